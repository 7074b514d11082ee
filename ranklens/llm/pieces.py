"""SentencePiece encoding and decoding through a table of distinct chunks.

A model whose pieces hold the white space mark only at their start can't make a
piece across the place before a mark that follows another character.  A
normalised text is therefore cut there into marked words (``marks`` then other
characters).  The rows of a task are taken in blocks of texts: every text
becomes the positions of its marked words in the block's table of distinct
marked words, the table is segmented once (by the sentencepiece library), and
ids, counts and decoded strings are joined back by position.  No rows are
shuffled, a block's table is freed with the block, and a lost task only repeats
its own rows.

Null texts count as empty; an empty text has the end id alone, as in the
library.  A text without white space is one chunk, however long.  Rows are
independent, so repeated rows give repeated results and other columns of the
input, whatever their names, are left out.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Characters of a block; its last text may go beyond.
BLOCK_CHARS = 16_000_000
_CHUNKS = re.compile(f"{MARK}+[^{MARK}]*").findall


class _Codes(dict):
    """Marked words in order of their first position."""

    def __missing__(self, word: str) -> int:
        self[word] = code = len(self)
        return code


class ChunkTable:
    """Segments distinct marked words of one model file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        rule = spec.normalizer_spec
        plain = not rule.precompiled_charsmap and rule.add_dummy_prefix and rule.escape_whitespaces and not rule.remove_extra_whitespaces
        if not plain or spec.trainer_spec.treat_whitespace_as_suffix or spec.denormalizer_spec.precompiled_charsmap:
            raise ValueError(f"{path}: the model rewrites its texts, marked words don't stand for them")
        if any(MARK in p.piece.lstrip(MARK) for p in spec.pieces if p.type in (p.NORMAL, p.USER_DEFINED)):
            raise ValueError(f"{path}: a piece crosses a white space mark")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end = self.library.eos_id()
        self._mark_alone = [self.library.piece_to_id(MARK)]

    def chunks(self, text: str) -> list[str]:
        """The marked words of a text: the library puts a mark before it and writes spaces as marks."""
        return _CHUNKS(MARK + text.replace(" ", MARK)) if text else []

    def segment(self, words: list[str]) -> list[list[int]]:
        """The ids of each marked word; the library adds the first mark itself, but not to an empty text."""
        found = self.library.encode([w[1:] for w in words], num_threads=1)
        return [ids or self._mark_alone for ids in found]

    def spoken(self, ids: list[list[int]]) -> list[str]:
        """Each marked word's decoded text without the white space of its first mark."""
        return self.library.decode(ids, num_threads=1)


@lru_cache(maxsize=1)
def _loaded(path: str) -> ChunkTable:
    return ChunkTable(path)


def _blocks(batches: Iterator[pa.RecordBatch], table: ChunkTable) -> Iterator[tuple[list, list[array], list[str]]]:
    """(row ids, positions of each text's marked words, distinct marked words) of blocks of texts."""
    ids, texts, codes, held = [], [], _Codes(), 0
    for batch in batches:
        for key, text in zip(batch.column("id"), batch.column("text")):
            text = text.as_py() or ""
            ids.append(key)
            texts.append(array("I", map(codes.__getitem__, table.chunks(text))))
            held += len(text) + 16
            if held >= BLOCK_CHARS:
                yield ids, texts, list(codes)
                ids, texts, codes, held = [], [], _Codes(), 0
    if ids:
        yield ids, texts, list(codes)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """(id, n_tokens, ids, decoded), or with ``digests`` (id, n_tokens, ids_sha256, decoded_sha256).

    ``model`` is the path of the model file on the executors.  The ids end with
    the end id, which counts in ``n_tokens`` and decodes to nothing.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["id", "n_tokens", "ids", "decoded"]

    def digest(parts) -> str:
        return hashlib.sha256(" ".join(parts).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _loaded(model)
        for keys, texts, words in _blocks(batches, table):
            ids = table.segment(words)
            spoken = table.spoken(ids) if words else []
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            shown = [" ".join(map(str, x)) for x in ids] if digests else []
            end = str(table.end)
            for lo in range(0, len(keys), 256):
                part = texts[lo : lo + 256]
                counts = [int(n[np.frombuffer(c, np.uint32)].sum()) + 1 for c in part]
                if digests:
                    a = [digest([*map(shown.__getitem__, c), end]) for c in part]
                    b = [digest(map(spoken.__getitem__, c)) for c in part]
                else:
                    a = [[*(i for k in c for i in ids[k]), table.end] for c in part]
                    b = [" ".join(map(spoken.__getitem__, c)) for c in part]
                kind = pa.string() if digests else pa.list_(pa.int32())
                ids_col = pa.array([k.as_py() for k in keys[lo : lo + 256]], keys[lo].type)
                yield pa.RecordBatch.from_arrays([ids_col, pa.array(counts, pa.int64()), pa.array(a, kind), pa.array(b, pa.string())], names)

    kinds = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return src.mapInArrow(run, f"id {id_type}, n_tokens long, {kinds}").withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded) of rows with lists of ids (null: empty), as the library decodes them."""
    src = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    id_type = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _loaded(model).library
        for part in batches:
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([library.decode(x.as_py() or []) for x in part.column("ids")], pa.string())], ["id", "decoded"])

    return src.mapInArrow(run, f"id {id_type}, decoded string").withColumnRenamed("id", id_col)
