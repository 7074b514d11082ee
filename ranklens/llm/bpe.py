"""BPE encoding and decoding with forced boundaries.

A merge across two neighbouring bytes needs a vocabulary token that holds these
two bytes side by side.  Byte pairs that no token holds are therefore certain
cuts: a word is cut at every such pair, the fragments are merged independently
(by the tokenizers library's merge rule) and their ids are concatenated, which gives the ids of the whole word.  The
last byte of a word carries the end-of-word mark, so it counts as another
symbol, and the end of a word is always a cut.

The vocabulary file is a ``tokenizers`` JSON file of a byte-level BPE with an
end-of-word mark.  Texts are normalised as the file says (NFC, lower case).  Special tokens found in a text are emitted as they are,
as the library does.  Null texts count as empty and have no ids.  Rows are
independent: repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words remembered per worker; a full memory is emptied.
REMEMBERED = 500_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in table]
    table |= {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


#: The word pattern that ``_COMMON_WORD`` equals on common characters (fixed value of the vocabulary file).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_COMMON_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\s\w]|_)+").findall
#: Characters on which every Unicode version agrees about letters, numbers and lower case.
_UNCOMMON = re.compile("[^\x00-\x1b\x20-\u024f\u0400-\u0482\u048a-\u0527\u2010-\u2027\u20ac]").search


class ForcedBoundaryBPE:
    def __init__(self, path: str):
        from tokenizers import Tokenizer, models

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.mark = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        #: Merging of fragments inside a word and of fragments that end it.
        self._inner = models.BPE(vocab=self.vocab, merges=merges).tokenize
        self._last = models.BPE(vocab=self.vocab, merges=merges, end_of_word_suffix=self.mark or None).tokenize
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        library = Tokenizer.from_file(path)
        self._normalise = library.normalizer.normalize_str if library.normalizer else str
        self._pre_tokenise = library.pre_tokenizer.pre_tokenize_str
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split = next((p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"), "")
        self._common = kinds == ["NFC", "Replace", "Lowercase"] and split == SPLIT
        self._specials = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self._bytes = byte_symbols()
        self._byte_of = {c: b for b, c in enumerate(self._bytes)}
        #: Neighbouring symbols that stand side by side in some token.
        self.inside: set[tuple[str, str]] = set()
        for token in self.vocab:
            s = self._symbols_of_token(token)
            self.inside.update(zip(s, s[1:]))
        self._word_ids: dict[str, tuple[int, ...]] = {}

    def _symbols_of_token(self, token: str) -> list[str]:
        if self.mark and token.endswith(self.mark) and token != self.mark:
            body = token[: -len(self.mark)]
            return [*body[:-1], body[-1] + self.mark]
        return list(token)

    def fragments(self, symbols: list[str]) -> Iterator[list[str]]:
        """The symbols cut between every two that no token holds side by side."""
        lo, inside = 0, self.inside
        for k, pair in enumerate(zip(symbols, symbols[1:]), 1):
            if pair not in inside:
                yield symbols[lo:k]
                lo = k
        yield symbols[lo:]

    def _encode_word(self, word: str) -> tuple[int, ...]:
        symbols = [self._bytes[b] for b in word.encode()]
        symbols[-1] += self.mark
        *inner, last = self.fragments(symbols)
        ids = [t.id for f in inner for t in self._inner("".join(f))]
        return (*ids, *(t.id for t in self._last("".join(last)[: -len(self.mark) or None])))

    def words(self, text: str) -> list[str]:
        """The normalised words; texts with uncommon characters go through the library's own Unicode tables."""
        if self._common and not _UNCOMMON(text):
            return _COMMON_WORD(unicodedata.normalize("NFC", text).lower())
        found = self._pre_tokenise(self._normalise(text))
        return [bytes(self._byte_of[c] for c in w).decode() for w, _ in found]

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text."""
        out: list[int] = []
        known = self._word_ids
        for k, piece in enumerate(self._specials.split(text) if self._specials else [text]):
            if k % 2:
                out.append(self.special[piece])
                continue
            if not piece:
                continue
            for word in self.words(piece):
                ids = known.get(word)
                if ids is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    ids = self._encode_word(word)
                    if len(word) <= 64:
                        known[word] = ids
                out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The tokens' strings joined by spaces: the vocabulary file names no decoder."""
        return " ".join([self.tokens[i] for i in ids])


@lru_cache(maxsize=2)
def _loaded(path: str) -> ForcedBoundaryBPE:
    return ForcedBoundaryBPE(path)


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """(id, n_tokens, ids, decoded), or with ``digests`` (id, n_tokens, ids_sha256, decoded_sha256).

    ``vocabulary`` is the path of the vocabulary file on the executors.  A
    digest never leaves the worker as a list, so very long texts stay small.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["id", "n_tokens", "ids", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(vocabulary)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                n, a, b = [], [], []
                for text in part.column("text"):
                    ids = bpe.encode(text.as_py() or "")
                    decoded = bpe.decode(ids)
                    n.append(len(ids))
                    a.append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() if digests else ids)
                    b.append(hashlib.sha256(decoded.encode()).hexdigest() if digests else decoded)
                kind = pa.string() if digests else pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n, pa.int64()), pa.array(a, kind), pa.array(b, pa.string())], names)

    kinds = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return src.mapInArrow(run, f"id {id_type}, n_tokens long, {kinds}").withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded) of rows with lists of ids (null: empty)."""
    src = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    id_type = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(vocabulary)
        for part in batches:
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([bpe.decode(x.as_py() or []) for x in part.column("ids")], pa.string())], ["id", "decoded"])

    return src.mapInArrow(run, f"id {id_type}, decoded string").withColumnRenamed("id", id_col)
