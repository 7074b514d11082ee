"""Substring dedup: words of passages that occur earlier in the corpus are removed.

A window is ``window`` consecutive words.  Every window is routed by its
minimizer (the smallest hash of the word 4-grams in it), so equal windows reach
the same shard; neighbouring windows with one minimizer travel as one segment.
A shard drops the segments whose minimizer it has once, builds a compressed
FM-index (``fmindex``) over the others in (id, start) order and streams them
through it: matching statistics from backward search over the wavelet matrix
give, for every window, the interval of its occurrences and the earliest one.
The number of shards follows the text's size, so a shard stays small.
Segments that occur several times in one slice of a task's input travel once;
the later ones are known to be removed already, so a hot passage costs a shard
about one segment per slice of the input.  Equal segments at one place of one
document are one: no copy of them is the earlier one.

A document is an (id, text) pair: rows that repeat both are one document given
twice and get the same result; different texts under one id are ordered by a
hash of the text; a null id comes before all others.  Null, empty and short
texts have no windows and lose nothing.  Only id and text are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklens.llm.fmindex import FMIndex
from ranklens.llm.wordhash import Texts, mix, ngrams, text_slices

GRAM = 4
#: Bytes of text per shard, and windows per segment at most.
SHARD_BYTES = 2 << 20
SEGMENT_WINDOWS = 128
_NULL_ID = -(1 << 63)
_FIELDS = (("id", "<i8"), ("th", "<i4"), ("start", "<i4"), ("windows", "<i4"), ("gram", "<u4"), ("multi", "u1"))


def segments(words: np.ndarray, row: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window's word, number of windows, minimizer, its gram occurs more than once) of every segment."""
    n = len(words) - window + 1
    if n <= 0:
        e = np.zeros(0, np.int64)
        return e, e, e.astype(np.uint64), e.astype(bool)
    g, at = ngrams(words, np.zeros(len(words), np.int8), GRAM)  # grams across rows belong to no window
    span, low, have = window - GRAM + 1, g, 1
    while have < span:
        step = min(have, span - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    ok = row[:n] == row[window - 1 :]
    at = np.flatnonzero(ok)
    if not len(at):
        return at, at, low[:0], ok[:0]
    low = low[at]
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (low[1:] != low[:-1]) | (row[at[1:]] != row[at[:-1]])])
    # long runs are cut: windows stay whole, so this changes nothing but the segments' size
    first = np.flatnonzero(new)
    since = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    first = np.flatnonzero(since % SEGMENT_WINDOWS == 0)
    count = np.diff(np.append(first, len(at)))
    start, gram = at[first], low[first]
    size = count + span - 1
    inside = np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    same = np.add.reduceat((g[inside] == np.repeat(gram, size)).astype(np.int32), np.concatenate([[0], np.cumsum(size)[:-1]]))
    return start, count, gram, same > 1


def _pack(cols: dict[str, np.ndarray], text: bytes) -> bytes:
    head = np.array([len(cols["id"])], "<i8").tobytes()
    return zstandard.compress(head + b"".join(np.ascontiguousarray(cols[k], t).tobytes() for k, t in _FIELDS) + text, 9)


def _unpack(blob: bytes) -> tuple[dict[str, np.ndarray], bytes]:
    raw = zstandard.decompress(blob)
    n, at, cols = int(np.frombuffer(raw[:8], "<i8")[0]), 8, {}
    for k, t in _FIELDS:
        size = n * np.dtype(t).itemsize
        cols[k] = np.frombuffer(raw[at : at + size], t)
        at += size
    return cols, raw[at:]


def _route(part: pa.RecordBatch, window: int, shards: int) -> pa.RecordBatch:
    """A slice's segments as one blob per shard, and the segments that repeat an earlier one of the slice as plain rows."""
    t = Texts(part.column("text"))
    h = t.words()
    start, count, gram, multi = segments(h, t.row, window)
    rows = t.row[start]
    ids = part.column("id").to_numpy(zero_copy_only=False).astype(np.int64)[rows]
    th = part.column("th").to_numpy(zero_copy_only=False).astype(np.int64)[rows]
    own = (start - t.word_off[rows]).astype(np.int64)
    size = count + window - 1
    content = t.sequences(start, start + size)
    order = np.lexsort((own, th, ids, content))
    again = np.zeros(len(order), bool)
    again[order[1:]] = content[order[1:]] == content[order[:-1]]
    twice = np.zeros(len(order), bool)  # the same segment of a row given twice
    twice[order[1:]] = again[order[1:]] & (ids[order[1:]] == ids[order[:-1]]) & (th[order[1:]] == th[order[:-1]]) & (own[order[1:]] == own[order[:-1]])
    shard = (mix(gram) % np.uint64(shards)).astype(np.int32)
    out: dict[str, list] = {k: [] for k in ("shard", "id", "th", "start", "windows", "blob")}
    one = np.flatnonzero(~again)
    one = one[np.lexsort((own[one], ids[one], shard[one]))]  # in order, blobs get smaller
    cuts = np.flatnonzero(np.diff(shard[one])) + 1
    raw, first, last = t.raw.tobytes(), t.start, t.end
    for group in np.split(one, cuts) if len(one) else []:
        text = b"\n".join([raw[first[a] : last[a + n - 1]] for a, n in zip(start[group].tolist(), size[group].tolist())])
        cols = {"id": ids[group], "th": th[group], "start": own[group], "windows": count[group], "gram": mix(gram[group]) >> np.uint64(32), "multi": multi[group]}
        for k, v in (("shard", int(shard[group[0]])), ("id", 0), ("th", 0), ("start", 0), ("windows", 0), ("blob", _pack(cols, text))):
            out[k].append(v)
    known = np.flatnonzero(again & ~twice)
    plain = {"shard": shard[known], "id": ids[known], "th": th[known], "start": own[known], "windows": count[known]}
    kinds = {"shard": pa.int32(), "id": pa.int64(), "th": pa.int64(), "start": pa.int32(), "windows": pa.int32(), "blob": pa.binary()}
    arrays = [pa.concat_arrays([pa.array(out[k], kinds[k]), pa.nulls(len(known), kinds[k]) if k == "blob" else pa.array(plain[k], kinds[k])]) for k in kinds]
    return pa.RecordBatch.from_arrays(arrays, list(kinds))


def _shard(blobs: list[bytes], window: int) -> pd.DataFrame:
    """Runs of windows that occur earlier, over the segments of one shard."""
    parts = [_unpack(b) for b in blobs]
    col = {k: np.concatenate([p[0][k] for p in parts]).astype(np.int64) for k, _ in _FIELDS}
    texts = pa.array(_split(parts, col["windows"] + window - 1), pa.binary())
    _, inverse, times = np.unique(col["gram"], return_inverse=True, return_counts=True)
    keep = np.flatnonzero((times[inverse] > 1) | (col["multi"] > 0))
    empty = pd.DataFrame({"id": np.zeros(0, np.int64), "th": np.zeros(0, np.int64), "start": np.zeros(0, np.int32), "windows": np.zeros(0, np.int32)})
    if not len(keep):
        return empty
    keep = _once(keep, col, texts)
    ids, th, start, count = (col[k][keep] for k in ("id", "th", "start", "windows"))
    t = Texts(texts.take(pa.array(keep)).cast(pa.string()))
    vocab, symbol = np.unique(t.words(), return_inverse=True)
    size = np.diff(t.word_off)
    # the text: every segment and a separator, 0
    first = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    text = np.zeros(int((size + 1).sum()), np.int64)
    text[np.arange(len(symbol)) + t.row] = symbol + 1
    index = FMIndex(text, len(vocab) + 1, window)
    at, found = index.matches(first + size, size, text)
    hit = np.zeros(len(text), bool)
    hit[at[index.earliest[found] < at]] = True
    at = np.flatnonzero(hit)
    if not len(at):
        return empty
    seg = np.searchsorted(first, at, "right") - 1
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (seg[1:] != seg[:-1])])
    begin = np.flatnonzero(new)
    seg, pos = seg[begin], at[begin]
    return pd.DataFrame({"id": ids[seg], "th": th[seg], "start": (start[seg] + pos - first[seg]).astype(np.int32), "windows": np.diff(np.append(begin, len(at))).astype(np.int32)})


def _once(keep: np.ndarray, col: dict[str, np.ndarray], texts: pa.Array) -> np.ndarray:
    """The segments in (id, th, start) order; those that equal another in place and words are a row given twice and go."""
    keep = keep[np.lexsort((col["start"][keep], col["th"][keep], col["id"][keep]))]
    same = np.ones(max(len(keep) - 1, 0), bool)
    for k in ("id", "th", "start"):
        same &= col[k][keep[1:]] == col[k][keep[:-1]]
    stays, seen = np.ones(len(keep), bool), set()
    for i in np.flatnonzero(np.append(same, False) | np.append(False, same)).tolist():
        at = (*(int(col[k][keep[i]]) for k in ("id", "th", "start")), texts[int(keep[i])].as_py())
        stays[i] = at not in seen
        seen.add(at)
    return keep[stays]


def _split(parts: list[tuple[dict[str, np.ndarray], bytes]], sizes: np.ndarray) -> list[bytes]:
    """The segments' bytes; they are cut by their numbers of words, since white space inside may be line ends."""
    out, at = [], 0
    for cols, raw in parts:
        n = len(cols["id"])
        t = Texts(pa.array([raw], pa.binary()).cast(pa.string()))
        ends = np.cumsum(sizes[at : at + n])
        out += [raw[a:b] for a, b in zip(t.start[ends - sizes[at : at + n]].tolist(), t.end[ends - 1].tolist())]
        at += n
    return out


def _key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID))


def repeated_windows(docs: DataFrame, window: int = 20, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, start, windows): runs of windows (first word, number) that occur earlier; th is the text's hash."""
    src = docs.select(_key(id_col).alias("id"), F.hash(F.col(text_col)).cast("long").alias("th"), F.col(text_col).cast("string").alias("text"))
    if shards is None:
        total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(1, math.ceil(total / SHARD_BYTES))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                yield _route(part, window, shards)

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        blobs = rows["blob"].dropna().tolist()
        known = rows.loc[rows["blob"].isna(), ["id", "th", "start", "windows"]]
        return pd.concat([known, _shard(blobs, window)]) if blobs else known

    routed = src.mapInArrow(route, "shard int, id long, th long, start int, windows int, blob binary")
    return routed.groupBy("shard").applyInPandas(search, "id long, th long, start int, windows int")


def remove_repeats(docs: DataFrame, window: int = 20, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept): every text without the words of repeated windows, joined by one space.

    With ``digests`` ``kept_sha256`` stands for ``kept``.
    """
    found = repeated_windows(docs, window, shards, id_col, text_col)
    runs = found.groupBy("id", "th").agg(F.collect_list("start").alias("starts"), F.collect_list("windows").alias("counts"))
    src = docs.select(F.col(id_col).alias("given"), _key(id_col).alias("id"), F.hash(F.col(text_col)).cast("long").alias("th"), F.col(text_col).cast("string").alias("text"))
    joined = src.join(runs, ["id", "th"], "left").select("given", "text", "starts", "counts")
    last = "kept_sha256" if digests else "kept"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                n, removed, kept = [], [], []
                for text, starts, counts in zip(part.column("text"), part.column("starts"), part.column("counts")):
                    words = (text.as_py() or "").encode().split()
                    n.append(len(words))
                    if starts.is_valid and len(starts):
                        edge = np.zeros(len(words) + 1, np.int32)
                        a, c = starts.values.to_numpy(), counts.values.to_numpy()
                        np.add.at(edge, a, 1)
                        np.add.at(edge, a + c + window - 1, -1)
                        stays = np.cumsum(edge[:-1]) == 0
                        words = [w for w, s in zip(words, stays.tolist()) if s]
                    removed.append(n[-1] - len(words))
                    left = b" ".join(words)
                    kept.append(hashlib.sha256(left).hexdigest() if digests else left.decode())
                yield pa.RecordBatch.from_arrays([part.column("given"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["given", "n_words", "n_removed", last])

    id_type = src.schema["given"].dataType.simpleString()
    return joined.mapInArrow(cut, f"given {id_type}, n_words long, n_removed long, {last} string").withColumnRenamed("given", id_col)
