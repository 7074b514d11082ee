"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes, into ``DIMENSIONS`` slots, of its
words, word pairs and word pairs with one or two words between.  Words are runs
of letters and digits (and of any non-ASCII bytes), A-Z lower-cased.

Training reads a bounded, documented sample: at most ``max_per_class`` labelled
documents of each class, chosen by a hash of their id.  The sample is split
into shards; every shard runs FTRL-proximal (per-coordinate rates, L1 and L2)
over its documents, and the shards' weights are averaged.  L1 leaves few
weights above zero, so what is broadcast has at most ``DIMENSIONS`` numbers,
however much is scored.

Null and empty texts have no features: their score is the bias alone.  Without
any labelled row of both classes every score is 0.  Repeated rows are scored
one by one; labels are one per id (the largest counts), null labels are left
out.  Columns other than id and text are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklens.llm.wordhash import NOT_WORD, Texts, mix, ngrams, text_slices

DIMENSIONS = 1 << 20
#: Slot of the bias, past the hashed ones.
BIAS = DIMENSIONS
#: Bytes of text whose features a task holds at once (a longer text alone).
SLICE = 1 << 20
#: Offsets of the words in each kind of feature.
KINDS = ((0,), (0, 1), (0, 2), (0, 3))


def features(col: pa.Array, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(slots, row offsets): the distinct features of every text, the bias slot included; with ``known`` flags, of known slots only."""
    t = Texts(col, NOT_WORD, lower=True)
    h = t.words()
    keys = [np.arange(t.rows, dtype=np.int64) << 21 | BIAS]
    for gaps in KINDS:
        g, at = ngrams(h, t.row, len(gaps), gaps)
        slot = (g & np.uint64(DIMENSIONS - 1)).astype(np.int64)
        if known is not None:
            hit = np.flatnonzero(known[slot])
            slot, at = slot[hit], at[hit]
        keys.append(t.row[at] << 21 | slot)
    keys = np.unique(np.concatenate(keys))
    return (keys & (1 << 21) - 1).astype(np.int32), np.searchsorted(keys >> 21, np.arange(t.rows + 1))


def ftrl(slots: np.ndarray, off: np.ndarray, labels: np.ndarray, alpha: float, beta: float, l1: float, l2: float, epochs: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots, weights) above zero after ``epochs`` passes of FTRL-proximal over the rows in order; both classes weigh the same in sum."""
    positive = labels.sum()
    rarer = max(1.0, (len(labels) - positive) / max(positive, 1))
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
    one = np.ones(DIMENSIONS + 1)
    one[BIAS] = 0  # the bias is not shrunk

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        return np.where(np.abs(zi) <= l1 * one[at], 0.0, -(zi - np.sign(zi) * l1 * one[at]) / ((beta + np.sqrt(n[at])) / alpha + l2 * one[at]))

    for _ in range(epochs):
        for i in range(len(labels)):
            at = slots[off[i] : off[i + 1]]
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[i]
            g *= rarer if labels[i] else 1.0
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    seen = np.flatnonzero(n)
    w = weights(seen)
    return seen[w != 0], w[w != 0]


def sample(labels: DataFrame, usable: Column, max_per_class: int, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """(id, label): at most ``max_per_class`` usable labelled ids of each class, by the hash of the id."""
    one = labels.where(usable & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    pick = [one.where(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(max_per_class) for v in (0, 1)]
    return pick[0].unionByName(pick[1])


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column | None = None,
    max_per_class: int = 8000,
    shards: int = 4,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 8.0,
    l2: float = 0.01,
    epochs: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """(slot, weight): the averaged weights of the shards.

    The sampled ids are at most ``2 * max_per_class`` rows of two numbers, which
    is the size bound of the broadcast to the documents.
    """
    ids = sample(labels, F.lit(True) if usable is None else usable, max_per_class, id_col, label_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(ids), "id")
    rows = rows.select("id", "text", "label", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(shards)).cast("int").alias("shard"))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.iloc[np.argsort(mix(rows["id"].map(hash).to_numpy().astype(np.int64)), kind="stable")]
        table = pa.RecordBatch.from_arrays([pa.array(rows["text"], pa.large_string()).cast(pa.large_string())], ["text"])
        parts = [features(p.column("text")) for p in text_slices(table, "text", SLICE)]
        slots = np.concatenate([s for s, _ in parts])
        sizes = np.concatenate([np.diff(o) for _, o in parts])
        at, w = ftrl(slots, np.concatenate([[0], np.cumsum(sizes)]), rows["label"].to_numpy(), alpha, beta, l1, l2, epochs)
        return pd.DataFrame({"slot": at.astype(np.int32), "weight": w})

    fitted = rows.groupBy("shard").applyInPandas(fit, "slot int, weight double")
    return fitted.groupBy("slot").agg((F.sum("weight") / F.lit(shards)).alias("weight"))


def score(docs: DataFrame, weights: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, kept columns, score): the model's probability for every row.

    ``weights`` is collected as the model: at most ``DIMENSIONS + 1`` rows.
    """
    return docs.select(id_col, *keep, _scorer(weights)(F.col(text_col).cast("string")).alias("score"))


def clean(docs: DataFrame, weights: DataFrame, below: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns (of any names), that score under ``below``."""
    return docs.where(_scorer(weights)(F.col(text_col).cast("string")) < below)


def _scorer(weights: DataFrame) -> Callable[[Column], Column]:
    """A text column -> its scores: only texts are sent to Python, and only scores come back."""
    model = weights.where("weight <> 0").toPandas()
    w = np.zeros(DIMENSIONS + 1, np.float32)
    w[model["slot"].to_numpy(np.int64)] = model["weight"].to_numpy(np.float32)
    trained = len(model) > 0
    shared = weights.sparkSession.sparkContext.broadcast((model["slot"].to_numpy(np.int32), w[model["slot"].to_numpy(np.int64)]))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        full = np.zeros(DIMENSIONS + 1, np.float64)
        full[shared.value[0]] = shared.value[1]
        known = full != 0

        def found(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            slots, off = features(col, known)
            return full[slots], np.diff(off)

        for texts in batches:
            out = [np.zeros(0)]
            for part in text_slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
                hits, sizes = zip(*(found(p.column("text")) for p in text_slices(part, "text", SLICE)))
                total = np.concatenate([[0], np.cumsum(np.concatenate(hits))])
                off = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
                s = total[off[1:]] - total[off[:-1]]
                out.append(1 / (1 + np.exp(-np.clip(s, -35, 35))) if trained else np.zeros(len(s)))
            yield pa.array(np.concatenate(out))

    return F.arrow_udf(run, "double")
