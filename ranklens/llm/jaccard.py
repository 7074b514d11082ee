"""N-gram Jaccard join with prefix filters under several token orders.

A document's set holds the hashes of its distinct word shingles.  Two sets can
only reach the similarity when they share a token among the first
``n - ceil(t * n) + 1`` of each, under every global order of the tokens.  Order
one puts tokens in frequent buckets of a corpus-wide count sketch last, so its
prefixes hold rare tokens; documents that share one of them are candidates.
A shared token counts only where the two sets can be similar enough with it as
their first common one: each set's tokens before it are then not in the other.
Order two is a second hash: of the tokens below a fixed quantile of it, a set
may miss at most as many in the other set as the similarity allows at all.
Only pairs that pass both are verified, on their whole texts.

Equal sets are one node, however many documents have them, and near copies are
linked through the member of their block with the fewest rarer tokens
(``components.link_blocks``), which is the one with the fewest changes of its
own, so a group of copies never makes all pairs.  The sketch has a fixed number of
counters; it decides the order, never the result.

Null, empty and blank texts have no set: size 0, linked with nothing, their own
component.  A row with a null id takes part in links; if no id is reachable its
component is null.  Repeated rows give repeated results.  Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklens.llm.components import link_blocks
from ranklens.llm.shared import written
from ranklens.llm.wordhash import Texts, mix, ngrams, signed, text_slices

#: Counters of the sketch, and counters summed together.
COUNTERS, BLOCK = 1 << 20, 1 << 13
#: Share of the tokens that the second order's filter looks at (a power of two).
SECOND = 8
_ORDER_TWO = np.uint64(0x8CB92BA72F3D8DD7)


def sets(col: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, rows, row offsets): the distinct shingles of every text, sorted in each row."""
    t = Texts(col, lower=True)
    h = t.words()
    g, at = ngrams(h, t.row, n)
    row = t.row[at]
    size = np.diff(t.word_off)
    short = np.flatnonzero((size > 0) & (size < n))
    if len(short):
        # fewer words than a shingle: the whole sequence, told apart by its length
        own = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            has = size[short] > k
            own[has] = mix(own[has] + h[t.word_off[short[has]] + k] + np.uint64(k + 1))
        g, row = np.concatenate([g, own]), np.concatenate([row, short])
    order = np.lexsort((g, row))
    g, row = g[order], row[order]
    if len(g):
        one = np.concatenate([[True], (g[1:] != g[:-1]) | (row[1:] != row[:-1])])
        g, row = g[one], row[one]
    return g, row, np.searchsorted(row, np.arange(t.rows + 1))


def fingerprints(g: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One number per set (0 for none): sums of two mixes of its tokens, mixed with its size."""
    total = lambda x: np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)])
    a, b = total(mix(g + np.uint64(0x51))), total(mix(g ^ np.uint64(0x7F4A7C15F39CC060)))
    size = np.diff(off)
    out = mix((a[off[1:]] - a[off[:-1]]) ^ mix((b[off[1:]] - b[off[:-1]]) + size.astype(np.uint64)))
    return np.where(size > 0, out, np.uint64(0))


def _counted(id_type: str, n: int):
    """Pass one: (id, th, size, fp) of every row, and the task's counters in packed blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "th", "size", "fp", "block", "counts"]
        counts = np.zeros(COUNTERS, np.int64)
        seen = 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                g, _, off = sets(part.column("text"), n)
                counts += np.bincount((g & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
                seen += len(g)
                rows = part.num_rows
                cols = [part.column("id"), part.column("th"), pa.array(np.diff(off)), pa.array(signed(fingerprints(g, off))), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names)
        if seen:
            m = COUNTERS // BLOCK
            blobs = [counts[i * BLOCK : (i + 1) * BLOCK].astype("<i8").tobytes() for i in range(m)]
            yield pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.array(np.arange(m, dtype=np.int32)), pa.array(blobs, pa.binary())], names)

    return run


def _summed(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The counters of one partition's blocks, summed."""
    total: dict[int, np.ndarray] = {}
    for part in rows:
        for block, counts in zip(part["block"], part["counts"]):
            c = np.frombuffer(counts, "<i8")
            total[block] = total[block] + c if block in total else c
    yield pd.DataFrame({"block": list(total), "counts": [c.tobytes() for c in total.values()]})


def _classes(counted: DataFrame) -> np.ndarray:
    """Frequency class of every counter (0: within its usual spread): only the summed counters reach the driver."""
    blocks = counted.where("block is not null").select("block", "counts")
    for salt in ("rand(7) * 64", "0"):  # sums of sums, so no partition reads every task's counters
        blocks = blocks.repartition(COUNTERS // BLOCK, "block", F.expr(f"cast({salt} as int)")).mapInPandas(_summed, "block int, counts binary")
    counts = np.zeros(COUNTERS, np.int64)
    for r in blocks.collect():
        counts[r.block * BLOCK : (r.block + 1) * BLOCK] += np.frombuffer(r.counts, "<i8")
    usual = float(np.median(counts))  # what other tokens add to every counter, give or take its square root
    above = (counts - usual) / (np.sqrt(usual) + 1)
    return np.clip(np.floor(2 * np.log2(np.maximum(above, 1))), 0, 120).astype(np.uint8)


def prefix_size(size: np.ndarray, percent: int) -> np.ndarray:
    return np.where(size > 0, size - -(-size * percent // 100) + 1, 0)


def component_ids(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id): the smallest id reachable by links of ``100 * |A & B| >= percent * |A | B|``."""
    found = linked_rows(docs, n, percent, id_col, text_col)
    least = found.where("size > 0").groupBy("component").agg(F.min("id").alias("component_id"))
    out = found.where("size > 0").join(least, "component").select("id", "size", "component_id")
    out = out.unionByName(found.where("size = 0").select("id", "size", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, with one row of each component: the smallest by (id, hash of the text); texts without words all stay."""
    found = linked_rows(docs, n, percent, id_col, text_col).withColumn("at", F.struct(F.coalesce("id", F.lit(-(1 << 63))).alias("id"), "th"))
    first = found.where("size > 0").groupBy("component").agg(F.min("at").alias("at")).select("at.id", "at.th", F.lit(True).alias("once"))
    empty = found.where("size = 0").select("at.id", "at.th", F.lit(False).alias("once")).distinct()
    stays = first.unionByName(empty)
    # a given row is one column: its own columns may have any names
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.struct("*").alias("row"))
    again = F.row_number().over(Window.partitionBy("id", "th").orderBy("once"))  # a row given twice stays once
    return rows.join(stays, ["id", "th"]).withColumn("n", again).where("not once or n = 1").select("row.*")


def linked_rows(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(id, th, size, component): every row with its text's hash, its set's size and a number for its component."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).cast("string").alias("text"))
    counted = written(src.mapInArrow(_counted("long", n), "id long, th long, size long, fp long, block int, counts binary"), "sets")
    classes = spark.sparkContext.broadcast(_classes(counted))
    rows = counted.where("block is null").select("id", "th", "size", "fp")

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = classes.value
        for batch in batches:
            for part in text_slices(batch, "text"):
                g, row, off = sets(part.column("text"), n)
                order, first = _prefixes(g, row, off, kind, percent)
                fp = fingerprints(g, off)
                size, place = np.diff(off), np.arange(len(g)) - off[row]
                cols = [pa.array(signed(g[order][first])), pa.array(signed(fp[row[first]])), pa.array(size[row[first]].astype(np.int32)), pa.array(place[first].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, ["key", "id", "size", "place"])

    tokens = src.select("text").mapInArrow(prefixes, "key long, id long, size int, place int")
    shared = written(_shared(tokens), "shared")
    nodes = rows.where("size > 0").groupBy(F.col("fp").alias("id")).agg(F.min(F.struct(F.coalesce("id", F.lit(-(1 << 63))).alias("doc"), "th")).alias("at"), F.first("size").alias("size"))
    wanted = shared.select("id").distinct().join(nodes, "id").select("id", "size", "at.doc", "at.th")
    texts = src.select(F.coalesce("id", F.lit(-(1 << 63))).alias("doc"), "th", "text")
    texts = texts.join(wanted, ["doc", "th"]).dropDuplicates(["doc", "th"])
    texts = written(texts.select("id", "size", "text").mapInArrow(_second_order(n), "id long, size long, text string, low array<int>"), "candidates")
    overlap = f"(({percent}L * (a_size + b_size) + {99 + percent}) div {100 + percent})"
    # with this token as their first common one, at most the tokens from it on are common
    fits = f"100L * least(a_size, b_size) >= {percent}L * greatest(a_size, b_size) and least(a_size - a_place, b_size - b_place) >= {overlap} and a_at = greatest(a_own, b_own)"
    linked = link_blocks(_by_size(shared, percent), lambda pairs: _verified(pairs, texts, n, percent), ("size", "place", "own", "at"), fits, first="place", sides=("size",))

    return rows.join(linked.withColumnRenamed("id", "fp"), "fp", "left").select("id", "th", "size", F.coalesce("component", "fp").alias("component"))


def _shared(tokens: DataFrame) -> DataFrame:
    """The rows whose token stands in the prefixes of two different sets: one shuffle, and copies fold into one row."""
    w = Window.partitionBy("key")
    return tokens.withColumn("lo", F.min("id").over(w)).withColumn("hi", F.max("id").over(w)).where("lo <> hi").drop("lo", "hi").distinct()


def _by_size(shared: DataFrame, percent: int) -> DataFrame:
    """Blocks split by size: linked sizes lie in one class of sizes or two neighbouring ones."""
    step = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100 / percent) * (1 + 1e-9))).cast("int")
    return shared.withColumn("own", step).withColumn("at", F.explode(F.array(F.col("own"), F.col("own") + 1))).select(F.xxhash64("key", "at").alias("key"), "id", "size", "place", "own", "at")


def _prefixes(g: np.ndarray, row: np.ndarray, off: np.ndarray, kind: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(order one of every row's tokens, which of the ordered tokens are in the prefix)."""
    order = np.lexsort((g, kind[(g & np.uint64(COUNTERS - 1)).astype(np.int64)], row))
    place = np.arange(len(g)) - off[row]
    return order, place < prefix_size(np.diff(off), percent)[row]


def _second_order(n: int):
    """Adds the tokens under order two's quantile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                g, row, _ = sets(part.column("text"), n)
                other = mix(g ^ _ORDER_TWO)
                low = other < np.uint64((1 << 64) // SECOND)
                values = (other[low] & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
                cuts = np.searchsorted(row[low], np.arange(part.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "size", "text")), lists], ["id", "size", "text", "low"])

    return run


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs that pass the second order's filter and then the exact comparison."""
    low = texts.select("id", "low")
    both = pairs.join(low.select(F.col("id").alias("a"), F.col("low").alias("a_low")), "a").join(low.select(F.col("id").alias("b"), F.col("low").alias("b_low")), "b")
    overlap = F.ceil(F.lit(percent) * (F.col("a_size") + F.col("b_size")) / F.lit(100 + percent) - 1e-9)

    def least(side: str) -> Column:
        return F.size(f"{side}_low") - (F.col(f"{side}_size") - overlap)

    both = both.where(F.size(F.array_intersect("a_low", "b_low")) >= F.greatest(least("a"), least("b"))).select("a", "b")
    both = written(both, "pairs")
    text = texts.select("id", "text")
    joined = both.join(text.select(F.col("id").alias("a"), F.col("text").alias("a_text")), "a").join(text.select(F.col("id").alias("b"), F.col("text").alias("b_text")), "b")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                ga, ra, oa = sets(part.column("a_text"), n)
                gb, rb, ob = sets(part.column("b_text"), n)
                keys = np.concatenate([ga, gb])
                rows = np.concatenate([ra, rb])
                order = np.lexsort((keys, rows))
                keys, rows = keys[order], rows[order]
                same = (keys[1:] == keys[:-1]) & (rows[1:] == rows[:-1])
                common = np.bincount(rows[1:][same], minlength=part.num_rows)
                union = np.diff(oa) + np.diff(ob) - common
                ok = pa.array((100 * common >= percent * union) & (common > 0))
                yield part.select(["a", "b"]).filter(ok)

    return joined.mapInArrow(exact, "a long, b long").distinct()
