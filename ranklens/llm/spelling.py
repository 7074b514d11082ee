"""Spelling variants: words one edit apart, the more frequent form of each, and the root that forms lead to.

Candidates come from Bloom-guided neighbourhoods.  Every vocabulary word
generates its deletions and its replacements by larger letters; insertions and
replacements by smaller letters are the same pairs seen from the other word.  An
edit's hash follows from the word's own hash in one step, and is probed against
blocked Bloom filters, one shard for each word length (64-bit blocks, sized by
the number of words of the length).  The filters are broadcast; beyond
``FILTER_BYTES`` they are probed in several rounds, each with a range of their
blocks, so the broadcast is bounded whatever the vocabulary.  Only positives
become strings and are shuffled to an exact join with the vocabulary, which
removes the false ones.

A word has at most 181 times its length neighbours, so no group is hot: counts
are aggregated before their shuffle, edits are dealt evenly.  A form has at
least twice the count of its word, so forms never lead in a circle and a chain
of k forms ends after about log2(k) doubling rounds.

Words are made of A-Z, a-z and U+00C0 to U+00FF, so each code point is one
Latin-1 byte.  Null texts have no words, a null id counts as an empty one,
repeated rows count each time, words of any length are whole, an empty table
gives no rows, and other columns of the input, whatever their names, are left
out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklens.llm.shared import written

#: Most bytes of filters that are broadcast at once.
FILTER_BYTES = 32_000_000
#: Bits for each word, and bits set by one.
BITS, SET = 24, 5
#: Blocks that one task fills.
SLAB = 4096
#: Words of a task that generates edits, and cells (words x length) handled at once.
TASK_WORDS, CELLS = 20_000, 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


# ---------------------------------------------------------------- words


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 5, least: int = 3, damaged: int | None = 97) -> DataFrame:
    """(word, n) of the lower-cased letter runs of at least ``shortest`` letters that occur ``least`` times.

    With ``damaged``, a run whose crc32 (with its document's id) is divisible by it loses one letter.
    """
    run = F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit("[A-Za-zÀ-ÿ]+"), 0))
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run.alias("run")).select("id", F.translate("run", _UPPER, _LOWER).alias("word"))
    if damaged:
        runs = runs.where(F.length("word") >= shortest).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word").cast("binary")))
        at = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        runs = runs.select(F.when(F.col("h") % damaged == 0, cut).otherwise(F.col("word")).alias("word"))
    return runs.where(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


# ---------------------------------------------------------------- hashes and filters


def _powers(n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = _BASE
    return np.multiply.accumulate(out)


def _hashes(letters: np.ndarray) -> np.ndarray:
    """The sums of letter times power of its place (modulo 2^64), for rows of words of one length."""
    return (letters.astype(np.uint64) * _powers(letters.shape[1])).sum(axis=1, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Places:
    """Where the words of each length have their blocks: shards of a length lie side by side."""

    def __init__(self, words_of_length: dict[int, int]):
        self.first, self.blocks, self.total = {}, {}, 0
        for length, n in sorted(words_of_length.items()):
            self.first[length], self.blocks[length] = self.total, -(-n * BITS // 64)
            self.total += self.blocks[length]

    def of(self, length: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(block, bits) of hashes of words of one length."""
        h = _mixed(hashes)
        block = ((h >> np.uint64(32)) * np.uint64(self.blocks[length])) >> np.uint64(32)
        bits = np.zeros(h.shape, np.uint64)
        for k in range(SET):
            bits |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
        return block.astype(np.int64) + self.first[length], bits


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, letters) of the batch's words, a length and ``CELLS`` at a time."""
    coded = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
    lengths = np.fromiter(map(len, coded), np.int64, len(coded))
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        step = max(1, CELLS // int(length))
        for lo in range(0, len(rows), step):
            part = rows[lo : lo + step]
            yield part, np.frombuffer(b"".join([coded[r] for r in part]), np.uint8).reshape(len(part), length)


def _filter_range(words: DataFrame, places: Places, lo: int, hi: int) -> np.ndarray:
    """The blocks ``lo`` to ``hi`` of the filters, filled by slabs."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, letters in _by_length(batch):
                block, mask = places.of(letters.shape[1], _hashes(letters))
                held = (block >= lo) & (block < hi)
                block = block[held] - lo
                yield pa.RecordBatch.from_arrays([pa.array(block // SLAB), pa.array(block % SLAB), pa.array(mask[held].view(np.int64))], ["slab", "block", "bits"])

    def fill(rows: pa.Table) -> pa.Table:
        slab = np.zeros(SLAB, np.uint64)
        np.bitwise_or.at(slab, rows["block"].to_numpy(), rows["bits"].to_numpy().view(np.uint64))
        return pa.table({"slab": rows["slab"][:1], "filled": pa.array([slab.tobytes()], pa.binary())})

    slabs = words.mapInArrow(bits, "slab long, block long, bits long").groupBy("slab").applyInArrow(fill, "slab long, filled binary")
    out = np.zeros(-(-(hi - lo) // SLAB) * SLAB, np.uint64)
    for row in slabs.collect():  # FILTER_BYTES at most
        out[row.slab * SLAB : (row.slab + 1) * SLAB] = np.frombuffer(row.filled, np.uint64)
    return out


# ---------------------------------------------------------------- edits


def _edits(letters: np.ndarray, alphabet: np.ndarray, shards: dict[int, int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, Callable[[np.ndarray], np.ndarray]]]:
    """(target length, hashes, rows, letters of chosen edits) for every place of words of one length."""
    n, length = letters.shape
    wide, power = letters.astype(np.uint64), _powers(length)
    whole = (wide * power).sum(axis=1, dtype=np.uint64)
    before = np.zeros(n, np.uint64)
    for i in range(length):
        here = wide[:, i]
        if length - 1 in shards:  # one deletion for each run of equal letters
            rows = np.flatnonzero(letters[:, i] != letters[:, i - 1]) if i else np.arange(n)
            after = (whole - before - here * power[i])[rows] * _INVERSE
            yield length - 1, before[rows] + after, rows, lambda chosen, i=i, rows=rows: np.delete(letters[rows[chosen]], i, axis=1)
        larger = alphabet[None, :] > letters[:, i, None]
        rows, at = np.nonzero(larger)
        put = alphabet[at]

        def replaced(chosen: np.ndarray, i: int = i, rows: np.ndarray = rows, put: np.ndarray = put) -> np.ndarray:
            out = letters[rows[chosen]]
            out[:, i] = put[chosen]
            return out

        yield length, whole[rows] + (put.astype(np.uint64) - here[rows]) * power[i], rows, replaced
        before = before + here * power[i]


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): each pair of vocabulary words one edit apart, in both directions."""
    spark = words.sparkSession
    counts = {r[0]: r[1] for r in words.groupBy(F.length("word")).count().collect()}
    places = Places(counts)
    letters = words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect()  # 116 at most
    alphabet = np.array(sorted(ord(r.c) for r in letters), np.uint8)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sum(counts.values()) // TASK_WORDS))
    dealt = words.repartition(tasks, "word")
    positives, step = [], FILTER_BYTES // 8
    for lo in range(0, places.total, step):
        hi = min(lo + step, places.total)
        held = spark.sparkContext.broadcast(_filter_range(dealt, places, lo, hi))

        def probe(batches: Iterator[pa.RecordBatch], lo: int = lo, hi: int = hi, held=held) -> Iterator[pa.RecordBatch]:
            blocks = held.value
            for batch in batches:
                for rows, chars in _by_length(batch):
                    source, found = [], []
                    for length, hashes, local, spelled in _edits(chars, alphabet, counts):
                        block, bits = places.of(length, hashes)
                        inside = (block >= lo) & (block < hi)
                        hit = np.flatnonzero(inside)[(blocks[block[inside] - lo] & bits[inside]) == bits[inside]]
                        if len(hit):
                            source.append(rows[local[hit]])
                            found += [bytes(x).decode("latin-1") for x in spelled(hit)]
                    if found:
                        taken = batch.take(pa.array(np.concatenate(source)))
                        yield pa.RecordBatch.from_arrays([taken.column("word"), taken.column("n"), pa.array(found, pa.string())], ["word", "n", "near"])

        positives.append(written(dealt.mapInArrow(probe, "word string, n long, near string"), "probes"))
        held.destroy()
    if not positives:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    union = positives[0]
    for more in positives[1:]:
        union = union.unionByName(more)
    exact = union.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "n", "near", "near_n")
    both = F.array(F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return exact.select(F.inline(both))


# ---------------------------------------------------------------- forms and roots


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): every round doubles the forms that are followed."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = written(now.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if longer.where("moved").isEmpty():
            return longer.select("word", "root")
        now = longer.select("word", "root")


def variants(words: DataFrame, times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n).

    The form is the near word of the largest count (ties: the smallest in
    code-point order) if that is at least ``times`` the word's count.
    """
    words = written(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    found = near_pairs(words).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    fits = -F.col("best.less") >= times * F.col("n")
    found = written(found.select("word", "n_near", F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")), "near")
    out = words.join(found, "word", "left").join(_roots(found.where("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("form_n").cast("long").alias("form_n"))
