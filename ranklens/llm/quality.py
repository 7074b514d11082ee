"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once per document and stores one bit per failed
rule next to the measurements the rules read.  A policy is a versioned set of
bits: ``apply_policy`` keeps a document when none of its bits is set, and
``ablations`` says for every rule of a policy how many documents only that rule
rejects.  Neither looks at a text again.

Null and empty texts have all measurements 0 (and fail ``few_words``).  Rows
are judged one by one, so repeated rows and repeated ids give repeated rows.
Only ``doc_id`` and ``text`` are read; other columns, whatever their names, do
not reach the ledger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklens.llm.wordhash import Texts, mix, ngrams, text_slices

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


def _c(name: str) -> Column:
    return F.col(name)


#: name -> failure condition over the measurements; the position is the rule's bit and never changes.
RULES = {
    "few_words": lambda: _c("n_words") < 50,
    "repeated_words": lambda: 100 * _c("n_repeat_words") > 50 * _c("n_words"),
    "symbols": lambda: 100 * _c("n_symbols") > 8 * _c("word_chars"),
    "upper_case": lambda: 100 * _c("n_upper") > 50 * _c("word_chars"),
    "repeated_lines": lambda: 100 * _c("n_dup_lines") > 50 * _c("n_lines"),
    "short_words": lambda: 10 * _c("word_chars") < 20 * _c("n_words"),
    "long_words": lambda: _c("word_chars") > 40 * _c("n_words"),
}

#: Versioned policies: the rules that reject.
POLICIES = {
    1: ("few_words", "repeated_words"),
    2: ("few_words", "repeated_words", "symbols", "upper_case", "repeated_lines", "short_words", "long_words"),
}


def policy_mask(version: int) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in POLICIES[version])


def measure(col: pa.Array) -> dict[str, np.ndarray]:
    """The measurements of every text of a column."""
    t = Texts(col)
    total = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    per_row = lambda s: s[t.off[1:]] - s[t.off[:-1]]
    blank = np.zeros(256, bool)
    blank[[0x20, 9, 10, 11, 12, 13]] = True
    code_points = total((t.raw & 0xC0) != 0x80)
    white = total(blank[t.raw])
    upper = total((t.raw >= 65) & (t.raw <= 90))
    symbols = total(_SYMBOL[t.raw])

    start, end, row = t.lines()
    worded = np.searchsorted(t.start, end) > np.searchsorted(t.start, start)
    start, end, row = start[worded], end[worded], row[worded]
    key = mix(t.hash(start, end) + row.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    firsts = np.unique(key, return_index=True)[1]
    again = np.ones(len(key), bool)
    again[firsts] = False

    g, at = ngrams(t.words(), t.row, 3)
    g = mix(g + t.row[at].astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    _, inverse, count = np.unique(g, return_inverse=True, return_counts=True)
    hit = at[count[inverse] > 1]
    covered = np.zeros(len(t.start), bool)
    for k in range(3):
        covered[hit + k] = True
    return {
        "n_words": np.diff(t.word_off),
        "word_chars": per_row(code_points) - per_row(white),
        "n_symbols": per_row(symbols),
        "n_dup_lines": np.bincount(row[again], minlength=t.rows),
        "n_repeat_words": t.per_row(covered),
        "n_lines": np.bincount(row, minlength=t.rows),
        "n_upper": per_row(upper),
    }


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, measurements, failure_bits): bit i is set when rule i of ``RULES`` fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                m = measure(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(m[k].astype(np.int64)) for k in MEASURES)], ["id", *MEASURES])

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    measured = src.mapInArrow(run, f"id {id_type}, " + ", ".join(f"{k} long" for k in MEASURES))
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(rule(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failure_bits", bits).withColumnRenamed("id", id_col)


def apply_policy(led: DataFrame, version: int) -> DataFrame:
    """The ledger with ``kept``: no bit of the policy is set."""
    return led.withColumn("kept", F.col("failure_bits").bitwiseAND(F.lit(policy_mask(version)).cast("long")) == 0)


def ablations(led: DataFrame, version: int) -> DataFrame:
    """Per rule of the policy: documents it fails, and documents that only it rejects.

    The ledger is first counted by distinct bit pattern (at most 2^rules rows),
    so one pass answers for every rule.
    """
    mask = policy_mask(version)
    names = list(RULES)
    patterns = led.groupBy(F.col("failure_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit")) for r in POLICIES[version]))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return (
        patterns.withColumn("r", F.explode(rules))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        )
    )
