"""Ranges of the order (run_id, qid, score descending, docno) and prefix sums over them.

A ranked list can be any length, and every document of it can have the same
score, so neither a topic nor a score may be one unit of work.  ``range_of``
cuts the whole order at boundaries from a sample of its keys: about as many
ranges as there are shuffle partitions, each with about as many rows, however
they spread over runs, topics and scores.  Most ranges hold many whole lists, a
long list lies in several.  The boundaries are a constant of the plan and a row
finds its range by bisection, so the range is a plain column, the same in every
use and after any retry; the sample changes sizes, never results.

Work inside (list, range) is a window; what earlier ranges of the same list
hold is added from ``prefix_sums`` over one row for each list and range.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklens.session import shuffles_end

#: Sampled keys for each range.
SAMPLES = 20

_BOUNDS = "array<struct<k:struct<run_id:string,qid:string,kind:int,s:double>,docno:string>>"


def _score_key(sim: float | None) -> tuple[int, float]:
    if sim is None:
        return 2, 0.0
    return (0, 0.0) if math.isnan(sim) else (1, -sim)


def range_of(run: DataFrame, docno_desc: bool = True, rows: int | None = None, by: tuple[Column, ...] | None = None) -> Column:
    """The number of a row's range in its list, for any DataFrame with run's columns run_id, qid, sim and docno.

    Only lists with a boundary inside are searched; the rows of any other list are range 0.

    Counts and samples ``run`` at once.  ``rows``: rows of a range, about
    (default: as many ranges as shuffle partitions).  ``by``: other columns in
    the roles of these four, two strings, a number (descending) and a string.
    """
    run_id, qid, sim, docno = by or tuple(map(F.col, ("run_id", "qid", "sim", "docno")))
    sim = sim.cast("double")
    keys = run.select(run_id.alias("run_id"), qid.alias("qid"), sim.alias("sim"), docno.alias("docno"))
    with shuffles_end(run.sparkSession):
        n = keys.count()
    ranges = -(-n // rows) if rows else int(run.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if n == 0 or ranges < 2:
        return F.lit(0)
    fraction = SAMPLES * ranges / n
    with shuffles_end(run.sparkSession):
        found = keys.sample(min(fraction, 1.0), seed=7).collect()
    found.sort(key=lambda r: (r.docno is not None, r.docno or ""), reverse=docno_desc)
    found.sort(key=lambda r: (r.run_id, r.qid, *_score_key(r.sim)))
    cuts = sorted({i * len(found) // ranges for i in range(1, ranges)} - {0})
    listed = []
    for c in cuts:
        kind, s = _score_key(found[c].sim)
        listed.append({"k": {"run_id": found[c].run_id, "qid": found[c].qid, "kind": kind, "s": s}, "docno": found[c].docno})
    if not listed:
        return F.lit(0)
    bounds = F.from_json(F.lit(json.dumps(listed)), _BOUNDS)
    kind = F.when(sim.isNull(), 2).when(F.isnan(sim), 0).otherwise(1)
    mine = F.struct(run_id.alias("run_id"), qid.alias("qid"), kind.alias("kind"), F.when(kind == 1, -sim).otherwise(0.0).alias("s"))

    def reached(b: Column) -> Column:
        if docno_desc:  # nulls last
            tie = F.when(b["docno"].isNull(), docno.isNull()).otherwise(docno.isNull() | (docno <= b["docno"]))
        else:  # nulls first
            tie = F.when(b["docno"].isNull(), F.lit(True)).otherwise(docno.isNotNull() & (docno >= b["docno"]))
        return (mine > b["k"]) | ((mine == b["k"]) & tie)

    steps = [1 << i for i in reversed(range(len(listed).bit_length()))]
    # the largest number of boundaries that the row has reached, bit by bit
    found_at = F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda at, step: F.when((at + step <= len(listed)) & F.coalesce(reached(F.get(bounds, at + step - 1)), F.lit(False)), at + step).otherwise(at),
    )
    # a list without a boundary lies in one range, whatever its number: its rows need no search
    cut = [c.isin(*{b["k"][k] for b in listed}) for c, k in ((run_id, "run_id"), (qid, "qid"))]
    return F.when(cut[0] & cut[1], F.coalesce(found_at, F.lit(0))).otherwise(0)  # never null, so joins need not test it


def prefix_sums(totals: DataFrame, keys, sums, bucket: str = "bucket") -> DataFrame:
    """``totals`` (keys, bucket, sums) with off_<sum>: the sums of earlier ranges of the same list."""
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumns({f"off_{c}": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in sums})
