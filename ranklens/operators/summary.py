"""Summaries over topics, complete-topic averaging and z-score normalisation.

Per-topic scores are long rows ``(run_id, qid, measure, value)``.  The summary
is one ``groupBy(run_id, measure)``: sums for counts, means for rates, and
``exp(mean(log))`` for geometric means (gm_* topic rows already hold the log).
The kind of each requested measure name is a literal map built on the driver
from the request (bounded by the number of requested names).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklens.functions import catalog as C
from ranklens.functions.exact import exact_sum


def _kind(name: str) -> str:
    if name.startswith("Z") and name[1:] and not name.startswith("ZZ"):
        return C.summary_kind(name[1:])
    return C.summary_kind(name)


def _kind_map(names) -> F.Column:
    kv = []
    for n in sorted(set(names)):
        kv += [F.lit(n), F.lit(_kind(n))]
    return F.create_map(*kv) if kv else F.create_map()


def zscore(scores: DataFrame, zref: DataFrame) -> DataFrame:
    """Replace each topic value by its z-score against ``zref(qid, measure, mean, stddev)``.

    Missing reference -> -1000000; zero stddev -> 0 if equal to the mean else
    -1000000.  The output measure names carry a ``Z`` prefix.
    """
    z = zref.select("qid", "measure", F.col("mean").alias("_mean"), F.col("stddev").alias("_sd"))
    # the reference table is one row per (topic, measure): hash join, broadcast when small by AQE
    j = scores.join(z, ["qid", "measure"], "left")
    miss = F.lit(C.MISSING_ZSCORE)
    val = (
        F.when(F.col("_mean").isNull(), miss)
        .when(F.col("_sd") == 0, F.when(F.col("value") == F.col("_mean"), F.lit(0.0)).otherwise(miss))
        .otherwise((F.col("value") - F.col("_mean")) / F.col("_sd"))
    )
    return j.select("run_id", "qid", F.concat(F.lit("Z"), F.col("measure")).alias("measure"), val.alias("value"))


def summarize(
    scores: DataFrame,
    measure_names: list[str],
    judged_topics: DataFrame | None = None,
    complete: bool = False,
    num_q_name: str = "num_q",
) -> DataFrame:
    """Summary rows ``(run_id, qid='all', measure, value)`` plus ``num_q``.

    ``complete=True`` averages over every judged topic (``judged_topics(qid)``),
    a topic without results counting 0 (log(1e-5) for geometric means).
    """
    kinds = _kind_map(measure_names)
    agg = scores.groupBy("run_id", "measure").agg(F.sum("value").alias("_s"), F.count(F.lit(1)).alias("_c"))
    if complete:
        if judged_topics is None:
            raise ValueError("complete averaging needs the judged topics")
        # a scalar subquery: the number of judged topics, no join
        nq_col = judged_topics.agg(F.countDistinct("qid")).scalar()
    else:
        # every topic of a run has exactly one row per measure
        nq_col = F.col("_c")
    agg = agg.withColumn("_nq", nq_col.cast("long"))
    kind = F.element_at(kinds, F.col("measure"))
    nq = F.col("_nq").cast("double")
    geo_fix = (F.col("_nq") - F.col("_c")).cast("double") * math.log(C.MIN_GEO_MEAN)
    val = (
        F.when(kind == C.SUM, F.col("_s"))
        .when(kind == C.GEO, F.when(nq > 0, F.exp((F.col("_s") + geo_fix) / nq)).otherwise(0.0))
        .otherwise(F.when(nq > 0, F.col("_s") / nq).otherwise(0.0))
    )
    out = agg.where(F.coalesce(kind, F.lit(C.MEAN)) != C.TOPIC_ONLY).select(
        "run_id", F.lit("all").alias("qid"), "measure", val.cast("double").alias("value")
    )
    numq = agg.groupBy("run_id").agg(F.max("_nq").cast("double").alias("value")).select(
        "run_id", F.lit("all").alias("qid"), F.lit(num_q_name).alias("measure"), "value"
    )
    return out.unionByName(numq)


def topic_rows(scores: DataFrame, measure_names: list[str]) -> DataFrame:
    """Per-topic rows as printed: geometric-mean measures have no per-topic value."""
    kinds = _kind_map(measure_names)
    return scores.where(F.coalesce(F.element_at(kinds, F.col("measure")), F.lit(C.MEAN)) != C.GEO)


def with_summary(
    scores: DataFrame,
    measure_names: list[str],
    judged_topics: DataFrame | None = None,
    complete: bool = False,
    num_q_name: str = "num_q",
    per_topic: bool = True,
    counted: str | None = None,
) -> DataFrame:
    """Per-topic rows and summary rows from **one** aggregation (a rollup).

    ``rollup(run_id, measure, qid)`` yields the topic level, the per-measure
    summary level and the per-run level in a single pass over the scores, so
    the plan that computes the per-topic scores runs once (a union of topic
    rows and a separately aggregated summary would compute it twice).
    ``counted`` names a measure that every topic has one row of: its rows are
    the topics, so the number of topics needs no distinct count.
    """
    kinds = _kind_map(measure_names)
    r = scores.rollup("run_id", "measure", "qid").agg(
        exact_sum(F.col("value"), finite=False).alias("_s"),
        F.max("value").alias("_v"),  # a topic's only row, as it is
        F.count(F.lit(1)).alias("_c"),
        (F.count(F.when(F.col("measure") == counted, 1)) if counted else F.countDistinct("qid")).alias("_nqd"),
        F.grouping_id().alias("_g"),
    )
    kind = F.coalesce(F.element_at(kinds, F.col("measure")), F.lit(C.MEAN))
    if complete:
        if judged_topics is None:
            raise ValueError("complete averaging needs the judged topics")
        nq_all = judged_topics.agg(F.countDistinct("qid")).scalar().cast("long")
        nq_measure, nq_run = nq_all, nq_all
    else:
        nq_measure, nq_run = F.col("_c"), F.col("_nqd")
    nq = nq_measure.cast("double")
    geo_fix = (nq_measure - F.col("_c")).cast("double") * math.log(C.MIN_GEO_MEAN)
    summary_val = (
        F.when(kind == C.SUM, F.col("_s"))
        .when(kind == C.GEO, F.when(nq > 0, F.exp((F.col("_s") + geo_fix) / nq)).otherwise(0.0))
        .otherwise(F.when(nq > 0, F.col("_s") / nq).otherwise(0.0))
    )
    topic = (F.col("_g") == 0) & (kind != C.GEO)
    summ = (F.col("_g") == 1) & (kind != C.TOPIC_ONLY)
    runrow = F.col("_g") == 3
    keep = (topic | summ | runrow) if per_topic else (summ | runrow)
    return r.where(keep).select(
        "run_id",
        F.when(F.col("_g") == 0, F.col("qid")).otherwise(F.lit("all")).alias("qid"),
        F.when(runrow, F.lit(num_q_name)).otherwise(F.col("measure")).alias("measure"),
        F.when(F.col("_g") == 0, F.col("_v")).when(runrow, nq_run.cast("double")).otherwise(summary_val).cast("double").alias("value"),
    )
