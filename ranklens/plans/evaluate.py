"""Evaluate runs against judgments: the whole evaluation as one Spark plan.

``run -> ranked lists with running sums (one scan of the order, in ranges) ->
one wide groupBy(run_id, qid) -> long rows -> summary (tiny second aggregation)``.  ``run_id`` is a key, so any
number of runs is evaluated in the same job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ranklens.functions import catalog as C
from ranklens.operators import measures as M
from ranklens.operators import summary as S
from ranklens.operators.ranked import build_ranked, run_ids, scan_ranked
from ranklens.session import checkpoint_dir


def evaluate(
    run: DataFrame,
    qrels: DataFrame,
    measures=None,
    relevance_level: int = 1,
    max_docs: int | None = None,
    judged_only: bool = False,
    complete: bool = False,
    per_topic: bool = True,
    zref: DataFrame | None = None,
    num_docs_in_coll: int = 0,
    split_rows: int | None = None,
    strict: bool = False,
) -> DataFrame:
    """Scores ``(run_id, qid, measure, value double)``; summary rows have qid ``'all'``.

    ``strict`` evaluates at once and raises ValueError when a run ranks a
    document twice for a topic, the judgments hold a document twice, or run and
    judgments have no topic in common; the rows that tell are counted while the
    evaluation runs.  String measures (``runid``, ``relstring``) are left to :func:`evaluate_text`.
    """
    ms = C.expand(measures)
    curves = M.topic_curves(qrels, M.list_measures(ms))
    faults = Observation() if strict else None
    ranked = scan_ranked(run, qrels, relevance_level, max_docs, judged_only, split_rows, curves, faults)
    scores = M.per_topic(ranked, qrels, ms, relevance_level, num_docs_in_coll)
    names = [n for m in ms for n in m.names()]
    counted = next((n for m in M.list_measures(ms) for n in m.names()), None)
    if zref is not None:
        scores = S.zscore(scores, zref)
        names = ["Z" + n for n in names]
        counted = counted and "Z" + counted
    judged = qrels.select("qid").distinct() if complete else None
    out = S.with_summary(scores, names, judged, complete, "Znum_q" if zref is not None else "num_q", per_topic, counted)
    return _checked(out, faults) if strict else out


def _checked(scores: DataFrame, faults: Observation) -> DataFrame:
    """The scores, evaluated and kept, unless the rows counted meanwhile show a fault."""
    checkpoint_dir(scores.sparkSession)
    scores = scores.checkpoint()
    if scores.isEmpty():
        raise ValueError("run and judgments have no topic in common")
    seen = faults.get
    if seen["judged_twice"]:
        raise ValueError(f"judgments hold a document of a topic more than once ({seen['judged_twice']} retrieved documents)")
    if seen["ranked_twice"]:
        raise ValueError(f"a run ranks a document of a topic more than once ({seen['ranked_twice']} rows)")
    return scores


def evaluate_text(run: DataFrame, qrels: DataFrame, measures=None, max_docs=None, judged_only=False) -> DataFrame:
    """String measures: ``runid`` (summary row) and ``relstring`` (per topic)."""
    ms = C.expand(measures)
    lists = [m for m in ms if m.name == "relstring"]
    runs = any(m.name == "runid" for m in ms)
    ranked = build_ranked(run, qrels, max_docs, judged_only) if lists or (runs and judged_only and max_docs is not None) else None
    parts = [M.relstring(ranked, int(m.params), m.names()[0]) for m in lists]
    if runs:
        parts.append((run_ids(run, qrels, max_docs, judged_only) if ranked is None else ranked.select("run_id").distinct()).select("run_id", F.lit("all").alias("qid"), F.lit("runid").alias("measure"), F.col("run_id").alias("value")))
    if not parts:
        return ranked.sparkSession.createDataFrame([], "run_id string, qid string, measure string, value string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def evaluate_jg(
    run: DataFrame,
    qrels_jg: DataFrame,
    measures="qrels_jg",
    relevance_level: int = 1,
    max_docs: int | None = None,
    judged_only: bool = False,
    complete: bool = False,
    per_topic: bool = True,
    split_rows: int | None = None,
) -> DataFrame:
    """Judgment-group measures (``map_avgjg``, ``P_avgjg``, ``Rprec_mult_avgjg``)."""
    from ranklens.operators.ranked import scan_ranked_jg

    ms = [m for m in C.expand(measures) if m.name in C.JG_MEASURES]
    # a judgment without a group belongs to no list
    ranked = scan_ranked_jg(run, qrels_jg.where("jg is not null"), relevance_level, max_docs, judged_only, split_rows)
    scores = M.per_topic_jg(ranked, qrels_jg, ms, relevance_level)
    names = [n for m in ms for n in m.names()]
    judged = qrels_jg.select("qid").distinct() if complete else None
    return S.with_summary(scores, names, judged, complete, per_topic=per_topic, counted=names[0] if names else None)


def evaluate_prefs(
    run: DataFrame,
    prefs: DataFrame,
    measures="all_prefs",
    max_docs: int | None = None,
    complete: bool = False,
    per_topic: bool = True,
    strict: bool = False,
    docs: DataFrame | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Preference measures per topic and summarised (``prefs_num_*`` summed, the rest averaged).

    ``docs``: the rows of run and preferences by document (``topics.doc_rows``), if they are at hand: they move once.
    ``sizes``: the rows that a topic has at most (``topics.split_docs``), if they are cheaper to count.

    ``strict`` raises ValueError on inconsistent preferences (``validate_prefs``) before evaluating.
    """
    from ranklens.operators.prefs import pref_measures, validate_prefs

    if strict:
        bad = validate_prefs(prefs).limit(1).collect()
        if bad:
            raise ValueError(f"inconsistent preferences: {bad[0].asDict()}")
    ms = [m for m in C.expand(measures) if m.name in C.PREF_MEASURES]
    scores = pref_measures(run, prefs, max_docs, ms, docs, sizes)
    names = [n for m in ms for n in m.names()]
    judged = prefs.select("qid").distinct() if complete else None
    return S.with_summary(scores, names, judged, complete, per_topic=per_topic, counted=names[0] if names else None)
