"""Fusion of several rankings into learning-to-rank feature rows.

``rr_features``: one row per (query, candidate document), feature i =
1 / rank in ranking i (float32), 0 when the document is not in that ranking.
It is a single ``groupBy(qid, docno).pivot(method, <fixed list>)`` — the
explicit value list avoids the extra job that discovers pivot values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: feature order f1..f5 as the feature files are written
FEATURE_METHODS = ("bnn_bnn", "lnc_ltn", "lm_laplace", "lm_jm", "lm_dirichlet")


def union_candidates(hits: DataFrame) -> DataFrame:
    """Distinct (qid, docno) over all rankings."""
    return hits.select("qid", "docno").dropDuplicates(["qid", "docno"])


def rr_features(hits: DataFrame, methods=FEATURE_METHODS) -> DataFrame:
    """(qid, docno, f1..fk float) reciprocal-rank features; absent -> 0."""
    piv = hits.groupBy("qid", "docno").pivot("method", list(methods)).agg(F.first(1.0 / F.col("rank")))
    return piv.select(
        "qid", "docno", *[F.coalesce(F.col(m), F.lit(0.0)).cast("float").alias(f"f{i + 1}") for i, m in enumerate(methods)]
    )


def pooled_qrels(candidates: DataFrame, labels: DataFrame) -> DataFrame:
    """Judgments for the pooled candidates from per-document labels.

    Fixed grading: 2 = good and not toxic, 1 = good, -1 = toxic (judged
    unusable), 0 otherwise; candidates without a label are not judged.
    """
    lab = labels.select(
        F.col("doc_id").cast("string").alias("docno"),
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
        .when(F.col("quality") == 1, 1)
        .when(F.col("toxic") == 1, -1)
        .otherwise(0)
        .cast("int")
        .alias("rel"),
    )
    return candidates.join(lab, "docno").select("qid", "docno", "rel")


def relevance_label(candidates: DataFrame, qrels: DataFrame) -> DataFrame:
    """label 1 if judged rel > 0 else 0 (left join; unjudged -> 0)."""
    q = qrels.select("qid", "docno", F.col("rel").alias("_rel"))
    return candidates.join(q, ["qid", "docno"], "left").select(
        "qid", "docno", F.when(F.col("_rel") > 0, 1).otherwise(0).cast("int").alias("label")
    )


def ltr_dataset(hits: DataFrame, qrels: DataFrame, methods=FEATURE_METHODS) -> DataFrame:
    """(qid, docno, label, f1..fk): candidates ⟕ features ⟕ labels."""
    feats = rr_features(hits, methods)
    lab = relevance_label(feats.select("qid", "docno"), qrels)
    return feats.join(lab, ["qid", "docno"]).select("qid", "docno", "label", *[f"f{i + 1}" for i in range(len(methods))])
