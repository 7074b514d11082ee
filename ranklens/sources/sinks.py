"""Writers for runs, learning-to-rank rows and evaluation reports (``write.text``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklens.functions import catalog as C


def run_lines(hits: DataFrame, tag_col: str = "method", team: str | None = None, exact: bool = False) -> DataFrame:
    """``qid Q0 docno rank score tag`` (tag = team-method when a team is given).

    The score has 6 decimals, which may tie documents of different scores;
    ``exact`` writes the shortest digits that read back as the same double
    (``read_run`` keeps them in its own precision of scores, a float).
    """
    tag = F.col(tag_col) if team is None else F.concat(F.lit(team + "-"), F.col(tag_col))
    if exact:
        score = F.col("score").cast("double").cast("string")
        return hits.select(F.format_string("%s Q0 %s %d %s %s", "qid", "docno", F.col("rank").cast("long"), score, tag).alias("value"))
    return hits.select(
        F.format_string("%s Q0 %s %d %.6f %s", "qid", "docno", F.col("rank").cast("long"), F.round("score", 6), tag).alias("value")
    )


def write_run(hits: DataFrame, path: str, tag_col: str = "method", team: str | None = None, exact: bool = False) -> None:
    run_lines(hits, tag_col, team, exact).write.mode("overwrite").text(path)


def ltr_lines(ltr: DataFrame) -> DataFrame:
    """``label qid:q 1:f1 … k:fk # DocId:d``."""
    cols = sorted([c for c in ltr.columns if c.startswith("f") and c[1:].isdigit()], key=lambda c: int(c[1:]))
    feats = [F.concat(F.lit(f"{i + 1}:"), F.col(c).cast("float").cast("string")) for i, c in enumerate(cols)]
    return ltr.select(
        F.concat_ws(
            " ", F.col("label").cast("string"), F.concat(F.lit("qid:"), F.col("qid")), *feats, F.concat(F.lit("# DocId:"), F.col("docno"))
        ).alias("value")
    )


def write_ltr(ltr: DataFrame, path: str) -> None:
    ltr_lines(ltr).write.mode("overwrite").text(path)


def _measure_order() -> list[Column]:
    """Measures in the order of the catalogue, a measure's values by their parameter."""
    parameter = r"_([-+0-9.,=]+)$"
    place = F.create_map(*(F.lit(x) for i, name in enumerate(C.SPEC) for x in (name, i)))
    named = F.coalesce(F.try_element_at(place, F.col("measure")), F.try_element_at(place, F.regexp_replace("measure", parameter, "")), F.lit(len(C.SPEC)))
    return [named, F.regexp_extract("measure", parameter, 1).try_cast("double"), F.col("measure")]


def report_lines(scores: DataFrame, text_scores: DataFrame | None = None) -> DataFrame:
    """``measure<TAB>qid<TAB>value``: counts as integers, rates with 4 decimals, strings quoted as printed.

    Lines are ordered: run after run, each run's topics and then its summary
    (``all``), the measures as in the catalogue.
    """
    sums = [k for k, v in C.SPEC.items() if v[2] in (C.SUM, C.COUNT)]
    is_int = F.col("measure").isin(*sums)
    val = F.when(is_int, F.format_string("%d", F.round("value").cast("long"))).otherwise(F.format_string("%6.4f", "value"))
    out = scores.select("run_id", "qid", "measure", val.alias("shown"))
    if text_scores is not None:
        q = F.when(F.col("measure").startswith("relstring"), F.concat(F.lit("'"), F.col("value"), F.lit("'"))).otherwise(F.col("value"))
        out = out.unionByName(text_scores.select("run_id", "qid", "measure", q.alias("shown")))
    out = out.orderBy("run_id", F.col("qid") == "all", "qid", *_measure_order())
    return out.select(F.format_string("%-22s\t%s\t%s", "measure", "qid", "shown").alias("value"))


def write_report(scores: DataFrame, path: str, text_scores: DataFrame | None = None) -> None:
    """The report's lines, in order over the part files by their names."""
    report_lines(scores, text_scores).write.mode("overwrite").text(path)


def top_content(hits: DataFrame, corpus: DataFrame, qids: DataFrame | None = None) -> DataFrame:
    """Rank and text of the hits of the chosen queries, per method."""
    h = hits if qids is None else hits.join(qids.select("qid"), "qid", "left_semi")
    return h.join(corpus, "docno").select("qid", "method", "rank", "docno", "text")
