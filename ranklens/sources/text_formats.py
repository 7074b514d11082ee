"""Readers for the whitespace-separated evaluation and learning-to-rank formats.

All readers are ``spark.read.text`` + ``split`` + casts: splittable, columnar
after the first stage, and the projections let Catalyst prune what a caller
does not use.  Blank lines are dropped; extra trailing fields are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_WS = r"\s+"


def _fields(spark: SparkSession, path: str, sep: str = _WS) -> DataFrame:
    t = spark.read.text(path)
    t = t.select(F.split(F.regexp_replace(F.col("value"), r"^\s+|\s+$", ""), sep).alias("f"), F.monotonically_increasing_id().alias("line_no"))
    return t.where(F.size("f") > 0).where(F.col("f")[0] != "")


def _at_least(n: int):
    """Lines with fewer than n fields are malformed: reading them is an error, never a silent drop."""
    bad = F.raise_error(F.concat(F.lit(f"malformed line, fewer than {n} fields: "), F.array_join("f", " "))).cast("array<string>")
    return lambda lines: lines.withColumn("f", F.when(F.size("f") < n, bad).otherwise(F.col("f")))


def read_run(spark: SparkSession, path: str) -> DataFrame:
    """``qid iter docno rank sim run_id`` -> run(run_id, qid, docno, sim float).

    The rank column is read but not used for ordering (``input_rank`` kept for
    reference); iter is ignored.
    """
    f = _fields(spark, path)
    return f.transform(_at_least(6)).select(
        F.col("f")[5].alias("run_id"),
        F.col("f")[0].alias("qid"),
        F.col("f")[2].alias("docno"),
        F.col("f")[4].cast("float").alias("sim"),
        F.col("f")[3].cast("long").alias("input_rank"),
    )


def read_qrels(spark: SparkSession, path: str) -> DataFrame:
    """``qid iter docno rel`` -> qrels(qid, docno, rel int)."""
    f = _fields(spark, path)
    return f.transform(_at_least(4)).select(
        F.col("f")[0].alias("qid"), F.col("f")[2].alias("docno"), F.col("f")[3].cast("int").alias("rel")
    )


def read_qrels_jg(spark: SparkSession, path: str) -> DataFrame:
    """``qid jg docno rel`` -> qrels_jg(qid, jg, docno, rel int)."""
    f = _fields(spark, path)
    return f.transform(_at_least(4)).select(
        F.col("f")[0].alias("qid"),
        F.col("f")[1].alias("jg"),
        F.col("f")[2].alias("docno"),
        F.col("f")[3].cast("int").alias("rel"),
    )


def read_prefs(spark: SparkSession, path: str) -> DataFrame:
    """``qid jg jsg docno rel_level`` -> prefs(qid, jg, jsg, docno, rel_level float)."""
    f = _fields(spark, path)
    return f.transform(_at_least(5)).select(
        F.col("f")[0].alias("qid"),
        F.col("f")[1].alias("jg"),
        F.col("f")[2].alias("jsg"),
        F.col("f")[3].alias("docno"),
        F.col("f")[4].cast("float").alias("rel_level"),
    )


def qrels_as_prefs(qrels_jg: DataFrame) -> DataFrame:
    """A judgment file seen as preferences: one sub-group ``'0'`` per group."""
    return qrels_jg.select("qid", "jg", F.lit("0").alias("jsg"), "docno", F.col("rel").cast("float").alias("rel_level"))


def read_qrels_prefs(spark: SparkSession, path: str) -> DataFrame:
    """``qid jg docno rel_level`` read as preferences with sub-group ``'0'``."""
    f = _fields(spark, path)
    return f.transform(_at_least(4)).select(
        F.col("f")[0].alias("qid"),
        F.col("f")[1].alias("jg"),
        F.lit("0").alias("jsg"),
        F.col("f")[2].alias("docno"),
        F.col("f")[3].cast("float").alias("rel_level"),
    )


def read_zref(spark: SparkSession, path: str) -> DataFrame:
    """``qid measure mean stddev`` -> zref(qid, measure, mean double, stddev double)."""
    f = _fields(spark, path)
    return f.transform(_at_least(4)).select(
        F.col("f")[0].alias("qid"),
        F.col("f")[1].alias("measure"),
        F.col("f")[2].cast("double").alias("mean"),
        F.col("f")[3].cast("double").alias("stddev"),
    )


def qrels_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Judgments split on single spaces (columns 0, 2, 3); the last duplicate wins.

    "Last" is file order: (file name, position in the file) — a file's lines
    keep their order within its splits.
    """
    t = spark.read.text(path).select(
        F.split(F.col("value"), " ").alias("f"),
        F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line")).alias("line_no"),
    )
    t = t.transform(_at_least(4))
    return t.groupBy(F.col("f")[0].alias("qid"), F.col("f")[2].alias("docno")).agg(
        F.max_by(F.col("f")[3].cast("int"), F.col("line_no")).alias("rel")
    )


def labels_from_qrels(qrels: DataFrame, order_col: str = "line_no") -> DataFrame:
    """Same rule on an already loaded table: last row per (qid, docno) by ``order_col``."""
    return qrels.groupBy("qid", "docno").agg(F.max_by("rel", order_col).alias("rel"))


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    """One title per line -> topics(qid, query); the title is its own id."""
    t = spark.read.text(path).select(F.trim("value").alias("query")).where(F.col("query") != "")
    return t.select(F.col("query").alias("qid"), "query")


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet", id_col: str = "para_id", text_col: str = "text") -> DataFrame:
    """Paragraphs as corpus(docno, text) from Parquet or JSON lines."""
    df = spark.read.format(fmt).load(path)
    return df.select(F.col(id_col).cast("string").alias("docno"), F.col(text_col).alias("text"))


def parse_ltr(lines: DataFrame, col: str = "value") -> DataFrame:
    """``label qid:q 1:v 2:v … # comment`` -> (label int, qid, features map<int,float>, comment)."""
    body = F.trim(F.split(F.col(col), "#", 2)[0])
    comment = F.trim(F.split(F.col(col), "#", 2)[1])
    toks = F.split(body, _WS)
    feats = F.filter(F.slice(toks, F.lit(3), F.size(toks)), lambda t: t.contains(":"))
    fmap = F.map_from_entries(
        F.transform(
            feats,
            lambda t: F.struct(
                F.split(t, ":")[0].cast("int").alias("k"), F.split(t, ":")[1].cast("float").alias("v")
            ),
        )
    )
    return lines.where(F.trim(F.col(col)) != "").select(
        toks[0].cast("int").alias("label"),
        F.regexp_replace(toks[1], "^qid:", "").alias("qid"),
        fmap.alias("features"),
        comment.alias("comment"),
    )


def read_ltr(spark: SparkSession, path: str) -> DataFrame:
    return parse_ltr(spark.read.text(path))
