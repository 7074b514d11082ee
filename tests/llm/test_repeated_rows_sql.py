"""A document row given twice: the operator and its SQL both keep the row's words."""

import duckdb

from ranklens.llm import queries, substrings


def test_repeated_rows_agree_with_sql(spark):
    first = " ".join(f"w{i}" for i in range(25))
    rows = [(1, first), (1, first), (2, first + " tail"), (3, " ".join(f"x{i}" for i in range(30)) + " " + first), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    documents = docs.toPandas()  # noqa: F841
    want = sorted(duckdb.sql(queries._OP10_SQL).fetchall())
    got = sorted(tuple(r) for r in substrings.remove_repeats(docs, digests=True).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())
    assert got == want
    assert [(r[0], r[2]) for r in got] == [(1, 0), (1, 0), (2, 25), (3, 25), (4, 0), (5, 0)]
