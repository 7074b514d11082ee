"""Preferences done inside tasks against the spread plans: repeats, nulls, cycles, small and large topics together."""

import random
from collections import Counter

import pytest

from ranklens.operators import prefs as PR
from ranklens.operators import topics as TP

RUN = "run_id string, qid string, docno string, sim float"
PREFS = "qid string, jg string, jsg string, docno string, rel_level double"


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(1)
    run, prefs = [], []
    for q in range(20):
        for d in range(r.randint(1, 14)):
            for run_id in "ab":
                if r.random() < 0.6:  # now and then a document is ranked twice
                    run += [(run_id, str(q), f"d{d}", r.choice([None, float("nan"), *map(float, range(6)), *map(float, range(6))])) for _ in range(1 + (r.random() > 0.93))]
            for jg in r.choice([["0"], ["0", "1"], ["0", "1", "2"]]):
                for jsg in r.choice([["s"], ["s", "t"], ["t", "u"]]):
                    if r.random() < 0.8:  # now and then a document has two levels
                        prefs += [(str(q), jg, jsg, f"d{d}", float(r.randrange(4))) for _ in range(1 + (r.random() > 0.9))]
        if q % 5 == 0:
            prefs += [(str(q), "0", None, "d0", 1.0), (str(q), "0", "s", "zz", None)]
    return spark.createDataFrame(run, RUN), spark.createDataFrame(prefs, PREFS)


def rows(df):
    return Counter(map(tuple, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("limit", [TP.SMALL_TOPIC, 60])
def test_tasks_equal_spread_plans(spark, tables, monkeypatch, limit):
    monkeypatch.setattr(TP, "SMALL_TOPIC", limit)
    run, prefs = tables
    counts = rows(PR.pref_counts(run, prefs))
    assert counts == rows(PR._spread_counts(run, prefs)) and counts
    pairs = rows(PR.pair_counts(run, prefs))
    assert pairs == rows(PR._spread_pairs(run, prefs)) and pairs
    assert rows(PR.pref_positions(run, prefs, 4)) == rows(PR._spread_positions(run, prefs, 4))
    edges = PR.pref_edges(prefs)
    assert rows(edges) == rows(PR._spread_edges(prefs))
    assert rows(PR.pref_closure(edges)) == rows(PR._spread_closure(PR._spread_edges(prefs)))


def test_faults_equal_spread_plan(spark, tables):
    prefs = tables[1].unionByName(spark.createDataFrame([(None, "0", "s", "d1", 2.0), (None, "0", "s", "d1", 1.0), ("3", None, "s", "d1", 2.0), ("3", None, "t", "d1", 0.0)], PREFS))
    found = rows(PR.validate_prefs(prefs))
    assert found == rows(PR._spread_faults(prefs)) and len({p for *_, p, _ in found}) == 3


def test_topics_are_sent_once(spark, tables):
    """Judgments and run of the small topics are shuffled once, and no pair is."""
    run, prefs = tables
    for df in (PR.pref_counts(run, prefs), PR.pair_counts(run, prefs), PR.validate_prefs(prefs), PR.pref_positions(run, prefs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan, plan


def test_topics_of_preferences_are_counted_without_their_levels(spark, tmp_path):
    from ranklens.sources import tables as T

    rows = [(1, 2, 3, 25.0, 0.03, "O", "N"), (1, 2, 3, 35.0, 0.07, "F", "A"), (1, 1, 4, 5.0, 0.0, "O", "R"), (None, 1, 4, None, None, None, None)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_tax double, l_linestatus string, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    p = T.multi_prefs(spark, str(tmp_path))
    assert "max(" not in p.select("qid")._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.qid, r.jg, r.jsg, r.docno, r.rel_level) for r in p.collect()}
    assert got == {("1", "0", "ls_O", "2-3", 3.0), ("1", "0", "rf_N", "2-3", 3.0), ("1", "1", "ls_O", "2-3", 2.0), ("1", "1", "rf_N", "2-3", 2.0),
                   ("1", "0", "ls_O", "1-4", 0.0), ("1", "0", "rf_R", "1-4", 0.0), ("1", "1", "ls_O", "1-4", 0.0), ("1", "1", "rf_R", "1-4", 0.0),
                   (None, "0", None, "1-4", None), (None, "1", None, "1-4", 0.0)}
    assert p.count() == 12


@pytest.mark.parametrize("limit", [TP.SMALL_TOPIC, 60])
def test_rows_by_document_equal_rows_one_by_one(spark, tables, monkeypatch, limit):
    """Documents that lie by topic move once, on their way there; large topics and odd rows are the same."""
    from pyspark.sql import functions as F

    run, prefs = tables
    prefs = prefs.unionByName(spark.createDataFrame([(None, "0", "s", "d1", 2.0), ("3", None, "s", None, 2.0), ("3", "0", "s", None, 1.0)], PREFS))
    run = run.unionByName(spark.createDataFrame([("a", None, "d1", 2.0), (None, "3", "d1", 2.0), ("a", "3", None, 1.0)], RUN)).withColumn("run_id", F.coalesce("run_id", F.lit("run")))
    both = prefs.select("qid", "docno", F.array(F.struct("jg", "jsg", "rel_level")).alias("judged"), F.expr("cast(array() as array<struct<run_id:string,sim:float>>)").alias("ranked"))
    both = both.unionByName(run.select("qid", "docno", F.expr("cast(array() as array<struct<jg:string,jsg:string,rel_level:double>>)").alias("judged"), F.array(F.struct("run_id", "sim")).alias("ranked")))
    docs = both.repartition("qid").groupBy("qid", "docno").agg(F.flatten(F.collect_list("judged")).alias("judged"), F.flatten(F.collect_list("ranked")).alias("ranked"))
    docs = docs.withColumn("n", (F.size("judged") + F.size("ranked")).cast("long"))
    monkeypatch.setattr(TP, "SMALL_TOPIC", limit)
    for work in (PR.pref_counts, PR.pair_counts, PR.pref_positions, PR.pref_measures):
        want = rows(work(run, prefs))
        assert rows(work(run, prefs, docs=docs)) == want and want
    if limit == TP.SMALL_TOPIC:
        plan = PR.pref_counts(run, prefs, docs=docs)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1, plan


def test_documents_of_the_lines_hold_the_preferences_and_the_run(spark, tmp_path):
    from pyspark.sql import functions as F
    from ranklens.sources import tables as T

    lines = [
        (1, 2, 3, 25.0, 0.03, "O", "N", 7.0, 0.0), (1, 2, 3, 35.0, 0.07, "F", "A", 9.0, 0.01), (1, 1, 4, 5.0, 0.0, "F", "R", 1.0, 0.04),
        (1, 3, 4, 5.0, 0.0, "F", "R", 1.0, 0.03), (2, 1, 4, None, 0.0, None, "R", None, 0.05), (2, 1, None, 1.0, None, None, None, float("nan"), None),
        (None, 1, 4, None, None, None, None, None, None), (None, 1, 4, 12.0, None, "O", None, 2.0, None), (2, 1, 4, None, 0.0, None, "R", None, 0.05),
    ]
    names = "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_tax double, l_linestatus string, l_returnflag string, l_extendedprice double, l_discount double"
    spark.createDataFrame(lines, names).write.parquet(str(tmp_path / "lineitem.parquet"))
    docs = T.pref_docs(spark, str(tmp_path))
    assert rows(docs.select("qid", "docno", F.inline("judged"))) == rows(T.multi_prefs(spark, str(tmp_path)))
    assert rows(docs.select("qid", "docno", F.inline("ranked"))) == rows(T.prefs_run(spark, str(tmp_path)))
    assert docs.where("n <> size(judged) + size(ranked)").isEmpty()


def test_lines_move_as_numbers_whatever_their_values(spark, tmp_path):
    """Small numbers and one-letter names move as one number; lines with other values are the same rows."""
    from pyspark.sql import functions as F
    from ranklens.sources import tables as T

    lines = [
        (1, 2, 3, 25.0, 0.03, "O", "N", 7.0, 0.0), (1, 255, (1 << 30) - 1, 2559.0, 0.07, "\x00", "\x7f", 9.0, 0.01), (1, 256, 3, 25.0, 0.03, "O", "N", 7.0, 0.0),
        (1, -1, 1 << 30, 2560.0, 0.0, "", "R", 1.0, 0.04), (2, 3, -4, -5.0, 0.0, "OO", "é", 1.0, 0.03), (2, 1, 4, None, 0.0, None, "R", None, 0.05),
        (2, None, 4, float("nan"), 0.0, "F", None, 3.0, 0.05), (2, 4, None, 1.0, None, "O", "A", 4.0, None), (2, 0, 0, 0.0, 0.06, "F", "A", 2.0, 0.0),
    ]
    names = "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_tax double, l_linestatus string, l_returnflag string, l_extendedprice double, l_discount double"
    spark.createDataFrame(lines, names).write.parquet(str(tmp_path / "lineitem.parquet"))
    docs = T.pref_docs(spark, str(tmp_path))
    assert rows(docs.select("qid", "docno", F.inline("judged"))) == rows(T.multi_prefs(spark, str(tmp_path)))
    assert rows(docs.select("qid", "docno", F.inline("ranked"))) == rows(T.prefs_run(spark, str(tmp_path)))
    plan = TP.doc_rows(docs)._jdf.queryExecution().executedPlan().toString()
    moved = plan.split("Exchange", 1)[1]
    assert "AS packed" in moved and "AS docno" not in moved and "Exchange" not in moved, plan
    sizes = {r.qid: r["count"] for r in T.pref_sizes(spark, str(tmp_path)).collect()}
    assert all(r.n <= sizes[r.qid] for r in docs.groupBy("qid").agg(F.sum("n").alias("n")).collect())


@pytest.mark.parametrize("limit", [TP.SMALL_TOPIC, 30])
def test_documents_are_counted_only_where_a_topic_may_be_large(spark, tmp_path, monkeypatch, limit):
    from pyspark.sql import functions as F
    from ranklens.sources import tables as T

    lines = [(q, i % 40, i % 3, float(i * 7 % 50), i % 9 / 100, "OF"[i % 2], "NAR"[i % 3], float(i * 13 % 17), i % 10 / 100) for q, n in ((1, 4), (2, 7), (3, 90)) for i in range(n)]
    names = "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_tax double, l_linestatus string, l_returnflag string, l_extendedprice double, l_discount double"
    sf = str(tmp_path)
    spark.createDataFrame(lines, names).write.parquet(f"{sf}/lineitem.parquet")
    monkeypatch.setattr(TP, "SMALL_TOPIC", limit)
    docs, sizes = T.pref_docs(spark, sf), T.pref_sizes(spark, sf)
    if limit == 2_048:
        unread = docs.withColumn("n", F.raise_error(F.lit("documents were counted")).cast("long"))
        assert TP.split_docs(unread, sizes)[1] is None
    else:
        large = TP.split_docs(docs, sizes)[1]
        assert {r.qid for r in large(spark.createDataFrame([("1",), ("2",), ("3",)], "qid string")).collect()} == {"2", "3"}
    for work in (PR.pref_positions, PR.pref_counts, PR.pair_counts, PR.pref_measures)[: 4 if limit == 2_048 else 1]:
        want = rows(work(T.prefs_run(spark, sf), T.multi_prefs(spark, sf)))
        assert rows(work(T.prefs_run(spark, sf), T.multi_prefs(spark, sf), docs=docs, sizes=sizes)) == want and want
