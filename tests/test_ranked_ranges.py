"""Ranks and running sums of ranges against plain Python: one constant score, one hot topic, nulls, ties, empty runs."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from ranklens.operators import ranked as RK
from ranklens.plans.evaluate import evaluate, evaluate_text

RUN = "run_id string, qid string, docno string, sim float"
QRELS = "qid string, docno string, rel int"


def plain_lists(run, qrels, max_docs=None, judged_only=False):
    """{(run, topic): [(docno, rel)] by rank}."""
    rel = {(q, d): r for q, d, r in qrels}
    topics = {q for q, _, _ in qrels}
    out = {}
    for key in {(r, q) for r, q, _, _ in run if q in topics}:
        rows = [(s, d) for r, q, d, s in run if (r, q) == key]
        rows.sort(key=lambda x: (x[1] is not None, x[1] or ""), reverse=True)
        rows.sort(key=lambda x: 0 if x[0] is not None and math.isnan(x[0]) else 1 if x[0] is not None else 2)
        rows.sort(key=lambda x: (0, 0) if x[0] is not None and math.isnan(x[0]) else (1, -x[0]) if x[0] is not None else (2, 0))
        listed = [(d, rel.get((key[1], d), -1)) for _, d in rows][:max_docs]
        listed = [(d, -2 if x < -1 or (x < 0 and (key[1], d) in rel) else x) for d, x in listed]
        out[key] = [x for x in listed if x[1] >= 0] if judged_only else listed
    return out


def made(kind, seed=1):
    r = random.Random(seed)
    run, qrels = [], []
    for q in range(12):
        n = 700 if q == 3 else r.choice([1, 2, 15])
        for i in range(n):
            sim = {"constant": 1.0, "ties": float(r.randrange(4)), "spread": r.random(), "odd": r.choice([0.0, -0.0, 1e30, -5.0, float("nan"), float("inf"), float("-inf"), None])}[kind]
            run.append((r.choice(["a", "b"]) if q != 3 else "a", str(q), f"d{i:04d}", sim))
            if r.random() < 0.5:
                qrels.append((str(q), f"d{i:04d}", r.choice([-1, 0, 0, 1, 2])))
        if q % 4 == 1:
            qrels = [x for x in qrels if x[0] != str(q)]  # not judged
        qrels.append(("only judged", f"x{q}", 1))
    return run, qrels


def lists(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.run_id, r.qid), []).append((r["rank"], r.docno, r.rel))
    for rows in out.values():
        rows.sort()
        assert [x[0] for x in rows] == list(range(1, len(rows) + 1))
    return {k: [x[1:] for x in v] for k, v in out.items()}


@pytest.mark.parametrize("kind", ["constant", "ties", "spread", "odd"])
@pytest.mark.parametrize("rows", [None, 7])
def test_lists_equal_plain_ones(spark, kind, rows):
    run, qrels = made(kind)
    a, q = spark.createDataFrame(run, RUN).repartition(5), spark.createDataFrame(qrels, QRELS)
    found = RK.build_ranked(a, q, split_rows=rows)
    assert lists(found) == plain_lists(run, qrels)
    if rows:  # the hot topic, of one score or not, is cut into many ranges of bounded size
        sizes = [x["count"] for x in found.where("qid = '3'").groupBy("bucket").count().collect()]
        assert len(sizes) > 50 and max(sizes) < 60
    top = plain_lists(run, qrels, 40)
    assert lists(RK.build_ranked(a, q, max_docs_=40, split_rows=rows)) == {k: v for k, v in top.items() if v}
    judged = plain_lists(run, qrels, 40, True)
    assert lists(RK.build_ranked(a, q, 40, True, rows)) == {k: v for k, v in judged.items() if v}


@pytest.mark.parametrize("rows", [None, 7])
def test_measures_of_one_constant_score(spark, rows):
    run, qrels = made("constant", 5)
    got = evaluate(spark.createDataFrame(run, RUN), spark.createDataFrame(qrels, QRELS), ["map", "bpref", "num_ret", "P.10", "ndcg", "num_q"], split_rows=rows)
    got = {(r.run_id, r.qid, r.measure): r.value for r in got.collect()}
    held = plain_lists(run, qrels)
    for (run_id, qid), listed in held.items():
        total = sum(1 for q, _, x in qrels if q == qid and x >= 1)
        rel = ap = 0
        for rank, (_, x) in enumerate(listed, 1):
            if x >= 1:
                rel += 1
                ap += rel / rank
        assert got[run_id, qid, "map"] == pytest.approx(ap / total if total else 0)
        assert got[run_id, qid, "num_ret"] == len(listed)
        assert got[run_id, qid, "P_10"] == pytest.approx(sum(x >= 1 for _, x in listed[:10]) / 10)
        ideal = sorted((x for q, _, x in qrels if q == qid and x > 0), reverse=True)
        best = sum(x / math.log2(i + 1) for i, x in enumerate(ideal, 1))
        dcg = sum(x / math.log2(i + 1) for i, (_, x) in enumerate(listed, 1) if x > 0)
        assert got[run_id, qid, "ndcg"] == pytest.approx(dcg / best if best else 0)
    for run_id in ("a", "b"):
        assert got[run_id, "all", "num_q"] == sum(k[0] == run_id for k in held)


def test_every_measure_is_the_same_in_any_ranges(spark):
    run, qrels = made("ties", 9)
    a, q = spark.createDataFrame(run, RUN), spark.createDataFrame(qrels, QRELS)
    key = lambda r: tuple(r)[:3]
    want = {key(r): r.value for r in evaluate(a, q, "all_trec", split_rows=10_000).collect()}
    got = {key(r): r.value for r in evaluate(a, q, "all_trec", split_rows=9).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    shown = lambda n: sorted(map(tuple, evaluate_text(a, q, ["relstring.30"], judged_only=n).collect()))
    letters = {-1: "-", -2: ".", 0: "0", 1: "1", 2: "2"}
    for n in (False, True):
        held = plain_lists(run, qrels, judged_only=n)
        assert shown(n) == sorted((*k, "relstring_30", "".join(letters[x] for _, x in v[:30])) for k, v in held.items() if v)


def test_empty_runs_and_judgments(spark):
    run, qrels = made("ties")
    a, q = spark.createDataFrame(run, RUN), spark.createDataFrame(qrels, QRELS)
    for x, y in ((a.limit(0), q), (a, q.limit(0)), (a.limit(0), q.limit(0))):
        assert RK.build_ranked(x, y).collect() == []
        assert evaluate(x, y, ["map"]).collect() == []


def test_map_takes_eight_shuffles(spark, tmp_path):
    run, qrels = made("ties")
    spark.createDataFrame(run, RUN).write.parquet(f"{tmp_path}/run")
    spark.createDataFrame(qrels, QRELS).write.parquet(f"{tmp_path}/qrels")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = evaluate(spark.read.parquet(f"{tmp_path}/run"), spark.read.parquet(f"{tmp_path}/qrels"), ["map"])
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"[-:] Exchange ", plan)) <= 8, plan


def test_run_ids_need_no_order(spark):
    """Runs with a ranked document in a judged topic, without windows over the lists."""
    from ranklens.plans.evaluate import evaluate_text

    run = spark.createDataFrame([("a", "1", "x", 1.0), ("a", "2", "y", 2.0), ("b", "3", "x", 1.0), ("c", "2", "z", None)], "run_id string, qid string, docno string, sim float")
    qrels = spark.createDataFrame([("1", "x", -1), ("2", "y", 1), (None, "z", 1)], "qid string, docno string, rel int")
    ids = lambda **k: sorted(r.value for r in evaluate_text(run, qrels, ["runid"], **k).collect())
    assert ids() == ids(max_docs=1) == ["a", "c"] and ids(max_docs=0) == []
    assert ids(judged_only=True) == ids(judged_only=True, max_docs=1) == ["a"]
    plan = evaluate_text(run, qrels, ["runid"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_only_lists_with_a_boundary_are_numbered(spark):
    from ranklens.operators.ordered import range_of

    rows = [("a", f"small {i:03d}", f"d{j}", float(j)) for i in range(200) for j in range(3)] + [("a", "zz long", f"d{j:04d}", float(j % 7)) for j in range(900)]
    df = spark.createDataFrame(rows, RUN).repartition(4)
    # all boundaries after the first lie in the long list; of the other lists at most one has a boundary
    found = df.withColumn("range", range_of(df, rows=500)).groupBy("qid").agg(F.min("range").alias("lo"), F.max("range").alias("hi")).collect()
    assert sum(x.hi > 0 for x in found if x.qid != "zz long") <= 2
    assert any(x.hi > x.lo for x in found if x.qid == "zz long")
