"""Exact steps along a weight against a brute-force ranking at every step."""

import math
import random

import pytest

from ranklens.operators import ltr as LT

SCHEMA = "qid string, docno string, label int, f1 double, f2 double, f3 double"


def rows_of(seed, queries=4, docs=9):
    rng = random.Random(seed)
    values = [0.0, 0.0, 1.0, 0.5, 0.25, 1 / 3]
    return [(f"q{q}", f"d{d}", rng.choice([0, 0, 1, 2]), *(rng.choice(values) for _ in range(3))) for q in range(queries) for d in range(docs)]


def measured(rows, w, metric, num_rel=None):
    total, by_query = 0.0, {}
    for r in rows:
        by_query.setdefault(r[0], []).append(r)
    for qid, docs in by_query.items():
        scale = float(1 << 52)
        score = {d[1]: sum(round(a * b * scale) for a, b in zip(w, d[3:])) for d in docs}
        ranked = sorted(docs, key=lambda d: (-score[d[1]], d[1]))
        rel = [i for i, d in enumerate(ranked, 1) if d[2] > 0]
        if metric == "map":
            norm = (num_rel or {}).get(qid, len(rel))
            got = sum(n / i for n, i in enumerate(rel, 1))
        else:
            cut = int(metric.split("@")[1])
            dcg = lambda labels: sum((2**x - 1) / math.log2(i + 1) for i, x in enumerate(labels[:cut], 1) if x > 0)
            norm, got = dcg(sorted((d[2] for d in docs), reverse=True)), dcg([d[2] for d in ranked])
        total += got / norm if norm else 0.0
    return total / len(by_query)


@pytest.mark.parametrize("metric", ["map", "ndcg@3"])
def test_every_step_has_the_measured_value(spark, metric):
    rows = rows_of(3) + [("none", "d1", 0, 1.0, 0.0, 0.0), ("one", "d1", 1, 0.5, 0.0, 0.0)]
    features = spark.createDataFrame(rows, SCHEMA)
    start = [0.5, 0.2, 0.3]
    steps = LT.line_steps(features, [(-1, start)], metric).collect()
    assert {s.coord for s in steps} == {0, 1, 2}
    tested = 0
    for s in steps:
        if s.until is not None and s.until - s.t <= LT.MIN_WIDTH:
            continue
        t = s.until - 1 if s.t == LT._START else s.t + 1 if s.until is None else (s.t + s.until) / 2
        w = list(start)
        w[s.coord] += t
        assert abs(s.value - measured(rows, w, metric)) < 1e-9, (s, w)
        tested += 1
    assert tested > 20


def test_states_leave_their_folds_out(spark):
    rows = rows_of(5, queries=6)
    features = LT.kfold_split(spark.createDataFrame(rows, SCHEMA), 2)
    fold = {r.qid: r.fold for r in features.select("qid", "fold").distinct().collect()}
    states = [(0, [1.0, 0.0, 0.0]), (1, [0.2, 0.3, 0.5]), (-1, [0.2, 0.3, 0.5])]
    got = LT._values(features, states, LT.query_norms(features), "map")
    for i, (left, w) in enumerate(states):
        mine = [r for r in rows if fold[r[0]] != left]
        assert abs(got.get(i, 0.0) - (measured(mine, w, "map") if mine else 0.0)) < 1e-9


def test_search_value_is_measured_and_no_single_step_gains_more(spark):
    rows = rows_of(11)
    features = spark.createDataFrame(rows, SCHEMA)
    judged = spark.createDataFrame([("q0", 20)], "qid string, R int")
    w, value = LT.weight_search(features, restarts=2, num_rel=judged)
    assert abs(sum(map(abs, w)) - 1) < 1e-9
    assert abs(value - measured(rows, w, "map", {"q0": 20})) < 1e-9
    best = LT.best_steps(LT.line_steps(features, [(-1, w)], "map", LT.query_norms(features, "map", judged))).first()
    assert best.value - value <= LT.TOLERANCE
    grid = [[math.cos(a) * math.cos(b), math.sin(a) * math.cos(b), math.sin(b)] for a in (0, 0.7, 1.5, 2.3, 3.1, 4.5) for b in (-1.2, -0.4, 0.3, 1.0)]
    assert value >= sorted(measured(rows, g, "map", {"q0": 20}) for g in grid)[len(grid) // 2]


def test_no_rows_and_bad_metric(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert LT.weight_search(empty, restarts=1) == ([1 / 3] * 3, 0.0)
    with pytest.raises(ValueError):
        LT.weight_search(empty, metric="err")


def test_cross_validation_holds_folds_out(spark):
    rows = rows_of(7, queries=6)
    got = LT.cv_eval(spark.createDataFrame(rows, SCHEMA), 2, restarts=1).orderBy("fold").collect()
    assert [r.fold for r in got] == [0, 1]
    assert all(0 <= r.train_map <= 1 and 0 <= r.test_map <= 1 for r in got)
