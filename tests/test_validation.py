"""Strict evaluation and inconsistent preferences."""

import itertools
import random

import pytest

from ranklens.operators import prefs as PR
from ranklens.plans.evaluate import evaluate, evaluate_prefs

RUN = [("a", "1", "x", 3.0), ("a", "1", "y", 2.0), ("a", "2", "x", 1.0), ("b", "1", "x", 3.0), ("b", "9", "x", 3.0), ("b", "9", "x", 2.0)]
QRELS = [("1", "x", 1), ("1", "z", 1), ("2", "y", 0), ("8", "y", 1)]


def tables(spark, run, qrels):
    return spark.createDataFrame(run, "run_id string, qid string, docno string, sim double"), spark.createDataFrame(qrels, "qid string, docno string, rel int")


def test_sound_input_gives_the_same_scores(spark):
    run, qrels = tables(spark, RUN, QRELS)  # topic 9 isn't judged, its duplicate doesn't matter
    want = sorted(map(tuple, evaluate(run, qrels, ["map", "P.5"]).collect()))
    assert len(want) > 8
    assert sorted(map(tuple, evaluate(run, qrels, ["map", "P.5"], strict=True).collect())) == want


def test_document_ranked_twice(spark):
    run, qrels = tables(spark, [*RUN, ("a", "1", "y", 0.5)], QRELS)
    with pytest.raises(ValueError, match="ranks a document"):
        evaluate(run, qrels, ["map"], strict=True)


def test_document_judged_twice(spark):
    run, qrels = tables(spark, RUN, [*QRELS, ("1", "x", 0)])
    with pytest.raises(ValueError, match="judgments hold"):
        evaluate(run, qrels, ["map"], strict=True)


def test_no_common_topic(spark):
    run, qrels = tables(spark, RUN, [("7", "x", 1)])
    with pytest.raises(ValueError, match="no topic in common"):
        evaluate(run, qrels, ["map"], strict=True)


PREFS = "qid string, jg string, jsg string, docno string, rel_level double"


def plain_cyclic(rows):
    out = set()
    for key in {r[:2] for r in rows}:
        held = [r for r in rows if r[:2] == key]
        edges = {(a[3], b[3]) for a, b in itertools.product(held, held) if a[2] == b[2] and a[4] > b[4]}
        while True:
            more = {(a, d) for a, b in edges for c, d in edges if b == c} - edges
            if not more:
                break
            edges |= more
        on = {a for a, b in edges if a == b}
        out |= {(*key, x) for x in {b for a, b in edges if a in on} & {a for a, b in edges if b in on}}
    return out


def test_cycles_equal_the_closure(spark):
    r = random.Random(3)
    rows = []
    for q in range(40):
        for _ in range(r.randint(1, 14)):
            rows.append((str(q), r.choice("01"), r.choice("abc"), f"d{r.randrange(7)}", float(r.randrange(4))))
    rows += [("chain", "0", "ab"[i % 2], f"d{i // 2 + j}", float(1 - j)) for i in range(16) for j in (0, 1)]
    rows += [("levels", "0", "a", f"d{i}", float(i)) for i in range(30)]
    want = plain_cyclic(rows)
    assert {k[0] for k in want} and not {k for k in want if k[0] in ("levels",)}
    assert {tuple(x) for x in PR.cyclic_docs(spark.createDataFrame(rows, PREFS)).collect()} == want
    assert PR.cyclic_docs(spark.createDataFrame([], PREFS)).collect() == []


def test_inconsistent_preferences_raise(spark):
    run = spark.createDataFrame(RUN, "run_id string, qid string, docno string, sim double")
    sound = [("1", "0", "a", "x", 2.0), ("1", "0", "a", "y", 1.0), ("1", "0", "b", "x", 2.0), ("1", "0", "b", "y", 1.0)]
    assert evaluate_prefs(run, spark.createDataFrame(sound, PREFS), ["prefs_simp"], strict=True).count() > 0
    cycle = [*sound[:2], ("1", "0", "b", "x", 1.0), ("1", "0", "b", "y", 2.0)]
    with pytest.raises(ValueError, match="inconsistent"):
        evaluate_prefs(run, spark.createDataFrame(cycle, PREFS), ["prefs_simp"], strict=True)
