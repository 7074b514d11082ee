"""Preference measures against the recorded outputs (fixtures read as data)."""

from conftest import fixture, read_golden
from test_golden_qrels import _collect, _compare

from ranklens.plans.evaluate import evaluate_prefs
from ranklens.sources import read_prefs, read_qrels_prefs, read_run


def test_prefs(spark):
    run = read_run(spark, fixture("prefs.results.test"))
    prefs = read_prefs(spark, fixture("prefs.test"))
    got = _collect(evaluate_prefs(run, prefs))
    gold = read_golden("out.test.prefs")
    gold.pop("num_q", None)
    n, bad = _compare(got, gold)
    assert n > 300 and not bad, bad[:30]


def test_qrels_prefs(spark):
    run = read_run(spark, fixture("results.test"))
    prefs = read_qrels_prefs(spark, fixture("qrels.test"))
    got = _collect(evaluate_prefs(run, prefs))
    gold = read_golden("out.test.qrels_prefs")
    gold.pop("num_q", None)
    n, bad = _compare(got, gold)
    assert n > 50 and not bad, bad[:30]
