"""Measures on graded judgments against the evaluation tool's recorded outputs.

The fixture files are read as data; values are compared at the 4 printed decimals.
"""

import math

import pytest

from conftest import fixture, read_golden
from ranklens.plans.evaluate import evaluate, evaluate_text
from ranklens.sources import read_qrels, read_run, read_zref

SKIP_NUMERIC = {"runid", "relstring", "relstring_20"}


def _collect(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["measure"], {})[r["qid"]] = r["value"]
    return out


def _compare(got, golden, only=None):
    bad = []
    n = 0
    for m, per in golden.items():
        if m in SKIP_NUMERIC or m.lstrip("Z") in SKIP_NUMERIC:
            continue
        if only and m not in only:
            continue
        for q, v in per.items():
            g = got.get(m, {}).get(q)
            n += 1
            if g is None:
                bad.append((m, q, v, None))
                continue
            if isinstance(v, float) and math.isnan(v):
                if not (isinstance(g, float) and math.isnan(g)):
                    bad.append((m, q, v, g))
                continue
            if abs(round(g, 4) - v) > 0.00011:
                bad.append((m, q, v, g))
    return n, bad


@pytest.fixture(scope="module")
def base(spark):
    run = read_run(spark, fixture("results.test"))
    qrels = read_qrels(spark, fixture("qrels.test"))
    return run, qrels


def test_official(spark, base):
    run, qrels = base
    got = _collect(evaluate(run, qrels, "official"))
    n, bad = _compare(got, read_golden("out.test"))
    assert n > 25 and not bad, bad[:10]


def test_all_trec_per_topic(spark, base):
    run, qrels = base
    got = _collect(evaluate(run, qrels, "all_trec"))
    n, bad = _compare(got, read_golden("out.test.aq"))
    assert n > 300 and not bad, bad[:20]


def test_relstring(spark, base):
    run, qrels = base
    got = {(r["qid"]): r["value"] for r in evaluate_text(run, qrels, ["relstring"]).collect()}
    gold = read_golden("out.test.aq")["relstring"]
    for q, v in gold.items():
        assert "'" + got[q] + "'" == v


def test_complete_truncated(spark):
    run = read_run(spark, fixture("results.trunc"))
    qrels = read_qrels(spark, fixture("qrels.test"))
    got = _collect(evaluate(run, qrels, "all_trec", complete=True))
    n, bad = _compare(got, read_golden("out.test.aqc"))
    assert n > 200 and not bad, bad[:20]


def test_complete_max_docs(spark):
    run = read_run(spark, fixture("results.trunc"))
    qrels = read_qrels(spark, fixture("qrels.test"))
    got = _collect(evaluate(run, qrels, "all_trec", complete=True, max_docs=100))
    n, bad = _compare(got, read_golden("out.test.aqcM"))
    assert n > 200 and not bad, bad[:20]


def test_level_2(spark):
    run = read_run(spark, fixture("results.test"))
    qrels = read_qrels(spark, fixture("qrels.rel_level"))
    got = _collect(evaluate(run, qrels, ["all_trec", "relstring.20"], relevance_level=2))
    n, bad = _compare(got, read_golden("out.test.aql"))
    assert n > 300 and not bad, bad[:20]
    rs = {r["qid"]: r["value"] for r in evaluate_text(run, qrels, ["relstring.20"]).collect()}
    for q, v in read_golden("out.test.aql")["relstring_20"].items():
        assert "'" + rs[q] + "'" == v


def test_meas_params(spark, base):
    run, qrels = base
    req = [
        "iprec_at_recall..10,.20,.25,.75,.50",
        "P.5,7,3",
        "recall.20,2000",
        "Rprec_mult.5.0,0.2,0.35",
        "utility.2,-1,0,0",
        "11pt_avg..25,.5,.75",
        "ndcg.1=3,2=9,4=4.5",
        "ndcg_cut.10,20,23.4",
        "success.2,5,20",
    ]
    got = _collect(evaluate(run, qrels, req))
    n, bad = _compare(got, read_golden("out.test.meas_params"))
    assert n > 80 and not bad, bad[:20]


def test_zscores(spark, base):
    run, qrels = base
    z = read_zref(spark, fixture("zscores_file"))
    got = _collect(evaluate(run, qrels, "all_trec", zref=z))
    n, bad = _compare(got, read_golden("out.test.aqZ"))
    assert n > 300 and not bad, bad[:20]


def test_qrels_jg(spark):
    from ranklens.plans.evaluate import evaluate_jg
    from ranklens.sources import read_qrels_jg

    run = read_run(spark, fixture("results.test"))
    q = read_qrels_jg(spark, fixture("qrels.123"))
    got = _collect(evaluate_jg(run, q, "qrels_jg"))
    gold = read_golden("out.test.qrels_jg")
    gold.pop("num_q", None)
    n, bad = _compare(got, gold)
    assert n > 70 and not bad, bad[:20]


def test_split_hot_topics_same_results(spark, base):
    """Ranking hot topics in score buckets gives exactly the same measures."""
    run, qrels = base
    want = _collect(evaluate(run, qrels, "all_trec"))
    got = _collect(evaluate(run, qrels, "all_trec", split_rows=50))
    for m, per in want.items():
        for q, v in per.items():
            assert abs(got[m][q] - v) < 1e-9, (m, q)
    jo = _collect(evaluate(run, qrels, ["map", "bpref", "ndcg"], judged_only=True, split_rows=50))
    jw = _collect(evaluate(run, qrels, ["map", "bpref", "ndcg"], judged_only=True))
    assert jo == jw


def test_split_ranked_rows_identical(spark):
    from ranklens.operators.ranked import build_ranked

    run = read_run(spark, fixture("results.test"))
    qrels = read_qrels(spark, fixture("qrels.rel_level"))
    cols = ["run_id", "qid", "docno", "rank", "rel"]
    a = sorted(tuple(r) for r in build_ranked(run, qrels).select(*cols).collect())
    b = sorted(tuple(r) for r in build_ranked(run, qrels, split_rows=40).select(*cols).collect())
    assert a == b


def test_split_judgment_groups(spark):
    from ranklens.plans.evaluate import evaluate_jg
    from ranklens.sources import read_qrels_jg

    run = read_run(spark, fixture("results.test"))
    q = read_qrels_jg(spark, fixture("qrels.123"))
    got = _collect(evaluate_jg(run, q, "qrels_jg", split_rows=60))
    gold = read_golden("out.test.qrels_jg")
    gold.pop("num_q", None)
    n, bad = _compare(got, gold)
    assert n > 70 and not bad, bad[:20]
