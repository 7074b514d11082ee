"""Report lines in the evaluation tool's printed layout."""

from conftest import fixture
from ranklens.plans.evaluate import evaluate, evaluate_text
from ranklens.sources import read_qrels, read_run
from ranklens.sources.sinks import report_lines, run_lines, write_report, write_run


def test_report_lines_match_recorded_summary(spark):
    run = read_run(spark, fixture("results.test"))
    qrels = read_qrels(spark, fixture("qrels.test"))
    scores = evaluate(run, qrels, "official", per_topic=False)
    text = evaluate_text(run, qrels, ["runid"])
    got = {r["value"] for r in report_lines(scores, text).collect()}
    with open(fixture("out.test")) as fh:
        want = {line.rstrip("\n") for line in fh if line.strip()}
    assert want == got


def test_run_lines_layout(spark):
    hits = spark.createDataFrame([("q1", "d1", "bm25", 1.5, 1)], "qid string, docno string, method string, score double, rank long")
    assert run_lines(hits, team="t1").collect()[0]["value"] == "q1 Q0 d1 1 1.500000 t1-bm25"


def test_report_lines_match_recorded_per_topic(spark):
    run = read_run(spark, fixture("results.test"))
    qrels = read_qrels(spark, fixture("qrels.test"))
    scores = evaluate(run, qrels, "all_trec")
    text = evaluate_text(run, qrels, ["runid", "relstring"])
    got = {r["value"] for r in report_lines(scores, text).collect()}
    with open(fixture("out.test.aq")) as fh:
        want = {line.rstrip("\n") for line in fh if line.strip()}
    assert want - got == set(), sorted(want - got)[:5]
    assert got - want == set(), sorted(got - want)[:5]


def test_exact_scores_read_back_apart(spark, tmp_path):
    rows = [("q1", f"d{i}", "lm", -7.5 - i * 1e-6, i + 1) for i in range(4)] + [("q2", "d0", "lm", 1.25e-9, 1), ("q2", "d1", "lm", 1e-9, 2)]
    hits = spark.createDataFrame(rows, "qid string, docno string, method string, score double, rank long")
    write_run(hits, str(tmp_path / "run"), exact=True)
    back = read_run(spark, str(tmp_path / "run")).orderBy("qid", "sim", ascending=[True, False]).collect()
    assert [(r.qid, r.docno) for r in back] == [(r[0], r[1]) for r in rows]


def test_report_lines_are_in_order(spark, tmp_path):
    run = spark.createDataFrame([(q, d, s, "r") for q in ("2", "10") for d, s in (("a", 2.0), ("b", 1.0))], "qid string, docno string, sim double, run_id string")
    qrels = spark.createDataFrame([("2", "a", 1), ("10", "b", 1)], "qid string, docno string, rel int")
    scores = evaluate(run, qrels, ["P.5,10", "map", "num_rel"])
    write_report(scores.repartition(5), str(tmp_path / "report"), evaluate_text(run, qrels, ["runid"]))
    lines = [x.split("\t") for f in sorted((tmp_path / "report").glob("part-*")) for x in f.read_text().splitlines()]
    topic = ["num_rel", "map", "P_5", "P_10"]
    assert [(a.strip(), q) for a, q, _ in lines] == [(m, q) for q in ("10", "2") for m in topic] + [(m, "all") for m in ["runid", "num_q", *topic]]
