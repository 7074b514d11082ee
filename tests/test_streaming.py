"""Runs arriving as files are evaluated per micro-batch like a batch evaluation."""

import os
import tempfile

from conftest import fixture
from ranklens.plans.evaluate import evaluate
from ranklens.sources import read_qrels, read_run
from ranklens.streaming import evaluate_run_stream


def test_run_stream_matches_batch(spark):
    src = fixture("results.test")
    qrels = read_qrels(spark, fixture("qrels.test"))
    d = tempfile.mkdtemp(prefix="ranklens-stream-")
    runs = os.path.join(d, "runs")
    os.makedirs(runs)
    with open(src) as fh:
        text = fh.read()
    with open(os.path.join(runs, "a.txt"), "w") as fh:
        fh.write(text)
    with open(os.path.join(runs, "b.txt"), "w") as fh:
        fh.write(text.replace("STANDARD", "COPY"))
    out = os.path.join(d, "out")
    q = evaluate_run_stream(spark, runs, qrels, out, "official", checkpoint=os.path.join(d, "ck"))
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    assert got.select("epoch").distinct().count() == 2
    want = {(r["measure"], r["qid"]): r["value"] for r in evaluate(read_run(spark, src), qrels, "official").collect()}
    for r in got.where("run_id = 'COPY'").collect():
        assert abs(r["value"] - want[(r["measure"], r["qid"])]) < 1e-9
