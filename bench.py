"""Benchmark the headline queries.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints one JSON line.  Every query is executed in
full through the ``noop`` sink (no collect to the driver); the session is warm
(one untimed pass of a small query) so JVM start-up is not charged to a query.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from pyspark.sql import functions as F  # noqa: E402

from ranklens.session import get_spark  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ.setdefault("RANKLENS_MASTER", f"local[{cpus}]")
    spark = get_spark(shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * int(cpus)))))

    from checks import registry as R
    from ranklens.plans.evaluate import evaluate, evaluate_jg, evaluate_prefs
    from ranklens.operators import articles as AR
    from ranklens.operators import index as IX
    from ranklens.sources import tables as T

    def q_eval_all_trec():
        return evaluate(T.deep_run(spark, sf_dir), T.deep_qrels(spark, sf_dir), "all_trec")

    def q_eval_two_runs_official():
        runs = T.deep_run(spark, sf_dir).unionByName(T.tied_run(spark, sf_dir))
        return evaluate(runs, T.deep_qrels(spark, sf_dir), "official")

    def q_eval_qrels_jg():
        return evaluate_jg(T.deep_run(spark, sf_dir), T.deep_qrels_jg(spark, sf_dir), "qrels_jg")

    def q_prefs_qrels():
        return evaluate_prefs(T.deep_run(spark, sf_dir), T.qrels_prefs(spark, sf_dir), "all_prefs")

    def q_prefs_multi():
        return evaluate_prefs(T.prefs_run(spark, sf_dir), T.multi_prefs(spark, sf_dir), "all_prefs")

    def q_postings():
        return IX.postings(T.corpus(spark, sf_dir))

    def q_score_five():
        return R._hits(spark, sf_dir)

    def q_ltr_dataset():
        return R._ltr(spark, sf_dir)

    def q_article_plain_text():
        return AR.article_plain_text(T.article_nodes(spark, sf_dir), T.article_pages(spark, sf_dir), T.article_paragraphs(spark, sf_dir))

    queries = {
        "eval_all_trec": q_eval_all_trec,
        "eval_two_runs_official": q_eval_two_runs_official,
        "eval_qrels_jg": q_eval_qrels_jg,
        "prefs_qrels": q_prefs_qrels,
        "prefs_multi": q_prefs_multi,
        "postings": q_postings,
        "score_five": q_score_five,
        "ltr_dataset": q_ltr_dataset,
        "article_plain_text": q_article_plain_text,
    }
    only = [a for a in sys.argv[1:] if a in queries]
    if only:
        queries = {k: queries[k] for k in only}

    # warm-up: JVM, parquet readers, codegen caches
    spark.read.parquet(f"{sf_dir}/region.parquet").select(F.count(F.lit(1))).collect()

    times = {}
    for name, fn in queries.items():
        t0 = time.time()
        fn().write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
