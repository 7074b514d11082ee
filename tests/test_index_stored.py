"""The stored index against the corpus: round trip, statistics, every scorer, and blocks that are skipped."""

import random

import pytest

from ranklens.operators import index as IX
from ranklens.operators import scoring as SC


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    r = random.Random(6)
    words = [f"w{i}" for i in range(40)]
    rows = [(f"d{i:04d}", " ".join(["common"] * r.choice([1, 1, 1, 2, 30]) + [r.choice(words[: r.randint(1, 40)]) for _ in range(r.randint(1, 30))])) for i in range(600)]
    rows += [("empty", ""), ("blank", " . "), ("null", None)]
    corpus = spark.createDataFrame(rows, "docno string, text string").repartition(3)
    topics = spark.createDataFrame([("q1", "common w1 w2 w2"), ("q2", "w3 nowhere w30"), ("q3", "common"), ("q4", "")], "qid string, query string")
    path = str(tmp_path_factory.mktemp("index"))
    IX.write_index(corpus, path, buckets=5, block=8, salt_postings=150)
    return corpus, topics, IX.read_index(spark, path, buckets=5)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_round_trip_and_statistics(made):
    corpus, topics, index = made
    post = IX.postings(corpus)
    assert rows(index.postings()) == rows(post)
    assert rows(index.doc_stats()) == rows(IX.doc_stats(corpus))
    assert rows(index.term_stats()) == rows(IX.term_stats(post))
    assert rows(index.collection_stats()) == rows(IX.collection_stats(IX.doc_stats(corpus)))
    terms = IX.query_terms(topics)
    assert rows(index.postings(terms)) == rows(post.join(terms.select("term").distinct(), "term", "left_semi"))


@pytest.mark.parametrize("method", [*SC.METHODS, "raw_tf", "bm25"])
def test_scores_equal_those_of_the_corpus(made, method):
    corpus, topics, index = made
    want = rows(SC.score(method, topics, post=IX.postings(corpus), stats=IX.doc_stats(corpus)))
    assert len(want) > 20
    # equal to the last bit, in whatever order the terms were summed
    assert rows(SC.score(method, topics, corpus.repartition(7))) == want
    assert rows(SC.score(method, topics, index=index)) == want


def test_blocks_are_skipped(made):
    corpus, topics, index = made
    heads = index.heads(IX.query_terms(topics)).where("term = 'common'")
    kept = index.top_blocks(IX.query_terms(topics), "rate", 5).where("term = 'common'")
    assert heads.select("salt").distinct().count() > 3  # a frequent term is salted
    total = heads.count()
    # 'common' is in every document that has a word, but the empty documents have none
    assert total > 60 and kept.count() < total / 2
    # more than a block holds: no block proves a bound alone, so all are kept
    assert index.top_blocks(IX.query_terms(topics), "rate", 9).where("term = 'common'").count() == total
    for impact in IX.IMPACTS:
        best = index.top_postings(IX.query_terms(topics), impact, 5)
        whole = index.postings(IX.query_terms(topics))
        for df in (best, whole):
            assert df.where("term = 'w1'").count() >= 5
        value = IX.IMPACTS[impact]
        from pyspark.sql import functions as F

        def top(df):
            p = df.withColumn("s", value(F.struct(*IX._POSTING))).withColumn("qid", F.lit("q"))
            return rows(SC.term_topk(p, 5))

        assert top(best) == top(whole)


def test_empty_corpus(spark, tmp_path):
    IX.write_index(spark.createDataFrame([], "docno string, text string"), str(tmp_path / "i"), buckets=2)
    topics = spark.createDataFrame([("q", "a")], "qid string, query string")
    assert SC.score("bm25", topics, spark.createDataFrame([], "docno string, text string")).collect() == []


def test_postings_move_once_to_their_files(spark):
    post = spark.createDataFrame([("w", "d", 1, 1, 1, 1)], "term string, docno string, tf long, dlen long, ulen long, uvoc long")
    plan = IX.index_blocks(post, 4)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert plan.count("hashpartitioning(bucket") == 1 and "hashpartitioning(term#" not in plan.split("BroadcastExchange")[0]


def _left(spark):
    """Shuffle files of this session on disk now."""
    import os

    tops = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return {f for top in tops for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def test_postings_are_counted_inside_rows_and_documents_given_twice_are_added_up(spark, tmp_path):
    r = random.Random(2)
    words = [f"w{i}" for i in range(30)] + ["the"]
    rows_ = [(f"d{i % 40}" if i % 17 else None, " ".join(r.choice(words) for _ in range(r.randint(0, 60)))) for i in range(90)]
    rows_ += [("d1", None), ("long", "w1 " * 3000 + "w2"), ("long", "w1")]
    corpus = spark.createDataFrame(rows_, "docno string, text string").repartition(3)
    each = IX.row_postings(corpus)
    plan = each._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan
    whole = IX.all_postings(corpus)
    from pyspark.sql import functions as F

    assert rows(each.groupBy("term", "docno").agg(F.sum("tf").alias("tf"), *(F.max(c).alias(c) for c in ("dlen", "ulen", "uvoc")))) == rows(whole)
    for rounds in (1, 2, 7):
        path = str(tmp_path / f"i{rounds}")
        IX.write_index(corpus, path, buckets=3, block=8, salt_postings=20, rounds=rounds)
        index = IX.read_index(spark, path, buckets=3)
        assert rows(index.postings()) == rows(whole.where("term <> ''"))
        assert rows(index.term_stats()) == rows(IX.term_stats(whole.where("term <> ''")))
        # a document's list of itself holds it once, however often it was given
        assert rows(index.doc_stats()) == rows(whole.where("term = ''").select("docno", "dlen", "ulen", "uvoc"))


def test_shuffle_files_go_when_an_index_is_written(spark, tmp_path):
    import time

    corpus = spark.createDataFrame([(f"d{i}", f"a{i} b c") for i in range(50)], "docno string, text string").repartition(3)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
    before = _left(spark)
    IX.write_index(corpus, str(tmp_path / "i"), buckets=2)
    for _ in range(50):
        left = _left(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
