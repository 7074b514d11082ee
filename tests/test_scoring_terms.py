"""Scores of a hand-worked corpus: repeated query words count again; Laplace lists are cut before the division."""

from math import isclose

from pyspark.sql import functions as F

from ranklens.operators import scoring

# lengths 4, 8 and 12; collection: 24 words, alpha 1 + 2 + 3, beta 1
CORPUS = [
    ("d1", "alpha beta gamma delta"),
    ("d2", "alpha alpha gamma delta kappa sigma omega theta"),
    ("d3", "alpha alpha alpha gamma gamma gamma delta delta delta kappa kappa kappa"),
]


def _scores(spark, method, query, **more):
    topics = spark.createDataFrame([("q", query)], "qid string, query string")
    corpus = spark.createDataFrame(CORPUS, "docno string, text string")
    return {r.docno: r.score for r in scoring.score(method, topics, corpus, **more).collect()}


def _same(got, want):
    assert got.keys() == want.keys()
    assert all(isclose(got[d], want[d], rel_tol=1e-9) for d in want), (got, want)


def test_repeated_words_count_once_per_occurrence(spark):
    q = "alpha alpha beta"
    _same(_scores(spark, "bnn_bnn", q), {"d1": 3.0, "d2": 2.0, "d3": 2.0})
    _same(_scores(spark, "raw_tf", q), {"d1": 3.0, "d2": 4.0, "d3": 6.0})
    # 0.9 tf/|d| + 0.1 ctf/|C|, a factor per occurrence
    a, b = [0.9 * tf / n + 0.1 * 6 / 24 for tf, n in ((1, 4), (2, 8), (3, 12))], 0.9 / 4 + 0.1 / 24
    _same(_scores(spark, "lm_jm", q), {"d1": a[0] ** 2 * b, "d2": a[1] ** 2, "d3": a[2] ** 2})
    # (tf + 1000) / (ctf + 1000)
    d = {"d1": 2 * 1001 / 1006 + 1001 / 1001, "d2": 2 * 1002 / 1006, "d3": 2 * 1003 / 1006}
    _same(_scores(spark, "lm_dirichlet", q), d)


def test_laplace_list_is_cut_by_frequency_and_dirichlet_has_no_list(spark):
    # lengths and vocabularies 4 4, 8 7, 12 4: divided scores are 1.25/8 = 0.156, 2.125/15 = 0.142, 3.083/16 = 0.193
    _same(_scores(spark, "lm_laplace", "alpha", n=2), {"d2": (2 + 1 / 8) / 15, "d3": (3 + 1 / 12) / 16})
    assert len(_scores(spark, "lm_dirichlet", "alpha", n=2)) == 3


def test_all_methods_in_one_plan_agree_with_each_alone(spark):
    topics = spark.createDataFrame([("q", "alpha alpha beta")], "qid string, query string")
    corpus = spark.createDataFrame(CORPUS, "docno string, text string")
    got = {(r.method, r.docno): r.score for r in scoring.score_many(topics, corpus, n=2).collect()}
    want = {(m, d): s for m in scoring.METHODS for d, s in _scores(spark, m, "alpha alpha beta", n=2).items()}
    _same(got, want)


def test_background_mass_of_unmatched_terms(spark):
    from math import log10

    docs = {d: t.split() for d, t in CORPUS}
    words = [w for t in docs.values() for w in t]
    query = "alpha alpha beta sigma unknownword"
    for method, mass in (
        ("lm_jm", lambda t, d: 0.9 * d.count(t) / len(d) + (1 - 0.9) * words.count(t) / len(words)),
        ("lm_dirichlet", lambda t, d: (d.count(t) + 1000 * words.count(t) / len(words)) / (len(d) + 1000)),
    ):
        want = {n: sum(log10(mass(t, d)) for t in query.split() if t in words) for n, d in docs.items()}
        _same(_scores(spark, method, query, background=True), want)
        # d3 lacks two of the terms, a document without any is no candidate
        assert _scores(spark, method, "beta", background=True).keys() == {"d1"}
        assert _scores(spark, method, "unknownword", background=True) == {}


def test_only_smoothed_models_have_a_background(spark):
    import pytest

    for method in ("raw_tf", "bm25", "lm_laplace"):
        with pytest.raises(ValueError):
            _scores(spark, method, "alpha", background=True)
    with pytest.raises(ValueError):
        _scores(spark, "lm_jm", "alpha", background=True, per_term_top=True)


def test_lists_of_terms_are_cut_once_for_all_queries(spark):
    # more documents than groups of the bound, equal keys everywhere, null and empty names
    rows = [(f"t{t}", d, 1 + (i * 7 + t) % 3, 5 + i % 4, 5, 4) for t in range(3) for i, d in enumerate([None, "", *(f"{i % 50}-{i}" for i in range(300)), "é1", "日本"])]
    post = spark.createDataFrame(rows, "term string, docno string, tf long, dlen long, ulen long, uvoc long").repartition(5)
    keys = {"bnn_bnn": F.lit(1.0), "lnc_ltn": F.log10(F.col("tf").cast("double")), "lm_jm": F.col("tf") / F.col("dlen")}
    got = {}
    for r in scoring._top_of_terms(post, keys, 4).collect():
        got.setdefault((r.method, r.term), set()).add(r.docno)
    plain = {"bnn_bnn": lambda r: 1.0, "lnc_ltn": lambda r: r[2], "lm_jm": lambda r: r[2] / r[3]}
    for m, key in plain.items():
        for t in ("t0", "t1", "t2"):
            mine = sorted((r for r in rows if r[0] == t), key=lambda r: (-key(r), r[1] is not None, (r[1] or "").encode()))
            assert got[m, t] == {r[1] for r in mine[:4]}, (m, t)


def test_only_lists_with_a_norm_are_brought_together(spark):
    """Documents without a term list are cut to the best of each task before they move to their query."""
    topics = spark.createDataFrame([("q", "alpha alpha beta"), ("r", "kappa gamma"), ("s", "nothing")], "qid string, query string")
    corpus = spark.createDataFrame(CORPUS, "docno string, text string")
    both = scoring.score_many(topics, corpus, ("lnc_ltn", "lm_dirichlet"), k=2)
    plan = both._jdf.queryExecution().executedPlan().toString()
    moved = plan.split("WindowGroupLimit", 2)[2]
    assert "Partial" in moved.split("\n")[0] and "lm_dirichlet" in moved, plan
    norm, every = moved.split("Union", 1)[1].split("Window [", 1)
    assert "lm_dirichlet" not in norm + every.split("lm_dirichlet")[0] and "Window [" not in every.split("lm_dirichlet", 1)[1], plan
    got = {(r.method, r.qid, r.docno): (r.score, r["rank"]) for r in both.collect()}
    want = {(m, r.qid, r.docno): (r.score, r["rank"]) for m in ("lnc_ltn", "lm_dirichlet") for r in scoring.score(m, topics, corpus, k=2).collect()}
    assert got == want and want
