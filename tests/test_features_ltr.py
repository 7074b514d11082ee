"""Fusion features, labels and linear models on the worked example."""

import pytest

from ranklens.operators import features as FE
from ranklens.operators import ltr as LT
from ranklens.sources import parse_ltr

# worked example: four rankings of one query; D2, D3, D5 relevant
RANKINGS = {
    "R1": ["D1", "D2", "D3", "D4", "D5", "D6"],
    "R2": ["D2", "D5", "D6", "D7", "D8", "D9", "D10", "D11"],
    "R3": ["D1", "D2", "D5"],
    "R4": ["D1", "D2", "D8", "D10", "D12"],
}
RELEVANT = {"D2", "D3", "D5"}


def expected_lines():
    """The feature rows by their definition: a document's reciprocal rank in each ranking, 0 where it isn't ranked."""
    for doc in sorted({d for docs in RANKINGS.values() for d in docs}):
        ranks = [docs.index(doc) + 1 if doc in docs else None for docs in RANKINGS.values()]
        values = " ".join(f"{i}:{1 / r if r else 0}" for i, r in enumerate(ranks, 1))
        yield f"{int(doc in RELEVANT)} qid:1 {values} # {doc}"


@pytest.fixture(scope="module")
def example(spark):
    rows = [("1", d, m, 0.0, i + 1) for m, docs in RANKINGS.items() for i, d in enumerate(docs)]
    hits = spark.createDataFrame(rows, "qid string, docno string, method string, score double, rank long")
    qrels = spark.createDataFrame([("1", d, 1) for d in RELEVANT], "qid string, docno string, rel int")
    return hits, qrels


def test_worked_example_rows(spark, example):
    hits, qrels = example
    ds = FE.ltr_dataset(hits, qrels, methods=tuple(RANKINGS))
    got = {r["docno"]: r for r in ds.collect()}
    exp = parse_ltr(spark.createDataFrame([(x,) for x in expected_lines()], "value string")).collect()
    assert len(got) == 12
    for e in exp:
        g = got[e["comment"]]
        assert g["label"] == e["label"]
        for i in range(1, 5):
            assert abs(g[f"f{i}"] - e["features"][i]) < 1e-6, (e["comment"], i)


def test_union_candidates(spark, example):
    hits, _ = example
    assert FE.union_candidates(hits).count() == 12


def test_linear_rerank_and_map(spark, example):
    hits, qrels = example
    ds = FE.ltr_dataset(hits, qrels, methods=tuple(RANKINGS))
    r = LT.linear_rerank(ds, [1.0, 0.0, 0.0, 0.0]).orderBy("rank").collect()
    assert [x["docno"] for x in r[:3]] == ["D1", "D2", "D3"]
    m = LT.mean_average_precision(ds, [1.0, 0.0, 0.0, 0.0]).collect()[0]["map"]
    # R1 order: D1 D2 D3 D4 D5 ... relevant at 2, 3, 5 -> (1/2 + 2/3 + 3/5) / 3
    assert abs(m - (0.5 + 2 / 3 + 0.6) / 3) < 1e-9


def test_weight_search_improves(spark, example):
    hits, qrels = example
    ds = FE.ltr_dataset(hits, qrels, methods=tuple(RANKINGS)).cache()
    start = LT.mean_average_precision(ds, [0.25] * 4).collect()[0]["map"]
    w, m = LT.weight_search(ds, restarts=2)
    assert m >= start - 1e-12
    assert abs(sum(abs(x) for x in w) - 1.0) < 1e-9
    again = LT.mean_average_precision(ds, w).collect()[0]["map"]
    assert abs(again - m) < 1e-9


def test_kfold_split_is_stable(spark, example):
    hits, qrels = example
    ds = FE.ltr_dataset(hits, qrels, methods=tuple(RANKINGS))
    folds = {r["fold"] for r in LT.kfold_split(ds).collect()}
    assert len(folds) == 1 and folds <= set(range(5))


def test_equal_sums_tie_in_any_order_of_their_terms(spark):
    from itertools import permutations

    from ranklens.operators import ltr

    values = (0.1, 0.3, 0.7, 1 / 3, 1 / 9)
    rows = [("q", f"d{i:03d}", 0, *p) for i, p in enumerate(permutations(values))]
    df = spark.createDataFrame(rows, "qid string, docno string, label int, f1 double, f2 double, f3 double, f4 double, f5 double")
    for weights in ([0.2] * 5, [-0.1] * 5, [1e6] * 5):
        got = ltr.linear_rerank(df, weights).orderBy("rank").collect()
        assert [r.docno for r in got] == [r[1] for r in rows]  # one score: the documents' own order
        assert len({r.score for r in got}) == 1 and abs(got[0].score - weights[0] * sum(values)) < 1e-9 * abs(weights[0])
