"""Lists by judgment group against the rows counted one by one: repeats, nulls, ranges and cuts; and how often a list moves."""

import random
from collections import Counter, defaultdict

import pytest

from ranklens.operators import ranked as RK
from ranklens.plans.evaluate import evaluate_jg

RUN = "run_id string, qid string, docno string, sim float"
QRELS = "qid string, jg string, docno string, rel int"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    run = [(run_id, q, f"d{d}", r.choice([None, *map(float, range(5))])) for run_id in "ab" for q in ("1", "2", "3", "4", None) for d in range(r.randint(1, 30))]
    run += [("a", "1", None, 2.0)]
    qrels = [(q, jg, f"d{d}", r.choice([-1, 0, 1, 2])) for q, groups in (("1", "xyz"), ("2", "x"), ("3", "yz"), (None, "x"), ("9", "x")) for jg in groups for d in range(30) if r.random() < 0.5]
    qrels += [("1", "x", "d1", None), ("2", None, "d1", 1), ("3", None, "d2", 1), ("1", "x", None, 1)]
    # documents that a group judges twice are equal, so their order says nothing
    return run, qrels + [x for x in qrels if x[0] == "3"][:2]


def ranks(run, qrels, cut, judged_only):
    """(run_id, qid, jg, docno, rank, rel), row by row."""
    rels, groups, lists, out = defaultdict(list), defaultdict(set), defaultdict(list), []
    for q, jg, d, rel in qrels:
        rels[q, jg, d].append(rel)
        groups[q].add(jg)
    for run_id, q, d, s in run:
        if q is not None:
            lists[run_id, q].append((s is not None, s or 0.0, d is not None, d or "", d))
    for (run_id, q), docs in lists.items():
        for jg in groups[q]:
            at = 0
            for n, (*_, d) in enumerate(sorted(docs, key=lambda x: x[:4], reverse=True)[:cut], 1):
                for rel in (rels.get((q, jg, d)) or [None]) if jg is not None and d is not None else [None]:
                    rel = -1 if rel is None else -2 if rel < 0 else rel
                    if judged_only and rel < 0:
                        continue
                    at += 1
                    out.append((run_id, q, jg, d, at if judged_only else n, rel))
    return out


@pytest.mark.parametrize("split", [None, 7])
@pytest.mark.parametrize("cut", [None, 9])
@pytest.mark.parametrize("judged_only", [False, True])
def test_every_group_has_the_list(spark, rows, split, cut, judged_only):
    run, qrels = spark.createDataFrame(rows[0], RUN), spark.createDataFrame(rows[1], QRELS)
    want = ranks(*rows, cut, judged_only)
    found = RK.build_ranked_jg(run, qrels, cut, judged_only, split)
    assert Counter(map(tuple, found.select("run_id", "qid", "jg", "docno", "rank", "rel").collect())) == Counter(want) and len(want) > 20

    mean, lists = defaultdict(list), defaultdict(list)
    for run_id, q, jg, _, n, rel in want:
        if jg is not None:
            lists[run_id, q, jg].append((n, rel >= 1))
    for (run_id, q, jg), docs in lists.items():
        all_rel = sum(rel is not None and rel >= 1 for q_, jg_, _, rel in rows[1] if (q_, jg_) == (q, jg))
        hits = [n for n, hit in sorted(docs) if hit]
        mean[run_id, q].append(sum(k / n for k, n in enumerate(hits, 1)) / all_rel if all_rel else 0.0)
    scores = evaluate_jg(run, qrels, ["map_avgjg"], max_docs=cut, judged_only=judged_only, split_rows=split).where("measure = 'map_avgjg' and qid <> 'all'")
    assert {(r.run_id, r.qid): r.value for r in scores.collect()} == {k: pytest.approx(sum(v) / len(v)) for k, v in mean.items()}


def test_a_list_moves_once_for_all_groups(spark, rows):
    run, qrels = spark.createDataFrame(rows[0], RUN), spark.createDataFrame(rows[1], QRELS)
    plan = RK.build_ranked_jg(run, qrels, split_rows=7)._jdf.queryExecution().optimizedPlan().toString()
    # the copies are made above every join, and ranks know nothing of groups
    copies = plan.index("Generate explode")
    assert "Join" not in plan[:copies]
    assert "jg" not in next(x for x in plan.splitlines() if "Window [row_number" in x)


def test_lines_move_as_numbers(spark, tmp_path):
    """The names of a run and of its judgments are made after the lines were dealt by them, and null parts are left out as before."""
    from ranklens.sources import tables as T

    li = [(1, 2, 3, 9.0, 0.1, 0.0, "N", "F"), (1, 2, 3, 8.0, 0.01, 0.01, "R", "O"), (None, 5, 6, 7.0, 0.06, 0.02, "R", "F"), (1, None, 3, None, None, 0.02, "R", "F"), (1, 3, None, 5.0, 0.09, 0.02, "A", "F"), (1, 4, 4, 5.0, 0.09, 0.02, "N", "O")]
    spark.createDataFrame(li, "l_suppkey long, l_orderkey long, l_linenumber int, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string").write.parquet(str(tmp_path / "lineitem.parquet"))
    run, qrels = T.deep_run(spark, str(tmp_path)), T.deep_qrels(spark, str(tmp_path))
    for df in (run, qrels):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1 and "concat_ws" not in plan.split("Exchange ", 1)[1].split("\n", 1)[1]
    assert Counter(map(tuple, run.collect())) == Counter([("deep", "1", "2-3", 9.0), ("deep", None, "5-6", 7.0), ("deep", "1", "3", 5.0), ("deep", "1", "4-4", 5.0)])
    assert Counter(map(tuple, qrels.collect())) == Counter([("1", "2-3", 0), (None, "5-6", 1), ("1", "3", 2)])
