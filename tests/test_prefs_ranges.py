"""Preference counts in ranges against all pairs: many levels, ties, hot topics, several runs and groups."""

import random
import time

import numpy as np
import pytest

from ranklens.operators import prefs as PR

RUN = "run_id string, qid string, docno string, sim float"
PREFS = "qid string, jg string, jsg string, docno string, rel_level double"


def test_larger_before_equals_pairs():
    r = np.random.default_rng(2)
    for _ in range(30):
        segment = np.sort(r.integers(0, 4, 60))
        level = r.integers(0, r.integers(1, 40), 60).astype(float)
        want = [sum(segment[j] == segment[i] and level[j] > level[i] for j in range(i)) for i in range(60)]
        assert PR._larger_before(segment, level).tolist() == want


def plain(run, prefs):
    """{(run, topic, group): counts} by all pairs, groups of one sub-group."""
    out = {}
    for key in {(x[0], x[1]) for x in run}:
        order = [d for _, d in sorted((-s, d) for r, q, d, s in run if (r, q) == key)]
        at = {d: i for i, d in enumerate(order)}
        for jg in {p[1] for p in prefs if p[0] == key[1]}:
            lvl = {p[3]: p[4] for p in prefs if p[:2] == (key[1], jg)}
            c = dict.fromkeys(["poss_ret", "ful_ret", "poss_imp", "ful_imp", "poss_notoccur"], 0)
            for x in lvl:
                for y in lvl:
                    if lvl[x] > lvl[y]:
                        if x in at and y in at:
                            c["poss_ret"] += 1
                            c["ful_ret"] += at[x] < at[y]
                        elif x in at or y in at:
                            c["poss_imp"] += 1
                            c["ful_imp"] += x in at
                        else:
                            c["poss_notoccur"] += 1
            n = lambda f: sum(map(f, lvl))
            c |= {"num_rel": n(lambda d: lvl[d] > 0), "num_nonrel": n(lambda d: lvl[d] == 0), "num_rel_ret": n(lambda d: lvl[d] > 0 and d in at), "num_nonrel_ret": n(lambda d: lvl[d] == 0 and d in at)}
            out[*key, jg] = c
    return out


@pytest.mark.parametrize("rows", [None, 5, 23])
def test_counts_equal_all_pairs(spark, rows):
    r = random.Random(4)
    run, prefs = [], []
    for q in range(8):
        n = 150 if q == 2 else r.randint(1, 12)
        for d in range(n):
            for run_id in "ab":
                if r.random() < 0.7:
                    run.append((run_id, str(q), f"d{d:03d}", float(r.randrange(20))))
            for jg in "01":
                if r.random() < 0.8:
                    levels = n if jg == "1" else 3
                    prefs.append((str(q), jg, "s", f"d{d:03d}", float(r.randrange(levels))))
    a, p = spark.createDataFrame(run, RUN).repartition(3), spark.createDataFrame(prefs, PREFS)
    got = {(x.run_id, x.qid, x.jg): x.asDict() for x in PR.pref_counts(a, p, split_rows=rows).collect()}
    want = plain(run, prefs)
    assert got.keys() == want.keys()
    for k, c in want.items():
        assert {x: got[k][x] for x in c} == c, k


def test_a_group_of_very_many_levels(spark):
    n = 100_000
    r = random.Random(7)
    level = list(range(n))
    r.shuffle(level)
    run = spark.createDataFrame([("a", "q", f"d{i:06d}", float(-i)) for i in range(n)], RUN)
    prefs = spark.createDataFrame([("q", "0", "s", f"d{i:06d}", float(x)) for i, x in enumerate(level)], PREFS)
    began = time.time()
    row = PR.pref_counts(run, prefs).first()
    assert time.time() - began < 120
    assert row.poss_ret == n * (n - 1) // 2
    assert row.ful_ret == int(PR._larger_before(np.zeros(n, int), np.array(level, float)).sum())
