"""Decontamination: windows against brute force, extra columns, long, empty and repeated rows."""

import random

import pytest

from ranklens.llm import decontaminate as d

WORDS = "the a of 12 7 km Paris Rome, river, (high) 3.5 costs how many does it have -- In MOUNTAIN été".split()


def _random_texts(seed, n, least, most):
    r = random.Random(seed)
    return [" ".join(r.choice(WORDS) for _ in range(r.randint(least, most))) for _ in range(n)]


def _windows(a, b, size):
    return [(i, j) for i in range(len(a) - size + 1) for j in range(len(b) - size + 1) if a[i : i + size] == b[j : j + size]]


@pytest.mark.parametrize("window,least", [(8, 5), (4, 4), (5, 2), (1, 1)])
def test_windows_equal_brute_force(spark, window, least):
    items = _random_texts(1, 12, 1, 14)
    texts = _random_texts(2, 20, 0, 20) + [f"so {items[0]} yes", f"{items[3].upper()}\n{items[4]}", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.id, r.item, r.pos, r.doc_pos, r.size, r.plain) for r in d.matches(docs, bench, window, least).collect()}

    def forms(df, key):
        return {r[0]: (r[1] or [], r[2] or []) for r in df.select(key, d.canonical_words(df.text), d.plain_words(df.text)).collect()}

    want = {}
    for item, (canonical, plain) in forms(bench, "item_id").items():
        if len(canonical) < least:
            continue
        size = min(len(canonical), window)
        for doc, (doc_canonical, doc_plain) in forms(docs, "doc_id").items():
            for own, other, kind in ((canonical, doc_canonical, False), (plain, doc_plain, True)):
                for pos, doc_pos in _windows(own, other, size):
                    key = (doc, item, pos, doc_pos, size)
                    want[key] = want.get(key, False) or kind
    assert got == {(*k, v) for k, v in want.items()}


def test_a_hit_carries_its_raw_words(spark):
    docs = spark.createDataFrame([(1, "Well: how many (12) apples -- does Tom, have now")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "how many 9 apples does Ann have")], "item_id long, text string")
    (hit,) = d.matches(docs, items).collect()
    assert (hit.doc_pos, hit.size, hit.doc_words) == (1, 7, ["how", "many", "(12)", "apples", "does", "Tom,", "have"])


def test_clean_keeps_every_column_as_it_is(spark):
    item = "how many apples does the old farmer have in his garden today"
    names = ["__id", "__th", "id", "th", "row", "own", "words", "bits", "key"]
    rows = [(1, item, *names), (2, "a clean text", *names), (2, "a clean text", *names), (None, None, *names), (3, "", *names), (4, "word " * 20000, *names), (5, "word " * 20000 + item, *names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in names))
    items = spark.createDataFrame([(1, item), (1, item), (None, None), (2, "")], "item_id long, text string")
    left = d.clean(docs, items)
    assert left.columns == docs.columns
    order = lambda rows: sorted(rows, key=str)
    assert order(map(tuple, left.collect())) == order(r for r in rows if r[0] not in (1, 5))
    assert d.clean(docs.where("false"), items).count() == 0
    assert d.clean(docs, items.where("false")).count() == len(rows)
