"""op13 against all pairs of words: nulls, repeated rows, long words, common words, empty tables, small filters."""

import random
import re
import zlib
from collections import Counter

import pytest

from ranklens.llm import queries, spelling


def edited(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    counts = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in n if edited(w, v)] for w in n}
    form = {}
    for w, held in near.items():
        best = min(held, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    letters = "abcéÿ×Z"
    words = ["".join(r.choice(letters) for _ in range(r.randint(3, 8))) for _ in range(120)] + ["aaaaa", "aaaaaa", "aaaaaaa", "b" * 300, "b" * 299 + "c", "b" * 301]
    for _ in range(300):
        w = r.choice(words)
        i = r.randrange(len(w))
        words.append(r.choice([w[:i] + w[i + 1 :], w[:i] + r.choice(letters) + w[i:], w[:i] + r.choice(letters) + w[i + 1 :]]))
    texts = [None, "", " 12 ", "chain " * 40 + "chais " * 20 + "chaos " * 10 + "choos " * 5]
    texts += [" ".join(r.choice(words) + r.choice(["", ".", "1", "_x", "日"]) for _ in range(60)) for _ in range(150)]
    out = list(enumerate(texts)) + [(None, "chain words " * 5)]
    return out + out[50:60]


@pytest.mark.parametrize("slab, filter_bytes", [(4096, 32_000_000), (2, 400)])
def test_variants_equal_all_pairs(spark, rows, slab, filter_bytes, monkeypatch):
    monkeypatch.setattr(spelling, "SLAB", slab)
    monkeypatch.setattr(spelling, "FILTER_BYTES", filter_bytes)
    queries.ready(spark)
    df = spark.createDataFrame([(d, t, "x", "y", 5) for d, t in rows], "doc_id long, text string, word string, near string, n int").repartition(3)
    got = spelling.variants(spelling.word_counts(df))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows), key=key)


def test_empty_table(spark):
    for given in ([], [(1, None), (2, "too few")]):
        assert spelling.variants(spelling.word_counts(spark.createDataFrame(given, "doc_id long, text string"))).collect() == []


def test_registered_query_equals_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    fn, sql = queries.QUERIES["op13_spelling_variants"]
    got = fn(spark, sf)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({sql})").fetchall()
    assert len(want) > 100
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
