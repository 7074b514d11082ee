"""op11 against a plain trie: nulls, ties, repeated rows, empty tables, common first turns and many copies."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ranklens.llm import prefixtrie, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(sequences):
    """{prefix: row} of {conv_id: [(role, text), ...]}."""
    members = defaultdict(list)
    for c, turns in sorted(sequences.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, held in members.items():
        own = (len(held) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own
            leaves[node[:d]] += not children[node]
    out = []
    for node, held in members.items():
        ends = ",".join(str(c) for c in held if len(sequences[c]) == len(node))
        out.append((held[0], len(node), members[node[:-1]][0] if node else None, len(held), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            k = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, k, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(8)
    said = [("user", f"text {i}" * r.randint(1, 4)) for i in range(6)] + [("assistant", "é"), (None, "x"), ("user", None), ("", "")]
    out = []
    for c in range(300):
        if c % 7 == 0:
            continue  # absent bases
        turns = [("user", "hello")] * (r.random() < 0.5) + [r.choice(said) for _ in range(r.choice([1, 2, 3, 12]))]
        if c > 150:  # copies of one conversation
            turns = [("user", "same"), ("assistant", "answer"), ("user", "thanks")] * 4
        out += [(c, i, *t) for i, t in enumerate(turns)]
    out += [(301, None, "user", "no turn"), (301, 0, "user", "a"), (302, 1, "user", "tie"), (302, 1, "assistant", "tie"), (303, 5, "u", "t"), (303, 5, "u", "t"), (None, 0, "user", "lost")]
    out += [(400, i, "user", f"turn {i}") for i in range(120)] + [(405, i, "user", f"turn {i}") for i in range(120)]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("parts", ["1", "2", "7", "40"])
def test_trie_equals_a_plain_one(spark, rows, parts, monkeypatch):
    monkeypatch.setattr(prefixtrie, "ENDS_PART", 3)
    monkeypatch.setattr(prefixtrie, "PATHS_GROUP", 5)
    queries.ready(spark)
    df = spark.createDataFrame([(*x, "k", 1) for x in rows], "conv_id long, turn long, role string, text string, id string, shard int").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = prefixtrie.sequences(prefixtrie.encoded_turns(df))
        conv = F.col("conv_id")
        got = prefixtrie.prefix_trie(prefixtrie.rebuilt(found, conv - conv % 5, F.crc32(conv.cast("string").cast("binary")) % 9, 8))
        assert got.columns == COLUMNS
        assert sorted(map(tuple, got.collect()), key=key) == sorted(plain_trie(rebuilt(rows)), key=key)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_tree_is_balanced_by_medians():
    tree = prefixtrie.TernaryTree()
    for k in prefixtrie._medians_first(1023):
        tree.insert([k], [1], [k])
    deepest, left = 0, [(tree.down[0], 1)]
    while left:
        at, d = left.pop()
        if at >= 0:
            deepest = max(deepest, d)
            left += [(tree.low[at], d + 1), (tree.high[at], d + 1)]
    assert deepest == 10
    assert [tree.key[at] for at in tree.preorder()[1:]] == list(range(1023))


def test_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    for given in ([], [(None, 1, "user", "x")]):
        df = spark.createDataFrame(given, schema)
        assert prefixtrie.prefix_trie(prefixtrie.sequences(prefixtrie.encoded_turns(df))).collect() == []


def test_registered_query_equals_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    fn, sql = queries.QUERIES["op11_prefix_trie"]
    got = fn(spark, sf)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({sql})").fetchall()
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
