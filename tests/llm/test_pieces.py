"""op12 against the sentencepiece library on whole texts."""

import hashlib
import random

import pytest

from ranklens.llm import pieces, queries

sentencepiece = pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())


def texts():
    r = random.Random(3)
    signs = ["a", "B", "the ", " of", "▁", " ", "  ", "\n", "\t", "\x00", "é", "日本", "\U0001f600", "<s>", "</s>", "<0x0A>", " ", "�", "é", "#", "12"]
    made = ["".join(r.choice(signs) for _ in range(r.randint(1, 40))) for _ in range(400)]
    long = " ".join(r.choice(signs) + str(r.randrange(99)) for _ in range(20_000))
    return [None, "", " ", "   ", "▁", "a", " a", "a ", "x" * 5000, long, *made, *made[:30]]


def test_ids_and_decoded_texts_equal_the_library(spark, library):
    rows = list(enumerate(texts())) + [(None, "null id"), (7, "again"), (7, "again")]
    queries.ready(spark)
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, ids string, n_tokens int").repartition(3)
    want = []
    for d, t in rows:
        ids = library.encode(t or "", add_eos=True)
        want.append((d, len(ids), ids, library.decode(ids)))
    key = lambda x: (x[0] is None, x[0] or 0, str(x))
    got = pieces.encode(df, queries.piece_model())
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    hexed = lambda s: hashlib.sha256(s.encode()).hexdigest()
    digests = [(d, n, hexed(" ".join(map(str, ids))), hexed(text)) for d, n, ids, text in want]
    assert sorted(map(tuple, pieces.encode(df, queries.piece_model(), digests=True).collect()), key=key) == sorted(digests, key=key)
    back = pieces.decode(got, queries.piece_model())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.decoded) for r in back.collect()) == sorted((d is None, d or 0, t) for d, _, _, t in want)


def test_blocks_of_any_size_give_the_same_ids(library):
    table = pieces.ChunkTable(queries.piece_model())
    for text in texts():
        ids = [i for x in table.segment(table.chunks(text or "")) for i in x]
        assert ids == library.encode(text or "")


def test_empty_table_and_null_ids(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.encode(none, queries.piece_model()).collect() == []
    ids = spark.createDataFrame([(1, None), (2, []), (3, [2])], "doc_id long, ids array<int>")
    assert sorted(map(tuple, pieces.decode(ids, queries.piece_model()).collect())) == [(1, ""), (2, ""), (3, "")]


def test_whole_table(spark, library):
    rows = {r.doc_id: r for r in queries.op12_sentencepiece(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_eos=True)
        assert rows[d.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[d.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
