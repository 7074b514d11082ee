"""The stages of the corpus pipeline on small tables: what goes, what stays, and columns with clashing names."""

import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ranklens.llm import queries

CLASH = ["__id", "__th", "__n", "__once", "__removed", "id", "th", "row", "removed", "size", "label", "score", "k0"]
ITEM = "how many apples does the old farmer carry home from his garden in the rain"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    r = random.Random(8)
    word = lambda: "".join(r.choice("bcdfghklmnprst") + r.choice("aeiou") for _ in range(3))
    line = lambda n=12: " ".join(word() for _ in range(n))
    long = line(40)
    near = " ".join([*long.split()[:39], "changed"])
    texts = {
        1: long, 2: long, 3: near, 4: line(30), 5: None, 6: "", 7: f"{line(30)} {ITEM} {line(9)}",
        8: "\n".join([line(), "a line that stands in two documents of this table", line()]),
        9: "\n".join([line(), "a line that stands in two documents of this table", line()]),
        10: line(20000),
    }
    for i in range(20, 80):
        texts[i] = f"{line(6)} {'vile rotten scum' if i % 2 else line(3)} {line(6)}"
    path = str(tmp_path_factory.mktemp("pipeline"))
    rows = [(i, t, "en", "web", len(t or ""), *CLASH) for i, t in texts.items()]
    rows.append(rows[3])  # a row given twice
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, i % 2) for i in range(20, 80)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, texts


def _stage(spark, tables, name, where=None):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    docs = docs if where is None else docs.where(where)
    return docs, dict(corpus_pipeline.STAGES)[name](spark, docs, tables[0])


def _unchanged_columns(docs, got):
    assert got.columns == docs.columns
    assert got.select(*(F.col(f"`{c}`") for c in CLASH)).distinct().collect() == [tuple(CLASH)]


def test_toxicity_keeps_clean_rows_whole(spark, tables):
    docs, got = _stage(spark, tables, "toxicity")
    _unchanged_columns(docs, got)
    left = {r.doc_id: r.text for r in got.collect()}
    clean = {i: t for i, t in tables[1].items() if i < 20 or i % 2 == 0}
    assert left.items() <= tables[1].items()
    assert sum(i in left for i in clean) >= 0.9 * len(clean) and sum(i not in left for i in tables[1] if i not in clean) >= 24
    assert sorted(map(str, got.where("doc_id = 4").collect())) == sorted(map(str, docs.where("doc_id = 4").collect()))


def test_lines_stay_once(spark, tables):
    docs, got = _stage(spark, tables, "line_dedup", "doc_id < 10 or doc_id = 10")
    _unchanged_columns(docs, got)
    left = {r.doc_id: r.text for r in got.collect()}
    texts = tables[1]
    assert 2 not in left and 3 not in left  # their only line is the first one's
    assert {i: left[i] for i in (1, 4, 5, 6, 7, 8, 10)} == {i: texts[i] for i in (1, 4, 5, 6, 7, 8, 10)}
    assert left[9].split("\n") == [x for x in texts[9].split("\n") if x not in texts[8].split("\n")]
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.collect())


def test_near_copies_stay_once(spark, tables):
    docs, got = _stage(spark, tables, "ngram_jaccard_join")
    _unchanged_columns(docs, got)
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(tables[1]) - {2, 3})


def test_benchmark_passages_go(spark, tables):
    docs, got = _stage(spark, tables, "decontamination")
    _unchanged_columns(docs, got)
    assert sorted(r.doc_id for r in got.collect()) == sorted([*(set(tables[1]) - {7}), 4])


def test_tokens_are_the_library_s(spark, tables):
    library = Tokenizer.from_file(queries.vocabulary())
    library.no_truncation()
    library.no_padding()
    _, got = _stage(spark, tables, "bpe")
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in tables[1].items()}
    assert {r.doc_id: (list(r.ids), r.decoded) for r in got.collect()} == {i: (x, library.decode(x, skip_special_tokens=False)) for i, x in ids.items()}


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_tables(spark, tables, name):
    docs, got = _stage(spark, tables, name, "false")
    assert got.count() == 0 and (name == "bpe" or got.columns == docs.columns)


def test_toxicity_sends_texts_and_takes_scores(spark, tables):
    """Other columns stay where they are, and the text doesn't come back."""
    plan = _stage(spark, tables, "toxicity")[1]._jdf.queryExecution().executedPlan().toString()
    sent = [x for x in plan.split("\n") if "ArrowEvalPython" in x]
    assert len(sent) == 1 and "(text#" in sent[0] and "MapInArrow" not in plan, sent
