"""Word spans, quality rules, BPE, HTML and FM-index against plain Python, without Spark."""

import html as H
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ranklens.llm import bpe, html, quality
from ranklens.llm.fmindex import FMIndex
from ranklens.llm.wordhash import Texts

WORD = re.compile("[^\x20\x09-\x0d]+")


def test_words_never_cross_rows_and_hash_by_content():
    col = pa.array(["ab", "cd ab", None, "", " \n", "é x ab"])
    t = Texts(col)
    got = [[t.raw[a:b].tobytes().decode() for a, b in zip(t.start[lo:hi], t.end[lo:hi])] for lo, hi in zip(t.word_off, t.word_off[1:])]
    assert got == [WORD.findall(x or "") for x in col.to_pylist()]
    h = t.words()
    assert h[0] == h[2] == h[4] and len(set(h.tolist())) == 3


def brute_measures(text):
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times, covered, seen, dup = Counter(grams), set(), set(), 0
    for i, g in enumerate(grams):
        if times[g] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality_measures_equal_brute_force():
    r = random.Random(4)
    texts = ["", "\n\n", "a a a a a", "x y z\nx y z\n\n x y z", "é|#\x0b<b>\r\nü"]
    texts += ["".join(r.choice(["a", "b", "é", " ", "\n", "#", "  ", "c d e "]) for _ in range(r.randint(0, 300))) for _ in range(200)]
    m = quality.measure(pa.array([*texts, None]))
    for i, text in enumerate([*texts, ""]):
        assert brute_measures(text) == tuple(int(m[k][i]) for k in quality.MEASURES[:5])


@pytest.fixture(scope="module")
def vocabulary():
    public = pytest.importorskip("public_tokenizers")
    return str(public.path("word_bpe_49k.json"))


def test_forced_boundaries_give_the_librarys_ids_and_texts(vocabulary):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(vocabulary), bpe.ForcedBoundaryBPE(vocabulary)
    r = random.Random(1)
    texts = ["", "a" * 3000, "ΑΣ ΣΑΣ Σ", "İ ǅ ß ﬁ", "éa", "it's I'LL don''t", "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "x　\x85y\x1cz", "日本語 🙂👩‍👩‍👧", "१२३ ½ ²", "\x00a\x7f"]
    texts += ["".join(r.choice("abΣé 🙂'st1²\n\t<|>ﬀQ") for _ in range(r.randint(1, 80))) for _ in range(500)]
    cut = 0
    for text in texts:
        ids = own.encode(text)
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)
        for word in own.words(text):
            cut += len(list(own.fragments([own._bytes[b] for b in word.encode()]))) > 1
    assert cut > 100  # boundaries are really forced


PAGE = """<html><head><title>T</title></head><body><header>Site</header><nav><ul><li>a</ul></nav><article class="post">
<header><h1>Head &amp; tail&hellip;</h1></header><p>One <b>two</b>
 three<p>Four<br>five &lt;x&gt; &am<ul><li>i1<li>i2</ul><div class="share">Share</div><script>var a="</p><p>no";</script>
<aside>side</aside><form>f<input></form><section id="comments"><article class="comment"><p>me too</article></section></article><footer>foot"""


def test_main_text_of_untidy_page():
    assert html.text_of(html.parse(PAGE)) == "Head & tail…\nOne two three\nFour five <x> &am\ni1\ni2"
    assert html.text_of(html.parse("")) == "" and html.text_of(html.parse("x &lt; y")) == "x < y"
    assert html.text_of(html.parse("<article></article>b")) == ""
    assert H.unescape("&amp") == "&"


def test_fm_index_finds_every_window_and_its_first_place():
    r = random.Random(7)
    for length in (7, 20):
        runs = [[r.randint(1, 3) for _ in range(r.randint(length, length + 30))] for _ in range(20)] + [[1, 2] * 30, [3] * 50]
        text = np.array([x for run in runs for x in [*run, 0]])
        first = np.cumsum([0, *[len(run) + 1 for run in runs[:-1]]])
        sizes = np.array([len(run) for run in runs])
        index = FMIndex(text, 4, length)
        at, rows = index.matches(first + sizes, sizes, text)
        assert len(at) == sum(sizes - length + 1)
        where = {}
        for i in range(len(text) - length + 1):
            where.setdefault(tuple(text[i : i + length]), i)
        assert all(index.earliest[b] == where[tuple(text[a : a + length])] for a, b in zip(at, rows))
