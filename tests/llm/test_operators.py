"""The distributed operators against brute force on small fixtures: nulls, empty texts, copies, ties, clashing columns."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ranklens.llm import decontaminate, html, jaccard, licenses, lines, queries, quality, substrings, toxicity, urlfilter
from ranklens.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")


class Union(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


@pytest.fixture(scope="module")
def docs(spark):
    """Invented documents with copies, near copies, repeated passages, nulls and clashing extra columns."""
    r = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    rows = [(0, None), (2, ""), (4, " \n "), (6, "one"), (8, "a b\n" * 40)]
    for d in range(10, 240, 2):
        if r.random() < 0.6:
            w = (r.choice(rows)[1] or "x").split(" ")
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                w[r.randrange(len(w))] = r.choice(vocab)
            text = " ".join(w)
        else:
            text = "\n".join(" ".join(r.choice(vocab) for _ in range(r.choice([1, 3, 20, 60]))) for _ in range(r.randint(1, 3)))
        rows.append((d, text.upper() if r.random() < 0.1 else text))
    queries.ready(spark)
    df = spark.createDataFrame([(d, t, "k", 1) for d, t in rows], "doc_id long, text string, key string, size int").repartition(4)
    return rows, df


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, x) for x in range(1001, 1300)] + [(5000, 5000)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1300)}


@pytest.mark.parametrize("n, percent", [(4, 85), (3, 50)])
def test_jaccard_components(docs, n, percent):
    rows, df = docs
    sets = []
    for _, t in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(t or "")]
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    u = Union()
    for i, (a, _) in enumerate(rows):
        for j, (b, _) in enumerate(rows[:i]):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                u.join(a, b)
    want = sorted((d, len(s), u.find(d)) for (d, _), s in zip(rows, sets))
    assert sorted(map(tuple, jaccard.component_ids(df, n, percent).collect())) == want
    left = jaccard.one_of_each(df.unionByName(df), n, percent)
    assert left.columns == df.columns
    keep = sorted(d for d, size, c in want if size and d == c) + sorted(d for d, size, _ in want if not size) * 2
    assert sorted(r.doc_id for r in left.collect()) == sorted(keep)


def test_jaccard_links_of_a_large_group_of_near_copies(spark):
    r = random.Random(11)
    base = [f"b{i}" for i in range(150)]
    rows = [(3000 + d, f"other text {d} of few words") for d in range(50)]
    for d in range(400):
        w = list(base)
        for _ in range(r.choice([1, 1, 2, 3, 4, 6])):  # from three changes on, a copy is linked only with its like
            at = r.randrange(len(w))
            w[at : at + 1] = r.choice([[], [w[at], f"x{r.randrange(40)}"], [f"x{r.randrange(3000)}"]])
        rows.append((d, " ".join(w)))
    queries.ready(spark)
    sets = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in (t.split(" ") for _, t in rows)]
    u = Union()
    for i, (a, _) in enumerate(rows):
        for j, (b, _) in enumerate(rows[:i]):
            if 100 * (common := len(sets[i] & sets[j])) >= 85 * (len(sets[i]) + len(sets[j]) - common):
                u.join(a, b)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard.component_ids(df, 4, 85)
    assert sorted(map(tuple, got.collect())) == sorted((d, len(s), u.find(d)) for (d, _), s in zip(rows, sets))


def test_substrings_equal_brute_force(docs):
    rows, df = docs
    for window in (20, 7):
        first = {}
        for d, t in rows:
            w = WORD.findall(t or "")
            for i in range(len(w) - window + 1):
                first.setdefault(tuple(w[i : i + window]), (d, i))
        want = []
        for d, t in rows:
            w = WORD.findall(t or "")
            gone = set()
            for i in range(len(w) - window + 1):
                if first[tuple(w[i : i + window])] < (d, i):
                    gone |= set(range(i, i + window))
            left = " ".join(x for i, x in enumerate(w) if i not in gone)
            want.append((d, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
        assert sorted(map(tuple, substrings.remove_repeats(df, window, digests=True).collect())) == sorted(want)


def test_substrings_of_rows_given_twice_stay(spark):
    r = random.Random(2)
    text = [" ".join(f"w{r.randrange(900)}" for _ in range(60)) for _ in range(4)]
    rows = [(1, text[0]), (1, text[0]), (2, text[1] + " " + text[2]), (3, text[3] + " " + text[1])] * 2
    queries.ready(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted([(1, 60, 0, text[0]), (1, 60, 0, text[0]), (2, 120, 0, text[1] + " " + text[2]), (3, 120, 60, text[3])] * 2)
    for parts in (1, 5):  # the copies in one slice and in several
        assert sorted(map(tuple, substrings.remove_repeats(df.repartition(parts)).collect())) == want


def test_equal_lines_go_and_others_stay(docs):
    _, df = docs
    out = {r.doc_id: r for r in lines.line_counts(df).collect()}
    assert out[0].n_lines == 1 and out[2].n_removed == 0
    assert out[8].n_removed == 39 and out[8].removed == list(range(1, 40))
    kept = lines.dedup_lines(df)
    assert kept.columns == df.columns
    text = {r.doc_id: r.text for r in kept.collect()}
    assert text[0] is None and text[2] == "" and text[8] == "a b\n"


def test_nearly_equal_lines_are_linked(spark):
    r = random.Random(1)
    base = [''.join(r.choice('abcdefghij') for _ in range(8)) for _ in range(150)]
    near = base.copy()
    near[70] = "changed"
    rows = [(1, " ".join(base)), (2, "own line\n" + " ".join(near)), (3, " ".join(reversed(base)))]
    got = {r.doc_id: r.removed for r in lines.line_counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [], 2: [1], 3: []}


def word_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def test_near_lines_of_every_similarity_equal_brute_force(spark):
    r = random.Random(9)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(r.choice([2, 6, 8]))) for _ in range(400)]
    texts = []
    for size in (4, 5, 8, 9, 10, 15, 20, 34, 50):
        for similarity in (0.75, 0.80, 0.85, 0.90, 0.95):
            base = [r.choice(vocab[:40] if r.random() < 0.3 else vocab) for _ in range(size)]
            near = list(base)
            for _ in range(round(size * (1 - similarity))):
                at = r.randrange(len(near))
                near[at : at + 1] = r.choice([[], [near[at], r.choice(vocab)], [r.choice(vocab)], [r.choice(vocab)]])
            texts += [base, near]
    r.shuffle(texts)
    u, edges = Union(), 0
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:i]):
            if word_distance(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9):
                u.join(i, j)
                edges += 1
    queries.ready(spark)
    got = lines.line_counts(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4))
    assert edges > 30 and {x.doc_id for x in got.collect() if x.n_removed} == {i for i in range(len(texts)) if u.find(i) != i}


def test_template_windows_and_slots(spark):
    items = spark.createDataFrame([(7, "Alice has 12 apples, and Bob buys 5 kg of pears for 12 dollars every week in Paris."), (8, "tiny one"), (9, None)], "item_id long, text string")
    rows = [
        (1, "Intro. Alice has 12 apples, and Bob buys 5 kg of pears for 12 dollars every week in Paris. End."),
        (2, "Intro. Tom has 9 apples, and Ann buys 7 kg of pears for 9 dollars every week in Rome."),
        (3, "Intro. Tom has 9 apples, and Ann buys 7 kg of pears for 31 dollars every week in Rome."),
        (4, "nothing of the sort but apples, and pears for every week"),
        (5, None),
        (6, ""),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.id for r in decontaminate.contaminated(df, items).collect()} == {1, 2}  # 3 contradicts itself
    assert sorted(r.doc_id for r in decontaminate.clean(df, items).collect()) == [3, 4, 5, 6]
    assert decontaminate.contaminated(df, items.where("false")).count() == 0


def test_slot_values_lose_punctuation_and_only_wrong_slots_count_against(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("bcdfghklm") for _ in range(7))
    w = [word() for _ in range(55)]
    short = "the shop sells 12 apples to every visitor who pays the man at the door 12 dollars before noon on any day of the long week"
    items = spark.createDataFrame([(1, " ".join(w)), (2, short)], "item_id long, text string")
    rows = [
        (1, "so " + " ".join(w[10:37]) + " end"),  # 20 of 48 windows, 27 words in a row
        (2, " ".join(w[10:22])),  # 12 words in a row
        (3, short.replace("12 dollars", "(12) dollars")),
        (4, short.replace("12 apples", "9, apples").replace("12 dollars", "9 dollars")),
        (5, short.replace("12 dollars", "13 dollars")),
        (6, " ".join(short.split()[:10]).replace("12", "7") + " and " + " ".join(short.split()[10:20])),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(x.id, x.item) for x in decontaminate.contaminated(df, items).collect()} == {(1, 1), (3, 2), (4, 2), (5, 2)}


def test_verbatim_copies_in_other_case_or_lines(spark):
    text = "one day in Paris the young Anna met old Victor, near Lyon with Emma, and saw Berta from Rome"
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    forms = [text, text.lower(), text.upper(), text.title(), text.replace(" ", "\n"), text.replace(" ", "  "), "nothing of one day in Paris"]
    df = spark.createDataFrame(list(enumerate(forms)), "doc_id long, text string")
    assert {(x.id, x.n_matched) for x in decontaminate.contaminated(df, items).collect()} == {(i, 12) for i in range(6)}


def test_url_rules_and_host_graph(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.net/en/x", '<a href="http://b.com/q">'), (2, "https://T.Example.NET/en/x?q#f", None), (3, "http://c.com/de/y", "<a href='//a.net/'>"), (4, "http://c.example.com/de/y", ""),
         (5, "http://x.org/fr/a", "<a href=https://good.com/z>"), (6, "http://good.com", ""), (7, None, None), (8, "no scheme", None), (9, "http://net/", ""), (10, "http://b.com/e", "")],
        "page_id long, url string, html string",
    )
    got = {r.page_id: tuple(r)[1:] for r in urlfilter.judge(pages, queries.RULES).collect()}
    assert got == {
        1: ("a.net", "/en/x", "net/", "block"), 2: ("t.example.net", "/en/x", "example.net/en/", "allow"), 3: ("c.com", "/de/y", None, "block"), 4: ("c.example.com", "/de/y", "example.com/de/", "block"),
        5: ("x.org", "/fr/a", "org/fr/", "allow"), 6: ("good.com", "", None, "allow"), 7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("net", "/", "net/", "block"), 10: ("b.com", "/e", None, "allow"),
    }
    v = {r.host: r for r in urlfilter.host_verdicts(pages, queries.RULES).collect()}
    assert v["good.com"].trust > 1 and v["c.com"].distrust > 1 and not v["b.com"].distrust


def test_hosts_without_pages_are_seeds(spark):
    pages = spark.createDataFrame(
        [(1, "http://portal.com/", '<a href="http://spam.net/a"><a href="http://junk.net/">'), (2, "http://list.com/", '<a href="http://x.org/">'), (3, "http://x.com/", "")],
        "page_id long, url string, html string",
    )
    assert {r.page_id: r.verdict for r in urlfilter.judge(pages, queries.RULES).collect()} == {1: "block", 2: "allow", 3: "allow"}
    v = {r.host: r for r in urlfilter.host_verdicts(pages, queries.RULES).collect()}
    assert v["portal.com"].distrust > 0.1 and v["spam.net"].distrust > 1 and v["x.org"].trust > 1 and not v["list.com"].distrust


def test_licence_lines(spark):
    rows = [(1, "x\nLicensed under the Apache License, Version 2.0.\ny"), (2, "licensed UNDER the apache license version 2 0"), (3, "Apache"), (4, None), (5, "")]
    got = {(r.doc_id, r.line, r.license, round(r.dice, 3)) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {x for x in got if x[2] == "Apache-2.0"} == {(1, 1, "Apache-2.0", 1.0), (2, 0, "Apache-2.0", 1.0), (1, -1, "Apache-2.0", 0.875)} or {(1, 1, "Apache-2.0", 1.0), (2, 0, "Apache-2.0", 1.0)} <= got
    assert {x[0] for x in got} == {1, 2}


def test_site_template_goes_and_shared_passages_stay(spark):
    pages = [(i, "http://h.org/%d" % i, f"<div><p>Sign in here</p></div><p>own text {i}</p>") for i in range(20)]
    pages += [(100 + i, "http://a.org/%d" % i, f"<article><h1>t{i}</h1><div><b>rate this</b></div><p>shared passage</p></article>") for i in range(20)]
    pages += [(200, None, None), (201, "http://h.org/x", "")]
    got = {r.page_id: r for r in html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[3].text == "own text 3" and got[103].text == "t3\nshared passage" and got[200].text == "" and got[201].n_chars == 0


def test_small_sites_have_templates_and_marks_never_take_the_article(spark):
    pages = [(i, f"http://s.org/{i}", f"<div><p>Sign in here</p></div><p>own text {i}</p>") for i in range(4)]
    pages += [
        (10, "http://a.org/", '<div class="layout with-sidebar"><article><p>one</p></article><div class="sidebar">side</div></div>'),
        (11, "http://b.org/", '<article class="post has-comments"><p>two</p><div class="comments">reply</div></article>'),
        (12, "http://c.org/", '<main id="side-main"><p>three</p></main><div class="sidebar">side</div>'),
        (13, "http://d.org/", '<main><p>four is the text of the page</p><div class="comments"><article class="comment">reply</article></div></main>'),
        (14, "http://e.org/", '<article><p>five</p></article><div class="comments"><article>a longer reply</article></div>'),
    ]
    queries.ready(spark)
    got = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(4)] == [f"own text {i}" for i in range(4)]
    assert [got[i] for i in range(10, 15)] == ["one", "two", "three", "four is the text of the page", "five"]


def test_quality_policies_and_ablations(docs):
    _, df = docs
    led = quality.ledger(df)
    kept = quality.apply_policy(led, 1)
    assert kept.where("kept and n_words < 50").count() == 0
    rows = {r.rule: r for r in quality.ablations(led, 1).collect()}
    assert rows["few_words"].n_failed == led.where("n_words < 50").count()
    assert rows["few_words"].n_only == led.where("n_words < 50 and not 100 * n_repeat_words > 50 * n_words").count()


def test_toxicity_learns_and_scores_every_row(spark):
    r = random.Random(3)
    rows, labels = [], []
    for d in range(400):
        w = [f"w{r.randint(0, 80)}" for _ in range(30)]
        if d % 4 == 0:
            w[5] = "idiot"
        rows.append((d, " ".join(w)))
        labels.append((d, int(d % 4 == 0)))
    df = spark.createDataFrame([*rows, (None, None), (1000, "")], "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (5000, None)], "doc_id long, toxic int")
    weights = toxicity.train(df, lab, usable=F.col("doc_id") % 5 != 0, shards=1, l1=2.0)
    out = {x.doc_id: x.score for x in toxicity.score(df, weights).collect()}
    held = [d for d, _ in rows if d % 5 == 0]
    assert len(out) == 402 and sum((out[d] >= 0.5) == (d % 4 == 0) for d in held) >= 0.95 * len(held)
    assert out[1000] < 0.5
    none = toxicity.score(df, toxicity.train(df, lab.where("false")))
    assert none.agg(F.max("score")).first()[0] == 0.0
