"""Preferences of whole topics inside tasks.

Judgments and run of a topic are sent to one place once, sorted by document,
and a task takes the topics of a batch of rows all at once: groups of about
equal size become one array (groups, documents, documents) of "preferred to",
which is closed by squaring.  No pair leaves its task unless it is a result.
Only topics of at most ``SMALL_TOPIC`` rows come here (:func:`split_topics`), so
a task holds little whatever the tables; larger topics are spread (``prefs``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklens.operators.ranked import normalize_run
from ranklens.session import written

#: Rows (judgments and retrieved documents) of a topic that one task may hold.
SMALL_TOPIC = 2_048
#: Cells of the arrays that a task fills at once.
CELLS = 1 << 20

COUNTS = [
    "poss_ret", "ful_ret", "poss_imp", "ful_imp", "poss_notoccur", "num_rel", "num_nonrel", "num_rel_ret", "num_nonrel_ret",
    "rc_ful", "rc_poss", "rcr_ful", "rcr_poss",
]


def split_topics(prefs: DataFrame, *more: DataFrame, keys=("qid",)) -> tuple[Callable, DataFrame | None]:
    """(small, large): ``small(df)`` keeps the rows of small topics, ``large(df)`` those of the others (None if there are none)."""
    n = prefs.select(*keys)
    for df in more:
        n = n.unionByName(df.select(*keys))
    return _split(n.groupBy(*keys).count(), keys)


def split_docs(docs: DataFrame, sizes: DataFrame | None = None) -> tuple[Callable, DataFrame | None]:
    """:func:`split_topics` of judgments and run by document (:func:`doc_rows`).

    ``sizes(qid, count)``: what a topic has at most; only topics that may be large are counted then.
    """
    if sizes is not None:
        maybe = written(sizes.where(F.col("count") > SMALL_TOPIC).select(F.col("qid").alias("_qid")), "large_topics")
        if maybe.isEmpty():
            return (lambda df: df), None
        docs = docs.join(maybe, F.col("qid").eqNullSafe(F.col("_qid")), "left_semi")
    return _split(docs.groupBy("qid").agg(F.sum("n").alias("count")), ("qid",))


def _split(counts: DataFrame, keys) -> tuple[Callable, DataFrame | None]:
    big = written(counts.where(F.col("count") > SMALL_TOPIC).select(*(F.col(k).alias(f"_{k}") for k in keys)), "large_topics")
    if big.isEmpty():
        return (lambda df: df), None

    def keep(how: str) -> Callable:
        def kept(df: DataFrame) -> DataFrame:
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
            return df.join(big, same, how)

        return kept

    return keep("left_anti"), keep("left_semi")


def topic_rows(prefs: DataFrame, run: DataFrame | None = None) -> DataFrame:
    """Judgments and run (its rows have a run_id) of each topic in one place, by document."""
    none = F.lit(None).cast("string")
    rows = prefs.select("qid", "docno", none.alias("run_id"), "jg", "jsg", F.col("rel_level").cast("double").alias("v"))
    if run is not None:
        r = normalize_run(run).where(F.col("qid").isNotNull())
        rows = rows.where(F.col("qid").isNotNull()).unionByName(r.select("qid", "docno", "run_id", none.alias("jg"), none.alias("jsg"), F.col("sim").cast("double").alias("v")))
    return rows.repartition("qid").sortWithinPartitions("qid", "docno")


def doc_rows(docs: DataFrame) -> DataFrame:
    """The rows of :func:`topic_rows` from (qid, docno, n, judged, ranked), one row for each document of a topic.

    ``judged``: (jg, jsg, rel_level) of its judgments, ``ranked``: (run_id, sim)
    of its rows in runs, ``n``: the number of both.  The arrays are opened where
    the topic lies; documents that lie by topic already do not move.
    """
    none = F.lit(None).cast("string")
    judged = F.transform("judged", lambda x: F.struct(none.alias("run_id"), x["jg"].alias("jg"), x["jsg"].alias("jsg"), x["rel_level"].cast("double").alias("v")))
    ranked = F.transform("ranked", lambda x: F.struct(F.coalesce(x["run_id"], F.lit("run")).alias("run_id"), none.alias("jg"), none.alias("jsg"), x["sim"].cast("float").cast("double").alias("v")))
    dealt = docs.where(F.col("qid").isNotNull()).repartition("qid").sortWithinPartitions("qid", "docno")
    return dealt.select("qid", "docno", F.inline(F.concat(judged, ranked)))


def in_tasks(rows: DataFrame, work: Callable, schema: str, keys=("qid",)) -> DataFrame:
    """``work(table)`` over the whole topics (``keys``, sorted) of each batch; it yields columns of the schema."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch]).combine_chunks()
            cut = int(np.flatnonzero(np.logical_or.reduce([_fresh(table[k]) for k in keys]))[-1])  # the last topic may go on
            if cut:
                yield from out(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held:
            yield from out(pa.Table.from_batches(held))

    def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for columns in work(table.combine_chunks()):
            done = pa.table(columns)
            yield from done.combine_chunks().to_batches(max_chunksize=50_000)

    return rows.mapInArrow(run, schema)


def _fresh(column: pa.ChunkedArray) -> np.ndarray:
    """Whether a row's value differs from the row's before (nulls are equal)."""
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    null = np.asarray(pc.is_null(c).to_numpy(zero_copy_only=False))
    differs = pc.fill_null(pc.not_equal(c[1:], c[:-1]), False).to_numpy(zero_copy_only=False)
    return np.r_[True, differs | (null[1:] != null[:-1])][: len(c)]


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted key stands among the sorted keys, -1 if nowhere."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _spread(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, index) for all ``starts[o] .. starts[o] + lengths[o] - 1``."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return owner, np.repeat(starts, lengths) + offset


def _slots(owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(place in its owner, length of each owner) of rows sorted by owner."""
    lengths = np.bincount(owner, minlength=n)
    return np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths), lengths


class Topics:
    """The rows of some whole topics as numbers: topics, documents, groups and sub-groups are numbered in order."""

    def __init__(self, table: pa.Table):
        self.table = table
        fresh_topic = _fresh(table["qid"])
        fresh_doc = fresh_topic | _fresh(table["docno"])
        topic, doc = np.cumsum(fresh_topic) - 1, np.cumsum(fresh_doc) - 1
        self.n_docs = int(doc[-1]) + 1
        self.doc_row, self.topic_row = np.flatnonzero(fresh_doc), np.flatnonzero(fresh_topic)
        self.doc_topic = topic[self.doc_row]
        valid = lambda c: table[c].is_valid().to_numpy()
        self.doc_named = valid("docno")[self.doc_row]
        code = lambda c: table[c].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64)
        value = table["v"].combine_chunks().to_numpy(zero_copy_only=False).astype(float)
        known = valid("v")
        is_run = valid("run_id")
        # judgments: groups, sub-groups, levels (a level that is no number is above all)
        j = np.flatnonzero(~is_run)
        self.judged = np.zeros(self.n_docs, bool)
        self.judged[doc[j]] = True
        level = np.where(known & np.isnan(value), np.inf, np.where(known, value, np.nan))
        jg, jsg = code("jg"), code("jsg")
        group_key = topic[j] * (len(jg) + 1) + jg[j]
        _, first, group = np.unique(group_key, return_index=True, return_inverse=True)
        self.group_row, self.group_topic = j[first], topic[j[first]]
        self.group_named = valid("jg")[self.group_row] & valid("qid")[self.group_row]
        self.j_row, self.j_doc, self.j_group, self.j_jsg, self.j_level = j, doc[j], group, jsg[j], level[j]
        self.n_groups = len(first)
        # sub-groups: the levels of a document lie between lo and hi
        sub = np.flatnonzero(valid("jsg")[j])
        block_key = group[sub] * (len(jsg) + 1) + jsg[j][sub]
        blocks, block = np.unique(block_key, return_inverse=True)
        self.n_sub = np.bincount(blocks // (len(jsg) + 1), minlength=self.n_groups)
        self.first_block = np.cumsum(self.n_sub) - self.n_sub
        self.block_docs, self.lo, self.hi = self._ranges(block, sub)
        # documents of a group: the highest level, nan if none is known
        self.group_docs, _, self.level = self._ranges(group, np.arange(len(j)))
        # the run's rows in order of their lists
        r = np.flatnonzero(is_run)
        run_key = topic[r] * (len(jg) + 1) + code("run_id")[r]
        lists, first, unit = np.unique(run_key, return_index=True, return_inverse=True)
        self.list_row, self.list_topic = r[first], topic[r[first]]
        kind = np.where(~known[r], 2, np.where(np.isnan(value[r]), 0, 1))
        score = np.where(kind == 1, -value[r], 0.0)
        order = np.lexsort((np.arange(len(r)), score, kind, unit))
        self.r_list, self.r_doc = unit[order], doc[r][order]

    def _ranges(self, owner: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys owner * documents + document, smallest level, largest level), nan where none is known."""
        keys, at = np.unique(owner * self.n_docs + self.j_doc[rows], return_inverse=True)
        lo, hi = np.full(len(keys), np.nan), np.full(len(keys), np.nan)
        np.fmin.at(lo, at, self.j_level[rows])
        np.fmax.at(hi, at, self.j_level[rows])
        return keys, lo, hi

    def take(self, column: str, rows: np.ndarray) -> pa.Array:
        return self.table[column].combine_chunks().take(pa.array(rows))

    def positions(self, max_docs: int | None) -> tuple[np.ndarray, ...]:
        """(list, document, retrieved, position) of every judged document in every list of its topic, in order."""
        place, _ = _slots(self.r_list, len(self.list_row))
        kept = np.full(len(place), True) if max_docs is None else place < max_docs
        lists, docs, place = self.r_list[kept], self.r_doc[kept], place[kept]
        ranked = self.judged[docs] & self.doc_named[docs]
        alive = np.unique(lists)  # lists that retrieve anything
        judged = np.flatnonzero(self.judged)
        per_topic = np.bincount(self.doc_topic[judged], minlength=len(self.topic_row))
        starts = np.cumsum(per_topic) - per_topic
        owner, at = _spread(starts[self.list_topic[alive]], per_topic[self.list_topic[alive]])
        all_list, all_doc = alive[owner], judged[at]
        seen = np.unique(lists[ranked] * self.n_docs + docs[ranked])
        rest = _find(seen, all_list * self.n_docs + all_doc) < 0
        e_list = np.r_[lists[ranked], all_list[rest]]
        e_doc = np.r_[docs[ranked], all_doc[rest]]
        ret = np.r_[np.ones(ranked.sum(), bool), np.zeros(rest.sum(), bool)]
        order = np.lexsort((np.r_[place[ranked], all_doc[rest]], ~ret, e_list))
        e_list, e_doc, ret = e_list[order], e_doc[order], ret[order]
        return e_list, e_doc, ret, _slots(e_list, len(self.list_row))[0]

    def preferred(self, group: np.ndarray, case: np.ndarray, slot: np.ndarray, doc: np.ndarray, m: int, closed: np.ndarray | None = None) -> np.ndarray:
        """(cases, m, m): whether the row's document is preferred to the column's in the case's group.

        ``closed`` cases (default: groups of several sub-groups) get their transitive closure.
        """
        out = np.zeros((len(group), m, m), bool)
        n_sub = self.n_sub[group]
        for s in range(int(n_sub.max(initial=0))):
            block = np.where(n_sub[case] > s, self.first_block[group[case]] + s, -1)
            at = _find(self.block_docs, np.where(block >= 0, block * self.n_docs + doc, -1))
            hit = at >= 0
            hi, lo = np.full(out.shape[:2], np.nan), np.full(out.shape[:2], np.nan)
            hi[case[hit], slot[hit]] = self.hi[at[hit]]
            lo[case[hit], slot[hit]] = self.lo[at[hit]]
            out |= hi[:, :, None] > lo[:, None, :]
        return _close(out, n_sub > 1 if closed is None else closed)


def _close(edges: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The arrays (cases, m, m), those chosen closed by squaring until nothing is new."""
    open_ = np.flatnonzero(chosen)
    while len(open_):
        known = edges[open_].astype(np.float32)
        longer = (known @ known > 0) & ~edges[open_]
        changed = longer.any((1, 2))
        open_ = open_[changed]
        edges[open_] |= longer[changed]
    return edges


def _chunks(size: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """(cases, m): cases of at most m documents each, arrays of about CELLS cells."""
    wide = np.where(size > 0, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(int), 0)
    for m in np.unique(wide[wide > 0]):
        cases = np.flatnonzero(wide == m)
        step = max(1, CELLS // int(m * m))
        for i in range(0, len(cases), step):
            yield cases[i : i + step], int(m)


def _members(owner: np.ndarray, n: int) -> Callable:
    """Rows (sorted by owner) of chosen owners: (number among the chosen, place, row)."""
    lengths = np.bincount(owner, minlength=n)
    starts = np.cumsum(lengths) - lengths

    def of(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        case, row = _spread(starts[chosen], lengths[chosen])
        return case, row - starts[chosen][case], row

    return of


def list_positions(table: pa.Table, max_docs: int | None) -> Iterator[dict]:
    """(run_id, qid, docno, ret, pos), see ``prefs.pref_positions``."""
    t = Topics(table)
    e_list, e_doc, ret, pos = t.positions(max_docs)
    rows = t.doc_row[e_doc]
    yield {"run_id": t.take("run_id", t.list_row[e_list]), "qid": t.take("qid", rows), "docno": t.take("docno", rows), "ret": pa.array(ret), "pos": pa.array(pos, pa.int64())}


def _group_members(t: Topics) -> tuple[np.ndarray, np.ndarray]:
    """(group, document) of named groups and documents, in order."""
    group, doc = t.group_docs // t.n_docs, t.group_docs % t.n_docs
    named = t.group_named[group] & t.doc_named[doc]
    return group[named], doc[named]


def group_edges(table: pa.Table, only_multi: bool) -> Iterator[dict]:
    """(qid, jg, a, b): each preference of a group (of those with several sub-groups) once, see ``prefs.pref_edges``."""
    t = Topics(table)
    group, doc = t.group_docs // t.n_docs, t.group_docs % t.n_docs
    of = _members(group, t.n_groups)
    wanted = t.group_named & (t.n_sub > (1 if only_multi else 0))
    for groups, m in _chunks(np.where(wanted, np.bincount(group, minlength=t.n_groups), 0)):
        case, slot, row = of(groups)
        edges = t.preferred(groups, case, slot, doc[row], m, np.zeros(len(groups), bool))
        docs = np.zeros((len(groups), m), np.int64)
        docs[case, slot] = t.doc_row[doc[row]]
        g, a, b = np.nonzero(edges)
        rows = t.group_row[groups[g]]
        yield {"qid": t.take("qid", rows), "jg": t.take("jg", rows), "a": t.take("docno", docs[g, a]), "b": t.take("docno", docs[g, b])}


def closed_edges(table: pa.Table) -> Iterator[dict]:
    """(qid, jg, a, b) of the transitive closure of the edges of whole groups, see ``prefs.pref_closure``."""
    fresh = _fresh(table["qid"]) | _fresh(table["jg"])
    group, group_row = np.cumsum(fresh) - 1, np.flatnonzero(fresh)
    n = table.num_rows
    names = pa.concat_arrays([table["a"].combine_chunks(), table["b"].combine_chunks()])
    code = names.dictionary_encode().indices.to_numpy().astype(np.int64)
    node, first, at = np.unique(np.r_[group, group] * (2 * n) + code, return_index=True, return_inverse=True)
    owner = node // (2 * n)
    place, size = _slots(owner, len(group_row))
    of, edges_of = _members(owner, len(group_row)), _members(group, len(group_row))
    for groups, m in _chunks(size):
        edges = np.zeros((len(groups), m, m), bool)
        case, _, row = edges_of(groups)
        edges[case, place[at[row]], place[at[row + n]]] = True
        edges = _close(edges, np.ones(len(groups), bool))
        case, slot, row = of(groups)
        named = np.zeros((len(groups), m), np.int64)
        named[case, slot] = first[row]
        g, a, b = np.nonzero(edges)
        rows = pa.array(group_row[groups[g]])
        yield {"qid": table["qid"].take(rows), "jg": table["jg"].take(rows), "a": names.take(pa.array(named[g, a])), "b": names.take(pa.array(named[g, b]))}


def faults(table: pa.Table) -> Iterator[dict]:
    """(qid, jg, docno, problem), see ``prefs.validate_prefs``."""
    t = Topics(table)

    def found(group: np.ndarray, doc: np.ndarray, problem: str) -> dict:
        rows = t.group_row[group]
        return {"qid": t.take("qid", rows), "jg": t.take("jg", rows), "docno": t.take("docno", t.doc_row[doc]), "problem": pa.array([problem] * len(rows), pa.string())}

    # a missing name of a sub-group is a name too, but makes no preference
    _, first, sub = np.unique(t.j_group * (table.num_rows + 1) + t.j_jsg, return_index=True, return_inverse=True)
    keys, lo, hi = t._ranges(sub, np.arange(len(sub)))
    two = np.flatnonzero(hi > lo)
    yield found(t.j_group[first][keys[two] // t.n_docs], keys[two] % t.n_docs, "two levels in a sub-group")
    keys, lo, hi = t._ranges(t.j_group, np.arange(len(sub)))
    zero = np.flatnonzero((lo == 0) & (hi > 0))
    yield found(keys[zero] // t.n_docs, keys[zero] % t.n_docs, "zero and non-zero level in a group")
    group, doc = _group_members(t)
    of = _members(group, t.n_groups)
    for groups, m in _chunks(np.bincount(group, minlength=t.n_groups)):
        case, slot, row = of(groups)
        way = t.preferred(groups, case, slot, doc[row], m, np.ones(len(groups), bool))
        on = way[:, np.arange(m), np.arange(m)]
        cyclic = (on | (way & on[:, :, None]).any(1)) & (on | (way & on[:, None, :]).any(2))
        hit = cyclic[case, slot]
        yield found(groups[case[hit]], doc[row[hit]], "in a cycle of preferences")


def list_counts(table: pa.Table, max_docs: int | None) -> Iterator[dict]:
    """The counts of each (list, group), see ``prefs.pref_counts``."""
    t = Topics(table)
    e_list, e_doc, ret, _ = t.positions(max_docs)
    usable = np.flatnonzero(t.group_named & (t.n_sub > 0))
    per_topic = np.bincount(t.group_topic[usable], minlength=len(t.topic_row))
    starts = np.cumsum(per_topic) - per_topic
    owner, at = _spread(starts[t.list_topic], per_topic[t.list_topic])
    case_list, case_group = owner, usable[at]  # every list with every group of its topic
    of_list = _members(e_list, len(t.list_row))
    case, _, row = of_list(case_list)
    at = _find(t.group_docs, case_group[case] * t.n_docs + e_doc[row])
    inside = (at >= 0) & t.doc_named[e_doc[row]]
    case, row, level = case[inside], row[inside], t.level[at[inside]]
    of_case = _members(case, len(case_list))
    for cases, m in _chunks(np.bincount(case, minlength=len(case_list))):
        c, slot, k = of_case(cases)
        lvl, r, real = np.full((len(cases), m), np.nan), np.zeros((len(cases), m), bool), np.zeros((len(cases), m), bool)
        lvl[c, slot], r[c, slot], real[c, slot] = level[k], ret[row[k]], True
        one = t.n_sub[case_group[cases]] == 1
        flat = np.where(real & np.isnan(lvl), -np.inf, lvl)  # in one sub-group an unknown level is below all
        edges = flat[:, :, None] > flat[:, None, :]
        several = np.flatnonzero(~one)
        if len(several):
            number = np.cumsum(~one) - 1
            mine = ~one[c]
            edges[several] = t.preferred(case_group[cases[several]], number[c[mine]], slot[mine], e_doc[row[k[mine]]], m)
        yield {
            "run_id": t.take("run_id", t.list_row[case_list[cases]]), "qid": t.take("qid", t.list_row[case_list[cases]]),
            "jg": t.take("jg", t.group_row[case_group[cases]]),
            **{name: pa.array(v.astype(np.int64)) for name, v in _counted(edges, lvl, r, real, one).items()},
        }


def _counted(edges: np.ndarray, lvl: np.ndarray, r: np.ndarray, real: np.ndarray, one: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of arrays (cases, documents in order of positions): edges, levels, retrieved, real documents, one sub-group."""
    earlier = np.triu(np.ones(edges.shape[1:], bool), 1)

    def pairs(left: np.ndarray, right: np.ndarray, mask=None) -> np.ndarray:
        e = edges if mask is None else edges & mask
        return np.einsum("ci,cij,cj->c", left.astype(np.float32), e.astype(np.float32), right.astype(np.float32), optimize=True)

    rel, non, u, every = lvl > 0, lvl == 0, real & ~r, real
    n_rel, n_rel_ret = rel.sum(1), (rel & r).sum(1)
    non_idx, ret_non_idx, before = np.cumsum(non, 1), np.cumsum(non & r, 1), np.cumsum(r, 1) - r
    ful_ret, ful_imp = pairs(r, r, earlier), pairs(r, u)
    kept = non & (non_idx <= n_rel[:, None])
    kept_ret = non & r & (non_idx <= n_rel_ret[:, None])
    ful_ret_rel = pairs(r, r & rel, earlier)
    stay = real & ~(non & (non_idx > n_rel[:, None]))
    stay_ret = r & ~(non & r & (ret_non_idx > n_rel[:, None]))
    recount = {
        "rc_ful": (ful_ret_rel + pairs(r, u & rel) + (before * kept).sum(1), pairs(stay & r, stay, earlier)),
        "rc_poss": (pairs(every, rel) + real.sum(1) * n_rel, pairs(stay, stay)),
        "rcr_ful": (ful_ret_rel + (before * kept_ret).sum(1), pairs(stay_ret, stay_ret, earlier)),
        "rcr_poss": (pairs(r, r & rel) + r.sum(1) * kept_ret.sum(1), pairs(stay_ret, stay_ret)),
    }
    return {
        "poss_ret": pairs(r, r), "ful_ret": ful_ret, "poss_imp": ful_imp + pairs(u, r), "ful_imp": ful_imp, "poss_notoccur": pairs(u, u),
        "num_rel": n_rel, "num_nonrel": non.sum(1), "num_rel_ret": n_rel_ret, "num_nonrel_ret": (non & r).sum(1),
        **{k: np.where(one, a, b) for k, (a, b) in recount.items()},
    }


def list_pairs(table: pa.Table, max_docs: int | None) -> Iterator[dict]:
    """(run_id, qid, x, y, n_xy, n_yx, rx, ry) of topics with several groups, see ``prefs.pair_counts``."""
    t = Topics(table)
    e_list, e_doc, ret, _ = t.positions(max_docs)
    named = np.flatnonzero(t.group_named)
    n_jg = np.bincount(t.group_topic[named], minlength=len(t.topic_row))
    first = np.cumsum(n_jg) - n_jg
    of_list = _members(e_list, len(t.list_row))
    size = np.where(n_jg[t.list_topic] > 1, np.bincount(e_list, minlength=len(t.list_row)), 0)
    for lists, m in _chunks(size):
        case, slot, row = of_list(lists)
        named_doc = t.doc_named[e_doc[row]]
        case, slot, row = case[named_doc], slot[named_doc], row[named_doc]
        agree = np.zeros((len(lists), m, m), np.int64)
        n = n_jg[t.list_topic[lists]]
        for o in range(int(n.max())):
            some = np.flatnonzero(n > o)
            mine = n[case] > o
            number = np.cumsum(n > o) - 1
            groups = named[first[t.list_topic[lists[some]]] + o]
            agree[some] += t.preferred(groups, number[case[mine]], slot[mine], e_doc[row[mine]], m)
        docs, r = np.zeros((len(lists), m), np.int64), np.zeros((len(lists), m), bool)
        docs[case, slot], r[case, slot] = e_doc[row], ret[row]
        ahead = np.triu(np.ones((m, m), bool), 1)
        n_xy, n_yx = agree * ahead, np.triu(agree.transpose(0, 2, 1))
        c, x, y = np.nonzero(n_xy + n_yx)
        cols = {"n_xy": n_xy[c, x, y], "n_yx": n_yx[c, x, y], "rx": r[c, x], "ry": r[c, y]}
        key = (c * t.n_docs + docs[c, x]) * t.n_docs + docs[c, y]
        c, x, y = c, docs[c, x], docs[c, y]
        if len(np.unique(key)) < len(key):  # a document ranked twice
            _, at, back = np.unique(key, return_index=True, return_inverse=True)
            cols = {k: (np.bincount(back, v) > 0) if k in ("rx", "ry") else np.bincount(back, v).astype(np.int64) for k, v in cols.items()}
            c, x, y = c[at], x[at], y[at]
        rows = t.list_row[lists[c]]
        yield {"run_id": t.take("run_id", rows), "qid": t.take("qid", rows), "x": t.take("docno", t.doc_row[x]), "y": t.take("docno", t.doc_row[y]), **{k: pa.array(v) for k, v in cols.items()}}
