"""Preference judgments: positions, counts of fulfilled/possible preferences, measures.

Input ``prefs(qid, jg, jsg, docno, rel_level)``: inside one sub-group ``jsg`` a
document with a higher level is preferred to one with a lower level.  A
judgment group ``jg`` with several sub-groups takes the transitive closure of
the union of its sub-group orders.

Every judged document of a topic gets a position: retrieved documents first
in rank order (score desc, docno asc), then unretrieved ones by docno.  A
preference x ≻ y is fulfilled when x is retrieved and comes before y.

Topics of at most ``topics.SMALL_TOPIC`` rows (judgments and retrieved
documents) are sent to one place once and done inside tasks, many topics at a
time (``topics``): their closure makes no rows.  The topics beyond are spread,
on two physical paths, chosen per group:

* **one sub-group** (the common case, and every judgment file read as
  preferences): counts come from per-level histograms and from merge counting
  inside ranges of positions and of levels; no document pair is ever
  materialised, and rows stay linear however many levels there are.
* **several sub-groups**: the preference relation is only defined through the
  closure, so its edges are materialised per group and closed by iterated
  joins (deduplicated every round, lineage cut by a checkpoint).  Groups of
  this kind are small assessor-defined sets; the closure is quadratic in the
  group size, and only these groups take this path.

The pair measures (``prefs_pair*``) of a topic with several judgment groups
need the per-pair count of groups agreeing; only those topics build pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklens.operators import topics as TP
from ranklens.operators.ordered import prefix_sums, range_of
from ranklens.operators.ranked import add_rank, normalize_run
from ranklens.session import written

G = ["run_id", "qid", "jg"]


# ------------------------------------------------------------------ positions


def pref_positions(run: DataFrame, prefs: DataFrame, max_docs: int | None = None, split_rows: int | None = None, docs: DataFrame | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """(run_id, qid, docno, ret, pos): dense position of every judged document per topic, kept as a table.

    Of topics beyond ``topics.SMALL_TOPIC`` (of all, if ``split_rows`` is given)
    both orders, that of the run and that of the judged documents, are dealt in
    ranges (``ordered``), so a topic of any length is no single task.
    ``docs``: the rows of both by document, see ``topics.doc_rows``; ``sizes``: see ``topics.split_docs``.
    """
    if split_rows is not None:
        return _spread_positions(run, prefs, max_docs, split_rows)
    inside = lambda rows: TP.in_tasks(rows, partial(TP.list_positions, max_docs=max_docs), _POSITIONS)
    return _joined(_split(run, prefs, docs, sizes), prefs, run, docs, inside, lambda p, r: _spread_positions(r, p, max_docs))


_POSITIONS = "run_id string, qid string, docno string, ret boolean, pos long"
_COUNTS = "run_id string, qid string, jg string, " + ", ".join(f"{c} long" for c in TP.COUNTS)
_PAIRS = "run_id string, qid string, x string, y string, n_xy long, n_yx long, rx boolean, ry boolean"
_EDGES = "qid string, jg string, a string, b string"


def _split(run: DataFrame, prefs: DataFrame, docs: DataFrame | None, sizes: DataFrame | None = None):
    return TP.split_topics(prefs, run) if docs is None else TP.split_docs(docs, sizes)


def _joined(split, prefs: DataFrame, run: DataFrame, docs: DataFrame | None, inside, spread) -> DataFrame:
    """``inside(rows)`` of the small topics and ``spread(prefs, run)`` of the others, if there are any."""
    small, large = split
    out = inside(TP.topic_rows(small(prefs), small(run)) if docs is None else TP.doc_rows(small(docs)))
    return out if large is None else out.unionByName(spread(large(prefs), large(run)))


def _spread_positions(run: DataFrame, prefs: DataFrame, max_docs: int | None = None, split_rows: int | None = None) -> DataFrame:
    from ranklens.session import checkpoint_dir

    checkpoint_dir(prefs.sparkSession)
    r = normalize_run(run)
    judged = prefs.select("qid", "docno").distinct()
    r = r.join(judged.select("qid").distinct(), "qid", "left_semi").select("run_id", "qid", "docno", "sim")
    r = add_rank(r, docno_desc=False, split_rows=split_rows)
    if max_docs is not None:
        r = r.where(F.col("rank") <= max_docs)
    runs_topics = r.select("run_id", "qid").distinct()
    docs = judged.join(runs_topics, "qid")  # judged documents of every (run, topic)
    d = docs.join(r.select("run_id", "qid", "docno", "rank"), ["run_id", "qid", "docno"], "left").checkpoint()
    # retrieved documents by rank, then the others (a null score is last) by docno
    d = add_rank(d.select("run_id", "qid", "docno", F.col("rank").isNotNull().alias("ret"), (-F.col("rank")).cast("double").alias("sim")), docno_desc=False, split_rows=split_rows)
    return d.select("run_id", "qid", "docno", "ret", (F.col("rank") - 1).alias("pos")).checkpoint()


def _group_docs(prefs: DataFrame, pos: DataFrame, split_rows: int | None = None) -> DataFrame:
    """(run_id, qid, jg, docno, lvl, ret, pos, nsub, pr, lr), one row per document of a group, kept as a table.

    ``pr`` and ``lr`` number the row's range in the order of positions and in
    that of (level, position) of all groups: most groups lie in one range of
    each, a large group in several.
    """
    nsub = prefs.groupBy("qid", "jg").agg(F.countDistinct("jsg").alias("nsub"))
    docs = prefs.groupBy("qid", "jg", "docno").agg(F.max("rel_level").cast("double").alias("lvl"))
    gd = docs.join(nsub, ["qid", "jg"]).join(pos, ["qid", "docno"]).checkpoint()
    group = F.concat(F.col("qid"), F.lit("\x01"), F.col("jg"))
    by_pos = range_of(gd, False, split_rows, (F.col("run_id"), group, -F.col("pos"), F.lit("")))
    by_level = range_of(gd, False, split_rows, (F.col("run_id"), group, -F.col("lvl"), F.lpad(F.col("pos").cast("string"), 19, "0")))
    return gd.withColumns({"pr": by_pos, "lr": by_level}).checkpoint()


# ------------------------------------------------------------------ validation


def validate_prefs(prefs: DataFrame) -> DataFrame:
    """Problems that make preferences inconsistent: (qid, jg, docno, problem).

    * a document with two levels in one sub-group;
    * a document judged 0 in one sub-group and non-0 in another of its group;
    * a document in a cycle of preferences (or between two), see :func:`cyclic_docs`.
    """
    small, large = TP.split_topics(prefs)
    out = TP.in_tasks(TP.topic_rows(small(prefs)), TP.faults, "qid string, jg string, docno string, problem string")
    return out if large is None else out.unionByName(_spread_faults(large(prefs)))


def _spread_faults(prefs: DataFrame) -> DataFrame:
    """:func:`validate_prefs` by aggregations over all judgments."""
    two = (
        prefs.groupBy("qid", "jg", "jsg", "docno")
        .agg(F.countDistinct("rel_level").alias("n"))
        .where(F.col("n") > 1)
        .select("qid", "jg", "docno", F.lit("two levels in a sub-group").alias("problem"))
    )
    zero = (
        prefs.groupBy("qid", "jg", "docno")
        .agg(F.min("rel_level").alias("lo"), F.max("rel_level").alias("hi"))
        .where((F.col("lo") == 0) & (F.col("hi") > 0))
        .select("qid", "jg", "docno", F.lit("zero and non-zero level in a group").alias("problem"))
    )
    cyclic = cyclic_docs(prefs).select("qid", "jg", "docno", F.lit("in a cycle of preferences").alias("problem"))
    return two.unionByName(zero).unionByName(cyclic)


def cyclic_docs(prefs: DataFrame) -> DataFrame:
    """(qid, jg, docno) of documents on a cycle of preferences or on a way from one cycle to another.

    The preference graph is peeled without making its edges: nothing is
    preferred to a document that has the highest level left in every sub-group
    where it is judged, and it is preferred to nothing if it has the lowest in
    each.  Both kinds can't lie on a cycle and go; what stays when none goes is
    the answer.  A round is two aggregations over the judgments left, and a
    group of one sub-group, where no document has two levels, is never looked at.
    """
    from ranklens.session import checkpoint_dir

    checkpoint_dir(prefs.sparkSession)
    group, sub = ["qid", "jg"], ["qid", "jg", "jsg"]
    rows = prefs.select(*sub, "docno", F.col("rel_level").cast("double").alias("level")).distinct()
    judged = rows.groupBy(*group).agg(F.countDistinct("jsg").alias("n_sub"), F.count(F.lit(1)).alias("n"), F.countDistinct("docno").alias("n_docs"))
    suspect = judged.where((F.col("n_sub") > 1) | (F.col("n") > F.col("n_docs"))).select(*group)
    left = rows.join(suspect, group, "left_semi").checkpoint()
    n = left.count()
    while n:
        ends = left.groupBy(*sub).agg(F.max("level").alias("hi"), F.min("level").alias("lo"))
        docs = left.join(ends, sub).groupBy(*group, "docno").agg(F.min((F.col("level") == F.col("hi")).cast("int")).alias("top"), F.min((F.col("level") == F.col("lo")).cast("int")).alias("bottom"))
        left = left.join(docs.where("top = 0 and bottom = 0").select(*group, "docno"), [*group, "docno"], "left_semi").checkpoint()
        before, n = n, left.count()
        if n == before:
            break
    return left.select(*group, "docno").distinct()


# ------------------------------------------------------------------ edges and closure (several sub-groups)


def pref_edges(prefs: DataFrame, only_multi: bool = True) -> DataFrame:
    """(qid, jg, a, b): a ≻ b inside a sub-group; by default only groups with several sub-groups."""
    small, large = TP.split_topics(prefs)
    out = TP.in_tasks(TP.topic_rows(small(prefs).where(F.col("qid").isNotNull())), partial(TP.group_edges, only_multi=only_multi), _EDGES)
    return out if large is None else out.unionByName(_spread_edges(large(prefs), only_multi))


def _spread_edges(prefs: DataFrame, only_multi: bool = True) -> DataFrame:
    """:func:`pref_edges` by a join inside the sub-groups."""
    p = prefs
    if only_multi:
        multi = prefs.groupBy("qid", "jg").agg(F.countDistinct("jsg").alias("n")).where(F.col("n") > 1)
        p = prefs.join(multi.select("qid", "jg"), ["qid", "jg"], "left_semi")
    a = p.select("qid", "jg", "jsg", F.col("docno").alias("a"), F.col("rel_level").alias("la"))
    b = p.select("qid", "jg", "jsg", F.col("docno").alias("b"), F.col("rel_level").alias("lb"))
    return a.join(b, ["qid", "jg", "jsg"]).where(F.col("la") > F.col("lb")).select("qid", "jg", "a", "b").distinct()


def pref_closure(edges: DataFrame) -> DataFrame:
    """Transitive closure of the edges within each (qid, jg), kept as written where groups are counted.

    Groups of at most ``topics.SMALL_TOPIC`` edges are closed inside tasks, the others by :func:`_spread_closure`.
    """
    kept = written(edges.select("qid", "jg", "a", "b"), "edges")
    small, large = TP.split_topics(kept, keys=("qid", "jg"))
    whole = small(kept).repartition("qid", "jg").sortWithinPartitions("qid", "jg")
    out = TP.in_tasks(whole, TP.closed_edges, _EDGES, keys=("qid", "jg"))
    return out if large is None else out.unionByName(_spread_closure(large(kept)))


def _spread_closure(edges: DataFrame) -> DataFrame:
    """Transitive closure of the edges within each (qid, jg), semi-naive.

    Round k joins only the edges found in round k-1 with the base edges and
    keeps what is new (anti join against everything found so far), so no
    path is derived twice.  Every round's delta is checkpointed to the shared
    checkpoint folder (reliable: survives executor loss, cuts lineage); the
    loop ends when a round finds nothing new.
    """
    from ranklens.session import checkpoint_dir

    checkpoint_dir(edges.sparkSession)
    base = edges.select("qid", "jg", "a", "b").distinct().checkpoint()
    step = base.select("qid", "jg", F.col("a").alias("m"), F.col("b").alias("b2"))
    found = base
    delta = base
    while True:
        d = delta.select("qid", "jg", "a", F.col("b").alias("m"))
        nxt = d.join(step, ["qid", "jg", "m"]).select("qid", "jg", "a", F.col("b2").alias("b")).distinct()
        nxt = nxt.join(found, ["qid", "jg", "a", "b"], "left_anti").checkpoint()
        if nxt.isEmpty():
            break
        found = found.unionByName(nxt)
        delta = nxt
    return found


# ------------------------------------------------------------------ counts per group


def _larger_before(segment: np.ndarray, level: np.ndarray) -> np.ndarray:
    """For each row, in order of segments and places: how many earlier rows of its segment have a larger level.

    Merge counting, all segments at once: two rows of a segment are compared
    at the one bit of their places where they part, left half with right half.
    """
    n = len(level)
    out = np.zeros(n, np.int64)
    if not n:
        return out
    starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
    lengths = np.diff(np.r_[starts, n])
    place = np.arange(n) - np.repeat(starts, lengths)
    number = np.repeat(np.arange(len(starts)), lengths)
    for bit in range(int(lengths.max() - 1).bit_length()):
        half = place >> bit
        left = (half & 1) == 0
        order = np.lexsort((left, -level, half >> 1, number))  # equal levels: the right half first
        sorted_left = left[order]
        seen = np.cumsum(sorted_left) - sorted_left
        fresh = np.r_[True, (number[order][1:] != number[order][:-1]) | ((half[order] >> 1)[1:] != (half[order] >> 1)[:-1])]
        base = np.maximum.accumulate(np.where(fresh, seen, 0))
        out[order] += np.where(sorted_left, 0, seen - base)
    return out


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(run_id, qid, jg, ful, ful_rel) of each segment of rows sorted by (run_id, qid, jg, seg) and place."""
    names = ["run_id", "qid", "jg", "seg", "lvl"]

    def counted(table: pa.Table) -> pa.RecordBatch:
        keys = [table[c].cast(pa.string()) for c in names[:4]]
        codes = [k.combine_chunks().dictionary_encode().indices.to_numpy() for k in keys]
        fresh = np.zeros(table.num_rows, bool)
        fresh[0] = True
        for c in codes:
            fresh[1:] |= c[1:] != c[:-1]
        segment = np.cumsum(fresh) - 1
        level = table["lvl"].to_numpy()
        more = _larger_before(segment, level)
        ful = np.zeros(segment[-1] + 1, np.int64)
        rel = ful.copy()
        np.add.at(ful, segment, more)
        np.add.at(rel, segment, np.where(level > 0, more, 0))
        heads = table.take(pa.array(np.flatnonzero(fresh))).combine_chunks()
        return pa.RecordBatch.from_arrays([*(heads[c].combine_chunks() for c in names[:3]), pa.array(ful), pa.array(rel)], [*names[:3], "ful", "ful_rel"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and any(batch.column(c)[0] != held[-1].column(c)[held[-1].num_rows - 1] for c in names[:4]):
            yield counted(pa.Table.from_batches(held))
            held = []
        # the batch's last segment may go on in the next batch, all before it is whole
        ends = np.ones(batch.num_rows, bool)
        for c in names[:4]:
            ends &= pc.equal(batch.column(c), batch.column(c)[batch.num_rows - 1]).to_numpy(zero_copy_only=False)
        other = np.flatnonzero(~ends)
        if len(other):
            cut = int(other[-1]) + 1
            yield counted(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield counted(pa.Table.from_batches(held))


def _local(rows: DataFrame, seg: str, order: list[str]) -> DataFrame:
    """Fulfilled pairs inside each (group, range)."""
    dealt = rows.select(*G, F.col(seg).cast("int").alias("seg"), "pos", "pr", "lvl").repartition(*G, "seg").sortWithinPartitions(*G, "seg", *order)
    return dealt.select(*G, "seg", "lvl").mapInArrow(_crossed, "run_id string, qid string, jg string, ful long, ful_rel long")


def _fulfilled(ret: DataFrame) -> DataFrame:
    """(group, ful_ret, ful_ret_rel): retrieved pairs in the order of their levels, and those whose lower one is relevant.

    Two documents of a group meet once: in one range of positions (counted
    there), else in one range of levels (counted there, pairs of one range of
    positions never count), else through the table of their ranges, where the
    documents of all earlier position ranges and higher level ranges add up.
    """
    parts = [_local(ret, "pr", ["pos"])]
    spread = ret.groupBy(*G).agg(F.min("pr").alias("a"), F.max("pr").alias("b")).where("a < b").select(*G)  # one group a boundary at most
    wide = ret.join(spread, G, "left_semi")
    parts.append(_local(wide, "lr", ["pr", "lvl"]))
    cells = wide.groupBy(*G, "pr", "lr").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("lvl") > 0).cast("long")).alias("n_rel"))
    grid = cells.select(*G, "pr").distinct().join(cells.select(*G, "lr").distinct(), G).join(cells, [*G, "pr", "lr"], "left").fillna(0, ["n", "n_rel"])
    earlier = Window.partitionBy(*G, "lr").orderBy("pr").rowsBetween(Window.unboundedPreceding, -1)
    higher = Window.partitionBy(*G, "pr").orderBy(F.desc("lr")).rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumn("above", F.coalesce(F.sum("before").over(higher), F.lit(0)))
    parts.append(grid.select(*G, (F.col("n") * F.col("above")).alias("ful"), (F.col("n_rel") * F.col("above")).alias("ful_rel")))
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return union.groupBy(*G).agg(F.sum("ful").alias("ful_ret"), F.sum("ful_rel").alias("ful_ret_rel"))


def _level_counts(gd: DataFrame) -> DataFrame:
    """Counts for one-sub-group groups without materialising pairs."""
    lv = gd.groupBy(*G, "lvl").agg(
        F.sum(F.col("ret").cast("long")).alias("r_l"), F.sum((~F.col("ret")).cast("long")).alias("u_l"), (-F.min("lr")).alias("bucket")
    )
    # documents of higher levels: inside the level's range, and in the ranges of higher levels
    w = Window.partitionBy(*G, "bucket").orderBy(F.col("lvl").desc()).rowsBetween(Window.unboundedPreceding, -1)
    lv = lv.withColumns({"R_in": F.coalesce(F.sum("r_l").over(w), F.lit(0)), "U_in": F.coalesce(F.sum("u_l").over(w), F.lit(0))})
    heads = prefix_sums(lv.groupBy(*G, "bucket").agg(F.sum("r_l").alias("r"), F.sum("u_l").alias("u")), G, ["r", "u"]).drop("r", "u")
    lv = lv.join(heads, [*G, "bucket"]).withColumns({"R_above": F.col("R_in") + F.col("off_r"), "U_above": F.col("U_in") + F.col("off_u")})
    rel = F.col("lvl") > 0
    base = lv.groupBy(*G).agg(
        F.sum(F.col("r_l") * F.col("R_above")).alias("poss_ret"),
        F.sum(F.col("r_l") * F.col("U_above") + F.col("u_l") * F.col("R_above")).alias("poss_imp"),
        F.sum(F.col("u_l") * F.col("R_above")).alias("ful_imp"),
        F.sum(F.col("u_l") * F.col("U_above")).alias("poss_notoccur"),
        F.sum(F.when(rel, F.col("r_l") * F.col("R_above"))).alias("poss_ret_rel"),
        F.sum(F.when(rel, (F.col("r_l") + F.col("u_l")) * (F.col("R_above") + F.col("U_above")))).alias("poss_rel"),
        F.sum(F.when(rel, F.col("u_l") * F.col("R_above"))).alias("ful_imp_rel"),
    )
    out = base.join(_fulfilled(gd.where(F.col("ret"))), G, "left")
    return out.fillna(0, ["ful_ret", "ful_ret_rel", "poss_ret_rel", "poss_rel", "ful_imp_rel"])


def _doc_rows(gd: DataFrame) -> DataFrame:
    """The documents with running counts along their group's positions and its totals of relevant documents."""
    marks = {"is_ret": F.col("ret"), "nonrel": F.col("lvl") == 0, "ret_nonrel": (F.col("lvl") == 0) & F.col("ret")}
    totals = {"n_rel": F.col("lvl") > 0, "n_rel_ret": (F.col("lvl") > 0) & F.col("ret")}
    d = gd.withColumns({k: v.cast("long") for k, v in marks.items()})
    heads = d.groupBy(*G, "pr").agg(*(F.sum(k).alias(k) for k in marks), *(F.sum(v.cast("long")).alias(k) for k, v in totals.items()))
    heads = prefix_sums(heads, G, list(marks), "pr")
    heads = heads.select(*G, "pr", *(f"off_{k}" for k in marks), *(F.sum(k).over(Window.partitionBy(*G)).alias(k) for k in totals))
    w = Window.partitionBy(*G, "pr").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({f"c_{k}": F.sum(k).over(w) for k in marks}).join(heads, [*G, "pr"])
    running = {k: F.col(f"c_{k}") + F.col(f"off_{k}") for k in marks}
    return d.withColumns({
        "ret_before": running["is_ret"] - F.col("is_ret"),
        "nonrel_idx": F.when(F.col("nonrel") == 1, running["nonrel"]),
        "ret_nonrel_idx": F.when(F.col("ret_nonrel") == 1, running["ret_nonrel"]),
    })


def _doc_counts(gd: DataFrame) -> DataFrame:
    """num_rel / num_nonrel (and retrieved versions) plus the recount terms of the Rnonrel measures."""
    nonrel = F.col("lvl") == 0
    return _doc_rows(gd).groupBy(*G).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.col("ret").cast("long")).alias("n_ret"),
        F.max("n_rel").alias("num_rel"),
        F.sum(nonrel.cast("long")).alias("num_nonrel"),
        F.max("n_rel_ret").alias("num_rel_ret"),
        F.sum((nonrel & F.col("ret")).cast("long")).alias("num_nonrel_ret"),
        # first num_rel nonrelevant documents by position (any retrieval state)
        F.sum(F.when(F.col("nonrel_idx") <= F.col("n_rel"), F.col("ret_before"))).alias("ful_kept"),
        # first num_rel_ret nonrelevant documents, retrieved ones only
        F.sum(F.when((F.col("nonrel_idx") <= F.col("n_rel_ret")) & F.col("ret"), F.col("ret_before"))).alias("ful_kept_ret"),
        F.sum(F.when((F.col("nonrel_idx") <= F.col("n_rel_ret")) & F.col("ret"), 1)).alias("n_kept_ret"),
    )


def _edge_counts(closure: DataFrame, gd: DataFrame) -> DataFrame:
    """Counts of groups with several sub-groups from their closed edge set."""
    # Rnonrel recount: nonrelevant documents beyond the first num_rel (by position) are dropped
    d = _doc_rows(gd).select(
        *G, "docno", "ret", "pos",
        F.coalesce(F.col("nonrel_idx") > F.col("n_rel"), F.lit(False)).alias("drop_all"),
        F.coalesce(F.col("ret_nonrel_idx") > F.col("n_rel"), F.lit(False)).alias("drop_ret"),
    )

    def side(x: str) -> DataFrame:
        return d.select(*G, F.col("docno").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("ret", "pos", "drop_all", "drop_ret")))

    e = closure.join(side("a"), ["qid", "jg", "a"]).join(side("b"), [*G, "b"])
    ful = F.col("ret_a") & (F.col("pos_a") < F.col("pos_b"))
    both = F.col("ret_a") & F.col("ret_b")
    one = F.col("ret_a") != F.col("ret_b")
    keep = ~F.col("drop_all_a") & ~F.col("drop_all_b")
    keep_r = ~F.col("drop_ret_a") & ~F.col("drop_ret_b")
    return e.groupBy(*G).agg(
        F.sum(both.cast("long")).alias("poss_ret"),
        F.sum((both & ful).cast("long")).alias("ful_ret"),
        F.sum(one.cast("long")).alias("poss_imp"),
        F.sum((one & F.col("ret_a")).cast("long")).alias("ful_imp"),
        F.sum((~F.col("ret_a") & ~F.col("ret_b")).cast("long")).alias("poss_notoccur"),
        F.sum(keep.cast("long")).alias("rc_poss"),
        F.sum((keep & ful).cast("long")).alias("rc_ful"),
        F.sum((keep_r & both).cast("long")).alias("rcr_poss"),
        F.sum((keep_r & both & ful).cast("long")).alias("rcr_ful"),
    )


def pref_counts(
    run: DataFrame, prefs: DataFrame, max_docs: int | None = None, closure: DataFrame | None = None, pos: DataFrame | None = None,
    split_rows: int | None = None, split=None, docs: DataFrame | None = None, sizes: DataFrame | None = None,
) -> DataFrame:
    """Per (run_id, qid, jg): fulfilled / possible preferences by class and the Rnonrel recounts.

    Topics are split by size (``split``, see ``topics.split_topics``) unless ``closure``, ``pos`` or ``split_rows`` is given.
    ``docs``: the rows of both by document, see ``topics.doc_rows``; ``sizes``: see ``topics.split_docs``.
    """
    if closure is None and pos is None and split_rows is None:
        inside = lambda rows: TP.in_tasks(rows, partial(TP.list_counts, max_docs=max_docs), _COUNTS)
        return _joined(split or _split(run, prefs, docs, sizes), prefs, run, docs, inside, lambda p, r: _spread_counts(r, p, max_docs))
    return _spread_counts(run, prefs, max_docs, closure, pos, split_rows)


def _spread_counts(
    run: DataFrame, prefs: DataFrame, max_docs: int | None = None, closure: DataFrame | None = None, pos: DataFrame | None = None,
    split_rows: int | None = None,
) -> DataFrame:
    pos = _spread_positions(run, prefs, max_docs, split_rows) if pos is None else pos
    gd = _group_docs(prefs, pos, split_rows)
    one = gd.where(F.col("nsub") == 1)
    multi = gd.where(F.col("nsub") > 1)
    dc = _doc_counts(gd)
    lc = _level_counts(one)
    # one sub-group recounts (equivalence-class form, including its pairing of
    # nonrelevant documents with the kept ones)
    lc = lc.join(dc, G)
    lc = lc.select(
        *G,
        "poss_ret", "ful_ret", "poss_imp", "ful_imp", "poss_notoccur",
        "num_rel", "num_nonrel", "num_rel_ret", "num_nonrel_ret",
        (F.col("ful_ret_rel") + F.col("ful_imp_rel") + F.coalesce(F.col("ful_kept"), F.lit(0))).alias("rc_ful"),
        (F.col("poss_rel") + F.col("n_docs") * F.col("num_rel")).alias("rc_poss"),
        (F.col("ful_ret_rel") + F.coalesce(F.col("ful_kept_ret"), F.lit(0))).alias("rcr_ful"),
        (F.col("poss_ret_rel") + F.col("n_ret") * F.coalesce(F.col("n_kept_ret"), F.lit(0))).alias("rcr_poss"),
    )
    if closure is None:
        closure = _spread_closure(_spread_edges(prefs, only_multi=True))
    ec = _edge_counts(closure, multi)
    ec = multi.select(*G).distinct().join(ec, G, "left").fillna(0).join(dc, G)
    ec = ec.select(*lc.columns)
    return lc.unionByName(ec)


# ------------------------------------------------------------------ pair counts across groups


def pair_counts(
    run: DataFrame, prefs: DataFrame, max_docs: int | None = None, closure: DataFrame | None = None, pos: DataFrame | None = None, split=None,
    docs: DataFrame | None = None, sizes: DataFrame | None = None,
) -> DataFrame:
    """(run_id, qid, x, y, n_xy, n_yx, rx, ry) for topics with several judgment groups.

    ``n_xy`` = number of groups preferring x to y.  Pairs are materialised only
    for topics with more than one judgment group (the pair measures of a
    single-group topic follow from :func:`pref_counts`).  Topics are split by
    size unless ``closure`` or ``pos`` is given.  ``docs``: the rows of both by
    document, see ``topics.doc_rows``; ``sizes``: see ``topics.split_docs``.
    """
    if closure is None and pos is None:
        inside = lambda rows: TP.in_tasks(rows, partial(TP.list_pairs, max_docs=max_docs), _PAIRS)
        return _joined(split or _split(run, prefs, docs, sizes), prefs, run, docs, inside, lambda p, r: _spread_pairs(r, p, max_docs))
    return _spread_pairs(run, prefs, max_docs, closure, pos)


def _spread_pairs(
    run: DataFrame, prefs: DataFrame, max_docs: int | None = None, closure: DataFrame | None = None, pos: DataFrame | None = None
) -> DataFrame:
    multi_jg = prefs.groupBy("qid").agg(F.countDistinct("jg").alias("njg")).where(F.col("njg") > 1)
    p = prefs.join(multi_jg.select("qid"), "qid", "left_semi")
    nsub = p.groupBy("qid", "jg").agg(F.countDistinct("jsg").alias("nsub"))
    single = p.join(nsub.where(F.col("nsub") == 1).select("qid", "jg"), ["qid", "jg"], "left_semi")
    e1 = _spread_edges(single, only_multi=False)
    e2 = _spread_closure(_spread_edges(p, only_multi=True)) if closure is None else closure.join(multi_jg.select("qid"), "qid", "left_semi")
    edges = e1.unionByName(e2)
    cnt = edges.groupBy("qid", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    pos = _spread_positions(run, prefs, max_docs) if pos is None else pos
    # orient each unordered pair with x = the earlier position
    pa = pos.select("run_id", "qid", F.col("docno").alias("a"), F.col("pos").alias("pa"), F.col("ret").alias("ra"))
    pb = pos.select("run_id", "qid", F.col("docno").alias("b"), F.col("pos").alias("pb"), F.col("ret").alias("rb"))
    c = cnt.join(pa, ["qid", "a"]).join(pb, ["run_id", "qid", "b"])
    fwd = F.col("pa") < F.col("pb")
    c = c.select(
        "run_id", "qid",
        F.when(fwd, F.col("a")).otherwise(F.col("b")).alias("x"),
        F.when(fwd, F.col("b")).otherwise(F.col("a")).alias("y"),
        F.when(fwd, F.col("n")).otherwise(0).alias("n_xy"),
        F.when(fwd, 0).otherwise(F.col("n")).alias("n_yx"),
        F.when(fwd, F.col("ra")).otherwise(F.col("rb")).alias("rx"),
        F.when(fwd, F.col("rb")).otherwise(F.col("ra")).alias("ry"),
    )
    return c.groupBy("run_id", "qid", "x", "y").agg(
        F.sum("n_xy").alias("n_xy"), F.sum("n_yx").alias("n_yx"), F.max("rx").alias("rx"), F.max("ry").alias("ry")
    )


# ------------------------------------------------------------------ measures


def _ratio(a, b):
    return F.when(b != 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def pref_measures(run: DataFrame, prefs: DataFrame, max_docs: int | None = None, measures=None, docs: DataFrame | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """Per-topic values ``(run_id, qid, measure, value)`` of the 14 preference measures.

    ``docs``: the rows of both by document, see ``topics.doc_rows``; ``sizes``: see ``topics.split_docs``.
    """
    from ranklens.functions import catalog as C

    wanted = [m.name for m in C.expand(measures or "all_prefs") if m.name in C.PREF_MEASURES]
    split = _split(run, prefs, docs, sizes)
    c = pref_counts(run, prefs, max_docs, split=split, docs=docs)
    poss = F.col("poss_ret") + F.col("poss_imp") + F.col("poss_notoccur")
    ful = F.col("ful_ret") + F.col("ful_imp")
    R, N = F.col("num_rel"), F.col("num_nonrel")
    Rr, Nr = F.col("num_rel_ret"), F.col("num_nonrel_ret")
    # Rnonrel: ratio per group; a 0/0 ratio poisons the topic (value 0), as NaN does in the reference
    rn_ful = F.when(R >= N, ful + Rr * (R - N)).otherwise(F.col("rc_ful"))
    rn_poss = F.when(R >= N, poss + R * (R - N)).otherwise(F.col("rc_poss"))
    rr_ful = F.when(Rr >= Nr, F.col("ful_ret") + Rr * (Rr - Nr)).otherwise(F.col("rcr_ful"))
    rr_poss = F.when(Rr >= Nr, F.col("poss_ret") + R * (Rr - Nr)).otherwise(F.col("rcr_poss"))
    g = c.select(
        "run_id", "qid", "jg", poss.alias("poss"), ful.alias("ful"), "ful_ret", "poss_ret",
        (F.col("poss_ret") + F.col("poss_imp")).alias("poss_ri"),
        _ratio(ful, poss).alias("r_all"),
        _ratio(F.col("ful_ret"), F.col("poss_ret")).alias("r_ret"),
        _ratio(ful, F.col("poss_ret") + F.col("poss_imp")).alias("r_imp"),
        _ratio(rn_ful, rn_poss).alias("r_rn"), (rn_poss == 0).alias("nan_rn"),
        _ratio(rr_ful, rr_poss).alias("r_rnr"), (rr_poss == 0).alias("nan_rnr"),
    )
    t = g.groupBy("run_id", "qid").agg(
        F.count(F.lit(1)).alias("njg"),
        F.sum("poss").alias("poss"), F.sum("ful").alias("ful"), F.sum("ful_ret").alias("ful_ret"),
        F.sum("poss_ret").alias("poss_ret"), F.sum("poss_ri").alias("poss_ri"),
        F.sum("r_all").alias("s_all"), F.sum("r_ret").alias("s_ret"), F.sum("r_imp").alias("s_imp"),
        F.sum("r_rn").alias("s_rn"), F.max(F.col("nan_rn").cast("int")).alias("nan_rn"),
        F.sum("r_rnr").alias("s_rnr"), F.max(F.col("nan_rnr").cast("int")).alias("nan_rnr"),
    )
    avg = lambda s: F.when(F.col(s) > 0, F.col(s) / F.col("njg")).otherwise(0.0)
    vals = {
        "prefs_num_prefs_poss": F.col("poss").cast("double"),
        "prefs_num_prefs_ful": F.col("ful").cast("double"),
        "prefs_num_prefs_ful_ret": F.col("ful_ret").cast("double"),
        "prefs_simp": _ratio(F.col("ful"), F.col("poss")),
        "prefs_simp_ret": _ratio(F.col("ful_ret"), F.col("poss_ret")),
        "prefs_simp_imp": _ratio(F.col("ful"), F.col("poss_ri")),
        "prefs_avgjg": avg("s_all"),
        "prefs_avgjg_ret": avg("s_ret"),
        "prefs_avgjg_imp": avg("s_imp"),
        "prefs_avgjg_Rnonrel": F.when(F.col("nan_rn") == 1, 0.0).otherwise(avg("s_rn")),
        "prefs_avgjg_Rnonrel_ret": F.when(F.col("nan_rnr") == 1, 0.0).otherwise(avg("s_rnr")),
    }
    pair_names = [m for m in ("prefs_pair", "prefs_pair_ret", "prefs_pair_imp") if m in wanted]
    if pair_names:
        # single-group topics: every preferred pair has share 1 (fulfilled) or 0
        vals["prefs_pair"] = _ratio(F.col("ful"), F.col("poss"))
        vals["prefs_pair_ret"] = _ratio(F.col("ful_ret"), F.col("poss_ret"))
        vals["prefs_pair_imp"] = _ratio(F.col("ful"), F.col("poss_ri"))
    keep = [m for m in wanted if m in vals]
    out = t.select("run_id", "qid", "njg", F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), vals[m].alias("value")) for m in keep])))
    if pair_names:
        pc = pair_counts(run, prefs, max_docs, split=split, docs=docs)
        share = F.col("n_xy") / (F.col("n_xy") + F.col("n_yx"))
        pm = pc.groupBy("run_id", "qid").agg(
            F.sum(F.when(F.col("rx"), share).otherwise(0.0)).alias("s"),
            F.count(F.lit(1)).alias("n_all"),
            F.sum(F.when(F.col("rx"), 1).otherwise(0)).alias("n_imp"),
            F.sum(F.when(F.col("rx") & F.col("ry"), share).otherwise(0.0)).alias("s_ret"),
            F.sum(F.when(F.col("rx") & F.col("ry"), 1).otherwise(0)).alias("n_ret"),
        )
        pv = {
            "prefs_pair": _ratio(F.col("s"), F.col("n_all")),
            "prefs_pair_imp": _ratio(F.col("s"), F.col("n_imp")),
            "prefs_pair_ret": _ratio(F.col("s_ret"), F.col("n_ret")),
        }
        multi = pm.select("run_id", "qid", F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), pv[m].alias("value")) for m in pair_names])))
        out = out.join(multi.withColumnRenamed("value", "_mv"), ["run_id", "qid", "measure"], "left")
        is_pair = F.col("measure").isin(*pair_names) & (F.col("njg") > 1)
        out = out.withColumn("value", F.when(is_pair, F.coalesce(F.col("_mv"), F.lit(0.0))).otherwise(F.col("value"))).drop("_mv")
    return out.drop("njg")
