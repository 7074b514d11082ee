"""Per-topic effectiveness measures over a ranked list.

Shape of the plan: judgments are aggregated once per topic (relevant count,
judged nonrelevant count, ideal gain curve); the ranked list gets one window
pass (all running sums share one sort per topic) and then **one** wide
``groupBy(run_id, qid)`` computes every requested measure as conditional
aggregates.  The wide row is turned into the long form
``(run_id, qid, measure, value)`` with an ``explode`` of literal-named structs,
so measure names with dots or ``=`` never become column names.

Only the expressions of requested measures are planned; the per-position
ideal join (G, ndcg_rel, Rndcg) is added only when one of them is requested.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklens.functions import catalog as C
from ranklens.functions.exact import exact_sum
from ranklens.operators.ranked import REL_NONPOOL, REL_UNJUDGED

_W_RUN = ("run_id", "qid")


# ---------------------------------------------------------------- gains / ideal


def gain_column(rel: Column, gains: dict | None) -> Column:
    """Gain of a relevance level: explicit ``level=gain`` pairs, else the level (>= 0), else 0."""
    e = None
    for lv, g in sorted((gains or {}).items()):
        cond = rel == F.lit(int(lv))
        e = F.when(cond, F.lit(float(g))) if e is None else e.when(cond, F.lit(float(g)))
    default = F.when(rel >= 0, rel.cast("double")).otherwise(F.lit(0.0))
    return default if e is None else e.otherwise(default)


IDEAL_SUB_BUCKETS = 16


def ideal_positions(qrels: DataFrame, gains: dict | None = None, qkeys=("qid",)) -> DataFrame:
    """Ideal ranking per topic: judged documents with positive gain, best first.

    Columns: qid, pos, igain, cum_idcg, cum_cost (running sum of max(gain, 1)),
    is_boundary (last position of a block of equal gain).

    Inside a block of equal gain the order of documents does not change any
    value at any position, so each block is split into hash sub-buckets of
    its documents: positions are bucket offsets plus a row number inside the
    (topic, gain, sub-bucket) window — no task holds a whole topic.
    """
    from ranklens.operators.ranked import bucket_offsets

    qkeys = list(qkeys)
    q = qrels.where(F.col("rel") >= 0).select(*qkeys, "docno", gain_column(F.col("rel"), gains).alias("igain"))
    q = q.where(F.col("igain") > 0)
    q = q.withColumn("bucket", F.struct((-F.col("igain")).alias("g"), F.pmod(F.xxhash64("docno"), F.lit(IDEAL_SUB_BUCKETS)).alias("h")))
    w_in = Window.partitionBy(*qkeys, "bucket").orderBy("docno")
    q = q.withColumn("_in", F.row_number().over(w_in))
    q = q.join(bucket_offsets(q, qkeys), [*qkeys, "bucket"])
    q = q.withColumn("pos", F.col("_off_n") + F.col("_in"))
    q = q.withColumn("_t_idcg", F.col("igain") / F.log2(F.col("pos") + 1)).withColumn("_t_cost", F.greatest(F.col("igain"), F.lit(1.0)))
    wc = w_in.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    q = q.withColumn("_c_idcg", F.sum("_t_idcg").over(wc)).withColumn("_c_cost", F.sum("_t_cost").over(wc))
    q = q.drop("_off_n").join(bucket_offsets(q, qkeys, "bucket", ["_t_idcg", "_t_cost"]), [*qkeys, "bucket"])
    level_end = q.groupBy(*qkeys, "igain").agg(F.max("pos").alias("_end"))
    q = q.join(level_end, [*qkeys, "igain"])
    return q.select(
        *qkeys,
        "pos",
        "igain",
        (F.col("_off__t_idcg") + F.col("_c_idcg")).alias("cum_idcg"),
        (F.col("_off__t_cost") + F.col("_c_cost")).alias("cum_cost"),
        (F.col("pos") == F.col("_end")).alias("is_boundary"),
    )


def _needs(ms: list[C.Measure], *names: str) -> bool:
    return any(m.name in names for m in ms)


def _gains_of(ms: list[C.Measure]) -> dict:
    """Gain pairs of the gain-family measures (they share one ideal curve)."""
    seen = None
    for m in ms:
        if m.name in ("ndcg", "ndcg_rel", "Rndcg", "G"):
            g = dict(m.params or {})
            if seen is None:
                seen = g
            elif seen != g:
                raise ValueError("gain-family measures in one request must use the same gains")
    return seen or {}


def topic_curves(qrels: DataFrame, ms: list[C.Measure], qkeys=("qid",)) -> DataFrame | None:
    """One row per topic with what its ideal ranking adds up to, if a requested measure needs it."""
    return _with_curves(None, qrels, ms, list(qkeys))


def topic_judgments(qrels: DataFrame, ms: list[C.Measure], level: int = 1, qkeys=("qid",)) -> DataFrame:
    """One row per judged topic with every judgment-side quantity the measures need."""
    qkeys = list(qkeys)
    base = qrels.groupBy(*qkeys).agg(
        F.sum(F.when(F.col("rel") >= level, 1).otherwise(0)).cast("long").alias("R"),
        F.sum(F.when((F.col("rel") >= 0) & (F.col("rel") < level), 1).otherwise(0)).cast("long").alias("N"),
    )
    return _with_curves(base, qrels, ms, qkeys)


def _with_curves(base: DataFrame | None, qrels: DataFrame, ms: list[C.Measure], qkeys: list[str]) -> DataFrame | None:
    gain_family = _needs(ms, "ndcg", "ndcg_rel", "Rndcg", "G")
    cut = [m for m in ms if m.name == "ndcg_cut"]
    if gain_family:
        ideal = ideal_positions(qrels, _gains_of(ms), qkeys)
        agg = ideal.groupBy(*qkeys).agg(
            F.count(F.lit(1)).alias("P"),
            F.max("cum_idcg").alias("idcg_full"),
            F.sum("igain").alias("ideal_gain_sum"),
            F.max("cum_cost").alias("icost_full"),
            F.sort_array(F.collect_list(F.when(F.col("is_boundary"), F.struct(F.col("pos"), F.col("cum_idcg"))))).alias(
                "bounds"
            ),  # one entry per distinct positive gain: bounded by the number of levels
        )
        base = agg if base is None else base.join(agg, qkeys, "left")
    if cut:
        lvl = ideal_positions(qrels, None, qkeys)
        ks = cut[0].params
        lagg = lvl.groupBy(*qkeys).agg(
            *[F.sum(F.when(F.col("pos") <= k, F.col("igain") / F.log2(F.col("pos") + 1))).alias(f"idcg_cut_{k}") for k in ks]
        )
        base = lagg if base is None else base.join(lagg, qkeys, "outer" if gain_family else "left")
    return base


# ---------------------------------------------------------------- run side


def _row_columns(ranked: DataFrame, ms: list[C.Measure], level: int, keys=_W_RUN) -> DataFrame:
    """Relevance, gains and running sums of every row; a scanned list has the sums of relevance already."""
    scanned = "cum_rel" in ranked.columns
    bucketed = "bucket" in ranked.columns
    wkeys = [*keys, "bucket"] if bucketed else list(keys)
    w = Window.partitionBy(*wkeys).orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rel = F.col("rel")
    df = ranked
    sums = {}
    if not scanned:
        df = df.withColumn("is_rel", (rel >= level).cast("int"))
        df = df.withColumn("jnr", ((rel >= 0) & (rel < level)).cast("int"))
        df = df.withColumn("unj", (rel == REL_UNJUDGED).cast("int"))
        sums |= {"cum_rel": "is_rel", "cum_jnr": "jnr", "cum_unj": "unj"}
    if _needs(ms, "ndcg", "ndcg_rel", "Rndcg", "G"):
        df = df.withColumn("gain", gain_column(rel, _gains_of(ms)))
        df = df.withColumn("dcg_term", F.when(F.col("gain") != 0, F.col("gain") / F.log2(F.col("rank") + 1)).otherwise(0.0))
    if _needs(ms, "ndcg_rel", "Rndcg"):
        sums["cum_dcg"] = "dcg_term"
    if _needs(ms, "G"):
        sums["cum_gain"] = "gain"
    if not sums:
        return df
    df = df.withColumns({c: F.sum(src).over(w) for c, src in sums.items()})
    if bucketed:
        # running sums restart in every range: add the totals of the earlier ranges
        from ranklens.operators.ranked import bucket_offsets

        df = df.join(bucket_offsets(df, keys, "bucket", sums.values()), [*keys, "bucket"])
        df = df.withColumns({c: F.col(c) + F.col(f"_off_{src}") for c, src in sums.items()})
    return df


def _attach_ideal(rows: DataFrame, ideal: DataFrame, qkeys=("qid",)) -> DataFrame:
    """Ideal curve value at position min(rank, P) for every ranked row.

    Rows are joined by their own rank, so those beyond the curve don't share
    a key; they take its last value from the topic.
    """
    ide = ideal.select(*qkeys, F.col("pos").alias("rank"), "cum_idcg", "cum_cost", "is_boundary")
    rows = rows.join(ide, [*qkeys, "rank"], "left")
    return rows.withColumns({"cum_idcg": F.coalesce("cum_idcg", "idcg_full"), "cum_cost": F.coalesce("cum_cost", "icost_full")})


def _k_of(mult: float) -> Column:
    # int(x * R + 0.9) truncates; floor() is the same for the non-negative values here
    return F.floor(F.lit(float(mult)) * F.col("R") + F.lit(0.9)).cast("long")


# user-registered measures: name -> (function(row columns) -> aggregate Column, summary kind)
CUSTOM: dict[str, tuple] = {}


def register_measure(name: str, per_topic_agg, summary: str = C.MEAN) -> None:
    """Add a measure computed as one aggregate Column per topic.

    ``per_topic_agg`` receives nothing and returns an aggregate expression over
    the ranked-row columns ``rank, rel, is_rel, cum_rel, cum_jnr, cum_unj, R, N``
    (e.g. ``lambda: F.sum(F.when(F.col("is_rel") == 1, 1 / F.log2(F.col("rank") + 1)))``).
    ``summary`` is one of ``"mean"``, ``"sum"``, ``"geo"``.  No Python runs per row.
    """
    CUSTOM[name] = (per_topic_agg, summary)
    C.SPEC[name] = (C.NONE, None, summary)


class _Plan:
    """Collects aggregate expressions (deduplicated) and final measure expressions."""

    def __init__(self):
        self.aggs: dict[str, Column] = {}
        self.finals: list[tuple[str, Column]] = []

    def agg(self, name: str, expr: Column) -> Column:
        if name not in self.aggs:
            self.aggs[name] = expr.alias(f"_a{len(self.aggs)}")
        return F.col(f"_a{list(self.aggs).index(name)}")

    def out(self, name: str, expr: Column):
        self.finals.append((name, expr.cast("double")))


def _div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def list_measures(measures=None) -> list[C.Measure]:
    """The requested numeric measures of ranked lists."""
    ms = [m for m in C.expand(measures) if m.name not in ("runid", "num_q", "relstring")]
    return [m for m in ms if m.name not in C.PREF_MEASURES and m.name not in C.JG_MEASURES]


def per_topic(
    ranked: DataFrame,
    qrels: DataFrame,
    measures=None,
    level: int = 1,
    num_docs_in_coll: int = 0,
    wide: bool = False,
    keys=_W_RUN,
    qkeys=("qid",),
) -> DataFrame:
    """Per-topic values of the requested measures.

    Returns ``(run_id, qid, measure, value double)``; gm_* rows hold the
    logarithm used by the geometric summary.  ``relstring`` and ``runid`` are
    string measures, see :func:`relstring`.
    """
    ms = list_measures(measures)
    keys, qkeys = list(keys), list(qkeys)
    if "R" not in ranked.columns:  # not scanned
        ranked = ranked.join(topic_judgments(qrels, ms, level, qkeys), qkeys)
    rows = _row_columns(ranked, ms, level, keys)
    if _needs(ms, "ndcg_rel", "Rndcg", "G"):
        rows = _attach_ideal(rows, ideal_positions(qrels, _gains_of(ms), qkeys), qkeys)

    p = _Plan()
    isrel = F.col("is_rel") == 1
    rank = F.col("rank").cast("double")
    cum_rel = F.col("cum_rel").cast("double")
    n = p.agg("_n", F.count(F.lit(1)))
    r = p.agg("_numrelret", F.sum("is_rel"))
    R = p.agg("_numrel", F.max("R"))
    Rd = R.cast("double")

    def rel_at(k) -> Column:
        return p.agg(f"_rel_at_{k}", F.sum(F.when(isrel & (F.col("rank") <= k), 1).otherwise(0)))

    def iprec(c: float) -> Column:
        key = f"{c!r}"
        k = p.agg(f"_ik_{key}", F.max(_k_of(c)))
        mx = p.agg(f"_ip_{key}", F.max(F.when(isrel & (F.col("cum_rel") >= _k_of(c)), cum_rel / rank)))
        return F.when(k > r, F.lit(0.0)).otherwise(F.coalesce(mx, F.lit(0.0)))

    ap = None
    for m in ms:
        nm = m.names()
        if m.name == "num_ret":
            p.out(nm[0], n)
        elif m.name == "num_rel":
            p.out(nm[0], R)
        elif m.name == "num_rel_ret":
            p.out(nm[0], r)
        elif m.name == "num_nonrel_judged_ret":
            npool = p.agg("_nonpool", F.sum((F.col("rel") == REL_NONPOOL).cast("int")))
            nunj = p.agg("_unj", F.sum("unj"))
            p.out(nm[0], n - npool - nunj - r)
        elif m.name in ("map", "gm_map"):
            ap = _div(p.agg("_ap", exact_sum(F.when(isrel, cum_rel / rank).otherwise(0.0))), Rd)
            p.out(nm[0], ap if m.name == "map" else F.log(F.greatest(ap, F.lit(C.MIN_GEO_MEAN))))
        elif m.name == "Rprec":
            p.out(nm[0], _div(p.agg("_rprec", F.sum(F.when(isrel & (F.col("rank") <= F.col("R")), 1).otherwise(0))), Rd))
        elif m.name in ("bpref", "gm_bpref"):
            nb = (F.col("cum_jnr") - F.col("jnr")).cast("double")
            term = F.when(
                nb > 0, 1.0 - F.least(nb, F.col("R").cast("double")) / F.least(F.col("N"), F.col("R")).cast("double")
            ).otherwise(1.0)
            b = _div(p.agg("_bpref", exact_sum(F.when(isrel, term).otherwise(0.0))), Rd)
            p.out(nm[0], b if m.name == "bpref" else F.log(F.greatest(b, F.lit(C.MIN_GEO_MEAN))))
        elif m.name == "recip_rank":
            first = p.agg("_first_rel", F.min(F.when(isrel, F.col("rank"))))
            p.out(nm[0], F.coalesce(1.0 / first.cast("double"), F.lit(0.0)))
        elif m.name == "iprec_at_recall":
            for c, name in zip(m.params, nm):
                p.out(name, iprec(c))
        elif m.name == "11pt_avg":
            vals = [iprec(c) for c in m.params]
            tot = vals[0]
            for v in vals[1:]:
                tot = tot + v
            p.out(nm[0], tot / float(len(vals)))
        elif m.name == "P":
            for k, name in zip(m.params, nm):
                p.out(name, rel_at(k) / float(k))
        elif m.name == "recall":
            for k, name in zip(m.params, nm):
                p.out(name, _div(rel_at(k).cast("double"), Rd))
        elif m.name == "relative_P":
            for k, name in zip(m.params, nm):
                p.out(name, _div(rel_at(k).cast("double"), F.least(Rd, F.lit(float(k)))))
        elif m.name == "success":
            for k, name in zip(m.params, nm):
                p.out(name, F.when(rel_at(k) > 0, 1.0).otherwise(0.0))
        elif m.name == "map_cut":
            for k, name in zip(m.params, nm):
                s = p.agg(f"_apcut_{k}", exact_sum(F.when(isrel & (F.col("rank") <= k), cum_rel / rank).otherwise(0.0)))
                p.out(name, _div(s, Rd))
        elif m.name == "Rprec_mult":
            for c, name in zip(m.params, nm):
                k = p.agg(f"_rmk_{c!r}", F.max(_k_of(c)))
                s = p.agg(f"_rms_{c!r}", F.sum(F.when(isrel & (F.col("rank") <= _k_of(c)), 1).otherwise(0)))
                p.out(name, _div(s.cast("double"), k.cast("double")))
        elif m.name == "infAP":
            eps = C.INFAP_EPSILON
            rb = (F.col("cum_rel") - 1).cast("double")
            nb = (F.col("cum_jnr") - F.col("jnr")).cast("double")
            ub = (F.col("cum_unj") - F.col("unj")).cast("double")
            term = F.when(F.col("rank") == 1, F.lit(1.0)).otherwise(
                1.0 / rank
                + ((rank - 1.0) / rank) * ((rb + nb + ub) / (rank - 1.0)) * ((rb + eps) / (rb + nb + 2 * eps))
            )
            p.out(nm[0], _div(p.agg("_infap", exact_sum(F.when(isrel, term).otherwise(0.0))), Rd))
        elif m.name == "utility":
            c0, c1, c2, c3 = m.params
            p.out(nm[0], c0 * r + c1 * (n - r) + c2 * (R - r) + c3 * (F.lit(num_docs_in_coll) + r - n - R))
        elif m.name == "binG":
            s = p.agg("_bing", exact_sum(F.when(isrel, 1.0 / F.log2(2.0 + rank - cum_rel)).otherwise(0.0)))
            p.out(nm[0], F.when(r > 0, _div(s, Rd)).otherwise(0.0))
        elif m.name == "G":
            P = F.coalesce(F.col("P"), F.lit(0))
            cost = F.coalesce(F.col("cum_cost"), F.lit(0.0)) + F.greatest(F.col("rank") - P, F.lit(0)).cast("double")
            s = p.agg(
                "_g", exact_sum(F.when(F.col("gain") != 0, F.col("gain") / F.log2(2.0 + cost - F.col("cum_gain"))).otherwise(0.0))
            )
            ideal = p.agg("_ideal_gain_sum", F.max(F.coalesce(F.col("ideal_gain_sum"), F.lit(0.0))))
            p.out(nm[0], F.when(ideal > 0, s / ideal).otherwise(0.0))
        elif m.name == "ndcg":
            dcg = p.agg("_dcg", exact_sum(F.col("dcg_term")))
            idcg = p.agg("_idcg", F.max(F.coalesce(F.col("idcg_full"), F.lit(0.0))))
            p.out(nm[0], F.when(idcg > 0, dcg / idcg).otherwise(0.0))
        elif m.name == "ndcg_cut":
            for k, name in zip(m.params, nm):
                d = p.agg(
                    f"_dcgcut_{k}",
                    exact_sum(F.when((F.col("rank") <= k) & (F.col("rel") > 0), F.col("rel") / F.log2(rank + 1.0)).otherwise(0.0)),
                )
                i = p.agg(f"_idcgcut_{k}", F.max(F.coalesce(F.col(f"idcg_cut_{k}"), F.lit(0.0))))
                p.out(name, F.when(i > 0, d / i).otherwise(d))
        elif m.name == "ndcg_rel":
            dcg = p.agg("_dcg", exact_sum(F.col("dcg_term")))
            idcg = p.agg("_idcg", F.max(F.coalesce(F.col("idcg_full"), F.lit(0.0))))
            P = p.agg("_npideal", F.max(F.coalesce(F.col("P"), F.lit(0))))
            s_in = p.agg("_ndcgrel_in", exact_sum(F.when(F.col("gain") > 0, F.col("cum_dcg") / F.col("cum_idcg")).otherwise(0.0)))
            npos = p.agg("_npos_ret", F.sum(F.when(F.col("gain") > 0, 1).otherwise(0)))
            tot = s_in + F.when(idcg > 0, (P - npos).cast("double") * dcg / idcg).otherwise(0.0)
            p.out(nm[0], F.when(tot > 0, tot / P.cast("double")).otherwise(0.0))
        elif m.name == "Rndcg":
            dcg = p.agg("_dcg", exact_sum(F.col("dcg_term")))
            idcg = p.agg("_idcg", F.max(F.coalesce(F.col("idcg_full"), F.lit(0.0))))
            P = p.agg("_npideal", F.max(F.coalesce(F.col("P"), F.lit(0))))
            at_b = F.col("is_boundary") & (F.col("rank") <= F.coalesce(F.col("P"), F.lit(0)))
            s_in = p.agg("_rndcg_in", exact_sum(F.when(at_b, F.col("cum_dcg") / F.col("cum_idcg")).otherwise(0.0)))
            c_in = p.agg("_rndcg_cin", F.sum(F.when(at_b, 1).otherwise(0)))
            bounds = p.agg("_bounds", F.max("bounds"))
            outer = F.filter(F.coalesce(bounds, F.array()), lambda b: b["pos"] > n)
            s_out = F.aggregate(outer, F.lit(0.0), lambda acc, b: acc + dcg / b["cum_idcg"])
            c_out = F.size(outer)
            end = (n > P + 1) & (idcg > 0)
            s_end = F.when(end, dcg / idcg).otherwise(0.0)
            c_end = F.when(end, 1).otherwise(0)
            cnt = c_in + c_out + c_end
            p.out(nm[0], F.when((R > 0) & (cnt > 0), (s_in + s_out + s_end) / cnt.cast("double")).otherwise(0.0))
        elif m.name == "set_P":
            p.out(nm[0], _div(r.cast("double"), n.cast("double")))
        elif m.name == "set_recall":
            p.out(nm[0], _div(r.cast("double"), Rd))
        elif m.name == "set_relative_P":
            p.out(nm[0], _div(r.cast("double"), F.least(n, R).cast("double")))
        elif m.name == "set_map":
            p.out(nm[0], _div((r * r).cast("double"), (n * R).cast("double")))
        elif m.name == "set_F":
            x = float(m.params)
            sp = r.cast("double") / n.cast("double")
            sr = r.cast("double") / Rd
            p.out(nm[0], F.when(r > 0, (x + 1.0) * sp * sr / (x * sp + sr)).otherwise(0.0))
        elif m.name in CUSTOM:
            p.out(nm[0], p.agg(f"_custom_{m.name}", CUSTOM[m.name][0]()))
        else:
            raise ValueError(f"measure {m.name} is not a ranked-list measure")

    agg = rows.groupBy(*keys).agg(*p.aggs.values())
    if wide:
        return agg.select(*keys, *[e.alias(k) for k, e in p.finals])
    pairs = F.array(*[F.struct(F.lit(k).alias("measure"), e.alias("value")) for k, e in p.finals])
    return agg.select(*keys, F.inline(pairs))


def per_topic_jg(ranked_jg: DataFrame, qrels_jg: DataFrame, measures=None, level: int = 1) -> DataFrame:
    """``*_avgjg`` measures: the base measure per judgment group, averaged over the topic's groups."""
    ms = [m for m in C.expand(measures) if m.name in C.JG_MEASURES]
    if not ms:
        return ranked_jg.sparkSession.createDataFrame([], "run_id string, qid string, measure string, value double")
    base = [C.Measure(m.name[: -len("_avgjg")], m.params, m.raw) for m in ms]
    per_group = per_topic(ranked_jg, qrels_jg, base, level, keys=("run_id", "qid", "jg"), qkeys=("qid", "jg"))
    # rename P_5 -> P_avgjg_5, map -> map_avgjg, Rprec_mult_0.20 -> Rprec_mult_avgjg_0.20
    out_names = {}
    for b, m in zip(base, ms):
        for bn, mn in zip(b.names(), m.names()):
            out_names[bn] = mn
    rename = F.create_map(*[x for kv in out_names.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return per_group.groupBy("run_id", "qid", "measure").agg(F.avg("value").alias("value")).select(
        "run_id", "qid", F.element_at(rename, F.col("measure")).alias("measure"), "value"
    )


def relstring(ranked: DataFrame, length: int = C.RELSTRING_LEN, name: str = "relstring") -> DataFrame:
    """First ``length`` relevance values as characters, per topic."""
    rel = F.col("rel")
    ch = (
        F.when((rel >= 0) & (rel <= 9), rel.cast("string"))
        .when(rel > 9, F.lit(">"))
        .when(rel == REL_NONPOOL, F.lit("-"))
        .when(rel == REL_UNJUDGED, F.lit("."))
        .otherwise(F.lit("<"))
    )
    top = ranked.where(F.col("rank") <= length)  # bounded: at most `length` rows per topic
    s = top.groupBy(*_W_RUN).agg(F.sort_array(F.collect_list(F.struct(F.col("rank"), ch.alias("c")))).alias("cs"))
    return s.select(*_W_RUN, F.lit(name).alias("measure"), F.array_join(F.transform("cs", lambda x: x["c"]), "").alias("value"))
