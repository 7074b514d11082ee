"""Oracle SQL (DuckDB dialect) for the registered queries.

The derivations mirror ``ranklens/sources/tables.py`` rule for rule; the
measure definitions are written independently of the Spark code, as plain
window + aggregate SQL.  Doubles are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

# ------------------------------------------------------------------ inputs

DEEP_RUN = """
SELECT 'deep' AS run_id, CAST(l_suppkey AS VARCHAR) AS qid,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS docno,
       CAST(max(l_extendedprice) AS FLOAT) AS sim
FROM lineitem GROUP BY 2, 3"""

TIED_RUN = """
SELECT 'tied' AS run_id, CAST(l_suppkey AS VARCHAR) AS qid,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS docno,
       CAST(max(l_quantity) AS FLOAT) AS sim
FROM lineitem GROUP BY 2, 3"""

TRUNC_RUN = """
SELECT 'trunc' AS run_id, qid, docno, sim FROM (
  SELECT CAST(l_suppkey AS VARCHAR) AS qid,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS docno,
         CAST(max(l_extendedprice) AS FLOAT) AS sim
  FROM lineitem GROUP BY 1, 2) x
WHERE qid IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal >= 0)"""

DEEP_QRELS = """
SELECT CAST(l_suppkey AS VARCHAR) AS qid,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS docno,
       CAST(max(CASE WHEN l_tax = 0 THEN -1 WHEN l_discount >= 0.08 THEN 2
                     WHEN l_discount >= 0.05 THEN 1 ELSE 0 END) AS INTEGER) AS rel
FROM lineitem WHERE l_returnflag <> 'N' OR l_linestatus = 'F'
GROUP BY 1, 2"""

DEEP_QRELS_JG = f"""
SELECT qid, jg, docno,
       CAST(CASE WHEN jg = '1' AND rel = 1 THEN 0 WHEN jg = '2' AND rel = 0 THEN 1 ELSE rel END AS INTEGER) AS rel
FROM ({DEEP_QRELS}) q, (VALUES ('0'), ('1'), ('2')) u(jg)"""

MULTI_PREFS = """
SELECT qid, '0' AS jg, unnest(['ls_' || ls, 'rf_' || rf]) AS jsg, docno, rel_level FROM (
  SELECT CAST(l_orderkey AS VARCHAR) AS qid,
         CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS docno,
         CAST(max(floor(l_quantity / 10)) AS FLOAT) AS rel_level,
         max(l_linestatus) AS ls, max(l_returnflag) AS rf
  FROM lineitem GROUP BY 1, 2) d"""

PREFS_RUN = """
SELECT 'prefs' AS run_id, CAST(l_orderkey AS VARCHAR) AS qid,
       CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS docno,
       CAST(max(l_extendedprice) AS FLOAT) AS sim
FROM lineitem WHERE l_linestatus = 'O' OR l_discount > 0.03 GROUP BY 2, 3"""

CORPUS = "SELECT CAST(doc_id AS VARCHAR) AS docno, text FROM documents"
TOPICS = "SELECT CAST(item_id AS VARCHAR) AS qid, text AS query FROM benchmark"


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6)"


_r6 = r6


# ------------------------------------------------------------------ ranked lists


def ranked_cte(run_sql: str = DEEP_RUN, qrels_sql: str = DEEP_QRELS, max_docs: int | None = None,
               judged_only: bool = False) -> str:
    cut = f"WHERE rank0 <= {int(max_docs)}" if max_docs else ""
    base = f"""
run AS ({run_sql}),
qrels AS ({qrels_sql}),
ranked0 AS (
  SELECT run_id, qid, docno, sim,
         row_number() OVER (PARTITION BY run_id, qid ORDER BY sim DESC, docno DESC) AS rank0
  FROM run WHERE qid IN (SELECT qid FROM qrels)),
ranked1 AS (
  SELECT r.run_id, r.qid, r.docno, r.sim, r.rank0,
         CAST(CASE WHEN q.rel IS NULL THEN -1 WHEN q.rel < 0 THEN -2 ELSE q.rel END AS INTEGER) AS rel
  FROM (SELECT * FROM ranked0 {cut}) r LEFT JOIN qrels q ON r.qid = q.qid AND r.docno = q.docno)"""
    if judged_only:
        return base + """,
ranked AS (
  SELECT run_id, qid, docno, sim, rel,
         row_number() OVER (PARTITION BY run_id, qid ORDER BY rank0) AS rank
  FROM ranked1 WHERE rel >= 0)"""
    return base + """,
ranked AS (SELECT run_id, qid, docno, sim, rel, rank0 AS rank FROM ranked1)"""


def rows_cte(level: int = 1) -> str:
    """Running counts per ranked row (inclusive of the row)."""
    return f"""
tj AS (
  SELECT qid,
         sum(CASE WHEN rel >= {level} THEN 1 ELSE 0 END) AS R,
         sum(CASE WHEN rel >= 0 AND rel < {level} THEN 1 ELSE 0 END) AS N
  FROM qrels GROUP BY qid),
flags AS (
  SELECT k.run_id, k.qid, k.rank, k.rel, tj.R, tj.N,
         CASE WHEN k.rel >= {level} THEN 1 ELSE 0 END AS is_rel,
         CASE WHEN k.rel >= 0 AND k.rel < {level} THEN 1 ELSE 0 END AS jnr,
         CASE WHEN k.rel = -2 THEN 1 ELSE 0 END AS unj,
         CASE WHEN k.rel = -1 THEN 1 ELSE 0 END AS npool,
         CASE WHEN k.rel >= 0 THEN CAST(k.rel AS DOUBLE) ELSE 0.0 END AS gain
  FROM ranked k JOIN tj ON k.qid = tj.qid),
rows AS (
  SELECT *,
         sum(is_rel) OVER w AS cum_rel,
         sum(jnr) OVER w AS cum_jnr,
         sum(unj) OVER w AS cum_unj,
         sum(CASE WHEN gain <> 0 THEN gain / log2(rank + 1) ELSE 0 END) OVER w AS cum_dcg,
         sum(gain) OVER w AS cum_gain
  FROM flags
  WINDOW w AS (PARTITION BY run_id, qid ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ideal AS (
  SELECT qid, pos, igain,
         sum(igain / log2(pos + 1)) OVER wi AS cum_idcg,
         sum(greatest(igain, 1.0)) OVER wi AS cum_cost,
         coalesce(lead(igain) OVER (PARTITION BY qid ORDER BY pos) <> igain, true) AS is_boundary
  FROM (SELECT qid, CAST(rel AS DOUBLE) AS igain,
               row_number() OVER (PARTITION BY qid ORDER BY rel DESC, docno) AS pos
        FROM qrels WHERE rel > 0) z
  WINDOW wi AS (PARTITION BY qid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ideal_topic AS (
  SELECT qid, count(*) AS P, max(cum_idcg) AS idcg_full, sum(igain) AS ideal_gain_sum FROM ideal GROUP BY qid)"""


def _floor_k(mult: float) -> str:
    return f"CAST(floor({mult!r} * R + 0.9) AS BIGINT)"


# per-topic value SQL over `rows`, grouped by (run_id, qid); returns list of (name, expr)
def _measure_exprs(name: str, cuts=None) -> list[tuple[str, str]]:
    cut = tuple(cuts) if cuts else (5, 10, 15, 20, 30, 100, 200, 500, 1000)
    if name == "num_ret":
        return [("num_ret", "count(*)")]
    if name == "num_rel":
        return [("num_rel", "max(R)")]
    if name == "num_rel_ret":
        return [("num_rel_ret", "sum(is_rel)")]
    if name == "num_nonrel_judged_ret":
        return [("num_nonrel_judged_ret", "count(*) - sum(npool) - sum(unj) - sum(is_rel)")]
    if name == "map":
        return [("map", "CASE WHEN max(R) > 0 THEN sum(CASE WHEN is_rel = 1 THEN cum_rel / rank ELSE 0 END) / max(R) ELSE 0 END")]
    if name == "gm_map":
        return [("gm_map", "ln(greatest(CASE WHEN max(R) > 0 THEN sum(CASE WHEN is_rel = 1 THEN cum_rel / rank ELSE 0 END) / max(R) ELSE 0 END, 1e-5))")]
    if name == "Rprec":
        return [("Rprec", "CASE WHEN max(R) > 0 THEN sum(CASE WHEN is_rel = 1 AND rank <= R THEN 1 ELSE 0 END) / max(R) ELSE 0 END")]
    bpref_term = ("CASE WHEN is_rel = 1 THEN CASE WHEN cum_jnr - jnr > 0 THEN 1.0 - least(cum_jnr - jnr, R) / least(N, R) "
                  "ELSE 1.0 END ELSE 0 END")
    if name == "bpref":
        return [("bpref", f"CASE WHEN max(R) > 0 THEN sum({bpref_term}) / max(R) ELSE 0 END")]
    if name == "gm_bpref":
        return [("gm_bpref", f"ln(greatest(CASE WHEN max(R) > 0 THEN sum({bpref_term}) / max(R) ELSE 0 END, 1e-5))")]
    if name == "recip_rank":
        return [("recip_rank", "coalesce(1.0 / min(CASE WHEN is_rel = 1 THEN rank END), 0)")]

    def iprec(c):
        k = _floor_k(c)
        return (f"CASE WHEN max({k}) > sum(is_rel) THEN 0 ELSE coalesce(max(CASE WHEN is_rel = 1 AND cum_rel >= {k} "
                f"THEN cum_rel / rank END), 0) END")

    pts = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
    if name == "iprec_at_recall":
        return [(f"iprec_at_recall_{c:3.2f}", iprec(c)) for c in pts]
    if name == "11pt_avg":
        return [("11pt_avg", "(" + " + ".join(iprec(c) for c in pts) + f") / {len(pts)}.0")]

    def relk(k):
        return f"sum(CASE WHEN is_rel = 1 AND rank <= {k} THEN 1 ELSE 0 END)"

    if name == "P":
        return [(f"P_{k}", f"{relk(k)} / {k}.0") for k in cut]
    if name == "recall":
        return [(f"recall_{k}", f"CASE WHEN max(R) > 0 THEN {relk(k)} / max(R) ELSE 0 END") for k in cut]
    if name == "relative_P":
        return [(f"relative_P_{k}", f"CASE WHEN max(R) > 0 THEN {relk(k)} / least(max(R), {k}) ELSE 0 END") for k in cut]
    if name == "success":
        return [(f"success_{k}", f"CASE WHEN {relk(k)} > 0 THEN 1.0 ELSE 0.0 END") for k in (cuts or (1, 5, 10))]
    if name == "map_cut":
        return [(f"map_cut_{k}", f"CASE WHEN max(R) > 0 THEN sum(CASE WHEN is_rel = 1 AND rank <= {k} THEN cum_rel / rank ELSE 0 END) / max(R) ELSE 0 END") for k in cut]
    if name == "Rprec_mult":
        out = []
        for m in (0.2, 0.4, 0.6, 0.8, 1.0, 1.2, 1.4, 1.6, 1.8, 2.0):
            k = _floor_k(m)
            out.append((f"Rprec_mult_{m:3.2f}", f"CASE WHEN max({k}) > 0 THEN sum(CASE WHEN is_rel = 1 AND rank <= {k} THEN 1 ELSE 0 END) / max({k}) ELSE 0 END"))
        return out
    if name == "infAP":
        t = ("CASE WHEN is_rel = 1 THEN CASE WHEN rank = 1 THEN 1.0 ELSE 1.0 / rank + ((rank - 1.0) / rank) * "
             "(((cum_rel - 1) + (cum_jnr - jnr) + (cum_unj - unj)) / (rank - 1.0)) * "
             "(((cum_rel - 1) + 1e-5) / ((cum_rel - 1) + (cum_jnr - jnr) + 2e-5)) END ELSE 0 END")
        return [("infAP", f"CASE WHEN max(R) > 0 THEN sum({t}) / max(R) ELSE 0 END")]
    if name == "utility":
        return [("utility", "1.0 * sum(is_rel) - 1.0 * (count(*) - sum(is_rel))")]
    if name == "binG":
        return [("binG", "CASE WHEN sum(is_rel) > 0 THEN sum(CASE WHEN is_rel = 1 THEN 1.0 / log2(2.0 + rank - cum_rel) ELSE 0 END) / max(R) ELSE 0 END")]
    if name == "ndcg":
        return [("ndcg", "CASE WHEN max(coalesce(idcg_full, 0)) > 0 THEN max(cum_dcg_final) / max(idcg_full) ELSE 0 END")]
    if name == "ndcg_cut":
        out = []
        for k in cut:
            d = f"sum(CASE WHEN rank <= {k} AND rel > 0 THEN rel / log2(rank + 1.0) ELSE 0 END)"
            i = f"max(coalesce(idcg_cut_{k}, 0))"
            out.append((f"ndcg_cut_{k}", f"CASE WHEN {i} > 0 THEN {d} / {i} ELSE {d} END"))
        return out
    if name == "G":
        cost = "(coalesce(cum_cost, 0) + greatest(rank - coalesce(P, 0), 0))"
        return [("G", f"CASE WHEN max(coalesce(ideal_gain_sum, 0)) > 0 THEN sum(CASE WHEN gain <> 0 THEN gain / log2(2.0 + {cost} - cum_gain) ELSE 0 END) / max(ideal_gain_sum) ELSE 0 END")]
    if name == "ndcg_rel":
        s = ("(sum(CASE WHEN gain > 0 THEN cum_dcg / cum_idcg ELSE 0 END) + CASE WHEN max(coalesce(idcg_full, 0)) > 0 "
             "THEN (max(coalesce(P, 0)) - sum(CASE WHEN gain > 0 THEN 1 ELSE 0 END)) * max(cum_dcg_final) / max(idcg_full) ELSE 0 END)")
        return [("ndcg_rel", f"CASE WHEN {s} > 0 THEN {s} / max(P) ELSE 0 END")]
    if name == "set_P":
        return [("set_P", "sum(is_rel) / count(*)")]
    if name == "set_recall":
        return [("set_recall", "CASE WHEN max(R) > 0 THEN sum(is_rel) / max(R) ELSE 0 END")]
    if name == "set_relative_P":
        return [("set_relative_P", "CASE WHEN least(count(*), max(R)) > 0 THEN sum(is_rel) / least(count(*), max(R)) ELSE 0 END")]
    if name == "set_map":
        return [("set_map", "CASE WHEN max(R) > 0 THEN sum(is_rel) * sum(is_rel) / (count(*) * max(R)) ELSE 0 END")]
    if name == "set_F":
        p = "(sum(is_rel) / count(*))"
        r = "(sum(is_rel) / max(R))"
        return [("set_F", f"CASE WHEN sum(is_rel) > 0 THEN 2.0 * {p} * {r} / ({p} + {r}) ELSE 0 END")]
    raise KeyError(name)


SUMMED = {"num_ret", "num_rel", "num_rel_ret", "num_nonrel_judged_ret"}
GEO = {"gm_map", "gm_bpref"}


def measure_sql(name: str, run_sql: str = DEEP_RUN, qrels_sql: str = DEEP_QRELS, level: int = 1,
                cuts=None, rounded: bool = True) -> str:
    """Per-topic rows + summary row (qid 'all') for one measure, like the Spark query."""
    r6 = _r6 if rounded else (lambda e: f"CAST({e} AS DOUBLE)")
    exprs = _measure_exprs(name, cuts)
    with_ideal = name in ("ndcg", "G", "ndcg_rel", "ndcg_cut", "Rndcg")
    src = "rows"
    extra = ""
    if with_ideal:
        cut_cols = ", ".join(
            f"sum(CASE WHEN pos <= {k} THEN igain / log2(pos + 1) END) AS idcg_cut_{k}" for k in (5, 10, 15, 20, 30, 100, 200, 500, 1000)
        )
        extra = f""",
icut AS (SELECT qid, {cut_cols} FROM ideal GROUP BY qid),
rowsi AS (
  SELECT rw.*, it.P, it.idcg_full, it.ideal_gain_sum, ic.* EXCLUDE (qid), i.cum_idcg, i.cum_cost, i.is_boundary,
         sum(CASE WHEN gain <> 0 THEN gain / log2(rank + 1) ELSE 0 END) OVER (PARTITION BY rw.run_id, rw.qid) AS cum_dcg_final
  FROM rows rw LEFT JOIN ideal_topic it ON rw.qid = it.qid
  LEFT JOIN icut ic ON rw.qid = ic.qid
  LEFT JOIN ideal i ON rw.qid = i.qid AND i.pos = least(rw.rank, coalesce(it.P, 0)))"""
        src = "rowsi"
    cols = ",\n       ".join(f"{e} AS \"{n}\"" for n, e in exprs)
    names = [n for n, _ in exprs]
    unp = " UNION ALL ".join(f"SELECT run_id, qid, '{n}' AS measure, CAST(\"{n}\" AS DOUBLE) AS value FROM wide" for n in names)
    if name in SUMMED:
        agg = "sum(value)"
    elif name in GEO:
        agg = "exp(avg(value))"
    else:
        agg = "avg(value)"
    topic_part = "" if name in GEO else f"SELECT run_id, qid, measure, {r6('value')} AS value FROM long UNION ALL "
    return f"""WITH {ranked_cte(run_sql, qrels_sql)},{rows_cte(level)}{extra},
wide AS (SELECT run_id, qid,
       {cols}
  FROM {src} GROUP BY run_id, qid),
long AS ({unp})
{topic_part}SELECT run_id, 'all' AS qid, measure, {r6(agg)} AS value FROM long GROUP BY run_id, measure"""


def rndcg_sql(run_sql: str = DEEP_RUN, qrels_sql: str = DEEP_QRELS, level: int = 1) -> str:
    return f"""WITH {ranked_cte(run_sql, qrels_sql)},{rows_cte(level)},
bounds AS (SELECT qid, pos, cum_idcg FROM ideal WHERE is_boundary),
topic AS (SELECT run_id, qid, count(*) AS n, max(R) AS R,
                 sum(CASE WHEN gain <> 0 THEN gain / log2(rank + 1) ELSE 0 END) AS dcg
          FROM rows GROUP BY run_id, qid),
pts AS (
  SELECT t.run_id, t.qid, CASE WHEN b.pos <= t.n THEN rw.cum_dcg ELSE t.dcg END / b.cum_idcg AS v
  FROM topic t JOIN bounds b ON t.qid = b.qid
  LEFT JOIN rows rw ON rw.run_id = t.run_id AND rw.qid = t.qid AND rw.rank = b.pos
  UNION ALL
  SELECT t.run_id, t.qid, t.dcg / it.idcg_full AS v
  FROM topic t JOIN ideal_topic it ON t.qid = it.qid WHERE t.n > it.P + 1 AND it.idcg_full > 0),
val AS (
  SELECT t.run_id, t.qid, CASE WHEN t.R > 0 AND count(p.v) > 0 THEN avg(p.v) ELSE 0 END AS value
  FROM topic t LEFT JOIN pts p ON t.run_id = p.run_id AND t.qid = p.qid GROUP BY t.run_id, t.qid, t.R)
SELECT run_id, qid, 'Rndcg' AS measure, {r6('value')} AS value FROM val
UNION ALL SELECT run_id, 'all', 'Rndcg', {r6('avg(value)')} FROM val GROUP BY run_id"""


def relstring_sql(run_sql: str = DEEP_RUN, qrels_sql: str = DEEP_QRELS, length: int = 10) -> str:
    return f"""WITH {ranked_cte(run_sql, qrels_sql)}
SELECT run_id, qid, 'relstring' AS measure,
       string_agg(CASE WHEN rel BETWEEN 0 AND 9 THEN CAST(rel AS VARCHAR) WHEN rel > 9 THEN '>'
                       WHEN rel = -1 THEN '-' WHEN rel = -2 THEN '.' ELSE '<' END, '' ORDER BY rank) AS value
FROM ranked WHERE rank <= {length} GROUP BY run_id, qid"""


# ------------------------------------------------------------------ judgment groups


def jg_rows_cte(run_sql: str = DEEP_RUN, qrels_sql: str = DEEP_QRELS_JG) -> str:
    return f"""
run AS ({run_sql}),
qrels AS ({qrels_sql}),
groups AS (SELECT DISTINCT qid, jg FROM qrels),
ranked0 AS (
  SELECT run_id, qid, docno,
         row_number() OVER (PARTITION BY run_id, qid ORDER BY sim DESC, docno DESC) AS rank
  FROM run WHERE qid IN (SELECT qid FROM qrels)),
ranked AS (
  SELECT r.run_id, r.qid, g.jg, r.docno, r.rank,
         CASE WHEN q.rel IS NULL THEN -1 WHEN q.rel < 0 THEN -2 ELSE q.rel END AS rel
  FROM ranked0 r JOIN groups g ON r.qid = g.qid
  LEFT JOIN qrels q ON r.qid = q.qid AND g.jg = q.jg AND r.docno = q.docno),
tj AS (SELECT qid, jg, sum(CASE WHEN rel >= 1 THEN 1 ELSE 0 END) AS R FROM qrels GROUP BY qid, jg),
rows AS (
  SELECT k.*, tj.R, CASE WHEN k.rel >= 1 THEN 1 ELSE 0 END AS is_rel,
         sum(CASE WHEN k.rel >= 1 THEN 1 ELSE 0 END) OVER (PARTITION BY k.run_id, k.qid, k.jg ORDER BY k.rank
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_rel
  FROM ranked k JOIN tj ON k.qid = tj.qid AND k.jg = tj.jg)"""


def jg_measure_sql(name: str) -> str:
    cut = (5, 10, 15, 20, 30, 100, 200, 500, 1000)
    if name == "map_avgjg":
        exprs = [("map_avgjg", "CASE WHEN max(R) > 0 THEN sum(CASE WHEN is_rel = 1 THEN cum_rel / rank ELSE 0 END) / max(R) ELSE 0 END")]
    elif name == "P_avgjg":
        exprs = [(f"P_avgjg_{k}", f"sum(CASE WHEN is_rel = 1 AND rank <= {k} THEN 1 ELSE 0 END) / {k}.0") for k in cut]
    else:
        exprs = []
        for m in (0.2, 0.4, 0.6, 0.8, 1.0, 1.2, 1.4, 1.6, 1.8, 2.0):
            k = _floor_k(m)
            exprs.append((f"Rprec_mult_avgjg_{m:3.2f}",
                          f"CASE WHEN max({k}) > 0 THEN sum(CASE WHEN is_rel = 1 AND rank <= {k} THEN 1 ELSE 0 END) / max({k}) ELSE 0 END"))
    cols = ",\n       ".join(f"{e} AS \"{n}\"" for n, e in exprs)
    unp = " UNION ALL ".join(f"SELECT run_id, qid, jg, '{n}' AS measure, CAST(\"{n}\" AS DOUBLE) AS value FROM wide" for n, _ in exprs)
    return f"""WITH {jg_rows_cte()},
wide AS (SELECT run_id, qid, jg, {cols} FROM rows GROUP BY run_id, qid, jg),
long AS ({unp}),
topic AS (SELECT run_id, qid, measure, avg(value) AS value FROM long GROUP BY run_id, qid, measure)
SELECT run_id, qid, measure, {r6('value')} AS value FROM topic
UNION ALL SELECT run_id, 'all', measure, {r6('avg(value)')} FROM topic GROUP BY run_id, measure"""


# ------------------------------------------------------------------ ranked-list operators

RANKED_COLS = "run_id, qid, docno, sim, rank, rel"


def ranked_sql(run_sql=TIED_RUN, qrels_sql=DEEP_QRELS, max_docs=None, judged_only=False) -> str:
    return f"WITH {ranked_cte(run_sql, qrels_sql, max_docs, judged_only)}\nSELECT {RANKED_COLS} FROM ranked"


def topic_stats_sql(run_sql=DEEP_RUN, qrels_sql=DEEP_QRELS) -> str:
    return f"""WITH {ranked_cte(run_sql, qrels_sql)},
j AS (SELECT qid, CAST(sum(CASE WHEN rel >= 1 THEN 1 ELSE 0 END) AS BIGINT) AS num_rel,
             CAST(sum(CASE WHEN rel >= 0 AND rel < 1 THEN 1 ELSE 0 END) AS BIGINT) AS num_nonrel FROM qrels GROUP BY qid)
SELECT r.run_id, r.qid, CAST(count(*) AS BIGINT) AS num_ret,
       CAST(sum(CASE WHEN rel >= 1 THEN 1 ELSE 0 END) AS BIGINT) AS num_rel_ret,
       CAST(sum(CASE WHEN rel = -1 THEN 1 ELSE 0 END) AS BIGINT) AS num_nonpool,
       CAST(sum(CASE WHEN rel = -2 THEN 1 ELSE 0 END) AS BIGINT) AS num_unjudged,
       max(j.num_rel) AS num_rel, max(j.num_nonrel) AS num_nonrel
FROM ranked r JOIN j ON r.qid = j.qid GROUP BY r.run_id, r.qid"""


RAW_RUN_KEYS = """
SELECT CAST(l_suppkey AS VARCHAR) AS qid,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS docno
FROM lineitem"""

RAW_QRELS_KEYS = """
SELECT CAST(l_suppkey AS VARCHAR) AS qid,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS docno
FROM lineitem WHERE l_returnflag <> 'N' OR l_linestatus = 'F'"""


def duplicates_sql(src: str) -> str:
    return f"SELECT qid, docno, CAST(count(*) AS BIGINT) AS n FROM ({src}) s GROUP BY qid, docno HAVING count(*) > 1"


def summary_rows_sql(names, run_sql, qrels_sql=DEEP_QRELS, only_all=True, level=1) -> str:
    parts = []
    for n in names:
        sql = rndcg_sql(run_sql, qrels_sql, level) if n == "Rndcg" else measure_sql(n, run_sql, qrels_sql, level)
        parts.append(f"SELECT * FROM ({sql}) x" + (" WHERE qid = 'all'" if only_all else ""))
    return "\nUNION ALL\n".join(parts)


def num_q_sql(run_sql, qrels_sql=DEEP_QRELS) -> str:
    return f"""SELECT run_id, 'all' AS qid, 'num_q' AS measure, CAST(count(DISTINCT qid) AS DOUBLE) AS value
FROM ({run_sql}) r WHERE qid IN (SELECT qid FROM ({qrels_sql}) q) GROUP BY run_id"""


# ------------------------------------------------------------------ text, index, scoring

STOP = ("a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it",
        "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these",
        "they", "this", "to", "was", "will", "with")
STOP_LIST = "[" + ", ".join(f"'{w}'" for w in STOP) + "]"


def uni_expr(col: str) -> str:
    return (f"list_filter(string_split(trim(regexp_replace(lower({col}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' '), "
            f"lambda x: x <> '')")


def std_expr(col: str) -> str:
    return f"list_filter({uni_expr(col)}, lambda x: NOT list_contains({STOP_LIST}, x))"


TEXT_CTE = f"""
corpus AS ({CORPUS}),
an AS (SELECT docno, {uni_expr('text')} AS uni, {std_expr('text')} AS std FROM corpus),
ds AS (SELECT docno, CAST(len(std) AS BIGINT) AS dlen, CAST(len(uni) AS BIGINT) AS ulen,
              CAST(len(list_distinct(uni)) AS BIGINT) AS uvoc FROM an),
post AS (SELECT term, docno, count(*) AS tf FROM (SELECT docno, unnest(std) AS term FROM an) x GROUP BY term, docno),
postd AS (SELECT p.term, p.docno, p.tf, d.dlen, d.ulen, d.uvoc FROM post p JOIN ds d ON p.docno = d.docno),
topics AS ({TOPICS}),
qtp AS (SELECT qid, unnest(generate_series(0, len(toks) - 1)) AS pos, unnest(toks) AS term
        FROM (SELECT qid, {std_expr('query')} AS toks FROM topics) t),
qt AS (SELECT qid, term, count(*) AS qtf, min(pos) AS qpos FROM qtp GROUP BY qid, term),
ts AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM post
       WHERE term IN (SELECT term FROM qt) GROUP BY term),
cs AS (SELECT count(*) AS num_docs, CAST(sum(dlen) AS BIGINT) AS sum_tf, avg(dlen) AS avg_dlen FROM ds),
m AS (SELECT q.qid, q.term, q.qtf, p.docno, p.tf, p.dlen, p.ulen, p.uvoc, ts.df, ts.ctf, cs.num_docs, cs.sum_tf, cs.avg_dlen
      FROM qt q JOIN postd p ON q.term = p.term JOIN ts ON ts.term = q.term CROSS JOIN cs)"""

TERM_SCORE = {
    "bnn_bnn": ("qtf * CASE WHEN tf > 0 THEN 1.0 ELSE 0.0 END", "sum"),
    "lnc_ltn": ("(1.0 + log10(tf)) * (1.0 + log10(qtf)) * log10(CAST(num_docs AS DOUBLE) / greatest(df, 1))", "sum_norm"),
    "lm_laplace": ("qtf * (tf + 1.0 / ulen) / (ulen + uvoc)", "sum"),
    "lm_jm": ("pow(0.9 * tf / dlen + (1.0 - 0.9) * CAST(ctf AS DOUBLE) / sum_tf, qtf)", "product"),
    "lm_dirichlet": ("qtf * (tf + 1000.0) / (ctf + 1000.0)", "sum"),
    "raw_tf": ("CAST(qtf * tf AS DOUBLE)", "sum"),
    "bm25": ("qtf * ln(1.0 + (num_docs - df + 0.5) / (df + 0.5)) * tf * (1.2 + 1.0) / "
             "(tf + 1.2 * (1.0 - 0.75 + 0.75 * dlen / avg_dlen))", "sum"),
}
PER_TERM_TOP = ("lnc_ltn", "bnn_bnn", "lm_laplace", "lm_jm")
LIST_KEY = {"lm_laplace": "tf + 1.0 / ulen"}


def hits_cte(method: str, k: int = 10) -> str:
    s, combine = TERM_SCORE[method]
    mm = method
    if method in PER_TERM_TOP:
        cand = f"""tt_{mm} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid, term ORDER BY {LIST_KEY.get(method, "s")} DESC, docno) AS rn
                         FROM sc_{mm}) z WHERE rn <= 10)"""
    else:
        cand = f"tt_{mm} AS (SELECT * FROM sc_{mm})"
    agg = "pow(10.0, sum(log10(s)))" if combine == "product" else "sum(s)"
    norm = ("score / sqrt(sum(score * score) OVER (PARTITION BY qid))" if combine == "sum_norm" else "score")
    return f"""sc_{mm} AS (SELECT *, CAST({s} AS DOUBLE) AS s FROM m),
{cand},
agg0_{mm} AS (SELECT qid, docno, {agg} AS score FROM tt_{mm} GROUP BY qid, docno),
agg_{mm} AS (SELECT qid, docno, {norm} AS score FROM agg0_{mm}),
top_{method} AS (SELECT qid, docno, '{method}' AS method, score,
              row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, docno) AS rank FROM agg_{mm})"""


def hits_sql(method: str, k: int = 10) -> str:
    return f"""WITH {TEXT_CTE},
{hits_cte(method)}
SELECT qid, docno, method, round(score, 6) AS score, rank FROM top_{method} WHERE rank <= {k}"""


BACKGROUND = {
    "lm_jm": "0.9 * tf / dlen + (1.0 - 0.9) * CAST(ctf AS DOUBLE) / sum_tf",
    "lm_dirichlet": "(tf + 1000.0 * ctf / sum_tf) / (dlen + 1000.0)",
}


def background_sql(method: str, k: int = 10) -> str:
    """Every document with a query term against every query term of the collection."""
    return f"""WITH {TEXT_CTE},
cand AS (SELECT DISTINCT qid, docno, dlen FROM m),
allt AS (SELECT c.qid, c.docno, c.dlen, q.term, q.qtf, ts.ctf, cs.sum_tf, coalesce(p.tf, 0) AS tf
         FROM cand c JOIN qt q ON q.qid = c.qid JOIN ts ON ts.term = q.term CROSS JOIN cs
         LEFT JOIN post p ON p.term = q.term AND p.docno = c.docno),
sc AS (SELECT qid, docno, sum(qtf * log10({BACKGROUND[method]})) AS score FROM allt GROUP BY qid, docno),
top AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, docno) AS rank FROM sc)
SELECT qid, docno, '{method}' AS method, round(score, 6) AS score, rank FROM top WHERE rank <= {k}"""


FEATURE_METHODS = ("bnn_bnn", "lnc_ltn", "lm_laplace", "lm_jm", "lm_dirichlet")


def features_cte() -> str:
    tops = ",\n".join(hits_cte(m) for m in FEATURE_METHODS)
    union = " UNION ALL ".join(f"SELECT qid, docno, method, score, rank FROM top_{m} WHERE rank <= 10" for m in FEATURE_METHODS)
    fcols = ",\n       ".join(
        f"CAST(coalesce(max(CASE WHEN method = '{m}' THEN 1.0 / rank END), 0) AS FLOAT) AS f{i + 1}"
        for i, m in enumerate(FEATURE_METHODS))
    return f"""{TEXT_CTE},
{tops},
hits AS ({union}),
cand AS (SELECT DISTINCT qid, docno FROM hits),
feat AS (SELECT qid, docno,
       {fcols}
  FROM hits GROUP BY qid, docno),
lab AS (SELECT CAST(doc_id AS VARCHAR) AS docno,
               CASE WHEN quality = 1 AND toxic = 0 THEN 2 WHEN quality = 1 THEN 1 WHEN toxic = 1 THEN -1 ELSE 0 END AS rel
        FROM labels),
pq AS (SELECT c.qid, c.docno, CAST(l.rel AS INTEGER) AS rel FROM cand c JOIN lab l ON c.docno = l.docno),
ltr AS (SELECT f.qid, f.docno, CAST(CASE WHEN pq.rel > 0 THEN 1 ELSE 0 END AS INTEGER) AS label, f.f1, f.f2, f.f3, f.f4, f.f5
        FROM feat f LEFT JOIN pq ON f.qid = pq.qid AND f.docno = pq.docno)"""


#: MAP along each weight from uniform weights: ranks counted anew after every swap of a query, then a running sum over all queries.
LINE_CTE = """
lx AS (SELECT qid, docno, label, feature, CAST(list_extract([f1, f2, f3, f4, f5], feature) AS DOUBLE) AS x,
              list_sum(list_transform([f1, f2, f3, f4, f5], lambda v: round(0.2 * CAST(v AS DOUBLE) * 4503599627370496.0))) / 4503599627370496.0 AS s
       FROM ltr, (SELECT unnest(range(1, 6)) AS feature)),
lp AS (SELECT r.qid, r.feature, r.docno AS d, r.s - e.s AS ds, r.x - e.x AS dx, e.docno <= r.docno AS tie, e.label
       FROM lx r JOIN lx e ON r.qid = e.qid AND r.feature = e.feature WHERE r.label > 0),
lt AS (SELECT DISTINCT qid, feature, d, round(-ds / dx, 9) + 0.0 AS t FROM lp WHERE dx <> 0
       UNION SELECT DISTINCT qid, feature, d, -1e300 FROM lp),
lv AS (SELECT lt.qid, lt.feature, lt.d, lt.t,
              sum(CASE WHEN up AND lp.label > 0 THEN 1 ELSE 0 END) / sum(CASE WHEN up THEN 1 ELSE 0 END) AS v
       FROM lt JOIN LATERAL (SELECT lp.label, CASE WHEN dx = 0 THEN ds < 0 OR (ds = 0 AND tie)
                                    WHEN dx > 0 THEN lt.t < round(-ds / dx, 9) ELSE lt.t >= round(-ds / dx, 9) END AS up
                             FROM lp WHERE lp.qid = lt.qid AND lp.feature = lt.feature AND lp.d = lt.d) lp ON true
       GROUP BY ALL),
lc AS (SELECT qid, feature, t, v - coalesce(lag(v) OVER (PARTITION BY qid, feature, d ORDER BY t), 0) AS c FROM lv),
ln AS (SELECT feature, t, sum(c / r) / (SELECT count(DISTINCT qid) FROM ltr) AS c
       FROM lc JOIN (SELECT qid, sum(label) AS r FROM ltr GROUP BY qid) USING (qid) GROUP BY feature, t),
line AS (SELECT CAST(feature AS INTEGER) AS feature, t, sum(c) OVER (PARTITION BY feature ORDER BY t) AS value,
                lead(t) OVER (PARTITION BY feature ORDER BY t) AS until FROM ln)"""

# ------------------------------------------------------------------ preferences (pairs materialised: brute force)

MULTI_PREFS = """
SELECT qid, jg, unnest(['ls_' || ls, 'rf_' || rf]) AS jsg, docno, rel_level FROM (
  SELECT qid, docno, ls, rf, '0' AS jg, lv0 AS rel_level FROM d0
  UNION ALL SELECT qid, docno, ls, rf, '1' AS jg, lv1 AS rel_level FROM d0) z"""

MULTI_PREFS_DOCS = """
SELECT CAST(l_orderkey AS VARCHAR) AS qid,
       CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS docno,
       CAST(max(floor(l_quantity / 10)) AS FLOAT) AS lv0,
       CAST(max(CASE WHEN l_tax >= 0.06 THEN 2 WHEN l_tax >= 0.03 THEN 1 ELSE 0 END) AS FLOAT) AS lv1,
       max(l_linestatus) AS ls, max(l_returnflag) AS rf
FROM lineitem GROUP BY 1, 2"""

RAW_PREFS = """
SELECT CAST(l_orderkey AS VARCHAR) AS qid, '0' AS jg, jsg, CAST(l_suppkey AS VARCHAR) AS docno, rel_level FROM (
  SELECT l_orderkey, l_suppkey, 'quantity' AS jsg, CAST(floor(l_quantity / 10) AS FLOAT) AS rel_level FROM lineitem
  UNION ALL SELECT l_orderkey, l_suppkey, 'tax', CAST(CASE WHEN l_tax >= 0.06 THEN 2 WHEN l_tax >= 0.03 THEN 1 ELSE 0 END AS FLOAT) FROM lineitem) z"""


def pref_faults_sql(prefs_sql: str) -> str:
    """The three faults by their definitions; cycles from the closure of all edges."""
    same = "c.qid = k.qid AND c.jg = k.jg"
    return f"""WITH RECURSIVE prefs AS ({prefs_sql}),
e AS (SELECT DISTINCT a.qid, a.jg, a.docno AS a, b.docno AS b FROM prefs a JOIN prefs b USING (qid, jg, jsg) WHERE a.rel_level > b.rel_level),
c AS (SELECT * FROM e UNION SELECT c.qid, c.jg, c.a, e.b FROM c JOIN e ON c.qid = e.qid AND c.jg = e.jg AND c.b = e.a),
k AS (SELECT DISTINCT qid, jg, a AS docno FROM c WHERE a = b),
below AS (SELECT DISTINCT c.qid, c.jg, c.b AS docno FROM c JOIN k ON {same} AND c.a = k.docno),
above AS (SELECT DISTINCT c.qid, c.jg, c.a AS docno FROM c JOIN k ON {same} AND c.b = k.docno)
SELECT qid, jg, docno, 'two levels in a sub-group' AS problem FROM prefs GROUP BY qid, jg, jsg, docno HAVING count(DISTINCT rel_level) > 1
UNION ALL
SELECT qid, jg, docno, 'zero and non-zero level in a group' FROM prefs GROUP BY qid, jg, docno HAVING min(rel_level) = 0 AND max(rel_level) > 0
UNION ALL
SELECT qid, jg, docno, 'in a cycle of preferences' FROM below JOIN above USING (qid, jg, docno)"""


QRELS_PREFS = f"SELECT qid, '0' AS jg, '0' AS jsg, docno, CAST(rel AS FLOAT) AS rel_level FROM ({DEEP_QRELS}) q WHERE rel >= 0"


def prefs_cte(prefs_sql: str, run_sql: str, pre: str = "") -> str:
    """CTEs ending in ``pm(run_id, qid, measure, value)`` (per topic)."""
    return f"""WITH RECURSIVE {pre}
prefs AS ({prefs_sql}),
prun AS ({run_sql}),
judged AS (SELECT DISTINCT qid, docno FROM prefs),
rr AS (SELECT run_id, qid, docno, row_number() OVER (PARTITION BY run_id, qid ORDER BY sim DESC, docno) AS rnk
       FROM prun WHERE qid IN (SELECT qid FROM judged)),
pos AS (SELECT t.run_id, j.qid, j.docno, r.rnk IS NOT NULL AS ret,
               row_number() OVER (PARTITION BY t.run_id, j.qid ORDER BY (r.rnk IS NOT NULL) DESC, r.rnk, j.docno) - 1 AS pos
        FROM judged j JOIN (SELECT DISTINCT run_id, qid FROM rr) t ON j.qid = t.qid
        LEFT JOIN rr r ON r.run_id = t.run_id AND r.qid = j.qid AND r.docno = j.docno),
nsub AS (SELECT qid, jg, count(DISTINCT jsg) AS nsub FROM prefs GROUP BY qid, jg),
gdoc AS (SELECT qid, jg, docno, max(rel_level) AS lvl FROM prefs GROUP BY qid, jg, docno),
e_one AS (SELECT a.qid, a.jg, a.docno AS a, b.docno AS b FROM gdoc a JOIN gdoc b ON a.qid = b.qid AND a.jg = b.jg
          WHERE a.lvl > b.lvl AND (a.qid, a.jg) IN (SELECT qid, jg FROM nsub WHERE nsub = 1)),
e_multi0 AS (SELECT DISTINCT a.qid, a.jg, a.docno AS a, b.docno AS b FROM prefs a JOIN prefs b
             ON a.qid = b.qid AND a.jg = b.jg AND a.jsg = b.jsg
             WHERE a.rel_level > b.rel_level AND (a.qid, a.jg) IN (SELECT qid, jg FROM nsub WHERE nsub > 1)),
clo(qid, jg, a, b) AS (
  SELECT qid, jg, a, b FROM e_multi0
  UNION
  SELECT c.qid, c.jg, c.a, e.b FROM clo c JOIN e_multi0 e ON c.qid = e.qid AND c.jg = e.jg AND c.b = e.a),
edges AS (SELECT qid, jg, a, b, 1 AS one_sub FROM e_one UNION ALL SELECT qid, jg, a, b, 0 FROM clo),
gd AS (SELECT p.run_id, g.qid, g.jg, g.docno, g.lvl, p.ret, p.pos,
              sum(CASE WHEN g.lvl = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY p.run_id, g.qid, g.jg ORDER BY p.pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nonrel_idx,
              sum(CASE WHEN g.lvl = 0 AND p.ret THEN 1 ELSE 0 END) OVER (PARTITION BY p.run_id, g.qid, g.jg ORDER BY p.pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ret_nonrel_idx
       FROM gdoc g JOIN pos p ON g.qid = p.qid AND g.docno = p.docno),
dc AS (SELECT run_id, qid, jg, count(*) AS n_docs, sum(CASE WHEN ret THEN 1 ELSE 0 END) AS n_ret,
              sum(CASE WHEN lvl > 0 THEN 1 ELSE 0 END) AS num_rel, sum(CASE WHEN lvl = 0 THEN 1 ELSE 0 END) AS num_nonrel,
              sum(CASE WHEN lvl > 0 AND ret THEN 1 ELSE 0 END) AS num_rel_ret,
              sum(CASE WHEN lvl = 0 AND ret THEN 1 ELSE 0 END) AS num_nonrel_ret
       FROM gd GROUP BY run_id, qid, jg),
ep AS (SELECT x.run_id, e.qid, e.jg, e.one_sub, x.docno AS a, y.docno AS b, x.lvl AS la, y.lvl AS lb,
              x.ret AS ra, y.ret AS rb, x.pos AS pa, y.pos AS pb, x.nonrel_idx AS ia, y.nonrel_idx AS ib,
              x.ret_nonrel_idx AS ria, y.ret_nonrel_idx AS rib
       FROM edges e JOIN gd x ON e.qid = x.qid AND e.jg = x.jg AND e.a = x.docno
       JOIN gd y ON e.qid = y.qid AND e.jg = y.jg AND e.b = y.docno AND x.run_id = y.run_id),
cnt AS (SELECT run_id, qid, jg, max(one_sub) AS one_sub,
               sum(CASE WHEN ra AND rb THEN 1 ELSE 0 END) AS poss_ret,
               sum(CASE WHEN ra AND rb AND pa < pb THEN 1 ELSE 0 END) AS ful_ret,
               sum(CASE WHEN ra <> rb THEN 1 ELSE 0 END) AS poss_imp,
               sum(CASE WHEN ra AND NOT rb THEN 1 ELSE 0 END) AS ful_imp,
               sum(CASE WHEN NOT ra AND NOT rb THEN 1 ELSE 0 END) AS poss_notoccur,
               sum(CASE WHEN la > 0 AND lb > 0 THEN 1 ELSE 0 END) AS ecA_poss,
               sum(CASE WHEN la > 0 AND lb > 0 AND ra AND pa < pb THEN 1 ELSE 0 END) AS ecA_ful,
               sum(CASE WHEN la > 0 AND lb > 0 AND ra AND rb THEN 1 ELSE 0 END) AS ecAr_poss,
               sum(CASE WHEN la > 0 AND lb > 0 AND ra AND rb AND pa < pb THEN 1 ELSE 0 END) AS ecAr_ful
        FROM ep GROUP BY run_id, qid, jg),
grp AS (SELECT d.run_id, d.qid, d.jg, n.nsub, d.n_docs, d.n_ret, d.num_rel, d.num_nonrel, d.num_rel_ret, d.num_nonrel_ret,
               coalesce(c.poss_ret, 0) AS poss_ret, coalesce(c.ful_ret, 0) AS ful_ret, coalesce(c.poss_imp, 0) AS poss_imp,
               coalesce(c.ful_imp, 0) AS ful_imp, coalesce(c.poss_notoccur, 0) AS poss_notoccur,
               coalesce(c.ecA_poss, 0) AS ecA_poss, coalesce(c.ecA_ful, 0) AS ecA_ful,
               coalesce(c.ecAr_poss, 0) AS ecAr_poss, coalesce(c.ecAr_ful, 0) AS ecAr_ful
        FROM dc d JOIN nsub n ON d.qid = n.qid AND d.jg = n.jg
        LEFT JOIN cnt c ON d.run_id = c.run_id AND d.qid = c.qid AND d.jg = c.jg),
-- one sub-group recount: every group document against the first num_rel nonrelevant ones (itself included)
kept AS (SELECT g.run_id, g.qid, g.jg,
                sum(CASE WHEN x.ret AND x.pos < y.pos THEN 1 ELSE 0 END) AS ful_b, count(*) AS poss_b
         FROM gd y JOIN dc g ON y.run_id = g.run_id AND y.qid = g.qid AND y.jg = g.jg
         JOIN gd x ON x.run_id = y.run_id AND x.qid = y.qid AND x.jg = y.jg
         WHERE y.lvl = 0 AND y.nonrel_idx <= g.num_rel GROUP BY g.run_id, g.qid, g.jg),
kept_r AS (SELECT g.run_id, g.qid, g.jg,
                  sum(CASE WHEN x.pos < y.pos THEN 1 ELSE 0 END) AS ful_b, count(*) AS poss_b
           FROM gd y JOIN dc g ON y.run_id = g.run_id AND y.qid = g.qid AND y.jg = g.jg
           JOIN gd x ON x.run_id = y.run_id AND x.qid = y.qid AND x.jg = y.jg AND x.ret
           WHERE y.lvl = 0 AND y.ret AND y.nonrel_idx <= g.num_rel_ret GROUP BY g.run_id, g.qid, g.jg),
-- several sub-groups recount: drop nonrelevant documents beyond the first num_rel
arr AS (SELECT run_id, qid, jg,
               sum(CASE WHEN ra AND pa < pb THEN 1 ELSE 0 END) AS ful, count(*) AS poss
        FROM ep e JOIN dc USING (run_id, qid, jg)
        WHERE e.one_sub = 0 AND NOT (la = 0 AND ia > num_rel) AND NOT (lb = 0 AND ib > num_rel)
        GROUP BY run_id, qid, jg),
arr_r AS (SELECT run_id, qid, jg,
                 sum(CASE WHEN pa < pb THEN 1 ELSE 0 END) AS ful, count(*) AS poss
          FROM ep e JOIN dc USING (run_id, qid, jg)
          WHERE e.one_sub = 0 AND ra AND rb AND NOT (la = 0 AND ria > num_rel) AND NOT (lb = 0 AND rib > num_rel)
          GROUP BY run_id, qid, jg),
g2 AS (SELECT g.*,
  CASE WHEN num_rel >= num_nonrel THEN ful_ret + ful_imp + num_rel_ret * (num_rel - num_nonrel)
       WHEN nsub = 1 THEN ecA_ful + coalesce(k.ful_b, 0) ELSE coalesce(a.ful, 0) END AS rn_ful,
  CASE WHEN num_rel >= num_nonrel THEN poss_ret + poss_imp + poss_notoccur + num_rel * (num_rel - num_nonrel)
       WHEN nsub = 1 THEN ecA_poss + coalesce(k.poss_b, 0) ELSE coalesce(a.poss, 0) END AS rn_poss,
  CASE WHEN num_rel_ret >= num_nonrel_ret THEN ful_ret + num_rel_ret * (num_rel_ret - num_nonrel_ret)
       WHEN nsub = 1 THEN ecAr_ful + coalesce(kr.ful_b, 0) ELSE coalesce(ar.ful, 0) END AS rr_ful,
  CASE WHEN num_rel_ret >= num_nonrel_ret THEN poss_ret + num_rel * (num_rel_ret - num_nonrel_ret)
       WHEN nsub = 1 THEN ecAr_poss + coalesce(kr.poss_b, 0) ELSE coalesce(ar.poss, 0) END AS rr_poss
  FROM grp g
  LEFT JOIN kept k USING (run_id, qid, jg) LEFT JOIN kept_r kr USING (run_id, qid, jg)
  LEFT JOIN arr a USING (run_id, qid, jg) LEFT JOIN arr_r ar USING (run_id, qid, jg)),
topic AS (SELECT run_id, qid, count(*) AS njg,
  sum(poss_ret + poss_imp + poss_notoccur) AS poss, sum(ful_ret + ful_imp) AS ful, sum(ful_ret) AS ful_ret,
  sum(poss_ret) AS poss_ret, sum(poss_ret + poss_imp) AS poss_ri,
  sum(CASE WHEN poss_ret + poss_imp + poss_notoccur > 0 THEN (ful_ret + ful_imp) / (poss_ret + poss_imp + poss_notoccur) ELSE 0 END) AS s_all,
  sum(CASE WHEN poss_ret > 0 THEN ful_ret / poss_ret ELSE 0 END) AS s_ret,
  sum(CASE WHEN poss_ret + poss_imp > 0 THEN (ful_ret + ful_imp) / (poss_ret + poss_imp) ELSE 0 END) AS s_imp,
  sum(CASE WHEN rn_poss > 0 THEN rn_ful / rn_poss ELSE 0 END) AS s_rn, max(CASE WHEN rn_poss = 0 THEN 1 ELSE 0 END) AS nan_rn,
  sum(CASE WHEN rr_poss > 0 THEN rr_ful / rr_poss ELSE 0 END) AS s_rnr, max(CASE WHEN rr_poss = 0 THEN 1 ELSE 0 END) AS nan_rnr
  FROM g2 GROUP BY run_id, qid),
pc0 AS (SELECT run_id, qid, CASE WHEN pa < pb THEN a ELSE b END AS x, CASE WHEN pa < pb THEN b ELSE a END AS y,
               CASE WHEN pa < pb THEN 1 ELSE 0 END AS fwd, CASE WHEN pa < pb THEN ra ELSE rb END AS rx,
               CASE WHEN pa < pb THEN rb ELSE ra END AS ry FROM ep),
pc AS (SELECT run_id, qid, x, y, sum(fwd) AS nxy, sum(1 - fwd) AS nyx, bool_or(rx) AS rx, bool_or(ry) AS ry
       FROM pc0 GROUP BY run_id, qid, x, y),
pairs AS (SELECT run_id, qid,
  sum(CASE WHEN rx THEN nxy / (nxy + nyx) ELSE 0 END) AS s, count(*) AS n_all,
  sum(CASE WHEN rx THEN 1 ELSE 0 END) AS n_imp,
  sum(CASE WHEN rx AND ry THEN nxy / (nxy + nyx) ELSE 0 END) AS ps_ret, sum(CASE WHEN rx AND ry THEN 1 ELSE 0 END) AS n_ret
  FROM pc GROUP BY run_id, qid),
tv AS (SELECT t.*, p.s, p.n_all, p.n_imp, p.ps_ret, p.n_ret FROM topic t LEFT JOIN pairs p USING (run_id, qid)),
pm AS (
  SELECT run_id, qid, 'prefs_num_prefs_poss' AS measure, CAST(poss AS DOUBLE) AS value FROM tv
  UNION ALL SELECT run_id, qid, 'prefs_num_prefs_ful', CAST(ful AS DOUBLE) FROM tv
  UNION ALL SELECT run_id, qid, 'prefs_num_prefs_ful_ret', CAST(ful_ret AS DOUBLE) FROM tv
  UNION ALL SELECT run_id, qid, 'prefs_simp', CASE WHEN poss > 0 THEN ful / poss ELSE 0 END FROM tv
  UNION ALL SELECT run_id, qid, 'prefs_simp_ret', CASE WHEN poss_ret > 0 THEN ful_ret / poss_ret ELSE 0 END FROM tv
  UNION ALL SELECT run_id, qid, 'prefs_simp_imp', CASE WHEN poss_ri > 0 THEN ful / poss_ri ELSE 0 END FROM tv
  UNION ALL SELECT run_id, qid, 'prefs_avgjg', CASE WHEN s_all > 0 THEN s_all / njg ELSE 0 END FROM tv
  UNION ALL SELECT run_id, qid, 'prefs_avgjg_ret', CASE WHEN s_ret > 0 THEN s_ret / njg ELSE 0 END FROM tv
  UNION ALL SELECT run_id, qid, 'prefs_avgjg_imp', CASE WHEN s_imp > 0 THEN s_imp / njg ELSE 0 END FROM tv
  UNION ALL SELECT run_id, qid, 'prefs_avgjg_Rnonrel', CASE WHEN nan_rn = 0 AND s_rn > 0 THEN s_rn / njg ELSE 0 END FROM tv
  UNION ALL SELECT run_id, qid, 'prefs_avgjg_Rnonrel_ret', CASE WHEN nan_rnr = 0 AND s_rnr > 0 THEN s_rnr / njg ELSE 0 END FROM tv
  UNION ALL SELECT run_id, qid, 'prefs_pair', CASE WHEN coalesce(n_all, 0) > 0 THEN s / n_all ELSE 0 END FROM tv
  UNION ALL SELECT run_id, qid, 'prefs_pair_imp', CASE WHEN coalesce(n_imp, 0) > 0 THEN s / n_imp ELSE 0 END FROM tv
  UNION ALL SELECT run_id, qid, 'prefs_pair_ret', CASE WHEN coalesce(n_ret, 0) > 0 THEN ps_ret / n_ret ELSE 0 END FROM tv)"""


SUMMED_PREFS = ("prefs_num_prefs_poss", "prefs_num_prefs_ful", "prefs_num_prefs_ful_ret")


def prefs_input_cte(which: str = "multi") -> str:
    if which == "multi":
        return prefs_cte(MULTI_PREFS, PREFS_RUN, pre=f"d0 AS ({MULTI_PREFS_DOCS}),")
    return prefs_cte(QRELS_PREFS, DEEP_RUN)


def prefs_measure_sql(measure: str, which: str = "multi") -> str:
    cte = prefs_input_cte(which)
    agg = "sum(value)" if measure in SUMMED_PREFS else "avg(value)"
    return f"""{cte}
SELECT run_id, qid, measure, round(value, 6) AS value FROM pm WHERE measure = '{measure}'
UNION ALL SELECT run_id, 'all', measure, round({agg}, 6) FROM pm WHERE measure = '{measure}' GROUP BY run_id, measure"""


def prefs_all_sql(which: str = "qrels") -> str:
    return f"""{prefs_input_cte(which)}
SELECT run_id, qid, measure, round(value, 6) AS value FROM pm
UNION ALL SELECT run_id, 'all', measure,
  round(CASE WHEN measure IN {SUMMED_PREFS} THEN sum(value) ELSE avg(value) END, 6) FROM pm GROUP BY run_id, measure"""


# ------------------------------------------------------------------ nested articles

ARTICLE_CTE = """
cn AS (SELECT c.*, n.n_regionkey FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
nodes AS (
  SELECT CAST(n_regionkey AS VARCHAR) AS page_id, 'n' || CAST(n_nationkey AS VARCHAR) AS node_id, CAST(NULL AS VARCHAR) AS parent_id,
         CAST(n_nationkey AS BIGINT) AS ord, 'section' AS kind, n_name AS heading, replace(n_name, ' ', '%20') AS heading_id,
         CAST(NULL AS VARCHAR) AS para_id FROM nation
  UNION ALL
  SELECT CAST(n_regionkey AS VARCHAR), 'n' || CAST(c_nationkey AS VARCHAR) || '/' || c_mktsegment, 'n' || CAST(c_nationkey AS VARCHAR),
         CAST(min(c_custkey) AS BIGINT), 'section', c_mktsegment, replace(c_mktsegment, ' ', '%20'), NULL
  FROM cn WHERE c_acctbal >= 0 GROUP BY n_regionkey, c_nationkey, c_mktsegment
  UNION ALL
  SELECT CAST(n_regionkey AS VARCHAR), 'c' || CAST(c_custkey AS VARCHAR),
         CASE WHEN c_acctbal >= 0 THEN 'n' || CAST(c_nationkey AS VARCHAR) || '/' || c_mktsegment ELSE 'n' || CAST(c_nationkey AS VARCHAR) END,
         CAST(c_custkey AS BIGINT), 'para', NULL, NULL, CAST(c_custkey AS VARCHAR) FROM cn),
paths(page_id, node_id, path_ids, headings) AS (
  SELECT page_id, node_id, [heading_id], [heading] FROM nodes WHERE kind = 'section' AND parent_id IS NULL
  UNION ALL
  SELECT s.page_id, s.node_id, list_append(p.path_ids, s.heading_id), list_append(p.headings, s.heading)
  FROM nodes s JOIN paths p ON s.parent_id = p.node_id AND s.page_id = p.page_id WHERE s.kind = 'section'),
pp AS (SELECT page_id, node_id, headings, array_to_string(list_prepend(page_id, path_ids), '/') AS section_path_id FROM paths),
spara AS (
  SELECT x.page_id, p.section_path_id, p.headings, x.para_id, x.ord FROM nodes x JOIN pp p ON x.parent_id = p.node_id AND x.page_id = p.page_id
  WHERE x.kind = 'para'
  UNION ALL
  SELECT page_id, page_id, CAST([] AS VARCHAR[]), para_id, ord FROM nodes WHERE kind = 'para' AND parent_id IS NULL),
bodies AS (
  SELECT CAST(conv_id AS VARCHAR) AS para_id, CAST(turn AS BIGINT) AS turn,
         CASE WHEN role = 'user' THEN 'text' ELSE 'link' END AS kind,
         CASE WHEN role = 'user' THEN text END AS text,
         CASE WHEN role <> 'user' THEN role END AS page,
         CASE WHEN role <> 'user' THEN role || '/' || CAST(conv_id AS VARCHAR) END AS page_id,
         CASE WHEN role <> 'user' AND turn > 1 THEN CAST(turn AS VARCHAR) END AS link_section,
         CASE WHEN role <> 'user' THEN text END AS anchor
  FROM conversations),
ptext AS (SELECT para_id, string_agg(CASE WHEN kind = 'text' THEN text ELSE anchor END, '' ORDER BY turn) AS text FROM bodies GROUP BY para_id),
pages AS (SELECT CAST(r_regionkey AS VARCHAR) AS page_id, r_name AS page_name FROM region)"""


def article_sql(select: str) -> str:
    return f"WITH RECURSIVE {ARTICLE_CTE}\n{select}"
