"""Registry of query keys -> (Spark callable, oracle SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import oracle as O
from ranklens.plans.evaluate import evaluate, evaluate_text
from ranklens.session import written
from ranklens.sources import read_run
from ranklens.sources import tables as T

REGISTRY: dict[str, tuple] = {}


def register(key: str, sql: str | None):
    def deco(fn):
        REGISTRY[key] = (fn, sql)
        return fn

    return deco


def _r6(df: DataFrame, col: str = "value") -> DataFrame:
    return df.withColumn(col, F.round(F.col(col).cast("double"), 6))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    run, qrels = T.deep_run(spark, sf), T.deep_qrels(spark, sf)
    return _r6(evaluate(run, qrels, "official"))


# ------------------------------------------------------------------ qrels measures

_QRELS_MEASURES = [
    "num_ret", "num_rel", "num_rel_ret", "num_nonrel_judged_ret", "map", "gm_map", "Rprec", "bpref",
    "gm_bpref", "recip_rank", "iprec_at_recall", "11pt_avg", "P", "recall", "relative_P", "success",
    "map_cut", "Rprec_mult", "infAP", "utility", "binG", "G", "ndcg", "ndcg_cut", "ndcg_rel",
    "set_P", "set_recall", "set_relative_P", "set_map", "set_F",
]


def _measure_query(name: str):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        run, qrels = T.deep_run(spark, sf), T.deep_qrels(spark, sf)
        df = evaluate(run, qrels, [name])
        return _r6(df.where(F.col("measure") != "num_q"))

    return q


for _m in _QRELS_MEASURES:
    register(_m, O.measure_sql(_m))(_measure_query(_m))
register("Rndcg", O.rndcg_sql())(_measure_query("Rndcg"))


@register("relstring", O.relstring_sql())
def q_relstring(spark, sf):
    return evaluate_text(T.deep_run(spark, sf), T.deep_qrels(spark, sf), ["relstring"])


# ------------------------------------------------------------------ judgment groups

from ranklens.plans.evaluate import evaluate_jg  # noqa: E402
from ranklens.operators import ranked as RK  # noqa: E402


def _jg_query(name):
    def q(spark, sf):
        df = evaluate_jg(T.deep_run(spark, sf), T.deep_qrels_jg(spark, sf), [name])
        return _r6(df.where(F.col("measure") != "num_q"))

    return q


for _m in ("map_avgjg", "P_avgjg", "Rprec_mult_avgjg"):
    register(_m, O.jg_measure_sql(_m))(_jg_query(_m))


# ------------------------------------------------------------------ ranked-list operators

_RANKED = ["run_id", "qid", "docno", "sim", "rank", "rel"]


@register("ranked", O.ranked_sql(O.TIED_RUN))
def q_ranked(spark, sf):
    return RK.build_ranked(T.tied_run(spark, sf), T.deep_qrels(spark, sf)).select(*_RANKED)


@register("max_docs", O.ranked_sql(O.DEEP_RUN, max_docs=100))
def q_max_docs(spark, sf):
    return RK.build_ranked(T.deep_run(spark, sf), T.deep_qrels(spark, sf), max_docs_=100).select(*_RANKED)


@register("judged_only", O.ranked_sql(O.DEEP_RUN, judged_only=True))
def q_judged_only(spark, sf):
    return RK.build_ranked(T.deep_run(spark, sf), T.deep_qrels(spark, sf), judged_only_=True).select(*_RANKED)


@register("relevance_level", O.measure_sql("map", level=2))
def q_relevance_level(spark, sf):
    df = evaluate(T.deep_run(spark, sf), T.deep_qrels(spark, sf), ["map"], relevance_level=2)
    return _r6(df.where(F.col("measure") != "num_q"))


@register("topic_stats", O.topic_stats_sql())
def q_topic_stats(spark, sf):
    qrels = T.deep_qrels(spark, sf)
    ranked = RK.build_ranked(T.deep_run(spark, sf), qrels)
    return RK.topic_stats(ranked, qrels)


@register("topic_join", f"""SELECT DISTINCT run_id, qid FROM ({O.TRUNC_RUN}) r
WHERE qid IN (SELECT qid FROM ({O.DEEP_QRELS}) q)""")
def q_topic_join(spark, sf):
    return RK.topic_join(T.trunc_run(spark, sf), T.deep_qrels(spark, sf)).select("run_id", "qid").distinct()


@register("ranked_jg", f"WITH {O.jg_rows_cte()} SELECT run_id, qid, jg, docno, rank, CAST(rel AS INTEGER) AS rel FROM ranked")
def q_ranked_jg(spark, sf):
    return RK.build_ranked_jg(T.deep_run(spark, sf), T.deep_qrels_jg(spark, sf)).select(
        "run_id", "qid", "jg", "docno", "rank", "rel"
    )


def _complete_sql():
    judged = f"(SELECT count(DISTINCT qid) FROM ({O.DEEP_QRELS}) q)"
    m = f"SELECT * FROM ({O.measure_sql('map', O.TRUNC_RUN, rounded=False)}) x WHERE qid <> 'all'"
    g = f"SELECT * FROM ({O.measure_sql('gm_map', O.TRUNC_RUN, rounded=False)}) x WHERE qid = 'all'"
    # gm_map per-topic logs are not printed; rebuild them from the per-topic map values
    return f"""WITH m AS ({m}),
nq AS (SELECT {judged} AS n)
SELECT run_id, 'all' AS qid, 'map' AS measure, round(sum(value) / max(n), 6) AS value FROM m, nq GROUP BY run_id
UNION ALL
SELECT run_id, 'all', 'gm_map', round(exp((sum(ln(greatest(value, 1e-5))) + (max(n) - count(*)) * ln(1e-5)) / max(n)), 6) FROM m, nq GROUP BY run_id
UNION ALL
SELECT run_id, 'all', 'num_q', CAST(max(n) AS DOUBLE) FROM m, nq GROUP BY run_id"""


@register("complete_topics", _complete_sql())
def q_complete_topics(spark, sf):
    df = evaluate(T.trunc_run(spark, sf), T.deep_qrels(spark, sf), ["map", "gm_map"], complete=True, per_topic=False)
    return _r6(df)


@register("validate_run", O.duplicates_sql(O.RAW_RUN_KEYS))
def q_validate_run(spark, sf):
    li = T.table(spark, sf, "lineitem")
    raw = li.select(F.col("l_suppkey").cast("string").alias("qid"), T._doc_key().alias("docno"))
    return RK.duplicates(raw)


@register("validate_qrels", O.duplicates_sql(O.RAW_QRELS_KEYS))
def q_validate_qrels(spark, sf):
    li = T.table(spark, sf, "lineitem").where((F.col("l_returnflag") != "N") | (F.col("l_linestatus") == "F"))
    raw = li.select(F.col("l_suppkey").cast("string").alias("qid"), T._doc_key().alias("docno"))
    return RK.duplicates(raw)


_TOP_SUPPLIER = "(SELECT CAST(s_suppkey AS VARCHAR) FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 1)"


@register("topic_filter", O.summary_rows_sql(["map", "P"], f"SELECT * FROM ({O.DEEP_RUN}) r WHERE qid IN {_TOP_SUPPLIER}", only_all=False))
def q_topic_filter(spark, sf):
    sup = T.table(spark, sf, "supplier")
    top = sup.orderBy(F.col("s_acctbal").desc(), F.col("s_suppkey")).limit(1).select(F.col("s_suppkey").cast("string").alias("qid"))
    run = RK.topic_filter(T.deep_run(spark, sf), top)
    df = evaluate(run, T.deep_qrels(spark, sf), ["map", "P"])
    return _r6(df.where(F.col("measure") != "num_q"))


@register("runid", f"SELECT DISTINCT run_id, 'all' AS qid, 'runid' AS measure, run_id AS value FROM ({O.DEEP_RUN}) r")
def q_runid(spark, sf):
    return evaluate_text(T.deep_run(spark, sf), T.deep_qrels(spark, sf), ["runid"])


@register("num_q", O.num_q_sql(O.DEEP_RUN))
def q_num_q(spark, sf):
    return _r6(evaluate(T.deep_run(spark, sf), T.deep_qrels(spark, sf), ["map"], per_topic=False).where(F.col("measure") == "num_q"))


_TWO_RUNS = f"{O.DEEP_RUN} UNION ALL {O.TIED_RUN}"
_SUMMARY_MEASURES = ["num_ret", "map", "gm_map", "P", "ndcg", "bpref"]


def _two_runs(spark, sf):
    return T.deep_run(spark, sf).unionByName(T.tied_run(spark, sf))


@register("summary", O.summary_rows_sql(_SUMMARY_MEASURES, _TWO_RUNS) + "\nUNION ALL\n" + O.num_q_sql(_TWO_RUNS))
def q_summary(spark, sf):
    return _r6(evaluate(_two_runs(spark, sf), T.deep_qrels(spark, sf), _SUMMARY_MEASURES, per_topic=False))


@register("per_topic", O.summary_rows_sql(["map", "recip_rank"], _TWO_RUNS, only_all=False))
def q_per_topic(spark, sf):
    df = evaluate(_two_runs(spark, sf), T.deep_qrels(spark, sf), ["map", "recip_rank"])
    return _r6(df.where(F.col("measure") != "num_q"))


def _zscore_sql():
    pt = "\nUNION ALL\n".join(
        f"SELECT * FROM ({O.measure_sql(n, _TWO_RUNS, rounded=False)}) x WHERE qid <> 'all'" for n in ("map", "P")
    )
    return f"""WITH pt AS ({pt}),
zref AS (SELECT qid, measure, avg(value) AS mean, stddev_samp(value) AS sd FROM pt GROUP BY qid, measure),
z AS (
  SELECT p.run_id, p.qid, 'Z' || p.measure AS measure,
         CASE WHEN z.mean IS NULL THEN -1000000.0
              WHEN z.sd = 0 THEN CASE WHEN p.value = z.mean THEN 0.0 ELSE -1000000.0 END
              ELSE (p.value - z.mean) / z.sd END AS value
  FROM pt p LEFT JOIN zref z ON p.qid = z.qid AND p.measure = z.measure WHERE p.run_id = 'deep')
SELECT run_id, qid, measure, round(value, 6) AS value FROM z
UNION ALL SELECT run_id, 'all', measure, round(avg(value), 6) FROM z GROUP BY run_id, measure
UNION ALL SELECT 'deep', 'all', 'Znum_q', CAST(count(DISTINCT qid) AS DOUBLE) FROM z"""


@register("zscore", _zscore_sql())
def q_zscore(spark, sf):
    qrels = T.deep_qrels(spark, sf)
    pt = evaluate(_two_runs(spark, sf), qrels, ["map", "P"]).where(F.col("qid") != "all")
    zref = pt.groupBy("qid", "measure").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("stddev"))
    return _r6(evaluate(T.deep_run(spark, sf), qrels, ["map", "P"], zref=zref))


_SET = ["num_ret", "num_rel", "num_rel_ret", "utility", "set_P", "set_recall", "set_relative_P", "set_map", "set_F"]


@register("measure_groups", O.summary_rows_sql(_SET, O.DEEP_RUN, only_all=False) + "\nUNION ALL\n" + O.num_q_sql(O.DEEP_RUN))
def q_measure_groups(spark, sf):
    return _r6(evaluate(T.deep_run(spark, sf), T.deep_qrels(spark, sf), "set"))


def _params_sql():
    a = O.measure_sql("P", cuts=(3, 7))
    b = O.measure_sql("success", cuts=(2, 20))
    return f"SELECT * FROM ({a}) x UNION ALL SELECT * FROM ({b}) y"


@register("measure_params", _params_sql())
def q_measure_params(spark, sf):
    df = evaluate(T.deep_run(spark, sf), T.deep_qrels(spark, sf), ["P.7,3", "success.20,2,2"])
    return _r6(df.where(F.col("measure") != "num_q"))


# ------------------------------------------------------------------ text analysis and statistics

from ranklens.functions import text as TX  # noqa: E402
from ranklens.operators import index as IX  # noqa: E402
from ranklens.operators import scoring as SC  # noqa: E402
from ranklens.session import scratch_path  # noqa: E402


@register("tokenize_standard", f"WITH {O.TEXT_CTE} SELECT docno, std AS tokens FROM an")
def q_tokenize_standard(spark, sf):
    return T.corpus(spark, sf).select("docno", TX.tokenize_standard("text").alias("tokens"))


@register("tokenize_unigram", f"WITH {O.TEXT_CTE} SELECT docno, uni AS tokens FROM an")
def q_tokenize_unigram(spark, sf):
    return T.corpus(spark, sf).select("docno", TX.tokenize_unigram("text").alias("tokens"))


@register("query_terms", f"WITH {O.TEXT_CTE} SELECT qid, term, qtf, qpos FROM qt")
def q_query_terms(spark, sf):
    return IX.query_terms(T.topics(spark, sf))


@register("query_tf", f"WITH {O.TEXT_CTE} SELECT qid, term, qtf FROM qt")
def q_query_tf(spark, sf):
    return IX.query_tf(T.topics(spark, sf))


@register("postings", f"WITH {O.TEXT_CTE} SELECT term, docno, tf FROM post")
def q_postings(spark, sf):
    return IX.postings(T.corpus(spark, sf)).select("term", "docno", "tf")


@register("doc_stats", f"WITH {O.TEXT_CTE} SELECT docno, dlen, ulen, uvoc FROM ds")
def q_doc_stats(spark, sf):
    return IX.doc_stats(T.corpus(spark, sf))


@register("term_stats", f"""WITH {O.TEXT_CTE}
SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM post GROUP BY term""")
def q_term_stats(spark, sf):
    return IX.term_stats(IX.postings(T.corpus(spark, sf)))


@register("collection_stats", f"WITH {O.TEXT_CTE} SELECT num_docs, sum_tf, round(avg_dlen, 6) AS avg_dlen FROM cs")
def q_collection_stats(spark, sf):
    cs = IX.collection_stats(IX.doc_stats(T.corpus(spark, sf)))
    return _r6(cs, "avg_dlen")


@register("term_topk", f"""WITH {O.TEXT_CTE}
SELECT qid, term, docno, tf FROM (
  SELECT qid, term, docno, tf, row_number() OVER (PARTITION BY qid, term ORDER BY tf DESC, docno) AS rn FROM m) z
WHERE rn <= 10""")
def q_term_topk(spark, sf):
    corpus = T.corpus(spark, sf)
    m = SC.match(IX.query_terms(T.topics(spark, sf)), IX.postings(corpus)).withColumn("s", F.col("tf"))
    return SC.term_topk(m, 10).select("qid", "term", "docno", "tf")


def _stored_index(spark, sf):
    """The corpus written as an index, small salts and blocks so that every branch runs, and read back."""
    path = scratch_path(spark, "index")
    IX.write_index(T.corpus(spark, sf), path, buckets=8, block=16, salt_postings=100)
    return IX.read_index(spark, path, buckets=8)


@register("postings_stored", f"WITH {O.TEXT_CTE} SELECT post.term, post.docno, post.tf, ds.dlen, ds.ulen, ds.uvoc FROM post JOIN ds USING (docno)")
def q_postings_stored(spark, sf):
    return _stored_index(spark, sf).postings()


@register("term_topk_stored", REGISTRY["term_topk"][1])
def q_term_topk_stored(spark, sf):
    qt = IX.query_terms(T.topics(spark, sf))
    best = _stored_index(spark, sf).top_postings(qt, "tf", 10)
    return SC.term_topk(best.join(qt, "term").withColumn("s", F.col("tf")), 10).select("qid", "term", "docno", "tf")


def _score_stored_query(method):
    def q(spark, sf):
        return _r6(SC.score(method, T.topics(spark, sf), index=_stored_index(spark, sf)), "score")

    return q


for _meth in ("lnc_ltn", "lm_jm", "bm25"):
    register(f"score_stored_{_meth}", O.hits_sql(_meth))(_score_stored_query(_meth))


def _score_query(method):
    def q(spark, sf):
        h = SC.score(method, T.topics(spark, sf), T.corpus(spark, sf))
        return _r6(h, "score")

    return q


for _meth, _key in [("bnn_bnn", "score_bnn_bnn"), ("lnc_ltn", "score_lnc_ltn"), ("lm_laplace", "score_lm_laplace"),
                    ("lm_jm", "score_lm_jm"), ("lm_dirichlet", "score_lm_dirichlet"), ("raw_tf", "score_raw_tf"),
                    ("bm25", "score_default")]:
    register(_key, O.hits_sql(_meth))(_score_query(_meth))


def _background_query(method):
    def q(spark, sf):
        return _r6(SC.score(method, T.topics(spark, sf), T.corpus(spark, sf), background=True), "score")

    return q


for _meth in ("lm_jm", "lm_dirichlet"):
    register(f"score_{_meth}_background", O.background_sql(_meth))(_background_query(_meth))


@register("topk_per_query", O.hits_sql("raw_tf", k=3))
def q_topk_per_query(spark, sf):
    corpus = T.corpus(spark, sf)
    h = SC.score("raw_tf", T.topics(spark, sf), corpus, k=3)
    return _r6(h, "score")


# ------------------------------------------------------------------ fusion, features, learning to rank

from ranklens.operators import features as FE  # noqa: E402
from ranklens.operators import ltr as LT  # noqa: E402


def _hits(spark, sf):
    # the best documents of every query, read by features, candidates and labels: scored once
    return written(SC.score_many(T.topics(spark, sf), T.corpus(spark, sf)), "hits")


def _text_qrels(spark, sf, hits=None):
    hits = _hits(spark, sf) if hits is None else hits
    return FE.pooled_qrels(FE.union_candidates(hits), T.table(spark, sf, "labels"))


def _ltr(spark, sf):
    hits = _hits(spark, sf)
    return FE.ltr_dataset(hits, _text_qrels(spark, sf, hits))


@register("union_candidates", f"WITH {O.features_cte()} SELECT qid, docno FROM cand")
def q_union_candidates(spark, sf):
    return FE.union_candidates(_hits(spark, sf))


@register("rr_features", f"WITH {O.features_cte()} SELECT * FROM feat")
def q_rr_features(spark, sf):
    return FE.rr_features(_hits(spark, sf))


@register("relevance_label", f"WITH {O.features_cte()} SELECT qid, docno, label FROM ltr")
def q_relevance_label(spark, sf):
    hits = _hits(spark, sf)
    return FE.relevance_label(FE.union_candidates(hits), _text_qrels(spark, sf, hits))


@register("ltr_dataset", f"WITH {O.features_cte()} SELECT * FROM ltr")
def q_ltr_dataset(spark, sf):
    return _ltr(spark, sf)


_W5 = LT.MODEL_WEIGHTS_5
_DOT = " + ".join(f"{w!r} * CAST(f{i + 1} AS DOUBLE)" for i, w in enumerate(_W5))


@register("linear_rerank", f"""WITH {O.features_cte()},
s AS (SELECT qid, docno, label, ({_DOT}) AS score FROM ltr)
SELECT qid, docno, label, round(score, 6) AS score,
       row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, docno) AS rank FROM s""")
def q_linear_rerank(spark, sf):
    r = LT.linear_rerank(_ltr(spark, sf), _W5)
    return _r6(r.select("qid", "docno", "label", "score", "rank"), "score")


@register("kfold_split", f"""WITH {O.features_cte()}
SELECT DISTINCT qid, CAST(CAST(('0x' || substr(md5(qid), 1, 8)) AS BIGINT) % 5 AS INTEGER) AS fold FROM ltr""")
def q_kfold_split(spark, sf):
    return LT.kfold_split(_ltr(spark, sf)).select("qid", "fold").distinct()


@register("weight_line", f"""WITH {O.features_cte()},
{O.LINE_CTE}
SELECT feature, round(max(value), 6) AS best_map FROM line WHERE until IS NULL OR until - t > 1e-6 GROUP BY feature""")
def q_weight_line(spark, sf):
    feats = written(_ltr(spark, sf), "features")
    best = LT.best_steps(LT.line_steps(feats, [(-1, [0.2] * 5)]), ("coord",))
    return best.select((F.col("coord") + 1).alias("feature"), F.round("value", 6).alias("best_map"))


@register("weight_search", None)
def q_weight_search(spark, sf):
    w, m = LT.weight_search(_ltr(spark, sf))
    return spark.createDataFrame([(i + 1, float(x), float(m)) for i, x in enumerate(w)], "feature int, weight double, train_map double")


@register("cv_eval", None)
def q_cv_eval(spark, sf):
    return LT.cv_eval(_ltr(spark, sf), 5)


# ------------------------------------------------------------------ preferences

from ranklens.operators import prefs as PR  # noqa: E402
from ranklens.plans.evaluate import evaluate_prefs  # noqa: E402
from ranklens.functions import catalog as CAT  # noqa: E402


def _prefs_query(name):
    def q(spark, sf):
        df = evaluate_prefs(T.prefs_run(spark, sf), T.multi_prefs(spark, sf), [name], docs=T.pref_docs(spark, sf), sizes=T.pref_sizes(spark, sf))
        return _r6(df.where(F.col("measure") != "num_q"))

    return q


for _m in CAT.PREF_MEASURES:
    register(_m, O.prefs_measure_sql(_m))(_prefs_query(_m))


@register("prefs_measures_qrels", O.prefs_all_sql("qrels"))
def q_prefs_measures_qrels(spark, sf):
    df = evaluate_prefs(T.deep_run(spark, sf), T.qrels_prefs(spark, sf), "all_prefs")
    return _r6(df.where(F.col("measure") != "num_q"))


@register("pref_positions", f"{O.prefs_input_cte('multi')} SELECT run_id, qid, docno, ret, CAST(pos AS BIGINT) AS pos FROM pos")
def q_pref_positions(spark, sf):
    return PR.pref_positions(T.prefs_run(spark, sf), T.multi_prefs(spark, sf), docs=T.pref_docs(spark, sf), sizes=T.pref_sizes(spark, sf))


@register("pref_edges", f"{O.prefs_input_cte('multi')} SELECT qid, jg, a, b FROM e_multi0")
def q_pref_edges(spark, sf):
    return PR.pref_edges(T.multi_prefs(spark, sf))


@register("pref_closure", f"{O.prefs_input_cte('multi')} SELECT qid, jg, a, b FROM clo")
def q_pref_closure(spark, sf):
    return PR.pref_closure(PR.pref_edges(T.multi_prefs(spark, sf)))


@register("validate_prefs", f"""WITH prefs AS ({O.MULTI_PREFS.replace('FROM d0', f'FROM ({O.MULTI_PREFS_DOCS}) d0')})
SELECT qid, jg, docno, 'two levels in a sub-group' AS problem FROM prefs GROUP BY qid, jg, jsg, docno
HAVING count(DISTINCT rel_level) > 1
UNION ALL
SELECT qid, jg, docno, 'zero and non-zero level in a group' FROM prefs GROUP BY qid, jg, docno
HAVING min(rel_level) = 0 AND max(rel_level) > 0""")
def q_validate_prefs(spark, sf):
    return PR.validate_prefs(T.multi_prefs(spark, sf))


@register("validate_prefs_raw", O.pref_faults_sql(O.RAW_PREFS))
def q_validate_prefs_raw(spark, sf):
    return PR.validate_prefs(T.raw_prefs(spark, sf))


_PC = ["poss_ret", "ful_ret", "poss_imp", "ful_imp", "poss_notoccur", "num_rel", "num_nonrel", "num_rel_ret", "num_nonrel_ret"]


@register("pref_counts", f"{O.prefs_input_cte('qrels')} SELECT run_id, qid, jg, " + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in _PC) + " FROM grp")
def q_pref_counts(spark, sf):
    c = PR.pref_counts(T.deep_run(spark, sf), T.qrels_prefs(spark, sf))
    return c.select("run_id", "qid", "jg", *[F.col(x).cast("long").alias(x) for x in _PC])


@register("pair_counts", f"{O.prefs_input_cte('multi')} SELECT run_id, qid, x, y, CAST(nxy AS BIGINT) AS n_xy, CAST(nyx AS BIGINT) AS n_yx, rx, ry FROM pc")
def q_pair_counts(spark, sf):
    c = PR.pair_counts(T.prefs_run(spark, sf), T.multi_prefs(spark, sf), docs=T.pref_docs(spark, sf), sizes=T.pref_sizes(spark, sf))
    return c.select("run_id", "qid", "x", "y", F.col("n_xy").cast("long").alias("n_xy"), F.col("n_yx").cast("long").alias("n_yx"), "rx", "ry")


# ------------------------------------------------------------------ nested articles

from ranklens.operators import articles as AR  # noqa: E402


@register("leaf_section_paths", O.article_sql("""SELECT p.page_id, p.section_path_id, p.headings FROM pp p
WHERE NOT EXISTS (SELECT 1 FROM nodes c WHERE c.kind = 'section' AND c.parent_id = p.node_id AND c.page_id = p.page_id)"""))
def q_leaf_section_paths(spark, sf):
    return AR.leaf_section_paths(T.article_nodes(spark, sf))


@register("section_paragraphs", O.article_sql("SELECT * FROM spara"))
def q_section_paragraphs(spark, sf):
    return AR.section_paragraphs(T.article_nodes(spark, sf))


@register("section_path_id", O.article_sql("SELECT page_id, node_id, section_path_id FROM pp"))
def q_section_path_id(spark, sf):
    p = AR.section_paths(T.article_nodes(spark, sf))
    return p.select("page_id", "node_id", AR.section_path_id(F.col("page_id"), F.col("path_ids")).alias("section_path_id"))


@register("section_path_headings", O.article_sql("SELECT page_id, node_id, headings FROM pp"))
def q_section_path_headings(spark, sf):
    return AR.section_paths(T.article_nodes(spark, sf)).select("page_id", "node_id", "headings")


@register("child_sections", O.article_sql("""SELECT c.page_id, p.section_path_id AS parent_path_id, c.heading AS child_heading, c.ord
FROM nodes c JOIN pp p ON c.parent_id = p.node_id AND c.page_id = p.page_id WHERE c.kind = 'section'"""))
def q_child_sections(spark, sf):
    return AR.child_sections(T.article_nodes(spark, sf))


@register("paragraph_text", O.article_sql("SELECT para_id, text FROM ptext"))
def q_paragraph_text(spark, sf):
    return AR.paragraph_text(T.article_paragraphs(spark, sf))


@register("paragraph_entities", O.article_sql("""SELECT para_id, coalesce(list(page ORDER BY turn) FILTER (WHERE kind = 'link'), CAST([] AS VARCHAR[])) AS entities
FROM bodies GROUP BY para_id"""))
def q_paragraph_entities(spark, sf):
    return AR.paragraph_entities(T.article_paragraphs(spark, sf))


@register("link_sections", O.article_sql("SELECT para_id, turn, page, page_id, link_section, anchor FROM bodies WHERE kind = 'link'"))
def q_link_sections(spark, sf):
    return AR.link_sections(T.article_paragraphs(spark, sf))


@register("article_plain_text", O.article_sql("""SELECT s.page_id, s.para_id,
       array_to_string(list_concat([g.page_name], s.headings, [t.text]), ' ') AS line
FROM spara s JOIN pages g ON s.page_id = g.page_id JOIN ptext t ON s.para_id = t.para_id WHERE length(t.text) > 10"""))
def q_article_plain_text(spark, sf):
    return AR.article_plain_text(T.article_nodes(spark, sf), T.article_pages(spark, sf), T.article_paragraphs(spark, sf))


@register("dedupe_paragraph", O.article_sql("""SELECT DISTINCT para_id, text FROM (
  SELECT para_id, text FROM ptext
  UNION ALL SELECT t.para_id, t.text FROM spara s JOIN ptext t ON s.para_id = t.para_id) u"""))
def q_dedupe_paragraph(spark, sf):
    pt = AR.paragraph_text(T.article_paragraphs(spark, sf))
    referenced = AR.section_paragraphs(T.article_nodes(spark, sf)).select("para_id").join(pt, "para_id")
    return AR.dedupe_paragraph(pt.unionByName(referenced))


# ------------------------------------------------------------------ sources and sinks (round trips through files)

from ranklens import sources as SRC  # noqa: E402
from ranklens.session import scratch_path  # noqa: E402
from ranklens.sources import sinks as SK  # noqa: E402


def _write_lines(df: DataFrame, spark, name: str) -> str:
    path = scratch_path(spark, name)
    df.write.mode("overwrite").text(path)
    return path


@register("read_run", O.DEEP_RUN)
def q_read_run(spark, sf):
    run = T.deep_run(spark, sf)
    lines = RK.add_rank(run).select(
        F.concat_ws(" ", "qid", F.lit("Q0"), "docno", F.col("rank").cast("string"), F.col("sim").cast("string"), "run_id").alias("value")
    )
    return SRC.read_run(spark, _write_lines(lines, spark, "run")).select("run_id", "qid", "docno", "sim")


@register("read_qrels", O.DEEP_QRELS)
def q_read_qrels(spark, sf):
    q = T.deep_qrels(spark, sf)
    lines = q.select(F.concat_ws(" ", "qid", F.lit("0"), "docno", F.col("rel").cast("string")).alias("value"))
    return SRC.read_qrels(spark, _write_lines(lines, spark, "qrels"))


@register("read_qrels_jg", O.DEEP_QRELS_JG)
def q_read_qrels_jg(spark, sf):
    q = T.deep_qrels_jg(spark, sf)
    lines = q.select(F.concat_ws(" ", "qid", "jg", "docno", F.col("rel").cast("string")).alias("value"))
    return SRC.read_qrels_jg(spark, _write_lines(lines, spark, "qrels_jg"))


@register("read_qrels_prefs", f"SELECT qid, jg, '0' AS jsg, docno, CAST(rel AS FLOAT) AS rel_level FROM ({O.DEEP_QRELS_JG}) q")
def q_read_qrels_prefs(spark, sf):
    q = T.deep_qrels_jg(spark, sf)
    lines = q.select(F.concat_ws(" ", "qid", "jg", "docno", F.col("rel").cast("string")).alias("value"))
    return SRC.read_qrels_prefs(spark, _write_lines(lines, spark, "qrels_prefs"))


@register("read_prefs", f"WITH d0 AS ({O.MULTI_PREFS_DOCS}) {O.MULTI_PREFS}")
def q_read_prefs(spark, sf):
    p = T.multi_prefs(spark, sf)
    lines = p.select(F.concat_ws(" ", "qid", "jg", "jsg", "docno", F.col("rel_level").cast("string")).alias("value"))
    return SRC.read_prefs(spark, _write_lines(lines, spark, "prefs"))


def _zref_sql():
    pt = f"SELECT * FROM ({O.measure_sql('map', _TWO_RUNS, rounded=False)}) x WHERE qid <> 'all'"
    return f"""WITH pt AS ({pt})
SELECT qid, measure, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stddev FROM pt GROUP BY qid, measure"""


@register("read_zref", _zref_sql())
def q_read_zref(spark, sf):
    pt = evaluate(_two_runs(spark, sf), T.deep_qrels(spark, sf), ["map"]).where(F.col("qid") != "all")
    z = pt.groupBy("qid", "measure").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("stddev"))
    lines = z.select(F.concat_ws("\t", "qid", "measure", F.col("mean").cast("string"), F.col("stddev").cast("string")).alias("value"))
    r = SRC.read_zref(spark, _write_lines(lines, spark, "zref"))
    return _r6(_r6(r, "mean"), "stddev")


@register("qrels_lookup", f"""SELECT CAST(l_suppkey AS VARCHAR) AS qid,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS docno,
       CAST(max(CASE WHEN l_discount >= 0.08 THEN 2 WHEN l_discount >= 0.05 THEN 1 ELSE 0 END) AS INTEGER) AS rel
FROM lineitem GROUP BY 1, 2""")
def q_qrels_lookup(spark, sf):
    li = T.table(spark, sf, "lineitem")
    grade = F.when(F.col("l_discount") >= 0.08, 2).when(F.col("l_discount") >= 0.05, 1).otherwise(0)
    rows = li.select(F.col("l_suppkey").cast("string").alias("qid"), T._doc_key().alias("docno"), grade.alias("rel"))
    # one judgment per line item, duplicates included; within a key, lines are written in grade order
    lines = rows.repartitionByRange(8, "qid", "docno", "rel").sortWithinPartitions("qid", "docno", "rel")
    lines = lines.select(F.concat_ws(" ", "qid", F.lit("0"), "docno", F.col("rel").cast("string")).alias("value"))
    return SRC.qrels_lookup(spark, _write_lines(lines, spark, "qrels_lookup"))


@register("read_topics", "SELECT trim(regexp_replace(text, '\\s+', ' ', 'g')) AS qid, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS query FROM benchmark")
def q_read_topics(spark, sf):
    t = T.topics(spark, sf).select(F.trim(F.regexp_replace("query", r"\s+", " ")).alias("value"))
    return SRC.read_topics(spark, _write_lines(t, spark, "titles"))


@register("read_corpus", O.CORPUS)
def q_read_corpus(spark, sf):
    path = scratch_path(spark, "corpus")
    T.corpus(spark, sf).select(F.col("docno").alias("para_id"), "text").write.mode("overwrite").json(path)
    return SRC.read_corpus(spark, path, fmt="json")


@register("read_ltr", f"""WITH {O.features_cte()}
SELECT label, qid, f1, f2, f3, f4, f5, 'DocId:' || docno AS comment FROM ltr""")
def q_read_ltr(spark, sf):
    path = scratch_path(spark, "ltr")
    SK.write_ltr(_ltr(spark, sf), path)
    r = SRC.read_ltr(spark, path)
    return r.select("label", "qid", *[F.col("features")[i].alias(f"f{i}") for i in range(1, 6)], "comment")


@register("write_ltr", f"""WITH {O.features_cte()}
SELECT CAST(label AS VARCHAR) || ' qid:' || qid || ' 1:' || CAST(f1 AS VARCHAR) || ' 2:' || CAST(f2 AS VARCHAR)
       || ' 3:' || CAST(f3 AS VARCHAR) || ' 4:' || CAST(f4 AS VARCHAR) || ' 5:' || CAST(f5 AS VARCHAR) || ' # DocId:' || docno AS value
FROM ltr""")
def q_write_ltr(spark, sf):
    path = scratch_path(spark, "ltr_lines")
    SK.write_ltr(_ltr(spark, sf), path)
    return spark.read.text(path)


@register("write_run", f"""WITH {O.TEXT_CTE},
{O.hits_cte('lm_dirichlet')}
SELECT printf('%s Q0 %s %d %.6f %s', qid, docno, rank, round(score, 6), 'team1-' || method) AS value
FROM top_lm_dirichlet WHERE rank <= 10""")
def q_write_run(spark, sf):
    path = scratch_path(spark, "run_lines")
    SK.write_run(SC.score("lm_dirichlet", T.topics(spark, sf), T.corpus(spark, sf)), path, team="team1")
    return spark.read.text(path)


@register("write_run_exact", f"""WITH {O.TEXT_CTE},
{O.hits_cte('lm_dirichlet')}
SELECT qid, docno, 'lm_dirichlet' AS run_id, round(score, 4) AS score, rank FROM top_lm_dirichlet WHERE rank <= 10""")
def q_write_run_exact(spark, sf):
    path = scratch_path(spark, "run_lines")
    SK.write_run(SC.score("lm_dirichlet", T.topics(spark, sf), T.corpus(spark, sf)), path, exact=True)
    run = read_run(spark, path)
    order = Window.partitionBy("run_id", "qid").orderBy(F.col("sim").desc(), "docno")
    return run.select("qid", "docno", "run_id", F.round(F.col("sim").cast("double"), 4).alias("score"), F.row_number().over(order).cast("long").alias("rank"))


@register("write_report", None)
def q_write_report(spark, sf):
    path = scratch_path(spark, "report")
    run, qrels = T.deep_run(spark, sf), T.deep_qrels(spark, sf)
    SK.write_report(evaluate(run, qrels, "official"), path, evaluate_text(run, qrels, ["runid", "relstring"]))
    return spark.read.text(path)


@register("top_content", f"""WITH {O.TEXT_CTE},
{O.hits_cte('bm25')}
SELECT t.qid, t.method, t.rank, t.docno, c.text FROM top_bm25 t JOIN corpus c ON t.docno = c.docno WHERE t.rank <= 10""")
def q_top_content(spark, sf):
    hits = SC.score("bm25", T.topics(spark, sf), T.corpus(spark, sf))
    return SK.top_content(hits, T.corpus(spark, sf))


# ------------------------------------------------------------------ extension surface and measure naming

from ranklens.operators import measures as ME  # noqa: E402

# example user measure: binary DCG of the first 10 documents (summed discounted relevance)
ME.register_measure(
    "dcg_bin_10",
    lambda: F.sum(F.when((F.col("is_rel") == 1) & (F.col("rank") <= 10), 1.0 / F.log2(F.col("rank") + 1.0)).otherwise(0.0)),
    "mean",
)


@register("register_measure", f"""WITH {O.ranked_cte()},{O.rows_cte()},
t AS (SELECT run_id, qid, sum(CASE WHEN is_rel = 1 AND rank <= 10 THEN 1.0 / log2(rank + 1.0) ELSE 0 END) AS value
      FROM rows GROUP BY run_id, qid)
SELECT run_id, qid, 'dcg_bin_10' AS measure, round(value, 6) AS value FROM t
UNION ALL SELECT run_id, 'all', 'dcg_bin_10', round(avg(value), 6) FROM t GROUP BY run_id""")
def q_register_measure(spark, sf):
    df = evaluate(T.deep_run(spark, sf), T.deep_qrels(spark, sf), ["dcg_bin_10"])
    return _r6(df.where(F.col("measure") != "num_q"))


@register("score_custom", f"""WITH {O.TEXT_CTE},
sc_c AS (SELECT qid, docno, sum(tf * log10(CAST(num_docs AS DOUBLE) / df)) AS score FROM m GROUP BY qid, docno),
t AS (SELECT qid, docno, 'custom' AS method, score,
             row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, docno) AS rank FROM sc_c)
SELECT qid, docno, method, round(score, 6) AS score, rank FROM t WHERE rank <= 10""")
def q_score_custom(spark, sf):
    expr = F.col("tf") * F.log10(F.col("num_docs").cast("double") / F.col("df"))
    h = SC.score("custom", T.topics(spark, sf), T.corpus(spark, sf), custom=expr, per_term_top=False)
    return _r6(h, "score")


_NAME_REQ = ["P.7,3", "iprec_at_recall..25,.5", "ndcg_cut.10", "utility.2,-1,0,0", "Rprec_mult.0.35"]
# fixed values: the output names of these requests as printed
_NAMES = ["P_3", "P_7", "iprec_at_recall_0.25", "iprec_at_recall_0.50", "ndcg_cut_10", "utility_2,-1,0,0", "Rprec_mult_0.35"]


@register("measure_names", f"""WITH {O.ranked_cte()}
SELECT measure, CAST((SELECT count(DISTINCT qid) FROM ranked) AS BIGINT) AS n_topics
FROM (VALUES {", ".join(f"('{n}')" for n in _NAMES)}) v(measure)""")
def q_measure_names(spark, sf):
    df = evaluate(T.deep_run(spark, sf), T.deep_qrels(spark, sf), _NAME_REQ).where(F.col("qid") != "all")
    return df.groupBy("measure").agg(F.countDistinct("qid").alias("n_topics"))
