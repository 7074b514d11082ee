"""Retrieval scoring: query terms joined with postings, per-term top-n, sum, top-k.

All scorers share one plan prefix — the equi-join of (broadcast, size-checked)
query terms with the postings on ``term`` — and differ only in column
expressions.  In the methods of ``TERM_LISTS`` every query term contributes its
own top-``n`` documents and a document is scored only from the term lists it
entered; the others score the whole bag of terms at once.  A term that a query
repeats counts once per occurrence.

Top-k uses ``row_number() <= k`` directly above the window, which Catalyst
turns into a window group limit (partial top-k before the shuffle), so a very
frequent term never ships its whole posting list to one task.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklens.functions.exact import exact_sum
from ranklens.operators.index import ALL_DOCS, BROADCAST_ROWS, Index, all_postings, checked_broadcast, collection_stats, doc_stats, query_terms, term_stats

# fixed values: parameters of the ranking functions
TERM_TOP_N = 10
TOP_K = 10
JM_LAMBDA = 0.9
DIRICHLET_MU = 1000.0
BM25_K1 = 1.2
BM25_B = 0.75

METHODS = ("lnc_ltn", "bnn_bnn", "lm_laplace", "lm_jm", "lm_dirichlet")
TERM_LISTS = ("lnc_ltn", "bnn_bnn", "lm_laplace", "lm_jm")
#: What the list of a term is ordered by, see ``index.IMPACTS``: all but one posting of equal impact may tie.
LIST_IMPACT = {"lnc_ltn": "tf", "lm_laplace": "laplace", "lm_jm": "rate"}


def match(topics_terms: DataFrame, post: DataFrame, bounded: bool | None = None) -> DataFrame:
    """(qid, term, qtf) ⋈ postings on term -> (qid, term, qtf, docno, tf, dlen, ulen, uvoc)."""
    qt = topics_terms.select("qid", "term", "qtf")
    if bounded is None:
        qt = checked_broadcast(qt)
    elif bounded:
        qt = F.broadcast(qt)
    return post.join(qt, "term")


class Weighed(NamedTuple):
    """Postings of query terms with df/ctf of their term and the collection statistics, and the query terms."""

    post: DataFrame
    qt: DataFrame

    def matches(self) -> DataFrame:
        """One row for each posting and query with its term."""
        return self.post.join(self.qt, "term")


def _with_stats(qt: DataFrame, post: DataFrame, corpus_stats: DataFrame) -> Weighed:
    """Given postings and lengths; term statistics have at most one row per distinct query term."""
    ts = term_stats(post, qt)
    return _weighed(qt, post, ts, collection_stats(corpus_stats))


def _matched(qt: DataFrame, corpus: DataFrame) -> Weighed:
    """All statistics from one pass over the corpus: postings of query terms are kept, then reused."""
    from ranklens.session import checkpoint_dir

    checkpoint_dir(corpus.sparkSession)
    kept = all_postings(corpus, qt).checkpoint()
    post = kept.where(F.col("term") != ALL_DOCS)
    return _weighed(qt, post, post.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ctf")), collection_stats(kept.where(F.col("term") == ALL_DOCS)))


def _weighed(qt: DataFrame, post: DataFrame, terms: DataFrame, collection: DataFrame) -> Weighed:
    """The postings with all statistics beside the query terms; the small sides go to every task (query terms size-checked)."""
    q = qt.select("qid", "term", "qtf")
    bounded = q.count() <= BROADCAST_ROWS
    small = F.broadcast if bounded else (lambda df: df)
    return Weighed(post.join(small(terms), "term").crossJoin(F.broadcast(collection)), small(q))  # collection: one row


def _stored(qt: DataFrame, index: Index, impact: str | None, n: int) -> Weighed:
    """Postings of a stored index; with ``impact`` only those of blocks that can reach the best ``n`` of a term."""
    post = index.top_postings(qt, impact, n) if impact else index.postings(qt)
    return _weighed(qt, post, index.term_stats(qt), index.collection_stats())


def term_topk(scored: DataFrame, n: int = TERM_TOP_N, by: str = "s") -> DataFrame:
    """Keep the best ``n`` documents of every (query, term) list; ties by docno."""
    w = Window.partitionBy("qid", "term").orderBy(F.col(by).desc(), F.col("docno"))
    return scored.withColumn("_tr", F.row_number().over(w)).where(F.col("_tr") <= n).drop("_tr")


# scores are summed in fixed point, so a sum of the same terms in another order is the
# same number: ties are ties, and ranks order on the score itself
SCORE_BITS = 31


def topk_per_query(scores: DataFrame, k: int = TOP_K, method: str | None = None) -> DataFrame:
    """Order by score desc (docno asc on ties), keep ``k``, rank from 1."""
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("docno"))
    out = scores.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)
    if method is not None:
        out = out.withColumn("method", F.lit(method))
    return out


def _term_scores(method: str, mode: str = "literal") -> tuple[Column, str]:
    """Per (term, doc) score column of one occurrence of the term and how scores combine per document."""
    tf = F.col("tf").cast("double")
    if method == "bnn_bnn":
        return F.when(F.col("tf") > 0, F.lit(1.0)).otherwise(F.lit(0.0)), "sum"
    if method == "lnc_ltn":
        idf = F.log10(F.col("num_docs").cast("double") / F.greatest(F.col("df"), F.lit(1)).cast("double"))
        return (1.0 + F.log10(tf)) * (1.0 + F.log10(F.col("qtf").cast("double"))) * idf, "sum_norm"
    if method == "lm_laplace":
        d = F.col("ulen").cast("double")
        return (tf + 1.0 / d) / (d + F.col("uvoc").cast("double")), "sum"
    if method == "lm_jm":
        d = F.col("dlen").cast("double")
        p = JM_LAMBDA * tf / d + (1.0 - JM_LAMBDA) * F.col("ctf").cast("double") / F.col("sum_tf").cast("double")
        return p, "product"
    if method == "lm_dirichlet":
        if mode == "textbook":
            p = (tf + DIRICHLET_MU * F.col("ctf") / F.col("sum_tf")) / (F.col("dlen") + DIRICHLET_MU)
            return p, "product"
        return (tf + DIRICHLET_MU) / (F.col("ctf").cast("double") + DIRICHLET_MU), "sum"
    if method == "raw_tf":
        return tf, "sum"
    if method == "bm25":
        n, df = F.col("num_docs").cast("double"), F.col("df").cast("double")
        idf = F.log(1.0 + (n - df + 0.5) / (df + 0.5))
        norm = BM25_K1 * (1.0 - BM25_B + BM25_B * F.col("dlen") / F.col("avg_dlen"))
        return idf * tf * (BM25_K1 + 1.0) / (tf + norm), "sum"
    raise ValueError(f"unknown method {method}")


def _background(method: str) -> Column:
    """The smoothed mass that a term has in a document without it (Dirichlet: times |d| + mu)."""
    share = F.col("ctf").cast("double") / F.col("sum_tf").cast("double")
    if method == "lm_jm":
        return (1.0 - JM_LAMBDA) * share
    if method == "lm_dirichlet":
        return DIRICHLET_MU * share
    raise ValueError(f"{method} has no background model")


def _likelihoods(method: str, m: DataFrame) -> DataFrame:
    """(qid, docno, score): log10 of the likelihood of the whole query, unmatched terms included.

    A term that a document lacks adds the log of its background mass.  So the
    sum splits into a constant of the query, as if nothing matched, and a
    correction for each matched term: unmatched terms cost no row.  Terms that
    the collection lacks say nothing about any document and are left out.
    """
    tf, dlen, times, rest = F.col("tf").cast("double"), F.col("dlen").cast("double"), F.col("qtf").cast("double"), _background(method)
    matched = JM_LAMBDA * tf / dlen + rest if method == "lm_jm" else tf + rest
    terms = m.select("qid", "term", "qtf", "ctf", "sum_tf").distinct()
    query = terms.groupBy("qid").agg(exact_sum(times * F.log10(rest), SCORE_BITS).alias("_none"), F.sum("qtf").alias("_words"))
    docs = m.groupBy("qid", "docno").agg(exact_sum(times * (F.log10(matched) - F.log10(rest)), SCORE_BITS).alias("_more"), F.max("dlen").alias("_dlen"))
    length = F.lit(0.0) if method == "lm_jm" else F.col("_words") * F.log10(F.col("_dlen") + DIRICHLET_MU)
    return docs.join(query, "qid").select("qid", "docno", (F.col("_more") + F.col("_none") - length).alias("score"))


def _list_key(method: str, s: Column) -> Column:
    """What a term's list is ordered by, the same for every query: Laplace divides by the document's length only after the cut."""
    if method == "lm_laplace":
        return F.col("tf").cast("double") + 1.0 / F.col("ulen").cast("double")
    if method == "lnc_ltn":  # without the query's own weight of the term, a positive factor
        return (1.0 + F.log10(F.col("tf").cast("double"))) * F.log10(F.col("num_docs").cast("double") / F.greatest(F.col("df"), F.lit(1)).cast("double"))
    return s


def _docno_head() -> Column:
    """A number that grows with the docno (its first six bytes; a null is before all)."""
    return F.coalesce(F.conv(F.rpad(F.substring(F.hex("docno"), 1, 12), 12, "0"), 16, 10).cast("double"), F.lit(-1.0))


def _top_of_terms(post: DataFrame, keys: dict[str, Column], n: int) -> DataFrame:
    """The best ``n`` postings of every term by each method's key, ties by docno: (posting, method).

    A term's list is cut once for all its queries.  The documents are dealt to
    ``4 * n`` groups by hash; of the best of each group the ``n``-th is a bound
    that no posting of the list is below, so few are sorted.  Equal keys are
    bounded by their docnos.
    """
    # bnn_bnn weighs every posting alike: its list is the first docnos
    bound = {m: -_docno_head() if m == "bnn_bnn" else F.when(~F.isnan(k), k) for m, k in keys.items()}
    rows = post.withColumns({f"_b{i}": v for i, v in enumerate(bound.values())})
    best = rows.groupBy("term", F.pmod(F.xxhash64("docno"), F.lit(4 * n)).alias("_g")).agg(*(F.max(f"_b{i}").alias(f"_b{i}") for i in range(len(keys))))
    least = best.groupBy("term").agg(*(F.get(F.sort_array(F.collect_list(f"_b{i}"), asc=False), F.lit(n - 1)).alias(f"_l{i}") for i in range(len(keys))))
    rows = rows.join(checked_broadcast(least), "term")
    fits = [F.when(F.coalesce(F.col(f"_b{i}") < F.col(f"_l{i}"), F.lit(False)), None).otherwise(F.struct(F.lit(m).alias("method"), k.alias("_key"))) for i, (m, k) in enumerate(keys.items())]
    kept = rows.select(*post.columns, F.inline(F.array_compact(F.array(*fits))))
    w = Window.partitionBy("term", "method").orderBy(F.col("_key").desc(), F.col("docno"))
    return kept.withColumn("_tr", F.row_number().over(w)).where(F.col("_tr") <= n).drop("_tr")


def _repeated(method: str, s: Column, combine: str) -> Column:
    """The score of all occurrences of the term in the query (lnc.ltn weighs them itself)."""
    if combine == "product":
        return F.pow(s, F.col("qtf").cast("double"))
    return s if combine == "sum_norm" else F.col("qtf") * s


def score(
    method: str,
    topics: DataFrame,
    corpus: DataFrame | None = None,
    post: DataFrame | None = None,
    stats: DataFrame | None = None,
    k: int = TOP_K,
    n: int = TERM_TOP_N,
    per_term_top: bool | None = None,
    raw_terms: bool = False,
    mode: str = "literal",
    custom: Column | None = None,
    index: Index | None = None,
    background: bool = False,
) -> DataFrame:
    """hits(qid, docno, method, score double, rank) — the top ``k`` documents per query.

    Reads a stored ``index``, or tokenises ``corpus`` once, or takes ``post`` and ``stats``.

    ``custom`` replaces the per-term score with any Column expression over
    ``tf, qtf, dlen, ulen, uvoc, df, ctf, num_docs, sum_tf, avg_dlen`` (summed).

    ``background`` (``lm_jm``, ``lm_dirichlet``) scores documents with at least
    one term by the log10 likelihood of the whole query, see :func:`_likelihoods`.
    """
    if background:
        _background(method)  # raises for other methods
        if custom is not None or per_term_top:
            raise ValueError("background scores the whole query: no custom score, no term lists")
    qt = query_terms(topics, raw_terms)
    if per_term_top is None:
        per_term_top = method in TERM_LISTS and not background
    if index is not None:
        w = _stored(qt, index, LIST_IMPACT.get(method) if per_term_top and custom is None else None, n)
    elif post is None:
        w = _matched(qt, corpus)
    else:
        w = _with_stats(qt, post, doc_stats(corpus) if stats is None else stats)
    if background:
        return topk_per_query(_likelihoods(method, w.matches()), k, method).select("qid", "docno", "method", "score", "rank")
    if custom is not None:  # may weigh the query's count of the term, so each query has its own lists
        combine = "sum"
        method = method or "custom"
        m = w.matches().withColumn("s", custom.cast("double"))
        if per_term_top:
            m = term_topk(m, n)
    else:
        one, combine = _term_scores(method, mode)
        if per_term_top:
            w = w._replace(post=_top_of_terms(w.post, {method: _list_key(method, one).cast("double")}, n).drop("method"))
        m = w.matches().withColumn("s", _repeated(method, one, combine).cast("double"))
    if combine == "product":
        agg = F.pow(F.lit(10.0), exact_sum(F.log10("s"), SCORE_BITS))
    else:
        agg = exact_sum(F.col("s"), SCORE_BITS)
    scores = m.groupBy("qid", "docno").agg(agg.alias("score"))
    if combine == "sum_norm":
        norm = F.sqrt(F.sum(F.col("score") * F.col("score")).over(Window.partitionBy("qid")))
        scores = scores.withColumn("score", F.col("score") / norm)
    return topk_per_query(scores, k, method).select("qid", "docno", "method", "score", "rank")


def score_many(
    topics: DataFrame,
    corpus: DataFrame | None = None,
    methods=METHODS,
    k: int = TOP_K,
    n: int = TERM_TOP_N,
    post: DataFrame | None = None,
    stats: DataFrame | None = None,
    index: Index | None = None,
) -> DataFrame:
    """Several rankings from one shared plan: one pass over the corpus, or a stored index.

    The list of a term is cut for all its queries at once, per method (a fixed
    fan-out of the methods with term lists); only then queries are joined.  The
    per-document sum and the final top-k are one aggregate and one window keyed
    by method.
    """
    qt = query_terms(topics)
    if index is not None:
        w = _stored(qt, index, None, n)
    else:
        w = _matched(qt, corpus) if post is None else _with_stats(qt, post, doc_stats(corpus) if stats is None else stats)
    ones = {meth: _term_scores(meth) for meth in methods}
    kinds = {meth: combine for meth, (_, combine) in ones.items()}

    def added(meth: str) -> Column:
        """What a term adds to a document's sum: products are sums of logarithms."""
        s = _repeated(meth, *ones[meth]).cast("double")
        return F.log10(s) if kinds[meth] == "product" else s

    def added_up(rows: DataFrame, names) -> DataFrame:
        """The score of every document, per method; only lists with a norm are brought together to be summed."""
        agg = rows.groupBy("method", "qid", "docno").agg(exact_sum(F.col("s"), SCORE_BITS).alias("score"))
        prod = [mm for mm in names if kinds[mm] == "product"]
        if prod:
            agg = agg.withColumn("score", F.when(F.col("method").isin(*prod), F.pow(F.lit(10.0), F.col("score"))).otherwise(F.col("score")))
        norm_m = [mm for mm in names if kinds[mm] == "sum_norm"]
        if norm_m:
            norm = F.sqrt(F.sum(F.col("score") * F.col("score")).over(Window.partitionBy("method", "qid")))
            agg = agg.withColumn("score", F.when(F.col("method").isin(*norm_m), F.col("score") / norm).otherwise(F.col("score")))
        return agg

    parts = []
    per_term = [mm for mm in methods if mm in TERM_LISTS]
    rest = [mm for mm in methods if mm not in per_term]
    if per_term:
        top = _top_of_terms(w.post, {mm: _list_key(mm, ones[mm][0]).cast("double") for mm in per_term}, n)
        s = F.coalesce(*(F.when(F.col("method") == mm, added(mm)) for mm in per_term))
        parts.append(added_up(w._replace(post=top).matches().select("method", "qid", "docno", s.alias("s")), per_term))
    if rest:  # every posting of a query's terms: added up where its document lies
        structs = [F.struct(F.lit(mm).alias("method"), added(mm).alias("s")) for mm in rest]
        parts.append(added_up(w.matches().select("qid", "docno", F.inline(F.array(*structs))).select("method", "qid", "docno", "s"), rest))
    agg = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    w2 = Window.partitionBy("method", "qid").orderBy(F.col("score").desc(), F.col("docno"))
    out = agg.withColumn("rank", F.row_number().over(w2).cast("long")).where(F.col("rank") <= k)
    return out.select("qid", "docno", "method", "score", "rank")
