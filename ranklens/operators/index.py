"""Inverted index as tables: postings, document, term and collection statistics, and the stored index.

``postings(term, docno, tf, dlen, ulen, uvoc)`` carries each document's
lengths next to every posting (the role of norms in an index), so scoring
never joins the corpus-sized document table again.

``write_index`` stores postings as blocks.  A term's postings are dealt to
salts (more of them for a frequent term, so no task holds a whole list), sorted
by tf and length within each, and cut into blocks of ``BLOCK`` postings; a
block is one row with its range of impacts, its counts and its postings.  Rows
are ordered by a hash bucket of the term, a folder each, then by term, so
reading a few terms prunes folders and row groups.  The list of the empty term
holds every document once: document and collection statistics come from it.  Postings
are counted inside each row of the corpus and move once, some buckets at a time;
nothing of them is kept in between, so the corpus is tokenised once for the
counts of terms and once for each round of buckets.

The best n postings of a term need only some blocks: a block with n postings or
more proves that the n-th best impact is at least its smallest one, and blocks
whose largest impact is below that are skipped unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklens.functions.text import query_tokens, tokenize_unigram, without_stop_words
from ranklens.session import shuffles_end, written

#: Postings of a block, and of a salt of a frequent term, about.
BLOCK, SALT_POSTINGS = 1024, 100_000
#: The term whose list holds every document.
ALL_DOCS = ""
#: What a posting can weigh in a term's list, by method: each method's score grows with one of these.
IMPACTS = {
    "tf": lambda p: p["tf"].cast("double"),
    "rate": lambda p: F.try_divide(p["tf"].cast("double"), p["dlen"].cast("double")),
    "laplace": lambda p: p["tf"].cast("double") + F.try_divide(F.lit(1.0), p["ulen"].cast("double")),
}
_POSTING = ["docno", "tf", "dlen", "ulen", "uvoc"]

# broadcast only below this many rows of the small side (checked by a count)
BROADCAST_ROWS = 2_000_000


def analyze(corpus: DataFrame) -> DataFrame:
    """corpus(docno, text) -> (docno, tokens, dlen, ulen, uvoc)."""
    # a text is split once: what several columns use is a column itself
    split = corpus.select("docno", tokenize_unigram("text").alias("uni")).select("docno", "uni", without_stop_words("uni").alias("tokens"))
    return split.select(
        "docno",
        "tokens",
        F.size("tokens").cast("long").alias("dlen"),
        F.size("uni").cast("long").alias("ulen"),
        F.size(F.array_distinct("uni")).cast("long").alias("uvoc"),
    )


def doc_stats(corpus: DataFrame) -> DataFrame:
    """Length |d| (index tokens), unigram length and unigram vocabulary |V_d| per document."""
    return analyze(corpus).drop("tokens")


def postings(corpus: DataFrame) -> DataFrame:
    return _postings(analyze(corpus))


def _postings(analyzed: DataFrame, tokens: str = "tokens", terms: DataFrame | None = None) -> DataFrame:
    ex = analyzed.select("docno", "dlen", "ulen", "uvoc", F.explode(tokens).alias("term"))
    if terms is not None:  # dealt by document: what adds up its matches finds them in one place
        ex = ex.join(terms, "term", "left_semi").repartition("docno")
    return ex.groupBy("term", "docno").agg(
        F.count(F.lit(1)).alias("tf"), F.max("dlen").alias("dlen"), F.max("ulen").alias("ulen"), F.max("uvoc").alias("uvoc")
    )


def _with_all_docs(corpus: DataFrame) -> DataFrame:
    """``analyze`` with the term of every document among its tokens."""
    return analyze(corpus).withColumn("tokens", F.coalesce(F.array_append("tokens", F.lit(ALL_DOCS)), F.array(F.lit(ALL_DOCS))))


def all_postings(corpus: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Postings and the list of all documents (term ``ALL_DOCS``) from one pass over the corpus; optionally only ``terms``."""
    a = _with_all_docs(corpus)
    if terms is not None:
        every = terms.sparkSession.createDataFrame([(ALL_DOCS,)], "term string")
        terms = checked_broadcast(terms.select("term").unionByName(every).distinct())
    return _postings(a, terms=terms)


def row_postings(corpus: DataFrame) -> DataFrame:
    """``all_postings`` of each row of the corpus, counted inside the row, so nothing moves; a docno of several rows has postings of each."""
    a = _with_all_docs(corpus).withColumn("tokens", F.sort_array("tokens"))
    first = F.transform("tokens", lambda t, i: F.when((i == 0) | (F.get("tokens", i - 1) != t), i))
    a = a.withColumn("first", F.array_append(F.array_compact(first), F.size("tokens")))
    runs = F.transform(F.slice("first", 1, F.size("first") - 1), lambda at, k: F.struct(F.get("tokens", at).alias("term"), (F.get("first", k + 1) - at).cast("long").alias("tf")))
    return a.select("docno", "dlen", "ulen", "uvoc", F.inline(runs)).select("term", *_POSTING)


# ---------------------------------------------------------------- stored index


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")


#: Bits of a posting's numbers in the one number that moves.
_BITS = {"tf": 11, "dlen": 18, "ulen": 18, "uvoc": 16}


def _moved(post: DataFrame, *keys: str) -> DataFrame:
    """The postings dealt by ``keys``; their numbers move as one, those that this can't hold as they are."""
    fits, packed, at = F.lit(True), F.lit(0).cast("long"), 0
    for c, bits in _BITS.items():
        fits &= F.col(c).between(0, (1 << bits) - 1)
        packed = packed.bitwiseOR(F.shiftleft(F.col(c).cast("long"), at))
        at += bits
    fits = F.coalesce(fits, F.lit(False))
    moved = post.withColumns({"packed": F.when(fits, packed), "odd": F.when(~fits, F.struct(*_BITS))}).drop(*_BITS)
    moved = moved.repartition(*keys)
    own, at = {}, 0
    for c, bits in _BITS.items():
        own[c] = F.when(F.col("packed").isNotNull(), F.shiftright("packed", at).bitwiseAND(F.lit((1 << bits) - 1))).otherwise(F.col(f"odd.{c}"))
        at += bits
    return moved.withColumns(own).drop("packed", "odd")


def salted_terms(post: DataFrame, salt_postings: int = SALT_POSTINGS) -> DataFrame:
    """(term, salts) of the terms with more postings than one salt takes, counted once; only ``post``'s term is read."""
    often = post.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > salt_postings)
    return checked_broadcast(written(often.select("term", F.ceil(F.col("df") / salt_postings).cast("int").alias("salts")), "often"))


def index_blocks(post: DataFrame, buckets: int, block: int = BLOCK, salt_postings: int = SALT_POSTINGS, unique: bool = True, often: DataFrame | None = None) -> DataFrame:
    """(bucket, term, salt, block, n, sum_tf, sum_dlen, n_dlen, max_<impact>, min_<impact>, postings) of postings.

    Without ``unique`` the postings of one term and docno are added up to one.  ``often``: ``salted_terms``, if they are known.
    """
    often = salted_terms(post, salt_postings) if often is None else often
    salted = post.join(often, "term", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("docno"), F.col("salts")).cast("int"), F.lit(0)))
    one = F.struct((-F.col("tf")).alias("order"), *_POSTING[2:3], "docno", "tf", "ulen", "uvoc")
    # postings move once, to the file that takes them: a bucket's lists lie in a few files
    files = max(1, int(post.sparkSession.conf.get("spark.sql.shuffle.partitions")) // buckets)
    file = F.pmod(F.xxhash64("salt", "term"), F.lit(files)).cast("int")
    salted = _moved(salted.drop("salts").withColumns({"bucket": _bucket(buckets), "file": file}), "bucket", "file")
    at = ["bucket", "file", "term", "salt"]
    if not unique:
        salted = salted.groupBy(*at, "docno").agg(F.sum("tf").alias("tf"), *(F.max(c).alias(c) for c in ("dlen", "ulen", "uvoc")))
    lists = salted.groupBy(*at).agg(F.sort_array(F.collect_list(one)).alias("p"))  # a salt's postings
    starts = F.sequence(F.lit(0), F.floor((F.size("p") - 1) / block).cast("int"))
    cut = F.transform(starts, lambda k: F.slice("p", k * block + 1, F.lit(block)))
    rows = lists.select("bucket", "term", "salt", F.posexplode(cut).alias("block", "p"))
    total = lambda c: F.aggregate("p", F.lit(0).cast("long"), lambda at, x: at + F.coalesce(x[c], F.lit(0)))
    ranges = {}
    for name, impact in IMPACTS.items():
        values = F.transform("p", impact)
        ranges |= {f"max_{name}": F.array_max(values), f"min_{name}": F.array_min(values)}
    return rows.select(
        "bucket", "term", "salt", "block", F.size("p").cast("long").alias("n"), total("tf").alias("sum_tf"), total("dlen").alias("sum_dlen"),
        F.size(F.filter("p", lambda x: x["dlen"].isNotNull())).cast("long").alias("n_dlen"),
        *(v.alias(k) for k, v in ranges.items()),
        F.transform("p", lambda x: F.struct(*(x[c].alias(c) for c in _POSTING))).alias("postings"),
    )


def write_index(corpus: DataFrame, path: str, buckets: int = 64, block: int = BLOCK, salt_postings: int = SALT_POSTINGS, rounds: int = 2) -> None:
    """Store the postings of the corpus as blocks under ``path``.

    The corpus is read once for the number of each term's postings and once in
    each of ``rounds``, which write some of the buckets each: only the postings
    of one round are on their way, and take disk for it, at once.
    """
    with shuffles_end(corpus.sparkSession):
        unique = corpus.groupBy("docno").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").isEmpty()
        often = salted_terms(_with_all_docs(corpus).select(F.explode(F.array_distinct("tokens")).alias("term")), salt_postings)
        for i in range(rounds):
            post = row_postings(corpus).where(F.pmod(_bucket(buckets), F.lit(rounds)) == i)
            blocks = index_blocks(post, buckets, block, salt_postings, unique, often)
            out = blocks.sortWithinPartitions("bucket", "term", "salt", "block").write.mode("append" if i else "overwrite")
            out.option("compression", "zstd").partitionBy("bucket").parquet(path)


class Index:
    """A stored index: every method reads the blocks it needs and no corpus."""

    def __init__(self, spark, path: str, buckets: int = 64):
        self.blocks = spark.read.parquet(path)
        self.buckets = buckets

    def heads(self, terms: DataFrame | None = None) -> DataFrame:
        """The blocks without their postings; with ``terms`` only the folders and row groups of these are read."""
        heads = self.blocks.drop("postings")
        return heads if terms is None else heads.join(self._located(terms), ["bucket", "term"], "left_semi")

    def _located(self, terms: DataFrame) -> DataFrame:
        return terms.select("term").distinct().select(_bucket(self.buckets).alias("bucket"), "term")

    def _opened(self, blocks: DataFrame) -> DataFrame:
        return blocks.select("term", F.inline("postings")).select("term", *_POSTING)

    def postings(self, terms: DataFrame | None = None) -> DataFrame:
        """(term, docno, tf, dlen, ulen, uvoc), optionally only of ``terms``."""
        kept = self.blocks.where(F.col("term") != ALL_DOCS)
        return self._opened(kept if terms is None else kept.join(self._located(terms), ["bucket", "term"], "left_semi"))

    def doc_stats(self) -> DataFrame:
        here = self.blocks.where((F.col("term") == ALL_DOCS) & (F.col("bucket") == _bucket_of(ALL_DOCS, self.buckets)))
        return self._opened(here).select("docno", "dlen", "ulen", "uvoc")

    def term_stats(self, terms: DataFrame | None = None) -> DataFrame:
        heads = self.heads(terms).where(F.col("term") != ALL_DOCS)
        return heads.groupBy("term").agg(F.sum("n").alias("df"), F.sum("sum_tf").alias("ctf"))

    def collection_stats(self) -> DataFrame:
        here = self.blocks.where((F.col("term") == ALL_DOCS) & (F.col("bucket") == _bucket_of(ALL_DOCS, self.buckets)))
        t = here.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("num_docs"), F.sum("sum_dlen").alias("sum_tf"), F.sum("n_dlen").alias("measured"))
        return t.select("num_docs", "sum_tf", F.try_divide("sum_tf", "measured").alias("avg_dlen"))

    def top_blocks(self, terms: DataFrame, impact: str, n: int) -> DataFrame:
        """(bucket, term, salt, block) of the blocks that may hold one of the best ``n`` postings of their term.

        ``n`` up to the block size lets blocks go; beyond it all are kept.  A term of every document separates none by its weight (its idf is 0), so it keeps all blocks.
        """
        heads = self.heads(terms).where(F.col("term") != ALL_DOCS)
        sure = heads.groupBy("term").agg(F.max(F.when(F.col("n") >= n, F.col(f"min_{impact}"))).alias("least"), F.sum("n").alias("df"))
        everywhere = F.col("df") >= self.collection_stats().select("num_docs").scalar()
        sure = sure.select("term", F.when(~everywhere, F.col("least")).alias("least"))
        reach = F.col("least").isNull() | (F.col(f"max_{impact}") >= F.col("least"))
        return heads.join(sure, "term", "left").where(reach).select("bucket", "term", "salt", "block")

    def top_postings(self, terms: DataFrame, impact: str, n: int) -> DataFrame:
        """Postings of ``top_blocks``: all that can be among the best ``n`` of their term by this impact, ties included."""
        return self._opened(self.blocks.join(self.top_blocks(terms, impact, n), ["bucket", "term", "salt", "block"], "left_semi"))


def _bucket_of(term: str, buckets: int):
    return F.pmod(F.xxhash64(F.lit(term)), F.lit(buckets)).cast("int")


def read_index(spark, path: str, buckets: int = 64) -> Index:
    return Index(spark, path, buckets)


def term_stats(post: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Document frequency and collection frequency per term (optionally only ``terms``)."""
    p = post if terms is None else post.join(checked_broadcast(terms.select("term").distinct()), "term", "left_semi")
    return p.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ctf"))


def collection_stats(corpus_stats: DataFrame) -> DataFrame:
    """One row: number of documents, sum of all term frequencies, average length."""
    return corpus_stats.agg(
        F.count(F.lit(1)).alias("num_docs"), F.sum("dlen").alias("sum_tf"), F.avg("dlen").alias("avg_dlen")
    )


def query_terms(topics: DataFrame, raw_terms: bool = False) -> DataFrame:
    """topics(qid, query) -> (qid, term, qtf, qpos) — qpos = first position of the term."""
    ex = topics.select("qid", F.posexplode(query_tokens("query", raw_terms)).alias("pos", "term"))
    return ex.groupBy("qid", "term").agg(F.count(F.lit(1)).alias("qtf"), F.min("pos").cast("long").alias("qpos"))


def query_tf(topics: DataFrame, raw_terms: bool = False) -> DataFrame:
    return query_terms(topics, raw_terms).select("qid", "term", "qtf")


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only after its row count is proven below ``max_rows``.

    The count runs over the small side only; beyond the bound the plain
    DataFrame is returned and Spark plans a shuffle join instead.
    """
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df
