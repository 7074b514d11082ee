"""Ranked-list construction: a run joined with judgments.

The rank column of a run is never trusted: ranks come from the score (float32)
descending, ties broken by docno descending for graded/per-user judgments.

One plan for lists of any length: the run is joined with the judgments on
(qid, docno), which spreads every topic; rows are dealt by (list, range of the
order), see ``ordered``; ranks and running sums are windows inside a range plus
the sums of the list's earlier ranges.  Whether a topic is judged, and what its
judgments add up to, is joined to the ranges, one row each, not to the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ranklens.operators.ordered import prefix_sums, range_of

# fixed values: relevance codes of retrieved documents without a usable judgment
REL_NONPOOL = -1  # not in the judgments at all
REL_UNJUDGED = -2  # in the pool, judged -1 in the input

RUN_COLS = ["run_id", "qid", "docno", "sim"]


def normalize_run(run: DataFrame) -> DataFrame:
    """Keep the run columns; scores are narrowed to float32 (ties depend on it), a run without id is 'run'."""
    kinds = dict(run.dtypes)

    def typed(c: str, kind: str):  # a column that has its type stays as it is, so equal subplans stay equal
        return F.col(c) if kinds[c] == kind else F.col(c).cast(kind).alias(c)

    rid = F.coalesce(F.col("run_id").cast("string"), F.lit("run")) if "run_id" in kinds else F.lit("run")
    return run.select(rid.alias("run_id"), typed("qid", "string"), typed("docno", "string"), typed("sim", "float"))


def rank_window(keys=("run_id", "qid"), docno_desc: bool = True) -> Window:
    tie = F.col("docno").desc() if docno_desc else F.col("docno").asc()
    return Window.partitionBy(*keys).orderBy(F.col("sim").desc(), tie)


def topic_join(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """Only topics that have judgments are evaluated (left semi join on qid)."""
    return run.join(qrels.select("qid").distinct(), "qid", "left_semi")


def bucket_offsets(df: DataFrame, keys, bucket: str = "bucket", weight_cols=()) -> DataFrame:
    """Rows (and sums of ``weight_cols``) in all earlier buckets of the same list: (keys, bucket, _off_*)."""
    keys = list(keys)
    t = df.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("_t_n"), *[F.sum(c).alias(f"_t_{c}") for c in weight_cols])
    w = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return t.select(
        *keys, bucket,
        F.coalesce(F.sum("_t_n").over(w), F.lit(0)).alias("_off_n"),
        *[F.coalesce(F.sum(f"_t_{c}").over(w), F.lit(0)).alias(f"_off_{c}") for c in weight_cols],
    )


def add_rank(run: DataFrame, keys=("run_id", "qid"), docno_desc: bool = True, split_rows: int | None = None) -> DataFrame:
    """rank by score desc (docno tie-break) and the row's range (bucket); ``split_rows``: rows of a range, about."""
    keys = list(keys)
    r = run.withColumn("bucket", range_of(run, docno_desc, split_rows))
    r = r.withColumn("_in", F.row_number().over(rank_window([*keys, "bucket"], docno_desc)))
    heads = prefix_sums(r.groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("_n")), keys, ["_n"]).drop("_n")
    return r.join(heads, [*keys, "bucket"]).withColumn("rank", (F.col("off__n") + F.col("_in")).cast("long")).drop("_in", "off__n")


def max_docs(ranked: DataFrame, m: int | None) -> DataFrame:
    """Keep the first ``m`` documents of every ranked list."""
    return ranked if m is None else ranked.where(F.col("rank") <= F.lit(int(m)))


def attach_relevance(ranked: DataFrame, qrels: DataFrame, keys=("qid", "docno")) -> DataFrame:
    """Left join judgments; absent -> -1 (not pooled), negative -> -2 (unjudged)."""
    q = qrels.select(*keys, F.col("rel").cast("int").alias("_rel"))
    rel = F.coalesce(F.when(F.col("_rel") < 0, F.lit(REL_UNJUDGED)).otherwise(F.col("_rel")), F.lit(REL_NONPOOL))
    return ranked.join(q, list(keys), "left").withColumn("rel", rel.cast("int")).drop("_rel")


def judged_only(ranked: DataFrame, keys=("run_id", "qid")) -> DataFrame:
    """Drop unjudged documents and close up the ranks."""
    keys = list(keys)
    kept = ranked.where(F.col("rel") >= 0)
    kept = kept.withColumn("_in", F.row_number().over(Window.partitionBy(*keys, "bucket").orderBy("rank")))
    kept = kept.join(bucket_offsets(kept, keys), [*keys, "bucket"])
    return kept.withColumn("rank", (F.col("_off_n") + F.col("_in")).cast("long")).drop("_in", "_off_n")


#: Running sums of a scanned list: column of the row -> its running sum.
SUMS = {"is_rel": "cum_rel", "jnr": "cum_jnr", "unj": "cum_unj", "jud": "cum_jud"}


def scan_ranked(
    run: DataFrame,
    qrels: DataFrame,
    level: int = 1,
    max_docs_: int | None = None,
    judged_only_: bool = False,
    split_rows: int | None = None,
    topics: DataFrame | None = None,
    faults: Observation | None = None,
) -> DataFrame:
    """The ranked lists of all judged topics with running sums, in one scan of the order.

    Columns: run_id, qid, docno, sim, rank, rel, bucket, the 0/1 columns of
    ``SUMS`` and their running sums, R and N (judged relevant and nonrelevant
    documents of the topic) and the columns of ``topics`` (one row a qid).
    ``faults`` observes, among the rows of judged topics, documents that a list
    or the judgments hold twice.
    """
    keys = ["run_id", "qid"]
    r = normalize_run(run).where("qid is not null")
    where = range_of(r, rows=split_rows)
    rel = F.col("rel")
    kinds = {"is_rel": rel >= level, "jnr": (rel >= 0) & (rel < level), "unj": rel == REL_UNJUDGED, "jud": rel >= 0}
    r = attach_relevance(r, qrels).withColumns({"bucket": where, **{k: v.cast("int") for k, v in kinds.items()}})
    own_rows = r
    if faults is not None:  # dealt by (qid, docno) already
        doc = Window.partitionBy("qid", "docno")
        q_twice = qrels.select("qid", "docno").withColumn("in_qrels", F.count(F.lit(1)).over(doc)).distinct()
        r = r.withColumn("in_list", F.count(F.lit(1)).over(Window.partitionBy("run_id", "qid", "docno"))).join(q_twice, ["qid", "docno"], "left")
    # the topics' judgments take part in the sums as a range of their own, so they need no join
    own = own_rows.select(*keys, "bucket", F.lit(1).alias("cnt"), *SUMS, F.lit(0).alias("R"), F.lit(0).alias("N"))
    zero = [F.lit(0).alias(c) for c in ("cnt", *SUMS)]
    q = qrels.select(F.lit(None).cast("string").alias("run_id"), F.col("qid").cast("string").alias("qid"), F.lit(-1).alias("bucket"), *zero, kinds["is_rel"].cast("int").alias("R"), kinds["jnr"].cast("int").alias("N"))
    sums = ["cnt", *SUMS]
    heads = own.unionByName(q).groupBy(*keys, "bucket").agg(*(F.sum(c).alias(c) for c in (*sums, "R", "N")))
    # dealt by topic once: the lists of a topic and its judgments, one row a range
    heads = heads.repartition("qid")
    if topics is not None:
        heads = heads.join(topics, "qid", "left")
    topic = Window.partitionBy("qid")
    heads = heads.withColumns({"R": F.sum("R").over(topic), "N": F.sum("N").over(topic), "judged": F.min("bucket").over(topic) < 0})
    heads = prefix_sums(heads, keys, sums).where("judged and run_id is not null").drop("judged", *sums)
    order = rank_window([*keys, "bucket"])
    inside = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = r.withColumns({"rank": F.row_number().over(order), **{c: F.sum(k).over(inside) for k, c in SUMS.items()}})
    r = r.join(heads, [*keys, "bucket"])
    if faults is not None:
        judged_twice = F.col("in_qrels") > 1
        counts = {"judged_twice": judged_twice, "ranked_twice": (F.col("in_list") > F.coalesce("in_qrels", F.lit(1)))}
        r = r.observe(faults, *(F.count(F.when(v, 1)).alias(k) for k, v in counts.items())).drop("in_list", "in_qrels")
    r = r.withColumns({"rank": (F.col("rank") + F.col("off_cnt")).cast("long"), **{c: F.col(c) + F.col(f"off_{k}") for k, c in SUMS.items()}})
    r = max_docs(r.drop(*(f"off_{c}" for c in sums)), max_docs_)
    if judged_only_:  # every judged document counts one, so their running sum is the closed-up rank
        r = r.where("rel >= 0").withColumn("rank", F.col("cum_jud"))
    return r


def build_ranked(
    run: DataFrame,
    qrels: DataFrame,
    max_docs_: int | None = None,
    judged_only_: bool = False,
    split_rows: int | None = None,
) -> DataFrame:
    """``ranked(run_id, qid, docno, sim, rank, rel, bucket)`` for every judged topic of the run."""
    r = scan_ranked(run, qrels, 1, max_docs_, judged_only_, split_rows)
    return r.select(*RUN_COLS, "rank", "rel", "bucket")


def run_ids(run: DataFrame, qrels: DataFrame, max_docs_: int | None = None, judged_only_: bool = False) -> DataFrame:
    """(run_id) of the runs with a ranked document in a judged topic: which lists have one does not depend on their order.

    With both ``max_docs_`` and ``judged_only_`` it does; take :func:`build_ranked` then.
    """
    if judged_only_ and max_docs_ is not None:
        raise ValueError("the judged documents among the first ones depend on the ranks")
    r = normalize_run(run)
    if judged_only_:
        r = r.join(qrels.where("rel >= 0"), ["qid", "docno"], "left_semi")
    if max_docs_ is not None and max_docs_ < 1:
        r = r.where(F.lit(False))
    return topic_join(r.select("run_id", "qid").distinct(), qrels).select("run_id").distinct()


def scan_ranked_jg(
    run: DataFrame,
    qrels_jg: DataFrame,
    level: int = 1,
    max_docs_: int | None = None,
    judged_only_: bool = False,
    split_rows: int | None = None,
    sums: bool = True,
) -> DataFrame:
    """The ranked lists repeated for each judgment group of their topic, in one scan of the order.

    What all groups say about a document moves as one row with it, and the
    copies are made where its range lies, so a list moves once however many
    groups judge it.  A range gets what the groups' judgments in earlier ranges
    add up to, one row with one entry for each group.

    Columns: run_id, qid, jg, docno, sim, rank, rel and bucket; with ``sums``
    is_rel and its running sum in the group's list, and R.
    """
    keys, groups = ["run_id", "qid"], ["qid", "jg"]
    r = normalize_run(run).where("qid is not null")
    where = range_of(r, rows=split_rows)
    q = qrels_jg.where("qid is not null").select("qid", "jg", "docno", F.col("rel").cast("int").alias("rel"))
    r = r.withColumn("bucket", where)
    # one row a range and group: how many documents the list has there, and how many of them the group judged
    is_rel, jud = (F.col("rel") >= level).cast("int"), (F.col("rel") >= 0).cast("int")
    topic = q.groupBy(*groups).agg(F.coalesce(F.sum(is_rel), F.lit(0)).alias("R"))
    ranges = r.groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("cnt"))
    none = [F.lit(0).cast("long").alias(c) for c in ("is_rel", "jud")]
    heads = ranges.join(topic, "qid").select(*keys, "jg", "bucket", "cnt", "R", *none)
    if sums or judged_only_:
        found = r.select(*keys, "docno", "bucket").join(q.where("rel is not null"), ["qid", "docno"])
        found = found.groupBy(*keys, "jg", "bucket").agg(F.sum(is_rel).alias("is_rel"), F.sum(jud).alias("jud"))
        heads = heads.unionByName(found.select(*keys, "jg", "bucket", F.lit(0).cast("long").alias("cnt"), F.lit(0).cast("long").alias("R"), "is_rel", "jud"))
    heads = heads.groupBy(*keys, "jg", "bucket").agg(F.max("R").alias("R"), *(F.sum(c).alias(c) for c in ("cnt", "is_rel", "jud")))
    heads = prefix_sums(heads, [*keys, "jg"], ["cnt", "is_rel", "jud"])
    mine = F.struct("jg", "R", F.col("off_is_rel").alias("is_rel"), F.col("off_jud").alias("jud"))
    heads = heads.groupBy(*keys, "bucket").agg(F.max("off_cnt").alias("off_cnt"), F.collect_list(mine).alias("groups"))
    judged = q.groupBy("qid", "docno").agg(F.collect_list(F.struct("jg", "rel")).alias("judged"))
    r = r.join(judged, ["qid", "docno"], "left")
    r = r.withColumn("rank", F.row_number().over(rank_window([*keys, "bucket"]))).join(heads, [*keys, "bucket"])
    r = max_docs(r.withColumn("rank", (F.col("rank") + F.col("off_cnt")).cast("long")), max_docs_)
    r = r.select(*RUN_COLS, "rank", "bucket", "judged", F.explode("groups").alias("g"))
    own = F.filter("judged", lambda x: x["jg"] == F.col("g.jg"))
    r = r.select(*RUN_COLS, "rank", "bucket", "g", F.explode_outer(F.transform(own, lambda x: x["rel"])).alias("_rel"))
    rel = F.coalesce(F.when(F.col("_rel") < 0, F.lit(REL_UNJUDGED)).otherwise(F.col("_rel")), F.lit(REL_NONPOOL))
    r = r.select("run_id", "qid", F.col("g.jg").alias("jg"), "docno", "sim", "rank", rel.cast("int").alias("rel"), "bucket", "g")
    inside = Window.partitionBy(*keys, "bucket", "jg").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if judged_only_:  # every judged document counts one, so their running sum is the closed-up rank
        r = r.where("rel >= 0").withColumn("rank", (F.col("g.jud") + F.row_number().over(inside)).cast("long"))
    if sums:
        r = r.withColumn("is_rel", is_rel).withColumns({"cum_rel": F.col("g.is_rel") + F.sum("is_rel").over(inside), "R": F.col("g.R")})
    return r.drop("g")


def build_ranked_jg(
    run: DataFrame,
    qrels_jg: DataFrame,
    max_docs_: int | None = None,
    judged_only_: bool = False,
    split_rows: int | None = None,
) -> DataFrame:
    """The ranked list repeated for each judgment group of its topic."""
    return scan_ranked_jg(run, qrels_jg, 1, max_docs_, judged_only_, split_rows, sums=False)


def topic_stats(ranked: DataFrame, qrels: DataFrame, level: int = 1) -> DataFrame:
    """Per topic: R, judged nonrelevant N, n, r, nonpool, unjudged."""
    j = qrels.groupBy("qid").agg(
        F.sum(F.when(F.col("rel") >= level, 1).otherwise(0)).cast("long").alias("num_rel"),
        F.sum(F.when((F.col("rel") >= 0) & (F.col("rel") < level), 1).otherwise(0)).cast("long").alias("num_nonrel"),
    )
    r = ranked.groupBy("run_id", "qid").agg(
        F.count(F.lit(1)).alias("num_ret"),
        F.sum(F.when(F.col("rel") >= level, 1).otherwise(0)).cast("long").alias("num_rel_ret"),
        F.sum(F.when(F.col("rel") == REL_NONPOOL, 1).otherwise(0)).cast("long").alias("num_nonpool"),
        F.sum(F.when(F.col("rel") == REL_UNJUDGED, 1).otherwise(0)).cast("long").alias("num_unjudged"),
    )
    return r.join(j, "qid")


def duplicates(df: DataFrame, keys=("qid", "docno")) -> DataFrame:
    """Rows whose key occurs more than once (validation of runs and judgments)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def validate(df: DataFrame, keys=("qid", "docno"), what: str = "input") -> None:
    """Raise when a key is duplicated (one small action; used on request only)."""
    bad = duplicates(df, keys).limit(1).collect()
    if bad:
        raise ValueError(f"duplicate {'/'.join(keys)} in {what}: {bad[0].asDict()}")


def topic_filter(df: DataFrame, qid) -> DataFrame:
    """Keep one topic (a literal id) or the topics listed in a DataFrame with a ``qid`` column."""
    if isinstance(qid, DataFrame):
        return df.join(qid.select(F.col("qid").cast("string").alias("qid")), "qid", "left_semi")
    return df.where(F.col("qid") == F.lit(str(qid)))
