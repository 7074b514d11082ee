"""Linear ranking models: apply, search weights, cross-validate.

``linear_rerank`` is a projection plus one ranking window.  ``weight_search``
is coordinate ascent with exact steps: along one weight a query's ranking
changes only where two of its documents swap, so the mean of the measure is a
step function of that weight, known from the swaps.  ``line_steps`` finds the
swaps of every relevant document with the documents of its query by a join,
turns them into running ranks and into changes of the measure, and takes
prefix sums of the changes over all queries.  One pass serves every weight of
every search state (restart, fold) at once; only the best step of each state
returns to the driver.
"""

from __future__ import annotations

import json
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklens.functions.exact import exact_sum, exact_total
from ranklens.operators.ordered import prefix_sums, range_of
from ranklens.session import written

# fixed values: coordinate-ascent parameters of the recorded learner runs
RESTARTS = 5
TOLERANCE = 0.001

#: Decimals of a swap's place on the line: swaps that agree in them are one event.
PLACES = 9
#: A step goes into intervals between events that are wider than this.
MIN_WIDTH = 1e-6
#: Stands for the line's start; no event lies before it.
_START = -1e300
_STATES = "array<struct<state:int,fold:int,w:array<double>>>"

# fixed values: weights of the recorded five-feature model
MODEL_WEIGHTS_5 = (0.7577692523343371, -0.005301593468447657, 0.15936974110041052, 0.006847577972692485, 0.07071183512411222)


def feature_cols(df: DataFrame) -> list[str]:
    return sorted([c for c in df.columns if c.startswith("f") and c[1:].isdigit()], key=lambda c: int(c[1:]))


def _dot(weights, cols) -> Column:
    return exact_total(F.array(*(F.lit(float(w)) * F.col(c).cast("double") for w, c in zip(weights, cols))))


def linear_rerank(features: DataFrame, weights, k: int | None = None) -> DataFrame:
    """score = Σ wᵢ·fᵢ, ranked per query (score desc, docno asc); equal sums tie, whatever the order of their terms."""
    cols = feature_cols(features)
    sc = features.withColumn("score", _dot(weights, cols))
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("docno"))
    out = sc.withColumn("rank", F.row_number().over(w).cast("long"))
    return out if k is None else out.where(F.col("rank") <= k)


def average_precision(ranked: DataFrame, keys=("qid",), num_rel: DataFrame | None = None) -> DataFrame:
    """AP per list from ``label`` and ``rank``; R from ``num_rel(qid, R)`` when given, else from the labels."""
    w = Window.partitionBy(*keys).orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = ranked.withColumn("_cum", F.sum("label").over(w))
    agg = r.groupBy(*keys).agg(
        F.sum(F.when(F.col("label") > 0, F.col("_cum") / F.col("rank")).otherwise(0.0)).alias("_s"),
        F.sum(F.when(F.col("label") > 0, 1).otherwise(0)).alias("_r"),
    )
    if num_rel is not None:
        agg = agg.join(num_rel, "qid", "left").withColumn("_r", F.coalesce(F.col("R"), F.col("_r")))
    return agg.select(*keys, F.when(F.col("_r") > 0, F.col("_s") / F.col("_r")).otherwise(0.0).alias("ap"))


def mean_average_precision(features: DataFrame, weights) -> DataFrame:
    return average_precision(linear_rerank(features, weights)).agg(F.avg("ap").alias("map"))


def _states(features: DataFrame, states: list[tuple[int, list[float]]], held_out: bool = False) -> DataFrame:
    """The feature rows of every state's training folds (or its held-out fold), with the state's scores."""
    cols = feature_cols(features)
    # one constant (folded by the optimizer) instead of an expression per state: small generated code
    listed = [{"state": i, "fold": fold, "w": [float(x) for x in w]} for i, (fold, w) in enumerate(states)]
    fv = F.array(*(F.col(c).cast("double") for c in cols)).alias("fv")
    fold = F.col("fold") if "fold" in features.columns else F.lit(-1)
    x = features.select("qid", "docno", "label", fold.alias("fold"), fv, F.explode(F.from_json(F.lit(json.dumps(listed)), _STATES)).alias("s"))
    mine = F.col("fold") == F.col("s.fold")
    x = x.where(mine if held_out else ~mine | (F.col("s.fold") < 0))
    return x.select(F.col("s.state").alias("state"), "qid", "docno", "label", "fv", exact_total(F.zip_with("s.w", "fv", lambda a, b: a * b)).alias("score"))


def _gain(metric: str, label: Column, above: Column, rank: Column) -> Column:
    """What a relevant document adds to its query's measure, before the division by the query's norm."""
    if metric == "map":
        return above / rank
    return F.when(rank <= int(metric.split("@")[1]), (F.pow(F.lit(2.0), label) - 1) / F.log2(rank + 1)).otherwise(0.0)


def query_norms(features: DataFrame, metric: str = "map", num_rel: DataFrame | None = None) -> DataFrame:
    """(qid, norm) of the queries with relevant documents: their number (``num_rel(qid, R)`` when given), or the ideal gain."""
    rel = features.where("label > 0")
    if metric == "map":
        own = rel.groupBy("qid").agg(F.count(F.lit(1)).cast("double").alias("norm"))
        return own if num_rel is None else own.join(num_rel, "qid", "left").select("qid", F.coalesce(F.col("R").cast("double"), "norm").alias("norm"))
    best = Window.partitionBy("qid").orderBy(F.col("label").desc(), "docno")
    ideal = rel.select("qid", "label", F.row_number().over(best).alias("rank")).where(F.col("rank") <= int(metric.split("@")[1]))
    return ideal.groupBy("qid").agg(exact_sum(_gain(metric, F.col("label"), F.col("rank"), F.col("rank"))).alias("norm"))


def _metric(metric: str) -> str:
    if metric != "map" and not (metric.startswith("ndcg@") and metric[5:].isdigit() and int(metric[5:])):
        raise ValueError(f"unknown metric {metric!r}: map or ndcg@<cutoff>")
    return metric


def _values(features: DataFrame, states, norms: DataFrame, metric: str, held_out: bool = False) -> dict[int, float]:
    """The mean over queries of the measure for every state; queries without relevant documents count as 0."""
    x = _states(features, states, held_out)
    order = Window.partitionBy("state", "qid").orderBy(F.col("score").desc(), "docno")
    x = x.withColumns({"rank": F.row_number().over(order), "above": F.count(F.when(F.col("label") > 0, 1)).over(order.rowsBetween(Window.unboundedPreceding, 0))})
    part = F.when(F.col("label") > 0, _gain(metric, F.col("label"), F.col("above"), F.col("rank"))).otherwise(0.0)
    q = x.groupBy("state", "qid").agg(exact_sum(part).alias("v")).join(norms, "qid", "left")
    rows = q.groupBy("state").agg(exact_sum(F.coalesce(F.when(F.col("norm") > 0, F.col("v") / F.col("norm")), F.lit(0.0))).alias("v"), F.count(F.lit(1)).alias("n")).collect()
    return {r.state: r.v / r.n for r in rows}


def line_steps(features: DataFrame, states: list[tuple[int, list[float]]], metric: str = "map", norms: DataFrame | None = None) -> DataFrame:
    """(state, coord, t, value, until): the measure while ``t`` to ``until`` is added to one weight of a state.

    ``states``: (fold left out or -1, weights).  (qid, docno) must be unique.
    ``until`` is null for a coordinate's last step; its first starts at -1e300.
    A document's rank is followed over its own swaps only, so the largest unit
    of work is one document's query; the sums over all queries are prefix sums
    over ranges of (state, coord, t), however many swaps there are.
    """
    norms = query_norms(features, metric) if norms is None else norms
    x = _states(features, states)
    k = len(feature_cols(features))
    r = x.where("label > 0").select("state", "qid", F.col("docno").alias("doc"), F.col("label").alias("gain"), F.col("fv").alias("mine"), F.col("score").alias("own"))
    e = x.select("state", "qid", "docno", (F.col("label") > 0).cast("int").alias("rel"), "fv", "score")
    pair = r.join(e, ["state", "qid"])
    moves = []
    for i in range(k):
        dx = F.col("mine")[i] - F.col("fv")[i]
        ds = F.col("own") - F.col("score")
        # the order at the line's start; a document counts as above itself, so ranks start at 1
        level = (ds < 0) | ((ds == 0) & (F.col("docno") <= F.col("doc")))
        above = F.when(dx == 0, level).otherwise(dx > 0)
        at = F.when(dx != 0, F.round(-ds / dx, PLACES) + 0.0)
        moves.append(F.when(above, F.struct(F.lit(i).alias("coord"), F.lit(_START).alias("t"), F.lit(1).alias("move"))))
        moves.append(F.when(at.isNotNull(), F.struct(F.lit(i).alias("coord"), at.alias("t"), F.when(dx > 0, -1).otherwise(1).alias("move"))))
    pair = pair.select("state", "qid", "doc", "gain", "rel", F.explode(F.filter(F.array(*moves), lambda m: m.isNotNull())).alias("m"))
    doc = ["state", "qid", "doc", "gain", "m.coord"]
    steps = pair.groupBy(*doc, "m.t").agg(F.sum("m.move").alias("move"), F.sum(F.col("m.move") * F.col("rel")).alias("rel"))
    own = Window.partitionBy("state", "qid", "doc", "coord").orderBy("t")
    past = own.rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.withColumn("v", _gain(metric, F.col("gain"), F.sum("rel").over(past), F.sum("move").over(past)))
    steps = steps.withColumn("change", F.col("v") - F.coalesce(F.lag("v").over(own), F.lit(0.0)))
    queries = x.groupBy("state").agg(F.countDistinct("qid").alias("queries"))
    change = steps.join(norms.where("norm > 0"), "qid").select("state", "coord", "t", (F.col("change") / F.col("norm")).alias("change"))
    events = written(change.groupBy("state", "coord", "t").agg(exact_sum(F.col("change")).alias("change")), "events")
    events = events.withColumn("bucket", range_of(events, by=(F.col("state").cast("string"), F.col("coord").cast("string"), -F.col("t"), F.lit(""))))
    line = Window.partitionBy("state", "coord")
    totals = events.groupBy("state", "coord", "bucket").agg(F.sum("change").alias("change"), F.min("t").alias("first"))
    totals = prefix_sums(totals, ["state", "coord"], ["change"]).withColumn("next", F.lead("first").over(line.orderBy("bucket")))
    inside = Window.partitionBy("state", "coord", "bucket").orderBy("t")
    run = events.join(totals.drop("change"), ["state", "coord", "bucket"])
    run = run.withColumns({"sum": F.sum("change").over(inside.rowsBetween(Window.unboundedPreceding, 0)) + F.col("off_change"), "until": F.coalesce(F.lead("t").over(inside), "next")})
    return run.join(F.broadcast(queries), "state").select("state", "coord", "t", (F.col("sum") / F.col("queries")).alias("value"), "until")


def best_steps(steps: DataFrame, keys=("state",)) -> DataFrame:
    """(keys, value, coord, step): the best step of ``line_steps``, ties to the first weight, then the smallest step."""
    inside = F.when(F.col("t") == _START, F.col("until") - 1).when(F.col("until").isNull(), F.col("t") + 1).otherwise((F.col("t") + F.col("until")) / 2)
    wide = steps.where(F.col("until").isNull() | (F.col("until") - F.col("t") > MIN_WIDTH))
    # a weight that never swaps documents has one step, which changes nothing
    step = F.when((F.col("t") == _START) & F.col("until").isNull(), 0.0).otherwise(inside)
    best = F.max(F.struct(F.round("value", 12).alias("value"), (-F.col("coord")).alias("c"), (-F.abs(step)).alias("size"), step.alias("step")))
    return wide.groupBy(*keys).agg(best.alias("b")).select(*(c for c in keys if c != "coord"), "b.value", (-F.col("b.c")).alias("coord"), "b.step")


def _normalize(w: list[float]) -> list[float]:
    s = sum(abs(x) for x in w)
    return [x / s for x in w] if s > 0 else w


def _search(features: DataFrame, states: list[tuple[int, list[float]]], metric: str, tolerance: float, norms: DataFrame) -> list[tuple[list[float], float]]:
    """Coordinate ascent of every state at once: (weights, value) of each, when no step gains more than ``tolerance``."""
    now = [list(w) for _, w in states]
    first = _values(features, states, norms, metric)
    value = [first.get(i, 0.0) for i in range(len(states))]
    live = [i for i in range(len(states)) if i in first]
    while live:
        found = best_steps(line_steps(features, [(states[i][0], now[i]) for i in live], metric, norms)).collect()
        going = []
        for b in found:
            i = live[b.state]
            if b.value - value[i] > tolerance:
                now[i][b.coord] += b.step
                now[i], value[i] = _normalize(now[i]), b.value
                going.append(i)
        live = sorted(going)
    return list(zip(now, value))


def _starts(k: int, restarts: int, seed: int) -> list[list[float]]:
    rng = random.Random(seed)
    return [[1.0 / k] * k if r == 0 else _normalize([rng.random() for _ in range(k)]) for r in range(restarts)]


def weight_search(
    features: DataFrame, restarts: int = RESTARTS, tolerance: float = TOLERANCE, seed: int = 42, metric: str = "map", num_rel: DataFrame | None = None
) -> tuple[list[float], float]:
    """Coordinate ascent on ``metric`` (``map`` or ``ndcg@10``); returns (weights normalised to Σ|w| = 1, training value).

    Each round takes, for every restart, the best of all steps along any one
    weight (:func:`line_steps`), found in one pass over the swaps; a restart
    ends when no step gains more than ``tolerance``.  Restarts after the first
    start from seeded random weights; the first of the best wins.  The value is
    measured at the returned weights.  ``num_rel(qid, R)`` gives the relevant
    documents of the judgments, also those that no ranking found.  No rows: uniform weights, 0.
    """
    cols = feature_cols(features)
    rows = written(features.select("qid", "docno", "label", *cols), "features")
    norms = written(query_norms(rows, _metric(metric), num_rel), "norms")
    ended = _search(rows, [(-1, w) for w in _starts(len(cols), restarts, seed)], metric, tolerance, norms)
    w = max(ended, key=lambda e: e[1])[0]
    return w, _values(rows, [(-1, w)], norms, metric).get(0, 0.0)


def kfold_split(features: DataFrame, k: int = 5) -> DataFrame:
    """Fold of every query: first 8 hex digits of md5(qid) modulo k (stable across engines)."""
    h = F.conv(F.substring(F.md5(F.col("qid").cast("string")), 1, 8), 16, 10).cast("long")
    return features.withColumn("fold", F.pmod(h, F.lit(k)).cast("int"))


def cv_eval(
    features: DataFrame, k: int = 5, restarts: int = RESTARTS, tolerance: float = TOLERANCE, seed: int = 42, metric: str = "map", num_rel: DataFrame | None = None
) -> DataFrame:
    """(fold, train_map, test_map): weights searched on the other folds, measured there and on the held-out fold.

    All folds and restarts are searched together, one pass for each round.  A
    fold without queries has 0.  Columns are named alike for every ``metric``.
    """
    cols = feature_cols(features)
    rows = written(kfold_split(features.select("qid", "docno", "label", *cols), k), "features")
    norms = written(query_norms(rows, _metric(metric), num_rel), "norms")
    starts = _starts(len(cols), restarts, seed)
    ended = _search(rows, [(fold, w) for fold in range(k) for w in starts], metric, tolerance, norms)
    best = [(fold, max(ended[fold * restarts : (fold + 1) * restarts], key=lambda e: e[1])[0]) for fold in range(k)]
    train, test = _values(rows, best, norms, metric), _values(rows, best, norms, metric, held_out=True)
    found = [(fold, train.get(fold, 0.0), test.get(fold, 0.0)) for fold in range(k)]
    return features.sparkSession.createDataFrame(found, "fold int, train_map double, test_map double")
