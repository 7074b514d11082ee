import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ranklens.functions.exact import exact_sum


def test_sums_do_not_depend_on_order(spark):
    r = random.Random(1)
    terms = [r.uniform(-3, 3) * 10 ** r.randint(-6, 3) for _ in range(500)]
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(terms)
        df = spark.createDataFrame([(t,) for t in terms], "t double").repartition(seed + 1)
        seen.add(df.agg(exact_sum(F.col("t")).alias("s")).first().s)
    assert len(seen) == 1
    assert seen.pop() == pytest.approx(float(sum(map(Fraction, terms))), rel=1e-12)


def test_nulls_nans_infinities_and_empty_groups(spark):
    rows = [("a", 1.5), ("a", None), ("b", float("nan")), ("b", 1.0), ("c", float("inf")), ("c", -2.0), ("d", None), ("e", -11.25)]
    df = spark.createDataFrame(rows, "k string, t double").groupBy("k").agg(exact_sum(F.col("t"), finite=False).alias("s"))
    got = {r.k: r.s for r in df.collect()}
    assert got["a"] == 1.5 and got["b"] != got["b"] and got["c"] == float("inf") and got["d"] is None and got["e"] == -11.25
