"""Order-independent sums against exact arithmetic and any partitioning."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from daybook.config import KEY_COLUMNS
from daybook.functions.exact import exact_avg, exact_sum
from daybook.functions.metrics import regression_metrics
from daybook.operators.aggregate import daily_agg


def total(spark, values, parts=3):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return df.agg(exact_sum(F.col("x")).alias("s")).first().s


def near(got, values):
    """Within one unit in the last place of the exact sum."""
    want = float(sum(map(Fraction, values)))
    return abs(got - want) <= math.ulp(want)


def test_sums_equal_exact_arithmetic(spark):
    rng = random.Random(1)
    cases = [[0.1] * 10, [1e16, 1.0, -1e16], [-0.1, -0.2], [0.0, -0.0], [2.0 ** 82, 1.0, -(2.0 ** 82)],
             [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-8, 20) for _ in range(3000)],
             [rng.random() - 0.5 for _ in range(3000)], [-3.75e-9] * 7, [1e24, -1e-9]]
    for values in cases:
        assert near(total(spark, values), values), values[:5]
    assert total(spark, [1e16, 1.0, -1e16]) == 1.0
    assert total(spark, [1e-60, 5e-300]) == 0.0  # multiples of 2^-84
    assert total(spark, [None, 1.5, None]) == 1.5 and total(spark, [None]) is None
    assert total(spark, []) is None
    assert total(spark, [1e300, 1.0]) == 1e300 and math.isnan(total(spark, [float("nan"), 1.0]))
    assert total(spark, [float("inf"), 1.0]) == math.inf
    df = spark.createDataFrame([(None,), (1.0,), (2.0,)], "x double")
    assert df.agg(exact_avg(F.col("x")).alias("a")).first().a == 1.5


def shuffled(spark, n=4000):
    rng = random.Random(2)
    rows = [(i, f"2023-01-0{rng.randrange(1, 4)}", rng.choice("ab"), rng.lognormvariate(0, 4),
             rng.lognormvariate(0, 4), rng.choice("12")) for i in range(n)]
    schema = "id long, day string, product string, y double, p double, v string"
    out = {}
    for parts in (1, 7, 200):
        rng.shuffle(rows)
        out[parts] = spark.createDataFrame(rows, schema).repartition(parts, "id")
    return out


def test_metrics_and_daily_sums_are_bit_equal_for_any_partitioning(spark):
    frames = shuffled(spark)
    metrics, daily, plain = set(), set(), set()
    for df in frames.values():
        metrics.add(tuple(map(tuple, regression_metrics(df, "y", "p", ["v"]).orderBy("v").collect()))
                    + tuple(regression_metrics(df, "y", "p").first()))
        tx = df.select(F.to_date("day").alias(KEY_COLUMNS[0]), F.col("product").alias(KEY_COLUMNS[1]),
                       F.lit("X").alias(KEY_COLUMNS[2]), F.col("y").alias("demand_quantity"),
                       F.col("p").alias("unit_price_usd"), F.col("y").alias("available_inventory"))
        daily.add(tuple(map(tuple, daily_agg(tx).orderBy(*KEY_COLUMNS).collect())))
        plain.add(tuple(map(tuple, df.groupBy("v").agg(F.sum("y"), F.var_pop("y")).orderBy("v").collect())))
    assert len(metrics) == 1 and len(daily) == 1
    assert len(plain) > 1  # the plain sums of these rows do differ


def test_metrics_equal_exact_arithmetic(spark):
    df = shuffled(spark, 500)[7]
    rows = [(Fraction(r.y), Fraction(r.p)) for r in df.collect()]
    mean = sum(y for y, _ in rows) / len(rows)
    sse, sst = sum((y - p) ** 2 for y, p in rows), sum((y - mean) ** 2 for y, _ in rows)
    m = regression_metrics(df, "y", "p").first()
    assert m.r2 == pytest.approx(float(1 - sse / sst), rel=1e-12)
    assert m.mae == pytest.approx(float(sum(abs(y - p) for y, p in rows) / len(rows)), rel=1e-14)
    assert regression_metrics(df.limit(0), "y", "p").first().n == 0
    same = spark.createDataFrame([(2.0, 2.0, None), (2.0, 2.0, None)], "y double, p double, v string")
    assert regression_metrics(same, "y", "p", ["v"]).first().r2 == 1.0  # a NULL group is a group


def test_spread_of_labels_far_from_zero(spark):
    rows = [(1e7 + (i % 3) * 1e-2, 1e7) for i in range(300)]
    y = [Fraction(a) for a, _ in rows]
    mean = sum(y) / len(y)
    sst, sse = sum((a - mean) ** 2 for a in y), sum((a - Fraction(1e7)) ** 2 for a in y)
    df = spark.createDataFrame(rows, "y double, p double").repartition(5)
    assert regression_metrics(df, "y", "p").first().r2 == pytest.approx(float(1 - sse / sst), rel=1e-9)
    far = spark.createDataFrame([(1e15, 1e15), (3e15, 2e15)], "y double, p double")
    assert regression_metrics(far, "y", "p").first().r2 == pytest.approx(0.5)
