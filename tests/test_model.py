"""Model tests: the X/y contract, learning on a table with signal,
repeatable fits, save/load."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from daybook.config import FEATURE_COLUMNS, TARGET_COL
from daybook.functions.metrics import regression_metrics
from daybook.operators.model import (
    DemandModel,
    category_target_stats,
    feature_importance,
    fit_gbt,
    split_by_date,
    split_features_target,
    xy_projection,
)
from daybook.operators.scoring import score
from daybook.operators.timeseries import build_features


@pytest.fixture(scope="module")
def sample(spark):
    # The two-row sample of the original unit tests.
    return spark.createDataFrame(
        [("Product A", "Pune", 10.0, 11.0, 12.0, 1, 3, "x", 100.0),
         ("Product B", "Mumbai", 20.0, 21.0, 22.0, 2, 4, "y", 200.0)],
        "product_name string, destination_city string, demand_1 double, demand_7 double, "
        "rolling_7_day_avg double, month int, day_of_week int, extra_column string, "
        "total_demand double")


def test_x_has_only_feature_columns(sample):
    x, _ = split_features_target(sample)
    assert x.columns == FEATURE_COLUMNS


def test_x_does_not_contain_target(sample):
    x, _ = split_features_target(sample)
    assert TARGET_COL not in x.columns


def test_y_is_target_column(sample):
    _, y = split_features_target(sample)
    assert y.columns == [TARGET_COL]
    assert [r[0] for r in y.collect()] == [100.0, 200.0]


def test_row_count_is_unchanged(sample):
    x, y = split_features_target(sample)
    assert x.count() == sample.count() == y.count()


def test_missing_feature_column_raises_key_error(sample):
    with pytest.raises(KeyError):
        xy_projection(sample.drop("demand_1"))


@pytest.fixture(scope="module")
def signal_features(spark):
    """Demand = weekday effect + product effect (+ a small deterministic wobble)."""
    start = dt.date(2023, 1, 1)
    rows = []
    for p_i, product in enumerate(["A", "B", "C"]):
        for city in ["X", "Y"]:
            for k in range(220):
                day = start + dt.timedelta(days=k)
                demand = 10.0 * (day.isoweekday() % 7) + 25.0 * p_i + (k % 3)
                rows.append((day, product, city, demand, 1.0, 1.0, 1))
    daily = spark.createDataFrame(
        rows, "transaction_date date, product_name string, destination_city string, "
              "total_demand double, avg_unit_price double, total_inventory double, "
              "transaction_count bigint")
    return build_features(daily)


def test_model_learns_signal(signal_features):
    train, test = split_by_date(signal_features, "2023-06-30")
    model = fit_gbt(train, max_iter=15, max_depth=4, step_size=0.3)
    preds = score(model, test, "gbt")
    r2 = regression_metrics(preds).first()["r2"]
    assert r2 > 0.8
    imp = feature_importance(model).collect()
    assert len(imp) == 7 and {r.feature for r in imp} == set(FEATURE_COLUMNS)
    assert imp[0].importance >= imp[-1].importance


def test_fit_repeatable_and_save_load(signal_features):
    train, test = split_by_date(signal_features, "2023-06-30")
    m1 = fit_gbt(train, max_iter=5, max_depth=3)
    m2 = fit_gbt(train, max_iter=5, max_depth=3)
    p1 = score(m1, test, "a").select("transaction_date", "product_name", "destination_city",
                                     "predicted_demand")
    p2 = score(m2, test, "a").select(*p1.columns)
    assert p1.exceptAll(p2).count() == 0 and p2.exceptAll(p1).count() == 0
    path = os.path.join(tempfile.mkdtemp(prefix="daybook-model-"), "m")
    m1.save(path)
    p3 = score(DemandModel.load(m1.totals.sparkSession, path), test, "a").select(*p1.columns)
    assert p1.exceptAll(p3).count() == 0


def test_unseen_category_and_null_features(spark, signal_features):
    train, _ = split_by_date(signal_features, "2023-06-30")
    model = fit_gbt(train, max_iter=3, max_depth=3)
    odd = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "Z", "X", None, None, None, 1, 2, 5.0)],
        "transaction_date date, product_name string, destination_city string, demand_1 double, "
        "demand_7 double, rolling_7_day_avg double, month int, day_of_week int, total_demand double")
    r = score(model, odd, "a").first()
    assert r.predicted_demand is not None


def _categories(spark, n):
    return spark.range(max(n, 3000)).select(
        F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("transaction_date"),
        F.concat(F.lit("p"), (F.col("id") % n).cast("string")).alias("product_name"),
        F.lit("X").alias("destination_city"),
        (F.col("id") % 7).cast("double").alias("demand_1"),
        (F.col("id") % 5).cast("double").alias("demand_7"),
        (F.col("id") % 3).cast("double").alias("rolling_7_day_avg"),
        F.lit(1).alias("month"), F.lit(2).alias("day_of_week"),
        (F.col("id") % 7 * 2.0).alias("total_demand"))


@pytest.mark.parametrize("n", [10, 50_000])
def test_any_number_of_categories_takes_the_same_path(spark, n):
    df = _categories(spark, n)
    model = fit_gbt(df, max_iter=2, max_depth=3)
    assert model.trees.count() == 2 and len(model.feature_names) == 7
    assert model.totals.filter(F.col("feature") == "product_name").count() == n
    assert len(feature_importance(model).collect()) == 7
    assert score(model, df, "a").count() == df.count()


def test_target_stats_see_earlier_days_only(spark):
    rows = [("2023-01-01", "a", 10.0), ("2023-01-01", "b", 2.0), ("2023-01-02", "a", 4.0),
            ("2023-01-02", "a", None), ("2023-01-02", "a", float("nan")), ("2023-01-03", None, 1.0),
            ("2023-01-03", "a", 7.0)]
    df = spark.createDataFrame(rows, "d string, c string, y double").withColumn("d", F.to_date("d"))
    got = {(str(r.d), r.category): (r.earlier_rows, r.earlier_sum, r.prior, r.encoded)
           for r in category_target_stats(df, ["c"], "y", "d").collect()}
    prior = 16.0 / 3
    assert got == {
        ("2023-01-01", "a"): (0, 0.0, None, None), ("2023-01-01", "b"): (0, 0.0, None, None),
        ("2023-01-02", "a"): (1, 10.0, 6.0, 8.0),
        ("2023-01-03", "a"): (2, 14.0, prior, (14.0 + prior) / 3),
        ("2023-01-03", None): (0, 0.0, prior, prior)}


def test_nan_features_and_odd_names(spark):
    df = _categories(spark, 10).withColumn("a__b", F.lit(float("nan")))
    model = fit_gbt(df, numeric=["demand_1", "a__b"], max_iter=2, max_depth=3)
    assert {r.feature for r in feature_importance(model).collect()} == {
        "demand_1", "a__b", "product_name", "destination_city"}
    assert score(model, df, "a").filter("predicted_demand is null").count() == 0
