"""Hand-made edge tables (FIXTURES.md §7)."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from daybook.config import RAW_COLUMNS, RAW_SCHEMA
from daybook.errors import DataContractError
from daybook.operators import contracts as C
from daybook.operators.aggregate import daily_agg
from daybook.operators.clean import dedupe_by_key, parse_dates
from daybook.operators.lifecycle import decide, promote
from daybook.functions.metrics import regression_metrics
from daybook.operators.timeseries import build_features, gapfill_days, gapfill_days_join
from daybook.sources.files import publish, read_raw_csv, read_table

DAILY_SCHEMA = ("transaction_date date, product_name string, destination_city string, "
                "total_demand double, avg_unit_price double, total_inventory double, "
                "transaction_count bigint")


def d(day: int) -> dt.date:
    return dt.date(2024, 1, day)


def daily_rows(spark, rows):
    return spark.createDataFrame(
        [(d(day), p, c, float(v), 1.0, 1.0, 1) for day, p, c, v in rows], DAILY_SCHEMA)


def test_dup_ids_collapse_nulls(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 5), (None, 3)], "id string, v int")
    out = {(r.id, r.v) for r in dedupe_by_key(df, "id").collect()}
    # one row per id, NULL ids form one group; the survivor is the smallest row
    assert out == {("a", 1), (None, 3)}


def test_dedupe_is_repeatable_and_idempotent(spark):
    df = spark.createDataFrame([(i % 3, 10 - i) for i in range(10)], "id int, v int").repartition(4)
    once = dedupe_by_key(df, "id")
    assert sorted(once.collect()) == sorted(dedupe_by_key(df.repartition(3), "id").collect())
    assert sorted(dedupe_by_key(once, "id").collect()) == sorted(once.collect())


def test_bad_dates_all_invalid(spark):
    texts = ["2026-13-01", "2026-02-30", "2026-1-1", " 2026-01-01", "2026-01-01 10:00", None]
    df = spark.createDataFrame([(t,) for t in texts], "transaction_date string")
    assert C.invalid_date_count(df).first()["invalid_dates"] == 6
    assert parse_dates(df).filter(F.col("transaction_date").isNotNull()).count() == 0
    good = spark.createDataFrame([("2026-01-31",)], "transaction_date string")
    assert parse_dates(good).first()[0] == dt.date(2026, 1, 31)


def test_one_day_series(spark):
    out = build_features(daily_rows(spark, [(1, "p", "c", 4)])).collect()
    assert len(out) == 1
    r = out[0]
    assert r.demand_1 is None and r.demand_7 is None and r.rolling_7_day_avg is None


def test_long_gap(spark):
    out = build_features(daily_rows(spark, [(1, "p", "c", 4), (12, "p", "c", 9)]))
    rows = out.orderBy("transaction_date").collect()
    assert len(rows) == 12
    last = rows[-1]
    assert (last.demand_1, last.demand_7, last.rolling_7_day_avg) == (0.0, 0.0, 0.0)
    filled = rows[5]
    assert filled.total_demand == 0.0 and filled.transaction_count == 0
    assert filled.avg_unit_price is None and filled.total_inventory is None


def test_partial_roll(spark):
    out = build_features(daily_rows(spark, [(1, "p", "c", 5), (4, "p", "c", 7)]))
    rolls = [r.rolling_7_day_avg for r in out.orderBy("transaction_date").collect()]
    assert rolls == [None, 5.0, 2.5, 1.6666666666666667]


def test_calendar_sunday_is_one(spark):
    # 2024-01-07 is a Sunday
    out = build_features(daily_rows(spark, [(7, "p", "c", 1), (8, "p", "c", 1)]))
    dows = [r.day_of_week for r in out.orderBy("transaction_date").collect()]
    assert dows == [1, 2]


def test_null_keys_rejected_before_publish(spark):
    daily = daily_rows(spark, [(1, "p", "c", 1), (2, "p", "c", 2)]).unionByName(
        spark.createDataFrame([(d(1), None, "c", 3.0, 1.0, 1.0, 1)], DAILY_SCHEMA))
    feats = build_features(daily)
    target = os.path.join(tempfile.mkdtemp(prefix="daybook-pub-"), "features")
    good = build_features(daily_rows(spark, [(1, "p", "c", 1)]))
    publish(good, target, lambda staged, n: C.require_features(staged, n))
    with pytest.raises(DataContractError) as e:
        publish(feats, target, lambda staged, n: C.require_features(staged, n))
    assert e.value.contract == "features"
    # the earlier, good table is still in place
    assert read_table(spark, target).count() == 1


def _write_text(text: str) -> str:
    path = os.path.join(tempfile.mkdtemp(prefix="daybook-csv-"), "raw.csv")
    with open(path, "w") as f:
        f.write(text)
    return path


def _row(values: dict) -> str:
    return ",".join("" if values.get(c) is None else str(values[c]) for c in RAW_COLUMNS)


GOOD = {"transaction_id": "1-1", "transaction_date": "2024-01-01", "product_name": "p",
        "destination_city": "c", "demand_quantity": 3.0, "unit_price_usd": 2.0,
        "available_inventory": 5.0}


def test_csv_good_file(spark):
    path = _write_text(",".join(RAW_COLUMNS) + "\n" + _row(GOOD) + "\n")
    rows = read_raw_csv(spark, path).collect()
    assert len(rows) == 1 and rows[0].demand_quantity == 3.0 and rows[0].transaction_year is None


def test_csv_bad_cell_raises_when_parsed(spark):
    bad = dict(GOOD, demand_quantity="many")
    path = _write_text(",".join(RAW_COLUMNS) + "\n" + _row(bad) + "\n")
    df = read_raw_csv(spark, path)
    assert df.count() == 1  # column pruning: the count parses no cell
    with pytest.raises(Exception):
        df.write.format("noop").mode("overwrite").save()


def test_csv_short_row_raises(spark):
    path = _write_text(",".join(RAW_COLUMNS) + "\n" + "1-1,2024-01-01,2024\n")
    with pytest.raises(Exception):
        read_raw_csv(spark, path).collect()


def test_csv_renamed_header_raises(spark):
    header = ["order_id"] + RAW_COLUMNS[1:]
    path = _write_text(",".join(header) + "\n" + _row(GOOD) + "\n")
    with pytest.raises(Exception):
        read_raw_csv(spark, path).collect()


def test_schema_is_33_nullable_fields():
    assert len(RAW_SCHEMA.fields) == 33 and all(f.nullable for f in RAW_SCHEMA.fields)


def test_constant_target(spark):
    exact = spark.createDataFrame([(5.0, 5.0), (5.0, 5.0)], "actual_demand double, predicted_demand double")
    off = spark.createDataFrame([(5.0, 4.0), (5.0, 5.0)], "actual_demand double, predicted_demand double")
    assert regression_metrics(exact).first()["r2"] == 1.0
    assert regression_metrics(off).first()["r2"] == 0.0


def test_metrics_match_definition(spark):
    y, p = [1.0, 2.0, 4.0, 7.0], [1.5, 2.0, 3.0, 8.0]
    df = spark.createDataFrame(list(zip(y, p)), "actual_demand double, predicted_demand double")
    m = regression_metrics(df, digits=None).first()
    mean = sum(y) / 4
    sse = sum((a - b) ** 2 for a, b in zip(y, p))
    sst = sum((a - mean) ** 2 for a in y)
    assert m["r2"] == pytest.approx(1 - sse / sst)
    assert m["rmse"] == pytest.approx((sse / 4) ** 0.5)
    assert m["mae"] == pytest.approx(sum(abs(a - b) for a, b in zip(y, p)) / 4)


def test_nan_prediction_counted_missing(spark):
    keys = "transaction_date date, product_name string, destination_city string, predicted_demand double"
    df = spark.createDataFrame([(d(1), "p", "c", float("nan")), (d(2), "p", "c", None),
                                (d(3), "p", "c", 1.0)], keys)
    v = C.prediction_check(df).first()
    assert v["missing_predictions"] == 2 and v["rows"] == 3 and v["distinct_keys"] == 3
    with pytest.raises(DataContractError):
        C.require_predictions(df)


VERSIONS = "model_name string, version string, alias string, test_r2 double"
METRICS = "model_version string, n bigint, r2 double, rmse double, mae double"


def test_first_model(spark):
    versions = spark.createDataFrame([("m", "1", "Challenger", 0.3)], VERSIONS)
    metrics = spark.createDataFrame([("1", 10, 0.3, 1.0, 1.0)], METRICS)
    r = decide(metrics, versions, "1").first()
    assert r.decision == "promoted (first model)" and r.champion_r2 is None
    assert r.champion_version == "1"
    after = {x.version: x.alias for x in promote(metrics, versions, "1").collect()}
    assert after == {"1": "Champion"}


def test_tie_keeps_champion(spark):
    versions = spark.createDataFrame([("m", "1", "Champion", 0.5), ("m", "2", "Challenger", 0.5)],
                                     VERSIONS)
    metrics = spark.createDataFrame([("1", 10, 0.5, 1.0, 1.0), ("2", 10, 0.5, 1.0, 1.0)], METRICS)
    r = decide(metrics, versions, "2", min_improvement=0.0).first()
    assert r.decision == "kept champion" and r.champion_version == "1"
    after = {x.version: x.alias for x in promote(metrics, versions, "2", 0.0).collect()}
    assert after == {"1": "Champion", "2": "Challenger"}


def test_better_challenger_promoted(spark):
    versions = spark.createDataFrame([("m", "1", "Champion", 0.5), ("m", "2", "Challenger", 0.6)],
                                     VERSIONS)
    metrics = spark.createDataFrame([("1", 10, 0.5, 1.0, 1.0), ("2", 10, 0.6, 1.0, 1.0)], METRICS)
    r = decide(metrics, versions, "2").first()
    assert (r.decision, r.champion_version, r.champion_r2, r.challenger_r2) == ("promoted", "2", 0.5, 0.6)
    after = {x.version: x.alias for x in promote(metrics, versions, "2").collect()}
    assert after == {"1": None, "2": "Champion"}
    # a required margin above the gain keeps the champion
    assert decide(metrics, versions, "2", min_improvement=0.2).first().decision == "kept champion"


def test_daily_agg_conservation(spark):
    raw = spark.createDataFrame(
        [("a", "2024-01-01", "p", "c", 2.0, 3.0, 1.0), ("b", "2024-01-01", "p", "c", 4.0, 5.0, 2.0),
         ("c", "2024-01-03", "p", "c", 1.0, 1.0, 1.0)],
        "transaction_id string, transaction_date string, product_name string, "
        "destination_city string, demand_quantity double, unit_price_usd double, "
        "available_inventory double")
    silver = parse_dates(raw)
    daily = daily_agg(silver)
    r = daily.filter(F.col("transaction_date") == d(1)).first()
    assert (r.total_demand, r.avg_unit_price, r.total_inventory, r.transaction_count) == (6.0, 4.0, 3.0, 2)
    v = C.require_daily(daily, silver)
    assert v["silver_rows"] == 3 and v["total_transactions"] == 3 and v["rows"] == 2


def test_silver_contract_rejects_invalid_dates_and_duplicates(spark):
    raw = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-02-30")],
                                "transaction_id string, transaction_date string")
    with pytest.raises(DataContractError) as e:
        C.require_silver(parse_dates(raw))
    assert e.value.values["invalid_dates"] == 1
    dup = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("a", dt.date(2024, 1, 2))],
                                "transaction_id string, transaction_date date")
    with pytest.raises(DataContractError):
        C.require_silver(dup)
    assert C.require_silver(dedupe_by_key(dup))["rows"] == 1


def test_plot_limits(spark):
    from daybook.operators.scoring import plot_limits
    df = spark.createDataFrame([(1.0, 3.0), (5.0, -2.0)], "actual_demand double, predicted_demand double")
    r = plot_limits(df).first()
    assert (r.lower, r.upper) == (-2.0, 5.0)


def test_champion_predictions_zero_rows_without_champion(spark):
    from daybook.operators.lifecycle import champion_predictions
    preds = spark.createDataFrame([("1", 1.0), ("2", 2.0)], "model_version string, predicted_demand double")
    versions = spark.createDataFrame([("m", "1", "Challenger", 0.1), ("m", "2", None, 0.2)], VERSIONS)
    assert champion_predictions(preds, versions).count() == 0
    versions = spark.createDataFrame([("m", "1", "Challenger", 0.1), ("m", "2", "Champion", 0.2)], VERSIONS)
    assert [r.model_version for r in champion_predictions(preds, versions).collect()] == ["2"]


def test_shuffle_partitions_from_input_size():
    from daybook.session import shuffle_partitions_for
    assert shuffle_partitions_for(10 << 20) == 200                 # small input: the floor
    assert shuffle_partitions_for(1 << 40) == 4096                 # 1 TiB / 256 MiB
    assert shuffle_partitions_for(100 << 40) == 409_600            # 100 TiB: no cap


def test_daily_measures_one_job_equals_parts(spark):
    raw = spark.createDataFrame(
        [("a", "2024-01-01", "p", "c", 2.0, 3.0, 1.0), ("b", "2024-01-01", "p", "c", 4.0, 5.0, 2.0),
         ("c", "2024-01-03", "p", "c", 1.0, 1.0, 1.0)],
        "transaction_id string, transaction_date string, product_name string, "
        "destination_city string, demand_quantity double, unit_price_usd double, "
        "available_inventory double")
    silver = parse_dates(raw)
    daily = daily_agg(silver)
    one = C.daily_measures(daily, silver).first().asDict()
    parts = C.grain_check(daily).first().asDict() | C.conservation_check(silver, daily).first().asDict()
    assert one == parts == {"rows": 2, "distinct_keys": 2, "total_transactions": 3, "silver_rows": 3}


def test_declared_key_travels_with_the_table(spark):
    feats = C.declare_key(build_features(daily_rows(spark, [(1, "p", "c", 1), (3, "p", "c", 2)])))
    path = os.path.join(tempfile.mkdtemp(prefix="daybook-key-"), "features")
    feats.write.parquet(path)
    back = read_table(spark, path)
    assert C.declared_key(back) == ["transaction_date", "product_name", "destination_city"]
    assert C.require_key(back)["rows"] == 3
    with pytest.raises(DataContractError):
        C.require_key(back, ["product_name", "transaction_date", "destination_city"])


def test_gap_filling_keeps_rows_without_a_date(spark):
    daily = spark.createDataFrame(
        [(dt.date(2023, 1, 1), "A", "X", 2.0, 1.0, 1.0, 1), (dt.date(2023, 1, 3), "A", "X", 3.0, 1.0, 1.0, 1),
         (None, "A", "X", 5.0, 1.0, 1.0, 2)],
        "transaction_date date, product_name string, destination_city string, total_demand double, "
        "avg_unit_price double, total_inventory double, transaction_count bigint")
    one, other = gapfill_days(daily), gapfill_days_join(daily)
    assert one.count() == 4 and one.agg(F.sum("total_demand")).first()[0] == 10.0
    assert one.exceptAll(other.select(*one.columns)).isEmpty()
    features = build_features(daily)
    assert C.feature_check(features).first()["null_keys"] == 1
    with pytest.raises(DataContractError):
        C.require_features(features, daily=daily)
    dated = daily.filter("transaction_date is not null")
    with pytest.raises(DataContractError, match="conserved"):
        C.require_features(build_features(dated), daily=dated.unionByName(dated))
