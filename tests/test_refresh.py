"""Refresh of changed series against a full rebuild; long gaps; malformed rows kept apart."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from daybook.config import RAW_COLUMNS
from daybook.errors import DataContractError
from daybook.operators import refresh as R
from daybook.operators.timeseries import build_features, date_spine, gapfill_days, gapfill_days_join
from daybook.plans.pipeline import layer_paths, run_bronze, run_silver
from daybook.sources.files import REJECT_COL, ingest_parted, read_raw_csv, read_table
from daybook.sources.versions import versions

DAILY = ("transaction_date date, product_name string, destination_city string, total_demand double, "
         "avg_unit_price double, total_inventory double, transaction_count bigint")


def folder(name="t"):
    return os.path.join(tempfile.mkdtemp(prefix="daybook-refresh-"), name)


def daily(spark, rows):
    return spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(n) if n is not None else None,
                                   p, c, v, 1.0, None, 1) for n, p, c, v in rows], DAILY)


def rows_of(df):
    return sorted(map(str, df.collect()))


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


BASE = [(n, f"p{p}", c, float(n * p)) for p in range(12) for c in ("x", None) for n in range(0, 9, 2)]


def test_refresh_equals_rebuild_and_leaves_other_partitions(spark):
    t = folder()
    first = R.refresh_features(daily(spark, BASE), t, buckets=16)
    assert first["new"] == 24 and first["changed"] == first["deleted"] == 0
    assert rows_of(R.read_features(spark, t)) == rows_of(build_features(daily(spark, BASE)))
    before = files(os.path.join(t, "rows"))

    late = [*BASE, (3, "p3", "x", 7.0)]                                # a late day
    late = [r for r in late if r[:3] != (8, "p4", None)]               # a deleted row, NULL in the key
    late = [r for r in late if r[1] != "p5"]                           # deleted series
    late += [(0, "new", "x", 1.0), (5, "new", "x", 2.0), (None, "p6", "x", 1.0)]
    out = R.refresh_features(daily(spark, late).repartition(5), t, buckets=99)
    assert out["buckets"] == 16 and (out["changed"], out["new"], out["deleted"]) == (3, 1, 2)
    assert rows_of(R.read_features(spark, t)) == rows_of(build_features(daily(spark, late)))
    after = files(os.path.join(t, "rows"))
    touched = tuple(f"bucket={b}/" for b in out["replaced"])
    assert {f for f in before if not any(x in f for x in touched)} <= after
    assert not any(any(x in f for x in touched) for f in before & after)

    again = R.refresh_features(daily(spark, late), t)
    assert again["replaced"] == [] and files(os.path.join(t, "rows")) == after
    other = R.refresh_features(daily(spark, late), t, recipe="two")    # features made otherwise
    assert other["changed"] == 23
    assert R.refresh_features(daily(spark, []), t, recipe="two")["deleted"] == 23
    assert R.read_features(spark, t).count() == 0
    assert R.read_features(spark, t).columns == build_features(daily(spark, [])).columns


def test_prints_tell_nulls_places_and_repeats_apart(spark):
    s = "product_name string, destination_city string, a int, b int"
    def prints(*rows):
        return R.series_prints(spark.createDataFrame([("p", "c", *r) for r in rows], s)).collect()
    states = [[(None, 5)], [(5, None)], [(5, 5)], [(5, 5)] * 2, [(5, 5)] * 3, [(None, None)], [(1, 2), (3, 4)],
              [(1, 4), (3, 2)]]
    seen = [str(prints(*x)) for x in states]
    assert len(set(seen)) == len(seen)
    assert prints((1, 2), (3, 4)) == prints((3, 4), (1, 2))


@pytest.mark.parametrize("end_at", ["check", "replace"])
def test_next_refresh_makes_good_one_that_ended(spark, monkeypatch, end_at):
    t = folder()
    R.refresh_features(daily(spark, BASE), t, buckets=4)
    changed = [(n, p, c, v + 1) if p in ("p1", "p2", "p3") else (n, p, c, v) for n, p, c, v in BASE]
    done = []

    def stop(*a):
        if end_at == "check" or done:
            raise KeyboardInterrupt
        done.append(1)
        real(*a)
    real = R._replace
    with monkeypatch.context() as m:
        if end_at == "replace":
            m.setattr(R, "_replace", stop)
        with pytest.raises(KeyboardInterrupt):
            R.refresh_features(daily(spark, changed), t, check=stop if end_at == "check" else None)
    if end_at == "check":
        assert rows_of(R.read_features(spark, t)) == rows_of(build_features(daily(spark, BASE)))
    # the daily table goes back to its former state: the touched partitions still count as changed
    R.refresh_features(daily(spark, BASE), t)
    assert rows_of(R.read_features(spark, t)) == rows_of(build_features(daily(spark, BASE)))


def test_long_gap_spreads_over_tasks(spark):
    far = spark.createDataFrame(
        [(dt.date(100, 1, 1), "p", "c", 1.0, 1.0, 1.0, 1), (dt.date(2016, 7, 20), "p", "c", 2.0, 1.0, 1.0, 1)],
        DAILY)
    days = (dt.date(2016, 7, 20) - dt.date(100, 1, 1)).days + 1
    assert days > 700_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep the small test's tasks apart
    try:
        filled = gapfill_days(far, spread=True)
        per_task = [r["count"] for r in filled.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(per_task) == days and len(per_task) >= 4 and max(per_task) < days / 2
    assert filled.agg(F.countDistinct("transaction_date"), F.sum("total_demand")).first()[:] == (days, 3.0)


def test_span_borders_match_the_join(spark):
    rows = [(0, "a", "x", 1.0), (1023, "a", "x", 1.0), (2048, "a", "x", 1.0), (0, "b", "x", 1.0),
            (1024, "b", "x", 2.0), (5, "c", None, 1.0), (None, "c", None, 9.0), (0, "d", "x", 1.0),
            (1025, "d", "x", 1.0)]
    df = daily(spark, rows)
    named = df.filter("destination_city is not null")
    assert rows_of(gapfill_days(named)) == rows_of(gapfill_days_join(named).select(*df.columns))
    assert rows_of(gapfill_days(df)) == rows_of(gapfill_days(df, spread=True))
    assert rows_of(date_spine(df)) == rows_of(date_spine(df, spread=True))
    assert date_spine(df).filter("product_name = 'b'").count() == 1025
    assert gapfill_days(df).filter("transaction_date is null").count() == 1


def raw_csv(lines):
    path = os.path.join(tempfile.mkdtemp(prefix="daybook-csv-"), "raw.csv")
    with open(path, "w") as f:
        f.write("\n".join([",".join(RAW_COLUMNS), *lines]) + "\n")
    return path


def cells(i, **other):
    held = {"transaction_id": f"t{i}", "transaction_date": "2024-01-05", "ordered_quantity": "2.5", **other}
    return ",".join(str(held.get(c, "")) for c in RAW_COLUMNS)


def test_malformed_rows_are_kept_apart(spark):
    bad = [cells(90, ordered_quantity="n/a"), cells(91, delay_days="1.5"), cells(92) + ",extra", "t93,2024-01-05"]
    source = raw_csv([cells(1), *bad, cells(2), cells(1)])
    good, rejects = folder("good"), folder("rejects")
    n = ingest_parted(spark, source, good, rejects, max_share=0.6)
    assert n == {"source_rows": 7, "good_rows": 3, "malformed_rows": 4}
    stored = read_table(spark, good)
    assert stored.columns == [*RAW_COLUMNS, REJECT_COL]
    assert sorted(r.transaction_id for r in stored.collect()) == ["t1", "t1", "t2"]
    found = [r[REJECT_COL] for r in read_table(spark, rejects).collect()]
    assert sorted(r.text for r in found) == sorted(bad)
    assert all(r.file.endswith("raw.csv") for r in found)
    with pytest.raises(DataContractError):  # over the threshold: both tables keep their versions
        ingest_parted(spark, source, good, rejects, max_share=0.5)
    assert versions(spark, good) == versions(spark, rejects) == [1]
    with pytest.raises(Exception):          # the default still stops at the first one
        read_raw_csv(spark, source).collect()
    ingest_parted(spark, raw_csv([cells(5)]), good, rejects)  # no malformed row: an empty version
    assert read_table(spark, rejects).count() == 0 and read_table(spark, good).count() == 1
    ingest_parted(spark, raw_csv([]), good, rejects)
    assert read_table(spark, good).count() == 0


def test_bronze_and_silver_with_malformed_rows(spark):
    source = raw_csv([cells(1), cells(2, ordered_quantity="?"), cells(3), cells(3)])
    paths, m = layer_paths(folder()), {}
    with pytest.raises(Exception):
        run_bronze(spark, source, paths, m)
    run_bronze(spark, source, paths, m, max_malformed=0.25)
    assert m["bronze"] == {"source_rows": 4, "good_rows": 3, "malformed_rows": 1, "table_rows": 3}
    assert m["duplicates"]["duplicate_rows"] == 1
    run_silver(spark, paths, m)
    silver = read_table(spark, paths["silver"])
    assert silver.count() == 2 and REJECT_COL not in silver.columns
