"""The staged CSV's joins hash or broadcast a side that was measured as small."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from daybook import session
from daybook.plans import catalog
from daybook.plans.stages import Stages
from daybook.session import ADAPTIVE_BROADCAST_CONF, BROADCAST_CONF, LOCAL_MAP_CONF, MEASURED_SIDE, measured_joins
from daybook.sources.files import read_raw_csv, write_csv


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def conf(spark):
    """Sets values of the session for one test."""
    keys = (BROADCAST_CONF, ADAPTIVE_BROADCAST_CONF, LOCAL_MAP_CONF)
    yield lambda key, value: spark.conf.set(key, value)
    for key in keys:
        spark.conf.unset(key)


def test_staged_csv_joins_without_sorts(spark, sf_small, conf, monkeypatch):
    conf(BROADCAST_CONF, "-1")
    plans = []

    def spy(df, *args):
        plans.append(_plan(df))
        return write_csv(df, *args)

    monkeypatch.setattr(catalog, "write_csv", spy)
    s = Stages(spark, sf_small)
    staged = read_raw_csv(spark, catalog._csv_source(s))
    catalog._csv_with_bad_cells(s)
    assert len(plans) == 2 and all("ShuffledHashJoin" in p and "SortMergeJoin" not in p for p in plans)
    assert spark.conf.get(ADAPTIVE_BROADCAST_CONF, None) is None  # broadcasts stay off
    assert "SortMergeJoin" in _plan(Stages(spark, sf_small).raw)  # outside, nothing has changed
    assert staged.exceptAll(s.raw).isEmpty() and s.raw.exceptAll(staged).isEmpty()


def test_measured_side_is_broadcast_below_the_limit_only(spark, conf, monkeypatch):
    side = spark.range(800_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
    total = spark.range(3_000_000).select((F.col("id") % 900_000).alias("k"), "id").join(side, "k").agg(
        F.count(F.lit(1)), F.sum(F.length("name") + F.col("id")))
    plans, rows = [], set()
    for limit in (None, MEASURED_SIDE, "1k"):
        df = total.select("*")  # a plan of its own
        if limit is None:
            plans.append(_plan(df))
        else:
            monkeypatch.setattr(session, "MEASURED_SIDE", limit)
            with measured_joins(spark):
                plans.append(_plan(df))
        rows.add(tuple(df.first()))
    assert [("BroadcastHashJoin" in p, "SortMergeJoin" in p) for p in plans] == [
        (False, True), (True, False), (False, True)]
    assert len(rows) == 1


def test_settings_come_back_and_given_ones_stay(spark, conf):
    with pytest.raises(ZeroDivisionError), measured_joins(spark):
        assert spark.conf.get(LOCAL_MAP_CONF) == spark.conf.get(ADAPTIVE_BROADCAST_CONF) == MEASURED_SIDE
        1 / 0
    assert spark.conf.get(LOCAL_MAP_CONF) == "0b" and spark.conf.get(ADAPTIVE_BROADCAST_CONF, None) is None
    conf(LOCAL_MAP_CONF, "5m")
    conf(ADAPTIVE_BROADCAST_CONF, "7m")
    with measured_joins(spark):
        assert (spark.conf.get(LOCAL_MAP_CONF), spark.conf.get(ADAPTIVE_BROADCAST_CONF)) == ("5m", "7m")
    assert (spark.conf.get(LOCAL_MAP_CONF), spark.conf.get(ADAPTIVE_BROADCAST_CONF)) == ("5m", "7m")
