"""The operators are generic over column names: the same code builds daily
series of the events table (per event type), checked against pandas."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from daybook.operators.aggregate import daily_agg
from daybook.operators.contracts import grain_check
from daybook.operators.timeseries import build_features


def test_events_daily_series(spark, sf_small):
    events = spark.read.parquet(f"{sf_small}/events.parquet").withColumn(
        "day", F.to_date("ts"))
    measures = {"total_value": ("sum", "value"), "n": ("count", None)}
    daily = daily_agg(events, keys=["day", "event_type"], measures=measures)
    feats = build_features(daily, series_keys=["event_type"], date_col="day",
                           target="total_value", zero_filled=["total_value", "n"])
    got = feats.toPandas().sort_values(["event_type", "day"]).reset_index(drop=True)
    assert grain_check(feats, ["day", "event_type"]).first()["distinct_keys"] == len(got)

    pdf = pd.read_parquet(f"{sf_small}/events.parquet")
    pdf["day"] = pdf["ts"].dt.date
    rows = []
    for etype, g in pdf.groupby("event_type"):
        per_day = g.groupby("day")["value"].sum()
        days = pd.date_range(min(per_day.index), max(per_day.index), freq="D").date
        vals = [float(per_day.get(d, 0.0)) for d in days]
        for i, d in enumerate(days):
            window = vals[max(0, i - 7):i]
            rows.append((etype, d, vals[i], vals[i - 1] if i else None,
                         vals[i - 7] if i >= 7 else None,
                         sum(window) / len(window) if window else None))
    exp = pd.DataFrame(rows, columns=["event_type", "day", "total_value", "demand_1",
                                      "demand_7", "rolling_7_day_avg"])
    assert len(exp) == len(got)
    for col in ["total_value", "demand_1", "demand_7", "rolling_7_day_avg"]:
        a = got[col].astype(float).fillna(-1e18).to_numpy()
        b = exp[col].astype(float).fillna(-1e18).to_numpy()
        assert abs(a - b).max() < 1e-6, col
    assert list(got["event_type"]) == list(exp["event_type"])
