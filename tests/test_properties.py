"""Property tests (small, hypothesis): gap filling and features against a
direct Python statement of the same rules."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daybook.operators.timeseries import build_features, gapfill_days, gapfill_days_join

SCHEMA = ("transaction_date date, product_name string, destination_city string, "
          "total_demand double, avg_unit_price double, total_inventory double, "
          "transaction_count bigint")
BASE = dt.date(2024, 1, 1)

series_days = st.dictionaries(
    keys=st.tuples(st.sampled_from(["p1", "p2"]), st.sampled_from(["c1", "c2"])),
    values=st.dictionaries(st.integers(0, 40), st.integers(1, 9), min_size=1, max_size=8),
    min_size=1, max_size=3,
)


def _frame(spark, data):
    rows = [(BASE + dt.timedelta(days=day), p, c, float(v), float(v), float(v), 1)
            for (p, c), days in data.items() for day, v in days.items()]
    return spark.createDataFrame(rows, SCHEMA)


def _expected(data):
    """Per series: dense daily demand from first to last day."""
    out = {}
    for key, days in data.items():
        lo, hi = min(days), max(days)
        out[key] = [float(days.get(i, 0)) for i in range(lo, hi + 1)], lo
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(series_days)
def test_gapfill_and_features(spark, data):
    daily = _frame(spark, data)
    filled = gapfill_days(daily)
    joined = gapfill_days_join(daily)
    a = sorted(map(tuple, filled.collect()))
    b = sorted(map(tuple, joined.select(*filled.columns).collect()))
    assert a == b  # join-free and join forms agree

    exp = _expected(data)
    assert len(a) == sum(len(v) for v, _ in exp.values())
    assert sum(r[3] for r in a) == sum(sum(v) for v, _ in exp.values())  # demand kept

    feats = build_features(daily).collect()
    by_key = {}
    for r in feats:
        by_key.setdefault((r.product_name, r.destination_city), []).append(r)
    for key, (values, lo) in exp.items():
        rows = sorted(by_key[key], key=lambda r: r.transaction_date)
        days = [(r.transaction_date - BASE).days for r in rows]
        assert days == list(range(lo, lo + len(values)))  # no gaps
        for i, r in enumerate(rows):
            assert r.total_demand == values[i]
            assert r.demand_1 == (values[i - 1] if i >= 1 else None)
            assert r.demand_7 == (values[i - 7] if i >= 7 else None)
            window = values[max(0, i - 7):i]
            if window:
                assert abs(r.rolling_7_day_avg - sum(window) / len(window)) < 1e-12
            else:
                assert r.rolling_7_day_avg is None


def _none_first(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]),
                          st.one_of(st.none(), st.integers(0, 3)),
                          st.sampled_from(["x", "y", None])), min_size=1, max_size=30),
       st.integers(1, 4))
def test_dedupe_matches_brute_force(spark, rows, parts):
    from daybook.operators.clean import dedupe_by_key
    df = spark.createDataFrame(rows, "k string, v int, w string").repartition(parts)
    got = sorted(map(tuple, dedupe_by_key(df, "k").collect()), key=_none_first)
    best = {}
    for r in rows:
        if r[0] not in best or _none_first(r[1:]) < _none_first(best[r[0]][1:]):
            best[r[0]] = r
    assert got == sorted(best.values(), key=_none_first)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 50)), min_size=1, max_size=40))
def test_metrics_match_brute_force(spark, pairs):
    from daybook.functions.metrics import regression_metrics
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs],
                               "actual_demand double, predicted_demand double")
    m = regression_metrics(df, digits=None).first()
    y = [float(a) for a, _ in pairs]
    p = [float(b) for _, b in pairs]
    n = len(y)
    mean = sum(y) / n
    sse = sum((a - b) ** 2 for a, b in zip(y, p))
    sst = sum((a - mean) ** 2 for a in y)
    r2 = (1.0 if sse == 0 else 0.0) if sst == 0 else 1 - sse / sst
    assert m["n"] == n
    assert abs(m["r2"] - r2) < 1e-9 * max(1.0, abs(r2))
    assert abs(m["rmse"] - (sse / n) ** 0.5) < 1e-9
    assert abs(m["mae"] - sum(abs(a - b) for a, b in zip(y, p)) / n) < 1e-9
