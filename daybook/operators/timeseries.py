"""Daily series: date spine, gap filling, lag / rolling / calendar features.

A series is one (product, city) pair. After the daily aggregate a series
has at most one row per calendar day, so the per-series windows below see
at most (last day - first day + 1) rows however large the raw input is: a
hot series costs days, not transactions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from daybook.config import DATE_COL, SERIES_KEYS, TARGET_COL, ZERO_FILLED
from daybook.operators.aggregate import series_extent

DEFAULT_LAGS = {"demand_1": 1, "demand_7": 7}
DEFAULT_ROLLING = {"rolling_7_day_avg": (-7, -1)}
#: Days that one array holds at most; longer stretches are cut into spans first.
SPAN_DAYS = 1024


def explode_days(df: DataFrame, first: str, last: str, day: str,
                 spread_by: Sequence[str] | None = None, span_days: int = SPAN_DAYS) -> DataFrame:
    """Every row once for each day from column ``first`` to ``last``, as column ``day``.

    Two levels: the stretch is cut into spans of ``span_days``, then each span
    into its days, so one wrong year makes no array of hundreds of thousands of
    days. With ``spread_by`` (columns) the spans are shuffled between the levels,
    by these columns and the span, so the days of one long gap are made by
    several tasks. A row without a first day is kept, with a NULL day.
    """
    spans = F.sequence(F.lit(0), F.floor(F.datediff(last, first) / span_days).cast("int"))
    out = df.select("*", F.explode_outer(spans).alias("_span"))
    if spread_by is not None:
        out = out.repartition(*spread_by, first, "_span")
    begin = F.date_add(F.col(first), F.col("_span") * span_days)
    end = F.least(F.date_add(begin, span_days - 1), F.col(last))
    return out.select("*", F.explode_outer(F.sequence(begin, end)).alias(day)).drop("_span")


def date_spine(daily: DataFrame, series_keys: Sequence[str] = SERIES_KEYS,
               date_col: str = DATE_COL, spread: bool = False) -> DataFrame:
    """Every calendar day from each series' first to its last day. ``spread``:
    long series are dealt over several tasks (one more shuffle, of spans)."""
    extent = series_extent(daily, series_keys, date_col).filter(F.col("first_date").isNotNull())
    return explode_days(extent, "first_date", "last_date", date_col,
                        series_keys if spread else None).drop("first_date", "last_date")


def _zero(df: DataFrame, col: str) -> F.Column:
    """NULL → 0; on floating columns NaN → 0 as well (as ``fillna`` does)."""
    c = F.col(col)
    if isinstance(df.schema[col].dataType, (DoubleType, FloatType)):
        c = F.nanvl(c, F.lit(None))
    return F.coalesce(c, F.lit(0))


def gapfill_days_join(daily: DataFrame, series_keys: Sequence[str] = SERIES_KEYS,
                      date_col: str = DATE_COL,
                      zero_filled: Sequence[str] = ZERO_FILLED) -> DataFrame:
    """Gap filling as spine ⟕ daily aggregate. Kept to cross-check
    :func:`gapfill_days`; it needs a join and more exchanges. Rows without a
    date belong to no day of the spine and are kept as they are."""
    keys = [date_col, *series_keys]
    spine = date_spine(daily, series_keys, date_col)
    joined = spine.join(daily, keys, "left")
    joined = joined.unionByName(daily.filter(F.col(date_col).isNull()).select(*joined.columns))
    return joined.select(
        *[(_zero(daily, c).cast(daily.schema[c].dataType).alias(c) if c in zero_filled else F.col(c))
          for c in joined.columns]
    )


def gapfill_days(daily: DataFrame, series_keys: Sequence[str] = SERIES_KEYS,
                 date_col: str = DATE_COL,
                 zero_filled: Sequence[str] = ZERO_FILLED, spread: bool = False) -> DataFrame:
    """Add a row for every missing day of each series, without a join.

    Each observed day is exploded into itself plus the missing days up to
    the next observed day of the series (``lead``). On filled days the
    ``zero_filled`` measures are 0 and the others NULL; on observed days
    NULL (and NaN) in ``zero_filled`` measures becomes 0. A row without a
    date is kept, for the feature contract to count and reject. One shuffle on
    the series keys; the feature windows that follow reuse it. ``spread``: the
    spans of long gaps are dealt over several tasks by a second shuffle, for
    filled tables that are stored without the windows.
    """
    keys = [date_col, *series_keys]
    measures = [c for c in daily.columns if c not in keys]
    w = Window.partitionBy(*series_keys).orderBy(date_col)
    # greatest(): a repeated day (non-unique input) must not run backwards
    last = F.greatest(F.col(date_col),
                      F.coalesce(F.date_sub(F.lead(date_col).over(w), 1), F.col(date_col)))
    exploded = explode_days(daily.select("*", last.alias("_last")), date_col, "_last", "_day",
                            series_keys if spread else None)
    observed = F.col("_day").eqNullSafe(F.col(date_col))
    out = [F.col("_day").alias(date_col), *[F.col(k) for k in series_keys]]
    for m in measures:
        dtype = daily.schema[m].dataType
        if m in zero_filled:
            out.append(F.when(observed, _zero(daily, m)).otherwise(F.lit(0)).cast(dtype).alias(m))
        else:
            out.append(F.when(observed, F.col(m)).alias(m))
    return exploded.select(*out)


def add_features(df: DataFrame, series_keys: Sequence[str] = SERIES_KEYS,
                 date_col: str = DATE_COL, target: str = TARGET_COL,
                 lags: Mapping[str, int] = DEFAULT_LAGS,
                 rolling: Mapping[str, tuple[int, int]] = DEFAULT_ROLLING,
                 calendar: bool = True) -> DataFrame:
    """Lags and rolling means of ``target`` (row-based: one row is one day
    because gaps are filled first), then month and day of week
    (Sunday = 1 … Saturday = 7). All window columns share one window spec,
    so Catalyst plans a single Window node over one sort."""
    w = Window.partitionBy(*series_keys).orderBy(date_col)
    cols = [F.col(c) for c in df.columns]
    cols += [F.lag(target, n).over(w).alias(name) for name, n in lags.items()]
    cols += [F.avg(target).over(w.rowsBetween(lo, hi)).alias(name)
             for name, (lo, hi) in rolling.items()]
    if calendar:
        cols += [F.month(date_col).alias("month"), F.dayofweek(date_col).alias("day_of_week")]
    return df.select(*cols)


def lag_features(df: DataFrame, **kw) -> DataFrame:
    return add_features(df, rolling={}, calendar=False, **kw)


def rolling_mean(df: DataFrame, **kw) -> DataFrame:
    return add_features(df, lags={}, calendar=False, **kw)


def calendar_features(df: DataFrame, date_col: str = DATE_COL) -> DataFrame:
    return df.select("*", F.month(date_col).alias("month"),
                     F.dayofweek(date_col).alias("day_of_week"))


def build_features(daily: DataFrame, series_keys: Sequence[str] = SERIES_KEYS,
                   date_col: str = DATE_COL, target: str = TARGET_COL,
                   zero_filled: Sequence[str] = ZERO_FILLED) -> DataFrame:
    """Daily aggregate → gap-filled days → features (the feature table)."""
    filled = gapfill_days(daily, series_keys, date_col, zero_filled)
    return add_features(filled, series_keys, date_col, target)
