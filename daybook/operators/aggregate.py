"""Group aggregates: the daily table, series extents, the date range."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.config import DAILY_MEASURES, DATE_COL, KEY_COLUMNS, SERIES_KEYS
from daybook.functions.exact import exact_avg, exact_sum


def _measure(name: str, fn: str, col: str | None) -> F.Column:
    if fn == "count":
        return F.count(F.lit(1)).alias(name)
    # sums and means that don't depend on the order of the rows
    order_free = {"sum": exact_sum, "avg": exact_avg}
    return order_free.get(fn, getattr(F, fn))(F.col(col)).alias(name)


def daily_agg(df: DataFrame, keys: Sequence[str] = KEY_COLUMNS,
              measures: Mapping[str, tuple[str, str | None]] = DAILY_MEASURES) -> DataFrame:
    """One row per (day, series): sums, average, row count.

    All measures have fixed-width buffers, so this is a hash aggregate with a
    partial (map-side) step: a hot day/series is combined inside each map
    task before the shuffle on the keys.
    """
    return df.groupBy(*keys).agg(*[_measure(n, fn, c) for n, (fn, c) in measures.items()])


def series_extent(df: DataFrame, series_keys: Sequence[str] = SERIES_KEYS,
                  date_col: str = DATE_COL) -> DataFrame:
    """First and last day of every series (its own extent, not a global one)."""
    return df.groupBy(*series_keys).agg(
        F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date")
    )


def date_range(df: DataFrame, date_col: str = DATE_COL) -> DataFrame:
    """One row: earliest and latest date of the table."""
    return df.agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"))
