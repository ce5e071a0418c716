"""Data contracts: each is a one-row DataFrame of measured values (so it can
be compared with an independent query) plus a ``require_*`` wrapper that
fetches that one row and raises :class:`DataContractError`.

Uniqueness is measured with a key pre-grouping (``groupBy(keys).count()``,
then a global aggregate): one shuffle, partial aggregation on both steps,
and NULL keys count as one value, as ``distinct`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from daybook.config import (
    DATE_COL,
    DATE_FORMAT,
    ID_COL,
    KEY_COLUMNS,
    NUMERIC_FEATURES,
    TARGET_COL,
)
from daybook.errors import DataContractError
from daybook.functions.exact import exact_sum
from daybook.functions.metrics import missing_count
from daybook.operators.clean import parse_date_col

LAG_COLUMNS = ["demand_1", "demand_7", "rolling_7_day_avg"]
CALENDAR_COLUMNS = ["month", "day_of_week"]


def _any_null(cols: Sequence[str]) -> F.Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def key_grouping(df: DataFrame, keys: Sequence[str], **extra: F.Column) -> DataFrame:
    """Rows per key (``_n``) plus optional per-key sums, one row per key."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.sum(e).alias(k) for k, e in extra.items()]
    return df.groupBy(*keys).agg(*aggs)


def grain_check(df: DataFrame, keys: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """rows, distinct_keys."""
    return key_grouping(df, keys).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
    )


def silver_measures(silver: DataFrame, key: str = ID_COL, date_col: str = DATE_COL) -> DataFrame:
    """rows, distinct_ids, date_type (the stored type name of the date) and
    invalid_dates (NULL dates), all from one key pre-grouping."""
    date_type = silver.schema[date_col].dataType.simpleString()
    g = key_grouping(silver, [key], _bad=F.when(F.col(date_col).isNull(), 1).otherwise(0))
    return g.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("distinct_ids"),
        F.coalesce(F.sum("_bad"), F.lit(0)).cast("bigint").alias("invalid_dates"),
    ).select("rows", "distinct_ids", F.lit(date_type).alias("date_type"), "invalid_dates")


def silver_check(silver: DataFrame, key: str = ID_COL, date_col: str = DATE_COL) -> DataFrame:
    """rows, distinct_ids, date_type."""
    return silver_measures(silver, key, date_col).select("rows", "distinct_ids", "date_type")


def conservation_check(silver: DataFrame, daily: DataFrame,
                       count_col: str = "transaction_count") -> DataFrame:
    """silver_rows and Σ transaction_count of the daily table, in one job:
    both inputs are unioned as (1, NULL) / (NULL, count) and summed. Empty
    input sums to 0, not NULL."""
    parts = silver.select(F.lit(1).cast("bigint").alias("s"), F.lit(None).cast("bigint").alias("t"))
    parts = parts.unionByName(
        daily.select(F.lit(None).cast("bigint").alias("s"), F.col(count_col).cast("bigint").alias("t")))
    return parts.agg(F.coalesce(F.sum("s"), F.lit(0)).cast("bigint").alias("silver_rows"),
                     F.coalesce(F.sum("t"), F.lit(0)).cast("bigint").alias("total_transactions"))


def ingest_rowcount(source_rows: int, table: DataFrame) -> DataFrame:
    """source_rows (measured while writing) and the rows of the stored table."""
    return table.agg(F.count(F.lit(1)).alias("table_rows")).select(
        F.lit(int(source_rows)).cast("bigint").alias("source_rows"), "table_rows")


def duplicate_summary(df: DataFrame) -> DataFrame:
    """total_rows, distinct_rows, duplicate_rows over whole rows. A grouping
    on every column with map-side combine: a row repeated a million times
    leaves each map task as one row with its count."""
    return key_grouping(df, df.columns).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).select("total_rows", "distinct_rows",
             (F.col("total_rows") - F.col("distinct_rows")).alias("duplicate_rows"))


def invalid_date_count(df: DataFrame, col: str = DATE_COL, fmt: str = DATE_FORMAT) -> DataFrame:
    """rows whose date text does not parse (NULL input included)."""
    return df.agg(F.count_if(parse_date_col(col, fmt).isNull()).alias("invalid_dates"))


def key_null_count(df: DataFrame, keys: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    return df.agg(F.count_if(_any_null(keys)).alias("null_keys"))


def missing_columns(df: DataFrame, required: Sequence[str] = (*NUMERIC_FEATURES,)) -> list[str]:
    return [c for c in required if c not in df.columns]


def missing_columns_frame(df: DataFrame, required: Sequence[str] = (*NUMERIC_FEATURES,)) -> DataFrame:
    """One row: rows of the table and how many required columns it lacks."""
    n_missing = len(missing_columns(df, required))
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(n_missing).cast("int").alias("missing_columns"))


def _plain(df: DataFrame, col: str) -> F.Column:
    """The column; NaN counts as NULL, as gap filling reads it."""
    c = F.col(col)
    return F.nanvl(c, F.lit(None)) if isinstance(df.schema[col].dataType, (DoubleType, FloatType)) else c


def feature_measures(df: DataFrame, keys: Sequence[str] = KEY_COLUMNS,
                     required: Sequence[str] = (*NUMERIC_FEATURES,),
                     calendar: Sequence[str] = CALENDAR_COLUMNS, target: str = TARGET_COL,
                     count_col: str = "transaction_count") -> DataFrame:
    """rows, distinct_keys, null_keys, null_calendar, missing_columns, Σ of
    the target, Σ of the transaction count and
    NULLs per key column, in one pass (per-key counts first, then a global
    sum): the feature contract and the key contract together."""
    n_missing = len(missing_columns(df, required))
    cal = [c for c in calendar if c in df.columns]
    extra = {"_cal": F.when(_any_null(cal), 1).otherwise(0)} if cal else {}
    for name, c in (("_y", target), ("_c", count_col)):
        extra[name] = _plain(df, c) if c in df.columns else F.lit(0)
    g = key_grouping(df, keys, **extra)
    null_cal = F.coalesce(F.sum("_cal"), F.lit(0)) if cal else F.lit(0)
    return g.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(_any_null(keys), F.col("_n"))), F.lit(0)).cast("bigint").alias("null_keys"),
        null_cal.cast("bigint").alias("null_calendar"),
        *[F.coalesce(F.sum(F.when(F.col(k).isNull(), F.col("_n"))), F.lit(0)).cast("bigint")
          .alias(f"null_{k}") for k in keys],
        F.coalesce(exact_sum(F.col("_y")), F.lit(0.0)).alias("total_demand"),
        F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("total_transactions"),
    ).select("*", F.lit(n_missing).cast("int").alias("missing_columns"))


def feature_check(df: DataFrame, keys: Sequence[str] = KEY_COLUMNS,
                  required: Sequence[str] = (*NUMERIC_FEATURES,),
                  calendar: Sequence[str] = CALENDAR_COLUMNS) -> DataFrame:
    """rows, distinct_keys, null_keys, null_calendar, missing_columns,
    total_demand, total_transactions."""
    return feature_measures(df, keys, required, calendar).select(
        "rows", "distinct_keys", "null_keys", "null_calendar", "missing_columns",
        "total_demand", "total_transactions")


def feature_null_summary(df: DataFrame, cols: Sequence[str] = LAG_COLUMNS) -> DataFrame:
    """NULLs per lag / rolling column (expected: the first days of each series)."""
    return df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in cols])


KEY_METADATA = "key_position"


def declare_key(df: DataFrame, keys: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Record the primary key in the column metadata (position 0, 1, …). The
    metadata is stored with the table's schema and comes back on read, so
    the declared key travels with the dataset (the re-aimed form of a
    catalog PRIMARY KEY constraint, which path-based tables lack)."""
    pos = {k: i for i, k in enumerate(keys)}
    return df.select(*[F.col(c).alias(c, metadata={KEY_METADATA: pos[c]}) if c in pos else F.col(c)
                       for c in df.columns])


def declared_key(df: DataFrame) -> list[str]:
    """The key recorded by :func:`declare_key`, in order (empty if none)."""
    marked = [(f.metadata[KEY_METADATA], f.name) for f in df.schema.fields
              if KEY_METADATA in (f.metadata or {})]
    return [name for _, name in sorted(marked)]


def key_contract(df: DataFrame, keys: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """The declared key (in order), rows, distinct keys and NULLs per key
    column: the measured form of NOT NULL + PRIMARY KEY."""
    g = key_grouping(df, keys)
    return g.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        *[F.coalesce(F.sum(F.when(F.col(k).isNull(), F.col("_n"))), F.lit(0)).cast("bigint")
          .alias(f"null_{k}") for k in keys],
    ).select(F.lit(",".join(declared_key(df)) or None).alias("key_columns"), "*")


def prediction_check(preds: DataFrame, keys: Sequence[str] = KEY_COLUMNS,
                     prediction: str = "predicted_demand") -> DataFrame:
    """rows, missing_predictions (NULL or NaN), distinct_keys."""
    g = key_grouping(preds, keys, _miss=F.when(F.col(prediction).isNull()
                                               | F.isnan(F.col(prediction)), 1).otherwise(0))
    return g.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.sum("_miss"), F.lit(0)).cast("bigint").alias("missing_predictions"),
        F.count(F.lit(1)).alias("distinct_keys"),
    )


# ---- raising wrappers -------------------------------------------------------

def _fetch(frame: DataFrame) -> dict:
    return frame.first().asDict()


def require_rowcount(source_rows: int, table: DataFrame, with_duplicates: bool = False) -> dict:
    """Rows written (measured during the write) must equal rows stored. With
    ``with_duplicates`` the stored rows come from the duplicate summary, so
    the raw layer's two measurements cost one job."""
    if with_duplicates:
        d = _fetch(duplicate_summary(table))
        v = {"source_rows": int(source_rows), "table_rows": d["total_rows"]} | d
    else:
        v = _fetch(ingest_rowcount(source_rows, table))
    if v["source_rows"] != v["table_rows"]:
        raise DataContractError("row_conservation", "row count mismatch", v)
    return v


def require_silver(silver: DataFrame, expected_rows: int | None = None, key: str = ID_COL,
                   date_col: str = DATE_COL) -> dict:
    v = _fetch(silver_measures(silver, key, date_col))
    if expected_rows is not None and v["rows"] != expected_rows:
        raise DataContractError("silver", "row count mismatch", v)
    if v["distinct_ids"] != v["rows"]:
        raise DataContractError("silver", "duplicate ids", v)
    if v["date_type"] != "date":
        raise DataContractError("silver", "date column is not a date", v)
    if v["invalid_dates"]:
        raise DataContractError("silver", "invalid dates", v)
    return v


def daily_measures(daily: DataFrame, silver: DataFrame, keys: Sequence[str] = KEY_COLUMNS,
                   count_col: str = "transaction_count") -> DataFrame:
    """rows, distinct_keys, total_transactions of the daily table and
    silver_rows, in one job: the daily key pre-grouping and the silver rows
    are unioned into one global aggregate."""
    g = key_grouping(daily, keys, _t=F.col(count_col).cast("bigint")).select(
        "_n", "_t", F.lit(1).alias("_k"), F.lit(None).cast("int").alias("_s"))
    s = silver.select(F.lit(None).cast("bigint").alias("_n"), F.lit(None).cast("bigint").alias("_t"),
                      F.lit(None).cast("int").alias("_k"), F.lit(1).alias("_s"))
    return g.unionByName(s).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count("_k").alias("distinct_keys"),
        F.coalesce(F.sum("_t"), F.lit(0)).cast("bigint").alias("total_transactions"),
        F.count("_s").alias("silver_rows"),
    )


def require_daily(daily: DataFrame, silver: DataFrame, expected_rows: int | None = None,
                  keys: Sequence[str] = KEY_COLUMNS) -> dict:
    v = _fetch(daily_measures(daily, silver, keys))
    if expected_rows is not None and v["rows"] != expected_rows:
        raise DataContractError("daily_agg", "row count mismatch", v)
    if v["distinct_keys"] != v["rows"]:
        raise DataContractError("daily_agg", "duplicate keys", v)
    if v["total_transactions"] != v["silver_rows"]:
        raise DataContractError("daily_agg", "transactions not conserved", v)
    return v


def require_features(df: DataFrame, expected_rows: int | None = None,
                     keys: Sequence[str] = KEY_COLUMNS, daily: DataFrame | None = None) -> dict:
    """Feature contract and key contract from one pass. With ``daily``, gap
    filling must also have kept its demand and its transactions."""
    v = _fetch(feature_measures(df, keys))
    if expected_rows is not None and v["rows"] != expected_rows:
        raise DataContractError("features", "row count mismatch", v)
    if v["distinct_keys"] != v["rows"]:
        raise DataContractError("features", "duplicate keys", v)
    if v["missing_columns"]:
        raise DataContractError("features", "missing feature columns", v)
    if v["null_keys"]:
        raise DataContractError("features", "NULL key values", v)
    if v["null_calendar"]:
        raise DataContractError("features", "NULL calendar values", v)
    if daily is not None:
        d = _fetch(daily.agg(
            F.coalesce(exact_sum(_plain(daily, TARGET_COL)), F.lit(0.0)).alias("demand"),
            F.coalesce(F.sum("transaction_count"), F.lit(0)).cast("bigint").alias("transactions")))
        # sums of the same numbers in another order: exact sums are equal
        if (d["transactions"], d["demand"]) != (v["total_transactions"], v["total_demand"]):
            raise DataContractError("features", "demand or transactions not conserved", v | d)
    return v


def require_key(df: DataFrame, keys: Sequence[str] = KEY_COLUMNS) -> dict:
    declared = declared_key(df)
    if declared != list(keys):
        raise DataContractError("key", "declared key differs", {"declared": declared,
                                                                "expected": list(keys)})
    v = _fetch(key_contract(df, keys))
    nulls = {k: v[f"null_{k}"] for k in keys if v[f"null_{k}"]}
    if nulls:
        raise DataContractError("key", "NULL key values", v)
    if v["distinct_keys"] != v["rows"]:
        raise DataContractError("key", "duplicate keys", v)
    return v


def require_predictions(preds: DataFrame, expected_rows: int | None = None,
                        keys: Sequence[str] = KEY_COLUMNS) -> dict:
    v = _fetch(prediction_check(preds, keys))
    if expected_rows is not None and v["rows"] != expected_rows:
        raise DataContractError("predictions", "row count mismatch", v)
    if v["missing_predictions"]:
        raise DataContractError("predictions", "missing predictions", v)
    if v["distinct_keys"] != v["rows"]:
        raise DataContractError("predictions", "duplicate keys", v)
    return v
