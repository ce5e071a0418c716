"""Batch scoring into the prediction table; actual-vs-predicted data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.config import FEATURE_COLUMNS, KEY_COLUMNS, TARGET_COL
from daybook.session import staging_path
from daybook.sources.files import read_table, write_table

PREDICTION_COLUMNS = [*KEY_COLUMNS, "actual_demand", "predicted_demand", "model_version"]


def score(model, test: DataFrame, model_version: str, keys: Sequence[str] = KEY_COLUMNS,
          target: str = TARGET_COL, with_timestamp: bool = False) -> DataFrame:
    """Keys, actual and predicted demand, the version as a literal (and the
    scoring time when asked). ``model`` is anything with ``transform``:
    a fitted Spark ML pipeline or a :class:`ColumnPredictor`. Lazy: the
    model runs inside the executors' tasks when the table is written."""
    scored = model.transform(test)
    cols = [*[F.col(k) for k in keys],
            F.col(target).cast("double").alias("actual_demand"),
            F.col("prediction").cast("double").alias("predicted_demand"),
            F.lit(str(model_version)).alias("model_version")]
    if with_timestamp:
        cols.append(F.current_timestamp().alias("predicted_at"))
    return scored.select(*cols)


def actual_vs_predicted(model, test: DataFrame, features: Sequence[str] = FEATURE_COLUMNS,
                        target: str = TARGET_COL) -> DataFrame:
    """Test rows as the model saw them plus actual and predicted demand
    (the data behind the scatter chart and the test-predictions export)."""
    scored = model.transform(test)
    return scored.select(*features, F.col(target).cast("double").alias("actual_demand"),
                         F.col("prediction").cast("double").alias("predicted_demand"))


def joined_predictions(preds: DataFrame, test: DataFrame, features: Sequence[str] = FEATURE_COLUMNS,
                       keys: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """:func:`actual_vs_predicted` from stored predictions: nothing is scored
    again. The keys are unique on both sides; a NULL key meets NULL."""
    p = preds.select(*[F.col(k).alias(f"_{k}") for k in keys], "actual_demand", "predicted_demand")
    same = [test[k].eqNullSafe(p[f"_{k}"]) for k in keys]
    return test.select(*dict.fromkeys([*keys, *features])).join(p, same).select(
        *features, "actual_demand", "predicted_demand")


def chart_grid(df: DataFrame, cells: int = 100) -> DataFrame:
    """Counts of the actual / predicted plane in cells * cells squares over the
    common range of both: chart data whose size doesn't depend on the rows.
    (actual_cell, predicted_cell, rows, actual_from, predicted_from); the largest
    values fall into the last cell; rows with a missing value are left out; with
    one value in all there's one cell. The limits and the cells need two passes: the
    pairs of values are stored first, so the rows are made once."""
    if not 1 <= cells <= 100:
        raise ValueError(f"cells: {cells}")
    a, p = F.col("actual_demand"), F.col("predicted_demand")
    valid = df.filter(a.isNotNull() & p.isNotNull() & ~F.isnan(a) & ~F.isnan(p))
    path = staging_path(df.sparkSession, "chart-pairs")
    write_table(valid.select(a, p), path)
    valid = read_table(df.sparkSession, path)
    limits = plot_limits(valid)
    width = (F.col("upper") - F.col("lower")) / cells
    cell = (lambda c: F.when(F.col("upper") == F.col("lower"), F.lit(0)).otherwise(
        F.least(F.floor((c - F.col("lower")) / F.when(width > 0, width)), F.lit(cells - 1))).cast("int"))
    return (valid.withColumns({c: limits.select(c).scalar() for c in ("lower", "upper")})
            .groupBy(cell(a).alias("actual_cell"), cell(p).alias("predicted_cell"))
            .agg(F.count(F.lit(1)).alias("rows"), F.first("lower").alias("_lower"),
                 F.first(width).alias("_width"))
            .select("actual_cell", "predicted_cell", "rows",
                    (F.col("_lower") + F.col("actual_cell") * F.col("_width")).alias("actual_from"),
                    (F.col("_lower") + F.col("predicted_cell") * F.col("_width")).alias("predicted_from")))


def plot_limits(df: DataFrame) -> DataFrame:
    """One row: the common axis range of actual and predicted values."""
    return df.agg(
        F.least(F.min("actual_demand"), F.min("predicted_demand")).alias("lower"),
        F.greatest(F.max("actual_demand"), F.max("predicted_demand")).alias("upper"),
    )
