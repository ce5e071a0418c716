"""Training data and model: time split, X/y projection, a distributed
gradient-boosted regressor (:mod:`boosting`) and its feature importance.

The fit runs on the executors; the driver holds a handful of scalars (fill
values, the prior, bin borders) and the trees. Categories enter the model as
ordered target statistics, at every number of categories.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from daybook.config import (
    CATEGORICAL_FEATURES,
    DATE_COL,
    FEATURE_COLUMNS,
    MODEL_PARAMS,
    NUMERIC_FEATURES,
    TARGET_COL,
)
from daybook.errors import DataContractError
from daybook.functions.exact import exact_avg, exact_sum
from daybook.operators.boosting import (
    TREES,
    BoostSettings,
    fit_trees,
    importance_of_trees,
    prediction_column,
)
from daybook.session import ensure_checkpoint_dir, staging_path


def cut_date(value: str) -> F.Column:
    return F.to_date(F.lit(value))


def split_by_date(df: DataFrame, cut: str, date_col: str = DATE_COL) -> tuple[DataFrame, DataFrame]:
    """Train = on or before ``cut``, test = after it. Both are lazy filters
    that reach the parquet scan as pushed predicates."""
    c = cut_date(cut)
    return df.filter(F.col(date_col) <= c), df.filter(F.col(date_col) > c)


def split_counts(df: DataFrame, cut: str, date_col: str = DATE_COL) -> DataFrame:
    """One row, one pass: rows on each side of the cut."""
    c = cut_date(cut)
    return df.agg(F.count_if(F.col(date_col) <= c).alias("train_rows"),
                  F.count_if(F.col(date_col) > c).alias("test_rows"))


def require_split(df: DataFrame, cut: str, date_col: str = DATE_COL) -> dict:
    row = split_counts(df, cut, date_col).first().asDict()
    if row["train_rows"] == 0 or row["test_rows"] == 0:
        raise DataContractError("split_not_empty", "train or test part is empty", row)
    return row


def xy_projection(df: DataFrame, features: Sequence[str] = FEATURE_COLUMNS,
                  target: str = TARGET_COL) -> DataFrame:
    """The feature columns in model order, then the target; others dropped.
    A missing column raises ``KeyError`` before any job runs."""
    missing = [c for c in [*features, target] if c not in df.columns]
    if missing:
        raise KeyError(missing)
    return df.select(*features, target)


def split_features_target(df: DataFrame, features: Sequence[str] = FEATURE_COLUMNS,
                          target: str = TARGET_COL) -> tuple[DataFrame, DataFrame]:
    """X and y as two projections of the same rows."""
    xy = xy_projection(df, features, target)
    return xy.select(*features), xy.select(target)


class ColumnPredictor:
    """A model that predicts an existing column (e.g. the 7-day mean). It has
    the ``transform`` contract of a fitted Spark ML model, so scoring, metrics
    and promotion treat it like any other version."""

    def __init__(self, column: str, prediction_col: str = "prediction"):
        self.column = column
        self.prediction_col = prediction_col

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.prediction_col, F.col(self.column).cast("double"))


# Weight of the prior, in rows, in a category's smoothed target mean.
PRIOR_WEIGHT = 1.0


def category_target_stats(train: DataFrame, categorical: Sequence[str] = CATEGORICAL_FEATURES,
                          target: str = TARGET_COL, date_col: str = DATE_COL,
                          prior_weight: float = PRIOR_WEIGHT) -> DataFrame:
    """Ordered target statistics: one row per (feature, category, day) with
    the rows and target sum of the *earlier* days of the category, the target
    mean of all earlier days (``prior``) and the smoothed mean ``encoded``.

    A training row never sees its own day's target. On the first day there is
    no earlier row of any kind: ``prior`` is NULL, and so is ``encoded``. NULL
    is a category; rows with a NULL or NaN target count in no statistic. The
    windows run over pre-aggregated rows, at most one per category and day;
    the prior's over one row per day, so its single task is as long as the
    calendar, whatever the number of rows.
    """
    y = _number(train, target)
    days = train.groupBy(date_col).agg(F.count(y).alias("_n"), exact_sum(y).alias("_s"))
    before = Window.orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)
    prior = days.select(F.col(date_col).alias("_day"),
                        (F.sum("_s").over(before)
                         / F.nullif(F.sum("_n").over(before), F.lit(0))).alias("prior"))
    earlier = (Window.partitionBy("feature", "category").orderBy(date_col)
               .rowsBetween(Window.unboundedPreceding, -1))
    # one pass over the training rows for all categorical features
    long = train.select(F.col(date_col), y.alias("_y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category"))
        for c in categorical])).alias("_c"))
    stats = (long.groupBy("_c.feature", "_c.category", date_col)
             .agg(F.count("_y").alias("_n"), exact_sum(F.col("_y")).alias("_s"))
             .select("feature", "category", date_col,
                     F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("earlier_rows"),
                     F.coalesce(F.sum("_s").over(earlier), F.lit(0.0)).alias("earlier_sum")))
    return (stats.join(prior, stats[date_col].eqNullSafe(prior["_day"])).drop("_day")
            .withColumn("encoded", _smoothed("earlier_sum", "earlier_rows", F.col("prior"),
                                             prior_weight)))


def category_totals(train: DataFrame, categorical: Sequence[str] = CATEGORICAL_FEATURES,
                    target: str = TARGET_COL) -> DataFrame:
    """(feature, category, rows, target_sum) over all training rows: what rows
    after the training period are encoded with."""
    y = _number(train, target)
    long = train.select(y.alias("_y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category"))
        for c in categorical])).alias("_c"))
    return long.groupBy("_c.feature", "_c.category").agg(
        F.count("_y").alias("rows"), F.coalesce(exact_sum(F.col("_y")), F.lit(0.0)).alias("target_sum"))


def _number(df: DataFrame, col: str) -> Column:
    """The column as a double; NaN counts as missing."""
    c = F.col(col).cast("double")
    return F.nanvl(c, F.lit(None).cast("double")) if isinstance(
        df.schema[col].dataType, (DoubleType, FloatType)) else c


def _smoothed(total: str, rows: str, prior: Column, weight: float) -> Column:
    return (F.col(total) + F.lit(weight) * prior) / (F.col(rows) + F.lit(weight))


def _encoded_name(col: str) -> str:
    return f"_enc_{col}"


def _filled_name(col: str) -> str:
    return f"_num_{col}"


@dataclass(frozen=True)
class ModelSettings:
    """The scalars of a fitted model."""

    numeric: list[str]
    categorical: list[str]
    fills: dict[str, float]
    prior: float
    prior_weight: float


class DemandModel:
    """A fitted model: category totals (a table, never on the driver), fill
    values, and the boosted trees (a table of one row each). Lazy ``transform``,
    ``save`` and ``load``."""

    def __init__(self, settings: ModelSettings, totals: DataFrame, trees: DataFrame,
                 prediction_col: str = "prediction"):
        self.settings = settings
        self.totals = totals
        self.trees = trees
        self.prediction_col = prediction_col

    @property
    def feature_names(self) -> list[str]:
        return [*self.settings.numeric, *self.settings.categorical]

    def _encode(self, df: DataFrame) -> DataFrame:
        """Categories as the smoothed means of the training period; a category
        that it lacks gets the prior. A left join per feature, on distinct keys."""
        s = self.settings
        for i, c in enumerate(s.categorical):
            t = self.totals.filter(F.col("feature") == c).select(
                F.col("category").alias(f"_cat{i}"),
                _smoothed("target_sum", "rows", F.lit(s.prior), s.prior_weight)
                .alias(_encoded_name(c)))
            df = df.join(t, F.col(c).cast("string").eqNullSafe(F.col(f"_cat{i}")), "left").withColumn(
                _encoded_name(c), F.coalesce(_encoded_name(c), F.lit(s.prior))).drop(f"_cat{i}")
        return df

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the prediction; its rows and other columns are kept."""
        ready = _filled(self._encode(df), self.settings)
        value = prediction_column(self.trees, [F.col(c) for c in _input_names(self.settings)],
                                  self.settings.prior)
        return ready.select(*df.columns, value.alias(self.prediction_col))

    def save(self, path: str) -> None:
        """Trees, totals and settings under ``path`` (any file system of Spark)."""
        spark = self.totals.sparkSession
        self.trees.write.mode("overwrite").parquet(os.path.join(path, "trees"))
        self.totals.write.mode("overwrite").parquet(os.path.join(path, "totals"))
        spark.createDataFrame([(json.dumps(asdict(self.settings)),)], "settings string").coalesce(
            1).write.mode("overwrite").parquet(os.path.join(path, "settings"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> DemandModel:
        settings = spark.read.parquet(os.path.join(path, "settings")).first()["settings"]
        return cls(ModelSettings(**json.loads(settings)),
                   spark.read.parquet(os.path.join(path, "totals")),
                   spark.read.schema(TREES).parquet(os.path.join(path, "trees")))


def _input_names(s: ModelSettings) -> list[str]:
    """The model's input columns, in model order."""
    return [_filled_name(c) for c in s.numeric] + [_encoded_name(c) for c in s.categorical]


def _filled(df: DataFrame, s: ModelSettings) -> DataFrame:
    """Missing numbers (NULL or NaN) filled, all inputs as doubles."""
    return df.withColumns({
        _filled_name(c): F.coalesce(_number(df, c), F.lit(s.fills[c])) for c in s.numeric
    } | {_encoded_name(c): F.coalesce(_encoded_name(c), F.lit(s.fills[c])) for c in s.categorical})


def fit_gbt(train: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES,
            categorical: Sequence[str] = CATEGORICAL_FEATURES, target: str = TARGET_COL,
            date_col: str = DATE_COL, max_iter: int = MODEL_PARAMS["iterations"],
            max_depth: int = MODEL_PARAMS["depth"], step_size: float = MODEL_PARAMS["learning_rate"],
            prior_weight: float = PRIOR_WEIGHT, folder: str | None = None) -> DemandModel:
    """Fit encode → fill → bin → boosted symmetric trees on the training rows.

    Categories are encoded by :func:`category_target_stats` (earlier days
    only), the same way for ten values and for ten million. Missing values
    are placed below every observed value (min − 1 of the training split).
    Fill values and the prior come from one aggregation. No part is random.

    The encoded rows are written to the shared checkpoint folder first: the
    statistics and the fit then read stored rows, and a lost executor recomputes
    from those files, not from the whole upstream plan. The split is one row per
    series and day, so its size follows the calendar, not the raw input. Rows
    without a target train nothing. ``folder``: where the trees of every
    segment are stored, to go on with after a failure.
    """
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    y = _number(train, target)
    train = train.select(date_col, *numeric, *categorical, y.alias(target)).filter(
        F.col(target).isNotNull()).checkpoint(eager=True)
    stats = category_target_stats(train, categorical, target, date_col, prior_weight).checkpoint(
        eager=True) if categorical else None
    rows = train
    for i, c in enumerate(categorical):
        t = stats.filter(F.col("feature") == c).select(
            F.col("category").alias(f"_cat{i}"), F.col(date_col).alias(f"_day{i}"),
            F.col("encoded").alias(_encoded_name(c)))
        rows = rows.join(t, F.col(c).cast("string").eqNullSafe(F.col(f"_cat{i}"))
                         & F.col(date_col).eqNullSafe(F.col(f"_day{i}"))).drop(f"_cat{i}", f"_day{i}")
    rows = rows.checkpoint(eager=True)
    least = rows.agg(exact_avg(F.col(target)).alias("prior"),
                     *[(F.min(_number(rows, c)) - 1).alias(c) for c in numeric],
                     *[(F.min(_encoded_name(c)) - 1).alias(c) for c in categorical]).first().asDict()
    settings = ModelSettings(list(numeric), list(categorical),
                             {c: -1.0 if least[c] is None else float(least[c])
                              for c in [*numeric, *categorical]},
                             float(least["prior"] or 0.0), prior_weight)
    totals = category_totals(train, categorical, target) if categorical else spark.createDataFrame(
        [], "feature string, category string, rows long, target_sum double")
    path = staging_path(spark, "category-totals")
    totals.write.parquet(path)
    trees = fit_trees(_filled(rows, settings), _input_names(settings), target, settings.prior,
                      BoostSettings(max_iter, max_depth, step_size),
                      folder or staging_path(spark, "boosting"))
    return DemandModel(settings, spark.read.parquet(path), trees)


def feature_importance(model: DemandModel) -> DataFrame:
    """(feature, importance), most important first, shares of 100: how much
    the splits of each model input change the predictions."""
    return importance_of_trees(model.trees, model.feature_names).orderBy(
        F.desc("importance"), F.asc("feature"))


def importance_check(importance: DataFrame) -> DataFrame:
    """One row: names, distinct names, Σ importance as a share of 1, rounded to
    6 digits, and whether all shares lie between 0 and 1."""
    share = F.col("importance") / 100
    return importance.agg(
        F.count(F.lit(1)).alias("features"), F.count_distinct("feature").alias("distinct_features"),
        F.round(F.sum(share), 6).alias("total_importance"),
        F.min(share.between(0, 1 + 1e-9)).alias("in_range"))
