"""Model versions as data: metrics per version, the champion's predictions,
the promotion decision, alias moves and the run summary.

Registry state is a small ``model_versions`` table
(model_name, version, alias, test_r2); predictions of all versions live in
one long table keyed by ``model_version``. Every version is therefore
scored on the same rows in one grouped pass.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.config import (
    CHALLENGER_ALIAS,
    CHAMPION_ALIAS,
    DATE_COL,
    DECISION_FIRST,
    DECISION_KEPT,
    DECISION_PROMOTED,
    MIN_IMPROVEMENT,
    TARGET_COL,
)
from daybook.functions.exact import exact_sum
from daybook.functions.metrics import regression_metrics
from daybook.operators.model import cut_date

VERSION_COLUMNS = ["model_name", "version", "alias", "test_r2"]


def metrics_by_version(preds: DataFrame) -> DataFrame:
    """n, r2, rmse, mae per model version, in full precision; per model too if
    the predictions carry a ``model_name``."""
    names = [c for c in ("model_name", "model_version") if c in preds.columns]
    return regression_metrics(preds, group_by=names)


def assign_versions(metrics: DataFrame, model_name: str, champion: str | None,
                    challenger: str) -> DataFrame:
    """A ``model_versions`` table for the versions found in ``metrics``: the
    given champion and challenger aliases, the measured R² as ``test_r2``."""
    v = F.col("model_version")
    alias = F.when(v == F.lit(challenger), F.lit(CHALLENGER_ALIAS))
    if champion is not None:
        alias = F.when(v == F.lit(champion), F.lit(CHAMPION_ALIAS)).otherwise(alias)
    return metrics.select(F.lit(model_name).alias("model_name"), v.alias("version"),
                          alias.alias("alias"), F.col("r2").alias("test_r2"))


def champion_predictions(preds: DataFrame, versions: DataFrame,
                         alias: str = CHAMPION_ALIAS) -> DataFrame:
    """Rows of the version that holds ``alias``; zero rows when nobody does.
    A semi join against the alias holder (one row): AQE broadcasts it from
    its measured size, so the predictions are not shuffled. Predictions stored in
    partitions by version are pruned to the holder's at run time. With a
    ``model_name`` on both sides versions are told apart by model."""
    keys = [c for c in ("model_name", "model_version") if c in preds.columns]
    holder = versions.filter(F.col("alias") == alias).select(
        *[F.col("version" if k == "model_version" else k).alias(k) for k in keys])
    return preds.join(holder, keys, "left_semi")


def version_board(metrics: DataFrame, versions: DataFrame, challenger: str,
                  min_improvement: float = MIN_IMPROVEMENT,
                  model_name: str | None = None) -> DataFrame:
    """Every registered version with its current metrics and this run's
    decision on each row, computed lazily (no fetch to the driver).

    The decision is per model: window columns partitioned by ``model_name``
    carry the challenger's and the champion's R² to every version row. A
    model has a handful of versions, so each window partition is tiny.

    No champion → "promoted (first model)" with champion_r2 NULL; else the
    challenger wins only if its R² is strictly above champion R² +
    ``min_improvement``. A champion or challenger without metrics is an
    error, not a decision; so are two champions of one model. Metrics belong to
    ``model_name`` (they may carry it as a column); with None, the challenger's
    version must exist in one model only. Versions of other models have no
    decision.
    """
    keys = ["model_name", "version"] if "model_name" in metrics.columns else ["version"]
    r2 = metrics.select(*[F.col(k if k == "model_name" else "model_version").alias(k) for k in keys],
                        "r2")
    mine = F.lit(True) if model_name is None else F.col("model_name") == F.lit(model_name)
    m = versions.join(r2, keys, "left")
    w = Window.partitionBy("model_name")
    v = F.col("version")
    is_chal = (v == F.lit(challenger)) & mine
    is_champ = (F.col("alias") == F.lit(CHAMPION_ALIAS)) & ~is_chal
    board = m.select(
        "model_name", "version", "alias", "test_r2", "r2",
        F.max(F.when(is_chal, F.col("r2"))).over(w).alias("challenger_r2"),
        F.max(F.when(is_champ, v)).over(w).alias("_champion"),
        F.max(F.when(is_champ, F.col("r2"))).over(w).alias("champion_r2"),
        F.sum(F.when(is_champ, 1).otherwise(0)).over(w).alias("_n_champ"),
        F.sum(F.when(is_chal, 1).otherwise(0)).over(w).alias("_n_chal"),
    )
    decision = (
        F.when(F.col("_n_chal") == 0, F.lit(None).cast("string"))  # another model
        .when(F.col("_n_champ") > 1, F.raise_error(F.lit("two champions of one model")).cast("string"))
        .when(F.col("challenger_r2").isNull(),
               F.raise_error(F.lit(f"challenger {challenger} has no metrics")).cast("string"))
        .when(F.col("_n_champ") == 0, F.lit(DECISION_FIRST))
        .when(F.col("champion_r2").isNull(),
              F.raise_error(F.lit("champion has no metrics")).cast("string"))
        .when(F.col("challenger_r2") > F.col("champion_r2") + F.lit(float(min_improvement)),
              F.lit(DECISION_PROMOTED))
        .otherwise(F.lit(DECISION_KEPT))
    )
    winner = (F.when(F.col("decision") == F.lit(DECISION_KEPT), F.col("_champion"))
              .otherwise(F.lit(challenger)))
    return board.withColumn("decision", decision).withColumn("champion_version", winner)


def decide(metrics: DataFrame, versions: DataFrame, challenger: str,
           min_improvement: float = MIN_IMPROVEMENT, model_name: str | None = None) -> DataFrame:
    """One row: decision, champion_version (the winner), champion_r2,
    challenger_r2 (the challenger must be registered in ``versions``)."""
    return (version_board(metrics, versions, challenger, min_improvement, model_name)
            .filter((F.col("version") == F.lit(challenger)) & F.col("decision").isNotNull())
            .select("decision", "champion_version", "champion_r2", "challenger_r2"))


def promote(metrics: DataFrame, versions: DataFrame, challenger: str,
            min_improvement: float = MIN_IMPROVEMENT, model_name: str | None = None) -> DataFrame:
    """The alias table after the decision; other models' aliases stay as they
    are. On promotion the winner takes
    Champion and the Challenger alias is removed; when the champion is kept,
    every alias stays."""
    board = version_board(metrics, versions, challenger, min_improvement, model_name)
    alias = (
        F.when(F.col("decision").isNull() | (F.col("decision") == F.lit(DECISION_KEPT)),
               F.col("alias"))
        .when(F.col("version") == F.col("champion_version"), F.lit(CHAMPION_ALIAS))
        .when(F.col("alias").isin(CHAMPION_ALIAS, CHALLENGER_ALIAS), F.lit(None))
        .otherwise(F.col("alias"))
    )
    return board.select("model_name", "version", alias.cast("string").alias("alias"), "test_r2")


def run_summary(features: DataFrame, preds: DataFrame, cut: str,
                params: Mapping[str, str] | None = None, date_col: str = DATE_COL,
                target: str = TARGET_COL) -> DataFrame:
    """One row per model version: the feature-table fingerprint (rows,
    first/last day, target sum; replaces a storage version number), the cut
    and split sizes, and the test metrics.

    One job, no fetch: the fingerprint (one aggregate row) and the metrics
    (one row per version) are unioned and the fingerprint is spread to the
    version rows by a window over the run's cut date, whose partition holds
    the version rows plus one.
    """
    c = cut_date(cut)
    snap_cols = ["feature_rows", "feature_min_date", "feature_max_date", "feature_target_sum",
                 "train_rows", "test_rows"]
    snap = features.agg(
        F.count(F.lit(1)).alias("feature_rows"),
        F.min(date_col).alias("feature_min_date"),
        F.max(date_col).alias("feature_max_date"),
        F.coalesce(exact_sum(F.col(target)), F.lit(0.0)).alias("feature_target_sum"),
        F.count_if(F.col(date_col) <= c).alias("train_rows"),
        F.count_if(F.col(date_col) > c).alias("test_rows"),
    ).select(F.lit(None).cast("string").alias("model_version"), *snap_cols,
             c.alias("train_end_date"))
    mets = metrics_by_version(preds).select("model_version", "r2", "rmse", "mae",
                                            c.alias("train_end_date"))
    w = Window.partitionBy("train_end_date")
    both = mets.unionByName(snap, allowMissingColumns=True)
    cols = [F.col("model_version"), *[F.max(x).over(w).alias(x) for x in snap_cols[:4]],
            F.col("train_end_date"), *[F.max(x).over(w).alias(x) for x in snap_cols[4:]],
            "r2", "rmse", "mae"]
    if params is not None:
        cols.insert(1, F.create_map(*[F.lit(x) for kv in sorted(params.items())
                                      for x in (str(kv[0]), str(kv[1]))]).alias("params"))
    return both.select(*cols).filter(F.col("model_version").isNotNull())
