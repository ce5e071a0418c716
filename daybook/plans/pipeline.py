"""The whole job, stage by stage: raw CSV → bronze → silver → daily →
features → model → decision → predictions.

Each stage is a function that reads the previous stage's stored table and
publishes its own as a new version (stage → contract → publish), like the six tasks of the
original daily job; ``run_pipeline`` runs them in order. Because every
layer is written once and the next layer reads the written table, each
contract checks stored data, a failed contract never replaces a published
table, and lineage is cut at every layer: a lost executor recomputes at
most one stage from stored files. Model versions, their aliases and run
summaries are tables too.
"""

from __future__ import annotations

import argparse
import json
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from daybook.config import (
    CHALLENGER_ALIAS,
    CHAMPION_ALIAS,
    KEY_COLUMNS,
    MIN_IMPROVEMENT,
    MODEL_PARAMS,
    TARGET_COL,
)
from daybook.errors import DataContractError
from daybook.functions.metrics import regression_metrics
from daybook.operators import contracts as C
from daybook.operators.aggregate import daily_agg, date_range
from daybook.operators.clean import to_silver
from daybook.operators.lifecycle import (
    VERSION_COLUMNS,
    decide,
    metrics_by_version,
    promote,
    run_summary,
)
from daybook.operators.model import DemandModel, feature_importance, fit_gbt, require_split, split_by_date
from daybook.operators.refresh import refresh_features
from daybook.operators.scoring import PREDICTION_COLUMNS, chart_grid, joined_predictions, score
from daybook.operators.timeseries import build_features
from daybook.sources.files import (
    REJECT_COL,
    ingest_parted,
    overwrite_partitions,
    publish,
    read_partitions,
    read_raw_csv,
    read_table,
    write_csv,
    write_table,
)
from daybook.sources.versions import current_version, fs_path, table_exists

VERSIONS_SCHEMA = "model_name string, version string, alias string, test_r2 double"
# scores: the predictions of all versions, a partition for each; fits: trees of
# unfinished fits; artifacts: importance, test predictions and chart data by version
# rejects: malformed rows of the last file; features_by_bucket: features refreshed by series
LAYERS = ["bronze", "rejects", "silver", "daily_agg", "features", "scores", "predictions", "model_versions",
          "runs", "models", "fits", "artifacts", "features_by_bucket"]
BY_VERSION = ["model_name", "model_version"]
#: Versions of a layer that stay readable.
KEEP_VERSIONS = 7


@dataclass
class PipelineResult:
    paths: dict[str, str]
    measures: dict = field(default_factory=dict)
    decision: dict = field(default_factory=dict)
    version: str = ""


def layer_paths(out_dir: str) -> dict[str, str]:
    return {name: os.path.join(out_dir, name) for name in LAYERS}


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = fs_path(spark, path)
    return fs.exists(p)


def _keep(measures: dict, key: str, check):
    """A publish check that also records the measured values."""
    def run(staged: DataFrame, rows: int):
        measures[key] = check(staged, rows)
    return run


def _publish(df: DataFrame, target: str, check=None, fmt: str = "parquet") -> int:
    return publish(df, target, check, fmt, keep=KEEP_VERSIONS)


def run_bronze(spark: SparkSession, source_csv: str, paths: dict, m: dict,
               fmt: str = "parquet", max_malformed: float | None = None) -> None:
    """The file as it is; rows written must equal rows stored. A malformed row stops
    the run, or, with ``max_malformed`` (a share of the rows), goes to ``rejects``."""
    def check(staged: DataFrame, rows: int) -> dict:
        v = C.require_rowcount(rows, staged, with_duplicates=True)
        m["duplicates"] = {k: v[k] for k in ["total_rows", "distinct_rows", "duplicate_rows"]}
        return {k: v[k] for k in ["source_rows", "table_rows"]}

    if max_malformed is not None:
        counts = ingest_parted(spark, source_csv, paths["bronze"], paths["rejects"], max_malformed,
                               fmt=fmt, keep=KEEP_VERSIONS)
        bronze = read_table(spark, paths["bronze"], fmt).drop(REJECT_COL)
        m["bronze"] = counts | check(bronze, counts["good_rows"]) | {"source_rows": counts["source_rows"]}
        return
    raw = read_raw_csv(spark, source_csv)
    _publish(raw, paths["bronze"], _keep(m, "bronze", check), fmt)


def run_silver(spark: SparkSession, paths: dict, m: dict, fmt: str = "parquet") -> None:
    """One row per id, dates parsed; duplicate ids or invalid dates stop the run."""
    bronze = read_table(spark, paths["bronze"], fmt).drop(REJECT_COL)
    _publish(to_silver(bronze), paths["silver"], _keep(m, "silver", C.require_silver), fmt)
    m["date_range"] = date_range(read_table(spark, paths["silver"], fmt)).first().asDict()


def run_daily(spark: SparkSession, paths: dict, m: dict, fmt: str = "parquet") -> None:
    """Daily aggregate: unique grain, every transaction counted once."""
    silver = read_table(spark, paths["silver"], fmt)
    _publish(daily_agg(silver), paths["daily_agg"],
            _keep(m, "daily", lambda s, n: C.require_daily(s, silver, n)), fmt)


def run_features(spark: SparkSession, paths: dict, m: dict, fmt: str = "parquet") -> None:
    """Gap-filled days, lags, rolling mean, calendar; feature and key contracts."""
    daily = read_table(spark, paths["daily_agg"], fmt)

    def check(staged: DataFrame, rows: int) -> dict:
        if C.declared_key(staged) != KEY_COLUMNS:
            raise DataContractError("key", "declared key lost", {"declared": C.declared_key(staged)})
        v = C.require_features(staged, rows, daily=daily)  # includes the key contract
        m["key"] = {k: v[k] for k in ["rows", "distinct_keys"]
                    + [c for c in v if c.startswith("null_") and c != "null_keys"
                       and c != "null_calendar"]}
        return v

    _publish(C.declare_key(build_features(daily)), paths["features"], _keep(m, "features", check),
            fmt)
    m["feature_nulls"] = C.feature_null_summary(
        read_table(spark, paths["features"], fmt)).first().asDict()


def run_refresh(spark: SparkSession, paths: dict, m: dict, fmt: str = "parquet") -> None:
    """Bring the partitioned feature table up to date: only partitions with a changed
    series are built, checked and replaced."""
    daily = read_table(spark, paths["daily_agg"], fmt)
    m["refresh"] = refresh_features(daily, paths["features_by_bucket"], fmt=fmt,
                                    check=lambda staged, rows: C.require_features(staged, rows))


def run_training(spark: SparkSession, paths: dict, m: dict, cut: str,
                 model_name: str = "demand_model", max_iter: int = MODEL_PARAMS["iterations"],
                 min_improvement: float = MIN_IMPROVEMENT, fmt: str = "parquet") -> tuple[str, dict]:
    """Fit a challenger, store its and the champion's scores of the same test rows,
    write the artefacts, decide, move the aliases and append the run summary. Returns the new
    version and the decision."""
    # one version of the features for the whole run, recorded with it
    feature_version = current_version(spark, paths["features"])
    features = read_table(spark, paths["features"], fmt, feature_version)
    m["split"] = require_split(features, cut)
    train, test = split_by_date(features, cut)
    registered = table_exists(spark, paths["model_versions"])
    versions = (read_table(spark, paths["model_versions"], fmt) if registered
                else spark.createDataFrame([], VERSIONS_SCHEMA))
    if not registered and _exists(spark, paths["models"]):
        raise DataContractError("registry", "models exist but the registry is absent", paths)
    registry = versions.filter(F.col("model_name") == model_name)
    known = [r.version for r in registry.select("version").collect()]  # registry rows: a handful
    version = str(max([int(v) for v in known if v.isdigit()] or [0]) + 1)
    fits = os.path.join(paths["fits"], model_name, version)
    model = fit_gbt(train, max_iter=max_iter, folder=fits)
    model.save(os.path.join(paths["models"], model_name, version))

    champion = [r.version for r in registry.filter(F.col("alias") == CHAMPION_ALIAS).collect()]
    # each version is scored once; all that follows reads the stored predictions
    _store_scores(spark, paths, model_name, version, model, test, fmt)
    if champion:
        old = DemandModel.load(spark, os.path.join(paths["models"], model_name, champion[0]))
        _store_scores(spark, paths, model_name, champion[0], old, test, fmt)
    preds = stored_scores(spark, paths, model_name, [version, *champion], fmt).drop("model_name")
    write_artifacts(spark, paths, model_name, version, model, test, fmt)
    # a few rows, read three times below: stored once (reliable checkpoint)
    metrics = metrics_by_version(preds).checkpoint(eager=True)
    chal_r2 = metrics.filter(F.col("model_version") == version).first()["r2"]
    # the Challenger alias moves to the new version (at most one holder)
    versions = versions.withColumn(
        "alias", F.when((F.col("model_name") != model_name) | (F.col("alias") != CHALLENGER_ALIAS),
                        F.col("alias"))
    ).unionByName(spark.createDataFrame([(model_name, version, CHALLENGER_ALIAS, chal_r2)],
                                        VERSIONS_SCHEMA))
    decision = decide(metrics, versions, version, min_improvement, model_name).first().asDict()
    params = {k: str(v) for k, v in MODEL_PARAMS.items()} | {"iterations": str(max_iter)}
    summary = run_summary(features, preds.filter(F.col("model_version") == version), cut, params)
    # the run first: a failure before the registry leaves no promoted version without
    # a run; a second attempt at this version replaces its run
    overwrite_partitions(summary.withColumns({
        "model_name": F.lit(model_name),
        "feature_version": F.lit(feature_version).cast("long")}), paths["runs"],
                         BY_VERSION, fmt)
    _publish(promote(metrics, versions, version, min_improvement, model_name).select(*VERSION_COLUMNS),
            paths["model_versions"], fmt=fmt)
    fs, p = fs_path(spark, fits)
    fs.delete(p, True)  # the model is registered
    m["decision"] = decision
    return version, decision


def _store_scores(spark: SparkSession, paths: dict, model_name: str, version: str, model: DemandModel,
                  test: DataFrame, fmt: str) -> None:
    """Score the test rows with one version and replace its partition."""
    rows = score(model, test, version, with_timestamp=True)
    overwrite_partitions(rows.withColumn("model_name", F.lit(model_name)), paths["scores"],
                         BY_VERSION, fmt)


def stored_scores(spark: SparkSession, paths: dict, model_name: str, versions: list[str],
                  fmt: str = "parquet") -> DataFrame:
    """Stored predictions of these versions; only their partitions are read."""
    return read_partitions(spark, paths["scores"], BY_VERSION, fmt).filter(
        (F.col("model_name") == model_name) & F.col("model_version").isin(versions))


def write_artifacts(spark: SparkSession, paths: dict, model_name: str, version: str,
                    model: DemandModel, test: DataFrame, fmt: str = "parquet") -> str:
    """Feature importance and test predictions as CSV, chart data as a table,
    under ``artifacts/<model>/<version>``."""
    folder = os.path.join(paths["artifacts"], model_name, version)
    write_csv(feature_importance(model).coalesce(1), os.path.join(folder, "feature_importance"))
    preds = stored_scores(spark, paths, model_name, [version], fmt)
    write_csv(joined_predictions(preds, test), os.path.join(folder, "test_predictions"))
    write_table(chart_grid(preds), os.path.join(folder, "actual_vs_predicted"), fmt)
    return folder


def _covers(spark: SparkSession, paths: dict, model_name: str, version: str, test: DataFrame,
            fmt: str) -> bool:
    """Whether the stored scores of a version are of exactly these test rows
    (keys and actual values, by an order-independent fingerprint)."""
    if not _exists(spark, os.path.join(paths["scores"], f"model_name={model_name}",
                                       f"model_version={version}")):
        return False
    def print_of(df: DataFrame, actual: str) -> Row:
        key = F.xxhash64(*KEY_COLUMNS, F.col(actual).cast("double"))
        return df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(key).alias("x")).first()
    return print_of(stored_scores(spark, paths, model_name, [version], fmt), "actual_demand") == print_of(
        test, TARGET_COL)


def run_predictions(spark: SparkSession, paths: dict, m: dict, cut: str,
                    fmt: str = "parquet", model_name: str = "demand_model") -> None:
    """The champion's stored predictions on the test period, with their scoring
    time; then R² recomputed from the published table. A champion whose scores are
    of another feature table or cut (other test rows) is scored anew."""
    versions = read_table(spark, paths["model_versions"], fmt)
    holder = [r.version for r in versions.filter(
        (F.col("model_name") == model_name) & (F.col("alias") == CHAMPION_ALIAS)).collect()]
    if not holder:
        raise LookupError("no version holds the Champion alias")
    winner = holder[0]
    _, test = split_by_date(read_table(spark, paths["features"], fmt), cut)
    if not _covers(spark, paths, model_name, winner, test, fmt):
        model = DemandModel.load(spark, os.path.join(paths["models"], model_name, winner))
        _store_scores(spark, paths, model_name, winner, model, test, fmt)
    out = stored_scores(spark, paths, model_name, [winner], fmt).select(
        *PREDICTION_COLUMNS, "predicted_at")
    _publish(out, paths["predictions"],
            _keep(m, "predictions", lambda s, n: C.require_predictions(s, n)), fmt)
    m["r2_from_table"] = regression_metrics(
        read_table(spark, paths["predictions"], fmt)).first()["r2"]


def run_pipeline(spark: SparkSession, source_csv: str, out_dir: str, cut: str,
                 model_name: str = "demand_model", max_iter: int = MODEL_PARAMS["iterations"],
                 min_improvement: float = MIN_IMPROVEMENT, fmt: str = "parquet",
                 max_malformed: float | None = None) -> PipelineResult:
    paths = layer_paths(out_dir)
    res = PipelineResult(paths)
    m = res.measures
    run_bronze(spark, source_csv, paths, m, fmt, max_malformed)
    run_silver(spark, paths, m, fmt)
    run_daily(spark, paths, m, fmt)
    run_features(spark, paths, m, fmt)
    res.version, res.decision = run_training(spark, paths, m, cut, model_name, max_iter,
                                             min_improvement, fmt)
    run_predictions(spark, paths, m, cut, fmt, model_name)
    return res


STAGES = ["bronze", "silver", "daily", "features", "refresh", "training", "predictions", "all"]


def main(argv: list[str] | None = None) -> None:
    """Run one stage (or all) from the command line, e.g. as a job task:

        python -m daybook.plans.pipeline features --out /shared/demand
    """
    ap = argparse.ArgumentParser(prog="daybook")
    ap.add_argument("stage", choices=STAGES)
    ap.add_argument("--source", help="raw CSV file or folder (bronze / all)")
    ap.add_argument("--out", required=True, help="folder of the layer tables")
    ap.add_argument("--cut", default=None, help="last training day, yyyy-MM-dd")
    ap.add_argument("--model-name", default="demand_model")
    ap.add_argument("--max-iter", type=int, default=MODEL_PARAMS["iterations"])
    ap.add_argument("--min-improvement", type=float, default=MIN_IMPROVEMENT)
    ap.add_argument("--max-malformed", type=float, default=None,
                    help="share of malformed rows that bronze keeps apart (default: any stops it)")
    ap.add_argument("--format", default="parquet")
    a = ap.parse_args(argv)
    if a.cut is None and a.stage in ("training", "predictions", "all"):
        ap.error(f"{a.stage} needs --cut")

    from daybook.session import build_session, size_shuffles
    spark = build_session()
    paths, m = layer_paths(a.out), {}
    # size the first shuffle from the stage's own input
    sized_by = {"bronze": a.source, "all": a.source, "silver": paths["bronze"],
                "daily": paths["silver"], "features": paths["daily_agg"],
                "refresh": paths["daily_agg"]}.get(a.stage, paths["features"])
    if sized_by and _exists(spark, sized_by):
        m["shuffle_partitions"] = size_shuffles(spark, sized_by)
    if a.stage == "all":
        m = run_pipeline(spark, a.source, a.out, a.cut, a.model_name, max_iter=a.max_iter,
                         min_improvement=a.min_improvement, fmt=a.format,
                         max_malformed=a.max_malformed).measures
    elif a.stage == "bronze":
        run_bronze(spark, a.source, paths, m, a.format, a.max_malformed)
    elif a.stage == "silver":
        run_silver(spark, paths, m, a.format)
    elif a.stage == "daily":
        run_daily(spark, paths, m, a.format)
    elif a.stage == "features":
        run_features(spark, paths, m, a.format)
    elif a.stage == "refresh":
        run_refresh(spark, paths, m, a.format)
    elif a.stage == "training":
        run_training(spark, paths, m, a.cut, a.model_name, max_iter=a.max_iter,
                     min_improvement=a.min_improvement, fmt=a.format)
    else:
        run_predictions(spark, paths, m, a.cut, a.format, a.model_name)
    print(json.dumps(m, default=str))


if __name__ == "__main__":
    main()
