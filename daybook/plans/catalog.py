"""The query catalog: one named query per operator of the job, each a
function ``(spark, sf_dir) -> DataFrame``, and for each (except the model
fit) the equivalent DuckDB SQL over the same raw tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.config import (
    CATEGORICAL_FEATURES,
    FEATURE_COLUMNS,
    KEY_COLUMNS,
    NUMERIC_FEATURES,
    RAW_SCHEMA,
)
from daybook.functions.exact import exact_sum
from daybook.functions.metrics import regression_metrics
from daybook.operators import contracts as C
from daybook.operators.aggregate import daily_agg, date_range, series_extent
from daybook.operators.clean import parse_dates
from daybook.operators.lifecycle import (
    assign_versions,
    champion_predictions,
    decide,
    metrics_by_version,
    promote,
    run_summary,
)
from daybook.operators.model import (
    PRIOR_WEIGHT,
    category_target_stats,
    feature_importance,
    importance_check,
    split_counts,
    xy_projection,
)
from daybook.operators.refresh import (
    changed_series,
    read_features,
    refresh_features,
    series_prints,
)
from daybook.operators.scoring import (
    PREDICTION_COLUMNS,
    actual_vs_predicted,
    chart_grid,
    plot_limits,
    score,
)
from daybook.operators.timeseries import (
    calendar_features,
    date_spine,
    gapfill_days,
    gapfill_days_join,
    lag_features,
    rolling_mean,
)
from daybook.plans.oracle import CUT, with_base
from daybook.plans.stages import (
    MODEL_NAME,
    SCENARIO_CHALLENGER,
    SCENARIO_CHAMPION,
    Stages,
)
from daybook.session import measured_joins, staging_path
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

from daybook.sources.versions import current_version, versions

OTHER_MODEL = "other_model"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

_FEATS = ", ".join(FEATURE_COLUMNS)
_KEYS = ", ".join(KEY_COLUMNS)
_PRESENT = ("(select count(*) from (describe select * from feat) where column_name in ("
            + ", ".join(f"'{c}'" for c in NUMERIC_FEATURES) + "))")


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Stages], DataFrame]) -> Callable[[Stages], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(Stages(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = with_base(sql)
        return fn
    return register


# ---- sources and sinks -------------------------------------------------------

def _csv_source(s: Stages) -> str:
    """Write the raw transactions as the headed CSV the job ingests (compressed)."""
    with measured_joins(s.spark):
        return write_csv(s.raw, staging_path(s.spark, "raw-csv"), "lz4")


@query("csv_ingest", "select * from tx")
def q_csv_ingest(s: Stages) -> DataFrame:
    return read_raw_csv(s.spark, _csv_source(s), RAW_SCHEMA)


def _csv_with_bad_cells(s: Stages) -> str:
    """The same CSV, with text in a number's place wherever the line number is 7."""
    bad = F.when(F.col("transaction_id").endswith("-7"), F.lit("n/a"))
    rows = s.raw.withColumn("ordered_quantity", F.coalesce(bad, F.col("ordered_quantity").cast("string")))
    with measured_joins(s.spark):
        return write_csv(rows, staging_path(s.spark, "raw-csv-bad"), "lz4")


@query("csv_parted_counts",
       "select count(*) as source_rows, count(*) filter (not suffix(transaction_id, '-7')) as good_rows, "
       "count(*) filter (suffix(transaction_id, '-7')) as malformed_rows, "
       "sum(demand_quantity) filter (not suffix(transaction_id, '-7')) as good_demand from tx")
def q_csv_parted_counts(s: Stages) -> DataFrame:
    good, bad = staging_path(s.spark, "bronze-good"), staging_path(s.spark, "bronze-rejects")
    n = ingest_parted(s.spark, _csv_with_bad_cells(s), good, bad, max_share=0.5)
    return read_table(s.spark, good).agg(
        F.lit(n["source_rows"]).cast("long").alias("source_rows"), F.count(F.lit(1)).alias("good_rows"),
        F.lit(n["malformed_rows"]).cast("long").alias("malformed_rows"),
        exact_sum(F.col("demand_quantity")).alias("good_demand"))


@query("csv_malformed_rows",
       "select transaction_id, true as has_file from tx where suffix(transaction_id, '-7')")
def q_csv_malformed_rows(s: Stages) -> DataFrame:
    good, bad = staging_path(s.spark, "bronze-good"), staging_path(s.spark, "bronze-rejects")
    ingest_parted(s.spark, _csv_with_bad_cells(s), good, bad, max_share=0.5)
    return read_table(s.spark, bad).select(
        F.split(f"{REJECT_COL}.text", ",")[0].alias("transaction_id"),
        F.col(f"{REJECT_COL}.file").endswith(".csv.lz4").alias("has_file"))


@query("ingest_rowcount", "select count(*) as source_rows, count(*) as table_rows from tx")
def q_ingest_rowcount(s: Stages) -> DataFrame:
    source = read_raw_csv(s.spark, _csv_source(s))
    path = staging_path(s.spark, "bronze")
    written = write_table(source, path)
    return C.ingest_rowcount(written, read_table(s.spark, path))


@query("table_roundtrip", "select * from silver")
def q_table_roundtrip(s: Stages) -> DataFrame:
    # the layer sink as the job uses it: stage, check the stored rows, publish
    path = staging_path(s.spark, "silver")
    publish(s.silver, path, lambda staged, rows: C.require_silver(staged, rows))
    return read_table(s.spark, path)


@query("table_version_history",
       "select 1 as version, count(*) as rows from tx union all select 2, count(*) from silver")
def q_table_version_history(s: Stages) -> DataFrame:
    # two versions of one table: the earlier stays readable, the later is current
    path = staging_path(s.spark, "versioned")
    publish(s.raw.select("transaction_id"), path)
    publish(s.silver.select("transaction_id"), path)
    assert current_version(s.spark, path) == 2
    counts = [read_table(s.spark, path, version=v).agg(F.lit(v).alias("version"),
                                                       F.count(F.lit(1)).alias("rows"))
              for v in versions(s.spark, path)]
    return counts[0].unionByName(counts[1])


@query("csv_export_roundtrip",
       f"select {_FEATS}, total_demand as actual_demand, rolling_7_day_avg as predicted_demand "
       "from test_rows")
def q_csv_export_roundtrip(s: Stages) -> DataFrame:
    avp = actual_vs_predicted(s.baseline(SCENARIO_CHALLENGER), s.test)
    path = write_csv(avp, staging_path(s.spark, "avp-csv"))
    return read_raw_csv(s.spark, path, avp.schema)


@query("feature_snapshot",
       "select count(*) as feature_rows, min(transaction_date) as feature_min_date, "
       "max(transaction_date) as feature_max_date, "
       "coalesce(sum(total_demand), 0) as feature_target_sum from feat")
def q_feature_snapshot(s: Stages) -> DataFrame:
    return s.features.agg(
        F.count(F.lit(1)).alias("feature_rows"),
        F.min("transaction_date").alias("feature_min_date"),
        F.max("transaction_date").alias("feature_max_date"),
        F.coalesce(exact_sum(F.col("total_demand")), F.lit(0.0)).alias("feature_target_sum"),
    )


# ---- projections, filters, cleaning -----------------------------------------

@query("feature_projection", f"select transaction_date, total_demand, {_FEATS} from feat")
def q_feature_projection(s: Stages) -> DataFrame:
    return s.features.select("transaction_date", "total_demand", *FEATURE_COLUMNS)


@query("parse_date",
       "select transaction_id, cast(try_strptime(transaction_date, '%Y-%m-%d') as date) "
       "as transaction_date from tx")
def q_parse_date(s: Stages) -> DataFrame:
    return parse_dates(s.raw.select("transaction_id", "transaction_date"))


@query("dedupe_by_key", "select * from dedup")
def q_dedupe_by_key(s: Stages) -> DataFrame:
    return s.deduped


@query("duplicate_summary",
       "select count(*) as total_rows, (select count(*) from (select distinct * from tx)) "
       "as distinct_rows, count(*) - (select count(*) from (select distinct * from tx)) "
       "as duplicate_rows from tx")
def q_duplicate_summary(s: Stages) -> DataFrame:
    return C.duplicate_summary(s.raw)


@query("invalid_date_count",
       "select count(*) filter (where try_strptime(transaction_date, '%Y-%m-%d') is null) "
       "as invalid_dates from dedup")
def q_invalid_date_count(s: Stages) -> DataFrame:
    return C.invalid_date_count(s.deduped)


@query("split_train",
       f"select transaction_date, total_demand, {_FEATS} from feat where transaction_date <= {CUT}")
def q_split_train(s: Stages) -> DataFrame:
    return s.train.select("transaction_date", "total_demand", *FEATURE_COLUMNS)


@query("split_test",
       f"select transaction_date, total_demand, {_FEATS} from feat where transaction_date > {CUT}")
def q_split_test(s: Stages) -> DataFrame:
    return s.test.select("transaction_date", "total_demand", *FEATURE_COLUMNS)


@query("split_counts",
       f"select count(*) filter (where transaction_date <= {CUT}) as train_rows, "
       f"count(*) filter (where transaction_date > {CUT}) as test_rows from feat")
def q_split_counts(s: Stages) -> DataFrame:
    return split_counts(s.features, s.cut)


@query("xy_projection", f"select {_FEATS}, total_demand from feat")
def q_xy_projection(s: Stages) -> DataFrame:
    return xy_projection(s.features)


@query("input_example",
       f"select {_FEATS} from feat where transaction_date <= {CUT} "
       f"order by {_KEYS} limit 5")
def q_input_example(s: Stages) -> DataFrame:
    # A head of the training rows is the feature here: order first, then limit.
    return s.train.orderBy(*KEY_COLUMNS).limit(5).select(*FEATURE_COLUMNS)


# ---- aggregates ---------------------------------------------------------------

@query("daily_agg", "select * from agg")
def q_daily_agg(s: Stages) -> DataFrame:
    return s.daily


@query("exact_cost",
       "select destination_city, round(sum(total_cost_usd * quality_score), 3) as quality_cost, "
       "count(*) as rows from tx group by destination_city")
def q_exact_cost(s: Stages) -> DataFrame:
    # fractional products: a plain sum would depend on the order of the rows
    return s.raw.groupBy("destination_city").agg(
        F.round(exact_sum(F.col("total_cost_usd") * F.col("quality_score")), 3).alias("quality_cost"),
        F.count(F.lit(1)).alias("rows"))


@query("series_extent", "select * from extent")
def q_series_extent(s: Stages) -> DataFrame:
    return series_extent(s.daily)


@query("date_range",
       "select min(transaction_date) as min_date, max(transaction_date) as max_date from silver")
def q_date_range(s: Stages) -> DataFrame:
    return date_range(s.silver)


@query("conservation_check",
       "select (select count(*) from silver) as silver_rows, "
       "(select cast(coalesce(sum(transaction_count), 0) as bigint) from agg) as total_transactions")
def q_conservation_check(s: Stages) -> DataFrame:
    # on the stored table, as the job does: the input is read once
    path = staging_path(s.spark, "silver")
    write_table(s.silver, path)
    silver = read_table(s.spark, path)
    return C.conservation_check(silver, daily_agg(silver))


@query("grain_check",
       "select count(*) as rows, (select count(*) from (select distinct transaction_date, "
       "product_name, destination_city from agg)) as distinct_keys from agg")
def q_grain_check(s: Stages) -> DataFrame:
    return C.grain_check(s.daily)


@query("silver_check",
       "select count(*) as rows, (select count(*) from (select distinct transaction_id from silver)) "
       "as distinct_ids, 'date' as date_type from silver")
def q_silver_check(s: Stages) -> DataFrame:
    return C.silver_check(s.silver)


# ---- time series ---------------------------------------------------------------

@query("date_spine", "select product_name, destination_city, transaction_date from spine")
def q_date_spine(s: Stages) -> DataFrame:
    return date_spine(s.daily)


@query("gapfill_days", "select * from full_days")
def q_gapfill_days(s: Stages) -> DataFrame:
    return gapfill_days(s.daily)


@query("gapfill_days_spread", "select * from full_days")
def q_gapfill_days_spread(s: Stages) -> DataFrame:
    # long gaps dealt over several tasks, for a filled table stored by itself
    return gapfill_days(s.daily, spread=True)


@query("gapfill_days_join", "select * from full_days")
def q_gapfill_days_join(s: Stages) -> DataFrame:
    return gapfill_days_join(s.daily)


@query("lag_features",
       "select transaction_date, product_name, destination_city, total_demand, avg_unit_price, "
       "total_inventory, transaction_count, demand_1, demand_7 from feat")
def q_lag_features(s: Stages) -> DataFrame:
    return lag_features(gapfill_days(s.daily))


@query("rolling_avg",
       "select transaction_date, product_name, destination_city, total_demand, avg_unit_price, "
       "total_inventory, transaction_count, rolling_7_day_avg from feat")
def q_rolling_avg(s: Stages) -> DataFrame:
    return rolling_mean(gapfill_days(s.daily))


@query("calendar_features",
       "select transaction_date, product_name, destination_city, month, day_of_week from feat")
def q_calendar_features(s: Stages) -> DataFrame:
    return calendar_features(gapfill_days(s.daily).select(*KEY_COLUMNS))


def _earlier_daily(daily: DataFrame) -> DataFrame:
    """A former state of the daily table: without the ECONOMY series, with other
    demand for PROMO, and with STANDARD series of a city that is gone since."""
    product = F.col("product_name")
    demand = F.when(product.startswith("PROMO"), F.col("total_demand") + 1)
    kept = daily.filter(~product.startswith("ECONOMY")).withColumn(
        "total_demand", F.coalesce(demand, F.col("total_demand")))
    gone = daily.filter(product.startswith("STANDARD")).withColumn("destination_city", F.lit("GONE"))
    return kept.unionByName(gone)


def _stored_daily(s: Stages) -> DataFrame:
    path = staging_path(s.spark, "daily")
    write_table(s.daily, path)
    return read_table(s.spark, path)


@query("features_refreshed", "select * from feat")
def q_features_refreshed(s: Stages) -> DataFrame:
    # built from the former state, then only what changed since: as a full rebuild
    daily, folder = _stored_daily(s), staging_path(s.spark, "refreshed")
    refresh_features(_earlier_daily(daily), folder, buckets=32)
    refresh_features(daily, folder)
    return read_features(s.spark, folder)


@query("changed_series",
       """select distinct product_name, case when k = 1 then 'GONE' else destination_city end as destination_city,
         product_name like 'ECONOMY%' as is_new, k = 1 as is_deleted
       from agg, (select 0 as k union all select 1) d
       where (k = 0 and (product_name like 'ECONOMY%' or product_name like 'PROMO%'))
         or (k = 1 and product_name like 'STANDARD%')""")
def q_changed_series(s: Stages) -> DataFrame:
    daily = _stored_daily(s)
    return changed_series(series_prints(daily), series_prints(_earlier_daily(daily)))


@query("feature_table", "select * from feat")
def q_feature_table(s: Stages) -> DataFrame:
    return s.features


# ---- contracts on the feature table ------------------------------------------

@query("feature_null_summary",
       "select count(*) filter (where demand_1 is null) as null_demand_1, "
       "count(*) filter (where demand_7 is null) as null_demand_7, "
       "count(*) filter (where rolling_7_day_avg is null) as null_rolling_7_day_avg from feat")
def q_feature_null_summary(s: Stages) -> DataFrame:
    return C.feature_null_summary(s.features)


@query("key_null_count",
       "select count(*) filter (where transaction_date is null or product_name is null "
       "or destination_city is null) as null_keys from feat")
def q_key_null_count(s: Stages) -> DataFrame:
    return C.key_null_count(s.features)


@query("missing_columns",
       f"select count(*) as rows, cast({len(NUMERIC_FEATURES)} - {_PRESENT} as int) "
       "as missing_columns from feat")
def q_missing_columns(s: Stages) -> DataFrame:
    return C.missing_columns_frame(s.features)


@query("feature_check",
       "select count(*) as rows, (select count(*) from (select distinct transaction_date, "
       "product_name, destination_city from feat)) as distinct_keys, "
       "count(*) filter (where transaction_date is null or product_name is null "
       "or destination_city is null) as null_keys, "
       "count(*) filter (where month is null or day_of_week is null) as null_calendar, "
       f"cast({len(NUMERIC_FEATURES)} - {_PRESENT} as int) as missing_columns, "
       "(select cast(coalesce(sum(demand_quantity), 0) as double) from silver) as total_demand, "
       "(select count(*) from silver) as total_transactions from feat")
def q_feature_check(s: Stages) -> DataFrame:
    return C.feature_check(s.features)


@query("key_contract",
       "select 'transaction_date,product_name,destination_city' as key_columns, count(*) as rows, "
       "(select count(*) from (select distinct transaction_date, product_name, destination_city "
       "from feat)) as distinct_keys, "
       "count(*) filter (where transaction_date is null) as null_transaction_date, "
       "count(*) filter (where product_name is null) as null_product_name, "
       "count(*) filter (where destination_city is null) as null_destination_city from feat")
def q_key_contract(s: Stages) -> DataFrame:
    return C.key_contract(C.declare_key(s.features))


# ---- scoring, metrics, model versions ----------------------------------------

# Decision of the oracle scenario, as SQL over the per-version metrics.
_DECISION = f"""
  select case when chal.r2 > champ.r2 + 0.0 then 'promoted' else 'kept champion' end as decision,
    case when chal.r2 > champ.r2 + 0.0 then '{SCENARIO_CHALLENGER}' else '{SCENARIO_CHAMPION}' end
      as champion_version,
    champ.r2 as champion_r2, chal.r2 as challenger_r2
  from metrics chal join metrics champ
    on chal.model_version = '{SCENARIO_CHALLENGER}' and champ.model_version = '{SCENARIO_CHAMPION}'
"""


def _rounded(df: DataFrame) -> DataFrame:
    """Metric columns with 6 digits, as the SQL prints them (decisions have
    been made on full precision)."""
    names = [c for c in ("r2", "rmse", "mae", "test_r2", "champion_r2", "challenger_r2")
             if c in df.columns]
    return df.withColumns({c: F.round(c, 6) for c in names})


def _scenario(s: Stages):
    metrics = metrics_by_version(s.predictions_long)
    versions = assign_versions(metrics, MODEL_NAME, SCENARIO_CHAMPION, SCENARIO_CHALLENGER)
    return metrics, versions


@query("prediction_table",
       f"select {_KEYS}, actual_demand, predicted_demand, model_version from preds "
       f"where model_version = '{SCENARIO_CHALLENGER}'")
def q_prediction_table(s: Stages) -> DataFrame:
    return s.predictions(SCENARIO_CHALLENGER)


@query("prediction_check",
       f"select count(*) as rows, count(*) filter (where predicted_demand is null "
       f"or isnan(predicted_demand)) as missing_predictions, "
       f"(select count(*) from (select distinct {_KEYS} from preds "
       f"where model_version = '{SCENARIO_CHALLENGER}')) as distinct_keys "
       f"from preds where model_version = '{SCENARIO_CHALLENGER}'")
def q_prediction_check(s: Stages) -> DataFrame:
    return C.prediction_check(s.predictions(SCENARIO_CHALLENGER))


@query("regression_metrics",
       f"select n, r2, rmse, mae from metrics where model_version = '{SCENARIO_CHALLENGER}'")
def q_regression_metrics(s: Stages) -> DataFrame:
    return _rounded(regression_metrics(s.predictions(SCENARIO_CHALLENGER)))


@query("r2_recheck", f"select r2 from metrics where model_version = '{SCENARIO_CHALLENGER}'")
def q_r2_recheck(s: Stages) -> DataFrame:
    path = staging_path(s.spark, "predictions")
    write_table(score(s.baseline(SCENARIO_CHALLENGER), s.test, SCENARIO_CHALLENGER,
                      with_timestamp=True), path)
    return _rounded(regression_metrics(read_table(s.spark, path)).select("r2"))


@query("actual_vs_predicted",
       f"select {_FEATS}, total_demand as actual_demand, rolling_7_day_avg as predicted_demand "
       "from test_rows")
def q_actual_vs_predicted(s: Stages) -> DataFrame:
    return actual_vs_predicted(s.baseline(SCENARIO_CHALLENGER), s.test)


@query("metrics_by_version", "select * from metrics")
def q_metrics_by_version(s: Stages) -> DataFrame:
    return _rounded(metrics_by_version(s.predictions_long))


@query("run_summary",
       f"""select m.model_version, f.feature_rows, f.feature_min_date, f.feature_max_date,
         f.feature_target_sum, {CUT} as train_end_date, f.train_rows, f.test_rows,
         m.r2, m.rmse, m.mae
       from metrics m join (
         select count(*) as feature_rows, min(transaction_date) as feature_min_date,
           max(transaction_date) as feature_max_date,
           coalesce(sum(total_demand), 0) as feature_target_sum,
           count(*) filter (where transaction_date <= {CUT}) as train_rows,
           count(*) filter (where transaction_date > {CUT}) as test_rows
         from feat) f on true""")
def q_run_summary(s: Stages) -> DataFrame:
    return _rounded(run_summary(s.features, s.predictions_long, s.cut))


@query("champion_challenger", _DECISION)
def q_champion_challenger(s: Stages) -> DataFrame:
    metrics, versions = _scenario(s)
    return _rounded(decide(metrics, versions, SCENARIO_CHALLENGER))


@query("promote_aliases",
       f"""select '{MODEL_NAME}' as model_name, m.model_version as version,
         case when m.model_version = d.champion_version then 'Champion'
              when d.decision = 'kept champion' and m.model_version = '{SCENARIO_CHALLENGER}'
                then 'Challenger'
              else null end as alias,
         m.r2 as test_r2
       from metrics m join ({_DECISION}) d on true""")
def q_promote_aliases(s: Stages) -> DataFrame:
    metrics, versions = _scenario(s)
    return _rounded(promote(metrics, versions, SCENARIO_CHALLENGER))


def _two_models(s: Stages) -> tuple[DataFrame, DataFrame]:
    """The scenario and a second model with the same version numbers, whose
    champion is its version 1."""
    metrics, versions = _scenario(s)
    other = versions.select(
        F.lit(OTHER_MODEL).alias("model_name"), "version",
        F.when(F.col("version") == SCENARIO_CHALLENGER, F.lit("Champion")).alias("alias"), "test_r2")
    return metrics, versions.unionByName(other)


@query("promote_aliases_two_models",
       f"""select '{MODEL_NAME}' as model_name, m.model_version as version,
         case when m.model_version = d.champion_version then 'Champion'
              when d.decision = 'kept champion' and m.model_version = '{SCENARIO_CHALLENGER}'
                then 'Challenger'
              else null end as alias,
         m.r2 as test_r2
       from metrics m join ({_DECISION}) d on true
       union all
       select '{OTHER_MODEL}', m.model_version,
         case when m.model_version = '{SCENARIO_CHALLENGER}' then 'Champion' else null end, m.r2
       from metrics m""")
def q_promote_aliases_two_models(s: Stages) -> DataFrame:
    metrics, versions = _two_models(s)
    return _rounded(promote(metrics, versions, SCENARIO_CHALLENGER, model_name=MODEL_NAME))


@query("champion_challenger_kept",
       f"""select 'kept champion' as decision, '{SCENARIO_CHALLENGER}' as champion_version,
         champ.r2 as champion_r2, chal.r2 as challenger_r2
       from metrics chal join metrics champ
         on chal.model_version = '{SCENARIO_CHAMPION}' and champ.model_version = '{SCENARIO_CHALLENGER}'
       where not chal.r2 > champ.r2 + 0.0""")
def q_champion_challenger_kept(s: Stages) -> DataFrame:
    # the roles swapped: the better version is the champion already
    metrics, _ = _scenario(s)
    versions = assign_versions(metrics, MODEL_NAME, SCENARIO_CHALLENGER, SCENARIO_CHAMPION)
    return _rounded(decide(metrics, versions, SCENARIO_CHAMPION))


@query("champion_challenger_first",
       f"""select 'promoted (first model)' as decision, '{SCENARIO_CHALLENGER}' as champion_version,
         cast(null as double) as champion_r2, r2 as challenger_r2
       from metrics where model_version = '{SCENARIO_CHALLENGER}'""")
def q_champion_challenger_first(s: Stages) -> DataFrame:
    metrics, _ = _scenario(s)
    versions = assign_versions(metrics, MODEL_NAME, None, SCENARIO_CHALLENGER)
    return _rounded(decide(metrics, versions, SCENARIO_CHALLENGER))


@query("champion_predictions",
       f"select p.* from preds p join ({_DECISION}) d on p.model_version = d.champion_version")
def q_champion_predictions(s: Stages) -> DataFrame:
    metrics, versions = _scenario(s)
    return champion_predictions(s.predictions_long,
                                promote(metrics, versions, SCENARIO_CHALLENGER))


@query("champion_from_stored_scores",
       f"select p.* from preds p join ({_DECISION}) d on p.model_version = d.champion_version")
def q_champion_from_stored_scores(s: Stages) -> DataFrame:
    # one stored table of all versions' predictions, as the job keeps it: metrics,
    # decision and the champion's rows read it; the other partitions are pruned
    path = overwrite_partitions(s.predictions_long, staging_path(s.spark, "scores"), ["model_version"])
    preds = read_partitions(s.spark, path, ["model_version"])
    metrics = metrics_by_version(preds)
    versions = assign_versions(metrics, MODEL_NAME, SCENARIO_CHAMPION, SCENARIO_CHALLENGER)
    return champion_predictions(preds, promote(metrics, versions, SCENARIO_CHALLENGER)).select(
        *PREDICTION_COLUMNS)


@query("plot_limits",
       "select least(min(total_demand), min(rolling_7_day_avg)) as lower, "
       "greatest(max(total_demand), max(rolling_7_day_avg)) as upper from test_rows")
def q_plot_limits(s: Stages) -> DataFrame:
    return plot_limits(actual_vs_predicted(s.baseline(SCENARIO_CHALLENGER), s.test))


@query("chart_grid",
       """select actual_cell, predicted_cell, count(*) as rows, lo + actual_cell * w as actual_from,
         lo + predicted_cell * w as predicted_from
       from (
         select cast(least(floor((a - lo) / w), 99) as int) as actual_cell,
           cast(least(floor((p - lo) / w), 99) as int) as predicted_cell, lo, w
         from (select total_demand as a, rolling_7_day_avg as p from test_rows
               where total_demand is not null and rolling_7_day_avg is not null) v,
           (select lo, (hi - lo) / 100 as w from (
              select least(min(total_demand), min(rolling_7_day_avg)) as lo,
                greatest(max(total_demand), max(rolling_7_day_avg)) as hi
              from test_rows where total_demand is not null and rolling_7_day_avg is not null)) l) c
       group by actual_cell, predicted_cell, lo, w""")
def q_chart_grid(s: Stages) -> DataFrame:
    return chart_grid(actual_vs_predicted(s.baseline(SCENARIO_CHALLENGER), s.test))


# ---- the distributed model (no SQL equivalent: rows-only) ----------------------

_STATS_OF = """
  select '{c}' as feature, cast({c} as varchar) as category, transaction_date,
    count(total_demand) as n, sum(total_demand) as s
  from feat where transaction_date <= {cut} group by 2, 3"""


@query("category_target_stats",
       f"""select c.feature, c.category, c.transaction_date,
         coalesce(sum(c.n) over w, 0)::bigint as earlier_rows,
         coalesce(sum(c.s) over w, 0.0)::double as earlier_sum, p.prior,
         (coalesce(sum(c.s) over w, 0.0) + {PRIOR_WEIGHT} * p.prior)
           / (coalesce(sum(c.n) over w, 0) + {PRIOR_WEIGHT}) as encoded
       from ({" union all ".join(_STATS_OF.format(c=c, cut=CUT) for c in CATEGORICAL_FEATURES)}) c
       join (
         select transaction_date, sum(s) over d / sum(n) over d as prior from (
           select transaction_date, sum(total_demand) as s, count(total_demand) as n
           from feat where transaction_date <= {CUT} group by 1)
         window d as (order by transaction_date rows between unbounded preceding and 1 preceding)
       ) p on p.transaction_date = c.transaction_date
       window w as (partition by c.feature, c.category order by c.transaction_date
         rows between unbounded preceding and 1 preceding)""")
def q_category_target_stats(s: Stages) -> DataFrame:
    return category_target_stats(s.train)


@query("gbt_check",
       f"select count(*) as rows, cast(0 as bigint) as missing_predictions, "
       f"(select count(*) from (select distinct {_KEYS} from test_rows)) as distinct_keys "
       "from test_rows")
def q_gbt_check(s: Stages) -> DataFrame:
    return C.prediction_check(score(s.gbt(), s.model_split[1], "gbt"))


@query("feature_importance_check",
       f"select cast({len(FEATURE_COLUMNS)} as bigint) as features, "
       f"cast({len(FEATURE_COLUMNS)} as bigint) as distinct_features, "
       "cast(1.0 as double) as total_importance, true as in_range")
def q_feature_importance_check(s: Stages) -> DataFrame:
    return importance_check(feature_importance(s.gbt()))


@query("gbt_predictions")
def q_gbt_predictions(s: Stages) -> DataFrame:
    return score(s.gbt(), s.model_split[1], "gbt")


@query("feature_importance")
def q_feature_importance(s: Stages) -> DataFrame:
    return feature_importance(s.gbt())
