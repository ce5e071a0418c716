"""Plan shape: pushdown, pruning, exchange counts, partial aggregation, no
Python in the plans. These are the properties that matter at scale."""

from __future__ import annotations

import contextlib
import io
import os
import re
import tempfile

from daybook.config import FIXTURE_CUT_DATE
from daybook.functions.metrics import regression_metrics
from daybook.operators.aggregate import daily_agg
from daybook.operators.clean import dedupe_by_key
from daybook.operators.model import split_by_date
from daybook.operators.timeseries import build_features
from daybook.plans.stages import Stages
from daybook.sources.files import read_table, write_table


def plan(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def exchanges(text: str) -> list[str]:
    return re.findall(r"hashpartitioning\(([^)]*)\)", text)


def stored(spark, df, name):
    path = os.path.join(tempfile.mkdtemp(prefix=f"daybook-{name}-"), name)
    write_table(df, path)
    return read_table(spark, path)


def test_split_filter_reaches_scan(spark, sf_small):
    feats = stored(spark, Stages(spark, sf_small).features, "features")
    _, test = split_by_date(feats, FIXTURE_CUT_DATE)
    text = plan(test.select("transaction_date", "total_demand"))
    assert re.search(r"PushedFilters: \[IsNotNull\(transaction_date\), "
                     r"GreaterThan\(transaction_date,2000-06-30\)\]", text), text
    # only the two selected columns are read
    assert "ReadSchema: struct<transaction_date:date,total_demand:double>" in text


def test_daily_agg_prunes_the_scan(spark, sf_small):
    silver = stored(spark, Stages(spark, sf_small).silver, "silver")
    text = plan(daily_agg(silver))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    cols = {c.split(":")[0] for c in schema.split(",")}
    assert cols == {"transaction_date", "product_name", "destination_city", "demand_quantity",
                    "unit_price_usd", "available_inventory"}
    # partial aggregate before the one exchange
    assert text.count("HashAggregate") >= 2 and len(exchanges(text)) == 1


def test_features_need_one_exchange(spark, sf_small):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        daily = stored(spark, Stages(spark, sf_small).daily, "daily")
        text = plan(build_features(daily))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    ex = exchanges(text)
    assert len(ex) == 1 and "product_name" in ex[0] and "destination_city" in ex[0]
    assert "transaction_date" not in ex[0]
    assert "Join" not in text


def test_dedupe_combines_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("cast(id % 3 as string) as k", "id as v")
    text = plan(dedupe_by_key(df, "k"))
    # partial min per map task, then the exchange on the key, then the final min
    first_partial = text.find("partial_min")
    exchange = text.find("hashpartitioning(k")
    assert first_partial != -1 and exchange != -1
    assert len(exchanges(text)) == 1


def test_metrics_one_grouped_pass(spark):
    df = spark.range(100).selectExpr("cast(id % 2 as string) as model_version",
                                     "cast(id as double) as actual_demand",
                                     "cast(id + 1 as double) as predicted_demand")
    text = plan(regression_metrics(df, group_by=["model_version"]))
    assert len(exchanges(text)) == 1 and "partial_" in text


def test_no_python_in_any_oracle_checked_plan(spark, sf_small):
    import __spark_entry__ as E
    for name in ["feature_table", "metrics_by_version", "duplicate_summary", "key_contract",
                 "prediction_table", "gapfill_days_join"]:
        text = plan(E.queries()[name](spark, sf_small), "extended")
        assert "EvalPython" not in text and "PythonUDF" not in text, name


def test_stored_scores_are_pruned_to_the_champion(spark, sf_small):
    from daybook.plans.catalog import QUERIES
    plan = QUERIES["champion_from_stored_scores"](spark, sf_small)._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan
