"""Adapter from the star-schema test tables to raw 33-column transactions.

Each line item becomes one transaction: the product is the part type, the
destination city is the customer's region, demand is the quantity. The
mapping per field is listed in FIXTURES.md. Only inner equi-joins on the
tables' keys. No broadcast hints: Spark broadcasts a side only when its
size estimate (and, after a shuffle, AQE's measured size) is below the
threshold, and keeps a shuffle join otherwise, so the plan stays valid
when every table is large.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.config import RAW_COLUMNS

# Schemas of the test tables, given to the reader so that no schema
# inference job runs per table and a changed file fails loudly.
STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}
STAR_TABLES = list(STAR_SCHEMAS)


def read_star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(STAR_SCHEMAS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def transactions_from_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions (all 33 fields, dates as text) from the test tables."""
    t = {name: read_star(spark, sf_dir, name) for name in STAR_TABLES}

    # nation -> region name (customer side) and nation name (supplier side)
    geo = (
        t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_nationkey").alias("geo_nationkey"), "r_name")
    )
    supplier_country = t["nation"].select(F.col("n_nationkey").alias("sn_nationkey"),
                                          F.col("n_name").alias("sn_name"))

    customers = (
        t["customer"].select("c_custkey", "c_nationkey", "c_mktsegment")
        .join(geo, F.col("c_nationkey") == F.col("geo_nationkey"))
    )
    orders = (
        t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                           "o_orderpriority")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
    )
    suppliers = (
        t["supplier"].select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
        .join(supplier_country, F.col("s_nationkey") == F.col("sn_nationkey"))
    )
    parts = t["part"].select("p_partkey", "p_type", "p_brand", "p_size", "p_retailprice")

    joined = (
        t["lineitem"]
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    )

    ship = F.col("l_shipdate")
    lead_days = F.datediff(F.to_date(ship), F.to_date(F.col("o_orderdate")))
    delay = F.greatest(lead_days - F.lit(30), F.lit(0))
    out = joined.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.date_format(ship, "yyyy-MM-dd").alias("transaction_date"),
        F.year(ship).cast("int").alias("transaction_year"),
        F.quarter(ship).cast("int").alias("transaction_quarter"),
        F.month(ship).cast("int").alias("transaction_month"),
        F.col("p_type").alias("product_name"),
        F.col("p_brand").alias("product_category"),
        F.lit("EA").alias("quantity_unit"),
        F.col("s_name").alias("supplier_name"),
        F.col("sn_name").alias("supplier_country"),
        F.col("s_acctbal").alias("supplier_reliability_score"),
        F.concat(F.lit("REFINERY_"), F.col("s_nationkey").cast("string")).alias("refinery_name"),
        F.col("r_name").alias("destination_city"),
        F.col("o_orderpriority").alias("transportation_mode"),
        F.col("l_quantity").alias("ordered_quantity"),
        F.col("l_quantity").alias("demand_quantity"),
        F.col("p_size").cast("double").alias("available_inventory"),
        F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("double").alias("unit_price_usd"),
        F.col("p_retailprice").alias("product_cost_usd"),
        F.col("l_tax").alias("transportation_cost_usd"),
        F.col("l_extendedprice").alias("total_cost_usd"),
        F.lit(30).cast("int").alias("expected_lead_time_days"),
        lead_days.cast("int").alias("actual_lead_time_days"),
        delay.cast("int").alias("delay_days"),
        F.when(delay > 0, 1).otherwise(0).cast("int").alias("is_delayed"),
        F.when(F.col("l_quantity") > F.col("p_size"), 1).otherwise(0).cast("int").alias("is_stockout"),
        F.col("l_returnflag").alias("quality_status"),
        F.col("l_discount").alias("quality_score"),
        F.col("l_linestatus").alias("disruption_type"),
        F.col("o_orderstatus").alias("delivery_status"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("ingestion_timestamp"),
        F.col("c_mktsegment").alias("source_system"),
        F.lit("INSERT").alias("operation_type"),
    )
    assert out.columns == RAW_COLUMNS
    return out
