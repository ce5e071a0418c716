"""Column names, the raw schema and defaults, kept in one place.

Every function in the library takes column names as parameters; the
values below are only the defaults, so other tables (e.g. events per day
and type) work through the same operators.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# --- Fixed values: these must equal the reference job's for equal results ---
# Raw transaction schema: 33 nullable fields, in file order.
RAW_FIELDS: list[tuple[str, str]] = [
    ("transaction_id", "string"),
    ("transaction_date", "string"),
    ("transaction_year", "int"),
    ("transaction_quarter", "int"),
    ("transaction_month", "int"),
    ("product_name", "string"),
    ("product_category", "string"),
    ("quantity_unit", "string"),
    ("supplier_name", "string"),
    ("supplier_country", "string"),
    ("supplier_reliability_score", "double"),
    ("refinery_name", "string"),
    ("destination_city", "string"),
    ("transportation_mode", "string"),
    ("ordered_quantity", "double"),
    ("demand_quantity", "double"),
    ("available_inventory", "double"),
    ("unit_price_usd", "double"),
    ("product_cost_usd", "double"),
    ("transportation_cost_usd", "double"),
    ("total_cost_usd", "double"),
    ("expected_lead_time_days", "int"),
    ("actual_lead_time_days", "int"),
    ("delay_days", "int"),
    ("is_delayed", "int"),
    ("is_stockout", "int"),
    ("quality_status", "string"),
    ("quality_score", "double"),
    ("disruption_type", "string"),
    ("delivery_status", "string"),
    ("ingestion_timestamp", "string"),
    ("source_system", "string"),
    ("operation_type", "string"),
]
# Date text format of the raw file.
DATE_FORMAT = "yyyy-MM-dd"
# Feature columns: numeric first, then categorical (this order is the model input order).
NUMERIC_FEATURES = ["demand_1", "demand_7", "rolling_7_day_avg", "month", "day_of_week"]
CATEGORICAL_FEATURES = ["product_name", "destination_city"]
# Model settings of the reference trainer.
MODEL_PARAMS = {"iterations": 500, "learning_rate": 0.05, "depth": 6, "random_seed": 42}
CHAMPION_ALIAS = "Champion"
CHALLENGER_ALIAS = "Challenger"
MIN_IMPROVEMENT = 0.0
# Decision labels of the promotion step.
DECISION_FIRST = "promoted (first model)"
DECISION_PROMOTED = "promoted"
DECISION_KEPT = "kept champion"
# --- end of fixed values ---

_TYPES = {"string": StringType(), "int": IntegerType(), "double": DoubleType()}

RAW_SCHEMA = StructType([StructField(n, _TYPES[t], True) for n, t in RAW_FIELDS])
RAW_COLUMNS = [n for n, _ in RAW_FIELDS]

ID_COL = "transaction_id"
DATE_COL = "transaction_date"
PRODUCT_COL = "product_name"
CITY_COL = "destination_city"
SERIES_KEYS = [PRODUCT_COL, CITY_COL]
KEY_COLUMNS = [DATE_COL, PRODUCT_COL, CITY_COL]
TARGET_COL = "total_demand"
FEATURE_COLUMNS = NUMERIC_FEATURES + CATEGORICAL_FEATURES

# Daily measures: output name -> (aggregate, input column).
DAILY_MEASURES = {
    "total_demand": ("sum", "demand_quantity"),
    "avg_unit_price": ("avg", "unit_price_usd"),
    "total_inventory": ("sum", "available_inventory"),
    "transaction_count": ("count", None),
}
# Measures that become 0 on a filled (missing) day; the others stay NULL.
ZERO_FILLED = ["total_demand", "transaction_count"]

# Cut date used with the test tables (about 80 % of rows on or before it).
FIXTURE_CUT_DATE = "2000-06-30"
