"""Chart data from rows that are made once."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.operators.scoring import chart_grid


def test_chart_grid_makes_its_rows_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        made.add(1)
        return x

    rows = [(float(i), float(i % 7)) for i in range(50)] + [(None, 1.0), (2.0, float("nan"))]
    df = spark.createDataFrame(rows, "actual_demand double, p double")
    grid = chart_grid(df.select("actual_demand", seen("p").alias("predicted_demand")).repartition(2), 5)
    made_before = made.value
    assert sum(r["rows"] for r in grid.collect()) == 50
    assert made.value == made_before  # the result reads stored pairs
