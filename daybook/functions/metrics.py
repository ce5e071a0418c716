"""Regression metrics as one aggregation, for any number of groups, the same for
any order of rows.

R² = 1 − SSE/SST. All sums are exact (:mod:`exact`), so a promotion, a strict
comparison of R², does not hang on how the rows were partitioned. SST comes from
the same pass, n · SST = n · Σy² − (Σy)²: the squares' roundings are summed too, and
the difference is taken with about twice a double's digits, so nothing cancels that
the labels' own digits hold. With a label of 2^41 (2.2e12) or more it is the
mergeable variance of Spark instead, as exact digits end at 2^83. When
SST = 0 the result is 1.0 if SSE = 0 else 0.0 (the documented convention of
common metric libraries), instead of a division by zero. Rows with a NULL
or NaN label or prediction are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.exact import exact_parts, exact_sum, let, square_parts


def _valid(label: str, prediction: str) -> F.Column:
    return (F.col(label).isNotNull() & F.col(prediction).isNotNull()
            & ~F.isnan(F.col(label)) & ~F.isnan(F.col(prediction)))


def regression_metrics(df: DataFrame, label: str = "actual_demand",
                       prediction: str = "predicted_demand",
                       group_by: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """One row per group: n, r2, rmse, mae, in full precision unless ``digits``
    is given (for display; decisions are made on full doubles)."""
    y = F.col(label).cast("double")
    p = F.col(prediction).cast("double")
    inside = F.abs(y) < F.lit(2.0 ** 41)
    square, rounding = square_parts(F.when(inside, y))
    sums = (
        df.filter(_valid(label, prediction))
        .groupBy(*group_by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            exact_sum((y - p) * (y - p)).alias("_sse"),
            exact_sum(F.abs(y - p)).alias("_sae"),
            exact_parts(F.when(inside, y)).alias("_s"),
            exact_parts(square).alias("_q"),
            exact_sum(rounding).alias("_e"),
            F.when(F.count_if(~inside) > 0, F.var_pop(y) * F.count(F.lit(1))).alias("_wide"),
        )
    )
    sums = sums.withColumn("_sst", F.coalesce("_wide", _spread()))
    n = F.col("n").cast("double")
    sse = F.col("_sse")
    sst = F.col("_sst")
    r2 = (F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - sse / F.when(sst != 0, sst)))
    rmse = F.sqrt(sse / n)
    mae = F.col("_sae") / n

    def rnd(c: F.Column) -> F.Column:
        return F.round(c, digits) if digits is not None else c

    return sums.select(*group_by, "n", rnd(r2).alias("r2"), rnd(rmse).alias("rmse"),
                       rnd(mae).alias("mae"))


def _spread() -> F.Column:
    """Σy² − (Σy)²/n from the parts: the products n·Σy² and (Σy)² as a double and
    its remainder each, whose doubles differ exactly where they nearly cancel."""
    def halves(x: F.Column) -> tuple[F.Column, F.Column]:
        c = x * F.lit(134217729.0)
        return c - (c - x), x - (c - (c - x))

    def spread(g: F.Column) -> F.Column:
        n, s, q = g["n"], g["s"], g["q"]
        (n1, n2), (q1, q2) = halves(n), halves(q["high"])
        product = n * q["high"]
        left = ((n1 * q1 - product) + n1 * q2 + n2 * q1) + n2 * q2
        square, right = square_parts(s["high"])
        small = left - right + n * (q["low"] + g["e"]) - F.lit(2.0) * s["high"] * s["low"]
        return F.greatest(((product - square) + small) / n, F.lit(0.0))

    return let(F.struct(F.col("n").cast("double").alias("n"), F.col("_s").alias("s"),
                        F.col("_q").alias("q"), F.col("_e").alias("e")), spread)


def missing_count(col: str) -> F.Column:
    """Rows whose value is NULL or NaN."""
    c = F.col(col)
    return F.count_if(c.isNull() | F.isnan(c))
