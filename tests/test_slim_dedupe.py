"""Survivors without the columns that nobody reads; a feature table stored once."""

from __future__ import annotations

from daybook.operators.clean import dedupe_by_key
from daybook.plans.stages import Stages
from tests.test_plans import plan


def test_dedupe_of_some_columns(spark):
    rows = [("a", 2, None, "x", 1), ("a", 1, "q", "z", 2), ("a", 1, "p", "y", 3), ("a", 1, "p", "x", 4),
            (None, 5, None, "u", 5), (None, 5, "m", "t", 6), ("b", None, "r", None, 7)]
    df = spark.createDataFrame(rows, "id string, n int, s string, t string, last int")
    whole = dedupe_by_key(df, "id")
    for cols in (["id", "n"], ["s", "id"], ["id", "n", "t"], ["t"], ["id"]):
        assert (sorted(map(repr, dedupe_by_key(df, "id", columns=cols).collect()))
                == sorted(map(repr, whole.select(*cols).collect())))
    ordered = dedupe_by_key(df, "id", order_by=["t"])
    assert (sorted(map(repr, dedupe_by_key(df, "id", ["t"], ["id", "s"]).collect()))
            == sorted(map(repr, ordered.select("id", "s").collect())))


def test_daily_carries_no_column_behind_the_last_one_read(spark, sf_small):
    text = plan(Stages(spark, sf_small).daily)
    assert "l_shipdate" in text and "l_tax" not in text and "o_orderstatus" not in text


def test_fit_and_scores_read_one_stored_feature_table(spark, sf_small):
    s = Stages(spark, sf_small)
    train, test = s.model_split
    for part, whole in ((train, s.train), (test, s.test)):
        assert all("/features-" in f for f in part.inputFiles())
        assert part.exceptAll(whole).isEmpty() and whole.exceptAll(part).isEmpty()
