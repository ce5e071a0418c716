"""Print a markdown table of the physical plan shape of every query.

    python plan_report.py [sf_dir] > PLANS.md

Counts come from the static plan (AQE off, so the table does not depend on
runtime sizes; at runtime AQE can only turn shuffle joins into broadcast
joins and merge small partitions). The join strategy counted here is the
one Spark picks at the given scale factor's file sizes.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

from daybook.plans.catalog import ORACLE, QUERIES
from daybook.session import build_session


def physical(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def shape(text: str) -> dict:
    head = text.split("\n\n")[0]
    return {
        "shuffles": len(re.findall(r"(?<![A-Za-z])Exchange \(", head)),
        "reused": len(re.findall(r"ReusedExchange \(", head)),
        "broadcasts": len(re.findall(r"BroadcastExchange", head)),
        "smj": len(re.findall(r"SortMergeJoin", head)),
        "bhj": len(re.findall(r"BroadcastHashJoin", head)),
        "hash_agg": len(re.findall(r"HashAggregate", head)),
        "sort_agg": len(re.findall(r"SortAggregate", head)),
        "windows": len(re.findall(r"Window \(", head)),
        "python": "yes" if re.search(r"Python|ArrowEval|BatchEval", head) else "no",
        "pushed": sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", text))),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", "daybook-plans", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    print(f"# Plan shapes ({sf_dir}, static plans, AQE off)\n")
    print("| query | shuffles | reused | broadcasts | SMJ | BHJ | hash agg | sort agg | windows | Python | oracle |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    skip = {"gbt_predictions", "gbt_check", "feature_importance", "feature_importance_check"}  # their plans include a fit
    for name, fn in QUERIES.items():
        if name in skip:
            continue
        s = shape(physical(fn(spark, sf_dir)))
        print(f"| {name} | {s['shuffles']} | {s['reused']} | {s['broadcasts']} | {s['smj']} | {s['bhj']} | "
              f"{s['hash_agg']} | {s['sort_agg']} | {s['windows']} | {s['python']} | "
              f"{'SQL' if name in ORACLE else 'rows'} |")
    spark.stop()


if __name__ == "__main__":
    main()
