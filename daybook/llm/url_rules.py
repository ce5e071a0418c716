"""URL filters: a broadcast trie over reversed host labels and path segments.

A rule is a host with a path ("example.net/en/") and an action. It fits its
host and all subdomains if the URL's path starts with the rule's path; of the
rules that fit, the longest wins (most host labels, then the longest path).
Where one entry both allows and blocks, it blocks. URLs without a rule get the
default verdict.

Defined results: a NULL URL or one without "://" has an empty host and path,
which no rule fits; ports and user names are part of the host as written;
repeated rows are judged row by row; an empty table gives no rows; without
rules every URL gets the default. Texts of any length are walked once. Other
columns may have any names. A rule list beyond ``MAX_RULE_BYTES`` isn't
broadcast: the URLs' host suffixes are joined with the rules instead.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import ship_package

MAX_RULE_BYTES = 8 << 20
ALLOW, BLOCK = "allow", "block"
Rule = tuple[str, str, str]  # host, path, action

_HERE, _PATH = "\x00here", "\x00path"  # no host label or segment holds a NUL


def split_rule(rule: str, action: str) -> Rule:
    host, slash, path = rule.partition("/")
    return host.lower(), slash + path, action


def build_trie(rules: Sequence[Rule]) -> dict:
    """Nested dicts: host labels from the last one, then path segments. The
    last segment of a rule is a prefix and is kept apart, in a dict of
    prefixes, under the node of the segments before it."""
    top: dict = {}
    for host, path, action in rules:
        node = top
        for label in reversed(host.split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(_PATH, {})
        *segments, rest = path.split("/")
        for segment in segments:
            node = node.setdefault(segment, {})
        entry = node.setdefault(_HERE, {})
        if entry.get(rest, (None, None))[1] != BLOCK:
            entry[rest] = (host + path, action)
    return top


def _best_path(node: dict, path: str) -> tuple[str, str] | None:
    best = None
    segments = path.split("/")
    for i, segment in enumerate(segments):
        entry = node.get(_HERE)
        if entry:
            fits = [r for r in entry if segment.startswith(r)]
            if fits:
                best = entry[max(fits, key=len)]
        if i + 1 == len(segments):
            break
        node = node.get(segment)
        if node is None:
            break
    return best


def match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, action) of the longest rule that fits, if any."""
    best, node = None, trie
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        if _PATH in node:
            best = _best_path(node[_PATH], path) or best
    return best


def url_parts(url_col: str = "url") -> tuple:
    """Host and path as columns."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def _judge_by_join(parts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The same by a join of host suffixes with the rules (for long lists)."""
    spark = parts.sparkSession
    table = (spark.createDataFrame(list(rules), "_rule_host string, _rule_path string, _action string")
             .groupBy("_rule_host", "_rule_path")
             .agg(F.max(F.col("_action") == BLOCK).alias("_block")))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keyed = parts.withColumn("_row", F.struct("page_id", "url"))
    found = (keyed.select("_row", "path", F.explode(F.array_distinct(suffixes)).alias("_rule_host"))
             .join(table, "_rule_host").filter(F.startswith("path", "_rule_path")))
    rank = F.struct(F.size(F.split("_rule_host", r"\.")), F.length("_rule_path"))
    best = found.groupBy("_row").agg(F.max_by(
        F.struct(F.concat("_rule_host", "_rule_path").alias("rule"),
                 F.when(F.col("_block"), BLOCK).otherwise(ALLOW).alias("action")), rank).alias("_best"))
    best = best.withColumnRenamed("_row", "_best_row")
    return keyed.join(best, keyed["_row"].eqNullSafe(best["_best_row"]), "left").select(
        "page_id", "host", "path", F.col("_best.rule").alias("rule"),
        F.col("_best.action").alias("verdict"))


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = ALLOW, id_col: str = "page_id",
          url_col: str = "url", max_rule_bytes: int = MAX_RULE_BYTES) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    host, path = url_parts(url_col)
    parts = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         host.alias("host"), path.alias("path"))
    if sum(len(h) + len(p) for h, p, _ in rules) > max_rule_bytes:
        judged = _judge_by_join(parts, rules)
    else:
        spark = pages.sparkSession
        ship_package(spark)
        trie = spark.sparkContext.broadcast(build_trie(rules))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = [match(trie.value, h, p) or (None, None)
                         for h, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array([r for r, _ in found], pa.string()),
                     pa.array([v for _, v in found], pa.string())],
                    names=["page_id", "host", "path", "rule", "verdict"])

        kind = parts.schema["page_id"].dataType.simpleString()
        judged = parts.drop("url").mapInArrow(
            run, f"page_id {kind}, host string, path string, rule string, verdict string")
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
