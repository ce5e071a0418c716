"""Exact dedup: groups by a 128-bit content hash, bytes compared inside the
groups, in DataFrame functions.

1. Every row becomes (id, number, MD5 of its text), without its text; the
   rows are grouped by the hash, pre-aggregated in the map tasks.
2. Texts are read again only where a hash stands for two rows or more, and
   grouped by hash and bytes: copies become one row in their own map task, so
   a group that holds a third of all rows is compared without being gathered.
3. A hash with one text is a class of its rows. A hash with several texts (a
   collision) is divided by its bytes, which go along as part of the key.

Rows meet their class by a join on the hash. Classes with more than
1 / ``HOT_CLASSES`` of the rows, of which there can't be more than that number, are
broadcast; all others are small beside a partition.

Defined results: NULL texts equal empty ones; texts are equal when their UTF-8
bytes are; of equal texts one row stays, the one with the smallest id (or the
largest, a parameter), a NULL id only when there's no other; of rows that repeat
id and text too exactly one stays; an empty table gives no rows; texts of any
length are compared whole. Other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import stored

SMALLEST, LARGEST = "smallest", "largest"
#: Classes that can be broadcast: those with more than 1 / HOT_CLASSES of all rows.
HOT_CLASSES = 1 << 16
#: Buckets of hashes that keep most single texts out of the comparison.
BUCKETS = 1 << 18


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def _bucket(h: Column) -> Column:
    return F.pmod(F.xxhash64(h), F.lit(BUCKETS).cast("long"))


def _best(keep: str) -> Column:
    """The row that stays, as (id, number): a NULL id loses against any other."""
    row = F.struct(F.col("_id").isNotNull().alias("known"), F.col("_id").alias("id"),
                   F.col("_turn").alias("turn"))
    if keep == LARGEST:
        return F.max(row)
    return F.min(F.struct(F.col("_id").isNull().alias("unknown"), F.col("_id").alias("id"),
                          F.col("_turn").alias("turn")))


def _classes(rows: DataFrame, keys: list[str], keep: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), _best(keep).alias("_best")).select(
        *keys, "_n", F.col("_best.id").alias("_keep_id"), F.col("_best.turn").alias("_keep_turn"))


def dedup(docs: DataFrame, keep: str = SMALLEST, id_col: str = "doc_id", text_col: str = "text",
          hash_of=content_hash) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, content_hash of every row."""
    if keep not in (SMALLEST, LARGEST):
        raise ValueError(f"keep: {keep}")
    texts = docs.select(F.col(id_col).cast("long").alias("_id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    texts = texts.withColumn("_hash", hash_of(F.col("_text")))
    sha = F.unhex(F.sha2(F.encode("_text", "UTF-8"), 256)).alias("_sha")
    rows = stored(texts.select("_id", "_hash", sha, F.monotonically_increasing_id().alias("_turn")))

    shared = stored(_classes(rows, ["_hash"], keep).filter("_n > 1"))
    collided = _collided(texts, shared)
    whole = shared.join(collided, "_hash", "left_anti") if collided is not None else shared
    singles = rows
    parts = []
    if collided is not None:
        singles = rows.join(collided, "_hash", "left_anti")
        held = stored(texts.join(collided, "_hash", "left_semi")
                      .withColumns({"_sha": sha, "_turn": F.monotonically_increasing_id()}))
        # exact for any number of collisions; a hot text among them is left to
        # the adaptive split of skewed joins
        parts.append(held.join(_classes(held, ["_hash", "_text"], keep), ["_hash", "_text"])
                     .drop("_text"))
    parts.append(_joined(singles, whole))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    single = F.col("_n").isNull()
    return out.select(
        F.col("_id").alias("doc_id"),
        F.when(single, F.col("_id")).otherwise(F.col("_keep_id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("_turn") == F.col("_keep_turn"))).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
        F.lower(F.hex("_hash")).alias("content_hash"))


def _collided(texts: DataFrame, shared: DataFrame) -> DataFrame | None:
    """The hashes that stand for more than one text, by comparing the bytes of
    all texts of shared hashes; None if there are none."""
    # at most BUCKETS rows: a proven bound for the broadcast
    marked = F.broadcast(shared.select(_bucket(F.col("_hash")).alias("_bucket")).distinct())
    near = texts.withColumn("_bucket", _bucket(F.col("_hash"))).join(marked, "_bucket", "left_semi")
    different = near.select("_hash", "_text").distinct()
    found = stored(different.groupBy("_hash").agg(F.count(F.lit(1)).alias("_texts"))
                   .filter("_texts > 1").select("_hash"))
    return None if found.isEmpty() else found


def _joined(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows with the class of their hash (NULL columns for a hash of one row)."""
    hot_rows = F.col("_n") * HOT_CLASSES > F.lit(rows.count())
    hot = classes.filter(hot_rows)
    of_hot = rows.join(F.broadcast(hot), "_hash")
    others = rows.join(F.broadcast(hot.select("_hash")), "_hash", "left_anti")
    return of_hot.unionByName(others.join(classes.filter(~hot_rows), "_hash", "left"))


def kept_documents(docs: DataFrame, keep: str = SMALLEST, id_col: str = "doc_id") -> DataFrame:
    """The documents that stay, with all their columns. Ids must be unique."""
    ids = dedup(docs, keep, id_col).filter("kept").select(F.col("doc_id").alias("_kept_id"))
    return docs.join(ids, docs[id_col].cast("long").eqNullSafe(ids["_kept_id"]), "left_semi")
