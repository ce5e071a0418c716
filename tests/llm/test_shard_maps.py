"""Slot maps as versioned tables; hot slots by rows."""

from __future__ import annotations

import collections
import os
import tempfile

from daybook.llm import shards
from daybook.sources.versions import version_path, versions
from tests.llm.test_operators import table


def test_a_slot_that_is_hot_by_rows_alone_is_split(spark):
    rows = [(None, None)] * 6000 + [(i, "long text " * 300) for i in range(400)]
    out = shards.shard(table(spark, rows)).collect()
    sizes = collections.Counter((r.virtual_slot, r.part) for r in out)
    hot = max(sizes, key=sizes.get)[0]
    parts = [n for (s, _), n in sizes.items() if s == hot]
    assert sum(parts) >= 6000 and len(parts) > 500 and max(parts) <= 30
    by = collections.defaultdict(list)
    for r in out:
        by[r.shard].append(r)
    assert all(sorted(r.slot for r in p) == list(range(len(p))) for p in by.values()) and len(out) == len(rows)


def test_parts_are_bounded():
    slots = 4096
    for loads in ([(0, 10**12, 10**9)] + [(i, 1, 1) for i in range(1, slots)],
                  [(i, 900 if i < 300 else 1, 900 if i >= 3800 else 10) for i in range(slots)]):
        parts = shards.parts_of_slots(loads, slots)
        assert parts and sum(parts.values()) <= slots * 3 // 4 and min(parts.values()) >= 2
    assert shards.parts_of_slots([], slots) == {}


def test_a_second_run_reads_and_edits_the_map(spark):
    docs = table(spark, [(i, "word " * (i % 50)) for i in range(3000)])
    folder = os.path.join(tempfile.mkdtemp(prefix="daybook-maps-"), "maps")
    first = {r.doc_id: r for r in shards.shard(docs, 16, folder=folder).collect()}
    again = {r.doc_id: r for r in shards.shard(docs, 16, folder=folder).collect()}
    moved = sum(first[i].size for i in first if first[i].shard != again[i].shard)
    total = sum(r.size for r in first.values())
    assert moved / total < 0.02  # only what lies above the mean
    grown = {r.doc_id: r for r in shards.shard(docs, 17, folder=folder).collect()}
    moved = sum(again[i].size for i in first if again[i].shard != grown[i].shard)
    assert 0.02 < moved / total < 0.12
    assert {r.shard for r in grown.values()} == set(range(17))
    assert all(first[i].virtual_slot == grown[i].virtual_slot for i in first)
    assert versions(spark, folder) == [1, 2, 3]  # every version stays readable
    old = spark.read.parquet(version_path(folder, 1))
    assert {(r.virtual_slot, r.shard) for r in old.collect()} == {(r.virtual_slot, r.shard) for r in first.values()}
