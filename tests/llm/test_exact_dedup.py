"""Exact dedup against brute force, with forced collisions."""

from __future__ import annotations

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from daybook.llm import exact_dedup as D
from tests.llm.test_operators import ODD, table


def brute(rows, keep):
    """Rows (doc_id, keep_id, size, sha) and the number of kept rows of each text."""
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    pick = max if keep == D.LARGEST else min
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = pick(known) if known else None
        out += [(i, best, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return collections.Counter(out)


def sample(seed):
    rng = random.Random(seed)
    rows = list(ODD) + [(None, None), (None, "a b c"), (20, ""), (7, "dup"), (7, "dup"), (7, "dup")]
    rows += [(i, rng.choice("pqrstuvw") * rng.randrange(1, 4)) for i in range(100, 260)]
    return rows + [(i, "a hot text " * 20) for i in range(1000, 1200)]


# the last ones make every hash, or a few, stand for many texts
HASHES = {"md5": D.content_hash, "few": lambda t: F.unhex(F.hex(F.pmod(F.crc32(t), F.lit(5)))),
          "one": lambda t: F.when(F.length(t) >= 0, F.unhex(F.lit("00")))}


@pytest.mark.parametrize("keep", [D.SMALLEST, D.LARGEST])
@pytest.mark.parametrize("name", list(HASHES))
@pytest.mark.parametrize("hot", [1 << 16, 2])
def test_groups_equal_brute_force(spark, keep, name, hot, monkeypatch):
    if hot == 2 and name != "md5":
        pytest.skip("hot classes are those of whole hashes")
    monkeypatch.setattr(D, "HOT_CLASSES", hot)
    rows = sample(3)
    out = D.dedup(table(spark, rows), keep, hash_of=HASHES[name]).collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out) == brute(rows, keep)
    kept = [r for r in out if r.kept]
    assert all(r.doc_id == r.keep_id for r in kept)
    assert sorted(r.text_sha256 for r in kept) == sorted({k[3] for k in brute(rows, keep)})  # one each


def test_empty_table_and_kept_documents(spark):
    docs = table(spark, [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, "")])
    assert D.dedup(docs.limit(0)).count() == 0
    assert sorted(r.doc_id for r in D.kept_documents(docs).collect()) == [1, 3, 4]
    last = D.kept_documents(docs, D.LARGEST)
    assert last.columns == docs.columns and sorted(r.doc_id for r in last.collect()) == [2, 3, 5]
    with pytest.raises(ValueError):
        D.dedup(docs, "any")
