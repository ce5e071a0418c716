"""Groups of packing follow the pieces, not the documents."""

from __future__ import annotations

import collections

from daybook.llm import packing
from tests.llm.test_operators import table


def test_few_long_documents_make_many_groups(spark):
    docs = table(spark, [(i, f"word{i} and more " * 8_000) for i in range(20)])
    out = packing.pack(docs, group_pieces=64).collect()
    groups = collections.Counter(r.sequence_id >> 32 for r in out)
    assert len(groups) >= len(out) // 200 and max(groups.values()) <= 3 * 64 * 2
    by = collections.defaultdict(list)
    for r in out:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= packing.SEQUENCE
    held = collections.Counter()
    for r in out:
        held[r.doc_id] += r.length
    assert {r.doc_id: r.doc_tokens for r in out} == dict(held)
