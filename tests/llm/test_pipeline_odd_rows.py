"""The stages of the corpus pipeline on odd rows, and the memory helpers."""

from __future__ import annotations

import collections

import pyarrow as pa
import pytest

from daybook.llm import common
from tests.llm.test_operators import ODD, table

NAMES = ["drop_toxic", "drop_near_copies", "cut_benchmark", "redact_secrets"]


def counted(df):
    return collections.Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("name", NAMES)
def test_stage_on_odd_rows(spark, sf_small, name):
    import corpus_pipeline as P
    docs = table(spark, [r for r in ODD if r[0] != 6] + [(8, "token=abcdefgh12345678"), (9, "x " * 3000)])
    out = getattr(P, name)(spark, docs, sf_small)
    assert out.columns == docs.columns and out.schema == docs.schema
    got, before = counted(out), counted(docs)
    if name == "redact_secrets":
        assert {r[0] for r in got} == {r[0] for r in before} and sum(got.values()) == sum(before.values())
        assert next(r[1] for r in got if r[0] == 8) == "[REDACTED]"
    elif name == "drop_near_copies":
        # copies of one row stand once; texts without words stay, each by itself
        assert set(got) == set(before) and got[next(r for r in got if r[0] == 4)] == 1
    else:
        assert got == before
    assert any(r[0] == 1 and r[1] is None for r in got) and any(r[0] is None for r in got)
    assert getattr(P, name)(spark, docs.limit(0), sf_small).count() == 0


def test_packing_stage_on_odd_rows(spark, sf_small):
    import corpus_pipeline as P
    docs = table(spark, [r for r in ODD if r[0] != 6])
    out = P.pack(spark, docs, sf_small).collect()
    ids = collections.Counter(r.doc_id for r in out if r.start == 0)
    assert ids == collections.Counter(i for i, _ in ODD if i != 6)
    assert {r.doc_tokens for r in out if r.doc_id in (1, 2)} == {1}
    assert P.pack(spark, docs.limit(0), sf_small).count() == 0


def test_small_batches_leave_own_settings_alone(spark):
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.unset(k)
        spark.conf.set(keys[0], "77")
        common.small_batches(spark)
        assert spark.conf.get(keys[0]) == "77" and spark.conf.get(keys[1]) in ("4m", "4194304b")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_released_passes_batches_and_errors_on():
    batches = [pa.RecordBatch.from_pydict({"a": [i]}) for i in range(3)]
    assert list(common.released(lambda it: (b for b in it))(iter(batches))) == batches

    def broken(it):
        yield next(it)
        raise KeyError("x")
    with pytest.raises(KeyError):
        list(common.released(broken)(iter(batches)))
