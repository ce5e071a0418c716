"""Versioned publish: a whole table at any time, whatever ends the process."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile
import textwrap

import pytest

from daybook.sources import versions as V
from daybook.sources.files import publish, read_table
from tests.conftest import ROOT


def folder():
    return os.path.join(tempfile.mkdtemp(prefix="daybook-versions-"), "t")


def values(spark, path, version=None):
    return sorted(r.id for r in read_table(spark, path, version=version).collect())


def test_versions_history_and_retention(spark):
    t = folder()
    assert not V.table_exists(spark, t) and V.current_version(spark, t) is None
    for n in (1, 2, 3, 4):
        assert publish(spark.range(n), t) == n
    assert V.versions(spark, t) == [1, 2, 3, 4] and V.current_version(spark, t) == 4
    assert values(spark, t) == [0, 1, 2, 3] and values(spark, t, 2) == [0, 1]
    assert V.retain(spark, t, 2) == [1, 2] and V.versions(spark, t) == [3, 4]
    with pytest.raises(LookupError):
        read_table(spark, t, version=1)
    with pytest.raises(ValueError):
        V.retain(spark, t, 0)
    publish(spark.range(9), t, keep=1)  # a new schema and number; old ones go
    assert V.versions(spark, t) == [5] and len(values(spark, t)) == 9


def test_failed_check_keeps_the_current_version(spark):
    t = folder()

    def reject(staged, rows):
        raise ValueError(rows)
    with pytest.raises(ValueError):
        publish(spark.range(3), t, reject)
    assert not V.table_exists(spark, t)  # a staged copy is no table
    publish(spark.range(2), t)
    with pytest.raises(ValueError):
        publish(spark.range(3), t, reject)
    assert V.versions(spark, t) == [1] and values(spark, t) == [0, 1]


def test_plain_table_is_read_until_a_version_is_published(spark):
    t = folder()
    spark.range(5).write.parquet(t)
    assert V.table_exists(spark, t) and len(values(spark, t)) == 5
    publish(spark.range(1), t)
    assert values(spark, t) == [0]


class End(BaseException):
    """Ends a publish as a killed process would: nothing is cleaned up."""


@pytest.mark.parametrize("step", ["write", "check", "claim", "rename"])
def test_a_whole_table_after_an_end_at_any_step(spark, monkeypatch, step):
    t = folder()
    publish(spark.range(2), t)

    def end(*a, **k):
        raise End

    def write(df, path):
        df.write.parquet(path)
        if step == "write":
            raise End
        return df.count()
    with monkeypatch.context() as m:
        if step == "claim":
            m.setattr(V, "_claim", end)
        if step == "rename":
            real = V._claim
            m.setattr(V, "_claim", lambda *a: (real(*a), end()))
        with pytest.raises(End):
            V.publish_version(spark.range(7), t, write, end if step == "check" else None)
    assert V.versions(spark, t) == [1] and values(spark, t) == [0, 1]
    publish(spark.range(4), t)  # the next attempt goes through, with a number of its own
    assert values(spark, t) == [0, 1, 2, 3] and values(spark, t, 1) == [0, 1]


def test_concurrent_claims_never_share_a_number(spark):
    t = folder()
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: V._claim(spark, t), range(24)))
    assert len(set(got)) == 24


def test_a_killed_process_leaves_the_old_version(spark):
    t = folder()
    publish(spark.range(2), t)
    code = textwrap.dedent(f"""
        import os, sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession
        from daybook.sources import files, versions
        s = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate())
        def end(staged, rows):
            os._exit(9)  # no clean-up of any kind
        files.publish(s.range(7), {t!r}, end)
    """)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, timeout=120)
    assert done.returncode == 9
    assert V.versions(spark, t) == [1] and values(spark, t) == [0, 1]
