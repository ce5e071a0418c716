"""The staged CSV is compressed, in files of a bounded number of rows."""

from __future__ import annotations

import os

from daybook.plans.catalog import _csv_source, _csv_with_bad_cells
from daybook.plans.stages import Stages
from daybook.sources import files
from daybook.sources.files import read_raw_csv, write_csv


def test_staged_csv_is_compressed(spark, sf_small, tmp_path, monkeypatch):
    s = Stages(spark, sf_small)
    for path in (_csv_source(s).removeprefix("file:"), _csv_with_bad_cells(s).removeprefix("file:")):
        parts = [f for f in os.listdir(path) if f.startswith("part-")]
        assert parts and all(f.endswith(".csv.lz4") for f in parts)
    monkeypatch.setattr(files, "CSV_FILE_ROWS", 100)
    path = write_csv(s.raw.limit(250).coalesce(1), str(tmp_path / "csv"), "lz4")
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 3
    assert read_raw_csv(spark, path).exceptAll(s.raw).isEmpty()
