"""The catalog query writes documents of bounded size and loads them all."""

import json
from pathlib import Path

from workload import q_records


def test_catalog_documents_are_bounded(spark, tmp_path, monkeypatch):
    path = tmp_path / "catalog"
    monkeypatch.setattr(q_records, "folder", lambda spark: str(path))
    rows = q_records.catalog_file(spark, "/root/testdata/sf0.01").collect()
    sizes = [len(json.loads(f.read_text())["entries"]) for f in Path(path).glob("*.json") if f.stat().st_size]
    assert sum(sizes) == len(rows) == 2000 and max(sizes) < 1500


def test_empty_catalog(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(q_records, "folder", lambda spark: str(tmp_path / "catalog"))
    table = q_records.b.table
    monkeypatch.setattr(q_records.b, "table", lambda *a: table(*a).where("false"))
    assert q_records.catalog_file(spark, "/root/testdata/sf0.01").count() == 0
