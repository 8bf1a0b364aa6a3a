"""A job selects its files by a listing, so no document is asked for its file's name."""
import json

import pytest

from feedspark.plans import files, job
from feedspark.plans.catalog import ParquetCatalog


@pytest.fixture
def landing(tmp_path):
    def put(name, *ids):
        rows = [{"id": i, "name": f"N{i}", "media": "M", "type": "K", "nielsenCode": "1"} for i in ids]
        doc = {"tenant": "T", "extractdatetime": "2018-01-02-00-00-00", "destinations": rows}
        at = tmp_path / "landing" / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_text(json.dumps(doc) + "\n")

    put("DS-DESTINATIONFEED-20180101-1", "a")
    put("ds-destinationfeed-20180201 1/part-0", "b")
    put("DS-DESTINATIONFEED-20170101-1", "old")
    put("DS-PROGRAMFEED-20180101-1", "other")
    return str(tmp_path / "landing")


@pytest.mark.parametrize("mode", ["FAILFAST", "PERMISSIVE"])
@pytest.mark.parametrize("listed", [True, False])
def test_selected_files_are_named_to_the_scan(spark, tmp_path, monkeypatch, landing, mode, listed):
    cat = ParquetCatalog(spark, str(tmp_path / "c"))
    cat.seed("tenant", spark.createDataFrame([(1, "T")], "id long, mo_id string"))
    plans = []
    was = job.scan_feed

    def scan(*a, **k):
        docs = was(*a, **k)
        plans.append(docs._jdf.queryExecution().optimizedPlan().toString())
        return docs

    monkeypatch.setattr(job, "scan_feed", scan)
    if not listed:
        monkeypatch.setattr(files, "LISTED", 1)
    job.run_feed(spark, "destination", landing, cat, since=20170601, multi_line=False, mode=mode, quarantine=str(tmp_path / "q"))
    assert sorted(r.mo_id for r in cat.read("network").collect()) == ["a", "b"]
    assert ("regexp_extract" in plans[0]) is not listed
