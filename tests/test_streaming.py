import pytest

from feedspark.plans.catalog import ParquetCatalog
from feedspark.streaming import start_feed_stream

from .conftest import envelope, write_doc


def _dest(ids, ts):
    return envelope(ts=ts, feed="DESTINATION", destinations=[{"id": i, "name": i, "media": "TV", "type": "CABLE", "nielsenCode": "1"} for i in ids])


def test_available_now_loads_only_new_files(spark, tmp_path):
    land = tmp_path / "landing"
    write_doc(land, "DS-OO-NATIONAL-DESTINATIONFEED-20180102-100000", _dest(["N1", "N2"], "2018-01-02-10-00-00"))
    cat = ParquetCatalog(spark, str(tmp_path / "tables"))
    cat.seed("tenant", spark.createDataFrame([(7, "T1")], "id long, mo_id string"))
    ckpt = str(tmp_path / "ckpt")
    q = start_feed_stream(spark, str(land), "destination", cat, ckpt, multi_line=True)
    q.awaitTermination(120)
    assert sorted(r.mo_id for r in cat.read("network").collect()) == ["N1", "N2"]

    write_doc(land, "DS-OO-NATIONAL-DESTINATIONFEED-20180301-100000", _dest(["N2", "N3"], "2018-03-01-10-00-00"))
    q = start_feed_stream(spark, str(land), "destination", cat, ckpt, multi_line=True)
    q.awaitTermination(120)
    rows = sorted((r.mo_id, r.id) for r in cat.read("network").collect())
    assert rows == [("N1", 1), ("N2", 2), ("N3", 3)]


def _one(name, ts, kind="CABLE"):
    return envelope(ts=ts, feed="DESTINATION", destinations=[{"id": "N1", "name": name, "media": "TV", "type": kind, "nielsenCode": "1"}])


def _catalog(spark, path):
    cat = ParquetCatalog(spark, str(path))
    cat.seed("tenant", spark.createDataFrame([(7, "T1")], "id long, mo_id string"))
    return cat


def _stream(spark, land, cat, ckpt, **kw):
    q = start_feed_stream(spark, str(land), "destination", cat, str(ckpt), multi_line=True, **kw)
    q.awaitTermination(120)
    return sorted(tuple(r) for r in cat.read("network").collect())


def test_a_late_earlier_extract_corrects_the_row_and_keeps_its_id(spark, tmp_path):
    land, cat = tmp_path / "landing", _catalog(spark, tmp_path / "tables")
    write_doc(land, "DS-DESTINATIONFEED-20180301", _one("renamed", "2018-03-01-10-00-00"))
    write_doc(land, "DS-DESTINATIONFEED-20180302", _dest(["N0", "N2"], "2018-03-02-10-00-00"))
    first = {r[1]: r for r in _stream(spark, land, cat, tmp_path / "ckpt")}
    write_doc(land, "DS-DESTINATIONFEED-20180101", _one("original", "2018-01-01-10-00-00"))
    second = {r[1]: r for r in _stream(spark, land, cat, tmp_path / "ckpt")}
    assert first["N1"][2] == "renamed" and second["N1"][2] == "original" and first["N1"][0] == second["N1"][0]
    assert {k: v for k, v in second.items() if k != "N1"} == {k: v for k, v in first.items() if k != "N1"}


def test_a_rejected_first_extract_stays_rejected_in_any_order(spark, tmp_path):
    for turn, order in enumerate((("20180101", "20180301"), ("20180301", "20180101"))):
        land, cat = tmp_path / f"landing{turn}", _catalog(spark, tmp_path / f"tables{turn}")
        for day in order:
            write_doc(land, f"DS-DESTINATIONFEED-{day}", _one("n", f"{day[:4]}-{day[4:6]}-{day[6:]}-10-00-00", None if day == "20180101" else "CABLE"))
            rows = _stream(spark, land, cat, tmp_path / f"ckpt{turn}", max_files=1)
        assert rows == []


def test_undated_files_fail_the_stream(spark, tmp_path):
    land, cat = tmp_path / "landing", _catalog(spark, tmp_path / "tables")
    write_doc(land, "DS-DESTINATIONFEED-latest", _one("n", "2018-01-01-10-00-00"))
    with pytest.raises(Exception, match="without a date"):
        _stream(spark, land, cat, tmp_path / "ckpt")
    assert _stream(spark, land, cat, tmp_path / "ckpt2", undated="skip", undated_list=str(tmp_path / "list")) == []
    assert spark.read.parquet(str(tmp_path / "list")).count() == 1


def test_stream_with_no_feed_files_loads_nothing(spark, tmp_path):
    land = tmp_path / "landing"
    write_doc(land, "DS-OO-NATIONAL-PROGRAMFEED-20180102-100000", envelope(feed="PROGRAM", programs=[]))
    cat = ParquetCatalog(spark, str(tmp_path / "tables"))
    cat.seed("tenant", spark.createDataFrame([(7, "T1")], "id long, mo_id string"))
    q = start_feed_stream(spark, str(land), "destination", cat, str(tmp_path / "ckpt"), multi_line=True)
    q.awaitTermination(120)
    assert cat.read("network").count() == 0
