import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from feedspark.operators.flatten import flatten
from feedspark.plans.catalog import ParquetCatalog
from feedspark.plans.job import run_feed
from feedspark.operators.lookup import MissingParentError
from feedspark.sources.feeds import detect_multi_line, parse_feed, scan_feed

from .conftest import envelope, write_doc

ADV_NAME = "DS-OO-NATIONAL-ADVERTISERFEED-20180102-100000"


def adv_doc(**kw):
    return envelope(
        advertiserMappedByMedia="N",
        advertisers=[
            {"id": "A", "name": "Acmé", "media": "N", "brands": [{"id": "b1", "name": "x"}, {"id": "b2", "name": "y"}]},
            {"id": "B", "name": "No brands", "media": "N", "brands": []},
            {"id": "C", "name": "Null brands", "media": "N"},
        ],
        **kw,
    )


def test_multiline_document_per_file(spark, tmp_path):
    write_doc(tmp_path, ADV_NAME, adv_doc())
    flat = flatten(scan_feed(spark, str(tmp_path), "advertiser", multi_line=True), "advertiser")
    rows = flat.orderBy("brand_id").collect()
    assert [(r.advertiser_id, r.brand_id) for r in rows] == [("A", "b1"), ("A", "b2")]
    assert rows[0].advertiser_name == "Acmé"
    assert rows[0].extract_datetime == dt.datetime(2018, 1, 2, 10, 0, 0)
    assert flat.columns == [
        "mo_system", "tenant", "system", "advertiser_mapped_by_media", "feed_type", "filename", "extract_datetime",
        "advertiser_id", "advertiser_name", "advertiser_media", "brand_id", "brand_name",
    ]


def test_keep_empty_arrays(spark, tmp_path):
    write_doc(tmp_path, ADV_NAME, adv_doc())
    flat = flatten(scan_feed(spark, str(tmp_path), "advertiser", multi_line=True), "advertiser", keep_empty=True)
    got = sorted((r.advertiser_id, r.brand_id) for r in flat.collect())
    assert got == [("A", "b1"), ("A", "b2"), ("B", None), ("C", None)]


def test_zero_files_gives_empty_frame(spark, tmp_path):
    write_doc(tmp_path, "DS-OO-NATIONAL-PROGRAMFEED-20180102-100000", envelope(feed="PROGRAM", programs=[]))
    flat = flatten(scan_feed(spark, str(tmp_path), "advertiser", multi_line=True), "advertiser")
    assert flat.count() == 0
    assert len(flat.columns) == 12


def test_other_feeds_broken_file_is_not_opened(spark, tmp_path):
    write_doc(tmp_path, ADV_NAME, adv_doc())
    write_doc(tmp_path, "DS-OO-NATIONAL-PROGRAMFEED-20180102-100000", "{ not json", raw=True)
    flat = flatten(scan_feed(spark, str(tmp_path), "advertiser", multi_line=True), "advertiser")
    assert flat.count() == 2


def test_bad_syntax_fails_by_default(spark, tmp_path):
    write_doc(tmp_path, ADV_NAME, "{ not json", raw=True)
    with pytest.raises((Py4JJavaError, PySparkException)):
        scan_feed(spark, str(tmp_path), "advertiser", multi_line=True).count()


def test_bad_timestamp_fails_by_default(spark, tmp_path):
    write_doc(tmp_path, ADV_NAME, adv_doc(extractdatetime="2018/01/02 10:00"))
    with pytest.raises((Py4JJavaError, PySparkException)):
        flatten(scan_feed(spark, str(tmp_path), "advertiser", multi_line=True), "advertiser").collect()


def test_permissive_quarantines_bad_documents(spark, tmp_path):
    land = tmp_path / "landing"
    write_doc(land, ADV_NAME, adv_doc())
    write_doc(land, "DS-OO-NATIONAL-ADVERTISERFEED-20180103-100000", "{ not json", raw=True)
    q = str(tmp_path / "quarantine")
    cat = ParquetCatalog(spark, str(tmp_path / "tables"))
    with pytest.raises(MissingParentError):  # no tenant yet: nothing is written
        run_feed(spark, "advertiser", str(land), cat, multi_line=True, mode="PERMISSIVE", quarantine=q)
    assert not (tmp_path / "quarantine").exists()
    cat.seed("tenant", spark.createDataFrame([(7, "T1")], "id long, mo_id string"))
    for _ in range(2):
        run_feed(spark, "advertiser", str(land), cat, multi_line=True, mode="PERMISSIVE", quarantine=q, only_new=True)
    assert cat.read("product").count() == 2
    bad = spark.read.parquet(q).collect()
    assert len(bad) == 1 and "ADVERTISERFEED-20180103" in bad[0]._feed_file
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_no_mode_drops_documents(spark, tmp_path):
    write_doc(tmp_path, ADV_NAME, adv_doc())
    with pytest.raises(ValueError, match="mode"):
        scan_feed(spark, str(tmp_path), "advertiser", mode="DROPMALFORMED")


def test_form_of_files_is_found_out(spark, tmp_path):
    import json

    write_doc(tmp_path / "pretty", ADV_NAME, adv_doc())
    write_doc(tmp_path / "lines", ADV_NAME, json.dumps(adv_doc()) + "\n" + json.dumps(adv_doc()), raw=True)
    assert detect_multi_line(spark, str(tmp_path / "pretty"), "advertiser")
    assert not detect_multi_line(spark, str(tmp_path / "lines"), "advertiser")
    assert not detect_multi_line(spark, str(tmp_path / "lines"), "program")


def test_every_file_is_read_in_its_own_form(spark, tmp_path):
    import json

    from feedspark.sources.feeds import SeveralDocumentsError, split_corrupt

    a, b = tmp_path / "a", tmp_path / "b"
    name = "DS-OO-NATIONAL-ADVERTISERFEED-2018010{}-100000".format
    one = lambda t: json.dumps(adv_doc(tenant=t))
    write_doc(a, name(1), adv_doc(tenant="pretty"))
    write_doc(a, name(2), one("l1") + "\n\n" + one("l2"), raw=True)
    write_doc(b, name(3), "[\n" + one("i1") + ",\n" + one("i2") + "\n]", raw=True)
    write_doc(b, name(4), one("single"), raw=True)
    docs = scan_feed(spark, [str(a), str(b)], "advertiser", multi_line=None)
    assert sorted(r.tenant for r in docs.collect()) == ["i1", "i2", "l1", "l2", "pretty", "single"]
    # a broken first line, a document cut off
    write_doc(b, name(5), one("x")[:-9] + "\n" + one("b1") + "\n" + one("b2"), raw=True)
    write_doc(b, name(6), json.dumps(adv_doc(), indent=2)[:-30], raw=True)
    good, bad = split_corrupt(scan_feed(spark, [str(a), str(b)], "advertiser", multi_line=None, mode="PERMISSIVE").persist())
    assert sorted(r.tenant for r in good.collect()) == ["b1", "b2", "i1", "i2", "l1", "l2", "pretty", "single"]
    assert sorted(r._feed_file for r in bad.collect()) == [name(5), name(6)]
    with pytest.raises((Py4JJavaError, PySparkException)):
        scan_feed(spark, [str(a), str(b)], "advertiser", multi_line=None).collect()
    # two documents over several lines each: no form reads both
    write_doc(b, name(7), json.dumps(adv_doc(), indent=2) + "\n" + json.dumps(adv_doc(), indent=2), raw=True)
    with pytest.raises(SeveralDocumentsError, match=name(7)):
        scan_feed(spark, [str(a), str(b)], "advertiser", multi_line=None)
    # which is not looked at before the cutoff
    assert scan_feed(spark, [str(a), str(b)], "advertiser", since=20180107, multi_line=None).count() == 0


def test_job_loads_lines_beside_a_pretty_file(spark, tmp_path):
    import json

    land = tmp_path / "landing"
    write_doc(land, "DS-OO-NATIONAL-DESTINATIONFEED-20180101-100000", envelope(feed="DESTINATION", destinations=[], system="x" * 9000))  # the larger file comes first
    docs = [envelope(feed="DESTINATION", destinations=[{"id": i, "name": i, "media": "TV", "type": "CABLE", "nielsenCode": "1"}]) for i in "ABC"]
    write_doc(land, "DS-OO-NATIONAL-DESTINATIONFEED-20180102-100000", "\n".join(map(json.dumps, docs)), raw=True)
    cat = ParquetCatalog(spark, str(tmp_path / "tables"))
    cat.seed("tenant", spark.createDataFrame([(7, "T1")], "id long, mo_id string"))
    run_feed(spark, "destination", str(land), cat)
    assert cat.read("network").count() == 3


def test_since_cutoff_and_undated_names(spark, tmp_path):
    write_doc(tmp_path, ADV_NAME, adv_doc())
    write_doc(tmp_path, "DS-OO-NATIONAL-ADVERTISERFEED-20170101-100000", adv_doc(extractdatetime="2017-01-01-10-00-00"))
    write_doc(tmp_path, "DS-OO-NATIONAL-ADVERTISERFEED-latest", adv_doc())
    docs = scan_feed(spark, str(tmp_path), "advertiser", since=20171231, multi_line=True)
    assert [r._feed_file for r in docs.select("_feed_file").collect()] == [ADV_NAME]


def test_number_and_non_ascii_as_string(spark, tmp_path):
    doc = adv_doc()
    doc["advertisers"][0]["id"] = 1.50
    doc["advertisers"][0]["name"] = "Ünïcødé 広告"
    write_doc(tmp_path, ADV_NAME, doc)
    rows = flatten(scan_feed(spark, str(tmp_path), "advertiser", multi_line=True), "advertiser").collect()
    assert {r.advertiser_id for r in rows} == {"1.5"}
    assert rows[0].advertiser_name == "Ünïcødé 広告"


def test_estimate_versions_merge(spark, tmp_path):
    e17 = envelope(feed="ESTIMATE", estimates=[{"id": "E1", "name": "n", "startDate": "2017-01-01", "endDate": "2017-02-01", "media": "N", "advertiserId": "A", "brandId": "b1"}])
    e18 = envelope(feed="ESTIMATE", ts="2018-03-01-00-00-00", estimates=[{"id": "E2", "name": "n", "startDate": "2018-01-01", "endDate": "2018-02-01", "media": "N", "advertiserId": "A", "brandIds": ["b1", "b2"]}])
    write_doc(tmp_path, "DS-OO-NATIONAL-ESTIMATEFEED-20170101-000000", e17)
    write_doc(tmp_path, "DS-OO-NATIONAL-ESTIMATEFEED-20180301-000000", e18)
    rows = {r.id: r for r in flatten(scan_feed(spark, str(tmp_path), "estimate", multi_line=True), "estimate").collect()}
    assert rows["E1"].brand_id == "b1" and rows["E1"].brand_ids == ["b1"]
    assert rows["E2"].brand_id is None and rows["E2"].brand_ids == ["b1", "b2"]
    assert rows["E2"].start_date == dt.date(2018, 1, 1)


def test_parse_feed_from_text_rows(spark):
    import json

    df = spark.createDataFrame([(json.dumps(adv_doc()),)], "value string")
    flat = flatten(parse_feed(df, "value", "advertiser"), "advertiser")
    assert sorted(r.brand_id for r in flat.collect()) == ["b1", "b2"]


def test_json_lines_many_documents_per_file(spark, tmp_path):
    import json

    lines = "\n".join(json.dumps(adv_doc(tenant=f"T{i}")) for i in range(5))
    write_doc(tmp_path, ADV_NAME, lines, raw=True)
    flat = flatten(scan_feed(spark, str(tmp_path), "advertiser"), "advertiser")
    assert flat.count() == 10


def test_bad_date_fails_by_default(spark, tmp_path):
    doc = envelope(feed="PROGRAM", programs=[{"id": "P", "name": "n", "networkId": "N", "startDate": "05/01/2018", "endDate": "2018-06-01", "media": "TV"}])
    write_doc(tmp_path, "DS-OO-NATIONAL-PROGRAMFEED-20180102-100000", doc)
    with pytest.raises((Py4JJavaError, PySparkException)):
        flatten(scan_feed(spark, str(tmp_path), "program", multi_line=True), "program").collect()


def test_empty_and_null_outer_arrays(spark, tmp_path):
    write_doc(tmp_path, "DS-OO-NATIONAL-ADVERTISERFEED-20180102-100000", envelope(advertisers=[]))
    write_doc(tmp_path, "DS-OO-NATIONAL-ADVERTISERFEED-20180103-100000", envelope(advertisers=None))
    write_doc(tmp_path, "DS-OO-NATIONAL-ADVERTISERFEED-20180104-100000", envelope())
    assert flatten(scan_feed(spark, str(tmp_path), "advertiser", multi_line=True), "advertiser").count() == 0


def test_null_extract_datetime_is_kept_as_null(spark, tmp_path):
    write_doc(tmp_path, ADV_NAME, adv_doc(extractdatetime=None))
    rows = flatten(scan_feed(spark, str(tmp_path), "advertiser", multi_line=True), "advertiser").collect()
    assert len(rows) == 2 and all(r.extract_datetime is None for r in rows)


def test_several_landing_roots_in_one_scan(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    write_doc(a, ADV_NAME, adv_doc())
    write_doc(b, "DS-OO-NATIONAL-ADVERTISERFEED-20180301-100000", adv_doc(tenant="T2"))
    docs = scan_feed(spark, [str(a), str(b)], "advertiser", multi_line=True)
    rows = flatten(docs, "advertiser").select("tenant", "brand_id").collect()
    assert sorted(map(tuple, rows)) == [("T1", "b1"), ("T1", "b2"), ("T2", "b1"), ("T2", "b2")]
    assert sorted(r._feed_file for r in docs.select("_feed_file").collect()) == [ADV_NAME, "DS-OO-NATIONAL-ADVERTISERFEED-20180301-100000"]


def test_top_level_array_gives_one_document_per_element(spark, tmp_path):
    import json

    write_doc(tmp_path, ADV_NAME, json.dumps([adv_doc(tenant="T1"), adv_doc(tenant="T2")]), raw=True)
    docs = scan_feed(spark, str(tmp_path), "advertiser", multi_line=True)
    assert sorted(r.tenant for r in docs.collect()) == ["T1", "T2"]


def test_root_without_feed_entries_is_skipped(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    write_doc(a, ADV_NAME, adv_doc())
    write_doc(b, "DS-OO-NATIONAL-PROGRAMFEED-20180102-100000", envelope(feed="PROGRAM", programs=[]))
    docs = scan_feed(spark, [str(a), str(b)], "advertiser", multi_line=True)
    assert docs.count() == 1


def test_missing_root_fails(spark, tmp_path):
    with pytest.raises(PySparkException):
        scan_feed(spark, str(tmp_path / "nope"), "advertiser", multi_line=True)


def test_permissive_quarantines_bad_timestamp_instead_of_null(spark, tmp_path):
    """A bad timestamp must not pass as null: a null extract would win the first-seen dedupe."""
    import json

    from feedspark.sources.feeds import split_corrupt

    lines = "\n".join([json.dumps(adv_doc()), json.dumps(adv_doc(extractdatetime="2018/01/02 10:00"))])
    write_doc(tmp_path, ADV_NAME, lines, raw=True)
    docs = scan_feed(spark, str(tmp_path), "advertiser", mode="PERMISSIVE").persist()
    good, bad = split_corrupt(docs)
    assert [r.extractdatetime for r in good.collect()] == [dt.datetime(2018, 1, 2, 10, 0)]
    assert bad.count() == 1


def test_read_schema_prunes_nested_fields(spark, tmp_path):
    from feedspark.plans.specs import ADVERTISER, ESTIMATE

    s = ADVERTISER.read_schema(["tenant", "brand_id"]).simpleString()
    assert s == "struct<tenant:string,advertisers:array<struct<brands:array<struct<id:string>>>>>"
    # envelope only: the exploded arrays stay (they decide the rows), with one field each
    assert "advertisers:array<struct<brands:array<struct<id:string>>>>" in ADVERTISER.read_schema(["tenant"]).simpleString()
    assert "brandIds" in ESTIMATE.read_schema(["brand_ids"]).simpleString()
    assert ADVERTISER.read_schema(None) == ADVERTISER.schema
    with pytest.raises(ValueError):
        ADVERTISER.read_schema(["nope"])
    write_doc(tmp_path, ADV_NAME, adv_doc())
    cols = ["tenant", "brand_id"]
    rows = flatten(scan_feed(spark, str(tmp_path), "advertiser", multi_line=True, columns=cols), "advertiser", columns=cols).collect()
    assert sorted(map(tuple, rows)) == [("T1", "b1"), ("T1", "b2")]


def test_documents_of_another_shape_are_kept_and_counted(spark, tmp_path):
    """Loaded and quarantined documents add up; nothing is left out unseen."""
    from feedspark.plans.job import run_feed

    land, cat = tmp_path / "shapes", ParquetCatalog(spark, str(tmp_path / "shape-tables"))
    cat.seed("tenant", spark.createDataFrame([(7, "T1")], "id long, mo_id string"))
    good = json.dumps(envelope(feed="DESTINATION", destinations=[{"id": "N1", "name": "n", "media": "m", "type": "t", "nielsenCode": "c"}]))
    lines = [good, '{"heartbeat": 1}', '{"heartbeat": 2}', '{"destinations": null}', "{cut", good.replace("N1", "N2")]
    write_doc(land, "DS-DESTINATIONFEED-20180101", "\n".join(lines), raw=True)
    for _ in range(2):
        run_feed(spark, "destination", str(land), cat, multi_line=False, mode="PERMISSIVE", quarantine=str(tmp_path / "kept"), only_new=True)
    assert sorted(r.mo_id for r in cat.read("network").collect()) == ["N1", "N2"]
    kept = spark.read.parquet(str(tmp_path / "kept")).collect()
    assert sum(r.n_documents for r in kept) == 4 and "{cut" in {r._corrupt_record for r in kept}


def test_a_large_file_over_several_lines_is_refused(spark, tmp_path, monkeypatch):
    from feedspark.sources import SeveralDocumentsError, feeds

    monkeypatch.setattr(feeds, "WHOLE", 100)
    doc = envelope(feed="DESTINATION", destinations=[{"id": f"N{i}"} for i in range(20)])
    text = json.dumps(doc).replace("}, {", "},\n{").replace("}]", "}\n]")
    write_doc(tmp_path / "large", "DS-DESTINATIONFEED-20180101", text, raw=True)
    with pytest.raises(SeveralDocumentsError, match="too large"):
        scan_feed(spark, str(tmp_path / "large"), "destination", multi_line=None)
