"""End-to-end loads of hand-written feed files into a parquet catalog."""
import datetime as dt

import pytest

from pyspark.sql import functions as F

from feedspark.operators.lookup import MissingParentError
from feedspark.plans import loads
from feedspark.plans.catalog import ParquetCatalog
from feedspark.plans.job import main, run_feed

from .conftest import envelope, write_doc


def _name(word, day):
    return f"DS-OO-NATIONAL-{word}-{day}-100000"


@pytest.fixture()
def landing(tmp_path):
    root = tmp_path / "landing"
    adv = lambda ts, name: envelope(
        ts=ts,
        advertiserMappedByMedia="N",
        advertisers=[
            {"id": "A", "name": name, "media": "N", "brands": [{"id": "b1", "name": "x"}]},
            {"id": "B", "name": "Bee", "media": "N", "brands": [{"id": "b2", "name": "y"}, {"id": "b1", "name": "x"}]},
            {"id": "E", "name": "Empty", "media": "N", "brands": []},
        ],
    )
    write_doc(root, _name("ADVERTISERFEED", "20180102"), adv("2018-01-02-10-00-00", "Acme"))
    write_doc(root, _name("ADVERTISERFEED", "20180201"), adv("2018-02-01-10-00-00", "Acme renamed"))
    write_doc(
        root,
        _name("DESTINATIONFEED", "20180102"),
        envelope(feed="DESTINATION", destinations=[
            {"id": "N1", "name": "Net1", "media": "TV", "type": None, "nielsenCode": "1"},
            {"id": "N2", "name": "Net2", "media": "TV", "type": "CABLE", "nielsenCode": "2"},
        ]),
    )
    write_doc(
        root,
        _name("DESTINATIONFEED", "20180301"),
        envelope(ts="2018-03-01-00-00-00", feed="DESTINATION", destinations=[
            {"id": "N1", "name": "Net1", "media": "TV", "type": "CABLE", "nielsenCode": "1"},
            {"id": "N3", "name": "Net3", "media": "TV", "type": "BROADCAST", "nielsenCode": "3"},
        ]),
    )
    write_doc(
        root,
        _name("ESTIMATEFEED", "20180102"),
        envelope(feed="ESTIMATE", estimates=[
            {"id": "E1", "name": "first", "startDate": "2018-01-01", "endDate": "2018-02-01", "media": "N", "advertiserId": "A", "brandIds": ["b1"]},
        ]),
    )
    write_doc(
        root,
        _name("ESTIMATEFEED", "20180103"),
        envelope(ts="2018-01-03-00-00-00", feed="ESTIMATE", estimates=[
            {"id": "E1", "name": "second", "startDate": "2018-01-01", "endDate": "2018-02-01", "media": "N", "advertiserId": "A", "brandId": "b1"},
        ]),
    )
    write_doc(
        root,
        _name("DAYPARTFEED", "20180102"),
        envelope(feed="DAYPART", dayparts=[
            {"id": "D1", "name": "Morning", "media": "N", "advertiserId": "A"},
            {"id": "D1", "name": "Morning (no adv)", "media": "N"},
            {"id": "D2", "name": "Night", "media": "N", "advertiserId": "ZZ"},
        ]),
    )
    write_doc(
        root,
        _name("PROGRAMFEED", "20180102"),
        envelope(feed="PROGRAM", programs=[
            {"id": "P1", "name": "Show", "networkId": "N2", "startDate": "2018-01-05", "endDate": "2018-06-01", "media": "TV"},
            {"id": "P2", "name": "Lost", "networkId": "N404", "startDate": "2018-01-05", "endDate": "2018-06-01", "media": "TV"},
        ]),
    )
    return str(root)


@pytest.fixture()
def catalog(spark, tmp_path):
    cat = ParquetCatalog(spark, str(tmp_path / "tables"))
    cat.seed("tenant", spark.createDataFrame([(7, "T1")], "id long, mo_id string"))
    return cat


def _run(spark, feed, landing, catalog, **kw):
    run_feed(spark, feed, landing, catalog, multi_line=True, **kw)


def test_all_feeds_in_load_order(spark, landing, catalog):
    _run(spark, "advertiser", landing, catalog)
    clients = sorted(map(tuple, catalog.read("client").collect()))
    # earliest extract wins (name of January), advertiser without brands is absent
    assert clients == [(1, "A", "Acme", 7), (2, "B", "Bee", 7)]
    products = sorted(map(tuple, catalog.read("product").collect()))
    assert products == [("b1", "x", 1), ("b2", "y", 2)]

    _run(spark, "destination", landing, catalog)
    nets = sorted((r.id, r.mo_id, r.network_type) for r in catalog.read("network").collect())
    # N1's earliest row has no type: dedupe first, then the type filter drops it
    assert nets == [(1, "N2", "CABLE"), (2, "N3", "BROADCAST")]

    _run(spark, "estimate", landing, catalog)
    est = catalog.read("estimate").collect()
    assert [(r.mo_id, r.client_id, r.name, r.start_date) for r in est] == [("E1", 1, "first", dt.date(2018, 1, 1))]

    _run(spark, "daypart", landing, catalog)
    dps = sorted(((r.mo_id, r.client_id, r.tenant_id, r.name) for r in catalog.read("daypart").collect()), key=str)
    assert dps == sorted([("D1", 1, 7, "Morning"), ("D1", None, None, "Morning (no adv)"), ("D2", None, None, "Night")], key=str)

    _run(spark, "program", landing, catalog)
    progs = [(r.mo_id, r.network_id, r.tenant_id, r.start_date) for r in catalog.read("program").collect()]
    assert progs == [("P1", 1, 7, dt.date(2018, 1, 5))]  # unknown network dropped; start date from startDate


def test_missing_tenant_stops_before_any_write(spark, landing, tmp_path):
    cat = ParquetCatalog(spark, str(tmp_path / "t2"))
    cat.seed("tenant", spark.createDataFrame([(1, "OTHER")], "id long, mo_id string"))
    with pytest.raises(MissingParentError) as e:
        _run(spark, "advertiser", landing, cat)
    assert e.value.keys == ["T1"]
    assert cat.read("client").count() == 0 and cat.read("product").count() == 0


def test_missing_client_for_estimate_lists_advertiser_ids(spark, landing, catalog):
    with pytest.raises(MissingParentError) as e:
        _run(spark, "estimate", landing, catalog)
    assert e.value.keys == ["A"]


def test_rerun_appends_twice_but_only_new_does_not(spark, landing, catalog, tmp_path):
    _run(spark, "destination", landing, catalog)
    _run(spark, "destination", landing, catalog)
    assert catalog.read("network").count() == 4  # plain append: rows again, new ids
    cat2 = ParquetCatalog(spark, str(tmp_path / "t3"))
    cat2.seed("tenant", catalog.read("tenant"))
    _run(spark, "destination", landing, cat2, only_new=True)
    _run(spark, "destination", landing, cat2, only_new=True)
    assert sorted(r.id for r in cat2.read("network").collect()) == [1, 2]


def test_daypart_rerun_with_null_keys(spark, landing, catalog):
    _run(spark, "advertiser", landing, catalog)
    _run(spark, "daypart", landing, catalog, only_new=True)
    _run(spark, "daypart", landing, catalog, only_new=True)
    assert catalog.read("daypart").count() == 3


def test_unknown_feed(spark, landing, catalog):
    with pytest.raises(ValueError):
        run_feed(spark, "nosuchfeed", landing, catalog)
    assert main(["--feed", "nosuchfeed", "--landing", landing]) == 2


@pytest.mark.parametrize("partitions,bound", [(3, "0"), (17, "1000000")])
def test_same_result_for_any_partitioning_and_join_path(spark, landing, tmp_path, partitions, bound):
    """Order independence: shuffle width and broadcast or shuffled lookups give the same tables."""
    old_p = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("feedspark.lookup.broadcastMaxRows", bound)
    try:
        cat = ParquetCatalog(spark, str(tmp_path / f"t{partitions}"))
        cat.seed("tenant", spark.createDataFrame([(7, "T1")], "id long, mo_id string"))
        for feed in ("advertiser", "destination", "daypart", "program"):
            _run(spark, feed, landing, cat)
        got = {t: sorted(map(tuple, cat.read(t).collect()), key=str) for t in ("client", "product", "network", "daypart", "program")}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old_p)
        spark.conf.unset("feedspark.lookup.broadcastMaxRows")
    assert got["client"] == [(1, "A", "Acme", 7), (2, "B", "Bee", 7)]
    assert got["product"] == [("b1", "x", 1), ("b2", "y", 2)]
    assert [r[1] for r in got["network"]] == ["N2", "N3"]
    assert len(got["daypart"]) == 3 and len(got["program"]) == 1


def test_stage_in_cache_gives_same_tables(spark, landing, catalog, tmp_path):
    _run(spark, "advertiser", landing, catalog)
    cat2 = ParquetCatalog(spark, str(tmp_path / "staged"))
    cat2.seed("tenant", catalog.read("tenant"))
    _run(spark, "advertiser", landing, cat2, stage="cache")
    for t in ("client", "product"):
        assert sorted(map(tuple, cat2.read(t).collect())) == sorted(map(tuple, catalog.read(t).collect()))


def test_undated_files_stop_the_run_or_are_listed(spark, landing, catalog, tmp_path):
    from feedspark.sources import UndatedFilesError

    write_doc(landing, "DS-OO-NATIONAL-DESTINATIONFEED-latest", envelope(feed="DESTINATION", destinations=[]))
    with pytest.raises(UndatedFilesError, match="DESTINATIONFEED-latest"):
        _run(spark, "destination", landing, catalog)
    assert catalog.read("network").count() == 0
    listing = str(tmp_path / "undated")
    with pytest.raises(ValueError, match="list"):
        _run(spark, "destination", landing, catalog, undated="skip")
    for _ in range(2):
        _run(spark, "destination", landing, catalog, undated="skip", undated_list=listing, only_new=True)
    assert [r[0] for r in spark.read.parquet(listing).collect()] == ["DS-OO-NATIONAL-DESTINATIONFEED-latest"]
    assert catalog.read("network").count() == 2


def test_missing_keys_are_kept_in_full(spark):
    from feedspark.operators.lookup import resolve

    feed = spark.range(200).selectExpr("cast(id as string) as k")
    dim = spark.createDataFrame([("0", 1)], "d string, n int")
    with pytest.raises(MissingParentError) as e:
        resolve(feed, dim, "k", "d", miss="raise")
    assert len(e.value.keys) == 50 and e.value.more and spark.read.parquet(e.value.table).count() == 199


def test_cli_loads_a_feed(spark, landing, tmp_path):
    cat = ParquetCatalog(spark, str(tmp_path / "cli"))
    cat.seed("tenant", spark.createDataFrame([(7, "T1")], "id long, mo_id string"))
    assert main(["--feed", "destination", "--landing", landing, "--catalog", cat.root, "--multi-line", "--only-new"]) == 0
    assert sorted(r.mo_id for r in cat.read("network").collect()) == ["N2", "N3"]


def test_tenant_scoped_client_and_network(spark, landing, tmp_path):
    cat = ParquetCatalog(spark, str(tmp_path / "scoped"))
    cat.seed("tenant", spark.createDataFrame([(7, "T1"), (8, "T2")], "id long, mo_id string"))
    # advertiser A and network N2 exist under both tenants
    cat.seed("client", spark.createDataFrame([(1, "A", "a", 7), (2, "A", "a", 8)], "id long, mo_id string, name string, tenant_id long"))
    cat.seed("network", spark.createDataFrame([(5, "N2", 8), (6, "N2", 7)], "id long, mo_id string, tenant_id long"))
    _run(spark, "daypart", landing, cat)
    unscoped = sorted((r.mo_id, r.client_id) for r in cat.read("daypart").where("client_id is not null").collect())
    assert unscoped == [("D1", 1), ("D1", 2)]
    _run(spark, "program", landing, cat)
    assert sorted(r.network_id for r in cat.read("program").collect()) == [5]  # unscoped: one per key, smallest id wins

    cat2 = ParquetCatalog(spark, str(tmp_path / "scoped2"))
    for t in ("tenant", "client", "network"):
        cat2.seed(t, cat.read(t))
    _run(spark, "daypart", landing, cat2, tenant_scoped=True)
    scoped = sorted((r.mo_id, r.client_id, r.tenant_id) for r in cat2.read("daypart").where("client_id is not null").collect())
    assert scoped == [("D1", 1, 7)]
    _run(spark, "program", landing, cat2, tenant_scoped=True)
    assert [r.network_id for r in cat2.read("program").collect()] == [6]


def test_cli_all_feeds_in_load_order(spark, landing, tmp_path):
    cat = ParquetCatalog(spark, str(tmp_path / "all"))
    cat.seed("tenant", spark.createDataFrame([(7, "T1")], "id long, mo_id string"))
    assert main(["--feed", "all", "--landing", landing, "--catalog", cat.root, "--multi-line"]) == 0
    counts = {t: cat.read(t).count() for t in ("client", "product", "network", "estimate", "daypart", "program")}
    assert counts == {"client": 2, "product": 2, "network": 2, "estimate": 1, "daypart": 3, "program": 1}


def test_feed_without_files_loads_nothing(spark, tmp_path):
    land = tmp_path / "empty-landing"
    write_doc(land, "DS-OO-NATIONAL-PROGRAMFEED-20180102-100000", envelope(feed="PROGRAM", programs=[]))
    cat = ParquetCatalog(spark, str(tmp_path / "none"))
    cat.seed("tenant", spark.createDataFrame([(7, "T1")], "id long, mo_id string"))
    for feed in ("advertiser", "destination"):
        _run(spark, feed, str(land), cat)
    assert cat.read("client").count() == 0 and cat.read("network").count() == 0


def test_a_brand_under_two_advertisers_over_two_runs(spark, tmp_path):
    land, cat = str(tmp_path / "landing"), ParquetCatalog(spark, str(tmp_path / "tables"))
    cat.seed("tenant", spark.createDataFrame([(7, "T1")], "id long, mo_id string"))
    for day, adv in (("01", "A"), ("02", "B")):
        doc = envelope(ts=f"2018-01-{day}-10-00-00", advertiserMappedByMedia="N", advertisers=[{"id": adv, "name": adv, "media": "N", "brands": [{"id": "b1", "name": "x"}]}])
        write_doc(land, f"DS-ADVERTISERFEED-201801{day}", doc)
        _run(spark, "advertiser", land, cat, only_new=True)
    client = {r.mo_id: r.id for r in cat.read("client").collect()}
    assert [tuple(r) for r in cat.read("product").collect()] == [("b1", "x", client["A"])]


def test_a_new_lookup_row_reaches_rows_loaded_before(spark, tmp_path):
    land, cat = str(tmp_path / "landing"), ParquetCatalog(spark, str(tmp_path / "tables"))
    cat.seed("tenant", spark.createDataFrame([(7, "T1")], "id long, mo_id string"))
    network = "id long, mo_id string, name string, tenant_id long, media string, network_type string, nielsen_code string"
    cat.seed("network", spark.createDataFrame([(1, "N1", "n", 7, "m", "t", "c")], network))
    for k, (pid, net) in enumerate((("P1", "N1"), ("P2", "N2"), ("P3", "N1"))):
        doc = envelope(ts=f"2018-01-0{k + 1}-10-00-00", feed="PROGRAM", programs=[{"id": pid, "name": pid, "networkId": net, "media": "TV"}])
        write_doc(land, f"DS-PROGRAMFEED-2018010{k + 1}", doc)
        _run(spark, "program", land, cat, only_new=True)
        if k == 1:
            assert [r.mo_id for r in cat.read("program").collect()] == ["P1"]
            cat.seed("network", spark.createDataFrame([(1, "N1", "n", 7, "m", "t", "c"), (2, "N2", "n", 7, "m", "t", "c")], network))
    assert sorted((r.mo_id, r.network_id) for r in cat.read("program").collect()) == [("P1", 1), ("P2", 2), ("P3", 1)]


def test_staged_files_hold_a_bounded_number_of_rows(spark, monkeypatch):
    """However well the rows compress, no task gets many: files are not packed by their rows."""
    monkeypatch.setattr(loads, "STAGE_ROWS", 10, raising=False)
    rows = spark.range(95).selectExpr("0 AS same").coalesce(1)
    with loads.persisted(rows, stage="table") as held:
        per_file = held.groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in per_file) == 95 and max(r["count"] for r in per_file) == 10
