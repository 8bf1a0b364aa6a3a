"""File ledger, schema drift and tables by name."""
import json
import os
import uuid

import pytest

from feedspark.operators.lookup import resolve
from feedspark.plans import files as ledger_module
from feedspark.plans.catalog import JdbcCatalog, ParquetCatalog
from feedspark.plans.job import run_feed
from feedspark.session import scratch_path
from feedspark.sinks.tables import append_named
from feedspark.sources.drift import feed_drift, known_paths, schema_drift
from feedspark.sources.feeds import UndatedFilesError, landing_files
from feedspark.plans.specs import feed_spec
from tests.conftest import envelope, write_doc


def doc(ids, day="2018-01-02", tenant="T1"):
    rows = [{"id": i, "name": f"n{i}", "media": "m", "type": "t", "nielsenCode": "c"} for i in ids]
    return envelope(tenant, f"{day}-10-00-00", "DESTINATION", destinations=rows)


def name(day, extra=""):
    return f"DS-OO-NATIONAL-DESTINATIONFEED-{day}-000000{extra}"


@pytest.fixture
def place(spark, tmp_path):
    cat = ParquetCatalog(spark, str(tmp_path / "tables"))
    cat.seed("tenant", spark.createDataFrame([(7, "T1"), (8, "T2")], "id long, mo_id string"))
    return str(tmp_path / "landing"), cat


def loaded(cat):
    return sorted(r.mo_id for r in cat.read("network").collect())


def ledgered(cat):
    folders = cat.state().get("files", {}).get("destination", [])
    return [sorted(os.path.basename(r.path) for r in cat.open([f]).collect()) for f in folders]


def spoil(path):
    """Other content of the same size and time: seen only if the file is opened."""
    s = os.stat(path)
    with open(path, "w") as fh:
        fh.write("x" * s.st_size)
    os.utime(path, ns=(s.st_atime_ns, s.st_mtime_ns))


@pytest.mark.parametrize("multi_line", [True, None])
def test_second_run_opens_only_unseen_files(spark, place, multi_line):
    root, cat = place
    first = write_doc(root, name(20180102), doc(["1", "2"]))
    run_feed(spark, "destination", root, cat, multi_line=multi_line, only_new=True)
    spoil(first)
    # characters that a path pattern would take for something else
    write_doc(root, name(20180103, "-[a]{b}"), doc(["3"], "2018-01-03"))
    run_feed(spark, "destination", root, cat, multi_line=multi_line, only_new=True)
    assert loaded(cat) == ["1", "2", "3"]
    assert ledgered(cat) == [[name(20180102)], [name(20180103, "-[a]{b}")]]
    run_feed(spark, "destination", root, cat, multi_line=multi_line, only_new=True)
    assert len(ledgered(cat)) == 2


def test_changed_file_is_read_again(spark, place):
    root, cat = place
    path = write_doc(root, name(20180102), doc(["1"]))
    run_feed(spark, "destination", root, cat, multi_line=True, only_new=True)
    write_doc(root, name(20180102), doc(["1", "2"]))
    os.utime(path, (1_600_000_000, 1_600_000_000))
    run_feed(spark, "destination", root, cat, multi_line=True, only_new=True)
    assert loaded(cat) == ["1", "2"]
    assert ledgered(cat) == [[name(20180102)], [name(20180102)]]


def test_cutoff_leaves_files_for_a_later_run(spark, place):
    root, cat = place
    write_doc(root, name(20180102), doc(["1"]))
    write_doc(root, name(20180301), doc(["2"], "2018-03-01"))
    run_feed(spark, "destination", root, cat, multi_line=True, only_new=True, since=20180201)
    assert loaded(cat) == ["2"]
    run_feed(spark, "destination", root, cat, multi_line=True, only_new=True)
    assert loaded(cat) == ["1", "2"]


def test_stopped_run_knows_no_file(spark, place):
    root, cat = place
    write_doc(root, name(20180102), doc(["1"]))
    bad = write_doc(root, name(20180103), "{", raw=True)
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        run_feed(spark, "destination", root, cat, multi_line=True, only_new=True)
    assert ledgered(cat) == [] and loaded(cat) == []
    write_doc(root, os.path.basename(bad), doc(["2"], "2018-01-03"))
    run_feed(spark, "destination", root, cat, multi_line=True, only_new=True)
    assert loaded(cat) == ["1", "2"]


def test_bad_documents_are_kept_before_their_file_is_known(spark, place, tmp_path):
    root, cat = place
    write_doc(root, name(20180102), json.dumps(doc(["1"])) + "\n{\n", raw=True)
    kept = str(tmp_path / "kept")
    os.makedirs(kept)
    (tmp_path / "kept" / "part-0.parquet").write_text("not parquet")  # the quarantine cannot be read
    options = dict(multi_line=False, only_new=True, mode="PERMISSIVE")
    with pytest.raises(Exception):
        run_feed(spark, "destination", root, cat, quarantine=kept, **options)
    assert ledgered(cat) == [] and loaded(cat) == []
    for _ in range(2):
        run_feed(spark, "destination", root, cat, quarantine=kept + "-2", **options)
    assert loaded(cat) == ["1"]
    assert spark.read.parquet(kept + "-2").count() == 1


def test_more_files_than_a_scan_names_are_all_read(spark, place, monkeypatch):
    root, cat = place
    monkeypatch.setattr(ledger_module, "LISTED", 1)
    for i in (2, 3, 4):
        write_doc(root, name(20180100 + i), doc([str(i)], f"2018-01-0{i}"))
    run_feed(spark, "destination", root, cat, multi_line=True, only_new=True)
    assert loaded(cat) == ["2", "3", "4"] and len(ledgered(cat)[0]) == 3


def test_ledger_of_files_is_folded_and_survives_vacuum(spark, place, monkeypatch):
    root, cat = place
    monkeypatch.setattr(ledger_module, "FOLD_FILES", 1)
    paths = []
    for i in (2, 3):
        paths.append(write_doc(root, name(20180100 + i), doc([str(i)], f"2018-01-0{i}")))
        run_feed(spark, "destination", root, cat, multi_line=True, only_new=True)
    assert ledgered(cat) == [[name(20180102), name(20180103)]]
    cat.vacuum(keep=1)
    for p in paths:
        spoil(p)
    run_feed(spark, "destination", root, cat, multi_line=True, only_new=True)
    assert loaded(cat) == ["2", "3"]


def test_undated_files_and_empty_places(spark, place, tmp_path):
    root, cat = place
    write_doc(root, "DS-OO-NATIONAL-DESTINATIONFEED", doc(["1"]))
    with pytest.raises(UndatedFilesError):
        run_feed(spark, "destination", root, cat, multi_line=True, only_new=True)
    run_feed(spark, "destination", root, cat, multi_line=True, only_new=True, undated="skip", undated_list=str(tmp_path / "undated"))
    assert loaded(cat) == [] and spark.read.parquet(str(tmp_path / "undated")).count() == 1
    assert landing_files(spark, root, "program").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        landing_files(spark, root + "-none", "program")
    with pytest.raises(ValueError, match="ledgers"):
        run_feed(spark, "destination", root, JdbcCatalog(spark, "jdbc:x", {}), only_new=True)


# --- drift ------------------------------------------------------------------------------

def drift(spark, docs, feed="advertiser"):
    rows = spark.createDataFrame([(d if d is None or isinstance(d, str) else json.dumps(d),) for d in docs], "value string")
    return sorted(((r.path, r.expected, r.found, r.n) for r in schema_drift(rows, "value", feed).collect()), key=str)


def plain(value, known, path="$"):
    """The same walk over one parsed document."""
    kind = "OBJECT" if isinstance(value, dict) else "ARRAY" if isinstance(value, list) else None if value is None else "SCALAR"
    if kind is None:
        return []
    if known.get(path) != kind:
        return [(path, known.get(path), kind)]
    if kind == "OBJECT":
        return [x for k, v in value.items() for x in plain(v, known, f"{path}.{k}")]
    return [x for v in value for x in plain(v, known, f"{path}[]")] if kind == "ARRAY" else []


def test_drift_equals_a_plain_walk(spark):
    brand = {"id": "b", "name": "x"}
    docs = [
        envelope(advertisers=[{"id": "a", "name": "n", "media": "m", "brands": [brand, {**brand, "color": {"deep": [1]}}]}]),
        envelope(advertisers=[{"id": {"v": 1}, "brands": brand}, "text", None, [1]], extra=[[1], 2], region=None),
        envelope(advertisers={"id": "a"}, Tenant="T"),
        {"advertisers": []}, {}, [], "just text", 5,
    ]
    known, want = known_paths(feed_spec("advertiser").schema), {}
    for d in docs:
        for place in plain(d, known):
            want[place] = want.get(place, 0) + 1
    texts = [json.dumps(d) for d in docs] + ["{broken", "", None]
    assert drift(spark, texts) == sorted(((*p, n) for p, n in want.items()), key=str)
    assert ("$.advertisers[].brands[].color", None, "OBJECT", 1) in drift(spark, texts)


@pytest.mark.parametrize("feed", ["advertiser", "destination", "estimate", "daypart", "program"])
def test_empty_table_has_no_drift(spark, feed):
    assert drift(spark, [], feed) == []


def test_drift_of_landing_files(spark, tmp_path):
    root = str(tmp_path / "landing")
    write_doc(root, name(20180102), {**doc(["1"]), "region": {"a": 1}})
    write_doc(root, name(20170102), {**doc(["1"]), "old": 1})
    write_doc(root, name(20180103), doc(["1"]))
    rows = feed_drift(spark, root, "destination", since=20180101, multi_line=True).collect()
    assert [(r._feed_file, r.path, r.found, r.n) for r in rows] == [(name(20180102), "$.region", "OBJECT", 1)]
    assert feed_drift(spark, root, "program").count() == 0


# --- tables by name ---------------------------------------------------------------------

def test_bucketed_tables_join_without_a_shuffle(spark):
    tag = uuid.uuid4().hex
    feed = spark.range(200).selectExpr("id", "if(id % 10 = 0, null, cast(id % 50 as string)) AS k")
    dim = spark.range(40).selectExpr("cast(id as string) AS p", "id AS parent")
    for table, rows, key in ((f"f_{tag}", feed, "k"), (f"d_{tag}", dim, "p")):
        path = scratch_path(spark, table)
        append_named(rows.where("id < 100") if key == "k" else rows, table, path=path, bucket_by=[key], buckets=4)
        if key == "k":
            append_named(rows.where("id >= 100"), table, path=path, bucket_by=[key], buckets=4)
    try:
        f, d = spark.table(f"f_{tag}"), spark.table(f"d_{tag}")
        assert f.count() == 200
        joined = resolve(f, d, "k", "p", laid_out=True)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Broadcast" not in plan
        assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, resolve(feed, dim, "k", "p").collect()), key=str)
        with pytest.raises(ValueError, match="broadcast"):
            resolve(f, d, "k", "p", laid_out=True, broadcast=True)
        with pytest.raises(ValueError, match="together"):
            append_named(feed, f"f_{tag}", bucket_by=["k"])
    finally:
        spark.sql(f"DROP TABLE IF EXISTS f_{tag}")
        spark.sql(f"DROP TABLE IF EXISTS d_{tag}")


def test_plain_table_by_name(spark):
    table = f"plain_{uuid.uuid4().hex}"
    path = scratch_path(spark, table)
    try:
        append_named(spark.range(3), table, path=path)
        append_named(spark.range(2), table, path=path)
        assert spark.table(table).count() == 5
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
