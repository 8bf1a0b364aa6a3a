"""Commits, id ranges, delta ledgers and what follows a change of a lookup."""
import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from feedspark.plans import incremental, loads
from feedspark.plans.catalog import ParquetCatalog
from feedspark.plans.commits import ConcurrentRunError

KINDS = {"extract_datetime": "timestamp", "start_date": "date", "end_date": "date", "program_start_date": "date", "program_end_date": "date"}
NETWORK = "id long, mo_id string, name string, tenant_id long, media string, network_type string, nielsen_code string"
CLIENT = "id long, mo_id string, name string, tenant_id long"


def flat(spark, feed, rows):
    """Rows of (day, {column: value}); the tenant is T1 unless given."""
    cols = loads.NEEDED[feed]
    data = [tuple({"tenant": "T1", "extract_datetime": dt.datetime(2018, 1, day), **r}.get(c) for c in cols) for day, r in rows]
    return spark.createDataFrame(data, ", ".join(f"{c} {KINDS.get(c, 'string')}" for c in cols))


def seeded(spark, path, kind=ParquetCatalog):
    cat = kind(spark, str(path))
    cat.seed("tenant", spark.createDataFrame([(7, "T1"), (8, "T2")], "id long, mo_id string"))
    return cat


def adv(a, b, name="n", brand="x"):
    return {"advertiser_id": a, "advertiser_name": name, "brand_id": b, "brand_name": brand}


def dest(i, kind="t", name="n"):
    return {"id": i, "name": name, "media": "m", "type": kind, "nielsen_code": "c"}


# a first run, and a second one with new, corrected and withdrawn rows
RUNS = {
    "advertiser": ([(5, adv("A", "b1")), (5, adv("B", "b2")), (6, adv("B", "b1"))], [(1, adv("A", "b1", "earlier", "y")), (2, adv("B", "b1")), (7, adv("C", "b3"))]),
    "destination": ([(5, dest("N1")), (5, dest("N2")), (6, dest("N3"))], [(1, dest("N2", None)), (2, dest("N3", "u", "old")), (7, dest("N4"))]),
    "estimate": ([(5, {"id": "E1", "advertiser_id": "A", "media": "m"}), (5, {"id": "E2", "advertiser_id": "B"})], [(1, {"id": "E1", "advertiser_id": "A", "media": "k"}), (7, {"id": "E3", "advertiser_id": "B"})]),
    "daypart": ([(5, {"id": "D1", "advertiser_id": "A", "media": "m"}), (5, {"id": "D2"})], [(1, {"id": "D2", "media": "k"}), (7, {"id": "D1", "advertiser_id": "B"})]),
    "program": ([(5, {"program_id": "P1", "program_network_id": "N1"}), (5, {"program_id": "P2", "program_network_id": "N9"})], [(1, {"program_id": "P1", "program_network_id": "N2"}), (7, {"program_id": "P3", "program_network_id": "N1"})]),
}


def with_lookups(spark, cat):
    cat.seed("client", spark.createDataFrame([(1, "A", "a", 7), (2, "B", "b", 7)], CLIENT))
    cat.seed("network", spark.createDataFrame([(1, "N1", "n", 7, "m", "t", "c"), (2, "N2", "n", 7, "m", "t", "c")], NETWORK))


def content(cat, feed):
    """Rows of a feed's targets, ids replaced by external ids."""
    if feed == "advertiser":
        client = {r.id: (r.mo_id, r.tenant_id) for r in cat.read("client").collect()}
        assert len(client) == cat.read("client").count()
        return sorted((r.mo_id, r.name, r.tenant_id) for r in cat.read("client").collect()), sorted((r.mo_id, r.name, client[r.client_id]) for r in cat.read("product").collect())
    table = {"destination": "network"}.get(feed, feed)
    return sorted(map(tuple, cat.read(table).drop("id").collect() if table == "network" else cat.read(table).collect()), key=str)


class Stop(Exception):
    pass


class Stopping(ParquetCatalog):
    """Stops before (even steps) or after (odd ones) a write, and at the commit."""

    left = None

    def _step(self):
        if self.left is not None:
            self.left -= 1
            if self.left < 0:
                raise Stop

    def store(self, name, df):
        self._step()
        out = super().store(name, df)
        self._step()
        return out

    def reserve(self, table, n):
        out = super().reserve(table, n)
        self._step()
        return out


@pytest.mark.parametrize("feed,every", [("destination", 1), ("advertiser", 3), ("estimate", 4), ("daypart", 4), ("program", 4)])
def test_a_run_stopped_at_any_write_changes_nothing_and_is_repeated(spark, tmp_path, feed, every):
    first, second = (flat(spark, feed, r) for r in RUNS[feed])
    whole, cat = seeded(spark, tmp_path / "whole"), seeded(spark, tmp_path / "stopped", Stopping)
    for c in (whole, cat):
        if feed not in ("advertiser", "destination"):
            with_lookups(spark, c)
    loads.LOADERS[feed](first.unionByName(second), whole, only_new=True)
    loads.LOADERS[feed](first, cat, only_new=True)
    before, stops, step = cat.state(), 0, 0
    while True:
        cat.left = step
        try:
            loads.LOADERS[feed](second, cat, only_new=True)
            break
        except Stop:
            assert cat.state() == before
            stops, step = stops + 1, step + every
    cat.left = None
    assert stops >= 2 and content(cat, feed) == content(whole, feed)
    loads.LOADERS[feed](second, cat, only_new=True)
    assert content(cat, feed) == content(whole, feed)


def test_a_stop_at_the_commit_itself_changes_nothing(spark, tmp_path, monkeypatch):
    cat = seeded(spark, tmp_path / "t")
    loads.load_destination(flat(spark, "destination", RUNS["destination"][0]), cat, only_new=True)
    before = content(cat, "destination")
    monkeypatch.setattr(cat.log, "create", lambda *a: (_ for _ in ()).throw(Stop()))
    with pytest.raises(Stop):
        loads.load_destination(flat(spark, "destination", RUNS["destination"][1]), cat, only_new=True)
    assert content(ParquetCatalog(spark, cat.root), "destination") == before


def test_withdrawn_ids_never_return(spark, tmp_path):
    cat = seeded(spark, tmp_path / "t")
    loads.load_destination(flat(spark, "destination", [(5, dest("A")), (5, dest("B"))]), cat, only_new=True)
    loads.load_destination(flat(spark, "destination", [(1, dest("B", None))]), cat, only_new=True)
    assert [(r.id, r.mo_id) for r in cat.read("network").collect()] == [(1, "A")]
    loads.load_destination(flat(spark, "destination", [(6, dest("C"))]), cat, only_new=True)
    assert sorted((r.id, r.mo_id) for r in cat.read("network").collect()) == [(1, "A"), (3, "C")]


def test_writers_at_once_get_distinct_ids(spark, tmp_path):
    cats = [ParquetCatalog(spark, str(tmp_path / "t")) for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        starts = list(pool.map(lambda k: cats[k % 4].reserve("client", 3), range(24)))
    assert sorted(starts) == list(range(1, 72, 3))


def test_of_two_runs_from_one_state_one_is_told(spark, tmp_path):
    one, two = seeded(spark, tmp_path / "t"), ParquetCatalog(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame([("N", "n", 7, "m", "t", "c")], NETWORK.removeprefix("id long, "))
    with pytest.raises(ConcurrentRunError):
        with one.transaction():
            one.append("network", rows)
            two.append("network", rows)
    assert [r.id for r in one.read("network").collect()] == [2]


def test_vacuum_keeps_what_is_named(spark, tmp_path):
    cat = seeded(spark, tmp_path / "t", Stopping)
    for rows in RUNS["destination"]:
        loads.load_destination(flat(spark, "destination", rows), cat, only_new=True)
    cat.left = 1
    with pytest.raises(Stop):
        cat.rewrite("network", cat.read("network"))
    cat.left = None
    want = content(cat, "destination")
    assert cat.vacuum(keep=1) and not cat.vacuum(keep=1)
    assert content(cat, "destination") == want and len(cat.log.names()) == 1


def _bytes(root, folders):
    return sum(os.path.getsize(os.path.join(root, f, x)) for f in folders for x in os.listdir(os.path.join(root, f)) if x.endswith(".parquet"))


def test_few_new_keys_write_few_bytes(spark, tmp_path):
    cat, whole = seeded(spark, tmp_path / "t"), seeded(spark, tmp_path / "w")
    rows = flat(spark, "destination", [(5, dest(f"N{i}", name=f"name {i * 7919 % 10007}")) for i in range(20_000)]).coalesce(1)
    loads.load_destination(rows, cat, only_new=True)
    some = flat(spark, "destination", [(6, dest(f"N{i}")) for i in range(19_000, 20_200)]).coalesce(1)
    loads.load_destination(some, cat, only_new=True)
    base, delta = cat.state()["ledgers"]["network"]["folders"]
    assert _bytes(cat.root, [delta]) < 0.05 * _bytes(cat.root, [base]) and cat.state()["ledgers"]["network"]["rows"] == [20_000, 200]
    loads.load_destination(rows.unionByName(some), whole, only_new=True)
    assert content(cat, "destination") == content(whole, "destination")
    # deltas of half the base are folded into it
    loads.load_destination(flat(spark, "destination", [(7, dest(f"M{i}")) for i in range(10_001)]), cat, only_new=True)
    assert cat.state()["ledgers"]["network"]["rows"] == [30_201]


def test_only_entities_that_a_lookup_change_reaches_are_derived(spark, tmp_path, monkeypatch):
    cat = seeded(spark, tmp_path / "t")
    with_lookups(spark, cat)
    loads.load_estimate(flat(spark, "estimate", [(5, {"id": f"E{i}", "advertiser_id": "AB"[i % 10 == 0]}) for i in range(100)]), cat, only_new=True)
    derived, sync = [], incremental.sync_target
    monkeypatch.setattr(incremental, "sync_target", lambda c, t, wanted, k, entities, *a: (derived.append(entities.count()), sync(c, t, wanted, k, entities, *a)))
    none = flat(spark, "estimate", RUNS["estimate"][0]).limit(0)
    loads.load_estimate(none, cat, only_new=True)
    assert derived == []
    # B's id changes, C is new and reaches nothing
    cat.seed("client", spark.createDataFrame([(1, "A", "renamed", 7), (5, "B", "b", 7), (6, "C", "c", 8)], CLIENT))
    loads.load_estimate(none, cat, only_new=True)
    assert derived == [10]
    assert sorted({(r.client_id, int(r.mo_id[1:]) % 10 == 0) for r in cat.read("estimate").collect()}) == [(1, False), (5, True)]


def test_a_plain_folder_changed_by_others_is_followed(spark, tmp_path):
    cat = seeded(spark, tmp_path / "t")
    path = f"{cat.root}/client"
    spark.createDataFrame([(1, "A", "a", 7), (2, "B", "b", 7)], CLIENT).write.parquet(path)
    rows = flat(spark, "estimate", RUNS["estimate"][0])
    loads.load_estimate(rows, cat, only_new=True)
    spark.createDataFrame([(1, "A", "a", 7), (9, "B", "b", 7)], CLIENT).write.mode("overwrite").parquet(path)
    loads.load_estimate(rows, cat, only_new=True)
    assert sorted((r.mo_id, r.client_id) for r in cat.read("estimate").collect()) == [("E1", 1), ("E2", 9)]
