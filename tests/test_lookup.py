import pytest

from feedspark.operators.lookup import MissingParentError, missing_parents, require_parents, resolve

FEED = [("A", "T1"), ("B", "T2"), ("C", None), ("D", "T9")]
DIM = [(1, "T1"), (2, "T2"), (3, "T3")]


@pytest.fixture()
def frames(spark):
    feed = spark.createDataFrame(FEED, "advertiser_id string, tenant string")
    dim = spark.createDataFrame(DIM, "tenant_id long, tenant_mo_id string")
    return feed, dim


@pytest.mark.parametrize("broadcast", [True, False])
def test_keep_policy_keeps_misses_and_null_keys(frames, broadcast):
    feed, dim = frames
    out = resolve(feed, dim, "tenant", "tenant_mo_id", miss="keep", broadcast=broadcast)
    got = sorted((r.advertiser_id, r.tenant_id) for r in out.collect())
    assert got == [("A", 1), ("B", 2), ("C", None), ("D", None)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_drop_policy(frames, broadcast):
    feed, dim = frames
    out = resolve(feed, dim, "tenant", "tenant_mo_id", miss="drop", broadcast=broadcast)
    assert sorted(r.advertiser_id for r in out.collect()) == ["A", "B"]


def test_raise_policy_lists_missing_including_null(frames):
    feed, dim = frames
    with pytest.raises(MissingParentError) as e:
        resolve(feed, dim, "tenant", "tenant_mo_id", miss="raise", what="Tenants")
    assert sorted(e.value.keys, key=str) == sorted([None, "T9"], key=str)
    assert str(e.value).startswith("Tenants missing:")


def test_raise_policy_passes_when_all_present(spark, frames):
    _, dim = frames
    feed = spark.createDataFrame([("A", "T1")], "advertiser_id string, tenant string")
    assert resolve(feed, dim, "tenant", "tenant_mo_id", miss="raise").count() == 1


def test_missing_list_is_bounded(spark):
    feed = spark.range(100).selectExpr("cast(id as string) as k")
    dim = spark.createDataFrame([("x",)], "mo string")
    with pytest.raises(MissingParentError) as e:
        require_parents(feed, dim, "k", "mo", show=5)
    assert len(e.value.keys) == 5 and e.value.more
    assert missing_parents(feed, dim, "k", "mo").count() == 100


def test_fan_out_and_scoped_match(spark):
    feed = spark.createDataFrame([("A", 1)], "advertiser_id string, feed_tenant long")
    dim = spark.createDataFrame([(10, "A", 1), (20, "A", 2), (10, "A", 1)], "client_id long, client_mo_id string, tenant_id long")
    assert resolve(feed, dim, "advertiser_id", "client_mo_id").count() == 3  # every copy matches
    scoped = resolve(feed, dim.dropDuplicates(), ["advertiser_id", "feed_tenant"], ["client_mo_id", "tenant_id"])
    assert [(r.client_id, r.tenant_id) for r in scoped.collect()] == [(10, 1)]


def test_broadcast_only_below_bound(frames):
    feed, dim = frames
    small = resolve(feed, dim, "tenant", "tenant_mo_id", max_broadcast_rows=10)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString() or "Broadcast" in _plan(small)
    big = resolve(feed, dim, "tenant", "tenant_mo_id", max_broadcast_rows=2)
    plan = _plan(big)
    # shuffled join keyed on (key, salt): null keys spread over partitions
    assert "SortMergeJoin" in plan and "_lookup_salt" in plan and "Union" not in plan


def _plan(df):
    import io
    from contextlib import redirect_stdout

    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_broadcast_bound_on_bytes_too(spark):
    wide = spark.range(100).selectExpr("cast(id as string) as k", "repeat('x', 1000) as payload")
    from feedspark.operators.lookup import fits_broadcast

    assert fits_broadcast(wide, max_rows=1000, max_bytes=10_000_000)
    assert not fits_broadcast(wide, max_rows=1000, max_bytes=50_000)  # ~100 kB of values
    assert not fits_broadcast(wide, max_rows=99, max_bytes=10_000_000)


def test_shuffled_missing_parents_moves_distinct_keys(spark):
    """Spark moves an anti join below the distinct; all rows of the feed would cross it then."""
    feed = spark.range(1000).selectExpr("concat('k', id % 5) AS k", "if(id % 7 = 0, NULL, id % 2) AS t")
    dim = spark.createDataFrame([("k0", 0), ("k0", 0), ("k1", 1), ("k3", 0), (None, 1)], "mo string, tenant long")
    for left, right, lacking in (("k", "mo", {("k2",), ("k4",)}), (["k", "t"], ["mo", "tenant"], {(f"k{i}", t) for i in range(5) for t in (0, 1, None)} - {("k0", 0), ("k1", 1), ("k3", 0)})):
        missing = missing_parents(feed, dim, left, right, broadcast=False)
        plan = missing._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Join") < plan.index("Aggregate")
        assert {tuple(r) for r in missing.collect()} == {tuple(r) for r in missing_parents(feed, dim, left, right, broadcast=True).collect()} == lacking
