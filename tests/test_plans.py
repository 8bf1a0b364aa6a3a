"""Plan properties of the load pipelines on a derived landing area (sf0.001)."""
import io
from contextlib import redirect_stdout

import pytest

from feedspark.plans import landing as L
from feedspark.plans import loads
from feedspark.plans import registry as R
from feedspark.sources.lookups import tenant_lookup

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def flats(spark):
    return {f: R.flat_feed(spark, SF, f) for f in L.BUILDERS}


def test_scan_reads_only_needed_columns_of_one_feed(spark, flats):
    plan = _plan(flats["destination"].select("tenant", "id"))
    import re

    assert len(re.findall(r"^\(\d+\) Scan json", plan, re.M)) == 1
    read_schema = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")][0]
    # top-level envelope fields not asked for are not read
    assert "filename" not in read_schema and "moSystem" not in read_schema


def test_loads_have_no_python_and_limit_before_shuffle(spark, flats):
    seeds = L.seed_lookups(spark, SF)
    tenant = seeds["tenant"]
    plans = {
        "client": loads.client_rows(loads.with_tenant(flats["advertiser"], tenant, miss="keep")),
        "network": loads.network_rows(loads.with_tenant(flats["destination"], tenant, miss="keep")),
        "estimate": loads.estimate_rows(loads.with_client(flats["estimate"], seeds["client"], miss="keep")),
        "daypart": loads.daypart_rows(loads.with_client(flats["daypart"], seeds["client"], miss="keep")),
        "program": loads.program_rows(loads.with_network(loads.with_tenant(flats["program"], tenant, miss="keep"), seeds["network"])),
    }
    for name, df in plans.items():
        plan = _plan(df)
        assert not any(p in plan for p in PYTHON_NODES), name
        assert "WindowGroupLimit" in plan, name
        assert "BroadcastHashJoin" in plan, name  # small lookups broadcast after the size check


def test_missing_parent_check_is_distinct_then_anti_join(spark, flats):
    from feedspark.operators.lookup import missing_parents

    seeds = L.seed_lookups(spark, SF)
    plan = _plan(missing_parents(flats["advertiser"], tenant_lookup(seeds["tenant"]), "tenant", "tenant_mo_id"))
    assert "LeftAnti" in plan and "HashAggregate" in plan


def test_each_load_is_one_scan_and_one_shuffle(spark):
    """With checked broadcasts: one JSON scan and one shuffle (the first-seen window) per load;
    with shuffled lookups still one scan (null keys are salted, not split off)."""
    import os
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
    from plan_report import rows_plans, shape

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, df in rows_plans(spark, SF).items():
            s = shape(df)
            assert s["json scans"] == 1 and s["shuffles"] == 1 and s["partial window limits"] == 1, (name, s)
        spark.conf.set("feedspark.lookup.broadcastMaxRows", "0")
        # Spark's own broadcasts are on again: the joins are hinted
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name, df in rows_plans(spark, SF).items():
            s = shape(df)
            assert s["json scans"] == 1 and s["broadcasts"] == 0 and s["sort-merge joins"] >= 1, (name, s)
            assert s["shuffles"] == 1 + 2 * s["sort-merge joins"], (name, s)
    finally:
        spark.conf.unset("feedspark.lookup.broadcastMaxRows")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_load_scan_reads_only_needed_nested_fields(spark):
    from feedspark.plans.loads import NEEDED

    flat = R.flat_feed(spark, SF, "advertiser", NEEDED["advertiser"])
    read_schema = [ln for ln in _plan(flat).splitlines() if ln.startswith("ReadSchema")][0]
    # the advertiser's media is inside the exploded array: Spark would read it, the load does not
    assert "media" not in read_schema and "brands" in read_schema
    est = R.flat_feed(spark, SF, "estimate", NEEDED["estimate"])
    assert "brandId" not in [ln for ln in _plan(est).splitlines() if ln.startswith("ReadSchema")][0]


def test_size_check_moves_no_row_of_the_lookup(spark, tmp_path):
    """One partial aggregate: no limit, and only one row a task leaves the map side."""
    spark.range(5000).selectExpr("id as tenant_id", "cast(id as string) as tenant_mo_id").write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    from feedspark.operators import lookup

    seen = []
    kind = type(dim)
    first = kind.first
    try:
        kind.first = lambda self: (seen.append(self._jdf.queryExecution().executedPlan().toString()), first(self))[1]
        assert lookup.fits_broadcast(dim, 10_000, 1 << 20) and not lookup.fits_broadcast(dim, 4_999, 1 << 20)
    finally:
        kind.first = first
    assert len(seen) == 2 and all("Limit" not in p and "partial_count" in p for p in seen)
