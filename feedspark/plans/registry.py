"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Feed queries first derive a landing area from the driver tables
(:mod:`feedspark.plans.landing`) - once per session and scale - then run the
library on it. Timestamps leave as ``timestamp_ntz`` (wall clock, as the
tables hold them).
"""
from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import name_date, select_names
from ..operators.dedupe import first_seen
from ..operators.flatten import flatten
from ..operators.keys import assign_ids
from ..operators.lookup import BROADCAST_ROWS_CONF, MissingParentError, missing_parents, resolve
from ..operators.union import union_sources
from ..session import scratch_path
from ..sinks.tables import append_named, append_table, new_rows, overwrite_partitions
from ..sources.drift import feed_drift
from ..sources.feeds import FILE_COL, parse_feed, scan_feed, split_corrupt, undated_files
from ..sources.lookups import as_lookup, client_lookup, tenant_lookup
from . import landing as L
from . import loads
from .catalog import ParquetCatalog
from .job import run_feed

_lock = threading.Lock()
_landing: dict[tuple[str, str], tuple[str, set[str]]] = {}
_loaded: dict[tuple[str, str, str], ParquetCatalog] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"))


def landing_root(spark: SparkSession, sf_dir: str, feeds=tuple(L.BUILDERS)) -> str:
    """One landing root per session and scale; each feed derived from
    ``sf_dir`` is written into it the first time a query needs it."""
    k = _key(spark, sf_dir)
    with _lock:
        if k not in _landing:
            _landing[k] = (scratch_path(spark, "landing"), set())
        root, written = _landing[k]
        missing = [f for f in L.BUILDERS if f in feeds and f not in written]
        if missing:
            L.write_landing(spark, sf_dir, root, missing)
            written.update(missing)
        return root


def flat_feed(spark: SparkSession, sf_dir: str, feed: str, columns=None) -> DataFrame:
    """Flat rows of one derived feed (all columns, or only ``columns``)."""
    return flatten(scan_feed(spark, landing_root(spark, sf_dir, (feed,)), feed, columns=columns), feed, columns=columns)


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def loaded_catalog(spark: SparkSession, sf_dir: str, feed: str) -> ParquetCatalog:
    """A fresh catalog holding the lookups a feed needs, after loading the feed."""
    k = _key(spark, sf_dir) + (feed,)
    with _lock:
        if k in _loaded:
            return _loaded[k]
    cat = ParquetCatalog(spark, scratch_path(spark, f"catalog-{feed}"))
    seeds = L.seed_lookups(spark, sf_dir)
    cat.seed("tenant", seeds["tenant"])
    if feed in ("estimate", "daypart"):
        cat.seed("client", seeds["client"])
    if feed == "program":
        cat.seed("network", seeds["network"])
    loads.LOADERS[feed](flat_feed(spark, sf_dir, feed, loads.NEEDED[feed]), cat)
    with _lock:
        _loaded[k] = cat
    return cat


# --- scans and flattening -----------------------------------------------------

def _file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    base = F.concat(F.lit("ds-oo-national-"), F.col("event_type"), F.lit("feed"))
    name = F.when(F.col("event_id") % 50 == 0, base).otherwise(
        F.concat(base, F.lit("-"), F.date_format("ts", "yyyyMMdd-HHmmss"))
    )
    return ev.select("event_id", name.alias("file_name"))


def q_feed_file_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _file_names(spark, sf_dir)
    return files.where(select_names("file_name", "clickfeed", since=20240115)).select(
        "event_id", "file_name", name_date("file_name").alias("file_date")
    )


def q_json_scan_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(flat_feed(spark, sf_dir, "advertiser"), "extract_datetime")


def _advertiser_text_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.advertiser_documents(L.read_tables(spark, sf_dir)).select("value")


def q_flatten_drops_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parse_feed(_advertiser_text_docs(spark, sf_dir), "value", "advertiser")
    flat = flatten(docs, "advertiser")
    return _ntz(flat.select("tenant", "extract_datetime", "advertiser_id", "brand_id"), "extract_datetime")


def q_flatten_keeps_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parse_feed(_advertiser_text_docs(spark, sf_dir), "value", "advertiser")
    flat = flatten(docs, "advertiser", keep_empty=True)
    return _ntz(flat.select("tenant", "extract_datetime", "advertiser_id", "brand_id"), "extract_datetime")


def q_estimate_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flat_feed(spark, sf_dir, "estimate")
    out = flat.select(
        "tenant", "extract_datetime", "id", "estimate_name", "start_date", "end_date", "media", "advertiser_id", "brand_id",
        F.concat_ws(",", "brand_ids").alias("brand_list"),
    )
    return _ntz(out, "extract_datetime")


def q_union_all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    a = orders.where(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")).select("o_orderkey", "o_custkey", "o_orderdate")
    b = orders.where(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    return union_sources([a, b])


def q_feed_since_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advertiser files dated after 1998-01-01 only (pruned by name before reading)."""
    docs = scan_feed(spark, landing_root(spark, sf_dir, ("advertiser",)), "advertiser", since=19980101)
    flat = flatten(docs, "advertiser")
    return _ntz(flat.select("filename", "extract_datetime", "advertiser_id", "brand_id"), "extract_datetime")


# fixed value of the derived broken documents: chunks of this residue are cut short
BROKEN_CHUNK_RESIDUE = 3
OTHER_SHAPE_RESIDUE = 4


def _broken_landing(spark: SparkSession, sf_dir: str) -> str:
    """Program documents where every tenth chunk is cut short."""
    root = scratch_path(spark, "landing-broken")
    docs = L.program_documents(L.read_tables(spark, sf_dir))
    broken = (F.col("chunk") % 10) == BROKEN_CHUNK_RESIDUE
    text = F.when(broken, F.expr("substring(value, 1, length(value) - 7)")).otherwise(F.col("value"))
    L.write_documents(docs.select("feed_file", text.alias("value")), root)
    return root


def q_scan_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PERMISSIVE scan of documents some of which are broken: staged once, the
    good ones flattened."""
    scanned = scan_feed(spark, _broken_landing(spark, sf_dir), "program", mode="PERMISSIVE")
    path = scratch_path(spark, "scanned")
    scanned.write.parquet(path)
    good, _ = split_corrupt(spark.read.schema(scanned.schema).parquet(path))
    flat = flatten(good, "program")
    return _ntz(flat.select("tenant", "extract_datetime", "program_id", "program_network_id", "program_start_date"), "extract_datetime")


# --- lookups ----------------------------------------------------------------------

def _customer_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = L.read_tables(spark, sf_dir)
    return t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("advertiser_id"), F.col("n_name").alias("tenant")
    )


def _tenants_of_regions(spark: SparkSession, sf_dir: str, regions=(0, 1, 2)) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return nation.where(F.col("n_regionkey").isin(*regions)).select(
        F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("mo_id")
    )


def q_rename_drop_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = L.read_tables(spark, sf_dir)
    feed = t["customer"].select(
        F.col("c_custkey").cast("string").alias("mo_id"), F.col("c_name").alias("name"), F.col("c_nationkey").cast("long").alias("nation_key")
    )
    dim = t["nation"].select(
        F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("mo_id"), F.lower("n_name").alias("name")
    )
    lk = as_lookup(dim, {"id": "tenant_id", "mo_id": "tenant_mo_id", "name": "tenant_name"})
    joined = resolve(feed, lk, "nation_key", "tenant_id", miss="keep")
    return (
        joined.drop("nation_key", "tenant_mo_id")
        .withColumn("label", F.concat(F.col("name"), F.lit("@"), F.col("tenant_name")))
        .select("mo_id", "name", "tenant_id", "tenant_name", "label")
    )


def q_lookup_left_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _customer_tenants(spark, sf_dir)
    return resolve(feed, tenant_lookup(_tenants_of_regions(spark, sf_dir)), "tenant", "tenant_mo_id", miss="keep").select(
        "advertiser_id", "tenant", "tenant_id"
    )


def q_lookup_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _customer_tenants(spark, sf_dir)
    return resolve(feed, tenant_lookup(_tenants_of_regions(spark, sf_dir)), "tenant", "tenant_mo_id", miss="drop").select(
        "advertiser_id", "tenant", "tenant_id"
    )


def q_missing_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _customer_tenants(spark, sf_dir)
    return missing_parents(feed, tenant_lookup(_tenants_of_regions(spark, sf_dir)), "tenant", "tenant_mo_id")


def _two_tenant_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client lookup in which every 7th customer's id also exists under the next tenant."""
    client = L.seed_lookups(spark, sf_dir)["client"]
    extra = client.where(F.col("id") % 7 == 0).select(
        (F.col("id") + 1_000_000).alias("id"), "mo_id", "name", ((F.col("tenant_id") + 1) % 25).alias("tenant_id")
    )
    return client.unionByName(extra)


def q_lookup_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    feed = orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("advertiser_id"))
    lk = client_lookup(_two_tenant_clients(spark, sf_dir), mo_id_as="client_mo_id", columns=["client_id", "client_mo_id", "tenant_id"])
    return resolve(feed, lk, "advertiser_id", "client_mo_id", miss="keep").select("o_orderkey", "advertiser_id", "client_id", "tenant_id")


def q_lookup_scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = L.read_tables(spark, sf_dir)
    feed = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("advertiser_id"), F.col("c_nationkey").cast("long").alias("feed_tenant_id")
    )
    lk = client_lookup(_two_tenant_clients(spark, sf_dir), mo_id_as="client_mo_id", columns=["client_id", "client_mo_id", "tenant_id"])
    joined = resolve(feed, lk, ["advertiser_id", "feed_tenant_id"], ["client_mo_id", "tenant_id"], miss="keep")
    return joined.select("o_orderkey", "advertiser_id", "client_id", "tenant_id")


def q_lookup_shuffled_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events -> client lookup on the shuffled path (as for a lookup above the
    broadcast bound); signups have no advertiser and are salted, not piled up."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    feed = ev.select(
        "event_id",
        F.when(F.col("event_type") == L.NO_ADVERTISER_EVENT, F.lit(None).cast("string")).otherwise(F.col("user_id").cast("string")).alias("advertiser_id"),
    )
    lk = client_lookup(L.seed_lookups(spark, sf_dir)["client"], mo_id_as="client_mo_id", columns=["client_id", "client_mo_id", "tenant_id"])
    joined = resolve(feed, lk, "advertiser_id", "client_mo_id", miss="keep", broadcast=False)
    return joined.select("event_id", "advertiser_id", "client_id", "tenant_id")


# --- aggregation, dedupe, ids ------------------------------------------------------

def q_product_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(loads.product_candidates(flat_feed(spark, sf_dir, "advertiser")), "extract_datetime")


def q_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return first_seen(orders, ["o_custkey"], order="o_orderdate", tiebreak=["o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority"
    )


def _event_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = F.when(F.col("event_type") == L.NO_ADVERTISER_EVENT, F.lit(None).cast("string")).otherwise(F.col("event_type"))
    return ev.select("user_id", "event_id", "ts", kind.alias("kind"))


def q_dedupe_then_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _event_kinds(spark, sf_dir)
    return first_seen(ev, ["user_id"], order="ts", tiebreak=["event_id"]).where(F.col("kind").isNotNull())


def q_filter_then_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _event_kinds(spark, sf_dir)
    return first_seen(ev.where(F.col("kind").isNotNull()), ["user_id"], order="ts", tiebreak=["event_id"])


def q_assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    rows = customer.select(F.col("c_nationkey").cast("long").alias("tenant_id"), F.col("c_custkey").cast("string").alias("mo_id")).distinct()
    return assign_ids(rows, ["tenant_id", "mo_id"], start=1)


def q_ids_continue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends to a client table: the second batch's ids follow the first's maximum."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    rows = customer.select(
        F.col("c_custkey").cast("string").alias("mo_id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("long").alias("tenant_id"), (F.col("c_mktsegment") == "BUILDING").alias("first"),
    )
    cat = ParquetCatalog(spark, scratch_path(spark, "catalog-ids"))
    cat.append("client", rows.where("first").drop("first"))
    cat.append("client", rows.where("NOT first").drop("first"))
    return cat.read("client")


# --- full loads ---------------------------------------------------------------------

def q_load_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_catalog(spark, sf_dir, "advertiser").read("client")


def q_load_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_catalog(spark, sf_dir, "advertiser").read("product")


def q_load_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_catalog(spark, sf_dir, "destination").read("network")


def q_load_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_catalog(spark, sf_dir, "estimate").read("estimate")


def q_load_daypart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_catalog(spark, sf_dir, "daypart").read("daypart")


def q_load_program(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_catalog(spark, sf_dir, "program").read("program")


def _estimate_two_tenant_catalog(spark: SparkSession, sf_dir: str, tag: str) -> ParquetCatalog:
    cat = ParquetCatalog(spark, scratch_path(spark, f"catalog-{tag}"))
    cat.seed("tenant", L.seed_lookups(spark, sf_dir)["tenant"])
    cat.seed("client", _two_tenant_clients(spark, sf_dir))
    return cat


def q_load_estimate_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimate load when some client ids exist under two tenants: unscoped, each copy matches."""
    cat = _estimate_two_tenant_catalog(spark, sf_dir, "estimate-fan-out")
    loads.load_estimate(flat_feed(spark, sf_dir, "estimate", loads.NEEDED["estimate"]), cat)
    return cat.read("estimate")


def q_load_estimate_scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with tenant-scoped client matching: only the client of the feed's tenant."""
    cat = _estimate_two_tenant_catalog(spark, sf_dir, "estimate-scoped")
    loads.load_estimate(flat_feed(spark, sf_dir, "estimate", loads.NEEDED["estimate"]), cat, tenant_scoped=True)
    return cat.read("estimate")


# --- sinks ---------------------------------------------------------------------------

def _supplier_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    return sup.select(F.col("s_suppkey").cast("string").alias("mo_id"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("long").alias("tenant_id"))


def q_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "append_twice")
    rows = _supplier_rows(spark, sf_dir)
    append_table(rows, path)
    append_table(rows, path)
    return spark.read.parquet(path)


def _event_batches(spark: SparkSession, sf_dir: str):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = ev.select(
        F.col("event_type").alias("mo_id"),
        F.when(F.col("event_type") == L.NO_ADVERTISER_EVENT, F.lit(None).cast("long")).otherwise(F.col("user_id")).alias("client_id"),
        "ts",
        "event_id",
    )
    key = ["mo_id", "client_id"]
    first = first_seen(rows.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")), key, order="ts", tiebreak=["event_id"])
    second = first_seen(rows, key, order="ts", tiebreak=["event_id"])
    return first, second, key


def q_append_only_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "append_only_new")
    first, second, key = _event_batches(spark, sf_dir)
    append_table(first, path)
    append_table(new_rows(second, spark.read.parquet(path), key), path)
    return spark.read.parquet(path)


def q_overwrite_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "overwrite_partitions")
    rows = _supplier_rows(spark, sf_dir)
    append_table(rows, path, partition_by=["tenant_id"])
    changed = rows.where(F.col("tenant_id") == 0).withColumn("name", F.upper("name"))
    overwrite_partitions(changed, path, ["tenant_id"])
    out = spark.read.parquet(path)
    return out.select("mo_id", "name", F.col("tenant_id").cast("long").alias("tenant_id"))


def q_rerun_only_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the destination feed twice with the re-run guard: no row twice."""
    cat = ParquetCatalog(spark, scratch_path(spark, "catalog-rerun"))
    cat.seed("tenant", L.seed_lookups(spark, sf_dir)["tenant"])
    flat = flat_feed(spark, sf_dir, "destination", loads.NEEDED["destination"])
    loads.load_destination(flat, cat, only_new=True)
    loads.load_destination(flat, cat, only_new=True)
    return cat.read("network")


def q_stream_load_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The destination feed loaded by the incremental (file stream) ingest."""
    from ..streaming.ingest import start_feed_stream

    cat = ParquetCatalog(spark, scratch_path(spark, "catalog-stream"))
    cat.seed("tenant", L.seed_lookups(spark, sf_dir)["tenant"])
    q = start_feed_stream(spark, landing_root(spark, sf_dir, ("destination",)), "destination", cat, scratch_path(spark, "stream-ckpt"))
    if not q.awaitTermination(STREAM_TIMEOUT_SEC):
        q.stop()
        raise TimeoutError(f"stream did not finish the available files within {STREAM_TIMEOUT_SEC} s")
    return cat.read("network")


def q_stream_network_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same one file at a time: the size of batches changes nothing."""
    from ..streaming.ingest import start_feed_stream

    cat = ParquetCatalog(spark, scratch_path(spark, "catalog-stream-batches"))
    cat.seed("tenant", L.seed_lookups(spark, sf_dir)["tenant"])
    root = landing_root(spark, sf_dir, ("destination",))
    q = start_feed_stream(spark, root, "destination", cat, scratch_path(spark, "stream-batches-ckpt"), max_files=1)
    if not q.awaitTermination(STREAM_TIMEOUT_SEC):
        q.stop()
        raise TimeoutError(f"stream did not finish the available files within {STREAM_TIMEOUT_SEC} s")
    return cat.read("network").drop("id")


STREAM_TIMEOUT_SEC = 1800


# --- loads split over runs ------------------------------------------------------------

# the history of each feed in three runs, the last part first
RUNS = {
    "advertiser": ("1996-01-01", "1994-01-01"),
    "destination": ("2018-07-01", "2018-01-01"),
    "estimate": ("1996-01-01", "1994-01-01"),
    "daypart": ("2024-01-20", "2024-01-10"),
    "program": ("1996-01-01", "1994-01-01"),
}


def split_catalog(spark: SparkSession, sf_dir: str, feed: str) -> ParquetCatalog:
    """A catalog after incremental loads of a feed whose files arrive late:
    first the newest, then the oldest, then the rest."""
    cat = ParquetCatalog(spark, scratch_path(spark, f"catalog-split-{feed}"))
    seeds = L.seed_lookups(spark, sf_dir)
    cat.seed("tenant", seeds["tenant"])
    if feed in ("estimate", "daypart"):
        cat.seed("client", seeds["client"])
    if feed == "program":
        cat.seed("network", seeds["network"])
    new, old = (F.lit(d).cast("timestamp") for d in RUNS[feed])
    flat = flat_feed(spark, sf_dir, feed, loads.NEEDED[feed])
    at = F.col("extract_datetime")
    for part in (at >= new, at < old, (at >= old) & (at < new)):
        loads.LOADERS[feed](flat.where(part), cat, only_new=True)
    return cat


def q_incremental_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_catalog(spark, sf_dir, "advertiser").read("client").drop("id")


def q_incremental_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products by their clients' external ids (made ids follow the runs)."""
    cat = split_catalog(spark, sf_dir, "advertiser")
    client = cat.read("client").select(F.col("id").alias("client_id"), F.col("mo_id").alias("client_mo_id"), "tenant_id")
    return cat.read("product").join(client, "client_id", "left").select("mo_id", "name", "client_mo_id", "tenant_id")


def q_incremental_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_catalog(spark, sf_dir, "destination").read("network").drop("id")


def q_incremental_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_catalog(spark, sf_dir, "estimate").read("estimate")


def q_incremental_daypart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_catalog(spark, sf_dir, "daypart").read("daypart")


def q_incremental_program(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_catalog(spark, sf_dir, "program").read("program")


class _Stopped(Exception):
    pass


class _StoppingCatalog(ParquetCatalog):
    """Raises after a number of writes."""

    left: int | None = None

    def store(self, name: str, df: DataFrame) -> str:
        out = super().store(name, df)
        if self.left is not None:
            self.left -= 1
            if self.left < 0:
                raise _Stopped(name)
        return out


def q_commit_interrupted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products by their clients' external ids, where the run of the oldest
    files (which corrects both tables) stops after the client's and after the
    product's writes before it is repeated."""
    cat = _StoppingCatalog(spark, scratch_path(spark, "catalog-interrupted"))
    cat.seed("tenant", L.seed_lookups(spark, sf_dir)["tenant"])
    old = F.lit(RUNS["advertiser"][1]).cast("timestamp")
    flat = flat_feed(spark, sf_dir, "advertiser", loads.NEEDED["advertiser"])
    loads.load_advertiser(flat.where(F.col("extract_datetime") >= old), cat, only_new=True)
    for left in (1, 3, None):
        cat.left = left
        try:
            loads.load_advertiser(flat.where(F.col("extract_datetime") < old), cat, only_new=True)
        except _Stopped:
            continue
    client = cat.read("client").select(F.col("id").alias("client_id"), F.col("mo_id").alias("client_mo_id"), "tenant_id")
    return cat.read("product").join(client, "client_id", "left").select("mo_id", "name", "client_mo_id", "tenant_id")


def q_lookup_change_followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates after the ids of every third client have changed since they
    were loaded: a run without new rows follows them."""
    cat = ParquetCatalog(spark, scratch_path(spark, "catalog-followed"))
    seeds = L.seed_lookups(spark, sf_dir)
    cat.seed("tenant", seeds["tenant"])
    other = F.when(F.col("id") % 3 == 0, F.col("id") + 1_000_000).otherwise(F.col("id"))
    cat.seed("client", seeds["client"].withColumn("id", other))
    flat = flat_feed(spark, sf_dir, "estimate", loads.NEEDED["estimate"])
    loads.load_estimate(flat, cat, only_new=True)
    cat.seed("client", seeds["client"])
    loads.load_estimate(flat.limit(0), cat, only_new=True)
    return cat.read("estimate")


# --- loads with lookups above the broadcast bound --------------------------------------

def _shuffled(spark: SparkSession, sf_dir: str, feed: str, table: str) -> DataFrame:
    before = spark.conf.get(BROADCAST_ROWS_CONF, None)
    spark.conf.set(BROADCAST_ROWS_CONF, "0")
    try:
        cat = ParquetCatalog(spark, scratch_path(spark, f"catalog-shuffled-{feed}"))
        for name, df in L.seed_lookups(spark, sf_dir).items():
            if name == "tenant" or (name, feed) in (("client", "estimate"), ("client", "daypart"), ("network", "program")):
                cat.seed(name, df)
        loads.LOADERS[feed](flat_feed(spark, sf_dir, feed, loads.NEEDED[feed]), cat)
        return cat.read(table)
    finally:
        if before is None:
            spark.conf.unset(BROADCAST_ROWS_CONF)
        else:
            spark.conf.set(BROADCAST_ROWS_CONF, before)


def q_load_product_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shuffled(spark, sf_dir, "advertiser", "product")


def q_load_estimate_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shuffled(spark, sf_dir, "estimate", "estimate")


def q_load_daypart_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shuffled(spark, sf_dir, "daypart", "daypart")


def q_load_program_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shuffled(spark, sf_dir, "program", "program")


# --- the job, its checks and its quarantine --------------------------------------------

def q_run_feed_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed job end to end on the advertiser landing."""
    cat = ParquetCatalog(spark, scratch_path(spark, "catalog-job"))
    cat.seed("tenant", L.seed_lookups(spark, sf_dir)["tenant"])
    run_feed(spark, "advertiser", landing_root(spark, sf_dir, ("advertiser",)), cat)
    return cat.read("client")


def q_run_feed_multi_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed job on files of one document over several lines each."""
    root = scratch_path(spark, "landing one document a file")
    docs = L.destination_documents(L.read_tables(spark, sf_dir))
    lines = docs.select("feed_file", F.xxhash64("value").alias("doc"), F.replace(F.col("value"), F.lit("{"), F.lit("{\n")).alias("value"))
    lines.write.partitionBy("feed_file", "doc").text(root)
    cat = ParquetCatalog(spark, scratch_path(spark, "catalog-multi-line"))
    cat.seed("tenant", L.seed_lookups(spark, sf_dir)["tenant"])
    run_feed(spark, "destination", root, cat)
    return cat.read("network")


def q_scan_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken documents per feed file in the quarantine of a PERMISSIVE job
    that ran twice."""
    root = _broken_landing(spark, sf_dir)
    seeds = L.seed_lookups(spark, sf_dir)
    for turn in range(2):
        cat = ParquetCatalog(spark, scratch_path(spark, f"catalog-quarantine-{turn}"))
        cat.seed("tenant", seeds["tenant"])
        cat.seed("network", seeds["network"])
        run_feed(spark, "program", root, cat, multi_line=False, mode="PERMISSIVE", quarantine=f"{root}-kept")
    held = spark.read.parquet(f"{root}-kept")
    return held.groupBy(F.regexp_extract(FILE_COL, "feed_file=([^/]+)/", 1).alias("feed_file")).agg(F.count(F.lit(1)).alias("n_bad"))


def q_quarantine_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every file, documents loaded and documents quarantined, where
    some lines are cut short and others are of another shape."""
    root = scratch_path(spark, "landing-shapes")
    docs = L.program_documents(L.read_tables(spark, sf_dir))
    part = F.col("chunk") % 10
    text = F.when(part == BROKEN_CHUNK_RESIDUE, F.expr("substring(value, 1, length(value) - 7)")).when(part == OTHER_SHAPE_RESIDUE, F.lit('{"heartbeat": true}'))
    L.write_documents(docs.select("feed_file", F.coalesce(text, "value").alias("value")), root)
    path = scratch_path(spark, "scanned-shapes")
    scanned = scan_feed(spark, root, "program", mode="PERMISSIVE")
    scanned.write.parquet(path)
    good, bad = split_corrupt(spark.read.schema(scanned.schema).parquet(path), "program")
    name = F.regexp_extract(FILE_COL, "feed_file=([^/]+)/", 1).alias("feed_file")
    loaded = good.groupBy(name).agg(F.count(F.lit(1)).alias("n_loaded"))
    kept = bad.groupBy(name).agg(F.sum("n_documents").alias("n_quarantined"))
    lines = spark.read.text(root).groupBy("feed_file").agg(F.count(F.lit(1)).alias("n_lines"))
    both = lines.join(loaded, "feed_file", "left").join(kept, "feed_file", "left")
    return both.select("feed_file", "n_lines", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_loaded", "n_quarantined")))


def q_feed_file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed files that each of three incremental runs opens: the newest ones,
    then all others, then none."""
    cat = ParquetCatalog(spark, scratch_path(spark, "catalog-files"))
    seeds = L.seed_lookups(spark, sf_dir)
    cat.seed("tenant", seeds["tenant"])
    cat.seed("client", seeds["client"])
    root = landing_root(spark, sf_dir, ("estimate",))
    for since in (19960101, 0, 0):
        run_feed(spark, "estimate", root, cat, since=since, multi_line=False, only_new=True)
    name = F.regexp_extract(FILE_COL, "feed_file=([^/]+)/", 1).alias("feed_file")
    runs = [cat.open([f]).select(F.lit(i).cast("long").alias("run"), name) for i, f in enumerate(cat.state()["files"]["estimate"], 1)]
    return union_sources(runs).distinct()


def q_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of estimate documents that the schema does not know or knows as
    another kind, per feed file; some documents are cut short as well."""
    root = scratch_path(spark, "landing-drift")
    docs = L.estimate_documents(L.read_tables(spark, sf_dir))
    part, text = F.col("chunk") % 10, F.col("value")
    text = (
        F.when(part == BROKEN_CHUNK_RESIDUE, F.expr("substring(value, 1, length(value) - 7)"))
        .when(part == 5, F.replace(text, F.lit('"media":'), F.lit('"mediaType":')))
        .when(part == 6, F.replace(text, F.lit('{"moSystem":'), F.lit('{"region":{"codes":[1,2]},"moSystem":')))
        .when(part == 7, F.regexp_replace(text, '"tenant":("[^"]*")', '"tenant":{"name":$1}'))
        .otherwise(text)
    )
    L.write_documents(docs.select("feed_file", text.alias("value")), root)
    name = F.regexp_extract(FILE_COL, "feed_file=([^/]+)/", 1).alias("feed_file")
    return feed_drift(spark, root, "estimate").groupBy(name, "path", "expected", "found").agg(F.sum("n").alias("n"))


def q_lookup_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events -> client lookup of two tables of the session's catalog, appended
    to by name and joined on their buckets."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    no_one = F.col("event_type") == L.NO_ADVERTISER_EVENT
    feed = ev.select("event_id", F.when(~no_one, F.col("user_id").cast("string")).alias("advertiser_id"))
    client = L.seed_lookups(spark, sf_dir)["client"]
    lk = client_lookup(client, mo_id_as="client_mo_id", columns=["client_id", "client_mo_id", "tenant_id"])
    tag = uuid.uuid4().hex
    for name, rows, key, part in ((f"feed_{tag}", feed, "advertiser_id", F.col("event_id") % 2), (f"client_{tag}", lk, "client_mo_id", F.col("client_id") % 2)):
        path = scratch_path(spark, name)
        for turn in (0, 1):
            append_named(rows.where(part == turn), name, path=path, bucket_by=[key], buckets=8)
    joined = resolve(spark.table(f"feed_{tag}"), spark.table(f"client_{tag}"), "advertiser_id", "client_mo_id", laid_out=True)
    return joined.select("event_id", "advertiser_id", "client_id", "tenant_id")


def q_undated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All names of a feed without a date."""
    return undated_files(_file_names(spark, sf_dir), "clickfeed", "file_name")


def q_missing_parent_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole list of missing keys that a stopped run leaves."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_custkey").cast("string").alias("advertiser_id"))
    client = L.seed_lookups(spark, sf_dir)["client"].where(F.col("tenant_id") < 12)
    lk = client_lookup(client, mo_id_as="client_mo_id", columns=["client_id", "client_mo_id"])
    try:
        resolve(orders, lk, "advertiser_id", "client_mo_id", miss="raise", what="Clients")
    except MissingParentError as e:
        return spark.read.parquet(e.table)
    return orders.limit(0)  # none missing


def q_first_seen_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_mktsegment").alias("name"), "c_custkey")
    return first_seen(customer, ["name"], order="c_custkey")


def q_append_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows spread over three writers, and read back with their files' number."""
    path = scratch_path(spark, "append_spread")
    append_table(_supplier_rows(spark, sf_dir), path, writers=3)
    out = spark.read.parquet(path)
    files = out.select(F.input_file_name().alias("f")).distinct().agg(F.count(F.lit(1)).alias("files"))
    return out.join(F.broadcast(files), F.col("files") > 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "feed_file_select": q_feed_file_select,
    "json_scan_flatten": q_json_scan_flatten,
    "flatten_drops_empty": q_flatten_drops_empty,
    "flatten_keeps_empty": q_flatten_keeps_empty,
    "feed_since_cutoff": q_feed_since_cutoff,
    "scan_permissive": q_scan_permissive,
    "estimate_versions": q_estimate_versions,
    "union_all_sources": q_union_all_sources,
    "rename_drop_project": q_rename_drop_project,
    "lookup_left_outer": q_lookup_left_outer,
    "lookup_drop": q_lookup_drop,
    "missing_parents": q_missing_parents,
    "lookup_fan_out": q_lookup_fan_out,
    "lookup_scoped": q_lookup_scoped,
    "lookup_shuffled_nulls": q_lookup_shuffled_nulls,
    "product_candidates": q_product_candidates,
    "first_seen": q_first_seen,
    "dedupe_then_filter": q_dedupe_then_filter,
    "filter_then_dedupe": q_filter_then_dedupe,
    "assign_ids": q_assign_ids,
    "ids_continue": q_ids_continue,
    "load_client": q_load_client,
    "load_product": q_load_product,
    "load_network": q_load_network,
    "load_estimate": q_load_estimate,
    "load_estimate_fan_out": q_load_estimate_fan_out,
    "load_estimate_scoped": q_load_estimate_scoped,
    "load_daypart": q_load_daypart,
    "load_program": q_load_program,
    "append_twice": q_append_twice,
    "append_only_new": q_append_only_new,
    "overwrite_partitions": q_overwrite_partitions,
    "rerun_only_new": q_rerun_only_new,
    "stream_load_network": q_stream_load_network,
    "stream_network_batches": q_stream_network_batches,
    "incremental_client": q_incremental_client,
    "incremental_product": q_incremental_product,
    "incremental_network": q_incremental_network,
    "incremental_estimate": q_incremental_estimate,
    "incremental_daypart": q_incremental_daypart,
    "incremental_program": q_incremental_program,
    "load_product_shuffled": q_load_product_shuffled,
    "load_estimate_shuffled": q_load_estimate_shuffled,
    "load_daypart_shuffled": q_load_daypart_shuffled,
    "load_program_shuffled": q_load_program_shuffled,
    "commit_interrupted": q_commit_interrupted,
    "lookup_change_followed": q_lookup_change_followed,
    "quarantine_accounting": q_quarantine_accounting,
    "run_feed_client": q_run_feed_client,
    "run_feed_multi_line": q_run_feed_multi_line,
    "scan_quarantine": q_scan_quarantine,
    "feed_file_ledger": q_feed_file_ledger,
    "schema_drift": q_schema_drift,
    "lookup_bucketed": q_lookup_bucketed,
    "undated_files": q_undated_files,
    "missing_parent_table": q_missing_parent_table,
    "first_seen_by_name": q_first_seen_by_name,
    "append_spread": q_append_spread,
}
