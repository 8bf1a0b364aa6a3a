"""The load pipelines: flat feed -> lookups -> first-seen -> target table.

``*_rows`` functions are lazy (DataFrame in, DataFrame out). ``load_*``
functions run the parent checks (before any write) and append to the
catalog. Tie-breakers after ``extract_datetime`` are the remaining output
columns, so reruns give the same rows.
"""
from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedupe import first_seen
from ..operators.lookup import require_parents, resolve
from ..schemas import TARGET_COLUMNS
from ..session import scratch_path
from ..sources.lookups import as_lookup, client_lookup, network_lookup, tenant_lookup
from . import incremental

# --- fixed values: business key of every target table; product's tenant is that
# of its client and is not stored
KEYS = {
    "client": ["tenant_id", "mo_id"],
    "product": ["tenant_id", "mo_id"],
    "network": ["mo_id", "tenant_id"],
    "estimate": ["mo_id", "client_id"],
    "daypart": ["mo_id", "client_id", "tenant_id"],
    "program": ["mo_id", "tenant_id"],
}


def _tiebreak(table: str, key: list[str]) -> list[str]:
    return [c for c in TARGET_COLUMNS[table] if c not in key and c != "id"]


# --- fixed values: flat-feed columns each load reads (the rest is never held)
NEEDED = {
    "advertiser": ["tenant", "extract_datetime", "advertiser_id", "advertiser_name", "brand_id", "brand_name"],
    "destination": ["tenant", "extract_datetime", "id", "name", "media", "type", "nielsen_code"],
    "estimate": ["tenant", "extract_datetime", "id", "estimate_name", "start_date", "end_date", "media", "advertiser_id"],
    "daypart": ["tenant", "extract_datetime", "id", "daypart_name", "media", "advertiser_id"],
    "program": [
        "tenant", "extract_datetime", "program_id", "program_name", "program_network_id",
        "program_start_date", "program_end_date", "program_media",
    ],
}


STAGE_CONF = "feedspark.stage"
STAGES = ("table", "cache")
# rows of a staged file: its size says little of its rows, but a task reads few files (each counts 4 MB at least)
STAGE_ROWS = 100_000


@contextmanager
def persisted(df: DataFrame, feed: str | None = None, stage: str | None = None):
    """Hold the columns a load needs between its actions (check, then writes),
    so the JSON is parsed once.

    ``stage="table"`` (the default; session setting ``feedspark.stage``)
    writes them as a parquet table under the shared checkpoint folder and
    reads that back: the lineage is cut, a lost executor costs no re-parse,
    and each later read prunes columns. The table is emptied afterwards.
    ``stage="cache"`` persists in executor memory/disk instead (recomputed
    from the files if an executor is lost) - fine for small feeds.
    """
    if feed:
        df = df.select(*NEEDED[feed])
    spark = df.sparkSession
    stage = stage or spark.conf.get(STAGE_CONF, "table")
    if stage not in STAGES:
        raise ValueError(f"stage must be one of {STAGES}")
    if stage == "table":
        path = scratch_path(spark, f"stage-{feed or 'flat'}")
        df.write.options(compression="zstd", maxRecordsPerFile=STAGE_ROWS).parquet(path)
        try:
            yield spark.read.parquet(path)
        finally:
            # plain overwrite with no rows: the staged data is removed
            spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)
        return
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()


# --- advertiser -> client, product -------------------------------------------

def with_tenant(flat: DataFrame, tenant: DataFrame, *, miss: str = "raise") -> DataFrame:
    return resolve(flat, tenant_lookup(tenant), "tenant", "tenant_mo_id", miss=miss, what="Tenants")


def client_rows(joined: DataFrame) -> DataFrame:
    """Earliest advertiser row per (tenant_id, advertiser_id)."""
    rows = joined.withColumnsRenamed({"advertiser_id": "mo_id", "advertiser_name": "name"})
    key = KEYS["client"]
    return first_seen(rows, key, tiebreak=_tiebreak("client", key)).select("mo_id", "name", "tenant_id")


def product_candidates(joined: DataFrame, *, tenant_scoped: bool = False) -> DataFrame:
    cols = ["advertiser_id", "brand_id", "brand_name", "extract_datetime"]
    if tenant_scoped:
        cols.append("tenant_id")
    return joined.select(*cols).distinct()


def product_rows(joined: DataFrame, client: DataFrame, *, tenant_scoped: bool = False) -> DataFrame:
    """Earliest brand row per (tenant_id, brand_id); client ids from the client table.

    Unscoped (the default) matches the advertiser id under every tenant
    holding it; ``tenant_scoped`` also compares the tenant.
    """
    # Distinct candidates cannot change the earliest row per key, and the
    # window's partial limit already drops repeats before its shuffle, so the
    # rows go straight to the lookup: one shuffle instead of two.
    cols = ["advertiser_id", "brand_id", "brand_name", "extract_datetime"] + (["tenant_id"] if tenant_scoped else [])
    cand = joined.select(*cols)
    if tenant_scoped:
        cand = cand.withColumnRenamed("tenant_id", "feed_tenant_id")
        lk = client_lookup(client, mo_id_as="client_mo_id", columns=["client_id", "client_mo_id", "tenant_id"])
        rows = resolve(cand, lk, ["advertiser_id", "feed_tenant_id"], ["client_mo_id", "tenant_id"], miss="keep")
    else:
        lk = client_lookup(client, mo_id_as="client_mo_id", columns=["client_id", "client_mo_id", "tenant_id"])
        rows = resolve(cand, lk, "advertiser_id", "client_mo_id", miss="keep")
    rows = rows.withColumnsRenamed({"brand_id": "mo_id", "brand_name": "name"})
    # the client's external id breaks ties: its made id follows that order in a
    # load of everything, but not over several runs
    first = first_seen(rows, KEYS["product"], tiebreak=["name", "advertiser_id"])
    return first.select("tenant_id", *TARGET_COLUMNS["product"])


def _product_tenants(catalog):
    """Adds the tenant of each product's client."""

    def keyed(products: DataFrame) -> DataFrame:
        lk = client_lookup(catalog.read("client"), mo_id_as="client_mo_id", columns=["client_id", "tenant_id"])
        return resolve(products, lk.withColumnRenamed("client_id", "_client"), "client_id", "_client", miss="keep").drop("_client")

    return keyed


def load_advertiser(flat: DataFrame, catalog, *, only_new: bool = False, tenant_scoped: bool = False, stage: str | None = None) -> None:
    """Client first, then product (which reads the client ids back)."""
    # both tables appear together
    with persisted(flat, "advertiser", stage) as flat, catalog.transaction():
        joined = with_tenant(flat, catalog.read("tenant"))
        if only_new:
            known = lambda rows: with_tenant(rows, catalog.read("tenant"), miss="keep")  # noqa: E731 - checked just now
            incremental.run(flat, catalog, "client", lambda rows: client_rows(known(rows)), KEYS["client"])
            incremental.run(
                flat, catalog, "product",
                lambda rows: product_rows(known(rows), catalog.read("client"), tenant_scoped=tenant_scoped),
                KEYS["product"], _product_tenants(catalog),
            )
            return
        catalog.append("client", client_rows(joined))
        # read after write: ids exist only now
        products = product_rows(joined, catalog.read("client"), tenant_scoped=tenant_scoped)
        catalog.append("product", products.drop("tenant_id"))


# --- destination -> network --------------------------------------------------

def network_rows(joined: DataFrame) -> DataFrame:
    """Earliest row per (mo_id, tenant_id), then rows without a type left out."""
    rows = joined.withColumnsRenamed({"id": "mo_id", "type": "network_type"})
    key = KEYS["network"]
    first = first_seen(rows, key, tiebreak=_tiebreak("network", key))
    return first.where(F.col("network_type").isNotNull()).select(*TARGET_COLUMNS["network"][1:])


def load_destination(flat: DataFrame, catalog, *, only_new: bool = False, stage: str | None = None, tenant_scoped: bool = False) -> None:
    """Networks of known tenants (``tenant_scoped`` changes nothing: the tenant is the lookup)."""
    with persisted(flat, "destination", stage) as flat:
        joined = with_tenant(flat, catalog.read("tenant"))
        if only_new:
            incremental.run(
                flat, catalog, "network",
                lambda rows: network_rows(with_tenant(rows, catalog.read("tenant"), miss="keep")), KEYS["network"],
            )
            return
        catalog.append("network", network_rows(joined))


# --- estimate ----------------------------------------------------------------

def estimate_rows(joined: DataFrame) -> DataFrame:
    rows = joined.withColumnsRenamed({"id": "mo_id", "estimate_name": "name"})
    key = KEYS["estimate"]
    return first_seen(rows, key, tiebreak=_tiebreak("estimate", key)).select(*TARGET_COLUMNS["estimate"])


def with_client(flat: DataFrame, client: DataFrame, *, miss: str, what: str = "Clients", tenant_col: str | None = None) -> DataFrame:
    """Client lookup by advertiser id; with ``tenant_col`` (the feed row's
    tenant id) only a client of the same tenant matches."""
    lk = client_lookup(client, mo_id_as="client_mo_id", columns=["client_id", "client_mo_id", "tenant_id"])
    if tenant_col:
        return resolve(flat, lk, ["advertiser_id", tenant_col], ["client_mo_id", "tenant_id"], miss=miss, what=what)
    return resolve(flat, lk, "advertiser_id", "client_mo_id", miss=miss, what=what)


FEED_TENANT = "feed_tenant_id"


def with_feed_tenant(flat: DataFrame, tenant: DataFrame) -> DataFrame:
    """Add the feed row's tenant id (null for an unknown tenant) as ``feed_tenant_id``."""
    return with_tenant(flat, tenant, miss="keep").withColumnRenamed("tenant_id", FEED_TENANT)


def load_estimate(flat: DataFrame, catalog, *, only_new: bool = False, stage: str | None = None, tenant_scoped: bool = False) -> None:
    with persisted(flat, "estimate", stage) as flat:
        def joined(rows: DataFrame, miss: str) -> DataFrame:
            scope = None
            if tenant_scoped:
                rows, scope = with_feed_tenant(rows, catalog.read("tenant")), FEED_TENANT
            # missing clients are listed by advertiser id (and tenant id when scoped)
            return with_client(rows, catalog.read("client"), miss=miss, tenant_col=scope)

        checked = joined(flat, "raise")
        if only_new:
            incremental.run(flat, catalog, "estimate", lambda rows: estimate_rows(joined(rows, "keep")), KEYS["estimate"])
            return
        catalog.append("estimate", estimate_rows(checked))


# --- daypart -----------------------------------------------------------------

def daypart_rows(joined: DataFrame) -> DataFrame:
    rows = joined.withColumnsRenamed({"id": "mo_id", "daypart_name": "name"})
    key = KEYS["daypart"]
    return first_seen(rows, key, tiebreak=_tiebreak("daypart", key)).select(*TARGET_COLUMNS["daypart"])


def load_daypart(flat: DataFrame, catalog, *, only_new: bool = False, stage: str | None = None, tenant_scoped: bool = False) -> None:
    """Tenants must exist (checked only); the client is optional and gives the tenant id."""
    with persisted(flat, "daypart", stage) as flat:
        require_parents(flat, tenant_lookup(catalog.read("tenant")), "tenant", "tenant_mo_id", what="Tenants")
        def derived(rows: DataFrame) -> DataFrame:
            scope = None
            if tenant_scoped:
                rows, scope = with_feed_tenant(rows, catalog.read("tenant")), FEED_TENANT
            return daypart_rows(with_client(rows, catalog.read("client"), miss="keep", tenant_col=scope))

        if only_new:
            incremental.run(flat, catalog, "daypart", derived, KEYS["daypart"])
            return
        # first seen per feed key before the lookup: the rows that survive are the
        # same (a lookup never orders them), and far fewer of them are looked up
        spec = incremental.LEDGERS["daypart"]
        few = first_seen(flat.select(*spec.key, "extract_datetime", *spec.rest), spec.key, tiebreak=spec.rest)
        catalog.append("daypart", derived(few))


# --- program -----------------------------------------------------------------

def program_rows(joined: DataFrame) -> DataFrame:
    rows = joined.withColumnsRenamed(
        {
            "program_id": "mo_id",
            "program_name": "name",
            "program_media": "media",
            "program_start_date": "start_date",
            "program_end_date": "end_date",
        }
    )
    key = KEYS["program"]
    return first_seen(rows, key, tiebreak=_tiebreak("program", key)).select(*TARGET_COLUMNS["program"])


def with_network(joined: DataFrame, network: DataFrame, *, miss: str = "drop", tenant_scoped: bool = False) -> DataFrame:
    """Network lookup by network id; ``tenant_scoped`` also compares the tenant."""
    if tenant_scoped:
        lk = as_lookup(
            network, {"id": "network_id", "mo_id": "network_mo_id", "tenant_id": "network_tenant_id"},
            ["network_id", "network_mo_id", "network_tenant_id"],
        )
        return resolve(
            joined, lk, ["program_network_id", "tenant_id"], ["network_mo_id", "network_tenant_id"],
            miss=miss, id_col="network_id", what="Networks",
        ).drop("network_tenant_id")
    return resolve(joined, network_lookup(network), "program_network_id", "network_mo_id", miss=miss, id_col="network_id", what="Networks")


def load_program(flat: DataFrame, catalog, *, only_new: bool = False, stage: str | None = None, tenant_scoped: bool = False) -> None:
    """Tenants must exist; programs of unknown networks are left out (before the dedupe)."""
    with persisted(flat, "program", stage) as flat:
        def derived(rows: DataFrame, miss: str) -> DataFrame:
            known = with_tenant(rows, catalog.read("tenant"), miss=miss)
            return program_rows(with_network(known, catalog.read("network"), tenant_scoped=tenant_scoped))

        checked = derived(flat, "raise")
        if only_new:
            incremental.run(flat, catalog, "program", lambda rows: derived(rows, "keep"), KEYS["program"])
            return
        catalog.append("program", checked)


LOADERS = {
    "advertiser": load_advertiser,
    "destination": load_destination,
    "estimate": load_estimate,
    "daypart": load_daypart,
    "program": load_program,
}
