"""Lookup (dimension) tables: JDBC or file/catalog tables, renamed at read."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    partition_column: str | None = None,
    num_partitions: int = 1,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A database table over JDBC.

    Several partitions need a numeric ``partition_column``; its bounds are
    read first with one small query (min/max), so the ranges fit the data.
    Without it the read is a single task. ``fetch_size`` bounds the rows a
    task holds at a time (drivers that ignore it buffer their whole range:
    give those more partitions).
    """
    if num_partitions < 1:
        raise ValueError("num_partitions must be at least 1")
    props = {"fetchsize": str(fetch_size), **properties}
    if partition_column and num_partitions > 1:
        bounds = spark.read.jdbc(
            url, f"(SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {table}) b", properties=props
        ).first()
        if bounds is not None and bounds[0] is not None:
            return spark.read.jdbc(
                url,
                table,
                column=partition_column,
                lowerBound=int(bounds[0]),
                upperBound=int(bounds[1]) + 1,
                numPartitions=num_partitions,
                properties=props,
            )
    return spark.read.jdbc(url, table, properties=props)


def as_lookup(df: DataFrame, rename: Mapping[str, str], columns: Sequence[str] | None = None) -> DataFrame:
    """Rename lookup columns (e.g. ``id -> tenant_id``, ``mo_id -> tenant_mo_id``)
    and keep only the ones the join needs."""
    out = df.withColumnsRenamed(dict(rename))
    if columns:
        out = out.select(*columns)
    return out


def tenant_lookup(tenant: DataFrame) -> DataFrame:
    """Tenant table as used by every feed: ``tenant_id``, ``tenant_mo_id``."""
    return as_lookup(tenant, {"id": "tenant_id", "mo_id": "tenant_mo_id"}, ["tenant_id", "tenant_mo_id"])


def client_lookup(client: DataFrame, *, mo_id_as: str = "mo_id", columns: Sequence[str] | None = None) -> DataFrame:
    """Client table with ``id -> client_id`` (and ``mo_id`` renamed if asked)."""
    ren = {"id": "client_id"}
    if mo_id_as != "mo_id":
        ren["mo_id"] = mo_id_as
    return as_lookup(client, ren, columns)


def network_lookup(network: DataFrame) -> DataFrame:
    """Network table as used by programs: ``network_id``, ``network_mo_id``."""
    return as_lookup(network, {"id": "network_id", "mo_id": "network_mo_id"}, ["network_id", "network_mo_id"])

