"""Feed landing areas derived from the driver's TPC-H-like tables.

Used by the registered queries, tests and the bench: every feed document is
computed by Spark from the tables (joins + two levels of ``collect_list``)
and written as JSON, one document per line, into
``<root>/feed_file=<feed file name>/part-*``. Nothing goes through the driver.

Mapping: tenant = nation, client/advertiser = customer, brand = part (via
the customer's order lines), network/destination = supplier, estimate =
order, daypart = event, program = order line.

A document never holds more than ``DOC_CHUNK`` source keys (orders,
suppliers or events), so no group grows with the data. The joined rows move
once more, as columns, to the tasks that write their feed file: a file's
chunks are dealt to as many buckets as the largest file needs (``TASK_ROWS``
rows a task), both levels of grouping happen there, and the documents are
written where they are made, compressed. So neither the memory of a task nor
the number of files follows the shuffle settings.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DATE_FORMAT, FEED_WORDS, TIMESTAMP_FORMAT

# --- fixed values of the derived feeds --------------------------------------
DOC_CHUNK = 256
TASK_ROWS = 250_000  # rows that one task makes documents of
SYSTEM = "NATIONAL"
MO_SYSTEM = "OO"
DESTINATION_EXTRACTS = ("2018-01-01 06:00:00", "2018-07-01 06:00:00")
LOW_PRIORITY = "5-LOW"  # orders of this priority contribute no brands
NO_ADVERTISER_EVENT = "signup"  # dayparts of this type have no advertiser

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


class Tables(dict):
    """The driver's tables, each opened when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._open = lambda t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet")

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._open(name)
        return self[name]


def read_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return Tables(spark, sf_dir)


def feed_file_name(feed: str, extract: Column) -> Column:
    """``DS-OO-NATIONAL-<WORD>-<yyyyMMdd of the month>-000000``."""
    month = F.date_format(F.date_trunc("MONTH", extract), "yyyyMMdd")
    return F.concat(F.lit(f"DS-{MO_SYSTEM}-{SYSTEM}-{FEED_WORDS[feed]}-"), month, F.lit("-000000"))


def _envelope(feed: str, tenant: Column, extract: Column) -> list[Column]:
    return [
        F.lit(MO_SYSTEM).alias("moSystem"),
        tenant.alias("tenant"),
        F.lit(SYSTEM).alias("system"),
        F.lit(feed.upper()).alias("feedType"),
        feed_file_name(feed, extract).alias("filename"),
        extract.cast("timestamp").alias("extractdatetime"),
    ]


def _by_file(rows: DataFrame, dates: DataFrame, n: int | None = None) -> DataFrame:
    """Rows with ``extract`` and ``chunk`` dealt to the tasks that make their
    documents: those of a chunk and feed file lie together (the file's ``month``
    and a ``bucket`` are added and take part in every grouping).

    ``dates`` are the extracts of the source rows (or of as many that stand for
    ``n`` rows), from one column of a scan; only their counts are needed, one
    row a feed file."""
    months = dates.groupBy(_month(dates[dates.columns[0]])).agg(F.count(F.lit(1)).alias("n"))
    total, largest = months.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    if n is not None and total:
        total, largest = n, largest * n // total
    bucket = F.pmod(F.xxhash64("chunk"), F.lit(largest // TASK_ROWS + 1))
    dealt = rows.withColumns({"month": _month(F.col("extract")), "bucket": bucket})
    return dealt.repartition(total // TASK_ROWS + 1, *_PLACE)


_PLACE = ["month", "bucket"]


def _month(extract: Column) -> Column:
    """Month of a feed file, as a number (the file's name would weigh more than the row it moves with)."""
    return (F.year(extract) * 12 + F.month(extract)).cast("int")


def _docs(feed: str, elements: DataFrame, payload: str, element: Column, extra: list[Column] | None = None) -> DataFrame:
    """Group elements (dealt by :func:`_by_file`) into documents keyed by (tenant, extract, chunk[, version])."""
    keys = ["n_name", "extract", "chunk"] + (["version"] if "version" in elements.columns else [])
    grouped = elements.groupBy(*_PLACE, *keys).agg(F.collect_list(element).alias(payload))
    env = _envelope(feed, F.col("n_name"), F.col("extract"))
    if extra:
        env = env[:3] + extra + env[3:]
    return grouped.select(
        feed_file_name(feed, F.col("extract")).alias("feed_file"),
        F.col("chunk"),
        F.to_json(F.struct(*env, F.col(payload)), {"timestampFormat": TIMESTAMP_FORMAT, "dateFormat": DATE_FORMAT}).alias("value"),
    )


def _order_tenants(t: dict[str, DataFrame], orders: Sequence[str | Column] = (), customer: Sequence[str] = ()) -> DataFrame:
    """Orders with the tenant of their customer, joined before anything larger is."""
    return (
        t["orders"].select("o_orderkey", "o_custkey", *orders)
        .join(t["customer"].select("c_custkey", "c_nationkey", *customer), F.col("o_custkey") == F.col("c_custkey"))
        .join(t["nation"].select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    )


def advertiser_documents(t: dict[str, DataFrame]) -> DataFrame:
    # whether an order names brands moves with its lines, not its priority
    branded = (F.col("o_orderpriority") != LOW_PRIORITY).alias("branded")
    lines = t["lineitem"].select("l_orderkey", "l_partkey").join(t["part"].select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    rows = lines.join(_order_tenants(t, ["o_orderdate", branded], ["c_name", "c_mktsegment"]), F.col("l_orderkey") == F.col("o_orderkey"))
    brand = F.when(
        F.col("branded"),
        F.struct(F.col("l_partkey").cast("string").alias("id"), F.col("p_name").alias("name")),
    )
    # where the lines met their order: it is dealt once, not with each of them
    rows = rows.groupBy("o_orderkey", "o_orderdate", "n_name", "c_custkey", "c_name", "c_mktsegment").agg(F.collect_list(brand).alias("of_order"))
    rows = rows.withColumns({"extract": F.date_trunc("MONTH", "o_orderdate"), "chunk": F.floor(F.col("o_orderkey") / DOC_CHUNK)})
    rows = _by_file(rows, t["orders"].select("o_orderdate"), t["lineitem"].count())
    advertisers = rows.groupBy(*_PLACE, "n_name", "extract", "chunk", "c_custkey", "c_name", "c_mktsegment").agg(
        F.flatten(F.collect_list("of_order")).alias("brands")
    )
    element = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("media"),
        F.col("brands"),
    )
    return _docs("advertiser", advertisers, "advertisers", element, [F.lit("N").alias("advertiserMappedByMedia")])


def destination_documents(t: dict[str, DataFrame]) -> DataFrame:
    sup = t["supplier"].join(t["nation"].select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    kind = F.when(F.col("s_suppkey") % 3 == 0, F.lit("BROADCAST")).otherwise(F.lit("CABLE"))
    first = sup.select(
        "n_name",
        F.lit(DESTINATION_EXTRACTS[0]).cast("timestamp").alias("extract"),
        "s_suppkey",
        F.col("s_name").alias("name"),
        F.when(F.col("s_suppkey") % 10 == 0, F.lit(None).cast("string")).otherwise(kind).alias("type"),
    )
    second = sup.select(
        "n_name",
        F.lit(DESTINATION_EXTRACTS[1]).cast("timestamp").alias("extract"),
        "s_suppkey",
        F.concat(F.col("s_name"), F.lit(" (renamed)")).alias("name"),
        kind.alias("type"),
    )
    rows = first.unionByName(second).withColumn("chunk", F.floor(F.col("s_suppkey") / DOC_CHUNK))
    element = F.struct(
        F.col("s_suppkey").cast("string").alias("id"),
        F.col("name"),
        F.when(F.col("s_suppkey") % 2 == 0, F.lit("NATIONAL")).otherwise(F.lit("LOCAL")).alias("media"),
        F.col("type"),
        (F.col("s_suppkey") % 100).cast("string").alias("nielsenCode"),
    )
    return _docs("destination", _by_file(rows, rows.select("extract")), "destinations", element)


def estimate_documents(t: dict[str, DataFrame]) -> DataFrame:
    rows = (
        _order_tenants(t, ["o_orderdate", "o_orderpriority", "o_orderstatus"])
        .withColumn("extract", F.col("o_orderdate"))
        .withColumn("chunk", F.floor(F.col("o_orderkey") / DOC_CHUNK))
        .withColumn("version", (F.col("o_orderkey") % 2).cast("int"))
    )
    rows = _by_file(rows, t["orders"].select("o_orderdate"))
    start = F.col("o_orderdate").cast("date")
    brand = F.concat(F.lit("B"), (F.col("o_orderkey") % 100).cast("string"))
    brand2 = F.concat(F.lit("B"), (F.col("o_orderkey") % 7).cast("string"))
    common = [
        F.concat(F.col("o_custkey").cast("string"), F.lit("-"), F.col("o_orderpriority")).alias("id"),
        F.concat(F.lit("EST-"), F.col("o_orderkey").cast("string")).alias("name"),
        start.alias("startDate"),
        F.date_add(start, 30).alias("endDate"),
        F.col("o_orderstatus").alias("media"),
        F.col("o_custkey").cast("string").alias("advertiserId"),
    ]
    v2017 = _docs("estimate", rows.where("version = 0"), "estimates", F.struct(*common, brand.alias("brandId")))
    v2018 = _docs("estimate", rows.where("version = 1"), "estimates", F.struct(*common, F.array(brand, brand2).alias("brandIds")))
    return v2017.unionByName(v2018)


def daypart_documents(t: dict[str, DataFrame]) -> DataFrame:
    rows = (
        t["events"].select("event_id", "ts", "user_id", "event_type", "value")
        .join(t["customer"].select("c_custkey", "c_nationkey"), F.col("user_id") == F.col("c_custkey"))
        .join(t["nation"].select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("extract", F.date_trunc("SECOND", "ts"))
        .withColumn("chunk", F.floor(F.col("event_id") / DOC_CHUNK))
    )
    element = F.struct(
        F.col("event_type").alias("id"),
        F.concat(F.col("event_type"), F.lit("-"), F.hour("ts").cast("string")).alias("name"),
        F.when(F.col("value") >= 50, F.lit("DIGITAL")).otherwise(F.lit("LINEAR")).alias("media"),
        F.when(F.col("event_type") == NO_ADVERTISER_EVENT, F.lit(None).cast("string"))
        .otherwise(F.col("user_id").cast("string"))
        .alias("advertiserId"),
    )
    return _docs("daypart", _by_file(rows, t["events"].select("ts")), "dayparts", element)


def program_documents(t: dict[str, DataFrame]) -> DataFrame:
    rows = (
        t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag")
        .join(_order_tenants(t), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["part"].select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("extract", F.col("l_shipdate"))
        .withColumn("chunk", F.floor(F.col("l_orderkey") / DOC_CHUNK))
    )
    start = F.col("l_shipdate").cast("date")
    element = F.struct(
        F.col("l_partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.col("l_suppkey").cast("string").alias("networkId"),
        start.alias("startDate"),
        F.date_add(start, 90).alias("endDate"),
        F.col("l_returnflag").alias("media"),
    )
    return _docs("program", _by_file(rows, t["lineitem"].select("l_shipdate")), "programs", element)


BUILDERS = {
    "advertiser": advertiser_documents,
    "destination": destination_documents,
    "estimate": estimate_documents,
    "daypart": daypart_documents,
    "program": program_documents,
}


def write_landing(spark: SparkSession, sf_dir: str, root: str, feeds=tuple(BUILDERS)) -> str:
    """Write the documents of ``feeds`` under ``root``; returns ``root``."""
    for feed in feeds:
        write_documents(BUILDERS[feed](read_tables(spark, sf_dir)), root)
    return root


def write_documents(docs: DataFrame, root: str) -> None:
    """Append (feed_file, value) rows to the landing area, compressed."""
    fast = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    docs.select("feed_file", "value").write.mode("append").options(**fast).partitionBy("feed_file").text(root)


def seed_lookups(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lookup tables that exist before a feed run: tenant (nation), client
    (customer) and network (supplier, without every tenth supplier so that
    some programs miss their network)."""
    t = read_tables(spark, sf_dir)
    tenant = t["nation"].select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("mo_id"))
    client = t["customer"].select(
        F.col("c_custkey").cast("long").alias("id"),
        F.col("c_custkey").cast("string").alias("mo_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("long").alias("tenant_id"),
    )
    network = t["supplier"].where(F.col("s_suppkey") % 10 != 0).select(
        F.col("s_suppkey").cast("long").alias("id"),
        F.col("s_suppkey").cast("string").alias("mo_id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("long").alias("tenant_id"),
        F.when(F.col("s_suppkey") % 2 == 0, F.lit("NATIONAL")).otherwise(F.lit("LOCAL")).alias("media"),
        F.when(F.col("s_suppkey") % 3 == 0, F.lit("BROADCAST")).otherwise(F.lit("CABLE")).alias("network_type"),
        (F.col("s_suppkey") % 100).cast("string").alias("nielsen_code"),
    )
    return {"tenant": tenant, "client": client, "network": network}
