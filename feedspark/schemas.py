"""Feed document schemas, parse formats and target-table layouts.

Everything in this module is a fixed value that must equal the feed format:
field names, their order and types, and the two parse patterns.
"""
from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values: parse formats of feed documents --------------------------
TIMESTAMP_FORMAT = "yyyy-MM-dd-HH-mm-ss"
DATE_FORMAT = "yyyy-MM-dd"

# --- fixed values: feed words looked for in landing file names --------------
FEED_WORDS = {
    "advertiser": "ADVERTISERFEED",
    "destination": "DESTINATIONFEED",
    "estimate": "ESTIMATEFEED",
    "daypart": "DAYPARTFEED",
    "program": "PROGRAMFEED",
}


def _s(name: str) -> StructField:
    return StructField(name, StringType(), True)


def _d(name: str) -> StructField:
    return StructField(name, DateType(), True)


def _arr(name: str, element: StructType) -> StructField:
    return StructField(name, ArrayType(element, True), True)


# --- fixed values: envelope shared by every feed ----------------------------
ENVELOPE = [
    _s("moSystem"),
    _s("tenant"),
    _s("system"),
    _s("feedType"),
    _s("filename"),
    StructField("extractdatetime", TimestampType(), True),
]

# --- fixed values: payload of each feed -------------------------------------
BRAND = StructType([_s("id"), _s("name")])
ADVERTISER = StructType([_s("id"), _s("name"), _s("media"), _arr("brands", BRAND)])
# The estimate feed has two shapes: 2017 files carry a scalar ``brandId``,
# 2018+ files an array ``brandIds``. One superset element reads both.
ESTIMATE_2017 = StructType(
    [_s("advertiserId"), _s("brandId"), _d("endDate"), _s("id"), _s("media"), _s("name"), _d("startDate")]
)
ESTIMATE_2018 = StructType(
    [
        _s("id"),
        _s("name"),
        _d("startDate"),
        _d("endDate"),
        _s("media"),
        _s("advertiserId"),
        StructField("brandIds", ArrayType(StringType(), True), True),
    ]
)
ESTIMATE_ANY = StructType(ESTIMATE_2018.fields + [_s("brandId")])
DAYPART = StructType([_s("id"), _s("name"), _s("media"), _s("advertiserId")])
DESTINATION = StructType([_s("id"), _s("name"), _s("media"), _s("type"), _s("nielsenCode")])
PROGRAM = StructType([_s("id"), _s("name"), _s("networkId"), _d("startDate"), _d("endDate"), _s("media")])


def document_schema(payload_field: str, element: StructType, extra_envelope: list[StructField] | None = None) -> StructType:
    """Envelope (+ feed-specific top-level scalars) + one payload array."""
    env = list(ENVELOPE)
    if extra_envelope:
        env = env[:3] + list(extra_envelope) + env[3:]
    return StructType(env + [_arr(payload_field, element)])


ADVERTISER_DOC = document_schema("advertisers", ADVERTISER, [_s("advertiserMappedByMedia")])
ESTIMATE_DOC = document_schema("estimates", ESTIMATE_ANY)
DAYPART_DOC = document_schema("dayparts", DAYPART)
DESTINATION_DOC = document_schema("destinations", DESTINATION)
PROGRAM_DOC = document_schema("programs", PROGRAM)

# --- fixed values: target tables (column order of each write) ---------------
# ``id`` is made at insert time (by the database, or by ``assign_ids``).
TARGET_COLUMNS = {
    "tenant": ["id", "mo_id"],
    "client": ["id", "mo_id", "name", "tenant_id"],
    "product": ["mo_id", "name", "client_id"],
    "network": ["id", "mo_id", "name", "tenant_id", "media", "network_type", "nielsen_code"],
    "estimate": ["mo_id", "media", "client_id", "start_date", "end_date", "name"],
    "daypart": ["mo_id", "media", "client_id", "name", "tenant_id"],
    "program": ["tenant_id", "network_id", "mo_id", "name", "media", "start_date", "end_date"],
}

_TARGET_TYPES = {
    "id": LongType(),
    "tenant_id": LongType(),
    "client_id": LongType(),
    "network_id": LongType(),
    "start_date": DateType(),
    "end_date": DateType(),
}

# Tables whose ``id`` is generated on insert, with the order ids follow.
GENERATED_IDS = {"client": ["tenant_id", "mo_id"], "network": ["tenant_id", "mo_id"]}


def target_schema(table: str) -> StructType:
    return StructType(
        [StructField(c, _TARGET_TYPES.get(c, StringType()), True) for c in TARGET_COLUMNS[table]]
    )
