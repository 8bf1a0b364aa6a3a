"""Declarative description of every feed: document schema, which arrays to
flatten and how the flat columns are named."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

from .. import schemas as S
from ..functions.parse import merge_brand_ids


@dataclass(frozen=True)
class FeedSpec:
    """How one feed's documents become a flat table.

    ``explode`` is applied in order; each entry replaces (or adds) a column
    by one element of the array at ``path`` (an inner explode: a null or
    empty array gives no row, unless ``keep_empty`` is asked for).
    ``columns`` maps flat column name -> source column path.
    """

    name: str
    word: str
    schema: StructType
    explode: tuple[tuple[str, str], ...]
    columns: tuple[tuple[str, str], ...]
    derived: tuple[tuple[str, object], ...] = field(default=())
    # source paths each derived column reads
    derived_paths: tuple[tuple[str, tuple[str, ...]], ...] = field(default=())

    def select_list(self, columns: Sequence[str] | None = None) -> list[Column]:
        keep = set(columns) if columns is not None else None
        cols = [F.col(src).alias(dst) for dst, src in self.columns if keep is None or dst in keep]
        for dst, make in self.derived:
            if keep is None or dst in keep:
                cols.append(make().alias(dst))  # type: ignore[operator]
        return cols

    def flat_names(self) -> list[str]:
        return [dst for dst, _ in self.columns] + [dst for dst, _ in self.derived]

    def read_schema(self, columns: Sequence[str] | None = None) -> StructType:
        """Document schema reduced to the fields the given flat columns read
        (and the arrays that are exploded). Spark prunes top-level JSON
        fields by itself, but not fields inside exploded arrays."""
        if columns is None:
            return self.schema
        unknown = set(columns) - set(self.flat_names())
        if unknown:
            raise ValueError(f"{self.name} has no flat columns {sorted(unknown)}")
        sources = dict(self.columns)
        derived = dict(self.derived_paths)
        paths = []
        for c in columns:
            paths.extend(derived[c] if c in derived else [sources[c]])
        aliases = {name: path for name, path in self.explode if name != path}

        def resolve(path: str) -> list[str]:
            head, *rest = path.split(".")
            if head in aliases:
                return resolve(".".join([aliases[head], *rest]))
            return [head, *rest]

        # an exploded array must exist, but not all of its fields are needed
        containers = [resolve(p) + [_ANY] for _, p in self.explode]
        return _prune(self.schema, [resolve(p) for p in paths] + containers)  # type: ignore[return-value]


_ANY = "\0"  # path step: keep the container, no field in particular


def _prune(dtype: DataType, paths: list[list[str]]) -> DataType:
    """Keep only the fields on ``paths`` (a path ending at a field keeps all of it)."""
    if isinstance(dtype, ArrayType):
        return ArrayType(_prune(dtype.elementType, paths), dtype.containsNull)
    if not isinstance(dtype, StructType) or any(not p for p in paths):
        return dtype
    paths = [p for p in paths if p[0] != _ANY] or []
    fields = []
    for f in dtype.fields:
        below = [p[1:] for p in paths if p[0] == f.name]
        if below:
            fields.append(StructField(f.name, _prune(f.dataType, below), f.nullable))
    if not fields:  # only the container was asked for: keep its first field
        f = dtype.fields[0]
        fields = [StructField(f.name, _prune(f.dataType, [[_ANY]]), f.nullable)]
    return StructType(fields)


def _envelope(*extra: tuple[str, str]) -> tuple[tuple[str, str], ...]:
    head = (("mo_system", "moSystem"), ("tenant", "tenant"), ("system", "system"))
    tail = (("feed_type", "feedType"), ("filename", "filename"), ("extract_datetime", "extractdatetime"))
    return head + tuple(extra) + tail


ADVERTISER = FeedSpec(
    name="advertiser",
    word=S.FEED_WORDS["advertiser"],
    schema=S.ADVERTISER_DOC,
    explode=(("advertisers", "advertisers"), ("brands", "advertisers.brands")),
    columns=_envelope(("advertiser_mapped_by_media", "advertiserMappedByMedia"))
    + (
        ("advertiser_id", "advertisers.id"),
        ("advertiser_name", "advertisers.name"),
        ("advertiser_media", "advertisers.media"),
        ("brand_id", "brands.id"),
        ("brand_name", "brands.name"),
    ),
)

ESTIMATE = FeedSpec(
    name="estimate",
    word=S.FEED_WORDS["estimate"],
    schema=S.ESTIMATE_DOC,
    explode=(("estimates", "estimates"),),
    columns=_envelope()
    + (
        ("id", "estimates.id"),
        ("estimate_name", "estimates.name"),
        ("start_date", "estimates.startDate"),
        ("end_date", "estimates.endDate"),
        ("media", "estimates.media"),
        ("advertiser_id", "estimates.advertiserId"),
        ("brand_id", "estimates.brandId"),
    ),
    # both schema versions: the 2018+ list, or the 2017 scalar as a list
    derived=(("brand_ids", merge_brand_ids),),
    derived_paths=(("brand_ids", ("estimates.brandIds", "estimates.brandId")),),
)

DAYPART = FeedSpec(
    name="daypart",
    word=S.FEED_WORDS["daypart"],
    schema=S.DAYPART_DOC,
    explode=(("dayparts", "dayparts"),),
    columns=_envelope()
    + (
        ("id", "dayparts.id"),
        ("daypart_name", "dayparts.name"),
        ("media", "dayparts.media"),
        ("advertiser_id", "dayparts.advertiserId"),
    ),
)

DESTINATION = FeedSpec(
    name="destination",
    word=S.FEED_WORDS["destination"],
    schema=S.DESTINATION_DOC,
    explode=(("destinations", "destinations"),),
    columns=_envelope()
    + (
        ("id", "destinations.id"),
        ("name", "destinations.name"),
        ("media", "destinations.media"),
        ("nielsen_code", "destinations.nielsenCode"),
        ("type", "destinations.type"),
    ),
)

PROGRAM = FeedSpec(
    name="program",
    word=S.FEED_WORDS["program"],
    schema=S.PROGRAM_DOC,
    explode=(("programs", "programs"),),
    columns=_envelope()
    + (
        ("program_id", "programs.id"),
        ("program_name", "programs.name"),
        ("program_network_id", "programs.networkId"),
        ("program_end_date", "programs.endDate"),
        ("program_start_date", "programs.startDate"),
        ("program_media", "programs.media"),
    ),
)

FEEDS: dict[str, FeedSpec] = {s.name: s for s in (ADVERTISER, ESTIMATE, DAYPART, DESTINATION, PROGRAM)}


def feed_spec(feed: str | FeedSpec) -> FeedSpec:
    if isinstance(feed, FeedSpec):
        return feed
    key = feed.lower()
    for spec in FEEDS.values():
        if key in (spec.name, spec.word.lower()):
            return spec
    raise ValueError(f"unknown feed {feed!r}; expected one of {sorted(FEEDS)}")
