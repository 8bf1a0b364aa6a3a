"""External-id resolution against lookup (dimension) tables.

Every lookup is a left outer equi-join on the external id; what happens to
rows whose parent is missing is a policy:

* ``raise`` - stop before any target is written, listing the missing keys
  (some in the message, all in a table);
* ``keep``  - keep the row with null ids;
* ``drop``  - remove the row.

The dimension is broadcast only after its size (rows, then bytes) is
checked against bounds; above them the join shuffles both sides, and rows with a null key
(which can never match and may be a large share of a feed) or with a hot key are
salted over the shuffle partitions instead of piling into one.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

MISS_POLICIES = ("raise", "keep", "drop")
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024
# session settings that override the bounds (e.g. raise them on big executors)
BROADCAST_ROWS_CONF = "feedspark.lookup.broadcastMaxRows"
BROADCAST_BYTES_CONF = "feedspark.lookup.broadcastMaxBytes"


def broadcast_bound(df: DataFrame) -> int:
    """Row bound for broadcasting a lookup: the session setting, else 1,000,000."""
    return int(df.sparkSession.conf.get(BROADCAST_ROWS_CONF, str(DEFAULT_BROADCAST_ROWS)))


def broadcast_byte_bound(df: DataFrame) -> int:
    """Byte bound for broadcasting a lookup: the session setting, else 256 MiB."""
    return int(df.sparkSession.conf.get(BROADCAST_BYTES_CONF, str(DEFAULT_BROADCAST_BYTES)))


class MissingParentError(RuntimeError):
    """Feed rows point at parents that the lookup table does not hold."""

    def __init__(self, what: str, keys: list, more: bool, table: str | None = None):
        self.what = what
        self.keys = keys
        self.more = more
        # holds every missing key
        self.table = table
        listed = "\n".join(str(k) for k in keys)
        suffix = f"\n... (all in {table})" if more else ""
        super().__init__(f"{what} missing: {listed}{suffix}")


def fits_broadcast(dim: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """True when ``dim`` has at most ``max_rows`` rows and about ``max_bytes`` bytes.

    One partial aggregate: every task reads its part of the lookup and passes on
    one row (count, bytes of the JSON-encoded values, which stand in for the
    broadcast size). No row of the lookup moves, whatever its size.
    """
    if max_rows is None:
        max_rows = broadcast_bound(dim)
    if max_bytes is None:
        max_bytes = broadcast_byte_bound(dim)
    if max_rows <= 0 or max_bytes <= 0:
        return False
    width = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in dim.columns]))) if dim.columns else F.lit(0)
    rows, size = dim.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _condition(left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str]) -> Column:
    cond = None
    for lk, rk in zip(left_on, right_on, strict=True):
        c = left[lk] == right[rk]
        cond = c if cond is None else cond & c
    return cond


_SALT_L = "_lookup_salt"
_SALT_R = "_lookup_salt_dim"
# salts of a null or hot key for every shuffle partition: hashed to partitions,
# so many make each partition's share even
SPREAD = 8
MAX_SALTS = 4096
HOT_KEYS = 64  # a sketch tracks many more and is asked for these


def hot_keys(feed: DataFrame, keys: Sequence[str], partitions: int) -> list[int]:
    """Hashes of the keys that hold more rows than half a shuffle partition's
    even share, by a mergeable sketch: one partial aggregate over the keys,
    whose result is one row."""
    key = F.xxhash64(*[F.col(k) for k in keys]).alias("_key")
    found = feed.where(_complete(keys)).select(key).agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_key, {HOT_KEYS}, {100 * HOT_KEYS})").alias("top")).first()
    return [x["item"] for x in found["top"] or [] if x["count"] * 2 * partitions > found["n"]]


def _complete(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def _salted_left_join(feed: DataFrame, dim: DataFrame, lk: list[str], rk: list[str]) -> DataFrame:
    """Shuffled left outer join in which null-key rows and hot keys are spread.

    A null key never matches, but hashed as is every such row lands in one
    shuffle partition (one task may get a third of the feed), and so do the
    rows of one hot parent. Both get a deterministic hash bucket of the row as
    a second join key; the few parents of hot keys are repeated for every
    bucket, all others have bucket 0. Matches are unchanged. The join is
    hinted, so that no size estimate turns it into a broadcast.
    """
    partitions = max(1, int(feed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salts = min(MAX_SALTS, SPREAD * partitions)
    # equal keys must hash alike, so their types must be the same
    alike = [feed.schema[k].dataType for k in lk] == [dim.schema[k].dataType for k in rk]
    hot = hot_keys(feed, lk, partitions) if alike else []
    row = F.pmod(F.xxhash64(*[F.col(c) for c in feed.columns]), F.lit(salts).cast("long"))
    spread = ~_complete(lk) | (F.xxhash64(*[F.col(k) for k in lk]).isin(hot) if hot else F.lit(False))
    left = feed.withColumn(_SALT_L, F.when(spread, row).otherwise(F.lit(0).cast("long")))
    # not a literal, so the optimizer keeps it as a join key
    zero = F.when(F.col(rk[0]).isNotNull(), F.lit(0).cast("long"))
    if hot:
        every = F.when(F.xxhash64(*[F.col(k) for k in rk]).isin(hot), F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).otherwise(F.array(zero))
        right = dim.withColumn(_SALT_R, F.explode(every))
    else:
        right = dim.withColumn(_SALT_R, zero)
    cond = _condition(left, right, lk + [_SALT_L], rk + [_SALT_R])
    return left.hint("merge").join(right.hint("merge"), cond, "left_outer").drop(_SALT_L, _SALT_R)


def missing_parents(
    feed: DataFrame,
    dim: DataFrame,
    left_on: str | Sequence[str],
    right_on: str | Sequence[str],
    *,
    broadcast: bool | None = None,
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """Distinct feed keys with no parent in ``dim`` (a null key counts as missing).

    Distinct first (partial + final hash aggregate: map-side combine), then the
    join, so only distinct keys ever cross the network. Spark moves an anti join
    below the distinct, where every row of the feed would cross it and the rows
    of a hot parent lie in one task; that is left to a broadcast lookup, which
    moves none of them.
    """
    lk, rk = _keys(left_on), _keys(right_on)
    keys = feed.select(*lk).distinct()
    # repeats of a parent match the same key: no distinct of the lookup
    parents = dim.select(*[F.col(r).alias(f"_p{i}") for i, r in enumerate(rk)])
    if broadcast is None:
        broadcast = fits_broadcast(dim, max_broadcast_rows)
    cond = _condition(keys, parents, lk, [f"_p{i}" for i in range(len(rk))])
    if broadcast:
        return keys.join(F.broadcast(parents), cond, "left_anti")
    return keys.join(parents.hint("merge"), cond, "left_outer").where(F.col("_p0").isNull()).select(*lk)


def require_parents(
    feed: DataFrame,
    dim: DataFrame,
    left_on: str | Sequence[str],
    right_on: str | Sequence[str],
    *,
    what: str = "Parents",
    show: int = 50,
    broadcast: bool | None = None,
    max_broadcast_rows: int | None = None,
) -> None:
    """Raise :class:`MissingParentError` when any feed key has no parent.

    The whole list of missing keys is written to a table in the shared
    checkpoint folder, named in the error; the message shows ``show`` of them.
    """
    missing = missing_parents(feed, dim, left_on, right_on, broadcast=broadcast, max_broadcast_rows=max_broadcast_rows)
    rows = missing.limit(show + 1).collect()
    if rows:
        keys = [r[0] if len(r) == 1 else tuple(r) for r in rows[:show]]
        table = scratch_path(feed.sparkSession, f"missing-{what.lower()}")
        missing.write.parquet(table)
        raise MissingParentError(what, keys, len(rows) > show, table)


def resolve(
    feed: DataFrame,
    dim: DataFrame,
    left_on: str | Sequence[str],
    right_on: str | Sequence[str],
    *,
    miss: str = "keep",
    id_col: str | None = None,
    what: str = "Parents",
    broadcast: bool | None = None,
    max_broadcast_rows: int | None = None,
    laid_out: bool = False,
) -> DataFrame:
    """Left outer lookup of ``feed`` in ``dim`` with a miss policy.

    ``dim`` should already carry the output names it contributes (rename it
    before the call), so no column name is ambiguous afterwards. An external
    id present more than once in ``dim`` matches every copy (fan-out); pass a
    second key column (e.g. the tenant) to scope the match. ``drop`` removes
    rows whose ``id_col`` (default: the first dimension column that is not a
    join key) is null after the join. ``laid_out`` joins two tables bucketed by
    the key where they lie: no broadcast, no salt and no shuffle (null and hot
    keys stay in their buckets, so it is for keys that are spread well).
    """
    if miss not in MISS_POLICIES:
        raise ValueError(f"miss must be one of {MISS_POLICIES}")
    lk, rk = _keys(left_on), _keys(right_on)
    if laid_out:
        if broadcast:
            raise ValueError("tables joined where they lie are not broadcast")
        broadcast = False
    if broadcast is None:
        broadcast = fits_broadcast(dim, max_broadcast_rows)
    if miss == "raise":
        require_parents(feed, dim, lk, rk, what=what, broadcast=broadcast)
    if broadcast:
        right = F.broadcast(dim)
        joined = feed.join(right, _condition(feed, right, lk, rk), "left_outer")
    elif laid_out:
        right = dim.hint("merge")
        joined = feed.join(right, _condition(feed, right, lk, rk), "left_outer")
    else:
        joined = _salted_left_join(feed, dim, lk, rk)
    if miss == "drop":
        check = id_col or next(c for c in dim.columns if c not in rk)
        joined = joined.where(F.col(check).isNotNull())
    return joined
