"""Incremental loads that equal a load of the whole history.

Every target has a ledger: the first-seen row of each *feed* key (external
ids, before any lookup or filter), with its extract time. The target is derived
from it with the same row functions a full load uses, so neither the number of
runs nor the order in which files arrive can change the result: a rejected key
stays known, and an earlier extract that arrives late corrects its row, which
keeps its id.

A ledger is a base and deltas, merged on read. A run writes only the rows that
are new or earlier than what is held; deltas are folded into the base once they
hold half as much, so what all runs write together follows the new keys.

A run derives only the entities (external ids of the target, which every target
key contains) that its new rows belong to, or that a change in a lookup table
reaches: the lookup's folders are compared with those the target was last
derived with, and only the ids whose rows differ are followed. Of the target
only folders that hold a corrected or withdrawn row are written again.

All of it - ledgers, targets, both tables of a feed - is published in one
commit (see :mod:`feedspark.plans.catalog`), so a run that stops half way has
changed nothing and is repeated.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.dedupe import first_seen
from ..operators.keys import assign_ids
from ..operators.lookup import fits_broadcast
from ..schemas import GENERATED_IDS, TARGET_COLUMNS
from ..session import scratch_path

# deltas are folded into the base when their rows are this share of its rows,
# or when there are this many
FOLD_SHARE, FOLD_DELTAS = 0.5, 64


@dataclass(frozen=True)
class Ledger:
    """What a target's ledger holds. ``key`` and ``rest`` are flat-feed
    columns; ``rest`` breaks ties in this order. ``entity`` is the flat column
    that becomes the target's ``mo_id``."""

    entity: str
    key: tuple[str, ...]
    rest: tuple[str, ...]
    lookups: tuple[str, ...]


# --- fixed values: feed keys of the targets, tie-breaks in target column order
LEDGERS = {
    "client": Ledger("advertiser_id", ("tenant", "advertiser_id"), ("advertiser_name",), ("tenant",)),
    "product": Ledger("brand_id", ("tenant", "advertiser_id", "brand_id"), ("brand_name",), ("tenant", "client")),
    "network": Ledger("id", ("tenant", "id"), ("name", "media", "type", "nielsen_code"), ("tenant",)),
    "estimate": Ledger(
        "id", ("tenant", "id", "advertiser_id"), ("media", "start_date", "end_date", "estimate_name"), ("tenant", "client")
    ),
    "daypart": Ledger("id", ("tenant", "id", "advertiser_id"), ("media", "daypart_name"), ("tenant", "client")),
    "program": Ledger(
        "program_id", ("tenant", "program_id", "program_network_id"),
        ("program_name", "program_media", "program_start_date", "program_end_date"), ("tenant", "network"),
    ),
}


# --- fixed values: columns of the lookups that a load reads, and the flat column that points at them
LINKS = {
    "tenant": (("id", "mo_id"), "tenant"),
    "client": (("id", "mo_id", "tenant_id"), "advertiser_id"),
    "network": (("id", "mo_id", "tenant_id"), "program_network_id"),
}
_KEY = "_entity"


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same(left: DataFrame, right: DataFrame, cols) -> Column:
    """Null-safe equality of the given columns."""
    return reduce(Column.__and__, [left[c].eqNullSafe(right[c]) for c in cols])


def _of_entities(rows: DataFrame, entity: str, entities: DataFrame) -> DataFrame:
    """Rows of the given entities, which are distinct; a null one is as any other.

    The join is on the column itself, not null-safe: where it shuffles, rows
    then lie by their entity, which every key contains, so that no window over
    a key moves them again."""
    known = F.col("_known").isNotNull()
    if not entities.where(F.col(_KEY).isNull()).isEmpty():
        known = known | F.col(entity).isNull()
    mine = entities.where(F.col(_KEY).isNotNull()).withColumn("_known", F.lit(1))
    return rows.join(mine, F.col(entity) == F.col(_KEY), "left_outer").where(known).drop(_KEY, "_known")


def ledger_rows(catalog, table: str, entities: DataFrame | None = None) -> DataFrame | None:
    """First-seen rows of a ledger (of some entities), base and deltas merged."""
    held, spec = catalog.state().get("ledgers", {}).get(table), LEDGERS[table]
    if not held:
        return None
    rows = catalog.open(held["folders"])
    if entities is not None:
        rows = _of_entities(rows, spec.entity, entities)
    return rows if len(held["folders"]) == 1 else first_seen(rows, spec.key, tiebreak=spec.rest)


def _of_keys(known: DataFrame, batch: DataFrame, key) -> DataFrame:
    """The known rows whose key is in ``batch`` (and any whose key hashes like
    one). What is shuffled of rows that have no part in the batch is the hash of
    their key."""
    hashed = F.xxhash64(*[F.col(k) for k in key])
    found = known.select(hashed.alias("_h")).join(batch.select(hashed.alias("_h")), "_h", "left_semi").distinct()
    found = _staged(found, "keys-known")
    return known.withColumn("_h", hashed).join(found, "_h", "left_semi").drop("_h")


def merge_ledger(flat: DataFrame, catalog, table: str) -> DataFrame | None:
    """Add the rows of ``flat`` that are new to the ledger, or earlier than what
    it holds, as a delta. Returns the delta (None: nothing new)."""
    spec = LEDGERS[table]
    batch = first_seen(flat.select(*spec.key, "extract_datetime", *spec.rest), spec.key, tiebreak=spec.rest)
    ledgers = catalog.part("ledgers")
    held = ledgers.get(table, {"folders": [], "rows": []})
    if held["folders"]:
        batch = _staged(batch, f"ledger-batch-{table}")
        known = _of_keys(catalog.open(held["folders"]), batch, spec.key)
        both = batch.withColumn("_new", F.lit(1)).unionByName(known.select(*batch.columns).withColumn("_new", F.lit(0)))
        # of equal rows the one that is held stands first
        batch = first_seen(both, spec.key, tiebreak=[*spec.rest, "_new"]).where("_new = 1").drop("_new")
    folder = catalog.store(f"ledger-{table}", batch)
    delta = catalog.open([folder])
    n = delta.count()
    if not n:
        return None
    held = {"folders": [*held["folders"], folder], "rows": [*held["rows"], n]}
    ledgers[table] = held
    if len(held["folders"]) > FOLD_DELTAS or sum(held["rows"][1:]) > FOLD_SHARE * held["rows"][0]:
        if len(held["folders"]) > 1:
            base = catalog.store(f"ledger-{table}", ledger_rows(catalog, table))
            ledgers[table] = {"folders": [base], "rows": [catalog.open([base]).count()]}
    return delta


def changed_ids(catalog, lookup: str, before: list[str] | None) -> DataFrame | None:
    """External ids whose rows differ between the folders a lookup had and the
    folders it has (None: no difference is possible)."""
    now = catalog.folders(lookup) or []
    if before is None or before == now:
        return None
    cols = LINKS[lookup][0]

    def rows(folders: list[str]) -> DataFrame:
        if not folders:
            return catalog.spark.createDataFrame([], ", ".join(f"{c} string" for c in cols))
        held = catalog.open(folders)
        return held.select(*(F.col(c).cast("string") if c in held.columns else F.lit(None).cast("string").alias(c) for c in cols))

    added, gone = rows([f for f in now if f not in before]), rows([f for f in before if f not in now])
    either = added.withColumn("_n", F.lit(1)).unionByName(gone.withColumn("_n", F.lit(-1)))
    return either.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n <> 0").select(F.col("mo_id").alias("_changed")).distinct()


def reached(catalog, table: str, delta: DataFrame | None) -> DataFrame | None:
    """Entities to derive: those of new ledger rows, and those whose ledger
    rows point at a changed lookup row."""
    spec = LEDGERS[table]
    parts = [] if delta is None else [delta.select(F.col(spec.entity).alias(_KEY))]
    seen = catalog.state().get("seen", {}).get(table, {})
    held = catalog.state().get("ledgers", {}).get(table)
    # base and deltas as they lie: what points at a lookup is part of the key, so merging changes no entity
    rows = catalog.open(held["folders"]) if held else None
    for lookup in spec.lookups if held else ():
        if catalog.folders(lookup) == [lookup]:  # a plain folder that others may change in place
            parts.append(rows.select(F.col(spec.entity).alias(_KEY)))
            continue
        ids = changed_ids(catalog, lookup, seen.get(lookup))
        if ids is not None:
            link = F.col(LINKS[lookup][1])
            parts.append(rows.join(ids, link == F.col("_changed"), "left_semi").select(F.col(spec.entity).alias(_KEY)))
    return _staged(reduce(DataFrame.unionByName, parts).distinct(), f"entities-{table}") if parts else None


def _differing(wanted: DataFrame, have: DataFrame) -> DataFrame:
    """Rows of either side without an equal row (in the columns of ``wanted``)
    on the other, marked by ``_wanted``; both sides move once."""
    more = [c for c in have.columns if c not in wanted.columns]
    none = [F.lit(None).cast(have.schema[c].dataType).alias(c) for c in more]
    cols = wanted.columns
    both = have.select(*cols, *more, F.lit(0).alias("_wanted")).unionByName(wanted.select(*cols, *none, F.lit(1).alias("_wanted")))
    equal = Window.partitionBy(*cols)
    ends = both.withColumns({"_least": F.min("_wanted").over(equal), "_most": F.max("_wanted").over(equal)})
    return ends.where(F.col("_least") == F.col("_most")).drop("_least", "_most")


def sync_target(
    catalog, table: str, wanted: DataFrame, key: list[str], entities: DataFrame | None, keyed: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Make the target's rows of ``entities`` (None: there is no row yet) equal to ``wanted``.

    ``wanted`` has the key and the target columns (without a made ``id``);
    ``keyed`` adds key columns that the target does not store. A row whose key
    is there keeps its id. New rows are one more folder; folders that hold a
    row that is corrected or withdrawn are written again without it.
    """
    made = table in GENERATED_IDS
    cols = [c for c in TARGET_COLUMNS[table] if not (made and c == "id")]
    stored = (["id"] if made else []) + cols
    wanted = wanted.select(*dict.fromkeys([*key, *cols]))
    folders = catalog.folders(table) or []
    if folders:
        part = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]*$", 1)
        target = catalog.read(table).withColumn("_folder", part)
        have = _of_entities(target, "mo_id", entities)
        have = (keyed(have) if keyed else have).select("_folder", *dict.fromkeys([*stored, *key]))
        differ = _staged(_differing(wanted, have), f"differ-{table}")
        changed = differ.where("_wanted = 1").select(*wanted.columns)
        gone = differ.where("_wanted = 0").drop("_wanted")
    else:
        changed, gone = wanted, None
    hit = {r[0] for r in gone.select("_folder").distinct().collect()} if gone is not None else set()
    if made:
        if hit:
            ids = gone.groupBy(*key).agg(F.min("id").alias("_kept"))
            ids = ids.select(F.col("_kept"), *(F.col(c).alias(f"_{c}") for c in key))
            known = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key])
            changed = _staged(changed.join(ids, known, "left").select("_kept", *changed.columns), f"changed-{table}")
            old = changed.where("_kept IS NOT NULL").select(F.col("_kept").alias("id"), *cols)
            fresh = changed.where("_kept IS NULL").select(*cols)
        else:
            old, fresh = None, changed.select(*cols)
        body = assign_ids(fresh, GENERATED_IDS[table], start=lambda n: catalog.reserve(table, n)).select(*stored)
        body = body if old is None else body.unionByName(old.select(*stored))
    else:
        body = changed.select(*cols)
    if hit:
        again = [f for f in folders if f.rsplit("/", 1)[-1] in hit]
        rest = catalog.open(again).select(*stored)
        out = gone.select(*stored).distinct()
        body = rest.join(out, _same(rest, out, stored), "left_anti").unionByName(body)
        folders = [f for f in folders if f not in again]
    from .catalog import conform

    folder = catalog.store(table, conform(body, table))
    if hit or not folders or not catalog.open([folder]).isEmpty():
        catalog.replace(table, [*folders, folder])


def run(flat: DataFrame, catalog, table: str, derive: Callable[[DataFrame], DataFrame], key: list[str], keyed=None) -> None:
    """Merge ``flat`` into the ledger of ``table`` and bring the target up to
    it, in one commit (that of the caller's transaction, if there is one)."""
    if not hasattr(catalog, "state"):
        raise ValueError("incremental loads need a catalog with ledgers; a database target takes full loads only")
    with catalog.transaction():
        empty = not catalog.state().get("ledgers", {}).get(table) and not catalog.folders(table)
        delta = merge_ledger(flat, catalog, table)
        if empty:  # whatever there is now is new
            if delta is not None:
                sync_target(catalog, table, derive(ledger_rows(catalog, table)), key, None, keyed)
        else:
            entities = reached(catalog, table, delta)
            if entities is not None and not entities.isEmpty():
                rows = ledger_rows(catalog, table, entities)
                if not all(fits_broadcast(catalog.read(x)) for x in LEDGERS[table].lookups):
                    # a shuffled lookup looks for hot keys first: merged once for both
                    rows = _staged(rows, f"reached-{table}")
                sync_target(catalog, table, derive(rows), key, entities, keyed)
        # the folders themselves are the snapshot: no commit changes one
        catalog.part("seen")[table] = {x: catalog.folders(x) or [] for x in LEDGERS[table].lookups}
