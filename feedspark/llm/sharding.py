"""Sharding by balanced label propagation.

Rows with equal texts are linked. All rows start in shards dealt in turn, so
counts are at most one apart, and every shard keeps its count from then on (law
``rows``). Round by round every group that lies in several shards wants the one
that holds most of its rows and still has room for all of them; a shard's room
is its count less the rows of groups that lie in it whole. Larger groups go
first; those that a shard's room cannot take look further in the next round.
Rows that come in push out others, unlinked ones first, into the places of rows
that left. Every round settles at least one group, mostly nearly all that bid.
When no shard has room for any of the open groups, these are laid one after
another into the room left, and the rounds end.

A text with more rows than a shard is split beforehand into chunks below a
shard's size, which move as groups of their own. Groups are only ever counted
(partial aggregates) and ranked inside hash buckets; the few large ones (at most
``LARGE``) are joined by broadcast, the others by a shuffle, so no task holds a
large group. The driver sees a few counts per pair of shards.

Which rows share a shard: rows with equal texts, but for texts of more rows than
a shard and for those of the groups laid out last that cross from one shard
into the next: fewer than there are shards.

Defined results: a null text has size 1, crc32 0 and no links; empty texts are
equal texts; rows equal in id and text are rows of their own; a table of fewer
rows than shards fills the first shards; an empty table gives an empty table;
ids of any type; other columns are not looked at.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, gapless

# rows of one hash bucket when numbering
BUCKET_ROWS = 20_000
# groups of at least this part of all rows are joined by broadcast
LARGE = 10_000


def _line(counts: dict[int, int], shards: int) -> Column:
    return F.array(*(F.lit(int(counts.get(s, 0))).cast("long") for s in range(shards)))


def _with(rows: DataFrame, groups: DataFrame, least: int) -> DataFrame:
    """The rows whose ``grp`` is in ``groups`` (grp, size, ...), joined with it.
    Groups of ``least`` rows or more are at most ``LARGE`` and go by broadcast."""
    large = F.broadcast(groups.where(F.col("size") >= least))
    others = rows.join(F.broadcast(large.select("grp")), "grp", "left_anti")
    return rows.join(large, "grp").unionByName(others.join(groups.where(F.col("size") < least), "grp"))


def _starts(bids: DataFrame, buckets: int) -> DataFrame:
    """The groups (grp, size, aim) with the sum of the sizes before them in their
    shard, larger ones first. Running sums go over buckets of like size and
    hash, then inside each."""
    rank = F.struct((-F.floor(F.log2("size"))).alias("c"), F.pmod(F.xxhash64("grp"), F.lit(buckets)).alias("h"))
    b = bids.withColumn("_b", rank)
    total = b.groupBy("aim", "_b").agg(F.sum("size").alias("_sum"))
    before = W.partitionBy("aim").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    start = total.select("aim", "_b", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy("aim", "_b").orderBy(F.desc("size"), "grp").rowsBetween(W.unboundedPreceding, 0)
    placed = b.withColumn("_inside", F.sum("size").over(inside) - F.col("size")).join(start, ["aim", "_b"])
    return placed.select("grp", "size", "aim", (F.col("_start") + F.col("_inside")).alias("start"))


def _lay(linked: DataFrame, groups: DataFrame, room: dict[int, int], shards: int, least: int, buckets: int) -> DataFrame:
    """Rows (node, shard) of the groups with the shard ``aim`` that they fall
    in when the groups fill the rooms one after another."""
    line = cut(_with(linked, _starts(groups.select("grp", "size", F.lit(0).alias("aim")), buckets).drop("aim"), least), "shard_line")
    place = F.col("start") + F.col("place")
    ends = F.array(*(F.lit(sum(room[t] for t in range(s + 1))).cast("long") for s in range(shards)))
    aim = F.size(F.filter(ends, lambda e: e <= place))
    return gapless(line, ["grp"], ["node"], "place", buckets).select("node", "shard", aim.alias("aim"))


def _ways(net: dict[int, int], shards: int) -> dict[int, list[tuple[int, int]]]:
    """For every shard with more arrivals than leavers, which places its pushed
    out rows take: (shard, upper end of the places counted from 0)."""
    holes = [[s, -net.get(s, 0)] for s in range(shards) if net.get(s, 0) < 0]
    out: dict[int, list[tuple[int, int]]] = {}
    for s in range(shards):
        left, end = max(net.get(s, 0), 0), 0
        while left:
            n = min(left, holes[0][1])
            end, left, holes[0][1] = end + n, left - n, holes[0][1] - n
            out.setdefault(s, []).append((holes[0][0], end))
            if not holes[0][1]:
                holes.pop(0)
    return out


def _push(rest: DataFrame, ways: dict[int, list[tuple[int, int]]], shards: int, buckets: int) -> DataFrame:
    """Which rows leave the shards of ``ways`` and where they go. Rows without
    links leave first; ``rest`` (node, linked, shard) is a written table."""
    alone = {r.shard: r["count"] for r in rest.where("NOT linked").groupBy("shard").count().collect()}
    placed = gapless(rest.where(F.col("shard").isin(list(ways))), ["shard", "linked"], ["node"], "place", buckets)
    place = F.col("place") + F.when(F.col("linked"), F.get(_line(alone, shards), F.col("shard"))).otherwise(F.lit(0))
    aim = F.lit(None).cast("int")
    for s, ends in ways.items():
        to = F.lit(None).cast("int")
        for t, end in reversed(ends):
            to = F.when(place < end, F.lit(t)).otherwise(to)
        aim = F.when(F.col("shard") == s, to).otherwise(aim)
    return placed.select("node", aim.alias("aim")).where("aim IS NOT NULL")


def _split_large(dealt: DataFrame, total: int, shards: int, least: int) -> DataFrame:
    """``grp`` of every row: its text, or a chunk of a text that no shard can
    hold; null where no other row has the text."""
    sizes = dealt.where("_text IS NOT NULL").groupBy(F.col("_text").alias("grp")).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    linked = _with(dealt.where("_text IS NOT NULL").withColumnRenamed("_text", "grp"), cut(sizes, "shard_texts"), least)
    fits = -(-total // shards)
    chunks = F.when(F.col("size") <= fits, F.lit(1)).otherwise(F.ceil(F.col("size") / F.lit(max(1.0, 0.9 * (total // shards)))))
    grp = F.concat_ws(":", "grp", F.pmod(F.xxhash64("node"), chunks).cast("string"))
    return linked.select("node", grp.alias("grp"))


def assign(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every row."""
    text = F.col(text_col)
    rows = cut(
        docs.select(
            F.col(id_col).alias("id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.md5(text.cast("binary")).alias("_text"),
        ),
        "shard_rows",
    )
    total = rows.count()
    buckets = max(8, total // BUCKET_ROWS + 1)
    least = max(2, total // LARGE)
    dealt = cut(gapless(rows, [], ["id", "_text"], "node", buckets), "shard_dealt")
    grouped = _split_large(dealt.select("node", "_text"), total, shards, least)
    shard = F.pmod("node", F.lit(shards)).cast("int").alias("shard")
    state = cut(dealt.select("node").join(grouped, "node", "left").select("node", "grp", shard), "shard_state")
    capacity = {s: total // shards + (s < total % shards) for s in range(shards)}
    laid = False
    while not laid:
        linked = state.where("grp IS NOT NULL")
        tally = linked.groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("n"))
        lies = F.sort_array(F.collect_list(F.struct("n", F.xxhash64("grp", "shard").alias("tie"), "shard")), asc=False)
        groups = cut(tally.groupBy("grp").agg(F.sum("n").alias("size"), lies.alias("lies")), "shard_groups")
        whole = F.size("lies") == 1
        held = {r.shard: r.n for r in groups.where(whole).groupBy(F.get("lies", F.lit(0))["shard"].alias("shard")).agg(F.sum("size").alias("n")).collect()}
        room = {s: n - held.get(s, 0) for s, n in capacity.items()}
        # the shard with room that holds most of the group, else any with room
        spare = _line(room, shards)
        here = F.filter("lies", lambda x: F.get(spare, x["shard"]) >= F.col("size"))
        others = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.pmod(i + F.xxhash64("grp"), F.lit(shards)).cast("int"))
        there = F.filter(others, lambda s: F.get(spare, s) >= F.col("size"))
        aim = F.coalesce(F.get(here, F.lit(0))["shard"], F.get(there, F.lit(0))).alias("aim")
        bids = cut(groups.where(~whole).select("grp", "size", aim), "shard_bids")
        n_open, n_bids = bids.agg(F.count(F.lit(1)), F.count("aim")).first()
        if not n_open:
            break
        laid = not n_bids
        if laid:
            go, stay = _lay(linked, bids, room, shards, least, buckets), bids.limit(0)
        else:
            # larger groups first, while the sizes add up to no more than the room
            ends = F.col("start") + F.col("size")
            taken = cut(_starts(bids.where("aim IS NOT NULL"), buckets).where(ends <= F.get(spare, F.col("aim"))).drop("start"), "shard_taken")
            go, stay = _with(linked, taken, least), bids.join(taken.select("grp"), "grp", "left_anti")
        go = cut(go.where("shard <> aim").select("node", "shard", "aim"), "shard_movers")
        net = dict.fromkeys(range(shards), 0)
        for r in go.groupBy("shard", "aim").count().collect():
            net[r.shard] -= r["count"]
            net[r.aim] += r["count"]
        moves = go.select("node", "aim")
        if ways := _ways(net, shards):
            free = _with(linked, stay.select("grp", "size"), least).select("node", F.lit(True).alias("linked"), "shard")
            alone = state.where("grp IS NULL").select("node", F.lit(False).alias("linked"), "shard")
            moves = moves.unionByName(_push(cut(free.unionByName(alone), "shard_rest"), ways, shards, buckets))
        state = cut(state.join(moves, "node", "left").select("node", "grp", F.coalesce("aim", "shard").alias("shard")), "shard_state")
    put = gapless(state.select("node", "shard"), ["shard"], ["node"], "slot", buckets)
    return dealt.drop("_text").join(put, "node").select("id", "size", "text_crc32", "shard", "slot")
