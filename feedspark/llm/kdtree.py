"""Exact top-k search by integer inner product: a KD-tree per shard.

Components become whole numbers (``SCALE`` times the component, rounded down),
so scores are exact. Equal vectors are stored once, with the few smallest ids
any answer can need. Distinct vectors lie in cells, cut by the medians of the
widest dimensions, and cells in shards of ``SHARD_ROWS`` to ``SHARD_MOST`` rows; a
task builds a shard's tree: median splits of the widest side, a tight box and
the smallest id at every node.

No vector of a box scores more with a query than the sum over the dimensions of
the larger of query times low and query times high. Every query first searches
one shard of its most promising cell; its kth score then goes along to the cells
whose bound is not below it, and no other. In a shard the nodes of a query are
taken best bound first, and none whose bound (or, at equal score, whose smallest
id) cannot come before its kth result.

Defined results: vectors that are null or hold null or non-finite components
take no part, nor do rows without id; zero vectors do; vectors of another length
are never compared; equal scores go to the smaller id; a row repeated with one id
counts once, and no row of a query's own id is an answer to it; fewer candidates
than ``k`` are all returned; a component beyond 64 bits counts as the nearest
long, and so is a score beyond them reported, after exact ranking; an empty
table gives an empty table; other columns are not looked at.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

SCALE = 1024
LEAF = 64
SHARD_ROWS, SHARD_MOST = 4096, 131_072
QUERY_GROUP = 32_768  # queries that meet a shard in one task
MAX_CELLS = 1024
SAMPLE = 50_000  # distinct vectors (expected) whose medians place the cells; every vector is stored
LENGTHS = 16  # vector lengths with cells of their own; others lie in one cell each
BLOCK = 256  # queries in lockstep
_NONE = np.iinfo(np.int64).max

_TREE = "dim int, cell int, shard int, ids binary, second binary, vectors binary, nodes binary, low binary, high binary, least binary, every array<array<bigint>>"


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id`` and the whole numbers ``v`` of the rows that take part."""
    v = F.col(f"`{vector_col}`")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(f"`{id_col}`").isNotNull() & v.isNotNull()).where(fine)
    whole = F.transform(v, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    return rows.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), whole.alias("v"))


def _exact(v: np.ndarray, q: np.ndarray) -> bool:
    """Whether sums of products stay whole in double precision."""
    if not v.size or not q.size:
        return True
    most = [float(np.abs(x.astype(np.float64)).max()) for x in (v, q)]
    return most[0] * most[1] * v.shape[1] < 2.0**52


def build(ids: np.ndarray, v: np.ndarray) -> dict[str, np.ndarray]:
    """Rows in leaf order and the nodes: (first row, end, left child, or 0 at a
    leaf; the right one follows it), their boxes and smallest ids."""
    order, nodes, low, high, least = np.arange(len(v)), [(0, len(v), 0)], [], [], []
    at = 0
    while at < len(nodes):
        a, b, _ = nodes[at]
        part = v[order[a:b]]
        low.append(part.min(axis=0)), high.append(part.max(axis=0)), least.append(ids[order[a:b]].min())
        if b - a > LEAF:
            side = np.subtract(high[at], low[at], dtype=np.float64) if v.shape[1] else np.zeros(1)
            if side.max() > 0:
                middle = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(part[:, side.argmax()], middle)]
                nodes[at] = (a, b, len(nodes))
                nodes += [(a, a + middle, 0), (a + middle, b, 0)]
        at += 1
    return {"order": order, "nodes": np.array(nodes, dtype=np.int64), "low": np.array(low), "high": np.array(high), "least": np.array(least, dtype=np.int64)}


def _bound(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Most that any vector of each box can score with each query."""
    return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T


def search(tree: dict[str, np.ndarray], asked: np.ndarray, queries: np.ndarray, known: np.ndarray, k: int) -> list[list[tuple[int, int, int]]]:
    """Of every query (its id in ``asked``; ``known``: a score that its kth
    result has elsewhere) the ``k`` best (score, id, row) of the tree that can
    be among its best."""
    v, number = tree["vectors"], np.float64 if _exact(tree["vectors"], queries) else object
    v, low, high = (tree[x].astype(number) for x in ("vectors", "low", "high"))
    nodes, least, ids, second = tree["nodes"], tree["least"], tree["ids"], tree["second"]
    out = []
    for a in range(0, len(queries), BLOCK):
        q, who = queries[a : a + BLOCK].astype(number), asked[a : a + BLOCK]
        best: list[list] = [[] for _ in who]  # heaps, the worst first
        floor = [s if ok else None for s, ok in known[a : a + BLOCK]]
        heaps = [[(-b, int(least[0]), 0)] for b in _bound(q, low[:1], high[:1])[:, 0].tolist()] if len(v) else [[] for _ in who]

        def open_(x: int, bound, node: int) -> bool:
            if floor[x] is not None and bound < floor[x]:
                return False
            if len(best[x]) < k:
                return True
            score, id_, _ = best[x][0]
            return bound > score or (bound == score and least[node] < -id_)

        live = list(range(len(who)))
        while live:
            leaves, inner, still = [], [], []
            for x in live:
                heap = heaps[x]
                while heap:
                    bound, _, node = heapq.heappop(heap)
                    if not open_(x, -bound, node):
                        heap.clear()  # later ones have no better bound, nor a smaller id at the same
                        break
                    (inner if nodes[node, 2] else leaves).append((x, node))
                    still.append(x)
                    break
            if inner:
                x, node = (np.array(c) for c in zip(*inner, strict=True))
                child = nodes[node, 2][:, None] + np.arange(2)
                up, down = np.maximum(q[x], 0)[:, None, :], np.minimum(q[x], 0)[:, None, :]
                bounds = (up * high[child] + down * low[child]).sum(axis=2)
                for y, pair, values in zip(x.tolist(), child.tolist(), bounds.tolist(), strict=True):
                    for node_, value in zip(pair, values, strict=True):
                        if open_(y, value, node_):
                            heapq.heappush(heaps[y], (-value, int(least[node_]), node_))
            by_leaf: dict[int, list[int]] = {}
            for x, node in leaves:
                by_leaf.setdefault(node, []).append(x)
            for node, xs in by_leaf.items():
                s, e, _ = nodes[node]
                scores = q[xs] @ v[s:e].T
                for x, row in zip(xs, scores, strict=True):
                    _take(best[x], row, who[x], ids[s:e], second[s:e], int(s), floor[x], k)
            live = still
        out += [sorted(((s, -i, r) for s, i, r in found), key=lambda f: (-f[0], f[1])) for found in best]
    return out


def _take(best: list, scores: np.ndarray, own: int, ids: np.ndarray, second: np.ndarray, first: int, floor, k: int) -> None:
    """Put the rows of a leaf that belong there among a query's best. A vector
    whose first id is the query's own stands for its second (none: nothing)."""
    line = best[0][0] if len(best) == k else floor
    rows = np.flatnonzero(scores >= line) if line is not None else np.arange(len(scores))
    for r in rows.tolist():
        id_ = int(ids[r]) if ids[r] != own else int(second[r])
        if ids[r] == own and second[r] == _NONE:
            continue
        entry = (int(scores[r]), -id_, first + r)
        if len(best) < k:
            heapq.heappush(best, entry)
        elif entry > best[0]:
            heapq.heapreplace(best, entry)


def _matrix(col: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, dtype=np.int64) for x in col])


def _build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    v, ids = _matrix(pdf["v"]), pdf["rep"].to_numpy(dtype=np.int64)
    tree = build(ids, v)
    by = tree.pop("order")
    tree |= {"ids": ids[by], "second": pdf["second"].to_numpy(dtype=np.int64)[by], "vectors": v[by]}
    place = {c: [int(pdf[c].iloc[0])] for c in ("dim", "cell", "shard")}
    return pd.DataFrame({**place, **{c: [x.tobytes()] for c, x in tree.items()}, "every": [[pdf["ids"].iloc[r] for r in by]]})


def _tree(row: pd.Series) -> dict[str, np.ndarray]:
    ids = np.frombuffer(row["ids"], dtype=np.int64)
    nodes = np.frombuffer(row["nodes"], dtype=np.int64).reshape(-1, 3)
    boxes = {c: np.frombuffer(row[c], dtype=np.int64).reshape(len(nodes), row["dim"]) for c in ("low", "high")}
    vectors = np.frombuffer(row["vectors"], dtype=np.int64).reshape(len(ids), row["dim"])
    return {"ids": ids, "second": np.frombuffer(row["second"], dtype=np.int64), "least": np.frombuffer(row["least"], dtype=np.int64), "nodes": nodes, "vectors": vectors, **boxes}


def _search_shard(k: int):
    def run(queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(queries) and len(index):
            tree, every = _tree(index.iloc[0]), index["every"].iloc[0]
            known = [(None, False) if pd.isna(s) else (int(s), True) for s in queries["floor"]]
            found = search(tree, queries["query_id"].to_numpy(dtype=np.int64), _matrix(queries["v"]), known, k)
            for place, query, hits in zip(queries["place"], queries["query_id"], found, strict=True):
                each = sorted((-s, int(i)) for s, _, r in hits for i in every[r] if i != query)[:k]
                rows += [(place, query, i, str(-s)) for s, i in each]
        return pd.DataFrame(rows, columns=["place", "query_id", "id", "exact"], dtype=object)

    return run


def _planes(bits: int):
    """Dimensions and medians of the cells of vectors of one length, from a
    bounded sample: the widest first."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = _matrix(pdf["v"])
        wide = np.argsort(-v.astype(np.float64).std(axis=0), kind="stable")[:bits]
        return pd.DataFrame({"dim": [v.shape[1]], "axes": [wide.astype(np.int32)], "at": [np.median(v[:, wide], axis=0).astype(np.int64)]})

    return run


def _route(boxes, first: bool):
    """The cell whose box promises a query most (``first``), or all cells whose
    bound is not below its kth score."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = boxes.value
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                cells, low, high = held.get(len(row.v), (None, None, None))
                if cells is None:
                    continue
                q = np.array(row.v, dtype=object)[None, :]
                number = np.float64 if _exact(low, q.astype(np.float64)) and _exact(high, q.astype(np.float64)) else object
                bound = _bound(q.astype(number), low.astype(number), high.astype(number))[0]
                if first:
                    out.append((row.place, int(cells[bound.argmax()])))
                else:
                    floor = None if pd.isna(row.floor) else int(row.floor)
                    out += [(row.place, int(c)) for c, b in zip(cells, bound, strict=True) if floor is None or b >= floor]
            yield pd.DataFrame(out, columns=["place", "cell"])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``id`` and ``score`` of the ``k`` rows of
    ``vectors`` with the largest inner products with every row of ``queries``."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    few = W.partitionBy("v").orderBy("id")
    some = rows.withColumn("_n", F.dense_rank().over(few)).where(F.col("_n") <= k + 1)
    distinct = some.groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    distinct = cut(distinct.select(F.get("ids", F.lit(0)).alias("rep"), F.coalesce(F.get("ids", F.lit(1)), F.lit(_NONE)).alias("second"), F.size("v").alias("dim"), "v", "ids"), "whole")

    # cells by the medians of the widest dimensions
    n = distinct.count()
    size = min(max(SHARD_ROWS, n // 256), SHARD_MOST)
    bits = min(max(n // size, 1).bit_length() - 1, MAX_CELLS.bit_length() - 1)
    lengths = [r["dim"] for r in distinct.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(LENGTHS).collect()]
    cell = F.lit(0)
    if bits and lengths:
        sample = distinct.where(F.col("dim").isin(lengths)).where(F.pmod(F.xxhash64("rep", F.lit(7)), F.lit(n // SAMPLE + 1)) == 0)
        planes = sample.groupBy("dim").applyInPandas(_planes(bits), "dim int, axes array<int>, at array<bigint>").collect()
        for r in planes:
            code = sum((F.when(F.get("v", F.lit(int(x))) > int(m), F.lit(1 << b)).otherwise(F.lit(0)) for b, (x, m) in enumerate(zip(r["axes"], r["at"], strict=True))), F.lit(0))
            cell = F.when(F.col("dim") == r["dim"], code).otherwise(cell)
    placed = cut(distinct.withColumn("cell", cell.cast("int")), "cells")
    sizes = placed.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("int").alias("shards"))
    # at most LENGTHS * MAX_CELLS cells, and one of every rarer length
    sizes = cut(sizes, "sizes")
    small = sizes.count() <= 100_000
    of = F.broadcast(sizes) if small else sizes
    sharded = placed.join(of, ["dim", "cell"]).withColumn("shard", F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int"))
    index = cut(sharded.select("dim", "cell", "shard", "rep", "second", "v", "ids").groupBy("dim", "cell", "shard").applyInPandas(_build_shard, _TREE), "trees")

    # a query is an id and a vector, told from others by its place
    asked = usable(queries, id_col, vector_col).distinct().select(F.col("id").alias("query_id"), "v", F.size("v").alias("dim"))
    asked = cut(asked.withColumn("place", F.monotonically_increasing_id()), "asked")
    parts = asked.count() // QUERY_GROUP + 1
    celled = F.col("dim").isin(lengths) if lengths else F.lit(False)
    held = spark.sparkContext.broadcast(_boxes(index.where(celled)))
    other = asked.where(~celled).select("place", F.lit(0).alias("cell"))

    def met(pairs: DataFrame) -> DataFrame:
        """Hits of queries in shards; ``pairs``: place, dim, cell, shard, floor."""
        keys = ["dim", "cell", "shard", "part"]
        pairs = pairs.withColumn("part", F.pmod("place", F.lit(parts)).cast("int"))
        trees = index.join(pairs.select(*keys).distinct(), keys[:3])
        trees = trees.toDF(*trees.columns)  # columns of its own, apart from those of the pairs
        fan = pairs.join(asked.select("place", "query_id", "v"), "place")
        return fan.groupBy(*keys).cogroup(trees.groupBy(*keys)).applyInPandas(_search_shard(k), "place bigint, query_id bigint, id bigint, exact string")

    start = asked.where(celled).mapInPandas(_route(held, True), "place bigint, cell int").unionByName(other)
    start = start.join(asked.select("place", "dim"), "place").join(of, ["dim", "cell"])
    start = cut(start.select("place", "dim", "cell", F.pmod("place", F.col("shards")).cast("int").alias("shard"), F.lit(None).cast("string").alias("floor")), "start")
    exact = F.col("exact").cast("decimal(38,0)")
    first = cut(met(start), "first_hits")
    floors = first.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.min(exact).alias("least")).where(F.col("n") >= k)
    aware = cut(asked.join(floors.select("place", F.col("least").cast("string").alias("floor")), "place", "left"), "aware")
    on = aware.where(celled).select("place", "v", "floor").mapInPandas(_route(held, False), "place bigint, cell int").unionByName(other)
    on = on.join(aware.select("place", "dim", "floor"), "place").join(of, ["dim", "cell"])
    on = on.select("place", "dim", "cell", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "floor")
    on = cut(on.join(start.select("place", "cell", "shard"), ["place", "cell", "shard"], "left_anti"), "on")
    rank = F.row_number().over(W.partitionBy("place").orderBy(F.desc(exact), "id"))
    best = first.unionByName(met(on)).withColumn("rank", rank).where(F.col("rank") <= k)
    long = F.greatest(F.lit(-(2**63)).cast("decimal(38,0)"), F.least(F.lit(2**63 - 1).cast("decimal(38,0)"), exact)).cast("bigint")
    return best.select("query_id", "rank", "id", long.alias("score"))


def _boxes(index: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Cells of every length with their boxes: at most ``MAX_CELLS`` of each
    of ``LENGTHS`` lengths, drawn together from the shards' roots."""
    root = [F.substring(c, F.lit(1), F.col("dim") * 8).alias(c) for c in ("low", "high")]
    found: dict[int, dict[int, tuple[np.ndarray, np.ndarray]]] = {}
    for r in index.select("dim", "cell", *root).toLocalIterator():
        low, high = (np.frombuffer(r[c], dtype=np.int64) for c in ("low", "high"))
        cells = found.setdefault(r["dim"], {})
        was = cells.get(r["cell"])
        cells[r["cell"]] = (low, high) if was is None else (np.minimum(low, was[0]), np.maximum(high, was[1]))
    return {d: (np.array(list(c)), *(np.array([x[i] for x in c.values()]).reshape(len(c), d) for i in (0, 1))) for d, c in found.items()}
