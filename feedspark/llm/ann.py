"""Approximate nearest neighbours: one navigable small-world graph per shard.

Equal vectors are indexed once, with the few smallest ids that any answer can
need, so a vector that a third of the rows share is one node. Distinct vectors
are hashed into shards of about ``SHARD_ROWS``; a task builds its shard's graph:
nodes enter in the order of their level, each is linked to a diverse choice
among its nearest predecessors and they back to it, per level. Graphs are stored
as flat neighbour arrays, one row a shard. Query vectors, in groups of about
``QUERY_GROUP``, meet every shard; beams of a group run in lockstep, and the
shards' best are merged by a window.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows without id; vectors of another length are
never compared; equal scores go to the smaller id; a row repeated with one id
counts once; fewer candidates than ``k`` are all returned; an empty table gives
an empty table; other columns are not looked at.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut
from .hashing import mix

SHARD_ROWS = 8192
QUERY_GROUP = 4096
M = 16  # links of a node on upper levels; twice as many on the ground
WIDE = 48  # nearest predecessors looked at
BEAM = 96
STRIDE = 4  # nodes of a beam expanded at once
BLOCK = 512

_INDEX = "dim int, shard int, ids binary, vectors binary, levels binary, ground binary, upper binary"


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id`` and ``v`` of the rows that take part."""
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull()).where(fine).select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"))


def _diverse(v: np.ndarray, cand: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (nearest first, -1: none) those nearer to the
    node than to any chosen before; nearest others fill the places left."""
    n, c = cand.shape
    out = np.full((n, most), -1, dtype=np.int32)
    if not c:
        return out
    near = v[np.maximum(cand, 0)]
    between = np.einsum("nid,njd->nij", near, near)
    chosen = np.zeros((n, c), dtype=bool)
    for j in range(c):
        rival = np.where(chosen, between[:, j], -2.0).max(axis=1)
        chosen[:, j] = (cand[:, j] >= 0) & (rival < sims[:, j]) & (chosen.sum(axis=1) < most)
    rank = np.where(cand < 0, 2 * c, np.where(chosen, 0, c) + np.arange(c))
    take = np.argsort(rank, axis=1, kind="stable")[:, :most]
    picked = np.take_along_axis(cand, take, axis=1)
    out[:, : picked.shape[1]] = picked
    return out


def _level(v: np.ndarray, most: int) -> np.ndarray:
    """Neighbour array of one level; rows of ``v`` in order of entry."""
    n = len(v)
    out = np.full((n, most), -1, dtype=np.int32)
    for a in range(0, n, BLOCK):
        b = min(a + BLOCK, n)
        sims = v[a:b] @ v[:b].T
        sims[np.arange(b)[None, :] >= np.arange(a, b)[:, None]] = -3.0
        wide = min(WIDE, b)
        part = np.argpartition(-sims, wide - 1, axis=1)[:, :wide]
        near = np.take_along_axis(sims, part, axis=1)
        by = np.argsort(-near, axis=1, kind="stable")
        part, near = np.take_along_axis(part, by, axis=1), np.take_along_axis(near, by, axis=1)
        part[near < -2] = -1
        out[a:b, : most // 2] = _diverse(v, part.astype(np.int32), near, most // 2)
    # links back, then each node's choice among all that touch it
    src, dst = np.repeat(np.arange(n), most), out.ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    edge = np.unique(np.concatenate([src * n + dst, dst * n + src]))
    src, dst = edge // n, edge % n
    sim = np.einsum("ed,ed->e", v[src], v[dst]) if len(edge) else np.empty(0)
    by = np.lexsort((dst, -sim, src))
    src, dst, sim = src[by], dst[by], sim[by]
    place = np.arange(len(src)) - np.searchsorted(src, src)
    width = 3 * most
    cand, sims = np.full((n, width), -1, dtype=np.int32), np.full((n, width), -3.0, dtype=np.float32)
    fits = place < width
    cand[src[fits], place[fits]], sims[src[fits], place[fits]] = dst[fits], sim[fits]
    for a in range(0, n, BLOCK):
        out[a : a + BLOCK] = _diverse(v, cand[a : a + BLOCK], sims[a : a + BLOCK], most)
    return out


def build(ids: np.ndarray, vectors: np.ndarray) -> dict[str, np.ndarray]:
    """The graph of one shard: nodes in order of entry (highest level first),
    their vectors and levels, ground links and upper links level by level."""
    u = (mix(ids.astype(np.uint64) + np.uint64(0x9E37)) >> np.uint64(11)).astype(float) / (1 << 53)
    levels = np.floor(-np.log(np.maximum(u, 1e-18)) / np.log(M)).astype(np.int32)
    by = np.lexsort((ids, u, -levels))
    ids, vectors, levels = ids[by], vectors[by], levels[by]
    unit = _unit(vectors)
    upper = [_level(unit[: int((levels >= x).sum())], M).ravel() for x in range(1, int(levels.max(initial=0)) + 1)]
    return {
        "ids": ids, "vectors": vectors, "levels": levels, "ground": _level(unit, 2 * M).ravel(),
        "upper": np.concatenate(upper) if upper else np.empty(0, dtype=np.int32),
    }


def _unit(v: np.ndarray) -> np.ndarray:
    w = v.astype(np.float64)
    return (w / np.linalg.norm(w, axis=1, keepdims=True)).astype(np.float32)


def search(graph: dict[str, np.ndarray], queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes (-1: none) and exact scores of the ``k`` best found, best first."""
    unit, levels = _unit(graph["vectors"]), graph["levels"]
    n, ground = len(unit), graph["ground"].reshape(len(unit), 2 * M)
    q, found = _unit(queries), []
    upper, at = [], 0
    for x in range(1, int(levels.max(initial=0)) + 1):
        size = int((levels >= x).sum())
        upper.append(graph["upper"][at : at + size * M].reshape(size, M))
        at += size * M
    for a in range(0, len(q), BLOCK):
        found.append(_beam(unit, ground, upper, q[a : a + BLOCK], min(BEAM, n)))
    nodes = np.concatenate(found) if found else np.empty((0, 1), dtype=np.int64)
    wide, other = graph["vectors"].astype(np.float64), queries.astype(np.float64)
    dots = np.einsum("qkd,qd->qk", wide[np.maximum(nodes, 0)], other)
    score = dots / (np.linalg.norm(wide, axis=1)[np.maximum(nodes, 0)] * np.linalg.norm(other, axis=1)[:, None])
    score[nodes < 0] = -np.inf
    by = np.lexsort((graph["ids"][np.maximum(nodes, 0)], -score), axis=1)[:, :k]
    return np.take_along_axis(nodes, by, axis=1), np.take_along_axis(score, by, axis=1)


def _beam(unit: np.ndarray, ground: np.ndarray, upper: list[np.ndarray], q: np.ndarray, width: int) -> np.ndarray:
    m, n = len(q), len(unit)
    line = np.arange(m)
    now, sim = np.zeros(m, dtype=np.int64), q @ unit[0]
    for links in reversed(upper):
        moving = line
        while len(moving):
            to = links[now[moving]]
            s = np.where(to >= 0, np.einsum("qd,qkd->qk", q[moving], unit[np.maximum(to, 0)]), -2.0)
            best = s.argmax(axis=1)
            top = s[np.arange(len(moving)), best]
            better = top > sim[moving]
            moving, best, top, to = moving[better], best[better], top[better], to[better]
            now[moving], sim[moving] = to[np.arange(len(moving)), best], top
    seen = np.zeros((m, n + 1), dtype=bool)  # the last column takes links that are none
    seen[:, n] = True
    nodes, sims, done = np.full((m, width), -1, dtype=np.int64), np.full((m, width), -2.0, dtype=np.float32), np.ones((m, width), dtype=bool)
    nodes[:, 0], sims[:, 0], done[:, 0] = now, sim, False
    seen[line, now] = True
    live = line
    while len(live):
        open_ = ~done[live]
        first = np.argsort(~open_, axis=1, kind="stable")[:, :STRIDE]  # beams are sorted, so these are the best open ones
        ok = np.take_along_axis(open_, first, axis=1)
        rows = np.arange(len(live))[:, None]
        done[live[:, None], first] = True
        at = np.where(ok, nodes[live[:, None], first], -1)
        to = np.where(at[:, :, None] >= 0, ground[np.maximum(at, 0)], -1).reshape(len(live), -1)
        to = np.sort(np.where(to < 0, n, to), axis=1)
        fresh = ~seen[live[:, None], to]
        fresh[:, 1:] &= to[:, 1:] != to[:, :-1]
        seen[live[:, None], to] = True
        s = np.where(fresh, np.einsum("qd,qkd->qk", q[live], unit[np.minimum(to, n - 1)]), -2.0).astype(np.float32)
        all_nodes = np.concatenate([nodes[live], np.where(fresh, to, -1)], axis=1)
        all_sims = np.concatenate([sims[live], s], axis=1)
        all_done = np.concatenate([done[live], ~fresh], axis=1)
        by = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
        nodes[live], sims[live], done[live] = all_nodes[rows, by], all_sims[rows, by], all_done[rows, by]
        live = live[~done[live].all(axis=1)]
    return nodes


def _matrix(col: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x) for x in col])


def _build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    v = _matrix(pdf["v"])
    g = build(pdf["rep"].to_numpy(dtype=np.int64), v.astype(np.float64))
    return pd.DataFrame({"dim": [v.shape[1]], "shard": [int(pdf["shard"].iloc[0])], **{k: [a.tobytes()] for k, a in g.items()}})


def _graph(row: pd.Series) -> dict[str, np.ndarray]:
    ids = np.frombuffer(row["ids"], dtype=np.int64)
    return {
        "ids": ids, "vectors": np.frombuffer(row["vectors"], dtype=np.float64).reshape(len(ids), -1),
        **{k: np.frombuffer(row[k], dtype=np.int32) for k in ("levels", "ground", "upper")},
    }


def _search_shard(k: int):
    def run(queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(index):
            return pd.DataFrame({"query": [], "hit": [], "score": []})
        g = _graph(index.iloc[0])
        nodes, score = search(g, _matrix(queries["v"]), k)
        line, place = np.nonzero(nodes >= 0)
        return pd.DataFrame({"query": queries["rep"].to_numpy()[line], "hit": g["ids"][nodes[line, place]], "score": score[line, place]})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``id`` and ``score`` (cosine in double precision)
    of the ``k`` nearest rows of ``vectors`` found for every row of ``queries``,
    never a row of the query's own id."""
    rows = usable(vectors, id_col, vector_col)
    few = W.partitionBy("v").orderBy("id")
    some = rows.withColumn("_n", F.dense_rank().over(few)).where(F.col("_n") <= k + 1)
    distinct = some.groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    distinct = cut(distinct.select(F.get("ids", F.lit(0)).alias("rep"), F.size("v").alias("dim"), "v", "ids"), "vectors")
    shards = distinct.count() // SHARD_ROWS + 1
    placed = distinct.withColumn("shard", F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int"))
    index = cut(placed.select("dim", "shard", "rep", "v").groupBy("dim", "shard").applyInPandas(_build_shard, _INDEX), "graphs")

    asked = usable(queries, id_col, vector_col)
    # a query vector that is not indexed is one of its own
    named = asked.join(distinct.select("v", "rep"), "v", "left").withColumn("rep", F.coalesce("rep", -F.col("id") - 1))
    named = cut(named.select(F.col("id").alias("query_id"), "rep", "v"), "queries")
    each = named.groupBy("rep").agg(F.first("v").alias("v"))
    groups = each.count() // QUERY_GROUP + 1
    fan = each.select(
        "rep", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("rep"), F.lit(groups)).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    )
    spread = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    hits = fan.groupBy("dim", "shard", "part").cogroup(spread.groupBy("dim", "shard", "part"))
    hits = hits.applyInPandas(_search_shard(k + 1), "query bigint, hit bigint, score double")
    best = W.partitionBy("query").orderBy(F.desc("score"), "hit")
    hits = hits.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1)
    full = hits.join(distinct.select(F.col("rep").alias("hit"), "ids"), "hit").select("query", "score", F.explode("ids").alias("id"))
    out = named.select("query_id", F.col("rep").alias("query")).distinct().join(full, "query").where("id <> query_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
