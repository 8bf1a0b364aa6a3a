"""MinHash near-duplicates with sequential Bayesian verification.

1. One pass over the texts makes each one's distinct shingles, their count, a
   128-bit key of the set and a MinHash signature (``N_HASHES`` values of 16 bits).
   Equal sets collapse to one representative, the smallest id, by a partial
   aggregate.
2. Signatures are banded. Within a bucket nobody is paired with everybody: each
   member is compared with the bucket's two hubs (least id, least hash). The
   comparison runs over batches of signature values and ends as soon as the
   posterior probability of a similarity at the threshold falls below ``MISS``.
3. Survivors are verified exactly on full shingle sets, each member's likeliest
   hub first, and joined into components.
4. Whatever a bucket then holds in different components is compared in blocks
   inside tasks: the members outside the bucket's largest component against all,
   by the same Bayesian test and then on full sets, so a link between members that
   no hub has is found too, and a task puts out no more links than join components.

A pair at the threshold shares no band with probability below 1e-6.

Defined results: null, empty and blank texts have no shingles and link with
nothing; rows without id take no part (component null, kept); equal texts and
repeated rows fall into one component; an empty table gives an empty table;
texts of any length are read whole; other columns are not looked at.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedspark.operators.keys import assign_ids

from .common import cut
from .components import components
from .hashing import mix, shingles

SHINGLE = 4
PERCENT = 80
BAND = 4
N_BANDS = 28
N_HASHES = BAND * N_BANDS
BATCH = 16  # signature values compared at a time
MISS = 1e-6  # posterior probability at which a pair is given up
BLOCK = 256  # members of a bucket compared at once
COLUMNS = 4096  # shingles counted at once when blocks are verified
# ids up to this number (8 bytes each) are sent to every task instead of
# shuffling texts to them
BROADCAST_IDS = 1_000_000

_A = mix(np.arange(1, N_HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_B = mix(np.arange(1, N_HASHES + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def signature(s: np.ndarray) -> np.ndarray:
    """The MinHash values of a set of hashes, 16 bits each."""
    low = np.full(N_HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(s), 4096):
        np.minimum(low, (s[None, at : at + 4096] * _A[:, None] + _B[:, None]).min(axis=1), out=low)
    return (mix(low) >> np.uint64(48)).astype("<u2")


def _sign(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                s = shingles(text.encode() if isinstance(text, str) else None, size)
                if len(s):
                    k1, k2 = (int(x.sum(dtype=np.uint64).astype(np.int64)) for x in (s, mix(s ^ np.uint64(0x5BD1E995))))
                    rows.append((len(s), k1, k2, signature(s).tobytes()))
                else:
                    rows.append((0, 0, 0, None))
            out = pd.DataFrame(rows, columns=["n_shingles", "k1", "k2", "sig"])
            out.insert(0, "id", pdf["id"].to_numpy())
            yield out

    return run


def least_matches(n: int, percent: int = PERCENT, miss: float = MISS) -> int:
    """The fewest of ``n`` equal values at which a similarity of the threshold
    is still likelier than ``miss``, under a uniform prior: the posterior is a
    beta distribution, its upper tail a binomial sum."""
    t, tail, term = percent / 100, 0.0, (1 - percent / 100) ** (n + 1)
    for m in range(n + 1):
        tail += term
        if tail >= miss:
            return m
        term *= (n + 1 - m) / (m + 1) * t / (1 - t)
    return n


_STEPS = tuple(range(BATCH, N_HASHES + 1, BATCH))
_LEAST = tuple(least_matches(n) for n in _STEPS)


def alike(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two signature tables that survive the batches, and their number
    of equal values."""
    alive, equal = np.arange(len(a)), np.zeros(len(a), dtype=np.int32)
    for to, least in zip(_STEPS, _LEAST, strict=True):
        equal = equal + (a[alive, to - BATCH : to] == b[alive, to - BATCH : to]).sum(axis=1, dtype=np.int32)
        on = equal >= least
        alive, equal = alive[on], equal[on]
    return alive, equal


def _table(col: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(col), dtype="<u2").reshape(len(col), N_HASHES)


def _prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            alive, equal = alike(_table(pdf["sig_a"]), _table(pdf["sig_b"]))
            yield pdf[["a", "b"]].iloc[alive].assign(equal=equal)


def _shared_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``x`` with every one of ``y``."""
    size = [len(s) for s in x + y]
    values, which, count = np.unique(np.concatenate(x + y), return_inverse=True, return_counts=True)
    often = count > 1
    column = (np.cumsum(often) - 1)[which]
    row, column = np.repeat(np.arange(len(size)), size)[often[which]], column[often[which]]
    by = np.argsort(column, kind="stable")
    row, column = row[by], column[by]
    out = np.zeros((len(x), len(y)), dtype=np.float32)
    for at in range(0, int(often.sum()), COLUMNS):
        a, b = np.searchsorted(column, (at, at + COLUMNS))
        hold = np.zeros((len(size), COLUMNS), dtype=np.float32)
        hold[row[a:b], column[a:b] - at] = 1
        out += hold[: len(x)] @ hold[len(x) :].T
    return out.astype(np.int64)


def _block_links(size: int):
    """Links between one block of a bucket's minor members and one of all its
    members across components: the batches first, then the full sets; of the
    links found as many as it takes to join what they join."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf[pdf["minor"]], pdf[~pdf["minor"]]
        ids, others, mine, theirs = (v.to_numpy() for v in (x["rep"], y["rep"], x["component"], y["component"]))
        maybe = np.zeros((len(ids), len(others)), dtype=bool)
        if len(ids) and len(others):
            sx, sy = _table(x["sig"]), _table(y["sig"])
            for k in range(len(ids)):
                to = np.flatnonzero(theirs != mine[k])
                alive, _ = alike(np.broadcast_to(sx[k], (len(to), N_HASHES)), sy[to])
                maybe[k, to[alive]] = True
        rows, cols = np.flatnonzero(maybe.any(axis=1)), np.flatnonzero(maybe.any(axis=0))
        found = []
        if len(rows):
            a, b = ([shingles(t.encode(), size) for t in v] for v in (x["text"].iloc[rows], y["text"].iloc[cols]))
            both = _shared_counts(a, b)
            union = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b])[None, :] - both
            head: dict[int, int] = {}

            def top(c: int) -> int:
                while c in head:
                    c = head[c]
                return c

            for i, j in np.argwhere((100 * both >= PERCENT * union) & maybe[np.ix_(rows, cols)]):
                p, q = top(int(mine[rows[i]])), top(int(theirs[cols[j]]))
                if p != q:
                    head[max(p, q)] = min(p, q)
                    found.append((int(ids[rows[i]]), int(others[cols[j]])))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def _exact(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            on = []
            for x, y in zip(pdf["text_a"], pdf["text_b"], strict=True):
                s, t = shingles(x.encode(), size), shingles(y.encode(), size)
                both = len(np.intersect1d(s, t, assume_unique=True))
                on.append(100 * both >= PERCENT * (len(s) + len(t) - both))
            yield pdf.loc[on, ["a", "b"]]

    return run


def _only(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``docs`` with (left_semi) or without (left_anti) the given ids, by a
    broadcast of a checked size or else by shuffle."""
    small = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if small else ids, "id", how)


def _verified(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    a = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(a, "a").join(b, "b").mapInPandas(_exact(size), "a bigint, b bigint")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """``id``, ``n_shingles``, ``component`` and ``kept`` of every row; links
    join texts whose shingle sets share ``PERCENT`` per cent of their union."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    signed = cut(rows.mapInPandas(_sign(size), "id bigint, n_shingles int, k1 bigint, k2 bigint, sig binary"), "signed")
    real = signed.where("n_shingles > 0 AND id IS NOT NULL")
    reps = cut(real.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.first("sig").alias("sig")), "reps")

    width = 2 * BAND
    keys = F.transform(F.sequence(F.lit(0), F.lit(N_BANDS - 1)), lambda b: F.xxhash64(b, F.substring("sig", b * width + 1, F.lit(width))))
    bands = reps.select("rep", F.explode(keys).alias("key"))
    hubs = bands.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("rep").alias("hub"), F.min(F.struct(F.xxhash64("rep").alias("h"), "rep")).alias("other")
    ).where("n > 1")
    members = cut(bands.join(hubs, "key").select("key", "n", "rep", "hub", F.col("other.rep").alias("hub2")), "members")
    star = members.select("rep", F.explode(F.array("hub", "hub2")).alias("hub")).where("rep <> hub")
    star = star.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()
    sig_a, sig_b = (reps.select(F.col("rep").alias(c), F.col("sig").alias(f"sig_{c}")) for c in "ab")
    likely = cut(star.join(sig_a, "a").join(sig_b, "b").mapInPandas(_prune, "a bigint, b bigint, equal int"), "likely")

    # each member's likeliest hub first (a member may be either end of a pair)
    ends = likely.select(F.explode(F.array("a", "b")).alias("node"), "a", "b", "equal")
    first = ends.groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("equal", -F.col("a"), -F.col("b"))).alias("p"))
    # every text that any later step can ask for: those of buckets with company
    texts = cut(_only(rows.where("id IS NOT NULL AND text IS NOT NULL"), cut(likely.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "likely_ids"), "left_semi").dropDuplicates(["id"]), "texts")
    sure = cut(_verified(first.select("p.*").distinct(), texts, size), "sure")
    part = cut(components(sure, "first"), "parts")

    # hub pairs that still lie across components
    a_part, b_part = (part.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")) for c in "ab")
    across = likely.join(a_part, "a", "left").join(b_part, "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    across = across.join(first.select("p.*").distinct(), ["a", "b"], "left_anti")
    links = cut(sure.unionByName(_verified(across, texts, size)), "links")
    part = cut(components(links, "second"), "second_parts")

    # members without a hub across components: a bucket's minor members (not of
    # its largest component) against all, in blocks
    many = members.where("n > 2").join(part.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    many = cut(many.select("key", "n", "rep", "hub", "hub2", "component"), "many")
    held = many.groupBy("key", "component").agg(
        F.count(F.lit(1)).alias("c"), F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.expr("bit_xor(xxhash64(rep))").alias("x")
    )
    mixed = held.groupBy("key").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("parts"), F.max(F.struct("c", "component")).alias("top"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.expr("bit_xor(x)").alias("x"),
    ).where("parts > 1")
    # buckets with the same members do the same work
    once = mixed.groupBy("n", "lo", "hi", "x").agg(F.min("key").alias("key"), F.min_by("top", "key").alias("top"))
    inner = many.drop("n").where("rep <> hub AND rep <> hub2").join(once.select("key", "n", "top"), "key").withColumn("minor", F.col("component") != F.col("top.component"))
    x_blocks = F.ceil((F.col("n") - F.col("top.c")) / BLOCK).cast("int")
    y_blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    x_own, y_own = F.pmod(F.xxhash64("rep"), x_blocks).cast("int"), F.pmod(F.xxhash64("rep"), y_blocks).cast("int")
    xs = inner.where("minor").select("key", "rep", "component", "minor", x_own.alias("i"), F.explode(F.sequence(F.lit(0), y_blocks - 1)).alias("j"))
    ys = inner.select("key", "rep", "component", F.lit(False).alias("minor"), F.explode(F.sequence(F.lit(0), x_blocks - 1)).alias("i"), y_own.alias("j"))
    dealt = cut(xs.unionByName(ys), "dealt")
    more = cut(_only(rows.where("id IS NOT NULL AND text IS NOT NULL"), cut(dealt.select(F.col("rep").alias("id")).distinct(), "dealt_ids"), "left_semi").dropDuplicates(["id"]), "dealt_texts")
    facts = reps.select("rep", "sig").join(more.select(F.col("id").alias("rep"), "text"), "rep")
    blocked = dealt.join(facts, "rep").groupBy("key", "i", "j").applyInPandas(_block_links(size), "a bigint, b bigint")
    final = cut(components(links.unionByName(blocked), "all"), "components")

    named = signed.drop("sig").join(reps.select("k1", "k2", "rep"), ["k1", "k2"], "left").join(final.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "rep", "id")).otherwise(F.col("id"))
    return named.select("id", F.col("n_shingles").cast("long").alias("n_shingles"), component.alias("component")).withColumn(
        "kept", F.col("id").isNull() | (F.col("id") == F.col("component"))
    )


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """The rows that head their component, with the columns they came with: the
    smallest id's, of equal ids one row. Where ids repeat or are null, rows are
    numbered (by id, then text, nulls last) and the numbers take the ids' part."""
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    odd = docs.groupBy(id_.alias("_id")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 OR _id IS NULL")
    if odd.isEmpty():
        gone = _gone(docs, id_col, text_col, size)
        return docs.join(gone, id_ == F.col("_gone"), "left_anti")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), id_.isNull().alias("_null"), id_.alias("_id"),
        F.md5(text.cast("binary")).alias("_md5"), F.monotonically_increasing_id().alias("_copy"),
    )
    rows = assign_ids(rows, ["_null", "_id", "_md5", "_copy"], id_col="_key").select("_key", "_row")
    gone = _gone(rows.select("_key", F.col(f"_row.`{text_col}`").alias("_text")), "_key", "_text", size)
    return rows.join(gone, F.col("_key") == F.col("_gone"), "left_anti").select("_row.*")


def _gone(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Ids that do not head their component, to be broadcast if they are few."""
    gone = cut(classes(docs, id_col, text_col, size).where("NOT kept").select(F.col("id").alias("_gone")).distinct(), "gone")
    return F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
