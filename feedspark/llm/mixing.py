"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its share of the wanted mix over its share of the
corpus; every document draws a Poisson number of copies with that mean by
inverting the distribution at a uniform number hashed from a seed and its id,
and all copies are shuffled globally by another hash. Draws depend on nothing
but (seed, id, rate), so a lost task repeats them exactly.

Defined results: a null source is a source of its own; a null text weighs one
byte like an empty one; a null id draws as the text ``null``; repeated rows draw
alike; ties of the order go by copy number; an empty table gives an empty
table; input columns come out as they are, whatever their names.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

SEED = 17
# wanted weight of a source: its size in bytes to this power, unless given
TEMPERATURE = 0.5
# bytes of the mix per byte of the corpus
EPOCHS = 1.0
# a rate table of so many sources is sent to every task; a larger one is
# joined with salted keys
BROADCAST_SOURCES = 100_000
SALTS = 32


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of a hash."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def cumulative(rate: Column) -> Column:
    """Poisson probabilities of at most 0, 1, 2, ... summed in log space, as far
    as a double can tell them from 1."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    empty = F.struct(F.lit(0.0).alias("lnf"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("out"))

    def step(acc, k):
        lnf = acc["lnf"] + F.when(k > 0, F.log(k.cast("double"))).otherwise(F.lit(0.0))
        total = acc["sum"] + F.exp(k * F.log(rate) - rate - lnf)
        return F.struct(lnf.alias("lnf"), total.alias("sum"), F.array_append(acc["out"], total).alias("out"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(0), last), empty, step, lambda a: a["out"])).otherwise(F.array(F.lit(1.0)))


def rates(docs: DataFrame, source: str = "source", text: str = "text", weights: dict[str, float] | None = None) -> DataFrame:
    """(source, bytes, rate): one row per source. ``weights`` names wanted
    weights (sources not named: 0); without it, bytes to ``TEMPERATURE``."""
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1
    per = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("bytes"))
    if weights is None:
        wanted = F.pow(F.col("bytes").cast("double"), F.lit(TEMPERATURE))
    else:
        wanted = F.coalesce(*(F.when(F.col("source") == k, F.lit(float(v))) for k, v in weights.items()), F.lit(0.0))
    per = per.withColumn("wanted", wanted)
    total = per.agg(F.sum("bytes").alias("all_bytes"), F.sum("wanted").alias("all_wanted"))
    share = F.when(F.col("all_wanted") > 0, F.col("wanted") / F.col("all_wanted")).otherwise(F.lit(0.0))
    # `total` is one row
    return per.join(F.broadcast(total)).select("source", "bytes", (F.lit(EPOCHS) * share * F.col("all_bytes") / F.col("bytes")).alias("rate"))


def replicate(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", weights: dict[str, float] | None = None, seed: int = SEED) -> DataFrame:
    """``row`` (the input row), ``rate``, ``copies``, ``copy`` (from 0) and
    ``order_key`` of every copy, dealt and sorted by ``order_key``."""
    table = cut(rates(docs, source, text, weights).withColumn("_cdf", cumulative(F.col("rate"))), "rates")
    n = table.count()
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    key = F.col(f"row.`{id_col}`")
    same = F.col(f"row.`{source}`").eqNullSafe(F.col("source"))
    if n <= BROADCAST_SOURCES:
        joined = row.join(F.broadcast(table), same)
    else:
        salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = row.withColumn("_deal", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")).join(salted, same & (F.col("_deal") == F.col("_salt")))
    drawn = joined.withColumn("_u", uniform(seed, key)).withColumn("copies", F.size(F.filter("_cdf", lambda c: c <= F.col("_u"))))
    each = drawn.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    order = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(f"{seed}-order"), F.coalesce(key.cast("string"), F.lit("null")), F.col("copy").cast("string")).cast("binary")), 1, 15), 16, 10).cast("long")
    return each.select("row", "rate", "copies", "copy", order.alias("order_key")).repartition("order_key").sortWithinPartitions("order_key", "copy")


def mix(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", weights: dict[str, float] | None = None, seed: int = SEED) -> DataFrame:
    """The mixed corpus: whole input rows, each as often as drawn, in global
    random order."""
    return replicate(docs, id_col, source, text, weights, seed).select("row.*")
