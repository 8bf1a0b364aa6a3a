"""Small shared helpers of the training-data operators."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.session import scratch_path

# ASCII blanks that part words in every contract of this subpackage.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it
    back: lineage ends there, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(id_col: Column) -> Column:
    """The fifth of the rows that no model may learn from."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def gapless(df: DataFrame, by: list[str], order: list[str], out: str, buckets: int) -> DataFrame:
    """Number the rows of every ``by`` group from 0 without gaps, with no task
    holding a whole group: rows are numbered inside hash buckets of ``order``
    and the buckets' offsets (``buckets`` rows a group) are joined on. Rows
    equal in ``by`` and ``order`` are interchangeable to the caller.

    ``df`` must be cheap to read twice (a written table or a scan)."""
    from pyspark.sql import Window as W

    b = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    size = b.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    start = size.select(*by, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(W.partitionBy(*by, "_bucket").orderBy(*order))
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*by, "_bucket"]]
    joined = b.withColumn("_inside", inside).alias("l").join(start.alias("r"), on)
    return joined.select(*(F.col(f"l.{c}") for c in df.columns), (F.col("_start") + F.col("_inside") - 1).cast("long").alias(out))
