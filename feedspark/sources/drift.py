"""Schema drift: what documents hold that the feed's schema does not know.

Documents are parsed as VARIANT and walked level by level, as deep as the known
schema goes: an unknown path is reported where it begins and not followed
further, so the depth of the plan is that of the schema, whatever arrives.
"""
from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from ..functions.names import qualified_roots, relative_path
from ..plans.specs import FeedSpec, feed_spec
from .feeds import FILE_COL, _as_list, _entries


def known_paths(dtype: DataType, path: str = "$") -> dict[str, str]:
    """Every path of a schema (``[]`` is any element) and its kind."""
    if isinstance(dtype, StructType):
        out = {path: "OBJECT"}
        for f in dtype.fields:
            out |= known_paths(f.dataType, f"{path}.{f.name}")
        return out
    if isinstance(dtype, ArrayType):
        return {path: "ARRAY"} | known_paths(dtype.elementType, f"{path}[]")
    return {path: "SCALAR"}


def schema_drift(docs: DataFrame, column: str, feed: str | FeedSpec, by: Sequence[str] = ()) -> DataFrame:
    """Paths of JSON documents (text) that do not fit the feed's schema.

    One row per ``by`` columns, ``path``, ``expected`` kind (null: unknown path)
    and ``found`` kind (OBJECT, ARRAY, SCALAR), with the number of places
    ``n``. Names differ by case. Nulls fit everywhere. Text that is not JSON
    (or beyond the size of a VARIANT) has no paths: the quarantine counts it."""
    known = known_paths(feed_spec(feed).schema)
    kinds = F.create_map(*(F.lit(x) for x in chain.from_iterable(known.items())))
    depth = max(p.count(".") + p.count("[]") for p in known)

    def judged(rows: DataFrame) -> DataFrame:
        """Rows that go on: known containers, and places that do not fit."""
        name = F.schema_of_variant("_value")
        kind = F.when(name.startswith("OBJECT"), "OBJECT").when(name.startswith("ARRAY"), "ARRAY").when(name != "VOID", "SCALAR")
        past = F.col("_done")
        fresh = rows.withColumns({
            "_found": F.when(past, F.col("_found")).otherwise(kind),
            "_expected": F.when(past, F.col("_expected")).otherwise(F.try_element_at(kinds, F.col("_path"))),
        })
        fits = F.col("_expected").eqNullSafe(F.col("_found"))
        fresh = fresh.where(F.col("_found").isNotNull() & ~(fits & (F.col("_found") == "SCALAR")))
        return fresh.withColumn("_done", ~fits)

    spark = docs.sparkSession
    none = F.lit(None).cast("string")
    rows = docs.select(*by, F.lit("$").alias("_path"), F.try_parse_json(column).alias("_value"), none.alias("_found"), none.alias("_expected"), F.lit(False).alias("_done"))
    rows = judged(rows)
    for _ in range(depth):
        inside = F.when(~F.col("_done"), F.col("_value"))
        rows = rows.lateralJoin(spark.tvf.variant_explode_outer(inside.outer()).alias("tvf"))
        below = F.col("key").isNotNull() | F.col("pos").isNotNull()
        step = F.when(F.col("key").isNotNull(), F.concat(F.lit("."), "key")).otherwise(F.lit("[]"))
        path = F.when(F.col("_done"), F.col("_path")).otherwise(F.concat("_path", step))
        rows = rows.where(F.col("_done") | below).select(*by, path.alias("_path"), F.col("tvf.value").alias("_value"), "_found", "_expected", "_done")
        rows = judged(rows)
    out = rows.where("_done").groupBy(*by, F.col("_path").alias("path"), F.col("_expected").alias("expected"), F.col("_found").alias("found"))
    return out.agg(F.count(F.lit(1)).alias("n"))


def feed_drift(spark: SparkSession, landing: str | Sequence[str], feed: str | FeedSpec, *, since: int = 0, multi_line: bool = False) -> DataFrame:
    """:func:`schema_drift` of the feed's landing files after ``since`` (or
    without a date), per file; ``multi_line`` as for a scan. A landing area
    without such files gives no rows."""
    spec = feed_spec(feed)
    text = _entries(spark, landing, spec.word, since, whole=multi_line)
    if text is None:
        text = spark.createDataFrame([], "value string, path string")
    name = relative_path(F.col("path"), qualified_roots(spark, _as_list(landing)))
    return schema_drift(text.select(name.alias(FILE_COL), "value"), "value", spec, [FILE_COL])
