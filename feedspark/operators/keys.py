"""Surrogate ids without a single-partition window.

``row_number() over (order by k)`` would move every row into one task. Here
rows are range-partitioned and sorted on the order columns, the layout is
checkpointed (range bounds come from sampling, so it must not be recomputed
differently after a lost executor), per-partition counts (one row per
partition) give each partition its id offset, and every row gets
``start + offset + position in its partition``. The result equals a global
``row_number`` over the order columns.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path

# rows of one range (and so of one output file)
RANGE_ROWS = 200_000

_PID = "_id_pid"
_POS = "_id_pos"
_OFF = "_id_off"


def assign_ids(
    df: DataFrame,
    order_cols: Sequence[str],
    *,
    start: int | Callable[[int], int] = 1,
    id_col: str = "id",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``id_col`` = ``start`` + rank of the row in ``order_cols`` order;
    ``start`` may be a function of the number of rows (a reservation)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if num_partitions is None:
        # few rows make few ranges; the rows are staged, so counting reads them once
        path = scratch_path(spark, "ids")
        df.write.parquet(path)
        df = spark.read.schema(df.schema).parquet(path)
    n = num_partitions or df.count() // RANGE_ROWS + 1
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    ranged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn(_PID, F.spark_partition_id())
        # low 33 bits of the monotonically increasing id = position in partition
        .withColumn(_POS, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .checkpoint(eager=True)
    )
    counts = sorted((r[0], r[1]) for r in ranged.groupBy(_PID).count().collect())
    offsets, running = [], 0
    for pid, cnt in counts:
        offsets.append((pid, running))
        running += cnt
    if callable(start):
        start = start(running)
    off_df = spark.createDataFrame(offsets or [(0, 0)], f"{_PID} int, {_OFF} long")
    out = ranged.join(F.broadcast(off_df), _PID, "inner")
    out = out.withColumn(id_col, (F.lit(int(start)) + F.col(_OFF) + F.col(_POS)).cast("long"))
    return out.drop(_PID, _POS, _OFF).select(id_col, *[c for c in df.columns if c != id_col])
