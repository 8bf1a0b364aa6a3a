"""First-seen dedupe: keep the earliest extract of every business key."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANK_COL = "_rn"


def first_seen(
    df: DataFrame,
    key: Sequence[str],
    order: str = "extract_datetime",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """One row per ``key``: the smallest ``order`` value, nulls first.

    Ties on ``order`` are broken by ``tiebreak`` (ascending, nulls first), so
    repeated runs give the same rows. Null key values form one group.

    ``row_number() ... = 1`` is planned by Spark as a partial
    ``WindowGroupLimit`` before the shuffle, so a hot key sends at most one
    row per map task over the network.
    """
    ordering = [F.col(order).asc_nulls_first()] + [F.col(c).asc_nulls_first() for c in tiebreak]
    w = Window.partitionBy(*key).orderBy(*ordering)
    return df.withColumn(RANK_COL, F.row_number().over(w)).where(F.col(RANK_COL) == 1).drop(RANK_COL)
