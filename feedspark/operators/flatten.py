"""Flatten nested feed documents: explode arrays in order, then name the
flat columns."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.specs import FeedSpec, feed_spec


def explode_chain(df: DataFrame, steps, keep_empty: bool = False) -> DataFrame:
    """Apply ``(column, array path)`` explodes in order.

    Inner by default: a null or empty array removes the row (so an
    advertiser without brands yields nothing). ``keep_empty`` keeps such
    rows with a null element.
    """
    gen = F.explode_outer if keep_empty else F.explode
    for name, path in steps:
        df = df.withColumn(name, gen(F.col(path)))
    return df


def flatten(
    docs: DataFrame, feed: str | FeedSpec, *, keep_empty: bool = False, keep: tuple[str, ...] = (), columns=None
) -> DataFrame:
    """Documents of ``feed`` -> one row per innermost payload element
    (all flat columns, or only ``columns``)."""
    spec = feed_spec(feed)
    exploded = explode_chain(docs, spec.explode, keep_empty)
    return exploded.select(*spec.select_list(columns), *[F.col(c) for c in keep])
