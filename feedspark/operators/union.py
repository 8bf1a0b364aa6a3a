"""UNION ALL of feed sources."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_sources(frames: Sequence[DataFrame], *, allow_missing: bool = True) -> DataFrame:
    """All rows of all frames, duplicates kept, matched by column name.

    Files of one feed are better read by one multi-path scan
    (:func:`feedspark.sources.feeds.scan_feed`); this is for sources that
    differ (another landing root, another schema version). A column missing
    from one source is null there.
    """
    if not frames:
        raise ValueError("union_sources needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
