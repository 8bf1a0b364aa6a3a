"""The estimate schema-version merge."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def merge_brand_ids(element: str = "estimates") -> Column:
    """One brand list for both estimate versions.

    2018+ elements carry ``brandIds``; 2017 elements a scalar ``brandId``,
    turned into a one-element list (null stays null).
    """
    e = F.col(element)
    return F.coalesce(
        e.getField("brandIds"),
        F.when(e.getField("brandId").isNotNull(), F.array(e.getField("brandId"))),
    )
