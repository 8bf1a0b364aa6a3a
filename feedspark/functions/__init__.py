"""Column functions (all built from ``pyspark.sql.functions``; JVM-side)."""
from .names import feed_matches, name_date, qualified_roots, relative_path, select_names
from .parse import merge_brand_ids

__all__ = [
    "feed_matches",
    "name_date",
    "qualified_roots",
    "relative_path",
    "select_names",
    "merge_brand_ids",
]
