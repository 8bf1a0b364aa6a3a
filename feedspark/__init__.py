"""feedspark: Spark-native ingest and conformance of nested JSON feeds.

Select feed files by name and date, scan them in parallel with fixed
(versioned) schemas, flatten nested arrays, resolve external ids against
lookup tables with a policy for missing parents, keep the first-seen record
of every business key, assign surrogate ids and append to file, catalog or
JDBC tables. Importing the package starts nothing.
"""
from .operators import (
    MissingParentError,
    assign_ids,
    first_seen,
    flatten,
    missing_parents,
    require_parents,
    resolve,
    union_sources,
)
from .plans.catalog import JdbcCatalog, ParquetCatalog
from .plans.job import run_feed
from .plans.specs import FEEDS, FeedSpec, feed_spec
from .sinks import append_jdbc, append_table, new_rows, overwrite_partitions
from .sources import parse_feed, scan_feed, select_feed, split_corrupt

__version__ = "0.1.0"

__all__ = [
    "FEEDS",
    "FeedSpec",
    "JdbcCatalog",
    "MissingParentError",
    "ParquetCatalog",
    "append_jdbc",
    "append_table",
    "assign_ids",
    "feed_spec",
    "first_seen",
    "flatten",
    "missing_parents",
    "new_rows",
    "overwrite_partitions",
    "parse_feed",
    "require_parents",
    "resolve",
    "run_feed",
    "scan_feed",
    "select_feed",
    "split_corrupt",
    "union_sources",
]
