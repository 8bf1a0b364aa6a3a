"""Sources: landing-area feed scans, JSON-text parsing, lookup tables."""
from .drift import feed_drift, schema_drift
from .feeds import SeveralDocumentsError, UndatedFilesError, check_undated, detect_multi_line, file_forms, landing_files, parse_feed, scan_feed, select_feed, split_corrupt, undated_files
from .lookups import as_lookup, client_lookup, network_lookup, read_jdbc, tenant_lookup

__all__ = [
    "feed_drift",
    "landing_files",
    "parse_feed",
    "scan_feed",
    "schema_drift",
    "select_feed",
    "split_corrupt",
    "undated_files",
    "as_lookup",
    "client_lookup",
    "network_lookup",
    "read_jdbc",
    "tenant_lookup",
]
