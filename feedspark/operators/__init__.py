"""DataFrame operators: flatten, lookup, first-seen dedupe, ids, union."""
from .dedupe import first_seen
from .flatten import explode_chain, flatten
from .keys import assign_ids
from .lookup import MissingParentError, fits_broadcast, missing_parents, require_parents, resolve
from .union import union_sources

__all__ = [
    "first_seen",
    "explode_chain",
    "flatten",
    "assign_ids",
    "MissingParentError",
    "fits_broadcast",
    "missing_parents",
    "require_parents",
    "resolve",
    "union_sources",
]
