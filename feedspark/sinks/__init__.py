"""Table and JDBC writers."""
from .tables import append_jdbc, append_named, append_table, new_rows, overwrite_partitions

__all__ = ["append_jdbc", "append_named", "append_table", "new_rows", "overwrite_partitions"]
