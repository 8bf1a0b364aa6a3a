"""Writers for target tables: append (files, catalog, JDBC), dynamic
partition overwrite, and the re-run guard that appends only new keys."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def append_table(df: DataFrame, path: str, *, fmt: str = "parquet", partition_by: Sequence[str] = (), writers: int | None = None) -> None:
    """Append ``df`` to a file table (duplicates are not checked).

    ``writers`` spreads the rows evenly over so many tasks (and files) first."""
    if writers is not None:
        if writers < 1:
            raise ValueError("writers must be at least 1")
        df = df.repartition(writers)
    writer = df.write.mode("append").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def append_named(df: DataFrame, name: str, *, path: str | None = None, bucket_by: Sequence[str] = (), buckets: int = 0, fmt: str = "parquet") -> None:
    """Append ``df`` to a table of the session's catalog (made if there is none).

    ``path`` keeps the files of a table in a folder of its own instead of the
    warehouse. With ``bucket_by`` the rows lie in ``buckets`` by a hash of those
    columns, so joins and groups on them need no shuffle (see ``resolve``'s
    ``laid_out``). Every append names the same columns and number. Rows are
    spread by bucket first: an append writes one file a bucket, not one a task
    and bucket.
    """
    if bool(bucket_by) != (buckets > 0):
        raise ValueError("give bucket_by and buckets together")
    writer_rows = df.repartition(buckets, *bucket_by) if bucket_by else df
    writer = writer_rows.write.mode("append").format(fmt)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], *, fmt: str = "parquet") -> None:
    """Replace only the partitions present in ``df``; the others stay.

    Uses the per-write ``partitionOverwriteMode=dynamic`` option, so the
    session setting is not changed for other writes.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .format(fmt)
        .partitionBy(*partition_by)
        .save(path)
    )


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    *,
    writers: int = 20,
    untyped_strings: bool = False,
) -> None:
    """Append ``df`` to a database table over JDBC.

    ``writers`` bounds the number of open connections: wider frames are
    spread round robin over that many tasks first. Columns left out of
    ``df`` (e.g. a database-made ``id``) are filled by the database.
    ``untyped_strings`` sends strings untyped so the database casts them
    (PostgreSQL ``stringtype=unspecified``).
    """
    if writers < 1:
        raise ValueError("writers must be at least 1")
    props = dict(properties)
    if untyped_strings:
        props.setdefault("stringtype", "unspecified")
    df.repartition(writers).write.option("numPartitions", writers).jdbc(url=url, table=table, mode="append", properties=props)


def _null_safe(left: DataFrame, right: DataFrame, key: Sequence[str]) -> Column:
    cond = None
    for k in key:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def new_rows(df: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not yet in ``existing``.

    Null-safe key equality: a key holding nulls (e.g. a daypart without
    client) matches an earlier row with the same nulls, so a re-run of the
    same files appends nothing.
    """
    # no distinct on ``existing``: an anti join ignores repeats on its right
    # side, and a distinct would shuffle the whole target table once more
    have = existing.select(*key)
    return df.join(have, _null_safe(df, have, key), "left_anti")
