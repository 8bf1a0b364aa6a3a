"""Where lookup and target tables live.

``ParquetCatalog`` keeps tables as versioned parquet folders behind a commit
log (testable without a database); ``JdbcCatalog`` reads and appends over JDBC
and lets the database make ids. Both expose ``read(table)``, ``append(table,
df)`` and ``transaction()``.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import assign_ids
from ..schemas import GENERATED_IDS, TARGET_COLUMNS, target_schema
from ..sinks.tables import append_jdbc
from ..sources.lookups import read_jdbc
from .commits import CommitLog, ConcurrentRunError, numbered


def conform(df: DataFrame, table: str, *, with_id: bool = True) -> DataFrame:
    """Columns of ``table`` in target order and type."""
    fields = [f for f in target_schema(table).fields if with_id or f.name != "id"]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


class ParquetCatalog:
    """Tables as lists of parquet folders, named together by one commit.

    Whatever happens between the start and the end of a :meth:`transaction`
    is seen by its own reads only, and appears at once or not at all. A
    table that lies as a plain folder below the root (written by others) is
    read as it is.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/_commits")
        self._working: dict | None = None

    # --- versions -------------------------------------------------------------

    def _latest(self) -> tuple[int, dict]:
        names = self.log.names()
        return (int(names[-1]), self.log.read(names[-1])) if names else (0, {})

    def state(self) -> dict:
        """What the catalog holds now: ``tables`` and ``ledgers`` (folders),
        ``tops`` (largest given ids), ``seen`` (lookup folders that a target
        was derived with) and ``files`` (folders of loaded files)."""
        return self._working if self._working is not None else self._latest()[1]

    @contextmanager
    def transaction(self):
        """Publish all that the block writes in one commit, or nothing if it
        raises. A block inside another is part of it."""
        if self._working is not None:
            yield
            return
        number, held = self._latest()
        self._working = json.loads(json.dumps(held))
        try:
            yield
            if self._working != held and not self.log.create(numbered(number + 1), self._working):
                raise ConcurrentRunError(f"{self.root}: another run has committed; repeat this one")
        finally:
            self._working = None

    def part(self, kind: str) -> dict:
        """One part of the state of the open transaction."""
        if self._working is None:
            raise RuntimeError("open a transaction first")
        return self._working.setdefault(kind, {})

    def store(self, name: str, df: DataFrame) -> str:
        """Write rows into a folder that no commit names yet."""
        folder = f"_data/{name}/{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(f"{self.root}/{folder}")
        return folder

    def open(self, folders: list[str]) -> DataFrame:
        return self.spark.read.parquet(*(f"{self.root}/{f}" for f in folders))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete what none of the last ``keep`` commits names: older commits,
        folders they replaced, and what interrupted runs left. Only while no
        run is writing. Returns the folders deleted."""
        names = self.log.names()
        named = set()
        for n in names[-keep:]:
            state = self.log.read(n)
            lists = [*state.get("tables", {}).values(), *state.get("files", {}).values(), *(x["folders"] for x in state.get("ledgers", {}).values())]
            lists += [f for seen in state.get("seen", {}).values() for f in seen.values()]
            named.update(f for folders in lists for f in folders)
        for n in names[:-keep]:
            self.log.remove(f"{self.log.folder}/{n}")
        data, gone = CommitLog(self.spark, f"{self.root}/_data"), []
        for table in data.names():
            for folder in CommitLog(self.spark, f"{self.root}/_data/{table}").names():
                if f"_data/{table}/{folder}" not in named:
                    data.remove(f"{self.root}/_data/{table}/{folder}")
                    gone.append(f"_data/{table}/{folder}")
        return gone

    # --- tables ---------------------------------------------------------------

    def folders(self, table: str) -> list[str] | None:
        """Folders of a table, below the root; None if there is no such table."""
        held = self.state().get("tables", {}).get(table)
        if held is None and self.log._system().exists(self.log.hadoop.Path(f"{self.root}/{table}")):
            return [table]
        return held

    def read(self, table: str) -> DataFrame:
        folders = self.folders(table)
        return self.open(folders) if folders else self.spark.createDataFrame([], target_schema(table))

    def replace(self, table: str, folders: list[str]) -> None:
        self.part("tables")[table] = folders

    def rewrite(self, table: str, df: DataFrame) -> None:
        """Replace the table by rows that may come from it."""
        with self.transaction():
            self.replace(table, [self.store(table, conform(df, table))])

    def reserve(self, table: str, n: int) -> int:
        """The first of ``n`` ids that nobody else gets, now or later: a range
        is reserved by creating the file of its first id. Ranges of runs that
        stopped, and ids of withdrawn rows, are not given again."""
        ranges = CommitLog(self.spark, f"{self.root}/_ids/{table}")
        while True:
            names = ranges.names()
            last = ranges.read(names[-1])["end"] if names else 0
            start = max(last, self._top(table)) + 1
            if n == 0 or ranges.create(numbered(start), {"end": start + n - 1}):
                return start

    def _top(self, table: str) -> int:
        """Largest id that came with given rows."""
        top = self.state().get("tops", {}).get(table)
        if top is None and self.folders(table) == [table]:
            top = self.read(table).agg(F.max("id")).first()[0]
        return int(top or 0)

    def append(self, table: str, df: DataFrame) -> None:
        """Append rows; a table with a made id gets ids that were never used."""
        with self.transaction():
            if table in GENERATED_IDS and "id" not in df.columns:
                df = assign_ids(df, GENERATED_IDS[table], start=lambda n: self.reserve(table, n))
            self.replace(table, [*(self.folders(table) or []), self.store(table, conform(df, table))])

    def seed(self, table: str, df: DataFrame) -> None:
        """Write a given table as is (lookup tables that exist before a run)."""
        with self.transaction():
            folder = self.store(table, df)
            self.replace(table, [folder])
            if "id" in df.columns:
                top = self.open([folder]).agg(F.max(F.col("id").cast("bigint"))).first()[0]
                tops = self.part("tops")
                tops[table] = max(int(top or 0), tops.get(table, 0))


class JdbcCatalog:
    """Tables in a database; ``schema`` prefixes table names (e.g. ``media.``)."""

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: Mapping[str, str],
        *,
        schema: str = "",
        read_partitions: int = 4,
        fetch_size: int = 10_000,
        writers: int = 20,
        untyped_strings: bool = True,
    ):
        self.spark = spark
        self.url = url
        self.properties = dict(properties)
        self.prefix = f"{schema}." if schema and not schema.endswith(".") else schema
        self.read_partitions = read_partitions
        self.fetch_size = fetch_size
        self.writers = writers
        self.untyped_strings = untyped_strings

    def transaction(self):
        """Appends over JDBC commit one by one; nothing binds them together."""
        return nullcontext()

    def read(self, table: str) -> DataFrame:
        part = "id" if "id" in TARGET_COLUMNS.get(table, ["id"]) else None
        return read_jdbc(
            self.spark, self.url, self.prefix + table, self.properties, partition_column=part,
            num_partitions=self.read_partitions, fetch_size=self.fetch_size,
        )

    def append(self, table: str, df: DataFrame) -> None:
        # the database makes ``id``: write every other column
        append_jdbc(
            conform(df, table, with_id=False),
            self.url,
            self.prefix + table,
            self.properties,
            writers=self.writers,
            untyped_strings=self.untyped_strings,
        )
