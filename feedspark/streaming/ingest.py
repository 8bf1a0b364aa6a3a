"""Incremental feed loads: the file-stream checkpoint remembers which landing
files were loaded, so a rerun reads only new files.

Each micro-batch is a plain DataFrame handed to the same batch pipeline
(``foreachBatch``) through the first-seen ledger, so neither the size nor the
order of batches changes the tables, and a batch replayed after a failure
appends nothing twice.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import qualified_roots, relative_path
from ..operators.flatten import flatten
from ..plans.loads import LOADERS, NEEDED
from ..plans.specs import feed_spec
from ..schemas import DATE_FORMAT, TIMESTAMP_FORMAT
from ..sources.feeds import FILE_COL, check_undated, name_glob, select_feed


def feed_stream(spark: SparkSession, landing: str, feed: str, *, multi_line: bool = False, max_files: int | None = None) -> DataFrame:
    """Streaming DataFrame of one feed's documents (new files only; only the
    fields its load reads), undated files among them."""
    spec = feed_spec(feed)
    reader = (
        spark.readStream.schema(spec.read_schema(NEEDED[spec.name]))
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("dateFormat", DATE_FORMAT)
        .option("multiLine", bool(multi_line))
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", True)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    # list only the landing entries named after the feed, as the batch scan does
    docs = reader.json(f"{landing.rstrip('/')}/{name_glob(spec.word)}")
    return docs.withColumn(FILE_COL, relative_path(F.col("_metadata.file_path"), qualified_roots(spark, [landing])))


def start_feed_stream(
    spark: SparkSession,
    landing: str,
    feed: str,
    catalog,
    checkpoint: str,
    *,
    since: int = 0,
    multi_line: bool = False,
    available_now: bool = True,
    max_files: int | None = None,
    undated: str = "raise",
    undated_list: str | None = None,
):
    """Start loading ``feed`` from ``landing`` into ``catalog``; returns the query.

    ``available_now`` processes every file present now (in several batches
    if ``max_files`` is set) and stops; otherwise the query keeps running
    and picks up new files as they land. A file without a date in its name
    fails the query, or with ``undated="skip"`` is listed in ``undated_list``.
    """
    spec = feed_spec(feed)
    load = LOADERS[spec.name]

    def batch(docs: DataFrame, epoch_id: int) -> None:
        check_undated(docs, spec.word, undated, undated_list)
        load(flatten(select_feed(docs, spec.word, since), spec, columns=NEEDED[spec.name]), catalog, only_new=True)

    writer = feed_stream(spark, landing, spec.name, multi_line=multi_line, max_files=max_files).writeStream.foreachBatch(batch)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
