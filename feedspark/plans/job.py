"""The feed job: feed name -> landing files -> flat feed -> load.

    python -m feedspark --feed advertiser --landing s3://.../landing --catalog s3://.../tables
    (or spark-submit a script that calls ``feedspark.plans.job.main()``)

or over JDBC (``--jdbc-url`` with ``--jdbc-user``/``--jdbc-password`` or the
``FEED_JDBC_USER``/``FEED_JDBC_PASSWORD`` variables).
"""
from __future__ import annotations

import argparse
import logging
import os
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..operators.flatten import flatten
from ..session import scratch_path
from ..sinks.tables import append_table
from ..sources.feeds import check_undated, landing_files, scan_feed, split_corrupt
from .files import dated_files, note_files, to_open, unseen_files
from .loads import LOADERS, NEEDED
from .specs import FEEDS, feed_spec

log = logging.getLogger("feedspark.job")


def _append_once(bad: DataFrame, quarantine: str) -> None:
    """Append the bad documents that the quarantine does not hold yet."""
    spark = bad.sparkSession
    bad = bad.distinct()
    try:
        held = spark.read.parquet(quarantine)
        bad = bad.join(held, [bad[c].eqNullSafe(held[c]) for c in bad.columns if c in held.columns], "left_anti")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
    if not bad.isEmpty():
        append_table(bad, quarantine)


def run_feed(
    spark: SparkSession,
    feed: str,
    landing: str | list[str],
    catalog,
    *,
    since: int = 0,
    multi_line: bool | None = None,
    mode: str = "FAILFAST",
    quarantine: str | None = None,
    undated: str = "raise",
    undated_list: str | None = None,
    only_new: bool = False,
    stage: str | None = None,
    tenant_scoped: bool = False,
) -> None:
    """Load every landing file of ``feed`` dated after ``since`` into ``catalog``.

    An unknown feed raises ``ValueError`` before anything is read.
    ``multi_line=None`` finds out for every file whether it holds one document
    or one per line. Files without a date stop the run, or with ``undated="skip"`` are
    listed in the table ``undated_list``. In PERMISSIVE mode documents that do
    not parse, or do not hold the feed's payload, go to ``quarantine`` (required then) once the others are loaded;
    a run that stops or is repeated adds none twice. ``only_new`` loads through
    the ledger (see :mod:`feedspark.plans.incremental`) and opens only files
    that no earlier such run has loaded (see :mod:`feedspark.plans.files`).
    """
    spec = feed_spec(feed)
    permissive = mode.upper() == "PERMISSIVE"
    if only_new and not hasattr(catalog, "state"):
        raise ValueError("incremental loads need a catalog with ledgers; a database target takes full loads only")
    if permissive and not quarantine:
        raise ValueError("PERMISSIVE mode needs a quarantine location")
    with catalog.transaction():
        # files are checked and selected by a listing, not with every document
        listing = landing_files(spark, landing, spec)
        check_undated(listing, spec.word, undated, undated_list)
        files = unseen_files(catalog, spec.name, listing, spec.word, since) if only_new else None
        only = dated_files(listing, spec.word, since) if files is None else to_open(catalog, files)
        docs = scan_feed(spark, landing, spec, since=since, multi_line=multi_line, mode=mode, columns=NEEDED[spec.name], select=only is None, only=only)
        bad = None
        if permissive:
            path = scratch_path(spark, f"documents-{spec.name}")
            docs.write.option("compression", "zstd").parquet(path)
            docs, bad = split_corrupt(spark.read.schema(docs.schema).parquet(path), spec)
        flat = flatten(docs, spec, columns=NEEDED[spec.name])
        LOADERS[spec.name](flat, catalog, only_new=only_new, stage=stage, tenant_scoped=tenant_scoped)
        if bad is not None:
            # before the commit: a file is known as loaded only once its bad documents are kept
            _append_once(bad, quarantine)
        if only != [] and files is not None:
            note_files(catalog, spec.name, files)


# parents before children: clients before products, estimates and dayparts;
# networks before programs
LOAD_ORDER = ("advertiser", "destination", "estimate", "daypart", "program")


def run_feeds(spark: SparkSession, landing: str | list[str], catalog, feeds=LOAD_ORDER, **options) -> None:
    """Load several feeds in load order (each as :func:`run_feed`)."""
    wanted = {feed_spec(f).name for f in feeds}
    for feed in LOAD_ORDER:
        if feed in wanted:
            log.info("loading %s", feed)
            run_feed(spark, feed, landing, catalog, **options)


def _catalog(spark: SparkSession, args):
    from .catalog import JdbcCatalog, ParquetCatalog

    if args.jdbc_url:
        props = {
            "user": args.jdbc_user or os.environ.get("FEED_JDBC_USER", ""),
            "password": args.jdbc_password or os.environ.get("FEED_JDBC_PASSWORD", ""),
        }
        if args.jdbc_driver:
            props["driver"] = args.jdbc_driver
        return JdbcCatalog(spark, args.jdbc_url, props, schema=args.jdbc_schema)
    if not args.catalog:
        raise SystemExit("give --catalog (parquet tables) or --jdbc-url")
    return ParquetCatalog(spark, args.catalog)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="feedspark", description="Load one feed (or all, in load order) from a landing area.")
    p.add_argument("--feed", required=True, help=f"one of {sorted(FEEDS)}, or all (in load order)")
    p.add_argument("--landing", required=True, action="append", help="landing root (repeatable)")
    p.add_argument("--catalog", help="root folder of parquet target tables")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password")
    p.add_argument("--jdbc-driver")
    p.add_argument("--jdbc-schema", default="")
    p.add_argument("--since", type=int, default=0, help="only files dated after yyyymmdd")
    p.add_argument("--multi-line", action=argparse.BooleanOptionalAction, default=None, help="one (pretty-printed) document per file, or one per line; found out unless given")
    p.add_argument("--undated", default="raise", choices=["raise", "skip"], help="stop on files without a date in the name, or list them and go on")
    p.add_argument("--undated-list", help="table for the list of skipped files")
    p.add_argument("--mode", default="FAILFAST", choices=["FAILFAST", "PERMISSIVE"])
    p.add_argument("--quarantine", help="where PERMISSIVE mode keeps bad documents")
    p.add_argument("--only-new", action="store_true", help="incremental load through the first-seen ledger")
    p.add_argument("--tenant-scoped", action="store_true", help="match clients/networks within the feed row's tenant only")
    p.add_argument("--stage", default=None, choices=["table", "cache"], help="hold the flat feed as a parquet table (default) or in cache")
    args = p.parse_args(argv)
    feeds = LOAD_ORDER if args.feed == "all" else (args.feed,)
    try:
        for f in feeds:
            feed_spec(f)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName(f"feed-{args.feed}").getOrCreate()
    run_feeds(
        spark,
        args.landing,
        _catalog(spark, args),
        feeds,
        since=args.since,
        multi_line=args.multi_line,
        mode=args.mode,
        quarantine=args.quarantine,
        undated=args.undated,
        undated_list=args.undated_list,
        only_new=args.only_new,
        stage=args.stage,
        tenant_scoped=args.tenant_scoped,
    )
    return 0


if __name__ == "__main__":
    sys.exit(main())
