"""Landing-area scans of JSON feed documents.

One distributed scan reads every file of one feed (no per-file plan branch,
nothing read on the driver). Feed selection is a predicate on the file
metadata, so files of other feeds are pruned before they are opened.
"""
from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.names import feed_matches, name_date, qualified_roots, relative_path, select_names
from ..plans.specs import FeedSpec, feed_spec
from ..schemas import DATE_FORMAT, TIMESTAMP_FORMAT
from ..session import scratch_path

FILE_COL = "_feed_file"
CORRUPT_COL = "_corrupt_record"
# a mode that leaves bad documents out without a trace is not offered
MODES = ("FAILFAST", "PERMISSIVE")
# files of the rarer form that a scan names, and the largest file read whole to find its form
LISTED = 100_000
WHOLE = 1 << 28


def _reader(spark: SparkSession, schema: StructType, multi_line: bool, mode: str):
    if mode.upper() not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return (
        spark.read.schema(schema)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("dateFormat", DATE_FORMAT)
        .option("multiLine", bool(multi_line))
        .option("mode", mode.upper())
        .option("columnNameOfCorruptRecord", CORRUPT_COL)
        .option("recursiveFileLookup", True)
    )


def _as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def name_glob(word: str) -> str:
    """Case-insensitive glob for names containing ``word``: ``*[aA][dD]...*``."""
    parts = []
    for ch in word:
        if ch.isalpha():
            parts.append(f"[{ch.lower()}{ch.upper()}]")
        elif ch in "*?[]{}\\":
            parts.append("\\" + ch)
        else:
            parts.append(ch)
    return "*" + "".join(parts) + "*"


def _literal(paths: Sequence[str]) -> list[str]:
    """Paths that a reader takes as they are, not as patterns."""
    return [re.sub(r"([{}\[\]*?\\])", r"\\\1", p) for p in paths]


def _scan(reader, roots: list[str], places, word: str, top_level: bool, files: Column | None, only: Sequence[str] | None = None) -> DataFrame:
    """Documents of the (selected) files below the roots, with their names."""

    def read(paths) -> DataFrame:
        part = reader.json(paths)
        part = part if files is None else part.where(files)
        # file metadata does not cross a union: name the file per root
        return part.withColumn(FILE_COL, relative_path(F.col("_metadata.file_path"), places))

    if only is not None:
        return read(_literal(only))
    parts = []
    if top_level:
        # list only the landing entries named after the feed (like a listing of
        # the landing folder), not the whole history of every feed; a root
        # without such entries is skipped
        for r in roots:
            try:
                parts.append(read(f"{r.rstrip('/')}/{name_glob(word)}"))
            except AnalysisException as e:
                if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                    raise
    return reduce(DataFrame.unionByName, parts) if parts else read(roots)


def scan_feed(
    spark: SparkSession,
    landing: str | Sequence[str],
    feed: str | FeedSpec,
    *,
    since: int = 0,
    multi_line: bool | None = False,
    mode: str = "FAILFAST",
    select: bool = True,
    top_level: bool = True,
    columns: Sequence[str] | None = None,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Documents of one feed under one or more landing roots.

    A feed file is a top-level entry of a landing root whose name holds the
    feed word (a file, or a folder of part files); only those entries are
    listed. ``top_level=False`` lists everything below the roots and selects
    on the whole relative path instead. ``select=False`` skips the exact
    name/date predicate (e.g. to look for undated files).

    ``multi_line=True`` reads one (possibly pretty-printed) document per file;
    such a file is never split (small ones are packed several to a task). The
    default reads one document per line, which Spark splits across tasks, and
    ``None`` reads every file in its own form (see :func:`file_forms`; this
    reads the feed's text once more). If
    no root holds an entry of the feed, the roots themselves are read (so a
    missing root still fails) and the name predicate selects nothing. ``mode="PERMISSIVE"`` keeps bad documents in
    ``_corrupt_record`` (see :func:`split_corrupt`); the default fails.
    The result has the document columns plus ``_feed_file`` (path below the
    landing root). ``columns`` (flat column names) reads only the document
    fields those need, nested ones included. ``only`` names the files below the
    roots (as :func:`landing_files` does) that are opened, and no others.
    """
    spec = feed_spec(feed)
    roots = _as_list(landing)
    places = qualified_roots(spark, roots)
    schema = spec.read_schema(columns)
    if mode.upper() == "PERMISSIVE":
        schema = StructType(schema.fields + [StructField(CORRUPT_COL, StringType(), True)])
    if only is not None and not only:
        return spark.createDataFrame([], StructType(schema.fields + [StructField(FILE_COL, StringType())]))
    most, others = file_forms(spark, landing, spec, since, only) if multi_line is None else (multi_line, [])
    docs = _scan(_reader(spark, schema, most, mode), roots, places, spec.word, top_level, ~F.col("_metadata.file_path").isin(others) if others else None, only)
    if others:
        rest = _scan(_reader(spark, schema, not most, mode), roots, places, spec.word, top_level, F.col("_metadata.file_path").isin(others), only)
        docs = docs.unionByName(rest)
    if select:
        docs = docs.where(select_names(F.col(FILE_COL), spec.word, since))
    return docs


def select_feed(df: DataFrame, feed: str, since: int = 0, name_col: str = FILE_COL) -> DataFrame:
    """Keep rows whose file name holds the feed word and a date after ``since``."""
    return df.where(select_names(F.col(name_col), feed, since))


class UndatedFilesError(RuntimeError):
    """Feed files whose name holds no date: no cutoff can place them."""


def check_undated(docs: DataFrame, feed: str, policy: str = "raise", listing: str | None = None) -> None:
    """Stop on undated files of the feed, or with ``policy="skip"`` write the
    whole list of them to the ``listing`` table (idempotently) and go on.

    ``docs`` is an unselected scan, which the caller selects from afterwards,
    so the landing area is listed once."""
    if policy not in ("raise", "skip"):
        raise ValueError("policy must be raise or skip")
    if policy == "skip" and not listing:
        raise ValueError("skipping undated files needs a place for their list")
    names = undated_files(docs, feed)
    if policy == "skip":
        spark = docs.sparkSession
        try:
            names = names.join(spark.read.parquet(listing), names.columns, "left_anti")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
        if not names.isEmpty():
            names.write.mode("append").parquet(listing)
        return
    some = [r[0] for r in names.limit(6).collect()]
    if some:
        raise UndatedFilesError(f"{feed}: files without a date in the name: " + ", ".join(some[:5]) + (", ..." if len(some) > 5 else ""))


class SeveralDocumentsError(RuntimeError):
    """Files whose documents no form of scan would read in full."""


def landing_files(spark: SparkSession, landing: str | Sequence[str], feed: str | FeedSpec) -> DataFrame:
    """Files of the feed's landing entries: ``path``, ``size``, time ``modified``
    and ``_feed_file`` (path below the root). None of them is opened."""
    word, places = feed_spec(feed).word, qualified_roots(spark, _as_list(landing))
    parts = []
    for root in _as_list(landing):
        try:
            part = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root.rstrip('/')}/{name_glob(word)}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
            continue
        name = relative_path(F.col("_metadata.file_path"), places).alias(FILE_COL)
        parts.append(part.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), name))
    if not parts:
        spark.read.text(landing if isinstance(landing, str) else list(landing))  # a missing root is an error
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], f"path string, size long, modified timestamp, {FILE_COL} string")


def _entries(spark: SparkSession, landing: str | Sequence[str], word: str, since: int, whole: bool = False, only: Sequence[str] | None = None) -> DataFrame | None:
    """Text of the feed's landing entries after ``since`` (or without a date),
    with ``path`` and ``size`` of the file."""
    places = qualified_roots(spark, _as_list(landing))
    name = relative_path(F.col("_metadata.file_path"), places)
    parts = []
    for where in [f"{root.rstrip('/')}/{name_glob(word)}" for root in _as_list(landing)] if only is None else [_literal(only)]:
        try:
            part = spark.read.option("recursiveFileLookup", True).text(where, wholetext=whole)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
            continue
        part = part.where(feed_matches(name, word) & (F.coalesce(name_date(name), F.lit(since + 1)) > since))
        # file metadata does not cross a union
        parts.append(part.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("at")))
    return reduce(DataFrame.unionByName, parts) if parts else None


def _listed(names: DataFrame, mine: Column) -> tuple[bool, list[str]]:
    """Whether more than half of the files are ``mine``, and the paths of the
    others (the driver lists them for the scan anyway)."""
    counts = names.agg(F.count_if(mine).alias("mine"), F.count_if(~mine).alias("rest")).first()
    most = counts["mine"] >= counts["rest"]
    if min(counts) > LISTED:
        raise SeveralDocumentsError(f"both forms of file are there more than {LISTED} times: load them apart, with multi_line given")
    return most, [r[0] for r in names.where(~mine if most else mine).select("path").collect()] if min(counts) else []


def file_forms(spark: SparkSession, landing: str | Sequence[str], feed: str | FeedSpec, since: int = 0, only: Sequence[str] | None = None) -> tuple[bool, list[str]]:
    """Whether most files of the feed hold one document over several lines, and
    the paths of the files in the other form.

    Every file after ``since`` (or without a date; of ``only``, if given) is looked at, on Spark. One
    whose first line stands alone as JSON is a file of lines. Of the others (read
    whole, up to ``WHOLE`` bytes) those that are one JSON value, or whose first
    value is broken while no line stands alone, take the multi-line form, which
    reads (or quarantines) all of them; files of lines behind a broken first one
    are read by lines. A file with more after a document over several lines would
    lose that in one form and the document in the other: it raises
    :class:`SeveralDocumentsError`."""
    spec = feed_spec(feed)
    lines = _entries(spark, landing, spec.word, since, only=only)
    if lines is None:
        return False, []
    # one value and nothing after it
    alone = F.col("value").rlike(r"^\s*[{\[]") & F.coalesce(F.json_array_length(F.concat(F.lit("["), "value", F.lit("]"))) == 1, F.lit(False))
    # one value at least
    first = F.json_object_keys("value").isNotNull() | F.json_array_length("value").isNotNull()
    place = F.struct("at", F.monotonically_increasing_id().alias("n"))
    seen = lines.where(F.trim("value") != "").select("path", "size", alone.alias("alone"), first.alias("first"), place.alias("place"))
    path = scratch_path(spark, f"forms-{spec.name}")
    seen.groupBy("path", "size").agg(F.min_by("alone", "place").alias("head"), F.min_by("first", "place").alias("on_head"), F.bool_or("alone").alias("some"), F.count(F.lit(1)).alias("n")).write.parquet(path)
    files = spark.read.parquet(path)
    # a single line is the same in both forms
    by_line = F.col("head") | (F.col("n") == 1)
    most, others = _listed(files, by_line)
    if most and not others:
        return False, []
    big = [r[0] for r in files.where(~by_line & (F.col("size") > WHOLE)).select("path").limit(5).collect()]
    if big:
        raise SeveralDocumentsError(f"{spec.name}: too large to find out whether they are one document (give multi_line): " + ", ".join(big))
    whole = _entries(spark, landing, spec.word, since, whole=True, only=only)
    if others:
        whole = whole.where(F.col("path").isin(others) if most else ~F.col("path").isin(others))
    whole = whole.select("path", alone.alias("one"), first.alias("first")).join(files.where(~by_line), "path")
    form = F.when(F.col("one"), "multi").when(F.col("first") & ~F.col("on_head"), "several").when(F.col("some") | F.col("first"), "lines").otherwise("multi")
    held = scratch_path(spark, f"forms-whole-{spec.name}")
    whole.select("path", form.alias("form")).write.parquet(held)
    forms = spark.read.parquet(held)
    several = [r[0] for r in forms.where("form = 'several'").select("path").limit(6).collect()]
    if several:
        raise SeveralDocumentsError(f"{spec.name}: more after a document over several lines in " + ", ".join(several[:5]) + (", ..." if len(several) > 5 else ""))
    every = files.select("path").join(forms, "path", "left")
    return _listed(every, F.coalesce(F.col("form") == "multi", F.lit(False)))


def detect_multi_line(spark: SparkSession, landing: str | Sequence[str], feed: str | FeedSpec) -> bool:
    """Whether some file of the feed holds one document over several lines."""
    most, others = file_forms(spark, landing, feed)
    return most or bool(others)


def undated_files(df: DataFrame, feed: str, name_col: str = FILE_COL) -> DataFrame:
    """Files of the feed whose name holds no 8-digit date (left out by the cutoff).

    Give it an unselected scan (``scan_feed(..., select=False)``): the
    predicate is on file metadata, so only such files are opened.
    """
    return df.where(feed_matches(F.col(name_col), feed) & name_date(F.col(name_col)).isNull()).select(name_col).distinct()


def parse_feed(df: DataFrame, column: str, feed: str | FeedSpec, *, mode: str = "FAILFAST") -> DataFrame:
    """Documents held as JSON text in a string column -> document columns."""
    spec = feed_spec(feed)
    opts = {"timestampFormat": TIMESTAMP_FORMAT, "dateFormat": DATE_FORMAT, "mode": mode.upper()}
    parsed = F.from_json(F.col(column), spec.schema, opts)
    others = [c for c in df.columns if c != column]
    return df.select(*others, parsed.alias("_doc")).select(*others, "_doc.*")


def split_corrupt(docs: DataFrame, feed: str | FeedSpec | None = None) -> tuple[DataFrame, DataFrame]:
    """(good documents, quarantined documents) of a PERMISSIVE scan.

    With ``feed`` given, a document that parses but does not hold the feed's
    payload array (a line of another shape) is quarantined too, as what was
    parsed of it. ``n_documents`` counts equal ones of a file, so good and
    quarantined documents of a file add up to those it holds. The scan is
    staged by the caller if both halves are used, so the files are read once.
    """
    whole = F.col(CORRUPT_COL).isNull()
    held = [F.col(c) for c in docs.columns if c not in (CORRUPT_COL, FILE_COL)]
    text = F.coalesce(F.col(CORRUPT_COL), F.to_json(F.struct(*held)))
    fits = whole if feed is None else whole & F.col(feed_spec(feed).explode[0][1]).isNotNull()
    bad = docs.where(~fits).groupBy(FILE_COL, text.alias(CORRUPT_COL)).agg(F.count(F.lit(1)).alias("n_documents"))
    return docs.where(fits).drop(CORRUPT_COL), bad
