"""Feed-file name predicates (feed word, date cutoff) as Column expressions.

Written as predicates on a column so that, applied to ``_metadata`` of a
file scan, Spark prunes whole files before opening them.
"""
from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..schemas import FEED_WORDS

# --- fixed values: the date in a feed file name is its first run of 8 digits
NAME_DATE_PATTERN = "([0-9]{8})"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def feed_word(feed: str) -> str:
    """``advertiser`` -> ``ADVERTISERFEED``; a feed word passes through."""
    return FEED_WORDS.get(feed.lower(), feed).upper()


def feed_matches(name: Column | str, feed: str) -> Column:
    """Case-insensitive: does the name contain the feed word?"""
    return F.upper(_col(name)).contains(feed_word(feed))


def name_date(name: Column | str) -> Column:
    """First 8 consecutive digits of the name as int; null when there are none."""
    return F.regexp_extract(_col(name), NAME_DATE_PATTERN, 1).try_cast("int")


def select_names(name: Column | str, feed: str, since: int = 0) -> Column:
    """Feed word present and name date strictly after ``since``.

    A name without a date (or a null name) gives false: the file is left out
    (the job and the stream stop on such files, see ``undated_files``).
    """
    return F.coalesce(feed_matches(name, feed) & (name_date(name) > F.lit(int(since))), F.lit(False))


_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.\-]*:")


def _normalise_root(root: str) -> str:
    path = _SCHEME.sub("", root)
    return ("/" + path.lstrip("/")).rstrip("/")


def relative_path(path: Column | str, roots: Sequence[str]) -> Column:
    """Part of a file path below the landing root it was found under.

    File names and sub-folders below the root take part in feed selection;
    the root itself does not, so neither its name nor digits in it can select
    or date a file. ``roots`` must be written as file metadata writes paths
    (see :func:`qualified_roots`); a path under none of them is an error.
    """
    p = _col(path)
    parts = []
    for root in roots:
        marker = _normalise_root(root) + "/"
        pos = F.instr(p, marker)  # first occurrence, 1-based; 0 when absent
        parts.append(F.when(pos > 0, p.substr(pos + F.lit(len(marker)), F.lit(1 << 30))))
    return F.coalesce(*parts, F.raise_error(F.concat(F.lit("file under none of the landing roots: "), p)).cast("string"))


def qualified_roots(spark: SparkSession, roots: Sequence[str]) -> list[str]:
    """Landing roots as file metadata spells them: absolute, percent-encoded,
    globs resolved to the folders they match now."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out = []
    for root in roots:
        path = jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(conf)
        # no matches only for a folder that is not there: reading it fails later
        found = fs.globStatus(path) or []
        places = [s.getPath() for s in found] or [path]
        out += [fs.makeQualified(x).toUri().toString() for x in places]
    return list(dict.fromkeys(out))
