"""File ledger: which landing files a feed has been loaded from.

A run that loads only what is new lists the landing entries without opening
them, leaves out the files that an earlier run loaded at the same size and time
(an anti join), and names the rest in a folder of the catalog. The folder
becomes part of the ledger with the commit that publishes the rows, so a file
is known exactly when its rows are. A file that has changed since is read again;
rows that only its earlier content held stay, as the first-seen ledger keeps them.
"""
from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.names import select_names
from ..sources.feeds import FILE_COL, LISTED

# folders of the ledger that are folded into one
FOLD_FILES = 64
SAME = ["path", "size", "modified"]


def unseen_files(catalog, feed: str, listing: DataFrame, word: str, since: int = 0) -> str:
    """Write the listed files of the feed after ``since`` that no commit names;
    returns their folder (not part of the ledger yet)."""
    files = listing.where(select_names(FILE_COL, word, since)).dropDuplicates(SAME)
    held = catalog.state().get("files", {}).get(feed)
    if held:
        files = files.join(catalog.open(held), SAME, "left_anti")
    return catalog.store(f"files-{feed}", files)


def _named(files: DataFrame) -> list[str] | None:
    paths = [r[0] for r in files.select("path").distinct().limit(LISTED + 1).collect()]
    return paths if len(paths) <= LISTED else None


def dated_files(listing: DataFrame, word: str, since: int = 0) -> list[str] | None:
    """Paths of the listed files of the feed after ``since``. None if there are
    more than a scan names: then the scan selects by the names itself."""
    return _named(listing.where(select_names(FILE_COL, word, since)))


def to_open(catalog, folder: str) -> list[str] | None:
    """Paths of the files to open. None if there are more than a scan names:
    then all are read, which changes nothing in the result."""
    return _named(catalog.open([folder]))


def note_files(catalog, feed: str, folder: str) -> None:
    """Add a folder of files to the ledger, in the catalog's open transaction."""
    files = catalog.part("files")
    files[feed] = [*files.get(feed, []), folder]
    if len(files[feed]) > FOLD_FILES:
        files[feed] = [catalog.store(f"files-{feed}", catalog.open(files[feed]))]
