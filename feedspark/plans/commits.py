"""A commit log: small numbered files, each naming all that a catalog holds.

A run writes its data into new folders and then publishes one file that names
them; readers take the file of the largest number. So a run that stops half way
changes nothing, however many tables it writes, and of two runs that start from
the same state one publishes and the other one is told.

A file appears whole: it is written under another name and renamed, which fails
if the number is taken (HDFS and alike; a store without such a rename needs one
writer at a time).
"""
from __future__ import annotations

import json
import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_lock = threading.Lock()  # a local file system does not check and rename in one step


class ConcurrentRunError(RuntimeError):
    """Another run has published since this one started: repeat it."""


class CommitLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.hadoop = spark._jvm.org.apache.hadoop.fs

    def _path(self, name: str):
        return self.hadoop.Path(f"{self.folder}/{name}")

    def _system(self):
        return self._path(".").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        """Published files, in order of their names."""
        folder = self.hadoop.Path(self.folder)
        if not self._system().exists(folder):
            return []
        found = [s.getPath().getName() for s in self._system().listStatus(folder)]
        return sorted(n for n in found if not n.startswith((".", "_")))

    def read(self, name: str) -> dict:
        stream = self._system().open(self._path(name))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def create(self, name: str, content: dict) -> bool:
        """Publish a file under a name; False if the name is taken."""
        system, draft = self._system(), self._path(f".{name}.{uuid.uuid4().hex}")
        stream = system.create(draft, False)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        rename = getattr(self.hadoop, "Options$Rename")
        plain = self.spark.sparkContext._gateway.new_array(rename, 1)
        plain[0] = rename.NONE
        files = self.hadoop.FileContext.getFileContext(system.makeQualified(draft).toUri(), self.spark._jsc.hadoopConfiguration())
        with _lock:
            try:
                files.rename(system.makeQualified(draft), system.makeQualified(self._path(name)), plain)
            except Py4JJavaError as e:
                if "FileAlreadyExistsException" not in str(e):
                    raise
                system.delete(draft, False)
                return False
        return True

    def remove(self, path: str) -> None:
        """Delete a folder or file (given whole) that nothing names any more."""
        self._system().delete(self.hadoop.Path(path), True)


def numbered(n: int) -> str:
    return f"{n:018d}"
