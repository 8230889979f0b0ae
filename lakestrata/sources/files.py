"""File access through Hadoop's FileSystem, so any shared store Spark can reach works."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path(root).getFileSystem(conf)

    def _path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def exists(self, p: str) -> bool:
        return self.fs.exists(self._path(p))

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(folder)))

    def read_text(self, p: str) -> str:
        stream = self.fs.open(self._path(p))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_text(self, p: str, text: str) -> None:
        """Create a file that must not exist yet; a second writer of the same name fails.

        The text is written under a name of its own and then renamed, so a crash leaves no
        half-written file and nothing that blocks a later attempt.
        """
        if self.exists(p):
            raise FileExistsError(p)
        tmp = f"{p}.{uuid.uuid4().hex}.writing"
        out = self.fs.create(self._path(tmp), False)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        if not self.fs.rename(self._path(tmp), self._path(p)):
            self.delete(tmp)
            raise FileExistsError(p)

    def reserve(self, p: str) -> bool:
        """Make an empty file; False if it is there already. The store decides between two writers."""
        try:
            return self.fs.createNewFile(self._path(p))
        except Py4JJavaError as exc:
            if "FileAlreadyExists" in str(exc):
                return False
            raise

    def delete(self, p: str) -> None:
        self.fs.delete(self._path(p), True)
