"""Small files in the store of a path, whatever file system Spark has for it: created once, listed, read."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Store:
    """A folder of small text files. Each is put whole or not at all, and never replaced."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(conf)
        # A context renames without replacing; the plain file system would overwrite on some stores.
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name)

    def put(self, name: str, text: str) -> bool:
        """Whether the file was put: false if there is one of that name, which then stays as it is.

        It is written under another name first and renamed, so that no reader meets half of it.
        """
        draft = self._at(f".{name}.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            none = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
            options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = none
            self._context.rename(draft, self._at(name), options)
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception.getClass().getName()):
                raise
            self._fs.delete(draft, False)
            return False
        return True

    def names(self) -> list[str]:
        if not self._fs.exists(self._root):
            return []
        return sorted(n for s in self._fs.listStatus(self._root) if s.isFile() and not (n := s.getPath().getName()).startswith("."))

    def folders(self) -> list[str]:
        if not self._fs.exists(self._root):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._root) if s.isDirectory())

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
