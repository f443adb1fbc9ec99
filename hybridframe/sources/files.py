"""The few file operations a collection needs beside reading and writing DataFrames.

They go through Hadoop's FileContext, so a root can lie on any file system Spark can reach.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        fs = self._jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._path = fs.Path
        base = fs.Path(root)
        self._fs = base.getFileSystem(conf)
        self._context = fs.FileContext.getFileContext(self._fs.getUri(), conf)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Entries of a folder; none for a folder that is not there."""
        if not self.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(path)))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> bool:
        """Create a file in one step; False if it is there already, as it is when another writer won."""
        draft = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
        self._fs.mkdirs(self._path(path).getParent())
        stream = self._fs.create(self._path(draft), False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(rename, 0)
        try:
            self._context.rename(self._path(draft), self._path(path), options)
            return True
        except Py4JJavaError:
            self.delete(draft)
            if self.exists(path):
                return False
            raise

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
