"""Names, sizes and small files of whatever file system a path is on, through Spark's Hadoop classes."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """Listing and small whole files below a root."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self.system = self._path(root).getFileSystem(self._conf)

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self.system.listStatus(path)) if self.system.exists(path) else []

    def folders_below(self, folder: str, depth: int) -> list[str]:
        """Relative paths of the folders ``depth`` levels down."""
        found = self.system.globStatus(self._path("/".join([folder, *["*=*"] * depth]))) or []
        return sorted("/".join(str(s.getPath().toString()).split("/")[-depth:]) for s in found)

    def read(self, path: str) -> str:
        stream = self.system.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, path: str, text: str) -> None:
        """Write a whole file, over an old one."""
        stream = self.system.create(self._path(path), True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def put_new(self, path: str, text: str) -> bool:
        """Write a whole file; False if its name is taken."""
        draft = self._path(f"{path}.{uuid.uuid4().hex}.draft")
        stream = self.system.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        kinds = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._jvm.java.lang.reflect.Array.newInstance(kinds.NONE.getClass(), 0)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.system.getUri(), self._conf)
        try:
            context.rename(self.system.makeQualified(draft), self.system.makeQualified(self._path(path)), options)
        except Py4JJavaError as error:
            self.system.delete(draft, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def sizes(self, folder: str) -> list[int]:
        """Bytes of the data files directly in a folder."""
        return [s.getLen() for s in self.system.listStatus(self._path(folder)) if s.getPath().getName().endswith(".parquet")]

    def delete(self, path: str) -> None:
        self.system.delete(self._path(path), True)
