"""Files of any store Spark can reach, through Spark's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    """A few calls about names, sizes and moves; contents stay with the executors."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self._conf), where

    def exists(self, path: str) -> bool:
        fs, where = self._at(path)
        return fs.exists(where)

    def names(self, path: str) -> list[str]:
        """Names directly in a folder, in order; none if there is no such folder."""
        fs, where = self._at(path)
        if not fs.exists(where):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(where))

    def size(self, path: str) -> int:
        fs, where = self._at(path)
        return fs.getContentSummary(where).getLength() if fs.exists(where) else 0

    def delete(self, path: str) -> None:
        fs, where = self._at(path)
        fs.delete(where, True)

    def touch(self, path: str) -> None:
        """An empty file: it is there or not, with nothing between."""
        fs, where = self._at(path)
        fs.create(where, True).close()

    def move(self, path: str, folder: str) -> None:
        fs, where = self._at(path)
        target = self._jvm.org.apache.hadoop.fs.Path(folder)
        fs.mkdirs(target)
        if not fs.rename(where, self._jvm.org.apache.hadoop.fs.Path(target, where.getName())):
            raise OSError(f"cannot move {path} to {folder}")

    def rename(self, path: str, target: str) -> None:
        """Give a file another name, in place of the file that has it."""
        fs, where = self._at(path)
        named = self._jvm.org.apache.hadoop.fs.Path(target)
        fs.mkdirs(named.getParent())
        fs.delete(named, False)
        if not fs.rename(where, named):
            raise OSError(f"cannot rename {path} to {target}")

    def set_age(self, path: str, days: int) -> None:
        """Let a file look as if it was written so many days ago."""
        fs, where = self._at(path)
        written = self._jvm.java.lang.System.currentTimeMillis() - days * 86_400_000
        fs.setTimes(where, written, -1)

    def qualified(self, path: str) -> str:
        """The path with the scheme of its store."""
        fs, where = self._at(path)
        return fs.makeQualified(where).toString()

    def first_line(self, path: str) -> str:
        """The first line of a text file that is not blank; empty if there is none."""
        fs, where = self._at(path)
        stream = self._jvm.java.io.InputStreamReader(fs.open(where), "UTF-8")
        reader = self._jvm.java.io.BufferedReader(stream, 8192)
        try:
            line = reader.readLine()
            while line is not None and not line.strip():
                line = reader.readLine()
        finally:
            reader.close()
        return (line or "").removeprefix("\ufeff")
