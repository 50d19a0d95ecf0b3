"""Folders of Spark's file system, as the driver sees them: listings, and renames that never overwrite."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """One folder, by its path in any store that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf, self.gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(self.conf)

    def names(self) -> list[str]:
        if not self.fs.exists(self.path):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.path)]

    def files(self) -> list[str]:
        """Every file below the folder, relative to it; hidden ones are left out."""
        if not self.fs.exists(self.path):
            return []
        top, found, it = self.fs.makeQualified(self.path).toString().rstrip("/") + "/", [], self.fs.listFiles(self.path, True)
        while it.hasNext():
            rel = it.next().getPath().toString().removeprefix(top)
            if not rel.rsplit("/", 1)[-1].startswith(("_", ".")):
                found.append(rel)
        return found

    def child(self, rel: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.path, rel)

    def delete(self, rel: str) -> None:
        self.fs.delete(self.child(rel), True)

    def rename_new(self, source, rel: str) -> bool:
        """Renames ``source`` to ``rel``; False if that is there already.  One atomic step."""
        target, fs = self.child(rel), self.jvm.org.apache.hadoop.fs
        self.fs.mkdirs(target.getParent())
        none = self.gateway.new_array(fs.Options.Rename, 1)
        none[0] = fs.Options.Rename.NONE
        try:
            fs.FileContext.getFileContext(self.path.toUri(), self.conf).rename(source, target, none)
        except Py4JJavaError as exc:
            if "FileAlreadyExistsException" in exc.java_exception.getClass().getName():
                return False
            raise
        return True
