"""Whole files under names that must not be taken yet.

A numbered log is only safe if a number is taken and complete in one step: a file that is created first and written afterwards can be
passed over while its writer still holds it. Text is therefore written aside, and then published by what the file system does as one
step and refuses where the name is taken: a hard link on a local disk, a rename without overwriting on HDFS, a conditional put on object
stores that offer it. Where there is none of these, publishing is refused instead of being unsafe.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CONDITIONAL = "fs.option.create.conditional.overwrite"
RENAMING = ("hdfs", "viewfs", "webhdfs", "swebhdfs")


class Publisher:
    """Publishing and reading of small text files under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self.root = root
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(root).getFileSystem(self._conf)

    def path(self, name: str):
        return self._path(f"{self.root}/{name}")

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def names(self, pattern: str) -> list[str]:
        return [f.getPath().getName() for f in self.fs.globStatus(self.path(pattern)) or []]

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), False)

    def write_aside(self, text: str) -> str:
        """A file of its own that no reader looks at; a writer that dies leaves it for sweep()."""
        name = f"_aside-{uuid.uuid4().hex}"
        out = self.fs.create(self.path(name), False)
        out.write(bytearray(text.encode()))
        out.close()
        return name

    def publish(self, name: str, text: str) -> bool:
        """False if the name is taken; the file is never seen unfinished."""
        scheme = self.fs.getUri().getScheme()
        if scheme != "file" and self.fs.hasPathCapability(self.path(name), CONDITIONAL):
            return self._put(name, text)
        aside = self.write_aside(text)
        try:
            if scheme == "file":
                return self._link(aside, name)
            if scheme in RENAMING:
                return self._rename(aside, name)
            raise NotImplementedError(f"{scheme}: no way to publish a file in one step without overwriting")
        finally:
            self.delete(aside)

    def _link(self, aside: str, name: str) -> bool:
        local = lambda n: self._jvm.java.nio.file.Paths.get(self.fs.makeQualified(self.path(n)).toUri())
        return self._done(lambda: self._jvm.java.nio.file.Files.createLink(local(name), local(aside)))

    def _rename(self, aside: str, name: str) -> bool:
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self._conf)
        options = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        return self._done(lambda: context.rename(self.fs.makeQualified(self.path(aside)), self.fs.makeQualified(self.path(name)), options))

    def _put(self, name: str, text: str) -> bool:
        def put():
            out = self.fs.createFile(self.path(name)).must(CONDITIONAL, True).build()
            out.write(bytearray(text.encode()))
            out.close()

        try:
            return self._done(put)
        except Exception:
            # the answer may have been lost: the store has the text, another's, or none
            if not self.fs.exists(self.path(name)):
                raise
            return self.read(name) == text

    @staticmethod
    def _done(step) -> bool:
        try:
            step()
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    def sweep(self) -> None:
        """Delete what dead writers left aside. Not beside a running one."""
        for name in self.names("_aside-*"):
            self.delete(name)
