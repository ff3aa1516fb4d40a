"""Folders and small files of a table, on whatever file system it lies."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folders:
    """Looks at and removes folders below a path by the session's own file systems."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._jvm, self._gateway = context._jvm, context._gateway
        self._conf = context._jsc.hadoopConfiguration()
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self.root = path.rstrip("/")
        self.files = self._path(path).getFileSystem(self._conf)

    def exists(self, name: str = "") -> bool:
        return self.files.exists(self._at(name))

    def named(self, prefix: str, below: str = "") -> list[str]:
        """Names of the folders that start with ``prefix``, in order."""
        if not self.exists(below):
            return []
        entries = self.files.listStatus(self._at(below))
        names = (entry.getPath().getName() for entry in entries if entry.isDirectory())
        return sorted(name for name in names if name.startswith(prefix))

    def files_in(self, name: str) -> list[str]:
        """Names of the files in a folder that are complete and not hidden."""
        if not self.exists(name):
            return []
        entries = self.files.listStatus(self._at(name))
        names = (entry.getPath().getName() for entry in entries if entry.isFile())
        return sorted(name for name in names if name[0] not in "._")

    def read(self, name: str) -> str:
        try:
            stream = self.files.open(self._at(name))
        except Py4JJavaError as problem:
            raise FileNotFoundError(name) from problem
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.files.create(self._at(name), True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Make a whole file appear under a name, or give False where the name is taken."""
        folder, _, last = name.rpartition("/")
        draft = f"{folder}/.{last}-{uuid.uuid4().hex}" if folder else f".{last}-{uuid.uuid4().hex}"
        self.write(draft, text)
        target = self.files.makeQualified(self._at(name))
        options = self._jvm.org.apache.hadoop.fs.Options
        none = self._gateway.new_array(options.Rename, 1)
        none[0] = options.Rename.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        try:
            context.rename(self.files.makeQualified(self._at(draft)), target, none)
        except Py4JJavaError as problem:
            self.files.delete(self._at(draft), False)
            if "FileAlreadyExists" in problem.java_exception.getClass().getName():
                return False
            raise
        return True

    def move(self, name: str, to: str) -> None:
        self.files.mkdirs(self._at(to).getParent())
        if not self.files.rename(self._at(name), self._at(to)):
            raise OSError(f"{name} could not be moved to {to}")

    def remove_if_empty(self, name: str) -> None:
        if self.exists(name) and not any(
            entry.isDirectory() or entry.getPath().getName()[0] not in "._"
            for entry in self.files.listStatus(self._at(name))
        ):
            self.remove(name)

    def remove(self, name: str) -> None:
        self.files.delete(self._at(name), True)

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)
