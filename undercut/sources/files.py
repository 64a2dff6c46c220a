"""The few file operations of a commit, on whatever store a path is in."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._jvm, self._gateway = context._jvm, context._gateway
        self._path = self._jvm.org.apache.hadoop.fs.Path
        configuration = context._jsc.hadoopConfiguration()
        self._fs = self._path(path).getFileSystem(configuration)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), configuration)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put_if_absent(self, path: str, text: str) -> bool:
        """Whether this call made the file. It appears whole or not at all, and is never replaced."""
        folder, _, name = path.rpartition("/")
        written = f"{folder}/.{name}-{uuid.uuid4().hex}"
        out = self._fs.create(self._path(written), False)
        out.write(bytearray(text.encode()))
        out.close()
        if self.move(written, path):
            return True
        self.delete(written)
        return False

    def move(self, source: str, target: str) -> bool:
        """Rename a file or folder unless there is a target, in one step of the store."""
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            self._context.rename(self._path(source), self._path(target), options)
        except Py4JJavaError:
            if self.exists(target):
                return False
            raise
        return True

    def children(self, path: str) -> dict[str, int]:
        """Names in a folder, with the times they were last changed; none if there is no folder."""
        if not self.exists(path):
            return {}
        return {x.getPath().getName(): x.getModificationTime() for x in self._fs.listStatus(self._path(path))}

    def below(self, path: str) -> list[str]:
        """Data files below a folder, relative to it, in a fixed order."""
        root = self._fs.makeQualified(self._path(path)).toString()
        found, files = [], self._fs.listFiles(self._path(path), True)
        while files.hasNext():
            file = files.next().getPath()
            if not file.getName().startswith(("_", ".")):
                found.append(file.toString()[len(root) + 1 :])
        return sorted(found)

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))
