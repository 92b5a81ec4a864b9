"""Versioned manifests in a shared folder, committed by a rename that fails where the version exists."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Conflict(Exception):
    """Another writer committed this version or batch first."""


class Folder:
    """Small files of a folder in any store that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._spark = spark
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str = "") -> list[str]:
        path = self._at(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def size(self, folder: str) -> tuple[int, int]:
        """Number and bytes of the files with any content below a folder; one call, however many there are."""
        path = self._at(folder)
        if not self._fs.exists(path):
            return 0, 0
        found = self._fs.getContentSummary(path)
        return found.getFileCount() - int(self._fs.exists(self._at(f"{folder}/_SUCCESS"))), found.getLength()

    def read(self, name: str) -> dict:
        stream = self._fs.open(self._at(name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def create(self, name: str, content: dict) -> None:
        """The file appears whole, or Conflict is raised where there is one of that name."""
        made = f".{name.replace('/', '_')}.{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(made), True)
        stream.write(json.dumps(content).encode())
        stream.close()
        self._fs.mkdirs(self._at(name).getParent())
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), self._conf)
        options = self._spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self._at(made), self._at(name), options)
        except Exception as e:
            self._fs.delete(self._at(made), False)
            if "FileAlreadyExistsException" in str(e):
                raise Conflict(name) from e
            raise

    def delete(self, path: str) -> None:
        self._fs.delete(self._jvm.org.apache.hadoop.fs.Path(path), True)
