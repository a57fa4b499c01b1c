"""Small files that steer readers: listings, and text files that appear whole or not at all."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def names(self, name: str = "") -> list[str]:
        """Names in the folder or in one below it, sorted; none if it does not exist."""
        place = self._path(self.at(name) if name else self.path)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(place)) if self._fs.exists(place) else []

    def state(self) -> list[tuple[str, int, int]]:
        """Name, length and time of change of what lies in the folder, sorted."""
        return sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in self._fs.listStatus(self._path(self.path)))

    def read_text(self, name: str) -> str:
        opened = self._fs.open(self._path(self.at(name)))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
        finally:
            opened.close()

    def remove(self, name: str) -> None:
        """Delete a folder below this one with all that it holds."""
        self._fs.delete(self._path(self.at(name)), True)

    def publish(self, name: str, text: str, replace: bool = False) -> None:
        """Write beside the target and rename, so that readers never see a part; an existing file is an error unless replaced."""
        target = self._path(self.at(name))
        draft = self._path(f"{target.getParent()}/_draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        out.write(bytearray(text.encode()))
        out.close()
        if replace and self._fs.exists(target):
            self._fs.delete(target, False)
        # two writers of one name: the second finds it taken
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise FileExistsError(self.at(name))
