"""Stored histories: each batch writes the ranges that it closes and the ranges open after it, and then one version file.

A batch reads the open ranges only. Its folder holds both kinds, told apart by partition, from one computation;
readers take the open ranges of the last batch and the closed ones of all batches. Before the version file
is there, and after a batch that fails, they see the history before.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from recurra.operators.history import merge_versions
from recurra.sources.folders import Folder


class StoredHistory:
    def __init__(self, spark: SparkSession, root: str, key: str, updated_at: str):
        self.spark, self.folder, self.key, self.updated_at = spark, Folder(spark, root), key, updated_at

    def _version(self) -> dict | None:
        names = [n for n in self.folder.names("_versions") if n.endswith(".json")]
        return json.loads(self.folder.read_text(f"_versions/{names[-1]}")) if names else None

    def _read(self, version: dict, batches: list[int]) -> DataFrame:
        schema = T.StructType.fromJson(version["schema"])
        stored = T.StructType([*schema, T.StructField("batch", T.IntegerType()), T.StructField("is_current", T.BooleanType())])
        paths = [self.folder.at(f"batch={b}") for b in batches]
        return self.spark.read.schema(stored).option("basePath", self.folder.path).parquet(*paths)

    def current(self) -> DataFrame | None:
        """The open ranges; None before the first batch."""
        version = self._version()
        return version and self._read(version, [version["batch"]]).where("is_current").drop("batch", "is_current")

    def ranges(self) -> DataFrame | None:
        """The whole history."""
        version = self._version()
        if version is None:
            return None
        last = version["batch"]
        return self._read(version, list(range(1, last + 1))).where(~F.col("is_current") | (F.col("batch") == last)).drop("batch")

    def apply(self, batch: DataFrame, seen_at: dt.date | dt.datetime | None = None) -> int:
        """Merge a batch of versions, see :func:`merge_versions`; fails if another writer has published since."""
        version = self._version()
        number = version["batch"] + 1 if version else 1
        rest = [f for f in batch.schema if f.name not in (self.key, self.updated_at)]
        when = batch.schema[self.updated_at].dataType
        fields = [batch.schema[self.key], *rest, T.StructField("valid_from", when), T.StructField("valid_to", when)]
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
        now = self.spark.createDataFrame([], schema) if version is None else self.current()
        merged = merge_versions(now, batch, self.key, self.updated_at, seen_at).select(*schema.fieldNames(), "is_current")
        merged.hint("rebalance").write.mode("overwrite").partitionBy("is_current").parquet(self.folder.at(f"batch={number}"))
        self.folder.publish(f"_versions/{number:010d}.json", json.dumps({"batch": number, "schema": schema.jsonValue()}))
        return number
