"""Name -> query registry. Each query takes (spark, sf_dir) and returns a frame."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from recurra.config import MetricConfig
from recurra.plans.published import Published
from recurra.sources import adapter

CFG = MetricConfig()
AS_OF = adapter.AS_OF
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class Source:
    """Lazy access to the entity frames of one data folder, plus the marts over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.t = adapter.tables(spark, sf_dir)

    @cached_property
    def marts(self) -> Published:
        """Stored marts as reports meet them."""
        return Published(self.spark, self.sf_dir, self.t, CFG, AS_OF)

    def raw(self, name: str) -> DataFrame:
        return adapter.read_table(self.spark, self.sf_dir, name)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and arrays as text, so that any client compares them alike."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double").alias(f.name)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws("|", c).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def query(name: str):
    """Register ``fn(source)`` under ``name``."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: plain(fn(Source(spark, sf_dir)))
        return fn

    return register
