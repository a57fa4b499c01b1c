"""Versioned store of marts.

Every build writes into folders of its own number. A version is a small file that names,
for each mart, the builds that hold its rows: one build for a whole mart, or for
a monthly mart the build of each range of months. A look-back build therefore writes its
months only, and also removes rows of months that have become empty. The version file
is published last, for all marts of the build together: until then, and after a build
that fails, readers see the version before.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from recurra.sources.files import write_full_refresh
from recurra.sources.folders import Folder

MONTH = "month_start"


def shifted(month: dt.date, months: int) -> dt.date:
    n = month.year * 12 + month.month - 1 + months
    return dt.date(n // 12, n % 12 + 1, 1)


@dataclass
class Mart:
    """Where the rows of a mart are: (build, first month, month behind the last), newest build first."""

    schema: str
    monthly: bool
    segments: list[tuple[int, str | None, str | None]]
    #: newest month with rows
    newest: str | None = None


@dataclass
class Version:
    number: int = 0
    build: int = 0
    marts: dict[str, Mart] = field(default_factory=dict)


class MartStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, Folder(spark, root)

    def current(self) -> Version:
        names = [n for n in self.folder.names("_versions") if n.endswith(".json")]
        if not names:
            return Version()
        found = json.loads(self.folder.read_text(f"_versions/{names[-1]}"))
        return Version(found["number"], found["build"], {k: Mart(m["schema"], m["monthly"], [tuple(s) for s in m["segments"]], m["newest"]) for k, m in found["marts"].items()})

    def read(self, name: str, version: Version | None = None) -> DataFrame | None:
        """A mart as of a version; months are partitions, so a filter on them prunes the scan. None if it has not been built."""
        mart = (version or self.current()).marts.get(name)
        if mart is None:
            return None
        schema = T.StructType.fromJson(json.loads(mart.schema))
        if not mart.monthly:
            return self.spark.read.schema(schema).parquet(self.folder.at(f"{name}/build={mart.segments[0][0]}"))
        parts = T.StructType([f for f in schema if f.name != MONTH]).add("build", T.IntegerType()).add(schema[MONTH])
        rows = self.spark.read.schema(parts).option("basePath", self.folder.at(name)).parquet(*[self.folder.at(f"{name}/build={b}") for b in sorted({b for b, _, _ in mart.segments})])
        kept = F.lit(False)
        for build, since, until in mart.segments:
            part = F.col("build") == build
            part = part & (F.col(MONTH) >= F.lit(since).cast("date")) if since else part
            part = part & (F.col(MONTH) < F.lit(until).cast("date")) if until else part
            kept = kept | part
        return rows.where(kept).select(*schema.fieldNames())

    def draft(self, before: Version) -> Draft:
        # folders of builds that failed keep their numbers
        used = [int(n.split("=")[1]) for mart in self.folder.names() for n in self.folder.names(mart) if n.startswith("build=")]
        return Draft(self, before, max([before.build, *used]) + 1)


class Draft:
    """The next version while it is built."""

    def __init__(self, store: MartStore, before: Version, build: int):
        self.store, self.before = store, before
        self.version = Version(before.number + 1, build, dict(before.marts))

    def read(self, name: str) -> DataFrame | None:
        """A mart with what this build has written so far."""
        return self.store.read(name, self.version)

    def newest(self, name: str) -> dt.date | None:
        """Newest month of a mart before this build; from the version file, no row is read."""
        mart = self.before.marts.get(name)
        return dt.date.fromisoformat(mart.newest) if mart and mart.newest else None

    def write(self, name: str, rows: DataFrame, monthly: bool, since: dt.date | None = None, finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Write ``rows`` as this build's part of the mart: all of it, or with ``since`` the months from there on.

        ``finish`` adds columns that follow from a row alone; it runs behind the shuffle and sort by month.
        """
        build, folder = self.version.build, self.store.folder
        rows = rows.where(F.col(MONTH) >= F.lit(since)) if since else rows
        rows = write_full_refresh(rows, folder.at(f"{name}/build={build}"), MONTH if monthly else None, finish)
        segments: list[tuple[int, str | None, str | None]] = [(build, since.isoformat() if since else None, None)]
        newest = None
        if monthly:
            newest = max((n.split("=")[1] for n in folder.names(f"{name}/build={build}") if n.startswith(f"{MONTH}=")), default=None)
        if since:
            for b, low, high in self.before.marts[name].segments if name in self.before.marts else []:
                high = min(filter(None, (high, since.isoformat())))
                if low is None or low < high:
                    segments.append((b, low, high))
            newest = newest or max((n.split("=")[1] for b, low, high in segments[1:] for n in folder.names(f"{name}/build={b}") if n.startswith(f"{MONTH}=") and (low or "") <= n.split("=")[1] < high), default=None)
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])  # files hold nulls whatever the plan knew
        self.version.marts[name] = Mart(schema.json(), monthly, segments, newest)

    def publish(self) -> Version:
        """Switch readers to this version; fails if another build has published since this one began."""
        v = self.version
        text = json.dumps({"number": v.number, "build": v.build, "marts": {k: vars(m) for k, m in v.marts.items()}})
        self.store.folder.publish(f"_versions/{v.number:010d}.json", text)
        return v
