"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recurra.session import scratch_path

_shipped: set[str] = set()
#: Rows of one Arrow batch. Texts have no bound, so batches are kept short.
BATCH_ROWS = 256


def short_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let Python workers get at most ``rows`` rows at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def give_back() -> None:
    """Return the memory that a task has freed to the machine; workers stay for the next stages."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, done: Callable[[], None] | None = None) -> DataFrame:
    """``fn`` over each Arrow batch, ``done`` at the end of each task; rows are independent, so a lost task is simply run again."""
    short_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
        # workers are used again by other stages, so buffers go back to the machine
        pa.default_memory_pool().release_unused()
        if done:
            done()

    return df.mapInArrow(run, schema)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again, which cuts its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`stored` that no later step reads.

    Only where all that was derived from them is stored too: a shuffle that is lost with its
    executor would have to read them again.
    """
    for df in tables:
        spark = df.sparkSession
        files = df.inputFiles()
        if files:
            folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        spark._jvm.System.gc()  # the cleaner drops the shuffle files of plans that nothing holds any more


def in_fold(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    """Rows of one fold by checksum of the id; rows without an id belong to no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def ship_package(spark: SparkSession) -> None:
    """Send this library to the Python workers once for each application, for clusters where it is not installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="recurra-code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)
