"""Vector tables as blocks: checked rows packed into matrices, and queries met with them slab by slab."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from recurra.llm.common import short_batches, stored

#: vectors of one block, and packed rows in one Arrow batch
BLOCK, PACKED_ROWS = 4096, 8
BLOCK_COLUMNS = "block long, ids binary, nulls binary, labels binary, asked binary, matrix binary"


def common_length(rows: DataFrame, vector: str) -> int:
    """The most frequent length of the vectors; of several the greatest, without any vector 0."""
    sizes = rows.where(f"size({vector}) > 0").groupBy(F.size(vector).alias("dim")).count()
    found = sizes.orderBy(F.desc("count"), F.desc("dim")).first()
    return found.dim if found else 0


def checked(vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and matrix of the vectors that have ``dim`` finite components."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    offsets = vectors.offsets.to_numpy()
    null = vectors.is_null().to_numpy(zero_copy_only=False)
    whole = np.flatnonzero(~null & (np.diff(offsets) == dim))
    flat = vectors.values.to_numpy(zero_copy_only=False)  # null components are NaN here
    matrix = flat[offsets[whole][:, None] + np.arange(dim)] if len(whole) else np.zeros((0, dim))
    finite = np.isfinite(matrix).all(axis=1)
    return whole[finite], matrix[finite]


def packed(rows: DataFrame, dim: int, change: Callable[[np.ndarray], np.ndarray], keep: Callable[[np.ndarray], np.ndarray], label: str, size: int = BLOCK) -> DataFrame:
    """Blocks of up to ``size`` rows of (id, label, asked, vector), written as a table; no row moves between tasks.

    ``keep`` marks the rows of a checked matrix that take part, ``change`` turns them into
    what is stored, column by column. Rows of a block are ordered by id, null last.
    """
    short_batches(rows.sparkSession, 4096)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, parts = TaskContext.get().partitionId() << 32, 0, []

        def block() -> pa.RecordBatch:
            nonlocal number, held
            ids, nulls, labels, asked, matrix = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((ids, nulls))
            columns = [ids[order].tobytes(), nulls[order].tobytes(), labels[order].tobytes(), asked[order].tobytes(), np.ascontiguousarray(matrix[order].T).tobytes()]
            number, held = number + 1, 0
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *[pa.array([c], pa.binary()) for c in columns]], [c.split()[0] for c in BLOCK_COLUMNS.split(", ")])

        for batch in batches:
            place, matrix = checked(batch.column(3), dim)
            stay = keep(matrix)
            place, matrix = place[stay], change(matrix[stay])
            ids = batch.column(0).take(pa.array(place))
            values = [ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
                      batch.column(1).take(pa.array(place)).to_numpy(zero_copy_only=False), batch.column(2).take(pa.array(place)).to_numpy(zero_copy_only=False).astype(np.uint8), matrix]
            for at in range(0, len(place), size):
                piece = [v[at : at + size] for v in values]
                if held + len(piece[0]) > size:
                    yield block()
                parts.append(piece)
                held += len(piece[0])
        if parts:
            yield block()

    return stored(rows.select("id", "label", "asked", "vector").mapInArrow(run, BLOCK_COLUMNS), label)


def numbers(value: bytes, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(value, kind)


def met(asked: DataFrame, blocks: DataFrame, key: str, slabs: int) -> DataFrame:
    """Packed queries of ``asked`` with the blocks of their slab; both sides are dealt by ``key`` to ``slabs`` tasks."""
    return asked.repartition(slabs, key).join(blocks.repartition(slabs, key), key)


def tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slab_of(block: Column, slabs: int) -> Column:
    return F.pmod(F.xxhash64(block), F.lit(slabs)).cast("int")
