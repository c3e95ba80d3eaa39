"""What the operators share: tables, stored intermediates, bounded Arrow batches, the hold-out rule."""

from __future__ import annotations

import contextlib
import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import limnia
from limnia.session import scratch_path

# Rows of whole texts that one Arrow batch may carry, and bytes worked on at a time.
BATCH_ROWS = 200
CHUNK_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession) -> SparkSession:
    """Send this package to the workers, and keep Arrow batches of whole texts small.

    A worker need not have the package installed, and a run of very long texts fits into it.
    """
    sc = spark.sparkContext
    if not getattr(sc, "_limnia_sent", False):
        home = Path(limnia.__file__).parent
        sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='limnia-')}/limnia", "zip", home.parent, home.name))
        sc._limnia_sent = True
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, deleted when the session's JVM ends."""
    return scratch_path(spark)


def stored(df: DataFrame) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Total UTF-8 bytes of a text column, to size groups by."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds about ``limit`` bytes of ``column``, and one row at least.

    A worker outlives its task: what the task has freed goes back to the machine at the end.
    """
    try:
        yield from _slices(batches, column, limit)
    finally:
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(AttributeError, OSError):  # not on every system
            ctypes.CDLL(None).malloc_trim(0)


def _slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, size = 0, 0
        offsets = _offsets(batch.column(column))
        for i in range(batch.num_rows):
            n = int(offsets[i + 1] - offsets[i])
            if size and size + n > limit:
                yield batch.slice(at, i - at)
                at, size = i, 0
            size += n
        if batch.num_rows > at:
            yield batch.slice(at)


def _offsets(arr: pa.Array):
    import numpy as np

    kind = np.int64 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else np.int32
    if len(arr) == 0:
        return np.zeros(1, dtype=kind)
    return np.frombuffer(arr.buffers()[1], dtype=kind)[arr.offset : arr.offset + len(arr) + 1]


def broadcast(spark: SparkSession, value) -> Callable:
    """A broadcast's value getter that can travel in a closure."""
    b = spark.sparkContext.broadcast(value)
    return lambda: b.value
