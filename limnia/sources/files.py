"""File listings: signatures, reader status, and what is still missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limnia.functions.text import basename


def list_files(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """``path, src, length``; contents are not read because the column is pruned.

    Spark's scans skip files of length zero, so an empty file is not listed. Audits treat it
    like an absent one either way.
    """
    r = spark.read.format("binaryFile")
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    return r.load(path).select("path", basename("path").alias("src"), "length")


# Leading bytes of HDF5-based and classic array files.
SIGNATURES = (b"\x89HDF", b"CDF")
_HEAD = 8


def _open_head(path: str) -> bytes:
    """First bytes of a file, b"" when it cannot be read."""
    from pyarrow import fs

    uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and "://" not in path else path
    system, inner = fs.FileSystem.from_uri(uri)  # an unknown scheme is an error, not "unreadable"
    try:
        with system.open_input_stream(inner) as f:
            return f.read(_HEAD)
    except OSError:
        return b""


def _flag_signatures(batches):
    for pdf in batches:
        heads = pdf["path"].map(_open_head)
        yield pdf.assign(is_array_file=heads.map(lambda h: h.startswith(SIGNATURES)))


def file_signatures(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """``src, length, is_array_file``; an unreadable file is no array file.

    Spark lists the files and spreads the paths; a task then reads eight bytes of each. The
    built-in binary scan would load whole files to look at their first bytes.
    """
    listing = list_files(spark, path, pattern, recursive)
    tasks = spark.sparkContext.defaultParallelism
    return listing.repartition(tasks, "path").mapInPandas(
        _flag_signatures, "path string, src string, length bigint, is_array_file boolean"
    ).drop("path")


def readable_only(pixels: DataFrame, status: DataFrame, strict: bool = False) -> DataFrame:
    """Drop pixels of files marked unreadable and record which reader served the rest.

    ``status`` is ``src, engine``; a NULL engine means no reader could open the file. In
    strict mode such a file fails the job instead of being skipped.
    """
    from limnia.operators.schema import require

    known = F.col("engine").isNotNull()
    status = require(status, known, "unreadable file") if strict else status.where(known)
    return pixels.join(status.select("src", "engine"), "src")


def audit_files(expected: DataFrame, listing: DataFrame, remote: DataFrame | None = None) -> DataFrame:
    """Each expected file with its action.

    ``skip`` when present and not empty, else ``get`` when it can be fetched, else ``miss``.
    ``remote`` lists obtainable ``src``; without it everything absent is ``get``.
    """
    have = listing.where("length > 0").select("src").distinct().withColumn("have", F.lit(True))
    out = expected.join(have, "src", "left")
    if remote is None:
        out = out.withColumn("there", F.lit(True))
    else:
        out = out.join(remote.select("src").distinct().withColumn("there", F.lit(True)), "src", "left")
    action = F.when(F.col("have"), "skip").when(F.col("there"), "get").otherwise("miss")
    return out.withColumn("action", action).drop("have", "there")


def missing_files(expected: DataFrame, listing: DataFrame) -> DataFrame:
    return expected.join(listing.where("length > 0").select("src"), "src", "left_anti")
