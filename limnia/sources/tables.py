"""Reading and writing the library's tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limnia.functions.cleaning import finite_columns
from limnia.operators.schema import check_raster, check_srid

# CSV series are read with a declared schema: inferring one would scan the files twice.
# Counts are read as DOUBLE because tools that know NaN write gaps as 12.0, and cast after.
REGIONAL_SERIES = T.StructType([
    T.StructField("time", T.StringType()), T.StructField("CI_mean", T.DoubleType()),
    T.StructField("CI_p90", T.DoubleType()), T.StructField("n_valid", T.DoubleType()),
])
REGIONAL_DAILY = T.StructType([
    T.StructField("date", T.StringType()), *REGIONAL_SERIES.fields[1:],
    T.StructField("src", T.StringType()), T.StructField("engine", T.StringType()),
])
RINGS = T.ArrayType(T.ArrayType(T.StructType([
    T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType()),
])))


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """CSV with a header; NaN and empty cells become NULL, counts become BIGINT."""
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    df = finite_columns(df)
    return df.withColumn("n_valid", F.col("n_valid").cast("bigint")) if "n_valid" in df.columns else df


def read_parquet(
    spark: SparkSession, path: str | Sequence[str], pattern: str | None = None, recursive: bool = False,
    source_column: str | None = None,
) -> DataFrame:
    """Parquet scan, optionally of the files matching a name pattern in a folder tree."""
    r = spark.read
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    df = finite_columns(r.parquet(*([path] if isinstance(path, str) else path)))
    return df.withColumn(source_column, F.col("_metadata.file_name")) if source_column else df


def read_pixels(
    spark: SparkSession, path: str, value: str, grid: DataFrame | None = None, pattern: str | None = None
) -> DataFrame:
    """Pixel table; with ``grid`` (y, x, lon, lat) positions are attached and checked."""
    df = read_parquet(spark, path, pattern, recursive=bool(pattern))
    if grid is not None:
        df = df.join(grid.select("y", "x", "lon", "lat"), ["y", "x"], "left")
    return check_raster(df, value)


# Folders of a tiled pixel table: squares of so many degrees, 4,050 on the globe; and the side of the
# cells whose space-filling order the rows of a folder have.
TILE_DEG = 4.0
ORDER_DEG = 0.0625


def _tile(lon: Column, lat: Column) -> Column:
    return (F.floor((lat + 90) / TILE_DEG) * 1000 + F.floor((lon + 180) / TILE_DEG)).cast("int")


def _curve(lon: Column, lat: Column) -> Column:
    """Number of a pixel's small cell along a space-filling curve: the bits of column and row in turns."""
    def apart(n):
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            n = n.bitwiseOR(F.shiftleft(n, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
        return n

    x, y = (F.pmod(F.floor(v / ORDER_DEG).cast("bigint"), F.lit(1 << 16)) for v in (lon, lat))
    return apart(x).bitwiseOR(F.shiftleft(apart(y), 1))


def write_pixels(pixels: DataFrame, path: str, lon: str = "lon", lat: str = "lat") -> bool:
    """Overwrite a pixel table laid out by place: a folder per tile, rows along a space-filling curve.

    A reader that knows the lakes opens their tiles only (:func:`near_boxes`), and row groups
    within a tile have narrow bounds of longitude and latitude. Tasks get ranges of the
    curve, so a crowded tile is many files.
    """
    at = pixels.withColumns({"tile": _tile(F.col(lon), F.col(lat)), "curve": _curve(F.col(lon), F.col(lat))})
    dealt = at.repartitionByRange("tile", "curve").sortWithinPartitions("tile", "curve").drop("curve")
    dealt.write.mode("overwrite").partitionBy("tile").parquet(path)
    return True


def near_boxes(pixels: DataFrame, boxes: DataFrame) -> DataFrame:
    """Pixels of the tiles that some box touches; a table without tiles comes back as it is.

    The tiles are asked for first, at most as many as the globe has, so that their numbers select
    folders before any file is opened.
    """
    if "tile" not in pixels.columns:
        return pixels
    number = lambda c, add: F.floor((F.col(c) + add) / TILE_DEG)
    rows = boxes.select(F.explode(F.sequence(number("miny", 90), number("maxy", 90))).alias("r"), "minx", "maxx")
    cells = rows.select("r", F.explode(F.sequence(number("minx", 180), number("maxx", 180))).alias("c"))
    wanted = [r["t"] for r in cells.select((F.col("r") * 1000 + F.col("c")).alias("t")).distinct().collect()]
    return pixels.where(F.col("tile").isin(wanted)).drop("tile")


def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    """Polygon part table; every part must name its coordinate reference system."""
    return check_srid(spark.read.parquet(path))


def polygons_from_geojson(features: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Polygon or MultiPolygon GeoJSON text -> one row per part with ``part`` and ``rings``."""
    g = F.col(geometry)
    kind = F.get_json_object(g, "$.type")
    coords = F.get_json_object(g, "$.coordinates")
    one = F.from_json(coords, "array<array<array<double>>>")
    many = F.from_json(coords, "array<array<array<array<double>>>>")
    parts = F.when(kind == "MultiPolygon", many).when(kind == "Polygon", F.array(one))
    rings = F.transform("polygon", lambda ring: F.transform(
        ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
    ))
    rest = [c for c in features.columns if c != geometry]
    return features.select(*rest, F.posexplode(parts).alias("part", "polygon")).select(
        *rest, F.col("part").cast("bigint").alias("part"), rings.alias("rings")
    )


def optional(read, *args, **kwargs) -> DataFrame | None:
    """The table, or None when its path does not exist."""
    try:
        return read(*args, **kwargs)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), unless_empty: DataFrame | None = None) -> bool:
    """Overwrite a parquet table. If ``unless_empty``, the table it is made from, has no row, write nothing.

    The input is asked and not the result, which would be computed twice.
    """
    if unless_empty is not None and unless_empty.isEmpty():
        return False
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return True


def write_csv(df: DataFrame, path: str, unless_empty: DataFrame | None = None) -> bool:
    """Overwrite a CSV folder with headers. Meant for series and summaries."""
    if unless_empty is not None and unless_empty.isEmpty():
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True


def write_polygons(df: DataFrame, path: str) -> bool:
    return write_parquet(check_srid(df), path)
