"""The test tables seen as lake data: pixels, lakes, polygons, series, climate, files.

Every adapter is a projection or aggregation of a whole table, so the work of the queries
grows with the tables. ``oracles.py`` states the same shapes in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limnia.session import materialise, use_utc
from limnia.sources.manifest import daily_name

VALID_MIN, VALID_MAX = 0.0, 0.005
CLIMATE = ("tmin", "tmax", "prcp", "srad", "vp", "dayl")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixels(spark, sf_dir) -> DataFrame:
    """lineitem -> src, date, y, x, lon, lat, CI_cyano; every seventh line number is NaN."""
    li = table(spark, sf_dir, "lineitem")
    x = F.pmod(F.col("l_orderkey") * 7919, F.lit(2100)).cast("int")
    y = F.pmod(F.col("l_partkey") * 31, F.lit(90)).cast("int")
    date = F.to_date("l_shipdate")
    value = F.when(F.col("l_linenumber") == 7, F.lit(float("nan")).cast("float")).otherwise(
        (F.col("l_extendedprice") * 5e-8).cast("float")
    )
    return li.select(
        daily_name(date, F.lit("CONUS")).alias("src"), date.alias("date"), y.alias("y"), x.alias("x"),
        (F.lit(-95.0) + x / 100.0).alias("lon"), (F.lit(40.0) + y / 10.0).alias("lat"),
        value.alias("CI_cyano"),
    )


def grid(spark, sf_dir) -> DataFrame:
    """The distinct pixel positions."""
    return pixels(spark, sf_dir).select("y", "x", "lon", "lat").distinct()


def files(spark, sf_dir) -> DataFrame:
    """The file table; written out, as a stored one would be."""
    return materialise(pixels(spark, sf_dir).select("src").distinct())


def boxes(spark, sf_dir) -> DataFrame:
    """region -> five overlapping lake boxes."""
    k = F.col("r_regionkey").cast("double")
    return table(spark, sf_dir, "region").select(
        F.concat(F.lit("GL-"), (F.col("r_regionkey") + 1).cast("string")).alias("lake_id"),
        (k * 3 - 93).alias("minx"), F.lit(41.0).alias("miny"),
        (k * 3 - 89).alias("maxx"), F.lit(48.0).alias("maxy"),
    )


def many_boxes(spark, sf_dir) -> DataFrame:
    """supplier -> one small box per supplier."""
    p = _centres(spark, sf_dir)
    r = F.col("r")
    return p.select(
        F.concat(F.lit("L-"), F.col("part")).alias("lake_id"), (F.col("cx") - r).alias("minx"),
        (F.col("cy") - r).alias("miny"), (F.col("cx") + r).alias("maxx"), (F.col("cy") + r).alias("maxy"),
    )


def _centres(spark, sf_dir) -> DataFrame:
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        s.cast("bigint").alias("part"), "s_nationkey",
        (F.lit(-97.0) + F.pmod(s * 37, F.lit(230)) / 10.0).alias("cx"),
        (F.lit(38.05) + F.pmod(s * 53, F.lit(110)) / 10.0).alias("cy"),
        (F.lit(0.25) + F.pmod(s, F.lit(7)) / 10.0).alias("r"),
    )


STAR = ((1.0, 0.0), (0.4, 0.4), (0.0, 1.0), (-0.4, 0.4), (-1.0, 0.0), (-0.4, -0.4), (0.0, -1.0), (0.4, -0.4))
SQUARE = ((1.0, 1.0), (-1.0, 1.0), (-1.0, -1.0), (1.0, -1.0))
HOLE = ((0.2, 0.0), (0.0, 0.2), (-0.2, 0.0), (0.0, -0.2))
LAKE_NAMES = ("Superior", "Michigan", "Huron", "Erie", "Ontario")


def parts(spark, sf_dir) -> DataFrame:
    """supplier -> raw polygon parts: stars with a hole (even keys) and squares (odd keys)."""
    c = _centres(spark, sf_dir)

    def ring(offsets):
        return F.array(*[
            F.struct((F.col("cx") + F.col("r") * dx).alias("x"), (F.col("cy") + F.col("r") * dy).alias("y"))
            for dx, dy in offsets
        ])

    base = F.element_at(F.array(*[F.lit(n) for n in LAKE_NAMES]), F.pmod("s_nationkey", F.lit(5)).cast("int") + 1)
    kind = F.pmod("part", F.lit(8))
    country = F.pmod("part", F.lit(3))
    return c.select(
        F.col("part").alias("Hylak_id"), "part",
        F.when(kind == 5, F.upper(base)).when(kind == 6, F.concat(F.lit("Lake "), base))
        .when(kind == 7, F.lit(None).cast("string")).otherwise(base).alias("Lake_name"),
        F.when(country == 0, "United States of America").when(country == 1, "Canada").alias("Country"),
        F.lit(4326).alias("srid"),
        F.when(F.col("part") % 2 == 0, F.array(ring(STAR), ring(HOLE))).otherwise(F.array(ring(SQUARE))).alias("rings"),
    )


def polygons(spark, sf_dir) -> DataFrame:
    """One lake per supplier: lake_id, lake_name, part, srid, rings."""
    return parts(spark, sf_dir).select(
        F.concat(F.lit("L-"), F.col("part")).alias("lake_id"), F.col("Lake_name").alias("lake_name"),
        "part", "srid", "rings",
    )


def halves(spark, sf_dir) -> DataFrame:
    """supplier -> a square lake in two parts that share an edge."""
    c = _centres(spark, sf_dir)

    def ring(x0, x1):
        return F.array(*[
            F.struct((F.col("cx") + F.col("r") * dx).alias("x"), (F.col("cy") + F.col("r") * dy).alias("y"))
            for dx, dy in ((x1, 1.0), (x0, 1.0), (x0, -1.0), (x1, -1.0))
        ])

    one = c.select("*", F.posexplode(F.array(F.array(ring(-1.0, 0.0)), F.array(ring(0.0, 1.0)))).alias("half", "rings"))
    return one.select(
        F.concat(F.lit("L-"), F.col("part")).alias("lake_id"), F.lit("Half").alias("lake_name"),
        (F.col("part") * 2 + F.col("half")).alias("part"), F.lit(4326).alias("srid"), "rings",
    )


# A lake's parts as corners (x0, y0, x1, y1) of rectangles: edges that touch in part, parts that
# overlap, parts that cross.
PATCHES = (
    ((-1.0, -1.0, 0.0, 1.0), (0.0, -1.0, 1.0, 0.25), (0.0, 0.25, 1.0, 1.0)),
    ((-1.0, -1.0, 0.3, 1.0), (-0.2, -1.0, 1.0, 1.0), (-0.5, -0.5, 0.5, 0.5)),
    ((-1.0, -0.5, 1.0, 0.5), (-0.5, -1.0, 0.5, 1.0), (0.5, 0.5, 1.0, 1.0)),
)


def patches(spark, sf_dir) -> DataFrame:
    """supplier -> a lake of three rectangles that touch, overlap or cross, by supplier number."""
    c = _centres(spark, sf_dir)

    def ring(x0, y0, x1, y1):
        return F.array(*[
            F.struct((F.col("cx") + F.col("r") * dx).alias("x"), (F.col("cy") + F.col("r") * dy).alias("y"))
            for dx, dy in ((x1, y1), (x0, y1), (x0, y0), (x1, y0))
        ])

    kinds = [F.array(*[F.array(ring(*p)) for p in kind]) for kind in PATCHES]
    own = F.when(F.col("part") % 3 == 0, kinds[0]).when(F.col("part") % 3 == 1, kinds[1]).otherwise(kinds[2])
    return c.select("part", F.posexplode(own).alias("no", "rings")).select(
        F.concat(F.lit("L-"), F.col("part")).alias("lake_id"), F.lit("Patches").alias("lake_name"),
        (F.col("part") * 3 + F.col("no")).alias("part"), F.lit(4326).alias("srid"), "rings",
    )


def index_value():
    """Order totals scaled to the size of index readings, by an odd factor so that no mean
    lands on a rounding tie."""
    return F.col("o_totalprice") / 3.7234567e8


def obs(spark, sf_dir) -> DataFrame:
    """orders x customer -> lake observations, one row per segment and day."""
    o = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return o.groupBy(F.col("c_mktsegment").alias("lake_id"), F.to_date("o_orderdate").alias("date")).agg(
        F.avg(index_value()).alias("CI_mean"), F.max(index_value()).alias("CI_p90"),
        F.count("*").alias("n_valid"),
    )


def obs_full(spark, sf_dir) -> DataFrame:
    """The same with product, src and reader columns, and a date made of text."""
    return obs(spark, sf_dir).select(
        "lake_id", F.col("date").cast("string").alias("date"), F.lit("daily").alias("product"),
        "CI_mean", "CI_p90", "n_valid", daily_name("date", F.lit("CONUS")).alias("src"),
        F.lit("table").alias("engine"),
    )


def expected(spark, sf_dir) -> DataFrame:
    """nation x customer: expected pixels per segment, small enough to flag something."""
    c = table(spark, sf_dir, "customer")
    return c.groupBy(F.col("c_mktsegment").alias("lake_id")).agg(
        (F.count("*") * 1000.0).alias("area_m2"),
        (F.bround(F.count("*") / 30.0) + 2).cast("bigint").alias("expected_pixels_geom"),
    ).withColumn("lake_name", F.initcap("lake_id"))


def climate_long(spark, sf_dir) -> DataFrame:
    """events -> (lake, day, variable, value), a fifth of the values missing."""
    e = table(spark, sf_dir, "events")
    kinds = {"click": "tmin", "view": "tmax", "purchase": "prcp", "signup": "srad"}
    var = F.when(F.col("event_id") % 2 == 0, "dayl").otherwise("vp")
    for kind, v in kinds.items():
        var = F.when(F.col("event_type") == kind, v).otherwise(var)
    lake = F.pmod("user_id", F.lit(5))
    rows = e.select(
        F.concat(F.lit("GL-"), (lake + 1).cast("string")).alias("lake_id"),
        F.concat(F.lit("Lake "), (lake + 1).cast("string")).alias("lake_name"),
        F.to_date("ts").alias("date"), var.alias("var"), "value",
    )
    known = F.when((F.day("date") + lake_no() * 3 + F.length("var")) % 5 != 0, F.col("value"))
    return rows.groupBy("lake_id", "lake_name", "date", "var").agg(F.avg(known).alias("value"))


def lake_no():
    return F.substring("lake_id", 4, 9).cast("int")


def climate_wide(spark, sf_dir) -> DataFrame:
    from limnia.operators.merge import outer_pivot

    return outer_pivot(climate_long(spark, sf_dir), ["lake_id", "lake_name", "date"], CLIMATE)


def climate_orders(spark, sf_dir) -> DataFrame:
    """orders x customer -> daily climate over seven years, one variable per order priority, the last in two."""
    o = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    kind = F.substring("o_orderpriority", 1, 1).cast("int")
    kind = F.when((kind == 5) & (F.col("o_orderkey") % 2 == 0), 6).otherwise(kind)
    return o.groupBy(F.col("c_mktsegment").alias("lake_id"), F.to_date("o_orderdate").alias("date")).agg(*[
        F.avg(F.when(kind == i + 1, F.col("o_totalprice") / 3.7234567e4)).alias(v) for i, v in enumerate(CLIMATE)
    ])


def obs_events(spark, sf_dir) -> DataFrame:
    """events -> valid/invalid observations, stamped within the day or, every third day, at midnight."""
    e = table(spark, sf_dir, "events")
    lake = F.concat(F.lit("GL-"), (F.pmod("user_id", F.lit(5)) + 1).cast("string"))
    return e.groupBy(lake.alias("lake_id"), F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("date"), F.avg("value").alias("CI_mean"), F.count("*").alias("n_valid")
    ).withColumn("date", F.when(F.day("day") % 3 == 0, F.col("day").cast("timestamp_ntz")).otherwise(F.col("date").cast("timestamp_ntz"))).withColumn("qc_is_valid", (F.day("day") % 4 != 0).cast("int")).drop("day")


def file_records(spark, sf_dir) -> DataFrame:
    """orders -> one file per order, with attributes that are present, broken or absent."""
    o = table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    month = F.col("o_orderkey") % 2 == 0
    p = F.substring("o_orderpriority", 1, 1)
    last = F.date_format(F.last_day(d), "yyyyMMdd")
    name = F.when(
        month,
        F.concat(F.lit("/data/S3B_OLCI_EFRNT."), F.date_format(F.trunc(d, "MM"), "yyyyMMdd"), F.lit("_"), last,
                 F.lit(".L3m.MO.ILW_CONUS.V5.all.CONUS.300m.nc")),
    ).otherwise(F.concat(F.lit("/data/"), daily_name(d, F.lit("CONUS"))))
    return o.select(
        "o_orderkey", name.alias("src"), F.when(month, "monthly").otherwise("daily").alias("product"),
        F.when(p == "1", F.concat(d.cast("string"), F.lit("T06:30:00.25Z"))).alias("time0"),
        F.when(p == "2", F.concat(d.cast("string"), F.lit(" 00:00:01+00:00")))
        .when(p == "3", d.cast("string")).when(p == "4", "not a date").alias("start"),
        F.when(p.isin("2", "4"), F.concat(F.date_add(d, 9).cast("string"), F.lit("T23:59:58")))
        .alias("end"),
    )
