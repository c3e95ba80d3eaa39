"""Registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapters as ad
from limnia.functions import flags as fl
from limnia.functions import timelabel as tl
from limnia.functions.cleaning import clean_index, near_zero_threshold
from limnia.functions.text import basename, display_label, mentions_any
from limnia.operators import merge, numbering, resample, schema, series, spatial, summary, zonal
from limnia.session import materialise, scratch_path
from limnia.plans import catalogue, climate, extraction, features, feeds, quality
from limnia.sources import files as src_files
from limnia.sources import manifest, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    """Register ``fn`` and present its times as text, so both engines print them alike."""

    def run(spark, sf_dir):
        out = fn(spark, sf_dir)
        text = {}
        for name, t in out.dtypes:
            if t == "date":
                text[name] = F.date_format(name, "yyyy-MM-dd")
            elif t.startswith("timestamp"):
                text[name] = F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return out.withColumns(text) if text else out

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def rounded(df: DataFrame, places: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


# --- index extraction ---------------------------------------------------------------


def _daily(spark, sf_dir):
    return extraction.daily_observations(
        ad.pixels(spark, sf_dir), ad.boxes(spark, sf_dir), ad.files(spark, sf_dir),
        valid_min=ad.VALID_MIN, valid_max=ad.VALID_MAX,
    )


@query
def zonal_daily(spark, sf_dir):
    """Daily lake observations, lakes without a valid pixel included."""
    return rounded(_daily(spark, sf_dir), 9, "CI_mean", "CI_p90")


@query
def zonal_tiled(spark, sf_dir):
    """Statistics per lake from pixels laid out by place, of which only the lakes' tiles are read."""
    path = scratch_path(spark)
    tables.write_pixels(extraction.clean_pixels(ad.pixels(spark, sf_dir), "CI_cyano", ad.VALID_MIN, ad.VALID_MAX), path)
    boxes = materialise(ad.boxes(spark, sf_dir).where("lake_id <> 'GL-3'"))
    near = tables.near_boxes(spark.read.parquet(path), boxes).withColumn("product", F.lit("all"))
    return rounded(zonal.zonal_stats(near, boxes, "CI_cyano", ["product"]), 9, "CI_mean", "CI_p90")


@query
def zonal_many_lakes(spark, sf_dir):
    """Statistics over all days for one small box per supplier: the grid-cell range join."""
    px = extraction.clean_pixels(ad.pixels(spark, sf_dir), "CI_cyano", ad.VALID_MIN, ad.VALID_MAX)
    out = zonal.zonal_stats(px.withColumn("product", F.lit("all")), ad.many_boxes(spark, sf_dir),
                            "CI_cyano", ["product"])
    return rounded(out, 9, "CI_mean", "CI_p90")


@query
def regional_daily(spark, sf_dir):
    out = extraction.regional_series(
        ad.pixels(spark, sf_dir), ad.files(spark, sf_dir), "daily",
        valid_min=ad.VALID_MIN, valid_max=ad.VALID_MAX,
    )
    return rounded(out, 9, "CI_mean", "CI_p90")


@query
def regional_readers(spark, sf_dir):
    """Regional days of files served by two readers; every fifth day no reader could open its file."""
    files = ad.files(spark, sf_dir)
    day = F.day(tl.name_dates("src", "daily")[0])
    engine = F.when(day % 5 == 0, F.lit(None).cast("string")).when(day % 2 == 0, "primary").otherwise("fallback")
    out = extraction.regional_series(
        ad.pixels(spark, sf_dir), files.withColumn("engine", engine), "daily", valid_min=ad.VALID_MIN, valid_max=ad.VALID_MAX
    )
    return rounded(out, 9, "CI_mean", "CI_p90")


@query
def regional_monthly(spark, sf_dir):
    """The pixels of a month as one file: large groups, mid-month labels."""
    px = ad.pixels(spark, sf_dir).withColumn("src", manifest.monthly_name("date", F.lit("CONUS"), "S3B"))
    out = extraction.regional_series(
        px, materialise(px.select("src").distinct()), "monthly", valid_min=ad.VALID_MIN, valid_max=ad.VALID_MAX
    )
    return rounded(out, 9, "CI_mean", "CI_p90")


@query
def zonal_monthly(spark, sf_dir):
    """Monthly lake observations: bounds and time span from each file's attributes, large groups."""
    px = ad.pixels(spark, sf_dir).withColumn("src", manifest.monthly_name("date", F.lit("CONUS"), "S3B"))
    month = F.substring("src", 20, 2).cast("int")
    first = F.concat_ws("-", F.substring("src", 16, 4), F.substring("src", 20, 2), F.lit("01"))
    dated = month % 3 == 0
    files = materialise(px.select("src").distinct()).withColumn("attrs", F.create_map(
        F.lit("valid_min"), F.lit("0"), F.lit("valid_max"), F.when(month % 2 == 1, "0.004").otherwise("0.005"),
        F.lit("time_coverage_start"), F.lit(""), F.lit("start_time"), F.when(dated, first),
        F.lit("time_coverage_end"), F.when(dated, F.concat(F.last_day(first).cast("string"), F.lit("T12:00:00Z"))),
    ))
    out = extraction.extract_lakes(px, ad.boxes(spark, sf_dir), files, "monthly")
    return rounded(out, 9, "CI_mean", "CI_p90")


@query
def index_cleaning(spark, sf_dir):
    """How many readings survive each bound, per day; single precision and, on the bounds, double."""
    px = ad.pixels(spark, sf_dir)
    v = clean_index("CI_cyano", ad.VALID_MIN, ad.VALID_MAX)
    floor_only = clean_index("CI_cyano")
    high_floor = clean_index("CI_cyano", 2e-3, None)
    out = px.groupBy("date").agg(
        F.count("*").alias("n_all"), F.count(floor_only).alias("n_floor"), F.count(v).alias("n_kept"),
        F.count(high_floor).alias("n_high"),
        F.round(F.max(near_zero_threshold(1e-3).cast("double")), 9).alias("threshold"),
    )
    li = ad.table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("date"), (F.col("l_quantity").cast("double") * 5e-5).alias("wide")
    )
    wide = li.groupBy("date").agg(
        F.count(clean_index("wide")).alias("n_wide_floor"), F.count(clean_index("wide", 1e-3, 2e-3)).alias("n_wide_kept")
    )
    return out.join(wide, "date")


# --- time ---------------------------------------------------------------------------


@query
def time_labels(spark, sf_dir):
    """Label of every file: own time, then coverage attributes, then name."""
    f = ad.file_records(spark, sf_dir)
    cols = [F.col(c) for c in ("time0", "start", "end")]
    label = F.when(F.col("product") == "monthly", tl.time_label("src", "monthly", *cols)).otherwise(
        tl.time_label("src", "daily", *cols)
    )
    return f.select("o_orderkey", basename("src").alias("file"), label.cast("timestamp_ntz").alias("label"))


@query
def filename_dates(spark, sf_dir):
    """Files per month found by name dates alone, with the midpoint of the name's span."""
    f = ad.file_records(spark, sf_dir)
    (a, b), (day, _) = tl.name_dates("src", "monthly"), tl.name_dates("src", "daily")
    first, last = F.coalesce(a, day), F.coalesce(b, day)
    return f.select(first.alias("first"), last.alias("last"), tl.midpoint(first, last).alias("middle")).groupBy(
        "first", "last", "middle"
    ).agg(F.count("*").alias("n_files"))


@query
def period_snap(spark, sf_dir):
    """Event counts per day, week, month and quarter start."""
    e = ad.table(spark, sf_dir, "events")
    return e.groupBy(
        tl.period_start("ts", "D").alias("day"), tl.period_start("ts", "W").alias("week"),
        tl.period_start("ts", "MS").alias("month"), tl.period_start("ts", "Q").alias("quarter"),
    ).agg(F.count("*").alias("n"))


# How event times are written as text, in turns; the last two can't be read.
TEXT_TIMES = (
    "yyyy-MM-dd HH:mm:ss'.5+00:00'", "yyyy-MM-dd", "MM/dd/yyyy", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyyMMdd",
    "M/d/yyyy", "MMMM d, yyyy", "yyyy-MM-dd h:mm a", "dd-MMM-yyyy", "MMM d yyyy", "yyyyMMdd'T'HHmmss", "yyyyMMdd HH:mm",
    "yyyy/MM/dd HH:mm", "yyyy.MM.dd", "M/d/yyyy H:mm", "MMM d, yyyy HH:mm", "EEE MMM d yyyy", "MMM yyyy", "yyyyMMddHHmmss",
    "M/d/yy", "EEEE, MMMM d, yyyy", "MM-dd-yyyy", "h:mm a d MMM yyyy", "EEE, dd MMM yyyy HH:mm:ss 'GMT'",
    "yyyy-MM-dd HH:mm:ss'+02:00'", "'junk'", None,
)


def _texts(spark, sf_dir):
    kind = F.pmod("event_id", F.lit(len(TEXT_TIMES)))
    text = F.lit(None).cast("string")
    for i, form in enumerate(TEXT_TIMES):
        if form:
            text = F.when(kind == i, F.date_format("ts", form)).otherwise(text)
    return ad.table(spark, sf_dir, "events").select("event_id", text.alias("obs_time"))


@query
def lenient_datetime(spark, sf_dir):
    """Mixed date text; unreadable rows dropped."""
    return schema.ensure_date(_texts(spark, sf_dir)).select("event_id", "date")


@query
def dropped_datetime(spark, sf_dir):
    return schema.rejected_dates(_texts(spark, sf_dir))


# --- regular series -----------------------------------------------------------------


def _orders_raw(spark, sf_dir):
    o = ad.table(spark, sf_dir, "orders").join(
        ad.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return o.select(F.col("c_mktsegment").alias("series"), F.col("o_orderdate").alias("date"),
                    F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("src"))


@query
def dedupe_first(spark, sf_dir):
    """First order of each segment and month, by time then key."""
    out = series.first_per_period(_orders_raw(spark, sf_dir), ["series"], "MS", tie=["src"])
    return out.select("series", "date", "src", "value")


@query
def reindex_daily(spark, sf_dir):
    s = ad.obs(spark, sf_dir)
    out = series.fill_calendar(s, ["lake_id"], "D").select("lake_id", "date", "CI_mean", "n_valid")
    return rounded(out, 11, "CI_mean").withColumn("n_valid", F.col("n_valid").cast("double"))


@query
def reindex_monthly(spark, sf_dir):
    """Months of each customer's orders, empty ones included."""
    o = ad.table(spark, sf_dir, "orders")
    m = o.groupBy(F.col("o_custkey").alias("series"), F.trunc("o_orderdate", "MM").alias("date")).agg(
        F.round(F.max("o_totalprice"), 2).alias("top")
    )
    return series.fill_calendar(m, ["series"], "MS")


@query
def calendar_days(spark, sf_dir):
    """The plain calendar of each series."""
    return series.calendar_spine(ad.obs(spark, sf_dir).select("lake_id", "date"), ["lake_id"], "D")


def _interp(spark, sf_dir, limit):
    # values blanked by date so that gaps of many lengths occur
    known = F.pmod(F.dayofyear("date") * 7, F.lit(11)) < 5
    s = ad.obs(spark, sf_dir).withColumns({c: F.when(known, F.col(c)) for c in ("CI_mean", "CI_p90")})
    full = series.fill_calendar(s, ["lake_id"], "D")
    out = series.interpolate_short_gaps(full, ["lake_id"], ["CI_mean", "CI_p90"], limit)
    return rounded(out.select("lake_id", "date", "CI_mean", "CI_p90"), 11, "CI_mean", "CI_p90")


@query
def interp_limit3(spark, sf_dir):
    return _interp(spark, sf_dir, 3)


@query
def interp_limit1(spark, sf_dir):
    return _interp(spark, sf_dir, 1)


@query
def clip_global(spark, sf_dir):
    li = ad.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    out = series.clip_quantiles(li, [], ["l_extendedprice"])
    return rounded(out, 6, "l_extendedprice")


@query
def clip_per_lake(spark, sf_dir):
    o = _orders_raw(spark, sf_dir)
    return rounded(series.clip_quantiles(o, ["series"], ["value"]).select("series", "src", "value"), 6, "value")


def _regional(spark, sf_dir):
    known = F.pmod(F.dayofyear("date") * 7, F.lit(11)) < 8
    s = ad.obs(spark, sf_dir).withColumns({c: F.when(known, F.col(c)) for c in ("CI_mean", "CI_p90", "n_valid")})
    return quality.regional_quality(s, "D", series="lake_id")


@query
def regional_quality_daily(spark, sf_dir):
    out = rounded(_regional(spark, sf_dir), 11, "CI_mean", "CI_p90")
    return out.withColumn("n_valid", F.col("n_valid").cast("double"))


@query
def regional_quality_summary(spark, sf_dir):
    return summary.missing_summary(_regional(spark, sf_dir), "regional_daily")


@query
def rolling_centre7(spark, sf_dir):
    out = series.centred_mean(ad.obs(spark, sf_dir), ["lake_id"], {"CI_mean_7": "CI_mean", "CI_p90_7": "CI_p90"})
    return rounded(out.select("lake_id", "date", "CI_mean_7", "CI_p90_7"), 11, "CI_mean_7", "CI_p90_7")


# --- lake quality -------------------------------------------------------------------


def _quality(spark, sf_dir):
    return quality.lake_quality(
        ad.obs_full(spark, sf_dir), ad.expected(spark, sf_dir), min_pct_geom=0.05, min_pct_emp=0.3, min_abs_pix=2
    )


def _stored_quality(spark, sf_dir):
    """The cleaned lake table as the chart and summary steps meet it: already written."""
    return materialise(_quality(spark, sf_dir))


@query
def lake_quality(spark, sf_dir):
    out = rounded(rounded(_quality(spark, sf_dir), 11, "CI_mean", "CI_p90"), 6, "pct_valid_geom", "pct_valid_emp")
    return out.drop("engine", "product")


@query
def lake_quality_summary(spark, sf_dir):
    return rounded(summary.quality_summary(_stored_quality(spark, sf_dir)), 6, "pct_valid_geom_med", "pct_valid_emp_med")


@query
def lake_counts(spark, sf_dir):
    return summary.lake_counts(_stored_quality(spark, sf_dir))


@query
def count_column_choice(spark, sf_dir):
    """``n_valid`` is all zero, so the first alias with positive counts takes its place."""
    s = ad.obs(spark, sf_dir).withColumns({"num_valid": F.col("n_valid"), "n_valid": F.lit(0)})
    out = schema.choose_count_column(s.withColumn("valid_count", F.lit(0)))
    return out.groupBy("lake_id").agg(F.sum("n_valid").cast("bigint").alias("pixels"))


@query
def value_presence(spark, sf_dir):
    """Which variables each lake has at all, and on how many days."""
    c = ad.climate_wide(spark, sf_dir)
    has = series.any_value_present(c, ["lake_id"], ad.CLIMATE)
    days = c.groupBy("lake_id").agg(F.count("*").alias("days"))
    return merge.left_attributes(days, has).select(
        "lake_id", "days", *[F.col(f"has_{v}").cast("int").alias(f"has_{v}") for v in ad.CLIMATE]
    )


# --- climate ------------------------------------------------------------------------

_KEYS = ["lake_id", "lake_name", "date"]


@query
def climate_outer(spark, sf_dir):
    """Six variable tables, fully outer merged one after the other."""
    long = ad.climate_long(spark, sf_dir)
    tables = [long.where(F.col("var") == v).select(*_KEYS, F.col("value").alias(v)) for v in ad.CLIMATE]
    return rounded(merge.outer_merge(tables, _KEYS), 9, *ad.CLIMATE)


@query
def climate_pivot(spark, sf_dir):
    return rounded(ad.climate_wide(spark, sf_dir), 9, *ad.CLIMATE)


def _resampled(name):
    def run(spark, sf_dir):
        out = climate.resampled_climate(ad.climate_orders(spark, sf_dir), ad.CLIMATE)[name]
        return rounded(out, 8, *ad.CLIMATE)

    return run


for _name, _table in (("resample_7d", "weekly_7D"), ("resample_wmon", "weekly_W-MON"),
                      ("rolling_28d", "roll28"), ("resample_month", "monthly")):
    _fn = _resampled(_table)
    _fn.__name__ = _name
    query(_fn)


@query
def rolling_1970(spark, sf_dir):
    """The 28-day means of the same series moved back over 1970."""
    moved = ad.climate_orders(spark, sf_dir).withColumn("date", F.date_sub("date", 9500))
    return rounded(climate.resampled_climate(moved, ad.CLIMATE)["roll28"], 8, *ad.CLIMATE)


@query
def lake_pixels_mean(spark, sf_dir):
    """Climate-style means over the pixels inside each polygon, all variables in one pass."""
    cube = ad.pixels(spark, sf_dir).select(
        "y", "x", F.trunc("date", "MM").alias("date"),
        F.when(F.col("x") % 2 == 0, "tmin").otherwise("tmax").alias("var"), F.col("CI_cyano").alias("value"),
    )
    out = climate.lake_climate(cube, ad.grid(spark, sf_dir), ad.polygons(spark, sf_dir), ("tmin", "tmax"))
    out = out.select("lake_id", "lake_name", F.to_date("date").alias("date"), "tmin", "tmax")
    return rounded(out, 9, "tmin", "tmax")


@query
def zonal_polygon(spark, sf_dir):
    """Index statistics with true lake shapes, one file per year."""
    px = ad.pixels(spark, sf_dir).withColumn("src", F.year("date").cast("string"))
    years = px.select("src").distinct().withColumn("time0", F.concat("src", F.lit("-07-01")))
    out = extraction.extract_lakes_by_polygon(
        px, ad.polygons(spark, sf_dir), ad.grid(spark, sf_dir), years, "daily", valid_min=ad.VALID_MIN, valid_max=ad.VALID_MAX
    )
    return rounded(out.select("src", "lake_id", "CI_mean", "CI_p90", "n_valid"), 9, "CI_mean", "CI_p90")


# --- features -----------------------------------------------------------------------


def _features(spark, sf_dir, align):
    out = features.daily_features(ad.obs_events(spark, sf_dir), ad.climate_wide(spark, sf_dir), ad.CLIMATE, align)
    return rounded(out, 9, "CI_mean", *ad.CLIMATE)


@query
def features_daily(spark, sf_dir):
    return _features(spark, sf_dir, "day")


@query
def features_exact(spark, sf_dir):
    """Equal time stamps only: observations stamped at midnight match, others stay without climate."""
    return _features(spark, sf_dir, "exact")


@query
def features_monthly(spark, sf_dir):
    """Monthly observations labelled mid-month against month-start climate."""
    obs = ad.obs(spark, sf_dir).groupBy("lake_id", F.trunc("date", "MM").alias("m")).agg(
        F.avg("CI_mean").alias("CI_mean"), F.sum("n_valid").alias("n_valid")
    )
    obs = obs.select("lake_id", F.date_add("m", 14).alias("date"), "CI_mean", "n_valid",
                     (F.col("n_valid") % 3 != 0).cast("int").alias("qc_is_valid"))
    month = resample.monthly(ad.climate_orders(spark, sf_dir), ad.CLIMATE)
    return rounded(rounded(features.monthly_features(obs, month, ad.CLIMATE), 11, "CI_mean"), 8, *ad.CLIMATE)


@query
def valid_row_counts(spark, sf_dir):
    return features.valid_counts(_stored_quality(spark, sf_dir))


# --- polygons -----------------------------------------------------------------------


@query
def points_in_polygon(spark, sf_dir):
    """Grid pixels strictly inside each polygon."""
    return spatial.lake_pixels(ad.grid(spark, sf_dir), ad.polygons(spark, sf_dir))


@query
def inset_membership(spark, sf_dir):
    """Grid pixels at least 5 km from the shore."""
    return spatial.lake_pixels(ad.grid(spark, sf_dir), ad.polygons(spark, sf_dir), inset_m=5000.0)


@query
def touching_parts(spark, sf_dir):
    """Grid pixels inside lakes of two touching parts, without and with an inset of 5 km."""
    grid, lakes = ad.grid(spark, sf_dir), ad.halves(spark, sf_dir)
    both = [spatial.lake_pixels(grid, lakes, d).withColumn("inset_km", F.lit(d / 1000)) for d in (0.0, 5000.0)]
    return both[0].unionByName(both[1])


@query
def overlapping_parts(spark, sf_dir):
    """Grid pixels inside lakes of parts that touch in part of an edge, overlap or cross, without and with an inset of 5 km."""
    grid, lakes = ad.grid(spark, sf_dir), ad.patches(spark, sf_dir)
    both = [spatial.lake_pixels(grid, lakes, d).withColumn("inset_km", F.lit(d / 1000)) for d in (0.0, 5000.0)]
    return both[0].unionByName(both[1])


@query
def united_area(spark, sf_dir):
    """Area and expected pixels of lakes whose parts touch, overlap or cross."""
    out = spatial.expected_pixel_table(ad.patches(spark, sf_dir))
    return out.select("lake_id", "expected_pixels_geom", F.round(F.col("area_m2") / 1e6, 3).alias("area_km2"))


@query
def inset_chain(spark, sf_dir):
    """Study lakes, then expected pixels and member pixels inside the inset that their table states."""
    cand = catalogue.candidate_lakes(ad.parts(spark, sf_dir))
    lakes = materialise(catalogue.study_lakes(cand, strict=False, step_m=500.0, inset_m=3000.0))
    expected = spatial.expected_pixel_table(lakes, pix_res_m=5000.0, step_m=500.0)
    members = spatial.lake_pixels(ad.grid(spark, sf_dir), lakes).groupBy("lake_id").agg(F.count("*").alias("members"))
    return expected.join(members, "lake_id", "left").select("lake_id", "lake_name", "expected_pixels_geom", "members")


@query
def polygon_bounds(spark, sf_dir):
    return rounded(spatial.bounds(spatial.edges(ad.polygons(spark, sf_dir))), 9, "minx", "miny", "maxx", "maxy")


@query
def projected_bounds(spark, sf_dir):
    """Bounds in equal-area metres."""
    b = spatial.bounds(spatial.edges_in_metres(spatial.edges(ad.polygons(spark, sf_dir))))
    return rounded(b, 3, "minx", "miny", "maxx", "maxy")


@query
def expected_pixels(spark, sf_dir):
    out = spatial.expected_pixel_table(ad.polygons(spark, sf_dir))
    return out.withColumn("area_km2", F.round(F.col("area_m2") / 1e6, 3)).drop("area_m2")


@query
def inset_area(spark, sf_dir):
    """Area left inside a 2 km inset, by scan lines 200 m apart."""
    out = spatial.lake_area(ad.polygons(spark, sf_dir), inset_m=2000.0, step_m=200.0)
    return out.select("lake_id", F.round(F.col("area_m2") / 1e6, 3).alias("area_km2"))


@query
def inset_boxes(spark, sf_dir):
    """Bounds in degrees of what a 2 km inset leaves of each lake."""
    out = spatial.lake_boxes(ad.polygons(spark, sf_dir), inset_m=2000.0, step_m=500.0)
    return rounded(out, 6, "minx", "miny", "maxx", "maxy")


@query
def box_intersects(spark, sf_dir):
    return spatial.intersects_box(ad.polygons(spark, sf_dir), -92.0, 41.0, -84.0, 46.0)


@query
def lake_candidates(spark, sf_dir):
    out = catalogue.candidate_lakes(ad.parts(spark, sf_dir))
    return out.select("Hylak_id", "Lake_name", "Country")


@query
def lake_union_first(spark, sf_dir):
    """Country branch before box branch, first branch wins."""
    p = ad.parts(spark, sf_dir)
    home = p.where("Country LIKE 'United States%'").select("Hylak_id", F.lit("country").alias("why"))
    touch = spatial.intersects_box(p, *catalogue.STUDY_BOX, key="Hylak_id").withColumn("why", F.lit("box"))
    return merge.union_first_wins([home, touch], "Hylak_id")


@query
def study_lakes(spark, sf_dir):
    """The chosen lakes: ids in listed order, parts and outlines after dissolving."""
    cand = catalogue.candidate_lakes(ad.parts(spark, sf_dir))
    lakes = catalogue.study_lakes(cand, strict=False, step_m=500.0, inset_m=300.0)
    n = lakes.groupBy("lake_id", "lake_name").agg(
        F.count("*").alias("parts"), F.min("part").alias("first_part"), F.max("inset_m").alias("inset_m")
    )
    return n


@query
def lake_labels(spark, sf_dir):
    """Id and first name per segment, as a chart label."""
    q = _stored_quality(spark, sf_dir)
    names = merge.first_name_per_id(q, "lake_id", "lake_name", "date")
    return names.select("lake_id", display_label("lake_id", "lake_name").alias("label"))


@query
def name_search(spark, sf_dir):
    """Parts whose name mentions a listed lake in any spelling."""
    p = ad.parts(spark, sf_dir).where(mentions_any("Lake_name", ["superior", "erie"]))
    return p.groupBy("Lake_name").agg(F.count("*").alias("n"))


# --- manifests and files ------------------------------------------------------------


def _spans(spark, sf_dir):
    o = ad.table(spark, sf_dir, "orders")
    region = F.when(F.col("o_orderkey") % 2 == 0, "CONUS").otherwise("ALASKA")
    return o.groupBy(region.alias("region")).agg(
        F.to_date(F.min("o_orderdate")).alias("start"), F.to_date(F.max("o_orderdate")).alias("end")
    )


@query
def manifest_daily(spark, sf_dir):
    """A file name per day and region over the span of the orders, end day excluded."""
    return manifest.expected_daily(_spans(spark, sf_dir))


@query
def manifest_monthly(spark, sf_dir):
    spans = _spans(spark, sf_dir).select(
        "region", F.year("start").alias("year1"), F.year("end").alias("year2"),
        F.lit(3).alias("month1"), F.lit(10).alias("month2"),
    )
    return manifest.expected_monthly(spans, "S3B")


def _listing(spark, sf_dir):
    """Days with pixels as present files; a file whose pixels are all missing is empty."""
    px = ad.pixels(spark, sf_dir)
    return px.groupBy("src").agg(F.count(clean_index("CI_cyano", ad.VALID_MIN, 1e-3)).alias("length"))


@query
def manifest_audit(spark, sf_dir):
    """skip / get / miss for every expected day; odd days can be fetched."""
    expected = manifest.expected_daily(_spans(spark, sf_dir))
    remote = expected.where(F.day("date") % 2 == 1).select("src")
    return src_files.audit_files(expected, _listing(spark, sf_dir), remote).select("src", "date", "action")


@query
def manifest_missing(spark, sf_dir):
    expected = manifest.expected_daily(_spans(spark, sf_dir))
    return src_files.missing_files(expected, _listing(spark, sf_dir)).select("src", "date")


@query
def url_names(spark, sf_dir):
    """File name of every page URL, split where it has the climate product's shape.

    Half of the pages have a climate file below them, daily or monthly.
    """
    u = ad.table(spark, sf_dir, "pages").select("page_id", "url")
    var = F.element_at(F.array(*map(F.lit, ("tmin", "vp", "prcp"))), F.pmod("page_id", F.lit(3)).cast("int") + 1)
    kind = F.pmod("page_id", F.lit(4))
    below = F.when(kind == 0, F.concat(F.lit("/daymet_v4_daily_na_"), var, F.lit("_2024.nc?a=b"))).when(
        kind == 1, F.concat(F.lit("/daymet_v4_"), var, F.lit("_monavg_hi_2023.tif"))
    )
    out = manifest.url_manifest(u.withColumn("url", F.concat("url", F.coalesce(below, F.lit("")))))
    return out.drop("url").withColumn("year", F.col("year").cast("double"))


@query
def reader_status(spark, sf_dir):
    """Pixels of readable files only, with the reader that served them."""
    px = ad.pixels(spark, sf_dir)
    day = F.day(tl.name_dates("src", "daily")[0])
    engine = F.when(day % 5 == 0, F.lit(None).cast("string")).when(day % 2 == 0, "primary").otherwise("fallback")
    status = materialise(ad.files(spark, sf_dir).withColumn("engine", engine))
    out = src_files.readable_only(px, status)
    return out.groupBy("engine", F.year("date").alias("year")).agg(F.count("*").alias("pixels"))


# --- summaries and chart tables -----------------------------------------------------


@query
def file_audit(spark, sf_dir):
    """Per file and reader: dates, rows, lakes. Files are months here, so ranges occur."""
    rows = ad.obs(spark, sf_dir).select(
        "lake_id", "date", F.date_format("date", "yyyyMM").alias("src"),
        F.when(F.col("n_valid") > 2, "primary").otherwise("fallback").alias("engine"),
    )
    return summary.file_audit(rows)


@query
def table_profile(spark, sf_dir):
    c = ad.table(spark, sf_dir, "orders").select("o_totalprice", "o_orderpriority", "o_orderstatus", "o_orderdate", "o_custkey")
    out = rounded(summary.profile(c), 5, "mean", "std", "min", "p25", "p50", "p75", "max")
    return out.withColumns({c: F.col(c).cast("double") for c in ("unique", "freq")})


@query
def chart_regional(spark, sf_dir):
    return rounded(feeds.regional_daily_feed(_regional(spark, sf_dir), "lake_id"), 11, "CI_mean", "CI_mean_7", "CI_p90_7")


@query
def chart_regional_monthly(spark, sf_dir):
    m = ad.obs(spark, sf_dir)
    m = quality.regional_quality(m, "MS", series="lake_id", tie=("CI_mean",))
    return rounded(feeds.regional_monthly_feed(m, "lake_id"), 11, "CI_mean", "CI_p90")


@query
def chart_lake_daily(spark, sf_dir):
    out = feeds.lake_daily_feed(_stored_quality(spark, sf_dir))
    out = out.withColumns({c: F.col(c).cast("int") for c in out.columns if c.startswith("has_")})
    return rounded(rounded(out, 11, "CI_mean", "CI_mean_7", "CI_p90_7"), 5, "pct_valid_geom")


@query
def chart_lake_monthly(spark, sf_dir):
    out = feeds.lake_monthly_feed(_stored_quality(spark, sf_dir))
    out = out.withColumns({c: F.col(c).cast("int") for c in out.columns if c.startswith("has_")})
    return rounded(out, 11, "CI_mean", "CI_p90")


@query
def facet_shading(spark, sf_dir):
    """Panels in a listed order, picked by name regardless of case."""
    out = feeds.facet_feed(_stored_quality(spark, sf_dir), ("MACHINERY", "building", "Automobile"))
    return rounded(out, 11, "coverage_height", "CI_mean_7", "CI_p90_7")


@query
def validity_matrix(spark, sf_dir):
    """Labelled lakes x every day of the data: the validity verdict."""
    named = ad.obs_events(spark, sf_dir).withColumn("lake_name", F.concat(F.lit("Lake "), F.substring("lake_id", 4, 9)))
    out = feeds.validity_matrix_feed(named)
    days = [c for c in out.columns if c != "label"]
    return out.select("label", *[F.col(f"`{d}`").cast("double").alias("d" + d.replace("-", "")) for d in days])


@query
def validity_long(spark, sf_dir):
    return summary.validity_long(_stored_quality(spark, sf_dir)).select("label", "date", "qc_is_valid")


# --- schema plumbing ----------------------------------------------------------------


@query
def schema_complete(spark, sf_dir):
    """Observations without reader and product columns, brought to the stored form."""
    s = ad.obs(spark, sf_dir).drop("CI_p90").withColumn("date", F.col("date").cast("timestamp_ntz"))
    return rounded(schema.complete_columns(s), 11, "CI_mean")


@query
def column_resolve(spark, sf_dir):
    """Repeated columns dropped, name and time columns found."""
    s = ad.obs(spark, sf_dir).select(
        "lake_id", F.col("date").alias("obs_datetime"), "n_valid", F.col("n_valid").alias("n_valid"),
        F.initcap("lake_id").alias("Name"),
    )
    out = schema.with_lake_name(schema.ensure_date(schema.drop_repeated_columns(s)))
    return out.groupBy("lake_id", "lake_name").agg(
        F.min("date").alias("first"), F.max("date").alias("last"), F.sum("n_valid").alias("pixels")
    )


@query
def coordinate_names(spark, sf_dir):
    """Odd axis names normalised, then 1-D coordinates bound to them."""
    px = ad.pixels(spark, sf_dir).select(F.col("x").alias("X"), F.col("y").alias("Y"), "date")
    out = schema.normalise_coordinates(px)
    xs = out.select("x").distinct().withColumn("lon", F.lit(-95.0) + F.col("x") / 100.0)
    ys = out.select("y").distinct().withColumn("lat", F.lit(40.0) + F.col("y") / 10.0)
    bound = schema.bind_axes(out, xs, ys)
    return bound.groupBy("y").agg(
        F.count("*").alias("n"), F.round(F.min("lon"), 6).alias("west"), F.round(F.max("lon"), 6).alias("east"),
        F.round(F.max("lat"), 6).alias("lat"),
    )


# --- readers, writers, order --------------------------------------------------------


@query
def csv_round_trip(spark, sf_dir):
    """A regional series written as CSV and read back with its schema; missing counts stay missing."""
    path = scratch_path(spark)
    known = F.when(F.day("date") % 6 != 0, F.col("n_valid"))
    rows = ad.obs(spark, sf_dir).select(F.concat_ws("/", "lake_id", "date").alias("time"), "CI_mean", "CI_p90", known.alias("n_valid"))
    tables.write_csv(rows, path)
    out = rounded(tables.read_csv(spark, path, tables.REGIONAL_SERIES), 11, "CI_mean", "CI_p90")
    return out.withColumn("n_valid", F.col("n_valid").cast("double"))


@query
def parquet_glob(spark, sf_dir):
    """Observations written by lake, then the files of all folders read by pattern, with NaN made missing."""
    path = scratch_path(spark)
    rows = ad.obs(spark, sf_dir).withColumn("CI_mean", F.when(F.day("date") % 9 == 0, F.lit(float("nan"))).otherwise(F.col("CI_mean")))
    tables.write_parquet(rows.withColumn("lake", F.col("lake_id")), path, ["lake"])
    out = tables.read_parquet(spark, path, "part-*.parquet", recursive=True, source_column="src")
    return out.groupBy("lake_id").agg(
        F.count("*").alias("rows"), F.count("CI_mean").alias("n_mean"), F.count_if(F.col("src").startswith("part-")).alias("n_src")
    )


@query
def pixel_scan(spark, sf_dir):
    """Pixels without positions read from their own table; the grid's positions are attached."""
    path = scratch_path(spark)
    tables.write_parquet(ad.pixels(spark, sf_dir).drop("lon", "lat"), path)
    px = tables.read_pixels(spark, path, "CI_cyano", ad.grid(spark, sf_dir))
    return px.groupBy("src").agg(
        F.count("*").alias("n"), F.count("CI_cyano").alias("n_value"), F.round(F.sum("lon"), 6).alias("lon"), F.round(F.sum("lat"), 6).alias("lat")
    )


@query
def polygon_round_trip(spark, sf_dir):
    """Polygon parts written, read back and measured: points of all rings and the box of each lake."""
    path = scratch_path(spark)
    tables.write_polygons(ad.polygons(spark, sf_dir), path)
    parts = tables.read_polygons(spark, path)
    points = F.aggregate("rings", F.lit(0), lambda n, ring: n + F.size(ring))
    box = spatial.bounds(spatial.edges(parts))
    out = parts.select("lake_id", "srid", points.alias("points")).join(box, "lake_id")
    return rounded(out, 9, "minx", "miny", "maxx", "maxy")


@query
def optional_input(spark, sf_dir):
    """Tables of the folder that are there, by name; one is not."""
    names = ("orders", "lineitem", "supplier", "no_such_table")
    found = [(n, tables.optional(tables.read_parquet, spark, f"{sf_dir}/{n}.parquet")) for n in names]
    one = [
        (df.agg(F.count("*").alias("rows")) if df is not None else spark.range(1).select(F.lit(None).cast("long").alias("rows")))
        .select(F.lit(n).alias("name"), F.col("rows").cast("double").alias("rows"))
        for n, df in found
    ]
    return series.union_all(one)


@query
def sorted_rows(spark, sf_dir):
    """Observations in lake and date order, each row with its place in the table, as written and read back."""
    path = scratch_path(spark)
    rows = numbering.row_numbers(ad.obs(spark, sf_dir), ["lake_id", "date"])
    tables.write_parquet(schema.ordered(rows, "place").select("lake_id", "date", "n_valid", "place"), path)
    return spark.read.parquet(path)


@query
def numbered_rows(spark, sf_dir):
    """Pixels of each day numbered by value, missing ones last; the extremes of every day by their numbers."""
    px = ad.pixels(spark, sf_dir).select("date", "CI_cyano", "x", "y")
    px = px.withColumn("CI_cyano", F.when(~F.isnan("CI_cyano"), F.col("CI_cyano")))
    rows = numbering.row_numbers(px, ["CI_cyano"], by=["date"])
    return rows.groupBy("date").agg(
        F.count("*").alias("rows"), (F.max("place") + 1).alias("last"), F.count_distinct("place").alias("numbers"),
        F.round(F.max(F.when(F.col("place") == 0, F.col("CI_cyano").cast("double"))), 9).alias("lowest"),
        F.min(F.when(F.col("CI_cyano").isNull(), F.col("place"))).alias("first_missing"),
    )


@query
def facet_first(spark, sf_dir):
    """The first two panels of all lakes in text order: rows, span and peak of each."""
    out = feeds.facet_feed(_stored_quality(spark, sf_dir), ("none of these",), limit=2)
    return out.groupBy("lake_id").agg(F.count("*").alias("rows"), F.min("date").alias("first"), F.max("date").alias("last"))


@query
def quality_defaults(spark, sf_dir):
    """Lake quality with the coverage limits as they come: flags and verdicts counted."""
    obs = ad.obs_full(spark, sf_dir).withColumn("n_valid", F.col("n_valid") * 25)
    expected = ad.expected(spark, sf_dir).withColumn("expected_pixels_geom", F.col("expected_pixels_geom") * 100)
    q = quality.lake_quality(obs, expected)
    flags = [c for c in q.columns if c.startswith("qc_")]
    return q.groupBy("lake_id").agg(F.count("*").alias("rows"), *[F.sum(F.col(c).cast("bigint")).alias(c) for c in flags])


@query
def guarded_write(spark, sf_dir):
    """Tables written into folders that don't exist yet; one without rows writes nothing."""
    root = scratch_path(spark)
    obs, found = ad.obs(spark, sf_dir), []
    for name, rows in (("all", obs), ("none", obs.where("n_valid < 0"))):
        tables.write_parquet(rows, f"{root}/deep/{name}", unless_empty=rows)
        back = tables.optional(spark.read.parquet, f"{root}/deep/{name}")
        written = obs.limit(0) if back is None else back
        found.append(written.agg(F.lit(name).alias("name"), F.lit(back is not None).cast("int").alias("written"), F.count("*").alias("rows")))
    return found[0].unionByName(found[1])


@query
def column_difference(spark, sf_dir):
    """Columns of the stored form that observations lack, and tables with different columns put together."""
    s = ad.obs(spark, sf_dir)
    lacking = ",".join(schema.missing_columns(s, schema.OBSERVATION_COLUMNS))
    both = series.union_all([s.select("lake_id", "n_valid"), s.select("lake_id", "CI_mean")])
    return both.groupBy("lake_id").agg(
        F.count("*").alias("rows"), F.count("n_valid").alias("n_counts"), F.count("CI_mean").alias("n_means"), F.lit(lacking).alias("lacking")
    )


@query
def facet_all(spark, sf_dir):
    """Without a listed name every lake has its panel."""
    out = feeds.facet_feed(_stored_quality(spark, sf_dir), ("nowhere",))
    return out.groupBy("lake_id", F.col("ord").cast("double").alias("ord")).agg(F.count("*").alias("rows"))
