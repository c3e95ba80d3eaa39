"""Choosing the study lakes from a global polygon table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limnia.functions.text import contains_text, is_any, mentions_any
from limnia.operators.schema import check_srid, in_listed_order
from limnia.operators.inset import STEP_M, free_stretches
from limnia.operators.spatial import dissolve, inset_shores, intersects_box

# The study area and its lakes.
COUNTRY = "United States"
STUDY_BOX = (-95.0, 40.0, -74.0, 49.0)
NAMES = ("Superior", "Michigan", "Huron", "Erie", "Ontario")
ID_ORDER = ("Erie", "Huron", "Michigan", "Ontario", "Superior")
SHORE_M = 300.0


def candidate_lakes(
    lakes: DataFrame, country: str = COUNTRY, box: Sequence[float] = STUDY_BOX, names: Sequence[str] = NAMES
) -> DataFrame:
    """Parts of lakes in the country or touching the box, whose name mentions a listed one.

    Input: one row per polygon part with ``Hylak_id, Lake_name, Country, part, srid, rings``.
    The two branches of the union are one predicate, so nothing is scanned or deduplicated
    twice; the name test runs first because it is the most selective.
    """
    named = check_srid(lakes).where(mentions_any("Lake_name", names))
    home = contains_text("Country", country)
    abroad = named.where(~home)
    touching = intersects_box(abroad, *box, key="Hylak_id").withColumn("touches", F.lit(True))
    return named.join(touching, "Hylak_id", "left").where(home | F.col("touches")).drop("touches")


def study_lakes(
    candidates: DataFrame, names: Sequence[str] = NAMES, order: Sequence[str] = ID_ORDER,
    inset_m: float = SHORE_M, strict: bool = True, step_m: float = STEP_M,
) -> DataFrame:
    """The listed lakes, dissolved by exact name, numbered GL-1, GL-2, ... in listed order.

    The shoreline inset is kept as a number (``inset_m``) that the membership and area
    operators apply. A lake with nothing left inside the inset is dropped before numbering.
    """
    exact = candidates.where(is_any("Lake_name", names))
    merged = dissolve(exact, "Lake_name", order="Hylak_id")
    listed = in_listed_order(merged, "Lake_name", order, strict)
    listed = listed.withColumnRenamed("Lake_name", "lake_name")
    if inset_m:
        shape = listed.select(F.col("lake_name").alias("lake_id"), "part", "rings", F.lit(float(inset_m)).alias("inset_m"))
        left = free_stretches(inset_shores(shape), step_m).select(F.col("lake_id").alias("lake_name")).distinct()
        listed = listed.join(left, "lake_name", "left_semi")
    # at most len(order) names: a bounded ranking
    ids = listed.groupBy("ord").agg(F.count("*").alias("parts")).withColumn(
        "no", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("ord"))
    )
    return listed.join(ids, "ord").select(
        F.concat(F.lit("GL-"), F.col("no")).alias("lake_id"), "lake_name", "part", "srid", "rings",
        F.lit(float(inset_m)).alias("inset_m"),
    )
