"""Row numbers without a window over the whole table or over one group.

Rows are dealt to ranges of the order and sorted there; each range's rows are numbered as they
are written, and the counts of the ranges before are added. A group of any size is as many
ranges as it needs, and the only window runs over one row for each range and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limnia.operators.quantiles import attach
from limnia.session import materialise

RANGE_ROWS = 4_000_000


def row_numbers(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), name: str = "place") -> DataFrame:
    """``df`` with the 0-based number of each row in the order of the columns, missing values last.

    With ``by``, numbers start anew in each group of these columns (NULL is a group). Rows that are
    equal in the order are put in order by a hash of all their columns; rows equal in
    everything get different numbers in any order, and they are the only ones that must share
    a range. The result is read from a written table, so numbers stay as they are.
    """
    spark, by = df.sparkSession, list(by)
    keys = [F.asc_nulls_last(c) for c in (*by, *order)] + [F.xxhash64(*df.columns).asc()]
    ranges = df.count() // RANGE_ROWS + 1
    given = [ranges] if ranges > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
    ranked = df.repartitionByRange(*given, *keys).sortWithinPartitions(*keys)
    # upper bits of the number are the range's, the lower ones count its rows
    held = materialise(ranked.withColumn("num_at", F.monotonically_increasing_id()))
    held = held.withColumn("num_range", F.shiftright("num_at", 33))
    before = Window.partitionBy(*by).orderBy("num_range").rowsBetween(Window.unboundedPreceding, -1)
    runs = held.groupBy(*by, "num_range").agg(F.count("*").alias("num_n"), F.min("num_at").alias("num_first"))
    shift = F.coalesce(F.sum("num_n").over(before), F.lit(0)) - F.col("num_first")
    # written, so that the planner sees how small they are and need not shuffle the rows to them
    runs = materialise(runs.select(*by, "num_range", shift.alias("num_shift")))
    out = attach(held, runs, [*by, "num_range"])
    return out.withColumn(name, F.col("num_at") + F.col("num_shift")).drop("num_at", "num_range", "num_shift")
