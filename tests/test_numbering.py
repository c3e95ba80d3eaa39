import random

import pytest
from pyspark.sql import functions as F

from limnia.operators import numbering


@pytest.mark.parametrize("by", [[], ["k"]])
def test_numbers_equal_a_sort(spark, monkeypatch, by):
    monkeypatch.setattr(numbering, "RANGE_ROWS", 50)
    rnd = random.Random(1)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice([None, *range(40)]), i, 0) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, t int, id int, num_n int").repartition(5)
    got = numbering.row_numbers(df, ["t", "id"], by)
    assert got.columns == ["k", "t", "id", "num_n", "place"]
    seen = {}
    for r in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2])):
        key = r[0] if by else 0
        seen[r[2]], seen[key, "n"] = seen.get((key, "n"), 0), seen.get((key, "n"), 0) + 1
    assert {r["id"]: r["place"] for r in got.collect()} == {i: seen[i] for i in range(2000)}


def test_one_time_and_equal_rows(spark):
    df = spark.range(5000).selectExpr("'day' AS t", "id % 10 AS v")
    got = numbering.row_numbers(df, ["t"], name="n")
    assert got.select("n").distinct().count() == 5000 and got.agg(F.max("n")).first()[0] == 4999
    # equal rows stand side by side
    assert got.groupBy("v").agg((F.max("n") - F.min("n") + 1).alias("span"), F.count("*").alias("c")).where("span <> c").count() == 0


def test_no_task_holds_a_hot_day(spark, monkeypatch):
    monkeypatch.setattr(numbering, "RANGE_ROWS", 10_000)
    df = spark.range(200_000).selectExpr("'one day' AS t", "id")
    got = numbering.row_numbers(df, ["t"])
    held = got.groupBy(F.spark_partition_id()).count()
    assert got.agg(F.max("place")).first()[0] == 199_999 and held.agg(F.max("count")).first()[0] < 100_000


def test_empty_table(spark):
    assert numbering.row_numbers(spark.createDataFrame([], "t int"), ["t"]).collect() == []
