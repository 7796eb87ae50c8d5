import random

import pytest
from pyspark.sql import functions as F

from estate_hygiene.operators import ordering
from helpers import records


@pytest.mark.parametrize("n", [0, 1, 3_000])
def test_places_follow_the_order_without_gaps(spark, n):
    rng = random.Random(n)
    rows = [(i, rng.choice([None, 1.5, 2.5, -1.0]), rng.randrange(5)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, size double, n long").repartition(5)
    got = ordering.numbered(df, [F.col("size").desc_nulls_last(), F.col("id")], running={"so_far": "n"})
    want, total = [], 0
    for place, (i, size, words) in enumerate(sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0])), 1):
        total += words
        want.append((i, size, words, place, total))
    assert sorted(records(got)) == sorted(want)


def test_equal_rows_and_clashing_names(spark):
    df = spark.createDataFrame([("x", 7, 1)] * 40, "range string, place int, place_before int")
    got = ordering.numbered(df, [F.col("range")])
    assert got.columns == ["range", "place_before", "place"] and sorted(records(got, "place")) == [(i,) for i in range(1, 41)]


def test_no_window_holds_all_rows(spark):
    df = spark.range(100).withColumn("size", F.col("id") % 7)
    plan = ordering.numbered(df, [F.col("size"), F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1  # the offsets: a row for each range
