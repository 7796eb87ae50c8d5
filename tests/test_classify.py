from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from estate_hygiene.operators import classify
from helpers import NOW, ago, evaluate

SCHEMA = "dataset_id string, size_gb double, last_read_time timestamp, last_write_time timestamp, last_storage_modified timestamp"


def profiles(spark, name="sales", size=1.0, read=None, write=None, modified=None):
    return spark.createDataFrame([(name, size, read, write, modified)], SCHEMA)


@pytest.mark.parametrize(
    "name,size,used,expected",
    [
        ("sales", 1.0, False, ("STALE", "High", "DELETE (No access 180d)")),
        ("sales", 100.0, False, ("STALE", "High", "DELETE (No access 180d)")),
        ("sales", 100.01, False, ("STALE", "Critical", "DELETE (No access 180d)")),
        ("test_a", 100.01, False, ("STALE", "Critical", "DELETE (No access 180d)")),
        ("test_a", 1.0, True, ("TEST DATA", "Medium", "Verify & Cleanup (Test/Temp naming)")),
        ("test_a", 100.01, True, ("TEST DATA", "Critical", "Verify & Cleanup (Test/Temp naming)")),
        ("sales", 5000.0, True, ("ACTIVE", "Low", "Keep")),
        ("sales", None, False, ("STALE", "High", "DELETE (No access 180d)")),
        ("test_a", None, True, ("TEST DATA", "Medium", "Verify & Cleanup (Test/Temp naming)")),
    ],
)
def test_access_classes(spark, name, size, used, expected):
    for read, write in ([(ago(1), None), (None, ago(1))] if used else [(None, None)]):
        got = classify.classify_access(profiles(spark, name, size, read, write))
        assert tuple(got.select("status", "priority", "action").first()) == expected


@pytest.mark.parametrize(
    "name,size,used,tranche,priority",
    [
        ("tmp", 900.0, False, "Tranche 1: Stale Test/Temp", "Critical"),
        ("sales", 100.01, False, "Tranche 2: High Saving Stale (>100GB)", "Critical"),
        ("sales", 100.0, False, "Tranche 3: Stale Production", "High"),
        ("sales", None, False, "Tranche 3: Stale Production", "High"),
        ("tmp", 900.0, True, "Tranche 4: Active Test/Temp (Review Needed)", "Medium"),
        ("sales", 500.01, True, "Active (Large: Monitor)", "Low"),
        ("sales", 500.0, True, "Active", "Low"),
        ("sales", None, True, "Active", "Low"),
    ],
)
def test_tranches(spark, name, size, used, tranche, priority):
    got = classify.classify_tranche(profiles(spark, name, size, ago(1) if used else None))
    assert tuple(got.select("tranche", "priority").first()) == (tranche, priority)


DEEP = {
    1: ("Tranche 1: Abandoned Test/Temp (>1yr)", "Critical"),
    2: ("Tranche 2: Abandoned Large Prod (>1yr)", "Critical"),
    3: ("Tranche 3: Abandoned Small Prod (>1yr)", "High"),
    4: ("Tranche 4: Stale (No Access 180d, No Write >6mo)", "Medium"),
    5: ("Tranche 5: Active Test (Housekeeping)", "Low"),
    0: ("Active", "Low"),
}


@pytest.mark.parametrize(
    "name,size,read,modified,expected",
    [
        ("poc", 1.0, None, 366, 1),
        ("poc", 1.0, 1, 366, 1),
        ("sales", 100.01, 1, 366, 2),
        ("sales", 100.0, None, 366, 3),
        ("sales", 1.0, None, 365, 4),
        ("sales", 1.0, None, 181, 4),
        ("sales", 1.0, None, 180, 0),
        ("sales", 1.0, 1, 300, 0),
        ("poc", 1.0, None, 300, 4),
        ("poc", 1.0, 1, 300, 5),
        ("poc", 1.0, None, 10, 5),
        ("sales", 900.0, None, 10, 0),
        ("sales", 1.0, None, None, 3),
        ("sales", 101.0, 1, None, 2),
        ("poc", 1.0, None, None, 1),
    ],
)
def test_deep_tranches(spark, name, size, read, modified, expected):
    df = profiles(spark, name, size, read and ago(read), None, modified and ago(modified))
    got = classify.classify_deep(df, NOW).first()
    assert (got.tranche, got.priority) == DEEP[expected]
    assert got.days_since_modified == modified


@pytest.mark.parametrize("seconds,days,tranche", [(0, 366, 3), (-1, 365, 4)])
def test_a_day_counts_when_it_is_over(spark, seconds, days, tranche):
    got = classify.classify_deep(profiles(spark, modified=ago(366, seconds)), NOW).first()
    assert (got.days_since_modified, got.tranche) == (days, DEEP[tranche][0])


@pytest.mark.parametrize(
    "name,read,expected,activity", [("sales", None, 0, None), ("poc", None, 5, None), ("sales", 3, 0, 3), ("poc", 3, 5, 3)]
)
def test_unknown_storage_time_is_not_abandoned(spark, name, read, expected, activity):
    df = profiles(spark, name, 1000.0, read and ago(read))
    got = classify.classify_deep(df, NOW, null_storage="unknown").first()
    assert (got.tranche, got.days_since_activity, got.days_since_modified) == (DEEP[expected][0], activity, None)


def test_activity_is_the_latest_of_three(spark):
    df = profiles(spark, read=ago(30), write=ago(20), modified=ago(40))
    assert classify.classify_deep(df, NOW).first().days_since_activity == 20


def test_deletion_status(spark):
    got = evaluate(spark, classify.deletion_status(F.col("x")), "x bigint", [(366,), (365,), (None,)])
    assert got == ["CONFIRMED: NO MODS > 1YR", "REVIEW", "REVIEW"]


def test_confirmed_only_in_the_first_three_tranches(spark):
    rows = [(n, s, NOW - timedelta(days=r) if r else None, None, NOW - timedelta(days=m) if m else None)
            for n in ("poc", "sales") for s in (1.0, 200.0, None) for r in (None, 5) for m in (None, 1, 181, 365, 366, 900)]
    df = classify.classify_deep(spark.createDataFrame(rows, SCHEMA), NOW)
    status = df.withColumn("status", classify.deletion_status(F.col("days_since_modified")))
    confirmed = {r.tranche[:9] for r in status.where("status like 'CONFIRMED%'").collect()}
    assert confirmed == {"Tranche 1", "Tranche 2", "Tranche 3"}


@pytest.mark.parametrize(
    "reader,datasets,expected",
    [
        ("a@x.gserviceaccount.com", 2, "Service account, single-day bulk scan"),
        ("a@x.gserviceaccount.com", 1, "Service account, single read"),
        ("u@x.com", 2, "Single-day bulk scan"),
        ("u@x.com", 1, "Single read"),
    ],
)
def test_read_pattern(spark, reader, datasets, expected):
    got = evaluate(spark, classify.read_pattern(F.col("r"), F.col("n")), "r string, n bigint", [(reader, datasets)])
    assert got == [expected]


def test_rank_of_unknown_label(spark):
    rows = [("b",), ("z",), (None,)]
    assert evaluate(spark, classify.rank_of(F.col("x"), ("a", "b")), "x string", rows) == [1, None, None]
    assert evaluate(spark, classify.rank_of(F.col("x"), ("a", "b"), 99), "x string", rows) == [1, 99, 99]
