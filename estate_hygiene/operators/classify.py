"""Cleanup classes. All thresholds are strict; sizes are the unrounded ones."""

from __future__ import annotations

from datetime import datetime
from typing import Literal

from pyspark.sql import Column, DataFrame, functions as F

from estate_hygiene.functions.names import capitalise, is_service_account, is_test_name
from estate_hygiene.functions.timestamps import floor_days, instant, latest

# Class labels in the order in which audits list them.
TRANCHES = (
    "Tranche 1: Stale Test/Temp",
    "Tranche 2: High Saving Stale (>100GB)",
    "Tranche 3: Stale Production",
    "Tranche 4: Active Test/Temp (Review Needed)",
    "Active (Large: Monitor)",
    "Active",
)
DEEP_TRANCHES = (
    "Tranche 1: Abandoned Test/Temp (>1yr)",
    "Tranche 2: Abandoned Large Prod (>1yr)",
    "Tranche 3: Abandoned Small Prod (>1yr)",
    "Tranche 4: Stale (No Access 180d, No Write >6mo)",
    "Tranche 5: Active Test (Housekeeping)",
    "Active",
)
PRIORITIES = ("Critical", "High", "Medium", "Low")
CONFIRMED_STATUS = "CONFIRMED: NO MODS > 1YR"
REVIEW_STATUS = "REVIEW"
UNKNOWN_RANK = 99


def rank_of(label: Column, labels: tuple[str, ...], unknown: int | None = None) -> Column:
    """Position of a label in its list; null or ``unknown`` for others."""
    rank = F.lit(unknown).cast("int")
    for position, name in reversed(list(enumerate(labels))):
        rank = F.when(label == name, F.lit(position)).otherwise(rank)
    return rank


def _unused() -> Column:
    return F.col("last_read_time").isNull() & F.col("last_write_time").isNull()


def _larger_than(gb: float) -> Column:
    """A missing size is not larger than anything."""
    return F.coalesce(F.col("size_gb") > gb, F.lit(False))


def classify_access(df: DataFrame, large_gb: float = 100) -> DataFrame:
    """Adds status, priority and action."""
    unused, test, large = _unused(), is_test_name(F.col("dataset_id")), _larger_than(large_gb)
    return df.select(
        "*",
        F.when(unused, "STALE").when(test, "TEST DATA").otherwise("ACTIVE").alias("status"),
        F.when((unused | test) & large, "Critical")
        .when(unused, "High")
        .when(test, "Medium")
        .otherwise("Low")
        .alias("priority"),
        F.when(unused, "DELETE (No access 180d)")
        .when(test, "Verify & Cleanup (Test/Temp naming)")
        .otherwise("Keep")
        .alias("action"),
    )


def classify_tranche(df: DataFrame, large_gb: float = 100, monitor_gb: float = 500) -> DataFrame:
    """Adds tranche and priority, by use in the look-back window."""
    unused, test = _unused(), is_test_name(F.col("dataset_id"))
    tranche = (
        F.when(unused & test, TRANCHES[0])
        .when(unused & _larger_than(large_gb), TRANCHES[1])
        .when(unused, TRANCHES[2])
        .when(test, TRANCHES[3])
        .when(_larger_than(monitor_gb), TRANCHES[4])
        .otherwise(TRANCHES[5])
    )
    priority = (
        F.when(F.col("tranche").isin(TRANCHES[0], TRANCHES[1]), "Critical")
        .when(F.col("tranche") == TRANCHES[2], "High")
        .when(F.col("tranche") == TRANCHES[3], "Medium")
        .otherwise("Low")
    )
    return df.withColumn("tranche", tranche).withColumn("priority", priority)


def classify_deep(
    df: DataFrame,
    as_of: datetime | str,
    abandon_days: int = 365,
    stale_days: int = 180,
    large_gb: float = 100,
    null_storage: Literal["abandoned", "unknown"] = "abandoned",
) -> DataFrame:
    """Adds days_since_modified, days_since_activity, tranche and priority, by age of the last modification.

    A dataset without a modification time counts as abandoned, or, with ``null_storage="unknown"``, as
    neither abandoned nor stale.
    """
    now = instant(as_of)
    modified = F.col("last_storage_modified")
    touched = F.col("days_since_modified")
    abandoned = touched > abandon_days
    if null_storage == "abandoned":
        abandoned = touched.isNull() | abandoned
    test = is_test_name(F.col("dataset_id"))
    tranche = (
        F.when(abandoned & test, DEEP_TRANCHES[0])
        .when(abandoned & _larger_than(large_gb), DEEP_TRANCHES[1])
        .when(abandoned, DEEP_TRANCHES[2])
        .when(F.col("days_since_activity") > stale_days, DEEP_TRANCHES[3])
        .when(test, DEEP_TRANCHES[4])
        .otherwise(DEEP_TRANCHES[5])
    )
    priority = (
        F.when(F.col("tranche").isin(DEEP_TRANCHES[0], DEEP_TRANCHES[1]), "Critical")
        .when(F.col("tranche") == DEEP_TRANCHES[2], "High")
        .when(F.col("tranche") == DEEP_TRANCHES[3], "Medium")
        .otherwise("Low")
    )
    activity = latest(F.col("last_read_time"), F.col("last_write_time"), modified)
    return (
        df.withColumn("days_since_modified", floor_days(now, modified))
        .withColumn("days_since_activity", floor_days(now, activity))
        .withColumn("tranche", tranche)
        .withColumn("priority", priority)
    )


def deletion_status(days_since_modified: Column, abandon_days: int = 365) -> Column:
    """Confirmed only on a known age; no age means review."""
    return F.when(days_since_modified > abandon_days, CONFIRMED_STATUS).otherwise(REVIEW_STATUS)


def read_pattern(reader: Column, datasets: Column) -> Column:
    kind = F.when(datasets > 1, "single-day bulk scan").otherwise("single read")
    return capitalise(F.concat(F.when(is_service_account(reader), "Service account, ").otherwise(""), kind))
