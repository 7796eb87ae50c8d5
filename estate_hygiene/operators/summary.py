"""Stakeholder summaries of the control table."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame, functions as F

from estate_hygiene.functions.numbers import exact_total, thousands
from estate_hygiene.operators.classify import DEEP_TRANCHES, UNKNOWN_RANK, rank_of, read_pattern
from estate_hygiene.operators.ordering import sheet_order
from estate_hygiene.operators.selection import starts_confirmed

# Fixed values.
TRANCHE_1 = "Tranche 1:"
NO_READS_PREFIX = "No Read Access"
SUBTOTAL = "Subtotal (Cleanup)"
WHEN_WHO = r"^(.*?)\s*\(([^)]+)\)\s*$"
ACTIVE = DEEP_TRANCHES[-1]

_NAME = ("project", "region", "dataset")

def tranche1_candidates(audit: DataFrame) -> DataFrame:
    return audit.where(
        F.coalesce(F.col("tranche").startswith(TRANCHE_1), F.lit(False)) & starts_confirmed(F.col("deletion_status"))
    )


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def parse_last_reader(candidates: DataFrame) -> DataFrame:
    """Adds last_read_when and last_read_who from the first line of the read details.

    Both are null when nothing was read; a line of another form is all time and no reader.
    """
    first = _strip(F.split(F.col("last_reads"), "\n").getItem(0))
    unread = F.col("last_reads").startswith(NO_READS_PREFIX)
    parsed = candidates.withColumn("first_read", F.when(~unread, first))
    matches = F.col("first_read").rlike(WHEN_WHO)
    return parsed.select(
        *candidates.columns,
        F.when(matches, _strip(F.regexp_extract("first_read", WHEN_WHO, 1)))
        .otherwise(F.col("first_read"))
        .alias("last_read_when"),
        F.when(matches, _strip(F.regexp_extract("first_read", WHEN_WHO, 2))).alias("last_read_who"),
    )


def reader_summary(candidates: DataFrame) -> DataFrame:
    """Distinct datasets, newest read and pattern per last reader; busiest reader first.

    Datasets are folded to one row per (reader, name) first, so a reader of a third of all datasets is
    combined before the shuffle.
    """
    read = parse_last_reader(candidates).where(F.col("last_read_who").isNotNull())
    names = read.groupBy(F.col("last_read_who").alias("reader"), "dataset").agg(
        F.max("last_read_when").alias("last_read")
    )
    readers = names.groupBy("reader").agg(F.count("dataset").alias("datasets"), F.max("last_read").alias("last_read"))
    return readers.withColumn("pattern", read_pattern(F.col("reader"), F.col("datasets"))).orderBy(*reader_order())


def reader_order() -> list[Column]:
    """Rows of the reader summary: busiest first."""
    return [F.col("datasets").desc(), F.col("reader")]


def unread_datasets(candidates: DataFrame) -> DataFrame:
    """Candidates without a known reader, one row each, in sheet order.

    Rows rather than one joined text: the list has no bound.
    """
    unread = parse_last_reader(candidates).where(F.col("last_read_who").isNull())
    return unread.orderBy(*sheet_order()).select(*_NAME)


def bulk_scan_insight(candidates: DataFrame) -> DataFrame:
    """How many candidates show a read, and how many of those trace to readers of several datasets."""
    names = parse_last_reader(candidates).groupBy("last_read_who", "dataset").agg(F.count(F.lit(1)).alias("n"))
    readers = names.groupBy("last_read_who").agg(F.count("dataset").alias("datasets"), F.sum("n").alias("n"))
    read = F.col("last_read_who").isNotNull()
    bulk = read & (F.col("datasets") > 1)
    return readers.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("candidates"),
        F.coalesce(F.sum(F.when(read, F.col("datasets"))), F.lit(0)).alias("datasets_with_reads"),
        F.coalesce(F.sum(F.when(bulk, F.col("datasets"))), F.lit(0)).alias("bulk_scanned_datasets"),
        F.count_if(bulk).alias("bulk_readers"),
    )


def candidate_totals(candidates: DataFrame) -> DataFrame:
    totals = candidates.agg(
        F.count(F.lit(1)).alias("datasets"),
        exact_total(F.col("size_gb")).alias("size_gb"),
        exact_total(F.col("monthly_cost")).alias("monthly_cost"),
    )
    return totals.select(
        "*",
        thousands(F.col("size_gb"), 0).alias("size_text"),
        thousands(F.col("monthly_cost"), 2).alias("cost_text"),
    )


def recency_series(candidates: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` candidates idle longest, with days since the last read and the last modification.

    The days since activity stand for the days since the read, and are null when there was none.
    """
    idle = candidates.orderBy(F.col("days_since_activity").desc_nulls_last(), *_NAME).limit(n)
    return idle.select(
        *_NAME,
        F.when(F.col("last_read_time").isNotNull(), F.col("days_since_activity").cast("double")).alias("days_since_read"),
        F.col("days_since_modified").cast("double").alias("days_since_modified"),
    )


def top_cost(candidates: DataFrame, n: int = 6) -> DataFrame:
    """The ``n`` most expensive candidates, as displayed."""
    dearest = candidates.orderBy(F.col("monthly_cost").desc_nulls_last(), *_NAME).limit(n)
    return dearest.select(
        *_NAME,
        F.col("days_since_activity").cast("string").alias("days_inactive"),
        thousands(F.col("size_gb"), 2).alias("size_text"),
        thousands(F.col("monthly_cost"), 2).alias("cost_text"),
    )


def tranche_overview(audit: DataFrame, subtotal_projects: Literal["summed", "distinct"] = "summed") -> DataFrame:
    """Cost, volume, datasets and projects per tranche, with a subtotal over all but the active ones.

    The subtotal of projects adds the counts of the tranches, or counts each project once if ``distinct``.
    Datasets without a tranche are a row of their own, last, and no part of the subtotal: nothing says that they
    can go.
    """
    cleanup = F.coalesce(F.col("tranche") != ACTIVE, F.lit(False))
    own = F.array(F.col("tranche"))
    labels = F.explode(F.when(cleanup, F.concat(own, F.array(F.lit(SUBTOTAL)))).otherwise(own)).alias("label")
    per_project = audit.groupBy("tranche", "project").agg(
        F.sum(F.col("monthly_cost").cast("decimal(28,6)")).alias("cost"),
        F.sum(F.col("size_gb").cast("decimal(28,6)")).alias("size"),
        F.count(F.lit(1)).alias("n"),
    )
    projects = F.count("project") if subtotal_projects == "summed" else F.count_distinct("project")
    overview = per_project.select("*", labels).groupBy("label").agg(
        F.sum("cost").cast("double").alias("monthly_cost"),
        F.sum("size").cast("double").alias("size_gb"),
        F.sum("n").alias("datasets"),
        projects.alias("projects"),
    )
    after = (*DEEP_TRANCHES[:-1], SUBTOTAL, ACTIVE)
    return overview.select(F.col("label").alias("tranche"), "monthly_cost", "size_gb", "datasets", "projects").orderBy(
        rank_of(F.col("tranche"), after, UNKNOWN_RANK), "tranche"
    )
