"""Who read or wrote which dataset, from job history.

Job columns: job_id, project_id, region, creation_time, user_email, referenced_tables, destination_table.
Only references to the job's own project count, except in ``last_access_by_table``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Literal

from pyspark.sql import Column, DataFrame, Window, functions as F

from estate_hygiene.functions.timestamps import days_before, minute_text
from estate_hygiene.operators.membership import may_be_member, membership

LOOKBACK_DAYS = 180
EVENTS_KEPT = 5
DATASET = ("project_id", "region", "dataset_id")
# Spark cuts each map task to k rows per key only below this (spark.sql.optimizer.windowGroupLimitThreshold).
MOST_KEPT = 999
_NO_REFERENCES = "array<struct<project_id:string,dataset_id:string>>"


def within_days(df: DataFrame, ts: str, as_of: datetime | str, days: int) -> DataFrame:
    """Strictly later than ``days`` before ``as_of``; no upper bound."""
    return df.where(F.col(ts) > days_before(as_of, days))


def newest_first() -> list[Column]:
    """Total order of events; text rendered from equal (time, user) pairs is the same whichever comes first."""
    return [F.col("creation_time").desc(), F.col("user_email").asc()]


def read_events(jobs: DataFrame, as_of: datetime | str, days: int = LOOKBACK_DAYS) -> DataFrame:
    """One row per referenced table: a job naming three tables of a dataset gives three events."""
    recent = within_days(jobs, "creation_time", as_of, days)
    exploded = recent.select(
        "project_id", "region", "creation_time", "user_email", "job_id", F.explode("referenced_tables").alias("ref")
    )
    return exploded.where(F.col("ref.project_id") == F.col("project_id")).select(
        "project_id",
        "region",
        F.col("ref.dataset_id").alias("dataset_id"),
        F.col("ref.table_id").alias("table_id"),
        "creation_time",
        "user_email",
        "job_id",
    )


def write_events(jobs: DataFrame, as_of: datetime | str, days: int = LOOKBACK_DAYS) -> DataFrame:
    """One row per job with a destination table."""
    recent = within_days(jobs, "creation_time", as_of, days)
    return recent.where(
        F.col("destination_table.dataset_id").isNotNull()
        & (F.col("destination_table.project_id") == F.col("project_id"))
    ).select(
        "project_id",
        "region",
        F.col("destination_table.dataset_id").alias("dataset_id"),
        F.col("destination_table.table_id").alias("table_id"),
        "creation_time",
        "user_email",
        "job_id",
    )


def access_events(jobs: DataFrame, as_of: datetime | str, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Reads and writes of the look-back window, told apart by ``is_write``."""
    return events_of(within_days(jobs, "creation_time", as_of, days))


def events_of(jobs: DataFrame) -> DataFrame:
    """Reads and writes in one pass over the job log, told apart by ``is_write``.

    The destination goes in front of the references, so position 0 of the exploded array is the write.
    ``arrays_zip`` of two extracted fields keeps table ids out of the scan and, unlike a lambda, inside
    generated code.
    """
    destination = F.array(
        F.struct(
            F.col("destination_table.project_id").alias("project_id"),
            F.col("destination_table.dataset_id").alias("dataset_id"),
        )
    )
    references = F.coalesce(
        F.arrays_zip(F.col("referenced_tables.project_id"), F.col("referenced_tables.dataset_id")),
        F.array().cast(_NO_REFERENCES),
    )
    exploded = jobs.select(
        "project_id",
        "region",
        "creation_time",
        "user_email",
        F.posexplode(F.concat(destination, references)).alias("pos", "ref"),
    )
    own = (F.col("ref.project_id") == F.col("project_id")) & F.col("ref.dataset_id").isNotNull()
    return exploded.where(own).select(
        "project_id",
        "region",
        F.col("ref.dataset_id").alias("dataset_id"),
        (F.col("pos") == 0).alias("is_write"),
        "creation_time",
        "user_email",
    )


def top_k_access(
    events: DataFrame, keys: Sequence[str], k: int = EVENTS_KEPT, order: Sequence[Column] | None = None
) -> DataFrame:
    """The first ``k`` rows per key, numbered in ``rn``.

    Spark cuts every map task to ``k`` rows per key before the shuffle, so a key holding a third of all
    events sends on no more than k rows per task. It does so up to MOST_KEPT rows, which bounds ``k``.
    """
    if not 0 < k <= MOST_KEPT:
        raise ValueError(f"k is 1 to {MOST_KEPT}")
    ranked = Window.partitionBy(*keys).orderBy(*(order or newest_first()))
    return events.withColumn("rn", F.row_number().over(ranked)).where(F.col("rn") <= k)


def _numbered_line() -> Column:
    who = F.coalesce(F.col("user_email"), F.lit("None"))
    line = F.concat(minute_text(F.col("creation_time")), F.lit(" ("), who, F.lit(")"))
    return F.struct("rn", line.alias("line"))


def _lines(numbered: Column) -> Column:
    """At most k numbered lines per group, joined in order."""
    return F.array_join(F.sort_array(F.collect_list(numbered)).getField("line"), "\n")


def last_access_time(
    jobs: DataFrame, kind: Literal["READ", "WRITE"], as_of: datetime | str, days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Only the time of the last access: a plain aggregation, combined before the shuffle."""
    events = read_events(jobs, as_of, days) if kind == "READ" else write_events(jobs, as_of, days)
    return events.groupBy(*DATASET).agg(F.max("creation_time").alias("last_access_time"))


def last_access(
    jobs: DataFrame,
    kind: Literal["READ", "WRITE"],
    as_of: datetime | str,
    k: int = EVENTS_KEPT,
    days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """Last access and the ``k`` newest events as text, per dataset, for one kind of access."""
    events = read_events(jobs, as_of, days) if kind == "READ" else write_events(jobs, as_of, days)
    newest = top_k_access(events.select(*DATASET, "creation_time", "user_email"), DATASET, k)
    return newest.groupBy(*DATASET).agg(
        F.max("creation_time").alias("last_access_time"), _lines(_numbered_line()).alias("details")
    )


def access_summary(
    jobs: DataFrame,
    as_of: datetime | str,
    k: int = EVENTS_KEPT,
    days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """Reads and writes of each dataset side by side; null where there were none."""
    return summary_of(top_k_access(access_events(jobs, as_of, days), (*DATASET, "is_write"), k))


def summary_of(newest: DataFrame) -> DataFrame:
    """One row per dataset from its newest events, numbered in ``rn`` by kind."""
    read, write = ~F.col("is_write"), F.col("is_write")
    per_dataset = newest.groupBy(*DATASET).agg(
        F.max(F.when(read, F.col("creation_time"))).alias("last_read_time"),
        F.max(F.when(write, F.col("creation_time"))).alias("last_write_time"),
        _lines(F.when(read, _numbered_line())).alias("reads"),
        _lines(F.when(write, _numbered_line())).alias("writes"),
    )
    return per_dataset.select(
        *DATASET,
        "last_read_time",
        "last_write_time",
        F.when(F.col("last_read_time").isNotNull(), F.col("reads")).alias("last_reads"),
        F.when(F.col("last_write_time").isNotNull(), F.col("writes")).alias("last_writes"),
    )


def last_access_by_table(
    jobs: DataFrame,
    as_of: datetime | str,
    days: int = LOOKBACK_DAYS,
    match_project: bool = False,
    among: DataFrame | None = None,
) -> DataFrame:
    """Last reference to each table, within the scope of the job log that names it.

    By default the project of the reference is not looked at: a table of the same dataset and name in
    another project counts as use. References fold to one row per table in each map task. With ``among``, rows of the
    same four keys, references to other tables are dropped where they are read, but for a few that share a hash.
    """
    recent = within_days(jobs, "creation_time", as_of, days)
    exploded = recent.select("project_id", "region", "creation_time", F.explode("referenced_tables").alias("ref"))
    if match_project:
        exploded = exploded.where(F.col("ref.project_id") == F.col("project_id"))
    keys = (*DATASET, "table_name")
    references = exploded.select(
        "project_id",
        "region",
        F.col("ref.dataset_id").alias("dataset_id"),
        F.col("ref.table_id").alias("table_name"),
        "creation_time",
    )
    if among is not None:
        references = references.where(may_be_member(membership(among, keys), [F.col(c) for c in keys]))
    return references.groupBy(*keys).agg(F.max("creation_time").alias("last_accessed"))
