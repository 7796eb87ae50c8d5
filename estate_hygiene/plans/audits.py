"""The four audits. Each is one lazy plan over all scopes.

With a ``coverage`` table, scopes whose metadata could not be read are left out, and ``history_ok`` says of the others
whether their access log was read. ``require_history`` keeps what has no such log from being called unused: its status
is for review, and no deletion is recommended.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Literal

from pyspark.sql import Column, DataFrame, functions as F

from estate_hygiene.functions.names import organisation
from estate_hygiene.functions.numbers import monthly_cost, round2
from estate_hygiene.functions.timestamps import (
    floor_days,
    instant,
    offset_text,
    second_text,
    wall_clock,
)
from estate_hygiene.operators.access import EVENTS_KEPT, LOOKBACK_DAYS, access_summary, last_access_by_table
from estate_hygiene.operators.classify import (
    PRIORITIES,
    REVIEW_STATUS,
    TRANCHES,
    classify_access,
    classify_deep,
    classify_tranche,
    deletion_status,
    rank_of,
)
from estate_hygiene.operators.ordering import sheet_order
from estate_hygiene.operators.storage import TABLES_PER_SCOPE, dataset_metadata, largest_tables
from estate_hygiene.sources.estate import scope

# Fixed values.
NO_READS = "No Read Access (180d)"
NO_WRITES = "No Write Access (180d)"
NEVER_ACCESSED = "NEVER (>180 days)"
NEVER_STORED = "Never/Historical"
ZOMBIE_STATUS = "ZOMBIE DATA"
ZOMBIE_ACTION = "DELETE: No query history found for 180 days."
ACCESS_HEADERS = (
    "Project", "Region", "Dataset", "Description", "Size (GB)", "Last Storage Update",
    "Last 5 Reads (Who/When)", "Last 5 Writes (Who/When)", "Status", "Cleanup Priority", "Recommended Action",
)
TRANCHE_HEADERS = (
    "Project", "Region", "Dataset", "Description", "Size (GB)", "Monthly Cost ($)", "Tranche", "Cleanup Priority",
    "Last Read Time", "Last Write Time", "Last 5 Reads (Who/When)", "Last 5 Writes (Who/When)", "Last Storage Update",
)
DEEP_HEADERS = (
    "Project", "Region", "Dataset", "Description", "Size (GB)", "Monthly Cost ($)", "Tranche", "Cleanup Priority",
    "Days Since Last Activity", "Days Since Last Modified", "Last Read Time", "Last Write Time",
    "Last 5 Reads (Who/When)", "Last 5 Writes (Who/When)", "Last Storage Update", "Defensible Deletion Status",
)
TABLE_HEADERS = (
    "Organisation", "Project ID", "Region", "Dataset", "Table", "Size (GB)", "Created", "Last Accessed",
    "Status", "Action", "Monthly Waste ($)",
)

# Said of what has no access log, if one is required.
NO_HISTORY_STATUS = "REVIEW: access log missing"
NO_HISTORY_PRIORITY = "Review"
NO_HISTORY_ACTION = "REVIEW: the access log of this scope could not be read."

_KEYS = ["project_id", "region", "dataset_id"]


def _readable(df: DataFrame, coverage: DataFrame | None) -> DataFrame:
    """Without the scopes whose metadata could not be read, and with ``history_ok`` for the rest."""
    if coverage is None:
        return df
    readable = coverage.where("metadata_ok").select("project_id", "region", "history_ok")
    return df.join(readable, ["project_id", "region"], "inner")


def _profiles(
    schemata: DataFrame,
    options: DataFrame,
    storage: DataFrame,
    jobs: DataFrame,
    as_of: datetime | str,
    k: int,
    days: int,
    coverage: DataFrame | None,
) -> DataFrame:
    """Every dataset with its metadata and its accesses. Datasets seen only in the job log are left out."""
    metadata = _readable(dataset_metadata(schemata, options, storage), coverage)
    return metadata.join(access_summary(jobs, as_of, k, days), _KEYS, "left")


def _identity() -> list[Column]:
    return [
        F.col("project_id").alias("project"),
        F.col("region"),
        F.col("dataset_id").alias("dataset"),
        F.col("description"),
    ]


def _details() -> list[Column]:
    return [
        F.coalesce("last_reads", F.lit(NO_READS)).alias("last_reads"),
        F.coalesce("last_writes", F.lit(NO_WRITES)).alias("last_writes"),
    ]


def _flags(coverage: DataFrame | None) -> list[str]:
    return [] if coverage is None else ["history_ok"]


def _unless_known(found: Column, otherwise: str, coverage: DataFrame | None, require_history: bool) -> Column:
    """``found``, or ``otherwise`` where the access log is missing and its presence is required."""
    if not require_history:
        return found
    if coverage is None:
        raise ValueError("require_history needs a coverage table")
    return F.when(F.col("history_ok"), found).otherwise(otherwise)


def _ties() -> list[Column]:
    return [F.col("project"), F.col("region"), F.col("dataset")]


def access_order() -> list[Column]:
    """Rows of the access audit: most urgent, then largest first."""
    return [rank_of(F.col("priority"), PRIORITIES), F.col("size_gb").desc_nulls_last(), *_ties()]


def tranche_order() -> list[Column]:
    """Rows of the tranche audit: by tranche, then largest first."""
    return [rank_of(F.col("tranche"), TRANCHES).asc_nulls_last(), F.col("size_gb").desc_nulls_last(), *_ties()]


def waste_order() -> list[Column]:
    """Rows of the table audit: most wasteful first."""
    return [F.col("monthly_waste").desc(), *_ties(), F.col("table_name")]


def access_audit(
    schemata: DataFrame,
    options: DataFrame,
    storage: DataFrame,
    jobs: DataFrame,
    as_of: datetime | str,
    *,
    k: int = EVENTS_KEPT,
    days: int = LOOKBACK_DAYS,
    large_gb: float = 100,
    coverage: DataFrame | None = None,
    require_history: bool = False,
) -> DataFrame:
    """Datasets with status, priority and recommended action; most urgent and largest first."""
    found = classify_access(_profiles(schemata, options, storage, jobs, as_of, k, days, coverage), large_gb)
    return found.select(
        *_identity(),
        round2(F.col("size_gb")).alias("size_gb"),
        wall_clock(F.col("last_storage_modified")).alias("last_storage_update"),
        *_details(),
        _unless_known(F.col("status"), NO_HISTORY_STATUS, coverage, require_history).alias("status"),
        _unless_known(F.col("priority"), NO_HISTORY_PRIORITY, coverage, require_history).alias("priority"),
        _unless_known(F.col("action"), NO_HISTORY_ACTION, coverage, require_history).alias("action"),
        *_flags(coverage),
    ).orderBy(*access_order())


def tranche_audit(
    schemata: DataFrame,
    options: DataFrame,
    storage: DataFrame,
    jobs: DataFrame,
    as_of: datetime | str,
    *,
    k: int = EVENTS_KEPT,
    days: int = LOOKBACK_DAYS,
    large_gb: float = 100,
    monitor_gb: float = 500,
    coverage: DataFrame | None = None,
    require_history: bool = False,
) -> DataFrame:
    """Datasets in cleanup tranches by use in the look-back window."""
    profiles = _profiles(schemata, options, storage, jobs, as_of, k, days, coverage)
    found = classify_tranche(profiles, large_gb, monitor_gb)
    return found.select(
        *_identity(),
        F.coalesce(round2(F.col("size_gb")), F.lit(0.0)).alias("size_gb"),
        F.coalesce(monthly_cost(F.col("size_gb")), F.lit(0.0)).alias("monthly_cost"),
        _unless_known(F.col("tranche"), NO_HISTORY_STATUS, coverage, require_history).alias("tranche"),
        _unless_known(F.col("priority"), NO_HISTORY_PRIORITY, coverage, require_history).alias("priority"),
        wall_clock(F.col("last_read_time")).alias("last_read_time"),
        wall_clock(F.col("last_write_time")).alias("last_write_time"),
        *_details(),
        wall_clock(F.col("last_storage_modified")).alias("last_storage_update"),
        *_flags(coverage),
    ).orderBy(*tranche_order())


def deep_history_audit(
    schemata: DataFrame,
    options: DataFrame,
    storage: DataFrame,
    jobs: DataFrame,
    as_of: datetime | str,
    *,
    k: int = EVENTS_KEPT,
    days: int = LOOKBACK_DAYS,
    abandon_days: int = 365,
    stale_days: int = 180,
    large_gb: float = 100,
    null_storage: Literal["abandoned", "unknown"] = "abandoned",
    coverage: DataFrame | None = None,
    require_history: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """The control table: datasets in tranches by age of the last modification, with a deletion status.

    Rows come in sheet order unless ``ordered`` is false, as for a table that is stored and not looked at.
    """
    profiles = _profiles(schemata, options, storage, jobs, as_of, k, days, coverage)
    sized = profiles.withColumn("size_gb", F.coalesce("size_gb", F.lit(0.0)))
    found = classify_deep(sized, as_of, abandon_days, stale_days, large_gb, null_storage)
    status = deletion_status(F.col("days_since_modified"), abandon_days)
    status = _unless_known(status, REVIEW_STATUS, coverage, require_history)
    stored = second_text(F.col("last_storage_modified"))
    if null_storage == "abandoned":
        stored = F.coalesce(stored, F.lit(NEVER_STORED))
    sheet = found.select(
        *_identity(),
        round2(F.col("size_gb")).alias("size_gb"),
        monthly_cost(F.col("size_gb")).alias("monthly_cost"),
        "tranche",
        "priority",
        "days_since_activity",
        "days_since_modified",
        wall_clock(F.col("last_read_time")).alias("last_read_time"),
        wall_clock(F.col("last_write_time")).alias("last_write_time"),
        *_details(),
        stored.alias("last_storage_update"),
        status.alias("deletion_status"),
        *_flags(coverage),
    )
    return sheet.orderBy(*sheet_order()) if ordered else sheet


def stale_table_audit(
    tables: DataFrame,
    storage: DataFrame,
    jobs: DataFrame,
    as_of: datetime | str,
    *,
    projects: Sequence[str] | None = None,
    regions: Sequence[str] | None = None,
    top_n: int = TABLES_PER_SCOPE,
    days: int = LOOKBACK_DAYS,
    organisations: Mapping[str, str] | None = None,
    default_organisation: str = "",
    coverage: DataFrame | None = None,
    require_history: bool = False,
) -> DataFrame:
    """Old tables among the largest of each scope that no recent job referenced; most wasteful first.

    The cut to ``top_n`` comes before the usage test, so smaller unused tables are never listed, and references to
    tables that are no candidates are dropped before their shuffle.
    """
    largest = largest_tables(scope(tables, projects, regions), scope(storage, projects, regions), top_n)
    candidates = largest.where(floor_days(instant(as_of), F.col("creation_time")) > days)
    keys = candidates.select(*_KEYS, "table_name")
    usage = last_access_by_table(scope(jobs, projects, regions), as_of, days, among=keys)
    unused = candidates.join(usage, [*_KEYS, "table_name"], "left_anti")
    size = F.col("size_gb")
    return _readable(unused, coverage).select(
        organisation(F.col("project_id"), organisations or {}, default_organisation).alias("organisation"),
        F.col("project_id").alias("project"),
        F.concat(F.lit("region-"), F.col("region")).alias("region"),
        F.col("dataset_id").alias("dataset"),
        "table_name",
        round2(size).alias("size_gb"),
        offset_text(F.col("creation_time")).alias("created"),
        F.lit(NEVER_ACCESSED).alias("last_accessed"),
        _unless_known(F.lit(ZOMBIE_STATUS), NO_HISTORY_STATUS, coverage, require_history).alias("status"),
        _unless_known(F.lit(ZOMBIE_ACTION), NO_HISTORY_ACTION, coverage, require_history).alias("action"),
        monthly_cost(size).alias("monthly_waste"),
        *_flags(coverage),
    ).orderBy(*waste_order())


def with_headers(audit: DataFrame, headers: Sequence[str]) -> DataFrame:
    """An audit under its display column names, for export."""
    return audit.select([F.col(c).alias(h) for c, h in zip(audit.columns, headers, strict=True)])
