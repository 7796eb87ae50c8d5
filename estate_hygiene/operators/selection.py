"""Choosing rows of the control table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from estate_hygiene.functions.names import is_number_like
from estate_hygiene.operators.ordering import numbered, sheet_position

CONFIRMED = "CONFIRMED"


def contains_confirmed(status: Column) -> Column:
    """The gate for acting on a dataset: the word anywhere in the status. Null fails."""
    return F.coalesce(status.contains(CONFIRMED), F.lit(False))


def starts_confirmed(status: Column) -> Column:
    """The stricter gate of the stakeholder summary: the status begins with the word."""
    return F.coalesce(status.startswith(CONFIRMED), F.lit(False))


def confirmed(audit: DataFrame) -> DataFrame:
    """Confirmed datasets. One whose scope has no readable access log is never one, if the audit says so."""
    known = F.coalesce("history_ok", F.lit(True)) if "history_ok" in audit.columns else F.lit(True)
    return audit.where(contains_confirmed(F.col("deletion_status")) & known)


def _first_seen(audit: DataFrame) -> DataFrame:
    return audit.groupBy("tranche").agg(F.min(sheet_position(audit)).alias("first"))


def list_tranches(audit: DataFrame) -> DataFrame:
    """Distinct tranche labels, null included, in order of first appearance."""
    return _first_seen(audit).orderBy("first").select("tranche")


def tranche_places(audit: DataFrame) -> DataFrame:
    """``tranche, place``: the labels numbered by first appearance."""
    return numbered(_first_seen(audit), [F.col("first")]).select("tranche", "place")


def resolve_tranche(audit: DataFrame, text: str) -> DataFrame:
    """The label meant by ``text``: at most one row.

    An exact label wins; else digits and dots stand for the first label beginning ``Tranche <text>:``. The
    colon keeps ``1`` from meaning ``Tranche 1.1``. No row means the text names no tranche.
    """
    label = F.col("tranche")
    exact = label == text
    wanted = exact | label.startswith(f"Tranche {text}:") if is_number_like(text) else exact
    labels = audit.where(wanted).groupBy("tranche").agg(F.min(sheet_position(audit)).alias("first"))
    return labels.orderBy(exact.desc(), "first").select("tranche").limit(1)


def select_targets(audit: DataFrame, text: str) -> DataFrame:
    """Confirmed datasets of the tranche meant by ``text``; none when it names no tranche."""
    chosen = resolve_tranche(audit, text).scalar()
    return confirmed(audit.where(F.col("tranche") == chosen))


def notice_if_empty(df: DataFrame, message: str) -> DataFrame:
    """One row with ``message`` when ``df`` has no rows, else none."""
    found = df.select(F.lit(1).alias("one")).limit(1).agg(F.count("one").alias("n"))
    return found.where(F.col("n") == 0).select(F.lit(message).alias("message"))
