"""Status report over the workflow state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from estate_hygiene.functions.names import dataset_key
from estate_hygiene.functions.numbers import exact_total, float_text, thousands
from estate_hygiene.functions.timestamps import floor_days, instant, iso_text, utc
from estate_hygiene.operators.lifecycle import RETENTION_DAYS, SCREAM_TEST
from estate_hygiene.operators.ordering import sheet_position
from estate_hygiene.operators.selection import notice_if_empty

# Fixed values.
STATUS_LABELS = {"scream_test": "Scream Test Active", "deleted": "Deleted", "restored": "Restored"}
UNKNOWN_STATUS = "unknown"
NOT_AVAILABLE = "n/a"
COLUMN_LINE = "| Dataset | Tranche | Size (GB) | Monthly Cost ($) | Initiated | Days Elapsed | Ready for Phase D |"
RULE_LINE = "|---|---|---|---|---|---|---|"
EMPTY_LINE = "No entries in state.json yet — no Scream Tests have been initiated (or this is dry-run only)."

SOURCE_LINE = "Made from the {}; edits to this text are lost when it is made again"

HEAD, BODY, TOTALS = 0, 1, 2


def status_label(status: Column) -> Column:
    """Display label; other statuses show as they are, a missing one as unknown."""
    label = F.coalesce(status, F.lit(UNKNOWN_STATUS))
    for name, text in STATUS_LABELS.items():
        label = F.when(status == name, text).otherwise(label)
    return label


def audit_context(audit: DataFrame) -> DataFrame:
    """Size, cost, region and description per key. Where a key repeats, the last row of the sheet counts."""
    last = F.max_by(F.struct("size_gb", "monthly_cost", "region", "description"), sheet_position(audit))
    by_key = audit.groupBy(dataset_key(F.col("project"), F.col("dataset")).alias("key")).agg(last.alias("last"))
    return by_key.select("key", "last.*")


def status_rows(
    state: DataFrame, audit: DataFrame, as_of: datetime | str, retention_days: int = RETENTION_DAYS
) -> DataFrame:
    """State with its audit context, days since initiation and the flag for final deletion."""
    rows = state.join(audit_context(audit), "key", "left")
    elapsed = floor_days(instant(as_of), F.col("scream_initiated_at"))
    ready = (elapsed >= retention_days) & (F.col("status") == SCREAM_TEST)
    return rows.select(
        F.coalesce("status", F.lit(UNKNOWN_STATUS)).alias("status"),
        status_label(F.col("status")).alias("status_label"),
        "key",
        "tranche",
        "size_gb",
        "monthly_cost",
        F.coalesce(iso_text(F.col("scream_initiated_at")), F.lit("")).alias("initiated_at"),
        elapsed.alias("days_elapsed"),
        F.when(ready, "YES").otherwise("").alias("ready"),
        "seq",
    )


def status_counts(rows: DataFrame) -> DataFrame:
    """Entries per status, statuses in order of first appearance."""
    counts = rows.groupBy("status", "status_label").agg(
        F.count(F.lit(1)).alias("datasets"), F.min("seq").alias("first_seq")
    )
    return counts.orderBy("first_seq")


def status_totals(rows: DataFrame) -> DataFrame:
    """Number of entries and their combined size and cost; unknown sizes and costs are passed over."""
    return rows.agg(
        F.count(F.lit(1)).alias("datasets"),
        exact_total(F.col("size_gb")).alias("size_gb"),
        exact_total(F.col("monthly_cost")).alias("monthly_cost"),
    )


def _part(part: int, line: Column) -> Column:
    return F.struct(F.lit(part).alias("part"), line.alias("line"))


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(NOT_AVAILABLE))


def _lines(df: DataFrame, block: int, section: Column, key: Column, lines: list[tuple[int, Column]]) -> DataFrame:
    """Rows of text under the columns that order a report: block, section, part, key."""
    parts = F.array(*[_part(part, text) for part, text in lines])
    exploded = df.select(
        F.lit(block).alias("block"), section.cast("bigint").alias("section"), key.alias("key"), F.explode(parts).alias("p")
    )
    return exploded.select("block", "section", "p.part", "key", "p.line")


def render_report(
    state: DataFrame,
    audit: DataFrame,
    as_of: datetime | str,
    retention_days: int = RETENTION_DAYS,
    title: str = "Decommissioning Status Report",
    source: str = "workflow state and the control table",
) -> DataFrame:
    """The Markdown report as lines, in the order of block, section, part and key.

    A section's number is the first ``seq`` of its status. No line is numbered across the whole report, so
    rendering stays distributed.
    """
    none, zero = F.lit(""), F.lit(0)
    rows = status_rows(state, audit, as_of, retention_days)
    generated = utc(as_of).replace(tzinfo=None).isoformat()
    head = _lines(
        state.sparkSession.range(1),
        HEAD,
        zero,
        none,
        [
            (0, F.lit(f"# {title}")),
            (1, none),
            (2, F.lit(f"Generated: {generated}")),
            (3, F.lit(SOURCE_LINE.format(source))),
            (4, none),
        ],
    )
    nothing = _lines(notice_if_empty(state, EMPTY_LINE), HEAD, zero, none, [(5, F.col("message"))])

    # One aggregation yields the counts of the sections and, as the grand total, the closing lines.
    sums = rows.groupingSets([["status", "status_label"], []], "status", "status_label").agg(
        F.grouping_id().alias("level"),
        F.count(F.lit(1)).alias("datasets"),
        F.min("seq").alias("first_seq"),
        exact_total(F.col("size_gb")).alias("size_gb"),
        exact_total(F.col("monthly_cost")).alias("monthly_cost"),
    )
    of_status = F.col("level") == 0
    number = F.col("datasets").cast("string")
    summary = sums.select(
        F.when(of_status, BODY).otherwise(TOTALS).alias("block"),
        F.when(of_status, F.col("first_seq")).otherwise(0).alias("section"),
        none.alias("key"),
        F.when(
            of_status,
            F.array(
                _part(0, F.concat(F.lit("## "), "status_label", F.lit(" ("), number, F.lit(")"))),
                _part(1, none),
                _part(2, F.lit(COLUMN_LINE)),
                _part(3, F.lit(RULE_LINE)),
                _part(5, none),
            ),
        )
        .otherwise(
            F.array(
                _part(0, F.lit("## Totals")),
                _part(1, F.concat(F.lit("- Datasets tracked: "), number)),
                _part(2, F.concat(F.lit("- Combined size: "), thousands(F.col("size_gb"), 2), F.lit(" GB"))),
                _part(3, F.concat(F.lit("- Combined monthly cost: $"), thousands(F.col("monthly_cost"), 2))),
            )
        )
        .alias("parts"),
    )
    summary = summary.select("block", "section", "key", F.explode("parts").alias("p"))
    summary = summary.select("block", "section", "p.part", "key", "p.line")

    cells = [
        F.col("key"),
        F.coalesce("tranche", none),
        _text(float_text(F.col("size_gb"))),
        _text(float_text(F.col("monthly_cost"))),
        F.col("initiated_at"),
        _text(F.col("days_elapsed").cast("string")),
        F.col("ready"),
    ]
    row_line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    # A map of the few statuses, so that rows need no join on a key of three values.
    first = state.groupBy(F.coalesce("status", F.lit(UNKNOWN_STATUS)).alias("status")).agg(F.min("seq").alias("first_seq"))
    section = first.agg(F.map_from_entries(F.collect_list(F.struct("status", "first_seq"))).alias("first_of")).scalar()
    body = _lines(rows.withColumn("section", section[F.col("status")]), BODY, F.col("section"), F.col("key"), [(4, row_line)])
    order = ("block", "section", "part", "key")
    return head.unionByName(nothing).unionByName(summary).unionByName(body).orderBy(*order)
