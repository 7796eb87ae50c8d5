from estate_hygiene.operators import report
from helpers import NOW, ago, audit, records, state

TITLE = [
    "# Decommissioning Status Report",
    "",
    "Generated: 2026-06-24T12:00:00",
    "Made from the workflow state and the control table; edits to this text are lost when it is made again",
    "",
]


def text(lines):
    return [r.line for r in lines.orderBy("block", "section", "part", "key").collect()]


def test_empty_state(spark):
    assert text(report.render_report(state(spark), audit(spark), NOW)) == [*TITLE, report.EMPTY_LINE]


def test_report_text(spark):
    entries = state(
        spark,
        {"key": "p:z", "status": "restored", "scream_initiated_at": ago(30), "tranche": "T"},
        {"key": "p:b", "scream_initiated_at": ago(7), "tranche": "T"},
        {"key": "p:a", "scream_initiated_at": ago(7, -1), "tranche": None},
        {"key": "p:n", "scream_initiated_at": None, "tranche": "T"},
        {"key": "p:o", "status": "odd", "tranche": "T", "scream_initiated_at": ago(8)},
        {"key": "p:u", "status": None, "tranche": "T", "scream_initiated_at": ago(8)},
    )
    sheet = audit(
        spark,
        {"dataset": "b", "size_gb": 1234567.5, "monthly_cost": 24691.35},
        {"dataset": "z", "size_gb": 10.0, "monthly_cost": None},
    )
    head = ["", report.COLUMN_LINE, report.RULE_LINE]
    assert text(report.render_report(entries, sheet, NOW)) == [
        *TITLE,
        "## Restored (1)", *head,
        "| p:z | T | 10.0 | n/a | 2026-05-25T12:00:00 | 30 |  |",
        "",
        "## Scream Test Active (3)", *head,
        "| p:a |  | n/a | n/a | 2026-06-17T12:00:01 | 6 |  |",
        "| p:b | T | 1234567.5 | 24691.35 | 2026-06-17T12:00:00 | 7 | YES |",
        "| p:n | T | n/a | n/a |  | n/a |  |",
        "",
        "## odd (1)", *head,
        "| p:o | T | n/a | n/a | 2026-06-16T12:00:00 | 8 |  |",
        "",
        "## unknown (1)", *head,
        "| p:u | T | n/a | n/a | 2026-06-16T12:00:00 | 8 |  |",
        "",
        "## Totals",
        "- Datasets tracked: 6",
        "- Combined size: 1,234,577.50 GB",
        "- Combined monthly cost: $24,691.35",
    ]


def test_totals_and_counts(spark):
    entries = state(spark, {"key": "p:b", "status": "deleted"}, {"key": "p:a"}, {"key": "p:c"})
    rows = report.status_rows(entries, audit(spark, {"dataset": "a", "size_gb": 0.1}, {"dataset": "b", "size_gb": 0.2}), NOW)
    assert tuple(report.status_totals(rows).first()) == (3, 0.3, 0.04)
    assert records(report.status_counts(rows), "status_label", "datasets") == [("Deleted", 1), ("Scream Test Active", 2)]


def test_the_last_sheet_row_of_a_key_counts(spark):
    sheet = audit(
        spark,
        {"dataset": "d", "region": "eu", "size_gb": 1.0, "description": "last"},
        {"dataset": "d", "region": "us", "size_gb": 2.0, "description": "first"},
    )
    assert records(report.audit_context(sheet), "region", "size_gb", "description") == [("eu", 1.0, "last")]


def test_ready_follows_the_given_retention(spark):
    entries = state(spark, {"key": "p:d", "scream_initiated_at": ago(10)})
    ready = lambda days: report.status_rows(entries, audit(spark), NOW, days).first().ready
    assert (ready(10), ready(11)) == ("YES", "")
