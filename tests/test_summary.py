import pytest

from estate_hygiene.operators import summary
from helpers import ago, audit, records

WHEN = "2026-06-0{} 10:00"


def read(n, who):
    return f"{WHEN.format(n)} ({who})\n2020-01-01 00:00 (older)"


@pytest.fixture()
def candidates(spark):
    return audit(
        spark,
        {"dataset": "a", "last_reads": read(1, "bot@x.gserviceaccount.com"), "size_gb": 5.0},
        {"dataset": "b", "last_reads": read(3, "bot@x.gserviceaccount.com"), "size_gb": 4.0},
        {"dataset": "b", "region": "us", "last_reads": read(2, "bot@x.gserviceaccount.com"), "size_gb": 3.5},
        {"dataset": "c", "last_reads": read(2, "u@x"), "size_gb": 3.0},
        {"dataset": "d", "size_gb": 2.0},
        {"dataset": "e", "last_reads": "odd text", "size_gb": 1.0},
    )


def test_candidates_need_tranche_1_and_a_confirmed_start(spark):
    sheet = audit(
        spark,
        {"dataset": "a"},
        {"dataset": "b", "tranche": "Tranche 1.1: x"},
        {"dataset": "c", "deletion_status": "UNCONFIRMED"},
        {"dataset": "d", "tranche": None},
        {"dataset": "e", "deletion_status": None},
    )
    assert records(summary.tranche1_candidates(sheet), "dataset") == [("a",)]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("No Read Access (180d)", (None, None)),
        ("2026-06-01 10:00 (u@x)", ("2026-06-01 10:00", "u@x")),
        ("  2026-06-01 10:00  ( u@x ) \nmore (z)", ("2026-06-01 10:00", "u@x")),
        ("no brackets", ("no brackets", None)),
        ("(u)", ("", "u")),
        ("a (b) (c)", ("a (b)", "c")),
        (None, (None, None)),
    ],
)
def test_last_reader(spark, text, expected):
    got = summary.parse_last_reader(audit(spark, {"dataset": "d", "last_reads": text}))
    assert records(got, "last_read_when", "last_read_who") == [expected]


def test_reader_summary(candidates):
    assert records(summary.reader_summary(candidates)) == [
        ("bot@x.gserviceaccount.com", 2, WHEN.format(3), "Service account, single-day bulk scan"),
        ("u@x", 1, WHEN.format(2), "Single read"),
    ]


def test_unread_datasets_in_sheet_order(candidates):
    assert records(summary.unread_datasets(candidates), "dataset") == [("d",), ("e",)]


def test_bulk_scan_insight(candidates):
    assert summary.bulk_scan_insight(candidates).first().asDict() == {
        "candidates": 6,
        "datasets_with_reads": 3,
        "bulk_scanned_datasets": 2,
        "bulk_readers": 1,
    }
    assert tuple(summary.bulk_scan_insight(candidates.where("false")).first()) == (0, 0, 0, 0)


def test_candidate_totals(spark, candidates):
    got = summary.candidate_totals(audit(spark, {"dataset": "a", "size_gb": 1234.5, "monthly_cost": 2000.1}, {"dataset": "b", "size_gb": None}))
    assert tuple(got.first()) == (2, 1234.5, 2000.12, "1,234", "2,000.12")


def test_recency_series(spark):
    sheet = audit(
        spark,
        *[{"dataset": f"d{i:02}", "days_since_activity": i, "days_since_modified": 2 * i} for i in range(20)],
        {"dataset": "read", "days_since_activity": 99, "last_read_time": ago(99), "days_since_modified": 400},
        {"dataset": "unknown", "days_since_activity": None},
    )
    got = records(summary.recency_series(sheet), "dataset", "days_since_read", "days_since_modified")
    assert got == [("read", 99.0, 400.0)] + [(f"d{i:02}", None, 2.0 * i) for i in range(19, 5, -1)]


def test_top_cost(spark):
    sheet = audit(spark, *[{"dataset": f"d{i}", "monthly_cost": 1000.5 * i, "size_gb": 50025.0 * i} for i in range(8)])
    got = records(summary.top_cost(sheet), "dataset", "days_inactive", "size_text", "cost_text")
    assert got[0] == ("d7", "400", "350,175.00", "7,003.50") and [r[0] for r in got] == [f"d{i}" for i in range(7, 1, -1)]


def test_tranche_overview(spark):
    t1, t3 = "Tranche 1: Abandoned Test/Temp (>1yr)", "Tranche 3: Abandoned Small Prod (>1yr)"
    sheet = audit(
        spark,
        {"dataset": "a", "tranche": t1, "project": "p", "size_gb": 0.1, "monthly_cost": 0.1},
        {"dataset": "b", "tranche": t1, "project": "q", "size_gb": 0.2, "monthly_cost": 0.2},
        {"dataset": "c", "tranche": t3, "project": "p", "size_gb": 4.0, "monthly_cost": 0.0},
        {"dataset": "d", "tranche": "Active", "project": "z", "size_gb": 9.0, "monthly_cost": 0.18},
    )
    rows = [(t1, 0.3, 0.3, 2, 2), (t3, 0.0, 4.0, 1, 1), ("Subtotal (Cleanup)", 0.3, 4.3, 3, 3), ("Active", 0.18, 9.0, 1, 1)]
    assert records(summary.tranche_overview(sheet)) == rows
    rows[2] = ("Subtotal (Cleanup)", 0.3, 4.3, 3, 2)
    assert records(summary.tranche_overview(sheet, subtotal_projects="distinct")) == rows
