import random
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from estate_hygiene.functions import names, numbers, timestamps
from helpers import at, evaluate


def rounded(spark, values):
    return evaluate(spark, numbers.round2(F.col("x")), "x double", [(v,) for v in values])


def test_round2_equals_python_round(spark):
    rng = random.Random(7)
    values = [0.0, 2.675, 1.005, 0.125, 0.375, 0.625, 0.875, 2.5, 1e9 + 0.005, 123456.785, 99.995]
    values += [n / 1000 for n in range(0, 20000, 5)]
    values += [rng.uniform(0, 1e6) for _ in range(5000)]
    values += [rng.randrange(10**9) / 1024**3 * 1024 for _ in range(5000)]
    assert rounded(spark, values) == [round(v, 2) for v in values]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(min_value=0, max_value=1e12, allow_nan=False), min_size=1, max_size=200))
def test_round2_property(spark, values):
    assert rounded(spark, values) == [round(v, 2) for v in values]


def test_round2_keeps_null(spark):
    assert rounded(spark, [None]) == [None]


def test_monthly_cost_uses_unrounded_size(spark):
    assert evaluate(spark, numbers.monthly_cost(F.col("x")), "x double", [(0.249,), (100.0,)]) == [0.0, 2.0]


def test_exact_total_ignores_nulls_and_empty_is_zero(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,)], "x double")
    assert df.agg(numbers.exact_total(F.col("x"))).first()[0] == 0.3
    assert df.where("false").agg(numbers.exact_total(F.col("x"))).first()[0] == 0.0


def test_float_text_matches_python(spark):
    values = [0.0, 10.0, 12.5, 0.02, 12345678.9, 1.25]
    assert evaluate(spark, numbers.float_text(F.col("x")), "x double", [(v,) for v in values]) == [str(v) for v in values]
    assert evaluate(spark, numbers.float_text(F.col("x")), "x double", [(1.234,), (1e9,)]) == ["1.234", "1000000000.0"]


@pytest.mark.parametrize(
    "earlier,later,days",
    [
        ("2026-01-01 23:00:00", "2026-01-02 01:00:00", 0),
        ("2026-01-01 00:00:00", "2026-01-02 00:00:00", 1),
        ("2026-01-01 00:00:01", "2026-01-02 00:00:00", 0),
        ("2026-01-02 00:00:00", "2026-01-01 23:59:59", -1),
        ("2025-01-01 00:00:00", "2026-01-01 00:00:00", 365),
    ],
)
def test_floor_days_is_timedelta_days(spark, earlier, later, days):
    assert (at(later) - at(earlier)).days == days
    got = evaluate(spark, timestamps.floor_days(F.col("a"), F.col("b")), "a timestamp, b timestamp", [(at(later), at(earlier))])
    assert got == [days]


def test_instant_takes_naive_as_utc_and_keeps_offsets(spark):
    same = ["2026-01-01 12:00:00", datetime(2026, 1, 1, 12), datetime(2026, 1, 1, 14, tzinfo=timezone(timedelta(hours=2)))]
    assert len({evaluate(spark, F.unix_micros(timestamps.instant(m)))[0] for m in same}) == 1


def test_latest_skips_nulls(spark):
    got = evaluate(
        spark,
        timestamps.latest(F.col("a"), F.col("b"), F.col("c")),
        "a timestamp, b timestamp, c timestamp",
        [(None, at("2026-01-02"), at("2026-01-01")), (None, None, None)],
    )
    assert got == [datetime(2026, 1, 2), None]


def test_time_text(spark):
    plain, fine = at("2026-01-31 08:05:00"), at("2026-01-31 08:05:00.000120")
    rows = [(plain,), (fine,)]
    assert evaluate(spark, timestamps.offset_text(F.col("x")), "x timestamp", rows) == [str(plain), str(fine)]
    naive = [plain.replace(tzinfo=None).isoformat(), fine.replace(tzinfo=None).isoformat()]
    assert evaluate(spark, timestamps.iso_text(F.col("x")), "x timestamp", rows) == naive
    assert evaluate(spark, timestamps.minute_text(F.col("x")), "x timestamp", rows) == ["2026-01-31 08:05"] * 2


def test_test_names_match_substrings(spark):
    cases = {
        "My_TEST": True, "temp": True, "tmp_x": True, "demo1": True, "poc": True, "beta": True,
        "latest": True, "template": True, "epoch": True, "sales": False, "te_st": False,
    }
    got = evaluate(spark, names.is_test_name(F.col("x")), "x string", [(n,) for n in cases])
    assert got == list(cases.values())


def test_description_loses_outer_quotes_only(spark):
    rows = [('"a "b" c"',), ('""x""',), (None,), (" y ",)]
    got = evaluate(spark, names.clean_description(F.col("x")), "x string", rows)
    assert got == ['a "b" c', "x", "No Description", " y "]


def test_capitalise_is_python_capitalize(spark):
    texts = ["single read", "Service account, single-day Bulk scan", "", "A"]
    got = evaluate(spark, names.capitalise(F.col("x")), "x string", [(t,) for t in texts])
    assert got == [t.capitalize() for t in texts]


def test_organisation_by_prefix(spark):
    org = names.organisation(F.col("x"), {"a-": "one", "ab": "two"}, "other")
    assert evaluate(spark, org, "x string", [("a-1",), ("ab1",), ("c",)]) == ["one", "two", "other"]


def test_bucket_of(spark):
    rows = [("gs://bucket/backups/x.json",), ("backups/x.json",)]
    assert evaluate(spark, names.bucket_of(F.col("x")), "x string", rows) == ["bucket", None]
