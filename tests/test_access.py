from datetime import datetime

from pyspark.sql import functions as F

from estate_hygiene.operators import access
from helpers import NOW, ago, job, jobs, records, ref


def naive(when):
    return when.replace(tzinfo=None)


def test_every_reference_is_an_event(spark):
    df = jobs(spark, job("j", ago(1), refs=[ref("d", "a"), ref("d", "b"), ref("e", "a")]))
    assert sorted(records(access.read_events(df, NOW), "dataset_id", "table_id")) == [("d", "a"), ("d", "b"), ("e", "a")]


def test_jobs_without_references_vanish_from_reads(spark):
    df = jobs(spark, job("j", ago(1), refs=None), job("k", ago(1), refs=[]))
    assert records(access.read_events(df, NOW)) == []


def test_other_projects_do_not_count(spark):
    df = jobs(spark, job("j", ago(1), refs=[ref("d", project="q"), ref("d")], dest=ref("d", project="q")))
    assert len(records(access.read_events(df, NOW))) == 1
    assert records(access.write_events(df, NOW)) == []


def test_window_is_strict_and_open_to_the_future(spark):
    df = jobs(
        spark,
        job("edge", ago(180), refs=[ref("d")], dest=ref("d")),
        job("inside", ago(180, -1), refs=[ref("e")], dest=ref("e")),
        job("future", ago(-1), refs=[ref("f")], dest=ref("f")),
    )
    for events in (access.read_events(df, NOW), access.write_events(df, NOW)):
        assert sorted(r[0] for r in records(events, "dataset_id")) == ["e", "f"]
    assert sorted(set(records(access.access_events(df, NOW), "dataset_id"))) == [("e",), ("f",)]


def test_one_pass_equals_two_passes(spark):
    df = jobs(
        spark,
        job("1", ago(1), refs=[ref("d", "a"), ref("d", "b"), ref("e", project="q")], dest=ref("e")),
        job("2", ago(2), refs=None, dest=ref("d")),
        job("3", ago(3), refs=[], dest=None),
        job("4", ago(4), refs=[ref("d")], dest=ref("d", project="q")),
        job("5", ago(5), refs=[ref("d")], dest=None, region="us"),
        job("6", ago(500), refs=[ref("d")], dest=ref("d")),
    )
    columns = ("project_id", "region", "dataset_id", "creation_time", "user_email")
    both = access.access_events(df, NOW)
    assert sorted(records(both.where("not is_write"), *columns)) == sorted(records(access.read_events(df, NOW), *columns))
    assert sorted(records(both.where("is_write"), *columns)) == sorted(records(access.write_events(df, NOW), *columns))


def test_details_are_newest_first_and_cut_at_k(spark):
    rows = [job(str(i), ago(i), user=f"u{i}@x", refs=[ref("d")]) for i in range(1, 9)]
    [row] = access.last_access(jobs(spark, *rows), "READ", NOW).collect()
    assert row.last_access_time == naive(ago(1))
    lines = [f"{ago(i):%Y-%m-%d %H:%M} (u{i}@x)" for i in range(1, 6)]
    assert row.details == "\n".join(lines)


def test_one_job_can_fill_several_slots(spark):
    df = jobs(
        spark,
        job("new", ago(1), user="a", refs=[ref("d", str(t)) for t in range(4)]),
        job("old", ago(2), user="b", refs=[ref("d"), ref("d")]),
    )
    [row] = access.last_access(df, "READ", NOW).collect()
    assert [line.split("(")[1] for line in row.details.split("\n")] == ["a)"] * 4 + ["b)"]


def test_ties_are_ordered_by_user(spark):
    df = jobs(spark, *[job(u, ago(1), user=u, refs=[ref("d")]) for u in "cab"])
    [row] = access.last_access(df, "READ", NOW, k=2).collect()
    assert [line[-2] for line in row.details.split("\n")] == ["a", "b"]


def test_top_k_flat_rows_with_full_tie_break(spark):
    df = jobs(spark, job("j2", ago(1), refs=[ref("d", "b"), ref("d", "a")]), job("j1", ago(1), refs=[ref("d", "z")]))
    order = [*access.newest_first(), F.col("job_id"), F.col("table_id")]
    top = access.top_k_access(access.read_events(df, NOW), access.DATASET, 2, order)
    assert sorted(records(top, "rn", "job_id", "table_id")) == [(1, "j1", "z"), (2, "j2", "a")]


def test_summary_has_reads_and_writes_side_by_side(spark):
    df = jobs(
        spark,
        job("1", ago(1), user="r", refs=[ref("both")], dest=ref("both")),
        job("2", ago(2), user="w", dest=ref("written")),
        job("3", ago(3), user=None, refs=[ref("read")]),
    )
    rows = {r.dataset_id: r for r in access.access_summary(df, NOW).collect()}
    assert rows["both"].last_read_time == rows["both"].last_write_time == naive(ago(1))
    assert rows["written"].last_reads is None and rows["written"].last_read_time is None
    assert rows["written"].last_writes == f"{ago(2):%Y-%m-%d %H:%M} (w)"
    assert rows["read"].last_reads == f"{ago(3):%Y-%m-%d %H:%M} (None)" and rows["read"].last_writes is None


def test_regions_are_kept_apart(spark):
    df = jobs(spark, job("1", ago(1), refs=[ref("d")]), job("2", ago(2), refs=[ref("d")], region="us"))
    got = {r.region: r.last_access_time for r in access.last_access_time(df, "READ", NOW).collect()}
    assert got == {"eu": naive(ago(1)), "us": naive(ago(2))}


def test_table_usage_ignores_the_project_by_default(spark):
    df = jobs(spark, job("1", ago(1), refs=[ref("d", "t", project="q")]), job("2", ago(9), refs=[ref("d", "t")]))
    loose = access.last_access_by_table(df, NOW)
    strict = access.last_access_by_table(df, NOW, match_project=True)
    assert records(loose, "last_accessed") == [(naive(ago(1)),)]
    assert records(strict, "last_accessed") == [(naive(ago(9)),)]


def test_hot_dataset_stays_exact(spark):
    """A third of all events in one dataset, against a plain sort."""
    n = 3000
    base = datetime(2026, 6, 1)
    events = [(i % 3 == 0 and "hot" or f"d{i % 97}", base.replace(second=i % 60, minute=i % 59), f"u{i * 7919 % 1009}") for i in range(n)]
    df = spark.createDataFrame(events, "dataset_id string, creation_time timestamp, user_email string")
    got = records(access.top_k_access(df.repartition(8), ["dataset_id"], 5), "dataset_id", "creation_time", "user_email", "rn")
    expected = []
    for d in {e[0] for e in events}:
        ranked = sorted((e for e in events if e[0] == d), key=lambda e: (-e[1].timestamp(), e[2]))[:5]
        expected += [(*e, i + 1) for i, e in enumerate(ranked)]
    assert sorted(got) == sorted(expected)
