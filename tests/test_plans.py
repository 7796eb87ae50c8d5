"""What the optimizer makes of the operators: pruning, pushdown, top-k before the shuffle, no Python."""

import re
from datetime import date

import pytest

from estate_hygiene import fixtures, registry
from estate_hygiene.operators import access, storage as storage_ops
from estate_hygiene.plans import audits
from estate_hygiene.sources import access_days, estate
from helpers import NOW, ago, job, jobs, ref, stored, storage, tables

SMALL = "/root/testdata/sf0.001"


def physical(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture(scope="module")
def stored_jobs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("estate") / "jobs")
    estate.write_by_scope(jobs(spark, job("1", ago(1), refs=[ref("d")], dest=ref("d")), job("2", ago(1), project="q")), path)
    return estate.scope(estate.read_jobs(spark, path), ["p"], ["eu"])


def scan(plan):
    return [line for line in plan.split("\n") if "FileScan parquet" in line]


def test_scopes_prune_directories_and_the_window_reaches_parquet(stored_jobs):
    for df in (access.access_summary(stored_jobs, NOW), access.last_access_time(stored_jobs, "WRITE", NOW)):
        [line] = scan(physical(df))
        assert re.search(r"PartitionFilters: \[.*project_id = p.*region = eu", line)
        assert "GreaterThan(creation_time" in line or "creation_time >" in line


def test_one_scan_of_the_job_log_without_job_and_table_ids(stored_jobs):
    [line] = scan(stored_jobs_plan := physical(access.access_summary(stored_jobs, NOW)))
    assert "job_id" not in line and "table_id" not in line
    assert stored_jobs_plan.count("WindowGroupLimit") == 2


def test_write_times_do_not_read_the_references(stored_jobs):
    [line] = scan(physical(access.last_access_time(stored_jobs, "WRITE", NOW)))
    assert "referenced_tables" not in line and "user_email" not in line


def test_read_times_read_no_users(stored_jobs):
    [line] = scan(physical(access.last_access_time(stored_jobs, "READ", NOW)))
    assert "user_email" not in line and "destination_table" not in line and "table_id" not in line


def test_top_k_is_cut_before_the_shuffle(stored_jobs):
    plan = physical(access.last_access(stored_jobs, "READ", NOW))
    assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit.*, 5, Partial", plan)


def test_largest_tables_are_cut_before_the_scope_shuffle(spark):
    sized = storage(spark, stored("d"))
    catalogue = tables(spark, {"table_schema": "d", "table_name": "t", "creation_time": ago(1)})
    plan = physical(storage_ops.largest_tables(catalogue, sized))
    assert re.search(r"Exchange hashpartitioning\(project_id, region, \d+\).*\n.*WindowGroupLimit.*, 100, Partial", plan)


def test_many_largest_tables_meet_in_no_task_of_their_scope(spark):
    n = 6_000  # of one scope and one size
    sized = storage(spark, *[stored("d", table=f"t{i:04}") for i in range(n)])
    catalogue = tables(spark, *[{"table_schema": "d", "table_name": f"t{i:04}", "creation_time": ago(1)} for i in range(n)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a few rows would be put together
    try:
        found = storage_ops.largest_tables(catalogue, sized, 5_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plan = physical(found)
    assert not re.search(r"Window \[.*windowspecdefinition\(project_id", plan)
    assert sorted((r.table_name, r.size_rank) for r in found.collect()) == [(f"t{i:04}", i + 1) for i in range(5_000)]
    ranges = spark.read.parquet(*{f.rpartition("/")[0] for f in found.inputFiles() if "ordered-" in f}).groupBy("range").count().collect()
    assert len(ranges) > 1 and max(r["count"] for r in ranges) < n / 2


def test_references_to_other_tables_go_before_their_shuffle(spark):
    args = (fixtures.tables(spark, SMALL), fixtures.table_storage(spark, SMALL), fixtures.jobs(spark, SMALL), fixtures.AS_OF)
    plan = physical(audits.stale_table_audit(*args, projects=fixtures.PROJECTS, regions=fixtures.REGIONS))
    shuffled = r"Exchange hashpartitioning\(project_id, region, dataset_id, table_name.*\n.*HashAggregate.*\n.*Project.*\n.*Filter .*getbit\("
    assert re.search(shuffled, plan)


def test_only_the_days_asked_for_are_read(stored_jobs):
    plan = physical(access_days.folded(stored_jobs, date(2026, 6, 22), date(2026, 6, 23)))
    [line] = scan(plan)
    assert "GreaterThanOrEqual(creation_time,2026-06-22" in line and "LessThan(" in line.split("PushedFilters")[1]
    assert "creation_time < 2026-06-24 00:00:00" in plan


@pytest.mark.parametrize("top_n", [100, 5_000])
def test_no_hint_forces_a_broadcast(spark, top_n):
    args = (fixtures.tables(spark, SMALL), fixtures.table_storage(spark, SMALL), fixtures.jobs(spark, SMALL), fixtures.AS_OF)
    df = audits.stale_table_audit(*args, projects=fixtures.PROJECTS, regions=fixtures.REGIONS, top_n=top_n)
    assert "strategy=broadcast" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_kept_events_are_bounded(spark, stored_jobs):
    with pytest.raises(ValueError):
        access.access_summary(stored_jobs, NOW, 1_000)


def test_top_n_reports_use_a_bounded_heap(spark):
    registry.use_utc(spark)
    for name in ("recency_series", "top_cost"):
        assert "TakeOrderedAndProject" in physical(registry.registered()[name](spark, SMALL))


@pytest.mark.parametrize("name", list(registry.registered()))
def test_no_python_and_no_cross_joins(spark, name):
    plan = physical(registry.registered()[name](spark, SMALL))
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
