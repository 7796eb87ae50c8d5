import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from estate_hygiene.operators import access, membership
from estate_hygiene.sources import access_days, estate, versions
from helpers import NOW, ago, at, frame, job, jobs, records, ref, schemas, tables


def random_jobs(rng, n):
    rows = []
    for i in range(n):
        when = at("2026-06-01T00:00:00") + timedelta(seconds=rng.randrange(23 * 86400))
        refs = [ref(rng.choice("abc"), project=rng.choice("ppq")) for _ in range(rng.randrange(3))]
        rows.append(job(str(i), when, f"u{rng.randrange(4)}", refs, ref(rng.choice("abc")) if rng.random() < 0.4 else None, rng.choice("pq")))
    return rows


def test_folded_days_give_the_summary_of_the_whole_window(spark, tmp_path):
    rows, root = random_jobs(random.Random(1), 400), str(tmp_path / "days")
    log = jobs(spark, *rows)
    fold = lambda df, first, last: access_days.fold_days(df, root, date.fromisoformat(first), date.fromisoformat(last), 3)
    fold(log.where("user_email <> 'u1'"), "2026-06-01", "2026-06-20")
    fold(log, "2026-06-21", "2026-06-23")
    fold(log, "2026-06-10", "2026-06-20")  # again, with the rows that came late
    fold(log.where("creation_time < '2026-06-10'"), "2026-06-01", "2026-06-09")
    as_of = "2026-06-23 15:30:00"
    for days in (1, 5, 13, 20):
        want = access.access_summary(log, as_of, 3, days)
        assert sorted(records(access_days.access_summary(spark, root, as_of, 3, days)), key=str) == sorted(records(want), key=str)
    read = access_days.read_days(spark, root, as_of, 2, 3)
    assert {f.split("version=")[1][0] for f in read.inputFiles()} == {"2"}


def test_a_day_without_a_fold_is_no_day_without_access(spark, tmp_path):
    root = str(tmp_path / "days")
    log = jobs(spark, job("1", ago(1), refs=[ref("d")]))
    access_days.fold_days(log, root, date(2026, 6, 20), date(2026, 6, 23), 3)
    with pytest.raises(ValueError, match="2026-06-24"):
        access_days.read_days(spark, root, NOW, 3, 3)
    access_days.fold_days(log, root, date(2026, 6, 24), date(2026, 6, 24), 3)
    assert access_days.read_days(spark, root, NOW, 3, 3).count() == 1
    with pytest.raises(ValueError, match="2026-06-24"):
        access_days.read_days(spark, root, NOW, 3, 5)


def test_membership_lets_every_member_through(spark):
    keys = spark.range(3_000).selectExpr("cast(id as string) a", "if(id % 2 = 0, null, id) b")
    others = spark.range(20_000).selectExpr("cast(id + 3000 as string) a", "id b")
    bits = membership.membership(keys, ["a", "b"])
    let = lambda df: df.where(membership.may_be_member(bits, [F.col("a"), F.col("b")])).count()
    assert let(keys) == 3_000 and let(others) < 2_000
    none = membership.membership(keys.where("false"), ["a", "b"])
    assert keys.where(membership.may_be_member(none, [F.col("a"), F.col("b")])).count() == 0


def test_last_access_among_some_tables(spark):
    log = jobs(spark, *random_jobs(random.Random(2), 100))
    whole = access.last_access_by_table(log, NOW)
    some = whole.where("dataset_id = 'a'").drop("last_accessed")
    found = access.last_access_by_table(log, NOW, among=some)
    assert sorted(records(found.where("dataset_id = 'a'"))) == sorted(records(whole.where("dataset_id = 'a'"))) != []


def test_a_ledger_of_what_could_be_read(spark, tmp_path):
    root, scopes = str(tmp_path), [("p", "eu"), ("q", "eu"), ("r", "eu"), ("s", "eu")]
    made = {
        "schemata": frame(spark, schemas.SCHEMATA, [{"schema_name": "d", "project_id": p, "region": r} for p, r in scopes]),
        "table_storage": frame(spark, schemas.TABLE_STORAGE, [{"table_schema": "d", "table_name": "t", "project_id": "p", "region": "eu"}]),
        "tables": tables(spark, {"table_schema": "d", "table_name": "t"}),
        "jobs": jobs(spark, *[job("1", ago(1), refs=[ref("d", project=p)], project=p) for p, _ in scopes]),
    }
    for name, df in made.items():
        estate.write_by_scope(df, f"{root}/{name}")
    for name, project in (("schemata", "q"), ("jobs", "r")):
        [file] = (tmp_path / name / f"project_id={project}" / "region=eu").glob("part-*.parquet")
        file.write_bytes(b"nothing")
        file.with_name(f".{file.name}.crc").unlink()
    spark.sql("select 'x' job_id").write.mode("overwrite").parquet(f"{root}/jobs/project_id=s/region=eu")
    found = estate.load_estate(spark, root, [*scopes, ("t", "eu")])
    ledger = {(r.project_id, r.source): (r.ok, (r.error or "").split(":")[0].split(".")[0]) for r in found.loads.collect()}
    assert len(ledger) == 15 and ledger["p", "METADATA"] == (True, "") and ledger["p", "READ"] == (True, "")
    assert not ledger["q", "METADATA"][0] and ledger["q", "READ"][0]
    assert ledger["r", "METADATA"][0] and not ledger["r", "READ"][0] and not ledger["r", "WRITE"][0]
    assert ledger["s", "READ"] == (False, "COLUMNS_MISSING") and ledger["t", "METADATA"] == (False, "PATH_NOT_FOUND")
    assert sorted(records(found.schemata, "project_id")) == [("p",), ("r",), ("s",)]
    assert sorted(records(found.jobs, "project_id")) == [("p",), ("q",)] and found.schema_options.count() == 0
    assert records(found.table_storage, "table_schema") == [("d",)] and versions.committed(spark, root) == []
