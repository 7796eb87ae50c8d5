import json
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from estate_hygiene import schemas
from estate_hygiene.operators import report, selection
from estate_hygiene.sources import estate, state_json, tables, versions
from helpers import NOW, ago, audit, frame, job, jobs, records, ref, schemata, state


def naive(when):
    return when.replace(tzinfo=None)


def test_estate_tables_roundtrip_and_scope(spark, tmp_path):
    df = jobs(spark, job("1", ago(1), refs=[ref("d")]), job("2", ago(2), project="q"), job("3", ago(3), region="us", dest=ref("d")))
    estate.write_by_scope(df, str(tmp_path / "jobs"))
    back = estate.read_jobs(spark, str(tmp_path / "jobs"))
    assert back.schema == schemas.JOBS and sorted(records(back)) == sorted(records(df))
    assert records(estate.scope(back, ["p"], ["eu"]), "job_id") == [("1",)]
    assert sorted(records(estate.scope(back, regions=["eu"]), "job_id")) == [("1",), ("2",)]
    estate.write_by_scope(schemata(spark, "d", "e"), str(tmp_path / "schemata"))
    assert estate.read_schemata(spark, str(tmp_path / "schemata")).count() == 2


def test_zoneless_parquet_times_are_read_as_utc(spark, tmp_path):
    path = str(tmp_path / "jobs")
    spark.sql("select 'j' job_id, timestamp_ntz'2026-01-01 10:00:00' creation_time, 'p' project_id, 'eu' region").write.parquet(path)
    assert records(estate.read_jobs(spark, path).selectExpr("unix_seconds(creation_time)")) == [(1767261600,)]


def test_audit_is_replaced_by_the_next_version(spark, tmp_path):
    root = str(tmp_path / "audit")
    assert tables.read_audit(spark, root).count() == 0
    assert tables.write_audit(audit(spark, {"dataset": "a"}, {"dataset": "b"}), root) == 2
    replaced = tables.read_audit(spark, root).where("dataset = 'a'")
    assert tables.write_audit(replaced, root) == 1
    assert records(tables.read_audit(spark, root), "dataset") == [("a",)]


def test_an_audit_without_rows_keeps_the_last_one(spark, tmp_path):
    root = str(tmp_path / "audit")
    tables.write_audit(audit(spark, {"dataset": "a"}), root)
    assert tables.write_audit(audit(spark), root, version=2) == 0
    assert records(tables.read_audit(spark, root), "dataset") == [("a",)]


def test_audit_from_csv(spark, tmp_path):
    rows = audit(spark, {"dataset": "d", "last_reads": 'line (a)\nline "two" (b)', "description": None})
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(str(tmp_path / "sheet"))
    got = tables.read_audit_csv(spark, str(tmp_path / "sheet"))
    assert records(got, "dataset", "size_gb", "last_reads") == [("d", 1.0, 'line (a)\nline "two" (b)')]


def test_bundle_members_are_replaced_one_by_one(spark, tmp_path):
    bundle = str(tmp_path / "bundle")
    tables.write_bundle(audit(spark, {"dataset": "a"}), bundle)
    tables.write_member(audit(spark, {"dataset": "b"}, {"dataset": "c"}), bundle, "audit_results")
    assert tables.read_member(spark, bundle, "readme").count() == 7
    assert tables.read_member(spark, bundle, "audit_results").count() == 2
    with pytest.raises(KeyError):
        tables.read_member(spark, bundle, "other")


def test_a_bundle_whose_second_member_fails_reads_as_before(spark, tmp_path):
    bundle = str(tmp_path / "bundle")
    tables.write_bundle(audit(spark, {"dataset": "a"}), bundle)
    broken = audit(spark, {"dataset": "b"}).withColumn("dataset", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        tables.write_members({"readme": tables.data_dictionary(spark).limit(1), "audit_results": broken}, bundle)
    assert tables.read_member(spark, bundle, "readme").count() == 7
    assert records(tables.read_member(spark, bundle, "audit_results"), "dataset") == [("a",)]
    tables.write_member(audit(spark, {"dataset": "c"}), bundle, "audit_results")
    assert records(tables.read_member(spark, bundle, "audit_results"), "dataset") == [("c",)]


def test_an_emptied_state_and_plan_read_back_empty(spark, tmp_path):
    root = str(tmp_path / "state")
    assert tables.write_state(state(spark, {"key": "p:a"}), root) == 1
    assert tables.write_state(tables.read_state(spark, root).where("false"), root) == 0
    assert tables.read_state(spark, root).count() == 0
    assert [tuple(r) for r in versions.history(spark, root).collect()] == [(1, 1), (2, 0)]
    assert tables.write_state(state(spark, {"key": "p:b"}), root) == 1
    assert records(tables.read_state(spark, root), "key") == [("p:b",)]


def test_of_two_writers_of_a_version_one_succeeds(spark, tmp_path):
    root, start = str(tmp_path / "state"), threading.Barrier(2)
    made = [state(spark, {"key": "p:a"}), state(spark, {"key": "p:b"}, {"key": "p:c"})]

    def write(df):
        start.wait()
        try:
            return tables.write_state(df, root, version=1)
        except versions.VersionTaken as taken:
            return taken

    with ThreadPoolExecutor(2) as pool:
        results = list(pool.map(write, made))
    assert sum(isinstance(r, versions.VersionTaken) for r in results) == 1
    won = [len(m.collect()) for m, r in zip(made, results, strict=True) if isinstance(r, int)]
    assert [tables.read_state(spark, root).count()] == won and versions.committed(spark, root) == [1]


def test_a_lost_writer_leaves_the_last_version_and_its_number(spark, tmp_path):
    root = str(tmp_path / "state")
    tables.write_state(state(spark, {"key": "p:a"}), root)
    broken = state(spark, {"key": "p:b"}).withColumn("status", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        tables.write_state(broken, root)
    assert records(tables.read_state(spark, root), "key") == [("p:a",)] and tables.next_version(spark, root) == 3


def test_a_sheet_of_several_files_keeps_their_order(spark, tmp_path):
    folder, header = tmp_path / "sheet", ",".join(f.name for f in schemas.AUDIT.fields if f.name not in ("history_ok", "seq"))
    folder.mkdir()
    row = lambda dataset, tranche, size: f"p,eu,{dataset},,{size},1.0,{tranche}" + "," * 9 + "CONFIRMED"
    files = {"a.csv": [row("z", "Tranche 2: B", 1.0)], "b.csv": [row(f"d{i}", "Tranche 1: A", i) for i in range(300)], "c.csv": [row("z", "Tranche 1: Z", 9.0), row("d5", "Tranche 3: C", 77.0)]}
    for name, rows in files.items():
        (folder / name).write_text("\n".join([header, *rows]) + "\n")
    sheet = tables.read_audit_csv(spark, str(folder))
    assert [r.seq for r in sheet.orderBy("seq").collect()] == list(range(1, 304))
    assert records(selection.list_tranches(sheet)) == [("Tranche 2: B",), ("Tranche 1: A",), ("Tranche 1: Z",), ("Tranche 3: C",)]
    assert records(selection.resolve_tranche(sheet, "1")) == [("Tranche 1: A",)]
    context = {r.key: r.size_gb for r in report.audit_context(sheet).collect()}
    assert context["p:z"] == 9.0 and context["p:d5"] == 77.0 and context["p:d6"] == 6.0


def test_state_can_be_rewritten_from_itself(spark, tmp_path):
    root = str(tmp_path / "state")
    tables.write_state(state(spark, {"key": "p:a"}, {"key": "p:b"}), root)
    tables.write_state(tables.read_state(spark, root).where("key = 'p:b'"), root)
    assert records(tables.read_state(spark, root), "key", "seq") == [("p:b", 1)]


def test_newest_snapshot_per_path(spark, tmp_path):
    root = str(tmp_path / "snapshots")
    make = lambda *rows: spark.createDataFrame(list(rows), schemas.SNAPSHOTS)
    tables.write_snapshots(make(("p:a", "eu", "x/a", "old"), ("p:b", "eu", "x/b", "only")), root)
    tables.write_snapshots(make(("p:a", "eu", "x/a", "new")), root)
    tables.write_snapshots(make(("p:a", "eu", "x/a", None)), root)  # a failed backup hides no earlier one
    assert sorted(records(tables.read_policy_snapshot(spark, root))) == [("p:a", "eu", "x/a", "new"), ("p:b", "eu", "x/b", "only")]


def test_two_policies_for_one_path_are_both_kept(spark, tmp_path):
    root = str(tmp_path / "snapshots")
    make = lambda *rows: spark.createDataFrame(list(rows), schemas.SNAPSHOTS)
    tables.write_snapshots(make(("p:a", "eu", "x/a", "1"), ("p:a", "us", "x/a", "2"), ("p:b", "eu", "x/b", "3"), ("p:b", "us", "x/b", "3")), root)
    expected = [("p:a", "eu", "x/a", "1"), ("p:a", "us", "x/a", "2"), ("p:b", "eu", "x/b", "3")]
    assert sorted(records(tables.read_policy_snapshot(spark, root))) == expected
    assert tables.compact_snapshots(spark, root) == 3
    tables.write_snapshots(make(("p:a", "eu", "x/a", "4")), root)
    assert sorted(records(tables.read_policy_snapshot(spark, root))) == [("p:a", "eu", "x/a", "4"), ("p:b", "eu", "x/b", "3")]


def test_changes_fold_to_the_newest_record_of_a_key(spark, tmp_path):
    root = str(tmp_path / "state")
    tables.append_state(state(spark, {"key": "p:a"}), root)
    tables.write_state(state(spark, {"key": "p:b"}, {"key": "p:c"}), root)
    tables.append_state(state(spark, {"key": "p:b", "status": "deleted"}, {"key": "p:d"}), root)
    tables.append_state(state(spark, {"key": "p:b", "status": "restored", "tranche": None}), root)
    expected = [("p:b", "restored", None), ("p:c", "scream_test", state(spark, {"key": "p:c"}).first().tranche)]
    assert sorted(records(tables.read_state(spark, root).where("key < 'p:d'"), "key", "status", "tranche")) == expected
    before = sorted(records(tables.read_state(spark, root), "key", "status", "seq"))
    assert tables.compact_state(spark, root) == 3 and versions.committed(spark, root) == [1, 2, 3, 4, 5]
    after = tables.read_state(spark, root)
    assert sorted(records(after, "key", "status", "seq")) == before and len(after.inputFiles()) <= 4
    assert all("version=5" in f for f in after.inputFiles())


def test_compaction_waits_for_changes_that_are_being_written(spark, tmp_path):
    root = str(tmp_path / "state")
    tables.write_state(state(spark, {"key": "p:a"}), root)
    versions.claim(spark, root, 2)  # by a writer that vanished
    tables.append_state(state(spark, {"key": "p:b"}), root)
    with pytest.raises(versions.VersionTaken):
        tables.compact_state(spark, root)
    versions.abandon(spark, root, 2)
    with pytest.raises(versions.VersionTaken):
        versions.commit(spark, root, 2, {"rows": 0})
    with pytest.raises(versions.VersionTaken):
        versions.abandon(spark, root, 3)
    assert tables.compact_state(spark, root) == 2 and versions.committed(spark, root) == [1, 3, 4]


def test_a_version_that_was_not_committed_is_not_read(spark, tmp_path):
    root = str(tmp_path / "audit")
    assert tables.write_audit(audit(spark, {"dataset": "a"}, {"dataset": "b"}), root) == 2
    audit(spark, {"dataset": "c"}).write.parquet(f"{root}/version=2")
    assert sorted(records(tables.read_audit(spark, root), "dataset")) == [("a",), ("b",)]
    assert tables.next_version(spark, root) == 3
    for taken in (1, 2):
        with pytest.raises(versions.VersionTaken):
            tables.write_audit(audit(spark, {"dataset": "d"}), root, version=taken)


def write(tmp_path, text):
    path = tmp_path / "state.json"
    path.write_text(text)
    return str(path)


def test_state_from_json(spark, tmp_path):
    document = {
        "p:b": {"project": "p", "dataset": "b", "tranche": "T", "backup_path": "x", "scream_initiated_at": "2026-06-01T10:00:00.000250", "status": "scream_test"},
        "p:a": {"project": "p", "dataset": "a", "tranche": "T", "backup_path": "x", "scream_initiated_at": "2026-06-01T10:00:00", "status": "deleted", "deleted_at": "2026-06-09T00:00:00"},
    }
    got = state_json.read_state_json(spark, write(tmp_path, json.dumps(document, indent=2)))
    assert got.schema.fieldNames() == schemas.STATE.fieldNames()
    rows = sorted(got.collect(), key=lambda r: r.seq)
    assert [(r.key, r.status, r.seq) for r in rows] == [("p:b", "scream_test", 0), ("p:a", "deleted", 1)]
    assert rows[0].scream_initiated_at.isoformat() == document["p:b"]["scream_initiated_at"] and rows[1].restored_at is None
    exported = {r.key: json.loads(r.record_json) for r in state_json.state_json_entries(got).collect()}
    assert exported == document


def test_missing_and_malformed_state(spark, tmp_path):
    nowhere = str(tmp_path / "none.json")
    assert state_json.read_state_json(spark, nowhere).count() == 0
    with pytest.raises(AnalysisException):
        state_json.read_state_json(spark, nowhere, missing="error")
    assert state_json.read_state_json(spark, write(tmp_path, "{}")).count() == 0
    broken = write(tmp_path, "{not json")
    assert state_json.read_state_json(spark, broken).count() == 0
    with pytest.raises(Exception, match="(?i)malformed"):
        state_json.read_state_json(spark, broken, malformed="error").collect()


def test_report_files_keep_line_order(spark, tmp_path):
    entries = state(spark, *[{"key": f"p:{i:03}", "status": ("scream_test", "deleted")[i % 2]} for i in range(50)])
    lines = report.render_report(entries, audit(spark, {"dataset": "001"}), NOW)
    root = str(tmp_path / "report")
    assert tables.read_report(spark, root).count() == 0
    tables.write_report(lines.limit(3), root)
    assert tables.write_report(lines, root) == 2
    parts = sorted((tmp_path / "report" / "version=2").glob("part-*"))
    text = [line for part in parts for line in part.read_text().split("\n")[:-1]]
    assert text == [r.line for r in lines.collect()] and text[0].startswith("# ") and len(text) == 5 + 2 * 5 + 50 + 4
    back = tables.read_report(spark, root).orderBy("line_no").collect()
    assert [tuple(r) for r in back] == list(enumerate(text, 1))


def test_log_is_appended(spark, tmp_path):
    path = str(tmp_path / "log")
    actions = spark.createDataFrame([("p:a", "restrict", "done")], "key string, action string, message string")
    assert tables.read_log(spark, path).count() == 0
    assert [tables.append_log(actions, path, ago(1), 7), tables.append_log(actions, path, NOW), tables.append_log(actions, path, NOW, 7)] == [1, 1, 0]
    log = tables.read_log(spark, path)
    assert sorted(r.line for r in tables.log_lines(log).collect()) == ["[2026-06-23T12:00:00] done", "[2026-06-24T12:00:00] done"]
