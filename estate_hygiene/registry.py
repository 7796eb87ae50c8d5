"""The registered queries, each a callable of (spark, sf_dir) over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce
from threading import RLock

from pyspark.sql import DataFrame, SparkSession, functions as F

from estate_hygiene import fixtures as fx
from estate_hygiene.functions.names import bucket_of, dataset_key
from estate_hygiene.functions.timestamps import utc, wall_clock
from estate_hygiene.operators.ordering import numbered, sheet_order
from estate_hygiene.operators import access, lifecycle, policy, report, restore, selection, storage, summary
from estate_hygiene.plans import audits
from estate_hygiene.session import own_folder, use_utc
from estate_hygiene.sources import access_days, estate, tables, versions

AS_OF = fx.AS_OF
ORGANISATIONS = {"A": "first.example.com"}
OTHER_ORGANISATION = "second.example.com"

Query = Callable[[SparkSession, str], DataFrame]

_folders: dict[tuple[str, str, str], str] = {}
_folders_lock = RLock()


def _stored(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]) -> str:
    """Folder of a table that ``write`` fills once per application, in the shared folder of the cluster.

    Steps of the workflow meet in stored tables, as they do in use: lifecycle, reports and summaries read the
    audit instead of repeating it, and outcomes are reported on a plan that was written down.
    """
    spot = (spark.sparkContext.applicationId, sf_dir, name)
    with _folders_lock:
        if spot not in _folders:
            root = own_folder(spark, name)
            write(root)
            _folders[spot] = root
        return _folders[spot]


def deep_history_audit(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return audits.deep_history_audit(
        fx.schemata(spark, sf_dir),
        fx.schema_options(spark, sf_dir),
        fx.table_storage(spark, sf_dir),
        fx.jobs(spark, sf_dir),
        AS_OF,
        **options,
    )


def control_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(root: str) -> int:
        return tables.write_audit(deep_history_audit(spark, sf_dir, ordered=False), root, version=1)

    return tables.read_audit(spark, _stored(spark, sf_dir, "control", write))


def _dataset_as(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"project_id": "project", "dataset_id": "dataset"})


def last_read_by_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = access.last_access_time(fx.jobs(spark, sf_dir), "READ", AS_OF)
    return _dataset_as(found).withColumn("last_access_time", wall_clock(F.col("last_access_time")))


def last_write_by_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = access.last_access_time(fx.jobs(spark, sf_dir), "WRITE", AS_OF)
    return _dataset_as(found).withColumn("last_access_time", wall_clock(F.col("last_access_time")))


def top_k_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = access.read_events(fx.jobs(spark, sf_dir), AS_OF)
    order = [*access.newest_first(), F.col("job_id").asc(), F.col("table_id").asc()]
    top = access.top_k_access(events, access.DATASET, 2, order)
    return (
        _dataset_as(top)
        .withColumn("creation_time", wall_clock(F.col("creation_time")))
        .withColumn("rn", F.col("rn").cast("bigint"))
    )


def _details(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    found = access.last_access(fx.jobs(spark, sf_dir), kind, AS_OF)
    return _dataset_as(found).withColumn("last_access_time", wall_clock(F.col("last_access_time")))


def read_details_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _details(spark, sf_dir, "READ")


def write_details_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _details(spark, sf_dir, "WRITE")


def dataset_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = storage.dataset_metadata(
        fx.schemata(spark, sf_dir), fx.schema_options(spark, sf_dir), fx.table_storage(spark, sf_dir)
    )
    return _dataset_as(found).withColumn("last_storage_modified", wall_clock(F.col("last_storage_modified")))


def table_last_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = access.last_access_by_table(fx.jobs(spark, sf_dir), AS_OF)
    return _dataset_as(found).withColumn("last_accessed", wall_clock(F.col("last_accessed")))


def largest_tables_per_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = storage.largest_tables(fx.tables(spark, sf_dir), fx.table_storage(spark, sf_dir))
    return (
        _dataset_as(found)
        .withColumn("creation_time", wall_clock(F.col("creation_time")))
        .withColumn("size_rank", F.col("size_rank").cast("bigint"))
    )


def stale_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.stale_table_audit(
        fx.tables(spark, sf_dir),
        fx.table_storage(spark, sf_dir),
        fx.jobs(spark, sf_dir),
        AS_OF,
        projects=fx.PROJECTS,
        regions=fx.REGIONS,
        organisations=ORGANISATIONS,
        default_organisation=OTHER_ORGANISATION,
    )


def access_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.access_audit(
        fx.schemata(spark, sf_dir),
        fx.schema_options(spark, sf_dir),
        fx.table_storage(spark, sf_dir),
        fx.jobs(spark, sf_dir),
        AS_OF,
    )


def tranche_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.tranche_audit(
        fx.schemata(spark, sf_dir),
        fx.schema_options(spark, sf_dir),
        fx.table_storage(spark, sf_dir),
        fx.jobs(spark, sf_dir),
        AS_OF,
    )


def exported_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.with_headers(tranche_audit(spark, sf_dir), audits.TRANCHE_HEADERS)


def exported_access_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.with_headers(access_audit(spark, sf_dir), audits.ACCESS_HEADERS)


def exported_deep_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.with_headers(deep_history_audit(spark, sf_dir), audits.DEEP_HEADERS)


def exported_stale_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.with_headers(stale_tables(spark, sf_dir), audits.TABLE_HEADERS)


def scope_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Effect of a denied access log: confirmed datasets per scope with and without the history rule."""
    coverage = estate.scope_coverage(fx.scopes(spark, sf_dir), fx.loads(spark, sf_dir))
    audit = deep_history_audit(spark, sf_dir, coverage=coverage, require_history=True)
    gone = F.col("days_since_modified") > 365
    per_scope = audit.groupBy("project", "region", "history_ok").agg(
        F.count(F.lit(1)).alias("datasets"),
        F.count_if(gone).alias("without_rule"),
        F.count_if(selection.contains_confirmed(F.col("deletion_status"))).alias("with_rule"),
    )
    return per_scope


def audit_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fresh audit, written and read back."""
    root = own_folder(spark, "audit")
    coverage = estate.scope_coverage(fx.scopes(spark, sf_dir), fx.loads(spark, sf_dir))
    tables.write_audit(deep_history_audit(spark, sf_dir, ordered=False, coverage=coverage), root, version=1)
    return tables.read_audit(spark, root).drop("seq")


def confirmed_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.confirmed(control_table(spark, sf_dir)).select(
        "project", "region", "dataset", "tranche", "size_gb", "monthly_cost", "deletion_status"
    )


def tranche_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.list_tranches(control_table(spark, sf_dir))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.tranche1_candidates(control_table(spark, sf_dir))


def tranche1_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir).select(
        "project", "region", "dataset", "tranche", "size_gb", "monthly_cost", "last_reads", "deletion_status"
    )


def reader_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.reader_summary(_candidates(spark, sf_dir))


def unread_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.unread_datasets(_candidates(spark, sf_dir))


def bulk_scan_insight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.bulk_scan_insight(_candidates(spark, sf_dir))


def candidate_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.candidate_totals(_candidates(spark, sf_dir))


def recency_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.recency_series(_candidates(spark, sf_dir))


def top_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.top_cost(_candidates(spark, sf_dir))


def tranche_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.tranche_overview(control_table(spark, sf_dir))


def restricted_policy_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy.restricted_policy_entries(fx.policies(spark, sf_dir))


def revoked_policy_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy.revoked_policy_entries(fx.policies(spark, sf_dir))


def labels_after_scream_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = policy.label_dataset(policy.labels_of(F.col("policy_json")))
    return fx.policies(spark, sf_dir).select(
        F.col("project_id").alias("project"),
        "region",
        F.col("dataset_id").alias("dataset"),
        policy.labels_text(labels).alias("labels"),
    )


def policy_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backups of everything in the state."""
    control = control_table(spark, sf_dir)
    in_state = control.join(
        fx.state(control).select("project", "dataset"), ["project", "dataset"], "left_semi"
    )
    return policy.snapshot_policies(fx.policies(spark, sf_dir), in_state, fx.BACKUP_ROOT)


def backed_up_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scream-test plan after its policies were stored and read back, those of one project lost on the way."""
    plan = _stored_scream_plan(spark, sf_dir)

    def write(root: str) -> int:
        return tables.write_snapshots(policy.snapshots_of(plan.where(F.col("project") != "ASIA")), root)

    stored = tables.read_policy_snapshot(spark, _stored(spark, sf_dir, "plan-snapshots", write))
    gated = lifecycle.require_backup(plan, stored)
    kept = F.try_parse_json("restricted_policy")
    return gated.select(
        "key", "region", "action", "reason", "set_label",
        F.try_variant_get(kept, "$.access[0].role", "string").alias("first_role"),
        F.try_variant_get(kept, "$.access[1].role", "string").alias("second_role"),
    )


def restored_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access entries of the policies that a restore of everything would put back."""
    plan = _restore_plan(spark, sf_dir, every=True)
    entries = F.try_variant_get(F.try_parse_json("policy_json"), "$.access", "array<variant>")
    exploded = plan.where(F.col("action") == "restore").select("key", F.posexplode(entries).alias("position", "entry"))
    return exploded.select(
        "key", F.col("position").cast("bigint").alias("position"), F.try_variant_get("entry", "$.role", "string").alias("role")
    )


def action_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a scream test, a purge and a restore, appended to one log and read back."""
    root = own_folder(spark, "log")
    scream, purge, back = _stored_scream_plan(spark, sf_dir), _purge_plan(spark, sf_dir), _restore_plan(spark, sf_dir, every=True)
    runs = [lifecycle.scream_test_log(scream, fx.outcomes(scream)), lifecycle.purge_log(purge, fx.outcomes(purge)), restore.restore_log(back, fx.outcomes(back))]
    for run, lines in enumerate(runs, 1):
        tables.append_log(lines, root, AS_OF, run)
    tables.append_log(runs[0], root, AS_OF, 1)  # started again: adds nothing
    return tables.log_lines(tables.read_log(spark, root)).select("line")


def state_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state written twice, the second time after a purge: the newer version is read."""
    root = own_folder(spark, "state")
    state = fx.state(control_table(spark, sf_dir))
    tables.write_state(state, root)
    now = tables.read_state(spark, root)
    tables.write_state(lifecycle.apply_purge(now, fx.outcomes(_purge_plan(spark, sf_dir)), AS_OF), root)
    return _state_out(tables.read_state(spark, root))


def audit_without_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The access audit where a denied access log forbids any call for deletion."""
    coverage = estate.scope_coverage(fx.scopes(spark, sf_dir), fx.loads(spark, sf_dir))
    found = audits.access_audit(
        fx.schemata(spark, sf_dir), fx.schema_options(spark, sf_dir), fx.table_storage(spark, sf_dir), fx.jobs(spark, sf_dir),
        AS_OF, coverage=coverage, require_history=True,
    )
    return found.select("project", "region", "dataset", "status", "priority", "action", "history_ok")


def estate_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset metadata of two of the projects, from estate tables that were stored by scope and read back."""
    root = own_folder(spark, "estate")
    made = {"schemata": fx.schemata, "schema_options": fx.schema_options, "table_storage": fx.table_storage}
    readers = {"schemata": estate.read_schemata, "schema_options": estate.read_schema_options, "table_storage": estate.read_table_storage}
    back = []
    for name, make in made.items():
        estate.write_by_scope(make(spark, sf_dir), f"{root}/{name}")
        back.append(estate.scope(readers[name](spark, f"{root}/{name}"), ["ASIA", "EUROPE"], fx.REGIONS))
    return _dataset_as(storage.dataset_metadata(*back)).withColumn("last_storage_modified", wall_clock(F.col("last_storage_modified")))


def sheet_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each dataset among those of its project, in the order of the control sheet."""
    control = control_table(spark, sf_dir)
    placed = numbered(control.select("project", "region", "dataset", "tranche", "size_gb"), [F.col("project"), *sheet_order()])
    firsts = placed.groupBy(F.col("project").alias("of")).agg(F.min("place").alias("first"))
    found = placed.join(firsts, F.col("project") == F.col("of"))
    return found.select("project", "region", "dataset", (F.col("place") - F.col("first") + 1).alias("place"))


def _places(audit: DataFrame, order: list, *keys: str) -> DataFrame:
    return numbered(audit, order).select(*keys, "place")


def access_audit_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the access audit in their order."""
    return _places(access_audit(spark, sf_dir), audits.access_order(), "project", "region", "dataset", "priority")


def tranche_audit_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the tranche audit in their order."""
    return _places(tranche_audit(spark, sf_dir), audits.tranche_order(), "project", "region", "dataset", "tranche")


def stale_table_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the table audit in their order."""
    return _places(stale_tables(spark, sf_dir), audits.waste_order(), "project", "region", "dataset", "table_name")


def reader_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the reader summary in their order."""
    return _places(reader_summary(spark, sf_dir), summary.reader_order(), "reader", "datasets")


def empty_plan_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan and a state stored, stored again without rows, and stored once more: what is read after each."""
    plan, state = _stored_scream_plan(spark, sf_dir), fx.state(control_table(spark, sf_dir))
    roots = {"plan": own_folder(spark, "emptied-plan"), "state": own_folder(spark, "emptied-state")}
    found = []
    for step, keep in enumerate((F.lit(True), F.lit(False), F.col("project") != "ASIA"), 1):
        tables.write_version(plan.where(keep), roots["plan"])
        tables.write_state(state.where(keep), roots["state"])
        reads = {"plan": tables.read_latest(spark, roots["plan"], plan.schema), "state": tables.read_state(spark, roots["state"])}
        found += [df.agg(F.lit(name).alias("name"), F.lit(step).cast("bigint").alias("step"), F.count(F.lit(1)).alias("rows")) for name, df in reads.items()]
    return reduce(DataFrame.unionByName, found)


def written_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts that the writers of audit, state and backups have left, version by version."""
    root = own_folder(spark, "counted")
    control = control_table(spark, sf_dir)
    tables.write_audit(control, f"{root}/audit")
    tables.write_audit(control.where(F.col("deletion_status") == "REVIEW"), f"{root}/audit")
    tables.write_state(fx.state(control), f"{root}/state")
    tables.append_state(fx.state(control).where(F.col("status") == "restored"), f"{root}/state")
    tables.write_snapshots(policy_snapshot(spark, sf_dir), f"{root}/backups")
    counts = [versions.history(spark, f"{root}/{name}").select(F.lit(name).alias("name"), "version", "rows") for name in ("audit", "state", "backups")]
    return reduce(DataFrame.unionByName, counts)


def bundle_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts of an exported bundle, one member of which was replaced."""
    root = own_folder(spark, "bundle")
    audit = tranche_audit(spark, sf_dir)
    tables.write_bundle(audit, root)
    tables.write_member(audit.where(F.col("project") != "ASIA"), root, "audit_results")
    readme, results = tables.read_member(spark, root, "readme"), tables.read_member(spark, root, "audit_results")
    texts = F.concat_ws("|", "description", "tranche", "priority", "last_reads", "last_writes")
    return readme.select(
        F.lit("readme").alias("member"), F.col("category").alias("name"), F.concat("definition", F.lit(": "), "detail").alias("text")
    ).unionByName(results.select(F.lit("audit_results").alias("member"), F.concat_ws(":", "project", "region", "dataset").alias("name"), texts.alias("text")))


def _sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(root: str) -> None:
        fx.write_sheet(fx.hand_kept_sheet(control_table(spark, sf_dir)), f"{root}/sheet")

    return tables.read_audit_csv(spark, f"{_stored(spark, sf_dir, 'sheet', write)}/sheet")


def sheet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hand-kept sheet of several files with repeated keys: its tranches in order of appearance, the first that "1" means,
    and the size that counts for each key."""
    sheet = _sheet(spark, sf_dir)
    none = F.lit(None).cast("double").alias("size_gb")
    listed = selection.tranche_places(sheet).select(F.lit("tranche").alias("kind"), F.col("tranche").alias("name"), "place", none)
    meant = selection.resolve_tranche(sheet, "1").select(F.lit("meant by 1").alias("kind"), F.col("tranche").alias("name"), F.lit(1).cast("bigint").alias("place"), none)
    sizes = report.audit_context(sheet).select(F.lit("key").alias("kind"), F.col("key").alias("name"), F.lit(None).cast("bigint").alias("place"), "size_gb")
    return listed.unionByName(meant).unionByName(sizes)


def repeated_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scream-test plan of a sheet in which datasets are entered twice: each is restricted once."""
    targets = selection.confirmed(_sheet(spark, sf_dir))
    plan = lifecycle.plan_scream_test(targets, fx.state(control_table(spark, sf_dir)), fx.policies(spark, sf_dir), AS_OF, fx.BACKUP_ROOT)
    return plan.groupBy("key", "action", "reason").agg(F.count(F.lit(1)).alias("rows"))


def broken_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An estate on disk, parts of which cannot be read: what the readers' own ledger says of each scope, and how many
    datasets, confirmed datasets and tables the audits find there."""
    root = own_folder(spark, "broken")
    made = {"schemata": fx.schemata, "schema_options": fx.schema_options, "table_storage": fx.table_storage, "tables": fx.tables, "jobs": fx.jobs}
    for name, make in made.items():
        estate.write_by_scope(make(spark, sf_dir), f"{root}/{name}")
    fx.break_estate(spark, root)
    wanted = [(p, r) for p in fx.PROJECTS for r in fx.REGIONS]
    found = estate.load_estate(spark, root, wanted)
    scopes = spark.createDataFrame(wanted, "project_id string, region string")
    coverage = estate.scope_coverage(scopes, found.loads)
    audit = audits.deep_history_audit(
        found.schemata, found.schema_options, found.table_storage, found.jobs, AS_OF, coverage=coverage, require_history=True, ordered=False
    )
    stale = audits.stale_table_audit(found.tables, found.table_storage, found.jobs, AS_OF, coverage=coverage)
    datasets = audit.groupBy("project", "region").agg(
        F.count(F.lit(1)).alias("datasets"),
        F.count_if(selection.contains_confirmed(F.col("deletion_status"))).alias("confirmed"),
        F.count_if(F.col("last_reads") != audits.NO_READS).alias("read"),
    )
    unused = stale.groupBy("project", F.regexp_replace("region", "^region-", "").alias("region")).agg(F.count(F.lit(1)).alias("unused_tables"))
    per_scope = coverage.withColumnRenamed("project_id", "project").join(datasets, ["project", "region"], "left").join(unused, ["project", "region"], "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("datasets", "confirmed", "read", "unused_tables")]
    return per_scope.select("project", "region", "metadata_ok", "history_ok", *counts)


def incremental_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The access summary from days that were folded one after another: the window first, then two more days."""
    root, end = own_folder(spark, "days"), utc(AS_OF).date()
    first = end - timedelta(days=access.LOOKBACK_DAYS)
    for start, last in ((first, end - timedelta(days=2)), (end - timedelta(days=1),) * 2, (end,) * 2):
        access_days.fold_days(fx.jobs(spark, sf_dir), root, start, last)
    found = _dataset_as(access_days.access_summary(spark, root, AS_OF))
    return found.withColumns({c: wall_clock(F.col(c)) for c in ("last_read_time", "last_write_time")})


def many_largest_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 1,500 largest tables of each scope where a few sizes are shared by all tables."""
    sizes = fx.table_storage(spark, sf_dir).withColumn("total_logical_bytes", F.pmod("total_logical_bytes", F.lit(7)) + 1)
    found = storage.largest_tables(fx.tables(spark, sf_dir), sizes, 1_500)
    return _dataset_as(found).select("project", "region", "dataset", "table_name", "size_gb", "size_rank")


def state_after_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after a scream test, a purge and a restore, each of which adds its changes only, compacted on the way."""
    root = own_folder(spark, "batches")
    plan = _stored_scream_plan(spark, sf_dir)
    tables.write_state(fx.state(control_table(spark, sf_dir)), root)
    tables.append_state(lifecycle.scream_test_changes(tables.read_state(spark, root), plan, fx.outcomes(plan), AS_OF), root)
    now = tables.read_state(spark, root)
    tables.append_state(lifecycle.purge_changes(now, fx.outcomes(lifecycle.plan_purge(now, AS_OF)), AS_OF), root)
    tables.compact_state(spark, root)
    now = tables.read_state(spark, root)
    back = restore.select_restore(now, every=True).withColumn("action", F.lit("restore"))
    tables.append_state(lifecycle.restore_changes(now, fx.outcomes(back), AS_OF), root)
    return _state_out(tables.read_state(spark, root))


def report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the report as they stand in the files that were written."""
    root = own_folder(spark, "report")
    control = control_table(spark, sf_dir)
    tables.write_report(report.render_report(fx.state(control), control, AS_OF), root)
    return tables.read_report(spark, root)


def report_without_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's lines of datasets that the audit does not know, and of a state without entries."""
    control = control_table(spark, sf_dir)
    state = fx.state(control)
    unknown = report.render_report(state.where(F.col("project") == "ASIA"), control.where(F.col("project") != "ASIA"), AS_OF).where("key <> ''")
    empty = report.render_report(state.where(F.lit(False)), control, AS_OF)
    return unknown.select("key", "line").unionByName(empty.where("part = 5").select("key", "line"))


def deep_audit_unknown_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deep audit where a dataset whose last modification is unknown counts as neither abandoned nor stale."""
    found = deep_history_audit(spark, sf_dir, null_storage="unknown", ordered=False)
    return found.select("project", "region", "dataset", "tranche", "priority", "days_since_activity", "days_since_modified", "last_storage_update", "deletion_status")


def backup_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets that hold the backups of the state."""
    paths = fx.state(control_table(spark, sf_dir)).select(bucket_of(F.col("backup_path")).alias("bucket"))
    return paths.groupBy("bucket").agg(F.count(F.lit(1)).alias("backups"))


def _stored_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(root: str) -> int:
        return tables.write_snapshots(policy_snapshot(spark, sf_dir), root, version=1)

    return tables.read_policy_snapshot(spark, _stored(spark, sf_dir, "snapshots", write))


def _scream_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = control_table(spark, sf_dir)
    return lifecycle.plan_scream_test(
        selection.select_targets(control, "1"),
        fx.state(control),
        fx.policies(spark, sf_dir),
        AS_OF,
        fx.BACKUP_ROOT,
    )


def _stored_scream_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _scream_plan(spark, sf_dir)

    def write(root: str) -> int:
        return tables.write_version(plan, root, version=1)

    return tables.read_latest(spark, _stored(spark, sf_dir, "scream-plan", write), plan.schema)


def scream_test_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scream_plan(spark, sf_dir).select(
        "key", "project", "region", "dataset", "tranche", "size_gb", "monthly_cost", "action", "reason",
        "backup_path", "set_label",
    )


def scream_test_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _stored_scream_plan(spark, sf_dir)
    return lifecycle.scream_test_log(plan, fx.outcomes(plan))


def _state_out(state: DataFrame) -> DataFrame:
    times = {c: wall_clock(F.col(c)) for c in ("scream_initiated_at", "deleted_at", "restored_at")}
    return state.drop("seq").withColumns(times)


def state_after_scream_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _stored_scream_plan(spark, sf_dir)
    state = fx.state(control_table(spark, sf_dir))
    return _state_out(lifecycle.apply_outcomes(state, plan, fx.outcomes(plan), AS_OF))


def _purge_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.plan_purge(fx.state(control_table(spark, sf_dir)), AS_OF)


def purge_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _purge_plan(spark, sf_dir)


def state_after_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = fx.state(control_table(spark, sf_dir))
    return _state_out(lifecycle.apply_purge(state, fx.outcomes(_purge_plan(spark, sf_dir)), AS_OF))


def _restore_plan(spark: SparkSession, sf_dir: str, **choice) -> DataFrame:
    state = fx.state(control_table(spark, sf_dir))
    return restore.plan_restore(restore.select_restore(state, **choice), _stored_snapshots(spark, sf_dir))


def _restore_out(plan: DataFrame) -> DataFrame:
    return plan.select("key", "project", "dataset", "tranche", "prior_status", "action", "reason", "backup_path")


def restore_by_tranche(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _restore_out(_restore_plan(spark, sf_dir, tranche="2"))


def restore_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _restore_out(_restore_plan(spark, sf_dir, every=True))


def _requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every confirmed dataset is asked for; the state knows only some."""
    return selection.confirmed(control_table(spark, sf_dir)).select(
        dataset_key(F.col("project"), F.col("dataset")).alias("key")
    )


def restore_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _restore_out(_restore_plan(spark, sf_dir, keys=_requested(spark, sf_dir)))


def restore_unknown_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restore.unknown_keys(fx.state(control_table(spark, sf_dir)), _requested(spark, sf_dir))


def _restore_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _restore_plan(spark, sf_dir, keys=_requested(spark, sf_dir))
    return restore.restore_results(plan, fx.outcomes(plan))


def restore_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restore.outcome_counts(_restore_results(spark, sf_dir))


def restore_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restore.failed_keys(_restore_results(spark, sf_dir))


def state_after_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _restore_plan(spark, sf_dir, every=True)
    state = fx.state(control_table(spark, sf_dir))
    return _state_out(lifecycle.apply_restore(state, fx.outcomes(plan), AS_OF))


def _status_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = control_table(spark, sf_dir)
    return report.status_rows(fx.state(control), control, AS_OF)


def status_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status_rows(spark, sf_dir)


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.status_counts(_status_rows(spark, sf_dir))


def other_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of a state that holds statuses the library does not know, and entries without one."""
    control = control_table(spark, sf_dir)
    state = fx.state(control)
    other = F.when(F.col("project") == "ASIA", "on hold").when(F.col("project") != "EUROPE", F.col("status"))
    return report.status_counts(report.status_rows(state.withColumn("status", other), control, AS_OF))


def status_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.status_totals(_status_rows(spark, sf_dir))


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = control_table(spark, sf_dir)
    lines = report.render_report(fx.state(control), control, AS_OF)
    return lines.withColumns({c: F.col(c).cast("bigint") for c in ("block", "section", "part")})


_QUERIES = (
    last_read_by_dataset,
    last_write_by_dataset,
    top_k_reads,
    read_details_text,
    write_details_text,
    dataset_metadata,
    table_last_access,
    largest_tables_per_scope,
    stale_tables,
    access_audit,
    tranche_audit,
    exported_audit,
    exported_access_audit,
    exported_deep_audit,
    exported_stale_tables,
    deep_history_audit,
    scope_coverage,
    audit_roundtrip,
    confirmed_targets,
    tranche_list,
    tranche1_candidates,
    reader_summary,
    unread_datasets,
    bulk_scan_insight,
    candidate_totals,
    recency_series,
    top_cost,
    tranche_overview,
    restricted_policy_entries,
    revoked_policy_entries,
    labels_after_scream_test,
    policy_snapshot,
    scream_test_plan,
    scream_test_log,
    state_after_scream_test,
    purge_plan,
    state_after_purge,
    restore_by_tranche,
    restore_all,
    restore_by_key,
    restore_unknown_keys,
    restore_outcomes,
    restore_failures,
    state_after_restore,
    backed_up_plan,
    restored_entries,
    action_log,
    state_roundtrip,
    audit_without_history,
    estate_roundtrip,
    sheet_ranks,
    access_audit_places,
    tranche_audit_places,
    stale_table_places,
    reader_places,
    empty_plan_roundtrip,
    written_rows,
    bundle_roundtrip,
    sheet_roundtrip,
    repeated_targets,
    broken_scopes,
    incremental_access,
    many_largest_tables,
    state_after_batches,
    report_roundtrip,
    report_without_context,
    deep_audit_unknown_storage,
    backup_buckets,
    status_rows,
    status_counts,
    other_status_counts,
    status_totals,
    report_lines,
)


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(use_utc(spark), sf_dir)

    run.__name__ = query.__name__
    return run


def registered() -> dict[str, Query]:
    return {query.__name__: _in_utc(query) for query in _QUERIES}
