"""The scream-test workflow as tables: plan, reported outcomes, new state.

A plan is a lazy DataFrame of intended actions; looking at it is the dry run. Whoever carries it out feeds
back ``outcomes(key, ok)``, and an ``apply_*`` operator folds them into the state.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from estate_hygiene import schemas
from estate_hygiene.functions.names import dataset_key
from estate_hygiene.functions.timestamps import floor_days, instant
from estate_hygiene.operators.ordering import sheet_position
from estate_hygiene.operators.policy import (
    CLASH_REASON,
    CLEANUP_LABEL,
    CLEANUP_LABEL_VALUE,
    NO_BACKUP_REASON,
    backup_path,
    one_document,
    restrict_policy,
)

# Fixed values.
SCREAM_TEST, DELETED, RESTORED = "scream_test", "deleted", "restored"
RETENTION_DAYS = 7

# Messages of the action log.
SKIPPING = "Skipping %s - %s"
NO_BACKUP = "Failed to backup %s (%s). Skipping."
SCREAM_DONE = "Scream test applied successfully for %s"
SCREAM_FAILED = "ERROR: Failed to apply scream test for %s - dataset access NOT modified"
NO_LABEL = "WARNING: Failed to label %s - continuing with access restriction"
PURGE_DONE = "Deleted %s"
PURGE_FAILED = "ERROR: Failed to delete %s"


def reported_ok(outcomes: DataFrame) -> DataFrame:
    """Keys that succeeded at least once; repeated reports count once."""
    return outcomes.where("ok").select("key").distinct()


def already_processed(state: DataFrame) -> DataFrame:
    """Entries that a new scream test must leave alone. A restored dataset may be tested again."""
    return state.where(F.col("status").isin(DELETED, SCREAM_TEST)).select("key", F.col("status").alias("state_status"))


def plan_scream_test(
    targets: DataFrame,
    state: DataFrame,
    policies: DataFrame,
    as_of: datetime | str,
    root: str | None,
    safe: Sequence[str] = (),
) -> DataFrame:
    """One row per target: restrict, skip or fail, with the reason.

    The key has no region, so it can occur twice among the targets. The first occurrence whose policy can
    be backed up and read is restricted; later ones are skipped. Before a plan is carried out its policies are
    stored (``policy.snapshots_of``) and what was stored is asked for with ``require_backup``.
    """
    documents = policies.select(
        F.col("project_id").alias("project"), "region", F.col("dataset_id").alias("dataset"), "policy_json"
    )
    usable_position = F.when(F.col("restricted_policy").isNotNull(), F.col("sheet_position"))
    rows = (
        targets.select("*", dataset_key(F.col("project"), F.col("dataset")).alias("key"), sheet_position(targets).alias("sheet_position"))
        .join(documents, ["project", "region", "dataset"], "left")
        .withColumn("restricted_policy", restrict_policy(F.col("policy_json"), safe))
        .join(already_processed(state), "key", "left")
        .withColumn("first_position", F.min(usable_position).over(Window.partitionBy("key")))
    )
    done = F.col("state_status").isNotNull()
    repeated = F.col("sheet_position") > F.col("first_position")
    usable = F.col("restricted_policy").isNotNull()
    action = F.when(done | repeated, "skip").when(usable, "restrict").otherwise("fail")
    reason = (
        F.when(done, F.concat(F.lit("already processed (Status: "), F.col("state_status"), F.lit(")")))
        .when(repeated, F.lit("repeated key"))
        .when(usable, F.lit(None).cast("string"))
        .when(F.col("policy_json").isNull(), F.lit(NO_BACKUP_REASON))
        .otherwise(F.lit("unreadable policy"))
    )
    acts = F.col("action") == "restrict"
    return rows.select(
        "*",
        action.alias("action"),
        reason.alias("reason"),
    ).select(
        "key",
        "project",
        "region",
        "dataset",
        "tranche",
        "size_gb",
        "monthly_cost",
        "action",
        "reason",
        backup_path(F.col("project"), F.col("dataset"), root).alias("backup_path"),
        "policy_json",
        F.when(acts, F.col("restricted_policy")).alias("restricted_policy"),
        F.when(acts, F.lit(f"{CLEANUP_LABEL}:{CLEANUP_LABEL_VALUE}")).alias("set_label"),
        instant(as_of).alias("planned_at"),
        "sheet_position",
    )


def require_backup(plan: DataFrame, snapshots: DataFrame) -> DataFrame:
    """The plan, with a restriction failed unless the very policy it restricts was stored, as read back, and no other one
    under the same path."""
    stored = one_document(snapshots).select("backup_path", F.col("policy_json").alias("stored_policy"), "clash")
    rows = plan.join(stored, "backup_path", "left")
    lost = (F.col("action") == "restrict") & ~F.coalesce(F.col("stored_policy") == F.col("policy_json"), F.lit(False))
    return rows.withColumns(
        {
            "reason": F.when(lost, F.when(F.col("clash"), CLASH_REASON).otherwise(NO_BACKUP_REASON)).otherwise(F.col("reason")),
            "restricted_policy": F.when(~lost, F.col("restricted_policy")),
            "set_label": F.when(~lost, F.col("set_label")),
            "action": F.when(lost, "fail").otherwise(F.col("action")),
        }
    ).select(plan.columns)


def scream_test_changes(state: DataFrame, plan: DataFrame, outcomes: DataFrame, as_of: datetime | str) -> DataFrame:
    """The state records that a scream-test run adds or replaces, one for each restriction reported as successful.

    A record replaces the old one of its key as a whole, at the old position; new keys follow in sheet order. New ``seq``
    values ascend but have gaps, which spares numbering all rows in one task.
    """
    restricted = plan.where(F.col("action") == "restrict").join(reported_ok(outcomes), "key", "left_semi")
    succeeded = restricted.dropDuplicates(["key"])
    known = state.select("key", F.col("seq").alias("old_seq"))
    last = state.agg(F.coalesce(F.max("seq"), F.lit(-1))).scalar()
    placed = (
        succeeded.join(known, "key", "left")
        .orderBy("sheet_position")
        .withColumn("arrival", F.monotonically_increasing_id())
    )
    never = F.lit(None).cast("timestamp")
    return placed.select(
        "key",
        "project",
        "dataset",
        "tranche",
        "backup_path",
        instant(as_of).alias("scream_initiated_at"),
        F.lit(SCREAM_TEST).alias("status"),
        never.alias("deleted_at"),
        never.alias("restored_at"),
        F.coalesce(F.col("old_seq"), last + 1 + F.col("arrival")).alias("seq"),
    )


def apply_outcomes(state: DataFrame, plan: DataFrame, outcomes: DataFrame, as_of: datetime | str) -> DataFrame:
    """The whole state after a scream-test run."""
    restricted = plan.where(F.col("action") == "restrict").join(reported_ok(outcomes), "key", "left_semi")
    untouched = state.join(restricted.select("key"), "key", "left_anti")
    return untouched.select(schemas.STATE.fieldNames()).unionByName(scream_test_changes(state, plan, outcomes, as_of))


def plan_purge(state: DataFrame, as_of: datetime | str, retention_days: int = RETENTION_DAYS) -> DataFrame:
    """Delete what has been restricted for the whole monitoring period; skip, with the reason, what has not."""
    elapsed = floor_days(instant(as_of), F.col("scream_initiated_at"))
    due = F.col("days_elapsed") >= retention_days
    waiting = F.concat(
        F.lit("only "),
        F.col("days_elapsed").cast("string"),
        F.lit(f" days elapsed (threshold: {retention_days})"),
    )
    return (
        state.where(F.col("status") == SCREAM_TEST)
        .withColumn("days_elapsed", elapsed)
        .select(
            "key",
            "project",
            "dataset",
            "tranche",
            "days_elapsed",
            F.lit(retention_days).cast("bigint").alias("threshold"),
            F.when(due, "delete").otherwise("skip").alias("action"),
            F.when(due, F.lit(None).cast("string"))
            .otherwise(F.coalesce(waiting, F.lit("no initiation time")))
            .alias("reason"),
        )
    )


def _mark(state: DataFrame, outcomes: DataFrame, eligible: Column, status: str, stamp: str, as_of: datetime | str) -> DataFrame:
    done = reported_ok(outcomes).withColumn("done", F.lit(True))
    changed = F.coalesce(F.col("done"), F.lit(False)) & eligible
    marked = state.join(done, "key", "left").withColumn("changed", changed)
    return (
        marked.withColumn("status", F.when(F.col("changed"), status).otherwise(F.col("status")))
        .withColumn(stamp, F.when(F.col("changed"), instant(as_of)).otherwise(F.col(stamp)))
        .select(schemas.STATE.fieldNames())
    )


def _changed(state: DataFrame, outcomes: DataFrame, eligible: Column, status: str, stamp: str, as_of: datetime | str) -> DataFrame:
    done = state.where(eligible).join(reported_ok(outcomes), "key", "left_semi")
    return done.withColumns({"status": F.lit(status), stamp: instant(as_of)}).select(schemas.STATE.fieldNames())


def purge_changes(state: DataFrame, outcomes: DataFrame, as_of: datetime | str) -> DataFrame:
    """The state records of the datasets that were deleted."""
    return _changed(state, outcomes, F.col("status") == SCREAM_TEST, DELETED, "deleted_at", as_of)


def restore_changes(state: DataFrame, outcomes: DataFrame, as_of: datetime | str) -> DataFrame:
    """The state records of the datasets that were given back."""
    return _changed(state, outcomes, F.col("status") != RESTORED, RESTORED, "restored_at", as_of)


def apply_purge(state: DataFrame, outcomes: DataFrame, as_of: datetime | str) -> DataFrame:
    """State after deletions. A report about a dataset no longer in its scream test changes nothing."""
    return _mark(state, outcomes, F.col("status") == SCREAM_TEST, DELETED, "deleted_at", as_of)


def apply_restore(state: DataFrame, outcomes: DataFrame, as_of: datetime | str) -> DataFrame:
    return _mark(state, outcomes, F.col("status") != RESTORED, RESTORED, "restored_at", as_of)


def scream_test_log(plan: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Messages of a scream-test run: ``key, action, message``.

    ``outcomes`` may carry ``label_ok``; a label that could not be set is a warning and no failure.
    """
    has_labels = "label_ok" in outcomes.columns
    label_ok = F.bool_and("label_ok") if has_labels else F.lit(True)
    reports = outcomes.groupBy("key").agg(F.bool_or("ok").alias("ok"), label_ok.alias("label_ok"))
    rows = plan.select("key", "action", "reason").join(reports, "key", "left")
    acted = F.col("action") == "restrict"
    outcome = (
        F.when(F.col("action") == "skip", F.format_string(SKIPPING, "key", "reason"))
        .when(~acted, F.format_string(NO_BACKUP, "key", "reason"))
        .when(F.col("ok"), F.format_string(SCREAM_DONE, "key"))
        .otherwise(F.format_string(SCREAM_FAILED, "key"))
    )
    warning = F.when(
        acted & ~F.col("label_ok"),
        F.format_string(NO_LABEL, "key"),
    )
    return rows.select("key", "action", F.explode(F.array_compact(F.array(warning, outcome))).alias("message"))


def purge_log(plan: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Messages of a purge run."""
    rows = plan.join(reported_ok(outcomes).withColumn("ok", F.lit(True)), "key", "left")
    message = (
        F.when(F.col("action") == "skip", F.format_string(SKIPPING, "key", "reason"))
        .when(F.col("ok"), F.format_string(PURGE_DONE, "key"))
        .otherwise(F.format_string(PURGE_FAILED, "key"))
    )
    return rows.select("key", "action", message.alias("message"))
