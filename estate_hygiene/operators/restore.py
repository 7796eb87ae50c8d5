"""Giving access back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from estate_hygiene.functions.names import starts_with_digit
from estate_hygiene.operators.lifecycle import RESTORED, SCREAM_TEST, reported_ok
from estate_hygiene.operators.policy import CLASH_REASON, NO_BACKUP_REASON, one_document

# Messages of the action log.
SKIPPED = "Skipping %s - %s."
RESTORE_DONE = "Successfully restored %s"
RESTORE_FAILED = "ERROR: Failed to restore %s"


def select_restore(
    state: DataFrame,
    keys: DataFrame | str | None = None,
    tranche: str | None = None,
    every: bool = False,
) -> DataFrame:
    """State entries to restore: by key, else by tranche, else every active scream test.

    Only the last looks at the status; the others also find deleted and restored entries. A tranche is an
    exact label or a prefix; text starting with a digit means the prefix ``Tranche <text>:``.
    """
    if isinstance(keys, str):
        return state.where(F.col("key") == keys)
    if keys is not None:
        return state.join(keys.select("key").distinct(), "key", "left_semi")
    if tranche:
        prefix = f"Tranche {tranche}:" if starts_with_digit(tranche) else tranche
        return state.where((F.col("tranche") == tranche) | F.col("tranche").startswith(prefix))
    if every:
        return state.where(F.col("status") == SCREAM_TEST)
    raise ValueError("name keys, a tranche or every=True")


def unknown_keys(state: DataFrame, keys: DataFrame) -> DataFrame:
    """Requested keys that the state does not know."""
    return keys.select("key").distinct().join(state.select("key"), "key", "left_anti")


def plan_restore(targets: DataFrame, snapshots: DataFrame) -> DataFrame:
    """One row per target: restore with the full original policy, skip, or fail for want of a backup, or of one that is the
    only one under its path."""
    backups = one_document(snapshots.where(F.col("policy_json").isNotNull()))
    rows = targets.join(backups, "backup_path", "left")
    restored = F.coalesce(F.col("status") == RESTORED, F.lit(False))
    missing = F.col("policy_json").isNull()
    return rows.select(
        "key",
        "project",
        "dataset",
        "tranche",
        F.col("status").alias("prior_status"),
        F.when(restored, "skip").when(missing, "fail").otherwise("restore").alias("action"),
        F.when(restored, "already marked as restored").when(F.col("clash"), CLASH_REASON).when(missing, NO_BACKUP_REASON).alias("reason"),
        "backup_path",
        F.when(~restored, F.col("policy_json")).alias("policy_json"),
    )


def restore_results(plan: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``key, result``: restored, skipped, failed, or unreported when nobody said how it went."""
    reports = outcomes.groupBy("key").agg(F.bool_or("ok").alias("ok"))
    return plan.select("key", "action").join(reports, "key", "left").select(
        "key",
        F.when(F.col("action") == "skip", "skipped")
        .when(F.col("action") == "fail", "failed")
        .when(F.col("ok").isNull(), "unreported")
        .when(F.col("ok"), "restored")
        .otherwise("failed")
        .alias("result"),
    )


def outcome_counts(results: DataFrame) -> DataFrame:
    """Counts of a restore run; the run as a whole fails when any dataset did."""

    def n(result: str):
        return F.count_if(F.col("result") == result)

    return results.agg(
        n("restored").alias("restored"),
        n("failed").alias("failed"),
        n("skipped").alias("skipped"),
        n("unreported").alias("unreported"),
        (n("failed") > 0).alias("run_failed"),
    )


def failed_keys(results: DataFrame) -> DataFrame:
    return results.where(F.col("result") == "failed").select("key").orderBy("key")


def restore_log(plan: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Messages of a restore run: ``key, action, message``."""
    done = reported_ok(outcomes).withColumn("ok", F.lit(True))
    message = (
        F.when(F.col("action") == "skip", F.format_string(SKIPPED, "key", "reason"))
        .when(F.col("ok") & (F.col("action") == "restore"), F.format_string(RESTORE_DONE, "key"))
        .otherwise(F.format_string(RESTORE_FAILED, "key"))
    )
    return plan.join(done, "key", "left").select("key", "action", message.alias("message"))
