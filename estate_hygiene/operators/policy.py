"""Access policies as JSON documents, edited as Variant values so that unknown fields survive."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from estate_hygiene.functions.names import dataset_key

# Fixed values.
OWNER_ROLE = "OWNER"
CLEANUP_LABEL = "cleanup-status"
CLEANUP_LABEL_VALUE = "scream-test"

NO_BACKUP_REASON = "no backup"
CLASH_REASON = "different policies for one backup path"


def _document(policy_json: Column) -> Column:
    """The document; null when it is not JSON."""
    return F.try_parse_json(policy_json)


def _entries(policy_json: Column) -> Column:
    """Access entries in order; empty when the document has none."""
    entries = F.try_variant_get(_document(policy_json), "$.access", "array<variant>")
    return F.coalesce(entries, F.array().cast("array<variant>"))


def _is_kept(entry: Column, safe: Sequence[str]) -> Column:
    kept = F.coalesce(F.try_variant_get(entry, "$.role", "string") == OWNER_ROLE, F.lit(False))
    if not safe:
        return kept
    # Names of fields are no principals: only what the fields hold is searched.
    values = F.map_values(F.coalesce(F.try_variant_get(entry, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>")))
    mentions = F.exists(values, lambda v: _any(F.coalesce(F.to_json(v), F.lit("")).contains(p) for p in safe))
    return kept | mentions


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def kept_entries(policy_json: Column, safe: Sequence[str] = ()) -> Column:
    """Owners, and entries that mention a safe principal. Entries without a role go."""
    return F.filter(_entries(policy_json), lambda e: _is_kept(e, safe))


def revoked_entries(policy_json: Column, safe: Sequence[str] = ()) -> Column:
    """All other entries, duplicates included."""
    return F.filter(_entries(policy_json), lambda e: ~_is_kept(e, safe))


def restrict_policy(policy_json: Column, safe: Sequence[str] = ()) -> Column:
    """The document with only the kept entries under ``access`` and everything else as it was.

    Key order may change. Null when the document is not a JSON object.
    """
    fields = F.try_variant_get(_document(policy_json), "$", "map<string,variant>")
    others = F.map_filter(fields, lambda name, _: name != "access")
    access = F.create_map(F.lit("access"), F.to_variant_object(kept_entries(policy_json, safe)))
    return F.to_json(F.map_concat(others, access))


def explode_entries(policies: DataFrame, entries: Column) -> DataFrame:
    """One row per access entry, numbered within its kind."""
    exploded = policies.select("project_id", "region", "dataset_id", F.posexplode(entries).alias("position", "entry"))
    return exploded.select(
        dataset_key(F.col("project_id"), F.col("dataset_id")).alias("key"),
        "region",
        F.col("position").cast("bigint").alias("position"),
        F.try_variant_get("entry", "$.role", "string").alias("role"),
        F.coalesce(
            F.try_variant_get("entry", "$.userByEmail", "string"),
            F.try_variant_get("entry", "$.groupByEmail", "string"),
        ).alias("member"),
    )


def restricted_policy_entries(policies: DataFrame, safe: Sequence[str] = ()) -> DataFrame:
    return explode_entries(policies, kept_entries(F.col("policy_json"), safe))


def revoked_policy_entries(policies: DataFrame, safe: Sequence[str] = ()) -> DataFrame:
    return explode_entries(policies, revoked_entries(F.col("policy_json"), safe))


def label_dataset(labels: Column, key: str = CLEANUP_LABEL, value: str = CLEANUP_LABEL_VALUE) -> Column:
    """A label map with one label set; ``map_concat`` alone would fail on a label already there."""
    present = F.coalesce(labels, F.create_map().cast("map<string,string>"))
    others = F.map_filter(present, lambda name, _: name != key)
    return F.map_concat(others, F.create_map(F.lit(key), F.lit(value)))


def labels_of(policy_json: Column) -> Column:
    return F.try_variant_get(_document(policy_json), "$.labels", "map<string,string>")


def labels_text(labels: Column) -> Column:
    """``name=value`` pairs by name, joined by commas."""
    pairs = F.sort_array(F.map_entries(labels))
    return F.array_join(F.transform(pairs, lambda p: F.concat(p["key"], F.lit("="), p["value"])), ",")


def backup_path(project: Column, dataset: Column, root: str | None) -> Column:
    """``<root>/backups/<project>_<dataset>_backup.json``; relative when there is no root."""
    folder = f"{root.rstrip('/')}/backups/" if root else "backups/"
    return F.concat(F.lit(folder), project, F.lit("_"), dataset, F.lit("_backup.json"))


def one_document(snapshots: DataFrame) -> DataFrame:
    """One row per backup path, ``backup_path, policy_json, clash``. Two different documents for one path are a clash, which
    has none: either would be wrong for one of the datasets. It is for the rows that need the path to fail, not the run."""
    low, high = F.min("policy_json"), F.max("policy_json")
    found = snapshots.groupBy("backup_path").agg(low.alias("policy_json"), (~low.eqNullSafe(high)).alias("clash"))
    return found.select("backup_path", F.when(~F.col("clash"), F.col("policy_json")).alias("policy_json"), "clash")


def snapshots_of(plan: DataFrame) -> DataFrame:
    """What has to be backed up before a plan is carried out: the policies it restricts, one for each key."""
    return plan.where(F.col("action") == "restrict").select("key", "region", "backup_path", "policy_json")


def snapshot_policies(policies: DataFrame, targets: DataFrame, root: str | None) -> DataFrame:
    """The policy of every target as it stands, with the path it is kept under.

    A target whose policy cannot be had gets a null document and must not be touched.
    """
    keys = ["project_id", "region", "dataset_id"]
    wanted = targets.select(
        F.col("project").alias("project_id"), "region", F.col("dataset").alias("dataset_id")
    ).distinct()
    return wanted.join(policies.select(*keys, "policy_json"), keys, "left").select(
        dataset_key(F.col("project_id"), F.col("dataset_id")).alias("key"),
        "region",
        backup_path(F.col("project_id"), F.col("dataset_id"), root).alias("backup_path"),
        "policy_json",
    )
