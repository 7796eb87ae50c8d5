"""Stored results: control table, bundles, workflow state, snapshots, reports and the action log.

Nothing is replaced in place: a table, a bundle's members and a report are written as a new ``version=N`` directory,
and readers take the newest version whose write was committed (``sources.versions``). A run lost half-way therefore
leaves the last good one. A run's lines of the action log are a version too.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.types import LongType, StructField, StructType

from estate_hygiene import schemas
from estate_hygiene.functions.names import TEST_NAME_TOKENS
from estate_hygiene.functions.numbers import COST_PER_GB_MONTH
from estate_hygiene.functions.timestamps import instant, iso_text
from estate_hygiene.operators.access import EVENTS_KEPT, LOOKBACK_DAYS
from estate_hygiene.operators.ordering import numbered
from estate_hygiene.sources import versions


def _versions(spark: SparkSession, root: str, schema: StructType, numbers: list[int]) -> DataFrame:
    """The rows of some committed versions, with ``version``."""
    versioned = StructType(schema.fields + [StructField("version", LongType())])
    if not numbers:
        return spark.createDataFrame([], versioned)
    return spark.read.schema(versioned).option("basePath", root).parquet(*[versions.folder(root, n) for n in numbers])


def read_latest(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The newest committed version, which may hold no rows; no other folder is looked into."""
    return _versions(spark, root, schema, versions.committed(spark, root)[-1:]).drop("version")


def next_version(spark: SparkSession, root: str) -> int:
    return versions.next_version(spark, root)


def write_version(df: DataFrame, root: str, version: int | None = None, keep_if_empty: bool = False) -> int:
    """Write the next version, or the one that is named, and return its row count, taken while writing.

    Of two writers of one version the second gets ``VersionTaken`` before it has written anything. Name the version after
    the one that the rows were made from, and two writers that started from the same one cannot both succeed. A version
    without rows is in force like any other; with ``keep_if_empty`` it is not committed, so the last one stays.
    """
    spark = df.sparkSession
    version = versions.next_version(spark, root) if version is None else version
    with versions.claimed(spark, root, version):
        rows = versions.written(df, versions.folder(root, version))
        if rows or not keep_if_empty:
            versions.commit(spark, root, version, {"rows": rows})
    if not rows and keep_if_empty:
        versions.abandon(spark, root, version)
    return rows


def write_audit(audit: DataFrame, root: str, version: int | None = None) -> int:
    """Replace the stored audit and return the number of rows found.

    An audit without rows leaves the previous one in force.
    """
    absent = [f for f in schemas.AUDIT.fields[-2:] if f.name not in audit.columns]
    whole = audit.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
    return write_version(whole.select(schemas.AUDIT.fieldNames()), root, version, keep_if_empty=True)


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    return read_latest(spark, root, schemas.AUDIT)


def read_audit_csv(spark: SparkSession, path: str) -> DataFrame:
    """A control sheet kept by hand, as CSV with the snake-case column names, in one file or several.

    Rows keep the order of the files' paths and, within a file, their own: a file is read by one task from its beginning,
    so the row ids of its rows ascend, whatever files Spark packs into that task.
    """
    given = T.StructType([f for f in schemas.AUDIT.fields if f.name not in ("history_ok", "seq")])
    sheet = spark.read.schema(given).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    placed = sheet.withColumns({"file": F.col("_metadata.file_path"), "row": F.monotonically_increasing_id()})
    found = numbered(placed, [F.col("file"), F.col("row")], name="seq").withColumn("history_ok", F.lit(None).cast("boolean"))
    return found.select(schemas.AUDIT.fieldNames())


def append_changes(changes: DataFrame, root: str, version: int | None = None) -> int:
    """Add records that replace those of their keys, each key at most once, and return their number.

    Only the changes are written: what a batch of outcomes costs does not follow from the size of the table.
    """
    spark = changes.sparkSession
    version = versions.next_version(spark, root) if version is None else version
    with versions.claimed(spark, root, version):
        rows = versions.written(changes, versions.folder(root, version))
        versions.commit(spark, root, version, {"rows": rows, "kind": "changes"})
    return rows


def _since_whole(spark: SparkSession, root: str) -> list[int]:
    """The newest version that holds the whole table and the changes after it; older ones are not needed."""
    found: list[int] = []
    for number in reversed(versions.committed(spark, root)):
        found.append(number)
        if versions.record_of(spark, root, number).get("kind") != "changes":
            break
    return found


def read_folded(spark: SparkSession, root: str, schema: StructType, key: str) -> DataFrame:
    """The table with all changes since it was last written as a whole: of every key the newest record.

    Keys fold before the shuffle, and a table without changes is read as it is.
    """
    numbers = _since_whole(spark, root)
    rows = _versions(spark, root, schema, numbers)
    if len(numbers) < 2:
        return rows.drop("version")
    newest = F.max_by(F.struct(*schema.fieldNames()), "version").alias("newest")
    return rows.groupBy(F.col(key).alias("folded_key")).agg(newest).select("newest.*")


def compact(spark: SparkSession, root: str, schema: StructType, key: str) -> int:
    """Write the folded table as a whole, so that readers need no older version. Returns its number of rows."""
    return _compacted(spark, root, lambda: read_folded(spark, root, schema, key).select(schema.fieldNames()))


def _compacted(spark: SparkSession, root: str, fold: Callable[[], DataFrame]) -> int:
    """Write what ``fold`` reads as a whole. A change that is still being written could be committed under a lower number
    and would be lost, so it is waited for or given up first (``versions.abandon``)."""
    number = versions.next_version(spark, root)
    newest = max(versions.committed(spark, root), default=0)
    at_work = [n for n in versions.open_claims(spark, root) if n > (min(_since_whole(spark, root), default=0) or newest)]
    if at_work:
        raise versions.VersionTaken(f"versions {at_work} of {root} are being written")
    return write_version(fold(), root, number)


def write_state(state: DataFrame, root: str, version: int | None = None) -> int:
    return write_version(state.select(schemas.STATE.fieldNames()), root, version)


def append_state(changes: DataFrame, root: str, version: int | None = None) -> int:
    """Add the records that a batch of outcomes has changed (``lifecycle.*_changes``)."""
    return append_changes(changes.select(schemas.STATE.fieldNames()), root, version)


def read_state(spark: SparkSession, root: str) -> DataFrame:
    return read_folded(spark, root, schemas.STATE, "key")


def compact_state(spark: SparkSession, root: str) -> int:
    return compact(spark, root, schemas.STATE, "key")


def _manifest(spark: SparkSession, bundle: str) -> tuple[int, dict[str, int]]:
    """Number and members of the newest manifest; a member is named with the version that holds it."""
    done = versions.committed(spark, bundle)[-1:]
    return (done[0], versions.record_of(spark, bundle, done[0])["members"]) if done else (0, {})


def write_members(members: Mapping[str, DataFrame], bundle: str) -> int:
    """Replace the named tables of a bundle, all at once; the other members stay as they are.

    The tables are written beside those in force, and a manifest then names the current version of every member. If one
    write fails, no manifest is made and the bundle reads as before. Of two writers that start from one manifest the
    second fails, as its manifest would undo what the first has replaced. Returns the number of the manifest.
    """
    spark = next(iter(members.values())).sparkSession
    newest, kept = _manifest(spark, bundle)
    version = newest + 1 if newest + 1 not in versions.begun(spark, bundle) else versions.next_version(spark, bundle)
    with versions.claimed(spark, bundle, version):
        rows = {name: versions.written(df, f"{versions.folder(bundle, version)}/{name}") for name, df in members.items()}
        if _manifest(spark, bundle)[0] != newest:
            raise versions.VersionTaken(f"{bundle} was replaced by another writer")
        versions.commit(spark, bundle, version, {"members": kept | dict.fromkeys(members, version), "rows": sum(rows.values())})
    return version


def write_member(df: DataFrame, bundle: str, name: str) -> int:
    """Replace one named table of a bundle."""
    return write_members({name: df}, bundle)


def read_member(spark: SparkSession, bundle: str, name: str) -> DataFrame:
    """A table of a bundle, as the newest manifest names it."""
    members = _manifest(spark, bundle)[1]
    if name not in members:
        raise KeyError(f"{bundle} has no member {name}")
    return spark.read.parquet(f"{versions.folder(bundle, members[name])}/{name}")


def data_dictionary(spark: SparkSession, large_gb: int = 100, days: int = LOOKBACK_DAYS, rate: float = COST_PER_GB_MONTH) -> DataFrame:
    """What tranches and columns mean, put together from the rules that are in force."""
    names = "/".join(TEST_NAME_TOKENS)
    rows = [
        ("Tranche 1", "Stale Test/Temp", f"The name holds one of {names}, and nothing read or wrote it for {days} days. First to go."),
        ("Tranche 2", "High Saving Stale", f"Other datasets over {large_gb} GB without access for {days} days. They save the most."),
        ("Tranche 3", "Stale Production", f"Other datasets up to {large_gb} GB without access for {days} days."),
        ("Tranche 4", "Active Test/Temp", f"The name holds one of {names}, but the dataset is in use. For review."),
        ("Column: Description", "Dataset Metadata", "The description among the options of the dataset, which may name an owner or a purpose."),
        ("Column: Last 5 Access", "Audit Trail", f"The newest {EVENTS_KEPT} jobs that read or wrote the dataset, each with its time and user."),
        ("Column: Monthly Cost", "Financial Impact", f"An estimate at ${rate:.2f} per GB and month."),
    ]
    return spark.createDataFrame(rows, "category string, definition string, detail string")


def write_bundle(audit: DataFrame, bundle: str) -> int:
    """The audit together with the explanation of its tranches and columns."""
    return write_members({"readme": data_dictionary(audit.sparkSession), "audit_results": audit}, bundle)


def write_snapshots(snapshots: DataFrame, root: str, version: int | None = None) -> int:
    """Back up policies. Earlier versions stay, so a later backup cannot destroy an earlier one.

    Two different documents for one path are both kept; whoever needs the path gets them as a clash.
    """
    return append_changes(snapshots.select(schemas.SNAPSHOTS.fieldNames()).distinct(), root, version)


def read_policy_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Newest backup per path since backups were last compacted: a run backs up its own targets only. A failed backup,
    which holds no document, hides no earlier one. A path whose newest backup has different documents has two rows."""
    held = _versions(spark, root, schemas.SNAPSHOTS, _since_whole(spark, root)).where(F.col("policy_json").isNotNull())
    document = F.struct("policy_json", "key", "region")
    by_version = held.groupBy("backup_path", "version").agg(F.min(document).alias("low"), F.max(document).alias("high"))
    newest = by_version.groupBy("backup_path").agg(F.max_by(F.struct("low", "high"), "version").alias("newest"))
    low, high = F.col("newest.low"), F.col("newest.high")
    documents = F.when(low["policy_json"] == high["policy_json"], F.array(low)).otherwise(F.array(low, high))
    rows = newest.select("backup_path", F.explode(documents).alias("d"))
    return rows.select("d.key", "d.region", "backup_path", "d.policy_json")


def compact_snapshots(spark: SparkSession, root: str) -> int:
    """Write the newest backups as one version, so that readers open no older one. Returns their number."""
    return _compacted(spark, root, lambda: read_policy_snapshot(spark, root).select(schemas.SNAPSHOTS.fieldNames()))


def write_report(lines: DataFrame, root: str, version: int | None = None) -> int:
    """Report text as the next version: part files whose name order is the line order. Returns the version."""
    spark = lines.sparkSession
    version = versions.next_version(spark, root) if version is None else version
    order = [c for c in lines.columns if c != "line"]
    seen = Observation()
    counted = lines.orderBy(*order).select("line").observe(seen, F.count(F.lit(1)).alias("rows"))
    with versions.claimed(spark, root, version):
        counted.write.mode("error").text(versions.folder(root, version))
        versions.commit(spark, root, version, {"rows": seen.get["rows"]})
    return version


def read_report(spark: SparkSession, root: str) -> DataFrame:
    """``line_no, line`` of the newest report, in the order of its files and of the lines in each.

    A line's place is its file's name, the place of its split in the file and its place in the split.
    """
    done = versions.committed(spark, root)[-1:]
    if not done:
        return spark.createDataFrame([], "line_no bigint, line string")
    text = spark.read.text(versions.folder(root, done[0])).withColumnRenamed("value", "line")
    spot = {"file": F.col("_metadata.file_path"), "split": F.col("_metadata.file_block_start"), "row": F.monotonically_increasing_id()}
    placed = numbered(text.withColumns(spot), [F.col(c) for c in spot], name="line_no")
    return placed.select("line_no", "line")


def append_log(actions: DataFrame, path: str, as_of: datetime | str, run: int | None = None) -> int:
    """Append ``key, action, message`` rows, stamped, and return their number.

    A run is a version of the log. One that is named and was committed before adds nothing, so a job that is started again
    after its driver was lost doubles no lines.
    """
    spark = actions.sparkSession
    if run is not None and run in versions.committed(spark, path):
        return 0
    stamped = actions.select(instant(as_of).alias("ts"), "key", "action", "message")
    return append_changes(stamped, path, run)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all committed runs."""
    return _versions(spark, path, schemas.ACTION_LOG, versions.committed(spark, path)).drop("version")


def log_lines(log: DataFrame) -> DataFrame:
    """Log rows as text lines."""
    return log.select("ts", F.concat(F.lit("["), iso_text(F.col("ts")), F.lit("] "), F.col("message")).alias("line"))
