"""Estate tables: job history, dataset and table catalogue, options, storage, policies."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from estate_hygiene import schemas

# Reading with a declared schema also turns zone-less Parquet timestamps into UTC ones at the scan, so
# that time filters still reach the Parquet reader; casting the column afterwards would stop them.


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Job log, one row per job, laid out by ``project_id`` and ``region`` directories."""
    return _read(spark, path, schemas.JOBS)


def read_schemata(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.SCHEMATA)


def read_schema_options(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.SCHEMA_OPTIONS)


def read_tables(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.TABLES)


def read_table_storage(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.TABLE_STORAGE)


def read_policies(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.POLICIES)


def write_by_scope(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Lay a table out by scope, the layout ``scope`` prunes on.

    The rebalance hint gathers each scope into few files and lets Spark split a scope that is too large for
    one task, such as a project holding a third of the estate.
    """
    balanced = df.hint("rebalance", "project_id", "region")
    balanced.write.mode(mode).partitionBy("project_id", "region").parquet(path)


def scope(df: DataFrame, projects: Sequence[str] | None = None, regions: Sequence[str] | None = None) -> DataFrame:
    """Keep the named projects and regions: one scan with directory pruning for the whole fan-out."""
    if projects is not None:
        df = df.where(F.col("project_id").isin(list(projects)))
    if regions is not None:
        df = df.where(F.col("region").isin(list(regions)))
    return df


@dataclass(frozen=True)
class Estate:
    """The tables of the scopes that could be read, and a row for each load that was tried (schemas.LOADS)."""

    schemata: DataFrame
    schema_options: DataFrame
    table_storage: DataFrame
    tables: DataFrame
    jobs: DataFrame
    loads: DataFrame


_SCHEMAS = {
    "schemata": schemas.SCHEMATA,
    "schema_options": schemas.SCHEMA_OPTIONS,
    "table_storage": schemas.TABLE_STORAGE,
    "tables": schemas.TABLES,
    "jobs": schemas.JOBS,
}
_LOADS = {"METADATA": ("schemata", "schema_options", "table_storage", "tables"), "READ": ("jobs",), "WRITE": ("jobs",)}
# A scope can have datasets without options, tables or stored bytes; it has no datasets without a catalogue.
_MAY_BE_ABSENT = ("schema_options", "table_storage", "tables")


def _scope_folder(root: str, name: str, project: str, region: str) -> str:
    return f"{root}/{name}/project_id={project}/region={region}"


def try_load(spark: SparkSession, path: str, schema: StructType) -> str | None:
    """Why a scope's folder cannot be read, or None. The footers of all its files are read, by Spark's tasks, and no rows:
    missing folders, files that are no Parquet, refused access and missing columns are found."""
    try:
        found = spark.read.option("mergeSchema", True).parquet(path).columns
    except PySparkException as failure:
        return f"{failure.getCondition() or type(failure).__name__}: {str(failure)[:500]}"
    except Py4JJavaError as failure:
        return str(failure.java_exception)[:500]
    missing = [f.name for f in schema.fields if f.name not in (*found, "project_id", "region")]
    return f"COLUMNS_MISSING: {', '.join(missing)}" if missing else None


def load_estate(spark: SparkSession, root: str, scopes: Sequence[tuple[str, str]], at_once: int = 8) -> Estate:
    """The estate under ``root`` (a folder for each table, laid out by scope), without what cannot be read.

    Every scope's folders are tried, ``at_once`` at a time, and what happened is kept as the ledger that
    ``scope_coverage`` asks for. Where metadata fails the scope is left out; where the job log fails the scope has no
    accesses, and the ledger says why. A broken page inside a sound file is not found here and fails the audit.
    """
    wanted = [(name, project, region) for name in _SCHEMAS for project, region in scopes]

    def attempt(one: tuple[str, str, str]) -> str | None:
        name, project, region = one
        error = try_load(spark, _scope_folder(root, name, project, region), _SCHEMAS[name])
        return None if error and error.startswith("PATH_NOT_FOUND") and name in _MAY_BE_ABSENT else error

    with ThreadPoolExecutor(at_once) as pool:
        errors = dict(zip(wanted, pool.map(attempt, wanted), strict=True))
    ledger = []
    for project, region in scopes:
        for source, names in _LOADS.items():
            found = [e for e in (errors[name, project, region] for name in names) if e]
            ledger.append((project, region, source, not found, "; ".join(found) or None))
    sound = {source: {(p, r) for p, r, s, ok, _ in ledger if s == source and ok} for source in _LOADS}

    def rows(name: str) -> DataFrame:
        source = "METADATA" if name in _LOADS["METADATA"] else "READ"
        files = spark._jvm.org.apache.hadoop.fs
        paths = [files.Path(_scope_folder(root, name, p, r)) for p, r in sorted(sound[source])]
        there = [p.toString() for p in paths if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)]
        if not there:
            return spark.createDataFrame([], _SCHEMAS[name])
        return spark.read.schema(_SCHEMAS[name]).option("basePath", f"{root}/{name}").parquet(*there)

    return Estate(*[rows(name) for name in _SCHEMAS], loads=spark.createDataFrame(ledger, schemas.LOADS))


def _loaded(source: str) -> Column:
    return F.coalesce(F.bool_or(F.when(F.col("source") == source, F.col("ok"))), F.lit(False))


def scope_coverage(scopes: DataFrame, loads: DataFrame) -> DataFrame:
    """What is known about each scope.

    ``scopes`` has ``project_id, region``; ``loads`` has one row per attempted (scope, source) with source
    METADATA, READ or WRITE. A scope without metadata is left out of an audit. A scope whose access log is
    missing stays in and looks unused, which ``history_ok`` makes visible. A missing load counts as failed.
    """
    attempts = loads.groupBy("project_id", "region").agg(
        _loaded("METADATA").alias("metadata_ok"),
        _loaded("READ").alias("reads_ok"),
        _loaded("WRITE").alias("writes_ok"),
        F.coalesce(F.bool_or(~F.col("ok") & F.col("error").contains("403")), F.lit(False)).alias("denied"),
    )
    known = scopes.select("project_id", "region").join(attempts, ["project_id", "region"], "left")
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("metadata_ok", "reads_ok", "writes_ok", "denied")]
    return known.select("project_id", "region", *flags).withColumn(
        "history_ok", F.col("reads_ok") & F.col("writes_ok")
    )
