"""Versions of a stored table: claimed by one writer, committed as a whole, read by number.

A version is a folder ``version=N`` under the table's root. A writer first claims the number by creating a file that
only one can create, then writes, and at last commits: it leaves a record, a small JSON document with the row count and
whatever else a reader needs, and creates the commit mark, which again only one can create. Readers look for marks alone,
so a version that was lost half-way is never seen, and a version without rows is a result like any other. A claim whose
writer failed is abandoned, after which it cannot be committed; that of a writer that vanished stays open until someone
abandons it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

COMMIT = "_commit"
RECORD = "_record"
ABANDONED = "_abandoned"
CLAIMS = "_claims"


class VersionTaken(RuntimeError):
    """Another writer has claimed the version."""


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _files(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark._jsc.hadoopConfiguration())


def folder(root: str, version: int) -> str:
    return f"{root}/version={version}"


def _numbers(spark: SparkSession, root: str, pattern: str) -> set[int]:
    """Version numbers among the paths that match; lists names and opens nothing."""
    found = _files(spark, root).globStatus(_path(spark, f"{root}/{pattern}"))
    parts = [part for status in found or () for part in status.getPath().toString().split("/")]
    return {int(p.removeprefix("version=")) for p in parts if p.startswith("version=") and p.removeprefix("version=").isdigit()}


def _create_alone(spark: SparkSession, name: str) -> None:
    """Create a file, or fail if it is there. HDFS and local disks decide between two callers; so do object stores that
    offer conditional writes to Hadoop's ``create`` without overwriting."""
    files, path = _files(spark, name), _path(spark, name)
    files.mkdirs(path.getParent())
    real = files.resolvePath(path.getParent())
    if real.toUri().getScheme() in (None, "file"):
        jvm = spark._jvm.java.nio.file
        attributes = spark.sparkContext._gateway.new_array(jvm.attribute.FileAttribute, 0)
        no_more = spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)
        jvm.Files.createFile(jvm.Paths.get(f"{real.toUri().getPath()}/{path.getName()}", no_more), attributes)
    else:
        files.create(path, False).close()


def _first_to_create(spark: SparkSession, name: str) -> bool:
    from py4j.protocol import Py4JJavaError

    try:
        _create_alone(spark, name)
    except (Py4JJavaError, PySparkException) as failure:
        if "AlreadyExists" not in str(failure):
            raise
        return False
    return True


def claim(spark: SparkSession, root: str, version: int) -> None:
    """Make the version this writer's own."""
    if not _first_to_create(spark, f"{root}/{CLAIMS}/version={version}"):
        raise VersionTaken(f"version {version} of {root} belongs to another writer")
    if _files(spark, root).exists(_path(spark, folder(root, version))):
        raise VersionTaken(f"version {version} of {root} was begun without a claim")


def begun(spark: SparkSession, root: str) -> set[int]:
    """All versions that were claimed or written to, committed or not."""
    return _numbers(spark, root, "version=*") | _numbers(spark, root, f"{CLAIMS}/version=*")


def _abandoned(spark: SparkSession, root: str) -> set[int]:
    return _numbers(spark, root, f"version=*/{ABANDONED}")


def committed(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, oldest first."""
    return sorted(_numbers(spark, root, f"version=*/{COMMIT}") - _abandoned(spark, root))


def open_claims(spark: SparkSession, root: str) -> list[int]:
    """Versions that were begun and neither committed nor abandoned: a writer is at work, or was lost."""
    return sorted(begun(spark, root) - set(committed(spark, root)) - _abandoned(spark, root))


def next_version(spark: SparkSession, root: str) -> int:
    """After all versions that were begun, so that one that was lost half-way is left alone."""
    return max(begun(spark, root), default=0) + 1


def commit(spark: SparkSession, root: str, version: int, record: dict[str, Any]) -> None:
    """Make a claimed version visible, with its record."""
    path = folder(root, version)
    files = _files(spark, path)
    files.mkdirs(_path(spark, path))
    out = files.create(_path(spark, f"{path}/{RECORD}"), True)
    out.write(bytearray(json.dumps(record | {"version": version}, sort_keys=True).encode()))
    out.close()
    if not _first_to_create(spark, f"{path}/{COMMIT}"):
        raise VersionTaken(f"version {version} of {root} was committed or abandoned before")


def abandon(spark: SparkSession, root: str, version: int) -> None:
    """Give up a claim: its writer can no longer commit. A committed version is left as it is."""
    path = folder(root, version)
    mark = _path(spark, f"{path}/{ABANDONED}")
    files = _files(spark, path)
    files.create(mark, True).close()
    if not _first_to_create(spark, f"{path}/{COMMIT}"):
        files.delete(mark, False)
        raise VersionTaken(f"version {version} of {root} was committed before")


@contextmanager
def claimed(spark: SparkSession, root: str, version: int) -> Iterator[None]:
    """A claim for as long as the writer is at work; abandoned if it fails."""
    claim(spark, root, version)
    try:
        yield
    except BaseException:
        abandon(spark, root, version)
        raise


def record_of(spark: SparkSession, root: str, version: int) -> dict[str, Any]:
    """The commit record of a version."""
    name = f"{folder(root, version)}/{RECORD}"
    source = _files(spark, name).open(_path(spark, name))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
    finally:
        source.close()


def records(spark: SparkSession, root: str) -> list[dict[str, Any]]:
    """Commit records, oldest first."""
    return [record_of(spark, root, v) for v in committed(spark, root)]


def history(spark: SparkSession, root: str) -> DataFrame:
    """``version, rows`` of every committed version."""
    found = [(r["version"], r.get("rows")) for r in records(spark, root)]
    return spark.createDataFrame(found, "version bigint, rows bigint")


def written(df: DataFrame, path: str, *partitions: str) -> int:
    """Write to a folder that no one else writes to and return the row count, taken while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("error").partitionBy(*partitions).parquet(path)
    return seen.get["rows"]
