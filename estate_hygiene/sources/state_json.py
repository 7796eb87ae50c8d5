"""Import and export of workflow state as a JSON document: one object, dataset key to record."""

from __future__ import annotations

from typing import Literal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from estate_hygiene import schemas
from estate_hygiene.functions.timestamps import iso_text

_RECORD = (
    "struct<project:string,dataset:string,tranche:string,backup_path:string,"
    "scream_initiated_at:string,status:string,deleted_at:string,restored_at:string>"
)
_TIMES = ("scream_initiated_at", "deleted_at", "restored_at")


def read_state_json(
    spark: SparkSession,
    path: str,
    missing: Literal["empty", "error"] = "empty",
    malformed: Literal["empty", "error"] = "empty",
) -> DataFrame:
    """State from a JSON document.

    A single JSON object cannot be split, so this is an import for documents made elsewhere; the state of
    record is the versioned table of ``sources.tables``. ``seq`` is the position in the document; a
    repeated key keeps its first position and its last record.
    """
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as failure:
        if missing == "error" or failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.STATE)
    mode = "FAILFAST" if malformed == "error" else "PERMISSIVE"
    entries = text.select(
        F.posexplode(F.from_json("value", f"map<string,{_RECORD}>", {"mode": mode})).alias("seq", "key", "info")
    )
    records = entries.groupBy("key").agg(
        F.min("seq").cast("bigint").alias("seq"), F.max_by("info", "seq").alias("info")
    )
    fields = [
        F.col(f"info.{name}").cast("timestamp").alias(name) if name in _TIMES else F.col(f"info.{name}")
        for name in schemas.STATE.fieldNames()
        if name not in ("key", "seq")
    ]
    return records.select("key", *fields, "seq").select(schemas.STATE.fieldNames())


def state_json_entries(state: DataFrame) -> DataFrame:
    """One JSON record per dataset, in the same field names; absent times are left out."""
    times = [iso_text(F.col(c)).alias(c) for c in _TIMES]
    record = F.struct("project", "dataset", "tranche", "backup_path", times[0], "status", *times[1:])
    return state.select("seq", "key", F.to_json(record).alias("record_json"))
