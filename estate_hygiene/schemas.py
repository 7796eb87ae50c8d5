"""One schema per estate table. Operators rely on these column names."""

from pyspark.sql import types as T

TABLE_REF = T.StructType(
    [
        T.StructField("project_id", T.StringType()),
        T.StructField("dataset_id", T.StringType()),
        T.StructField("table_id", T.StringType()),
    ]
)

JOBS = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("creation_time", T.TimestampType()),
        T.StructField("user_email", T.StringType()),
        T.StructField("referenced_tables", T.ArrayType(TABLE_REF)),
        T.StructField("destination_table", TABLE_REF),
        T.StructField("project_id", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

SCHEMATA = T.StructType(
    [
        T.StructField("schema_name", T.StringType()),
        T.StructField("project_id", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

SCHEMA_OPTIONS = T.StructType(
    [
        T.StructField("schema_name", T.StringType()),
        T.StructField("option_name", T.StringType()),
        T.StructField("option_value", T.StringType()),
        T.StructField("project_id", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

TABLES = T.StructType(
    [
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("creation_time", T.TimestampType()),
        T.StructField("project_id", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

TABLE_STORAGE = T.StructType(
    [
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("total_logical_bytes", T.LongType()),
        T.StructField("storage_last_modified_time", T.TimestampType()),
        T.StructField("project_id", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

POLICIES = T.StructType(
    [
        T.StructField("project_id", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("dataset_id", T.StringType()),
        T.StructField("policy_json", T.StringType()),
    ]
)

SNAPSHOTS = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("backup_path", T.StringType()),
        T.StructField("policy_json", T.StringType()),
    ]
)

# The control table: output of the deep-history audit, input of lifecycle, report and summaries.
AUDIT = T.StructType(
    [
        T.StructField("project", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("size_gb", T.DoubleType()),
        T.StructField("monthly_cost", T.DoubleType()),
        T.StructField("tranche", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("days_since_activity", T.LongType()),
        T.StructField("days_since_modified", T.LongType()),
        T.StructField("last_read_time", T.TimestampNTZType()),
        T.StructField("last_write_time", T.TimestampNTZType()),
        T.StructField("last_reads", T.StringType()),
        T.StructField("last_writes", T.StringType()),
        T.StructField("last_storage_update", T.StringType()),
        T.StructField("deletion_status", T.StringType()),
        # Whether the access log of the scope was read; null if nobody looked.
        T.StructField("history_ok", T.BooleanType()),
        # The row's place in a sheet with an order of its own; null where the order of the audit holds.
        T.StructField("seq", T.LongType()),
    ]
)

STATE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("project", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("tranche", T.StringType()),
        T.StructField("backup_path", T.StringType()),
        T.StructField("scream_initiated_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("deleted_at", T.TimestampType()),
        T.StructField("restored_at", T.TimestampType()),
        T.StructField("seq", T.LongType()),
    ]
)

OUTCOMES = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("ok", T.BooleanType()),
    ]
)

ACTION_LOG = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

# One row per (scope, source) that a loader tried to read.
LOADS = T.StructType(
    [
        T.StructField("project_id", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("error", T.StringType()),
    ]
)
