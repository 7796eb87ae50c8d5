"""Hand-made estate tables."""

from datetime import datetime, timedelta, timezone


from estate_hygiene import schemas

NOW = datetime(2026, 6, 24, 12, 0, tzinfo=timezone.utc)


def ago(days=0, seconds=0):
    return NOW - timedelta(days=days, seconds=seconds)


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def ref(dataset, table="t", project="p"):
    return {"project_id": project, "dataset_id": dataset, "table_id": table}


def job(job_id, when, user="u@x.com", refs=None, dest=None, project="p", region="eu"):
    return {
        "job_id": job_id,
        "project_id": project,
        "region": region,
        "creation_time": when,
        "user_email": user,
        "referenced_tables": refs,
        "destination_table": dest,
    }


def frame(spark, schema, rows):
    full = [tuple(row.get(name) for name in schema.fieldNames()) for row in rows]
    return spark.createDataFrame(full, schema)


def jobs(spark, *rows):
    return frame(spark, schemas.JOBS, rows)


def schemata(spark, *names, project="p", region="eu"):
    rows = [n if isinstance(n, dict) else {"schema_name": n, "project_id": project, "region": region} for n in names]
    return frame(spark, schemas.SCHEMATA, rows)


def options(spark, *rows):
    return frame(spark, schemas.SCHEMA_OPTIONS, [{"project_id": "p", "region": "eu", **r} for r in rows])


def storage(spark, *rows):
    return frame(spark, schemas.TABLE_STORAGE, [{"project_id": "p", "region": "eu", **r} for r in rows])


def tables(spark, *rows):
    return frame(spark, schemas.TABLES, [{"project_id": "p", "region": "eu", **r} for r in rows])


def stored(dataset, gb=1.0, modified=None, table="t", **more):
    size = None if gb is None else int(gb * 1024**3)
    return {
        "table_schema": dataset,
        "table_name": table,
        "total_logical_bytes": size,
        "storage_last_modified_time": modified,
        **more,
    }


AUDIT_ROW = {
    "project": "p",
    "region": "eu",
    "description": "No Description",
    "size_gb": 1.0,
    "monthly_cost": 0.02,
    "tranche": "Tranche 1: Abandoned Test/Temp (>1yr)",
    "priority": "Critical",
    "days_since_activity": 400,
    "days_since_modified": 400,
    "last_reads": "No Read Access (180d)",
    "last_writes": "No Write Access (180d)",
    "last_storage_update": "2025-01-01 00:00:00",
    "deletion_status": "CONFIRMED: NO MODS > 1YR",
}


def audit(spark, *rows):
    return frame(spark, schemas.AUDIT, [{**AUDIT_ROW, **r} for r in rows])


def state(spark, *rows):
    filled = []
    for seq, r in enumerate(rows):
        project, dataset = r["key"].split(":")
        filled.append(
            {
                "project": project,
                "dataset": dataset,
                "tranche": AUDIT_ROW["tranche"],
                "backup_path": f"gs://bucket/backups/{project}_{dataset}_backup.json",
                "scream_initiated_at": ago(10),
                "status": "scream_test",
                "seq": seq,
                **r,
            }
        )
    return frame(spark, schemas.STATE, filled)


def policies(spark, documents):
    rows = [
        {"project_id": key.split(":")[0], "region": "eu", "dataset_id": key.split(":")[1], "policy_json": text}
        for key, text in documents.items()
    ]
    return frame(spark, schemas.POLICIES, rows)


def outcomes(spark, **ok):
    return spark.createDataFrame([(k.replace("__", ":"), v) for k, v in ok.items()] or [], schemas.OUTCOMES)


def evaluate(spark, column, schema=None, rows=((0,),)):
    """Values of a column expression over literal rows."""
    df = spark.createDataFrame(list(rows), schema or "x int")
    return [r[0] for r in df.select(column.alias("v")).collect()]


def records(df, *columns):
    chosen = df.select(*columns) if columns else df
    return [tuple(r) for r in chosen.collect()]


def by_key(df, key="key"):
    return {r[key]: r for r in df.collect()}


