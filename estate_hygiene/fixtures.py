"""Estate tables derived from the benchmark tables (see FIXTURES.md), lazily and for any scale."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from estate_hygiene.functions.names import dataset_key
from estate_hygiene.functions.timestamps import instant, utc
from estate_hygiene.operators.selection import contains_confirmed
from estate_hygiene.schemas import JOBS, TABLE_REF

AS_OF = "2001-08-02 00:00:00"
BACKUP_ROOT = "gs://backup"
PROJECTS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
REGIONS = ("eu", "europe-west2")
DATASET_WORDS = ("test_area", "tmp_load", "poc", "orders_latest", "sales", "core", "billing", "crm")


def _read(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "region", "r_regionkey int, r_name string")


def _gid(partkey: Column) -> Column:
    """Four tables per dataset."""
    return F.shiftright(partkey, 2)


def _with_dataset(df: DataFrame, partkey: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adds gid, dataset_id, dataset_region and dataset_project for a part key."""
    words = F.array(*[F.lit(w) for w in DATASET_WORDS])
    named = df.withColumn("gid", _gid(F.col(partkey))).select(
        "*",
        F.concat(F.get(words, F.pmod("gid", F.lit(8)).cast("int")), F.lit("_"), F.col("gid").cast("string")).alias(
            "dataset_id"
        ),
        F.when(F.pmod("gid", F.lit(10)) < 5, REGIONS[0]).otherwise(REGIONS[1]).alias("dataset_region"),
    )
    regions = _regions(spark, sf_dir).withColumnRenamed("r_name", "dataset_project")
    return named.join(regions, F.pmod("gid", F.lit(5)) == F.col("r_regionkey")).drop("r_regionkey")


def _datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per dataset: every fourth part starts one."""
    parts = _read(spark, sf_dir, "part", "p_partkey bigint").select(_gid(F.col("p_partkey")).alias("g"))
    one_part = parts.distinct().select((F.col("g") * 4).alias("p_partkey"))
    return _with_dataset(one_part, "p_partkey", spark, sf_dir).select(
        F.col("dataset_project").alias("project_id"), F.col("dataset_region").alias("region"), "dataset_id", "gid"
    )


def schemata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _datasets(spark, sf_dir).select("project_id", "region", F.col("dataset_id").alias("schema_name"))


def schema_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = F.array(
        F.when(
            F.pmod("gid", F.lit(3)) == 0,
            F.struct(
                F.lit("description").alias("option_name"),
                F.concat(F.lit('"desc '), F.col("gid").cast("string"), F.lit('"')).alias("option_value"),
            ),
        ),
        F.when(
            F.pmod("gid", F.lit(2)) == 0,
            F.struct(
                F.lit("location").alias("option_name"),
                F.concat(F.lit('"'), F.col("region"), F.lit('"')).alias("option_value"),
            ),
        ),
    )
    rows = _datasets(spark, sf_dir).select(
        "project_id", "region", F.col("dataset_id").alias("schema_name"), F.explode(options).alias("option")
    )
    return rows.where(F.col("option").isNotNull()).select("project_id", "region", "schema_name", "option.*")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _read(spark, sf_dir, "part", "p_partkey bigint, p_size int")
    return _with_dataset(parts, "p_partkey", spark, sf_dir).select(
        F.col("dataset_project").alias("project_id"),
        F.col("dataset_region").alias("region"),
        F.col("dataset_id").alias("table_schema"),
        F.concat(F.lit("t_"), F.col("p_partkey").cast("string")).alias("table_name"),
        "p_partkey",
        "p_size",
        "gid",
    )


def tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = F.make_dt_interval(F.pmod(F.col("p_partkey") * 37, F.lit(2400)).cast("int"))
    return _parts(spark, sf_dir).select(
        "project_id", "region", "table_schema", "table_name", (instant("1995-01-01") + age).alias("creation_time")
    )


def table_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem", "l_partkey bigint, l_quantity double, l_shipdate timestamp")
    kind = F.pmod(_gid(F.col("l_partkey")), F.lit(3))
    modifies = (kind == 0) | ((kind == 1) & (F.col("l_quantity") >= 40)) | (F.col("l_quantity") == 50)
    changes = lines.groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("quantity"),
        F.max(F.when(modifies & (F.col("l_shipdate") < instant(AS_OF)), F.col("l_shipdate"))).alias("modified"),
    )
    kept = _parts(spark, sf_dir).where((F.pmod("gid", F.lit(29)) != 0) & (F.pmod("p_partkey", F.lit(17)) != 0))
    total = (F.col("quantity") * F.col("p_size") * 4194304).cast("bigint")
    return kept.join(changes, F.col("p_partkey") == F.col("l_partkey")).select(
        "project_id",
        "region",
        "table_schema",
        "table_name",
        F.when(F.pmod("p_partkey", F.lit(23)) == 0, F.lit(0)).otherwise(total).alias("total_logical_bytes"),
        F.col("modified").alias("storage_last_modified_time"),
    )


def jobs(spark: SparkSession, sf_dir: str, as_of: str = AS_OF, days: int = 180) -> DataFrame:
    """Jobs that can fall in the look-back window.

    A job comes in pieces, as if the log were written that way: a row for each line item, which references its table
    and the neighbouring one of the same dataset, and for closed orders a row that writes the first of their tables
    and references it too. No operator counts jobs, and an order with a third of all line items is never gathered
    into one row.

    A job starts within a day after its order date. The bound on the order date follows from the window
    that every reader of the job log applies, and is stated here so that it reaches the Parquet scan.
    """
    orders = _read(
        spark, sf_dir, "orders", "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp"
    ).where(F.col("o_orderdate") > instant(utc(as_of) - timedelta(days=days + 1)))
    lines = _read(spark, sf_dir, "lineitem", "l_orderkey bigint, l_partkey bigint")
    projects = (
        _read(spark, sf_dir, "customer", "c_custkey bigint, c_nationkey int")
        .join(_read(spark, sf_dir, "nation", "n_nationkey int, n_regionkey int"), F.expr("c_nationkey = n_nationkey"))
        .join(_regions(spark, sf_dir), F.expr("n_regionkey = r_regionkey"))
        .select("c_custkey", "r_name")
    )
    seconds = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.pmod("o_orderkey", F.lit(86400)).cast("decimal(18,6)"))
    started = orders.join(projects, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("job_id"),
        F.col("r_name").alias("project_id"),
        F.when(F.pmod("o_orderkey", F.lit(2)) == 0, REGIONS[0]).otherwise(REGIONS[1]).alias("region"),
        (F.col("o_orderdate") + seconds).alias("creation_time"),
        F.when(
            F.pmod("o_custkey", F.lit(10)) == 0,
            F.concat(F.lit("svc"), F.col("o_custkey").cast("string"), F.lit("@x.iam.gserviceaccount.com")),
        )
        .otherwise(F.concat(F.lit("u"), F.col("o_custkey").cast("string"), F.lit("@example.com")))
        .alias("user_email"),
    )
    def table_of(partkey: Column) -> Column:
        name = F.concat(F.lit("t_"), partkey.cast("string"))
        return F.struct(F.col("dataset_project").alias("project_id"), "dataset_id", name.alias("table_id"))

    table, neighbour = table_of(F.col("l_partkey")), table_of(F.col("l_partkey").bitwiseXOR(F.lit(1)))
    first_parts = (
        lines.join(orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
        .groupBy("l_orderkey")
        .agg(F.min("l_partkey").alias("l_partkey"))
    )
    same_order = F.col("o_orderkey") == F.col("l_orderkey")
    no_table = F.lit(None).cast(TABLE_REF)
    reads = _with_dataset(started.join(lines, same_order), "l_partkey", spark, sf_dir)
    writes = _with_dataset(started.join(first_parts, same_order), "l_partkey", spark, sf_dir)
    return (
        reads.select("*", F.array(table, neighbour).alias("referenced_tables"), no_table.alias("destination_table"))
        .unionByName(writes.select("*", F.array(table).alias("referenced_tables"), table.alias("destination_table")))
        .select(JOBS.fieldNames())
    )


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    gid = F.col("gid").cast("string")
    parts = [
        F.lit('{"access":[{"role":"OWNER","userByEmail":"owner'),
        F.pmod("gid", F.lit(7)).cast("string"),
        F.lit('@example.com"},{"role":"READER","groupByEmail":"grp'),
        F.pmod("gid", F.lit(11)).cast("string"),
        F.lit('@example.com"},'),
        F.when(
            F.pmod("gid", F.lit(2)) == 0,
            F.concat(F.lit('{"role":"WRITER","userByEmail":"w'), gid, F.lit('@example.com"},')),
        ).otherwise(""),
        F.lit('{"view":{"projectId":"'),
        F.col("project_id"),
        F.lit('","datasetId":"'),
        F.col("dataset_id"),
        F.lit('","tableId":"v"}}],"labels":{"team":"t'),
        F.pmod("gid", F.lit(5)).cast("string"),
        F.lit('"}}'),
    ]
    return _datasets(spark, sf_dir).select("project_id", "region", "dataset_id", F.concat(*parts).alias("policy_json"))


def gid_of(dataset: Column) -> Column:
    return F.regexp_extract(dataset, r"(\d+)$", 1).cast("bigint")


def state(audit: DataFrame) -> DataFrame:
    """Workflow state for the confirmed datasets of a control table with an even group id."""
    gid = F.col("gid")
    phase = F.shiftright(F.pmod(gid, F.lit(8)), 1)
    chosen = audit.withColumn("gid", gid_of(F.col("dataset"))).where(
        contains_confirmed(F.col("deletion_status")) & (F.pmod("gid", F.lit(2)) == 0)
    )
    return chosen.select(
        dataset_key(F.col("project"), F.col("dataset")).alias("key"),
        "project",
        "dataset",
        "tranche",
        F.concat(F.lit(f"{BACKUP_ROOT}/backups/"), "project", F.lit("_"), "dataset", F.lit("_backup.json")).alias(
            "backup_path"
        ),
        (instant(AS_OF) - F.make_dt_interval(F.pmod("gid", F.lit(15)).cast("int"))).alias("scream_initiated_at"),
        F.when(phase < 2, "scream_test").when(phase == 2, "deleted").otherwise("restored").alias("status"),
        F.lit(None).cast("timestamp").alias("deleted_at"),
        F.lit(None).cast("timestamp").alias("restored_at"),
        gid.alias("seq"),
    )


def outcomes(plan: DataFrame) -> DataFrame:
    """What an executor might report for the rows of a plan that ask for something to be done."""
    asked = plan.where(F.col("action").isin("restrict", "delete", "restore"))
    return asked.select("key", (F.pmod(gid_of(F.col("dataset")), F.lit(5)) != 4).alias("ok"))


def scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemata(spark, sf_dir).select("project_id", "region").distinct()


def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load attempts: the access log of one scope was denied."""
    source = F.explode(F.array(F.lit("METADATA"), F.lit("READ"), F.lit("WRITE"))).alias("source")
    attempts = scopes(spark, sf_dir).select("project_id", "region", source)
    denied = (F.col("project_id") == "ASIA") & (F.col("region") == "eu") & (F.col("source") != "METADATA")
    return attempts.select("*", (~denied).alias("ok"), F.when(denied, "403 Access Denied").alias("error"))


#: The order of the hand-kept sheet: nothing like the order of tranches.
SHEET_ORDER = (F.desc, "dataset"), (F.asc, "project"), (F.asc, "region"), (F.asc, "copy")


def hand_kept_sheet(control: DataFrame) -> DataFrame:
    """The control table as a person might keep it: in an order of its own, every third dataset entered a second time
    with another size and label. ``copy`` tells the entries apart."""
    rows = control.drop("history_ok", "seq").withColumn("copy", F.lit(0))
    again = rows.where(F.pmod(gid_of(F.col("dataset")), F.lit(3)) == 0)
    later = {"copy": F.lit(1), "size_gb": F.col("size_gb") + 1, "tranche": F.lit("Tranche 1: Seen Again")}
    return rows.unionByName(again.withColumns(later))


def write_sheet(sheet: DataFrame, folder: str) -> None:
    """The sheet as three CSV files whose names are in its order."""
    order = [of(name) for of, name in SHEET_ORDER]
    files = sheet.repartitionByRange(3, *order).sortWithinPartitions(*order).drop("copy")
    files.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(folder)


def break_estate(spark: SparkSession, root: str) -> None:
    """Damage an estate on disk: the catalogue of AFRICA in eu is overwritten with something else, the job log of ASIA in
    europe-west2 is gone, and that of EUROPE in eu is cut short."""
    hadoop = spark._jvm.org.apache.hadoop.fs

    def folder(table: str, project: str, region: str):
        return hadoop.Path(f"{root}/{table}/project_id={project}/region={region}")

    def files(path) -> list:
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        return [(system, s.getPath()) for s in system.listStatus(path) if s.getPath().getName().startswith("part-")]

    for path, text in ((folder("schemata", "AFRICA", "eu"), b"no table at all"), (folder("jobs", "EUROPE", "eu"), b"PAR1")):
        for system, file in files(path):
            out = system.create(file, True)
            out.write(bytearray(text))
            out.close()
    gone = folder("jobs", "ASIA", "europe-west2")
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
