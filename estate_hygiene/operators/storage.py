"""Dataset and table metadata joined with storage statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from estate_hygiene.functions.names import clean_description
from estate_hygiene.functions.numbers import bytes_to_gb
from estate_hygiene.operators.access import MOST_KEPT
from estate_hygiene.operators.ordering import numbered

TABLES_PER_SCOPE = 100
SIZE_CLASSES = 8
TABLE = ("project_id", "region", "table_schema", "table_name")


def dataset_sizes(storage: DataFrame) -> DataFrame:
    return storage.groupBy("project_id", "region", F.col("table_schema").alias("dataset_id")).agg(
        bytes_to_gb(F.sum("total_logical_bytes")).alias("size_gb"),
        F.max("storage_last_modified_time").alias("last_storage_modified"),
    )


def dataset_descriptions(options: DataFrame) -> DataFrame:
    described = options.where(F.col("option_name") == "description")
    return described.groupBy("project_id", "region", F.col("schema_name").alias("dataset_id")).agg(
        F.max("option_value").alias("option_value")
    )


def dataset_metadata(schemata: DataFrame, options: DataFrame, storage: DataFrame) -> DataFrame:
    """Every dataset with description, unrounded size and last modification.

    Options and storage are folded to one row per dataset before the joins, so the joins meet unique
    keys on both sides whatever the number of tables in a dataset. A dataset without tables keeps a null size.
    """
    keys = ["project_id", "region", "dataset_id"]
    datasets = schemata.select("project_id", "region", F.col("schema_name").alias("dataset_id"))
    return (
        datasets.join(dataset_descriptions(options), keys, "left")
        .join(dataset_sizes(storage), keys, "left")
        .select(
            *keys,
            clean_description(F.col("option_value")).alias("description"),
            "size_gb",
            "last_storage_modified",
        )
    )


def nonempty_tables(tables: DataFrame, storage: DataFrame) -> DataFrame:
    sized = storage.where(F.col("total_logical_bytes") > 0).select(*TABLE, "total_logical_bytes")
    return tables.join(sized, list(TABLE), "inner").select(
        "project_id",
        "region",
        F.col("table_schema").alias("dataset_id"),
        "table_name",
        bytes_to_gb(F.col("total_logical_bytes")).alias("size_gb"),
        "creation_time",
    )


def _at_least_top(sized: DataFrame, top_n: int) -> DataFrame:
    """Without the tables that cannot be among the ``top_n`` largest of their scope. Every scope has one count for
    each of a few hundred size classes, so the running total needs no large window."""
    scope = ["project_id", "region"]
    classed = sized.withColumn("size_class", F.floor(F.log2("size_gb") * SIZE_CLASSES))
    counted = classed.groupBy(*scope, "size_class").agg(F.count(F.lit(1)).alias("n"))
    larger = Window.partitionBy(*scope).orderBy(F.col("size_class").desc())
    enough = counted.withColumn("held_before", F.sum("n").over(larger) - F.col("n")).where(F.col("held_before") < top_n)
    least = enough.groupBy(*scope).agg(F.min("size_class").alias("least_class"))
    return classed.join(least, scope).where(F.col("size_class") >= F.col("least_class")).drop("size_class", "least_class")


def _by_size() -> list[Column]:
    return [F.col("size_gb").desc(), F.col("dataset_id"), F.col("table_name")]


def _selected(sized: DataFrame, top_n: int) -> DataFrame:
    """The ``top_n`` largest of each scope by places in the order of all tables: a scope, and a size that many tables of
    it share, lie in several ranges of that order. A scope's first place comes with one value for each scope."""
    scope = ["project_id", "region"]
    placed = numbered(_at_least_top(sized, top_n), [*map(F.col, scope), *_by_size()], name="place")
    firsts = placed.groupBy(*scope).agg(F.min("place").alias("first"))
    first_of = firsts.agg(F.map_from_entries(F.collect_list(F.struct(F.struct(*scope), "first")))).scalar()
    ranked = placed.withColumn("size_rank", F.col("place") - first_of[F.struct(*scope)] + 1).drop("place")
    return ranked.where(F.col("size_rank") <= top_n)


def largest_tables(tables: DataFrame, storage: DataFrame, top_n: int = TABLES_PER_SCOPE) -> DataFrame:
    """The ``top_n`` largest tables of each scope, numbered in ``size_rank``.

    Up to MOST_KEPT Spark cuts each map task to the rows asked for, so that a scope's task meets a few rows of each. For
    more, tables are first counted by their size to the nearest eighth of a doubling; those smaller than the classes
    that hold ``top_n`` are dropped where they are read, and the rest get their places in two passes.
    """
    sized = nonempty_tables(tables, storage)
    if top_n > MOST_KEPT:
        return _selected(sized, top_n)
    by_size = Window.partitionBy("project_id", "region").orderBy(*_by_size())
    return sized.withColumn("size_rank", F.row_number().over(by_size)).where(F.col("size_rank") <= top_n)
