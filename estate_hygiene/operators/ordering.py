"""Row order of the control table, and places in an order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from estate_hygiene.functions.names import free_name
from estate_hygiene.operators.classify import DEEP_TRANCHES, UNKNOWN_RANK, rank_of
from estate_hygiene.session import own_folder


def sheet_order() -> list[Column]:
    """Ascending sort columns: tranche, then rounded size downwards with missing sizes last, then name."""
    return [
        rank_of(F.col("tranche"), DEEP_TRANCHES, UNKNOWN_RANK).alias("tranche_rank"),
        F.col("size_gb").isNull().alias("unsized"),
        (-F.col("size_gb")).alias("size_down"),
        F.col("project"),
        F.col("region"),
        F.col("dataset"),
    ]


def sheet_position(sheet: DataFrame) -> Column:
    """The place of a row as one comparable value: its ``seq`` in a sheet that was read in an order of its own, the
    order above for rows without one.

    Operators that need the first or last row take ``min_by`` or ``max_by`` over it, which Spark combines
    before the shuffle; numbering all rows would send the whole table through one task.
    """
    own = [F.col("seq").isNull().alias("unnumbered"), F.col("seq").alias("number")] if "seq" in sheet.columns else []
    return F.struct(*own, *sheet_order())


def numbered(df: DataFrame, order: Sequence[Column], name: str = "place", running: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` with the place of each row in ``order``, from 1 and without gaps.

    Two passes: rows are dealt to ranges of the order and stored with the number of their range, ranges are counted, and
    a row's place is its place in its range after the rows of all earlier ranges. Ranges are cut by Spark's own sample, so
    no task holds the whole table, and the driver none of it. ``order`` should tell all rows apart: rows that it does not
    lie in one range, in any order. ``running`` names running totals to add, the row itself included:
    {"so_far": "size"}. Columns of ``df`` with these names are replaced.
    """
    running = dict(running or {})
    part = free_name(df, "range")
    root = own_folder(df.sparkSession, "ordered")
    df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()).write.mode("overwrite").parquet(root)
    stored = df.sparkSession.read.parquet(root)
    first = {c: free_name(df, f"{c}_before") for c in (name, *running)}
    sums = [F.count(F.lit(1)).alias(first[name]), *[F.sum(old).alias(first[new]) for new, old in running.items()]]
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored.groupBy(part).agg(*sums).select(part, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in first.values()])
    within = Window.partitionBy(part).orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    places = {name: (F.col(first[name]) + F.row_number().over(within)).cast("bigint")}
    places |= {new: F.col(first[new]) + F.coalesce(F.sum(old).over(upto), F.lit(0)) for new, old in running.items()}
    kept = [c for c in df.columns if c not in places]
    return stored.join(offsets, part).select(*kept, *[c.alias(n) for n, c in places.items()])
