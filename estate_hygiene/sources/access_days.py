"""Accesses folded by day, so that an audit need not read the whole window of the job log again.

The newest k events of a dataset, kind and day are kept; the newest k of any window of days are among them, and so are
those of a window that begins within a day, since what it leaves out of that day is older than what it keeps. A version
holds a range of days; of a day that several versions hold the newest counts, so a range can be folded again after late
rows have come in.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from estate_hygiene.functions.timestamps import days_before, instant, utc
from estate_hygiene.operators.access import DATASET, EVENTS_KEPT, LOOKBACK_DAYS, events_of, summary_of, top_k_access
from estate_hygiene.sources import versions

KINDS = (*DATASET, "is_write")
SCHEMA = T.StructType(
    [
        *[T.StructField(name, T.StringType()) for name in DATASET],
        T.StructField("is_write", T.BooleanType()),
        T.StructField("creation_time", T.TimestampType()),
        T.StructField("user_email", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("day", T.DateType()),
    ]
)


def folded(jobs: DataFrame, first: date, last: date, k: int = EVENTS_KEPT) -> DataFrame:
    """The newest ``k`` reads and writes of each dataset on each day from ``first`` to ``last``, both included.

    The days bound the scan of the job log; rows are cut to k in every map task.
    """
    time = F.col("creation_time")
    within = jobs.where((time >= instant(first.isoformat())) & (time < instant((last + timedelta(days=1)).isoformat())))
    events = events_of(within).withColumn("day", F.to_date("creation_time"))
    return top_k_access(events, (*KINDS, "day"), k).select(*KINDS, "creation_time", "user_email", "day")


def fold_days(jobs: DataFrame, root: str, first: date, last: date, k: int = EVENTS_KEPT) -> int:
    """Store the fold of some days as the next version and return its number of rows."""
    spark = jobs.sparkSession
    version = versions.next_version(spark, root)
    with versions.claimed(spark, root, version):
        rows = versions.written(folded(jobs, first, last, k), versions.folder(root, version), "day")
        versions.commit(spark, root, version, {"rows": rows, "first": first.isoformat(), "last": last.isoformat(), "k": k})
    return rows


def _owners(records: list[dict], since: date) -> dict[date, int]:
    """For each stored day from ``since`` on, the newest version that holds it."""
    found: dict[date, int] = {}
    for r in records:
        day, last = max(since, date.fromisoformat(r["first"])), date.fromisoformat(r["last"])
        while day <= last:
            found[day] = r["version"]
            day += timedelta(days=1)
    return found


def read_days(spark: SparkSession, root: str, as_of: datetime | str, days: int = LOOKBACK_DAYS, k: int = EVENTS_KEPT) -> DataFrame:
    """Stored events strictly later than ``days`` before ``as_of``. A day of the window that was never folded, or was
    folded to fewer than ``k`` events, is an error: it would look like a day without access."""
    end = utc(as_of)
    start = (end - timedelta(days=days)).date()
    records = [r for r in versions.records(spark, root) if r["k"] >= k]
    owners = _owners(records, start)
    window = [start + timedelta(days=i) for i in range((end.date() - start).days + 1)]
    missing = [d.isoformat() for d in window if d not in owners and instant_after(d, end)]
    if missing:
        raise ValueError(f"days without a fold of {k} events: {', '.join(missing)}")
    needed = sorted(set(owners.values()))
    rows = spark.read.schema(SCHEMA).option("basePath", root).parquet(*[versions.folder(root, v) for v in needed]) if needed else spark.createDataFrame([], SCHEMA)
    owned = F.lit(False)
    for v in needed:
        owned |= (F.col("version") == v) & F.col("day").isin([d for d, o in owners.items() if o == v])
    return rows.where(owned & (F.col("creation_time") > days_before(as_of, days))).drop("version", "day")


def instant_after(day: date, end: datetime) -> bool:
    """Whether any moment of the day lies before ``end``."""
    return datetime(day.year, day.month, day.day, tzinfo=end.tzinfo) < end


def access_summary(spark: SparkSession, root: str, as_of: datetime | str, k: int = EVENTS_KEPT, days: int = LOOKBACK_DAYS) -> DataFrame:
    """``operators.access.access_summary`` from the stored days."""
    return summary_of(top_k_access(read_days(spark, root, as_of, days, k), KINDS, k))
