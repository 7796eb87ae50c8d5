"""Time expressions. Everything is evaluated at an explicit instant, in UTC."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

MICROS_PER_DAY = 86_400_000_000


def utc(as_of: datetime | str) -> datetime:
    """The instant as an aware UTC datetime; naive input is taken as UTC."""
    moment = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def instant(as_of: datetime | str) -> Column:
    """Timestamp literal. The offset is spelled out, so no session or driver time zone enters."""
    return F.lit(utc(as_of).isoformat(sep=" ", timespec="microseconds")).cast("timestamp")


def days_before(as_of: datetime | str, days: int) -> Column:
    return instant(utc(as_of) - timedelta(days=days))


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, rounded towards minus infinity.

    ``datediff`` counts midnights and ``timestampdiff`` truncates towards zero; neither fits.
    """
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return ((micros - F.pmod(micros, F.lit(MICROS_PER_DAY))) / F.lit(MICROS_PER_DAY)).cast("bigint")


def latest(*times: Column) -> Column:
    """Latest of several nullable times; null only when all are."""
    return F.greatest(*times)


def wall_clock(ts: Column) -> Column:
    """Time without zone, for output. The session time zone must be UTC."""
    return ts.cast("timestamp_ntz")


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def second_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def _fraction(ts: Column) -> Column:
    return F.when(
        F.pmod(F.unix_micros(ts), F.lit(1_000_000)) != 0, F.date_format(ts, ".SSSSSS")
    ).otherwise("")


def offset_text(ts: Column) -> Column:
    """``2026-01-31 08:00:00[.ffffff]+00:00``."""
    return F.concat(second_text(ts), _fraction(ts), F.lit("+00:00"))


def iso_text(ts: Column) -> Column:
    """``2026-01-31T08:00:00[.ffffff]``."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), _fraction(ts))
