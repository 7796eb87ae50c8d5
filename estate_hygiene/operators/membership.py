"""A filter of fixed size that tells which keys cannot be among a few."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BITS = 2**17
_WORD = 64


def _spot(keys: Sequence[Column]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BITS))


def membership(rows: DataFrame, keys: Sequence[str]) -> Column:
    """Bits of the hashed keys of ``rows``, as a value that any other frame can use: BITS bits in 64-bit words.

    It stands for a subquery that Spark runs once. The rows fold to at most BITS / 64 words before they meet, and the
    result has the same size however many they are.
    """
    spots = rows.select(_spot([F.col(k) for k in keys]).alias("spot"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("spot", F.lit(_WORD)).cast("int"))
    words = spots.select(F.floor(F.col("spot") / _WORD).cast("int").alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    held = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    every = F.transform(F.sequence(F.lit(0), F.lit(BITS // _WORD - 1)), lambda i: F.coalesce(held[i], F.lit(0).cast("bigint")))
    return words.agg(every.alias("bits")).scalar()


def may_be_member(bits: Column, keys: Sequence[Column]) -> Column:
    """False only for keys that were not among the rows. A column expression, in generated code."""
    spot = _spot(keys)
    word = F.get(bits, F.floor(spot / _WORD).cast("int"))
    return F.call_function("getbit", word, F.pmod(spot, F.lit(_WORD)).cast("int")) == 1
