"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks.

Targets. Sources, by code point and null last, take the weights in turn and share as many words as all texts have. A
target stops at MOST_REPEATS times its source's size; what is over is shared again by weight until no target is above.
All of this is whole numbers but the target that is returned.

Schedule. The mix has 2**m slots of about BLOCK_WORDS words. Slot i belongs to the van der Corput point of i, its m bits
read backwards over 2**m, and a point to the source in whose part of the cumulative targets it falls. The first 2**m
points are an even grid, so each source gets its share of slots to within one, and any stretch of slots is mixed nearly
as the whole. The slots of a source are ranked; the k-th one takes the k-th of equal blocks of its stream, which is the
source's documents in an order shuffled by the MD5 of doc_id, repeated as often as the target needs. Blocks are cut at
whole words so that they add up to the target exactly; so every document is taken as many times as the source is gone
through, at most MOST_REPEATS, and in the last round the first ones of the shuffled order once more.

Load. Running totals go by ranges of the hash within a source, ranks by ranges of slots; blocks and documents meet in
cells of CELL words of a stream. A source that holds a third of all words is thus spread like any other, and only totals
of a constant number of values come to the driver.

Rows: a null text has no words; a document without words has size 0 and is taken 0 times. A null source is a source of
its own. Rows that share a doc_id are documents of their own, ordered by size and text hash; a row without doc_id takes
part like any other. A source smaller than a slot's share that no point falls in joins the slot of the next point. An empty
table gives no rows. Columns other than doc_id, text and source are not passed on.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estate_hygiene.llm.workspace import stored
from estate_hygiene.operators.ordering import numbered

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 2048
CELL = 4096
WORD = r"[^\x20\x09-\x0D]+"
GRID_CHUNK = 4096
EXACT = "decimal(38,0)"


def _bits_for(rows: int) -> int:
    """Ranges of the hash, as a power of two: about 4,096 documents in each of a source that holds them all."""
    return min(20, max(8, (rows // 4096).bit_length()))


def _exact(x: Column) -> Column:
    return x.cast(EXACT)


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of numbers whose product may pass 64 bits."""
    return F.call_function("div", _exact(a), _exact(b))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and the two columns that shuffle a source."""
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        words.cast("long").alias("size"),
        F.unhex(F.md5(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("null")))).alias("shuffled"),
        F.xxhash64("text").alias("text_hash"),
    )


def _ranges(bits: int) -> Column:
    """The first bits of the hash that orders a source."""
    return F.shiftright(F.conv(F.hex(F.substring("shuffled", 1, 3)), 16, 10).cast("long"), 24 - bits)


def source_targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """source, source_size, place, weight, target and ``take``, its whole words, from (source, size) rows."""
    sums = totals.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(sums, [F.col("source").asc_nulls_last()])
    turn = F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int")
    sources = stored(ranked.withColumn("weight", F.get(F.array(*map(F.lit, weights)), turn).cast("long")), "sources")
    size, weight = F.col("source_size"), F.col("weight")
    words, free_weight = sources.agg(F.sum(size), F.sum(weight)).first()
    free = words = words or 0
    free_weight = free_weight or 1
    while True:
        full = _exact(size * most) * F.lit(free_weight).cast(EXACT) < F.lit(free).cast(EXACT) * _exact(weight)
        found = sources.agg(F.sum(F.when(full, size * most)), F.sum(F.when(~full, weight))).first()
        left = words - (found[0] or 0), found[1] or 1
        if left == (free, free_weight):
            break
        free, free_weight = left
    share = F.lit(free).cast("long") * weight
    return sources.select(
        "source", "source_size", "place", "weight",
        F.when(full, (size * most).cast("double")).otherwise(share.cast("double") / F.lit(float(free_weight))).alias("target"),
        F.when(full, size * most).otherwise(F.call_function("div", share, F.lit(free_weight).cast("long"))).alias("take"),
    )


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots: slot, place (of the source) and the part [block_start, block_end) of its repeated stream."""
    placed = numbered(sources.where("take > 0"), [F.col("place")], name="nth", running={"upto": "take"})
    placed = stored(placed.drop("nth"), "shares")
    words = placed.agg(F.sum("take")).first()[0] or 1
    bits = max(1, ceil(log2(max(words / block_words, 2))))
    points = F.lit(2**bits).cast(EXACT)

    def first_point(reached: Column) -> Column:
        return F.call_function("div", _exact(reached) * points + F.lit(words - 1).cast(EXACT), F.lit(words).cast(EXACT))

    low, high = first_point(F.col("upto") - F.col("take")), first_point(F.col("upto"))
    held = placed.select("place", "source_size", "take", low.alias("low"), F.greatest(high - low, F.lit(1)).alias("slots"))
    chunks = held.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(GRID_CHUNK).cast("long"))))
    spread = chunks.repartition("place", "chunk")
    in_chunk = F.sequence(F.col("chunk"), F.least(F.col("chunk") + GRID_CHUNK, F.col("slots")) - 1)
    point = F.least(F.col("low") + F.col("nth"), F.lit(2**bits - 1))
    slot = F.conv(F.reverse(F.lpad(F.bin(point), bits, "0")), 2, 10).cast("long")
    found = spread.withColumn("nth", F.explode(in_chunk)).select("place", "source_size", "take", "slots", slot.alias("slot"))
    found = stored(found.withColumn("stretch", F.shiftright("slot", max(0, bits - 12))), "slots")

    by_stretch = Window.partitionBy("place").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = found.groupBy("place", "stretch").agg(F.count(F.lit(1)).alias("n"))
    earlier = counts.select("place", "stretch", F.coalesce(F.sum("n").over(by_stretch), F.lit(0)).alias("before"))
    within = Window.partitionBy("place", "stretch").orderBy("slot")
    rank = F.col("before") + F.row_number().over(within) - 1
    ranked = found.join(earlier, ["place", "stretch"]).withColumn("rank", rank)
    return ranked.select(
        "slot", "place", "source_size",
        _div(_exact(F.col("rank")) * _exact(F.col("take")), F.col("slots")).alias("block_start"),
        _div(_exact(F.col("rank") + 1) * _exact(F.col("take")), F.col("slots")).alias("block_end"),
    )


def _cells(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(F.call_function("div", start, F.lit(CELL).cast("long")), F.call_function("div", end - 1, F.lit(CELL).cast("long"))))


def streams(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> tuple[DataFrame, DataFrame]:
    """The sources with their targets, and the documents with their offset in the shuffled stream of their source."""
    sizes = stored(sized(docs), "sized")
    bits = _bits_for(sizes.count())
    ranged = sizes.withColumn("hash_range", _ranges(bits))
    totals = stored(ranged.groupBy("source", "hash_range").agg(F.sum("size").alias("size")), "totals")
    sources = stored(source_targets(totals, weights, most), "targets")
    earlier = Window.partitionBy("source").orderBy("hash_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("source").alias("_source"), F.col("hash_range").alias("_range"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("range_start"))
    starts = starts.join(sources.withColumnRenamed("source", "_of"), F.col("_source").eqNullSafe(F.col("_of"))).drop("_of")
    met = F.col("source").eqNullSafe(F.col("_source")) & (F.col("hash_range") == F.col("_range"))
    within = Window.partitionBy("place", "hash_range").orderBy("shuffled", "size", "text_hash")
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offset = F.col("range_start") + F.sum("size").over(upto) - F.col("size")
    placed = ranged.join(starts, met).withColumn("offset", offset)
    return sources, stored(placed.select("doc_id", "source", "size", "source_size", "target", "place", "offset"), "placed")


def pieces(sources: DataFrame, placed: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix: slot, place, doc_id, offset (of the document), round, start and length in words of each piece, cut freely.

    The order of the mix is that of slot, round and offset + start.
    """
    blocks = schedule(sources, block_words).where(F.col("block_end") > F.col("block_start"))
    size = F.col("source_size")
    rounds = F.sequence(F.call_function("div", F.col("block_start"), size), F.call_function("div", F.col("block_end") - 1, size))
    laps = blocks.withColumn("round", F.explode(rounds)).select(
        "slot", "place", "round",
        F.greatest(F.col("block_start") - F.col("round") * size, F.lit(0)).alias("from_word"),
        F.least(F.col("block_end") - F.col("round") * size, size).alias("to_word"),
    )
    asked = laps.select("*", _cells(F.col("from_word"), F.col("to_word")).alias("cell"))
    held = placed.where("size > 0").select("place", "doc_id", "offset", "size", _cells(F.col("offset"), F.col("offset") + F.col("size")).alias("cell"))
    met = asked.join(held, ["place", "cell"])
    first = F.greatest("from_word", "offset", F.col("cell") * CELL)
    last = F.least("to_word", F.col("offset") + F.col("size"), (F.col("cell") + 1) * CELL)
    return met.where(last > first).select(
        "slot", "place", "doc_id", "offset", "round", (first - F.col("offset")).alias("start"), (last - first).alias("length")
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The pieces of the whole mix, as of ``pieces``."""
    return pieces(*streams(docs, weights, most), block_words)


def taken_words(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each document: doc_id, size, source_size, target and the words that the mix takes of it."""
    sources, placed = streams(docs, weights, most)
    found = pieces(sources, placed, block_words).groupBy(F.col("place").alias("_place"), F.col("offset").alias("_offset")).agg(F.sum("length").alias("_taken"))
    met = (F.col("place") == F.col("_place")) & (F.col("offset") == F.col("_offset")) & (F.col("size") > 0)
    taken = F.coalesce("_taken", F.lit(0)).cast("long").alias("taken")
    return placed.join(found, met, "left").select("doc_id", "source", "size", "source_size", "target", taken)
