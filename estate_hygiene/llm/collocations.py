"""Collocations: word sequences that occur together more often than their parts would, per language.

Counting. Shards of about SHARD_BYTES of text become count transducers: from the sorted n-grams of a shard the states are
added level by level, the n-grams with one more word after those with one less, so that n-grams share the states of
their common beginning; the weight of an arc is the number of times its path occurs, and the root's is the number of
words. A shard's arcs are cut into ranges of a hash of their first PREFIX words and sent packed, a row for each range;
a range takes the union of its transducers and adds up the weights of equal paths, folding whenever UNION_ROWS arcs wait.
So a word or pair that a third of all phrases start with is one arc for each shard, and what follows it is spread. Arcs
below MIN_COUNT go. Candidates are composed with the transducer by joining them to the arcs of their two parts, which
Spark splits where a part is common.

Sieve. Before that, words and pairs of words are counted by hash in a table of 2**SIEVE_BITS cells that stop counting at
MIN_COUNT, and then, of what these let through, n-grams of three and more words in another one. What falls in a cell that
does not reach MIN_COUNT cannot be a candidate or a part of one, so a shard leaves it out. The tables have a fixed size,
so their bits can be sent to all tasks. They are no cap: cells that hold more than one n-gram let more through, and the
counts that follow are of whole phrases. Beyond about 2**SIEVE_BITS * MIN_COUNT words all cells are full and every n-gram
is sent; for that much text raise ``sieve_bits`` or ``min_count``.

Score. For each cut, floor(1000 * a * n / (l * r)) in 38-digit decimals; the lowest counts. A candidate goes that a longer
one contains which is as frequent; as counts cannot grow with length, only candidates of one word more need to be asked.

Rows: a null text has no words; a null lang is "und". Repeated rows count each time. Texts are cut into chunks of
CHUNK_BYTES between words, each with the next words behind it to finish n-grams in, so memory is bounded for any text. Other
columns are not passed on. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estate_hygiene.llm.blocks import arrow_schema, packed, table, unpacked
from estate_hygiene.llm.workspace import shuffle_partitions, stored

LONGEST, MIN_COUNT, TOP = 5, 100, 2000
SHARD_BYTES, CHUNK_BYTES = 8_000_000, 4_000_000
SIEVE_BITS, SEGMENT_BITS = 24, 14
NO_LANG = "und"
CELLS_SCHEMA = "segment int, cells binary"
ARCS_SCHEMA = "lang string, phrase string, words int, weight long"
SLICES_SCHEMA = "range int, arcs binary"
PREFIX, UNION_ROWS = 3, 2_000_000

_WORD, _BLANK, _BREAK = 0, 1, 2
KIND = np.zeros(256, dtype=np.uint8)
KIND[[0x20, 0x09]] = _BLANK
KIND[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = _BREAK
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_NO_WORD = re.compile(rb"[\x09-\x0D .,;:!?]")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def chunks(text: bytes, size: int = CHUNK_BYTES) -> Iterator[tuple[bytes, int]]:
    """Pieces of a text with the number of bytes in which their own words start; the rest finishes their n-grams."""
    start = 0
    while len(text) - start > size:
        cut = _NO_WORD.search(text, start + size)
        if not cut:
            break
        end, after = cut.start(), cut.start()
        for _ in range(LONGEST - 1):
            word = re.compile(rb"[\x09-\x0D .,;:!?]*[^\x09-\x0D .,;:!?]+").match(text, after)
            after = word.end() if word else after
        yield text[start:after], end - start
        start = end
    yield text[start:], len(text) - start


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator["Shard"]:
    """Rows of (lang, text) as shards of about SHARD_BYTES."""
    held, size = [], 0
    for batch in batches:
        langs = batch.column(0).to_pylist()
        texts = batch.column(1).cast(pa.large_binary())
        for lang, text in zip(langs, texts, strict=True):
            for piece, own in chunks(text.as_py() or b""):
                held.append((NO_LANG if lang is None else lang, piece, own))
                size += len(piece) + 1
                if size >= SHARD_BYTES:
                    yield Shard(held)
                    held, size = [], 0
    if held:
        yield Shard(held)


class Shard:
    """The words of some texts as numbers, in their order.

    ``word`` numbers the words, ``lang`` their languages; ``joined`` says that the next word follows in the same piece,
    ``own`` that n-grams starting here are counted here and not in another chunk.
    """

    def __init__(self, rows: list[tuple[str, bytes, int]]):
        data = LOWER[np.frombuffer(b"\n".join(t for _, t, _ in rows) + b"\n", dtype=np.uint8)]
        kind = KIND[data]
        inside = kind == _WORD
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        breaks = np.cumsum(kind == _BREAK, dtype=np.int32)[starts]
        self.joined = np.append(breaks[1:] == breaks[:-1], False) if len(starts) else np.zeros(0, dtype=bool)
        offsets = np.zeros(len(starts) + 1, dtype=np.int64)
        np.cumsum(ends - starts, out=offsets[1:])
        spelled = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
        coded = spelled.dictionary_encode()
        self.word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.words: list[bytes] = coded.dictionary.to_pylist()
        sizes = np.array([len(t) + 1 for _, t, _ in rows], dtype=np.int64)
        first = np.cumsum(sizes) - sizes
        row = np.searchsorted(first, starts, side="right") - 1
        self.own = starts < (first + np.array([o for *_, o in rows], dtype=np.int64))[row]
        names: dict[str, int] = {}
        of_row = np.array([names.setdefault(lang, len(names)) for lang, *_ in rows], dtype=np.int64)
        self.langs = list(names)
        self.lang = of_row[row]

    def hashes(self) -> np.ndarray:
        """A hash of each word and its language, alike in all shards."""
        spelled = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words], dtype=np.uint64)
        named = np.array([xxhash.xxh3_64_intdigest(n.encode()) for n in self.langs], dtype=np.uint64)
        return spelled[self.word] ^ named[self.lang]


def _and_next(hashed: np.ndarray, following: np.ndarray) -> np.ndarray:
    return (hashed * _MIX) ^ (following + (hashed >> np.uint64(29)))


def _cell(hashed: np.ndarray, bits: int) -> np.ndarray:
    return ((hashed * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


class Windows:
    """The n-grams of a shard that a sieve of words and pairs lets through, level by level."""

    def __init__(self, shard: Shard, short: np.ndarray, bits: int):
        self.hashes, self.bits = shard.hashes(), bits
        kept = short[_cell(self.hashes, bits)]
        pairs = _cell(_and_next(self.hashes, np.roll(self.hashes, -1)), bits)
        self.extends = shard.joined & kept & np.append(kept[1:], False) & short[pairs]
        self.at = np.flatnonzero(shard.own & kept)
        self.path = self.hashes[self.at]
        self.length = 1

    def lengthen(self, long: np.ndarray | None = None) -> np.ndarray:
        """One word more, where the last pair allows it and, from three words on, ``long`` does: which ones stay."""
        further = self.extends[self.at + self.length - 1]
        at = self.at[further]
        path = _and_next(self.path[further], self.hashes[at + self.length])
        if long is not None and self.length > 1:
            let = long[_cell(path, self.bits)]
            further[further] = let
            at, path = at[let], path[let]
        self.at, self.path = at, path
        self.length += 1
        return further


def met_cells(shard: Shard, bits: int, short: np.ndarray | None) -> Iterator[np.ndarray]:
    """The cells of words and pairs, or, with the sieve of these, of longer n-grams."""
    if short is None:
        hashed = shard.hashes()
        yield _cell(hashed[shard.own], bits)
        yield _cell(_and_next(hashed, np.roll(hashed, -1))[shard.own & shard.joined], bits)
        return
    windows = Windows(shard, short, bits)
    windows.lengthen()
    for _ in range(LONGEST - 2):
        windows.lengthen()
        yield _cell(windows.path, bits)


def counted_cells(shards_: Iterator[Shard], bits: int, most: int, short: np.ndarray | None = None) -> np.ndarray:
    """How often each cell is met, at most ``most``."""
    out = np.zeros(1 << bits, dtype=np.uint8 if most < 256 else np.uint32)
    for shard in shards_:
        for met in met_cells(shard, bits, short):
            cell, n = np.unique(met, return_counts=True)
            out[cell] = np.minimum(out[cell] + n, most)
    return out


def _opened(cells: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(unpacked(cells), dtype=np.uint8)).astype(bool)


def sieve(texts: DataFrame, min_count: int, bits: int, short: bytes | None = None) -> bytes:
    """A bit for each cell that reaches ``min_count``, packed: 2**bits bits. With the sieve of words and pairs, of longer n-grams."""
    segment = min(bits, SEGMENT_BITS)
    kind = np.uint8 if min_count < 256 else np.uint32

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = counted_cells(shards(batches), bits, min_count, None if short is None else _opened(short)).reshape(-1, 1 << segment)
        some = np.flatnonzero(found.any(axis=1))
        yield table(CELLS_SCHEMA, {"segment": some.tolist(), "cells": [packed(found[i].tobytes()) for i in some]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, cells in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(unpacked(cells.as_py()), dtype=kind).astype(np.int64)
                total[number] = np.minimum(total.get(number, 0) + own, min_count)
        full = {k: v >= min_count for k, v in total.items()}
        full = {k: v for k, v in full.items() if v.any()}
        yield table(CELLS_SCHEMA, {"segment": list(full), "cells": [np.packbits(v).tobytes() for v in full.values()]})

    parts = texts.mapInArrow(count, CELLS_SCHEMA).repartition(shuffle_partitions(texts.sparkSession), "segment").mapInArrow(add, CELLS_SCHEMA)
    out = np.zeros((1 << (bits - segment), (1 << segment) // 8), dtype=np.uint8)
    for row in parts.collect():
        out[row["segment"]] = np.frombuffer(row["cells"], dtype=np.uint8)
    return packed(out.tobytes())


class Transducer:
    """The n-grams of a shard that the sieve lets through, as arcs by level: parent, word and weight."""

    def __init__(self, shard: Shard, short: np.ndarray, long: np.ndarray, bits: int):
        self.shard = shard
        n_words = len(shard.words)
        self.totals = np.bincount(shard.lang[shard.own], minlength=len(shard.langs))
        windows = Windows(shard, short, bits)
        state = shard.lang[windows.at]
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for depth in range(LONGEST):
            if not len(windows.at):
                break
            arcs, first, state, weight = np.unique(state * n_words + shard.word[windows.at + depth], return_index=True, return_inverse=True, return_counts=True)
            parent = arcs // n_words
            prefix = windows.path[first] if depth < PREFIX else self.levels[-1][3][parent]
            self.levels.append((parent, arcs % n_words, weight, prefix))
            state = state[windows.lengthen(long)]

    def arcs(self) -> tuple[pa.RecordBatch, np.ndarray]:
        """All paths from the root with their weights, the root itself as the empty phrase, and a hash of each one's prefix."""
        langs, words = self.shard.langs, self.shard.words
        own_lang, paths = list(range(len(langs))), [b""] * len(langs)
        out = {"lang": list(langs), "phrase": list(paths), "words": [0] * len(langs), "weight": self.totals.tolist()}
        prefixes = [np.array([xxhash.xxh3_64_intdigest(n.encode()) for n in langs], dtype=np.uint64)]
        for depth, (parent, word, weight, prefix) in enumerate(self.levels, 1):
            parents = parent.tolist()
            paths = [paths[p] + b" " + words[w] if depth > 1 else words[w] for p, w in zip(parents, word.tolist(), strict=True)]
            own_lang = [own_lang[p] for p in parents]
            out["lang"] += [langs[i] for i in own_lang]
            out["phrase"] += paths
            out["words"] += [depth] * len(paths)
            out["weight"] += weight.tolist()
            prefixes.append(prefix)
        out["phrase"] = pa.array(out["phrase"], type=pa.binary()).cast(pa.string())
        return table(ARCS_SCHEMA, out), np.concatenate(prefixes)

    def slices(self, ranges: int) -> pa.RecordBatch:
        """The arcs of each of ``ranges`` equal ranges of the prefix hash, packed."""
        arcs, prefix = self.arcs()
        number = (((prefix >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(number, kind="stable")
        arcs, bounds = arcs.take(pa.array(order)), np.searchsorted(number[order], np.arange(ranges + 1))
        some = np.flatnonzero(np.diff(bounds)).tolist()
        sent = [packed(arcs.slice(bounds[i], bounds[i + 1] - bounds[i]).serialize().to_pybytes()) for i in some]
        return table(SLICES_SCHEMA, {"range": some, "arcs": sent})


def _union(arcs: list[pa.RecordBatch | pa.Table]) -> pa.Table:
    """Several transducers as one, the weights of equal paths added up."""
    found = pa.concat_tables([a if isinstance(a, pa.Table) else pa.Table.from_batches([a]) for a in arcs])
    summed = found.group_by(["lang", "phrase", "words"]).aggregate([("weight", "sum")])
    return summed.rename_columns({"weight_sum": "weight"}).select(found.schema.names)


def unions(slices: Iterator[pa.RecordBatch], min_count: int) -> Iterator[pa.RecordBatch]:
    """Rows of (range, arcs), sorted: the union of each range without the arcs below ``min_count``."""
    schema, current, held, rows = arrow_schema(ARCS_SCHEMA), None, [], 0

    def ended() -> list[pa.RecordBatch]:
        if not held:
            return []
        found = _union(held)
        return found.filter((pc.field("weight") >= min_count) | (pc.field("words") == 0)).to_batches()

    for batch in slices:
        for number, sent in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if number != current:
                yield from ended()
                current, held, rows = number, [], 0
            held.append(pa.ipc.read_record_batch(pa.py_buffer(unpacked(sent.as_py())), schema))
            rows += held[-1].num_rows
            if rows > UNION_ROWS and len(held) > 1:
                held = [_union(held)]
                rows = held[0].num_rows // 2
    yield from ended()


def counts(docs: DataFrame, min_count: int = MIN_COUNT, sieve_bits: int = SIEVE_BITS) -> DataFrame:
    """lang, phrase, words and weight of every phrase of at most LONGEST words with ``min_count`` occurrences.

    The empty phrase, of 0 words, has the number of words of the language, however few.
    """
    texts = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    short_cells = sieve(texts, min_count, sieve_bits)
    long_cells = sieve(texts, min_count, sieve_bits, short_cells)
    ranges = shuffle_partitions(docs.sparkSession)

    def arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, long = _opened(short_cells), _opened(long_cells)
        for shard in shards(batches):
            yield Transducer(shard, short, long, sieve_bits).slices(ranges)

    sent = stored(texts.mapInArrow(arcs, SLICES_SCHEMA), "slices")
    by_range = sent.repartition(ranges, "range").sortWithinPartitions("range")
    return by_range.mapInArrow(lambda batches: unions(batches, min_count), ARCS_SCHEMA)


def _times(a: Column, b: Column) -> Column:
    return a.cast("decimal(19,0)") * b.cast("decimal(18,0)")


def candidates(arcs: DataFrame, scale: int = 1000) -> DataFrame:
    """lang, phrase, a, l, r, n and score of all candidates that no longer one stands for."""
    longest = arcs.where("words > 1").withColumn("parts", F.split("phrase", " "))
    cuts = longest.select("lang", "phrase", F.col("weight").alias("a"), "parts", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("parts", 1, F.col("k")), " ").alias("head"),
        F.array_join(F.slice("parts", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"),
    )
    heads = arcs.where("words > 0").select("lang", F.col("phrase").alias("head"), F.col("weight").alias("l"))
    rests = arcs.where("words > 0").select("lang", F.col("phrase").alias("rest"), F.col("weight").alias("r"))
    totals = arcs.where("words = 0").select("lang", F.col("weight").alias("n"))
    composed = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).join(totals, "lang")
    score = F.call_function("div", _times(F.col("a") * scale, F.col("n")), _times(F.col("l"), F.col("r")))
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = composed.groupBy("lang", "phrase", "a", "n").agg(lowest)
    whole = longest.where("words > 2")
    ends = F.array(F.slice("parts", 1, F.col("words") - 1), F.slice("parts", 2, F.col("words") - 1))
    inner = whole.select("lang", F.explode(ends).alias("inner"), "weight").select("lang", F.array_join("inner", " ").alias("phrase"), "weight")
    longer = inner.groupBy("lang", "phrase").agg(F.max("weight").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
    return kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def top_phrases(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, sieve_bits: int = SIEVE_BITS) -> DataFrame:
    """The first ``top`` candidates of each language by score, frequency and phrase, with their rank."""
    arcs = stored(counts(docs, min_count, sieve_bits), "frequent")
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = candidates(arcs).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
