"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits in lower case, so punctuation and case do not hide a copy. Documents and items that
share a seed of SEED words meet. For each such pair the longest common run of unmarked words is marked in both, again and
again, until none of SEED words is left: runs of the current length are found by their Karp-Rabin hashes and checked
word by word. Tiles never overlap and may come in any order, so a passage whose parts were moved is covered like one that
was not. An item leaks into a document when tiles cover at least COVERAGE of its words.

How they meet: items are packed into lots of about LOT_BYTES, and their seeds are rows of a table. A bit filter of fixed
size, 2**SIEVE_BITS bits however many items there are, tells which documents can share a seed; only these go on, packed
into blocks. Blocks and lots meet by a join on the hash of a seed, where a block has one row for a seed however many of
its documents hold it. Each pair of a block and a lot is judged once: a task holds one of each. The driver sees the
filter's bits and the widths of seeds, never items or documents. A full filter only makes the join larger.

Rows: a null or empty text has no words and leaks nothing. An item of fewer words than a seed is one seed of its own
length, so ``shortest`` leaves items out whose words are no evidence of a leak; items without words are left out. Rows
without doc_id, and repeated rows, are judged like any others; items without item_id are matched and count, but are not
listed. Items of the same item_id are judged one by one. Of items that cover equal shares, covered_words is that of the
longest. Without items, or without documents, nothing leaks. A column that has the name of a new one is replaced; all
others stay, whatever they are called. A very long text is read for seeds PORTION words at a time; to be tiled, its words
are held as numbers of eight bytes, in about ten arrays.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate_hygiene.functions.names import free_name
from estate_hygiene.llm import blocks as bl
from estate_hygiene.llm.annotate import annotated
from estate_hygiene.llm.bytehash import WORD_BASE, Words, laid_out, mix, prefix, windows
from estate_hygiene.llm.workspace import stored

SEED = 5
COVERAGE = 0.6
LOT_BYTES = 1_000_000
SIEVE_BITS = 26
#: Words that are hashed at a time, and the length from which a word is hashed by its digest.
PORTION, LONG_WORD = 200_000, 1_000
WORD = re.compile(r"[^\W_]+")
SEED_SCHEMA = "source long, width int, seed long"
JUDGED_SCHEMA = "row long, coverage double, covered_words long, item_ids array<long>"
#: Bits of one value of Spark's bitmap functions.
BITMAP = 4_096 * 8


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def numbered(words: Iterable[str], numbers: dict[str, int]) -> np.ndarray:
    """Words as numbers; those of no item are all different from items' words, and 0."""
    return np.fromiter((numbers.get(w, 0) for w in words), dtype=np.uint64)


def _parts(text: str | None, overlap: int) -> Iterator[tuple[int, list[str]]]:
    """A text's words, PORTION at a time: how many are new, and these after the last ``overlap`` ones before them."""
    if len(text or "") <= PORTION:
        words = words_of(text)
        yield len(words), words
        return
    every, before = (m.group() for m in WORD.finditer(text.lower())), []
    while new := list(islice(every, PORTION)):
        yield len(new), before + new
        before = (before + new)[-overlap:] if overlap else []


def _joined(words: list[str]) -> bytes:
    if words and len(max(words, key=len)) > LONG_WORD:
        words = [w if len(w) <= LONG_WORD else hashlib.md5(w.encode()).hexdigest() for w in words]
    return " ".join(words).encode()


def seeds_of(texts: Iterable[str | None], widths: list[int], counts: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(number of the text, hash, width) of all runs of words of some widths; each text's words are added to ``counts``."""

    def hashed(parts: list[bytes], owner: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        words = Words(*laid_out(parts))
        sums = prefix(words.hashes(), WORD_BASE)
        for width in widths:
            start = np.arange(max(len(words.doc) - width + 1, 0))
            start = start[words.doc[start] == words.doc[start + width - 1]]
            yield np.array(owner)[words.doc[start]], windows(sums, start, start + width, WORD_BASE), width

    parts, owner, size = [], [], 0
    for k, text in enumerate(texts):
        counts.append(0)
        for n_new, words in _parts(text, max(widths, default=1) - 1):
            counts[k] += n_new
            if widths:
                parts.append(_joined(words))
                owner.append(k)
                size += len(words)
            if size >= PORTION:
                yield from hashed(parts, owner)
                parts, owner, size = [], [], 0
    if parts:
        yield from hashed(parts, owner)


def tiles(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in doc, place in item, length), longest first."""
    free_doc, free_item = doc != 0, np.ones(len(item), dtype=bool)
    doc_sums, item_sums = prefix(mix(doc), WORD_BASE), prefix(mix(item), WORD_BASE)
    found = []
    length = _longest(doc, item, free_doc, free_item, doc_sums, item_sums, least)
    while length >= least:
        for d, i in _common(free_doc, free_item, doc_sums, item_sums, length):
            if free_doc[d : d + length].all() and free_item[i : i + length].all() and (doc[d : d + length] == item[i : i + length]).all():
                free_doc[d : d + length] = False
                free_item[i : i + length] = False
                found.append((int(d), int(i), length))
        length = _longest(doc, item, free_doc, free_item, doc_sums, item_sums, least)
    return found


def _open(free: np.ndarray, length: int) -> np.ndarray:
    """Starts of runs of ``length`` free places."""
    taken = np.concatenate(([0], np.cumsum(~free)))
    return np.flatnonzero(taken[length:] == taken[:-length]) if len(free) >= length else np.zeros(0, dtype=np.int64)


def _common(free_doc, free_item, doc_sums, item_sums, length) -> Iterator[tuple[int, int]]:
    """Places whose runs have equal hashes, in order of the document."""
    d, i = _open(free_doc, length), _open(free_item, length)
    if not len(d) or not len(i):
        return
    item_hashes = windows(item_sums, i, i + length, WORD_BASE)
    order = np.argsort(item_hashes, kind="stable")
    item_hashes, i = item_hashes[order], i[order]
    doc_hashes = windows(doc_sums, d, d + length, WORD_BASE)
    low, high = np.searchsorted(item_hashes, doc_hashes, "left"), np.searchsorted(item_hashes, doc_hashes, "right")
    for k in np.flatnonzero(low < high):
        for at in range(low[k], high[k]):
            yield d[k], i[at]


def _longest(doc, item, free_doc, free_item, doc_sums, item_sums, least) -> int:
    """The longest common free run, by halving: a run of some length holds runs of all lesser ones."""
    low, high = least - 1, min(len(doc), len(item))
    while low < high:
        length = (low + high + 1) // 2
        if next(_common(free_doc, free_item, doc_sums, item_sums, length), None) is not None:
            low = length
        else:
            high = length - 1
    return low


class Items:
    """Some benchmark items with the hashes of their seeds."""

    def __init__(self, rows: list[tuple[int | None, str]], seed: int):
        lists = [words_of(text) for _, text in rows]
        self.numbers = {w: k for k, w in enumerate(dict.fromkeys(w for x in lists for w in x), start=1)}
        self.ids = [item_id for item_id, _ in rows]
        self.items = [numbered(x, self.numbers) for x in lists]
        self.widths = sorted({min(seed, len(x)) for x in self.items if len(x)})
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for width in self.widths:
            own = [(k, x) for k, x in enumerate(self.items) if min(seed, len(x)) == width]
            hashes = [windows(prefix(mix(x), WORD_BASE), s := np.arange(len(x) - width + 1), s + width, WORD_BASE) for _, x in own]
            owner = np.repeat([k for k, _ in own], [len(h) for h in hashes])
            every = np.concatenate(hashes)
            order = np.argsort(every, kind="stable")
            self.seeds[width] = every[order], owner[order]

    def met(self, doc: np.ndarray) -> list[int]:
        """Items that share a seed with a document."""
        out: set[int] = set()
        sums = prefix(mix(doc), WORD_BASE)
        for width, (hashes, owner) in self.seeds.items():
            at = _open(doc != 0, width)
            own = windows(sums, at, at + width, WORD_BASE)
            low, high = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
            for k in np.flatnonzero(low < high):
                out.update(owner[low[k] : high[k]].tolist())
        return sorted(out)


def _chosen(lot: bl.Block, shortest: int) -> list[tuple[int | None, str]]:
    rows = [(int(i) if k else None, t.decode()) for i, k, t in zip(lot.doc_ids, lot.known, lot.texts, strict=True)]
    return [(i, t) for i, t in rows if len(words_of(t)) >= max(shortest, 1)]


def _seed_rows(source: int, width: int, hashes: np.ndarray) -> pa.RecordBatch:
    own = np.unique(hashes).view(np.int64)
    columns = [np.full(len(own), source), np.full(len(own), width, dtype=np.int32), own]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=bl.arrow_schema(SEED_SCHEMA))


def _item_seeds(lots: DataFrame, seed: int, shortest: int) -> DataFrame:
    """The distinct seeds of each lot, by width: an item of fewer words than a seed is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in bl.opened(batches):
            texts = [t for _, t in _chosen(lot, shortest)]
            own = np.array([min(seed, len(words_of(t))) for t in texts], dtype=np.int64)
            for width in np.unique(own).tolist():
                found = [h for _, h, _ in seeds_of([t for t, n in zip(texts, own, strict=True) if n == width], [width], [])]
                yield _seed_rows(lot.block_id, width, np.concatenate(found))

    return stored(lots.mapInArrow(run, SEED_SCHEMA), "item-seeds")


def _sieve(item_seeds: DataFrame) -> np.ndarray:
    """2**SIEVE_BITS bits, one set for the leading bits of each seed. Each task folds its seeds before they meet."""
    spot = F.shiftrightunsigned("seed", 64 - SIEVE_BITS) + 1
    chunks = item_seeds.select(F.bitmap_bucket_number(spot).alias("chunk"), F.bitmap_bit_position(spot).alias("bit"))
    out = np.zeros((max(1 << SIEVE_BITS, BITMAP) // BITMAP, BITMAP // 8), dtype=np.uint8)
    for row in chunks.groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        out[row["chunk"] - 1] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out.ravel()


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    spot = (hashes >> np.uint64(65 - (8 * len(bits)).bit_length())).astype(np.int64)
    return (bits[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1


def _block_seeds(blocks_: DataFrame, widths: list[int], sent) -> DataFrame:
    """The distinct seeds of each block that pass the sieve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in bl.opened(batches):
            found: dict[int, list[np.ndarray]] = {width: [] for width in widths}
            for _, hashes, width in seeds_of((t.decode() for t in block.texts), widths, []):
                found[width].append(np.unique(hashes[_passes(sent.value, hashes)]))
            for width, own in found.items():
                if own:
                    yield _seed_rows(block.block_id, width, np.concatenate(own))

    return blocks_.mapInArrow(run, SEED_SCHEMA)


def _judged(met: DataFrame, seed: int, coverage: float, shortest: int) -> DataFrame:
    """Rows of JUDGED_SCHEMA for the documents of a block that share a seed with an item of the lot beside it."""
    fields = bl.arrow_schema(bl.BLOCK_SCHEMA).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, items = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if last != row["lot_block_id"]:
                    last, items = row["lot_block_id"], Items(_chosen(bl.Block({n: row[f"lot_{n}"] for n in fields}), shortest), seed)
                yield _tiled(bl.Block(row), items, seed, coverage)

    return met.mapInArrow(run, JUDGED_SCHEMA)


def _tiled(block: bl.Block, items: Items, seed: int, coverage: float) -> pa.RecordBatch:
    out: dict[str, list] = {name: [] for name in bl.arrow_schema(JUDGED_SCHEMA).names}
    for row, text in zip(block.doc_ids.tolist(), block.texts, strict=True):
        doc = numbered((m.group() for m in WORD.finditer(text.decode().lower())), items.numbers)
        best, most, leaked = 0.0, 0, []
        met = items.met(doc)
        for k in met:
            item = items.items[k]
            n = sum(length for _, _, length in tiles(doc, item, min(seed, len(item))))
            best, most = max((best, most), (n / len(item), n))
            if n / len(item) >= coverage and items.ids[k] is not None:
                leaked.append(items.ids[k])
        if met:
            for name, value in (("row", row), ("coverage", best), ("covered_words", most), ("item_ids", leaked)):
                out[name].append(value)
    return bl.table(JUDGED_SCHEMA, out)


def with_leaks(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, coverage: float = COVERAGE, shortest: int = 1) -> DataFrame:
    """Rows of ``docs`` (text and any others, which stay) with n_words, coverage (the highest of any item),
    covered_words (of that item), item_ids (those that leak, ascending) and contaminated."""
    lots = bl.blocks(benchmark.where(F.col("text").isNotNull()), "item_id", "text", LOT_BYTES)
    item_seeds = _item_seeds(lots, seed, shortest)
    widths = sorted(r["width"] for r in item_seeds.select("width").distinct().collect())
    sent = docs.sparkSession.sparkContext.broadcast(_sieve(item_seeds))

    plain = docs.withColumn("text", F.col("text").cast("string")).drop("n_words", "coverage", "covered_words", "item_ids", "contaminated")
    row, maybe, found_row, found = (free_name(plain, n) for n in ("row", "maybe", "found_row", "found"))

    def sift(batch: pa.RecordBatch) -> dict[str, list]:
        counts: list[int] = []
        meets = np.zeros(batch.num_rows, dtype=bool)
        for owner, hashes, _ in seeds_of((x.as_py() for x in batch.column("text")), widths, counts):
            meets[owner[_passes(sent.value, hashes)]] = True
        return {"n_words": counts, maybe: meets.tolist()}

    held = stored(annotated(plain.withColumn(row, F.monotonically_increasing_id()), lambda: sift, f"n_words long, {maybe} boolean"), "sifted")
    blocks_ = bl.blocks(held.where(F.col(maybe)), row, "text")
    seeds = _block_seeds(blocks_, widths, sent).select(F.col("source").alias("block_id"), "width", "seed")
    pairs = seeds.join(item_seeds.withColumnRenamed("source", "lot_block_id"), ["width", "seed"]).select("block_id", "lot_block_id").distinct()
    met = blocks_.join(pairs.join(lots.withColumnsRenamed({n: f"lot_{n}" for n in lots.columns}), "lot_block_id"), "block_id")
    best = (
        _judged(met, seed, coverage, shortest)
        .groupBy(F.col("row").alias(found_row))
        .agg(
            F.struct(
                F.max(F.struct("coverage", "covered_words")).alias("best"),
                F.sort_array(F.flatten(F.collect_list("item_ids"))).alias("item_ids"),
            ).alias(found)
        )
    )
    # Stored, what was found has a size that Spark knows before it chooses how the documents meet it.
    joined = held.join(stored(best, "leaks"), F.col(row) == F.col(found_row), "left")
    return (
        joined.withColumn("coverage", F.coalesce(F.col(found)["best"]["coverage"], F.lit(0.0)))
        .withColumn("covered_words", F.coalesce(F.col(found)["best"]["covered_words"], F.lit(0).cast("long")))
        .withColumn("item_ids", F.coalesce(F.col(found)["item_ids"], F.array().cast("array<bigint>")))
        .withColumn("contaminated", F.col("coverage") >= coverage)
        .drop(row, maybe, found_row, found)
    )
