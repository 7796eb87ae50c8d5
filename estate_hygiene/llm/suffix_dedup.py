"""Suffix-array dedup over bytes: remove what any string of LENGTH bytes covers that also starts elsewhere.

Suffixes. Every window of LENGTH bytes names one position in its first REACH bytes, the leftmost least of the hashes of
GRAM bytes there. The choice depends on the window alone, so equal windows name the same offset, and a long match is seen
from a few hundred times fewer suffixes than it has bytes. Suffixes whose leading bytes occur once are ruled out by a
64-bit hash; the others are sorted.

Sort. Splitters sampled from the suffixes' leading bytes cut the order into ranges; a suffix goes to its range with the
bytes around it. Splitters are MOST_RANGES at most, whatever the size of the table, and so is their sample on the driver;
a table that needs more buckets has each range's suffixes dealt to several by the hash of their leading bytes. Buckets are
sorted by a multikey quicksort that compares eight bytes at a time and splits only what is still equal. Suffixes that
agree in their leading bytes lie in one range and one bucket, so none have to be compared across a boundary. Neighbours that agree in all bytes of their windows are matches at once; where members of a class
differ, each window of the class is compared.

Load. A block sends equal surroundings once, so a string that a third of all documents hold reaches its range once for
each block that holds it.

Rows: a null text is empty. Each row is a document, repeated rows too, so two equal rows of LENGTH bytes both lose their
text. A row without doc_id is judged like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate_hygiene.llm import blocks as bl
from estate_hygiene.llm.bytehash import BYTE_BASE, BYTE_VALUES, covered, prefix, windows
from estate_hygiene.llm.workspace import stored

LENGTH, REACH, GRAM = 400, 300, 16
LEAD = LENGTH - REACH + 1
#: The sample of splitters: so many suffixes of a block, and blocks at least, and so many suffixes for each range.
SAMPLE_SUFFIXES, SAMPLE_BLOCKS, SAMPLE_OF_RANGE = 512, 32, 32
MOST_RANGES = 2_048
#: A block's arrays take about 80 bytes for each of its own.
BLOCK_BYTES = 1_000_000
#: While a range is sorted: bytes that are hashed at a time, and windows that are compared at a time.
BATCH_BYTES, MOST_WINDOWS = 1_000_000, 1_000_000
RESULT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text binary"


class Suffixes:
    """The chosen suffixes of a block: position and the range of window starts that chose it."""

    def __init__(self, block: bl.Block):
        self.block, data = block, block.data
        self.sums = prefix(BYTE_VALUES[data], BYTE_BASE)
        sizes = np.diff(block.offsets) - 1
        n = np.maximum(sizes - LENGTH + 1, 0)
        self.start = np.repeat(block.offsets[:-1] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else np.zeros(0, dtype=np.int64)
        if not len(self.start):
            self.chosen, self.first, self.last = (np.zeros(0, dtype=np.int64) for _ in range(3))
        else:
            grams = np.arange(len(data) - GRAM + 1)
            bits = np.uint64(max(24, int(len(data)).bit_length()))
            ranked = (windows(self.sums, grams, grams + GRAM, BYTE_BASE) >> bits << bits) | grams.astype(np.uint64)
            least = _sliding_least(ranked, REACH)[self.start] & ((np.uint64(1) << bits) - np.uint64(1))
            least = least.astype(np.int64)
            new = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (np.diff(self.start) != 1))))
            self.chosen, self.first = least[new], self.start[new]
            self.last = self.start[np.concatenate((new[1:], [len(least)])) - 1]
        hashes = windows(self.sums, self.chosen, self.chosen + LEAD, BYTE_BASE)
        self.keys, self.key_of, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        self.twice = counts > 1

    def shared(self, elsewhere: np.ndarray, buckets: "Buckets") -> "Surroundings":
        return Surroundings(self, np.flatnonzero((elsewhere | self.twice)[self.key_of]), buckets)

    def lead(self, i: np.ndarray) -> np.ndarray:
        """The leading bytes of some suffixes, as fixed-length strings that compare as the bytes do."""
        return np.ascontiguousarray(leading(self.block.data, self.chosen[i])).view(f"S{LEAD}").ravel()


def leading(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The LEAD bytes at some places, a row each."""
    if not len(at):
        return np.zeros((0, LEAD), dtype=np.uint8)
    return np.lib.stride_tricks.sliding_window_view(data, LEAD)[at]


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of x[i:i + width] for each i, windows cut short at the end."""
    n = len(x)
    padded = np.full((n + width - 1) // width * width + width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(rows, axis=1).ravel()
    return np.minimum(ahead[:n], behind[width - 1 : n + width - 1])


class Buckets:
    """Where suffixes are sorted: ranges between splitters, each dealt to ``parts`` by the hash of the leading bytes."""

    def __init__(self, splitters: np.ndarray, parts: int):
        self.splitters, self.parts = splitters, parts

    def of(self, lead: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        within = (hashes % np.uint64(self.parts)).astype(np.int64)
        return np.searchsorted(self.splitters, lead, "left") * self.parts + within


class Surroundings:
    """The shared suffixes of a block in order of their buckets, equal ones with equal windows taken together."""

    def __init__(self, suffixes: Suffixes, i: np.ndarray, buckets: Buckets):
        self.suffixes = suffixes
        chosen, first, last = suffixes.chosen[i], suffixes.first[i], suffixes.last[i]
        whole = windows(suffixes.sums, first, last + LENGTH, BYTE_BASE)
        shape = (chosen - first) * LENGTH + (last - first)
        order = np.lexsort((shape, whole))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (whole[order][1:] != whole[order][:-1]) | (shape[order][1:] != shape[order][:-1])
        class_of = np.zeros(len(order), dtype=np.int64)
        class_of[order] = np.cumsum(new) - 1
        one = order[new]
        bucket = buckets.of(suffixes.lead(i[one]), suffixes.keys[suffixes.key_of[i[one]]])
        by_bucket = np.argsort(bucket, kind="stable")
        rank = np.empty(len(one), dtype=np.int64)
        rank[by_bucket] = np.arange(len(one))
        one = one[by_bucket]
        self.bucket, self.i, self.class_of = bucket[by_bucket], i, rank[class_of]
        self.chosen, self.first, self.last = chosen[one], first[one], last[one]
        self.count = np.bincount(self.class_of, minlength=len(one))
        self.n_windows = self.last - self.first + 1

    def payload(self, a: int, b: int) -> bytes:
        data = self.suffixes.block.data
        head = np.stack((self.chosen[a:b] - self.first[a:b], self.n_windows[a:b], np.minimum(self.count[a:b], 2))).astype(np.int32)
        spans = [data[s : e + LENGTH].tobytes() for s, e in zip(self.first[a:b], self.last[a:b], strict=True)]
        return bl.packed(np.int32(b - a).tobytes() + head.tobytes() + b"".join(spans))

    def questions(self) -> pa.RecordBatch:
        some, first = np.unique(self.bucket, return_index=True)
        bounds = [*first.tolist(), len(self.bucket)]
        return bl.table(bl.QUESTION_SCHEMA, {
            "bucket": some.tolist(), "block_id": [self.suffixes.block.block_id] * len(some),
            "keys": [self.payload(a, b) for a, b in zip(bounds, bounds[1:], strict=False)],
        })

    def repeated_starts(self, rows: list[dict]) -> np.ndarray:
        """Starts of windows that occur elsewhere, by the bits that came back: one for each window of each suffix."""
        ends = np.concatenate(([0], np.cumsum(self.n_windows)))
        bits = np.zeros(ends[-1], dtype=bool)
        for row in rows:
            low, high = (ends[np.searchsorted(self.bucket, row["bucket"], side)] for side in ("left", "right"))
            bits[low:high] = np.unpackbits(np.frombuffer(row["answer"], dtype=np.uint8), count=high - low).astype(bool)
        n = self.n_windows[self.class_of]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        starts = np.repeat(self.suffixes.first[self.i], n) + within
        return starts[bits[np.repeat(ends[self.class_of], n) + within]]


def multikey_classes(data: np.ndarray, at: np.ndarray, length: int = LEAD) -> np.ndarray:
    """A number for each place, equal where all ``length`` bytes from there on are, ascending in their order.

    Three-way radix quicksort with characters of eight bytes, each read from the data when it is compared and for the rows
    still open only: rows are split by one character after another, and rows that stand alone are left where they are.
    """
    n = len(at)
    eight = np.lib.stride_tricks.sliding_window_view(np.concatenate((data, np.zeros(8, dtype=np.uint8))), 8)

    def character(rows: np.ndarray, c: int) -> np.ndarray:
        own = np.ascontiguousarray(eight[at[rows] + 8 * c]).view(">u8").ravel().astype(np.uint64)
        beyond = 8 * (c + 1) - length  # bytes of the last character that are no part of the key
        return own >> np.uint64(8 * beyond) if beyond > 0 else own

    group = np.zeros(n, dtype=np.int64)
    open_rows = np.arange(n)
    for c in range(-(-length // 8)):
        chars = character(open_rows, c)
        by = np.lexsort((chars, group[open_rows]))
        order, chars = open_rows[by], chars[by]
        if len(order) < 2:
            break
        same_group = group[order][1:] == group[order][:-1]
        split = np.concatenate(([True], ~same_group | (chars[1:] != chars[:-1])))
        # A group's number is the place of its first row, so the parts of a group stay in its place.
        heads = np.flatnonzero(split)
        size = np.diff(np.concatenate((heads, [len(order)])))
        group_start = np.flatnonzero(np.concatenate(([True], ~same_group)))
        base = np.repeat(group_start, np.diff(np.concatenate((group_start, [len(order)]))))
        group[order] = group[order] + np.repeat(heads, size) - base
        open_rows = order[np.repeat(size > 1, size)]
    return group


def _matches(group: pa.Table) -> pa.Table:
    """Sort the suffixes of a range; which of their windows occur more than once?"""
    rows = group.to_pylist()
    heads, spans = [], []
    for row in rows:
        data = bl.unpacked(row["keys"])
        n = int(np.frombuffer(data[:4], dtype=np.int32)[0])
        heads.append(np.frombuffer(data[4 : 4 + 12 * n], dtype=np.int32).reshape(3, n).astype(np.int64))
        spans.append(np.frombuffer(data[4 + 12 * n :], dtype=np.uint8))
    before, n_windows, count = np.concatenate(heads, axis=1)
    data = np.concatenate(spans)
    ends = np.cumsum(n_windows + LENGTH - 1)
    begin = ends - n_windows - LENGTH + 1
    first_bit = np.concatenate(([0], np.cumsum(n_windows)))
    bits = np.repeat(count > 1, n_windows)
    lead = multikey_classes(data, begin + before)
    whole = string_hashes(data, begin, ends - begin, np.ones(len(begin), dtype=np.int64))
    order = np.lexsort((whole, n_windows, before, lead))
    sorted_rows = np.stack((lead, before, n_windows))[:, order]
    new_class = np.concatenate(([True], np.diff(sorted_rows[0]) != 0))
    new_twin = new_class | np.concatenate(([True], (np.diff(sorted_rows[1:]) != 0).any(axis=0) | (np.diff(whole[order]) != 0)))
    twin = np.cumsum(new_twin) - 1
    size = np.bincount(twin)
    bits |= np.repeat(_placed(size[twin] > 1, order), n_windows)
    # Of rows with equal surroundings one stands for all; a class with other rows compares every window of these.
    class_of = np.cumsum(new_class) - 1
    kinds = np.bincount(class_of[new_twin])
    member = order[new_twin & (kinds[class_of] > 1)]
    if len(member):
        # Windows are equal only at the same offset from their lead, so a few offsets are compared at a time.
        rounds = min(REACH, int(n_windows[member].sum()) // MOST_WINDOWS + 1)
        edges = np.linspace(0, REACH, rounds + 1).astype(np.int64)
        for near, far in zip(edges, edges[1:], strict=False):
            low = np.maximum(0, before[member] - far + 1)
            n = np.maximum(np.minimum(n_windows[member], before[member] - near + 1) - low, 0)
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - low, n)
            window = string_hashes(data, begin[member] + low, np.full(len(member), LENGTH), n)
            offset = np.repeat(before[member], n) - within
            by = np.lexsort((window, offset, np.repeat(lead[member], n)))
            key = np.stack((np.repeat(lead[member], n), offset))[:, by]
            equal = (np.diff(key) == 0).all(axis=0) & (window[by][1:] == window[by][:-1])
            met = np.zeros(len(by), dtype=bool)
            met[by[1:]] |= equal
            met[by[:-1]] |= equal
            bits[(np.repeat(first_bit[member], n) + within)[met]] = True
        # What holds for the one that stood in holds for its twins.
        stand = np.empty(size.shape[0], dtype=np.int64)
        stand[twin[new_twin]] = order[new_twin]
        own = np.empty(len(order), dtype=np.int64)
        own[order] = stand[twin]
        others = np.flatnonzero(own != np.arange(len(own)))
        for rows_at in _batches(n_windows[others], MOST_WINDOWS):
            i = others[rows_at]
            n = n_windows[i]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            bits[np.repeat(first_bit[i], n) + within] |= bits[np.repeat(first_bit[own[i]], n) + within]
    counts = [int(h[1].sum()) for h in heads]
    return pa.Table.from_batches([bl.reply(rows, counts, bits)])


def _batches(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Runs of rows with about ``most`` in all; a larger row is one by itself."""
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - 1) // most)) + 1 if len(sizes) else []
    edges = [0, *map(int, cuts), len(sizes)]
    yield from (slice(x, y) for x, y in zip(edges, edges[1:], strict=False) if y > x)


def string_hashes(data: np.ndarray, begin: np.ndarray, length: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Hashes of ``n`` strings of each row, which start at ``begin`` and the bytes after it, of ``length`` bytes each.

    The bytes of some rows are taken at a time, since sums over them take forty times their space.
    """
    span = np.where(n > 0, length + n - 1, 0)
    out = []
    for rows in _batches(span, BATCH_BYTES):
        own, count = span[rows], n[rows]
        start = np.cumsum(own) - own
        taken = data[np.repeat(begin[rows] - start, own) + np.arange(own.sum())]
        first = np.repeat(start, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        out.append(windows(prefix(BYTE_VALUES[taken], BYTE_BASE), first, first + np.repeat(length[rows], count), BYTE_BASE))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _placed(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    out = np.empty_like(values)
    out[order] = values
    return out


def _splitters(blocks_: DataFrame, shared: DataFrame, key_buckets: int, ranges: int) -> np.ndarray:
    """Cuts between at most MOST_RANGES ranges of about equal load, from a sample of the suffixes that will be sorted."""
    n_sample = max(SAMPLE_BLOCKS, ranges * SAMPLE_OF_RANGE // SAMPLE_SUFFIXES)
    some = blocks_.select("block_id").orderBy(F.xxhash64("block_id")).limit(n_sample)

    def sample(block: bl.Block, rows: list[dict]) -> list[pa.RecordBatch]:
        suffixes = Suffixes(block)
        i = np.flatnonzero((bl.answers_of(rows, suffixes.keys, key_buckets) | suffixes.twice)[suffixes.key_of])
        picked = i[np.random.default_rng(1).permutation(len(i))[:SAMPLE_SUFFIXES]]
        return [bl.table("lead binary", {"lead": [r.tobytes() for r in leading(block.data, suffixes.chosen[picked])]})]

    chosen = blocks_.join(F.broadcast(some), "block_id", "left_semi")
    answers = shared.join(F.broadcast(some), "block_id", "left_semi")
    found = bl.with_answers(chosen, answers, sample, "lead binary").collect()
    leads = np.sort(np.array([bytes(r["lead"]) for r in found], dtype=f"S{LEAD}"))
    at = (np.arange(1, ranges) * len(leads)) // ranges if len(leads) else []
    return np.unique(leads[at]) if len(leads) else leads


def drop_repeated_bytes(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text."""
    all_blocks = bl.blocks(docs, block_bytes=BLOCK_BYTES)
    buckets = bl.n_buckets(all_blocks, 0.1)
    # Sorting a bucket takes a few bytes for each of its own, besides the arrays of one batch.
    wanted = bl.n_buckets(all_blocks, 16)
    ranges = min(wanted, MOST_RANGES)

    def ask_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in bl.opened(batches):
            keys = Suffixes(block).keys
            yield bl.questions(block, keys, buckets, lambda a, b, keys=keys: keys[a:b].tobytes())

    shared = stored(bl.repeated(all_blocks.mapInArrow(ask_keys, bl.QUESTION_SCHEMA)), "suffixes")
    dealt = Buckets(_splitters(all_blocks, shared, buckets, ranges), -(-wanted // ranges))

    def surroundings(block: bl.Block, rows: list[dict]) -> Surroundings:
        suffixes = Suffixes(block)
        return suffixes.shared(bl.answers_of(rows, suffixes.keys, buckets), dealt)

    def ask_matches(block: bl.Block, rows: list[dict]) -> list[pa.RecordBatch]:
        return [surroundings(block, rows).questions()]

    asked = bl.with_answers(all_blocks, shared, ask_matches, bl.QUESTION_SCHEMA)
    matched = asked.groupBy("bucket").applyInArrow(_matches, bl.ANSWER_SCHEMA)
    both = shared.unionByName(matched.withColumn("bucket", -1 - matched["bucket"]))

    def finish(block: bl.Block, rows: list[dict]) -> list[pa.RecordBatch]:
        found = surroundings(block, [r for r in rows if r["bucket"] >= 0])
        second = [r | {"bucket": -1 - r["bucket"]} for r in rows if r["bucket"] < 0]
        start = found.repeated_starts(second)
        gone = covered(len(block.data), start, start + LENGTH)
        edge = np.concatenate(([gone[:1].sum()], np.diff(gone.astype(np.int8)) == 1)).astype(np.int64)
        total, runs = (np.concatenate(([0], np.cumsum(x))) for x in (gone, edge))
        kept = [block.data[a : b - 1][~gone[a : b - 1]].tobytes() for a, b in zip(block.offsets, block.offsets[1:], strict=False)]
        low, high = block.offsets[:-1], block.offsets[1:]
        return [bl.table(RESULT_SCHEMA, {
            "doc_id": [int(d) if k else None for d, k in zip(block.doc_ids, block.known, strict=True)],
            "n_bytes": (high - low - 1).tolist(), "n_removed": (total[high] - total[low]).tolist(),
            "n_spans": (runs[high] - runs[low]).tolist(), "kept_sha256": [hashlib.sha256(t).hexdigest() for t in kept],
            "kept_text": kept,
        })]

    return bl.with_answers(all_blocks, both, finish, RESULT_SCHEMA)
