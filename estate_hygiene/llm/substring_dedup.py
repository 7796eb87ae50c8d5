"""Substring dedup over words, with difference-cover anchors.

A window of WINDOW words goes if the same words start earlier, in a smaller document or earlier in the same one. Windows
of ANCHOR words are hashed only where the position modulo PERIOD lies in COVER. Every difference modulo PERIOD is a
difference of two members of COVER, so two equal windows, wherever they start, hold an anchor at the same offset, which
is below PERIOD; therefore WINDOW = ANCHOR + PERIOD - 1 words are enough to be sure of it. Anchors that occur once rule
out their surroundings; around the others every window is hashed in full and its first occurrence found.

Rows: a null or empty text has no words. A row without doc_id is returned whole and matches nothing. Rows that share a
doc_id are one document in order, so the same start in each of them is no earlier one and both stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from estate_hygiene.llm import blocks as bl
from estate_hygiene.llm.bytehash import SECOND_BASE, WORD_BASE, Words, covered, from_planes, planes, prefix, windows
from estate_hygiene.llm.workspace import stored

PERIOD, COVER = 13, (0, 1, 3, 9)
WINDOW = 20
RESULT_SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


class Parsed:
    """The words of a block and the hashes of its anchors."""

    def __init__(self, block: bl.Block, window: int):
        self.block, self.window, self.anchor = block, window, window - PERIOD + 1
        self.words = Words(block.data, block.offsets)
        self.word_hashes = self.words.hashes()
        self.sums = prefix(self.word_hashes, WORD_BASE)
        n = self.words.count
        judged = np.repeat(block.known & (n >= window), n)
        self.place = np.arange(len(judged)) - np.repeat(self.words.first[:-1], n)
        self.left = np.repeat(n, n) - self.place
        is_cover = np.isin(self.place % PERIOD, COVER)
        self.anchors = np.flatnonzero(judged & is_cover & (self.left >= self.anchor))
        hashes = windows(self.sums, self.anchors, self.anchors + self.anchor, WORD_BASE)
        self.keys, self.key_of, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        self.twice = counts > 1

    def shared_windows(self, shared: np.ndarray) -> "SharedWindows":
        return SharedWindows(self, self.anchors[(shared | self.twice)[self.key_of]])


class SharedWindows:
    """The windows around anchors that occur more than once, each distinct one with its first place in the block."""

    def __init__(self, parsed: Parsed, anchors: np.ndarray):
        self.parsed, block = parsed, parsed.block
        lowest = np.maximum(anchors - (parsed.window - parsed.anchor), anchors - parsed.place[anchors])
        near = covered(len(parsed.place), lowest, anchors + 1)
        self.start = np.flatnonzero(near & (parsed.left >= parsed.window))
        high = windows(parsed.sums, self.start, self.start + parsed.window, WORD_BASE)
        second = prefix(parsed.word_hashes ^ SECOND_BASE, SECOND_BASE)
        low = windows(second, self.start, self.start + parsed.window, SECOND_BASE).astype(np.uint32)
        doc, place = block.doc_ids[parsed.words.doc[self.start]], parsed.place[self.start]
        order = np.lexsort((place, doc, low, high))
        high, low, doc, place = high[order], low[order], doc[order], place[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        self.order, self.class_of = order, np.cumsum(new) - 1
        self.high, self.low, self.doc, self.place = high[new], low[new], doc[new], place[new]
        later = (doc != self.doc[self.class_of]) | (place != self.place[self.class_of])
        self.later = np.zeros(len(order), dtype=bool)
        self.later[order] = later

    def payload(self, low: int, high: int) -> bytes:
        parts = (self.high, self.low, self.doc, self.place.astype(np.int32))
        return bl.packed(b"".join(planes(x[low:high]) for x in parts))

    def repeats(self, elsewhere: np.ndarray) -> np.ndarray:
        """Starts of windows that are not the first of their words."""
        later = self.later.copy()
        later[self.order] |= elsewhere[self.class_of]
        return self.start[later]


def _unpack(payload: bytes) -> tuple[np.ndarray, ...]:
    data = bl.unpacked(payload)
    n = len(data) // 24
    cuts = (0, 8 * n, 12 * n, 20 * n, 24 * n)
    kinds = (np.uint64, np.uint32, np.int64, np.int32)
    return tuple(from_planes(data[a:b], kind, n) for a, b, kind in zip(cuts, cuts[1:], kinds, strict=False))


def _earlier_elsewhere(group: pa.Table) -> pa.Table:
    """For each block's windows: does another block hold an earlier one?"""
    rows = group.to_pylist()
    parts = [_unpack(r["keys"]) for r in rows]
    high, low, doc, place = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((place, doc, low, high))
    high, low, doc, place = high[order], low[order], doc[order], place[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    bits = np.zeros(len(order), dtype=bool)
    bits[order] = (doc != doc[first]) | (place != place[first])
    return pa.Table.from_batches([bl.reply(rows, [len(p[0]) for p in parts], bits)])


def _kept(words: Words, gone: np.ndarray, texts: list[bytes]) -> Iterator[tuple[bytes, int]]:
    """Each document's other words, joined by one blank, and how many were taken out."""
    kept = np.flatnonzero(~gone)
    data = words.data.copy()
    data[words.end] = 0x20
    inside = covered(len(data), words.start[kept], words.end[kept] + 1)
    sizes = np.add.reduceat(inside, words.offsets[:-1], dtype=np.int64) if len(texts) else np.zeros(0, dtype=np.int64)
    left, ends = data[inside].tobytes(), np.cumsum(sizes)
    removed = np.concatenate(([0], np.cumsum(gone)))
    removed = removed[words.first[1:]] - removed[words.first[:-1]]
    for i in range(len(texts)):
        yield left[ends[i] - sizes[i] : max(ends[i] - 1, ends[i] - sizes[i])], int(removed[i])


def drop_repeated_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256, kept_text."""
    if window < PERIOD + 1:
        raise ValueError(f"a window has more than {PERIOD} words")
    all_blocks = bl.blocks(docs)
    buckets = bl.n_buckets(all_blocks, 0.6)

    def ask_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in bl.opened(batches):
            keys = Parsed(block, window).keys
            yield bl.questions(block, keys, buckets, lambda a, b, keys=keys: keys[a:b].tobytes())

    shared = stored(bl.repeated(all_blocks.mapInArrow(ask_anchors, bl.QUESTION_SCHEMA)), "anchors")

    def windows_of(block: bl.Block, rows: list[dict]) -> SharedWindows:
        parsed = Parsed(block, window)
        return parsed.shared_windows(bl.answers_of(rows, parsed.keys, buckets))

    def ask_windows(block: bl.Block, rows: list[dict]) -> list[pa.RecordBatch]:
        found = windows_of(block, rows)
        return [bl.questions(block, found.high, buckets, found.payload)]

    asked = bl.with_answers(all_blocks, shared, ask_windows, bl.QUESTION_SCHEMA)
    earlier = asked.groupBy("bucket").applyInArrow(_earlier_elsewhere, bl.ANSWER_SCHEMA)
    # Both rounds of answers go back to a block together; the second round's buckets are told by their sign.
    both = shared.unionByName(earlier.withColumn("bucket", -1 - earlier["bucket"]))

    def finish(block: bl.Block, rows: list[dict]) -> list[pa.RecordBatch]:
        found = windows_of(block, [r for r in rows if r["bucket"] >= 0])
        second = [r | {"bucket": -1 - r["bucket"]} for r in rows if r["bucket"] < 0]
        start = found.repeats(bl.answers_of(second, found.high, buckets))
        words = found.parsed.words
        gone = covered(len(words.start), start, start + window)
        kept = list(_kept(words, gone, block.texts))
        return [bl.table(RESULT_SCHEMA, {
            "doc_id": [int(d) if k else None for d, k in zip(block.doc_ids, block.known, strict=True)],
            "n_words": words.count.tolist(), "n_removed": [n for _, n in kept],
            "kept_sha256": [hashlib.sha256(t).hexdigest() for t, _ in kept],
            "kept_text": [t.decode() for t, _ in kept],
        })]

    return bl.with_answers(all_blocks, both, finish, RESULT_SCHEMA)
