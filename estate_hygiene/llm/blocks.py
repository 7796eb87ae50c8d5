"""Blocks of documents, and questions that blocks ask each other.

A block is a few megabytes of whole texts, packed once and stored. A block asks about its distinct 64-bit keys: each
key goes to the bucket of its value, so a key that a third of all documents hold is sent once by a block and no bucket
gets more than its even share. A bucket answers each block with one bit for each key, in the order asked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate_hygiene.llm.bytehash import laid_out
from estate_hygiene.llm.workspace import shuffle_partitions, stored

BLOCK_BYTES = 2_000_000
BUCKET_BYTES = 64_000_000
BLOCK_SCHEMA = "block_id long, n_docs long, n_bytes long, doc_ids binary, known binary, sizes binary, texts binary"
QUESTION_SCHEMA = "bucket int, block_id long, keys binary"
ANSWER_SCHEMA = "block_id long, bucket int, answer binary"


@cache
def _compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=3)


@cache
def _decompressor() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def packed(data: bytes) -> bytes:
    return _compressor().compress(data)


def unpacked(data: bytes) -> bytes:
    return _decompressor().decompress(data)


KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(), "array<long>": pa.list_(pa.int64())}


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow form of a list of names and types; made without a session, so tasks can use it."""
    return pa.schema([(name, KINDS[kind]) for name, kind in (column.split(" ") for column in schema.split(", "))])


def table(schema: str, columns: dict[str, list]) -> pa.RecordBatch:
    kinds = arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in kinds], schema=kinds)


def text_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Rows of (id, text) gathered to about ``size`` bytes: ids, which ids are known, texts. A null text is empty."""
    ids, texts, held = [], [], 0
    for batch in batches:
        column = batch.column(1).cast(pa.large_binary())
        for doc_id, text in zip(batch.column(0).to_pylist(), column, strict=True):
            text = text.as_py() or b""
            ids.append(doc_id)
            texts.append(text)
            held += len(text) + 1
            if held >= size:
                yield *known_ids(ids), texts
                ids, texts, held = [], [], 0
    if ids:
        yield *known_ids(ids), texts


def known_ids(ids: list) -> tuple[np.ndarray, np.ndarray]:
    return np.array([x or 0 for x in ids], dtype=np.int64), np.array([x is not None for x in ids], dtype=bool)


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row of ``docs`` in a stored table of blocks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block_id = TaskContext.get().partitionId() << 33
        for ids, known, texts in text_batches(batches, block_bytes):
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            yield table(BLOCK_SCHEMA, {
                "block_id": [block_id], "n_docs": [len(ids)], "n_bytes": [int(sizes.sum())], "doc_ids": [ids.tobytes()],
                "known": [known.tobytes()], "sizes": [sizes.tobytes()], "texts": [packed(b"".join(texts))],
            })
            block_id += 1

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stored(chosen.mapInArrow(pack, BLOCK_SCHEMA), "blocks")


class Block:
    """One row of the table of blocks, opened."""

    def __init__(self, row: dict):
        self.block_id = row["block_id"]
        self.doc_ids = np.frombuffer(row["doc_ids"], dtype=np.int64)
        self.known = np.frombuffer(row["known"], dtype=bool)
        sizes = np.frombuffer(row["sizes"], dtype=np.int64)
        ends = np.cumsum(sizes)
        whole = unpacked(row["texts"])
        self.texts = [whole[e - s : e] for s, e in zip(sizes, ends, strict=True)]
        self.data, self.offsets = laid_out(self.texts)


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block(batch.slice(i, 1).to_pylist()[0])


def n_buckets(blocks_: DataFrame, bytes_for_byte: float) -> int:
    """Enough buckets for BUCKET_BYTES each, if a byte of text makes ``bytes_for_byte`` of questions."""
    total = blocks_.agg(F.sum("n_bytes")).first()[0] or 0
    return max(shuffle_partitions(blocks_.sparkSession), int(total * bytes_for_byte / BUCKET_BYTES) + 1)


def slices(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bounds of each bucket's share of sorted 64-bit keys."""
    step = 2**64 // buckets
    return np.searchsorted(keys, np.array([0, *(step * b for b in range(1, buckets)), 2**64 - 1], dtype=np.uint64), "left") if len(keys) else np.zeros(buckets + 1, dtype=np.int64)


def questions(block: Block, keys: np.ndarray, buckets: int, payload: Callable[[int, int], bytes]) -> pa.RecordBatch:
    """A row for each bucket that any of the sorted keys fall in."""
    bounds = slices(keys, buckets)
    bounds[-1] = len(keys)
    some = np.flatnonzero(np.diff(bounds))
    return table(QUESTION_SCHEMA, {
        "bucket": some.tolist(), "block_id": [block.block_id] * len(some),
        "keys": [payload(int(bounds[b]), int(bounds[b + 1])) for b in some],
    })


def answers_of(rows: list[dict], keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bits that came back for the sorted keys; a bucket that has none set sends nothing."""
    bounds = slices(keys, buckets)
    bounds[-1] = len(keys)
    out = np.zeros(len(keys), dtype=bool)
    for row in rows:
        low, high = bounds[row["bucket"]], bounds[row["bucket"] + 1]
        out[low:high] = np.unpackbits(np.frombuffer(row["answer"], dtype=np.uint8), count=high - low).astype(bool)
    return out


def reply(group: list[dict], counts: list[int], bits: np.ndarray) -> pa.RecordBatch:
    """Rows of bits for the blocks that asked, ``counts`` keys each; blocks without a set bit get none."""
    ends = np.cumsum(counts)
    out = [(row, bits[e - n : e]) for row, n, e in zip(group, counts, ends, strict=True)]
    out = [(row, own) for row, own in out if own.any()]
    return table(ANSWER_SCHEMA, {
        "block_id": [r["block_id"] for r, _ in out], "bucket": [r["bucket"] for r, _ in out],
        "answer": [np.packbits(own).tobytes() for _, own in out],
    })


def raw_keys(payload: bytes) -> np.ndarray:
    return np.frombuffer(payload, dtype=np.uint64)


def repeated(asked: DataFrame, keys_of: Callable[[bytes], np.ndarray] = raw_keys) -> DataFrame:
    """For questions whose payload is sorted distinct 64-bit keys: which of them another block asked about too."""

    def answer(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        keys = [keys_of(r["keys"]) for r in rows]
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        same = every[order][1:] == every[order][:-1]
        bits = np.zeros(len(every), dtype=bool)
        bits[order[1:]] |= same
        bits[order[:-1]] |= same
        return pa.Table.from_batches([reply(rows, [len(k) for k in keys], bits)])

    return asked.groupBy("bucket").applyInArrow(answer, ANSWER_SCHEMA)


def with_answers(blocks_: DataFrame, answers: DataFrame, visit: Callable[[Block, list[dict]], list[pa.RecordBatch]], schema: str) -> DataFrame:
    """``visit`` each block together with what it was answered."""
    empty = arrow_schema(schema).empty_table()

    def open_(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [b for row in left.to_pylist() for b in visit(Block(row), right.to_pylist())]
        return pa.Table.from_batches(out) if out else empty

    return blocks_.groupBy("block_id").cogroup(answers.groupBy("block_id")).applyInArrow(open_, schema)
