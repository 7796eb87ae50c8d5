"""Lexical retrieval packing: sequences of at most WINDOW tokens from documents that are alike.

Documents are tokenized once, and the documents that hold each token id are counted over all of them; the vocabulary
bounds that table. Documents are sorted by their rarest token into shards of about SHARD_TOKENS tokens, so that a hot
word or source is spread over as many shards as it needs. Each shard builds a BM25 inverted index of its documents. A
seed opens a window; its unused neighbours of the shard follow, best first, until the window is full; the one that is cut
goes on in the next window as its seed. When no neighbour is left the next unused document follows. So windows are full,
and what is left at a shard's end is cut at powers of two, which need no padding.

Rows: a null text is empty, and an empty one is the end token alone. Rows without doc_id, and repeated rows, are packed
like any others, each by itself.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate_hygiene.llm.blocks import packed, table, unpacked
from estate_hygiene.llm.workspace import give_back, shuffle_partitions, stored

WINDOW, END = 2_048, 1
SHARD_TOKENS = 4_000_000
#: BM25, and the rarest terms of a seed that make up its query.
K1, B, QUERY_TERMS, NEIGHBOURS = 1.2, 0.75, 24, 64
#: Words that a task's tokenizer remembers; others are encoded again.
REMEMBERED = 400_000
TOKEN_SCHEMA = "doc_id long, n_tokens long, ids binary"
PIECE_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Token ids of texts. White space never joins what stands at its sides, so each distinct word is encoded once.

    A word of Latin letters with marks behind them is two pre-tokens, the letters in lower case and the marks; both are
    known from other words as a rule. All other words go through the tokenizer as they are.
    """

    LETTERS = "a-zß-öø-ÿ"
    SIMPLE = re.compile(rf"([{LETTERS}]+)([!-&(-/:;=-@\[-`{{-~]*)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.known, self.parts = Tokenizer.from_file(path), {}, {}
        settings = json.loads(self.tokenizer.to_str())
        steps = (settings["pre_tokenizer"] or {}).get("pretokenizers", [])
        lower = any(n["type"] == "Lowercase" for n in (settings["normalizer"] or {}).get("normalizers", []))
        apart = [x["pattern"].get("Regex", "") for x in steps if x["type"] == "Split" and x["invert"]]
        self.splits = lower and len(apart) == 1 and apart[0].endswith("[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")
        spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        latin = [chr(c) for c in range(0xC0, 0x100)]
        self.spelling = {ord(c): spelled.pre_tokenize_str(c)[0][0] for c in latin}

    def _encoded(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=np.uint32).tobytes() for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]

    def _learn(self, new: list[bytes], found: dict[bytes, bytes]) -> None:
        rest: list[bytes] = []
        parts = self.parts if len(self.parts) < REMEMBERED else dict(self.parts)
        simple, tokenize, spelling = self.SIMPLE.fullmatch, self.tokenizer.model.tokenize, self.spelling
        for word in new if self.splits else ():
            m = simple(word.decode().lower())
            if m is None:
                rest.append(word)
                continue
            letters, marks = m.groups()
            ids = parts.get(letters)
            if ids is None:
                spelled = letters if letters.isascii() else letters.translate(spelling)
                ids = parts[letters] = array("I", [t.id for t in tokenize(spelled)]).tobytes()
            if marks:
                if marks not in parts:
                    parts[marks] = self._encoded([marks])[0]
                ids += parts[marks]
            found[word] = ids
        rest = rest if self.splits else new
        for at in range(0, len(rest), 10_000):
            words = rest[at : at + 10_000]
            found.update(zip(words, self._encoded([w.decode() for w in words]), strict=True))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        split = [t.split() for t in texts]
        new = [w for w in set().union(*split) if w not in self.known]
        found = self.known if len(self.known) + len(new) <= REMEMBERED else dict(self.known)
        self._learn(new, found)
        end = np.array([END], dtype=np.uint32).tobytes()
        return [np.frombuffer(b"".join([*map(found.__getitem__, s), end]), dtype=np.uint32) for s in split]


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One for each worker process, which keeps its words from task to task."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def forget_words() -> None:
    _tokenizers.clear()
    give_back()


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                texts = [x.as_py() or b"" for x in part.column(1).cast(pa.binary())]
                ids = tokenizer(path).encode(texts)
                yield table(TOKEN_SCHEMA, {
                    "doc_id": part.column(0).to_pylist(), "n_tokens": [len(x) for x in ids],
                    "ids": [packed(x.tobytes()) for x in ids],
                })
        give_back()

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(encode, TOKEN_SCHEMA)


def _ids(data: bytes) -> np.ndarray:
    return np.frombuffer(unpacked(data), dtype=np.uint32)


def counted(total: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """``total`` with one more for each distinct id of a document."""
    most = int(ids.max())
    if most >= len(total):
        total = np.concatenate((total, np.zeros(most + 1 - len(total), dtype=np.int64)))
    total[ids] += 1  # one for each distinct id, however often it stands here, so none have to be sorted
    return total


def _document_counts(tokens: DataFrame) -> np.ndarray:
    """How many documents hold each token id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for data in batch.column("ids").to_pylist():
                total = counted(total, _ids(data))
        some = np.flatnonzero(total)
        yield table("token long, held long", {"token": some.tolist(), "held": total[some].tolist()})

    rows = tokens.select("ids").mapInArrow(count, "token long, held long").groupBy("token").agg(F.sum("held").alias("held")).collect()
    out = np.zeros(max((r["token"] for r in rows), default=0) + 1, dtype=np.int64)
    for r in rows:
        out[r["token"]] = r["held"]
    return out


class Shard:
    """A BM25 index of some documents, and the packing of these."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.ids, self.idf = ids, idf
        lengths = np.array([len(x) for x in ids], dtype=np.int64)
        size = len(idf)
        keys, counts = np.unique(np.repeat(np.arange(len(ids)), lengths) * size + np.concatenate(ids).astype(np.int64), return_counts=True)
        # In 32 bits, a shard of SHARD_TOKENS takes half the memory.
        doc, term = (keys // size).astype(np.int32), (keys % size).astype(np.int32)
        del keys
        norm = (K1 * (1 - B + B * lengths / mean_length)).astype(np.float32)
        counts = counts.astype(np.float32)
        weight = idf.astype(np.float32)[term] * counts * np.float32(K1 + 1) / (counts + norm[doc])
        del counts
        self.terms, self.doc_bounds = term, np.searchsorted(doc, np.arange(len(ids) + 1))
        order = np.argsort(term, kind="stable").astype(np.int32)
        self.postings, self.weights = doc[order], weight[order]
        self.term_bounds = np.searchsorted(term[order], np.arange(size + 1, dtype=np.int32))

    def neighbours(self, seed: int, unused: np.ndarray) -> list[int]:
        """Unused documents that share the seed's rarest terms, best first."""
        terms = self.terms[self.doc_bounds[seed] : self.doc_bounds[seed + 1]]
        if len(terms) > QUERY_TERMS:
            terms = terms[np.argpartition(-self.idf[terms], QUERY_TERMS)[:QUERY_TERMS]]
        low, width = self.term_bounds[terms], self.term_bounds[terms + 1] - self.term_bounds[terms]
        at = np.repeat(low - (np.cumsum(width) - width), width) + np.arange(width.sum())
        score = np.bincount(self.postings[at], self.weights[at], minlength=len(self.ids)) * unused
        best = np.argpartition(-score, min(NEIGHBOURS, len(score) - 1))[:NEIGHBOURS]
        best = best[score[best] > 0]
        return best[np.lexsort((best, -score[best]))].tolist()

    def order(self) -> Iterator[int]:
        """Documents in the order in which they fill windows, each window's neighbours after its seed."""
        unused = np.ones(len(self.ids), dtype=bool)
        seed, after = None, 0
        filled = 0
        for _ in range(len(self.ids)):
            if seed is None:
                while not unused[after]:
                    after += 1
                queue, seed = [], after
                doc = seed
            elif queue:
                doc = queue.pop(0)
            else:
                while not unused[after]:
                    after += 1
                doc = after
            unused[doc] = False
            yield doc
            filled += len(self.ids[doc])
            if filled >= WINDOW or doc == seed or not queue:
                # The document that was cut, or that stands alone, is the seed of what follows.
                filled %= WINDOW
                seed, queue = doc, self.neighbours(doc, unused)


def pieces(shard: Shard, doc_ids: list, sequence: int) -> Iterator[tuple]:
    """(doc_id, start, ids, tokens of the document, sequence, offset)."""
    total = sum(len(x) for x in shard.ids)
    full = total // WINDOW
    ends = [WINDOW] * full + [1 << b for b in range(WINDOW.bit_length() - 1, -1, -1) if (total % WINDOW) >> b & 1]
    at, offset = 0, 0
    for doc in shard.order():
        ids, start = shard.ids[doc], 0
        while start < len(ids):
            length = min(len(ids) - start, ends[at] - offset)
            yield doc_ids[doc], start, ids[start : start + length], len(ids), sequence + at, offset
            start, offset = start + length, offset + length
            if offset == ends[at]:
                at, offset = at + 1, 0


def packed_sequences(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Pieces of all rows of ``docs`` (doc_id, text): doc_id, start, length, ids (unsigned 32-bit, little-endian),
    doc_tokens, sequence_id, offset."""
    tokens = stored(tokenized(docs, tokenizer_path or default_tokenizer()), "tokens")
    held = _document_counts(tokens)
    n_docs, n_tokens = tokens.agg(F.count("*"), F.sum("n_tokens")).first()
    idf = np.log(1 + (n_docs - held + 0.5) / (held + 0.5))
    mean_length = (n_tokens or 1) / max(n_docs, 1)
    sent = tokens.sparkSession.sparkContext.broadcast((held, idf))
    shards = max(shuffle_partitions(tokens.sparkSession), -(-(n_tokens or 0) // SHARD_TOKENS))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value[0]
        for batch in batches:
            rarest = []
            for data in batch.column("ids").to_pylist():
                ids = _ids(data)
                rarest.append(int(ids[np.argmin(held[ids])]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rarest, type=pa.int64())], names=[*batch.schema.names, "rarest"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        idf, sequence = sent.value[1], TaskContext.get().partitionId() << 40
        doc_ids, ids, size = [], [], 0
        # All texts are tokenized by now: the index takes the place of the words that the worker remembers.
        forget_words()
        for batch in batches:
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                doc_ids.append(doc_id)
                ids.append(_ids(data))
                size += len(ids[-1])
                if size >= SHARD_TOKENS:
                    sequence = yield from _rows(Shard(ids, idf, mean_length), doc_ids, sequence)
                    doc_ids, ids, size = [], [], 0
        if ids:
            yield from _rows(Shard(ids, idf, mean_length), doc_ids, sequence)
        del doc_ids, ids
        give_back()

    signed = tokens.mapInArrow(sign, TOKEN_SCHEMA + ", rarest long")
    dealt = signed.repartitionByRange(shards, "rarest", "doc_id").sortWithinPartitions("rarest", "doc_id", "ids")
    return dealt.mapInArrow(fill, PIECE_SCHEMA)


def _rows(shard: Shard, doc_ids: list, sequence: int):
    """Batches of pieces; returns the next free sequence."""
    held: list[tuple] = []
    last = sequence
    for piece in pieces(shard, doc_ids, sequence):
        held.append(piece)
        last = piece[4]
        if len(held) == 2_000:
            yield _piece_batch(held)
            held = []
    if held:
        yield _piece_batch(held)
    return last + 1


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    doc_id, start, ids, total, sequence, offset = zip(*rows, strict=True)
    return table(PIECE_SCHEMA, {
        "doc_id": doc_id, "start": start, "length": [len(x) for x in ids], "ids": [x.astype("<u4").tobytes() for x in ids],
        "doc_tokens": total, "sequence_id": sequence, "offset": offset,
    })
