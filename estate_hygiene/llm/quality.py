"""Quality classifier: a convolutional network over bytes, in numpy.

A text is cut into chunks of CHUNK bytes that overlap by a filter's width, so that they cover all of it. FILTERS learned
filters of WIDTH bytes run over each chunk at every byte; of each filter the largest response in the chunk is kept,
and the mean of these over a text's chunks gives one probability by a logistic layer.

Fit: on a sample of the labelled rows, chosen by a hash of doc_id, half of either label as far as there are enough: at most
TRAIN_DOCUMENTS rows, and no more than have TRAIN_BYTES of text between them. Their texts are learned from whole. The
share of the labels among all labelled rows, counted in full, corrects for the even choice. Rows whose crc32(doc_id)
modulo 5 is 0 are never learned from. Fitting takes the same steps on every run.

Memory: a task holds the responses of PORTION bytes of text at a time, whatever the length of the texts, and so does the
driver while it fits.

Rows: a null text is empty, and an empty one is a chunk of padding. Several labels of a doc_id count as the lowest, and
of several texts of one the first by its hash is learned from; null labels and doc_ids are passed over. Without labels
of both kinds every score is the share of label 1, or 0.5 without any. Other columns are passed on; one named score or
predicted is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate_hygiene.llm.annotate import annotated, texts_of
from estate_hygiene.llm.workspace import stored

FILTERS, WIDTH, CHUNK = 32, 6, 256
TRAIN_DOCUMENTS, TRAIN_BYTES = 2_000, 32_000_000
EPOCHS, BATCH, RATE, DECAY = 14, 64, 0.02, 1e-4
THRESHOLD = 0.3
#: Bytes scored at a time in a task.
PORTION = 65_536
SPAN = CHUNK + WIDTH


@dataclass
class Network:
    taps: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray
    weights: np.ndarray
    offset: float

    def pairs(self) -> np.ndarray:
        """Responses to two bytes at once, for half as many look-ups."""
        first, second = self.taps[0::2], self.taps[1::2]
        return (first[:, :, None, :] + second[:, None, :, :]).reshape(WIDTH // 2, 65536, FILTERS)

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights + self.offset, -30, 30)))


def cut(text: bytes) -> np.ndarray:
    """The chunks that cover a text, one a row, padded with zeros."""
    n = max(1, -(-len(text) // CHUNK))
    padded = np.zeros(n * CHUNK + SPAN - CHUNK, dtype=np.uint8)
    padded[: len(text)] = np.frombuffer(text, dtype=np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, SPAN)[::CHUNK]


def responses(chunks: np.ndarray, pairs: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """(chunks, places, filters), before the largest is taken."""
    two = chunks[:, :-1].astype(np.intp) * 256 + chunks[:, 1:]
    out = np.take(pairs[0], two[:, :CHUNK], axis=0)
    for k in range(1, WIDTH // 2):
        out += np.take(pairs[k], two[:, 2 * k : 2 * k + CHUNK], axis=0)
    out += bias
    return out


def features(texts: list[bytes], network: Network, pairs: np.ndarray) -> np.ndarray:
    """The mean over each text's chunks of the largest response, all chunks of all texts."""
    out = np.zeros((len(texts), FILTERS))
    for i, chunks in portions(texts):
        pooled = np.maximum(responses(chunks, pairs, network.bias).max(axis=1), 0)
        np.add.at(out, i, pooled)
    counts = np.array([max(1, -(-len(t) // CHUNK)) for t in texts])
    return out / counts[:, None]


def portions(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of consecutive texts, with the number of the text of each, about PORTION bytes at a time."""
    most = PORTION // CHUNK
    owners, held, n = [], [], 0
    for i, text in enumerate(texts):
        chunks = cut(text)
        for at in range(0, len(chunks), most):
            part = chunks[at : at + most]
            owners.append(np.full(len(part), i))
            held.append(part)
            n += len(part)
            if n >= most:
                yield np.concatenate(owners), np.concatenate(held)
                owners, held, n = [], [], 0
    if held:
        yield np.concatenate(owners), np.concatenate(held)


def fit(documents: list[np.ndarray], labels: np.ndarray, share: float) -> Network:
    """Train on the chunks of some documents by Adam; ``share`` is that of label 1 among all labelled rows."""
    rng = np.random.default_rng(5)
    network = Network(rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, dtype=np.float32), rng.normal(0, 0.1, FILTERS), 0.0)
    moments = [np.zeros((2, *np.shape(p))) for p in (network.taps, network.bias, network.weights, network.offset)]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(documents))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            _learn(network, [documents[i] for i in batch], labels[batch], moments, step, rate)
    sample_share = labels.mean()
    network.offset += np.log(share / (1 - share)) - np.log(sample_share / (1 - sample_share))
    return network


def _learn(network: Network, documents: list[np.ndarray], labels: np.ndarray, moments: list[np.ndarray], step: int, rate: float) -> None:
    chunks = np.concatenate(documents)
    counts = np.array([len(d) for d in documents])
    owner = np.repeat(np.arange(len(documents)), counts)
    pairs, most = network.pairs(), max(1, PORTION // CHUNK)
    best, top = np.zeros((len(chunks), FILTERS), dtype=np.int64), np.zeros((len(chunks), FILTERS), dtype=np.float32)
    for at in range(0, len(chunks), most):
        out = responses(chunks[at : at + most], pairs, network.bias)
        best[at : at + most] = out.argmax(axis=1)
        top[at : at + most] = np.take_along_axis(out, best[at : at + most, None, :], axis=1)[:, 0, :]
    pooled = np.maximum(top, 0)
    mean = np.zeros((len(documents), FILTERS))
    np.add.at(mean, owner, pooled / counts[owner, None])
    error = (network.probability(mean) - labels) / len(labels)
    by_weight, by_offset = mean.T @ error + DECAY * network.weights, error.sum()
    back = (error[owner] / counts[owner])[:, None] * network.weights * (top > 0)
    by_taps = np.zeros(network.taps.shape)
    filters = np.broadcast_to(np.arange(FILTERS), best.shape)
    for k in range(WIDTH):
        np.add.at(by_taps[k], (chunks[np.arange(len(chunks))[:, None], best + k], filters), back)
    for name, slope, (m, v) in zip(("taps", "bias", "weights", "offset"), (by_taps, back.sum(0), by_weight, by_offset), moments, strict=True):
        m += 0.1 * (slope - m)
        v += 0.001 * (np.square(slope) - v)
        change = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        now = getattr(network, name)
        setattr(network, name, now - change.astype(now.dtype) if isinstance(now, np.ndarray) else float(now - change))


def held_out(doc_id: str = "doc_id"):
    """Rows that are never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def _sample(rows: list, most: int) -> set[int]:
    """doc_ids in the order of their hash, each label's in turn, as long as their texts fit in ``most`` bytes."""
    by_label = [sorted((r["hash"], r["doc_id"], r["size"]) for r in rows if r["quality"] == q) for q in (0, 1)]
    chosen, left = set(), most
    for pair in zip_longest(*by_label):
        for one in pair:
            if one is None or one[2] > left:
                continue
            chosen.add(one[1])
            left -= one[2]
    return chosen


def trained(documents: DataFrame, labels: DataFrame, n_documents: int = TRAIN_DOCUMENTS) -> Network:
    """A network fitted to ``labels`` (doc_id, quality) of ``documents`` (doc_id, text)."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    ones, total = known.agg(F.sum("quality"), F.count("*")).first()
    share = ones / total if total else 0.5
    blank = Network(np.zeros((WIDTH, 256, FILTERS), dtype=np.float32), np.zeros(FILTERS, dtype=np.float32), np.zeros(FILTERS), 0.0)
    blank.offset = float(np.log(share / (1 - share))) if 0 < share < 1 else (30.0 if share == 1 else -30.0)
    if share in (0.0, 1.0) or not total:
        return blank
    picked = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id")).limit(n_documents // 2) for q in (0, 1)]
    picked = picked[0].unionByName(picked[1])
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = F.min(F.struct(F.xxhash64("text").alias("by"), F.coalesce("text", F.lit("")).alias("text"))).alias("first")
    found = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "quality").agg(first)
    found = stored(found.select("doc_id", "quality", F.encode("first.text", "UTF-8").alias("text")), "labelled")
    sizes = found.select("doc_id", "quality", F.xxhash64("doc_id").alias("hash"), F.octet_length("text").alias("size")).collect()
    chosen = _sample(sizes, TRAIN_BYTES)
    rows = sorted((r["doc_id"], r["quality"], bytes(r["text"])) for r in found.where(F.col("doc_id").isin(list(chosen))).collect())
    y = np.array([q for _, q, _ in rows], dtype=np.float64)
    if not 0 < y.sum() < len(y):
        return blank
    return fit([cut(text) for *_, text in rows], y, share)


def scored(docs: DataFrame, network: Network) -> DataFrame:
    """Rows of ``docs`` (text and any others, which stay) with score and predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def make() -> Callable[[pa.RecordBatch], dict[str, list]]:
        network = sent.value
        pairs = network.pairs()

        def score(batch: pa.RecordBatch) -> dict[str, list]:
            p = network.probability(features(texts_of(batch), network, pairs)) if batch.num_rows else np.zeros(0)
            return {"score": p.tolist(), "predicted": (p >= THRESHOLD).astype(int).tolist()}

        return score

    return annotated(docs.withColumn("text", F.col("text").cast("string")), make, "score double, predicted int")
