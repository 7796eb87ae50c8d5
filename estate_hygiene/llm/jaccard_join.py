"""N-gram Jaccard join with a token-group matrix.

Documents are sets of 5-word shingles and link when their Jaccard similarity is 0.8 or more. Equal sets are taken
together first and stand for one another.

Neighbourhoods. Any order of the shingles will do for the prefix rule: two linked sets share one of their first
n - ceil(0.8 n) + 1 shingles. The order here puts shingles first that no other set holds, as the blocks tell each other,
and then those that a bounded sample of documents has not seen often; the sample bears on speed alone. So passages that
documents share come last, and a document is met only if at most a fifth of it is its own. A prefix shingle's documents of sizes
that can link form a neighbourhood, named after the least of them, and every linked pair meets in one.

Bitmaps. A document's shingles set bits in a bitmap of about four times their number. A bit of one document that
another lacks is a shingle that it lacks, which bounds their overlap from above; the union of a group's bitmaps bounds
it for the whole group. Documents that no other of their neighbourhood can link with by that bound go no further.

Matrix. What is left of a neighbourhood is dealt out in parts. In a part similar documents form groups, the union of each group's
shingles is stored, and a document opens only the groups whose union holds 80 % of its shingles; in these it is compared
exactly with those it is not joined to yet. Of a neighbourhood with several parts, the documents that its first round
left unconnected to its leader go on to all its other parts; the others are one component already. So no link is
lost that could join two components, and no task holds more than some parts.

Rows: a null text, or one without words, has no shingles and links with nothing; with fewer than five words the whole
sequence is one shingle. A row without doc_id has no component and links with nothing. Rows that share a doc_id are nodes
of the same name, so what links with one of them is in the component of all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estate_hygiene.llm import blocks as bl
from estate_hygiene.llm.blocks import arrow_schema
from estate_hygiene.llm.bytehash import BYTE_BASE, WORD_BASE, Words, from_planes, laid_out, mix, planes, prefix, windows
from estate_hygiene.llm.components import components
from estate_hygiene.llm.workspace import shuffle_partitions, stored

SHINGLE = 5
PERCENT = 80
#: Documents of the sample that orders shingles, the times a shingle is seen there to count as frequent, and the most
#: of these that are told apart.
SAMPLE_DOCUMENTS, FREQUENT, FREQUENT_SHINGLES = 20_000, 4, 1_000_000
#: Documents and shingles in a part of a neighbourhood, and documents in a group of the matrix.
PART, PART_SHINGLES, GROUP = 512, 1_000_000, 16
#: Neighbourhoods of more documents are dealt out in parts without a look at their bitmaps.
BITMAP_DOCUMENTS = 4_096
#: Sizes that can link lie in one band or in two that follow each other; a little more than 100 / PERCENT.
BAND = 1.2501
SET_SCHEMA = "doc_id long, n_shingles long, high long, low long, block_id long, row long, bitmap binary"
PREFIX_SCHEMA = "bucket int, block_id long, keys binary"
#: Bits of a shingle's key beyond those that number all of them, in the question whether another block holds it.
SPARE_BITS = 12
MEMBER_SCHEMA = "leader long, doc_id long, n_shingles long"
TEXT_SCHEMA = "leader long, part int, kind int, doc_id long, text binary"
EDGE_SCHEMA = "a long, b long"


class Sets:
    """The shingle sets of some documents, each one's hashes ascending: hashes, document of each, bounds."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets, lower=True)
        sums, n = prefix(words.hashes(), WORD_BASE), words.count
        each = np.where(n >= SHINGLE, n - SHINGLE + 1, (n > 0).astype(np.int64))
        start = np.repeat(words.first[:-1] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        width = np.repeat(np.minimum(n, SHINGLE), each)
        # A short text is told from a shingle by its width, which the hash takes in.
        hashes = mix(windows(sums, start, start + width, WORD_BASE) + width.astype(np.uint64) * BYTE_BASE)
        doc = np.repeat(np.arange(len(n)), each)
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        self.hashes, self.doc = hashes[new], doc[new]
        self.size = np.bincount(self.doc, minlength=len(n)).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.size)))

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i] : self.first[i + 1]]

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each set."""
        out = []
        for salt in (BYTE_BASE, WORD_BASE):
            sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mix(self.hashes ^ salt), dtype=np.uint64)))
            out.append((sums[self.first[1:]] - sums[self.first[:-1]]).view(np.int64))
        return out[0], out[1]


def bitmap(hashes: np.ndarray) -> bytes:
    """A bit for each shingle, of a power of two that is at least four times as many."""
    bits = np.zeros(max(64, 1 << (4 * len(hashes) - 1).bit_length()) if len(hashes) else 64, dtype=bool)
    bits[hashes & np.uint64(len(bits) - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(bits: bytes, width: int) -> np.ndarray:
    """A bitmap as one of ``width`` bytes, each bit standing for all that agree modulo the width."""
    return np.bitwise_or.reduce(np.frombuffer(bits, dtype=np.uint8).reshape(-1, width), axis=0)


def can_link(bitmaps: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Which documents have another that their bitmaps allow to link with."""
    out = np.zeros(len(sizes), dtype=bool)
    order = np.argsort(sizes, kind="stable")
    for width in sorted({len(b) for b in bitmaps}):
        # Documents of this width, and those of the next that are near enough in size; all at this width.
        own = [i for i in order if len(bitmaps[i]) in (width, 2 * width)]
        if len(own) < 2 or all(len(bitmaps[i]) != width for i in own):
            continue
        rows, n = np.stack([_folded(bitmaps[i], width) for i in own]), sizes[own]
        least = (PERCENT * n + 99) // 100
        starts = np.arange(0, len(own), GROUP)
        unions = np.bitwise_or.reduceat(rows, starts, axis=0)
        for k in range(len(own)):
            if n[k] == 0 or len(bitmaps[own[k]]) != width and out[own[k]]:
                continue
            groups = np.flatnonzero(n[k] - np.bitwise_count(rows[k] & ~unions).sum(axis=1, dtype=np.int64) >= least[k])
            at = (starts[groups][:, None] + np.arange(GROUP)).ravel()
            at = at[(at < len(own)) & (at != k)]
            at = at[(100 * np.minimum(n[at], n[k]) >= PERCENT * np.maximum(n[at], n[k]))]
            met = np.minimum(
                n[k] - np.bitwise_count(rows[k] & ~rows[at]).sum(axis=1, dtype=np.int64),
                n[at] - np.bitwise_count(rows[at] & ~rows[k]).sum(axis=1, dtype=np.int64),
            )
            near = at[100 * met >= PERCENT * (n[k] + n[at] - met)]
            if len(near):
                out[own[k]] = True
                out[np.array(own)[near]] = True
    return out


def _sets(all_blocks: DataFrame) -> DataFrame:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in bl.opened(batches):
            sets = Sets(block.data, block.offsets)
            high, low = sets.digests()
            yield bl.table(SET_SCHEMA, {
                "doc_id": [int(d) if k else None for d, k in zip(block.doc_ids, block.known, strict=True)],
                "n_shingles": sets.size.tolist(), "high": high.tolist(), "low": low.tolist(),
                "block_id": [block.block_id] * len(block.doc_ids), "row": list(range(len(block.doc_ids))),
                "bitmap": [bitmap(sets.of(i)) for i in range(len(block.doc_ids))],
            })

    return all_blocks.mapInArrow(measure, SET_SCHEMA)


def _frequent(all_blocks: DataFrame, n_documents: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a sample of documents holds often, ascending, and how often."""
    share = np.uint64(min(1.0, SAMPLE_DOCUMENTS / max(n_documents, 1)) * (2**64 - 1025))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in bl.opened(batches):
            picked = np.flatnonzero(mix(block.doc_ids.view(np.uint64) + BYTE_BASE) <= share)
            if len(picked):
                sets = Sets(*laid_out([block.texts[i] for i in picked]))
                keys, counts = np.unique(sets.hashes, return_counts=True)
                yield bl.questions(block, keys, buckets, lambda a, b: keys[a:b].tobytes() + counts[a:b].astype(np.int64).tobytes())

    def often(group: pa.Table) -> pa.Table:
        parts = [np.frombuffer(k, dtype=np.uint64).reshape(2, -1) for k in group.column("keys").to_pylist()]
        keys, counts = np.concatenate(parts, axis=1)
        keys, at = np.unique(keys, return_inverse=True)
        total = np.bincount(at, weights=counts.view(np.int64)).astype(np.uint64)
        some = np.flatnonzero(total >= FREQUENT)
        some = some[np.argsort(total[some], kind="stable")[-(-(-FREQUENT_SHINGLES // buckets)) :]]
        return pa.Table.from_batches([bl.table("keys binary", {"keys": [np.stack((keys[some], total[some])).tobytes()]})])

    buckets = shuffle_partitions(all_blocks.sparkSession)
    found = all_blocks.mapInArrow(sample, bl.QUESTION_SCHEMA).groupBy("bucket").applyInArrow(often, "keys binary").collect()
    if not found:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    keys, counts = np.concatenate([np.frombuffer(r["keys"], dtype=np.uint64).reshape(2, -1) for r in found], axis=1)
    order = np.argsort(keys)
    return keys[order], counts[order]


class Representatives:
    """The sets of a block that stand for their classes, and their shingles' keys, cut short."""

    def __init__(self, block: bl.Block, rows: list[int], shift: int):
        self.doc_ids, self.shift = block.doc_ids[rows], np.uint64(shift)
        self.sets = Sets(*laid_out([block.texts[i] for i in rows]))
        self.keys, self.key_of, counts = np.unique(self.sets.hashes >> self.shift, return_inverse=True, return_counts=True)
        self.twice = counts > 1

    def spread(self) -> np.ndarray:
        """The keys over the whole range of 64 bits, in the same order."""
        return self.keys << self.shift

    def payload(self, a: int, b: int) -> bytes:
        steps = np.diff(self.keys[a:b], prepend=self.keys.dtype.type(0))
        return bl.packed(planes(steps))

    def prefixes(self, elsewhere: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shingles that a linked set must share one of, and their documents, without those that no other set holds."""
        sets, shared = self.sets, (elsewhere | self.twice)[self.key_of]
        rank = shared.astype(np.uint64)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, sets.hashes), len(frequent) - 1)
            rank += np.where(shared & (frequent[at] == sets.hashes), counts[at], 0).astype(np.uint64)
        order = np.lexsort((sets.hashes, rank, sets.doc))
        place = np.arange(len(order)) - np.repeat(sets.first[:-1], sets.size)
        length = sets.size - (PERCENT * sets.size + 99) // 100 + 1
        chosen = order[place < np.repeat(length, sets.size)]
        chosen = chosen[shared[chosen]]
        return sets.hashes[chosen], sets.doc[chosen]


def _keys_of(payload: bytes) -> np.ndarray:
    data = bl.unpacked(payload)
    return np.cumsum(from_planes(data, np.uint64, len(data) // 8), dtype=np.uint64)


def _neighbourhoods(group: pa.Table) -> pa.Table:
    """Documents that share a prefix shingle, and have sizes that can link, under the least of them.

    A neighbourhood takes in two bands of size that follow each other, so every such pair is in one; where the lower
    band has no document the pair of bands above holds all of it."""
    keys, doc, size = np.concatenate([np.frombuffer(bl.unpacked(k), dtype=np.int64).reshape(3, -1) for k in group.column("keys").to_pylist()], axis=1)
    order = np.argsort(keys, kind="stable")
    new = np.concatenate(([True], keys[order][1:] != keys[order][:-1]))
    many = np.diff(np.concatenate((np.flatnonzero(new), [len(keys)])))
    some = order[(many > 1)[np.cumsum(new) - 1]]
    keys, doc, size = keys[some], doc[some], size[some]
    band = np.floor(np.log(np.maximum(size, 1)) / np.log(BAND)).astype(np.int64)
    keys, doc, size, lower, pair = (np.concatenate(x) for x in ((keys, keys), (doc, doc), (size, size), (np.ones(len(band), bool), np.zeros(len(band), bool)), (band, band - 1)))
    order = np.lexsort((doc, pair, keys))
    keys, doc, size, lower, pair = keys[order], doc[order], size[order], lower[order], pair[order]
    if not len(keys):
        return arrow_schema(MEMBER_SCHEMA).empty_table()
    first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (pair[1:] != pair[:-1]))))
    held = np.diff(np.concatenate((first, [len(keys)])))
    wanted = np.repeat((held > 1) & np.logical_or.reduceat(lower, first), held)
    pairs = np.unique(np.stack((np.repeat(doc[first], held)[wanted], doc[wanted], size[wanted])), axis=1)
    return pa.Table.from_arrays([pa.array(x) for x in pairs], schema=arrow_schema(MEMBER_SCHEMA))


class Joined:
    """Which documents of a part are connected."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = sorted((self.root(i), self.root(j)))
        self.parent[j] = i


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort()
    met = int((both[1:] == both[:-1]).sum())
    return 100 * met >= PERCENT * (len(a) + len(b) - met)


def matrix_join(sets: Sets, n_queries: int, joined: Joined) -> None:
    """Join linked documents: the first ``n_queries`` against all, or with none, all against each other."""
    n = len(sets.size)
    asking = range(n_queries or n)
    if n <= GROUP:
        for i in asking:
            for j in range(i + 1, n):
                if joined.root(i) != joined.root(j) and _linked(sets.of(i), sets.of(j)):
                    joined.join(i, j)
        return
    # Groups: neighbours in the order of the least shingles, which similar sets mostly share.
    some = np.flatnonzero(sets.size)
    least = np.zeros(n, dtype=np.uint64)
    least[some] = np.minimum.reduceat(sets.hashes, sets.first[some])
    group = np.empty(n, dtype=np.int64)
    group[np.argsort(least, kind="stable")] = np.arange(n) // GROUP
    n_groups = int(group.max()) + 1
    tokens, token = np.unique(sets.hashes, return_inverse=True)
    union = np.unique(token * n_groups + group[sets.doc])
    bounds = np.searchsorted(union, np.arange(len(tokens) + 1) * n_groups)
    members = [np.flatnonzero(group == g) for g in range(n_groups)]
    for i in asking:
        own = token[sets.first[i] : sets.first[i + 1]]
        width = bounds[own + 1] - bounds[own]
        at = np.repeat(bounds[own] - (np.cumsum(width) - width), width) + np.arange(width.sum())
        overlap = np.bincount(union[at] % n_groups, minlength=n_groups)
        for g in np.flatnonzero(100 * overlap >= PERCENT * len(own)):
            for j in members[g]:
                if (j > i or n_queries) and joined.root(i) != joined.root(j) and _linked(sets.of(i), sets.of(int(j))):
                    joined.join(i, int(j))


def _parts(batches: Iterator[pa.RecordBatch], key: tuple[str, ...] = ("leader", "part")) -> Iterator[list[dict]]:
    """Consecutive rows of one part."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and any(row[k] != held[0][k] for k in key):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _open_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that connect what is linked in each part. Rows of kind 0 ask, those of kind 1 are asked; without the
    former all ask each other."""
    a: list[int] = []
    b: list[int] = []
    for rows in _parts(batches):
        rows.sort(key=lambda r: (r["kind"], r["doc_id"]))
        sets = Sets(*laid_out([bl.unpacked(r["text"]) for r in rows]))
        joined = Joined(len(rows))
        asking = sum(r["kind"] == 0 for r in rows)
        matrix_join(sets, asking, joined)
        for i, row in enumerate(rows):
            if joined.root(i) != i:
                a.append(row["doc_id"])
                b.append(rows[joined.root(i)]["doc_id"])
        if len(a) > 10_000:
            yield bl.table(EDGE_SCHEMA, {"a": a, "b": b})
            a, b = [], []
    yield bl.table(EDGE_SCHEMA, {"a": a, "b": b})


def _in_parts(rows: DataFrame) -> DataFrame:
    return rows.repartition("leader", "part").sortWithinPartitions("leader", "part").mapInArrow(_open_parts, EDGE_SCHEMA)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id."""
    all_blocks = bl.blocks(docs)
    sets = stored(_sets(all_blocks), "sets")
    digest = ["n_shingles", "high", "low"]
    with_set = sets.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = stored(
        with_set.groupBy(digest).agg(F.min(F.struct("doc_id", "block_id", "row")).alias("least"))
        .select(*digest, F.col("least.doc_id").alias("class_id"), "least.block_id", "least.row"),
        "classes",
    )
    held = classes.groupBy("block_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    held = held.select("block_id", F.lit(-1).alias("bucket"), F.lit(None).cast("binary").alias("answer"), "rows")
    n_documents, n_shingles = sets.agg(F.count("*"), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    frequent, counts = _frequent(all_blocks, n_documents)
    sent = all_blocks.sparkSession.sparkContext.broadcast((frequent, counts))
    buckets = bl.n_buckets(all_blocks, 0.6)
    shift = max(0, 64 - SPARE_BITS - int(n_shingles).bit_length())

    def representatives(block: bl.Block, rows: list[dict]) -> Representatives | None:
        own = next((r["rows"] for r in rows if r["bucket"] < 0), None)
        return Representatives(block, own, shift) if own else None

    def ask_shared(block: bl.Block, rows: list[dict]) -> list[pa.RecordBatch]:
        own = representatives(block, rows)
        return [bl.questions(block, own.spread(), buckets, own.payload)] if own else []

    def ask_prefixes(block: bl.Block, rows: list[dict]) -> list[pa.RecordBatch]:
        own = representatives(block, rows)
        if own is None:
            return []
        elsewhere = bl.answers_of([r for r in rows if r["bucket"] >= 0], own.spread(), buckets)
        keys, doc = own.prefixes(elsewhere, *sent.value)
        by = np.argsort(keys, kind="stable")
        columns = np.stack((keys[by].view(np.int64), own.doc_ids[doc[by]], own.sets.size[doc[by]]))
        return [bl.questions(block, keys[by], buckets, lambda a, b: bl.packed(columns[:, a:b].tobytes()))]

    asked = bl.with_answers(all_blocks, held, ask_shared, bl.QUESTION_SCHEMA)
    shared = bl.repeated(asked, _keys_of).withColumn("rows", F.lit(None).cast("array<bigint>"))
    told = stored(shared.unionByName(held), "shared")
    prefixes = bl.with_answers(all_blocks, told, ask_prefixes, PREFIX_SCHEMA)
    members = stored(prefixes.groupBy("bucket").applyInArrow(_neighbourhoods, MEMBER_SCHEMA).distinct(), "members")
    return _finish(all_blocks, sets, classes, members, digest)


def _finish(all_blocks: DataFrame, sets: DataFrame, classes: DataFrame, members: DataFrame, digest: list[str]) -> DataFrame:
    members = stored(_can_link(members, sets), "candidates")
    size = members.groupBy("leader").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    parts = F.greatest(F.ceil(F.col("n") / PART), F.ceil(F.col("shingles") / PART_SHINGLES)).cast("int")
    dealt = (
        members.join(size.where(F.col("n") > 1), "leader")
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
        .select("leader", "part", "parts", "doc_id")
    )
    located = dealt.withColumn("kind", F.lit(1)).join(sets.select("doc_id", "block_id", "row"), "doc_id")
    first = stored(_in_parts(_with_texts(all_blocks, located)), "links")
    found = first
    several = stored(dealt.where(F.col("parts") > 1), "parts")
    if several.limit(1).count():
        found = first.unionByName(_across_parts(all_blocks, sets, several, first))
    parts = components(found.unionByName(_named_alike(sets, classes, digest)))
    own = classes.drop("block_id", "row").join(parts, F.col("class_id") == F.col("node"), "left").select(*digest, F.coalesce("component", "class_id").alias("component_id"))
    return (
        sets.join(own, digest, "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
        .select("doc_id", "n_shingles", "component_id")
    )


def _named_alike(sets: DataFrame, classes: DataFrame, digest: list[str]) -> DataFrame:
    """Edges from a doc_id that occurs with different sets to the class of each."""
    with_set = sets.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)).select("doc_id", *digest)
    each = F.struct(*digest)
    several = with_set.groupBy("doc_id").agg(F.min(each).alias("least"), F.max(each).alias("most")).where(F.col("least") != F.col("most"))
    edges = with_set.join(several.select("doc_id"), "doc_id").join(classes.select(*digest, "class_id"), digest)
    return stored(edges.select(F.col("class_id").alias("a"), F.col("doc_id").alias("b")).distinct(), "names")


def _can_link(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Members that the bitmaps of their neighbourhood allow a link."""
    held = members.groupBy("leader").agg(F.count("*").alias("held"))
    counted = members.join(held, "leader")
    looked = counted.where(F.col("held").between(2, BITMAP_DOCUMENTS)).join(sets.select("doc_id", "bitmap"), "doc_id")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in _parts(batches, ("leader",)):
            near = can_link([r["bitmap"] for r in rows], np.array([r["n_shingles"] for r in rows], dtype=np.int64))
            out += [(r["leader"], r["doc_id"], r["n_shingles"]) for r, keep in zip(rows, near, strict=True) if keep]
            if len(out) > 10_000:
                yield bl.table(MEMBER_SCHEMA, {n: [row[i] for row in out] for i, n in enumerate(("leader", "doc_id", "n_shingles"))})
                out = []
        yield bl.table(MEMBER_SCHEMA, {n: [row[i] for row in out] for i, n in enumerate(("leader", "doc_id", "n_shingles"))})

    dealt = looked.select("leader", "doc_id", "n_shingles", "bitmap").repartition("leader").sortWithinPartitions("leader")
    passed = counted.where(F.col("held") > BITMAP_DOCUMENTS).select("leader", "doc_id", "n_shingles")
    return dealt.mapInArrow(look, MEMBER_SCHEMA).unionByName(passed).distinct()


def _across_parts(all_blocks: DataFrame, sets: DataFrame, several: DataFrame, first: DataFrame) -> DataFrame:
    """Edges between parts of a neighbourhood. The component that holds most of a neighbourhood needs no comparing
    within itself; every document outside it asks all parts but its own, in lots of a part's size."""
    now = components(first)
    placed = several.join(now, several["doc_id"] == now["node"], "left").select(several["*"], F.coalesce("component", "doc_id").alias("component"))
    counted = placed.groupBy("leader", "component").agg(F.count("*").alias("held"))
    main = counted.groupBy("leader").agg(F.max_by("component", F.struct("held", -F.col("component"))).alias("main"))
    outside = stored(placed.join(main, "leader").where(F.col("component") != F.col("main")).drop("main", "component"), "outside")
    lots = outside.groupBy("leader").agg(F.ceil(F.count("*") / PART).cast("int").alias("lots"))
    asking = outside.join(lots, "leader").withColumn("lot", F.pmod(F.xxhash64("doc_id", F.lit(1)), "lots"))
    others = F.array_remove(F.sequence(F.lit(0), F.col("parts") - 1), F.col("part"))
    asking = asking.withColumn("part", F.explode(others)).withColumn("kind", F.lit(0))
    asked = several.join(lots, "leader").withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1))).withColumn("kind", F.lit(1))
    dealt = asking.unionByName(asked).withColumn("part", (F.col("part") * F.col("lots") + F.col("lot")).cast("int")).drop("lots", "lot")
    return stored(_in_parts(_with_texts(all_blocks, dealt.join(sets.select("doc_id", "block_id", "row"), "doc_id"))), "links")


def _with_texts(all_blocks: DataFrame, dealt: DataFrame) -> DataFrame:
    """The texts of the dealt documents, which the blocks hold: a row for each place that a document is dealt to."""
    places = dealt.groupBy("block_id", "row", "doc_id").agg(F.collect_list(F.struct("leader", "part", "kind")).alias("places"))
    return bl.with_answers(all_blocks, places, lambda block, rows: [_fetched(block, rows)] if rows else [], TEXT_SCHEMA)


def _fetched(block: bl.Block, rows: list[dict]) -> pa.RecordBatch:
    columns: dict[str, list] = {name: [] for name in ("leader", "part", "kind", "doc_id", "text")}
    for row in rows:
        text = bl.packed(block.texts[row["row"]])
        for place in row["places"]:
            for name, value in (*place.items(), ("doc_id", row["doc_id"]), ("text", text)):
                columns[name].append(value)
    return bl.table(TEXT_SCHEMA, columns)
