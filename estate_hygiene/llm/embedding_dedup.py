"""Embedding near-dedup with an epsilon grid order join.

Unit vectors whose cosine is at least MIN_COSINE lie within a distance EPSILON of each other, in every orthonormal
basis. The basis here is that of the principal directions of a bounded sample; it bears on speed alone. Vectors are
sorted by their grid cells of width EPSILON on the leading directions, and the sorted sequence is cut into intervals. A
tree over the intervals keeps the box of each. From the root on, pairs of intervals are split again and again and dropped
when their boxes are further apart than EPSILON; the rest are compared, again piece by piece. Cosines near the
threshold are decided in double precision.

Equal vectors are one class from the start and count with their number. A task gets one interval and a few that it is
compared with. Of the links only counts, and edges that connect what is linked, leave a task.

Rows: a vector that is null, empty, zero or holds a null or non-finite component, or has no vec_id, links with nothing.
Vectors of different length do not link. Repeated rows are vectors of their own and link with each other; different
vectors of one vec_id are told apart, and each is in a component named by a vec_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate_hygiene.llm.blocks import arrow_schema, table
from estate_hygiene.llm.components import components
from estate_hygiene.llm.workspace import shuffle_partitions, stored

MIN_COSINE = 0.95
LEADING = 6
#: Vectors of an interval, of a piece of one, and of the sample for the principal directions; intervals met by a task.
INTERVAL, PIECE, SAMPLE, LOT = 2_048, 256, 10_000, 8
#: Children of a node of the tree, as bits.
FAN_BITS = 3
CELL_SCHEMA = "size int, node long, copies long, cell binary, vector binary"
BOX = [f"{end}_{d}" for end in ("low", "high") for d in range(LEADING)]
INTERVAL_SCHEMA = "size int, part long, at long, n long, rows binary, " + ", ".join(f"{c} double" for c in BOX)
MET_SCHEMA = "kind int, a long, b long"


def _bases(classes: DataFrame) -> dict[int, np.ndarray]:
    """Principal directions of the vectors of each length, from at most SAMPLE of them."""
    sample = classes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("vector").collect()
    by_size: dict[int, list] = {}
    for row in sample:
        by_size.setdefault(len(row["vector"]), []).append(row["vector"])
    bases = {}
    for size, rows in by_size.items():
        x = np.array(rows, dtype=np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        bases[size] = np.linalg.eigh(x.T @ x - len(x) * np.outer(x.mean(0), x.mean(0)))[1][:, ::-1]
    return bases


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _turned(unit: np.ndarray, bases: dict[int, np.ndarray]) -> np.ndarray:
    basis = bases.get(unit.shape[1])
    return unit if basis is None else unit @ basis


def _leading(turned: np.ndarray) -> np.ndarray:
    out = np.zeros((len(turned), LEADING))
    out[:, : min(LEADING, turned.shape[1])] = turned[:, :LEADING]
    return out


def _placed(classes: DataFrame, bases: dict[int, np.ndarray], eps: float) -> DataFrame:
    """Classes with their grid cell, in a form whose order is that of the grid."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            sizes = vectors.value_lengths().to_numpy()
            flat, first = vectors.flatten().to_numpy(), np.concatenate(([0], np.cumsum(sizes)))
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                x = flat[first[rows][:, None] + np.arange(size)]
                cells = np.floor(_leading(_turned(_unit(x), bases)) / eps).astype(np.int16)
                cells = (cells.astype(np.int32) + 2**15).astype(">u2")
                yield table(CELL_SCHEMA, {
                    "size": [int(size)] * len(rows), "node": batch.column("node").take(pa.array(rows)).to_pylist(),
                    "copies": batch.column("copies").take(pa.array(rows)).to_pylist(),
                    "cell": [c.tobytes() for c in cells], "vector": [v.astype(np.float64).tobytes() for v in x],
                })

    return classes.select("node", "copies", "vector").mapInArrow(place, CELL_SCHEMA)


def _intervals(placed: DataFrame, bases: dict[int, np.ndarray]) -> DataFrame:
    """The sorted sequence in intervals, each with its box and its rows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: list[dict] = []
        at = 0
        for batch in batches:
            for row in batch.select(["size", "node", "copies", "vector"]).to_pylist():
                if held and (row["size"] != held[0]["size"] or len(held) == INTERVAL):
                    yield _interval(held, TaskContext.get().partitionId(), at, bases)
                    held, at = [], at + 1
                held.append(row)
        if held:
            yield _interval(held, TaskContext.get().partitionId(), at, bases)

    parts = shuffle_partitions(placed.sparkSession)
    order = ["size", "cell", "node"]
    return placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(cut, INTERVAL_SCHEMA)


def _interval(rows: list[dict], part: int, at: int, bases: dict[int, np.ndarray]) -> pa.RecordBatch:
    x = np.frombuffer(b"".join(r["vector"] for r in rows), dtype=np.float64).reshape(len(rows), -1)
    own = np.array([(r["node"], r["copies"]) for r in rows], dtype=np.int64)
    lead = _leading(_turned(_unit(x), bases))
    box = dict(zip(BOX, [[float(v)] for v in (*lead.min(0), *lead.max(0))], strict=True))
    narrow = x.astype(np.float32)
    kind = b"4" if (narrow == x).all() else b"8"
    data = kind + own.tobytes() + (narrow if kind == b"4" else x).tobytes()
    return table(INTERVAL_SCHEMA, {"size": [x.shape[1]], "part": [part], "at": [at], "n": [len(rows)], "rows": [data]} | box)


class Interval:
    def __init__(self, row: dict, bases: dict[int, np.ndarray]):
        n, data = row["n"], row["rows"]
        kind = np.float32 if data[:1] == b"4" else np.float64
        own = np.frombuffer(data[1 : 1 + 16 * n], dtype=np.int64).reshape(n, 2)
        self.node, self.copies = own[:, 0], own[:, 1]
        self.unit = _unit(np.frombuffer(data[1 + 16 * n :], dtype=kind).reshape(n, row["size"]))
        self.narrow = self.unit.astype(np.float32)
        turned = _turned(self.unit, bases)
        self.cuts = range(0, n, PIECE)
        self.low = np.array([turned[i : i + PIECE].min(0) for i in self.cuts])
        self.high = np.array([turned[i : i + PIECE].max(0) for i in self.cuts])


def _pairs(intervals: DataFrame, eps: float) -> DataFrame:
    """Pairs of intervals, the earlier first, whose boxes come within ``eps``: down the tree, level by level."""
    widest = intervals.agg(F.max("part"), F.max("at")).first()
    part, at = (int(x or 0).bit_length() for x in widest)
    leaves = intervals.select("size", (F.col("part") * 2**at + F.col("at")).alias("id"), *BOX)
    pairs = leaves.select("size", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")).distinct()
    for level in reversed(range(-(-(part + at) // FAN_BITS) or 1)):
        ends = [F.min(c).alias(c) if c.startswith("low") else F.max(c).alias(c) for c in BOX]
        nodes = leaves.groupBy("size", F.shiftright("id", FAN_BITS * level).alias("id")).agg(*ends)
        nodes = nodes.withColumn("up", F.shiftright("id", FAN_BITS))
        left = nodes.select("size", F.col("up").alias("a"), F.col("id").alias("a_id"), *[F.col(c).alias(f"a_{c}") for c in BOX])
        right = nodes.select("size", F.col("up").alias("b"), F.col("id").alias("b_id"), *[F.col(c).alias(f"b_{c}") for c in BOX])
        met = pairs.join(left, ["size", "a"]).join(right, ["size", "b"])
        pairs = met.where((F.col("a_id") <= F.col("b_id")) & (_gap() <= eps * eps)).select("size", F.col("a_id").alias("a"), F.col("b_id").alias("b"))
    return pairs.withColumns({f"{x}_part": F.shiftright(x, at) for x in "ab"} | {f"{x}_at": F.col(x).bitwiseAND(2**at - 1) for x in "ab"})


def _gap() -> Column:
    """The square of the least distance between two boxes."""
    total = F.lit(0.0)
    for d in range(LEADING):
        apart = F.greatest(F.lit(0.0), F.col(f"a_low_{d}") - F.col(f"b_high_{d}"), F.col(f"b_low_{d}") - F.col(f"a_high_{d}"))
        total = total + apart * apart
    return total


class Links:
    """Counts of links, and what they connect, among the vectors of one task."""

    def __init__(self, intervals: list[Interval], min_cosine: float, eps: float):
        self.min_cosine, self.eps = min_cosine, eps
        self.first = np.concatenate(([0], np.cumsum([len(i.node) for i in intervals])))
        self.node = np.concatenate([i.node for i in intervals])
        self.count = np.zeros(len(self.node), dtype=np.int64)
        self.parent = np.arange(len(self.node))

    def meet(self, a: Interval, at_a: int, b: Interval, at_b: int) -> None:
        margin = max(1e-4, a.unit.shape[1] * 1e-6)
        for i, p in enumerate(a.cuts):
            for j, q in enumerate(b.cuts):
                if a is b and j < i:
                    continue
                apart = np.maximum(0, np.maximum(a.low[i] - b.high[j], b.low[j] - a.high[i]))
                if apart @ apart > self.eps * self.eps:
                    continue
                near = np.nonzero(a.narrow[p : p + PIECE] @ b.narrow[q : q + PIECE].T >= self.min_cosine - margin)
                x, y = near[0] + p, near[1] + q
                if a is b:
                    x, y = x[x < y], y[x < y]
                exact = np.einsum("ij,ij->i", a.unit[x], b.unit[y]) >= self.min_cosine
                if exact.any():
                    x, y = x[exact], y[exact]
                    np.add.at(self.count, at_a + x, b.copies[y])
                    np.add.at(self.count, at_b + y, a.copies[x])
                    self._join(at_a + x, at_b + y)

    def _join(self, x: np.ndarray, y: np.ndarray) -> None:
        while True:
            roots = np.stack((self.parent[x], self.parent[y]))
            apart = roots[0] != roots[1]
            if not apart.any():
                return
            np.minimum.at(self.parent, roots[:, apart].max(0), roots[:, apart].min(0))
            while (self.parent[self.parent] != self.parent).any():
                self.parent = self.parent[self.parent]

    def rows(self) -> pa.Table:
        some, moved = np.flatnonzero(self.count), np.flatnonzero(self.parent != np.arange(len(self.node)))
        a = np.concatenate((self.node[some], self.node[moved]))
        b = np.concatenate((self.count[some], self.node[self.parent[moved]]))
        kind = np.repeat(np.array([0, 1], dtype=np.int32), (len(some), len(moved)))
        return pa.Table.from_arrays([pa.array(kind), pa.array(a), pa.array(b)], schema=arrow_schema(MET_SCHEMA))


def _met(intervals: DataFrame, pairs: DataFrame, bases: dict[int, np.ndarray], min_cosine: float, eps: float) -> DataFrame:
    key = ["size", "a_part", "a_at", "lot"]
    pairs = pairs.withColumn("lot", F.pmod(F.xxhash64("b"), F.greatest(F.lit(1), F.ceil(F.col("partners") / LOT)))).drop("a", "b", "partners")
    rows = intervals.select("size", "part", "at", "n", "rows")
    other = pairs.join(rows.withColumnsRenamed({"part": "b_part", "at": "b_at"}), ["size", "b_part", "b_at"])
    own = pairs.select(*key).distinct().join(rows.withColumnsRenamed({"part": "a_part", "at": "a_at"}), ["size", "a_part", "a_at"])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        base, others = left.to_pylist()[0], right.to_pylist()
        first = Interval(base, bases)
        opened = [first if (r["b_part"], r["b_at"]) == (base["a_part"], base["a_at"]) else Interval(r, bases) for r in others]
        links = Links([first, *opened], min_cosine, eps)
        for i, interval in enumerate(opened):
            links.meet(first, 0, interval, 0 if interval is first else int(links.first[i + 1]))
        return links.rows()

    own, other = own.toDF(*own.columns), other.toDF(*other.columns)
    return own.groupBy(*key).cogroup(other.groupBy(*key)).applyInArrow(compare, MET_SCHEMA)


def near_vectors(vectors: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept."""
    eps = float(np.sqrt(max(0.0, 2 - 2 * min_cosine))) + 1e-9
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    classes = own.where(usable).groupBy("vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("class_id"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    bases = _bases(classes)
    intervals = stored(_intervals(_placed(classes, bases, eps), bases), "intervals")
    pairs = stored(_pairs(intervals, eps), "pairs")
    partners = pairs.groupBy("size", "a").agg(F.count("*").alias("partners"))
    met = stored(_met(intervals, pairs.join(partners, ["size", "a"]), bases, min_cosine, eps), "met")
    counts = met.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("linked"))
    parts = components(met.where("kind = 1").select("a", "b"))
    named = classes.select("node", "class_id").join(parts, "node").groupBy("component").agg(F.min("class_id").alias("least"))
    component = parts.join(named, "component").select("node", "least")
    found = classes.join(counts, "node", "left").join(component, "node", "left").select(
        "vector",
        (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("least", "class_id").alias("component"),
    )
    judged = own.where(usable).join(found, "vector").select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    rest = own.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return judged.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
