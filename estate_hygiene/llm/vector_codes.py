"""Compression of vectors to one byte for each of PARTS parts, with codebooks whose nearest entries Orchard's search finds.

Vectors become whole numbers, floor(SCALE * x), and are cut into PARTS equal parts. The codebook of a part starts with that
part of the vectors of the ENTRIES smallest vec_ids; in each of ROUNDS rounds every part goes to the nearest entry, ties to
the lower index, and an entry becomes the floor of the mean of its parts, or stays where it has none. Then every part is
coded with the last codebooks.

Search. For every entry a codebook holds the list of all entries by their distance from it. A part starts at an entry
and goes through that entry's list; whenever an entry is nearer, or as near and of lower index, the search jumps to the list
of that one. Entries seen before are marked and not measured again. It stops where the list goes beyond twice the distance of
the entry it has: by the triangle inequality no entry further on can be as near. All parts of a batch take their next
step together. A batch starts at the entry nearest to its mean.

Load. A task sends on one row of sums for each entry in use, PARTS * ENTRIES at most, whatever it has read; codebooks, of
a fixed size, are all that comes to the driver. Vectors are read again in every round. Errors of a label are summed
before the shuffle and joined back by Spark, which splits a label that a third of all rows have.

Rows: a row whose vector is null or holds null or non-finite components is dropped. The width is that of the vector of
the smallest vec_id whose length is a positive multiple of PARTS; kept rows of another length take no part and get a null
code, error and no share in label_error. Rows without vec_id are coded but start no codebook. Rows that share a vec_id are
vectors of their own; those of equal vec_id start codebooks in the order of their components. With fewer than ENTRIES
vectors the codebooks have as many entries. An empty table gives no rows. A component beyond MOST after scaling is an error,
since errors would not fit a long. Other columns are passed on; one that is named as a new one is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from estate_hygiene.functions.names import free_name
from estate_hygiene.llm.workspace import stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
MOST = 2**26
STEP_ROWS = 1 << 16
SUMS = "part int, entry int, place int, total long, members long"


def whole(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have ``width`` components, and those as whole numbers."""
    column = column.cast(pa.list_(pa.float64()))
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    fit = lengths == width
    values = column.filter(pa.array(fit)).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    scaled = np.floor(values * SCALE)
    if scaled.size and np.abs(scaled).max() > MOST:
        raise ValueError(f"a component is beyond {MOST} / {SCALE}")
    return fit, scaled.astype(np.int64)


class Codebook:
    """The entries of one part, with every entry's list of all entries by distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, axis=1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each point's nearest entry, by Orchard's search."""
        n, k = len(points), len(self.entries)
        start = int(((self.entries - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
        best = np.full(n, start)
        least = ((points - self.entries[start]) ** 2).sum(axis=1)
        seen = np.zeros((n, k), dtype=bool)
        seen[:, start] = True
        going, step = np.arange(n), np.zeros(n, dtype=np.int64)
        while len(going):
            at = best[going], step[going]
            near = self.apart[at] <= 4 * least[going]
            going, entry = going[near], self.order[at][near]
            new = ~seen[going, entry]
            tried, entry = going[new], entry[new]
            seen[tried, entry] = True
            distance = ((points[tried] - self.entries[entry]) ** 2).sum(axis=1)
            better = (distance < least[tried]) | ((distance == least[tried]) & (entry < best[tried]))
            moved = tried[better]
            best[moved], least[moved] = entry[better], distance[better]
            step[going] += 1
            step[moved] = 0
            going = going[step[going] < k]
        return best, least


def _nearest(books: list[Codebook], vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For every part: its number, its components, the entries found and their squared distances."""
    width = vectors.shape[1] // PARTS
    for part, book in enumerate(books):
        points = np.ascontiguousarray(vectors[:, part * width : (part + 1) * width])
        yield part, points, *book.nearest(points)


def finite(rows: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Rows whose vector can be coded."""
    odd = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return rows.where(F.col(vector_col).isNotNull() & ~odd)


def first_books(rows: DataFrame, id_col: str, vector_col: str) -> np.ndarray:
    """ENTRIES vectors at most, as whole numbers: the start of all codebooks."""
    fit = rows.where(F.col(id_col).isNotNull() & (F.size(vector_col) > 0) & (F.size(vector_col) % PARTS == 0))
    fit = fit.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    first = fit.orderBy("id", "vector").select(F.size("vector").alias("width")).limit(1).collect()
    if not first:
        return np.zeros((0, PARTS), dtype=np.int64)
    width = first[0]["width"]
    chosen = fit.where(F.size("vector") == width).orderBy("id", "vector").limit(ENTRIES).select("vector").collect()
    return whole(pa.array([r["vector"] for r in chosen], type=pa.list_(pa.float64())), width)[1]


def _books(entries: np.ndarray) -> list[Codebook]:
    width = entries.shape[1] // PARTS
    return [Codebook(entries[:, p * width : (p + 1) * width]) for p in range(PARTS)]


def sums(rows: DataFrame, vector_col: str, entries: np.ndarray) -> DataFrame:
    """What each task adds to the entries: SUMS rows."""
    n, width = entries.shape
    part_width = width // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = _books(entries)
        total = np.zeros((PARTS, n, part_width), dtype=np.int64)
        members = np.zeros((PARTS, n), dtype=np.int64)
        for batch in batches:
            _, vectors = whole(batch.column(0), width)
            if not len(vectors):
                continue
            for part, points, entry, _ in _nearest(books, vectors):
                members[part] += np.bincount(entry, minlength=n)
                np.add.at(total[part], entry, points)
        part, entry = np.nonzero(members)
        yield pa.RecordBatch.from_pydict({
            "part": np.repeat(part, part_width).astype(np.int32), "entry": np.repeat(entry, part_width).astype(np.int32),
            "place": np.tile(np.arange(part_width, dtype=np.int32), len(part)), "total": total[part, entry].reshape(-1),
            "members": np.repeat(members[part, entry], part_width),
        })

    return rows.select(vector_col).mapInArrow(run, SUMS)


def refined(rows: DataFrame, vector_col: str, entries: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""
    part_width = entries.shape[1] // PARTS
    found = sums(rows, vector_col, entries).groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("members").alias("members"))
    out = entries.copy()
    for r in found.collect():
        out[r["entry"], r["part"] * part_width + r["place"]] = r["total"] // r["members"]
    return out


def digest(entries: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position."""
    by_part = entries.reshape(len(entries), PARTS, entries.shape[1] // PARTS).transpose(1, 0, 2)
    return hashlib.sha256(",".join(map(str, by_part.reshape(-1).tolist())).encode()).hexdigest()


def trained(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks as rows of entries, all parts side by side."""
    entries = first_books(rows, id_col, vector_col)
    for _ in range(rounds if len(entries) else 0):
        entries = refined(rows, vector_col, entries)
    return entries


def with_codes(rows: DataFrame, entries: np.ndarray, vector_col: str = "embedding") -> DataFrame:
    """``rows`` with code and error."""
    kept = rows.drop("code", "error")
    at = kept.columns.index(vector_col)
    schema = StructType(kept.schema.fields + [StructField("code", StringType()), StructField("error", LongType())])
    width = entries.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = _books(entries) if len(entries) else []
        for batch in batches:
            fit, vectors = whole(batch.column(at), width)
            fit &= bool(books)
            code, error = np.full(len(fit), None, dtype=object), np.full(len(fit), None, dtype=object)
            if fit.any():
                found = np.zeros((len(vectors), PARTS), dtype=np.uint8)
                total = np.zeros(len(vectors), dtype=np.int64)
                for part, _, entry, distance in _nearest(books, vectors):
                    found[:, part] = entry
                    total += distance
                code[fit], error[fit] = [row.tobytes().hex() for row in found], total.tolist()
            arrays = [*batch.columns, pa.array(code, type=pa.string()), pa.array(error, type=pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "code", "error"])

    return kept.mapInArrow(run, schema)


def coded(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """The kept rows with code, error, label_error and codebooks_sha256."""
    kept = finite(rows, vector_col)
    entries = trained(kept, id_col, vector_col, rounds)
    found = stored(with_codes(kept.drop("label_error", "codebooks_sha256"), entries, vector_col).drop(vector_col), "codes")
    same, total = free_name(found, "same_label"), free_name(found, "total_error")
    by_label = found.groupBy(F.col(label_col).alias(same)).agg(F.sum("error").alias(total))
    joined = found.join(by_label, F.col(label_col).eqNullSafe(F.col(same)))
    label_error = F.when(F.col("code").isNotNull(), F.col(total))
    return joined.select(*found.columns, label_error.alias("label_error"), F.lit(digest(entries)).alias("codebooks_sha256"))
