"""Columns added to rows in Arrow batches, all other columns passed on as they are."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from estate_hygiene.llm.blocks import arrow_schema
from estate_hygiene.llm.workspace import give_back

#: Rows worked on at a time: the values of a batch are held once more while they are.
ROWS = 1_000

DDL = {"long": "bigint", "int": "int", "boolean": "boolean", "double": "double", "string": "string", "array<long>": "array<bigint>", "binary": "binary"}


def annotated(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict[str, list]]], added: str) -> DataFrame:
    """``df`` with the columns named in ``added``; a column of ``df`` of the same name is replaced.

    ``make`` is called once in each task and gives the function that turns a batch into the new columns.
    """
    new = arrow_schema(added)
    kept = df.drop(*new.names)
    named = StructType.fromDDL(", ".join(f"{n} {DDL[k]}" for n, k in (c.split(" ") for c in added.split(", "))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for whole in batches:
            for at in range(0, max(whole.num_rows, 1), ROWS):
                batch = whole.slice(at, ROWS)
                work = work or make()
                columns = work(batch)
                arrays = [pa.array(columns[f.name], type=f.type) for f in new]
                yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *new.names])
        del work
        give_back()

    return kept.mapInArrow(run, StructType(kept.schema.fields + named.fields))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A text column's values as UTF-8; a null is empty."""
    return [x.as_py() or b"" for x in batch.column(name).cast(pa.binary())]
