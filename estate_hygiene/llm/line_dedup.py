"""Line dedup in Spark expressions only: lines that several documents hold stay in the first of them.

Lines are exploded with their position; of a line only a 128-bit digest of its key travels. Counting folds to the
smallest and largest document of each digest before the shuffle, so a line that a third of all documents hold is one
row for each task. The positions to drop are gathered for each document, at most as many as it has lines, and the text
is put together again from the others.

Rows: a null text is one empty line. A row without doc_id keeps all its lines and counts for no other. Rows that share a
doc_id are one document for the count; each is judged by its own text. Repeated rows are alike and stay alike. Columns
named kept_text, n_lines or n_dropped are replaced; all others stay, whatever they are called. An empty table gives none.
A very long text is one row: its lines travel as digests, and it is put together in one expression.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate_hygiene.functions.names import free_name
from estate_hygiene.llm.workspace import stored

MIN_POINTS = 10
MIN_DOCUMENTS = 2
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, ASCII letters in lower case."""
    return F.translate(F.trim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def drop_shared_lines(docs: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """Rows of ``docs`` (doc_id, text and any others, which stay) with kept_text, n_lines and n_dropped."""
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where(F.col("doc_id").isNotNull())
    lines = own.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    keyed = lines.select("doc_id", "text_hash", "place", line_key(F.col("line")).alias("key"))
    judged = stored(
        keyed.where(F.char_length("key") >= min_points).select(
            "doc_id", "text_hash", "place", F.unhex(F.md5("key")).alias("digest")
        ),
        "lines",
    )
    held = judged.groupBy("digest").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    # Stored, the shared lines come to the join by a shuffle of their own, which lets Spark split a common line's rows.
    shared = stored(held.where(F.col("first_doc") < F.col("last_doc")).select("digest", "first_doc"), "shared")
    dropped = (
        judged.join(shared, "digest")
        .where(F.col("doc_id") != F.col("first_doc"))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("place").alias("places"))
    )
    places_of, doc, hashed = (free_name(docs, n) for n in ("dropped_places", "dedup_doc", "dedup_text"))
    dropped = dropped.withColumnsRenamed({"places": places_of, "doc_id": doc, "text_hash": hashed})
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    met = (F.col("doc_id").cast("long") == F.col(doc)) & (F.xxhash64("text") == F.col(hashed))
    split = F.split(text, "\n", -1)
    places = F.sequence(F.lit(0), F.size(split) - 1)
    left = F.array_except(places, F.coalesce(places_of, F.array().cast("array<int>")))
    kept = F.array_join(F.transform(left, lambda i: F.get(split, i)), "\n")
    return (
        docs.join(dropped, met, "left")
        .withColumn("kept_text", F.when(F.col(places_of).isNull(), text).otherwise(kept))
        .withColumn("n_lines", F.size(split).cast("long"))
        .withColumn("n_dropped", F.coalesce(F.size(places_of), F.lit(0)).cast("long"))
        .drop(places_of, doc, hashed)
    )
