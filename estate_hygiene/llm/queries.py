"""The registered queries of this subpackage and, where SQL can express them, their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estate_hygiene.llm import (
    collocations,
    decontamination,
    embedding_dedup,
    html_extraction,
    jaccard_join,
    line_dedup,
    mixing,
    packing,
    quality,
    substring_dedup,
    suffix_dedup,
    token_counts,
    vector_codes,
)

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.drop_repeated_words(_read(spark, sf_dir, "documents")).drop("kept_text")


def op2_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.packed_sequences(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.drop_repeated_bytes(_read(spark, sf_dir, "documents")).drop("kept_text")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.with_leaks(docs, _read(spark, sf_dir, "benchmark")).drop("text")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    network = quality.trained(docs, _read(spark, sf_dir, "labels"))
    found = quality.scored(docs, network).withColumn("held_out", quality.held_out())
    return found.select("doc_id", "held_out", "score", "predicted")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_read(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.with_token_counts(_read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(_read(spark, sf_dir, "embeddings"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_shared_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extraction.with_main_text(pages).select("page_id", "url", "text", "n_chars")


def op11_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(_read(spark, sf_dir, "documents")).drop("source")


def op12_collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top_phrases(_read(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.coded(_read(spark, sf_dir, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def queries() -> dict[str, Query]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_retrieval_packing": op2_retrieval_packing,
        "op3_suffix_array_dedup": op3_suffix_array_dedup,
        "op4_benchmark_decontamination": op4_benchmark_decontamination,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
        "op7_token_counts": op7_token_counts,
        "op8_embedding_near_dedup": op8_embedding_near_dedup,
        "op9_line_dedup": op9_line_dedup,
        "op10_html_extraction": op10_html_extraction,
        "op11_mixing_sources": op11_mixing_sources,
        "op12_collocation_mining": op12_collocation_mining,
        "op13_vector_codes": op13_vector_codes,
    }


OP1_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20
), seen AS (
  SELECT doc_id, i, min(doc_id * 100000000 + i) OVER (PARTITION BY array_to_string(w[i:i + 19], ' ')) AS first FROM starts
), gone AS (
  SELECT DISTINCT doc_id, i + k AS j FROM (SELECT doc_id, i FROM seen WHERE doc_id * 100000000 + i <> first), range(20) r(k)
), placed AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM words
)
SELECT w.doc_id, len(any_value(w.w))::BIGINT AS n_words, count(g.j)::BIGINT AS n_removed,
  sha256(coalesce(string_agg(p.word, ' ' ORDER BY p.j) FILTER (g.j IS NULL), '')) AS kept_sha256
FROM words w LEFT JOIN placed p USING (doc_id) LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.j = p.j GROUP BY w.doc_id
"""

OP6_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM words)
), sizes AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS met FROM shingles x JOIN shingles y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY ALL
  ) JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * met >= 80 * (p.n + q.n - met)
), reach AS (
  SELECT a AS node, a AS seen FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c.component, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT node, min(seen) AS component FROM reach GROUP BY node) c ON c.node = d.doc_id
"""

OP8_SQL = r"""
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) END >= 0.95
), reach AS (
  SELECT a AS node, a AS seen FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen
), found AS (
  SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component, e.vec_id) AS component_id
  FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON a = e.vec_id
  LEFT JOIN (SELECT node, min(seen) AS component FROM reach GROUP BY node) c ON c.node = e.vec_id
)
SELECT *, coalesce(vec_id = component_id, false) AS kept FROM found
"""

OP9_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place FROM documents
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), held AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT k.doc_id, place, line, coalesce(first <> k.doc_id, false) AS gone FROM keyed k LEFT JOIN held USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


OP11_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS s, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM docs GROUP BY source
), filling AS (
  SELECT *, sum(s) OVER () - coalesce(3 * sum(s) OVER (ORDER BY s * 10 // w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free,
    sum(w) OVER (ORDER BY s * 10 // w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights, s * 10 // w AS turn FROM sources
), level AS (
  SELECT free, weights FROM filling WHERE free * w <= 3 * s * weights ORDER BY turn, source LIMIT 1
), targets AS (
  SELECT source, s, CASE WHEN 3 * s * level.weights < level.free * w THEN (3 * s)::DOUBLE ELSE (level.free * w)::DOUBLE / level.weights::DOUBLE END AS target,
    CASE WHEN 3 * s * level.weights < level.free * w THEN 3 * s ELSE level.free * w // level.weights END AS take
  FROM filling, level
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, 'null')) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM docs
)
SELECT doc_id, size, s AS source_size, target,
  (CASE WHEN size = 0 THEN 0 ELSE (take // s) * size + greatest(0, least(size, take % s - start)) END)::BIGINT AS taken
FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
"""

OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM (
    SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)
), totals AS (
  SELECT lang, sum(len(w))::HUGEINT AS n FROM pieces GROUP BY lang
), grams AS MATERIALIZED (
  SELECT lang, m, g, count(*)::HUGEINT AS f FROM (
    SELECT lang, m, w[i:i + m - 1] AS g FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, range(1, 6) r(m) WHERE len(w) >= m)
  ) GROUP BY ALL HAVING count(*) >= 100
), longer AS (
  SELECT lang, g, max(f) AS f FROM (
    SELECT lang, g[1:m - 1] AS g, f FROM grams WHERE m > 2 UNION ALL SELECT lang, g[2:m] AS g, f FROM grams WHERE m > 2) GROUP BY ALL
), cuts AS (
  SELECT lang, g, f AS a, k, g[1:k] AS head, g[k + 1:m] AS rest FROM (SELECT *, unnest(range(1, m)) AS k FROM grams WHERE m > 1)
), scored AS (
  SELECT c.lang, c.g, a, k, x.f AS l, y.f AS r, n, 1000 * a * n // (x.f * y.f) AS score FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN grams x ON x.lang = c.lang AND x.g = head JOIN grams y ON y.lang = c.lang AND y.g = rest
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), kept AS (
  SELECT s.*, array_to_string(s.g, ' ') AS phrase FROM lowest s LEFT JOIN longer o ON o.lang = s.lang AND o.g = s.g WHERE o.f IS NULL OR o.f < a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
  n::BIGINT AS n, score::BIGINT AS score FROM kept QUALIFY rank <= 2000
"""

_OP13_ROUND = """
, a{0} AS MATERIALIZED (
  SELECT p.vec_id, p.part, p.v, arg_min(b.entry, {{'d': d, 'e': b.entry}}) AS entry, min(d) AS d FROM (
    SELECT p.vec_id, p.part, p.v, b.entry, list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - b.v[i]) * (p.v[i] - b.v[i])))::BIGINT AS d
    FROM parts p JOIN book{0} b ON b.part = p.part) b JOIN parts p ON p.vec_id = b.vec_id AND p.part = b.part GROUP BY ALL
)"""
_OP13_UPDATE = """
, means{0} AS (
  SELECT part, entry, list(mean ORDER BY i) AS v FROM (
    SELECT part, entry, i, floor(sum(v[i]) / count(*))::BIGINT AS mean FROM (SELECT part, entry, v, unnest(range(1, len(v) + 1)) AS i FROM a{0}) GROUP BY ALL
  ) GROUP BY ALL
), book{1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{0} b LEFT JOIN means{0} m USING (part, entry)
)"""

OP13_SQL = (
    """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, part, v[part * len(v) // 16 + 1:(part + 1) * len(v) // 16] AS v FROM kept, range(16) r(part)
), book0 AS (
  SELECT part, entry, v FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept) USING (vec_id) WHERE entry < 64
)"""
    + _OP13_ROUND.format(0) + _OP13_UPDATE.format(0, 1)
    + _OP13_ROUND.format(1) + _OP13_UPDATE.format(1, 2)
    + _OP13_ROUND.format(2)
    + """
, errors AS (
  SELECT vec_id, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY vec_id
), digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM errors JOIN kept USING (vec_id), digest
"""
)


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": OP1_SQL,
        "op6_ngram_jaccard_join": OP6_SQL,
        "op8_embedding_near_dedup": OP8_SQL,
        "op9_line_dedup": OP9_SQL,
        "op11_mixing_sources": OP11_SQL,
        "op12_collocation_mining": OP12_SQL,
        "op13_vector_codes": OP13_SQL,
    }
