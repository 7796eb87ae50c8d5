"""Packing, decontamination, quality, token counts, vectors, pages and the pipeline, against plain versions."""

import json
import math
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import component, corpus, docs
from pyspark.sql import functions as F

import corpus_pipeline
from estate_hygiene.llm import decontamination, embedding_dedup, html_extraction, packing, quality, token_counts
from estate_hygiene.llm.queries import op2_retrieval_packing, op5_quality_classifier

SMALL = "/root/testdata/sf0.001"
ODD = [(None, "a b c"), (None, None), (900, None), (901, ""), (902, " \n\t "), (903, "é ü ß 日本 one"), (903, "é ü ß 日本 one"), (904, "word " * 5000), (905, "x" * 3000)]


# Packing


def test_packing_is_an_exact_round_trip(spark):
    rows = [(i, t) for i, t in enumerate(corpus(3))] + ODD
    found = packing.packed_sequences(docs(spark, rows)).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in rows)
    sequences, starts = defaultdict(list), defaultdict(list)
    for r in found:
        ids = np.frombuffer(bytes(r.ids), dtype="<u4")
        assert len(ids) == r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        starts[r.doc_id, r.doc_tokens, r.start].append(tuple(ids.tolist()))
    got = Counter()
    for (i, ids), n in want.items():
        at, whole = 0, []
        while at < len(ids):
            piece = next(p for p in starts[i, len(ids), at] if ids[at : at + len(p)] == p)
            starts[i, len(ids), at].remove(piece)
            whole += piece
            at += len(piece)
        got[i, tuple(whole)] += n
    assert got == want
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0


def test_neighbours_are_alike():
    rng = np.random.default_rng(0)
    topics = [rng.integers(1000 * k, 1000 * k + 60, (20, 50)).astype(np.uint32) for k in range(1, 6)]
    ids = [row for k in range(20) for row in (t[k] for t in topics)]
    held = np.zeros(6000, dtype=np.int64)
    for row in ids:
        held[np.unique(row)] += 1
    shard = packing.Shard(ids, np.log(1 + (len(ids) - held + 0.5) / (held + 0.5)), 50)
    order = list(shard.order())
    assert sorted(order) == list(range(100))
    assert sum(a % 5 == b % 5 for a, b in zip(order, order[1:], strict=False)) > 80


def test_documents_are_counted_without_sorting_their_tokens(spark, monkeypatch):
    rng = np.random.default_rng(11)
    ids = [rng.integers(1, 60 + 40 * k, int(rng.integers(1, 300))).astype(np.uint32) for k in range(30)]
    want = Counter(int(t) for x in ids for t in set(x.tolist()))
    tokens = spark.createDataFrame([(bytearray(packing.packed(x.tobytes())),) for x in ids], "ids binary").repartition(3)
    assert {t: n for t, n in enumerate(packing._document_counts(tokens).tolist()) if n} == want
    monkeypatch.setattr(np, "unique", None)
    total = np.zeros(0, dtype=np.int64)
    for x in ids:
        total = packing.counted(total, x)
    assert {t: n for t, n in enumerate(total.tolist()) if n} == want


def test_packing_checksums(spark):
    found = op2_retrieval_packing(spark, SMALL)
    assert [c for c, _ in found.dtypes] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert dict(found.dtypes)["ids_crc32"] == "bigint"
    ids = np.array([5, 70000, 1], dtype="<u4").tobytes()
    assert spark.createDataFrame([(ids,)], "x binary").select(F.crc32("x")).first()[0] == zlib.crc32(ids)


def test_packing_of_an_empty_table(spark):
    assert packing.packed_sequences(docs(spark, [])).collect() == []


# Decontamination


def plain_tiles(doc, item, least):
    """Greedy string tiling, all pairs of places."""
    free_doc, free_item, covered = [True] * len(doc), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for d in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n] and free_doc[d + n] and free_item[i + n]:
                    n += 1
                if n > best[0]:
                    best = (n, d, i)
        if best[0] < least:
            return covered
        n, d, i = best
        free_doc[d : d + n] = free_item[i : i + n] = [False] * n
        covered += n


def test_tiles_cover_as_much_as_plain_tiling():
    rng = np.random.default_rng(1)
    for _ in range(60):
        item = rng.integers(1, 30, int(rng.integers(6, 30)))
        doc = np.concatenate([rng.integers(1, 30, 8), item[8:], rng.integers(1, 30, 5), item[:8], rng.integers(1, 30, 3)])
        item, doc = item.astype(np.uint64), doc.astype(np.uint64)
        assert sum(n for _, _, n in decontamination.tiles(doc, item, 5)) == plain_tiles(doc.tolist(), item.tolist(), 5)


def test_seeds_do_not_depend_on_portions(monkeypatch):
    texts = ["a b c d e f g h", None, "", "x", " ".join(f"w{k % 11}" for k in range(50)), "y" * 5_000 + " z"]

    def found():
        counts = []
        seeds = {(int(k), w, int(h)) for owner, hashes, w in decontamination.seeds_of(texts, [1, 3, 5], counts) for k, h in zip(owner, hashes, strict=True)}
        return seeds, counts

    whole = found()
    assert whole[1] == [8, 0, 0, 1, 50, 2]
    assert [sum(k == doc for k, _, _ in whole[0]) for doc in range(6)] == [8 + 6 + 4, 0, 0, 1, 33, 2]
    for portion in (7, 20):
        monkeypatch.setattr(decontamination, "PORTION", portion)
        assert found() == whole


@pytest.mark.parametrize(("lot", "bits"), [(1_000_000, 26), (30, 15)])
def test_leaks(spark, monkeypatch, lot, bits):
    """Also in lots of one item each, with a small filter."""
    monkeypatch.setattr(decontamination, "LOT_BYTES", lot)
    monkeypatch.setattr(decontamination, "SIEVE_BITS", bits)
    items = [(k, " ".join(f"i{k}x{j}" for j in range(20))) for k in range(5)] + [(7, "only three words"), (8, None), (None, "one two three four five six"), (9, "")]
    w = items[0][1].split()
    rows = [
        (1, "before " + items[0][1].upper().replace(" ", ", ") + " after"),
        (2, " ".join([*w[10:], "between", *w[:10]])),
        (3, " ".join(w[:11])),
        (4, items[1][1] + " and " + items[2][1]),
        (5, "there are only three words here"),
        (6, "one two three four five six seven"),
        *ODD,
    ]
    frame = docs(spark, [(i, t, 5) for i, t in rows], ", coverage int")
    found = decontamination.with_leaks(frame, spark.createDataFrame(items, "item_id long, text string"))
    got = {r.doc_id: (r.item_ids, r.contaminated) for r in found.collect() if r.doc_id is not None}
    assert {i: got[i] for i in range(1, 7)} == {1: ([0], True), 2: ([0], True), 3: ([], False), 4: ([1, 2], True), 5: ([7], True), 6: ([], True)}
    assert not any(flag for i, (_, flag) in got.items() if i > 6)
    assert found.count() == len(rows)


def test_short_items_drop_no_document_of_the_pipeline(spark, tmp_path):
    items = [(1, "Paris"), (2, "it is a yes"), (3, "these five words leak here")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = docs(spark, [(1, "a week in Paris"), (2, "and so it is a yes"), (3, "now these five words leak here"), (4, "clean")])
    assert sorted(r.doc_id for r in corpus_pipeline.benchmark_filter(spark, frame, str(tmp_path)).collect()) == [1, 2, 4]
    found = decontamination.with_leaks(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id: r.item_ids for r in found.collect()} == {1: [1], 2: [2], 3: [3], 4: []}


def plain_leaks(text, items, least=5, share=0.6):
    """(coverage, words covered, ids that leak) of a text, each item tiled by itself."""
    doc, best, leaked = decontamination.words_of(text), (0.0, 0), []
    for item_id, words in ((i, decontamination.words_of(t)) for i, t in items):
        if words:
            n = plain_tiles(doc, words, min(least, len(words)))
            best = max(best, (n / len(words), n))
            if n / len(words) >= share and item_id is not None:
                leaked.append(item_id)
    return *best, sorted(leaked)


def test_leaks_against_plain_tiling_of_every_pair(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "LOT_BYTES", 150)
    rng = np.random.default_rng(4)
    common = "as has been said many times before"
    items = [(k, f"{common} " + " ".join(f"w{x}" for x in rng.integers(0, 60, int(rng.integers(3, 20))))) for k in range(30)] + [(30, "w1 w2"), (None, common)]
    texts = []
    for k in range(60):
        own = items[k % 30][1].split()
        cut = int(rng.integers(0, len(own)))
        texts.append(" ".join([*own[cut:], "then", *(own[:cut] if k % 3 else []), f"w{k % 4} w2", "x" * 2_000, common if k % 2 else ""]))
    found = decontamination.with_leaks(docs(spark, list(enumerate(texts))), spark.createDataFrame(items, "item_id long, text string"))
    got = {r.doc_id: (r.coverage, r.covered_words, r.item_ids) for r in found.collect()}
    assert got == {k: plain_leaks(t, items) for k, t in enumerate(texts)}


def test_leaks_of_many_items_meet_by_a_shuffle_in_one_pass(spark):
    """No step holds all items: with Spark's own size check switched off, nothing is broadcast but the filter's bits."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = spark.range(20_000).selectExpr("id AS item_id", "concat_ws(' ', transform(sequence(0, 19), i -> concat('i', id, 'x', i))) AS text")
        frame = docs(spark, [(k, " ".join(f"i{k * 700}x{j}" for j in range(3, 20))) for k in range(20)] + [(99, "nothing of any item")])
        found = decontamination.with_leaks(frame, items)
        assert "Broadcast" not in found._jdf.queryExecution().toString()
        assert "MapInArrow" not in found._jdf.queryExecution().toString()
        assert {r.doc_id: r.item_ids for r in found.collect()} == {k: [k * 700] for k in range(20)} | {99: []}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_leaks_keep_columns_of_any_name_and_read_very_long_texts(spark):
    extra = ", row int, maybe int, found int, found_row int, _before_coverage int, covered_words int"
    item = " ".join(f"item{j}" for j in range(12))
    long_text = "some words before it and " * 400_000 + item + " after" * 100_000
    frame = docs(spark, [(1, long_text, 1, 2, 3, 4, 5, 6), (2, "clean", 1, 2, 3, 4, 5, 6)], extra)
    found = decontamination.with_leaks(frame, spark.createDataFrame([(7, item)], "item_id long, text string"))
    rows = found.where("row = 1 AND maybe = 2 AND found = 3 AND found_row = 4 AND _before_coverage = 5").select("doc_id", "n_words", "covered_words", "item_ids")
    assert sorted(map(tuple, rows.collect())) == [(1, 2_100_012, 12, [7]), (2, 1, 0, [])]


def test_no_items_and_no_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.with_leaks(docs(spark, [(1, "a")]), none).first().contaminated is False
    assert decontamination.with_leaks(docs(spark, []), none).collect() == []


# Quality


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    found = op5_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(found) > 50
    right = np.mean([r.predicted == r.quality for r in found])
    assert right > 0.9
    assert all(0 <= r.score <= 1 and (r.score >= 0.3) == (r.predicted == 1) for r in found)


def test_chunks_cover_the_whole_text():
    text = bytes(range(1, 251)) * 7
    chunks = quality.cut(text)
    assert b"".join(c[: quality.CHUNK].tobytes() for c in chunks).rstrip(b"\0") == text
    assert all(c[quality.CHUNK :].tobytes() == d[: quality.WIDTH].tobytes() for c, d in zip(chunks, chunks[1:], strict=False))


def test_scores_do_not_depend_on_neighbours_in_a_batch():
    rng = np.random.default_rng(2)
    network = quality.Network(rng.normal(0, 1, (quality.WIDTH, 256, quality.FILTERS)).astype(np.float32), np.zeros(quality.FILTERS, np.float32), rng.normal(0, 1, quality.FILTERS), 0.1)
    texts = [b"", b"a", b"word " * 40_000, bytes(rng.integers(1, 256, 3_000).astype(np.uint8))]
    together = quality.features(texts, network, network.pairs())
    for i, t in enumerate(texts):
        np.testing.assert_allclose(together[i], quality.features([t], network, network.pairs())[0], rtol=1e-5)


def plain_features(text, network):
    """The convolution as it is defined: every filter at every byte of every chunk."""
    padded = text + bytes(quality.CHUNK + quality.WIDTH)
    pooled = []
    for start in range(0, max(len(text), 1), quality.CHUNK):
        places = [sum(network.taps[k][padded[p + k]] for k in range(quality.WIDTH)) + network.bias for p in range(start, start + quality.CHUNK)]
        pooled.append(np.maximum(np.max(places, axis=0), 0))
    return np.mean(pooled, axis=0)


def test_features_are_those_of_a_plain_convolution():
    rng = np.random.default_rng(4)
    network = quality.Network(rng.normal(0, 1, (quality.WIDTH, 256, quality.FILTERS)).astype(np.float32), rng.normal(0, 1, quality.FILTERS).astype(np.float32), rng.normal(0, 1, quality.FILTERS), 0.1)
    texts = [b"", b"abc", bytes(rng.integers(1, 256, 700).astype(np.uint8)), b"x" * 256]
    found = quality.features(texts, network, network.pairs())
    for i, t in enumerate(texts):
        np.testing.assert_allclose(found[i], plain_features(t, network), rtol=1e-4, atol=1e-4)


def test_a_pattern_answers_alike_wherever_it_stands():
    network = quality.Network(np.zeros((quality.WIDTH, 256, quality.FILTERS), np.float32), np.zeros(quality.FILTERS, np.float32), np.zeros(quality.FILTERS), 0.0)
    for k, c in enumerate(b"defect"):
        network.taps[k, c, 0] = 1
    texts = [b" " * n + b"defect" + b" " * 40 for n in range(10)] + [b" " * (n + 250) + b"defect" for n in range(8)]
    found = quality.features(texts, network, network.pairs())[:, 0]
    assert (found[:10] == 6).all() and (found[10:] >= 3).all()


def test_the_gradient_is_that_of_the_loss():
    """One step of fitting moves every parameter against its slope, measured by differences."""
    rng = np.random.default_rng(6)
    texts, labels = [bytes(rng.integers(97, 100, 300).astype(np.uint8)) for _ in range(6)], np.array([0.0, 1, 1, 0, 1, 0])
    made = lambda: quality.Network(rng2.normal(0, 0.3, (quality.WIDTH, 256, quality.FILTERS)).astype(np.float32), np.full(quality.FILTERS, 0.5, np.float32), rng2.normal(0, 0.5, quality.FILTERS), 0.2)
    rng2 = np.random.default_rng(8)
    before = made()
    rng2 = np.random.default_rng(8)
    after = made()
    moments = [np.zeros((2, *np.shape(p))) for p in (after.taps, after.bias, after.weights, after.offset)]
    quality._learn(after, [quality.cut(t) for t in texts], labels, moments, 1, 1e-3)

    def loss(network):
        p = network.probability(quality.features(texts, network, network.pairs()))
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p)) + quality.DECAY / 2 * np.sum(network.weights**2)

    for f in (0, 5, 31):
        for name in ("weights", "bias"):
            slopes = []
            for step in (-1e-2, 1e-2):
                kept = getattr(before, name).copy()
                getattr(before, name)[f] += step
                slopes.append(loss(before))
                setattr(before, name, kept)
            moved = getattr(after, name)[f] - getattr(before, name)[f]
            slope = (slopes[1] - slopes[0]) / 2e-2
            assert abs(slope) < 1e-4 or np.sign(moved) == -np.sign(slope)
    assert loss(after) < loss(before)


def test_the_sample_of_labelled_rows_is_bounded_in_bytes():
    rows = [{"doc_id": i, "quality": i % 2, "hash": i * 7 % 11, "size": 10 if i else 10_000} for i in range(11)]
    assert quality._sample(rows, 10**6) == set(range(11)) and quality._sample(rows, 100) == set(range(1, 11))
    few = quality._sample(rows, 40)
    assert len(few) == 4 and {i % 2 for i in few} == {0, 1}


def test_quality_without_labels(spark):
    labels = spark.createDataFrame([(None, 1), (3, None)], "doc_id long, quality int")
    network = quality.trained(docs(spark, [(3, "a")]), labels)
    frame = docs(spark, [(i, t, 1.5) for i, t in ODD], ", score double")
    found = quality.scored(frame, network).collect()
    assert {r.score for r in found} == {0.5} and len(found) == len(ODD)
    assert quality.scored(docs(spark, []), network).collect() == []


# Token counts


def plain_count(pieces, word):
    token = token_counts.MARK + word
    best = [(0, 0)] + [(-math.inf, 0)] * len(token)
    for end in range(1, len(token) + 1):
        c = token[end - 1]
        options = [(best[s][0] + (pieces.value[token[s:end]] + 1) // token_counts.SHIFT, best[s][1] - 1) for s in range(end) if token[s:end] in pieces.value]
        if c not in pieces.value:
            n = len(c.encode())
            options.append((best[end - 1][0] + pieces.fallback * n, best[end - 1][1] - n))
        best[end] = max(options)
    return -best[-1][1]


def test_token_counts(spark):
    pieces = token_counts.Pieces.load(token_counts.default_vocabulary())
    words = [w for t in corpus(5) for w in t.split()] + ["日本", "é", "antidisestablishmentarianism", "a", "aaaa\x1f", "😀😀"]
    assert pieces.counts(sorted(set(words))) == {w: plain_count(pieces, w) for w in words}
    rows = [(i, t, 7) for i, t in ODD]
    found = token_counts.with_token_counts(docs(spark, rows, ", n_tokens int")).collect()
    got = sorted((r.doc_id or -1, r.n_pretokens, r.n_tokens) for r in found)
    assert got == sorted((i or -1, len((t or "").split()), sum(plain_count(pieces, w) for w in (t or "").split())) for i, t, _ in rows)


# Vectors


@pytest.mark.parametrize("interval", [2_048, 16])
def test_vectors(spark, monkeypatch, interval):
    monkeypatch.setattr(embedding_dedup, "INTERVAL", interval)
    monkeypatch.setattr(embedding_dedup, "PIECE", 8)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(30, 12))
    x = centres[rng.integers(0, 30, 200)] + rng.normal(size=(200, 12)) * rng.choice([0.0, 0.1, 0.25], (200, 1))
    rows = [(i, [float(v) for v in np.float32(row)]) for i, row in enumerate(x)]
    rows += [(500, None), (501, []), (502, [0.0] * 12), (503, [float("nan")] * 12), (504, [None, 1.0]), (505, [1.0, 2.0]), (506, [2.0, 4.0]), (507, [float("inf")] * 12), (None, rows[0][1])]
    rows += [(1, rows[1][1])]
    found = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    usable = [k for k, (i, v) in enumerate(rows) if i is not None and v and all(a is not None and math.isfinite(a) for a in v) and any(v)]
    links = []
    for p in usable:
        for q in usable:
            if p < q and len(rows[p][1]) == len(rows[q][1]):
                a, b = (np.array(rows[k][1], dtype=np.float64) for k in (p, q))
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95:
                    links.append((p, q))
    roots = component(len(rows), links)
    degree = Counter(k for link in links for k in link)
    want = []
    for k, (i, _) in enumerate(rows):
        c = min((rows[m][0] for m in range(len(rows)) if roots[m] == roots[k] and rows[m][0] is not None), default=None) if k in usable else i
        want.append((str(i), degree[k], c, i is not None and i == c))
    assert sorted(map(str, want)) == sorted(str((str(r.vec_id), r.n_links, r.component_id, r.kept)) for r in found)


def test_no_vectors(spark):
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>")).collect() == []


# Pages


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a><li>News</ul></nav><div class="cookie-notice">We use cookies</div>
{body}<aside>More</aside><form>Search <button>Go</button></form><section id="comments"><p>Nice!</p></section>
<script>var t="</p>";</script><footer>&copy; All</footer></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_pages(spark):
    article = "<article><h1>Title &amp; more</h1><p><b>First\n  para<br>line<p>Second&nbsp;one &lt;3<div class='ad'>Buy</div><div class=reader-comments><p>me too</p></div><p>{0}</article>"
    plain = "<div><p>Read our site daily</p><p>Story {0}</p></div>"
    rows = [(i, f"https://a.example/{i}", PAGE.format(body=article.format(i))) for i in range(4)]
    rows += [(10 + i, f"http://B.example:80/{i}", PAGE.format(body=plain.format(i))) for i in range(4)]
    rows += [(20, None, None), (21, "x", ""), (None, "https://a.example/", "no markup & all"), (23, "https://c.example", "<p>a<!-- b --><script>c"), (0, rows[0][1], rows[0][2])]
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in html_extraction.with_main_text(pages(spark, rows)).collect())
    want = [(str(i), f"Title & more\nFirst para line\nSecond one <3\n{i}") for i in (0, 0, 1, 2, 3)]
    want += [(str(10 + i), f"Story {i}") for i in range(4)] + [("20", ""), ("21", ""), ("None", "no markup & all"), ("23", "a")]
    assert got == sorted((i, t, len(t)) for i, t in want)
    assert html_extraction.with_main_text(pages(spark, [])).collect() == []


def test_template_text_inside_articles(spark):
    own = "<html><body><main><p>Tell your friends</p><h1>Story {0}</h1><p>Text {0}</p><div><p>Read our letter</p></div></main></body></html>"
    copy = "<html><body><article><h1>One story</h1><p>Always this</p><p>Copy {0}</p></article></body></html>"
    version = "<html><body><article><h1>Edited {0}</h1><p>a</p><p>b</p><p>c</p><p>d</p></article></body></html>"
    hosts = {0: own, 10: copy, 20: version}
    rows = [(k + i, f"https://h{k}.example/{i}", html.format(i)) for k, html in hosts.items() for i in range(4)]
    got = {r.page_id: r.text for r in html_extraction.with_main_text(pages(spark, rows)).collect()}
    assert [got[i] for i in range(4)] == [f"Story {i}\nText {i}" for i in range(4)]
    assert [got[10 + i] for i in range(4)] == [f"One story\nAlways this\nCopy {i}" for i in range(4)]
    assert [got[20 + i] for i in range(4)] == [f"Edited {i}" for i in range(4)]


def test_what_no_page_keeps(spark):
    """Comments, adverts, notices and sidebars go on every page; shared legal lines go however many they are."""
    story = "<html><body><article><h1>Story {0}</h1><p>Text {0}</p>{1}</article></body></html>"
    comments = "<div class='comments'><p>Reader {0}</p></div>"
    rows = [(i, f"https://a.example/{i}", story.format(i, comments.format(i) if i < 2 else "")) for i in range(6)]
    one = "<div class='ad'>Buy</div><div class=cookie-notice>Cookies</div><div id=sidebar>Side</div><p don't>Hello it's me</p><p>a <math><mi>x</mi></math></p>"
    rows += [(10, "https://one.example/", story.format("one", one))]
    legal = "".join(f"<p>Legal {k}</p>" for k in range(4))
    rows += [(20 + i, f"https://legal.example/{i}", f"<article><h1>Title {i}</h1>{legal if i % 2 else legal[:28]}</article>") for i in range(4)]
    got = {r.page_id: r.text for r in html_extraction.with_main_text(pages(spark, rows)).collect()}
    assert [got[i] for i in range(6)] == [f"Story {i}\nText {i}" for i in range(6)]
    assert got[10] == "Story one\nText one\nHello it's me\na x"
    assert [got[20 + i].split("\n")[0] for i in range(4)] == [f"Title {i}" for i in range(4)] and all("Legal 0" not in got[20 + i] for i in range(4))


@pytest.mark.parametrize("part", ["<a href=\"x>", "<a href='x' title=\"y>text", "<div><p don't>", "<div>", "<", "<a b=", "<li><div>", "<!", "<script", "</", "<a =\"'>\"'"])
def test_markup_left_open_is_read_in_one_pass(part):
    source = part * (1_000_000 // len(part))
    start = time.perf_counter()
    for _ in html_extraction.markup(source):
        pass
    assert time.perf_counter() - start < 4
    start = time.perf_counter()
    html_extraction.Page(source[:200_000]).text(set())
    assert time.perf_counter() - start < 8


def test_quotes_and_tags():
    found = list(html_extraction.markup("<p title='a>b' x=\"c'd\">one</p ><P don't>it's<br/>a < b <3 <b class=x>y</b><img alt=\"open>end"))
    names = [(n, e) for n, e, _ in found if n]
    assert names == [("p", False), ("p", True), ("p", False), ("br", False), ("b", False), ("b", True), ("img", False)]
    assert "".join(t for n, _, t in found if not n) == "oneit'sa < b <3 yend"


def test_pages_with_columns_of_any_name(spark):
    df = pages(spark, [(1, "https://a.example", "<p>a</p>")]).selectExpr("*", "'k' host", "1 page", "2 template", "3 _template", "'x' text")
    [row] = html_extraction.with_main_text(df).collect()
    assert (row["host"], row["page"], row["template"], row["_template"], row["text"], row["n_chars"]) == ("k", 1, 2, 3, "a", 1)


@pytest.mark.parametrize(
    "html, kept",
    [
        ("<div class='content has-sidebar'><article><p>Story {0}</p></article></div>", "Story {0}"),
        ("<div class='no-sidebar'><p>Story {0}</p></div>", "Story {0}"),
        ("<div id=social><main><p>Story {0}</p></main></div>", "Story {0}"),
        ("<article class='post social'><p>Story {0}</p></article>", "Story {0}"),
        ("<div class=widget><p>Story {0}</p></div>", "Story {0}"),
        ("<article><p>Story {0}</p><section id=side-effects>Pain {0}</section><section id='related-work'>Others {0}</section></article>", "Story {0}\nPain {0}\nOthers {0}"),
        ("<article><p>Story {0}</p><div class=ad-slot>Buy {0}</div></article><div id=comments><article>Nice {0}</article></div>", "Story {0}"),
        ("<main><article><p>Story {0}</p><ul class=share-buttons><li>Tell {0}</ul></article></main>", "Story {0}"),
        ("<div><p>Story {0}</p></div><div class=related-posts>More {0}</div>", "Story {0}"),
    ],
)
def test_names_of_classes_leave_out_no_article(spark, html, kept):
    rows = [(i, f"https://a.example/{i}", f"<html><body>{html.format(i)}</body></html>") for i in range(3)]
    rows += [(3, "https://b.example", "<body><div><p>Story</p><div class=notice>of one page</div></div></body>")]
    got = {r.page_id: r.text for r in html_extraction.with_main_text(pages(spark, rows)).collect()}
    assert got == {i: kept.format(i) for i in range(3)} | {3: "Story"}


# Pipeline


def test_stages_keep_the_columns_and_the_clean_documents(spark, tmp_path):
    docs_ = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    now, counts = docs_, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, SMALL)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.dtypes == docs_.dtypes
        out.write.parquet(str(tmp_path / str(k)))
        now = spark.read.parquet(str(tmp_path / str(k)))
        counts[name] = {r.doc_id for r in now.select("doc_id").distinct().collect()}
    names = list(counts)
    good = {i for i, q in labels.items() if q == 1}
    assert len(good & counts[names[0]]) > 0.9 * len(good)
    assert all(counts[b] <= counts[a] for a, b in zip(names, names[1:], strict=False))
    assert counts[names[3]] == counts[names[4]]
    run = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in run.select("doc_id").distinct().collect()} == counts[names[4]]


def test_stages_bear_odd_rows(spark, tmp_path):
    spark.read.parquet(f"{SMALL}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs(spark, [(i, t) for i, t in enumerate(corpus(8))] + ODD).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert json.dumps(corpus_pipeline.ORACLE_SQL) == "null"
