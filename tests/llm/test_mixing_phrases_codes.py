"""Mixing, collocations and vector codes against plain versions."""

import hashlib
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import DOCS, blanks, corpus

from estate_hygiene.llm import collocations, mixing, vector_codes


def sourced(spark, rows, extra=""):
    return spark.createDataFrame([(i, t, lang, s, None, *more) for i, t, lang, s, *more in rows], DOCS + extra).repartition(3)


def plain_mix(rows, weights=(5, 2, 1), most=3):
    """doc_id, size, source_size, target and taken, for distinct ids."""
    size = {i: len(blanks(t)) for i, t, *_ in rows}
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    held = {s: [r for r in rows if r[3] == s] for s in names}
    total = {s: sum(size[r[0]] for r in held[s]) for s in names}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    words, full = sum(total.values()), set()
    while True:
        left = Fraction(words - sum(most * total[s] for s in full))
        free = sum(weight[s] for s in names if s not in full) or 1
        target = {s: Fraction(most * total[s]) if s in full else left * weight[s] / free for s in names}
        over = {s for s in names if target[s] > most * total[s]}
        if not over:
            break
        full |= over
    out = []
    for s in names:
        start, take = 0, int(target[s])
        for i, *_ in sorted(held[s], key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest()):
            rounds, rest = divmod(take, total[s]) if total[s] else (0, 0)
            out.append((i, size[i], total[s], float(target[s]), rounds * size[i] + max(0, min(size[i], rest - start))))
            start += size[i]
    return sorted(out)


@pytest.mark.parametrize("seed", [0, 1])
def test_mix_takes_the_targets(spark, seed):
    rng = np.random.default_rng(seed)
    texts = corpus(seed, 80)
    names = [None, "", "a", "b", "é", "Z", "tiny"]
    rows = [(i, t, "en", names[int(rng.integers(0, 6))]) for i, t in enumerate(texts)]
    rows += [(900, None, "en", "a"), (901, "", "en", "empty"), (902, "one", "en", "tiny"), (903, "w " * 9_000, "en", "b")]
    got = mixing.taken_words(sourced(spark, [(*r, "x") for r in rows], ", size string"), block_words=64).drop("source")
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    want = plain_mix(rows)
    found = sorted(tuple(r) for r in got.collect())
    assert [r[:3] + r[4:] for r in found] == [r[:3] + r[4:] for r in want]
    assert np.allclose([r[3] for r in found], [r[3] for r in want], rtol=1e-12)
    assert all(t <= 3 * s for _, s, _, _, t in found)


def test_slots_are_a_low_discrepancy_schedule(spark):
    rows = [(i, "w " * 500, "en", "abc"[i % 3]) for i in range(60)]
    sources, placed = mixing.streams(sourced(spark, rows))
    slots = sorted(tuple(r) for r in mixing.schedule(sources, 100).select("slot", "place", "block_start", "block_end").collect())
    share = {r.place: r.take for r in sources.collect()}
    assert [s[0] for s in slots] == list(range(512)) and sum(share.values()) >= 30_000 - 3
    for place, take in share.items():
        blocks = [(a, b) for _, p, a, b in slots if p == place]
        assert blocks[0][0] == 0 and blocks[-1][1] == take and all(x[1] == y[0] for x, y in zip(blocks, blocks[1:]))
        for n in (16, 64, 200, 512):  # any beginning of the mix holds nearly its share
            assert abs(sum(p == place for _, p, *_ in slots[:n]) - n * take / 30_000) < 6
    mix = mixing.pieces(sources, placed, 100)
    assert mix.agg({"length": "sum"}).first()[0] == sum(share.values())
    assert mix.where("start < 0 or start + length > 500 or length < 1").count() == 0


def test_mixing_odd_tables(spark):
    assert mixing.taken_words(sourced(spark, [])).count() == 0
    assert mixing.taken_words(sourced(spark, [(1, None, "en", None)])).collect()[0]["taken"] == 0
    twins = mixing.taken_words(sourced(spark, [(None, "a b", "en", "s"), (5, "a b c", "en", "s"), (5, "a b c", "en", "s"), (5, "x", "en", "s")]))
    rows = twins.collect()
    assert sum(r["taken"] for r in rows) == 9 and len(rows) == 4 and {r["source_size"] for r in rows} == {9}


def plain_phrases(rows, least, top):
    f, n = Counter(), Counter()
    for _, t, lang, _ in rows:
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", (t or "").encode()):
            w = [x for x in re.split(rb"[\x20\x09]+", bytes(c + 32 if 65 <= c <= 90 else c for c in piece)) if x]
            n[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i : i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    frequent = {g: c for g, c in f.items() if c >= least}
    inner = {(lang, part) for (lang, g), c in frequent.items() for part in (g[1:], g[:-1]) if frequent.get((lang, part)) == c}
    out = []
    for lang in n:
        kept = []
        for (own, g), a in frequent.items():
            if own == lang and len(g) > 1 and (lang, g) not in inner:
                cuts = [(1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
                score, k = min(cuts)
                kept.append((-score, -a, b" ".join(g), f[lang, g[:k]], f[lang, g[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("bits,top", [(8, 2000), (20, 12)])
def test_phrases_against_plain_counts(spark, bits, top):
    rng = np.random.default_rng(bits)
    rows = [(i, t.replace(" w3 ", " W3, ").replace(" w5 ", "\t\t").replace(" w11", " É"), [None, "en", "de", "und"][int(rng.integers(0, 4))], "s") for i, t in enumerate(corpus(5, 90, 30))]
    rows += [(None, "a b a b a b\x0b", "en", None), (7, None, None, None), (8, "", "en", "s"), (9, "a b a b a b\x00c", "en", "s"), (9, " .,; ", "fr", "s")]
    got = collocations.top_phrases(sourced(spark, [(*r, "x") for r in rows], ", phrase string"), 4, top, bits)
    want = plain_phrases(rows, 4, top)
    assert len(want) > 30 and sorted(tuple(r) for r in got.collect()) == want


def test_no_phrases(spark):
    assert collocations.top_phrases(sourced(spark, [])).count() == 0
    assert collocations.top_phrases(sourced(spark, [(1, None, None, None)])).count() == 0


def test_scores_beyond_64_bits(spark):
    n, a, f = 9_000_000_000_000, 8_000_000_000_000, 8_500_000_000_001
    rows = [("en", "", 0, n), ("en", "x", 1, f), ("en", "y", 1, f + 2), ("en", "x y", 2, a)]
    [row] = collocations.candidates(spark.createDataFrame(rows, collocations.ARCS_SCHEMA)).collect()
    assert row["score"] == 1000 * a * n // (f * (f + 2)) and 1000 * a * n > 2**64


def test_chunks_of_a_long_text_count_every_phrase_once():
    rng = np.random.default_rng(1)
    text = b"".join(bytes([b"abcd"[rng.integers(0, 4)]]) * int(rng.integers(1, 4)) + [b" ", b"  ", b", ", b"\n"][int(rng.choice(4, p=[0.7, 0.1, 0.1, 0.1]))] for _ in range(3_000))

    def arcs(rows):
        full = np.ones(1 << 10, dtype=bool)
        out = Counter()
        for r in collocations.Transducer(collocations.Shard(rows), full, full, 10).arcs()[0].to_pylist():
            out[r["phrase"]] += r["weight"]
        return out

    cut = [("en", piece, own) for piece, own in collocations.chunks(text, 200)]
    assert len(cut) > 20 and arcs(cut) == arcs([("en", text, len(text))])
    assert [own for _, _, own in [("en", *c) for c in collocations.chunks(b"x" * 10_000, 200)]] == [10_000]


def test_union_of_shards_by_prefix_range():
    shards = [collocations.Shard([("en", t.encode(), 10**6)]) for t in corpus(3, 30, 20)]
    full = np.ones(1 << 10, dtype=bool)
    found = [collocations.Transducer(s, full, full, 10) for s in shards]
    whole = Counter()
    for t in found:
        for r in t.arcs()[0].to_pylist():
            whole[r["phrase"], r["words"]] += r["weight"]
    sent = pa.concat_batches([t.slices(5) for t in found])
    sent = sent.take(pa.array(np.argsort(sent.column(0).to_numpy(), kind="stable")))
    rows = [r for b in collocations.unions(iter([sent]), 3) for r in b.to_pylist()]
    assert {(r["phrase"], r["words"]): r["weight"] for r in rows} == {k: v for k, v in whole.items() if v >= 3 or not k[1]} and len(rows) > 100


def plain_codes(vectors, rounds=2, parts=16, entries=64):
    v = np.floor(np.array(vectors, dtype=np.float64) * 256).astype(np.int64).reshape(len(vectors), parts, -1)
    book = v[:entries].copy()
    for turn in range(rounds + 1):
        apart = ((v[:, None] - book[None]) ** 2).sum(axis=3)
        code = apart.argmin(axis=1)
        if turn < rounds:
            for p in range(parts):
                for e in range(len(book)):
                    if (code[:, p] == e).any():
                        book[e, p] = v[code[:, p] == e, p].sum(axis=0) // (code[:, p] == e).sum()
    sha = hashlib.sha256(",".join(str(x) for x in book.transpose(1, 0, 2).reshape(-1)).encode()).hexdigest()
    return ["".join(f"{c:02x}" for c in row) for row in code], apart.min(axis=1).sum(axis=1).tolist(), sha


VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("n,width", [(300, 64), (40, 16), (1, 32)])
def test_codes_against_plain_k_means(spark, n, width):
    rng = np.random.default_rng(n)
    vectors = np.round(rng.normal(size=(n, width)) * 4) / 16  # many ties
    vectors[n // 2 :: 7] = vectors[0]
    rows = [(i * 3, v.tolist(), None if i % 5 == 0 else i % 3) for i, v in enumerate(vectors.astype(np.float32))]
    odd = [(-1, None, 1), (-2, [None] + [0.0] * (width - 1), 1), (-3, [float("nan")] * width, 1), (-4, [float("inf")] * width, 2)]
    short = [(-5, [1.0] * 7, 1), (-6, [], 1)]
    df = spark.createDataFrame([(*r, "k") for r in rows + odd + short], VECTORS + ", code string").repartition(4)
    got = {r["vec_id"]: r for r in vector_codes.coded(df).collect()}
    code, error, sha = plain_codes(vectors)
    by_label = Counter()
    for (_, _, label), e in zip(rows, error, strict=True):
        by_label[label] += e
    assert got.keys() == {r[0] for r in rows + short}
    for (i, _, label), c, e in zip(rows, code, error, strict=True):
        assert (got[i]["code"], got[i]["error"], got[i]["label_error"], got[i]["codebooks_sha256"]) == (c, e, by_label[label], sha)
    assert got[-5]["code"] is None and got[-5]["error"] is None and got[-5]["label_error"] is None


def test_orchard_search_finds_the_least_index_of_the_nearest():
    rng = np.random.default_rng(3)
    for dims, spread in ((1, 4), (2, 3), (4, 40), (8, 2)):
        book = vector_codes.Codebook(rng.integers(-spread, spread + 1, (64, dims)))
        points = rng.integers(-spread - 2, spread + 3, (500, dims))
        apart = ((points[:, None] - book.entries[None]) ** 2).sum(axis=2)
        entry, distance = book.nearest(points)
        assert (entry == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def test_vectors_odd_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert vector_codes.coded(empty).count() == 0
    assert vector_codes.coded(spark.createDataFrame([(1, None, 1)], VECTORS)).count() == 0
    no_id = spark.createDataFrame([(None, [1.0] * 16, 1), (4, [2.0] * 16, 1), (4, [0.0] * 16, 1)], VECTORS)
    rows = vector_codes.coded(no_id).collect()
    assert len(rows) == 3 and {r["error"] for r in rows} == {0, 16 * 128**2} and len({r["label_error"] for r in rows}) == 1
    with pytest.raises(ValueError):
        vector_codes.whole(pa.array([[1e30] * 16]), 16)
