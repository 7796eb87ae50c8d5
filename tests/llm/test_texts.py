"""Substring, suffix and line dedup, and the Jaccard join, against plain versions."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import blanks, component, corpus, docs, sha

from estate_hygiene.llm import blocks, jaccard_join, line_dedup, substring_dedup, suffix_dedup
from estate_hygiene.llm.components import components

ODD = [(None, "a b c"), (None, None), (900, None), (901, ""), (902, " \n\t "), (903, "é ü ß 日本 one"), (903, "again"), (904, "word " * 3000), (905, "x" * 5000)]
EMPTY = []


def by_id(df, *columns):
    return sorted(tuple(r[c] for c in ("doc_id", *columns)) for r in df.where("doc_id is not null").collect())


def plain_substring(rows, window=20):
    first, out = {}, []
    for i, t in rows:
        w = blanks(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, (i, k)), (i, k))
    for i, t in rows:
        w = blanks(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (i, k):
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), sha(b" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out)


def plain_bytes(rows, length=400):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), dtype=bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, sha(bytes(np.frombuffer(t, np.uint8)[~gone]))))
    return sorted(out)


def shingles(text, n=5):
    w = [x.lower() for x in blanks(text)]
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def plain_jaccard(rows):
    sets = [shingles(t) for _, t in rows]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            met = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * met >= 80 * (len(sets[a]) + len(sets[b]) - met):
                links.append((a, b))
    named = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        named[i].append(k)
    links += [(own[0], k) for own in named.values() for k in own[1:]]
    roots = component(len(rows), links)
    least = {r: min(rows[k][0] for k in range(len(rows)) if roots[k] == r) for r in set(roots)}
    return sorted((i, len(sets[k]), least[roots[k]] if sets[k] else i) for k, (i, _) in enumerate(rows))


def plain_lines(rows):
    def key(line):
        stripped = line.strip(" \t\n\v\f\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in stripped)

    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                held[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held[key(x)]) < 2 or min(held[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out)


@pytest.fixture(params=[1, 2])
def rows(request):
    texts = corpus(request.param)
    return [(7 * i % 61, t) for i, t in enumerate(texts)]


def known(rows):
    return [r for r in rows if r[0] is not None]


def test_cover_meets_every_shift():
    cover, period = substring_dedup.COVER, substring_dedup.PERIOD
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_substring(spark, rows, monkeypatch):
    monkeypatch.setattr(blocks, "BUCKET_BYTES", 2_000)
    every = rows + ODD
    found = substring_dedup.drop_repeated_words(docs(spark, every))
    assert by_id(found, "n_words", "n_removed", "kept_sha256") == plain_substring(known(every))
    unknown = found.where("doc_id is null").collect()
    assert sorted((r.n_words, r.n_removed) for r in unknown) == [(0, 0), (3, 0)]


def test_substring_of_small_blocks(spark, rows):
    found = substring_dedup.drop_repeated_words(docs(spark, rows))
    kept = {r.doc_id: r.kept_text for r in found.collect()}
    assert all(sha(kept[i]) == s for i, _, _, s in plain_substring(rows))


@pytest.mark.parametrize(("most", "size"), [(2_048, 64_000_000), (3, 100_000)])
def test_suffixes(spark, rows, monkeypatch, most, size):
    """Also with fewer ranges than buckets are wanted, so that each is dealt to several."""
    monkeypatch.setattr(suffix_dedup, "MOST_RANGES", most)
    monkeypatch.setattr(blocks, "BUCKET_BYTES", size)
    every = rows + ODD + [(i + 100, t) for i, t in rows[:3]]
    found = suffix_dedup.drop_repeated_bytes(docs(spark, every))
    columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    got = sorted((r.doc_id if r.doc_id is not None else -1, *(r[c] for c in columns)) for r in found.collect())
    assert got == sorted((-1 if i is None else i, *more) for i, *more in plain_unknown(every))


def plain_unknown(rows):
    return [(None if i == -1 else i, *more) for i, *more in plain_bytes([(-1 if i is None else i, t) for i, t in rows])]


def test_equal_leads_share_a_bucket_and_splitters_are_few():
    rng = np.random.default_rng(2)
    lead = np.array([bytes(x) for x in rng.integers(97, 100, (400, 4)).astype(np.uint8)], dtype=f"S{suffix_dedup.LEAD}")
    hashes = np.array([hash(x) & 0xFFFFFFFF for x in lead], dtype=np.uint64)
    found = suffix_dedup.Buckets(np.unique(lead)[10:60:10], 7).of(lead, hashes)
    assert len(set(zip(lead, found, strict=True))) == len(set(lead))
    ranges = found // 7
    assert (np.diff(ranges[np.argsort(lead)]) >= 0).all() and set(ranges) == set(range(6))


@pytest.mark.parametrize("most", [300, 10**6])
def test_ranges_are_matched_in_parts(monkeypatch, most):
    """Every window of every row, with equal surroundings and equal windows in unlike ones, in small and in large parts."""
    rng = np.random.default_rng(7)
    monkeypatch.setattr(suffix_dedup, "MOST_WINDOWS", most)
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", most)
    lead = [rng.integers(0, 256, suffix_dedup.LEAD).astype(np.uint8) for _ in range(3)]
    around = [rng.integers(0, 2, 300).astype(np.uint8) for _ in range(4)]
    rows, windows = [], []
    for k in range(40):
        before, n = int(rng.integers(0, 299)), int(rng.integers(1, 30))
        n = min(n, before + 1)
        head, tail = around[k % 4][:before], np.concatenate(around)[k % 3 :][: 399 + n - before - suffix_dedup.LEAD]
        own = np.concatenate((head, lead[k % 3], tail))[: 399 + n]
        if k % 7 == 6:
            before, n, own, lead_of = *rows[-2][:3], windows[-2][0]
        else:
            lead_of = k % 3
        rows.append((before, n, own))
        windows.append((lead_of, [(lead_of, before - w, own[w : w + 400].tobytes()) for w in range(n)]))
    payload = []
    for part in (rows[:25], rows[25:]):
        head = np.array([[r[0] for r in part], [r[1] for r in part], [1] * len(part)], dtype=np.int32)
        payload.append(blocks.packed(np.int32(len(part)).tobytes() + head.tobytes() + b"".join(r[2].tobytes() for r in part)))
    group = pa.table({"bucket": pa.array([0, 0], pa.int32()), "block_id": pa.array([1, 2], pa.int64()), "keys": pa.array(payload, pa.binary())})
    found = {r["block_id"]: r["answer"] for r in suffix_dedup._matches(group).to_pylist()}
    seen = Counter(w for _, own in windows for w in own)
    for block, part in ((1, windows[:25]), (2, windows[25:])):
        want = [seen[w] > 1 for _, own in part for w in own]
        bits = np.unpackbits(np.frombuffer(found[block], dtype=np.uint8), count=len(want)).astype(bool) if block in found else np.zeros(len(want), bool)
        assert bits.tolist() == want
    assert any(c > 1 for c in seen.values()) and any(c == 1 for c in seen.values())


def test_multikey_classes_sort_as_bytes():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 3, (500, 21)).astype(np.uint8)
    keys[::5] = keys[0]
    found = suffix_dedup.multikey_classes(keys.ravel(), np.arange(500) * 21, 21)
    order = sorted(range(500), key=lambda i: bytes(keys[i]))
    assert [found[i] for i in order] == sorted(found)
    assert len(set(found)) == len({bytes(k) for k in keys})


def test_jaccard(spark, rows):
    found = jaccard_join.jaccard_components(docs(spark, rows + ODD))
    assert by_id(found, "n_shingles", "component_id") == plain_jaccard(known(rows + ODD))
    assert {r.component_id for r in found.where("doc_id is null").collect()} == {None}


def test_jaccard_of_rows_of_one_name(spark):
    one, two = "one text of some six words", "another text that shares nothing at all"
    rows = [(5, one), (7, one), (5, two), (3, two), (9, "a third text of nobody else here")]
    found = jaccard_join.jaccard_components(docs(spark, rows))
    assert by_id(found, "n_shingles", "component_id") == plain_jaccard(rows)
    assert {r.doc_id: r.component_id for r in found.collect()} == {3: 3, 5: 3, 7: 3, 9: 9}


def test_jaccard_of_a_neighbourhood_in_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PART", 6)
    monkeypatch.setattr(jaccard_join, "GROUP", 2)
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        own = list(base)
        for k in rng.integers(0, 60, int(rng.integers(0, 4))):
            own[k] = f"y{rng.integers(0, 9)}"
        rows.append((i, " ".join(own)))
    assert by_id(jaccard_join.jaccard_components(docs(spark, rows)), "n_shingles", "component_id") == plain_jaccard(rows)


def test_lines(spark, rows):
    every = rows + ODD
    frame = docs(spark, [(i, t, "mine") for i, t in every], ", n_lines string")
    found = line_dedup.drop_shared_lines(frame)
    got = sorted((r.doc_id, r.n_lines, r.n_dropped, sha(r.kept_text)) for r in found.collect() if r.doc_id is not None)
    assert got == plain_lines(known(every))
    assert {r.n_dropped for r in found.where("doc_id is null").collect()} == {0}


@pytest.mark.parametrize("operator", [substring_dedup.drop_repeated_words, suffix_dedup.drop_repeated_bytes, jaccard_join.jaccard_components, line_dedup.drop_shared_lines])
def test_empty_table(spark, operator):
    assert operator(docs(spark, EMPTY)).collect() == []


def test_line_dedup_keeps_columns_of_any_name(spark):
    frame = docs(spark, [(1, "a line that both have\nb", 1, 2, 3), (2, "a line that both have\nc", 1, 2, 3)], ", dropped_places int, dedup_doc int, _dedup_doc int")
    found = line_dedup.drop_shared_lines(frame).where("dropped_places = 1 AND dedup_doc = 2 AND _dedup_doc = 3")
    assert {r.doc_id: (r.kept_text, r.n_dropped) for r in found.collect()} == {1: ("a line that both have\nb", 0), 2: ("c", 1)}


def test_line_dedup_is_native(spark):
    plan = line_dedup.drop_shared_lines(docs(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_components(spark):
    rng = np.random.default_rng(6)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 200, (130, 2))] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    roots = component(341, links)
    assert found == {i: roots[i] for a, b in links if a != b for i in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(9)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 2**63, int(rng.integers(1, 300))).astype(np.uint64)
        for _ in range(int(rng.integers(1, 4))):
            own = base[rng.random(len(base)) > 0.08]
            sets.append(np.unique(np.concatenate((own, rng.integers(0, 2**63, len(base) // 20).astype(np.uint64)))))
    found = jaccard_join.can_link([jaccard_join.bitmap(x) for x in sets], np.array([len(x) for x in sets]))
    for i, a in enumerate(sets):
        for b in sets[:i]:
            met = len(np.intersect1d(a, b))
            if len(a) and len(b) and 100 * met >= 80 * (len(a) + len(b) - met):
                assert found[i]
    assert not found.all()
