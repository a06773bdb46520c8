"""SimHash groups and exact substring removal against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from tessera.llm import simhash, suffix_dedup


def brute_fingerprint(text, shingle=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    grams = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    u = sorted(set(prints))
    root = {f: f for f in u}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(u):
        for b in u[i + 1 :]:
            if bin(a ^ b).count("1") <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(f) for f in prints]


def test_fingerprint_matches_brute_force(edge_rows):
    for row in edge_rows:
        assert simhash.fingerprint((row[1] or "").encode()) == brute_fingerprint(row[1])


def test_near_duplicates(edge, edge_rows):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id or -1) for r in simhash.near_duplicates(edge).collect())
    prints = [brute_fingerprint(r[1]) for r in edge_rows]
    roots = brute_components(prints)
    least = {}
    for row, root in zip(edge_rows, roots):
        if row[0] is not None:
            least[root] = min(least.get(root, row[0]), row[0])
    want = sorted((r[0] is None, r[0] or 0, f"{p:016x}", least.get(c, -1)) for r, p, c in zip(edge_rows, prints, roots))
    assert got == want


def test_links_join_what_lies_within_the_radius(spark):
    rng = random.Random(2)
    prints = []
    for _ in range(60):
        f = rng.getrandbits(64)
        prints.append(f)
        for _ in range(rng.randint(0, 6)):  # chains of small steps, and steps just too far
            f ^= sum(1 << b for b in rng.sample(range(64), rng.choice((1, 2, 3, 4, 5, 6))))
            prints.append(f)
    prints += [0, 15, 31 << 40, (1 << 64) - 1]
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in prints], "fp long")
    want = brute_components(prints)
    for options in ({}, {"prefix_bits": 4, "most_variants": 3000}):
        pairs = [(r.node % (1 << 64), r.root % (1 << 64)) for r in simhash.components(simhash.links(df, **options)).collect()]
        root = dict(pairs)
        groups = {frozenset(f for f in set(prints) if root.get(f, f) == r) for r in {root.get(f, f) for f in prints}}
        brute = {frozenset(f for f, c in zip(prints, want) if c == r) for r in set(want)}
        assert groups == brute


def test_crowded_prefixes_are_made_longer(spark):
    rng = random.Random(4)
    family = {0xF0F0F0F0F0F0F0F0 ^ sum(1 << b for b in rng.sample(range(30), rng.choice((1, 2, 3)))) for _ in range(500)}
    prints = sorted(family | {rng.getrandbits(64) for _ in range(30)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in prints], "fp long")
    groups = simhash.prefix_groups(df, 10, 2, 60).groupBy("bits", "prefix").count().collect()
    assert len({r.bits for r in groups}) > 2 and max(r["count"] for r in groups if r.bits < 64) <= 60
    pairs = [(r.node % (1 << 64), r.root % (1 << 64)) for r in simhash.components(simhash.links(df, group_rows=60, most_variants=3000)).collect()]
    root, want = dict(pairs), brute_components(prints)
    got = {frozenset(f for f in prints if root.get(f, f) == r) for r in {root.get(f, f) for f in prints}}
    assert got == {frozenset(f for f, c in zip(prints, want) if c == r) for r in set(want)}


def test_groups_stay_bounded_as_fingerprints_grow():
    for n in (0, 10**3, 10**6, 10**9, 3 * 10**10):
        bits = simhash.prefix_bits_for(n, 2)
        assert bits >= 10 and n * (1 + bits + bits * (bits - 1) // 2) <= 10**6 << bits


def test_one_of_each_keeps_the_least(edge, edge_rows):
    kept = simhash.one_of_each(edge)
    assert kept.schema == edge.schema
    rows = [tuple(r) for r in kept.collect()]
    roots = brute_components([brute_fingerprint(r[1]) for r in edge_rows])
    assert len(rows) == len(set(roots))
    least = sorted(min((r for r, c in zip(edge_rows, roots) if c == root), key=lambda r: (r[0] is None, r[0] or 0, brute_fingerprint(r[1])))[0] or -1 for root in set(roots))
    assert sorted(r[0] or -1 for r in rows) == least


def brute_removal(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(x[i : i + length] for x in raw for i in range(len(x) - length + 1))
    out = []
    for x in raw:
        mark = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        kept = bytes(b for b, m in zip(x, mark) if not m)
        spans = len(bytes(mark).replace(b"\0", b" ").split())
        out.append((len(x), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return out


def removal(df, length):
    return sorted((r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in suffix_dedup.with_kept(df, length).collect())


@pytest.mark.parametrize("length", [200, 61])
def test_removal_on_edge_rows(edge, edge_rows, length):
    assert removal(edge, length) == sorted(brute_removal([r[1] for r in edge_rows], length))


def test_removal_on_planted_repeats(spark):
    rng = random.Random(5)
    letters = lambda n, al="abcdefgh": "".join(rng.choice(al) for _ in range(n))
    passages = [letters(n) for n in (61, 62, 100, 300)] + ["ab" * 60, "é" * 40]
    texts = [letters(rng.randint(0, 150)) + "".join(rng.choice(passages) + letters(rng.randint(0, 40)) for _ in range(rng.randint(0, 3))) for _ in range(80)]
    texts += [passages[0][:60], passages[1][1:] + "q", "z" * 500, letters(100) + passages[3][:60] + "-" + passages[3][:60]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    assert removal(df, 61) == sorted(brute_removal(texts, 61))


@pytest.mark.parametrize("crowd", [1, 5])
def test_removal_with_crowded_anchors(spark, edge, edge_rows, crowd, monkeypatch):
    rng = random.Random(6)
    letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    line, other = letters(150), letters(90)
    texts = [letters(rng.randint(0, 90)) + line + letters(rng.randint(0, 90)) + (other + "=" if i % 3 else "") for i in range(60)]
    texts += [line, "x" * 400, texts[0], texts[1] + "!"] + [r[1] for r in edge_rows]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    fullest, merged = [], suffix_dedup.repeated_intervals

    def watched(units, length):
        fullest.append(units.groupBy("key").agg({"*": "count"}).agg({"count(1)": "max"}).first()[0] or 0)
        return merged(units, length)

    monkeypatch.setattr(suffix_dedup, "repeated_intervals", watched)
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in suffix_dedup.with_kept(df, 61, crowd=crowd).collect())
    assert got == sorted(brute_removal(texts, 61))
    assert fullest and max(fullest) <= crowd


def test_merged_order_is_the_sorted_order():
    rng = np.random.default_rng(3)
    rows = rng.integers(97, 100, (300, 24), dtype=np.uint8)
    shards = [suffix_dedup.ShardTransform(np.ascontiguousarray(rows[i : i + 70].T)) for i in range(0, 300, 70)]
    for c, order in suffix_dedup.merged_orders(shards):
        tails = [rows[i, c:].tobytes() for i in order]
        assert tails == sorted(tails)


def test_long_texts_come_in_pieces(monkeypatch):
    rng = random.Random(1)
    raw = [("".join(rng.choice("abc ") for _ in range(3000))).encode(), b"short", b"x" * 700]
    want = {t: sorted((int(s), int(n), int(o)) for data, ends, own, base in [(np.frombuffer(x, np.uint8), np.array([len(x)]), None, None)]
                      for _, s, n, o, _ in zip(*suffix_dedup.anchor_units(data, ends, 200))) for t, x in enumerate(raw)}
    covered = {t: sorted(p for s, n, _ in u for p in range(s, s + n)) for t, u in want.items()}
    got = {t: [] for t in want}
    for data, ends, own, base in suffix_dedup._runs(raw, 200, most=512):
        t, start, size, _, _ = suffix_dedup.anchor_units(data, ends, 200)
        begins = np.r_[0, ends[:-1]]
        for i, s, n in zip(t, start, size):
            lo = int(s - begins[i] + base[i])
            got[int(own[i])] += range(lo, lo + int(n))
    assert {t: sorted(p) for t, p in got.items()} == covered


def test_empty_tables(empty):
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.one_of_each(empty).collect() == []
    assert suffix_dedup.with_kept(empty).collect() == []
    assert suffix_dedup.remaining_documents(empty).schema.names == empty.schema.names


def test_remaining_documents_keep_rows_and_columns(edge, edge_rows):
    out = suffix_dedup.remaining_documents(edge)
    assert out.columns == edge.columns and out.count() == len(edge_rows)
    assert all(r.n_chars == len(r.text) for r in out.collect())
