"""Language ID, quality rules and the forest against held-out rows and brute force."""

import numpy as np
import pytest
from tessera.llm import langid, quality, rpforest

SF01, SF001 = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


def test_held_out_accuracy_and_calibration(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    right = np.array([r.lang == r.lang_pred for r in rows])
    assert len(rows) > 200 and right.mean() > 0.98
    assert abs(np.mean([r.score for r in rows]) - right.mean()) < 0.02


def test_language_edge_rows(edge, empty, edge_rows):
    rows = langid.identify(edge).collect()
    assert len(rows) == len(edge_rows)
    learned = {"en", "de", "fr"}
    for r in rows:
        assert r.lang_pred in learned | {"und"} and 0 <= r.score <= 1 and r.held_out is not None
    assert sum(r.lang_pred == "und" for r in rows) == sum(r[1] is None or not langid.has_letter(r[1]) for r in edge_rows)
    again = {(r.doc_id, r.score) for r in langid.identify(edge.repartition(2)).collect()}
    assert again == {(r.doc_id, r.score) for r in rows}
    assert langid.identify(empty).collect() == []
    kept = langid.confident(edge, 0.0)
    assert kept.schema.names == edge.schema.names and kept.count() == sum(r.lang_pred != "und" for r in rows)
    nothing = langid.identify(edge.withColumn("lang", edge.lang.substr(9, 1)).filter("lang = 'x' or lang is null or lang = ''").filter("lang is null"))
    assert {r.lang_pred for r in nothing.collect()} <= {"und"}


def test_the_rarest_of_many_languages_are_learned(spark):
    rows = [(i, " ".join(chr(0x4E00 + 20 * g + (i * 7 + k) % 20) * 2 for k in range(12)), f"l{g:03}")
            for g in range(210) for i in range(100 * g, 100 * g + (24 if g < 200 else 16))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("lang >= 'l200'").collect()
    assert len(got) == 160 and np.mean([r.lang == r.lang_pred for r in got]) > 0.95


def test_sparse_weights_give_the_logits_of_the_whole_table():
    rng = np.random.default_rng(9)
    table = rng.normal(size=(4, langid.BUCKETS)) * (rng.random((4, langid.BUCKETS)) < 0.1)
    bucket, owner = np.nonzero(table.T)
    first = np.searchsorted(bucket, np.arange(langid.BUCKETS + 1))
    model = langid.Model(list("abcd"), np.ones(langid.BUCKETS), first, owner, table[owner, bucket], rng.normal(size=4))
    at, x = np.sort(rng.choice(langid.BUCKETS, 500, replace=False)), rng.random(500)
    assert model.logits(at, x) == pytest.approx(table[:, at] @ x + model.bias)


def test_the_penalty_makes_weights_sparse():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(200):
        c = int(rng.integers(2))
        at = np.unique(np.r_[c, rng.integers(10, 400, 20)])
        rows.append((c, at, np.full(len(at), len(at) ** -0.5)))
    loose, _ = langid.fit_ftrl(rows, 2, l1=0.0)
    tight, _ = langid.fit_ftrl(rows, 2, l1=1.0)
    assert np.count_nonzero(tight) < np.count_nonzero(loose) / 2
    assert tight[0, 0] > 0 > tight[0, 1]


def test_temperature_is_found():
    rng = np.random.default_rng(1)
    z = rng.normal(size=(4000, 3)) * 2
    labels = np.array([rng.choice(3, p=p) for p in langid.softmax(z)])
    assert abs(langid.fit_temperature(z * 3, labels) - 3) < 0.3


def brute_base(text):
    white = " \t\n\x0b\x0c\r"
    words = [w for w in "".join(" " if c in white else c for c in text or "").split(" ") if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if x.strip(white)]
    n = len(words)
    return (n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_base_counts(edge, empty, edge_rows):
    rows = quality.rate(edge).collect()
    got = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    small = [r for r in edge_rows if len(r[1] or "") < 20_000]
    want = sorted((r[0] or -1, *brute_base(r[1])) for r in small)
    assert [x for x in got if x[0] != 13] == want
    assert all(not r.kept for r in rows if r.base_failed)
    assert quality.rate(empty).collect() == []


def test_clean_documents_stay_and_junk_goes(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    rows = quality.rate(docs).join(labels, "doc_id").filter("not base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0 and r.n_words >= 150]
    assert all(good) and len(good) > 100
    assert not bad or np.mean(bad) < 0.3


def test_documents_of_the_smallest_of_many_languages_stay(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {g: [letters[g // 26] + letters[g % 26] + a + b for a in letters[:8] for b in letters[:20]] for g in range(230)}
    rows = [(3 * g + i, " ".join(words[g] + words[g][: g % 40]), f"l{g:03}") for g in range(230) for i in range(1 + (g < 200))]
    got = quality.rate(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)).collect()
    assert len(got) == len(rows) and all(r.kept and r.word_distance < 0.1 for r in got)
    assert langs_of(spark, rows) == sorted({r[2] for r in rows})


def langs_of(spark, rows):
    return quality.language_references(spark.createDataFrame(rows, "doc_id long, text string, lang string")).langs


def test_word_distances_are_those_of_the_whole_tables():
    rng = np.random.default_rng(8)
    table = rng.integers(0, 4, (5, 13)) * (rng.random((5, 13)) < 0.5)
    table[:, -1] = [3, 0, 2, 5, 1]
    shares = table / table.sum(axis=1, keepdims=True)
    word, owner = np.nonzero(shares[:, :-1].T)
    ref = quality.References(list("abcde"), np.zeros((5, 7)), {}, np.searchsorted(word, np.arange(13)), owner, shares[owner, word], shares[:, -1])
    for _ in range(20):
        counts = rng.integers(0, 3, 13)
        assert quality.word_distances(counts, ref) == pytest.approx(quality.distances(counts, shares))


def test_distance_is_the_jensen_shannon_distance():
    p, q = np.array([3.0, 1.0, 0.0]), np.array([[0.25, 0.25, 0.5], [0.75, 0.25, 0.0], [0.0, 0.0, 1.0]])
    a, m = p / 4, (p / 4 + q[0]) / 2
    kl = lambda x: sum(i * np.log2(i / j) for i, j in zip(x, m) if i)
    assert quality.distances(p, q) == pytest.approx([((kl(a) + kl(q[0])) / 2) ** 0.5, 0.0, 1.0])


def brute_neighbours(rows, every, k):
    out = []
    for i, (q, v) in enumerate(rows):
        if q % every:
            continue
        seen = sorted((-float(rpforest.cosines(np.array([v], float), np.array([w], float))[0]), c) for j, (c, w) in enumerate(rows) if j != i)
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(seen[:k])]
    return out


def test_forest_recall(spark):
    table = spark.read.parquet(f"{SF01}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = rpforest.neighbours(table).collect()
    want = brute_neighbours(rows, 50, 5)
    assert len(got) == len(want)
    assert len({(r.query_id, r.vec_id) for r in got} & {(q, c) for q, _, c, _ in want}) >= 0.9 * len(want)
    exact = dict(((q, c), s) for q, _, c, s in brute_neighbours(rows, 50, len(rows)))
    assert all(r.score == exact[r.query_id, r.vec_id] for r in got)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_forest_edge_rows(spark, kind):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).round(3).tolist()) for i in range(30)]
    same = [1.0, 2.0, 2.0, 0.0]
    rows += [(i, same) for i in range(100, 130)] + [(100, same), (140, [2.0, 4.0, 4.0, 0.0])]
    out = [(200, None), (201, [0.0] * 4), (202, [1.0, None, 0.0, 0.0]), (203, [float("nan"), 1.0, 1.0, 1.0]), (204, [float("inf"), 0.0, 0.0, 0.0]), (None, same), (205, [1.0, 2.0]), (206, [])]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows + out], f"vec_id long, embedding array<{kind}>, score string").repartition(3)
    rows = [(a, np.array(b, np.float32 if kind == "float" else float).astype(float).tolist()) for a, b in rows]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in rpforest.neighbours(df, every=10, leaf_rows=4, search_share=99.0, shard_leaves=3, block_rows=2).collect())
    assert got == sorted(brute_neighbours(rows, 10, 5))
    assert rpforest.neighbours(df.filter("vec_id > 199")).collect() == []
    assert [(r.query_id, r["rank"]) for r in rpforest.neighbours(df.filter("vec_id in (10, 11, 12)"), every=10).collect()] == [(10, 1), (10, 2)]
