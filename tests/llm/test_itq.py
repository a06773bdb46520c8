"""Embedding near-duplicates against all pairs, and the parts of the index by themselves."""

import math

import duckdb
import numpy as np
import pytest

from tessera.llm import itq as Q
from tessera.llm.queries import ORACLES, QUERIES

from paths import SF

SCHEMA = "vec_id long, embedding array<double>, label int, a long, code string, node int"


def brute(rows, least=0.98):
    good = {}
    for i, (_, e, label) in enumerate(rows):
        if label is not None and e and all(v is not None and math.isfinite(v) for v in e) and any(e):
            x = np.array(e) / max(abs(v) for v in e)
            good[i] = (label, x / np.linalg.norm(x))
    link = {i: [j for j in good if j != i and good[i][0] == good[j][0] and len(good[i][1]) == len(good[j][1]) and good[i][1] @ good[j][1] >= least] if i in good else [] for i in range(len(rows))}
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        known = [rows[j][0] for j in seen if rows[j][0] is not None]
        root = min(known) if known else None
        out.append((rows[i][0], len(link[i]), root, rows[i][0] is not None and rows[i][0] == root))
    return sorted(out, key=str)


def vectors(width=24, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, 2):
        for _ in range(12):
            centre = rng.normal(size=width)
            for spread in rng.choice([0.0, 0.02, 0.08, 0.13, 0.2], rng.integers(1, 9)):
                x = (centre + spread * rng.normal(size=width)) * rng.choice([1e-3, 1.0, 50.0])
                rows.append((int(rng.integers(0, 10_000)), x.tolist(), label))
    rows += [rows[3], rows[3], (-5, rows[3][1], 9), (None, rows[5][1], rows[5][2]), (None, [1.0] * width, 7), (20_001, None, 0), (20_002, [], 0), (20_003, [0.0] * width, 0),
             (20_004, [1.0, None] + [0.5] * (width - 2), 0), (20_005, [float("nan")] * width, 0), (20_006, [float("inf")] + [1.0] * (width - 1), 0), (20_007, rows[4][1], None),
             (20_008, [1e200] * width, 1), (20_009, [1.1e200] * width, 1), (20_010, [1e-200] * width, 1), (20_011, [1.0, 2.0], 0), (20_012, [1.0, 2.01], 0), (20_013, [1.0], 0), (20_014, [3.0], 0), (20_015, [-3.0], 0)]
    return rows


@pytest.mark.parametrize("tables", [None, 2, 7])
def test_against_all_pairs(spark, tables):
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, "c", 1) for r in rows], SCHEMA).repartition(5)
    got = Q.near_duplicates(df, sample_values=2000, tables=tables).collect()
    want = brute(rows)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert sum(w[1] for w in want) > 200


def test_wide_vectors_use_64_bits(spark):
    rows = vectors(90, 4)
    got = Q.near_duplicates(spark.createDataFrame([(*r, 1, "c", 1) for r in rows], SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_empty_table(spark):
    assert Q.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_rotation_is_orthogonal_and_nearer_to_the_codes():
    rng = np.random.default_rng(0)
    x = Q.units(rng.normal(size=(2000, 40)) * np.linspace(3, 0.3, 40))
    learned, start = Q.learn(x), Q.learn(x, rounds=0)
    assert np.allclose(learned.directions.T @ learned.directions, np.eye(40))
    loss = lambda r: ((np.where((z := r.margins(x)) > 0, 1, -1) * np.abs(z).mean() - z) ** 2).sum()
    assert loss(learned) < loss(start)
    on = (learned.margins(x) > 0).mean(axis=0)
    assert on.min() > 0.3 and on.max() < 0.7


def test_probes_are_all_sets_within_the_budget():
    squares = np.random.default_rng(1).random((5, 7))
    row, mask = Q.probes(squares, 0.9)
    want = {(r, m) for r in range(5) for m in range(128) if sum(squares[r, i] for i in range(7) if m >> i & 1) <= 0.9}
    assert set(zip(row.tolist(), mask.tolist())) == want and len(row) == len(want)


def test_query_and_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    got = sorted(tuple(r) for r in QUERIES["op11_embedding_near_dedup"](spark, SF).collect())
    assert got == sorted(con.execute(ORACLES["op11_embedding_near_dedup"]).fetchall())
