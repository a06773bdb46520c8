"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

Iterative quantisation learns an orthogonal rotation (and the mean) under which the
signs of up to 64 components are balanced binary codes.  A code is cut into tables; a vector stands
in every table under its piece of the code (home) and looks under other pieces (probes).

Which probes are needed is known exactly.  Let z be a unit vector's rotated, centred
components.  Where the codes of two vectors differ, z_i and z'_i have opposite
signs, so over these places sum (|z_i| + |z'_i|)^2 <= |u - u'|^2 <= 2 - 2 cos.  Of m tables
one has at most an m-th of it, and there one of the two has sum z_i^2 <= (1 - cos) / m:
it finds the other's home when it probes all pieces that flips of its own small components
reach within that sum.  So no link is lost, whatever the rotation; a good rotation
makes small components rare and the probes few.  Candidates are reranked with the
original vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, written
from .simhash import components

CODE_BITS = 64
SLACK = 1e-9  # for rounding in the rotation


def _usable(vector) -> np.ndarray | None:
    """A vector's doubles; None if null, empty, zero or with null or non-finite components."""
    if vector is None or not len(vector):
        return None
    x = np.array([np.nan if v is None else v for v in vector], np.float64) + 0.0
    return x if np.isfinite(x).all() and x.any() else None


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that no square overflows or vanishes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=-1, keepdims=True))[1])


def units(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt((x * x).sum(axis=-1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = _scaled(a), _scaled(b)
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


class Rotation:
    """Directions and thresholds: bit i of a unit vector u is set if ``u . w_i > t_i``.
    Bits without a direction are never set."""

    def __init__(self, directions: np.ndarray, thresholds: np.ndarray):
        self.directions, self.thresholds = directions, thresholds
        self.idle = ~directions.any(axis=0)

    @property
    def bits(self) -> int:
        return self.directions.shape[1]

    def margins(self, u: np.ndarray) -> np.ndarray:
        return u @ self.directions - self.thresholds


def signs(width: int, bits: int) -> Rotation:
    """``bits`` of the components as they are, spread over the code: right for any vectors, if not balanced."""
    used = min(width, bits)
    directions = np.zeros((width, bits))
    directions[np.arange(used), np.arange(used) * bits // used] = 1.0
    return Rotation(directions, np.zeros(bits))


def learn(sample: np.ndarray, rounds: int = 50, seed: int = 42) -> Rotation:
    """Iterative quantisation on unit vectors: principal directions, then a rotation
    that alternately takes the signs and turns the components towards them."""
    n, width = sample.shape
    bits = min(width, CODE_BITS)
    if n < 2:
        return signs(width, bits)
    mean = sample.mean(axis=0)
    centred = sample - mean
    principal = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :bits]
    v = centred @ principal
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        code = np.where(v @ turn > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(code.T @ v)
        turn = (left @ right).T
    directions = principal @ turn
    return Rotation(directions, mean @ directions)


def table_count(bits: int, rows: int) -> int:
    """Tables for groups of ``rows`` vectors: pieces of about log2(rows) bits, so a
    home holds few vectors, but 24 bits at most, beyond which probes outnumber them."""
    return max(1, -(-bits // 24), min(round(bits / max(np.log2(max(rows, 2)), 1)), -(-bits // 4)))


def cuts(bits: int, tables: int) -> list[tuple[int, int]]:
    ends = [bits * t // tables for t in range(tables + 1)]
    return list(zip(ends, ends[1:]))


def probes(squares: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, mask) of all sets of columns whose ``squares`` (rows x columns) add up to ``budget`` at most, the empty one included."""
    row, mask, total = np.arange(len(squares)), np.zeros(len(squares), np.int64), np.zeros(len(squares))
    for i in range(squares.shape[1]):
        more = total + squares[row, i]
        ok = more <= budget
        row, mask, total = np.concatenate([row, row[ok]]), np.concatenate([mask, mask[ok] | (1 << i)]), np.concatenate([total, more[ok]])
    return row, mask


def _marked(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, sha, x): label and SHA-256 of label and vector are null for rows that link with nothing."""

    def run(batch: pa.RecordBatch):
        sha, xs = [], []
        for label, vector in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            x = None if label is None else _usable(vector)
            sha.append(None if x is None else hashlib.sha256(f"{len(label)}:{label}".encode() + x.tobytes()).digest())
            xs.append(None if x is None else x)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sha, pa.binary()), pa.array(xs, pa.list_(pa.float64()))], ["vec_id", "label", "sha", "x"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("x"))
    return arrow_map(rows, run, "vec_id long, label string, sha binary, x array<double>")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def rotations(classes: DataFrame, sample_values: int = 2_097_152) -> tuple[int, Rotation]:
    """The most frequent width and the rotation learned from at most ``sample_values``
    numbers of its vectors; other widths take their signs as they are."""
    widths = classes.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if widths is None:
        return 0, signs(1, 1)
    width = widths["width"]
    sample = classes.filter(F.size("x") == width).orderBy("sha").limit(max(2, sample_values // width)).select("x").toArrow()
    return width, learn(units(_matrix(sample.column(0).combine_chunks(), width)))


ENTRY = "grp long, place long, node long, code long, own int, half int, flipped boolean, home boolean"


def entries(classes: DataFrame, rotation: Rotation, width: int, tables: int, min_cosine: float) -> DataFrame:
    """Homes and probes of every class in every table.  ``own`` and ``half``: how many
    places a code may differ in at most, if the whole and half of the distance are spent."""
    whole = 2.0 - 2.0 * min_cosine + SLACK
    shared = classes.sparkSession.sparkContext.broadcast(rotation)

    def run(batch: pa.RecordBatch):
        learned, sizes = shared.value, np.diff(batch.column(3).offsets.to_numpy())
        for w in np.unique(sizes).tolist():
            all_own = np.flatnonzero(sizes == w)
            turn = learned if w == width else signs(w, learned.bits)
            for lo in range(0, len(all_own), 1000):
                own = all_own[lo:lo + 1000]
                part = batch.take(pa.array(own))
                z = turn.margins(units(_matrix(part.column(3), w)))
                code = ((z > 0).astype(np.uint64) << np.arange(turn.bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
                squares = np.where(turn.idle, np.inf, z * z)
                least = np.cumsum(np.sort(squares, axis=1), axis=1)
                most = [(least <= b).sum(axis=1).astype(np.int32) for b in (whole, whole / 2)]
                grp, node = (part.column(c).to_numpy() for c in (1, 0))
                for t, (a, b) in enumerate(cuts(turn.bits, tables)):
                    piece = ((code >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)).astype(np.int64)
                    row, mask = probes(squares[:, a:b], whole / (2 * tables))
                    for rows, place, flipped, home in ((np.arange(len(own)), piece, np.zeros(len(own), bool), True), (row, piece[row] ^ mask, mask != 0, False)):
                        yield pa.RecordBatch.from_arrays([pa.array(grp[rows]), pa.array(place | (t << 56)), pa.array(node[rows]), pa.array(code.view(np.int64)[rows]),
                                                          pa.array(most[0][rows]), pa.array(most[1][rows]), pa.array(flipped), pa.array(np.full(len(rows), home))],
                                                         [c.split()[0] for c in ENTRY.split(", ")])

    grp = F.xxhash64("label", F.size("x"))
    return arrow_map(classes.select("node", grp.alias("grp"), F.size("x").alias("width"), "x"), run, ENTRY)


def candidates(found: DataFrame, bits: int, tables: int, spread: int = 8) -> DataFrame:
    """(a, b) of classes that meet in a table, a < b.  Pairs with an equal piece are
    taken from the first such table, once; the rest from probes.  Homes are
    copied ``spread`` times and probes dealt over the copies, so a crowded home is
    worked on in parts."""
    homes = found.filter("home").select("grp", "place", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("salt"),
                                        F.col("node").alias("other"), F.col("code").alias("other_code"), F.col("own").alias("other_own"), F.col("half").alias("other_half"))
    asks = found.filter("not home").select("grp", "place", F.pmod(F.xxhash64("node"), F.lit(spread)).cast("int").alias("salt"), "node", "code", "own", "half", "flipped")
    met = asks.join(homes, ["grp", "place", "salt"])
    differ = F.col("code").bitwiseXOR(F.col("other_code"))
    table = F.shiftrightunsigned("place", 56)
    equal = [differ.bitwiseAND(F.lit(_signed(((1 << (b - a)) - 1) << a))) == 0 for a, b in cuts(bits, tables)]
    before, anywhere = F.lit(False), F.lit(False)
    for t, same in enumerate(equal):
        before, anywhere = before | (same & (table > t)), anywhere | same
    places = F.bit_count(differ)
    near = (places <= F.least("own", "other_own")) & (places <= F.greatest("half", "other_half"))
    once = F.when(F.col("flipped"), ~anywhere & (F.col("node") != F.col("other"))).otherwise(~before & (F.col("node") < F.col("other")))
    return met.filter(near & once).select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def linked(classes: DataFrame, pairs: DataFrame, min_cosine: float) -> DataFrame:
    """(a, b, a_size, b_size, cosine) of the pairs with equal label and width and ``min_cosine`` or more, on the original vectors."""
    of = lambda side: classes.select(F.col("node").alias(side), F.col("label").alias(f"{side}_label"), F.col("size").alias(f"{side}_size"), F.col("x").alias(f"{side}_x"))
    both = pairs.join(of("a"), "a").join(of("b"), "b").filter((F.col("a_label") == F.col("b_label")) & (F.size("a_x") == F.size("b_x")))

    def run(batch: pa.RecordBatch):
        sizes = np.diff(batch.column(4).offsets.to_numpy())
        out = np.zeros(batch.num_rows)
        for w in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == w)
            part = batch if len(own) == batch.num_rows else batch.take(pa.array(own))
            out[own] = cosines(_matrix(part.column(4), w), _matrix(part.column(5), w))
        keep = pa.array(np.flatnonzero(out >= min_cosine))
        yield pa.RecordBatch.from_arrays([*[batch.column(k).take(keep) for k in range(4)], pa.array(out).take(keep)], ["a", "b", "a_size", "b_size", "cosine"])

    return arrow_map(both.select("a", "b", "a_size", "b_size", "a_x", "b_x"), run, "a long, b long, a_size long, b_size long, cosine double")


def near_duplicates(vectors: DataFrame, min_cosine: float = 0.98, sample_values: int = 2_097_152, tables: int | None = None, spread: int = 64) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id,
    embedding, label): rows of equal, non-null label and equal width link at a cosine
    of ``min_cosine`` or more; none is missed.

    Equal vectors of a label are one class and link; repeated rows are rows of
    their own.  Null, empty or zero vectors, vectors with null or non-finite components
    and rows without a label link with nothing: n_links 0 and their own vec_id.  A
    null vec_id keeps its row, is no component's id unless all of it are null, and
    is not kept; an empty table gives an empty result; other columns are not looked at.

    The rotation is learned from ``sample_values`` numbers at most, every vector
    is indexed.  ``tables`` is by default chosen from the largest label's size."""
    marked = _marked(vectors).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(spread)))
    classes = marked.filter("sha is not null").groupBy("label", "sha").agg(F.count("*").alias("size"), F.min("vec_id").alias("least"), F.first("x").alias("x"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    width, rotation = rotations(classes, sample_values)
    if tables is None:
        largest = classes.groupBy("label").count().agg(F.coalesce(F.max("count"), F.lit(1))).first()[0]
        tables = table_count(rotation.bits, largest)
    tables = min(tables, rotation.bits)
    found = written(entries(classes, rotation, width, tables, min_cosine), "entries")
    links = written(linked(classes, candidates(found, rotation.bits, tables), min_cosine), "links")
    degree = links.select(F.col("a").alias("node"), F.col("b_size").alias("n")).union(links.select("b", "a_size")).groupBy("node").agg(F.sum("n").alias("n"))
    known = classes.select("node", "label", "sha", "size", "least").join(degree, "node", "left").join(components(links.select("a", "b")), "node", "left")
    known = known.select("label", "sha", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), "least", F.coalesce("root", "node").alias("root"))
    ids = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(ids, "root").select("label", "sha", "n_links", "component_id")
    # a class meets its rows once for each salt that they have, so copies don't gather
    salted = marked.filter("sha is not null").select("label", "sha", "salt").distinct().join(known, ["label", "sha"])
    rows = marked.select("vec_id", "label", "sha", "salt")
    out = rows.join(salted, ["label", "sha", "salt"], "left")
    component = F.when(F.col("sha").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def oracle(min_cosine: float = 0.98) -> str:
    """The same in DuckDB: all pairs of a label, and what links reach."""
    return f"""
WITH RECURSIVE v AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
u AS MATERIALIZED (SELECT i, label, x, sqrt(list_dot_product(x, x)) AS s FROM v WHERE label IS NOT NULL AND len(x) > 0
  AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(x, lambda e: e <> 0)) > 0),
l AS MATERIALIZED (SELECT a.i AS a, b.i AS b FROM u a JOIN u b ON a.label = b.label AND a.i <> b.i AND len(a.x) = len(b.x)
  AND list_dot_product(a.x, b.x) / (a.s * b.s) >= {min_cosine}),
r(i, j) AS (SELECT i, i FROM v UNION SELECT r.i, l.b FROM r JOIN l ON l.a = r.j),
c AS (SELECT r.i, min(v.vec_id) AS component_id FROM r JOIN v ON v.i = r.j GROUP BY r.i)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.i) AS n_links, c.component_id, coalesce(v.vec_id = c.component_id, false) AS kept FROM v JOIN c ON c.i = v.i"""
