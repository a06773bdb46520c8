"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader with an
elastic-net penalty, its probabilities calibrated by a temperature.

Document frequencies cover every training text and are counted by Spark; the
weights are fitted on the driver on a bounded sample of labelled rows
(``sample_rows``, in equal shares for the languages), as hashed n-gram counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

BUCKETS = 1 << 15
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def ngram_counts(text: str, longest: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the hashed n-grams of 1 to ``longest`` characters of
    the lower-cased text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    hashes = []
    h = points * _MIX[0]
    for n in range(1, longest + 1):
        if n > len(points):
            break
        if n > 1:
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * _MIX[1] + points[n - 1 :] * _MIX[2]
        hashes.append(((h ^ (h >> np.uint32(13))) * _MIX[1]) >> np.uint32(17))
    if not hashes:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    counts = np.bincount(np.concatenate(hashes), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def split_number(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4


@dataclass
class Model:
    """langs in order; idf by bucket; the weights that are not zero (bucket b has
    first[b] to first[b + 1] of ``owners`` (languages) and ``weights``); bias;
    temperature."""

    langs: list[str]
    idf: np.ndarray
    first: np.ndarray
    owners: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1.0 + np.log(counts)) * self.idf[at]
        return x / np.sqrt(x @ x) if len(x) else x

    def logits(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        size = self.first[at + 1] - self.first[at]
        entry = np.arange(size.sum()) + np.repeat(self.first[at] - (np.cumsum(size) - size), size)
        return np.bincount(self.owners[entry], self.weights[entry] * np.repeat(x, size), len(self.langs)) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.langs or not has_letter(text):
            return "und", 0.0
        at, counts = ngram_counts(text)
        p = softmax(self.logits(at, self.vector(at, counts)) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], n_classes: int, alpha: float = 0.5, beta: float = 1.0,
             l1: float = 0.02, l2: float = 0.02, epochs: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) from (class, buckets, values) rows, one step a row.

    A weight is zero until its summed gradient exceeds ``l1``."""
    z, n = np.zeros((n_classes, BUCKETS)), np.zeros((n_classes, BUCKETS))
    bias, seen = np.zeros(n_classes), np.zeros(n_classes)

    def solve(zs, ns):
        w = (np.sign(zs) * l1 - zs) / ((beta + np.sqrt(ns)) / alpha + l2)
        return np.where(np.abs(zs) > l1, w, 0.0)

    for epoch in range(epochs):
        for i in np.random.Generator(np.random.PCG64(epoch)).permutation(len(rows)):
            label, at, x = rows[i]
            zs, ns = z[:, at], n[:, at]
            w = solve(zs, ns)
            error = softmax(w @ x + bias)
            error[label] -= 1.0
            g = error[:, None] * x
            more = ns + g * g
            z[:, at] = zs + g - (np.sqrt(more) - np.sqrt(ns)) / alpha * w
            n[:, at] = more
            seen += error * error
            bias -= alpha * error / (beta + np.sqrt(seen))
    return solve(z, n), bias


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search."""
    if not len(labels):
        return 1.0
    pick = np.arange(len(labels))

    def loss(log_t):
        s = logits / np.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[pick, labels]).mean())

    lo, hi, r = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def document_frequencies(rows: DataFrame) -> tuple[int, np.ndarray]:
    """(texts, texts with each bucket) over all of ``rows`` (text); a task sends
    one number a bucket at most."""

    def run(batches):
        df, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                at, _ = ngram_counts(text.as_py() or "")
                df[at] += 1
                n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at]), pa.array(np.r_[n, df[at]])], ["bucket", "n"])

    out = np.zeros(BUCKETS + 1, np.int64)
    for r in rows.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] += r.n
    return int(out[-1]), out[:-1]


def train(labelled: DataFrame, sample_rows: int = 3000, calibrate: int = 5, **penalties) -> Model:
    """Fit on ``labelled`` (doc_id, text, lang; nulls in text or lang take no
    part).  Of each language about sample_rows / languages rows, or 20 if that
    is more, are drawn by a hash of doc_id; every ``calibrate``-th of them sets
    the temperature and not the weights."""
    rows = labelled.filter("text is not null and lang is not null").select(
        "doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    found = rows.groupBy("lang").count().collect()
    langs = sorted(r.lang for r in found)
    if not langs:
        return Model([], np.zeros(BUCKETS), np.zeros(BUCKETS + 1, np.int64), np.empty(0, np.int32), np.empty(0), np.zeros(0))
    n, df = document_frequencies(rows)
    share = max(20, sample_rows // len(langs))
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(1 << 40))
    part = rows.sparkSession.createDataFrame([(r.lang, min(1 << 40, (share << 40) // r["count"])) for r in found], "lang string, most long")
    drawn = rows.join(F.broadcast(part), "lang").withColumn("draw", draw).filter("draw < most").select("draw", "lang", "text")

    def run(batch: pa.RecordBatch):
        pairs = [ngram_counts(t.as_py()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([p[0].astype(np.int32) for p in pairs], pa.list_(pa.int32())),
                                          pa.array([p[1].astype(np.int32) for p in pairs], pa.list_(pa.int32()))], ["draw", "lang", "at", "n"])

    got = arrow_map(drawn, run, "draw long, lang string, at array<int>, n array<int>").toArrow()
    number = {g: i for i, g in enumerate(langs)}
    sample = []
    for batch in got.to_batches():
        for draw, lang, at, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
            at, counts = at.values.to_numpy(), counts.values.to_numpy()
            sample.append((draw, lang, xxhash.xxh3_128_digest(at.tobytes() + counts.tobytes()), at, counts))
    sample.sort(key=lambda r: r[:3])
    model = Model(langs, np.log((1 + n) / (1 + df)) + 1.0, np.zeros(BUCKETS + 1, np.int64), np.empty(0, np.int32), np.empty(0), np.zeros(len(langs)))
    fit, held = [], []
    for k, (_, lang, _, at, counts) in enumerate(sample):
        if len(at):
            (held if k % calibrate == calibrate - 1 else fit).append((number[lang], at, model.vector(at, counts)))
    weights, model.bias = fit_ftrl(fit, len(langs), **penalties)
    bucket, model.owners = np.nonzero(weights.T)
    model.weights, model.first = weights[model.owners, bucket], np.searchsorted(bucket, np.arange(BUCKETS + 1))
    model.owners = model.owners.astype(np.int32)
    model.temperature = fit_temperature(np.array([model.logits(at, x) for _, at, x in held]).reshape(-1, len(langs)), np.array([c for c, _, _ in held], np.int64))
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (text first) with lang_pred and score added at the end."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch):
        got = [shared.value.predict(t.as_py()) for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                                         [*batch.schema.names, "lang_pred", "score"])

    schema = docs.withColumns({"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0)}).schema
    return arrow_map(docs, run, schema)


def identify(docs: DataFrame, **training) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``.

    Learns from text and non-null lang of rows whose ``split_number`` is not 2.
    A null text or one without a letter is ``und`` with score 0, and so is any
    where there is nothing to learn from; repeated rows stay and count again;
    ties go to the first language by name; an empty table gives an empty
    result; other columns are not looked at."""
    model = train(docs.filter(split_number(F.col("doc_id")) != 2), **training)
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"),
                       (split_number(F.col("doc_id")) == 2).alias("held_out"))
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def confident(docs: DataFrame, min_score: float = 0.5, **training) -> DataFrame:
    """The rows of ``docs``, all their columns unchanged, whose language is told
    with a probability of ``min_score`` or more; ``und`` never is.  Trained and
    with edge cases as in ``identify``."""
    model = train(docs.filter(split_number(F.col("doc_id")) != 2), **training)
    rows = docs.select(F.col("text").cast("string").alias("text"), F.struct(*docs.columns).alias("row"))
    return predict(rows, model).filter(F.col("score") >= min_score).filter("lang_pred <> 'und'").select("row.*")
