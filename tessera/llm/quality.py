"""Quality rules: base counts, and the Jensen-Shannon distance of a document's
character classes and common words to language references.

References are gathered from all documents of a language: the shares of its
character classes and of its common words (those that make up a thousandth or
more of its words, so a thousand at most).  A document is held against its
nearest reference, and only if long enough for its shares to mean something.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import count, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, texts, written

SYMBOLS = b"#*$%&|<>"
#: Lower case, upper case, digits, white space, marks of a
#: sentence, other ASCII, first bytes of other characters; their further bytes.
CLASSES = 7
#: Parts that a language's words are dealt to where they meet its total.
SALTS = 256
#: Kinds of rows that tasks add up.
WORD, TOTAL, CLASS = 0, 1, 2


def _class_table() -> np.ndarray:
    table = np.full(256, 5, np.uint8)
    for chars, k in ((b"abcdefghijklmnopqrstuvwxyz", 0), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2),
                     (b" \t\n\r\x0b\x0c", 3), (b".,;:!?'\"()-", 4)):
        table[np.frombuffer(chars, np.uint8)] = k
    table[0xC0:] = 6
    table[0x80:0xC0] = 7
    return table


CLASS_OF = _class_table()


def class_counts(raw: bytes) -> np.ndarray:
    return np.bincount(CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=CLASSES + 1)[:CLASSES]


@dataclass
class References:
    """Of every language: its shares of classes (a row each), of words common in
    it, and of ``others``, the words common in no language.  Word w has the
    entries first[w] to first[w + 1] of ``owners`` (languages) and ``shares``:
    a thousand entries a language at most, however many words there are."""

    langs: list[str]
    classes: np.ndarray
    words: dict[bytes, int]
    first: np.ndarray
    owners: np.ndarray
    shares: np.ndarray
    others: np.ndarray

    def __post_init__(self):
        self.whole = np.bincount(self.owners, self.shares, len(self.langs)) + self.others  # 1, or 0 without a word


def distances(counts: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (root of the divergence in bits, 0 to 1) of one
    histogram to each row of ``references``."""
    p = counts / max(1, counts.sum())
    m = (p + references) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0.0).sum(axis=1)
        b = np.where(references > 0, references * np.log2(references / m), 0.0).sum(axis=1)
    return np.sqrt(np.clip((a + b) / 2, 0.0, 1.0))


def word_distances(counts: np.ndarray, ref: References) -> np.ndarray:
    """``distances`` of one histogram of words (``others`` last) to every
    language; where only one side has a share it adds that share, so only words
    that both have are looked at."""
    p = counts / max(1, counts.sum())
    at = np.flatnonzero(counts[:-1])
    size = ref.first[at + 1] - ref.first[at]
    entry = np.arange(size.sum()) + np.repeat(ref.first[at] - (np.cumsum(size) - size), size)
    p_at, q_at, own = np.repeat(p[at], size), ref.shares[entry], ref.owners[entry]
    both = lambda a, b: a * np.log2(a / (a + b)) + b * np.log2(b / (a + b))
    total = p.sum() + ref.whole
    total += np.bincount(own, both(p_at, q_at), len(ref.langs))
    if p[-1] > 0:
        has = ref.others > 0
        total[has] += both(p[-1], ref.others[has])
    return np.sqrt(np.clip(total / 2, 0.0, 1.0))


def language_references(docs: DataFrame, common_share: float = 0.001, held_words: int = 200_000) -> References:
    """References of all languages, from all of ``docs`` (text, lang).  A task
    adds up words before it sends them, ``held_words`` or a text more at once."""

    def run(batches):
        words, classes = defaultdict(Counter), defaultdict(lambda: np.zeros(CLASSES, np.int64))
        held = 0

        def flush():
            rows = [(g, WORD, w, n) for g, c in words.items() for w, n in c.items()]
            rows += [(g, TOTAL, b"", c.total()) for g, c in words.items()]
            rows += [(g, CLASS, b"%d" % k, int(n)) for g, v in classes.items() for k, n in enumerate(v)]
            words.clear(), classes.clear()
            lang, kind, word, n = zip(*rows) if rows else ((),) * 4
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(kind, pa.int32()), pa.array(word, pa.binary()), pa.array(n, pa.int64())],
                                              ["lang", "kind", "word", "n"])

        for batch in batches:
            for lang, raw in zip(batch.column(1).to_pylist(), texts(batch.column(0))):
                own = words[lang]
                held -= len(own)
                own.update(raw.lower().split())
                held += len(own)
                classes[lang] += class_counts(raw)
                if held > held_words:
                    yield flush()
                    held = 0
        yield flush()

    rows = docs.filter("lang is not null and text is not null").select(F.col("text").cast("string"), F.col("lang").cast("string"))
    counts = rows.mapInArrow(run, "lang string, kind int, word binary, n long").groupBy("lang", "kind", "word").agg(F.sum("n").alias("n"))
    counts = written(counts, "words")  # read twice, made once
    # a word is sent on only if it can be common in a language: a thousand words a language at most
    # (a language's total meets its words in SALTS places, so no task gets all words of one)
    totals = counts.filter(F.col("kind") == TOTAL).select("lang", F.col("n").alias("total"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = counts.withColumn("salt", F.pmod(F.xxhash64("kind", "word"), F.lit(SALTS)).cast("int"))
    kept = salted.join(totals, ["lang", "salt"]).filter((F.col("kind") != WORD) | (F.col("n") >= F.col("total") * common_share))
    got = kept.select("lang", "kind", "word", "n").toArrow()
    kind, n = got.column("kind").to_numpy(), got.column("n").to_numpy()
    lang = got.column("lang").combine_chunks().dictionary_encode()
    langs = lang.dictionary.to_pylist()
    rank = np.empty(len(langs), np.int64)
    rank[sorted(range(len(langs)), key=langs.__getitem__)] = np.arange(len(langs))
    row = rank[lang.indices.to_numpy()] if len(got) else np.empty(0, np.int64)
    is_word, is_class = kind == WORD, kind == CLASS
    word = got.column("word").filter(pa.array(is_word)).combine_chunks().dictionary_encode()
    totals, classes = np.bincount(row[kind == TOTAL], n[kind == TOTAL], len(langs)), np.zeros((len(langs), CLASSES))
    classes[row[is_class], [int(k) for k in got.column("word").filter(pa.array(is_class)).to_pylist()]] = n[is_class]
    at, owners, own = word.indices.to_numpy(), row[is_word], n[is_word]
    order = np.lexsort((owners, at))
    at, owners, own = at[order], owners[order], own[order]
    others = totals - np.bincount(owners, own, len(langs))
    return References(sorted(langs), classes / np.maximum(1, classes.sum(axis=1, keepdims=True)), {w: i for i, w in enumerate(word.dictionary.to_pylist())},
                      np.searchsorted(at, np.arange(len(word.dictionary) + 1)), owners.astype(np.int32),
                      own / np.maximum(1, totals)[owners], others / np.maximum(1, totals))


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(words) < 4:
        return 0
    number = defaultdict(count().__next__)
    ids = np.array(list(map(number.__getitem__, words)), np.int64)
    k = len(number)
    pair = ids[:-1] * k + ids[1:]
    if k > 2_000_000:  # three numbers would not fit 64 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, which, counts = np.unique(pair[:-1] * k + ids[2:], return_inverse=True, return_counts=True)
    hit = counts[which] > 1
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : i + len(hit)] |= hit
    return int(covered.sum())


def duplicate_lines(raw: bytes) -> int:
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def judge(raw: bytes, ref: References, max_class: float, max_words: float, min_chars: int, min_words: int):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, class_distance, word_distance); a distance is None below its length."""
    words = raw.split()
    n = len(words)
    chars = len(b"".join(words).decode())
    repeats = repeat_words(words)
    failed = n < 50 or 100 * repeats > 50 * n
    by_class = by_word = None
    if ref.langs and chars >= min_chars:
        by_class = distances(class_counts(raw), ref.classes)
    if ref.langs and n >= min_words:
        at = np.array(list(map(ref.words.get, raw.lower().split(), repeat(len(ref.words)))))
        by_word = word_distances(np.bincount(at, minlength=len(ref.words) + 1), ref)
    both = [x for x in (by_class, by_word) if x is not None]
    if both:
        near = int(sum(both).argmin())
        by_class = None if by_class is None else float(by_class[near])
        by_word = None if by_word is None else float(by_word[near])
    kept = not failed and (by_class is None or by_class <= max_class) and (by_word is None or by_word <= max_words)
    return n, chars, len(raw) - len(raw.translate(None, SYMBOLS)), duplicate_lines(raw), repeats, failed, kept, by_class, by_word


def rate(docs: DataFrame, max_class: float = 0.28, max_words: float = 0.5, min_chars: int = 200, min_words: int = 100) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, base_failed, kept,
    and the two distances to the nearest reference (null below ``min_chars``
    characters in words or ``min_words`` words: such are judged by the base alone).

    A null text has no words and fails the base; a null lang adds to no
    reference but is judged like any; repeated rows stay; an empty table gives
    an empty result; without any lang the base alone decides; other columns are
    not looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(language_references(docs))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance"]
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2

    def run(batch: pa.RecordBatch):
        rows = [judge(raw, shared.value, max_class, max_words, min_chars, min_words) for raw in texts(batch.column(1))]
        columns = list(zip(*rows)) if rows else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names)

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                     "base_failed boolean, kept boolean, class_distance double, word_distance double")
