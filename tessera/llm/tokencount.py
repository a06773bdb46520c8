"""Edit-aware token counts: a segment tree over a document's pre-tokens.

Leaves hold the token counts and character counts of pre-tokens, inner nodes
their sums.  An edit re-splits only the touched pre-tokens, a few characters of
context before them, and what follows until the new split meets an old bound;
then the sums above the changed leaves are updated.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Memo

#: The split pattern looks this many characters ahead of a pre-token's end at most.
LOOK = 3


class Counter(Memo):
    """Tokens of a pre-token, by the library."""

    def __init__(self, path: str, pattern: str, most: int = 250_000):
        import regex
        from tokenizers import Tokenizer

        super().__init__(self._tokens, most)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.split = regex.compile(pattern)

    def _tokens(self, piece: str) -> int:
        return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)


@lru_cache(maxsize=2)
def piece_counter(path: str, pattern: str) -> Counter:
    """One per worker process: its cache serves all its tasks."""
    return Counter(path, pattern)


class CountedText:
    """A text that knows its token count through edits."""

    def __init__(self, text: str, counter: Counter):
        self.counter = counter
        parts = counter.split.findall(text)
        self.leaves: list[list[str]] = [[x] for x in parts] or [[]]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        tree = np.zeros((2 * self.size, 2), np.int64)
        tree[self.size : self.size + len(parts), 0] = [counter[x] for x in parts]
        tree[self.size : self.size + len(parts), 1] = [len(x) for x in parts]
        lo = self.size
        while lo > 1:
            tree[lo // 2 : lo] = tree[lo : 2 * lo : 2] + tree[lo + 1 : 2 * lo : 2]
            lo //= 2
        self.tree = tree
        self.encoded = 0  # pre-tokens split anew by edits

    @property
    def tokens(self) -> int:
        return int(self.tree[1, 0])

    @property
    def chars(self) -> int:
        return int(self.tree[1, 1])

    def _leaf(self, at: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds character ``at``
        (the last leaf with characters, if beyond)."""
        at = max(0, min(at, self.chars - 1))
        node, start = 1, 0
        while node < self.size:
            left = int(self.tree[2 * node, 1])
            if at - start < left or not self.tree[2 * node + 1, 1]:
                node = 2 * node
            else:
                node, start = 2 * node + 1, start + left
        return min(node - self.size, len(self.leaves) - 1), start

    def _set(self, leaf: int, pieces: list[str]) -> None:
        self.leaves[leaf] = pieces
        node = leaf + self.size
        self.tree[node] = sum(self.counter[x] for x in pieces), sum(map(len, pieces))
        while node > 1:
            node //= 2
            self.tree[node] = self.tree[2 * node] + self.tree[2 * node + 1]

    def replace(self, at: int, n_delete: int, insert: str) -> None:
        """Put ``insert`` for ``n_delete`` characters from ``at`` (both cut to
        the text)."""
        at = max(0, min(at, self.chars))
        end = min(at + max(0, n_delete), self.chars)
        first, start = self._leaf(at - LOOK)
        last, stop = first, start + int(self.tree[first + self.size, 1])
        old, bounds = "".join(self.leaves[first]), {stop: first}

        def more(n):
            nonlocal last, stop, old
            while n > 0 and last + 1 < len(self.leaves):
                last += 1
                part = "".join(self.leaves[last])
                old, stop, n = old + part, stop + len(part), n - len(part)
                bounds[stop] = last

        more(end - stop + 1)
        reach = 64
        while True:
            more(reach)
            whole = last + 1 == len(self.leaves)
            text = old[: at - start] + insert + old[end - start :]
            shift = len(insert) - (end - at)
            pieces, met = [], None
            for m in self.counter.split.finditer(text):
                if not whole and m.end() + LOOK > len(text):
                    break
                pieces.append(m.group())
                was = start + m.end() - shift
                if start + m.end() >= at + len(insert) and was in bounds and was >= end:
                    met = bounds[was]
                    break
            if met is None and whole:
                met = last
            if met is not None:
                break
            reach *= 2
        self.encoded += len(pieces)
        self._set(first, pieces)
        for leaf in range(first + 1, met + 1):
            if self.leaves[leaf]:
                self._set(leaf, [])

    def text(self) -> str:
        return "".join("".join(x) for x in self.leaves)


def count(docs: DataFrame, edits: Column, tokenizer_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, n_edited_tokens, n_edited_chars, n_encoded) for every
    row of ``docs``: its tokens, and its tokens and characters after ``edits``
    (array of struct of pos, n_delete, insert; in turn, places are characters of
    the text as the edits before left it), and the pre-tokens that the edits
    split anew.

    A null text is empty; null edits, or null fields of one, change nothing;
    places beyond the text are its end; repeated rows stay; an empty table gives
    an empty result; other columns are not looked at."""

    def run(batches):
        counter = piece_counter(tokenizer_path, pattern)
        for batch in batches:
            rows = []
            for text, todo in zip(batch.column(1), batch.column(2).to_pylist()):
                doc = CountedText(text.as_py() or "", counter)
                before = doc.tokens
                for e in todo or []:
                    if e is not None and None not in (e["pos"], e["n_delete"], e["insert"]):
                        doc.replace(e["pos"], e["n_delete"], e["insert"])
                rows.append((before, doc.tokens, doc.chars, doc.encoded))
            columns = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns]],
                                             ["doc_id", "n_tokens", "n_edited_tokens", "n_edited_chars", "n_encoded"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), edits.alias("edits"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_edited_tokens long, n_edited_chars long, n_encoded long")


def count_edits(docs: DataFrame, edits: DataFrame, tokenizer_path: str, pattern: str) -> DataFrame:
    """``count`` with the edits in a table (doc_id, seq, pos, n_delete, insert);
    they apply by seq to every row that has the doc_id."""
    listed = edits.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", "pos", "n_delete", "insert"))).alias("__edits"))
    rows = docs.select("doc_id", "text").join(listed, "doc_id", "left")
    return count(rows, F.col("__edits"), tokenizer_path, pattern)


def derived_edits(doc_id: Column, text: Column, insert: Column, n: int = 3) -> Column:
    """``n`` edits of a document, each a function of its id and length: a place
    anywhere in it, up to 11 characters deleted, ``insert`` put in."""
    size = F.coalesce(F.length(text), F.lit(0)) + 1
    key = F.coalesce(doc_id.cast("string"), F.lit(""))
    edit = lambda k: F.struct((F.crc32(F.concat(key, F.lit(f":{k}"))) % size).cast("int").alias("pos"),
                              (F.crc32(F.concat(key, F.lit(f"-{k}"))) % 12).cast("int").alias("n_delete"),
                              F.coalesce(insert, F.lit("")).alias("insert"))
    return F.array(*[edit(k) for k in range(n)])
