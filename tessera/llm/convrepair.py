"""Conversation structure repair by generalised LR parsing.

A conversation is well formed if its role initials read ``(s?(ua)+)?``, as the
grammar

    Conversation -> (empty) | Dialog        Opening -> (empty) | s
    Dialog -> Opening Pair | Dialog Pair    Pair -> u a

states.  The parser runs over the rows with a graph-structured stack: beside
shifting a row as it is, it may delete it, give it another role or insert a
turn, each at a cost.  Stack tops that are equal are merged, the one with the
least (cost, audit) stays; ``audit`` is the word of the edits' initials (K, R, D, I).

No conversation has to fit a task.  Rows are dealt by ranges of (conversation,
turn) and cut into chunks; each chunk is parsed from every stack top that may
come before it, in parallel, and the chunks of a conversation are folded in
order, a few letters a row.  Texts are shuffled once, to be streamed in order
past their conversation's audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
RENAME, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3  # costs; UNFINISHED is added to a truncated row that stays

#: LR states: nothing yet, after Opening, after u, after Dialog
START, OPENED, ASKED, DIALOG = 0, 1, 2, 3
ACCEPTING = (START, DIALOG)
#: the stack below each top, as far as a reduction can reach
STACKS = {START: (START,), OPENED: (START, OPENED), ASKED: (START, OPENED, ASKED), DIALOG: (START, DIALOG)}


def shift(stack: tuple[int, ...], initial: str) -> tuple[int, ...] | None:
    """The stack after ``initial`` was shifted and all reductions made; None
    where the grammar does not go on with it."""
    top = stack[-1]
    if initial == "s" and top == START:
        return (*stack, OPENED)  # Opening -> s
    if initial == "u":
        if top == START:
            stack, top = (*stack, OPENED), OPENED  # Opening -> (empty)
        return (*stack, ASKED) if top in (OPENED, DIALOG) else None
    if initial == "a" and top == ASKED:
        return (*stack[:-2], DIALOG)  # Pair -> u a, then Dialog -> Opening Pair or Dialog Pair
    return None


#: top -> initial -> top, from the reductions above
MOVES = {top: {c: nxt[-1] for c in "sua" if (nxt := shift(stack, c))} for top, stack in STACKS.items()}
MADE = ("u", "a")  # initials that renaming and inserting can give


def _offer(tops: dict, top: int, cost: int, audit: str) -> bool:
    """Merge a stack into ``tops``: the least (cost, audit) of a top stays."""
    old = tops.get(top)
    if old is None or (cost, audit) < old:
        tops[top] = (cost, audit)
        return True
    return False


def _with_inserts(tops: dict) -> dict:
    """``tops`` and all that inserted turns reach from them."""
    todo = list(tops)
    while todo:
        top = todo.pop()
        cost, audit = tops[top]
        for c in MADE:
            nxt = MOVES[top].get(c)
            if nxt is not None and _offer(tops, nxt, cost + INSERT, audit + "I") and nxt not in todo:
                todo.append(nxt)
    return tops


def parse(rows: list[tuple[str, bool, bool]], start: int = START) -> dict[int, tuple[int, str]]:
    """Least (cost, audit) for every stack top that repairs of ``rows`` lead to
    from the top ``start``.  A row is (initial, must be deleted, truncated).

    Stacks with equal tops read equal rests, and at one place two audits of
    equal cost are never a prefix of one another, so the least one stays least
    whatever follows."""
    tops = _with_inserts({start: (0, "")})
    for initial, delete, truncated in rows:
        after: dict = {}
        more = UNFINISHED if truncated else 0
        for top, (cost, audit) in tops.items():
            _offer(after, top, cost + DELETE, audit + "D")
            if delete:
                continue
            moves = MOVES[top]
            if initial in moves:
                _offer(after, moves[initial], cost + more, audit + "K")
            for c in MADE:
                if c in moves:
                    _offer(after, moves[c], cost + RENAME + more, audit + "R")
        tops = _with_inserts(after)
    return tops


def _standard(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text), nulls of the last two as one space, and the
    digest ``same`` of both."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    out = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return out.withColumn("same", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text; nulls count as one space) with faults
    by crc32(``conv_id:turn``) % 20: 0 drops the row, 1 empties its text, 2 takes
    ``.!?`` out of it, 3 repeats it, 4 makes its role user."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    out = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), kind.alias("kind"),
                      role.alias("role"), text.alias("text")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return out.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


ORDER = ("conv_id", "turn", "role", "same")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PIECE = ("conv_id long, pos long, whole boolean, blank long, duplicate long, truncated long, illegal long, head string, tail string, "
         "low long, high long, turns long, tops array<struct<start int, stop int, cost long, audit string>>")


def _placed(std: DataFrame) -> DataFrame:
    """Slim rows, written in the order of conversations and turns, with their place ``pos``."""
    bare = F.rtrim("text", F.lit(SPACE))
    slim = std.select(*ORDER, F.left("role", F.lit(1)).alias("initial"), (bare == "").alias("blank"),
                      (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"), F.monotonically_increasing_id().alias("row"))
    # equal rows may be dealt apart: the last key tells them apart
    ranged = slim.repartitionByRange(*ORDER, "row").sortWithinPartitions(*ORDER)
    return written(ranged.select("conv_id", "turn", "initial", "blank", "truncated", "same", F.monotonically_increasing_id().alias("pos")), "turns")


def pieces(placed: DataFrame, chunk_bits: int = 12) -> DataFrame:
    """The parsed pieces of all conversations: a conversation inside a chunk of
    ``2^chunk_bits`` rows is one ``whole`` piece, parsed from the start; others
    are cut at the chunks' ends and parsed from every stack top."""
    chunk = F.shiftright("pos", chunk_bits).alias("chunk")
    # a row is a duplicate unless it is the first of its conversation, role and text
    first = placed.groupBy("conv_id", "same").agg(F.min("pos").alias("pos")).select(chunk, "pos")
    rows = placed.select(chunk, "conv_id", "turn", "initial", "blank", "truncated", "pos")

    def run(own: pa.Table, firsts: pa.Table) -> pa.Table:
        own = own.sort_by("pos")
        pos = own.column("pos").to_numpy()
        blank = own.column("blank").to_numpy()
        again = ~np.isin(pos, firsts.column("pos").to_numpy()) & ~blank
        short = own.column("truncated").to_numpy() & ~blank & ~again
        conv, turn, initial = (own.column(c).to_pylist() for c in ("conv_id", "turn", "initial"))
        out, at = [], 0
        while at < len(conv):
            end = at
            while end < len(conv) and conv[end] == conv[at]:
                end += 1
            whole = at > 0 and end < len(conv)
            part = [(initial[i], bool(blank[i] or again[i]), bool(short[i])) for i in range(at, end)]
            known = [t for t in turn[at:end] if t is not None]
            tops = [(start, stop, cost, audit) for start in ([START] if whole else STACKS) for stop, (cost, audit) in parse(part, start).items()]
            out.append((conv[at], int(pos[at]), whole, int(blank[at:end].sum()), int(again[at:end].sum()), int(short[at:end].sum()),
                        sum(a[0] + b[0] not in LEGAL for a, b in zip(part, part[1:])), initial[at], initial[end - 1],
                        known[0] if known else None, known[-1] if known else None, len(set(known)), tops))
            at = end
        return pa.Table.from_pylist([dict(zip(_PIECE_NAMES, r)) for r in out], schema=_PIECE_ARROW)

    return rows.groupBy("chunk").cogroup(first.groupBy("chunk")).applyInArrow(run, PIECE)


LEGAL = ("su", "ua", "au")
_PIECE_NAMES = [c.split()[0] for c in PIECE.split(", tops")[0].split(", ")] + ["tops"]
_PIECE_ARROW = pa.schema([(n, pa.bool_() if n == "whole" else pa.string() if n in ("head", "tail") else pa.int64()) for n in _PIECE_NAMES[:-1]] + [
    ("tops", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])
SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Audit:
    """An audit in parts that share their beginnings."""

    __slots__ = ("before", "part")

    def __init__(self, before: "_Audit | None", part: str):
        self.before, self.part = before, part

    def parts(self, until: "_Audit | None" = None) -> str:
        out, at = [], self
        while at is not until:
            out.append(at.part)
            at = at.before
        return "".join(reversed(out))


def _less(a: tuple[int, _Audit], b: tuple[int, _Audit]) -> bool:
    """Whether (cost, audit) ``a`` is less; both have gone through as many pieces."""
    if a[0] != b[0]:
        return a[0] < b[0]
    x, y = a[1], b[1]
    while x is not y:
        x, y = x.before, y.before
    return a[1].parts(x) < b[1].parts(x)


def fold(found: Iterator[dict]) -> dict:
    """The summary of one conversation from its pieces in order."""
    total = dict.fromkeys(COUNTS, 0)
    tops: dict[int, tuple[int, _Audit]] = {START: (0, _Audit(None, ""))}
    tail = low = high = None
    turns = 0
    for p in found:
        for c in ("blank", "duplicate", "truncated", "illegal"):
            total[c] += p[c]
        if tail is not None and tail + p["head"] not in LEGAL:
            total["illegal"] += 1
        tail = p["tail"]
        if p["turns"]:
            low = p["low"] if low is None else low
            turns += p["turns"] - (p["low"] == high)
            high = p["high"]
        after: dict[int, tuple[int, _Audit]] = {}
        for move in p["tops"]:
            if move["start"] in tops:
                cost, audit = tops[move["start"]]
                new = (cost + move["cost"], _Audit(audit, move["audit"]))
                if move["stop"] not in after or _less(new, after[move["stop"]]):
                    after[move["stop"]] = new
        tops = after
    best = None
    for top in ACCEPTING:
        if top in tops and (best is None or _less(tops[top], best)):
            best = tops[top]
    total["cost"], total["audit"] = best[0], best[1].parts()
    if turns:
        total["gaps"] = min(high - low + 1 - turns, 2**63 - 1)
    return total


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _tabled(rows: Iterator[tuple], schema: pa.Schema, most: int = 2_000, size: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of ``most`` rows, or about ``size`` bytes of their strings."""
    held, held_size = [], 0
    for row in rows:
        held.append(row)
        held_size += sum(len(v) for v in row if isinstance(v, (str, bytes)))
        if len(held) >= most or held_size > size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)
            held, held_size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)


_SUMMARY_ARROW = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string())])


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for conv, found in groupby(_records(batches), key=lambda p: p["conv_id"]):
            total = fold(found)
            yield (conv, *[total[c] for c in COUNTS], total["audit"])

    return _tabled(rows(), _SUMMARY_ARROW)


def summaries(std: DataFrame, chunk_bits: int = 12) -> DataFrame:
    """gaps, faults, illegal neighbours, cost and audit of every conversation of ``std``."""
    found = written(pieces(_placed(std), chunk_bits), "pieces")
    cut = found.filter("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    return found.filter("whole").mapInArrow(_folded, SUMMARY).union(cut.mapInArrow(_folded, SUMMARY))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[tuple[bytes, bytes]]]]:
    """Per conversation its summary and its repaired (role, text), streamed."""

    def records():
        for batch in batches:
            for i, row in enumerate(zip(*(batch.column(k) for k in range(batch.num_columns - 2)))):
                yield row, batch.column(batch.num_columns - 2)[i], batch.column(batch.num_columns - 1)[i]

    def turns(audit: str, rest) -> Iterator[tuple[bytes, bytes]]:
        kept = len(audit) - audit.count("D")
        made = ((b"assistant", b"user") if kept % 2 else (b"user", b"assistant"))  # an odd number begins with s
        n = 0
        for edit in audit:
            role, text = b"", b""
            if edit != "I":
                _, role, text = next(rest)
                role, text = role.as_py(), text.as_py()
            if edit == "D":
                continue
            yield (role if edit == "K" else made[n % 2]), text
            n += 1

    for conv, rest in groupby(records(), key=lambda r: r[0][0].as_py()):
        summary = {"conv_id": conv, **dict.fromkeys(COUNTS, 0), "audit": ""}
        next(rest)  # every conversation has a row of kind 0, its summary is the next row if it has rows
        peeked = next(rest, None)
        if peeked is not None:
            summary.update({c: peeked[0][k + 2].as_py() for k, c in enumerate((*COUNTS, "audit"))})
        yield summary, turns(summary["audit"], rest)


def _stream(rows: DataFrame, std: DataFrame, chunk_bits: int) -> DataFrame:
    """Each conversation's id (kind 0), summary (kind 1) and rows (kind 2), in this order, in one partition."""
    none = lambda kind: F.lit(None).cast(kind)
    names = ["conv_id", "kind", *COUNTS, "audit", "turn", "same", "role", "text"]
    no_counts = [none("long").alias(c) for c in COUNTS] + [none("string").alias("audit")]
    ids = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select(
        "conv_id", F.lit(0).alias("kind"), *no_counts, none("long").alias("turn"), none("binary").alias("same"), none("binary").alias("role"), none("binary").alias("text"))
    told = summaries(std, chunk_bits).select("conv_id", F.lit(1).alias("kind"), *COUNTS, "audit", none("long").alias("turn"),
                                             none("binary").alias("same"), none("binary").alias("role"), none("binary").alias("text"))
    full = std.select("conv_id", F.lit(2).alias("kind"), *no_counts, "turn", "same", F.col("role").cast("binary"), F.col("text").cast("binary"))
    both = ids.select(names).union(told.select(names)).union(full.select(names))
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "same").select(
        "conv_id", "kind", *COUNTS, "audit", "role", "text")


def repaired(rows: DataFrame, chunk_bits: int = 12) -> DataFrame:
    """(conv_id, place, role, text): the repaired turns of all conversations of
    ``rows``, ``place`` from 1.

    Null roles and texts count as one space; null conv_ids are one conversation;
    null turns come first; rows of one turn are ordered by role and a digest of
    role and text, repeated rows are faults (duplicates); no rows give no rows;
    other columns are not looked at."""
    std = _standard(rows)

    def run(batches):
        out = ((s["conv_id"], n, role, text) for s, turns in _edited(batches) for n, (role, text) in enumerate(turns, 1))
        return _tabled(out, pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.binary()), ("text", pa.binary())]))

    out = _stream(rows, std, chunk_bits).mapInArrow(run, "conv_id long, place long, role binary, text binary")
    return out.select("conv_id", "place", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))


def repair_digests(original: DataFrame, rows: DataFrame, chunk_bits: int = 12) -> DataFrame:
    """Every conv_id of ``original`` with gaps, blank, duplicate, truncated,
    illegal, cost and audit of its conversation in ``rows``, and the SHA-256 of its
    repaired ``role:text`` lines.  Rules as in ``repaired``; a conversation
    without rows has zeros, an empty audit and the hash of nothing."""
    std = _standard(rows)

    def run(batches):
        def out():
            for s, turns in _edited(batches):
                digest = hashlib.sha256()
                for n, (role, text) in enumerate(turns):
                    digest.update((b"\n" if n else b"") + role + b":" + text)
                yield (s["conv_id"], *[s[c] for c in COUNTS], s["audit"], digest.hexdigest())

        return _tabled(out(), pa.schema([*_SUMMARY_ARROW, ("repaired_sha256", pa.string())]))

    return _stream(original, std, chunk_bits).mapInArrow(run, SUMMARY + ", repaired_sha256 string")
