"""Conversation repair against a search over all edits and a plain program."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tessera.llm import convrepair as C
from tessera.llm.queries import QUERIES

from paths import SF

WELL = re.compile(r"(s?(ua)+)?")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def same(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def plain_repair(rows):
    """Dynamic programme over (rows read, letters given), no parser: letter n of
    a word of known length is fixed by the length."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), same(r[2], r[3])))
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    best = None
    for length in range(0, 2 * len(rows) + 4):
        word = "ua" * (length // 2) if length % 2 == 0 else "s" + "ua" * (length // 2)
        if not WELL.fullmatch(word) or word == "s":
            continue
        at = {0: (0, "")}  # letters given -> (cost, audit), after some rows
        def inserted(at):
            for k in range(length):
                if k in at and word[k] in "ua":
                    c, a = at[k]
                    if k + 1 not in at or (c + 3, a + "I") < at[k + 1]:
                        at[k + 1] = (c + 3, a + "I")
            return at
        at = inserted(at)
        for (_, _, role, _), fault in zip(rows, faults):
            nxt = {}
            for k, (c, a) in at.items():
                ways = [(k, c + 4, a + "D")]
                more = 3 if fault == "truncated" else 0
                if fault not in ("blank", "duplicate") and k < length:
                    if role[:1] == word[k]:
                        ways.append((k + 1, c + more, a + "K"))
                    if word[k] in "ua":
                        ways.append((k + 1, c + 3 + more, a + "R"))
                for j, cost, audit in ways:
                    if j not in nxt or (cost, audit) < nxt[j]:
                        nxt[j] = (cost, audit)
            at = inserted(nxt)
        if length in at and (best is None or at[length] < best[:2]):
            best = (*at[length], word)
    cost, audit, word = best
    out, it, n = [], iter(rows), 0
    for edit in audit:
        row = next(it) if edit != "I" else None
        if edit == "D":
            continue
        out.append((row[2] if edit == "K" else {"u": "user", "a": "assistant"}[word[n]], row[3] if row else ""))
        n += 1
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    return dict(gaps=max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
                illegal=sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost=cost, audit=audit,
                repaired_sha256=hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()), out


def check(got, original, rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    got = {r["conv_id"]: r.asDict() for r in got}
    assert set(got) == {r[0] for r in original}
    for conv in got:
        want, _ = plain_repair(groups[conv])
        assert got[conv] == {"conv_id": conv, **want}, conv


def edge_rows():
    rng = random.Random(3)
    rows = [(1, None, "user", "Hi."), (1, None, "assistant", "Yes."), (2, 5, None, "x."), (2, 6, "user", None), (3, 0, "", "No!"), (3, 0, "user", "A?"),
            (3, 0, "user", "A?"), (None, 1, "user", "Null."), (None, 3, "assistant", "Gap."), (4, 2**62, "system", "Only."), (5, -5, "user", " \t\n"),
            (6, 0, "user", "long. " * 50_000), (6, 1, "ünder", "é."), (None, None, None, None)]
    rows += [(7, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "c!", "", "d?"]) + str(rng.randint(0, 3)) * rng.randint(0, 1)) for t in range(40)]
    for conv in range(10, 60):
        rows += [(conv, t, rng.choice(["user", "assistant", "user", "assistant", "system"]), rng.choice(["Yes.", "No", "So!", "x y z?", "q"]) + ("" if rng.random() < .5 else f" {t}.")) for t in range(rng.randint(1, 9))]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, cost string, kind string, audit int"


@pytest.mark.parametrize("bits", [12, 1, 0])
def test_against_a_plain_programme(spark, bits):
    rows = edge_rows()
    df = spark.createDataFrame([(*r, "c", "k", 0) for r in rows], SCHEMA).repartition(3)
    check(C.repair_digests(df, C.damaged(df), bits).collect(), rows, plain_damage(rows))
    # as they are, without damage
    std = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    check(C.repair_digests(df, df, bits).collect(), rows, std)


def test_repaired_turns(spark):
    rows = edge_rows()
    df = spark.createDataFrame([(*r, "c", "k", 0) for r in rows], SCHEMA)
    got = defaultdict(list)
    for r in sorted(C.repaired(df, 2).collect(), key=lambda r: r["place"]):
        got[r["conv_id"]].append((r["role"], r["text"]))
    groups = defaultdict(list)
    for c, t, r, x in rows:
        groups[c].append((c, t, " " if r is None else r, " " if x is None else x))
    for conv, own in groups.items():
        _, want = plain_repair(own)
        assert got[conv] == want
        assert WELL.fullmatch("".join(r[:1] for r, _ in want))


def test_long_conversation_over_many_chunks(spark):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"{rng.randint(0, 200)}{rng.choice('.?x')}") for t in range(90)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    check(C.repair_digests(df, df, 3).collect(), rows, rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert C.repair_digests(df, C.damaged(df)).collect() == [] and C.repaired(df).collect() == []


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(QUERIES["op13_conversation_repair"](spark, SF).collect(), rows, plain_damage(rows))
