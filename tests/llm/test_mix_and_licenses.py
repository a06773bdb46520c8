"""Mixing and licences against their SQL."""

import re
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tessera.llm import licenses, mixing

SF001 = "/root/testdata/sf0.001"


def duck(sql, rows):
    con = duckdb.connect()
    con.register("rows", pd.DataFrame([r[:4] for r in rows], columns=["doc_id", "text", "lang", "source"]).astype({"doc_id": "Int64"}))
    con.execute("create view documents as select * from rows")
    return sorted(con.execute(sql).fetchall(), key=str)


@pytest.mark.parametrize("block", [32, 5])
def test_mix_matches_its_sql(edge, edge_rows, block):
    got = mixing.mix(edge, block=block).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(tuple, got), key=str) == duck(mixing.oracle(), edge_rows)


def test_mix_meets_its_targets(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = mixing.mix(docs).collect()
    assert all(r.taken <= 2 * r["size"] for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1
    total = sum(r["size"] for r in rows)
    assert abs(sum({r.source: r.target for r in rows}.values()) - 1.5 * total) < 1e-6 * total
    assert sorted(map(tuple, mixing.mix(docs.repartition(5)).collect())) == sorted(map(tuple, rows))


def test_capped_sources_leave_their_excess(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(10, "a"), (1000, "b"), (1000, "c"), (3, None)])]
    got = {r.source: r.target for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    left = 1.5 * 2013 - 26
    assert got["a"] == 20 and got[None] == 6
    assert got["b"] == pytest.approx(left * 2 / 3) and got["c"] == pytest.approx(left / 3)


def test_every_prefix_of_the_schedule_is_near_its_weights(spark):
    docs = spark.createDataFrame([(i, "w " * 640, "abc"[i % 3]) for i in range(90)], "doc_id long, text string, source string")
    rows = docs.select("doc_id", "source", mixing.source_key(F.col("source")).alias("key"), mixing.word_count(F.col("text")).alias("size"))
    targets = mixing.source_targets(rows)
    quota = {r.pos: r.quota for r in targets.collect()}
    slots = sorted(mixing.schedule(targets).collect(), key=lambda r: r.slot)
    seen, whole = dict.fromkeys(quota, 0), sum(quota.values())
    for n, r in enumerate(slots, 1):
        seen[r.pos] += 1
        if n % 50 == 0:
            assert all(abs(seen[p] - n * q / whole) < 6 for p, q in quota.items())
    assert all(seen[p] >= q for p, q in quota.items())


def test_mixed_documents_hold_the_words_taken(edge, empty, edge_rows):
    out = mixing.mixed_documents(edge)
    assert out.columns == edge.columns
    words = out.agg(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert words == mixing.mix(edge).agg(F.sum("taken")).first()[0]
    assert all(r.n_chars == len(r.text) for r in out.collect())
    assert mixing.mix(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []


def test_rows_of_one_id_and_size_keep_their_order(spark):
    rows = [(7, " ".join([w] * 10), lang, "a") for w in "qwertyuiop" for lang in ("x", "y")] + [(None, f"n{i} " * 10, "x", "a") for i in range(20)] + [(1, "z " * 900, "x", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("extra", F.create_map(F.lit("k"), F.col("lang")))
    one = lambda df: sorted((str(r.doc_id), r.text, r.lang) for r in mixing.mixed_documents(df, share=0.4).collect())
    first = one(docs.repartition(1))
    assert 0 < len(first) < 41
    for n in (3, 7):
        assert one(docs.repartition(n, F.rand(n))) == first
    got = sorted((str(r.doc_id), r.taken) for r in mixing.mix(docs, share=0.4).collect())
    assert got == sorted((str(a), b) for a, *_, b in duck(mixing.oracle(share=0.4), rows))


def test_no_python_in_the_mix(edge):
    plan = mixing.mix(edge)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_what_grows_with_the_words_is_not_broadcast(spark):
    """30,000 words are 938 blocks, which Spark takes for 2 rows of a small file."""
    docs = spark.createDataFrame([(1, "w " * 29_000, "a"), (2, "v " * 1_000, "a")], "doc_id long, text string, source string")
    rows = docs.select("doc_id", mixing.source_key(F.col("source")).alias("key"), mixing.word_count(F.col("text")).alias("size"), F.lit("").alias("tie"), F.lit(0).alias("other"))
    for df, keys in ((mixing.mix(docs), ("pos", "block")), (mixing.lines(rows), ("key", "bucket"))):
        assert len(df.collect()) == 2
        plan = df._jdf.queryExecution().executedPlan().toString()
        on = r"\[" + r"#\d+L?, ".join(keys) + r"#"
        assert re.search(f"SortMergeJoin {on}", plan) and not re.search(f"BroadcastHashJoin {on}", plan)


VARIANTS = [
    ("MIT", "Copyright (c) 2019 Some One\n\n" + licenses._MIT.upper()),
    ("MIT", "  MIT LICENCE\r\n// Copyright 1999-2020 A, B\n" + licenses._MIT.replace(". ", ".\n\n")),
    ("BSD-3-Clause", licenses._BSD_1 + licenses._BSD_3RD.replace("copyright holder", "copyright owner") + licenses._BSD_END),
    ("Apache-2.0", "LICENSED under the APACHE licence, version 2.0"),
    ("MIT", licenses._MIT.replace('"Software"', "\u201cSoftware\u201d").replace('"AS IS"', "\u201cAS IS\u201d").replace("and/or", "and\u2009/\u2009or")),
    ("MIT", licenses._MIT.replace(" of ", "\u00a0of ").replace(". ", " \u2014 ")),
    ("MIT", "MIT License\n\nCopyright The Kubernetes Authors\n\n" + licenses._MIT),
    ("MIT", " * Copyright Joyent, Inc. and other Node contributors.\n" + licenses._MIT),
    ("MIT", "Copyright: \u00c9mile Z\n(c) 2020 Y\n\u00a9 2021 Z\n" + licenses._MIT),
    ("BSD-3-Clause", "Copyright (c) 2011, X\nAll rights reserved.\n\n" + licenses._BSD_1.replace("above copyright", "above\n  copyright") + "\n" + licenses._BSD_3RD
     + licenses._BSD_END.replace("BY THE COPYRIGHT", "BY THE\nCOPYRIGHT")),
    ("BSD-2-Clause", "ALL RIGHTS RESERVED\n" + licenses._BSD_1.replace("1. ", "\u2022 1) ") + "\n" + licenses._BSD_END),
    ("Unlicense", licenses.KNOWN[-1][1].replace("https://unlicense.org", "http://unlicense.org/")),
    (None, "Copyright License"), (None, "All rights reserved."),
    (None, licenses._MIT.replace("free of charge", "free of \u00e7harge")),
    (None, licenses._MIT + " and more"), (None, "Copyright (c) 2020 X"), (None, ""), (None, None), (None, "license"),
]


def test_licences_in_other_guises(spark, empty):
    df = spark.createDataFrame([(i, t, "x", "y") for i, (_, t) in enumerate(VARIANTS)], "doc_id long, text string, license_id string, digest string")
    assert [r.license_id for r in licenses.scan(df).orderBy("doc_id").collect()] == [x for x, _ in VARIANTS]
    assert licenses.scan(empty).collect() == []


def test_whole_licences_match_their_digests(spark):
    folder = Path("/usr/share/common-licenses")
    files = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0"}
    texts = {name: (folder / f).read_text() for name, f in files.items() if (folder / f).exists()}
    if not texts:
        pytest.skip("no licence texts on this machine")
    end = "END OF TERMS AND CONDITIONS"
    rows = [(name, t) for name, t in texts.items()] + [(name, " ".join(t.split())) for name, t in texts.items() if name in ("MPL-2.0", "CC0-1.0")]
    rows += [(name, t[: t.index(end) + len(end)]) for name, t in texts.items() if end in t and name != "LGPL-3.0"]
    rows += [(None, t[:-300]) for t in texts.values()]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    assert [r.license_id for r in licenses.scan(df).orderBy("doc_id").collect()] == [name for name, _ in rows]


def test_licences_of_the_callers_table(spark):
    known = spark.createDataFrame([("Own-1", "Do as you like."), ("Own-0", "do as you LIKE"), ("Own-2", "Do not.")], "license_id string, body string")
    df = spark.createDataFrame([(1, "Do \u2014 as you like!"), (2, "do not"), (3, licenses._MIT)], "doc_id long, text string")
    got = licenses.scan(df, known, digests=()).orderBy("doc_id").collect()
    assert [r.license_id for r in got] == ["Own-0", "Own-2", None]


def test_licences_match_their_sql(edge, edge_rows, spark):
    rows = [*edge_rows, *[(900 + i, t, None, None) for i, (_, t) in enumerate(VARIANTS)]]
    df = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string")
    got = sorted(map(tuple, licenses.scan(df).collect()), key=str)
    assert got == duck(licenses.oracle(), rows)
