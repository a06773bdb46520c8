import numpy as np

from tessera.session import shared_dir
from tessera.sources import idx as idx_src
from tessera.sources import csv as csv_src
from tessera.sources import text as text_src

from paths import SF


def test_idx_roundtrip(spark):
    rows = [([i % 256 for i in range(j, j + 64)], j % 10) for j in range(50)]
    df = spark.createDataFrame(rows, "pixels array<int>, label int").repartition(3)
    path = shared_dir(spark, "idx-test")
    assert idx_src.write_idx(df, path, chunk=7) == 50  # several parts a task
    back = idx_src.read_idx(spark, path, scale=False).toPandas()
    assert len(back) == 50
    got = sorted((int(l), tuple(int(v) for v in p)) for l, p in zip(back["label"], back["pixels"]))
    assert got == sorted((l, tuple(p)) for p, l in rows)


def test_idx_decode_rejects_other_files():
    import pytest

    with pytest.raises(ValueError):
        list(idx_src.records(b"\x00\x00\x00\x01junkjunk"))
    with pytest.raises(ValueError):
        list(idx_src.records(idx_src.encode_labels(np.array([1, 2, 3]))[:-1]))
    got = list(idx_src.records(idx_src.encode_labels(np.array([1, 2, 3])), chunk=2))
    assert [(first, v.tolist()) for first, v in got] == [(0, [1, 2]), (2, [3])]


def test_idx_parts_that_do_not_pair_raise(spark):
    import os

    import pytest

    path = shared_dir(spark, "idx-odd")
    local = path.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/a-images-idx3-ubyte", "wb") as f:
        f.write(idx_src.encode_images(np.zeros((2, 2, 2))))
    with open(f"{local}/a-labels-idx1-ubyte", "wb") as f:
        f.write(idx_src.encode_labels(np.array([1])))
    with pytest.raises(Exception, match="pair"):
        idx_src.read_idx(spark, path).collect()


def test_one_plain_file_is_many_tasks(spark):
    import os

    import pytest

    path = shared_dir(spark, "idx-ranges")
    local = path.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    rng = np.random.default_rng(0)
    imgs, labels = rng.integers(0, 256, (1000, 5, 3)), rng.integers(0, 10, 1000)
    for name, blob in (("images-idx3", idx_src.encode_images(imgs)), ("labels-idx1", idx_src.encode_labels(labels)), ("notes", b"other file")):
        with open(f"{local}/all-{name}-ubyte", "wb") as f:
            f.write(blob)
    spark.dataSource.register(idx_src.IdxSource)
    images = spark.read.format("idx").options(path=path, kind="images", recordsPerTask="128").load()
    assert images.rdd.getNumPartitions() == 8
    back = idx_src.read_idx(spark, path, scale=False, records_per_task=128).orderBy("idx").collect()
    assert [r.idx for r in back] == list(range(1000)) and [r.label for r in back] == labels.tolist()
    assert np.array_equal(np.array([r.pixels for r in back]), imgs.reshape(1000, 15))
    with open(f"{local}/cut-images-idx3-ubyte", "wb") as f:
        f.write(idx_src.encode_images(imgs)[:-1])
    with pytest.raises(Exception, match="last record"):
        idx_src.read_idx(spark, path).collect()


def test_semicolon_csv_roundtrip(spark):
    cust = spark.read.parquet(f"{SF}/customer.parquet")
    path = shared_dir(spark, "csv-test")
    csv_src.write_semicolon_csv(cust, path)
    raw = spark.read.text(path).first()[0]
    assert raw.startswith('"c_custkey";"c_name"')
    back = csv_src.read_semicolon_csv(spark, path, cust.schema)
    assert sorted(back.collect()) == sorted(cust.collect())


def test_text_rows(spark):
    df = spark.createDataFrame([("a,b",), ("c",)], "value string")
    path = shared_dir(spark, "text-test")
    text_src.write_text_rows(df, path)
    assert sorted(r[0] for r in text_src.read_text_rows(spark, path).collect()) == ["a,b", "c"]


def test_empty_table(spark):
    from tessera.operators import relational as R

    e = spark.read.parquet(f"{SF}/orders.parquet").filter("false")
    assert R.count_rows(e).first()[0] == 0
    assert R.count_per_group(e, "o_orderstatus").count() == 0


def test_materialize_checkpoint_cuts_lineage(spark):
    from tessera.session import materialize

    df = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey")
    c = materialize(df, "checkpoint")
    assert c.count() == df.count()
    assert "parquet" not in c._jdf.queryExecution().executedPlan().toString().lower()


def test_idx_reads_the_usual_file_names(spark):
    import gzip
    import os

    path = shared_dir(spark, "idx-names")
    local = path.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    imgs = np.arange(3 * 4 * 4, dtype=np.uint8).reshape(3, 4, 4)
    with open(f"{local}/train-images-idx3-ubyte.gz", "wb") as f:
        f.write(gzip.compress(idx_src.encode_images(imgs)))
    with open(f"{local}/train-labels-idx1-ubyte.gz", "wb") as f:
        f.write(gzip.compress(idx_src.encode_labels(np.array([7, 8, 9]))))
    with open(f"{local}/t10k-images-idx3-ubyte", "wb") as f:      # not compressed
        f.write(idx_src.encode_images(imgs[:1]))
    with open(f"{local}/t10k-labels-idx1-ubyte", "wb") as f:
        f.write(idx_src.encode_labels(np.array([4])))
    back = idx_src.read_idx(spark, path, scale=False).toPandas().sort_values(["file", "idx"])
    assert list(back["file"]) == ["t10k", "train", "train", "train"]
    assert list(back["label"]) == [4, 7, 8, 9]
    assert list(back["pixels"].iloc[2]) == list(imgs[1].ravel().astype(float))


def test_song_lines_take_the_part_before_a_tab(spark):
    from tessera.plans.relational import parse_song_lines

    df = spark.createDataFrame([("2001.7,0.5,1.5,2.5\tignored,9",)], "value string")
    r = parse_song_lines(df).first()
    assert (r.year, r.feat1, r.feat2, r.feat3) == (2001, 0.5, 1.5, 2.5)
