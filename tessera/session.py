"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "tessera", **conf: str) -> SparkSession:
    """Build (or reuse) a session for these jobs, with the package shipped to
    its workers.

    Master, cores, memory and shuffle partitions are the submitter's: they are
    only set if given (``conf`` keys with ``__`` for ``.``).  AQE stays on so
    shuffle partitions coalesce and skewed ones split at run time; the UI is
    off (no server is opened)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the session's Python workers, once a
    context, so that jobs run from any folder and on workers that don't have
    it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tessera-ship-")  # the driver's own; Spark copies the file from here
    archive = shutil.make_archive(os.path.join(folder, "tessera"), "zip", os.path.dirname(root), os.path.basename(root))
    sc.addPyFile(archive)
    sc._tessera_shipped = True


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    The context's own checkpoint dir if one was set, else
    ``spark.checkpoint.dir``; only when neither is set and the master is local (tests) a folder is
    made and registered, so later calls in the same session reuse it; on a
    cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)  # so DataFrame.checkpoint() uses it too
    if not root:
        if not sc.master.startswith("local"):
            # a driver-local folder is invisible to executors on a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        root = tempfile.mkdtemp(prefix="tessera-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for written tables."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tessera-{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str):
    """Read one of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder that was written below the shared folder, through the
    file system that Spark wrote it with."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)


def drop_at_exit(df, path: str):
    """``df``, which reads ``path``; the folder goes when the session ends, since
    ``df`` is read after this returns."""
    spark = df.sparkSession
    sc = spark.sparkContext
    held = getattr(sc, "_tessera_folders", None)
    if held is None:
        held = sc._tessera_folders = []
        stop = sc.stop

        def drop_and_stop(*args, **kwargs):
            for folder in held:
                drop_dir(spark, folder)
            held.clear()
            return stop(*args, **kwargs)

        sc.stop = drop_and_stop
    held.append(path)
    return df


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme and authority, as Spark resolves it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(conf).makeQualified(target).toString()


def materialize(df, mode: str = "persist"):
    """Keep rows that several jobs will read.

    ``persist`` (memory, spilling to disk) keeps the lineage: a lost
    executor's blocks are recomputed from the source, right when the
    lineage is a short scan-and-project.  ``checkpoint`` writes the rows to
    the shared checkpoint folder and cuts the lineage, for inputs behind a
    long or costly chain (never a machine-local checkpoint)."""
    from pyspark import StorageLevel

    if mode == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if mode == "checkpoint":
        checkpoint_root(df.sparkSession)
        return df.checkpoint(eager=True)
    raise ValueError(f"unknown mode {mode}")


def release(df) -> None:
    """Undo ``materialize(..., "persist")`` (checkpointed data stays with the
    checkpoint folder's lifecycle)."""
    df.unpersist()
