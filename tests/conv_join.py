"""The join form of a SAME convolution, as an independent check of the kernel."""

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tessera.operators.conv import same_geometry


def pixels_long(rows: DataFrame, key: str, vec: str, h: int, w: int, ch: int = 1) -> DataFrame:
    """Flat row-major ``h x w x ch`` arrays to ``(id, y, x, ci, v)`` rows."""
    e = rows.select(F.col(key).alias("id"), F.posexplode(vec).alias("pos", "v"))
    return e.select("id", (F.col("pos") / (w * ch)).cast("int").alias("y"),
                    (F.pmod(F.floor(F.col("pos") / ch), F.lit(w))).cast("int").alias("x"),
                    F.pmod(F.col("pos"), F.lit(ch)).cast("int").alias("ci"), "v")


def kernel_table(spark: SparkSession, W: np.ndarray) -> DataFrame:
    """``W`` of shape (k, k, ci, co) as ``(ky, kx, ci, co, w)`` rows."""
    k1, k2, ci, co = W.shape
    rows = [(a, b, c, d, float(W[a, b, c, d]))
            for a in range(k1) for b in range(k2) for c in range(ci) for d in range(co)]
    return spark.createDataFrame(rows, "ky int, kx int, ci int, co int, w double")


def conv2d_join(pixels: DataFrame, kernel: DataFrame, h: int, w: int, k: int, stride: int,
                bias: np.ndarray | None = None, relu: bool = False) -> DataFrame:
    """SAME convolution as a broadcast join + grouped sum:
    ``(id, oy, ox, co, value)``."""
    oh, pt = same_geometry(h, k, stride)
    ow, pl = same_geometry(w, k, stride)
    # A tap (ky, kx) reaches an output only when y + pad - ky is a multiple
    # of the stride: joining on the residues keeps 1/stride^2 of the pairs
    # instead of filtering them after the join.
    px = pixels.withColumn("ry", F.pmod(F.col("y") + F.lit(pt), F.lit(stride))) \
        .withColumn("rx", F.pmod(F.col("x") + F.lit(pl), F.lit(stride)))
    kr = kernel.withColumn("ry", F.pmod("ky", F.lit(stride))).withColumn("rx", F.pmod("kx", F.lit(stride)))
    j = px.join(F.broadcast(kr), ["ci", "ry", "rx"])
    ny = F.col("y") - F.col("ky") + F.lit(pt)
    nx = F.col("x") - F.col("kx") + F.lit(pl)
    j = j.select("id", "co", ny.alias("ny"), nx.alias("nx"), (F.col("v") * F.col("w")).alias("vw"))
    j = j.filter((F.col("ny") >= 0) & (F.col("nx") >= 0)
                 & (F.col("ny") < oh * stride) & (F.col("nx") < ow * stride))
    out = j.groupBy("id", (F.col("ny") / stride).cast("int").alias("oy"),
                    (F.col("nx") / stride).cast("int").alias("ox"), "co") \
        .agg(F.sum("vw").alias("value"))
    if bias is not None:
        b = F.element_at(F.array(*[F.lit(float(v)) for v in bias]), F.col("co") + 1)
        out = out.withColumn("value", F.col("value") + b)
    if relu:
        out = out.withColumn("value", F.greatest(F.col("value"), F.lit(0.0)))
    return out


def as_pixels(conv_out: DataFrame) -> DataFrame:
    """A layer's ``(id, oy, ox, co, value)`` output as the next layer's
    ``(id, y, x, ci, v)`` input, so join-form layers chain."""
    return conv_out.select("id", F.col("oy").alias("y"), F.col("ox").alias("x"),
                           F.col("co").alias("ci"), F.col("value").alias("v"))
