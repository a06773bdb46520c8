"""Text-row preparation, array/vector functions and per-row math
(embeddings as rows of numbers and as 8x8 images)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import vectors as V
from tessera.operators import conv
from tessera.operators import relational as R
from tessera.operators import stages as S
from tessera.operators.networks import score_rows
from tessera.operators.regression import with_prediction
from tessera.plans import inputs as I
from tessera.plans import weights as W
from tessera.plans.registry import register
from tessera.session import table

X_SQL = "list_transform(embedding, lambda v: CAST(v AS DOUBLE))"
EMB = f"(SELECT vec_id, CAST(label AS DOUBLE) AS label, label AS ilabel, {X_SQL} AS x FROM embeddings) e"


def _rows(spark, sf_dir, dims=None):
    return I.embedding_rows(spark, sf_dir, dims)


def _vectors(spark, sf_dir):
    """Text rows -> tokens -> doubles (label first)."""
    lines = I.embedding_lines(spark, sf_dir)
    return lines.select("vec_id", T.parse_doubles(T.regex_tokenize("value", ",")).alias("vector"))


def _r(col_sql: str, digits: int = 6) -> str:
    return f"round({col_sql}, {digits}) + 0.0"


def _rl(list_sql: str, digits: int = 6) -> str:
    return f"list_transform({list_sql}, lambda q: round(q, {digits}) + 0.0)"


# -- P2: pick fields by position and cast, label truncated --------------------

@register("cast_fields", """
  SELECT vec_id, label, embedding[1] AS feat1, embedding[2] AS feat2, embedding[3] AS feat3
  FROM embeddings""")
def cast_fields(spark, sf_dir):
    f = T.split_fields("value", ",")
    return I.embedding_lines(spark, sf_dir).select("vec_id", f.alias("f")).select(
        "vec_id", T.truncate_to_int(F.col("f")[0]).alias("label"),
        *[F.col("f")[i].cast("float").alias(f"feat{i}") for i in (1, 2, 3)])


# -- P5 + P6: tokens -> vector of doubles -----------------------------------------

@register("array_to_vector", f"""
  SELECT vec_id, list_concat([CAST(label AS DOUBLE)], {X_SQL}) AS vector FROM embeddings""")
def array_to_vector(spark, sf_dir):
    return _vectors(spark, sf_dir)


# -- P7: slice positions ------------------------------------------------------------

@register("vector_slice", f"""
  SELECT vec_id, [CAST(label AS DOUBLE)] AS year,
         list_transform(embedding[1:3], lambda v: CAST(v AS DOUBLE)) AS features
  FROM embeddings""")
def vector_slice(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    return v.select("vec_id", V.slice_positions("vector", [0]).alias("year"),
                    V.slice_positions("vector", [1, 2, 3]).alias("features"))


# -- P8: first element as double ------------------------------------------------

@register("vector_first", "SELECT vec_id, CAST(label AS DOUBLE) AS first FROM embeddings")
def vector_first(spark, sf_dir):
    return _vectors(spark, sf_dir).select("vec_id", F.col("vector")[0].alias("first"))


# -- P9: degree-2 polynomial expansion (MLlib order) ----------------------------

@register("poly_expand", f"""
  SELECT vec_id, flatten(list_transform(range(len(x)), lambda k: list_concat([x[k + 1]],
           list_transform(range(k + 1), lambda i: x[i + 1] * x[k + 1])))) AS poly FROM {EMB}""")
def poly_expand(spark, sf_dir):
    return _rows(spark, sf_dir).select("vec_id", V.poly_expand_2("x").alias("poly"))


# -- P10 (+U3 over all rows): label and features only --------------------------

@register("label_features", f"""
  SELECT CAST(label AS DOUBLE) - min(CAST(label AS DOUBLE)) OVER () AS label,
         {X_SQL} AS features
  FROM embeddings""")
def label_features(spark, sf_dir):
    """The shift is fitted on the parsed label alone (its scan reads no
    features) and applied in the one pass that parses the rows."""
    v = _vectors(spark, sf_dir)
    labels = I.embedding_lines(spark, sf_dir, 0).select(T.parse_doubles(T.regex_tokenize("value", ","))[0].alias("double"))
    shift = S.LabelShift(inputCol="double", outputCol="label").fit(labels)
    rows = v.select(F.col("vector")[0].alias("double"), F.slice("vector", 2, F.size("vector") - 1).alias("features"))
    return shift.transform(rows).select("label", "features")


# -- P11: feature width checked over all rows ------------------------------------

@register("feature_count", """
  SELECT CAST(min(len(embedding)) AS INTEGER) AS min_features,
         CAST(max(len(embedding)) AS INTEGER) AS max_features FROM embeddings""")
def feature_count(spark, sf_dir):
    tok = T.regex_tokenize("value", ",")
    w = I.embedding_lines(spark, sf_dir).select((F.size(tok) - 1).alias("w"))
    return w.agg(F.min("w").alias("min_features"), F.max("w").alias("max_features"))


# -- P12: flat 64 -> 8 rows of 8 (no shuffle: slices of the array) ---------------

@register("grid_reshape", f"""
  SELECT vec_id, CAST(r AS INTEGER) AS r, x[r * 8 + 1 : r * 8 + 8] AS grid_row
  FROM {EMB}, range(8) t(r)""")
def grid_reshape(spark, sf_dir):
    return conv.grid_rows(_rows(spark, sf_dir), "vec_id", "x", 8).withColumnRenamed("id", "vec_id")


@register("grid_flatten", f"SELECT vec_id, x AS flat FROM {EMB}")
def grid_flatten(spark, sf_dir):
    """Grid lines back to flat rows (one group an image: its lines)."""
    lines = grid_reshape(spark, sf_dir).withColumnRenamed("vec_id", "id")
    return conv.grid_flatten(lines).withColumnRenamed("id", "vec_id")


# -- P13: 0..1 floats to 0..255 integers -------------------------------------------

@register("pixels_to_bytes", """
  SELECT vec_id, list_transform(embedding,
           lambda v: CAST(floor(abs(CAST(v AS DOUBLE)) * 255) AS SMALLINT)) AS pixels
  FROM embeddings""")
def pixels_to_bytes(spark, sf_dir):
    r = _rows(spark, sf_dir)
    return r.select("vec_id", F.transform("x", lambda v: F.floor(F.abs(v) * 255).cast("short"))
                    .alias("pixels"))


# -- P14: one-hot encode / decode -----------------------------------------------------

@register("one_hot_labels", """
  SELECT vec_id, list_transform(range(10), lambda k: CAST(k = label AS DOUBLE)) AS one_hot,
         label AS decoded FROM embeddings""")
def one_hot_labels(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", V.one_hot("label").alias("one_hot"))
    return e.select("vec_id", "one_hot", V.one_hot_decode("one_hot").alias("decoded"))


# -- A6: minimum carried to every row (no driver round trip) ----------------------

@register("min_label", """
  SELECT vec_id, label, min(label) OVER () AS min_label, label - min(label) OVER () AS shifted
  FROM embeddings""")
def min_label(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    m = R.with_min_of(e, "label", alias="min_label", source=e.select("label"))
    return m.select("vec_id", "label", "min_label", (F.col("label") - F.col("min_label")).alias("shifted"))


# -- A7: row count and width in one pass --------------------------------------------

@register("row_and_width", """
  SELECT count(*) AS n, CAST(max(len(embedding)) AS INTEGER) AS d,
         CAST(min(len(embedding)) AS INTEGER) AS d_min FROM embeddings""")
def row_and_width(spark, sf_dir):
    r = _rows(spark, sf_dir)
    return r.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d"),
                 F.min(F.size("x")).alias("d_min"))


# -- A8: element-wise vector sum per label ------------------------------------------

@register("vector_sum", f"""
  SELECT label, CAST(i AS INTEGER) AS i, {_r('sum(v)')} AS total
  FROM (SELECT ilabel AS label, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS i FROM {EMB}) t
  GROUP BY label, i""")
def vector_sum(spark, sf_dir):
    r = _rows(spark, sf_dir).select(F.col("label").cast("int").alias("label"), "x")
    s = R.vector_sum_long(r, ["label"], "x")
    return s.select("label", "i", (F.round("total", 6) + F.lit(0.0)).alias("total"))


# -- V1-V4 ------------------------------------------------------------------------------

@register("vec_dot", f"SELECT vec_id, {_r('list_dot_product(x, x)')} AS dot FROM {EMB}")
def vec_dot(spark, sf_dir):
    r = _rows(spark, sf_dir)
    return r.select("vec_id", (F.round(V.dot("x", "x"), 6) + F.lit(0.0)).alias("dot"))


@register("vec_scale", f"SELECT vec_id, list_transform(x, lambda v: v * 2.5) AS scaled FROM {EMB}")
def vec_scale(spark, sf_dir):
    return _rows(spark, sf_dir).select("vec_id", V.scale("x", 2.5).alias("scaled"))


@register("vec_add", f"""
  SELECT vec_id, list_transform(generate_series(1, len(x)), lambda i: x[i] + x[len(x) + 1 - i]) AS added
  FROM {EMB}""")
def vec_add(spark, sf_dir):
    return _rows(spark, sf_dir).select("vec_id", V.add("x", F.reverse("x")).alias("added"))


@register("vec_fill", f"SELECT vec_id, list_transform(x, lambda v: CAST(0.5 AS DOUBLE)) AS filled FROM {EMB}")
def vec_fill(spark, sf_dir):
    return _rows(spark, sf_dir).select("vec_id", V.fill(F.size("x"), 0.5).alias("filled"))


# -- V5/V6: (label, prediction) with fixed weights; V7: per-row gradient ------------

D_LIN = 64
W_LIN_SQL = f"list_transform(range({D_LIN}), lambda j: {W.linear_weights_sql('j')})"


@register("predict_linear", f"""
  SELECT vec_id, label, {_r(f'list_dot_product(x, {W_LIN_SQL})')} AS prediction
  FROM {EMB}""")
def predict_linear(spark, sf_dir):
    p = with_prediction(_rows(spark, sf_dir), W.linear_weights(D_LIN), "x")
    return p.select("vec_id", "label", (F.round("prediction", 6) + F.lit(0.0)).alias("prediction"))


@register("grad_rows", f"""
  SELECT vec_id, list_transform(x, lambda v: round(v * r, 6) + 0.0) AS grad
  FROM (SELECT vec_id, x, list_dot_product(x, {W_LIN_SQL}) - label AS r FROM {EMB}) t""")
def grad_rows(spark, sf_dir):
    p = with_prediction(_rows(spark, sf_dir), W.linear_weights(D_LIN), "x")
    g = V.scale("x", F.col("prediction") - F.col("label"))
    return p.select("vec_id", V.round_array(g).alias("grad"))


# -- V8/V10 + C1-style scores with fixed class weights --------------------------------

D_IMG = 64
SCORES_SQL = (f"list_transform(range(10), lambda k: list_dot_product(x, list_transform(range({D_IMG}), "
              f"lambda j: {W.class_weights_sql('j', 'k')})) + {W.class_bias_sql('k')})")
SOFTMAX_SQL = ("list_transform(z, lambda v: exp(v - list_max(z)) / "
               "list_sum(list_transform(z, lambda u: exp(u - list_max(z)))))")


def class_score_rows(spark, sf_dir):
    """Class scores ``z`` per row: a matmul per Arrow batch."""
    return score_rows(_rows(spark, sf_dir), [(W.class_weights(D_IMG), W.class_bias())], digits=None, out="z")


@register("softmax_rows", f"""
  SELECT vec_id, {_rl(SOFTMAX_SQL)} AS probs
  FROM (SELECT vec_id, {SCORES_SQL} AS z FROM {EMB}) s""")
def softmax_rows(spark, sf_dir):
    return class_score_rows(spark, sf_dir).select("vec_id", V.round_array(V.softmax("z")).alias("probs"))


@register("argmax_label", f"""
  SELECT vec_id, CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS pred
  FROM (SELECT vec_id, {SCORES_SQL} AS z FROM {EMB}) s""")
def argmax_label(spark, sf_dir):
    return class_score_rows(spark, sf_dir).select("vec_id", V.argmax("z").alias("pred"))


# -- V9: activations ------------------------------------------------------------------

@register("activations", f"""
  SELECT vec_id,
         {_rl('list_transform(z, lambda v: greatest(v, 0.0))')} AS relu,
         {_rl('list_transform(z, lambda v: 1.0 / (1.0 + exp(-v)))')} AS sigmoid
  FROM (SELECT vec_id, list_transform(x, lambda v: v * 8.0 - 0.25) AS z FROM {EMB}) s""")
def activations(spark, sf_dir):
    r = _rows(spark, sf_dir).select("vec_id", F.transform("x", lambda v: v * 8.0 - 0.25).alias("z"))
    return r.select("vec_id", V.round_array(V.relu("z")).alias("relu"),
                    V.round_array(V.sigmoid("z")).alias("sigmoid"))
