"""Clustering and image-pixel queries.

Feature vectors are ``embeddings.embedding`` (64 floats).  The image job runs
on a pixel table that Spark derives from ``embeddings``: one image per label,
one image row per vector (in vec_id order), one pixel per vector component,
R = clamp(floor((v + 4) * 32), 0, 255), G = 255 - R, B = 4 * x.  (The image
*file* decoder, Spark's ``image`` source, is covered by the unit tests, since
the driver tables contain no image files.)
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidepool.functions.numbers import round_half_up
from tidepool.operators import clustering as C
from tidepool.operators import images as I
from tidepool.operators.shape import feature_columns
from tidepool.operators.windows import row_number_by_key
from tidepool.plans.registry import register
from tidepool.session import read_table, scratch_path
from tidepool.sinks.tables import write_path
from tidepool.sources.files import read_csv_typed

K_VALUES = list(range(2, 17))


def _features(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return C.array_features(e, "embedding")


# --------------------------------------------------------------------------
# features and scaling
# --------------------------------------------------------------------------


@register("ml_assemble", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n_features FROM embeddings")
def ml_assemble(spark, sf):
    e = read_table(spark, sf, "embeddings")
    wide = e.select("vec_id", *[F.get("embedding", i).alias(f"x{i}") for i in range(64)])
    path = scratch_path(spark, "features_csv")
    write_path(wide, path, fmt="csv", options={"header": "true", "sep": ";"})
    data = read_csv_typed(spark, path, sep=";")  # inferred types, ';' separated
    v = C.assemble(data, feature_columns(data))
    return v.select("vec_id", F.size(vector_to_array("features")).alias("n_features"))


@register(
    "ml_standard_scale",
    """
    WITH x AS (
      SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
             CAST(unnest(embedding) AS DOUBLE) AS v
      FROM embeddings)
    SELECT vec_id, pos,
           CAST(ROUND(CAST(CAST(v / stddev_samp(v) OVER (PARTITION BY pos) AS VARCHAR) AS DECIMAL(38,17)), 4) AS DOUBLE) AS scaled
    FROM x
    """,
)
def ml_standard_scale(spark, sf):
    s = C.standard_scale(_features(spark, sf))
    return s.select("vec_id", F.posexplode(vector_to_array("scaled_features")).alias("pos", "scaled")).select(
        "vec_id", "pos", round_half_up("scaled", 4).alias("scaled")
    )


@register(
    "ml_wcss_by_label",
    """
    WITH x AS (
      SELECT label, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v
      FROM embeddings),
    m AS (SELECT label, pos, AVG(v) AS mu FROM x GROUP BY label, pos)
    SELECT x.label, CAST(ROUND(CAST(CAST(SUM((x.v - m.mu) * (x.v - m.mu)) AS VARCHAR) AS DECIMAL(38,17)), 3) AS DOUBLE) AS wcss
    FROM x JOIN m ON x.label = m.label AND x.pos = m.pos
    GROUP BY x.label
    """,
)
def ml_wcss_by_label(spark, sf):
    w = C.wcss_by_label(read_table(spark, sf, "embeddings"), "embedding", "label")
    return w.select("label", round_half_up("wcss", 3).alias("wcss"))


# --------------------------------------------------------------------------
# KMeans
# --------------------------------------------------------------------------


@register("ml_kmeans")
def ml_kmeans(spark, sf):
    _, pred = C.kmeans(_features(spark, sf), k=5, seed=0)
    return pred.select("vec_id", "label", "prediction")


@register("ml_cluster_centers")
def ml_cluster_centers(spark, sf):
    model = C.fit_kmeans(_features(spark, sf), k=5, seed=0)
    return C.centers(spark, model)


@register("ml_silhouette")
def ml_silhouette(spark, sf):
    _, pred = C.kmeans(_features(spark, sf), k=5, seed=0)
    clusters = pred.drop("embedding").withColumnRenamed("prediction", "cluster")
    return C.metric_table(spark, "Silhouette Score", round(C.silhouette(clusters, prediction_col="cluster"), 2))


@register("ml_k_sweep")
def ml_k_sweep(spark, sf):
    return C.k_sweep(spark, _features(spark, sf), K_VALUES, seed=0)


@register("ml_elbow_point")
def ml_elbow_point(spark, sf):
    return C.elbow_point(C.k_sweep(spark, _features(spark, sf), K_VALUES, seed=0))


@register(
    "ml_kmeans_check",
    "SELECT COUNT(*) AS n_points, CAST(0 AS BIGINT) AS n_misplaced, true AS cost_ok FROM embeddings",
)
def ml_kmeans_check(spark, sf):
    data = _features(spark, sf)
    return C.check_assignment(data, C.fit_kmeans(data, k=5, seed=0))


@register(
    "ml_silhouette_by_label",
    """
    WITH x AS (
      SELECT vec_id, label, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v
      FROM embeddings),
    n AS (SELECT vec_id, label, SUM(v * v) AS sq FROM x GROUP BY vec_id, label),
    c AS (SELECT label, COUNT(*) AS n, SUM(sq) AS sq FROM n GROUP BY label),
    s AS (SELECT label, pos, SUM(v) AS v FROM x GROUP BY label, pos),
    p AS (SELECT x.vec_id, x.label, s.label AS other, SUM(x.v * s.v) AS prod
          FROM x JOIN s ON s.pos = x.pos GROUP BY x.vec_id, x.label, s.label),
    m AS (SELECT p.vec_id, p.label = p.other AS own, c.n, n.sq + (c.sq - 2 * p.prod) / c.n AS mean_sq
          FROM p JOIN c ON c.label = p.other JOIN n ON n.vec_id = p.vec_id),
    ab AS (SELECT vec_id, MAX(CASE WHEN own THEN n END) AS n, MIN(CASE WHEN NOT own THEN mean_sq END) AS b,
                  MAX(CASE WHEN own THEN mean_sq * n / NULLIF(n - 1, 0) END) AS a
           FROM m GROUP BY vec_id),
    f AS (SELECT AVG(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END) AS score FROM ab)
    SELECT 'Silhouette Score' AS metric, CAST(ROUND(CAST(CAST(score AS VARCHAR) AS DECIMAL(38,17)), 2) AS DOUBLE) AS value
    FROM f
    """,
)
def ml_silhouette_by_label(spark, sf):
    by_label = _features(spark, sf).withColumn("cluster", F.col("label").cast("double"))
    return C.metric_table(spark, "Silhouette Score", round(C.silhouette(by_label, prediction_col="cluster"), 2))


@register(
    "ml_elbow_by_label",
    """
    WITH x AS (
      SELECT label, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v
      FROM embeddings),
    w AS (SELECT label AS k, SUM(dev) AS wcss
          FROM (SELECT label, pos, var_pop(v) * COUNT(v) AS dev FROM x GROUP BY label, pos) GROUP BY label),
    e AS (SELECT MIN(k) AS k1, MAX(k) AS k2, arg_min(wcss, k) AS w1, arg_max(wcss, k) AS w2 FROM w),
    g AS (SELECT k, abs(w1 + (w2 - w1) * (k - k1) / (k2 - k1) - wcss) AS gap FROM w, e)
    SELECT k AS optimal_k FROM g ORDER BY gap DESC, k LIMIT 1
    """,
)
def ml_elbow_by_label(spark, sf):
    curve = C.wcss_by_label(read_table(spark, sf, "embeddings"), "embedding", "label")
    return C.elbow_point(curve, k_col="label")


# --------------------------------------------------------------------------
# image pixels
# --------------------------------------------------------------------------


def embedding_images(spark, sf):
    """``image`` rows as Spark's image source gives them, one per vector: 8 rows
    of 8 pixels, with 1, 3 or 4 channels by ``vec_id``; every fourth is unreadable."""
    e = read_table(spark, sf, "embeddings")
    kind = F.pmod("vec_id", F.lit(4))
    channels = F.when(kind == 0, 1).when(kind == 1, 3).when(kind == 2, 4).otherwise(-1)
    value = lambda v: F.least(F.greatest(F.floor((v.cast("double") + 4) * 32), F.lit(0)), F.lit(255)).cast("int")
    two = lambda v: F.lpad(F.hex(v), 2, "0")

    def pixel(v, i):
        grey, bgr = two(value(v)), F.concat(two(value(v)), two(255 - value(v)), two(i))
        return F.when(kind == 0, grey).when(kind == 1, bgr).when(kind == 2, F.concat(bgr, F.lit("FF"))).otherwise("")

    size = F.when(channels > 0, 8).otherwise(-1)
    return e.select(F.struct(
        F.concat(F.lit("vec-"), F.col("vec_id").cast("string")).alias("origin"), size.alias("height"),
        size.alias("width"), channels.alias("nChannels"), F.lit(16).alias("mode"),
        F.unhex(F.array_join(F.transform("embedding", pixel), "")).alias("data"),
    ).alias("image"))


@register(
    "img_decode",
    """
    WITH x AS (
      SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS i, CAST(unnest(embedding) AS DOUBLE) AS v
      FROM embeddings WHERE vec_id % 4 <> 3),
    p AS (SELECT vec_id, i, CAST(least(greatest(floor((v + 4) * 32), 0), 255) AS INTEGER) AS b FROM x)
    SELECT 'vec-' || CAST(vec_id AS VARCHAR) AS origin, CAST(i // 8 AS INTEGER) AS y, CAST(i % 8 AS INTEGER) AS x,
           CASE WHEN vec_id % 4 = 0 THEN b ELSE i END AS r, CASE WHEN vec_id % 4 = 0 THEN b ELSE 255 - b END AS g, b
    FROM p
    """,
)
def img_decode(spark, sf):
    return I.image_pixels(embedding_images(spark, sf))


@register(
    "img_rejects",
    "SELECT 'vec-' || CAST(vec_id AS VARCHAR) AS origin, -1 AS n_channels FROM embeddings WHERE vec_id % 4 = 3",
)
def img_rejects(spark, sf):
    return I.image_rejects(embedding_images(spark, sf))


def embedding_pixels(spark, sf):
    """Pixel table ``(origin, y, x, r, g, b)`` derived from ``embeddings``."""
    e = read_table(spark, sf, "embeddings")
    e = row_number_by_key(e, "label", ["vec_id"], out="_rn")
    px = e.select(
        F.concat(F.lit("embeddings/label-"), F.col("label").cast("string")).alias("origin"),
        (F.col("_rn") - 1).cast("int").alias("y"),
        F.posexplode("embedding").alias("x", "v"),
    )
    r = F.least(F.greatest(F.floor((F.col("v").cast("double") + 4) * 32), F.lit(0)), F.lit(255)).cast("int")
    return px.select("origin", "y", "x", r.alias("r"), (255 - r).alias("g"), (F.col("x") * 4).alias("b"))


_PIXELS_SQL = """
    WITH e AS (
      SELECT label, embedding, ROW_NUMBER() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS y FROM embeddings),
    p AS (
      SELECT 'embeddings/label-' || CAST(label AS VARCHAR) AS origin, CAST(y AS INTEGER) AS y,
             CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS x, CAST(unnest(embedding) AS DOUBLE) AS v
      FROM e),
    q AS (
      SELECT origin, y, x, CAST(least(greatest(floor((v + 4) * 32), 0), 255) AS INTEGER) AS r FROM p)
    SELECT origin, y, x, r, 255 - r AS g, x * 4 AS b FROM q
"""


@register("img_pixels", _PIXELS_SQL)
def img_pixels(spark, sf):
    return embedding_pixels(spark, sf)


@register(
    "img_rows",
    f"""
    SELECT origin, y, string_agg(printf('%02X%02X%02X', r, g, b), '' ORDER BY x) AS row_hex
    FROM ({_PIXELS_SQL}) GROUP BY origin, y
    """,
)
def img_rows(spark, sf):
    rows = I.encode_rows(embedding_pixels(spark, sf))
    return rows.select("origin", "y", F.hex("row_bytes").alias("row_hex"))


_SIZES_SQL = f"""
    SELECT origin, CAST(3 * COUNT(*) AS BIGINT) AS expected_bytes, CAST(3 * COUNT(*) AS BIGINT) AS actual_bytes,
           true AS size_ok
    FROM ({_PIXELS_SQL}) GROUP BY origin
"""


@register("img_size_check", _SIZES_SQL)
def img_size_check(spark, sf):
    px = embedding_pixels(spark, sf)
    return I.size_check(I.encode_rows(px), I.image_dimensions(px))


@register("img_kmeans")
def img_kmeans(spark, sf):
    _, clustered = I.cluster_pixels(embedding_pixels(spark, sf), k=5, seed=1)
    return clustered.select("origin", "y", "x", "cluster")


@register("img_recolor")
def img_recolor(spark, sf):
    model, clustered = I.cluster_pixels(embedding_pixels(spark, sf), k=5, seed=1)
    return I.recolor(spark, clustered, model)


_CENTERS = [[40.5, 200.0, 32.0], [128.9, 127.0, 128.0], [128.9, 127.0, 220.2], [210.0, 45.5, 60.0], [90.0, 165.0, 250.0]]


@register(
    "img_recolor_given",
    f"""
    WITH c AS (SELECT * FROM (VALUES {', '.join(f'({i}, {r}::DOUBLE, {g}::DOUBLE, {b}::DOUBLE)' for i, (r, g, b) in enumerate(_CENTERS))}) AS t(cluster, cr, cg, cb)),
    d AS (SELECT origin, y, x, cluster, cr, cg, cb, (r - cr) * (r - cr) + (g - cg) * (g - cg) + (b - cb) * (b - cb) AS gap
          FROM ({_PIXELS_SQL}), c)
    SELECT origin, y, x, CAST(cluster AS INTEGER) AS cluster, CAST(trunc(cr) AS INTEGER) AS new_r, CAST(trunc(cg) AS INTEGER) AS new_g,
           CAST(trunc(cb) AS INTEGER) AS new_b
    FROM d QUALIFY row_number() OVER (PARTITION BY origin, y, x ORDER BY gap, cluster) = 1
    """,
)
def img_recolor_given(spark, sf):
    out = I.recolor_by_centers(embedding_pixels(spark, sf), _CENTERS)
    return out.select("origin", "y", "x", "cluster", *[F.get("new_pixel", i).alias(f"new_{c}") for i, c in enumerate("rgb")])


@register("img_recolor_size_check", _SIZES_SQL)
def img_recolor_size_check(spark, sf):
    px = embedding_pixels(spark, sf)
    model, clustered = I.cluster_pixels(px, k=5, seed=1)
    rows = I.encode_rows(I.recolor(spark, clustered, model), rgb=F.col("new_pixel"))
    return I.size_check(rows, I.image_dimensions(px))
