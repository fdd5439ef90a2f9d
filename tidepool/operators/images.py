"""Image-pixel operators: decode -> pixel rows -> KMeans colours -> recolour ->
row bytes -> size check.

Pixels always carry their position ``(origin, y, x)``; nothing relies on row
order surviving a shuffle, and no global window or driver-side collect is
used.  Each image row is an independent group of ``width`` pixels, so row
encoding is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.clustering import assemble, centers, fit_kmeans
from tidepool.session import landed


#: Bytes of a pixel that the decoder knows: grey, BGR, BGRA.
CHANNELS = (1, 3, 4)


def _byte(data: Column, offset: Column) -> Column:
    """Unsigned byte at 0-based ``offset`` of a binary column."""
    return F.conv(F.hex(F.substring(data, offset + 1, 1)), 16, 10).cast("int")


def image_pixels(images: DataFrame) -> DataFrame:
    """Spark ``image`` source rows -> ``(origin, y, x, r, g, b)``.

    The source stores bytes row-major in BGR(A) order, or one grey byte; alpha
    is ignored.  Images that could not be read give no pixel, see
    :func:`image_rejects`.  Each image is cut into rows before the pixels, so a
    pixel never carries more than its row.
    """
    im = images.select(
        F.col("image.origin").alias("origin"), F.col("image.height").alias("h"),
        F.col("image.width").alias("w"), F.col("image.nChannels").alias("c"), F.col("image.data").alias("data"),
    ).where(F.col("c").isin(*CHANNELS) & (F.col("h") > 0) & (F.col("w") > 0))
    rows = im.select("origin", "w", "c", "data", F.explode(F.sequence(F.lit(0), F.col("h") - 1)).alias("y"))
    step = F.col("w") * F.col("c")
    rows = rows.select("origin", "w", "c", "y", F.substring(F.col("data"), F.col("y") * step + 1, step).alias("line"))
    px = rows.select("origin", "y", "c", "line", F.explode(F.sequence(F.lit(0), F.col("w") - 1)).alias("x"))
    at = lambda k: _byte(F.col("line"), F.col("x") * F.col("c") + F.when(F.col("c") == 1, 0).otherwise(k))
    return px.select("origin", "y", "x", at(2).alias("r"), at(1).alias("g"), at(0).alias("b"))


def image_rejects(images: DataFrame) -> DataFrame:
    """``(origin, n_channels)`` of the images that give no pixel."""
    im = images.select(F.col("image.origin").alias("origin"), F.col("image.nChannels").alias("n_channels"),
                       F.col("image.height").alias("h"), F.col("image.width").alias("w"))
    fits = F.col("n_channels").isin(*CHANNELS) & (F.col("h") > 0) & (F.col("w") > 0)
    return im.where(~F.coalesce(fits, F.lit(False))).select("origin", "n_channels")


def image_dimensions(pixels: DataFrame) -> DataFrame:
    """``(origin, height, width)`` from the pixel positions."""
    return pixels.groupBy("origin").agg(
        (F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width")
    )


def pixel_features(pixels: DataFrame, out: str = "features") -> DataFrame:
    """R, G, B as doubles -> feature vector."""
    d = pixels.withColumns({c: F.col(c).cast("double") for c in ("r", "g", "b")})
    return assemble(d, ["r", "g", "b"], out)


def cluster_pixels(pixels: DataFrame, k: int = 5, seed: int = 1, cluster_col: str = "cluster") -> tuple[KMeansModel, DataFrame]:
    """KMeans over pixel colours; returns ``(model, pixels + cluster)``.

    The fit reads each colour once, weighted by its number of pixels: at most
    2^24 rows, whatever the images.  Every pixel then takes its nearest centre
    in its own row."""
    colours = landed(pixels.sparkSession, pixels.groupBy("r", "g", "b").agg(F.count("*").cast("double").alias("weight")), "colours")
    model = fit_kmeans(pixel_features(colours), k, seed, "features", cluster_col, weight_col="weight")
    return model, model.transform(pixel_features(pixels))


def recolor_by_centers(pixels: DataFrame, centers: Sequence[Sequence[float]]) -> DataFrame:
    """Each pixel takes the colour of the nearest given centre (the first on ties),
    truncated toward zero."""
    ctr = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centers])
    gap = F.transform(ctr, lambda c: sum((F.col(p).cast("double") - F.get(c, i)) * (F.col(p).cast("double") - F.get(c, i))
                                         for i, p in enumerate(("r", "g", "b"))))
    placed = pixels.withColumn("_gap", gap).withColumn("cluster", (F.array_position("_gap", F.array_min("_gap")) - 1).cast("int"))
    return placed.select("origin", "y", "x", "cluster", F.transform(F.get(ctr, F.col("cluster")), lambda v: v.cast("int")).alias("new_pixel"))


def recolor(spark: SparkSession, clustered: DataFrame, model: KMeansModel, cluster_col: str = "cluster") -> DataFrame:
    """Each pixel takes its cluster centre's colour, truncated toward zero.

    A join with the k-row centre table (broadcast: its size is k), no UDF."""
    ctr = centers(spark, model, cluster_col).select(
        cluster_col, F.transform("center", lambda v: v.cast("int")).alias("new_pixel")
    )
    return clustered.join(F.broadcast(ctr), cluster_col).select(
        "origin", "y", "x", cluster_col, "new_pixel"
    )


def encode_rows(pixels: DataFrame, rgb: Column | None = None) -> DataFrame:
    """One row of bytes per ``(origin, y)``: R,G,B of each pixel in x order.

    ``rgb`` is an ``array<int>`` expression (default ``[r, g, b]``).  Built
    as a hex string and ``unhex``-ed, all inside the JVM."""
    px = rgb if rgb is not None else F.array("r", "g", "b")
    hexpix = F.array_join(F.transform(px, lambda v: F.lpad(F.hex(v), 2, "0")), "")
    rows = pixels.groupBy("origin", "y").agg(
        F.array_sort(F.collect_list(F.struct(F.col("x"), hexpix.alias("h")))).alias("_px")
    )
    return rows.select(
        "origin", "y", F.unhex(F.array_join(F.transform("_px", lambda s: s["h"]), "")).alias("row_bytes")
    )


def size_check(rows: DataFrame, dims: DataFrame) -> DataFrame:
    """Per image: expected bytes (width x height x 3) vs encoded bytes."""
    got = rows.groupBy("origin").agg(F.sum(F.length("row_bytes")).cast("bigint").alias("actual_bytes"))
    return dims.join(got, "origin", "left").select(
        "origin",
        (F.col("width") * F.col("height") * 3).cast("bigint").alias("expected_bytes"),
        F.coalesce(F.col("actual_bytes"), F.lit(0)).cast("bigint").alias("actual_bytes"),
    ).withColumn("size_ok", F.col("expected_bytes") == F.col("actual_bytes"))
