"""Classes, centroids, days and projections of embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.operators.stats import medians


def class_index(rows: DataFrame, column: str, n: int = 10) -> DataFrame:
    """(class, total, class_index): 1..n for the n most frequent classes, of equals the first by name, and 0 for others. Nulls aren't counted."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("class")).agg(F.count(F.lit(1)).alias("total"))
    rn = F.row_number().over(Window.orderBy(F.desc("total"), "class"))  # a row for each class, after their sum
    return counts.withColumn("rn", rn).select("class", "total", F.when(F.col("rn") <= n, F.col("rn")).otherwise(0).cast("int").alias("class_index"))


def with_class_index(rows: DataFrame, column: str, n: int = 10) -> DataFrame:
    """rows with class_index, 0 also where the class is null."""
    top = class_index(rows, column, n).where("class_index > 0").select(F.col("class").alias("_c"), "class_index")
    return rows.join(F.broadcast(top), F.col(column) == F.col("_c"), "left").drop("_c").withColumn("class_index", F.coalesce("class_index", F.lit(0)))


def median_centroids(points: DataFrame, by: str, x: str = "x", y: str = "y") -> DataFrame:
    """by, cx, cy: medians of both coordinates, exact, without a task that gets a whole class."""
    return medians(points, [by], {x: "cx", y: "cy"})


def angle_order(centroids: DataFrame, cx: float | None = None, cy: float | None = None, by: str = "label") -> DataFrame:
    """centroids with angle (about a centre, by default the mean of all) and angle_rank from 1."""
    mid = Window.partitionBy()
    x0 = F.avg("cx").over(mid) if cx is None else F.lit(float(cx))
    y0 = F.avg("cy").over(mid) if cy is None else F.lit(float(cy))
    out = centroids.withColumn("angle", F.atan2(F.col("cy") - y0, F.col("cx") - x0))
    return out.withColumn("angle_rank", F.row_number().over(Window.orderBy("angle", by)))


def sufficient_days(rows: DataFrame, ts: str, least: int = 500) -> DataFrame:
    """Rows from the first day (of the year) on that has more than `least` rows; all rows if no day has."""
    day = F.dayofyear(ts)
    first = rows.groupBy(day.alias("d")).agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > least).agg(F.min("d").alias("first_day"))
    return rows.withColumn("day", day).crossJoin(F.broadcast(first)).where(F.col("day") >= F.coalesce("first_day", F.col("day"))).drop("first_day")  # first: one row


def minmax_scaled(rows: DataFrame, column: str, to: str) -> DataFrame:
    """(x - min) / max(max - min, 1) over all rows; nulls are left out of the bounds."""
    ends = rows.agg(F.min(column).alias("_a"), F.max(column).alias("_b"))  # one row
    return rows.crossJoin(F.broadcast(ends)).withColumn(to, (F.col(column) - F.col("_a")) / F.greatest(F.col("_b") - F.col("_a"), F.lit(1))).drop("_a", "_b")


def pca(rows: DataFrame, vector: str, k: int = 2, prefix: str = "pc") -> DataFrame:
    """rows with the first k principal components of an array column, the sign of each such that its largest loading is positive."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    vectors = rows.withColumn("_v", array_to_vector(F.col(vector).cast("array<double>")))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(vectors)
    loads = model.pc.toArray()
    signs = [1.0 if loads[abs(loads[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    out = model.transform(vectors).withColumn("_p", vector_to_array("_p"))
    return out.select(*rows.columns, *[(F.get("_p", F.lit(j)) * signs[j]).alias(f"{prefix}{j + 1}") for j in range(k)])


def umap_2d(rows: DataFrame, vector: str, n_neighbors: int = 80, min_dist: float = 0.15) -> DataFrame:
    """A projection by the optional package umap, on the driver; pca is what scales."""
    try:
        import umap
    except ImportError as e:
        raise RuntimeError("umap isn't installed; use pca") from e
    frame = rows.toPandas()
    xy = umap.UMAP(n_components=2, n_neighbors=n_neighbors, min_dist=min_dist, metric="euclidean").fit_transform(list(frame[vector]))
    frame["umap_x"], frame["umap_y"] = xy[:, 0], xy[:, 1]
    return rows.sparkSession.createDataFrame(frame)
