"""Embedding maps: joined, indexed or timed rows, projected to two dimensions, with what a plot of them needs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import paths as P
from corvane.functions import times as M
from corvane.operators import embeddings as E
from corvane.operators import joins, raster

KEYS = ["file", "file_path", "chunk_idx", "start_time", "end_time"]


def project(rows: DataFrame, vector: str = "embedding", method: str = "pca") -> DataFrame:
    """rows with umap_x and umap_y: principal components, or the optional package umap on the driver."""
    if method == "umap":
        return E.umap_2d(rows, vector)
    return E.pca(rows, vector, 2, prefix="_pc").withColumnRenamed("_pc1", "umap_x").withColumnRenamed("_pc2", "umap_y")


def class_map(embeddings: DataFrame, predictions: DataFrame, n: int = 10, method: str = "pca") -> DataFrame:
    """KEYS, umap_x, umap_y, predicted_class, class_index (1..n by frequency, else 0)."""
    joined = joins.left_with_suffix(embeddings, predictions.select("file_path", "chunk_idx", F.col("top1").alias("predicted_class")), ["file_path", "chunk_idx"])
    return project(E.with_class_index(joined, "predicted_class", n), method=method).select(*KEYS, "umap_x", "umap_y", "predicted_class", "class_index")


def time_map(embeddings: DataFrame, least: int = 500, method: str = "pca") -> DataFrame:
    """KEYS, umap_x, umap_y, time_seconds, day_of_year of the rows with a time in their path, from the first day with enough rows on."""
    timed = embeddings.withColumn("ts", P.path_timestamp(F.col("file_path"))).where("ts IS NOT NULL")
    days = E.sufficient_days(timed, "ts", least).withColumnRenamed("day", "day_of_year").withColumn("time_seconds", M.second_of_day(F.col("ts")).cast("int"))
    return project(days, method=method).select(*KEYS, "umap_x", "umap_y", "time_seconds", "day_of_year")


def write_map(found: DataFrame, path: str) -> None:
    """A map's rows as Parquet, coordinates as floats."""
    found.withColumns({c: F.col(c).cast("float") for c in ("umap_x", "umap_y")}).write.mode("overwrite").parquet(path)


def chunk_labels(predictions: DataFrame, audio_stem: str, k: int = 3) -> DataFrame:
    """(chunk_idx, labels: the first k valid of rank, species and relative confidence) of one recording; of several rows of a chunk
    that with the largest file and scores counts."""
    from corvane.functions.arrays import first_valid, relative

    own = predictions.where(P.file_matches(F.col("file"), F.col("file_path"), audio_stem))
    names = [c for c in predictions.columns if c.startswith("top") and c[3:].isdigit()][:5]
    scores = F.array(*[F.col(c.replace("top", "score")).cast("double") for c in names])
    rows = own.select("chunk_idx", F.struct("file", scores.alias("scores"), F.array(*names).alias("names")).alias("r"))
    best = rows.groupBy("chunk_idx").agg(F.max("r").alias("r")).select("chunk_idx", "r.names", relative(F.col("r.scores")).alias("c"))
    return best.select("chunk_idx", first_valid(F.arrays_zip(F.col("names").alias("species"), F.col("c").alias("confidence")), k).alias("labels"))


def bilinear(grid: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Values of a grid (rows are y) between its cells, coordinates cut to its edges."""
    h, w = grid.shape
    x, y = np.clip(x, 0, w - 1), np.clip(y, 0, h - 1)
    i, j = np.minimum(x.astype(int), max(w - 2, 0)), np.minimum(y.astype(int), max(h - 2, 0))
    i2, j2 = np.minimum(i + 1, w - 1), np.minimum(j + 1, h - 1)
    a, b = x - i, y - j
    return (grid[j, i] * (1 - a) + grid[j, i2] * a) * (1 - b) + (grid[j2, i] * (1 - a) + grid[j2, i2] * a) * b


def smoothed(grid: np.ndarray, sigma: float = 1.5) -> np.ndarray:
    """A Gaussian blur, one axis after the other."""
    r = max(1, int(4 * sigma + 0.5))
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    kernel /= kernel.sum()
    blur = lambda v: np.convolve(np.pad(v, r, mode="edge"), kernel, mode="valid")
    return np.apply_along_axis(blur, 0, np.apply_along_axis(blur, 1, grid.astype(float)))


def label_places(points: DataFrame, by: str = "class_index", x: str = "umap_x", y: str = "umap_y", bins: int = 150, steps: int = 20) -> DataFrame:
    """(class, cx, cy, label_x, label_y): for each class from 1 on a place for its label on the ray from the plot's centre through its centroid (of
    medians), half to nearly all of the plot's range beyond the centroid, where three times the class's own density and a penalty for the distance are
    least. A centroid at the centre gets its label beside it; a ray that leaves the plot at once, one a little further out. A task holds the raster of
    a class, bins * bins cells at most."""
    box = raster.extent(points, x, y).first()
    kinds = "class int, cx double, cy double, label_x double, label_y double"
    if box["x0"] is None:
        return points.sparkSession.createDataFrame([], kinds)
    low, high = np.array([box["x0"], box["y0"]]), np.array([box["x1"], box["y1"]])
    centre, reach = (low + high) / 2, float((high - low).max())
    cells = raster.raster(points, bins, bins, x, y, by=(by,)).where(F.col(by) >= 1)
    centroids = E.median_centroids(points.where(F.col(by) >= 1), by, x, y)

    def place(own: pd.DataFrame) -> pd.DataFrame:
        grid = np.zeros((bins, bins))
        grid[own["px"], own["py"]] = own["n"]
        grid = smoothed(grid)
        grid /= grid.max() + 1e-8
        c = np.array([own["cx"].iloc[0], own["cy"].iloc[0]])
        far = np.linalg.norm(c - centre)
        if far < 1e-6:
            spot = c + [0.15 * reach, 0.0]
        else:
            ray, offsets = (c - centre) / far, np.linspace(0.5, 0.95, steps) * reach
            spots = c + offsets[:, None] * ray
            inside = ((spots >= low) & (spots <= high)).all(axis=1)
            at = np.clip(((spots - low) / np.where(high > low, high - low, 1.0) * bins).astype(int), 0, bins - 1)
            cost = 3 * grid[at[:, 0], at[:, 1]] + (offsets / (0.3 * reach)) ** 1.5
            spot = spots[np.where(inside, cost, np.inf).argmin()] if inside.any() else c + 0.35 * reach * ray
        return pd.DataFrame({"class": [int(own[by].iloc[0])], "cx": [c[0]], "cy": [c[1]], "label_x": [spot[0]], "label_y": [spot[1]]})

    return cells.join(centroids, by).groupBy(by).applyInPandas(place, kinds)


#: Palettes of this library's own: colours (red, green, blue) between which a day's hours run, for mornings and evenings.
MORNING, EVENING = ((0.27, 0.00, 0.33), (0.13, 0.57, 0.55), (0.99, 0.91, 0.14)), ((1.00, 0.96, 0.94), (0.98, 0.42, 0.29), (0.40, 0.00, 0.05))
#: Outside recording windows: a grey, nearly transparent.
GAP, GAP_ALPHA = 0.5, 0.15


def day_colours(windows: list[tuple[str, float, float]], cells: int = 288) -> np.ndarray:
    """cells x 4: a colour for each part of the day, hours 0 to 24 both included, from one end of a palette to the other within a recording
    window, its ends included, and a faint grey outside. windows: (kind, start_hour, end_hour); a window that ends before it starts runs
    over midnight. Mornings go before evenings where both are."""
    out = np.tile([GAP, GAP, GAP, GAP_ALPHA], (cells, 1))
    hours = 24.0 * np.arange(cells) / max(1, cells - 1)
    for kind, start, end in sorted(windows, key=lambda w: w[0] != "evening"):
        wraps = start > end
        at = (hours >= start) | (hours <= end) if wraps else (hours >= start) & (hours <= end)
        along = np.where(wraps & (hours < start), hours + 24.0, hours) - start
        share = np.clip(along[at] / max(end - start + 24.0 * wraps, 1e-6), 0, 1)
        palette = np.array(EVENING if kind == "evening" else MORNING)
        stops = np.linspace(0, 1, len(palette))
        out[at] = np.stack([*(np.interp(share, stops, palette[:, c]) for c in range(3)), np.ones(at.sum())], axis=1)
    return out


def time_of_day_windows(points: DataFrame, seconds: Column | None = None) -> DataFrame:
    """The recording windows of rows with time_seconds."""
    hist = raster.time_of_day_bins(points, F.col("time_seconds") if seconds is None else seconds)
    return raster.recording_windows(raster.circular_runs(raster.runs(raster.occupied(hist))))
