"""From predictions to smoothed daily series of the most detected species."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions.paths import file_timestamp, key_timestamp
from corvane.operators import detections as D
from corvane.operators.topk import from_topk


def dated(predictions: DataFrame, least_year: int = 2024) -> DataFrame:
    """predictions with date, from the file's path or else its key; rows without a valid time go."""
    ts = file_timestamp(F.col("file_path"), least_year) if "file_path" in predictions.columns else F.lit(None).cast("timestamp_ntz")
    ts = F.coalesce(ts, key_timestamp(F.col("file"), least_year)) if "file" in predictions.columns else ts
    return predictions.withColumn("date", ts.cast("date")).where("date IS NOT NULL")


def detection_timeseries(found: DataFrame, n: int = 15, width: int = 4) -> DataFrame:
    """(date, species, n, smooth) from detections (date, species), for the top n species over all days."""
    daily = D.of_top_species(D.daily_counts(found), n)
    return D.rolling_mean(D.calendar(daily), width)


def from_predictions(predictions: DataFrame, threshold: float = 0.0, n: int = 15, width: int = 4, k: int = 10) -> DataFrame:
    """The whole way from wide predictions; the date filter comes before the unpivot."""
    long = D.unpivot_topk(dated(predictions), ["date"], k)
    return detection_timeseries(D.detections(long, threshold), n, width)


def from_ingested(predictions: DataFrame, threshold: float = 0.0, n: int = 15, width: int = 4, k: int = 10) -> DataFrame:
    """The same from the predictions that inference writes, whose topk are arrays; no wide columns are made on the way."""
    long = from_topk(dated(predictions), ["date"], k).select("date", "rank", "species", "score")
    return detection_timeseries(D.detections(long, threshold), n, width)
