"""The monitor as a stream: alarm levels as they come, counts per window, sessions, latest verdicts.

An extension: the batch operators applied to unbounded readings. State is bounded by
watermarks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.operators.alarms import alarm_level


def read_events(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A growing folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def levelled(readings: DataFrame, thresholds: DataFrame, on: str, value: str) -> DataFrame:
    """Readings beside the static thresholds (on, alert, danger) of their source, with alarm levels."""
    return readings.join(thresholds, on, "left").withColumn("alarm", alarm_level(F.col(value), F.col("alert"), F.col("danger")))


def windowed(readings: DataFrame, at: str, keys: list[str], value: str, late: str = "1 hour", length: str = "6 hours", slide: str | None = None) -> DataFrame:
    """Count, mean and maximum per key and window; rows later than ``late`` don't count."""
    w = F.window(at, length, slide) if slide else F.window(at, length)
    return readings.withWatermark(at, late).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.max(value).alias("most"))


def sessions(readings: DataFrame, at: str, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Stretches of readings of one key without a longer gap."""
    return readings.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count("*").alias("n"))


def first_deliveries(readings: DataFrame, at: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """Each reading once, however often it is delivered within ``late``."""
    return readings.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)
