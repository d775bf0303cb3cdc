"""Counts, spans, roll-ups and top lists over measured objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def type_summary(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    """count, first and last time per key; partial counts merge by themselves."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at"))


def rolled_up(units: DataFrame, facts: DataFrame, on: str, levels: list[str], measures: dict[str, Column]) -> DataFrame:
    """Totals of every level down to the grand total; units without facts count with zeros.

    Facts are summed per unit before they meet the units. ``level`` is the number of
    levels a row is grouped by.
    """
    partial = facts.groupBy(on).agg(*[m.alias(n) for n, m in measures.items()])
    joined = units.join(partial, on, "left").fillna(0, list(measures))
    out = joined.rollup(*levels).agg(
        F.count("*").alias("units"), *[F.sum(n).alias(n) for n in measures], (F.lit(len(levels)) - F.bit_count(F.grouping_id())).cast("int").alias("level")
    )
    return out


def top_n(df: DataFrame, by: str, tie: list[str], n: int | None) -> DataFrame:
    """The ``n`` rows largest in ``by``, ties by ``tie``; all without ``n``."""
    out = df.orderBy(F.desc(by), *tie)
    return out if not n else out.limit(n)


def histogram(df: DataFrame, column: str) -> DataFrame:
    """Occurrences and percentage of each value; one small row carries the total."""
    counted = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("_all"))
    return counted.crossJoin(F.broadcast(total)).select(column, "n", F.round(100.0 * F.col("n") / F.col("_all"), 6).alias("pct"))  # one row


def conflicts(df: DataFrame, keys: list[str], signature: list[str]) -> DataFrame:
    """Keys described in more than one way, and in which fields."""
    each = [F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit("\u0000"))).alias(f"_{c}") for c in signature]
    differing = F.array_compact(F.array(*[F.when(F.col(f"_{c}") > 1, F.lit(c)) for c in signature]))
    return df.groupBy(*keys).agg(*each).select(*keys, differing.alias("fields")).where(F.size("fields") > 0)


def database_totals(machines: DataFrame) -> DataFrame:
    """One row of totals from (area_name, machine_id, n_points, fft, waveform, trend) per machine; areas without machines don't count."""
    total = F.col("fft") + F.col("waveform") + F.col("trend")
    return machines.agg(
        F.count_distinct("area_name").alias("areas"), F.count("*").alias("machines"), F.count_if(total > 0).alias("machines_with_data"), F.coalesce(F.sum("n_points"), F.lit(0)).alias("points"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("fft", "waveform", "trend")],
    )


def metadata_summary(points: DataFrame, name: str, bearings: str, speed: str) -> DataFrame:
    """One row: points, different names, points with a name, with bearings and with a nominal speed."""
    said = F.size(F.filter(bearings, lambda b: b.isNotNull() & (F.trim(b) != ""))) > 0
    return points.agg(
        F.count("*").alias("points"), F.count_distinct(name).alias("names"), F.count_if(F.trim(name) != "").alias("with_name"), F.count_if(said).alias("with_bearings"), F.count_if(F.col(speed) > 0).alias("with_speed")
    )
