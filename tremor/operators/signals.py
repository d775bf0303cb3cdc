"""Arrays of samples: assembly, checks, bins and bands, all in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assembled(low: Column, chain: Column, lines: Column) -> Column:
    """Low band and chain joined and cut to the nominal number of lines, if there is one; shorter ones stay as they are."""
    whole = F.concat(low, chain)
    return F.when(lines > 0, F.slice(whole, 1, lines)).otherwise(whole)


def wave_state(samples: Column, nominal: Column) -> Column:
    """ok, or what is wrong: ``short`` with fewer samples than nominal, ``padding`` if what exceeds it isn't all zero."""
    n = F.size(samples)
    rest = F.slice(samples, nominal + 1, F.greatest(n - nominal, F.lit(0)))
    return F.when(n < nominal, "short").when((n > nominal) & F.exists(rest, lambda x: x != 0), "padding").otherwise("ok")


def bins(df: DataFrame, keep: list[str], data: str, fmax: Column) -> DataFrame:
    """Long form of spectra: bin, its frequency (i x fmax / lines) and amplitude."""
    n = F.size(data)
    return df.select(*keep, fmax.cast("double").alias("_f"), n.alias("_n"), F.posexplode(data).alias("bin", "amplitude")).select(
        *keep, "bin", (F.col("bin") * F.col("_f") / F.col("_n")).alias("hz"), F.col("amplitude").cast("double").alias("amplitude")
    )


def band_value(data: Column, fmax: Column, low: Column, high: Column) -> Column:
    """Root of the sum of squares of the bins in [low, high), without a join."""
    n = F.size(data)
    inside = F.filter(
        F.transform(data, lambda x, i: F.struct(x.cast("double").alias("x"), (i * fmax / n).alias("f"))),
        lambda s: (s["f"] >= low) & (s["f"] < high),
    )
    return F.sqrt(F.aggregate(inside, F.lit(0.0), lambda a, s: a + s["x"] * s["x"]))


def order_band(low: Column, high: Column, rpm: Column) -> tuple[Column, Column]:
    """Bounds in shaft orders as Hz; null without a speed."""
    hz = F.when(rpm > 0, rpm / 60.0)
    return low * hz, high * hz


def capture_context(captures: DataFrame, t: Column, rpm: Column, load: Column, keep: list[str]) -> DataFrame:
    """Speed (Hz, where the speed is above 0) and load of every capture, equal rows once."""
    rows = captures.select(
        *keep, t.alias("t"),
        F.inline(F.array(F.struct(F.lit("load").alias("metric_id"), load.cast("double").alias("value")),
                         F.struct(F.lit("speed").alias("metric_id"), F.when(rpm > 0, rpm.cast("double") / 60.0).alias("value")))),
    ).where("value is not null")
    return rows.distinct()
