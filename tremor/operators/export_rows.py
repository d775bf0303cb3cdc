"""Rows and identities of the exported dataset."""

from __future__ import annotations

import hashlib
import json
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Unit identities, families and names of the dataset contract.
UNIT_CODES = {"mm/s": "C16", "G's": "K40", "g": "K40", "Hz": "HTZ", "%": "P1"}
FAMILIES = {"mm/s": "velocity", "G's": "acceleration", "g": "acceleration"}
PREFIXES = {"velocity": "VEL", "acceleration": "ACC"}
CONFIG_ID = "default"
OVERALL_NAMES = {"acceleration": "overall_acceleration_rms", "velocity": "overall_velocity_rms"}
# End of the fixed values.


def canonical_number(x: float) -> str:
    """A finite number as canonical JSON writes it (ECMAScript's shortest form)."""
    if not math.isfinite(x):
        raise ValueError("canonical JSON has no non-finite numbers")
    if x == int(x) and abs(x) < 1e21:
        return str(int(x))
    text = repr(float(x))
    if "e" not in text:
        return text
    digits, exponent = text.split("e")
    power = int(exponent)
    if 1e-6 <= abs(x) < 1e21:
        sign, digits = ("-", digits[1:]) if digits[0] == "-" else ("", digits)
        plain = digits.replace(".", "")
        return f"{sign}0.{'0' * (-power - 1)}{plain}"
    return f"{digits}e{'+' if power > 0 else '-'}{abs(power)}"


def canonical_json(value: object) -> str:
    """Canonical JSON: sorted keys, no blanks, numbers in their shortest form."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{canonical_json(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(canonical_json, value)) + "]"
    if isinstance(value, float):
        return canonical_number(value)
    return json.dumps(value, ensure_ascii=False)


def definition_id(blocks: dict[str, dict]) -> str:
    """Identity of an acquisition mode: digest of its canonical, null-free payload."""
    payload = {name: {k: v for k, v in block.items() if v is not None} for name, block in blocks.items() if block}
    if "spectrum" in payload:
        payload["spectrum"].setdefault("grid_kind", "hz_uniform")
    if not payload.get("spectrum") and not payload.get("waveform"):
        raise ValueError("a mode has a spectrum or a waveform")
    return "md-" + hashlib.sha256(canonical_json(payload).encode()).hexdigest()[:16]


@F.pandas_udf(StringType())
def spectrum_definition(family: pd.Series, fmax: pd.Series, lines: pd.Series) -> pd.Series:
    """Mode of spectra; call it on distinct shapes."""
    return pd.Series([
        definition_id({"spectrum": {"signal_family": f, "fmin_hz": 0.0, "fmax_hz": float(x), "lines": int(n), "detector": "peak", "power": False}})
        for f, x, n in zip(family, fmax, lines, strict=True)
    ], dtype=object)


@F.pandas_udf(StringType())
def waveform_definition(family: pd.Series, rate: pd.Series, samples: pd.Series) -> pd.Series:
    """Mode of waveforms; call it on distinct shapes."""
    return pd.Series([
        definition_id({"waveform": {"signal_family": f, "sample_rate_hz": float(x), "n_samples": int(n)}}) for f, x, n in zip(family, rate, samples, strict=True)
    ], dtype=object)


def _pick(values: dict[str, str], key: Column, other: str | None = None) -> Column:
    m = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    return F.coalesce(F.try_element_at(m, key), F.lit(other)) if other else F.try_element_at(m, key)


def family(unit: Column) -> Column:
    return _pick(FAMILIES, unit, "non_vibration")


def unit_code(unit: Column) -> Column:
    """UN/CEFACT code; a unit without one is an error."""
    code = _pick(UNIT_CODES, unit)
    return F.when(code.isNull(), F.raise_error(F.concat(F.lit("no unit code for "), F.coalesce(unit, F.lit("null"))))).otherwise(code)


@F.pandas_udf(StringType())
def number_name(x: pd.Series) -> pd.Series:
    """A number within a name: whole as such, else six significant digits with p for the point."""
    return x.map(lambda v: str(int(v)) if float(v).is_integer() else f"{v:g}".replace(".", "p"), na_action="ignore").astype(object)


def mode_name(unit: Column, x: Column, wave: bool = False) -> Column:
    parts = [_pick(PREFIXES, family(unit), "UNK"), number_name(x.cast("double"))]
    return F.concat_ws("_", *([F.lit("WAVE")] if wave else []), *parts)


def spectrum_rows(spectra: DataFrame) -> DataFrame:
    """Table of spectra from (point_id, timestamp_utc, fmax_hz, n_lines, unit, rpm, data)."""
    shape = ["_family", "fmax_hz", "n_lines"]
    typed = spectra.withColumn("_family", family(F.col("unit")))
    modes = typed.select(*shape).distinct().withColumn("_mode", spectrum_definition(*shape))
    return typed.join(modes, shape).select(
        F.unix_micros("timestamp_utc").alias("t"), F.lit(None).cast("long").alias("snap_t"), "point_id", mode_name(F.col("unit"), F.col("fmax_hz")).alias("proc_mode_id"),
        F.col("_mode").alias("mode_definition_id"), F.lit(0.0).cast("float").alias("fmin_hz"), F.col("fmax_hz").cast("float").alias("fmax_hz"),
        F.col("n_lines").cast("int").alias("lines"), F.lit(None).cast("string").alias("window"), F.lit(None).cast("int").alias("averages"),
        F.lit("peak").alias("spectrum_detector"), F.lit(False).alias("power"), unit_code(F.col("unit")).alias("unit"), F.col("_family").alias("signal_family"),
        F.when(F.col("rpm") > 0, F.col("rpm") / 60.0).cast("float").alias("speed_hz"), F.lit(CONFIG_ID).alias("config_id"), F.col("data").cast("array<float>").alias("data"),
    )


def waveform_rows(waves: DataFrame) -> DataFrame:
    """Table of waveforms from (point_id, timestamp_utc, sample_rate_hz, n_samples, unit, rpm, data)."""
    shape = ["_family", "sample_rate_hz", "n_samples"]
    typed = waves.withColumn("_family", family(F.col("unit")))
    modes = typed.select(*shape).distinct().withColumn("_mode", waveform_definition(*shape))
    none = lambda t: F.lit(None).cast(t)
    return typed.join(modes, shape).select(
        F.unix_micros("timestamp_utc").alias("t"), none("long").alias("snap_t"), "point_id", mode_name(F.col("unit"), F.col("sample_rate_hz"), True).alias("proc_mode_id"),
        F.col("_mode").alias("mode_definition_id"), F.col("sample_rate_hz").cast("float").alias("sample_rate_hz"), F.col("n_samples").cast("int").alias("n_samples"),
        unit_code(F.col("unit")).alias("unit"), F.col("_family").alias("signal_family"), F.when(F.col("rpm") > 0, F.col("rpm") / 60.0).cast("float").alias("speed_hz"),
        none("boolean").alias("sync"), none("int").alias("tacho_rising"), none("int").alias("tacho_falling"), F.lit(CONFIG_ID).alias("config_id"),
        F.col("data").cast("array<float>").alias("data"),
    )


def overall_metric(unit: Column, point_id: Column) -> Column:
    return F.concat_ws("__", _pick(OVERALL_NAMES, family(unit), OVERALL_NAMES["velocity"]), point_id)


def band_metric(band: Column, point_id: Column) -> Column:
    from tremor.functions.names import slug

    return F.concat(F.lit("band_"), slug(band), F.lit("__"), point_id)


def trend_rows(readings: DataFrame) -> DataFrame:
    """Table of trends from (t, metric_id, value, alarm); context rows have no alarm."""
    return readings.select(
        "t", F.lit(None).cast("long").alias("snap_t"), "metric_id", F.col("value").cast("float").alias("value"), F.col("alarm").cast("tinyint").alias("alarm"), F.lit(CONFIG_ID).alias("config_id")
    )


def metric_rows(bands: DataFrame) -> DataFrame:
    """Descriptors of metrics from (metric_id, point_id, name, unit, low/high in Hz or orders).

    A band with bounds is a spectral RMS; an acceleration band without any is a
    waveform peak. Every metric is described once.
    """
    bounded = F.col("low_hz").isNotNull() | F.col("low_order").isNotNull()
    fam = family(F.col("unit"))
    peak = (fam == "acceleration") & ~bounded & F.col("metric_id").startswith("band_")
    return bands.select(
        "metric_id", F.lit(CONFIG_ID).alias("config_id"), "point_id", "name", F.concat_ws(":", "point_id", "name").alias("path"),
        F.when(peak, "true_peak").otherwise("spectrum_rms").alias("statistic"), fam.alias("signal_family"), F.when(peak, "peak").otherwise("rms").alias("detector"),
        unit_code(F.col("unit")).alias("unit"), F.lit(False).alias("integrate"), F.when(bounded, "single").otherwise("none").alias("band_type"),
        F.col("low_hz").alias("band_low_hz"), F.col("high_hz").alias("band_high_hz"), F.col("low_order").alias("band_low_order"), F.col("high_order").alias("band_high_order"),
    ).distinct()
