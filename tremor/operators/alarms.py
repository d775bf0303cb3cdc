"""Thresholds, alarm levels, band columns and stored alarm notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Inch to mm, unit codes of thresholds (velocity, acceleration).
INCH = 25.4
VELOCITY, ACCELERATION = 1, 3
#: Band types: fixed Hz, shaft orders, high-frequency fixed Hz, waveform peak. Fixed values.
FIXED_HZ, ORDERS, HIGH_FREQUENCY, WAVE_PEAK = 1, 2, 4, 11


def limit(value: Column) -> Column:
    """A threshold; zero, less and NaN mean none."""
    return F.when((value > 0) & ~F.isnan(value), value)


def alarm_level(value: Column, alert: Column, danger: Column) -> Column:
    """3 from danger on, 2 from alert on, else 0; null without a threshold or a value."""
    return (
        F.when(value.isNull() | (alert.isNull() & danger.isNull()), None)
        .when(danger.isNotNull() & (value >= danger), 3)
        .when(alert.isNotNull() & (value >= alert), 2)
        .otherwise(0)
        .cast("tinyint")
    )


def usable(threshold: Column, code: Column, expected: int) -> Column:
    """The threshold where its unit code is the expected one."""
    return F.when(code == expected, threshold)


def slots_of(limits: DataFrame) -> DataFrame:
    """Limit sets in long form: (limit_record_num, slot, alert, danger, code), slot 0 the overall."""
    return limits.select(
        F.col("record_num").alias("limit_record_num"), F.posexplode(F.arrays_zip("alert", "danger", "unit_codes")).alias("slot", "s")
    ).select(
        "limit_record_num", "slot", limit(F.col("s.alert").cast("double")).alias("alert"), limit(F.col("s.danger").cast("double")).alias("danger"),
        F.col("s.unit_codes").alias("code"),
    )


def levels(readings: DataFrame, points: DataFrame, limits: DataFrame) -> DataFrame:
    """Each reading's overall with the thresholds of its point's limit set and the alarm level.

    Raw values are compared with raw thresholds; scaled ones are for display. Sets and
    points are dimensions that the planner broadcasts below its threshold.
    """
    overall = slots_of(limits).where("slot = 0").drop("slot")
    placed = points.select(F.col("record_num").alias("point_record_num"), "limit_record_num")
    joined = readings.join(placed, "point_record_num", "left").join(overall, "limit_record_num", "left")
    known = F.col("code").isin(VELOCITY, ACCELERATION)
    value = F.col("overall_raw").cast("double")
    alert, danger = F.when(known, F.col("alert")), F.when(known, F.col("danger"))
    return joined.select(
        "reading_id", "point_record_num", value.alias("value_raw"), alert.alias("alert_raw"), danger.alias("danger_raw"),
        alarm_level(value, alert, danger).cast("int").alias("alarm"),
    )


def band_columns(bands: DataFrame) -> DataFrame:
    """Scale, unit and bounds of each template slot ``(…, band_type, low, high)``; unknown types are left out."""
    t = F.col("band_type")
    return bands.where(t.isin(FIXED_HZ, ORDERS, HIGH_FREQUENCY, WAVE_PEAK)).select(
        "*",
        F.when(t.isin(FIXED_HZ, ORDERS), F.lit(INCH)).otherwise(F.lit(1.0)).alias("scale"),
        F.when(t.isin(FIXED_HZ, ORDERS), "mm/s").otherwise("G's").alias("unit"),
        F.when(t == ORDERS, F.col("low")).alias("low_order"),
        F.when(t == ORDERS, F.col("high")).alias("high_order"),
        F.when(t.isin(FIXED_HZ, HIGH_FREQUENCY), F.col("low")).alias("low_hz"),
        F.when(t.isin(FIXED_HZ, HIGH_FREQUENCY), F.col("high")).alias("high_hz"),
        F.when(t.isin(FIXED_HZ, ORDERS), VELOCITY).otherwise(ACCELERATION).alias("expected_code"),
    )


#: One alarm line; the lazy band and the two unit words settle names with separators. Fixed value.
ALARM_LINE = r"^(.+?)\s*-\s*([0-9]+(?:\.[0-9]+)?)\s+(mm/Seg|G-s)\s*-\s*([CD])\s+Alarm\s*$"


def parse_note(notes: DataFrame) -> DataFrame:
    """band, value, unit and level of the first alarm line of ``note_text``; nulls without one."""
    lines = F.filter(F.split("note_text", "[\r\n]+"), lambda x: F.trim(x).rlike(ALARM_LINE))
    line = F.trim(F.try_element_at(lines, F.lit(1)))
    group = lambda i: F.nullif(F.regexp_extract(line, ALARM_LINE, i), F.lit(""))
    return notes.select(
        "*",
        group(1).alias("note_band"),
        group(2).cast("double").alias("note_value"),
        F.when(group(3) == "mm/Seg", "mm/s").when(group(3) == "G-s", "G's").alias("note_unit"),
        group(4).alias("note_level"),
    )


def severity_level(severity: Column) -> Column:
    """1 to 40 is C, above D, else none."""
    return F.when(severity > 40, "D").when(severity > 0, "C")


def coherent(value: Column, level: Column, alert: Column, danger: Column) -> Column:
    """Whether a value lies where its level says; null without thresholds."""
    c = alert.isNotNull() & (alert <= value) & (danger.isNull() | (value < danger))
    return F.when(alert.isNull() & danger.isNull(), None).when(level == "C", c).otherwise(danger.isNotNull() & (value >= danger))


OVERALL = "OVERALL VALUE"


def long_limits(limits: DataFrame) -> DataFrame:
    """Limit sets of the tables as (limits_index, set_name, slot, alert, danger, code)."""
    names = limits.select(F.col("record_num").alias("limit_record_num"), "set_name")
    return slots_of(limits).join(names, "limit_record_num").withColumnRenamed("limit_record_num", "limits_index")


def note_thresholds(notes: DataFrame, links: DataFrame, limits: DataFrame, templates: DataFrame) -> DataFrame:
    """Parsed notes with the slot of the limit set that their band has, and its raw thresholds.

    ``links``: (point_record_num, template_index, limits_index); ``limits``: (limits_index,
    set_name, slot, alert, danger, code); ``templates``: (template_index, slot, band).
    The overall has slot 0, a band the slot behind the first template slot of its very
    name; a band that the template lacks has none, so nothing can be checked.
    """
    first = templates.groupBy("template_index", F.col("band").alias("note_band")).agg((F.min("slot") + 1).alias("_slot"))
    linked = notes.join(links, "point_record_num", "left").join(first, ["template_index", "note_band"], "left")
    placed = linked.withColumn("slot", F.when(F.upper("note_band") == OVERALL, 0).otherwise(F.col("_slot"))).drop("_slot")
    return placed.join(limits, ["limits_index", "slot"], "left")


def checked_notes(notes: DataFrame, links: DataFrame, limits: DataFrame, templates: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Parsed notes against the thresholds of their band, with the reason a note isn't published.

    Thresholds are those of the note's display unit. Gates in order: in alarm,
    coherent, unit consistent, dated.
    """
    n = note_thresholds(parse_note(notes), links, limits, templates)
    velocity = F.col("note_unit") == "mm/s"
    scale = F.when(velocity, F.lit(INCH)).otherwise(F.lit(1.0))
    same = F.coalesce(F.col("code") == F.when(velocity, VELOCITY).otherwise(ACCELERATION), F.lit(False))
    alert, danger = F.col("alert") * scale, F.col("danger") * scale
    ok = coherent(F.col("note_value"), F.col("note_level"), alert, danger)
    return n.select(
        *(keep or ["note_id"]), "point_record_num", "severity", "note_band", "note_value", "note_unit", "note_level", "slot", "set_name", alert.alias("note_alert"), danger.alias("note_danger"),
        severity_level(F.col("severity")).alias("severity_level"), ok.alias("coherent"), same.alias("unit_consistent"),
        F.when(F.col("note_level").isNull(), "not_in_alarm").when(F.coalesce(~ok, F.lit(True)), "incoherent").when(~same, "unit_mismatch")
        .when(F.col("measured_at_utc").isNull(), "undated").alias("reject_reason"),
    )


def coherence_summary(checked: DataFrame) -> DataFrame:
    """Counts of notes by outcome and the share of alarms that are coherent, 0 without alarms."""
    alarms = F.count_if(F.col("note_level").isNotNull())
    incoherent = F.count_if(F.col("reject_reason") == "incoherent")
    return checked.agg(
        F.count("*").alias("notes"), alarms.alias("alarms"), incoherent.alias("incoherent"),
        F.count_if(F.col("reject_reason") == "unit_mismatch").alias("unit_mismatch"), F.count_if(F.col("reject_reason").isNull()).alias("emitted"),
        F.round(F.when(alarms == 0, 0.0).otherwise(100.0 * (alarms - incoherent) / alarms), 6).alias("coherent_pct"),
    )
