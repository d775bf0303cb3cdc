"""Ground truth: observations of stored alarms, consolidation, and the tables made of diagnosis documents."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tremor.operators import findings, ordered
from tremor.operators.crosswalk import plain
from tremor.operators.history import normalise_tag

# Levels of stored alarms, a plant tag at the end of a name, keys of the consolidated view.
LEVELS = {"C": ("ALERT", 2), "D": ("DANGER", 3)}
TAG_AT_END = r"\b([A-Za-z]{2,4}[-./][A-Za-z0-9][A-Za-z0-9/.\- ]*)$"
MODALITY = "vibration"
DEDUPE_KEY = ["origin", "normalized_tag", "observed_at", "modality"]
SERIES_KEY = ["origin", "normalized_tag", "modality"]
OBSERVATIONS = (
    "document_id string, observation_id string, origin string, record_kind string, normalized_tag string, dataset_machine_id string, external_tag string, "
    "external_name string, area_code string, area_name string, modality string, observed_at string, inspection_date string, status string, status_source_label string, "
    "alarm tinyint, global_status_label string, diagnosis_text string, analysis_text string, recommendation_text string, rpm1 float, rpm2 float, power_kw float, "
    "source_page int, n_findings int"
)
CONSOLIDATED = OBSERVATIONS + ", valid_to string"
FINDINGS = (
    "document_id string, observation_id string, finding_index int, dataset_machine_id string, observed_at string, modality string, record_kind string, fault_mode string, "
    "fault_group string, label_quality string, mapping_rule string, weight double, source_text string, matched_text string"
)
# End of the fixed values.


def machine_tag(name: Column) -> Column:
    """The plant tag at the end of a machine's name, null without one."""
    return F.nullif(F.trim(F.regexp_extract(F.trim(name), TAG_AT_END, 1)), F.lit(""))


@F.pandas_udf(StringType())
def _four_digits(x: pd.Series) -> pd.Series:
    return x.map(lambda v: "-" if pd.isna(v) else f"{v:.4g}").astype(object)


@F.pandas_udf(StringType())
def _shortest(x: pd.Series) -> pd.Series:
    return x.map(lambda v: repr(float(v)), na_action="ignore").astype(object)


# Fixed value: the wording of the evidence, Punto NAME (CODE); banda BAND = VALUE UNIT; umbrales C ALERT / D DANGER UNIT (set "SET"); severidad N/100.
def evidence_text() -> Column:
    """Where a stored alarm fired and against what limits."""
    unit = F.coalesce("note_unit", F.lit(""))
    limits = F.concat_ws(" ", F.lit("umbrales C"), _four_digits("note_alert"), F.lit("/ D"), _four_digits("note_danger"), unit)
    named = F.when(F.col("set_name") != "", F.concat(F.lit(' (set "'), F.col("set_name"), F.lit('")')))
    return F.concat(
        F.concat_ws(
            "; ", F.concat(F.lit("Punto "), F.col("long_name"), F.lit(" ("), F.col("point_id"), F.lit(")")),
            F.trim(F.concat(F.lit("banda "), F.col("note_band"), F.lit(" = "), _shortest("note_value"), F.lit(" "), unit)),
            F.when(F.col("note_alert").isNotNull() | F.col("note_danger").isNotNull(), F.concat(F.trim(limits), F.coalesce(named, F.lit("")))),
            F.concat(F.lit("severidad "), F.col("severity").cast("string"), F.lit("/100")),
        ),
        F.lit("."),
    )


def alarm_observations(checked: DataFrame, points: DataFrame, document_id: str) -> DataFrame:
    """One observation with exactly one finding per note that passed all gates.

    ``checked`` comes from ``alarms.checked_notes``; ``points`` names them:
    (machine_id, machine_name, area_name, point_id, long_name).
    """
    named = checked.where("reject_reason is null").join(points.select("machine_id", "machine_name", "area_name", "point_id", "long_name"), ["machine_id", "point_id"])
    day = F.date_format("measured_at_utc", "yyyy-MM-dd")
    level = lambda k: F.create_map(*[F.lit(x) for l, v in LEVELS.items() for x in (l, v[k])])[F.col("note_level")]  # noqa: E731, E741
    tag = machine_tag(F.col("machine_name"))
    none = lambda t: F.lit(None).cast(t)
    finding = findings.band_finding(F.col("note_band"))
    one = F.struct(
        F.col("note_text").alias("source_text"), F.col("note_band").alias("matched_text"), finding["fault_mode"].alias("fault_mode"), finding["fault_group"].alias("fault_group"),
        finding["label_quality"].alias("label_quality"), finding["mapping_rule"].alias("mapping_rule"), none("double").alias("weight"),
    )
    return named.select(
        F.concat_ws(":", F.lit(document_id), "machine_id", "point_id", F.lit(MODALITY), day).alias("observation_id"), F.lit("primary").alias("record_kind"),
        F.struct(
            tag.alias("external_tag"), F.col("machine_name").alias("external_name"), normalise_tag(F.coalesce(tag, F.col("machine_name"))).alias("normalized_tag"),
            F.lit("").alias("area_code"), "area_name", F.col("machine_id").alias("dataset_machine_id"),
        ).alias("machine"),
        F.lit(MODALITY).alias("modality"), day.alias("observed_at"), level(0).alias("status"), F.concat("note_level", F.lit(" Alarm")).alias("status_source_label"),
        level(1).alias("alarm"), none("string").alias("global_status_label"), F.col("note_text").alias("diagnosis_text"), evidence_text().alias("analysis_text"),
        none("string").alias("recommendation_text"), none("struct<rpm1:double,rpm2:double,power_kw:double>").alias("operating_context"), none("int").alias("source_page"), F.array(one).alias("findings"),
    ).orderBy("observation_id")


def alarm_summary(checked: DataFrame) -> DataFrame:
    """One row: notes, alarms, what was kept out and why, published alarms by level, machines and dates."""
    kept = F.col("reject_reason").isNull()
    day = F.when(kept, F.date_format("measured_at_utc", "yyyy-MM-dd"))
    return checked.agg(
        F.count("*").alias("notes"), F.count("note_level").alias("alarms"), F.count_if(kept).alias("emitted"), F.count_if(F.col("reject_reason") == "unit_mismatch").alias("unit_mismatch"),
        F.count_if(F.col("reject_reason") == "incoherent").alias("incoherent"), F.count_distinct(F.when(kept, F.col("machine_id"))).alias("machines"),
        F.count_if(kept & (F.col("note_level") == "C")).alias("alert"), F.count_if(kept & (F.col("note_level") == "D")).alias("danger"), F.min(day).alias("first_observed"), F.max(day).alias("last_observed"),
    )


def with_machines(observations: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Observations with the machine of the crosswalk (normalized_tag, dataset_machine_id) where they name none."""
    known = crosswalk.select(plain(F.col("normalized_tag")).alias("_tag"), F.nullif(F.trim("dataset_machine_id"), F.lit("")).alias("_id")).where("_id is not null").groupBy("_tag").agg(F.max("_id").alias("_id"))
    joined = observations.withColumn("_tag", plain(F.col("normalized_tag"))).join(known, "_tag", "left")
    return joined.withColumn("dataset_machine_id", F.coalesce(F.nullif("dataset_machine_id", F.lit("")), "_id")).drop("_tag", "_id")


def consolidated(observations: DataFrame) -> DataFrame:
    """One observation per key, primary before the latest report, with the next date of its series as ``valid_to``.

    Rows stand in the order of their keys as text, a null as ``None``.
    """
    won = ordered.latest_primary(observations, DEDUPE_KEY)
    return ordered.valid_until(won, SERIES_KEY, "observed_at").orderBy(*[F.coalesce(F.col(k).cast("string"), F.lit("None")) for k in DEDUPE_KEY])


def conforming(df: DataFrame, schema: str) -> DataFrame:
    """Exactly the columns of a schema in its types; a column that is missing is null."""
    pairs = [c.strip().split(" ") for c in schema.split(",")]
    return df.select(*[(F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name) for name, kind in pairs])


def row_counts(tables: dict[str, DataFrame], per: str = "document_id") -> DataFrame:
    """Rows of each table by document: (table, document_id, rows)."""
    counted = [df.groupBy(per).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), per, "rows") for name, df in tables.items()]
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out
