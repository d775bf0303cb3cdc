"""Documents of an exported dataset: metric catalogue, acquisition modes and their bindings, machines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.functions.names import evidence
from tremor.operators import alarms, export_rows, inventory
from tremor.operators.database import Database

# Fixed values of the dataset contract.
SCHEMA_VERSION = "0.2.0"
CONTEXT_UNITS = {"load": "P1", "speed": "HTZ"}
NOTES = "Decoded from the record database; detailed acquisition metadata not decoded yet."
# End of the fixed values.


def metric_catalogue(db: Database) -> DataFrame:
    """Descriptors of all metrics by machine; one that is described in two ways is an error."""
    links = db.links().select("machine_id", "point_id", "template_index")
    series = db.readings().select("machine_id", "point_id", "units", F.size("bands").alias("columns")).distinct().join(links, ["machine_id", "point_id"])
    none = lambda *names: [F.lit(None).cast("float").alias(n) for n in names]
    bounds = ("low_hz", "high_hz", "low_order", "high_order")
    unit = F.when(F.col("units").isin("G's"), "G's").otherwise("mm/s")
    overall = series.select(
        "machine_id", "point_id", export_rows.overall_metric(unit, F.col("point_id")).alias("metric_id"), F.split(export_rows.overall_metric(unit, F.col("point_id")), "__")[0].alias("name"), unit.alias("unit"), *none(*bounds)
    ).distinct()
    bands = alarms.band_columns(db.templates())
    banded = series.join(bands, "template_index").where(F.col("columns") == F.col("active")).select(
        "machine_id", "point_id", export_rows.band_metric(F.col("band"), F.col("point_id")).alias("metric_id"), F.col("band").alias("name"), "unit", *bounds
    )
    rows = overall.unionByName(banded)
    described = export_rows.metric_rows(rows.select("metric_id", F.concat_ws("/", "machine_id", "point_id").alias("point_id"), "name", "unit", *bounds))
    own = described.select(F.split("point_id", "/")[0].alias("machine_id"), "*").withColumn("point_id", F.split("point_id", "/")[1]).withColumn("path", F.concat_ws(":", "point_id", "name"))
    captures = db.spectrum_refs().select("machine_id", "rpm").unionByName(db.waveform_refs().select("machine_id", "rpm"))
    context = captures.groupBy("machine_id").agg(F.max("rpm").alias("most")).select(
        "machine_id", F.explode(F.filter(F.array(F.lit("load"), F.when(F.col("most") > 0, F.lit("speed"))), lambda x: x.isNotNull())).alias("metric_id")
    )
    reserved = context.select(
        "machine_id", "metric_id", F.lit(export_rows.CONFIG_ID).alias("config_id"), F.lit(None).cast("string").alias("point_id"), F.col("metric_id").alias("name"), F.concat_ws(":", "machine_id", "metric_id").alias("path"),
        F.lit("value").alias("statistic"), F.lit("non_vibration").alias("signal_family"), F.lit(None).cast("string").alias("detector"),
        F.create_map(*[F.lit(x) for kv in CONTEXT_UNITS.items() for x in kv])[F.col("metric_id")].alias("unit"), F.lit(None).cast("boolean").alias("integrate"), F.lit("none").alias("band_type"),
        *none("band_low_hz", "band_high_hz", "band_low_order", "band_high_order"),
    )
    whole = own.unionByName(reserved).withColumn("flags", F.array().cast("array<string>"))
    keys = ["machine_id", "metric_id"]
    clashes = inventory.conflicts(whole, keys, ["name", "unit", "statistic", "band_low_hz", "band_high_hz", "band_low_order", "band_high_order"])
    checked = whole.join(clashes.withColumnRenamed("fields", "_clash"), keys, "left")
    return checked.where(F.assert_true(F.col("_clash").isNull(), F.concat_ws(" ", F.lit("metric described in two ways:"), "machine_id", "metric_id")).isNull()).drop("_clash")


def mode_shapes(spectra: DataFrame, waves: DataFrame) -> DataFrame:
    """(machine_id, point_id, proc_mode_id, definition_id, definition): the distinct modes that captures of points have.

    ``spectra``: (machine_id, point_id, unit, fmax_hz, n_lines); ``waves``: (…, unit,
    sample_rate_hz, n_samples). Digests are made once per distinct shape.
    """
    s = spectra.select("machine_id", "point_id", "unit", "fmax_hz", "n_lines").distinct()
    w = waves.select("machine_id", "point_id", "unit", "sample_rate_hz", "n_samples").distinct()
    fam = export_rows.family(F.col("unit"))

    def shaped(df: DataFrame, x: str, n: str, digest, wave: bool) -> DataFrame:
        shapes = df.select("unit", x, n).distinct().withColumn("definition_id", digest(fam, F.col(x), F.col(n))).withColumn("proc_mode_id", export_rows.mode_name(F.col("unit"), F.col(x), wave))
        number = lambda c: F.col(c).cast("double")
        spectrum = F.struct(fam.alias("signal_family"), F.lit(0.0).alias("fmin_hz"), number(x).alias("fmax_hz"), F.col(n).cast("long").alias("lines"), F.lit("peak").alias("detector"), F.lit(False).alias("power"), F.lit("hz_uniform").alias("grid_kind"))
        waveform = F.struct(fam.alias("signal_family"), number(x).alias("sample_rate_hz"), F.col(n).cast("long").alias("n_samples"))
        body = F.struct("definition_id", waveform.alias("waveform")) if wave else F.struct("definition_id", spectrum.alias("spectrum"))
        known = shapes.select("unit", x, n, "definition_id", "proc_mode_id", F.to_json(body).alias("definition"))
        return df.join(known, ["unit", x, n]).select("machine_id", "point_id", "proc_mode_id", "definition_id", "definition")

    return shaped(s, "fmax_hz", "n_lines", export_rows.spectrum_definition, False).unionByName(shaped(w, "sample_rate_hz", "n_samples", export_rows.waveform_definition, True))


def mode_definitions(shapes: DataFrame) -> DataFrame:
    """(machine_id, definition_id, definition) each mode of a machine once."""
    return shapes.select("machine_id", "definition_id", "definition").distinct()


def mode_bindings(shapes: DataFrame) -> DataFrame:
    """Which modes each point's tags stand for; one tag may have several."""
    return shapes.select("machine_id", "point_id", "proc_mode_id", "definition_id").distinct().select("*", F.lit(export_rows.CONFIG_ID).alias("config_id"), F.lit(NOTES).alias("notes"))


def _sorted_list(value: Column, *order: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(*order, value.alias("v")))), lambda x: x["v"])


def machine_documents(machines: DataFrame, points: DataFrame, shapes: DataFrame, source: dict[str, str]) -> DataFrame:
    """(machine_id, document): one null-free JSON document per machine, with its points, modes and bindings."""
    named = evidence(points, ["machine_id", "point_id", "point_slot", "bearing_designations", "nominal_speed_rpm"], "long_name")
    point = F.struct(
        F.col("point_id").alias("id"), F.col("long_name").alias("name"), "location", "direction", F.lit(export_rows.CONFIG_ID).alias("config_id"), "bearing_designations", "nominal_speed_rpm",
        F.array().cast("array<string>").alias("frequency_refs"),
    )
    p = named.groupBy("machine_id").agg(_sorted_list(point, "point_slot").alias("points"))
    d = mode_definitions(shapes).groupBy("machine_id").agg(_sorted_list(F.col("definition"), "definition_id").alias("definitions"))
    binding = F.struct("point_id", "proc_mode_id", "definition_id", "config_id", "notes")
    b = mode_bindings(shapes).groupBy("machine_id").agg(_sorted_list(binding, "point_id", "proc_mode_id", "config_id", "definition_id").alias("mode_bindings"))
    joined = machines.join(p, "machine_id", "left").join(d, "machine_id", "left").join(b, "machine_id", "left")
    empty = F.array().cast("array<string>")
    listed = lambda c, like: F.coalesce(c, F.array().cast(like.schema[c].dataType)).alias(c)
    body = F.struct(
        F.lit(SCHEMA_VERSION).alias("schema_version"), F.struct(*[F.lit(v).alias(k) for k, v in source.items()]).alias("source"),
        F.struct(F.col("machine_id").alias("id"), F.col("machine_name").alias("name"), F.array("area_name").alias("path"), empty.alias("frequencies")).alias("machine"),
        listed("points", p), F.lit("@definitions@").alias("mode_definitions"), listed("mode_bindings", b), empty.alias("config_generations"), empty.alias("states"),
    )
    # definitions are JSON already, of two kinds
    definitions = F.concat(F.lit("["), F.array_join(F.coalesce("definitions", empty), ","), F.lit("]"))
    return joined.select("machine_id", F.replace(F.to_json(body), F.lit('"@definitions@"'), definitions).alias("document"))


def sample_index(spectra: DataFrame, waves: DataFrame, readings: DataFrame) -> DataFrame:
    """One row per capture without its samples, for tools that look captures up: (sample_id, machine_id, point_id, kind, record_num, timestamp_utc, n)."""
    kinds = [(spectra, "fft", F.col("n_lines")), (waves, "waveform", F.col("n_samples")), (readings, "trend", F.lit(1))]
    rows = [
        df.select("machine_id", "point_id", F.lit(kind).alias("kind"), "record_num", F.col("timestamp_utc"), n.cast("long").alias("n"), (F.col("k") if kind == "trend" else F.lit(None)).cast("string").alias("place"))
        for df, kind, n in kinds
    ]
    both = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return both.withColumn("sample_id", sample_id(F.col("point_id"), F.col("record_num"), F.col("kind"), F.col("place"))).drop("place")


def sample_id(point: Column, record: Column, kind: Column, place: Column | None = None) -> Column:
    """Identity of a capture: the first 16 hex digits of the SHA-1 of point, record, kind and, where there are several in a record, the place."""
    parts = [point.cast("string"), record.cast("string"), kind] + ([] if place is None else [place])
    return F.substring(F.sha1(F.concat_ws(":", *parts)), 1, 16)


def export_summary(written: DataFrame) -> DataFrame:
    """One row from (machine_id, table, rows, error): machines, those with rows and those that failed, rows of each table."""
    per = written.groupBy("machine_id").agg(F.sum("rows").alias("rows"), F.max(F.col("error").isNotNull()).alias("failed"), *[F.sum(F.when(F.col("table") == t, F.col("rows"))).alias(t) for t in ("spectra", "waves", "trends")])
    return per.agg(
        F.count("*").alias("machines"), F.count_if(F.col("rows") > 0).alias("machines_with_rows"), F.count_if("failed").alias("failed"), *[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in ("spectra", "waves", "trends")]
    )


def date_span(first: Column, last: Column) -> Column:
    """``first → last`` as days; one day where they are the same, a dash without any."""
    a, b = F.date_format(first, "yyyy-MM-dd"), F.date_format(last, "yyyy-MM-dd")
    return F.when(first.isNull() | last.isNull(), "-").when(a == b, a).otherwise(F.concat(a, F.lit(" → "), b))
