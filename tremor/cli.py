"""Commands over a record file, dataset or table folder: ``python -m tremor COMMAND ...``."""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor import producer_name
from tremor.functions.names import file_name, hex_dump
from tremor.operators import chains, documents, export_rows, findings, ground_truth, inventory, pages, reconcile
from tremor.operators.database import Database
from tremor.operators.signals import capture_context
from tremor.sources import dataset, overlays
from tremor.sources.records import read_records, tag_frequencies

log = logging.getLogger("tremor")
#: Points of one name that are listed where a name isn't enough.
LISTED = 100


class CommandError(Exception):
    """A command that can't do what it was asked; ``code`` is the exit code."""

    def __init__(self, message: str, code: int = 1) -> None:
        super().__init__(message)
        self.code = code


def _filtered(df: DataFrame, area: str | None, equipment: str | None) -> DataFrame:
    """Substring filters without regard to case, on either name of the area and the machine's long name."""
    if area:
        df = df.where(F.contains(F.lower(F.concat_ws(" ", "area_name", "area_code")), F.lit(area.lower())))
    if equipment:
        df = df.where(F.contains(F.lower("machine_name"), F.lit(equipment.lower())))
    return df


def info(db: Database, a: argparse.Namespace) -> DataFrame:
    return db.header().select("signature", "tag", "description", "created_at")


def tree(db: Database, a: argparse.Namespace) -> DataFrame:
    """One nested document: areas, their machines, their points, each with counts; also as a file with ``--out``."""
    p = db.points().groupBy("machine_id").agg(F.array_sort(F.collect_list(F.struct("point_slot", "point_id", "long_name", "bearing_designations", "nominal_speed_rpm"))).alias("points"))
    counted = db.machines().join(p, "machine_id", "left").withColumn("n_points", F.coalesce(F.size("points"), F.lit(0)))
    m = counted.groupBy("area_ordinal").agg(
        F.array_sort(F.collect_list(F.struct("hop", "slot", "machine_id", "machine_name", "n_points", "points"))).alias("machines"), F.count("*").alias("n_machines"), F.sum("n_points").alias("n_points")
    )
    out = db.areas().join(m, "area_ordinal", "left").fillna(0, ["n_machines", "n_points"]).orderBy("area_ordinal")
    if getattr(a, "out", None):
        whole = out.agg(F.count("*").alias("n_areas"), F.sum("n_machines").alias("n_machines"), F.sum("n_points").alias("n_points"), F.array_sort(F.collect_list(F.struct(*out.columns))).alias("areas"))
        dataset.write_document(a.out, whole, {"generator": producer_name(), "source": os.path.basename(db.path)})
    return out


def summary(db: Database, a: argparse.Namespace) -> DataFrame:
    """Totals of the database; areas without machines don't count."""
    return inventory.database_totals(_filtered(db.per_machine(), a.area, a.equipment)) if a.area or a.equipment else db.totals()


def stats(db: Database, a: argparse.Namespace) -> DataFrame:
    """Captures per machine by kind, machines without any included, largest first."""
    m = _filtered(db.per_machine(), a.area, a.equipment)
    total = m.select("area_name", "machine_id", "n_points", "fft", "waveform", "trend", (F.col("fft") + F.col("waveform") + F.col("trend")).alias("total"))
    return inventory.top_n(total, a.sort, ["area_name", "machine_id"], a.limit)


def points(db: Database, a: argparse.Namespace) -> DataFrame:
    p = _filtered(db.points(), a.area, a.equipment).select("machine_id", "point_id", "long_name")
    spans = db.summaries().withColumn("span", documents.date_span(F.col("first_at"), F.col("last_at")))
    return p.join(spans, ["machine_id", "point_id"], "left").orderBy("machine_id", "point_id", "kind")


def report(db: Database, a: argparse.Namespace) -> DataFrame:
    """Machine, area and grand totals."""
    m = _filtered(db.machines(), a.area, None).select("area_name", "machine_id")
    return inventory.rolled_up(m, db.summaries(), "machine_id", ["area_name", "machine_id"], {"captures": F.sum("n")}).orderBy("area_name", "machine_id")


def scan(db: Database, a: argparse.Namespace) -> DataFrame:
    f = tag_frequencies(read_records(db.spark, db.path)).orderBy(F.desc("n"), "tag")
    return f.limit(a.limit) if a.limit else f


def alarm_notes(db: Database, a: argparse.Namespace) -> DataFrame:
    """What became of the stored alarms; with ``--out`` their document is written there and the folder's tables anew."""
    checked = db.checked_notes()
    out = getattr(a, "out", None)
    if out:
        stem = os.path.splitext(os.path.basename(db.path))[0]
        o = db.alarm_observations(f"alarms:{stem}")
        one = o.agg(F.array_sort(F.collect_list(F.struct(*o.columns))).alias("observations"), F.min("observed_at").alias("from"), F.max("observed_at").alias("to"))  # one database's alarms are a document
        provenance = {
            "origin": "system-alarm", "document_id": f"alarms:{stem}", "source_ref": os.path.basename(db.path), "source_sha256": dataset.sha256_of(db.path), "client": getattr(a, "client", "") or "", "plant": getattr(a, "plant", "") or "",
            "extractor": producer_name(), "extracted_at": dataset.utc_now(), "extraction_method": "structured_read",
        }
        document = one.select(
            F.struct(*[F.lit(v).alias(k) for k, v in provenance.items()], F.struct("from", "to").alias("measurement_period")).alias("provenance"),
            F.array().cast("array<string>").alias("machines_stopped"), F.array().cast("array<string>").alias("machines_not_measured"), "observations",
        )
        dataset.write_document(f"{out}/{stem}.json", document, {"kind": "diagnosis_ground_truth"})
        dataset.materialize(db.spark, out)
    return ground_truth.alarm_summary(checked)


def located(db: Database, name: str, equipment: str | None) -> dict:
    """The one point of exactly this long name, on machines whose name contains ``equipment``; none or several is an error."""
    found = _filtered(db.points(), None, equipment).where(F.col("long_name") == name).select("machine_id", "point_id", "record_num").limit(LISTED).collect()
    if not found:
        raise CommandError(f"no point {name!r}" + (f" on machines like {equipment!r}" if equipment else ""))
    if len(found) > 1:
        raise CommandError(f"{len(found)} points {name!r}; name the machine: " + ", ".join(sorted(r["machine_id"] for r in found)), 2)
    return found[0].asDict()


def extract(db: Database, a: argparse.Namespace) -> DataFrame:
    """Captures of one point as files: the first ``--limit`` spectra and waveforms, one file each, or the whole trend."""
    at = located(db, a.point, a.equipment)
    kinds = {"both": ("fft", "waveform")}.get(a.type, (a.type,))
    base = f"{a.out}/{at['machine_id']}__{file_name(a.point)}"
    mine = (F.col("machine_id") == at["machine_id"]) & (F.col("point_id") == at["point_id"])
    made = []
    for kind in kinds:
        table = {"fft": db.spectra, "waveform": db.waveforms, "trend": db.trends}[kind]().where(mine)
        if kind == "trend":
            n = table.count()
            if n:
                table.orderBy("t").coalesce(1).write.mode("overwrite").parquet(f"{base}__trend.parquet")
            made.append((kind, n))
            continue
        chosen = [r["record_num"] for r in table.orderBy("hop").select("record_num").limit(a.limit or 3).collect()]  # a handful
        for record in chosen:
            capture(table, record).coalesce(1).write.mode("overwrite").parquet(f"{base}__{kind}__{record}.parquet")
        made.append((kind, len(chosen)))
    if not sum(n for _, n in made):
        log.warning("no captures of %s", a.point)
    return db.spark.createDataFrame(made, "kind string, written long")


def capture(table: DataFrame, record: int) -> DataFrame:
    """One capture by the number of its record."""
    return table.where(F.col("record_num") == record)


def dump(db: Database, a: argparse.Namespace) -> str:
    """One record as hex and ASCII."""
    row = read_records(db.spark, db.path).where(F.col("record_num") == a.record).select("rec").first()
    if row is None:
        raise CommandError(f"no record {a.record}")
    return hex_dump(bytes(row["rec"]), a.record * 512)


def follow(db: Database, a: argparse.Namespace) -> DataFrame:
    """A chain from one record on, by the number at an offset, with the reason of its end."""
    walk = chains.debug_walk(read_records(db.spark, db.path), a.record, a.at, a.max_steps)
    return db.spark.createDataFrame(walk, "record long, next long, stop string")


def _chosen(db: Database, areas: str | None) -> DataFrame:
    """Machines of the areas named exactly, by either name and without regard to case; what matches none is told."""
    m = db.machines()
    if not areas:
        return m
    wanted = db.spark.createDataFrame([(x.strip().lower(),) for x in areas.split(",") if x.strip()], "token string").distinct()
    known = db.areas().select(F.explode(F.array(F.lower("area_name"), F.lower("area_code"))).alias("token"), "area_ordinal")
    for r in wanted.join(known, "token", "left_anti").collect():  # what a user typed
        log.warning("no area %s", r["token"])
    return m.join(known.join(wanted, "token").select("area_ordinal").distinct(), "area_ordinal", "left_semi")


def export(db: Database, a: argparse.Namespace) -> DataFrame:
    """The dataset: its document, a folder per machine with documents and tables; a row per machine and table comes back."""
    dataset.prepare_folder(a.out)
    m = _chosen(db, a.areas)
    kinds = set(a.types.split(","))
    spectra, waves, trends = db.spectra(), db.waveforms(), db.trends()
    context = spectra.select("machine_id", "timestamp_utc", "rpm", "load_pct").unionByName(waves.select("machine_id", "timestamp_utc", "rpm", "load_pct"))
    ctx = capture_context(context, F.unix_micros("timestamp_utc"), F.col("rpm"), F.col("load_pct"), ["machine_id"]).withColumn("alarm", F.lit(None).cast("tinyint"))
    t = ctx.select("machine_id", "t", "metric_id", "value", "alarm")
    if "trend" in kinds:
        metric = F.when(F.col("band").isNull(), export_rows.overall_metric(F.col("unit"), F.col("point_id"))).otherwise(export_rows.band_metric(F.col("band"), F.col("point_id")))
        t = t.unionByName(trends.select("machine_id", "t", metric.alias("metric_id"), F.col("value").cast("double"), "alarm"))

    def keyed(df: DataFrame, make) -> DataFrame:
        """Rows of a table with their machine, carried through in the point's id."""
        both = make(df.withColumn("point_id", F.concat_ws("/", "machine_id", "point_id")))
        return both.select(F.split("point_id", "/")[0].alias("machine_id"), "*").withColumn("point_id", F.split("point_id", "/")[1])

    tables = {"trends": (t.select("machine_id", "t", F.lit(None).cast("long").alias("snap_t"), "metric_id", F.col("value").cast("float").alias("value"), "alarm", F.lit(export_rows.CONFIG_ID).alias("config_id")), ["metric_id", "t"])}
    fft, wave = (spectra if "fft" in kinds else spectra.limit(0)), (waves if "waveform" in kinds else waves.limit(0))
    tables["spectra"] = (keyed(fft, export_rows.spectrum_rows), ["point_id", "t"])
    tables["waves"] = (keyed(wave, export_rows.waveform_rows), ["point_id", "t"])
    written = [
        dataset.write_machines(df.join(m.select("machine_id"), "machine_id", "left_semi"), m, a.out, name, order).withColumn("table", F.lit(name))
        for name, (df, order) in tables.items()
    ]
    source = {"origin": "record-database", "extractor": producer_name(), "extracted_at": dataset.utc_now(), "source_ref": db.path}
    described = documents.machine_documents(m, db.points(), documents.mode_shapes(fft, wave), source)
    catalogue = documents.metric_catalogue(db)
    own = catalogue.join(m.select("machine_id"), "machine_id", "left_semi")
    metrics = own.groupBy("machine_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct(*[c for c in own.columns if c != "machine_id"])))).alias("document"))
    texts = dataset.write_texts(described, a.out, "machine.json").unionByName(dataset.write_texts(metrics, a.out, "metric_catalog.json"))
    header = db.header().select("description")
    path = getattr(a, "dataset_path", None)
    meta = {"schema_version": documents.SCHEMA_VERSION, "name": os.path.splitext(os.path.basename(db.path))[0]} | ({"path": path.split("/")} if path else {}) | {"generator": producer_name(), "created_at": dataset.utc_now()}
    dataset.write_document(f"{a.out}/dataset.json", header, meta)
    return written[0].unionByName(written[1]).unionByName(written[2]).unionByName(texts).orderBy("machine_id", "table")


def index(db: Database, a: argparse.Namespace) -> DataFrame:
    """Every capture without its samples."""
    def timed(df: DataFrame) -> DataFrame:
        return df.withColumn("record_num", F.col("node")).withColumn("timestamp_utc", F.timestamp_seconds("ts"))

    return documents.sample_index(timed(db.spectrum_refs()), timed(db.waveform_refs()), db.readings().withColumn("timestamp_utc", F.timestamp_seconds("ts")))


def reports(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Documents and tables from the words of report pages (a Parquet table); lost dated entries are an error."""
    words = spark.read.parquet(a.path)
    broken = pages.broken_anchors(pages.read_pages(words)).limit(LISTED).collect()
    if broken:
        raise CommandError("dated entries were lost on " + ", ".join(f"{r['document_id']} page {r['page']}" for r in broken))
    meta = {"origin": overlays.ORIGIN, "extractor": producer_name(), "extracted_at": dataset.utc_now(), "extraction_method": "rules"}
    made = pages.report_documents(words, meta)
    os.makedirs(a.out, exist_ok=True)
    out = dataset.write_texts(made.select(F.col("source_ref").alias("machine_id"), F.to_json(F.struct(*[c for c in made.columns if c != "source_ref"])).alias("document")), a.out, None).collect()  # a row per report
    dataset.materialize(spark, a.out)
    return spark.createDataFrame([(r["machine_id"], r["error"]) for r in out], "document string, error string")


def weights(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Documents of a folder with the weights of an overlay, and their tables; an overlay that is unusable or doesn't fit is an error."""
    judgements = overlays.read_overlay(spark, a.overlay)
    faults = overlays.overlay_faults(judgements).limit(LISTED).collect()
    if faults:
        raise CommandError("unusable overlay: " + "; ".join(f"{r['fault']} ({(r['diagnosis_text'] or '')[:60]})" for r in faults))
    read = dataset.read_diagnoses(spark, f"{a.path}/*.json").where("kind is not null and provenance.document_id is not null")
    made = overlays.apply_overlay(read, judgements)
    out = a.out or a.path
    os.makedirs(out, exist_ok=True)
    named = made.select(F.regexp_replace("provenance.document_id", "[^A-Za-z0-9._-]+", "_").alias("machine_id"), F.to_json(F.struct("kind", "provenance", "observations")).alias("document"))
    stored = dataset.write_texts(named, out, None).collect()  # a row per report
    dataset.materialize(spark, out)
    for r in overlays.unused(read.select(F.explode("observations").alias("o")).select("o.*"), judgements).limit(LISTED).collect():
        log.warning("judged text that no observation has: %s", r["diagnosis_text"][:60])
    return spark.createDataFrame([(r["machine_id"], r["error"]) for r in stored], "document string, error string")


def reconciled(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """crosswalk.csv and a report of open cases for the documents of ``--out`` against the dataset at ``path``."""
    rows = dataset.observation_rows(dataset.read_diagnoses(spark, f"{a.out}/*.json"))
    machines = reconcile.dataset_machines(spark, a.path)
    built = reconcile.build_crosswalk(reconcile.unresolved_tags(rows), machines).cache()
    built.coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{a.out}/crosswalk.parts")
    dataset.single_file(f"{a.out}/crosswalk.parts", f"{a.out}/crosswalk.csv")
    cases, free = reconcile.open_cases(built, machines), reconcile.free_machines(built, machines)
    text = ["# Tags without a machine", reconcile.markdown_table(cases.drop("dataset_machine_id", "match_rule", "candidates")), "# Machines without a tag", reconcile.markdown_table(free)]
    with open(f"{a.out}/crosswalk.md", "w", encoding="utf-8") as file:
        file.write("\n\n".join(text) + "\n")
    for r in reconcile.area_mismatches(built, machines).limit(LISTED).collect():
        log.warning("%s: report says %s, dataset %s", r["normalized_tag"], r["area_name"], r["machine_path"])
    dataset.materialize(spark, a.out)
    return built


def audit(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Clauses of a folder's documents that no rule reads, by class; also as Markdown with ``--out``."""
    rows = dataset.observation_rows(dataset.read_diagnoses(spark, f"{a.path}/*.json"))
    found = findings.unmapped_audit(rows, "diagnosis_text").orderBy("cls")
    if a.out:
        with open(a.out, "w", encoding="utf-8") as file:
            file.write(reconcile.markdown_table(found) + "\n")
    return found


COMMANDS = {
    "info": info, "tree": tree, "report": report, "stats": stats, "summary": summary, "points": points, "scan": scan, "alarms": alarm_notes, "extract": extract, "dump": dump, "follow": follow, "index": index, "export": export,
}
#: Commands over folders instead of a record file.
FOLDERS = {"reports": reports, "weights": weights, "crosswalk": reconciled, "audit": audit}


class _JsonLines(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        return json.dumps({"level": record.levelname.lower(), "event": record.getMessage()}, ensure_ascii=False)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tremor", description=__doc__)
    parser.add_argument("command", choices=[*COMMANDS, *FOLDERS, "package", "query"])
    parser.add_argument("path", help="record file; dataset folder (package, crosswalk); documents (weights, audit); words (reports); tables (query)")
    parser.add_argument("--name", help="query to run")
    parser.add_argument("--area")
    parser.add_argument("--areas")
    parser.add_argument("--equipment")
    parser.add_argument("--sort", default="total", choices=["total", "fft", "waveform", "trend"])
    parser.add_argument("--limit", type=int, default=0)
    parser.add_argument("--types", default="fft,waveform")
    parser.add_argument("--type", default="both", choices=["fft", "waveform", "both", "trend"])
    parser.add_argument("--point")
    parser.add_argument("--record", type=int, default=0)
    parser.add_argument("--at", type=int, default=0, help="offset of the number to follow")
    parser.add_argument("--max-steps", type=int, default=32)
    parser.add_argument("--overlay")
    parser.add_argument("--dataset-path", help="levels above the dataset, outermost first, by slashes")
    parser.add_argument("--client")
    parser.add_argument("--plant")
    parser.add_argument("--out")
    parser.add_argument("--log-level", default="warning", choices=["debug", "info", "warning", "error"])
    parser.add_argument("--log-json", action="store_true")
    parser.add_argument("--version", action="version", version=producer_name())
    a = parser.parse_args(argv)
    handler = logging.StreamHandler(sys.stderr)
    handler.setFormatter(_JsonLines() if a.log_json else logging.Formatter("%(levelname)s %(message)s"))
    log.handlers, log.propagate = [handler], False
    log.setLevel(a.log_level.upper())
    if a.command in ("export", "extract") and not a.out:
        a.out = "dataset" if a.command == "export" else "samples"
    try:
        return _run(a, parser, spark)
    except (CommandError, OSError, ValueError) as e:
        log.error("%s", e)
        return getattr(e, "code", 1)


def _run(a: argparse.Namespace, parser: argparse.ArgumentParser, spark: SparkSession | None) -> int:
    if a.command == "package":
        print(dataset.package(a.path, a.out if (a.out or "").endswith(".zip") else None))
        return 0
    if not os.path.exists(a.path):
        raise CommandError(f"not found: {a.path}")
    from tremor.session import local_session

    spark = spark or local_session("*")
    if a.command == "query":
        from tremor.plans.catalogue import QUERIES

        if a.name not in QUERIES:
            parser.error(f"no query {a.name}; there are: {', '.join(QUERIES)}")
        out = QUERIES[a.name](spark, a.path)
    elif a.command in FOLDERS:
        out = FOLDERS[a.command](spark, a)
    else:
        out = COMMANDS[a.command](Database(spark, a.path), a)
    if isinstance(out, str):
        print(out)
        return 0
    for row in out.toJSON().toLocalIterator():
        print(json.dumps(json.loads(row), ensure_ascii=False))
    return 0
