"""The dataset on disk: one folder per machine, null-free documents, manifest, archive.

Tables are written by one task per group of machines through the driver's committed
folder layout ``machine=<id>/<table>.parquet``; reading them back is a glob with the
machine as partition column, kept as text.
"""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import zipfile
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tremor.operators import ground_truth

KEPT = ("ground-truth", "analysis")


def prepare_folder(out: str) -> None:
    """An empty folder but for what isn't ours; refuses roots, homes, working folders and repositories."""
    path = Path(out).resolve()
    if path in (Path("/"), Path.home().resolve(), Path.cwd().resolve()) or (path / ".git").exists():
        raise ValueError(f"won't clear {path}")
    path.mkdir(parents=True, exist_ok=True)
    for child in path.iterdir():
        if child.name not in KEPT:
            shutil.rmtree(child) if child.is_dir() and not child.is_symlink() else child.unlink()


def required(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows as they are; a null in a required column is an error when they are read."""
    checks = [F.assert_true(F.col(c).isNotNull(), F.lit(f"null in {c}")).isNull() for c in columns]
    for check in checks:
        df = df.where(check)
    return df


class _MachineFile:
    """One machine's file while its rows stream by: written beside its place, put there when whole."""

    def __init__(self, out: str, machine: str, table: str, schema: pa.Schema) -> None:
        self.machine, self.schema, self.rows = machine, schema, 0
        self.error: str | None = None
        self.target = Path(out) / f"machine={machine}" / f"{table}.parquet"
        self.part = self.target.with_suffix(f".{os.getpid()}.part")
        self.writer: pq.ParquetWriter | None = None
        self._try(self._open)

    def _try(self, step, *args) -> None:
        if self.error is None:
            try:
                step(*args)
            except Exception as e:  # told per machine, the rest goes on
                self.error = f"{type(e).__name__}: {e}"

    def _open(self) -> None:
        self.target.parent.mkdir(parents=True, exist_ok=True)
        self.writer = pq.ParquetWriter(self.part, self.schema, compression="zstd")

    def _put(self, rows: pa.Table) -> None:
        self.writer.write_table(rows.cast(self.schema))
        self.rows += rows.num_rows

    def add(self, rows: pa.Table) -> None:
        self._try(self._put, rows)

    def close(self) -> tuple[str, int, str | None]:
        if self.writer is not None:
            self._try(self.writer.close)
        self._try(os.replace, self.part, self.target)  # a task that runs twice leaves one whole file
        return self.machine, self.rows if self.error is None else 0, self.error


def write_machines(df: DataFrame, machines: DataFrame, out: str, table: str, order: list[str]) -> DataFrame:
    """One file per machine, also for machines without rows; returns machine_id, rows and error of each.

    ``out`` is a folder that all executors share. Rows come sorted by machine and
    order and are written as they come, so no task holds a machine; failures are
    reported per machine and don't stop the rest.
    """
    columns = [f for f in df.schema.fields if f.name != "machine_id"]
    schema = to_arrow_schema(type(df.schema)(columns))
    all_ = machines.select("machine_id").distinct().join(df.withColumn("_row", F.lit(True)), "machine_id", "left")
    kind = pa.schema([("machine_id", pa.string()), ("rows", pa.int64()), ("error", pa.string())])

    def done(files: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(kind.names, f, strict=True)) for f in files], schema=kind)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _MachineFile | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            names = rows["machine_id"].to_pylist()
            starts = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]], len(names)]
            finished = []
            for a, b in zip(starts, starts[1:], strict=False):
                if current is None or current.machine != names[a]:
                    if current is not None:
                        finished.append(current.close())
                    current = _MachineFile(out, names[a], table, schema)
                part = rows.slice(a, b - a)
                current.add(part.filter(part["_row"].is_valid()).select(schema.names))
            if finished:
                yield done(finished)
        if current is not None:
            yield done([current.close()])

    placed = all_.repartition("machine_id").sortWithinPartitions("machine_id", *order)
    return placed.mapInArrow(write, "machine_id string, rows long, error string")


def write_texts(df: DataFrame, out: str, name: str | None) -> DataFrame:
    """One text file per row of (machine_id, document): ``machine=<id>/<name>``, or ``<id>.json`` without a name.

    As rows of ``write_machines``: machine_id, rows, error, table.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            done = []
            for machine, document in zip(rows["machine_id"], rows["document"], strict=True):
                target = Path(out) / f"machine={machine}" / name if name else Path(out) / f"{machine}.json"
                try:
                    target.parent.mkdir(parents=True, exist_ok=True)
                    part = target.with_suffix(f".{os.getpid()}.part")
                    part.write_text(json.dumps(json.loads(document), ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
                    os.replace(part, target)
                    done.append((machine, 1, None))
                except (OSError, ValueError) as e:
                    done.append((machine, 0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(done, columns=["machine_id", "rows", "error"])

    return df.select("machine_id", "document").mapInPandas(write, "machine_id string, rows long, error string").withColumn("table", F.lit(name or "document"))


def single_file(folder: str, target: str) -> None:
    """The one data file of a folder written by one task, put in its place under a name of its own."""
    (part,) = [p for p in Path(folder).iterdir() if p.name.startswith("part-")]
    os.replace(part, target)
    shutil.rmtree(folder)


def read_machines(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of all machines with the machine as text, whatever it looks like."""
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return spark.read.option("basePath", root).parquet(f"{root}/machine=*/{table}.parquet")


def documents(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Null-free JSON per row: absence and null say the same; nulls inside lists stay."""
    return df.select(key, F.to_json(F.struct(*fields), {"ignoreNullFields": "true"}).alias("document"))


def sha256_of(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as file:
        while chunk := file.read(1 << 20):
            digest.update(chunk)
    return digest.hexdigest()


def _sha256_of_parts(path: str) -> str:
    """Digest of a file, or of all data files of a folder in the order of their names."""
    if os.path.isfile(path):
        return sha256_of(path)
    digest = hashlib.sha256()
    for part in sorted(Path(path).rglob("*.parquet")):
        digest.update(bytes.fromhex(sha256_of(str(part))))
    return digest.hexdigest()


def _write_json(path: Path, body: dict) -> None:
    part = path.with_suffix(".part")
    part.write_text(json.dumps(body, indent=2, ensure_ascii=False) + "\n", encoding="utf-8")
    os.replace(part, path)


def utc_now() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds").replace("+00:00", "Z")


def write_manifest(out: str, tables: dict[str, int], inputs: list[str], policy: str = "dedup-primary-latest/1.0", counts: dict[str, int] | None = None) -> dict:
    """What was made of what: hashes and row counts."""
    body = {
        "created_at": utc_now(),
        "policy": policy,
        "inputs": [{"path": os.path.basename(p), "sha256": sha256_of(p)} | ({"observations": (counts or {}).get(os.path.basename(p), 0)} if counts is not None else {}) for p in sorted(inputs)],
        "outputs": [{"path": name, "rows": n} | ({"sha256": _sha256_of_parts(f"{out}/{name}")} if os.path.exists(f"{out}/{name}") else {}) for name, n in sorted(tables.items())],
    }
    Path(out).mkdir(parents=True, exist_ok=True)
    _write_json(Path(out) / "materialization.json", body)
    return body


#: Projections of earlier formats, put away when the tables are written anew. Fixed values.
LEGACY = ("observations.csv", "findings.csv", "observations_system.csv", "observations_system.parquet")
TABLES = {"observations.parquet": ground_truth.OBSERVATIONS, "observations_consolidated.parquet": ground_truth.CONSOLIDATED, "findings.parquet": ground_truth.FINDINGS}


def read_crosswalk(spark: SparkSession, folder: str) -> DataFrame:
    """(normalized_tag, dataset_machine_id) of the folder's crosswalk.csv, trimmed, without blanks; empty without the file."""
    path = f"{folder}/crosswalk.csv"
    if not os.path.exists(path):
        return spark.createDataFrame([], "normalized_tag string, dataset_machine_id string")
    rows = spark.read.option("header", "true").csv(path)
    both = rows.select(F.trim("normalized_tag").alias("normalized_tag"), F.trim("dataset_machine_id").alias("dataset_machine_id"))
    return both.where("normalized_tag <> '' and dataset_machine_id <> ''")


def ground_truth_tables(diagnoses: DataFrame, crosswalk: DataFrame) -> dict[str, DataFrame]:
    """The three tables of diagnosis documents: all observations, the consolidated ones, the findings."""
    rows = observation_rows(diagnoses)
    whole = ground_truth.with_machines(rows, crosswalk)
    beside = whole.select("document_id", "observation_id", "place", "dataset_machine_id", "observed_at", "modality", "record_kind")
    found = finding_rows(diagnoses).join(beside, ["document_id", "observation_id", "place"])
    frames = (whole, ground_truth.consolidated(whole), found)
    return {name: ground_truth.conforming(df, schema) for (name, schema), df in zip(TABLES.items(), frames, strict=True)}


def materialize(spark: SparkSession, folder: str, crosswalk: DataFrame | None = None) -> dict:
    """Writes the tables of all documents (``*.json``) of a folder and the manifest of what was made of what.

    Each table is a Parquet folder (zstd) with the contract's columns; a folder without
    documents is an error; projections of earlier formats go.
    """
    inputs = sorted(str(p) for p in Path(folder).glob("*.json") if p.name != "materialization.json")
    if not inputs:
        raise ValueError(f"no documents in {folder}")
    diagnoses = spark.read.schema(DIAGNOSES).option("multiLine", "true").json(inputs).withColumn("_file", F.input_file_name())
    tables = ground_truth_tables(diagnoses, read_crosswalk(spark, folder) if crosswalk is None else crosswalk)
    rows = {}
    for name, df in tables.items():
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}")
        rows[name] = spark.read.parquet(f"{folder}/{name}").count()
    per_file = {os.path.basename(r["_file"]): r["n"] for r in diagnoses.select("_file", F.coalesce(F.size("observations"), F.lit(0)).alias("n")).collect()}  # one row per document
    for name in LEGACY:
        old = Path(folder) / name
        if old.is_file():
            old.unlink()
    return write_manifest(folder, rows, inputs, counts=per_file)


def write_document(path: str, document: DataFrame, meta: dict | None = None) -> None:
    """One document as JSON: the row of ``document`` without nulls, beside what ``meta`` says."""
    rows = document.limit(2).toJSON().collect()
    if len(rows) != 1:
        raise ValueError("a document is one row")
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    _write_json(Path(path), (meta or {}) | json.loads(rows[0]))


def _entries(root: Path) -> Iterator[Path]:
    for path in sorted(root.rglob("*")):
        if path.is_symlink():
            raise ValueError(f"a link within the dataset: {path}")
        if path.is_file():
            name = path.relative_to(root).as_posix()
            if name.startswith("/") or ".." in name.split("/"):
                raise ValueError(f"unsafe name: {name}")
            yield path


def package(root: str, target: str | None = None) -> str:
    """A ZIP of the dataset, put in place at once when it is whole."""
    base = Path(root)
    if not base.is_dir():
        raise ValueError(f"no dataset at {root}")
    out = Path(target or f"{base}.zip")
    part = out.with_suffix(".part")
    try:
        with zipfile.ZipFile(part, "w", zipfile.ZIP_DEFLATED) as archive:
            for path in _entries(base):
                if path not in (out, part):
                    archive.write(path, path.relative_to(base).as_posix())
        os.replace(part, out)
    finally:
        part.unlink(missing_ok=True)
    return str(out)


#: Schema of diagnosis documents: unknown keys are left out on reading.
DIAGNOSES = (
    "kind string, provenance struct<origin:string,document_id:string,inspection_date:string,source_ref:string>, "
    "observations array<struct<observation_id:string,record_kind:string,machine:struct<external_tag:string,external_name:string,normalized_tag:string,"
    "area_code:string,area_name:string,dataset_machine_id:string>,modality:string,observed_at:string,status:string,status_source_label:string,alarm:int,"
    "global_status_label:string,diagnosis_text:string,analysis_text:string,recommendation_text:string,operating_context:struct<rpm1:double,rpm2:double,power_kw:double>,"
    "source_page:int,findings:array<struct<source_text:string,matched_text:string,fault_mode:string,fault_group:string,label_quality:string,mapping_rule:string,weight:double>>>>"
)


def read_diagnoses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DIAGNOSES).option("multiLine", "true").json(path)


def observation_rows(diagnoses: DataFrame) -> DataFrame:
    """One flat row per observation, complete, with its place in the document."""
    o = diagnoses.select("provenance", F.posexplode("observations").alias("place", "o"))
    return o.select(
        "place", F.col("provenance.document_id").alias("document_id"), "o.observation_id", F.col("provenance.origin").alias("origin"), "o.record_kind", "o.machine.*",
        "o.modality", "o.observed_at", F.col("provenance.inspection_date").alias("inspection_date"), "o.status", "o.status_source_label", F.col("o.alarm").cast("tinyint").alias("alarm"),
        "o.global_status_label", "o.diagnosis_text", "o.analysis_text", "o.recommendation_text", "o.operating_context.*", "o.source_page",
        F.coalesce(F.size("o.findings"), F.lit(0)).alias("n_findings"),
    )


def finding_rows(diagnoses: DataFrame) -> DataFrame:
    """One row per finding with its contiguous index in its observation."""
    o = diagnoses.select("provenance.document_id", F.posexplode("observations").alias("place", "o"))
    return o.select("document_id", "o.observation_id", "place", F.posexplode("o.findings").alias("finding_index", "f")).select("document_id", "observation_id", "place", "finding_index", "f.*")
