"""Reconciling the tags of diagnosis documents with the machines of a dataset on disk."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.operators import crosswalk, ordered

MACHINE = "machine struct<id:string,name:string,path:array<string>>"
COLUMNS = ["normalized_tag", "external_tag", "external_name", "area_code", "area_name", "dataset_machine_id", "match_rule", "match_tier", "n_candidates", "candidates", "all_candidates", "resolution"]


def dataset_machines(spark: SparkSession, root: str) -> DataFrame:
    """(machine_id, machine_name, machine_path) of each machine folder; name and path from its document, where it has one."""
    folders = sorted(d.name for d in os.scandir(root) if d.is_dir() and d.name.startswith("machine="))
    ids = spark.createDataFrame([(f.split("=", 1)[1],) for f in folders], "machine_id string")
    if not any(os.path.exists(f"{root}/{f}/machine.json") for f in folders):
        return ids.withColumns({"machine_name": F.lit(None).cast("string"), "machine_path": F.lit(None).cast("string")})
    read = spark.read.schema(MACHINE).option("multiLine", "true").json(f"{root}/machine=*/machine.json").select(F.regexp_extract(F.col("_metadata.file_path"), "machine=([^/]*)/", 1).alias("machine_id"), "machine")
    named = read.select(F.url_decode("machine_id").alias("machine_id"), F.col("machine.name").alias("machine_name"), F.array_join("machine.path", " / ").alias("machine_path"))
    return ids.join(named, "machine_id", "left")


def trend_coverage(trends: DataFrame) -> DataFrame:
    """(machine_id, first_day, last_day, n) of each machine's trends; only their times are read."""
    day = lambda c: F.date_format(F.timestamp_micros(c), "yyyy-MM-dd")
    spans = trends.groupBy("machine_id").agg(F.min("t").alias("lo"), F.max("t").alias("hi"), F.count("*").alias("n"))
    return spans.select("machine_id", day("lo").alias("first_day"), day("hi").alias("last_day"), "n")


def unresolved_tags(observations: DataFrame) -> DataFrame:
    """Each tag of observations without a machine once, as it was first read: (document_id, place) orders them."""
    open_ = observations.where("dataset_machine_id is null and normalized_tag is not null")
    first = ordered.best_per_key(open_, ["normalized_tag"], [F.col("document_id"), F.col("place")])
    return first.select("normalized_tag", "external_tag", "external_name", "area_code", "area_name")


def build_crosswalk(tags: DataFrame, machines: DataFrame) -> DataFrame:
    """One row per tag with its machine, if it is the only one, and all candidates with their tiers."""
    ids = machines.select("machine_id").distinct()
    keyed = tags.select("normalized_tag").distinct().withColumnRenamed("normalized_tag", "tag")
    found = crosswalk.candidates(keyed, ids)
    best = crosswalk.resolve(keyed, ids).withColumnRenamed("tag", "normalized_tag")
    every = found.groupBy(F.col("tag").alias("normalized_tag")).agg(
        F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "machine_id", "tier"))), "|").alias("all_candidates"), F.array_sort(F.collect_list(F.struct("tier", "machine_id"))).alias("_all")
    )  # a tag has few candidates
    joined = tags.join(best, "normalized_tag", "left").join(every, "normalized_tag", "left")
    chosen = F.array_join(F.transform(F.filter("_all", lambda x: x["tier"] == F.col("tier")), lambda x: x["machine_id"]), "|")
    return joined.select(
        "normalized_tag", "external_tag", "external_name", "area_code", "area_name", F.col("machine_id").alias("dataset_machine_id"), F.col("rule").alias("match_rule"), F.col("tier").alias("match_tier"),
        "n_candidates", F.coalesce(chosen, F.lit("")).alias("candidates"), F.coalesce("all_candidates", F.lit("")).alias("all_candidates"), "resolution",
    ).orderBy("normalized_tag")


def free_machines(built: DataFrame, machines: DataFrame) -> DataFrame:
    """Machines that no tag resolves to."""
    used = built.where("dataset_machine_id is not null").select(F.col("dataset_machine_id").alias("machine_id")).distinct()
    return machines.join(used, "machine_id", "left_anti")


def open_cases(built: DataFrame, machines: DataFrame) -> DataFrame:
    """Tags without a machine, with the free machines of their area: (…, same_area)."""
    free = free_machines(built, machines).select(crosswalk.area_key(F.col("machine_path")).alias("_area"), "machine_id").groupBy("_area").agg(F.array_sort(F.collect_list("machine_id")).alias("same_area"))
    left = built.where("dataset_machine_id is null").withColumn("_area", crosswalk.area_key(F.col("area_name")))
    return left.join(free, "_area", "left").drop("_area").withColumn("same_area", F.coalesce("same_area", F.array().cast("array<string>")))


def area_mismatches(built: DataFrame, machines: DataFrame) -> DataFrame:
    """Resolved tags whose report names another area than their machine has."""
    m = machines.select(F.col("machine_id").alias("dataset_machine_id"), "machine_path")
    return built.join(m, "dataset_machine_id").where((crosswalk.area_key(F.col("area_name")) != crosswalk.area_key(F.col("machine_path"))) & F.col("area_name").isNotNull() & F.col("machine_path").isNotNull()).select("normalized_tag", "dataset_machine_id", "area_name", "machine_path")


def markdown_table(df: DataFrame, limit: int = 10_000) -> str:
    """A report table of at most ``limit`` rows as Markdown; null and empty are a dash."""
    cell = lambda v: "—" if v in (None, "", []) else ", ".join(v) if isinstance(v, list) else str(v)
    rows = df.limit(limit).collect()
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "|".join("---" for _ in df.columns) + "|"]
    return "\n".join(lines + ["| " + " | ".join(cell(v) for v in r) + " |" for r in rows])
