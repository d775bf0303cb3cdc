"""Overlays of judged weights: a JSON file of scores per diagnosis text, checked and applied to documents.

An overlay shares the mass of a whole text or nothing: its keys must be those of the
document's findings, in order. Scores become millionths that sum to one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.operators import findings

# Fixed values of the format.
KIND_END, SERIES = "weight_overlay", "0.1."
QUALITIES = ("approximate", "weak", "group")
GROUPS = (
    "IMBALANCE", "MISALIGNMENT", "LOOSENESS", "STRUCTURE", "RESONANCE", "BEARING", "LUBRICATION", "ELECTRICAL", "GEAR", "FLOW", "BELT", "OTHER",
)
ORIGIN = "inspection-report"
UNREAD_KEY = f"{findings.UNREAD[0]}:-"
OVERLAY = (
    "kind string, `$overlay_version` string, extractor string, extraction_method string, judgements array<struct<diagnosis_text:string,rationale:string,observations:int,"
    "findings:array<struct<finding:string,score:string>>,remap:array<struct<`from`:string,`to`:struct<fault_group:string,fault_mode:string,label_quality:string,matched_text:string>,why:string>>>>"
)
# End of the fixed values.


def read_overlay(spark: SparkSession, path: str) -> DataFrame:
    """The judgements of an overlay file, one row each: kind, version, diagnosis_text, keys, scores, remap."""
    j = spark.read.schema(OVERLAY).option("multiLine", "true").json(path).select("kind", F.col("`$overlay_version`").alias("version"), F.explode_outer("judgements").alias("j"))
    return j.select(
        "kind", "version", F.col("j.diagnosis_text").alias("diagnosis_text"), F.transform("j.findings", lambda x: x["finding"]).alias("keys"),
        F.transform("j.findings", lambda x: x["score"].try_cast("double")).alias("scores"), F.coalesce("j.remap", F.array().cast("array<struct<`from`:string,`to`:struct<fault_group:string,fault_mode:string,label_quality:string,matched_text:string>,why:string>>")).alias("remap"),
    )


def overlay_faults(judgements: DataFrame) -> DataFrame:
    """(diagnosis_text, fault) of what makes an overlay unusable: its kind or series, a text judged twice, a score that is none, a bad remap."""
    to = lambda r: r["to"]
    bad_remap = F.exists("remap", lambda r: F.coalesce(
        (r["from"] != UNREAD_KEY) | ~F.array_contains("keys", r["from"]) | ~to(r)["fault_group"].isin(*GROUPS) | ~to(r)["label_quality"].isin(*QUALITIES)
        | ((to(r)["label_quality"] == "group") != to(r)["fault_mode"].isNull()), F.lit(True)
    ))
    tests = {
        "kind": ~F.coalesce(F.col("kind").endswith(KIND_END), F.lit(False)),
        "series": ~F.coalesce(F.col("version").startswith(SERIES), F.lit(False)),
        "score": F.exists("scores", lambda s: F.coalesce(s <= 0, F.lit(True))),
        "remap": bad_remap,
    }
    found = F.filter(F.array(*[F.when(t, F.lit(name)) for name, t in tests.items()]), lambda x: x.isNotNull())
    each = judgements.select("diagnosis_text", F.explode(found).alias("fault"))
    twice = judgements.where("diagnosis_text is not null").groupBy("diagnosis_text").agg(F.count("*").alias("k")).where("k > 1").select("diagnosis_text", F.lit("twice").alias("fault"))
    return each.unionByName(twice)


def _reweighted(f: Column, keys: Column, scores: Column, remap: Column) -> Column:
    """Findings with judged weights and, where an unread one is remapped, its new label."""
    total = F.aggregate(scores, F.lit(0.0), lambda a, s: a + s)
    entries = F.transform(scores, lambda s: F.struct((s / total).alias("mass")))
    whole = findings.in_millionths(entries, "mass")

    def one(x: Column, i: Column) -> Column:
        new = F.get(F.filter(remap, lambda r: r["from"] == F.get(keys, i)), F.lit(0))["to"]
        picked = lambda c: F.when(new.isNotNull(), new[c]).otherwise(x[c]).alias(c)
        return F.struct(
            x["source_text"].alias("source_text"), picked("matched_text"), picked("fault_mode"), picked("fault_group"), picked("label_quality"),
            F.when(new.isNotNull(), F.lit(None).cast("string")).otherwise(x["mapping_rule"]).alias("mapping_rule"), (F.get(whole, i) / findings.MILLION).alias("weight"),
        )

    return F.transform(f, one)


def judge(observations: DataFrame, judgements: DataFrame) -> DataFrame:
    """Observations (with an array ``findings``) with ``findings`` as judged, ``judged`` and a ``fault`` where the overlay doesn't fit.

    A text without judgement keeps one finding, which weighs 1; with more it is
    ``unjudged``; other keys than the judged ones, or in another order, are ``stale``.
    Texts meet by their digest and then by themselves.
    """
    j = judgements.select(F.sha2("diagnosis_text", 256).alias("_digest"), F.col("diagnosis_text").alias("_text"), F.col("keys").alias("_keys"), F.col("scores").alias("_scores"), F.col("remap").alias("_remap"))
    text = F.coalesce("diagnosis_text", F.lit(""))
    met = observations.withColumn("_digest", F.sha2(text, 256)).join(j, "_digest", "left").withColumn("judged", F.col("_text").eqNullSafe(text) & (F.size("findings") > 0))
    keys = F.transform("findings", lambda x: findings.finding_key(x["fault_group"], x["fault_mode"]))
    n = F.coalesce(F.size("findings"), F.lit(0))
    fault = F.when(F.col("judged") & (keys != F.col("_keys")), "stale").when(~F.col("judged") & (n > 1), "unjudged")
    alone = F.transform("findings", lambda x: x.withField("weight", F.lit(1.0)))
    new = F.when(F.col("judged"), _reweighted(F.col("findings"), F.col("_keys"), F.col("_scores"), F.col("_remap"))).when(n == 1, alone).otherwise(F.col("findings"))
    kind = observations.schema["findings"].dataType
    return met.withColumn("fault", fault).withColumn("findings", F.when(F.col("fault").isNull(), new.cast(kind)).otherwise(F.col("findings"))).drop("_digest", "_text", "_keys", "_scores", "_remap")


def unused(observations: DataFrame, judgements: DataFrame) -> DataFrame:
    """Judged texts that no observation with findings has."""
    seen = observations.where(F.size("findings") > 0).select(F.sha2("diagnosis_text", 256).alias("_digest"), F.col("diagnosis_text").alias("_seen")).distinct()
    j = judgements.withColumn("_digest", F.sha2("diagnosis_text", 256))
    return j.join(seen, (j["_digest"] == seen["_digest"]) & (j["diagnosis_text"] == seen["_seen"]), "left_anti").select("diagnosis_text").distinct()


def apply_overlay(documents: DataFrame, judgements: DataFrame) -> DataFrame:
    """Documents of inspection reports with judged weights; one that the overlay doesn't fit is an error, other documents don't come out.

    ``documents`` as ``dataset.read_diagnoses`` gives them.
    """
    own = documents.where(F.col("provenance.origin") == ORIGIN)
    o = own.select("kind", "provenance", F.posexplode_outer("observations").alias("_place", "_o"))
    flat = o.select("kind", "provenance", "_place", "_o", F.col("_o.diagnosis_text").alias("diagnosis_text"), F.col("_o.findings").alias("findings"))
    said = judge(flat, judgements)
    checked = said.where(F.assert_true(F.col("fault").isNull(), F.concat_ws(" ", F.lit("overlay"), "fault", "_o.observation_id")).isNull())
    new = F.when(F.col("_o").isNotNull(), F.col("_o").withField("findings", F.col("findings")))
    # a document is read whole, and is put together again from its own observations
    again = checked.groupBy("kind", "provenance").agg(F.array_sort(F.collect_list(F.when(new.isNotNull(), F.struct(F.col("_place").alias("place"), new.alias("o"))))).alias("_all"))
    return again.select("kind", "provenance", F.transform("_all", lambda x: x["o"]).alias("observations"))
