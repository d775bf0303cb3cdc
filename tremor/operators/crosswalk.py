"""Tags of one source found in the ids of another: lookup, tiers, uniqueness both ways.

A tag may be the last words of an id (exact_suffix), words inside it (delimited) or
any part of it (substring). Words are joined up to the tag's length, so the first two
tiers are an equi-join on word runs; only tags without one look for substrings, by an
equi-join on all parts of the id as long as a tag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.functions.names import without_accents

#: Tiers from strong to weak with their rules. Fixed values.
TIERS = {"exact_suffix": "CW001", "delimited": "CW002", "substring": "CW003"}


def plain(text: Column) -> Column:
    """Upper case, accents and compatibility forms folded, letters and digits only."""
    return _bare(without_accents(text))


def _bare(text: Column) -> Column:
    return F.regexp_replace(F.upper(text), "[^A-Z0-9]", "")


def area_key(area: Column) -> Column:
    """Folded area name without ``DE``: two spellings of one area share it."""
    return F.replace(plain(F.coalesce(area, F.lit(""))), F.lit("DE"), F.lit(""))


def lookup(df: DataFrame, crosswalk: DataFrame, tag: str, own: str, out: str) -> DataFrame:
    """The row's own id if it has one, else that of the crosswalk for its normalised tag."""
    known = crosswalk.select(plain(F.col(tag)).alias("_tag"), F.nullif(F.trim(own), F.lit("")).alias("_id")).where("_id is not null")
    known = known.groupBy("_tag").agg(F.max("_id").alias("_id"))
    return (
        df.withColumn("_tag", plain(F.col(tag)))
        .join(known, "_tag", "left")
        .withColumn(out, F.coalesce(F.nullif(F.trim(own), F.lit("")), "_id"))
        .drop("_tag", "_id")
    )


def candidates(tags: DataFrame, ids: DataFrame) -> DataFrame:
    """(tag, machine_id, tier) for ``tags(tag)`` and ``ids(machine_id)``, each id's best tier for a tag."""
    words = F.transform(F.filter(F.split("machine_id", "[^A-Za-z0-9]+"), lambda w: w != ""), lambda w: _bare(w))
    split = ids.select("machine_id", words.alias("w"))
    n = F.size("w")
    runs = split.select(
        "machine_id",
        F.explode(
            F.flatten(
                F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(
                    F.sequence(i, n), lambda j: F.struct(F.array_join(F.slice(F.col("w"), i, j - i + 1), "").alias("run"), (j == n).alias("last"))))
            )
        ).alias("r"),
    ).select("machine_id", "r.run", "r.last")
    by_words = (
        runs.join(tags.select(F.col("tag").alias("run")).distinct(), "run")
        .groupBy(F.col("run").alias("tag"), "machine_id")
        .agg(F.when(F.max("last"), "exact_suffix").otherwise("delimited").alias("tier"))
    )
    left = tags.select("tag").distinct().join(by_words.select("tag").distinct(), "tag", "left_anti").where(F.length("tag") > 0)
    lengths = left.select(F.length("tag").alias("size")).distinct()
    joined = ids.select("machine_id", plain(F.col("machine_id")).alias("p"))
    parts = (
        joined.join(lengths, F.length("p") >= F.col("size"))
        .select("machine_id", F.explode(F.transform(F.sequence(F.lit(1), F.length("p") - F.col("size") + 1), lambda i: F.substring("p", i, F.col("size")))).alias("tag"))
        .distinct()
    )
    return by_words.unionByName(parts.join(left, "tag").select("tag", "machine_id", F.lit("substring").alias("tier")))


def resolve(tags: DataFrame, ids: DataFrame) -> DataFrame:
    """Each tag's machine: unique within its best tier, and no machine under two tags.

    ``resolution``: matched, ambiguous (several in the best tier), unmatched, or
    reverse_collision (the machine went to a tag of a stronger tier, or to none where
    the strongest tie).
    """
    strength = F.create_map(*[F.lit(x) for i, t in enumerate(TIERS) for x in (t, i)])
    ranked = candidates(tags, ids).withColumn("_s", strength[F.col("tier")])
    best = F.min("_s").over(Window.partitionBy("tag"))
    sel = (
        ranked.withColumn("_b", best).where("_s = _b").groupBy("tag", "tier", "_s")
        .agg(F.count("*").alias("n_candidates"), F.min("machine_id").alias("machine_id"))
    )
    unique = F.col("n_candidates") == 1
    # a tag without a single machine stands for itself: no window holds all of them
    mine = Window.partitionBy(F.coalesce("machine_id", F.concat(F.lit("\u0000"), "tag")))
    settled = (
        sel.withColumn("machine_id", F.when(unique, F.col("machine_id")))
        .withColumn("_top", F.min("_s").over(mine))
        .withColumn("_k", F.sum((F.col("_s") == F.col("_top")).cast("int")).over(mine))
        .withColumn("_n", F.count("*").over(mine))
        .withColumn("_keep", unique & (F.col("_s") == F.col("_top")) & (F.col("_k") == 1))
    )
    rule = F.create_map(*[F.lit(x) for kv in TIERS.items() for x in kv])[F.col("tier")]
    out = settled.select(
        "tag", "tier", "n_candidates",
        F.when(F.col("_keep"), F.col("machine_id")).alias("machine_id"),
        F.when(F.col("_keep"), F.when(F.col("_n") > 1, F.concat(rule, F.lit("+CW004"))).otherwise(rule)).alias("rule"),
        F.when(~unique, "ambiguous").when(F.col("_keep"), "matched").otherwise("reverse_collision").alias("resolution"),
    )
    return tags.select("tag").distinct().join(out, "tag", "left").select(
        "tag", "tier", F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"), "machine_id", "rule", F.coalesce("resolution", F.lit("unmatched")).alias("resolution")
    )
