"""Attribute history: dated statements in, one row per version out.

Method: an event-sourced change log per attribute. The statements of one series
and date are first reduced to the one that holds; every attribute then has its
own log of changes with its own intervals; the logs are combined by splitting at
the union of their boundary dates, and equal neighbours are coalesced.

Scale: the reduction to one row per (series, date) is an aggregate with map-side
combine (sorted, as its states hold text), so a series that holds a third of all rows arrives at the
windows with at most one row per calendar date. The windows over a series are
therefore bounded by the number of dates, however many rows state them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def normalise_tag(tag: Column) -> Column:
    """Upper-case letters and digits only; blank becomes null."""
    return F.nullif(F.regexp_replace(F.upper(tag), "[^A-Z0-9]", ""), F.lit(""))


def parse_date(text: Column) -> Column:
    """A date typed in any of the accepted forms, or null.

    Year first: ``2024-01-31``, ``2024/1/31``, ``20240131``, each with or without a
    time after a blank or ``T``. Otherwise day, month, year. An impossible date
    (month 13, 30 February) is null.
    """
    t = F.trim(text)
    ymd = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:[T ].*)?$"
    compact = r"^(\d{4})(\d{2})(\d{2})(?:[T ]?\d.*)?$"
    dmy = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})(?:[T ].*)?$"

    def parts(pattern: str, y: int, m: int, d: int) -> Column:
        g = [F.regexp_extract(t, pattern, i) for i in (y, m, d)]
        iso = F.concat_ws("-", g[0], F.lpad(g[1], 2, "0"), F.lpad(g[2], 2, "0"))
        return F.try_to_date(iso, "yyyy-MM-dd")

    return (
        F.when(t.rlike(ymd), parts(ymd, 1, 2, 3))
        .when(t.rlike(dmy), parts(dmy, 3, 2, 1))
        .when(t.rlike(compact), parts(compact, 1, 2, 3))
    )


def holding_statements(
    df: DataFrame, keys: list[str], date: str, attributes: list[str], precedence: list[Column]
) -> DataFrame:
    """One row per (keys, date): the statement that is highest in ``precedence``.

    ``precedence`` is compared from left to right and nulls rank lowest; the last
    tie is broken by the attributes themselves, so the result does not depend on
    row order. Only ``keys``, ``date`` and ``attributes`` come out, hence extra
    columns of any name do no harm.
    """
    rank = F.struct(
        *[p.alias(f"p{i}") for i, p in enumerate(precedence)],
        *[F.col(a).alias(f"a{i}") for i, a in enumerate(attributes)],
    )
    best = df.groupBy(*keys, date).agg(F.max(rank).alias("best"))
    return best.select(*keys, date, *[F.col(f"best.a{i}").alias(a) for i, a in enumerate(attributes)])


def change_log(df: DataFrame, keys: list[str], date: str, attributes: list[str]) -> DataFrame:
    """Every attribute's own log: (keys, attribute, value, valid_from, valid_to).

    A null says nothing and leaves the attribute as it was. What was first said of
    an attribute also holds for the dates before it, from the series' first date.
    ``valid_to`` is the next change of the same attribute, null while it lasts.
    """
    series = Window.partitionBy(*keys)
    log = Window.partitionBy(*keys, "attribute").orderBy(date)
    said = (
        df.withColumn("_first", F.min(date).over(series))
        .select(
            *keys,
            date,
            "_first",
            F.inline(
                F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attributes])
            ),
        )
        .where(F.col("value").isNotNull())
        .withColumn("_before", F.lag("value").over(log))
        .where(F.col("_before").isNull() | (F.col("_before") != F.col("value")))
        .withColumn("valid_from", F.when(F.col("_before").isNull(), F.col("_first")).otherwise(F.col(date)))
    )
    change = Window.partitionBy(*keys, "attribute").orderBy("valid_from")
    return said.withColumn("valid_to", F.lead("valid_from").over(change)).select(
        *keys, "attribute", "value", "valid_from", "valid_to"
    )


def combine_logs(log: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    """Versions of a whole series from its attributes' logs.

    The series is split at the union of the boundary dates of all logs, each part
    takes every attribute's value as of its start, and neighbours that are equal
    in all attributes are coalesced. ``valid_to`` is null for the open version.
    """
    at = Window.partitionBy(*keys).orderBy("valid_from").rowsBetween(Window.unboundedPreceding, 0)
    order = Window.partitionBy(*keys).orderBy("valid_from")
    split = log.groupBy(*keys, "valid_from").agg(
        *[F.max(F.when(F.col("attribute") == a, F.col("value"))).alias(a) for a in attributes]
    )
    filled = split.select(*keys, "valid_from", *[F.last(a, ignorenulls=True).over(at).alias(a) for a in attributes])
    state = F.struct(*attributes)
    return (
        filled.withColumn("_state", state)
        .withColumn("_same", F.lag("_state").over(order).eqNullSafe(F.col("_state")))
        .where(~F.col("_same") | F.col("_same").isNull())
        .withColumn("valid_to", F.lead("valid_from").over(order))
        .select(*keys, *attributes, "valid_from", "valid_to")
    )


def attribute_history(
    df: DataFrame, keys: list[str], date: str, attributes: list[str], precedence: list[Column]
) -> DataFrame:
    """Full history of ``attributes`` per series of ``keys``.

    Defined cases: rows whose ``date`` is null are left out (they say nothing about
    when); nulls in ``keys`` form their own series; a series whose attributes are
    all null has no version; repeated rows change nothing; an empty table gives
    an empty history.
    """
    held = holding_statements(df.where(F.col(date).isNotNull()), keys, date, attributes, precedence)
    versions = combine_logs(change_log(held, keys, date, attributes), keys, attributes)
    return versions.select(*keys, *[F.col(a).cast(df.schema[a].dataType).alias(a) for a in attributes], "valid_from", "valid_to")


def machine_history(observations: DataFrame) -> DataFrame:
    """History of status, area and speed per (origin, normalized_tag, modality).

    The primary record holds for a date, without one the record of the latest
    inspection; ties by document_id, then observation_id. Status is compared in
    upper case without outer blanks, a blank status says nothing.
    """
    typed = observations.select(
        "origin",
        normalise_tag(F.col("normalized_tag")).alias("normalized_tag"),
        "modality",
        parse_date(F.col("observed_at")).alias("observed_on"),
        F.nullif(F.upper(F.trim("status")), F.lit("")).alias("status"),
        F.nullif(F.trim("area_code"), F.lit("")).alias("area_code"),
        F.nanvl(F.col("rpm1").cast("double"), F.lit(None).cast("double")).alias("rpm1"),
        (F.lower(F.trim("record_kind")) == "primary").cast("int").alias("_primary"),
        F.coalesce(F.col("inspection_date"), F.lit("")).alias("_inspected"),
        F.coalesce(F.col("document_id"), F.lit("")).alias("_document"),
        F.coalesce(F.col("observation_id"), F.lit("")).alias("_observation"),
    ).where(F.col("normalized_tag").isNotNull())
    keys = ["origin", "normalized_tag", "modality"]
    rank = [F.coalesce("_primary", F.lit(0)), F.col("_inspected"), F.col("_document"), F.col("_observation")]
    return attribute_history(typed, keys, "observed_on", ["status", "area_code", "rpm1"], rank)
