"""Names: file-safe identifiers, suffixes for collisions, and what point names declare."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: How point names spell side, direction, component and acquisition.
SIDES = {"la": "DE", "loa": "NDE", "lca": "NDE"}
SIDE_PHRASES = [(r"\blad[o]?\s+(?:op\w*|contrari\w*|libre)\b", "NDE"), (r"\blad[o]?\s+(?:acopl\w*|motor?)\b", "DE")]
DIRECTIONS = [("horiz", "H"), ("vert", "V"), ("axial", "A")]
COMPONENTS = {"motor": "motor", "bomba": "pump", "reductor": "gearbox", "reductora": "gearbox", "ventilador": "fan", "centrifuga": "centrifuge", "campana": "bell"}
ACQUISITIONS = [
    (r"\bpeakv\w*\b", "peakvue"),
    (r"\balta\s+frecuencia\b|(?:\(|\[)\s*hf\s*(?:\)|\])", "high_frequency"),
    (r"\balta\s+resolucion\b|(?:\(|\[)\s*hr\s*(?:\)|\])", "high_resolution"),
    (r"(?:\(|\[)\s*p\s*(?:\)|\])", "peakvue"),
    (r"\bconsumo\s+intensidad\b", "electrical_current"),
]
ACQUISITION_END = (
    r"(?:\s+peakv\w*(?:\s+\d+\s*hz)?|\s+alta\s+frecuencia(?:\s+\(\s*hf\s*\))?|\s+alta\s+resolucion(?:\s+\(\s*hr\s*\))?"
    r"|\s*(?:\(|\[)\s*(?:p|hf|hr)\s*(?:\)|\])(?:\s+\d+\s*hz)?)\s*$"
)
MAX_NAME = 64


@F.pandas_udf(StringType())
def _decomposed(texts: pd.Series) -> pd.Series:
    return texts.str.normalize("NFKD").str.replace("[\u0300-\u036f]", "", regex=True)


def without_accents(text: Column) -> Column:
    """Compatibility forms decomposed and combining marks dropped; only texts beyond ASCII leave the JVM."""
    plain = text.rlike(r"^\p{ASCII}*$")
    return F.when(plain, text).otherwise(_decomposed(F.when(~plain, text)))


def file_name(text: str | None) -> str:
    """ASCII letters, digits and single underscores, 64 characters at most; ``unnamed`` if nothing is left."""
    plain = unicodedata.normalize("NFKD", text or "").encode("ascii", "ignore").decode()
    return "_".join(re.findall(r"[A-Za-z0-9]+", plain))[:MAX_NAME] or "unnamed"


@F.pandas_udf(StringType())
def file_names(names: pd.Series) -> pd.Series:
    return names.map(file_name)


def slug(text: Column) -> Column:
    """Lower case, runs of other characters as one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def distinct_names(df: DataFrame, group: list[str], order: list[str], name: str, out: str) -> DataFrame:
    """File names that are distinct within a group: a repeated one gets the next free suffix in ``order``.

    A suffix may itself be taken (A, A, A_1 gives A, A_1, A_1_1), so names are folded
    in order. Names can only meet where they are the same but for numbers at the end,
    so each such family of a group is folded by itself.
    """
    columns = [*group, *order, name]
    based = df.select(*columns, file_names(name).alias("_base"))
    keyed = based.withColumn("_family", F.regexp_replace("_base", r"(_\d+)+$", ""))

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, used, last = None, set(), {}
        for rows in batches:  # families stand one after the other
            names = []
            for key, base in zip(zip(*(rows[c] for c in [*group, "_family"]), strict=True), rows["_base"], strict=True):
                key = tuple(None if pd.isna(k) else k for k in key)
                if key != current:
                    current, used, last = key, set(), {}
                candidate, k = base, last.get(base, 0)
                while candidate in used:
                    k += 1
                    candidate = f"{base}_{k}"
                last[base] = k
                used.add(candidate)
                names.append(candidate)
            yield rows[columns].assign(**{out: pd.Series(names, index=rows.index, dtype=object)})

    placed = keyed.repartition(*group, "_family").sortWithinPartitions(*group, "_family", *order)
    return placed.mapInPandas(fold, df.select(*columns).schema.add(out, "string"))


FIELDS = ("location", "direction", "component", "acquisition")
_EVIDENCE = "array<struct<field:string,value:string,rule:string>>"


def _hits(low: Column, tokens: Column) -> Column:
    """Array of what a name declares, each with the rule that says so: (field, value, rule)."""
    entry = lambda field, value, rule: F.struct(F.lit(field).alias("field"), value.alias("value"), rule.alias("rule"))

    def listed(field: str, words: dict[str, str]) -> Column:
        known = F.create_map(*[F.lit(x) for kv in words.items() for x in kv])
        return F.transform(F.filter(tokens, lambda t: t.isin(*words)), lambda t: entry(field, F.try_element_at(known, t), t))

    def begun(field: str, stem: str, value: str) -> Column:
        return F.transform(F.filter(tokens, lambda t: F.startswith(t, F.lit(stem))), lambda t: entry(field, F.lit(value), t))

    def matched(field: str, patterns: list[tuple[str, str]]) -> Column:
        return F.filter(F.array(*[F.when(low.rlike(p), entry(field, F.lit(v), F.lit(p))) for p, v in patterns]), lambda h: h.isNotNull())

    return F.concat(
        listed("location", SIDES), matched("location", SIDE_PHRASES), *[begun("direction", *d) for d in DIRECTIONS],
        listed("component", COMPONENTS), matched("acquisition", ACQUISITIONS),
    ).cast(_EVIDENCE)


def position_base(low: Column) -> Column:
    """What is left of a folded name without acquisition suffixes, side and direction: its position on the machine."""
    bare = F.regexp_replace(low, rf"(?:{ACQUISITION_END[:-1]})+$", "")
    text = F.array_join(_tokens(bare), " ")
    for phrase, _ in SIDE_PHRASES:
        text = F.regexp_replace(text, phrase, " ")
    stems = "|".join(stem for stem, _ in DIRECTIONS)
    return F.array_join(F.filter(F.split(text, " +"), lambda t: (t != "") & ~t.isin(*SIDES) & ~t.rlike(f"^(?:{stems})")), " ")


def _tokens(low: Column) -> Column:
    return F.filter(F.split(low, "[^0-9A-Za-z]+"), lambda t: t != "")


def evidence(df: DataFrame, keep: list[str], name: str) -> DataFrame:
    """Points with what their names declare: each field with its status, the position's base and the trace of rules.

    One value is ``derived``, several are ``ambiguous`` (the field is null), none ``absent``.
    """
    folded = df.select(*keep, name, F.trim(F.lower(without_accents(F.coalesce(name, F.lit(""))))).alias("_low"))
    traced = folded.withColumn("trace", _hits(F.col("_low"), _tokens(F.col("_low"))))
    values = lambda field: F.array_distinct(F.transform(F.filter("trace", lambda h: h["field"] == field), lambda h: h["value"]))
    told = traced.select(*keep, name, "_low", "trace", *[values(f).alias(f"_{f}") for f in FIELDS])
    one = lambda f: F.when(F.size(f"_{f}") == 1, F.get(f"_{f}", F.lit(0)))
    status = lambda f: F.when(F.size(f"_{f}") == 1, "derived").when(F.size(f"_{f}") > 1, "ambiguous").otherwise("absent")
    return told.select(*keep, name, *[c for f in FIELDS for c in (one(f).alias(f), status(f).alias(f"{f}_status"))], position_base(F.col("_low")).alias("base"), "trace")


def sibling_directions(named: DataFrame, group: list[str], name: str) -> DataFrame:
    """A direction for points without one, from the only sibling of the same side, component and base.

    ``named`` comes from ``evidence``. The siblings of a position are counted before
    they meet the points, so a position with many siblings makes no pairs.
    """
    keys = [*group, "location", "component", "base"]
    placed = named.where("location is not null and component is not null")
    single = (
        placed.where("direction is not null").groupBy(*keys)
        .agg(F.count("*").alias("_k"), F.min("direction").alias("proposed"), F.min(name).alias("sibling")).where("_k = 1").drop("_k")
    )
    return placed.where("direction is null").join(single, keys).where(F.col("sibling") != F.col(name)).select(*group, name, "proposed", "sibling")


def name_audit(named: DataFrame, weight: Column) -> DataFrame:
    """Weighted counts per field, status and value."""
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_status").alias("status"), F.col(f).alias("value")) for f in FIELDS])
    return named.select(weight.alias("w"), F.inline(rows)).groupBy("field", "status", "value").agg(F.sum("w").alias("points"))


def hex_dump(data: bytes, base: int = 0) -> str:
    """Sixteen bytes a line: offset, hex, printable ASCII."""
    lines: Iterator[str] = (
        f"{base + i:08x}  {data[i : i + 16].hex(' '):<47}  {''.join(chr(b) if 32 <= b < 127 else '.' for b in data[i : i + 16])}" for i in range(0, len(data), 16)
    )
    return "\n".join(lines)
