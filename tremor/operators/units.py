"""Quantities recorded in different units, brought to common units.

Three sources state a unit in three ways: a code per slot or the free text of a
limit set, the unit note or the text of an alarm line, the unit of a spectrum.
Each quantity comes out with the catalogue unit its own record states (null where
it states none) and the factor to the common unit.

Scale: narrow throughout. Every input is read once with the columns named here;
the only shuffle is the one that reduces alarm notes to one row per ``note_id``,
and it carries only unit names. The catalogue is a fixed dimension whose size is
checked before it is taken to the driver.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.functions.unit_grammar import UnitReader

CATALOGUE_LIMIT = 10_000
#: How likely the quantities are in each field, for strings that can be cut into several. Limits and lines of alarms are mostly
#: velocities; spectra are taken of accelerations as often.
FIELD_PRIORS = {
    "limit": {"velocity": 0.3, "acceleration": 0.2, "displacement": 0.1},
    "note": {"velocity": 0.3, "acceleration": 0.2, "displacement": 0.1},
    "spectrum": {"velocity": 0.25, "acceleration": 0.25, "displacement": 0.1},
}

_NUM = r"[-+]?\d+(?:[.,]\d+)?"
#: Heads of an alarm line (what stands before the unit) and anchors (what stands after it), by layout.
_DASHED = re.compile(rf"\s-\s+{_NUM}", re.I), re.compile(r"-\s+[CD]\s+Alarm\b", re.I)
_LEVEL = re.compile(rf"=\s*{_NUM}", re.I), re.compile(r",\s*nivel\s+[CD]\b", re.I)
_COLON = re.compile(rf":\s*{_NUM}", re.I), re.compile(r"\([CD]\)$", re.I)
_ALARMA = re.compile(r"ALARMA\s+[CD]\s*/", re.I)
_MEASURED = re.compile(r"Valor medido en ", re.I)
_FIGURE = re.compile(rf"\s*{_NUM}")
_OPENS = re.compile(r"/\s*\[")
_TAIL = re.compile(rf"{_NUM}\s+alarma\s+[CD]", re.I)


def _between(line: str, start: int, head: re.Pattern, anchor: re.Pattern) -> str | None:
    """What stands between the last head from ``start`` on that has an anchor behind it and the first such anchor."""
    anchors = [m.start() for m in anchor.finditer(line, start)]
    if not anchors:
        return None
    ends = [m.end() for m in head.finditer(line, start) if m.end() <= anchors[-1]]
    if not ends:
        return None
    return line[ends[-1] : anchors[bisect_left(anchors, ends[-1])]].strip()


def _bracketed(line: str) -> tuple[str | None] | None:
    """The unit in brackets, or None in the tuple, of a line that ends in a figure after the last slash."""
    if not (m := _ALARMA.match(line)):
        return None
    slash = line.rfind("/")
    if slash >= m.end() and _FIGURE.fullmatch(line, slash + 1):
        return (None,)
    close = line.rfind("]")
    if close < 0 or not _FIGURE.fullmatch(line, close + 1):
        return None
    opens = list(_OPENS.finditer(line, max(m.end(), line.rfind("]", 0, close) + 1), close))
    if not opens:
        return None
    return (line[opens[-1].end() : close],)


def layout_parts(line: str) -> dict[str, str | None] | None:
    """The unit, or what stands before the figure, of a stripped line in one of the layouts; each is read once."""
    if (unit := _between(line, 0, *_DASHED)) is not None:
        return {"unit": unit}
    if (found := _bracketed(line)) is not None:
        return {"unit": found[0]}
    if (m := _MEASURED.match(line)) and (unit := _between(line, m.end() + 1, *_LEVEL)) is not None:
        return {"unit": unit}
    if (unit := _between(line, 1, *_COLON)) is not None:
        return {"unit": unit}
    words = line.rsplit(None, 3)
    if len(words) == 4 and _TAIL.fullmatch(" ".join(words[1:])):
        return {"before": words[0]}
    return None


def alarm_line_unit(reader: UnitReader, text: str | None, band: str | None) -> str | None:
    """Unit of the value that the alarm line within ``text`` reports, or None.

    Other figures in the text (former limits, speeds, temperatures, the edges of
    the band) don't count. Whole texts are searched, whatever their length and that of their lines.
    """
    for line in re.split(r"[\r\n]+", text or ""):
        parts = layout_parts(line.strip())
        if parts is None:
            continue
        if "before" not in parts:
            return reader.read(parts["unit"])
        before = parts["before"]
        if band and before.upper().startswith(band.upper()):
            return reader.read(before[len(band) :].strip())
        words = before.split()
        for size in range(min(4, len(words) - 1), 0, -1):
            if unit := reader.read(" ".join(words[-size:])):
                return unit
        return None
    return None


def unit_readers(catalogue: DataFrame, priors: dict[str, dict[str, float]] = FIELD_PRIORS) -> dict[str, UnitReader]:
    """A reader for each field, from the catalogue, whose size is checked."""
    rows = catalogue.select("unit", "quantity").limit(CATALOGUE_LIMIT + 1).collect()
    if len(rows) > CATALOGUE_LIMIT:
        raise ValueError(f"the unit catalogue has more than {CATALOGUE_LIMIT} units")
    units = {r["unit"]: r["quantity"] for r in rows if r["unit"] is not None}
    return {field: UnitReader(units, weights) for field, weights in priors.items()}


def read_units(text: Column, reader: UnitReader) -> Column:
    """The catalogue unit that a typed unit states; null for null, blank and unreadable ones."""

    @F.pandas_udf("string")
    def read(texts: pd.Series) -> pd.Series:
        return texts.map(reader.read, na_action="ignore").astype(object)

    return read(text)


def limit_units(limits: DataFrame, reader: UnitReader, catalogue: DataFrame) -> DataFrame:
    """One row per slot with an alert or danger above 0; a code of the catalogue speaks first, then the set's name.

    Arrays of unequal length are zipped to the longest, missing entries are null.
    """

    @F.pandas_udf("string")
    def named(names: pd.Series) -> pd.Series:
        return names.map(reader.find, na_action="ignore").astype(object)

    codes = catalogue.where("limit_code is not null and unit is not null").groupBy(F.col("limit_code").cast("int").alias("code")).agg(F.max("unit").alias("coded"))
    slots = limits.select("record_num", named("set_name").alias("_named"), "alert", "danger", "unit_codes").select(
        "record_num",
        "_named",
        F.posexplode(F.arrays_zip("alert", "danger", "unit_codes")).alias("slot", "s"),
    )
    above = lambda c: F.coalesce((c > 0) & ~F.isnan(c), F.lit(False))
    limited = slots.where(above(F.col("s.alert")) | above(F.col("s.danger")))
    # the catalogue has at most CATALOGUE_LIMIT rows, which is checked where its readers are made
    return limited.join(F.broadcast(codes), F.col("s.unit_codes") == F.col("code"), "left").select(
        F.lit("limit").alias("src"),
        F.col("record_num").alias("record_id"),
        "slot",
        F.coalesce("coded", "_named").alias("unit"),
        F.col("s.alert").cast("double").alias("low"),
        F.col("s.danger").cast("double").alias("high"),
    )


def note_units(notes: DataFrame, reader: UnitReader) -> DataFrame:
    """One row per ``note_id``; the unit note speaks first, then the alarm line of the text."""

    @F.pandas_udf("string")
    def line(note: pd.Series, text: pd.Series, band: pd.Series) -> pd.Series:
        return pd.Series(
            [reader.read(n) or alarm_line_unit(reader, t, b) for n, t, b in zip(note, text, band, strict=True)], dtype=object
        )

    each = notes.where(F.col("note_id").isNotNull()).select(
        "note_id", line("units_note", "note_text", "band").alias("unit"), F.col("line_value").cast("double").alias("v")
    )
    return each.groupBy("note_id").agg(F.max("unit").alias("unit"), F.max("v").alias("v")).select(
        F.lit("note").alias("src"), F.col("note_id").alias("record_id"), F.lit(0).alias("slot"), "unit",
        F.col("v").alias("low"), F.lit(None).cast("double").alias("high"),
    )


def spectrum_units(spectra: DataFrame, reader: UnitReader) -> DataFrame:
    """One row per spectrum with the unit of its amplitudes; the amplitudes themselves aren't read."""
    return spectra.select(
        F.lit("spectrum").alias("src"), F.col("record_num").alias("record_id"), F.lit(0).alias("slot"),
        read_units(F.col("units"), reader).alias("unit"),
        F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
    )


def quantities(limits: DataFrame, notes: DataFrame, spectra: DataFrame, catalogue: DataFrame) -> DataFrame:
    """All quantities in common units.

    ``unit`` is null, and so are the converted figures, where the record states no
    unit; ``state`` tells these (unstated) from common and converted ones. ``low``
    and ``high`` are alert and danger of a limit or the value of an alarm line.
    """
    readers = unit_readers(catalogue)
    spelled = (
        limit_units(limits, readers["limit"], catalogue).unionByName(note_units(notes, readers["note"])).unionByName(spectrum_units(spectra, readers["spectrum"]))
    )
    known = catalogue.where("unit is not null").select("unit", "common_unit", F.col("to_common").cast("double")).dropDuplicates(["unit"])
    # at most CATALOGUE_LIMIT rows
    return spelled.join(F.broadcast(known), "unit", "left").select(
        "src", "record_id", "slot", "unit", "common_unit", "to_common",
        (F.col("low") * F.col("to_common")).alias("low_common"),
        (F.col("high") * F.col("to_common")).alias("high_common"),
        F.when(F.col("unit").isNull(), "unstated").when(F.col("unit") == F.col("common_unit"), "common").otherwise("converted").alias("state"),
    )


def foreign_units(limits: DataFrame, notes: DataFrame, spectra: DataFrame, catalogue: DataFrame) -> DataFrame:
    """The quantities whose own record states a unit that is not a common one."""
    return quantities(limits, notes, spectra, catalogue).where("state = 'converted'").select("src", "record_id", "slot", "unit")
