"""Queries of the general data problems (1, 4 and 5) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.operators import history, spikes, units
from tremor.plans.tables import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per version of a series; ISO dates, ``open`` for the last version."""
    h = history.machine_history(table(spark, sf_dir, "observations_consolidated"))
    return h.select(
        "origin", "normalized_tag", "modality",
        F.date_format("valid_from", "yyyy-MM-dd").alias("observed_at"),
        F.coalesce(F.date_format("valid_to", "yyyy-MM-dd"), F.lit("open")).alias("valid_to"),
    )


def p1_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions with the state that each of them holds."""
    h = history.machine_history(table(spark, sf_dir, "observations_consolidated"))
    return h.select(
        "origin", "normalized_tag", "modality", "status", "area_code", F.col("rpm1").cast("double").alias("rpm1"),
        F.date_format("valid_from", "yyyy-MM-dd").alias("observed_at"),
        F.coalesce(F.date_format("valid_to", "yyyy-MM-dd"), F.lit("open")).alias("valid_to"),
    )


def _unit_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [table(spark, sf_dir, n) for n in ("alarm_limit_sets", "alarm_notes", "spectra", "unit_catalog")]


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities whose own record states a unit that is not a common one."""
    return units.foreign_units(*_unit_tables(spark, sf_dir)).select("src", "record_id", F.col("slot").cast("int").alias("slot"), "unit")


def p4_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All quantities in common units, those without a stated unit told apart."""
    return units.quantities(*_unit_tables(spark, sf_dir))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that hold a value the machine cannot have shown."""
    return spikes.implausible_readings(table(spark, sf_dir, "trend_readings"))


_P1 = """
WITH typed AS (
  SELECT origin, nullif(regexp_replace(upper(normalized_tag), '[^A-Z0-9]', '', 'g'), '') AS normalized_tag, modality,
    CASE WHEN regexp_matches(trim(observed_at), '^\\d{4}[-/.]\\d{1,2}[-/.]\\d{1,2}')
           THEN try_strptime(regexp_replace(substr(trim(observed_at), 1, 10), '[/.]', '-', 'g'), '%Y-%m-%d')
         WHEN regexp_matches(trim(observed_at), '^\\d{1,2}[-/.]\\d{1,2}[-/.]\\d{4}')
           THEN try_strptime(regexp_replace(substr(trim(observed_at), 1, 10), '[/.]', '-', 'g'), '%d-%m-%Y')
         WHEN regexp_matches(trim(observed_at), '^\\d{8}') THEN try_strptime(substr(trim(observed_at), 1, 8), '%Y%m%d') END::DATE AS d,
    nullif(upper(trim(status)), '') AS status, nullif(trim(area_code), '') AS area_code, rpm1::DOUBLE AS rpm1,
    row_number() OVER (PARTITION BY origin, nullif(regexp_replace(upper(normalized_tag), '[^A-Z0-9]', '', 'g'), ''), modality, d
      ORDER BY coalesce(lower(trim(record_kind)) = 'primary', false) DESC, coalesce(inspection_date, '') DESC,
        coalesce(document_id, '') DESC, coalesce(observation_id, '') DESC) AS rn
  FROM observations_consolidated),
held AS (SELECT * FROM typed WHERE rn = 1 AND normalized_tag IS NOT NULL AND d IS NOT NULL),
filled AS (
  SELECT origin, normalized_tag, modality, d,
    coalesce(last_value(status IGNORE NULLS) OVER past, first_value(status IGNORE NULLS) OVER next) AS status,
    coalesce(last_value(area_code IGNORE NULLS) OVER past, first_value(area_code IGNORE NULLS) OVER next) AS area_code,
    coalesce(last_value(rpm1 IGNORE NULLS) OVER past, first_value(rpm1 IGNORE NULLS) OVER next) AS rpm1
  FROM held
  WINDOW past AS (PARTITION BY origin, normalized_tag, modality ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    next AS (PARTITION BY origin, normalized_tag, modality ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
marked AS (
  SELECT *, row_number() OVER w = 1 OR lag(status) OVER w IS DISTINCT FROM status
    OR lag(area_code) OVER w IS DISTINCT FROM area_code OR lag(rpm1) OVER w IS DISTINCT FROM rpm1 AS starts
  FROM filled WINDOW w AS (PARTITION BY origin, normalized_tag, modality ORDER BY d))
SELECT origin, normalized_tag, modality, {columns}strftime(d, '%Y-%m-%d') AS observed_at,
  coalesce(strftime(lead(d) OVER (PARTITION BY origin, normalized_tag, modality ORDER BY d), '%Y-%m-%d'), 'open') AS valid_to
FROM marked WHERE starts
"""

_SPELLED = """CASE
  WHEN {u} IN ('mm/s','mm/seg','mm/seg.','mm·s-1','mm / s') THEN 'mm/s'
  WHEN {u} IN ('in/s','in/sec','plg./s','plg/segs','pul/sg','pulg/seg','ips') THEN 'in/s'
  WHEN {u} IN ('cm/s','cm/seg') THEN 'cm/s'
  WHEN {u} IN ('m/s','m/seg','mts/s') THEN 'm/s'
  WHEN {u} IN ('g','g''s','gs','g-s') THEN 'g'
  WHEN {u} IN ('m/s2','m/s²','m/s^2','m/seg2') THEN 'm/s2'
  WHEN {u} IN ('mg','mg''s','mili-g') THEN 'mg'
  WHEN {u} IN ('um','µm','micras','micrones') THEN 'um'
  WHEN {u} IN ('mil','mils','milésimas','mil p-p') THEN 'mil'
  WHEN {u} IN ('mm','mm pp','mm p-p') THEN 'mm' END"""

_BARE = "trim(regexp_replace(regexp_replace(lower({x}), '[\\[\\]]', ' ', 'g'), ' (rms|pc) *$', ''))"

_P4 = f"""
WITH words AS (SELECT record_num, lower(trim(regexp_replace(set_name, '[\\[\\]()]', ' ', 'g'))) AS s FROM alarm_limit_sets),
named AS (
  SELECT record_num, {_SPELLED.format(u="w")} AS unit FROM (
    SELECT record_num, trim(regexp_extract(' ' || regexp_replace(s, ' +', ' ', 'g') || ' ',
      ' (mm / s|mm p-p|mm pp|mil p-p|mm/seg[.]?|mm·s-1|mm/s|in/sec|in/s|plg[.]/s|plg/segs|pul/sg|pulg/seg|ips|cm/seg|cm/s|m/seg2|m/seg|mts/s|m/s2|m/s²|m/s\\^2|m/s|mili-g|mg''s|mg|g''s|g-s|gs|g|um|µm|micrones|micras|milésimas|mils|mil|mm) ', 1)) AS w
    FROM words)),
slots AS (
  SELECT record_num, unnest(range(13)) AS slot FROM alarm_limit_sets),
limits AS (
  SELECT 'limit' AS src, l.record_num AS record_id, s.slot, coalesce(c.unit, n.unit) AS unit
  FROM alarm_limit_sets l JOIN slots s USING (record_num) JOIN named n USING (record_num)
  LEFT JOIN unit_catalog c ON c.limit_code = l.unit_codes[s.slot + 1]
  WHERE (l.alert[s.slot + 1] > 0 AND NOT isnan(l.alert[s.slot + 1])) OR (l.danger[s.slot + 1] > 0 AND NOT isnan(l.danger[s.slot + 1]))),
lines AS (
  SELECT note_id, units_note, band, unnest(regexp_split_to_array(note_text, '[\\r\\n]+')) AS line FROM (SELECT DISTINCT note_id, units_note, band, note_text FROM alarm_notes)),
stated AS (
  SELECT note_id, units_note, trim(CASE
    WHEN regexp_matches(line, '-\\s+[CD]\\s+Alarm') THEN regexp_extract(line, '^.+\\s-\\s+\\d+(?:[.,]\\d+)?\\s*(.*?)\\s*-\\s+[CD]\\s+Alarm', 1)
    WHEN line LIKE 'ALARMA %' THEN regexp_extract(line, '\\[([^\\]]*)\\]\\s*\\d+(?:[.,]\\d+)?\\s*$', 1)
    WHEN line LIKE 'Valor medido en %' THEN regexp_extract(line, '=\\s*\\d+(?:[.,]\\d+)?\\s*(.*?)\\s*,\\s*nivel', 1)
    WHEN regexp_matches(line, '\\([CD]\\)\\s*$') THEN regexp_extract(line, ':\\s*\\d+(?:[.,]\\d+)?\\s*(.*?)\\s*\\([CD]\\)\\s*$', 1)
    WHEN regexp_matches(line, 'alarma [CD]\\s*$') THEN trim(regexp_extract(' ' || line,
      '\\s(mm / s|mm p-p|mm pp|mil p-p|\\S+)\\s+\\d+(?:[.,]\\d+)?\\s+alarma', 1)) END) AS u
  FROM lines),
notes AS (
  SELECT 'note' AS src, note_id AS record_id, 0 AS slot,
    coalesce(max({_SPELLED.format(u=_BARE.format(x="units_note"))}), max({_SPELLED.format(u=_BARE.format(x="u"))})) AS unit
  FROM stated GROUP BY note_id),
spectrum AS (SELECT 'spectrum' AS src, record_num AS record_id, 0 AS slot, {_SPELLED.format(u=_BARE.format(x="units"))} AS unit FROM spectra)
SELECT src, record_id, slot::INT AS slot, unit
FROM (SELECT * FROM limits UNION ALL SELECT * FROM notes UNION ALL SELECT * FROM spectrum)
WHERE unit NOT IN ('mm/s', 'g', 'um')
"""

QUERIES = {
    "p1_found": p1_found,
    "p1_states": p1_states,
    "p4_found": p4_found,
    "p4_quantities": p4_quantities,
    "p5_found": p5_found,
}
SQL = {
    "p1_found": _P1.replace("{columns}", ""),
    "p1_states": _P1.replace("{columns}", "status, area_code, rpm1, "),
    "p4_found": _P4,
}
