"""Queries of the record database over a file made of the suppliers, with their SQL.

Suppliers are points, eight to a machine, machines are dealt to the regions; captures,
readings and notes follow from the supplier's key by the rules stated once here and
once in SQL. The file is made once per table folder and process.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.operators import inventory
from tremor.operators.database import Database
from tremor.plans.tables import table
from tremor.session import shared_folder
from tremor.sources.record_writer import Capture, Point, write_database
from tremor.sources.records import read_records, tag_frequencies

QUERIES, SQL = {}, {}
_MADE: dict[tuple, Database] = {}
D0 = 1_500_000_000
BANDS = [("1X RPM", 2, 0.5, 1.5), ("Mp Wave", 11, 0.0, 0.0)]


def point_of(key: int, name: str, nation: int) -> Point:
    """The point that stands for a supplier."""
    unit = "G's" if key % 2 else "plg/segs"
    return Point(
        name, 1000.0 + key % 97, ["6204", f"B{nation}"],
        [Capture(D0 + key * 1000 + k, 90 + 50 * (key % 4), 1.0 + key % 7, unit, 60.0 * (key % 3), 50.0) for k in range(key % 4)],
        [Capture(D0 + key * 1000 + k, 200, key % 5, "G's", 120.0, 25.0, 0.5) for k in range(key % 2)],
        [(D0 + k * 86_400, 0.125 * (1 + (key + k) % 8), [0.0625 * (1 + (key + k) % 8), 0.25]) for k in range(1 + key % 30)],
        (60, D0 + key, f"{'1X RPM' if key % 8 else 'OVERALL VALUE'} - {10 + key % 11}.5 mm/Seg -  D Alarm") if key % 4 == 0 else None,
        key % 50 == 7,
    )


def record_database(spark: SparkSession, sf_dir: str) -> Database:
    """The database of a table folder, made at the first call; suppliers are a dimension, which the writer holds in memory."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MADE:
        regions = [r["r_name"] for r in table(spark, sf_dir, "region").orderBy("r_regionkey").select("r_name").collect()]
        suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey").orderBy("s_suppkey").collect()
        areas = [(r, []) for r in regions]
        for k in range(0, len(suppliers), 8):
            own = [point_of(s["s_suppkey"], s["s_name"], s["s_nationkey"]) for s in suppliers[k : k + 8]]
            areas[(k // 8) % len(areas)][1].append((f"MACHINE {k // 8}", own))
        folder = shared_folder(spark, "records").removeprefix("file:")
        os.makedirs(folder, exist_ok=True)
        write_database(f"{folder}/plant.rec", areas, BANDS, [0.4, 0.2, 0.1], [0.8, 0.4, 0.2], [1, 1, 1])
        _MADE[key] = Database(spark, f"{folder}/plant.rec")
    return _MADE[key]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, d: f(record_database(spark, d))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# a row per supplier with its place among them
_S = """s AS (SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nation, (row_number() OVER (ORDER BY s_suppkey) - 1) // 8 AS m,
CASE WHEN s_suppkey % 2 = 1 THEN 'G''s' ELSE 'mm/s' END AS unit, regexp_replace(s_name, '[^A-Za-z0-9]+', '_', 'g') AS pid FROM supplier),
r AS (SELECT r_name, (row_number() OVER (ORDER BY r_regionkey) - 1) AS o, count(*) OVER () AS n FROM region),
p AS (SELECT s.*, 'MACHINE_' || m AS machine, r.r_name AS area FROM s JOIN r ON r.o = m % r.n)"""


@query("SELECT (row_number() OVER (ORDER BY r_regionkey) - 1)::INT AS area_ordinal, r_name AS area_name, regexp_replace(r_name, '[^A-Za-z0-9]+', '_', 'g') AS area_code FROM region")
def record_areas(db: Database) -> DataFrame:
    return db.areas().select(F.col("area_ordinal").cast("int").alias("area_ordinal"), "area_name", "area_code")


@query(f"WITH {_S} SELECT DISTINCT area AS area_name, machine AS machine_id, 'MACHINE ' || m AS machine_name FROM p")
def record_machines(db: Database) -> DataFrame:
    return db.machines().select("area_name", "machine_id", "machine_name")


@query(f"WITH {_S} SELECT area AS area_name, machine AS machine_id, pid AS point_id, name AS long_name, ['6204', 'B' || nation] AS bearings, 1000.0::DOUBLE + key % 97 AS rpm FROM p")
def record_points(db: Database) -> DataFrame:
    return db.points().select("area_name", "machine_id", "point_id", "long_name", F.col("bearing_designations").alias("bearings"), F.col("nominal_speed_rpm").alias("rpm"))


_SPECTRA = """f AS (SELECT p.*, k, 90 + 50 * (key % 4) AS n, (1 + key % 7) * CASE WHEN key % 2 = 1 THEN 1.3 ELSE 48.5 END AS v FROM p, range(4) t(k) WHERE k < key % 4 AND key % 50 <> 7)"""


@query(f"WITH {_S}, {_SPECTRA} SELECT machine AS machine_id, pid AS point_id, k::INT AS hop, epoch_us(to_timestamp({D0} + key * 1000 + k)) AS t, unit, n::INT AS lines, round(n * v, 2) AS total FROM f")
def record_spectra(db: Database) -> DataFrame:
    total = F.aggregate("data", F.lit(0.0), lambda a, x: a + F.round(x.cast("double"), 4))
    return db.spectra().select("machine_id", "point_id", F.col("hop").cast("int"), F.unix_micros("timestamp_utc").alias("t"), "unit", F.size("data").alias("lines"), F.round(total, 2).alias("total"))


@query(f"WITH {_S} SELECT machine AS machine_id, pid AS point_id, epoch_us(to_timestamp({D0} + key * 1000)) AS t, 200 AS samples, 100.0::DOUBLE * (key % 5) AS total, 2560.0::DOUBLE AS rate FROM p WHERE key % 2 = 1")
def record_waveforms(db: Database) -> DataFrame:
    total = F.aggregate("data", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return db.waveforms().select("machine_id", "point_id", F.unix_micros("timestamp_utc").alias("t"), F.size("data").alias("samples"), total.alias("total"), F.round(F.col("sample_rate_hz").cast("double"), 2).alias("rate"))


# units come from a point's first spectrum: points without one, or with a broken chain, have no trends
_READINGS = """d AS (SELECT p.*, k, (1 + (key + k) % 8) AS x FROM p, range(30) t(k) WHERE k <= key % 30 AND key % 4 > 0 AND key % 50 <> 7)"""
_TRENDS = f"""WITH {_S}, {_READINGS}, v AS (
SELECT machine, pid, k, NULL AS band, 0.125 * x AS raw, CASE WHEN key % 2 = 1 THEN 1.0 ELSE 25.4 END AS scale, unit, CASE WHEN key % 2 = 0 THEN 0.4 END AS a, CASE WHEN key % 2 = 0 THEN 0.8 END AS b FROM d
UNION ALL SELECT machine, pid, k, '1X RPM', 0.0625 * x, 25.4, 'mm/s', 0.2, 0.4 FROM d UNION ALL SELECT machine, pid, k, 'Mp Wave', 0.25, 1.0, 'G''s', NULL, NULL FROM d)"""


@query(f"""{_TRENDS} SELECT machine AS machine_id, pid AS point_id, epoch_us(to_timestamp({D0} + k * 86400)) AS t, band, unit, round(raw * scale, 4)::DOUBLE AS value,
CASE WHEN a IS NULL THEN NULL WHEN raw >= b THEN 3 WHEN raw >= a THEN 2 ELSE 0 END::INT AS alarm FROM v""")
def record_trends(db: Database) -> DataFrame:
    return db.trends().select("machine_id", "point_id", "t", "band", "unit", F.round(F.col("value").cast("double"), 4).alias("value"), F.col("alarm").cast("int").alias("alarm"))


_NOTES = """n AS (SELECT p.*, CASE WHEN key % 8 > 0 THEN '1X RPM' ELSE 'OVERALL VALUE' END AS band, 10.5 + key % 11 AS v FROM p WHERE key % 4 = 0)"""


@query(f"WITH {_S}, {_NOTES} SELECT machine AS machine_id, pid AS point_id, band || ' - ' || v || ' mm/Seg -  D Alarm' AS note_text, 60 AS severity, 'D' AS severity_level, epoch_us(to_timestamp({D0} + key)) AS t FROM n")
def record_notes(db: Database) -> DataFrame:
    return db.notes().select("machine_id", "point_id", "note_text", F.col("severity").cast("int"), "severity_level", F.unix_micros("measured_at_utc").alias("t"))


@query(f"""WITH {_S}, {_NOTES} SELECT machine AS machine_id, pid AS point_id, band AS note_band, v::DOUBLE AS note_value, CASE WHEN band = '1X RPM' THEN 1 ELSE 0 END AS slot,
CASE WHEN band = '1X RPM' THEN 10.16 ELSE 20.32 END::DOUBLE AS danger, v >= CASE WHEN band = '1X RPM' THEN 10.16 ELSE 20.32 END AS coherent FROM n""")
def record_note_checks(db: Database) -> DataFrame:
    return db.checked_notes().select("machine_id", "point_id", "note_band", "note_value", F.col("slot").cast("int"), F.round("note_danger", 3).alias("danger"), "coherent")


@query(f"""WITH {_S}, {_NOTES} SELECT 'a:' || machine || ':' || pid || ':vibration:' || strftime(make_timestamp((({D0} + key) * 1000000)::BIGINT), '%Y-%m-%d') AS observation_id, 'DANGER' AS status, 3 AS alarm,
'UNMAPPED' AS fault_group FROM n WHERE v >= CASE WHEN band = '1X RPM' THEN 10.16 ELSE 20.32 END""")
def record_alarm_observations(db: Database) -> DataFrame:
    return db.alarm_observations("a").select("observation_id", "status", F.col("alarm").cast("int"), F.col("findings")[0]["fault_group"].alias("fault_group"))


@query(f"""WITH {_S}, {_SPECTRA}, {_READINGS}, c AS (SELECT machine, pid, 'fft' AS kind, {D0} + key * 1000 + k AS ts FROM f UNION ALL SELECT machine, pid, 'waveform', {D0} + key * 1000 FROM p WHERE key % 2 = 1
UNION ALL SELECT machine, pid, 'trend', {D0} + k * 86400 FROM d)
SELECT machine AS machine_id, pid AS point_id, kind, count(*) AS n, epoch_us(to_timestamp(min(ts))) AS first_us, epoch_us(to_timestamp(max(ts))) AS last_us FROM c GROUP BY ALL""")
def record_summaries(db: Database) -> DataFrame:
    return db.summaries().select("machine_id", "point_id", "kind", "n", F.unix_micros("first_at").alias("first_us"), F.unix_micros("last_at").alias("last_us"))


@query(f"""WITH {_S}, {_SPECTRA}, {_READINGS}, c AS (SELECT machine FROM f UNION ALL SELECT machine FROM p WHERE key % 2 = 1 UNION ALL SELECT machine FROM d)
SELECT area AS area_name, machine AS machine_id, count(DISTINCT machine) AS units, coalesce(sum(n), 0)::BIGINT AS captures, (2 - grouping(area) - grouping(machine))::INT AS level
FROM (SELECT DISTINCT area, machine FROM p) LEFT JOIN (SELECT machine, count(*) AS n FROM c GROUP BY 1) USING (machine) GROUP BY ROLLUP (area, machine)""")
def record_report(db: Database) -> DataFrame:
    m = db.machines().select("area_name", "machine_id")
    return inventory.rolled_up(m, db.summaries(), "machine_id", ["area_name", "machine_id"], {"captures": F.sum("n")})


@query(f"""WITH {_S} SELECT 'vdps' AS chain, 'cycle' AS fault, count(*) AS n FROM p WHERE key % 50 = 7 AND key % 4 > 0 HAVING count(*) > 0""")
def record_faults(db: Database) -> DataFrame:
    return db.faults().groupBy("chain", "fault").agg(F.count("*").alias("n"))


@query("""SELECT 1 AS template_index, * FROM (VALUES (0, '1X RPM', 2, 0.5::DOUBLE, 1.5::DOUBLE), (1, 'Mp Wave', 11, 0.0::DOUBLE, 0.0::DOUBLE)) t(slot, band, band_type, low, high)""")
def record_templates(db: Database) -> DataFrame:
    return db.templates().select(F.col("template_index").cast("int"), "slot", "band", "band_type", F.col("low").cast("double"), F.col("high").cast("double"))


@query("""SELECT 1 AS limits_index, 'LIMITS' AS set_name, slot, round(alert, 4) AS alert, round(danger, 4) AS danger FROM (VALUES (0, 0.4::DOUBLE, 0.8::DOUBLE), (1, 0.2::DOUBLE, 0.4::DOUBLE), (2, 0.1::DOUBLE, 0.2::DOUBLE)) t(slot, alert, danger)""")
def record_limits(db: Database) -> DataFrame:
    rows = db.limits().where("alert is not null or danger is not null")
    return rows.select(F.col("limits_index").cast("int"), "set_name", "slot", F.round("alert", 4).alias("alert"), F.round("danger", 4).alias("danger"))


@query(f"""WITH {_S}, c AS (SELECT 'vdpm' AS tag FROM p UNION ALL SELECT 'pdcd' FROM p UNION ALL SELECT 'vdfw' FROM p WHERE key % 2 = 1 UNION ALL SELECT 'vcfw' FROM p WHERE key % 2 = 1
UNION ALL SELECT 'vdps' FROM p, range(4) t(k) WHERE k < key % 4 UNION ALL SELECT 'vcps' FROM p, range(4) t(k), range(3) u(j) WHERE k < key % 4 AND j < ceil((12 + 50 * (key % 4)) / 122.0)
UNION ALL SELECT unnest(['gdsc', 'gdnl']) FROM p WHERE key % 4 = 0 UNION ALL SELECT unnest(['gdcm', 'gipm']) FROM (SELECT DISTINCT machine FROM p))
SELECT tag, count(*) AS n FROM c GROUP BY 1""")
def record_tags(db: Database) -> DataFrame:
    known = ("vdpm", "pdcd", "vdfw", "vcfw", "vdps", "vcps", "gdsc", "gdnl", "gdcm", "gipm")
    return tag_frequencies(read_records(db.spark, db.path)).where(F.col("tag").isin(*known))
