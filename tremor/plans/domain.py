"""Queries of the operators on condition-monitoring data, each with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremor.functions import names
from tremor.operators import alarms, chains, crosswalk, documents, findings, ground_truth, history, inventory, ordered, signals
from tremor.plans.tables import table
from tremor.session import shared_folder

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _observations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "observations_consolidated")


KEY = ["origin", "normalized_tag", "observed_at", "modality"]
_WINNERS = """SELECT origin, normalized_tag, observed_at, modality, document_id, observation_id, record_kind, status
FROM observations_consolidated
QUALIFY row_number() OVER (PARTITION BY origin, normalized_tag, observed_at, modality ORDER BY coalesce(record_kind = 'primary', false) DESC,
  coalesce(inspection_date, '') DESC, document_id DESC NULLS LAST, observation_id DESC NULLS LAST) = 1"""


def _winners(spark: SparkSession, d: str) -> DataFrame:
    return ordered.latest_primary(_observations(spark, d), KEY)


@query(_WINNERS)
def dedup_primary_latest(spark, d):
    return _winners(spark, d).select(*KEY, "document_id", "observation_id", "record_kind", "status")


@query(f"""SELECT origin, normalized_tag, modality, observed_at, status,
lead(observed_at) OVER (PARTITION BY origin, normalized_tag, modality ORDER BY observed_at) AS next_at FROM ({_WINNERS})""")
def valid_to_intervals(spark, d):
    w = _winners(spark, d).select("origin", "normalized_tag", "modality", "observed_at", "status")
    return ordered.valid_until(w, ["origin", "normalized_tag", "modality"], "observed_at", "next_at")


@query("""SELECT record_num, (row_number() OVER (PARTITION BY record_num ORDER BY p) - 1)::INT AS idx, designation FROM (
SELECT record_num, unnest(bearing_designations) AS designation, generate_subscripts(bearing_designations, 1) AS p FROM points)
WHERE designation IS NOT NULL AND designation <> ''""")
def findings_posexplode(spark, d):
    return ordered.indexed(table(spark, d, "points"), ["record_num"], F.col("bearing_designations"), "designation", "idx")


@query(f"""SELECT o.document_id, o.observation_id, count(*) AS n FROM observations_consolidated o
WHERE EXISTS (SELECT 1 FROM ({_WINNERS}) w WHERE w.document_id = o.document_id AND w.observation_id = o.observation_id) GROUP BY ALL""")
def findings_semi_consolidated(spark, d):
    o = _observations(spark, d).select("document_id", "observation_id")
    return o.join(_winners(spark, d).select("document_id", "observation_id"), ["document_id", "observation_id"], "left_semi").groupBy("document_id", "observation_id").agg(F.count("*").alias("n"))


@query("""WITH c AS (SELECT regexp_replace(strip_accents(upper(normalized_tag)), '[^A-Z0-9]', '', 'g') AS t, max(nullif(trim(dataset_machine_id), '')) AS id
FROM crosswalk WHERE nullif(trim(dataset_machine_id), '') IS NOT NULL GROUP BY 1)
SELECT document_id, observation_id, normalized_tag, coalesce(nullif(trim(o.dataset_machine_id), ''), c.id) AS machine_id
FROM observations_consolidated o LEFT JOIN c ON regexp_replace(strip_accents(upper(o.normalized_tag)), '[^A-Z0-9]', '', 'g') = c.t""")
def crosswalk_lookup(spark, d):
    out = crosswalk.lookup(_observations(spark, d), table(spark, d, "crosswalk"), "normalized_tag", "dataset_machine_id", "machine_id")
    return out.select("document_id", "observation_id", "normalized_tag", "machine_id")


@query("""WITH tags AS (SELECT DISTINCT normalized_tag AS tag FROM crosswalk WHERE normalized_tag <> ''),
ids AS (SELECT DISTINCT dataset_machine_id AS m FROM crosswalk WHERE dataset_machine_id IS NOT NULL),
w AS (SELECT m, list_transform(list_filter(regexp_split_to_array(m, '[^A-Za-z0-9]+'), lambda x: x <> ''), lambda x: upper(x)) AS w FROM ids),
starts AS (SELECT m, w, unnest(range(1, len(w) + 1)) AS i FROM w),
runs AS (SELECT m, array_to_string(w[i:j], '') AS run, j = len(w) AS last FROM (SELECT m, w, i, unnest(range(i, len(w) + 1)) AS j FROM starts)),
words AS (SELECT run AS tag, m, CASE WHEN bool_or(last) THEN 0 ELSE 1 END AS s FROM runs WHERE run IN (SELECT tag FROM tags) GROUP BY 1, 2),
subs AS (SELECT t.tag, i.m, 2 AS s FROM tags t, ids i WHERE t.tag NOT IN (SELECT tag FROM words) AND contains(regexp_replace(upper(i.m), '[^A-Z0-9]', '', 'g'), t.tag)),
ranked AS (SELECT *, min(s) OVER (PARTITION BY tag) AS b FROM (SELECT * FROM words UNION ALL SELECT * FROM subs)),
sel AS (SELECT tag, s, count(*) AS n, CASE WHEN count(*) = 1 THEN min(m) END AS m FROM ranked WHERE s = b GROUP BY 1, 2),
top AS (SELECT *, min(s) OVER (PARTITION BY m) AS ts, count(*) OVER (PARTITION BY m) AS k FROM sel),
fin AS (SELECT *, n = 1 AND s = ts AND sum(CASE WHEN s = ts THEN 1 ELSE 0 END) OVER (PARTITION BY m) = 1 AS keep FROM top)
SELECT t.tag, CASE s WHEN 0 THEN 'exact_suffix' WHEN 1 THEN 'delimited' WHEN 2 THEN 'substring' END AS tier, coalesce(n, 0) AS n_candidates,
CASE WHEN keep THEN m END AS machine_id, CASE WHEN keep THEN 'CW00' || (s + 1) || CASE WHEN k > 1 THEN '+CW004' ELSE '' END END AS rule,
CASE WHEN n IS NULL THEN 'unmatched' WHEN n > 1 THEN 'ambiguous' WHEN keep THEN 'matched' ELSE 'reverse_collision' END AS resolution
FROM tags t LEFT JOIN fin USING (tag)""")
def crosswalk_tiers(spark, d):
    c = table(spark, d, "crosswalk")
    tags = c.where("normalized_tag <> ''").select(F.col("normalized_tag").alias("tag"))
    ids = c.where("dataset_machine_id is not null").select(F.col("dataset_machine_id").alias("machine_id")).distinct()
    return crosswalk.resolve(tags, ids)


@query("""SELECT normalized_tag, area_name FROM crosswalk c WHERE NOT EXISTS (SELECT 1 FROM observations_consolidated o
WHERE regexp_replace(upper(o.normalized_tag), '[^A-Z0-9]', '', 'g') = c.normalized_tag)""")
def machines_without_truth(spark, d):
    seen = _observations(spark, d).select(history.normalise_tag(F.col("normalized_tag")).alias("normalized_tag")).distinct()
    return table(spark, d, "crosswalk").select("normalized_tag", "area_name").join(seen, "normalized_tag", "left_anti")


@query("""WITH p AS (SELECT normalized_tag, record_num, long_name, lower(strip_accents(long_name)) AS low FROM points),
e AS (SELECT *, regexp_matches(low, '\\blad[o]?\\s+(?:op\\w*|contrari\\w*|libre)\\b') OR list_has_any(regexp_split_to_array(low, '[^0-9a-z]+'), ['loa', 'lca']) AS nde,
 regexp_matches(low, '\\blad[o]?\\s+(?:acopl\\w*|motor?)\\b') OR list_contains(regexp_split_to_array(low, '[^0-9a-z]+'), 'la') AS de FROM p)
SELECT CASE WHEN de AND NOT nde THEN 'DE' WHEN nde AND NOT de THEN 'NDE' END AS location, CASE WHEN de AND nde THEN 'ambiguous' WHEN de OR nde THEN 'derived' ELSE 'absent' END AS status,
count(*) AS points FROM e GROUP BY ALL""")
def point_sides(spark, d):
    e = names.evidence(table(spark, d, "points"), ["record_num"], "long_name")
    return e.groupBy("location", F.col("location_status").alias("status")).agg(F.count("*").alias("points"))


@query()
def sibling_direction_proposals(spark, d):
    e = names.evidence(table(spark, d, "points"), ["normalized_tag", "record_num"], "long_name")
    return names.sibling_directions(e, ["normalized_tag"], "long_name")


@query()
def point_name_evidence(spark, d):
    return names.name_audit(names.evidence(table(spark, d, "points"), ["record_num"], "long_name"), F.lit(1))


@query("""WITH x AS (SELECT mix_name, source, round(target_share / sum(target_share) OVER (PARTITION BY mix_name) * 1000000, 6) AS x FROM mix_targets),
f AS (SELECT *, floor(x) AS f, 1000000 - sum(floor(x)) OVER (PARTITION BY mix_name) AS spare FROM x)
SELECT mix_name, source, (f + CASE WHEN row_number() OVER (PARTITION BY mix_name ORDER BY f - x, source) <= spare THEN 1 ELSE 0 END) / 1000000 AS weight FROM f""")
def overlay_weights(spark, d):
    t = table(spark, d, "mix_targets").select("mix_name", "source", "target_share")
    return findings.largest_remainder(t, ["mix_name"], ["source"], F.col("target_share"), "weight").select("mix_name", "source", "weight")


_LEVEL = "CASE WHEN v IS NULL OR (a IS NULL AND b IS NULL) THEN NULL WHEN v >= b THEN 3 WHEN v >= a THEN 2 ELSE 0 END"


@query(f"""SELECT reading_id, point_record_num, v AS value_raw, a AS alert_raw, b AS danger_raw, ({_LEVEL})::INT AS alarm FROM (
SELECT t.reading_id, t.point_record_num, t.overall_raw::DOUBLE AS v,
CASE WHEN l.unit_codes[1] IN (1, 3) AND l.alert[1] > 0 AND NOT isnan(l.alert[1]) THEN l.alert[1]::DOUBLE END AS a,
CASE WHEN l.unit_codes[1] IN (1, 3) AND l.danger[1] > 0 AND NOT isnan(l.danger[1]) THEN l.danger[1]::DOUBLE END AS b
FROM trend_readings t LEFT JOIN points p ON p.record_num = t.point_record_num LEFT JOIN alarm_limit_sets l ON l.record_num = p.limit_record_num)""")
def trend_alarm_levels(spark, d):
    return alarms.levels(table(spark, d, "trend_readings"), table(spark, d, "points"), table(spark, d, "alarm_limit_sets"))


@query("""WITH s AS (SELECT reading_id, point_record_num, timestamp_utc, overall_raw, lag(timestamp_utc) OVER w AS prev,
min(CASE WHEN overall_raw > 0 AND overall_raw <= 200 AND NOT isnan(overall_raw) THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) AS ok
FROM trend_readings WHERE timestamp_utc IS NOT NULL WINDOW w AS (PARTITION BY point_record_num ORDER BY timestamp_utc, reading_id))
SELECT reading_id, point_record_num, epoch_us(coalesce(prev, TIMESTAMPTZ '2000-01-01 00:00:00+00')) AS dated_us FROM s WHERE ok = 1""")
def trend_off_by_one(spark, d):
    t = table(spark, d, "trend_readings").where("timestamp_utc is not null").select("reading_id", "point_record_num", F.unix_micros("timestamp_utc").alias("us"), F.col("overall_raw").cast("double").alias("v"))
    t = t.withColumn("slot", F.struct("us", "reading_id"))
    dated = ordered.shifted_dates(t, ["point_record_num"], "slot", "us", F.lit(946684800000000), "dated_us", F.floor(F.col("us") / 86_400_000_000))
    kept = ordered.take_while(dated, ["point_record_num"], ["us", "reading_id"], (F.col("v") > 0) & (F.col("v") <= 200) & ~F.isnan("v"))
    return kept.select("reading_id", "point_record_num", "dated_us")


@query("""SELECT DISTINCT t, point_record_num, metric_id, value FROM (
SELECT epoch_us(timestamp_utc) AS t, point_record_num, 'overall__' || point_record_num AS metric_id, overall_raw::DOUBLE AS value FROM trend_readings WHERE overall_raw IS NOT NULL
UNION ALL SELECT t, point_record_num, 'band_' || k || '__' || point_record_num, value FROM (
SELECT epoch_us(timestamp_utc) AS t, point_record_num, unnest(bands_raw)::DOUBLE AS value, generate_subscripts(bands_raw, 1) - 1 AS k FROM trend_readings) WHERE value IS NOT NULL
UNION ALL SELECT epoch_us(timestamp_utc), point_record_num, 'load', carga_pct::DOUBLE FROM spectra WHERE carga_pct IS NOT NULL
UNION ALL SELECT epoch_us(timestamp_utc), point_record_num, 'speed', rpm::DOUBLE / 60 FROM spectra WHERE rpm > 0)
WHERE t IS NOT NULL""")
def trend_long_union(spark, d):
    r = table(spark, d, "trend_readings").select(F.unix_micros("timestamp_utc").alias("t"), "point_record_num", "overall_raw", "bands_raw")
    id_ = F.col("point_record_num").cast("string")
    overall = r.select("t", "point_record_num", F.concat(F.lit("overall__"), id_).alias("metric_id"), F.col("overall_raw").cast("double").alias("value")).where("value is not null")
    bands = r.select("t", "point_record_num", F.posexplode("bands_raw").alias("k", "v")).select(
        "t", "point_record_num", F.concat(F.lit("band_"), F.col("k").cast("string"), F.lit("__"), id_).alias("metric_id"), F.col("v").cast("double").alias("value")
    )
    s = table(spark, d, "spectra")
    context = signals.capture_context(s, F.unix_micros("timestamp_utc"), F.col("rpm"), F.col("carga_pct"), ["point_record_num"])
    return overall.unionByName(bands).where("value is not null").unionByName(context).where("t is not null").distinct()


@query("""WITH s AS (SELECT record_num, unnest(range(13)) AS slot, alert, danger, unit_codes FROM alarm_limit_sets),
b AS (SELECT record_num, slot, CASE unit_codes[slot + 1] WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 4 WHEN 4 THEN 11 END AS t FROM s WHERE slot > 0)
SELECT record_num, slot::INT AS slot, t AS band_type, CASE WHEN t IN (1, 2) THEN 25.4::DOUBLE ELSE 1.0::DOUBLE END AS scale, CASE WHEN t IN (1, 2) THEN 'mm/s' ELSE 'G''s' END AS unit,
CASE WHEN t = 2 THEN slot * 0.5::DOUBLE END AS low_order, CASE WHEN t = 2 THEN slot * 1.5::DOUBLE END AS high_order,
CASE WHEN t IN (1, 4) THEN slot * 0.5::DOUBLE END AS low_hz, CASE WHEN t IN (1, 4) THEN slot * 1.5::DOUBLE END AS high_hz FROM b WHERE t IS NOT NULL""")
def band_columns(spark, d):
    s = alarms.slots_of(table(spark, d, "alarm_limit_sets")).where("slot > 0")
    code = F.col("code")
    t = F.when(code == 1, 1).when(code == 2, 2).when(code == 3, 4).when(code == 4, 11)
    typed = s.select(F.col("limit_record_num").alias("record_num"), "slot", t.alias("band_type"), (F.col("slot") * 0.5).alias("low"), (F.col("slot") * 1.5).alias("high"))
    return alarms.band_columns(typed).select("record_num", "slot", "band_type", "scale", "unit", "low_order", "high_order", "low_hz", "high_hz")


_NOTE = """WITH l AS (SELECT note_id, point_record_num, severity, measured_at_utc, list_filter(list_transform(regexp_split_to_array(note_text, '[\\r\\n]+'), lambda x: trim(x)),
lambda x: regexp_matches(x, '^(.+?)\\s*-\\s*([0-9]+(?:\\.[0-9]+)?)\\s+(mm/Seg|G-s)\\s*-\\s*([CD])\\s+Alarm\\s*$'))[1] AS line FROM alarm_notes),
n AS (SELECT *, nullif(regexp_extract(line, '^(.+?)\\s*-\\s*([0-9]+(?:\\.[0-9]+)?)\\s+(mm/Seg|G-s)\\s*-\\s*([CD])\\s+Alarm', 1), '') AS note_band,
nullif(regexp_extract(line, '^(.+?)\\s*-\\s*([0-9]+(?:\\.[0-9]+)?)\\s+(mm/Seg|G-s)\\s*-\\s*([CD])\\s+Alarm', 2), '')::DOUBLE AS note_value,
CASE nullif(regexp_extract(line, '^(.+?)\\s*-\\s*([0-9]+(?:\\.[0-9]+)?)\\s+(mm/Seg|G-s)\\s*-\\s*([CD])\\s+Alarm', 3), '') WHEN 'mm/Seg' THEN 'mm/s' WHEN 'G-s' THEN 'G''s' END AS note_unit,
nullif(regexp_extract(line, '^(.+?)\\s*-\\s*([0-9]+(?:\\.[0-9]+)?)\\s+(mm/Seg|G-s)\\s*-\\s*([CD])\\s+Alarm', 4), '') AS note_level FROM l)"""


@query(f"{_NOTE} SELECT note_id, note_band, note_value, note_unit, note_level FROM n")
def alarm_note_parse(spark, d):
    return alarms.parse_note(table(spark, d, "alarm_notes")).select("note_id", "note_band", "note_value", "note_unit", "note_level")


# a template per limit set: the bands its notes name, in order, as far as the set has slots
_CHECKED = f"""{_NOTE}, i AS (SELECT n.*, p.limit_record_num FROM n LEFT JOIN points p ON p.record_num = n.point_record_num),
t AS (SELECT limit_record_num, note_band, row_number() OVER (PARTITION BY limit_record_num ORDER BY note_band) AS slot FROM (
SELECT DISTINCT limit_record_num, note_band FROM i WHERE limit_record_num IS NOT NULL AND note_band IS NOT NULL AND upper(note_band) <> 'OVERALL VALUE') QUALIFY slot <= 12),
s AS (SELECT i.*, CASE WHEN upper(i.note_band) = 'OVERALL VALUE' THEN 0 ELSE t.slot END AS slot FROM i LEFT JOIN t ON t.limit_record_num = i.limit_record_num AND t.note_band = i.note_band),
j AS (SELECT s.*, l.unit_codes[slot + 1] AS code,
CASE WHEN l.alert[slot + 1] > 0 THEN l.alert[slot + 1]::DOUBLE * CASE WHEN note_unit = 'mm/s' THEN 25.4 ELSE 1 END END AS a,
CASE WHEN l.danger[slot + 1] > 0 THEN l.danger[slot + 1]::DOUBLE * CASE WHEN note_unit = 'mm/s' THEN 25.4 ELSE 1 END END AS b
FROM s LEFT JOIN alarm_limit_sets l ON l.record_num = s.limit_record_num),
k AS (SELECT *, CASE WHEN a IS NULL AND b IS NULL THEN NULL WHEN note_level = 'C' THEN a IS NOT NULL AND a <= note_value AND (b IS NULL OR note_value < b) ELSE b IS NOT NULL AND note_value >= b END AS ok,
coalesce(code = CASE WHEN note_unit = 'mm/s' THEN 1 ELSE 3 END, false) AS same FROM j),
r AS (SELECT *, CASE WHEN note_level IS NULL THEN 'not_in_alarm' WHEN coalesce(NOT ok, true) THEN 'incoherent' WHEN NOT same THEN 'unit_mismatch' WHEN measured_at_utc IS NULL THEN 'undated' END AS reject_reason FROM k)"""


def _checked(spark, d):
    notes, points, limits = (table(spark, d, n) for n in ("alarm_notes", "points", "alarm_limit_sets"))
    links = points.select(F.col("record_num").alias("point_record_num"), F.col("limit_record_num").alias("template_index"), F.col("limit_record_num").alias("limits_index"))
    bands = alarms.parse_note(notes).join(links, "point_record_num").where(f"template_index is not null and note_band is not null and upper(note_band) <> '{alarms.OVERALL}'")
    slot = F.row_number().over(Window.partitionBy("template_index").orderBy("band")) - 1
    templates = bands.select("template_index", F.col("note_band").alias("band")).distinct().withColumn("slot", slot).where("slot < 12")
    return alarms.checked_notes(notes, links, alarms.long_limits(limits), templates)


@query(f"{_CHECKED} SELECT note_id, note_band, note_level, CASE WHEN severity > 40 THEN 'D' WHEN severity > 0 THEN 'C' END AS severity_level, ok AS coherent, reject_reason FROM r")
def alarm_note_checks(spark, d):
    return _checked(spark, d).select("note_id", "note_band", "note_level", "severity_level", "coherent", "reject_reason")


@query(f"""{_CHECKED} SELECT note_id, note_band, slot::INT AS slot, round(a, 6) AS alert, round(b, 6) AS danger, same AS unit_consistent, ok AS coherent FROM r
WHERE note_band IS NOT NULL AND upper(note_band) <> 'OVERALL VALUE'""")
def alarm_note_band_checks(spark, d):
    c = _checked(spark, d).where(f"note_band is not null and upper(note_band) <> '{alarms.OVERALL}'")
    return c.select("note_id", "note_band", "slot", F.round("note_alert", 6).alias("alert"), F.round("note_danger", 6).alias("danger"), "unit_consistent", "coherent")


@query(f"""{_CHECKED} SELECT count(*) AS notes, count(note_level) AS alarms, count(*) FILTER (reject_reason = 'incoherent') AS incoherent,
count(*) FILTER (reject_reason = 'unit_mismatch') AS unit_mismatch, count(*) FILTER (reject_reason IS NULL) AS emitted,
round(CASE WHEN count(note_level) = 0 THEN 0 ELSE 100.0 * (count(note_level) - count(*) FILTER (reject_reason = 'incoherent')) / count(note_level) END, 6) AS coherent_pct FROM r""")
def coherent_summary(spark, d):
    return alarms.coherence_summary(_checked(spark, d))


@query("""SELECT record_num, len(data) AS n, round(list_sum(list_transform(data, lambda x: x::DOUBLE)), 4) AS total FROM (
SELECT record_num, CASE WHEN n_lines > 0 THEN list_concat(amplitude[1:78], amplitude[79:])[1:n_lines] ELSE amplitude END AS data FROM spectra)""")
def spectrum_assemble(spark, d):
    a = F.col("amplitude")
    data = signals.assembled(F.slice(a, 1, 78), F.slice(a, 79, F.greatest(F.size(a) - 78, F.lit(0))), F.col("n_lines"))
    s = table(spark, d, "spectra").select("record_num", data.alias("data"))
    return s.select("record_num", F.size("data").cast("long").alias("n"), F.round(F.aggregate("data", F.lit(0.0), lambda x, y: x + y.cast("double")), 4).alias("total"))


@query("""SELECT record_num, round(sqrt(coalesce(list_sum(list_transform(list_filter(list_zip(amplitude, range(len(amplitude))), lambda z: z[2] * fmax_hz / len(amplitude) >= 10 AND z[2] * fmax_hz / len(amplitude) < 100),
lambda z: z[1]::DOUBLE * z[1]::DOUBLE)), 0)), 4) AS rss FROM spectra""")
def spectrum_band_rss(spark, d):
    return table(spark, d, "spectra").select("record_num", F.round(signals.band_value(F.col("amplitude"), F.col("fmax_hz"), F.lit(10.0), F.lit(100.0)), 4).alias("rss"))


@query("""SELECT record_num, (b - 1)::INT AS bin, round((b - 1) * fmax_hz::DOUBLE / n, 4) AS hz, amplitude FROM (
SELECT record_num, fmax_hz, len(amplitude) AS n, generate_subscripts(amplitude, 1) AS b, unnest(amplitude)::DOUBLE AS amplitude FROM spectra)""")
def spectrum_bins_long(spark, d):
    return signals.bins(table(spark, d, "spectra"), ["record_num"], "amplitude", F.col("fmax_hz")).withColumn("hz", F.round("hz", 4))


@query("""SELECT vec_id, CASE WHEN n < k THEN 'short' WHEN n > k AND len(list_filter(embedding[k + 1:], lambda x: x <> 0)) > 0 THEN 'padding' ELSE 'ok' END AS state FROM (
SELECT vec_id, embedding, len(embedding) AS n, (60 + vec_id % 8)::INT AS k FROM embeddings)""")
def waveform_padding_check(spark, d):
    return table(spark, d, "embeddings").select("vec_id", signals.wave_state(F.col("embedding"), (60 + F.col("vec_id") % 8).cast("int")).alias("state"))


@query("""SELECT point_record_num, 'trend' AS kind, count(*) AS n, epoch_us(min(timestamp_utc)) AS first_us, epoch_us(max(timestamp_utc)) AS last_us FROM trend_readings GROUP BY 1
UNION ALL SELECT point_record_num, 'fft', count(*), epoch_us(min(timestamp_utc)), epoch_us(max(timestamp_utc)) FROM spectra GROUP BY 1""")
def type_summary(spark, d):
    t = table(spark, d, "trend_readings").select("point_record_num", F.lit("trend").alias("kind"), F.unix_micros("timestamp_utc").alias("us"))
    s = table(spark, d, "spectra").select("point_record_num", F.lit("fft").alias("kind"), F.unix_micros("timestamp_utc").alias("us"))
    return inventory.type_summary(t.unionByName(s), ["point_record_num", "kind"], "us").withColumnsRenamed({"first_at": "first_us", "last_at": "last_us"})


@query("""WITH f AS (SELECT l_suppkey, count(*) AS samples, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1)
SELECT r_name, n_name, count(*) AS units, sum(coalesce(samples, 0))::BIGINT AS samples, round(sum(coalesce(quantity, 0)), 2) AS quantity, (2 - grouping(r_name) - grouping(n_name))::INT AS level
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN f ON l_suppkey = s_suppkey GROUP BY ROLLUP (r_name, n_name)""")
def inventory_rollup(spark, d):
    units = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    facts = table(spark, d, "lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    out = inventory.rolled_up(units, facts, "s_suppkey", ["r_name", "n_name"], {"samples": F.count("*"), "quantity": F.sum("l_quantity")})
    return out.withColumn("quantity", F.round("quantity", 2))


@query("""SELECT count(DISTINCT p.normalized_tag) AS machines, count(DISTINCT p.record_num) AS points, count(DISTINCT CASE WHEN t.n > 0 THEN p.record_num END) AS points_with_data,
sum(coalesce(t.n, 0))::BIGINT AS readings FROM points p LEFT JOIN (SELECT point_record_num, count(*) AS n FROM trend_readings GROUP BY 1) t ON t.point_record_num = p.record_num""")
def database_stats(spark, d):
    n = table(spark, d, "trend_readings").groupBy(F.col("point_record_num").alias("record_num")).agg(F.count("*").alias("n"))
    return table(spark, d, "points").select("record_num", "normalized_tag").join(n, "record_num", "left").agg(
        F.count_distinct("normalized_tag").alias("machines"), F.count_distinct("record_num").alias("points"),
        F.count_distinct(F.when(F.col("n") > 0, F.col("record_num"))).alias("points_with_data"), F.sum(F.coalesce("n", F.lit(0))).alias("readings"),
    )


@query("""SELECT p.normalized_tag, sum(coalesce(t.n, 0))::BIGINT AS total FROM points p LEFT JOIN (SELECT point_record_num, count(*) AS n FROM trend_readings GROUP BY 1) t ON t.point_record_num = p.record_num
GROUP BY 1 ORDER BY total DESC, normalized_tag LIMIT 20""")
def machine_stats_topn(spark, d):
    n = table(spark, d, "trend_readings").groupBy(F.col("point_record_num").alias("record_num")).agg(F.count("*").alias("n"))
    m = table(spark, d, "points").join(n, "record_num", "left").groupBy("normalized_tag").agg(F.sum(F.coalesce("n", F.lit(0))).alias("total"))
    return inventory.top_n(m, "total", ["normalized_tag"], 20)


@query("SELECT event_type, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM events), 6) AS pct FROM events GROUP BY 1")
def tag_frequencies(spark, d):
    return inventory.histogram(table(spark, d, "events"), "event_type")


@query("""WITH k AS (SELECT normalized_tag, count(DISTINCT coalesce(area_code, chr(0))) AS a, count(DISTINCT coalesce(area_name, chr(0))) AS b, count(DISTINCT coalesce(external_name, chr(0))) AS c
FROM observations_consolidated GROUP BY 1)
SELECT normalized_tag, list_filter([CASE WHEN a > 1 THEN 'area_code' END, CASE WHEN b > 1 THEN 'area_name' END, CASE WHEN c > 1 THEN 'external_name' END], lambda x: x IS NOT NULL) AS fields
FROM k WHERE a > 1 OR b > 1 OR c > 1""")
def metric_catalog(spark, d):
    return inventory.conflicts(_observations(spark, d), ["normalized_tag"], ["area_code", "area_name", "external_name"])


@query("""SELECT 'md-' || substr(sha256('{"spectrum":{"detector":"peak","fmax_hz":' || CASE WHEN fmax_hz = floor(fmax_hz) THEN fmax_hz::BIGINT::VARCHAR ELSE fmax_hz::DOUBLE::VARCHAR END || ',"fmin_hz":0,"grid_kind":"hz_uniform","lines":' || n_lines || ',"power":false,"signal_family":"velocity"}}'), 1, 16) AS definition_id,
count(DISTINCT point_record_num) AS points, count(*) AS captures FROM spectra WHERE isfinite(fmax_hz) AND n_lines IS NOT NULL GROUP BY fmax_hz, n_lines""")
def mode_definitions(spark, d):
    from tremor.operators.export_rows import spectrum_definition

    s = table(spark, d, "spectra").where("fmax_hz is not null and not isnan(fmax_hz) and abs(fmax_hz) < float('inf') and n_lines is not null")
    shapes = s.groupBy("fmax_hz", "n_lines").agg(F.count_distinct("point_record_num").alias("points"), F.count("*").alias("captures"))
    return shapes.select(spectrum_definition(F.lit("velocity"), F.col("fmax_hz"), F.col("n_lines")).alias("definition_id"), "points", "captures")


@query("SELECT event_id, substr(sha1(user_id || ':' || event_id || ':' || event_type), 1, 16) AS sample_id FROM events")
def sample_ids(spark, d):
    key = F.concat_ws(":", F.col("user_id").cast("string"), F.col("event_id").cast("string"), "event_type")
    return table(spark, d, "events").select("event_id", F.substring(F.sha1(key), 1, 16).alias("sample_id"))


# DuckDB's patterns have no look-behind, so a letter before a dash that opens a new clause is kept by doubling the dash
@query("""SELECT document_id, observation_id, trim(c, ' -–·' || chr(9) || '/') AS clause FROM (SELECT DISTINCT document_id, observation_id,
unnest(regexp_split_to_array(regexp_replace(diagnosis_text, '([\\pL\\d_)])(\\s*)-([A-ZÁÉÍÓÚÑ])', '\\1;\\3', 'g'), '[.;\\n]+|\\s+-\\s+')) AS c
FROM observations_consolidated) WHERE trim(c, ' -–·' || chr(9) || '/') <> ''""")
def clauses_explode(spark, d):
    o = _observations(spark, d).select("document_id", "observation_id", "diagnosis_text").distinct()
    return o.select("document_id", "observation_id", F.explode(findings.clauses(F.col("diagnosis_text"))).alias("clause")).distinct()


@query()
def map_findings(spark, d):
    return findings.map_findings(_observations(spark, d), ["document_id", "observation_id"], "diagnosis_text")


@query("""SELECT document_id, observation_id, CASE WHEN contains(l, 'bueno') THEN 'OK' WHEN contains(l, 'seguimiento') OR contains(l, 'vigilar') THEN 'WATCH' WHEN contains(l, 'alerta') THEN 'ALERT'
WHEN contains(l, 'peligro') THEN 'DANGER' WHEN contains(l, 'parada') THEN 'STOPPED' WHEN contains(l, 'no medida') THEN 'NOT_MEASURED' WHEN contains(l, 'fuera de servicio') THEN 'OUT_OF_SERVICE' ELSE 'UNKNOWN' END AS mapped,
CASE WHEN contains(l, 'bueno') THEN 0 WHEN contains(l, 'seguimiento') OR contains(l, 'vigilar') THEN 1 WHEN contains(l, 'alerta') THEN 2 WHEN contains(l, 'peligro') THEN 3 END::INT AS mapped_alarm
FROM (SELECT document_id, observation_id, lower(trim(status_source_label)) AS l FROM observations_consolidated)""")
def status_ladder(spark, d):
    status, alarm = findings.map_status(F.col("status_source_label"))
    return _observations(spark, d).select("document_id", "observation_id", status.alias("mapped"), alarm.alias("mapped_alarm"))


@query()
def status_from_texts(spark, d):
    return findings.status_of_texts(_observations(spark, d), ["document_id", "observation_id"], "diagnosis_text")


@query()
def text_census(spark, d):
    """Evidence in the texts of reports and of alarm notes."""
    reports = findings.census(_observations(spark, d), ["document_id", "observation_id"], ["diagnosis_text", "analysis_text", "recommendation_text"])
    notes = table(spark, d, "alarm_notes").select(F.lit("notes").alias("document_id"), F.col("note_id").cast("string").alias("observation_id"), "note_text")
    return reports.unionByName(findings.census(notes, ["document_id", "observation_id"], ["note_text"]))


@query()
def unmapped_audit(spark, d):
    return findings.unmapped_audit(_observations(spark, d), "diagnosis_text")


@query("""SELECT note_id, CASE upper(band) WHEN 'DESEQUILIBRIO' THEN 'GT050' WHEN 'DESALINEACION' THEN 'GT051' WHEN 'HOLGURAS' THEN 'GT052' WHEN 'FALLO ELECTRIC' THEN 'GT053' END AS mapping_rule,
CASE upper(band) WHEN 'DESEQUILIBRIO' THEN 'IMBALANCE' WHEN 'DESALINEACION' THEN 'MISALIGNMENT' WHEN 'HOLGURAS' THEN 'LOOSENESS' WHEN 'FALLO ELECTRIC' THEN 'ELECTRICAL' ELSE 'UNMAPPED' END AS fault_group FROM alarm_notes""")
def band_alarm_findings(spark, d):
    return table(spark, d, "alarm_notes").select("note_id", findings.band_finding(F.col("band")).alias("f")).select("note_id", "f.mapping_rule", "f.fault_group")


@query("""SELECT p_partkey, coalesce(nullif(substr(trim(regexp_replace(strip_accents(p_name), '[^A-Za-z0-9]+', '_', 'g'), '_'), 1, 64), ''), 'unnamed') AS code FROM part""")
def name_sanitize(spark, d):
    return table(spark, d, "part").select("p_partkey", names.file_names("p_name").alias("code"))


@query()
def name_collisions(spark, d):
    p = table(spark, d, "points").select("normalized_tag", "record_num", "long_name")
    return names.distinct_names(p, ["normalized_tag"], ["record_num"], "long_name", "code")


@query("SELECT record_num, trim(regexp_replace(lower(short_code), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM points")
def slugs(spark, d):
    return table(spark, d, "points").select("record_num", names.slug(F.col("short_code")).alias("slug"))


@query("""SELECT cell_id, source_ref, last_value(area IGNORE NULLS) OVER (PARTITION BY source_ref ORDER BY source_page, cell_id ROWS UNBOUNDED PRECEDING) AS area_carried FROM matrix_cells""")
def carry_forward_sections(spark, d):
    return ordered.carried_forward(table(spark, d, "matrix_cells"), ["source_ref"], ["source_page", "cell_id"], "area", "area_carried").select("cell_id", "source_ref", "area_carried")


@query("""SELECT lang, doc_type, doc_id, length(text) AS n FROM documents WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY lang, doc_type ORDER BY length(text) DESC, doc_id) = 1""")
def longest_per_key(spark, d):
    x = ordered.longest_per_key(table(spark, d, "documents").select("lang", "doc_type", "doc_id", "text"), ["lang", "doc_type"], "text", [F.col("doc_id")])
    return x.select("lang", "doc_type", "doc_id", F.length("text").cast("long").alias("n"))


@query("""SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 5""")
def first_n_per_point(spark, d):
    return ordered.best_per_key(table(spark, d, "events"), ["user_id"], [F.col("ts"), F.col("event_id")], 5).select("user_id", "event_id", "value")


_TAGS = "regexp_replace(upper(normalized_tag), '[^A-Z0-9]', '', 'g')"


@query(f"""WITH a AS (SELECT DISTINCT normalized_tag AS tag FROM crosswalk), b AS (SELECT DISTINCT {_TAGS} AS tag FROM observations_consolidated)
SELECT 'both' AS part, tag FROM (SELECT tag FROM a INTERSECT SELECT tag FROM b) UNION ALL SELECT 'list_only', tag FROM (SELECT tag FROM a EXCEPT SELECT tag FROM b)
UNION ALL SELECT 'reports_only', tag FROM (SELECT tag FROM b EXCEPT SELECT tag FROM a)""")
def set_algebra(spark, d):
    a = table(spark, d, "crosswalk").select(F.col("normalized_tag").alias("tag")).distinct()
    b = _observations(spark, d).select(history.normalise_tag(F.col("normalized_tag")).alias("tag")).distinct()
    part = lambda df, p: df.select(F.lit(p).alias("part"), "tag")
    return part(a.intersect(b), "both").unionByName(part(a.subtract(b), "list_only")).unionByName(part(b.subtract(a), "reports_only"))


# the filters: the first area's whole name, and the last word of the last area
@query("""WITH f AS (SELECT min(lower(area_name)) AS whole, regexp_extract(max(lower(area_name)), '[^ ]+$') AS word FROM crosswalk)
SELECT normalized_tag, lower(area_name) = whole AS exact, contains(lower(area_name), word) AS part FROM crosswalk, f WHERE lower(area_name) = whole OR contains(lower(area_name), word)""")
def area_filters(spark, d):
    c = table(spark, d, "crosswalk").select("normalized_tag", F.lower("area_name").alias("low"))
    wanted = c.agg(F.min("low").alias("whole"), F.regexp_extract(F.max("low"), "[^ ]+$", 0).alias("word"))
    exact, part = F.col("low") == F.col("whole"), F.contains("low", F.col("word"))
    return c.crossJoin(F.broadcast(wanted)).where(exact | part).select("normalized_tag", exact.alias("exact"), part.alias("part"))  # one row


@query("""WITH a AS (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) - 1 AS o FROM nation), b AS (SELECT r_name, row_number() OVER (ORDER BY r_regionkey) - 1 AS o FROM region)
SELECT a.o AS ordinal, n_name, r_name FROM a LEFT JOIN b ON a.o = b.o""")
def positional_pairing(spark, d):
    z = ordered.zipped(table(spark, d, "nation").select("n_nationkey", "n_name"), table(spark, d, "region").select("r_regionkey", "r_name"), ["n_nationkey"], ["r_regionkey"])
    return z.select(F.col("ordinal").cast("long").alias("ordinal"), "n_name", "r_name")


@query("""SELECT first_value(node) OVER w AS head, node, (row_number() OVER w - 1)::INT AS hop FROM (SELECT o_custkey, o_orderkey AS node FROM orders)
WINDOW w AS (PARTITION BY o_custkey ORDER BY node)""")
def pointer_chain(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    edges = ordered.valid_until(o, ["o_custkey"], "o_orderkey", "nxt").select(F.col("o_orderkey").alias("node"), "nxt")
    # no chain here is longer than the table; the cap of broken chains would cut a hot customer's
    return chains.follow(o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("head")), edges, o.count())


@query("""SELECT normalized_tag, observed_at, list_sort(list(DISTINCT status)) AS values FROM observations_consolidated WHERE status IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT status) > 1""")
def status_disagreements(spark, d):
    return ordered.disagreements(_observations(spark, d), ["normalized_tag", "observed_at"], "status")


@query("SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events")
def json_context(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


@query("""SELECT observation_id, document_id, CASE WHEN regexp_matches(observed_at, '^\\d{2}[/-]\\d{2}[/-]\\d{4}$') THEN substr(observed_at, 7, 4) || '-' || substr(observed_at, 4, 2) || '-' || substr(observed_at, 1, 2) END AS iso
FROM observations_consolidated""")
def iso_dates(spark, d):
    typed = F.when(F.col("observed_at").rlike(r"^\d{2}[/-]\d{2}[/-]\d{4}$"), F.date_format(history.parse_date(F.col("observed_at")), "yyyy-MM-dd"))
    return _observations(spark, d).select("observation_id", "document_id", typed.alias("iso"))


@query("""SELECT lang, min(p) AS least, max(p) AS most, count(*) AS n FROM (SELECT lang, length(text) AS p FROM documents WHERE text IS NOT NULL) GROUP BY 1""")
def text_spans(spark, d):
    return table(spark, d, "documents").where("text is not null").groupBy("lang").agg(
        F.min(F.length("text")).cast("long").alias("least"), F.max(F.length("text")).cast("long").alias("most"), F.count("*").alias("n")
    )


@query("""SELECT point_record_num, epoch_us(timestamp_utc) AS t, 'load' AS metric_id, carga_pct::DOUBLE AS value FROM spectra WHERE carga_pct IS NOT NULL GROUP BY ALL
UNION ALL SELECT point_record_num, epoch_us(timestamp_utc), 'speed', rpm::DOUBLE / 60.0 FROM spectra WHERE rpm > 0 GROUP BY ALL""")
def capture_context(spark, d):
    return signals.capture_context(table(spark, d, "spectra"), F.unix_micros("timestamp_utc"), F.col("rpm"), F.col("carga_pct"), ["point_record_num"])


@query("""SELECT normalized_tag AS machine_id, record_num, long_name, short_code, nominal_speed_rpm FROM points WHERE normalized_tag IS NOT NULL""")
def partition_roundtrip(spark, d):
    """Points written by machine as partition folders and read back, the machine as text."""
    p = table(spark, d, "points").where("normalized_tag is not null").select(F.col("normalized_tag").alias("machine"), "record_num", "long_name", "short_code", "nominal_speed_rpm")
    folder = shared_folder(spark, "points")
    p.repartition("machine").write.partitionBy("machine").option("compression", "zstd").parquet(folder)
    kept = spark.read.schema("record_num bigint, long_name string, short_code string, nominal_speed_rpm double, machine string").parquet(folder)
    return kept.withColumnRenamed("machine", "machine_id")


@query(f"""WITH w AS (SELECT *, row_number() OVER (PARTITION BY origin, normalized_tag, observed_at, modality ORDER BY coalesce(record_kind = 'primary', false) DESC,
coalesce(inspection_date, '') DESC, document_id DESC NULLS LAST, observation_id DESC NULLS LAST) AS r FROM observations_consolidated),
c AS (SELECT document_id, observation_id, origin, normalized_tag, modality, observed_at, lead(observed_at) OVER (PARTITION BY origin, normalized_tag, modality ORDER BY observed_at) AS until FROM w WHERE r = 1)
SELECT 'observations' AS tbl, origin, count(*) AS n, count(DISTINCT document_id) AS documents, 0::BIGINT AS open FROM observations_consolidated GROUP BY ALL
UNION ALL SELECT 'consolidated', origin, count(*), count(DISTINCT document_id), count(*) FILTER (until IS NULL) FROM c GROUP BY ALL""")
def materialised_tables(spark, d):
    """The observations and their consolidated view written as tables with the contract's columns, and counted as read back."""
    folder = shared_folder(spark, "truth")
    whole = _observations(spark, d)
    for name, df, schema in (("observations", whole, ground_truth.OBSERVATIONS), ("consolidated", ground_truth.consolidated(whole.drop("valid_to")), ground_truth.CONSOLIDATED)):
        ground_truth.conforming(df, schema).write.option("compression", "zstd").parquet(f"{folder}/{name}")
    read = lambda name, open_: spark.read.parquet(f"{folder}/{name}").groupBy("origin").agg(F.count("*").alias("n"), F.count_distinct("document_id").alias("documents"), open_.alias("open")).withColumn("tbl", F.lit(name))
    both = read("observations", F.sum(F.lit(0)).cast("long")).unionByName(read("consolidated", F.count_if(F.col("valid_to").isNull())))
    return both.select("tbl", "origin", "n", "documents", "open")


@query("""WITH t AS (SELECT normalized_tag, regexp_extract(trim(external_name), '\\b([A-Za-z]{2,4}[-./][A-Za-z0-9][A-Za-z0-9/.\\- ]*)$', 1) AS t FROM crosswalk) SELECT normalized_tag, nullif(trim(t), '') AS plant_tag FROM t""")
def machine_tags(spark, d):
    return table(spark, d, "crosswalk").select("normalized_tag", ground_truth.machine_tag(F.col("external_name")).alias("plant_tag"))


@query("""SELECT point_record_num, substr(sha1(point_record_num || ':' || record_num || ':fft'), 1, 16) AS sample_id, n_lines::BIGINT AS n FROM spectra""")
def sample_index(spark, d):
    s = table(spark, d, "spectra")
    return s.select("point_record_num", documents.sample_id(F.col("point_record_num"), F.col("record_num"), F.lit("fft")).alias("sample_id"), F.col("n_lines").cast("long").alias("n"))


@query("""WITH n AS (SELECT point_record_num, count(*) AS n FROM trend_readings GROUP BY 1), s AS (SELECT point_record_num, count(*) AS n FROM spectra GROUP BY 1),
m AS (SELECT p.normalized_tag, count(*) AS points, sum(coalesce(s.n, 0)) AS fft, sum(coalesce(n.n, 0)) AS trend FROM points p LEFT JOIN n ON n.point_record_num = p.record_num LEFT JOIN s ON s.point_record_num = p.record_num GROUP BY 1)
SELECT count(DISTINCT area_name) AS areas, count(*) AS machines, count(*) FILTER (fft + trend > 0) AS machines_with_data, sum(points)::BIGINT AS points, sum(fft)::BIGINT AS fft, 0::BIGINT AS waveform, sum(trend)::BIGINT AS trend
FROM m LEFT JOIN crosswalk USING (normalized_tag)""")
def database_totals(spark, d):
    count = lambda name, out: table(spark, d, name).groupBy(F.col("point_record_num").alias("record_num")).agg(F.count("*").alias(out))
    p = table(spark, d, "points").select("record_num", "normalized_tag").join(count("spectra", "fft"), "record_num", "left").join(count("trend_readings", "trend"), "record_num", "left").fillna(0, ["fft", "trend"])
    m = p.groupBy("normalized_tag").agg(F.count("*").alias("n_points"), F.sum("fft").alias("fft"), F.sum("trend").alias("trend"))
    named = m.join(table(spark, d, "crosswalk").select("normalized_tag", "area_name"), "normalized_tag", "left").withColumn("waveform", F.lit(0).cast("long"))
    return inventory.database_totals(named.withColumnRenamed("normalized_tag", "machine_id"))


@query("""WITH f AS (SELECT c.normalized_tag, c.area_name FROM crosswalk c WHERE NOT EXISTS (SELECT 1 FROM crosswalk d WHERE d.normalized_tag = c.normalized_tag AND d.dataset_machine_id IS NOT NULL)),
u AS (SELECT DISTINCT area_name FROM observations_consolidated WHERE dataset_machine_id IS NULL AND area_name IS NOT NULL)
SELECT u.area_name, count(f.normalized_tag) AS free FROM u LEFT JOIN f ON replace(regexp_replace(strip_accents(upper(f.area_name)), '[^A-Z0-9]', '', 'g'), 'DE', '') = replace(regexp_replace(strip_accents(upper(u.area_name)), '[^A-Z0-9]', '', 'g'), 'DE', '') GROUP BY 1""")
def same_area_candidates(spark, d):
    free = table(spark, d, "crosswalk").groupBy("normalized_tag", "area_name").agg(F.max("dataset_machine_id").alias("id")).where("id is null")
    keyed = free.select(crosswalk.area_key(F.col("area_name")).alias("k"), "normalized_tag")
    u = _observations(spark, d).where("dataset_machine_id is null and area_name is not null").select("area_name").distinct()
    return u.withColumn("k", crosswalk.area_key(F.col("area_name"))).join(keyed, "k", "left").groupBy("area_name").agg(F.count("normalized_tag").alias("free"))


@query()
def rule_traces(spark, d):
    """Which rules match each clause of the distinct diagnoses, vetoed ones too."""
    texts = _observations(spark, d).select("diagnosis_text").distinct()
    return findings.Rules().trace(texts, ["diagnosis_text"], "diagnosis_text").groupBy("rule", "vetoed").agg(F.count("*").alias("n"))


@query("""SELECT count(*) AS points, count(DISTINCT long_name) AS names, count(*) FILTER (trim(long_name) <> '') AS with_name,
count(*) FILTER (len(list_filter(bearing_designations, lambda b: b IS NOT NULL AND trim(b) <> '')) > 0) AS with_bearings, count(*) FILTER (nominal_speed_rpm > 0) AS with_speed FROM points""")
def point_metadata(spark, d):
    return inventory.metadata_summary(table(spark, d, "points"), "long_name", "bearing_designations", "nominal_speed_rpm")


@query(f"""SELECT 'observations' AS tbl, document_id, count(*) AS n FROM observations_consolidated GROUP BY ALL
UNION ALL SELECT 'consolidated', document_id, count(*) FROM ({_WINNERS}) GROUP BY ALL""")
def document_counts(spark, d):
    tables = {"observations": _observations(spark, d), "consolidated": _winners(spark, d)}
    return ground_truth.row_counts(tables).select(F.col("table").alias("tbl"), "document_id", F.col("rows").alias("n"))
