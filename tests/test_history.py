from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tremor.operators import history

COLUMNS = (
    "origin string, normalized_tag string, modality string, observed_at string, inspection_date string, record_kind string, status string, area_code string, rpm1 float, "
    "document_id string, observation_id string"
)


def table(spark, data):
    return spark.createDataFrame([("o", t, "v", d, i, k, s, a, r, doc, "x") for t, d, i, k, s, a, r, doc in data], COLUMNS)


def versions(spark, data):
    h = history.machine_history(table(spark, data))
    return [(r["normalized_tag"], str(r["valid_from"]), str(r["valid_to"]), r["status"], r["area_code"], r["rpm1"]) for r in h.orderBy("normalized_tag", "valid_from").collect()]


def test_date_forms(spark):
    typed = ["2024-01-31", "2024-01-31T00:00:00Z", "2024-01-31 10:00:00", "31/01/2024", "31-01-2024", "20240131", "1/2/2024", "2024-13-01", "", None, "soon"]
    got = [r[0] and str(r[0]) for r in spark.createDataFrame([(x,) for x in typed], "x string").select(history.parse_date(F.col("x"))).collect()]
    assert got == ["2024-01-31"] * 6 + ["2024-02-01"] + [None] * 4


def test_precedence_and_versions(spark):
    data = [
        ("a-1", "2024-01-01", "2024-01-01", "primary", "OK", "A", 1000.0, "d1"),
        ("A1", "2024-01-01", "2024-09-01", "retrospective", "ALERT", "Z", 1.0, "d9"),  # the primary holds
        ("A1", "01/02/2024", "2024-03-01", "retrospective", " alert ", None, None, "d2"),
        ("A1", "2024-02-01", "2024-02-15", "retrospective", "OK", "A", 1000.0, "d3"),  # an earlier inspection
        ("A1", "2024-03-01", "2024-03-01", "primary", "ALERT", "A", None, "d4"),  # nothing new
        ("A1", "2024-04-01", "2024-04-01", "primary", "ALERT", "B", 1000.0, "d5"),
        ("A1", "2024-04-01", "2024-04-01", "primary", "ALERT", "B", 1000.0, "d5"),  # repeated
    ]
    assert versions(spark, data) == [
        ("A1", "2024-01-01", "2024-02-01", "OK", "A", 1000.0),
        ("A1", "2024-02-01", "2024-04-01", "ALERT", "A", 1000.0),
        ("A1", "2024-04-01", "None", "ALERT", "B", 1000.0),
    ]


def test_leading_nulls_are_no_change(spark):
    data = [("A1", "2024-01-01", "2024-01-01", "primary", "OK", None, None, "d1"), ("A1", "2024-02-01", "2024-02-01", "primary", "OK", "A", 5.0, "d2")]
    assert versions(spark, data) == [("A1", "2024-01-01", "None", "OK", "A", 5.0)]


def test_degenerate(spark):
    assert versions(spark, []) == []
    assert versions(spark, [(None, "2024-01-01", "x", "primary", "OK", "A", 1.0, "d"), ("--", "2024-01-01", None, None, "OK", None, None, None)]) == []
    assert versions(spark, [("A1", "never", None, None, "OK", None, float("nan"), None), ("A1", "2024-01-01", None, None, "OK", None, float("nan"), None)]) == [("A1", "2024-01-01", "None", "OK", None, None)]


def test_extra_columns(spark):
    t = table(spark, [("A1", "2024-01-01", "2024-01-01", "primary", "OK", "A", 1.0, "d")]).withColumn("value", F.lit(1)).withColumn("attribute", F.lit("q")).withColumn("best", F.lit(2))
    assert history.machine_history(t).count() == 1


def brute(data):
    """Versions by a plain walk over dates."""
    held = {}
    for day, status, area in data:
        held[day] = (status, area)
    days = sorted(held)
    area = next((held[d][1] for d in days if held[d][1]), None)
    out, before = [], None
    for d in days:
        area = held[d][1] or area
        if (held[d][0], area) != before:
            out.append(d)
            before = (held[d][0], area)
    return out


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 28), st.sampled_from(["OK", "ALERT"]), st.sampled_from(["A", "B", None])), min_size=1, max_size=12, unique_by=lambda x: x[0]))
def test_against_brute_force(spark, data):
    got = versions(spark, [("A1", f"2024-01-{d:02d}", "2024-02-01", "primary", s, a, None, "d") for d, s, a in data])
    assert [int(v[1][-2:]) for v in got] == brute(data)


def test_one_hot_series(spark):
    """A series with most of the rows reaches the windows as one row per date."""
    t = spark.range(20000).select(
        F.lit("o").alias("origin"), F.lit("HOT1").alias("normalized_tag"), F.lit("v").alias("modality"), F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0")).alias("observed_at"),
        F.lit("2024-02-01").alias("inspection_date"), F.lit("primary").alias("record_kind"), F.lit("OK").alias("status"), F.lit("A").alias("area_code"), F.lit(1.0).alias("rpm1"), F.lit("d").alias("document_id"),
        F.col("id").cast("string").alias("observation_id"),
    )
    assert history.machine_history(t).count() == 1
    assert rows(history.machine_history(t).select("status")) == [("OK",)]
