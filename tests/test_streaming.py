from pyspark.sql import functions as F

from tremor.streaming import monitor

SCHEMA = "id long, point string, at timestamp, value double"


def run(stream, spark, name, mode="append"):
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).start()
    try:
        q.processAllAvailable()
        return spark.table(name).collect()
    finally:
        q.stop()


def test_stream(spark, tmp_path):
    at = lambda m: f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00"
    data = [(1, "p", at(0), 1.0), (2, "p", at(10), 5.0), (2, "p", at(10), 5.0), (3, "p", at(300), 2.0), (4, "q", at(1000), 9.0)]
    df = spark.createDataFrame(data, "id long, point string, at string, value double").withColumn("at", F.to_timestamp("at"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    events = monitor.read_events(spark, str(tmp_path / "in"), SCHEMA)
    limits = spark.createDataFrame([("p", 4.0, 8.0)], "point string, alert double, danger double")
    got = {(r["id"], r["alarm"]) for r in run(monitor.levelled(events, limits, "point", "value"), spark, "levels")}
    assert got == {(1, 0), (2, 2), (3, 0), (4, None)}
    assert len(run(monitor.first_deliveries(events, "at", ["id", "at"]), spark, "firsts")) == 4
    w = {(r["point"], r["n"], r["most"]) for r in run(monitor.windowed(events, "at", ["point"], "value"), spark, "windows", "complete")}
    assert w == {("p", 4, 5.0), ("q", 1, 9.0)}
    assert sorted(r["n"] for r in run(monitor.sessions(events, "at", "point"), spark, "sessions", "complete")) == [1, 1, 3]
