import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tremor.functions import names
from tremor.operators import alarms, chains, crosswalk, findings, inventory, ordered, signals


def judged(spark, text, **more):
    df = spark.createDataFrame([(text,)], "t string")
    return [tuple(r) for r in findings.map_findings(df, [], "t", **more).orderBy("finding_index").select("fault_group", "mapping_rule", "weight").collect()]


def test_findings_share_the_mass(spark):
    assert judged(spark, "-Desequilibrio del ventilador. -Debilidad estructural.") == [("IMBALANCE", "GT001v2", 0.5), ("STRUCTURE", "GT005", 0.5)]
    for nothing in ("Máquina parada", None, "ALERTA", "", " . ; "):
        assert judged(spark, nothing) == []
    three = judged(spark, "Desequilibrio. Algo raro. Otra cosa rara")
    assert three == [("IMBALANCE", "GT001v2", 0.333333), ("UNMAPPED", None, 0.666667)]
    assert judged(spark, "Se aprecia buen estado de lubricación de los rodamientos") == []
    assert [r[1] for r in judged(spark, "Excentricidad en polea")] == ["GT025"]
    thirds = judged(spark, "Desequilibrio. Holgura y resonancia. Cavitación")
    assert sum(round(r[2] * 1e6) for r in thirds) == 1_000_000 and [r[2] for r in thirds] == [0.333333, 0.166667, 0.166667, 0.333333]


def exact_weights(masses):
    """Millionths by largest remainder, in whole numbers."""
    floors = [m.numerator * 10**6 // m.denominator for m in masses]
    order = sorted(range(len(masses)), key=lambda i: (floors[i] - m if (m := masses[i] * 10**6) else 0, i))
    for i in order[: 10**6 - sum(floors)]:
        floors[i] += 1
    return [f / 10**6 for f in floors]


def test_weights_against_fractions(spark):
    from fractions import Fraction

    names_ = {"Desequilibrio": 0, "Resonancia": 1, "Cavitación": 2, "Correa": 3, "Rareza": 4}
    texts = [["Correa", "Resonancia", "Correa"], ["Rareza"] * 3 + ["Cavitación"] * 4, ["Desequilibrio", "Resonancia", "Cavitación", "Correa", "Rareza", "Rareza", "Correa"], ["Correa"] * 11 + ["Resonancia"] * 2]
    df = spark.createDataFrame([(i, ". ".join(t)) for i, t in enumerate(texts)], "i int, t string")
    got = findings.map_findings(df, ["i"], "t").orderBy("i", "finding_index").collect()
    for i, t in enumerate(texts):
        masses = [Fraction(t.count(n), len(t)) for n in names_ if n in t]
        assert [r["weight"] for r in got if r["i"] == i] == exact_weights(masses)


def test_status(spark):
    df = spark.createDataFrame([(1, "Rodamientos en buen estado. Máquina parada."), (2, "Rodamientos en buen estado. Desequilibrio."), (3, ""), (4, None), (5, "Máquina en buen estado")], "i int, t string")
    status, alarm = findings.text_status(F.col("t"))
    assert [tuple(r) for r in df.select(status, alarm).collect()] == [("STOPPED", None), (None, None), (None, None), (None, None), ("OK", 0)]
    one = spark.createDataFrame([("-Falta de rigidez -Rodamientos. ;  ",)], "t string")
    assert one.select(findings.clauses(F.col("t"))).first()[0] == ["Falta de rigidez", "Rodamientos"]


def test_audit_classes(spark):
    df = spark.createDataFrame([(c,) for c in ("Revisar todo", "holgura", "estable en el tiempo", "qué es esto", "Informar a Ana", "Informar a nadie")], "c string")
    read = df.select(findings.Rules().read(F.col("c")).alias("r"))
    plain = ["administrative_request", None, "healthy_or_stable", "insufficient_context", "insufficient_context", "insufficient_context"]
    assert [r[0] for r in read.select(findings.audit_class(F.col("r"))).collect()] == plain
    assert [r[0] for r in read.select(findings.audit_class(F.col("r"), ["Ana"])).collect()] == [*plain[:4], "administrative_request", "insufficient_context"]
    assert rows(findings.unmapped_audit(df, "c").select("cls", "clauses")) == [("administrative_request", 1), ("insufficient_context", 3)]


def test_rule_trace(spark):
    df = spark.createDataFrame([(1, "Buena lubricación. Excentricidad en polea"), (2, None)], "i int, t string")
    got = rows(findings.Rules().trace(df, ["i"], "t").select("place", "rule", "matched", "vetoed"))
    assert got == [(0, "GT011v2", "lubricaci", True), (1, "GT021v2", "excentricidad", True), (1, "GT025", "excentricidad en polea", False)]


def test_map_findings(spark):
    df = spark.createDataFrame([(1, "Holgura. Cavitación"), (2, None), (3, "Holgura. Cavitación"), (4, "")], "id long, t string")
    assert rows(findings.map_findings(df, ["id"], "t").select("id", "mapping_rule", "weight")) == [(1, "GT004v2", 0.5), (1, "GT015", 0.5), (3, "GT004v2", 0.5), (3, "GT015", 0.5)]
    assert findings.map_findings(df.limit(0), ["id"], "t").count() == 0


def test_census(spark):
    df = spark.createDataFrame([(1, "Niveles de 3,5 mm/s y 20 Hz tras la intervención", None)], "id long, a string, b string")
    assert rows(findings.census(df, ["id"], ["a", "b"]).select("field", "category", "occurrences")) == [("a", "intervention_candidate", 1), ("a", "numeric_measure", 2)]


@pytest.mark.parametrize(
    ("name", "location", "direction", "component", "acquisition"),
    [("MOTOR LA HORIZONTAL", "DE", "H", "motor", None), ("Bomba Lado Libre Vert (HF)", "NDE", "V", "pump", "high_frequency"), ("Reductor LOA LA axial", None, "A", "gearbox", None), ("", None, None, None, None), ("VENTILADOR LCA PEAKVUE", "NDE", None, "fan", "peakvue")],
)
def test_point_names(spark, name, location, direction, component, acquisition):
    e = names.evidence(spark.createDataFrame([(name,)], "n string"), [], "n").first()
    assert (e["location"], e["direction"], e["component"], e["acquisition"]) == (location, direction, component, acquisition)


def test_point_name_trace_and_base(spark):
    df = spark.createDataFrame([("Bómba L.O. LA Horiz. PEAKVUE 500 Hz (HF)",), (None,), ("MOTOR LADO LIBRE",)], "n string")
    got = names.evidence(df, [], "n").collect()
    assert [g["base"] for g in got] == ["bomba l o", "", "motor"]
    assert ("location", "DE", "la") in {tuple(t) for t in got[0]["trace"]} and got[0]["acquisition_status"] == "ambiguous" and got[1]["trace"] == []


def test_names(spark):
    assert [names.file_name(x) for x in ("EXTRACCIÓN / 2", "", None, "é" * 100, "__a--b__")] == ["EXTRACCION_2", "unnamed", "unnamed", "e" * 64, "a_b"]
    df = spark.createDataFrame([(1, 1, "A"), (1, 2, "A"), (1, 3, "A_1"), (2, 1, "A")], "g long, o long, n string")
    assert rows(names.distinct_names(df, ["g"], ["o"], "n", "code").select("g", "o", "code")) == [(1, 1, "A"), (1, 2, "A_1"), (1, 3, "A_1_1"), (2, 1, "A")]
    assert names.hex_dump(b"AB\0").endswith("AB.")


def test_siblings(spark):
    df = spark.createDataFrame([("m", "MOTOR LA"), ("m", "MOTOR LA HORIZONTAL"), ("n", "BOMBA LA"), ("n", "BOMBA LA HORIZ"), ("n", "BOMBA LA VERT")], "g string, name string")
    e = names.evidence(df, ["g"], "name")
    assert rows(names.sibling_directions(e, ["g"], "name").select("g", "name", "proposed")) == [("m", "MOTOR LA", "H")]


def test_folding(spark):
    df = spark.createDataFrame([("ñú-ő ①ﬁ 7",), ("Area de Carga",), (None,)], "t string")
    assert [r[0] for r in df.select(crosswalk.plain(F.col("t"))).collect()] == ["NUO1FI7", "AREADECARGA", None]
    assert [r[0] for r in df.select(crosswalk.area_key(F.col("t"))).collect()] == ["NUO1FI7", "AREACARGA", ""]


def test_crosswalk(spark):
    tags = spark.createDataFrame([("AG100",), ("P7",), ("XY9",), ("AG10",), ("Q1",)], "tag string")
    ids = spark.createDataFrame([("MEZCLADOR_AG_100",), ("P7_BOMBA",), ("ZXY9Z",), ("P7_OTRA",)], "machine_id string")
    got = {r["tag"]: (r["tier"], r["machine_id"], r["resolution"]) for r in crosswalk.resolve(tags, ids).collect()}
    assert got["AG100"] == ("exact_suffix", "MEZCLADOR_AG_100", "matched") and got["P7"][2] == "ambiguous"
    assert got["XY9"] == ("substring", "ZXY9Z", "matched") and got["AG10"] == ("substring", None, "reverse_collision") and got["Q1"][2] == "unmatched"


def test_alarm_levels(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 2.0, 3.0), (3.0, 2.0, 3.0), (5.0, None, None), (None, 1.0, 2.0), (2.5, None, 3.0)], "v double, a double, d double")
    assert [r[0] for r in df.select(alarms.alarm_level(F.col("v"), F.col("a"), F.col("d"))).collect()] == [0, 2, 3, None, None, 0]


def test_notes(spark):
    df = spark.createDataFrame([(1, "1 - 20 KHz - 11.278 G-s -  D Alarm"), (2, "x\r\nOVERALL VALUE - 3.1 mm/Seg -  C Alarm "), (3, "nothing"), (4, None)], "id long, note_text string")
    got = rows(alarms.parse_note(df).select("id", "note_band", "note_value", "note_unit", "note_level"))
    assert got == [(1, "1 - 20 KHz", 11.278, "G's", "D"), (2, "OVERALL VALUE", 3.1, "mm/s", "C"), (3, None, None, None, None), (4, None, None, None, None)]


def test_signals(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0], 2), ([1.0], [2.0], 5)], "a array<float>, b array<float>, n int")
    assert [r[0] for r in df.select(signals.assembled(F.col("a"), F.col("b"), F.col("n"))).collect()] == [[1.0, 2.0], [1.0, 2.0]]
    w = spark.createDataFrame([([1, 2, 0], 2), ([1, 2, 3], 2), ([1], 2), ([1, 2], 2)], "s array<int>, n int")
    assert [r[0] for r in w.select(signals.wave_state(F.col("s"), F.col("n"))).collect()] == ["ok", "padding", "short", "ok"]
    b = spark.createDataFrame([([3.0, 4.0, 100.0, 0.0], 4.0)], "x array<float>, f double")
    assert b.select(signals.band_value(F.col("x"), F.col("f"), F.lit(0.0), F.lit(2.0))).first()[0] == 5.0


def test_ordered(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "a"), (1, 3, "b"), (1, 4, None), (1, 5, "c")], "k long, o long, v string")
    valid = F.col("v").isNotNull()
    assert rows(ordered.skip_then_take(df, ["k"], "o", valid).select("o")) == [(2,), (3,)]
    assert ordered.take_while(df, ["k"], ["o"], valid).count() == 0
    assert rows(ordered.carried_forward(df, ["k"], ["o"], "v", "c").select("o", "c")) == [(1, None), (2, "a"), (3, "b"), (4, "b"), (5, "c")]
    assert rows(ordered.longest_per_key(df, ["k"], "v", [F.col("o")]).select("o")) == [(2,)]


def test_shifted_dates_over_blocks(spark):
    df = spark.createDataFrame([(1, 1, 10), (1, 2, None), (1, 5, 30), (1, 12, 40), (1, 31, 50), (None, 3, 7), (None, 14, 8)], "k long, o long, v long")
    got = ordered.shifted_dates(df, ["k"], "o", "v", F.lit(-1).cast("long"), "d", F.floor(F.col("o") / 10))
    assert rows(got.select("k", "o", "d")) == [(1, 1, -1), (1, 12, 30), (1, 2, 10), (1, 31, 40), (1, 5, -1), (None, 14, 7), (None, 3, -1)]


def test_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(40, None), (50, 51), (51, 50), (60, 99)], "node long, nxt long")
    heads = spark.createDataFrame([(1,), (30,), (50,), (60,)], "head long")
    nodes = edges.select("node")
    walked = chains.follow(heads, edges, 64)
    broken = {(r["head"], r["fault"]) for r in chains.faults(walked, edges, nodes, 64).collect()}
    assert (50, "cycle") in broken and (60, "missing") in broken and len({h for h, _ in broken}) == 2
    sound = chains.sound(walked, chains.faults(walked, edges, nodes, 64))
    assert sound.where("head = 1").count() == 40 and {(r["node"], r["hop"]) for r in sound.where("head = 30").collect()} == {(30 + i, i) for i in range(11)}


def test_debug_walk(spark):
    rec = lambda n: bytearray(b"..") + n.to_bytes(4, "little")
    df = spark.createDataFrame([(1, rec(2)), (2, rec(3)), (3, rec(1)), (4, rec(0)), (5, rec(99))], "record_num long, rec binary")
    assert chains.debug_walk(df, 1, 2) == [(1, 2, None), (2, 3, None), (3, 1, None), (1, None, "cycle")]
    assert chains.debug_walk(df, 1, 2, 2) == [(1, 2, None), (2, 3, "max steps")]
    assert chains.debug_walk(df, 4, 2) == [(4, 0, "end")] and chains.debug_walk(df, 5, 2)[-1] == (99, None, "out of range")


def test_inventory(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (2, "b", None), (2, "b", None)], "k long, p string, q string")
    assert rows(inventory.conflicts(df, ["k"], ["p", "q"])) == [(1, ["q"])]
    assert {(r["p"], r["n"], r["pct"]) for r in inventory.histogram(df, "p").collect()} == {("a", 2, 50.0), ("b", 2, 50.0)}


def test_pointer_chain_of_a_hot_customer(spark, tmp_path):
    from tremor.plans.domain import pointer_chain

    orders = spark.range(1, 5001).selectExpr("CASE WHEN id % 10 = 0 THEN id ELSE 0 END AS o_custkey", "id AS o_orderkey")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    got = pointer_chain(spark, str(tmp_path))
    assert got.count() == 5000 and got.agg({"hop": "max"}).first()[0] == 4499
