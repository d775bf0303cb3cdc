import pytest

from tests.conftest import rows
from tremor.llm import mapping
from tremor.llm.mapping import CodeResolver, NameResolver, one_slip, shortens

PARTS = ["MOTOR PRINCIPAL", "TURBINA", "RODETE VENTILADOR", "RODILLO PRENSOR", "REDUCTOR EJE RAPIDO", "REDUCTOR EJE LENTO"]
WAYS = ["HORIZONTAL", "VERTICAL", "AXIAL", "ALTA FRECUENCIA"]
NAMES = [(i, n) for i, n in enumerate((f"{p} LADO {s} {w}" for p in PARTS for s in ("LIBRE", "ACOPLE") for w in WAYS), start=1) if n != "TURBINA LADO LIBRE AXIAL"]
CODES = [(100, "6204"), (101, "NU 2312"), (102, "30308"), (103, "QJ 310"), (104, "NUP 404")]


@pytest.fixture(scope="module")
def names():
    r = NameResolver(NAMES, mapping.POINT_WORDS, mapping.POINT_PHRASES, mapping.POINT_NOISE)
    by = {ref: n for ref, n in NAMES}
    return lambda text: by.get(r.resolve(text), 0)


@pytest.mark.parametrize(
    ("typed", "meant"),
    [("Motor principal lado libre horizontal", "MOTOR PRINCIPAL LADO LIBRE HORIZONTAL"), ("MOT PPAL-L/ACOP-[HF]", "MOTOR PRINCIPAL LADO ACOPLE ALTA FRECUENCIA"), ("llib turb vtcal", "TURBINA LADO LIBRE VERTICAL"),
     ("rod. ventil laco ax", "RODETE VENTILADOR LADO ACOPLE AXIAL"), ("Rod prens lado acopl. Hztal *", "RODILLO PRENSOR LADO ACOPLE HORIZONTAL"), ("Red. e. rápido l/lib vret 2", "REDUCTOR EJE RAPIDO LADO LIBRE VERTICAL"),
     ("moror pral l libre horizonatl", "MOTOR PRINCIPAL LADO LIBRE HORIZONTAL"), ("TURB LADO LIBRE AXIAL", 0), ("motor principal lado libre", 0), ("TURBINA VERT/HORIZ", 0), ("Tolva superior horiz", 0),
     ("reductor lado libre axial", 0), ("???", 0), ("motor principal lado libre horizontal " * 2000, "MOTOR PRINCIPAL LADO LIBRE HORIZONTAL")],
)
def test_names(names, typed, meant):
    assert names(typed) == meant


@pytest.mark.parametrize(
    ("typed", "ref"),
    [("6204", 100), (" 62 04 ", 100), ("ROD.62o4 C3", 100), ("62O4-2RS", 100), ("TELMO-NU 23l2 K", 101), ("NU2312ECP", 101), ("2312", 0), ("NJ 2312", 0), ("62041", 0), ("16204", 0), ("3O308/CC", 102), ("QJ-310 (2)", 103),
     ("NUP404", 104), ("6204 / 30308", 0), ("COJ. LISO", 0), ("6", 0), ("NU 404", 0)],
)
def test_codes(typed, ref):
    assert CodeResolver(CODES).resolve(typed) == ref


def test_slips_and_abbreviations():
    assert one_slip("ab", "ba") and one_slip("abc", "ac") and one_slip("ac", "abc") and one_slip("abc", "axc") and not one_slip("abc", "bca") and one_slip("a", "a")
    assert shortens("vtcal", "vertical") and not shortens("vx", "vertical") and not shortens("v", "vertical")


def brute(entries, text):
    """The entry all of whose words stand in the text and nothing else does."""
    words = set(mapping.fold(text).split())
    hits = [ref for ref, n in entries if set(n.lower().split()) == words]
    return hits[0] if len(hits) == 1 else 0


def test_whole_words_against_brute_force():
    r = NameResolver(NAMES, {}, {}, frozenset())
    for _, n in NAMES:
        shuffled = " ".join(reversed(n.split()))
        for text in (n, shuffled.lower(), f"{n} EXTRA", n.rsplit(" ", 1)[0]):
            want = brute(NAMES, text)
            assert r.resolve(text) == want or (text.endswith("FRECUENCIA") is False and want == 0 and r.resolve(text) == 0) or text.split()[-1] == "ALTA"


def test_map_points(spark):
    points = spark.createDataFrame([(1, "MOT PPAL l/acop hor", ["6204", None, " ", "x"], 1), (2, None, None, 2), (2, " ", [], 3), (3, "zzz", ["NU2312"], 4)], "record_num long, long_name string, bearing_designations array<string>, ref_id int")
    reference = spark.createDataFrame([(i, "point_name", n) for i, n in NAMES] + [(i, "bearing", c) for i, c in CODES] + [(None, "bearing", "9"), (9, "bearing", None)], "ref_id long, kind string, canonical string")
    got = rows(mapping.map_points(points, reference).select("record_num", "slot", "ref_id"))
    motor = next(i for i, n in NAMES if n == "MOTOR PRINCIPAL LADO ACOPLE HORIZONTAL")
    assert got == sorted([(1, 0, motor), (1, 1, 100), (1, 4, 0), (3, 0, 0), (3, 1, 101)])
    assert mapping.map_points(points.limit(0), reference).count() == 0
    assert {r["ref_id"] for r in mapping.map_points(points, reference.limit(0)).collect()} == {0}
    assert mapping.map_points(points.union(points), reference).count() == 10


def test_reference_limit(spark, monkeypatch):
    monkeypatch.setattr(mapping, "REFERENCE_LIMIT", 1)
    with pytest.raises(ValueError, match="more than"):
        mapping.reference_entries(spark.createDataFrame([(1, "bearing", "a"), (2, "bearing", "b")], "ref_id long, kind string, canonical string"))


def test_aliases_as_a_table(spark):
    points = spark.createDataFrame([(1, "mtr la"), (2, "Motor lado acople"), (3, "mtr ##")], "record_num long, long_name string").selectExpr("*", "cast(null as array<string>) bearing_designations")
    reference = spark.createDataFrame([(7, "point_name", "MOTOR LADO ACOPLE"), (8, "point_name", "MOTOR")], "ref_id long, kind string, canonical string")
    table = spark.createDataFrame([("la", "lado acople"), ("Mtr.", "motor"), ("x", None)], "spelling string, means string")
    got = lambda a: {r["record_num"]: r["ref_id"] for r in mapping.map_points(points, reference, a).collect()}
    assert got(table) == {1: 7, 2: 7, 3: 8} and got(table.limit(0)) == {1: 0, 2: 7, 3: 8}


def test_long_lists_and_long_runs_of_letters():
    import time

    began = time.process_time()
    entries = [(i, f"pump {i} of line {i % 97} part{i % 13}") for i in range(1, 20_001)]
    names = mapping.NameResolver(entries, {}, {}, frozenset())
    assert names.resolve("line 5 pump 5 part5 off") == 5 and time.process_time() - began < 5
    codes = mapping.CodeResolver([(1, "6204"), (2, "NU308")])
    assert codes.resolve("X" * 5000 + "6204") == 1 and codes.resolve("AAANU6204") == 1 and codes.resolve("A NU6204") == 0
