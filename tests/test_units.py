import pytest

from tests.conftest import rows
from tremor.functions.unit_grammar import UnitReader, decompositions, fold
from tremor.operators import units

CATALOGUE = {"mm/s": "velocity", "in/s": "velocity", "m/s": "velocity", "cm/s": "velocity", "g": "acceleration", "m/s2": "acceleration", "mg": "acceleration", "um": "displacement", "mil": "displacement", "mm": "displacement"}


@pytest.fixture(scope="module")
def reader():
    return UnitReader(CATALOGUE, units.FIELD_PRIORS["limit"])


@pytest.mark.parametrize(
    ("typed", "unit"),
    [("mm/Seg", "mm/s"), ("MM·S-1", "mm/s"), ("mm / s RMS", "mm/s"), ("[plg./s]", "in/s"), ("IPS PC", "in/s"), ("pul/sg", "in/s"), ("mts/s", "m/s"), ("cm/seg", "cm/s"), ("G-s", "g"), ("g's", "g"),
     ("m/s²", "m/s2"), ("m/seg2", "m/s2"), ("m·s⁻²", "m/s2"), ("mG's", "mg"), ("mili-g", "mg"), ("µm", "um"), ("micras", "um"), ("milésimas", "mil"), ("mil p-p", "mil"), ("mm pp", "mm"),
     ("", None), ("??", None), ("EU", None), ("dB", None), ("u.", None), ("m", None), ("s", None), (None, None), ("x" * 10000, None)],
)
def test_typed_units(reader, typed, unit):
    assert reader.read(typed) == unit


def test_ambiguous_cuts_are_scored():
    best = decompositions(fold("mil"))[0]
    assert (best.length, best.time) == (1, 0) and best.factor == pytest.approx(2.54e-5)
    gs = decompositions(fold("gs"))
    assert (gs[0].length, gs[0].time) == (1, -2)


@pytest.mark.parametrize(("text", "unit"), [("LIM MOTOR 4P mm / s", "mm/s"), ("SET HF[Gs]", "g"), ("CLASE II GEN", None), ("mG's LIM MOTOR", "mg"), ("SET 2P", None), (None, None), ("", None)])
def test_units_in_names(reader, text, unit):
    assert reader.find(text) == unit


@pytest.mark.parametrize(
    ("text", "band", "unit"),
    [("1 - 12 KHz - 14.970 m/s2 -  C Alarm", "1 - 12 KHz", "m/s2"), ("(límite anterior 2.03 mil p-p)\r\n1X RPM - 3,523 G's -  C Alarm", None, "g"), ("HOLGURA: 0.00452m/seg (D)", None, "m/s"),
     ("ALARMA C / OVERALL VALUE / [plg./s] 0.249\nTemp. 82 C", None, "in/s"), ("Valor medido en 2X RPM = 0,234 plg./s, nivel D", None, "in/s"), ("500 - 2000 Hz mm / s 4.320 alarma C", None, "mm/s"),
     ("1X RPM  9 alarma C", "1X RPM", None), ("1X RPM - 0.666  -  C Alarm", None, None), ("Velocidad 1475 rpm", None, None), (None, None, None)],
)
def test_alarm_lines(reader, text, band, unit):
    assert units.alarm_line_unit(reader, text, band) == unit


@pytest.mark.parametrize(
    ("text", "unit"),
    [("BAND - 5.2 mm/Seg - C Alarm " + "and so on " * 60, "mm/s"), ("so it is " * 60 + ": 3,5 G's (C)", "g"), ("Valor medido en " + "x " * 400 + "= 0,234 plg./s, nivel D " + "y " * 400, "in/s"),
     ("ALARMA C / " + "OVERALL / " * 100 + "[plg./s] 0.249", "in/s"), ("x " * 400 + "mm / s 4.320 alarma C", "mm/s"), ("a - 1 " * 200_000, None), ("a: 1 = 2, / [ " * 100_000 + "- 1", None)],
)
def test_alarm_lines_of_any_length(reader, text, unit):
    assert units.alarm_line_unit(reader, text, None) == unit


def test_quantities(spark):
    catalogue = spark.createDataFrame([("mm/s", "velocity", "mm/s", 1.0, 2), ("in/s", "velocity", "mm/s", 25.4, 1), ("g", "acceleration", "g", 1.0, 3)], "unit string, quantity string, common_unit string, to_common double, limit_code int")
    limits = spark.createDataFrame([(1, 1, "SET in/sec", [1.0, 0.0, 2.0], [0.0, 0.0, float("nan")], [2, 1, 99]), (2, 2, None, None, None, None)], "record_num long, set_index int, set_name string, alert array<float>, danger array<float>, unit_codes array<int>")
    notes = spark.createDataFrame([(7, "x", None, 2.0, "IPS"), (7, "x", None, 2.0, "IPS"), (8, "B: 3.0g (C)", "B", 3.0, "u."), (9, None, None, None, None)], "note_id long, note_text string, band string, line_value double, units_note string")
    spectra = spark.createDataFrame([(5, "mm/seg"), (6, "pul/sg"), (7, None)], "record_num long, units string")
    found = units.foreign_units(limits, notes, spectra, catalogue)
    assert rows(found) == [("limit", 1, 2, "in/s"), ("note", 7, 0, "in/s"), ("spectrum", 6, 0, "in/s")]
    q = {(r["src"], r["record_id"]): r for r in units.quantities(limits, notes, spectra, catalogue).where("slot = 0").collect()}
    assert q[("note", 7)]["low_common"] == pytest.approx(50.8) and q[("note", 9)]["state"] == "unstated" and q[("note", 8)]["state"] == "common"
    empty = [t.limit(0) for t in (limits, notes, spectra)]
    assert units.quantities(*empty, catalogue).count() == 0


def test_unit_strings_of_any_length(spark):
    import time

    reader = UnitReader({"mm/s": "velocity", "g": "acceleration"})
    assert reader.read("mm" + " " * 300 + "/" + " " * 300 + "s") == "mm/s" and reader.read("mm/s " + "rms " * 100) == "mm/s"
    began = time.process_time()
    for text in ("m " * 20_000, "mm/s " + "rms " * 100_000 + "x", "g" * 100_000, "m/s*" * 20_000):
        assert reader.read(text) is None
    assert time.process_time() - began < 20
