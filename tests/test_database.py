import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.record_file import D0, DATES, database
from tremor.operators.database import Database, trend_readings
from tremor.sources.records import decode_text, read_records, tag_frequencies, tag_name


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    return database(tmp_path_factory.mktemp("db") / "plant.rec")


@pytest.fixture(scope="module")
def db(spark, path):
    return Database(spark, path)


def test_scan_and_pushdown(spark, path):
    counts = dict(rows(tag_frequencies(read_records(spark, path))))
    assert counts["vdps"] == 2 and counts["vcps"] == 3 and counts["gdcm"] == 14
    assert read_records(spark, path, ["vdps"]).count() == 2
    assert read_records(spark, path).where("record_num = 0").first()["tag"] == "gddh"


def test_bad_size(spark, tmp_path):
    bad = tmp_path / "bad.rec"
    bad.write_bytes(b"x" * 700)
    with pytest.raises(Exception, match="multiple"):
        read_records(spark, str(bad)).count()


def test_text_pages():
    assert decode_text(b"\xd1AND\xda \0") == "ÑANDÚ"
    assert decode_text(b"A\x81") == "Aü"  # not in the first page
    assert tag_name(b"\0\0\0\0") == "0x00000000"


def test_header(db):
    h = db.header().first()
    assert h["description"] == "PLANTA ÑANDÚ" and h["signature"] == "MT4.00"


def test_hierarchy(db):
    assert rows(db.areas()) == [(0, "AREA UNO", "AREA_UNO"), (1, "AREA DOS", "AREA_DOS")]
    m = db.machines().select("machine_id", "area_name", "slot").orderBy("slot").collect()
    assert [r["machine_id"] for r in m][:3] == ["BOMBA_AG_100", "BOMBA_AG_100_1", "MAQUINA_2"]
    assert len(m) == 14 and m[13]["machine_id"] == "MAQUINA_13" and {r["area_name"] for r in m} == {"AREA UNO"}
    p = db.points().orderBy("point_slot").collect()
    assert [r["point_id"] for r in p] == ["MOTOR_LA_HORIZONTAL", "MOTOR_LA_HORIZONTAL_1"]
    assert p[0]["bearing_designations"] == ["6204", "SKF 6308"] and p[0]["nominal_speed_rpm"] == 1455.0 and p[1]["nominal_speed_rpm"] is None


def test_spectra(db):
    s = db.spectra().orderBy("hop").collect()
    assert [len(r["data"]) for r in s] == [300, 100]
    assert s[0]["data"][0] == pytest.approx(48.5) and s[0]["data"][299] == pytest.approx(97.0) and s[0]["unit"] == "mm/s"
    assert [r["data"][99] for r in s][1] == pytest.approx(0.25 * 48.5)


def test_cycle_drops_the_chain(spark, tmp_path):
    broken = Database(spark, database(tmp_path / "cycle.rec", cycle=True))
    assert broken.spectrum_refs().count() == 0
    assert ("cycle", "vdps") in {(r["fault"], r["chain"]) for r in broken.faults().collect()}


def test_waveforms(db):
    w = db.waveforms().first()
    assert w["n_samples"] == 200 and len(w["data"]) == 200 and w["sample_rate_hz"] == pytest.approx(2560, rel=1e-6)
    assert w["data"][0] == 1.0 and w["data"][199] == 2.0 and w["unit"] == "G's"


def test_trends(db):
    t = db.trends().orderBy("band", "k").collect()
    overall = [(r["t"] // 1_000_000, round(r["value"], 4), r["alarm"]) for r in t if r["band"] is None]
    assert overall == [(D0, 2.54, 0), (DATES[0], 5.08, 2), (DATES[1], 12.7, 3)]
    first = [(round(r["value"], 4), r["alarm"]) for r in t if r["band"] == "1X RPM"]
    assert first == [(1.27, 0), (2.54, 2), (6.35, 3)]
    peak = [(r["unit"], r["alarm"]) for r in t if r["band"] == "Mp Wave"]
    assert peak == [("G's", None)] * 3  # the code of its limit is that of velocity


def test_trend_record_stops():
    assert trend_readings(D0, 0, b"\0" * 465) == []
    assert trend_readings(5, 2, b"\0" * 465) == []


def test_notes(db):
    n = db.notes().first()
    assert n["note_text"] == "OVERALL VALUE - 11.278 mm/Seg -  D Alarm\nRevisar" and n["severity_level"] == "D"


def test_summaries(db):
    s = {(r["kind"]): r["n"] for r in db.summaries().collect()}
    assert s == {"fft": 2, "waveform": 1, "trend": 3}


def test_decode_errors(spark, db, tmp_path):
    assert db.decode_errors().count() == 0
    path = tmp_path / "bad.rec"
    database(path)
    data = bytearray(path.read_bytes())
    at = next(i for i in range(len(data) // 512) if data[i * 512 + 8 : i * 512 + 12] == b"pdcd")
    data[at * 512 + 8 : at * 512 + 12] = b"xxxx"
    path.write_bytes(data)
    assert rows(Database(spark, str(path)).decode_errors()) == [("sample index", at, "pdcd", "xxxx")]
