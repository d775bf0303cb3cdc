import pytest

from tests.conftest import rows
from tremor.operators.database import Database
from tremor.sources.record_writer import Capture, Point, write_database


@pytest.fixture(scope="module")
def db(spark, tmp_path_factory):
    p = Point("P ONE", 1500.0, ["6204"], [Capture(1_500_000_000 + k, 500, 2.0, "G's") for k in range(3)], [Capture(1_500_000_000, 700, 3, "G's", scale=0.5)], [(1_500_000_000 + 60 * k, 1.0 + k, [0.5]) for k in range(60)])
    areas = [(f"AREA {a}", [(f"MACHINE {a} {m}", [p] if m == 0 else []) for m in range(25)]) for a in range(2)]
    path = str(tmp_path_factory.mktemp("w") / "x.rec")
    write_database(path, areas, [("1X RPM", 2, 0.5, 1.5)], [0.1], [0.2], [3])
    return Database(spark, path)


def test_hierarchy_over_several_lists(db):
    m = db.machines().collect()
    assert len(m) == 50 and {r["machine_name"] for r in m} == {f"MACHINE {a} {k}" for a in range(2) for k in range(25)}


def test_long_captures_and_trends(db):
    s = db.spectra().select("machine_id", "hop", "data").collect()
    assert sorted((r["machine_id"], r["hop"], len(r["data"])) for r in s) == [(f"MACHINE_{a}_0", h, 500) for a in range(2) for h in range(3)] and all(x == pytest.approx(2.6) for r in s for x in r["data"])
    w = db.waveforms().first()
    assert len(w["data"]) == 700 and set(w["data"]) == {1.5}
    t = db.trends().where("band is null and machine_id = 'MACHINE_0_0'").collect()
    assert sorted(r["t"] for r in t) == [(1_500_000_000 + 60 * k) * 1_000_000 for k in range(60)]


def test_file_is_read_once(db):
    db.machines()
    first = db.records()
    assert db.records() is first and rows(first.where("part = 'vdps'").select("tag").distinct()) == [("vdps",)]
