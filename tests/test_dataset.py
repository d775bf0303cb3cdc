import json
import zipfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.record_file import database
from tremor import cli
from tremor.operators import documents, export_rows
from tremor.operators.database import Database
from tremor.sources import dataset


@pytest.fixture(scope="module")
def db(spark, tmp_path_factory):
    return Database(spark, database(tmp_path_factory.mktemp("export") / "plant.rec"))


def test_export_and_read_back(spark, db, tmp_path):
    out = tmp_path / "data"
    written = cli.export(db, SimpleNamespace(out=str(out), areas="area_uno", types="fft,waveform,trend", dataset_path="client/site")).cache()
    got = written.collect()
    assert {r["error"] for r in got} == {None}
    counts = {(r["table"], r["machine_id"]): r["rows"] for r in got}
    assert counts["spectra", "BOMBA_AG_100"] == 2 and counts["waves", "BOMBA_AG_100"] == 1 and counts["spectra", "MAQUINA_2"] == 0
    assert counts["trends", "BOMBA_AG_100"] == 3 + 6 + 5  # overall, two bands, three loads and two speeds of the captures
    s = dataset.read_machines(spark, str(out), "spectra")
    assert {r["machine"] for r in s.collect()} == {"BOMBA_AG_100"} and dict(s.dtypes)["t"] == "bigint"
    assert {r["proc_mode_id"] for r in s.collect()} == {"VEL_1000"} and {r["unit"] for r in s.collect()} == {"C16"}
    assert (out / "machine=MAQUINA_13" / "waves.parquet").exists()
    about = json.loads((out / "dataset.json").read_text())
    assert about["name"] == "plant" and about["path"] == ["client", "site"] and about["description"] == "PLANTA ÑANDÚ"
    m = json.loads((out / "machine=BOMBA_AG_100" / "machine.json").read_text())
    assert m["machine"] == {"id": "BOMBA_AG_100", "name": "BOMBA AG-100", "path": ["AREA UNO"], "frequencies": []} and [p["id"] for p in m["points"]] == ["MOTOR_LA_HORIZONTAL", "MOTOR_LA_HORIZONTAL_1"]
    assert m["points"][0]["location"] == "DE" and m["points"][0]["bearing_designations"] == ["6204", "SKF 6308"] and "nominal_speed_rpm" not in m["points"][1]
    assert {b["proc_mode_id"] for b in m["mode_bindings"]} == {"VEL_1000", "WAVE_ACC_2560"} and {d["definition_id"] for d in m["mode_definitions"]} == {b["definition_id"] for b in m["mode_bindings"]}
    assert {r["mode_definition_id"] for r in s.collect()} <= {d["definition_id"] for d in m["mode_definitions"]}
    c = {r["metric_id"]: r for r in json.loads((out / "machine=BOMBA_AG_100" / "metric_catalog.json").read_text())}
    assert set(c) == {"overall_velocity_rms__MOTOR_LA_HORIZONTAL", "band_1x_rpm__MOTOR_LA_HORIZONTAL", "band_mp_wave__MOTOR_LA_HORIZONTAL", "load", "speed"}
    assert c["band_mp_wave__MOTOR_LA_HORIZONTAL"]["statistic"] == "true_peak" and c["speed"]["unit"] == "HTZ" and "point_id" not in c["speed"]
    assert json.loads((out / "machine=MAQUINA_13" / "machine.json").read_text())["points"] == []
    total = documents.export_summary(written.where("table in ('spectra', 'waves', 'trends')")).first()
    assert (total["machines"], total["machines_with_rows"], total["failed"], total["spectra"]) == (14, 1, 0, 2)
    from tremor.operators import reconcile

    machines = reconcile.dataset_machines(spark, str(out))
    assert machines.count() == 14 and machines.where("machine_path = 'AREA UNO'").count() == 14
    cover = reconcile.trend_coverage(dataset.read_machines(spark, str(out), "trends").withColumnRenamed("machine", "machine_id")).first()
    assert (cover["machine_id"], cover["first_day"], cover["n"]) == ("BOMBA_AG_100", "2013-02-28", 14)


def test_stats_and_report(db):
    a = SimpleNamespace(area=None, equipment=None, sort="total", limit=2)
    top = cli.stats(db, a).collect()
    assert len(top) == 2 and (top[0]["machine_id"], top[0]["total"]) == ("BOMBA_AG_100", 6)
    grand = [r for r in cli.report(db, a).collect() if r["level"] == 0]
    assert (grand[0]["units"], grand[0]["captures"]) == (14, 6)


def test_folder_guard(tmp_path, monkeypatch):
    (tmp_path / "ground-truth").mkdir()
    (tmp_path / "old.txt").write_text("x")
    dataset.prepare_folder(str(tmp_path))
    assert [p.name for p in tmp_path.iterdir()] == ["ground-truth"]
    (tmp_path / ".git").mkdir()
    for bad in ("/", str(tmp_path)):
        with pytest.raises(ValueError, match="clear"):
            dataset.prepare_folder(bad)


def test_package(tmp_path):
    root = tmp_path / "d"
    root.mkdir()
    (root / "b.txt").write_text("b")
    (root / "a.txt").write_text("a")
    out = dataset.package(str(root))
    assert zipfile.ZipFile(out).namelist() == ["a.txt", "b.txt"]
    (root / "link").symlink_to(root / "a.txt")
    with pytest.raises(ValueError, match="link"):
        dataset.package(str(root), str(tmp_path / "x.zip"))
    assert not (tmp_path / "x.zip").exists() and not (tmp_path / "x.part").exists()


def test_manifest(tmp_path):
    (tmp_path / "in.json").write_text("{}")
    body = dataset.write_manifest(str(tmp_path / "o"), {"findings": 3}, [str(tmp_path / "in.json")])
    assert body["inputs"][0]["sha256"].startswith("44136fa3") and json.loads((tmp_path / "o" / "materialization.json").read_text())["outputs"] == [{"path": "findings", "rows": 3}]


def test_definition_ids():
    spectrum = {"signal_family": "velocity", "fmin_hz": 0.0, "fmax_hz": 1000.0, "lines": 8, "detector": "peak", "power": False}
    assert export_rows.definition_id({"spectrum": spectrum}) == export_rows.definition_id({"spectrum": spectrum | {"grid_kind": "hz_uniform", "window": None}})
    assert export_rows.canonical_json({"b": [1.5, None], "a": 250.0}) == '{"a":250,"b":[1.5,null]}'
    assert [export_rows.canonical_number(x) for x in (0.0, 1e-7, 0.00001, 1e21, 0.1, -2.5)] == ["0", "1e-7", "0.00001", "1e+21", "0.1", "-2.5"]
    with pytest.raises(ValueError, match="spectrum or"):
        export_rows.definition_id({})
    with pytest.raises(ValueError, match="non-finite"):
        export_rows.canonical_number(float("nan"))


def test_diagnoses(spark, tmp_path):
    doc = {"kind": "k", "unknown": 1, "provenance": {"origin": "o", "document_id": "d1", "inspection_date": "2024-01-01"}, "observations": [
        {"observation_id": "x", "record_kind": "primary", "machine": {"normalized_tag": "A1"}, "modality": "v", "observed_at": "2024-01-01", "status": "OK", "findings": [{"fault_group": "G", "weight": 0.5}, {"fault_group": "H", "weight": 0.5}]},
        {"observation_id": "y", "record_kind": "primary", "machine": {"normalized_tag": "A2"}, "modality": "v", "observed_at": "2024-01-01", "status": "OK"}]}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    d = dataset.read_diagnoses(spark, str(tmp_path / "d.json"))
    assert rows(dataset.observation_rows(d).select("document_id", "observation_id", "normalized_tag", "n_findings")) == [("d1", "x", "A1", 2), ("d1", "y", "A2", 0)]
    assert rows(dataset.finding_rows(d).select("observation_id", "finding_index", "fault_group")) == [("x", 0, "G"), ("x", 1, "H")]


def test_required(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    assert dataset.required(df.where("id = 1"), ["id", "name"]).count() == 1
    with pytest.raises(Exception, match="null in name"):
        dataset.required(df, ["name"]).collect()


def test_point_commands(spark, db, tmp_path, caplog, capsys):
    a = SimpleNamespace(point="MOTOR LA HORIZONTAL", equipment=None, type="both", limit=1, out=str(tmp_path))
    with pytest.raises(cli.CommandError, match="2 points") as e:
        cli.extract(db, a)
    assert e.value.code == 2
    with pytest.raises(cli.CommandError, match="no point"):
        cli.located(db, "nothing", None)
    only = db.points().where("point_id = 'MOTOR_LA_HORIZONTAL'")
    one = SimpleNamespace(points=lambda: only, spectra=db.spectra, waveforms=db.waveforms, trends=db.trends, spark=spark)
    assert rows(cli.extract(one, a)) == [("fft", 1), ("waveform", 1)] and len(list(tmp_path.glob("BOMBA_AG_100__MOTOR_LA_HORIZONTAL__fft__*.parquet"))) == 1
    assert rows(cli.extract(one, SimpleNamespace(**vars(a) | {"type": "trend"}))) == [("trend", 9)]
    assert cli.dump(db, SimpleNamespace(record=0)).splitlines()[0].startswith("00000000") and "MT4." in cli.dump(db, SimpleNamespace(record=0))
    with pytest.raises(cli.CommandError, match="no record"):
        cli.dump(db, SimpleNamespace(record=10**6))
    assert rows(cli.follow(db, SimpleNamespace(record=0, at=0, max_steps=2))) == [(0, 0, "end")]
    s = cli.summary(db, SimpleNamespace(area=None, equipment=None)).first()
    assert (s["areas"], s["machines"], s["machines_with_data"], s["points"], s["fft"], s["waveform"], s["trend"]) == (1, 14, 1, 2, 2, 1, 3)
    assert cli.index(db, SimpleNamespace()).select("sample_id").distinct().count() == 6
    t = tmp_path / "tree.json"
    cli.tree(db, SimpleNamespace(out=str(t)))
    assert json.loads(t.read_text())["n_machines"] == 14


def test_alarm_document(spark, db, tmp_path):
    got = cli.alarm_notes(db, SimpleNamespace(out=str(tmp_path), client="c", plant="p")).first()
    assert (got["notes"], got["alarms"], got["emitted"], got["incoherent"], got["unit_mismatch"]) == (1, 1, 1, 0, 0)
    doc = json.loads((tmp_path / "plant.json").read_text())
    o = doc["observations"][0]
    assert o["status"] == "DANGER" and o["machine"]["normalized_tag"] == "AG100" and o["findings"][0]["fault_group"] == "UNMAPPED" and doc["provenance"]["measurement_period"] == {"from": "2013-02-28", "to": "2013-02-28"}
    assert "banda OVERALL VALUE = 11.278 mm/s" in o["analysis_text"] and 'D 10.16 mm/s (set "LIMITES")' in o["analysis_text"]
    assert spark.read.parquet(f"{tmp_path}/observations_consolidated.parquet").count() == 1


def test_command_line(spark, tmp_path, capsys):
    path = database(tmp_path / "x.rec")
    assert cli.main(["scan", path, "--limit", "2"], spark) == 0 and len(capsys.readouterr().out.splitlines()) == 2
    assert cli.main(["scan", str(tmp_path / "no.rec"), "--log-json"], spark) == 1 and json.loads(capsys.readouterr().err.splitlines()[-1])["level"] == "error"


def test_reconcile(spark):
    from tremor.operators import reconcile

    o = spark.createDataFrame([("d2", 0, "AG100", None, "A DE CARGA"), ("d1", 0, "AG100", "first", "A DE CARGA"), ("d1", 1, "P7", None, "B"), ("d1", 2, "Q", "x", "B")], "document_id string, place int, normalized_tag string, external_tag string, area_name string")
    o = o.withColumns({"external_name": F.lit("n"), "area_code": F.lit("c"), "dataset_machine_id": F.when(F.col("normalized_tag") == "Q", "taken")})
    machines = spark.createDataFrame([("MEZCLADOR_AG_100", "A CARGA"), ("P7_BOMBA", "B"), ("P7_OTRA", "B"), ("LIBRE", "C")], "machine_id string, machine_path string")
    built = reconcile.build_crosswalk(reconcile.unresolved_tags(o), machines)
    got = {r["normalized_tag"]: r for r in built.collect()}
    assert set(got) == {"AG100", "P7"} and got["AG100"]["dataset_machine_id"] == "MEZCLADOR_AG_100" and got["AG100"]["external_tag"] == "first" and got["P7"]["candidates"] == "P7_BOMBA|P7_OTRA"
    assert rows(reconcile.open_cases(built, machines).select("normalized_tag", "same_area")) == [("P7", ["P7_BOMBA", "P7_OTRA"])]
    assert reconcile.area_mismatches(built, machines).count() == 0 and reconcile.free_machines(built, machines).count() == 3
    assert reconcile.markdown_table(built.select("normalized_tag", "dataset_machine_id")).splitlines()[-1] == "| P7 | — |"
