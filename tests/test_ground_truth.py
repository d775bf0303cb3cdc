import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tremor.operators import alarms, ground_truth
from tremor.sources import dataset, overlays


def finding(group, mode=None, weight=0.5, text="t"):
    quality = "unmapped" if group == "UNMAPPED" else "direct"
    return {"source_text": text, "matched_text": "m", "fault_mode": mode, "fault_group": group, "label_quality": quality, "mapping_rule": "GT1", "weight": weight}


def observation(oid, tag, at, kind="primary", text="t", found=(), machine=None):
    return {"observation_id": oid, "record_kind": kind, "machine": {"normalized_tag": tag, "external_name": "n", "dataset_machine_id": machine}, "modality": "vibration",
            "observed_at": at, "status": "OK", "diagnosis_text": text, "findings": list(found)}


def document(folder, name, inspected, observations, origin="inspection-report"):
    body = {"kind": "k", "provenance": {"origin": origin, "document_id": name, "inspection_date": inspected, "source_ref": name}, "observations": observations}
    (folder / f"{name}.json").write_text(json.dumps(body))


@pytest.fixture
def folder(tmp_path):
    document(tmp_path, "d1", "2026-01-26", [observation("a", "AG100", "2026-01-26", found=[finding("GEAR", "GEAR_WEAR"), finding("UNMAPPED")]), observation("b", "P7", "2026-01-01", "retrospective")])
    document(tmp_path, "d2", "2026-05-25", [observation("c", "AG100", "2026-02-23", "retrospective", found=[finding("BELT", "BELT_FAULT", 1.0)]), observation("d", "P7", "2026-01-01", "retrospective")])
    document(tmp_path, "s1", None, [observation("e", "AG100", "2026-01-26", machine="own")], "system-alarm")
    (tmp_path / "crosswalk.csv").write_text("normalized_tag,external_name,dataset_machine_id\nAG100,X, CW001 \nP7,Y,\n")
    (tmp_path / "findings.csv").write_text("old")
    return tmp_path


def test_materialize(spark, folder):
    body = dataset.materialize(spark, str(folder))
    assert {o["path"]: o["rows"] for o in body["outputs"]} == {"observations.parquet": 5, "observations_consolidated.parquet": 4, "findings.parquet": 3}
    assert {i["path"]: i["observations"] for i in body["inputs"]} == {"d1.json": 2, "d2.json": 2, "s1.json": 1} and all(len(x["sha256"]) == 64 for x in body["inputs"] + body["outputs"])
    assert not (folder / "findings.csv").exists() and (folder / "crosswalk.csv").exists()
    c = spark.read.parquet(f"{folder}/observations_consolidated.parquet")
    assert dict(c.dtypes)["alarm"] == "tinyint" and len(c.columns) == 26
    got = rows(c.select("origin", "normalized_tag", "observed_at", "observation_id", "valid_to", "dataset_machine_id"))
    assert got == [
        ("inspection-report", "AG100", "2026-01-26", "a", "2026-02-23", "CW001"), ("inspection-report", "AG100", "2026-02-23", "c", None, "CW001"),
        ("inspection-report", "P7", "2026-01-01", "d", None, None), ("system-alarm", "AG100", "2026-01-26", "e", None, "own"),
    ]
    f = spark.read.parquet(f"{folder}/findings.parquet")
    assert rows(f.select("observation_id", "finding_index", "fault_group", "dataset_machine_id")) == [("a", 0, "GEAR", "CW001"), ("a", 1, "UNMAPPED", "CW001"), ("c", 0, "BELT", "CW001")]
    assert dataset.materialize(spark, str(folder))["outputs"][0]["rows"] == 3  # again over its own output
    with pytest.raises(ValueError, match="no documents"):
        (folder / "empty").mkdir()
        dataset.materialize(spark, str(folder / "empty"))


def overlay(spark, folder, judgements, kind="weight_overlay", version="0.1.2"):
    (folder / "overlay.txt").write_text(json.dumps({"kind": kind, "$overlay_version": version, "judgements": judgements}))
    return overlays.read_overlay(spark, str(folder / "overlay.txt"))


GOOD = {"diagnosis_text": "t", "findings": [{"finding": "GEAR:GEAR_WEAR", "score": 2}, {"finding": "UNMAPPED:-", "score": "1"}],
        "remap": [{"from": "UNMAPPED:-", "to": {"fault_group": "BELT", "fault_mode": "BELT_FAULT", "label_quality": "weak", "matched_text": "mm"}, "why": "w"}]}


def test_overlay(spark, folder):
    document(folder, "d2", "2026-05-25", [observation("c", "AG100", "2026-02-23", text="other", found=[finding("BELT", "BELT_FAULT", 0.3)])])
    j = overlay(spark, folder, [GOOD, {"diagnosis_text": "never", "findings": [{"finding": "X:-", "score": 1}]}])
    assert overlays.overlay_faults(j).count() == 0
    docs = dataset.read_diagnoses(spark, f"{folder}/*.json")
    new = {r["provenance"]["document_id"]: r["observations"] for r in overlays.apply_overlay(docs, j).collect()}
    assert set(new) == {"d1", "d2"} and [o["observation_id"] for o in new["d1"]] == ["a", "b"]
    assert [(f["fault_group"], f["fault_mode"], f["weight"], f["mapping_rule"], f["matched_text"]) for f in new["d1"][0]["findings"]] == [
        ("GEAR", "GEAR_WEAR", 0.666667, "GT1", "m"), ("BELT", "BELT_FAULT", 0.333333, None, "mm")]
    assert [f["weight"] for f in new["d2"][0]["findings"]] == [1.0]
    o = docs.select(F.explode("observations").alias("o")).select("o.*")
    assert rows(overlays.unused(o, j)) == [("never",)]


@pytest.mark.parametrize(
    ("change", "fault"),
    [({"findings": [{"finding": "GEAR:GEAR_WEAR", "score": 0}, {"finding": "UNMAPPED:-", "score": 1}]}, "score"), ({"findings": [{"finding": "GEAR:GEAR_WEAR", "score": 1}]}, "remap"),
     ({"remap": [{"from": "UNMAPPED:-", "to": {"fault_group": "BELT", "label_quality": "weak"}}]}, "remap"), ({"remap": [{"from": "UNMAPPED:-", "to": {"fault_group": "BELT", "fault_mode": "x", "label_quality": "direct"}}]}, "remap")],
)
def test_unusable_overlays(spark, tmp_path, change, fault):
    assert {r["fault"] for r in overlays.overlay_faults(overlay(spark, tmp_path, [GOOD | change])).collect()} == {fault}


def test_unusable_overlay_files(spark, tmp_path):
    assert {r["fault"] for r in overlays.overlay_faults(overlay(spark, tmp_path, [GOOD, GOOD], kind="x", version="0.2.0")).collect()} == {"kind", "series", "twice"}


def test_overlay_that_does_not_fit(spark, folder):
    docs = dataset.read_diagnoses(spark, f"{folder}/*.json")
    stale = overlay(spark, folder, [GOOD | {"findings": GOOD["findings"][::-1]}])
    with pytest.raises(Exception, match="overlay stale a"):
        overlays.apply_overlay(docs, stale).collect()
    with pytest.raises(Exception, match="overlay unjudged a"):
        overlays.apply_overlay(docs, stale.limit(0)).collect()


def test_machine_tags(spark):
    df = spark.createDataFrame([(x,) for x in ("MECLADOR AGITADOR AG-100", "Bomba Centrifuga PM-0CI/1", "MEZCLADOR", None)], "n string")
    assert [r[0] for r in df.select(ground_truth.machine_tag(F.col("n"))).collect()] == ["AG-100", "PM-0CI/1", None, None]


def test_notes_of_bands(spark):
    notes = spark.createDataFrame(
        [(1, 7, 20, "1X - 5.0 mm/Seg -  C Alarm"), (2, 7, 60, "1X - 9.0 mm/Seg -  D Alarm"), (3, 7, 20, "HF - 3.0 G-s -  C Alarm"), (4, 7, 20, "Unknown - 3.0 G-s -  C Alarm"), (5, 8, 20, "1X - 5.0 mm/Seg -  C Alarm"), (6, 7, 0, "1X - 1.0 mm/Seg -  C Alarm")],
        "note_id long, point_record_num long, severity int, note_text string",
    ).withColumn("measured_at_utc", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    links = spark.createDataFrame([(7, 1, 2)], "point_record_num long, template_index int, limits_index int")
    limits = spark.createDataFrame([(2, "S", 0, 1.0, 2.0, 1), (2, "S", 1, 0.15, 0.3, 1), (2, "S", 2, 2.0, None, 1), (2, "S", 3, 0.1, 0.2, 1)], "limits_index int, set_name string, slot int, alert double, danger double, code int")
    templates = spark.createDataFrame([(1, 0, "1X"), (1, 1, "HF"), (1, 2, "1X")], "template_index int, slot int, band string")
    got = {r["note_id"]: (r["slot"], r["coherent"], r["reject_reason"]) for r in alarms.checked_notes(notes, links, limits, templates).collect()}
    assert got == {1: (1, True, None), 2: (1, True, None), 3: (2, True, "unit_mismatch"), 4: (None, None, "incoherent"), 5: (None, None, "incoherent"), 6: (1, False, "incoherent")}
