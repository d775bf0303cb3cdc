import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tremor.operators import pages

H = 842.0


def word(text, x0, top, size=9.0, bold=False):
    return {"text": text, "x0": float(x0), "top": float(top), "size": size, "bold": bold}


def line(text, x0, top, size=9.0, bold=False):
    return [word(t, x0 + 12 * i, top, size, bold) for i, t in enumerate(text.split())]


MACHINE = [
    *line("PM.1250A - Bomba Centrifuga", 50, 100, 12.0, True),
    *line("Área: DEP - DEPURACION", 50, 120),
    *line("ALERTA", 50, 135, 9.0, True),
    word("Vibraciones:", 160, 135), word("Alerta", 230, 136),
    *line("RPM1: 1480,0 r.p.m. Potencia: 22,5 kW RPM2: 300", 50, 150),
    *line("DIAGNÓSTICO:", 50, 170, bold=True),
    *line("Vibraciones: -Desequilibrio del rotor.", 50, 182),
    *line("ANÁLISIS:", 50, 200, bold=True),
    *line("Vibraciones: Sube el 1X.", 50, 212),
    *line("Tendencia del punto", 50, 224), *line("en el lado libre", 50, 236),
    *line("La firma espectral lo confirma.", 310, 60),
    *line("DIAGNÓSTICOS PREVIOS:", 310, 86, bold=True),
    *line("-01/02/2024: (Vibraciones) Máquina parada", 310, 108),
    *line("-01/01/2024: (Vibraciones) Holgura en", 310, 127), *line("el soporte", 310, 143),
    *line("7", 300, 820),
]
CONTINUED = [*line("-01/01/2024: (Vibraciones) otra", 50, 60), *line("-05/12/2023: (Ultrasonidos) Fuga de aire", 50, 72)]


def pages_of(spark, *contents):
    data = [("d", n, H, w["x0"], w["top"], w["text"], w["size"], w["bold"]) for n, ws in enumerate(contents, 1) for w in ws]
    return spark.createDataFrame(data, "document_id string, page int, height double, x0 double, top double, text string, size double, bold boolean")


def test_lines_hang_on_their_first_word(spark):
    words = pages_of(spark, [word(str(i), 10 * i, t) for i, t in enumerate([100.0, 102.5, 104.5])]).withColumn("view", F.lit("body"))
    assert rows(pages.placed_lines(words).select("text")) == [("0 1",), ("2",)]


def test_machine_page(spark):
    p = pages.read_pages(pages_of(spark, MACHINE)).first()
    assert (p["kind"], p["tag"], p["name"], p["area_code"], p["area_name"]) == ("machine", "PM.1250A", "Bomba Centrifuga", "DEP", "DEPURACION")
    assert p["global_status_label"] == "ALERTA" and p["statuses"] == {"vibration": "Alerta"} and (p["rpm1"], p["power_kw"], p["rpm2"]) == (1480.0, 22.5, 300.0)
    assert p["diagnosis"] == {"vibration": "-Desequilibrio del rotor."} and p["figures"] == ["Tendencia del punto en el lado libre"]
    assert p["analysis"] == {"vibration": "Sube el 1X. La firma espectral lo confirma."}
    assert [tuple(e) for e in p["previous"]] == [("2024-02-01", "vibration", "Máquina parada"), ("2024-01-01", "vibration", "Holgura en el soporte")]
    assert p["anchors_page"] == p["anchors_sources"] == 2


@pytest.mark.parametrize(
    ("title", "tag", "name"),
    [("TC.1523A1 (lado x) - Transporte", "TC.1523A1", "Transporte (lado x)"), ("BOMBA PM.OSMOSIS2", "PM.OSMOSIS2", "BOMBA"), ("SIN TAG - algo", None, "SIN TAG - algo"), ("PM.1", "PM.1", "PM.1")],
)
def test_titles(spark, title, tag, name):
    got = spark.createDataFrame([(title,)], "t string").select(pages.tag_and_name(F.col("t")).alias("x")).first()["x"]
    assert (got["tag"], got["name"]) == (tag, name)


def test_parts_of_a_section(spark):
    df = spark.createDataFrame([("Vibraciones: a\nb  Termografía: c Vibraciones: d",), ("nothing",), (None,)], "t string")
    assert [r[0] for r in df.select(pages.by_modality(F.col("t"))).collect()] == [{"thermography": "c", "vibration": "d"}, {}, {}]
    two = spark.createDataFrame([({"vibration": "x"}, "firma espectral y ultrasonidos"), ({"vibration": "x"}, "y ultrasonido"), ({}, "-01/01/2024: (X) y")], "a map<string,string>, t string")
    assert [r[0] for r in two.select(pages.overflow_of(F.col("a"), F.col("t"))).collect()] == [{"vibration": "x"}, {"vibration": "x", "ultrasound": "y ultrasonido"}, {}]


def test_documents(spark):
    words = pages_of(spark, MACHINE, CONTINUED, line("Anexo", 50, 100))
    p = pages.read_pages(words).cache()
    assert rows(p.select("page", "kind")) == [(1, "machine"), (2, "continuation"), (3, "other")]
    assert rows(pages.entries(p).select("date", "modality", "text")) == [("2023-12-05", "ultrasound", "Fuga de aire"), ("2024-01-01", "vibration", "Holgura en el soporte"), ("2024-02-01", "vibration", "Máquina parada")]
    assert pages.broken_anchors(p).count() == 0
    inspections = spark.createDataFrame([("d", "2024-03-01")], "document_id string, inspection_date string")
    o = pages.observations(p, inspections)
    got = rows(o.select("record_kind", "observed_at", "modality", "status", "alarm"))
    assert got == [("primary", "2024-03-01", "vibration", "ALERT", 2), ("retrospective", "2023-12-05", "ultrasound", "UNKNOWN", None), ("retrospective", "2024-01-01", "vibration", "UNKNOWN", None), ("retrospective", "2024-02-01", "vibration", "STOPPED", None)]
    assert pages.read_pages(words.limit(0)).count() == 0


def test_fragments_and_samples(spark):
    data = [(1, "a"), (2, "x START"), (3, "b"), (4, "END"), (5, "c")]
    lines = spark.createDataFrame([("d", "l", 1, float(t), s) for t, s in data], "document_id string, column string, page int, top double, text string")
    assert rows(pages.update_fragments(lines, "START", "END").select("text")) == [("b",), ("x START",)]
    assert pages.sampled(lines, "document_id", 2, 7).count() == 2 and rows(pages.sampled(lines, "document_id", 2, 7)) == rows(pages.sampled(lines, "document_id", 2, 7))
    v = pages.verbatim(spark.createDataFrame([("a b", "x a  b y"), ("q", "x")], "t string, s string"), "t", "s")
    assert [r["found"] for r in v.collect()] == [True, False]


FRONT = [
    [*line("REF: INF-2026-01", 50, 60), *line("CLIENTE: Planta Norte", 50, 80), *line("FECHA INSPECCIÓN: 26/01/2026", 50, 100), *line("Inspección de vibraciones", 50, 120)],
    [*line("Índice", 50, 60), *line("- no es lista", 50, 80)],
    [*line("Este informe presenta los resultados entre el 01/01/2026 y el 20/01/2026.", 50, 60), *line("* Ruta A", 50, 80), *line("* Ruta B", 50, 100), *line("Análisis realizados por: Ana", 50, 120),
     *line("Máquinas Paradas", 50, 140), *line("- Bomba 1", 50, 160)],
    [*line("- Bomba 2", 50, 60), *line("- Bomba 1", 50, 80), *line("Máquinas No Medidas", 50, 100), *line("- Molino", 50, 120), *line("Resumen", 50, 140), *line("- nada", 50, 160)],
    [*line("Global Inspecciones", 50, 60), *line("Revisión realizada por: Eva", 50, 80)],
]


def test_front_matter(spark):
    f = pages.front_matter(pages_of(spark, *FRONT)).first().asDict()
    assert (f["document_ref"], f["client"], f["inspection_date"], f["document_title"], f["period_from"], f["period_to"]) == ("INF-2026-01", "Planta Norte", "2026-01-26", "Inspección de vibraciones", "2026-01-01", "2026-01-20")
    assert f["routes"] == ["Ruta A", "Ruta B"] and f["analysts"] == ["Ana"] and f["reviewers"] == ["Eva"]
    assert f["machines_stopped"] == ["Bomba 1", "Bomba 2"] and f["machines_not_measured"] == ["Molino"]
    assert pages.front_matter(pages_of(spark, line("nada", 50, 60))).first()["routes"] == []


def test_reports_to_tables(spark, tmp_path):
    from types import SimpleNamespace

    from tremor import cli

    words = str(tmp_path / "words.parquet")
    pages_of(spark, FRONT[0], MACHINE, CONTINUED).write.parquet(words)
    out = tmp_path / "truth"
    assert [r["error"] for r in cli.reports(spark, SimpleNamespace(path=words, out=str(out))).collect()] == [None]
    o = spark.read.parquet(f"{out}/observations.parquet")
    got = rows(o.select("observation_id", "record_kind", "status", "observed_at", "n_findings"))
    assert got == [
        ("INF202601:PM1250A:ultrasound:2023-12-05", "retrospective", "UNKNOWN", "2023-12-05", 1), ("INF202601:PM1250A:vibration", "primary", "ALERT", "2026-01-26", 1),
        ("INF202601:PM1250A:vibration:2024-01-01", "retrospective", "UNKNOWN", "2024-01-01", 1), ("INF202601:PM1250A:vibration:2024-02-01", "retrospective", "STOPPED", "2024-02-01", 0),
    ]
    assert rows(spark.read.parquet(f"{out}/findings.parquet").select("mapping_rule")) == [("GT001v2",), ("GT004v2",), ("GT024",)]
    lost = str(tmp_path / "lost.parquet")
    pages_of(spark, [*MACHINE, *line("-01/02/2020: (Vibraciones) antes", 50, 50)]).write.parquet(lost)
    with pytest.raises(cli.CommandError, match="lost on d page 1"):
        cli.reports(spark, SimpleNamespace(path=lost, out=str(out)))


def test_weights_command(spark, tmp_path):
    import json
    from types import SimpleNamespace

    from tremor import cli

    words = str(tmp_path / "words.parquet")
    pages_of(spark, FRONT[0], MACHINE).write.parquet(words)
    out = str(tmp_path / "truth")
    cli.reports(spark, SimpleNamespace(path=words, out=out))
    overlay = tmp_path / "overlay.json"
    overlay.write_text(json.dumps({"kind": "weight_overlay", "$overlay_version": "0.1.0", "judgements": [{"diagnosis_text": "-Desequilibrio del rotor.", "findings": [{"finding": "IMBALANCE:IMBALANCE", "score": 1}]}]}))
    new = str(tmp_path / "new")
    assert cli.weights(spark, SimpleNamespace(path=out, overlay=str(overlay), out=new)).count() == 1
    assert spark.read.parquet(f"{new}/findings.parquet").where("weight <> 1.0").count() == 0
    overlay.write_text(json.dumps({"kind": "x", "$overlay_version": "9", "judgements": []}))
    with pytest.raises(cli.CommandError, match="unusable"):
        cli.weights(spark, SimpleNamespace(path=out, overlay=str(overlay), out=new))
