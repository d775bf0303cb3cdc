import pytest

from tremor.llm import linkage
from tremor.llm.linkage import Corrector, sister_letter, two_slips, words_of

CELLS = "cell_id long, source_ref string, source_page int, area string, external_name string, normalized_tag string, rpm1 float, power_kw float, bbox array<double>"
MACHINES = [
    ("BC1A", "BOMBA CENTRIFUGA AGUA CALDERA A", "NORTE SECADO", 1780.0, 22.0, "BOMBA_CENTRIFUGA_AGUA_CALDERA_BC_1_A"),
    ("BC1B", "BOMBA CENTRIFUGA AGUA CALDERA B", "NORTE SECADO", 1780.0, 315.0, None),
    ("ML2", "MOLINO HARINA GRUESA", "NORTE MOLIENDA", 590.0, 75.0, "x"),
    ("ML3", None, "NORTE REFINO", 985.0, 11.0, None),
    ("BC9", "BOMBA CENTRIFUGA ACEITE CRUDO", "SURESTE SECADO", 590.0, 30.0, None),
    ("ML8", "MOLINO ACEITE CRUDO", "SURESTE REFINO", 1485.0, 30.0, None),
]


def link(spark, cells, machines=MACHINES):
    c = spark.createDataFrame([(i, r, 1, a, n, "POS", rpm, kw, [0.0, float(y)]) for i, r, a, n, rpm, kw, y in cells], CELLS)
    k = spark.createDataFrame(machines, "normalized_tag string, external_name string, area_name string, rpm1 float, power_kw float, dataset_machine_id string")
    return {r["cell_id"]: (r["normalized_tag"], r["confidence"]) for r in linkage.link_cells(c, k).collect()}


def test_links(spark):
    cells = [
        (1, "r1", "SECADO Norte", "Bomba centrif. agua cldr", None, 317.0, 1),  # told by its rating
        (2, "r1", "NORTE SECADERO", "AGUA CALDERA, Pump A", 1765.0, None, 2),
        (3, "r1", "NROTE Molienda", "mill gruesa hari. (05)", None, None, 3),
        (4, "r1", None, "Norte molino tolva pulmon", None, None, 4),  # not in the list
        (5, "r1", "Norte - REF.", "Molino", 985.0, 11.0, 5),  # the one without a name
        (6, "r1", "Norte Secado", "Bomba centrifuga agua caldera C", None, None, 6),  # no such sister
        (7, "r1", "Norte Secado", None, None, None, 7),
        (8, "r2", "Sureste", "aceite crudo, molino", None, None, 1),
        (9, "r2", "Sureste", "aceite crudo, molino", None, None, 1),
    ]
    got = link(spark, cells)
    assert {k: v[0] for k, v in got.items()} == {1: "BC1B", 2: "BC1A", 3: "ML2", 5: "ML3", 8: "ML8", 9: "ML8"}
    assert all(0.5 < c <= 1 for _, c in got.values())


def test_neighbours_settle_sisters(spark):
    cells = [(1, "r", "Norte Secado", "Bomba centrifuga agua caldera", None, None, 1), (2, "r", "Norte Secado", "Bomba centrifuga agua caldera B", None, None, 2)]
    assert {k: v[0] for k, v in link(spark, cells).items()} == {1: "BC1A", 2: "BC1B"}


def test_reports_of_two_sites(spark):
    """Mentions that name their own site are linked there, the others at the site of most."""
    cells = [
        (1, "r", "Norte Secado", "Bomba centrifuga agua caldera A", None, None, 1), (2, "r", "Norte Molienda", "Molino harina gruesa", None, None, 2),
        (3, "r", "Sureste", "aceite crudo, molino", None, None, 3), (4, "r", None, "Bomba centrifuga agua caldera B", None, None, 4), (5, "r", None, "Bomba centrifuga aceite crudo", None, None, 5),
    ]
    assert {k: v[0] for k, v in link(spark, cells).items()} == {1: "BC1A", 2: "ML2", 3: "ML8", 4: "BC1B"}


def test_ratings_alone_name_a_machine(spark):
    """One word and a rating each way over the edge of its class are enough to meet."""
    assert {k: v[0] for k, v in link(spark, [(1, "r", "Norte Refino", "Molino", 980.0, None, 1), (2, "s", "Norte Refino", "Molino", None, 11.3, 1)]).items()} == {1: "ML3", 2: "ML3"}


def test_foreign_words_are_learned(spark):
    services = ["AGUA CALDERA", "ACEITE TERMICO", "HARINA GRUESA", "GASES HORNO", "PULPA FINA"]
    machines = [(f"ML{i}", f"MOLINO {s}", "NORTE SECADO", 1000.0, 10.0, None) for i, s in enumerate(services)] + [(f"SC{i}", f"SECADOR {s}", "NORTE SECADO", 1500.0, 20.0, None) for i, s in enumerate(services)]
    cells = [(i, "r", "Norte Secado", f"Quern {s}", 1000.0, 10.0, i) for i, s in enumerate(services[:4])]
    last = (9, "r", "Norte Secado", f"Quern {services[4]}", None, None, 9)
    got = {k: v[0] for k, v in link(spark, [*cells, last], machines).items()}
    assert got == {0: "ML0", 1: "ML1", 2: "ML2", 3: "ML3", 9: "ML4"}
    assert link(spark, [last], machines) == {}  # nothing to learn from


def test_claims_of_neighbours_move_scores(spark):
    """Neither mention is clear by itself; what the second claims with rare words settles the first."""
    edges = [("r", 1, "k1", 1.9, 0.2), ("r", 1, "k2", 2.0, 1.0), ("r", 2, "k1", 2.9, 1.0), ("r", 2, "k3", 2.7, 1.0), ("s", 1, "k1", 1.9, 0.2), ("s", 1, "k2", 2.0, 1.0)]
    df = spark.createDataFrame(edges, "source_ref string, mention long, normalized_tag string, own double, weight double")
    assert linkage._settle(df.withColumnRenamed("own", "score")).count() == 0
    assert [tuple(r)[:3] for r in linkage._settle(linkage.propagate(df)).collect()] == [("r", 1, "k2")]


def test_long_chains_settle_to_the_end(spark):
    """Each mention is told by the one before it only."""
    edges = [("r", i, f"k{j:02}", 2.0) for i in range(15) for j in (i - 1, i) if j >= 0]
    df = spark.createDataFrame(edges, "source_ref string, mention long, normalized_tag string, score double")
    assert {(r["mention"], r["normalized_tag"]) for r in linkage._settle(df).collect()} == {(i, f"k{i:02}") for i in range(15)}


def test_ties_stay_open(spark):
    assert link(spark, [(1, "r", "Norte Secado", "Bomba centrifuga agua caldera", None, None, 1)]) == {}


def test_degenerate(spark):
    assert link(spark, []) == {}
    assert link(spark, [(1, "r", "Norte", "Molino", 1.0, 1.0, 1)], [(None, None, None, None, None, None)]) == {}
    assert link(spark, [(1, None, "Norte", "Molino harina gruesa", None, None, 1), (2, "r", "", "", None, None, 1), (3, "r", "Norte", "z " * 20000, None, None, 2)]) == {}


def test_words():
    assert words_of("Extracción 24h/N.º") == ["extraccion", "24", "h", "n", "o"]
    c = Corrector({"caldera": 3, "calor": 1, "ventilador": 2, "lavado": 1, "hexeno": 1}, {"fan": "ventilador"})
    assert [c.word(w) for w in ("caldera", "cldr", "caldear", "fan", "lvd", "hxn", "ventildaor", "zzz", "de")] == ["caldera", "caldera", "caldera", "ventilador", "lavado", "hexeno", "ventilador", None, None]
    assert two_slips("elebaador", "elevador") and not two_slips("abc", "xyz")


@pytest.mark.parametrize(("name", "letter"), [("x nº b (29)", "B"), ("Prensa (A)", "A"), ("bomba-B (89)", "B"), ("AGUA a [pl. baja]", "A"), ("molino c *", "C"), ("Bomba", None), ("SCREEN N/D", None), ("x Nº A  (Ver Nota)", "A"), (None, None)])
def test_sister_letter(name, letter):
    assert sister_letter(name) == letter


def test_held_out_accuracy(spark):
    """Machines retyped with other words, abbreviations and slips are found again."""
    import random

    rng = random.Random(5)
    kinds = {"VN": "VENTILADOR", "ML": "MOLINO", "SC": "SECADOR", "PR": "PRENSA", "TT": "TRITURADORA"}
    services = ["AGUA CALDERA", "ACEITE TERMICO", "HARINA GRUESA", "TOLVA PULMON", "GASES HORNO", "PULPA FINA", "CARBON ACTIVO", "LODOS ESPESADOS"]
    sites, parts = ["ALDEANUEVA", "BERMEOLAS", "CORTIJADA"], ["SECADO", "REFINO", "MOLIENDA"]
    machines, cells = [], []
    other = {"VENTILADOR": "fan", "MOLINO": "mill", "SECADOR": "dryer", "PRENSA": "press", "TRITURADORA": "crusher"}
    for site in sites:
        chosen = rng.sample([(k, s) for k in kinds for s in services], 14)
        for i, (k, s) in enumerate(chosen):
            part = rng.choice(parts)
            tag = f"{k}{100 * sites.index(site) + i}"
            machines.append((tag, f"{kinds[k]} {s}" if rng.random() > 0.1 else None, f"{site} {part}", 1000.0 + 37 * i, 11.0 + 3 * i, f"{kinds[k]}_{s.replace(' ', '_')}_{tag[:2]}_{tag[2:]}" if rng.random() > 0.3 else None))
            words = [w if rng.random() > 0.4 else (w[: max(4, len(w) - 3)] + "." if rng.random() > 0.5 else w[:2] + w[3] + w[2] + w[4:]) for w in s.split()]
            if rng.random() > 0.5:
                words.reverse()
            name = " ".join([rng.choice([kinds[k], other[kinds[k]]]), "-", *words])
            cells.append((len(cells), f"r{site}", f"{part} {site}" if rng.random() > 0.3 else site, name.lower() if rng.random() > 0.5 else name, 1000.0 + 37 * i if rng.random() > 0.4 else None, 11.0 + 3 * i if rng.random() > 0.4 else None, i, tag))
    got = link(spark, [c[:7] for c in cells], machines)
    right = sum(got.get(c[0], ("",))[0] == c[7] for c in cells)
    assert right >= 0.9 * len(cells) and right >= 0.97 * len(got)
