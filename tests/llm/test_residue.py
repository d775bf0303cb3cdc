import pytest

from tremor.llm import residue
from tremor.llm.residue import read_document

CONTENT = "Bearing 6204 shows impacts at 120.5 Hz. Shaft speed 908 rpm, steady for the whole capture. "


@pytest.mark.parametrize(
    "text",
    ["Equipo: {{tag}}\nEl nivel bajó.", CONTENT + "The trend at ${location} moved from 2.1 to 3.4 mm/s.", CONTENT + "Overall is %LOAD% % above.", "Date: undefined\n" + CONTENT, CONTENT + "Status: None",
     "We read <%= value %> g.", "Keep an eye on [fill in point] for weeks.", "El nivel «valor» sube.", CONTENT + "Wait for ________ Hz.", "Escriba aquí el diagnóstico. Haga clic para añadir texto.", "x [object Object] y", "am XX/XX/XXXX"],
)
def test_fields(text):
    assert read_document(text)[1] == "field"


@pytest.mark.parametrize(
    "text",
    ["404 Bad Gateway\nproxy/1.11", "<noscript>Please enable scripting to run this app.</noscript>", "Parte de trabajo 2907/26\nEquipo: ML-1684\nFecha: 2026-09-20\n\nEl informe solicitado ya no está disponible.",
     '{"status": 503, "message": "report not available", "id": "8e962f39"}', "Home | Help\n\nDer angeforderte Bericht erfordert eine Berechtigung. (ref. d0cf2eb9)", "Verificando o seu navegador antes de abrir…\nLoading...",
     "Traceback (most recent call last):\n  File \"render.py\", line 39, in build\n    value = row['overall']\nKeyError: 'overall'", "Analysis note\nEquipment: AT1339\n\nProduction asked us to move the \nUnhandled exception at R.render(R:24)\n  caused by: N at T.open(24)",
     "Esta pÃ¡gina se interrumpiÃ³ porque su sesiÃ³n ha caducado.", "<html><head><title>504</title></head><body><h1>Oops!</h1></body></html>"],
)
def test_messages(text):
    assert read_document(text)[1] == "message"


@pytest.mark.parametrize(
    "text",
    ["Unhandled exception at R.render(R:24)\n" + "".join(f"  at viewer.Render{chr(97 + i % 26)}(R:{i})\n" for i in range(300)),
     "".join(f"The {a} server is under maintenance and not available until the work of the {b} team is over.\n" for a in ("report", "folder", "image", "chart") for b in ("network", "storage", "database", "backup", "cooling")) + "".join(f"The server {chr(97 + i) * 5} is down for maintenance. " for i in range(20))],
)
def test_long_messages(text):
    assert len(text.split()) > 240 and read_document(text)[1:] == ("message", True)


def test_long_texts_of_no_rule_can_be_reached():
    assert read_document(" ".join(f"We saw hall {chr(97 + i % 26) * 3} and came back without news of paint {chr(97 + i % 23) * 4}." for i in range(40)))[1:] == (None, True)


@pytest.mark.parametrize("text", ["(ref ", "<p ", "word ", "server. "])
def test_long_texts_are_read_in_linear_time(text):
    import time

    began = time.process_time()
    read_document(" ".join(f"{text}{chr(97 + i % 26)}" for i in range(60_000)))
    assert time.process_time() - began < 20


@pytest.mark.parametrize("text", ["bla\n" * 30, "xxxx, " * 20, "Lorem ipsum dolor amet vestib consectur. Nullam quisque tempus porta mollis.", "Este é um texto de exemplo. " * 3, "fskhkjhg klf djkkjhhh jdñhk ghlds agksj", "aaaa aaaa aaaa aaaa", "lorem ipsum dolor " * 4000])
def test_padding(text):
    assert read_document(text)[1] == "padding"


@pytest.mark.parametrize(
    "text",
    [CONTENT, CONTENT + "The historian answered with error 503 on Monday; readings were recovered from the collector.", CONTENT + "In the new template {{ date }} is filled in by IT before signing.",
     CONTENT + "Sustituya {% tag %} por la carpeta de su puesto antes de lanzar la exportación.", "Replace {{value}} with your own folder before you start the export.", CONTENT + "We removed the lorem ipsum sample from the cover of the manual.",
     CONTENT + "Los rangos <0.3> y [HF] son nombres de banda, no notas.", '{\n "machine": "SP1", "route": 77, "points": [], "bands": [0.3, 2.6], "x": {"a": 1}}', "Machine 403 stands in line two.\n" + CONTENT, CONTENT * 500, "8 points could not be reached.", "- 3 Messstellen waren nicht zugänglich.\n- 3 Messstellen waren nicht zugänglich."],
)
def test_content(text):
    assert read_document(text)[1] is None


def test_simhash_is_near_for_near_texts():
    base = [f"word{i}" for i in range(300)]
    near, far = base.copy(), [f"other{i}" for i in range(300)]
    near[150] = "changed"
    a, b, c = (int(x) & (2**64 - 1) for x in residue.simhashes([" ".join(x) for x in (base, near, far)]))
    assert bin(a ^ b).count("1") <= residue.HAMMING < bin(a ^ c).count("1")
    assert len(residue.simhashes([])) == 0 and len(residue.simhashes(["", "one"])) == 2


def of_texts(spark, texts):
    sims = residue.simhashes(texts)
    return spark.createDataFrame([(i, t, int(s)) for i, (t, s) in enumerate(zip(texts, sims, strict=True))], "class long, core string, sim long")


def alike_by_brute_force(texts):
    sets = [residue.shingles(t) for t in texts]
    return {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}


def components_of(n, links):
    of = list(range(n))
    for _ in range(n):
        for a, b in links:
            of[a] = of[b] = min(of[a], of[b])
    return of


def varied_texts(seed):
    import random

    rng = random.Random(seed)
    texts = []
    for k in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([5, 9, 30, 80, 120]))]
        texts.append(base)
        for _ in range(5):
            t = base.copy()
            for _ in range(rng.randrange(1, 4)):
                t[rng.randrange(len(t))] = f"x{k}"
            texts.append(t + [f"y{k}"] * rng.randrange(3))
    return sorted({" ".join(t) for t in texts}) + ["", "one", "one two", "a b c d e " * 3, "a b c d e " * 4]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_brute_force(spark, seed):
    """All pairs of Jaccard 0.8 are in one component, also those whose hashes lie far apart; nothing else is."""
    texts = varied_texts(seed)
    classes = of_texts(spark, texts)
    want = alike_by_brute_force(texts)
    found = {(r["a"], r["b"]) for r in residue.alike_pairs(residue.table_pairs(classes), classes).collect()}
    assert found and found < want  # the tables alone lose links
    got = dict((r["class"], r["component"]) for r in residue.near_components(classes).collect())
    assert [got[i] for i in range(len(texts))] == components_of(len(texts), want)


def test_a_cluster_makes_candidates_in_proportion(spark):
    """Of many near copies each meets its neighbours only, and all end in one component."""
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join([*base[:k], f"x{k}", *base[k + 1 :]]) for k in range(0, 200, 2)]
    classes = of_texts(spark, texts)
    assert residue.table_pairs(classes).count() <= residue.TABLES * residue.NEIGHBOURS * len(texts)
    assert residue.near_components(classes).select("component").distinct().count() == 1


def test_near_hashes_are_neighbours(spark):
    sims = [5, 5 ^ (1 << 60), 5 ^ (1 << 3), -1, 0x7000000000000000]
    classes = spark.createDataFrame([(i, f"t{i}", s) for i, s in enumerate(sims)], "class long, core string, sim long")
    assert {(r["a"], r["b"]) for r in residue.table_pairs(classes).collect()} == {(0, 1), (0, 2), (1, 2), (1, 4), (0, 4), (2, 4)}


def test_components(spark):
    nodes = spark.createDataFrame([(i,) for i in range(10)], "class long")
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (7, 8), (0, 9)], "a long, b long")
    got = dict((r["class"], r["component"]) for r in residue.components(nodes, links).collect())
    assert got == {0: 0, 9: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 6, 7: 7, 8: 7}


def test_documents(spark):
    texts = [(1, "404 Bad Gateway\nproxy/1.11"), (2, None), (3, ""), (4, "  \n"), (5, CONTENT * 3), (6, "Equipo: {{tag}}"), (7, "503 Bad Gateway\nproxy/9.9"), (5, CONTENT), (None, "404 Bad Gateway")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    from pyspark.sql import functions as F

    docs = docs.withColumn("class", F.lit("c")).withColumn("label", F.lit("l")).withColumn("core", F.lit("q"))
    got = {(r["doc_id"], r["reason"]) for r in residue.residue_documents(docs).collect()}
    assert got == {(1, "message"), (7, "message"), (6, "field")}
    assert {r["doc_id"] for r in residue.clean_corpus(docs).collect()} == {2, 3, 4, 5, None}
    assert residue.residue_documents(docs.limit(0)).count() == 0


def test_labels_spread_through_near_copies(spark):
    """A text that no rule reads is residue if it is nearly one that is, over several steps too."""
    known = "the page is closed now and will open again soon please come back to this place once more dear guest of ours so long".split()
    told = [f"The server said {k}." for k in ("no", "never", "maybe", "what")]
    message = " ".join([*told, "Error on the server: " + " ".join(known), "and so on until the server is available again."])
    steps = [message]
    for k, word in enumerate(("guest", "dear", "once")):
        steps.append(steps[-1].replace(word, f"gloom{k}") if k else steps[-1].replace("again.", "again. We wish all of our friends joy."))
    steps += ["We wish all of our friends joy. " + " ".join(known), "Bearing 6204 shows impacts at 120.5 Hz and 3 mm/s."]
    reads = [read_document(t) for t in steps]
    assert reads[0][1] == "message" and [r[1:] for r in reads[1:5]] == [(None, True)] * 4
    docs = spark.createDataFrame(list(enumerate([*steps, steps[1]])), "doc_id long, text string")
    got = {r["doc_id"]: (r["reason"], r["via"]) for r in residue.residue_documents(docs).collect()}
    assert got == {0: ("message", "text"), **dict.fromkeys((1, 2, 3, 6), ("message", "link"))}
    alone = residue.residue_documents(docs.where("doc_id > 0"))
    assert alone.count() == 0  # without the trusted text nothing spreads


def test_clean_corpus_keeps_other_rows_of_an_id(spark):
    docs = spark.createDataFrame([(1, "404 Bad Gateway", "x"), (1, CONTENT, "y"), (1, None, "z"), (2, CONTENT, None)], "doc_id long, text string, _extra string")
    assert sorted((r["doc_id"], r["_extra"] or "") for r in residue.clean_corpus(docs).collect()) == [(1, "y"), (1, "z"), (2, "")]


def test_a_table_repeats_words_but_not_figures():
    table = "Casing axial {} watch\n"
    assert read_document("".join(table.format(i / 7) for i in range(20)))[1] is None and read_document(table.format(2) * 20)[1] == "padding"


def report_tables(n, rows=16):
    import random

    rng = random.Random(5)
    row = lambda: f"the {rng.choice(('casing', 'fan', 'base frame', 'free end', 'slow shaft', 'head pulley'))} {rng.choice(('axial', 'vertical', 'horizontal'))} # {rng.choice(('good', 'watch', 'alert', 'danger', 'stopped'))}"
    return sorted({" ".join(row() for _ in range(rows)) for _ in range(n)})


def pairs_checked(monkeypatch, classes):
    """(how many pairs come to the check of words, components by class)."""
    seen, check = [], residue.alike_pairs
    monkeypatch.setattr(residue, "alike_pairs", lambda pairs, of: seen.append(pairs.count()) or check(pairs, of))
    member = dict((r["class"], r["component"]) for r in residue.near_components(classes).collect())
    return sum(seen), member


def test_unlike_texts_of_the_same_phrases_are_no_candidates(spark, monkeypatch):
    """Tables of the same phrases share shingles two by two; of these pairs only the alike are checked word by word."""
    texts = report_tables(200)
    texts += [t + " x" for t in texts[:5]]
    checked, member = pairs_checked(monkeypatch, of_texts(spark, texts))
    assert checked < len(texts)
    assert [member[i] for i in range(len(texts))] == components_of(len(texts), alike_by_brute_force(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_wanted_components_are_whole(spark, seed):
    """Components that hold a wanted class are those of brute force, over links of links too."""
    chain, texts = [f"c{i}" for i in range(80)], varied_texts(seed)
    for k in range(6):
        chain[10 * k] = f"d{k}"
        texts.append(" ".join(chain))
    classes = of_texts(spark, texts)
    want = components_of(len(texts), alike_by_brute_force(texts))
    wanted = {0, 17, len(texts) - 6}
    got = dict((r["class"], r["component"]) for r in residue.near_components(classes, spark.createDataFrame([(i,) for i in wanted], "class long")).collect())
    whole = {want[i] for i in wanted}
    assert [got[i] for i in range(len(texts)) if want[i] in whole] == [c for c in want if c in whole]
    assert want[-1] == want[-6]  # the chain is one component


@pytest.mark.parametrize("seed", [1, 2])
def test_sketches_differ_in_no_more_bits_than_sets_in_shingles(seed):
    import numpy as np

    texts = varied_texts(seed)
    sets = [residue.shingles(t) for t in texts]
    doc, s = residue.shingle_hashes(texts)
    pairs = sorted(set(zip(doc.tolist(), s.tolist(), strict=True)))
    words = residue.sketches(np.array([d for d, _ in pairs]), np.array([x for _, x in pairs], dtype=np.uint64), len(texts))
    assert [len(x) for x in sets] == np.bincount([d for d, _ in pairs]).tolist()
    for i in range(len(texts)):
        for j in range(i):
            assert sum(bin((int(x) ^ int(y)) & (2**64 - 1)).count("1") for x, y in zip(words[i], words[j], strict=True)) <= len(sets[i] ^ sets[j])
