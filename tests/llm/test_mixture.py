import os
from collections import Counter

import pytest

from tremor.llm import encoding, mixture

needs_vocabulary = pytest.mark.skipif(not os.path.exists(os.path.join(encoding.VOCABULARIES, encoding.DEFAULT)), reason="no vocabulary files here")


def test_plan():
    plan = {p["source"]: p for p in mixture.mix_plan([("m", "a", 3.0, 2), ("m", "b", 1.0, None), ("m", "none", 6.0, 1), ("m", "zero", 0.0, 1)], {"a": (10, 300), "b": (5, 1000), "zero": (1, 5)})}
    assert plan["a"]["copies_each"] == pytest.approx(2.0) and plan["b"]["wanted_tokens"] == pytest.approx(200.0)
    assert plan["none"]["copies_each"] == 0 and plan["zero"]["target_share"] == 0
    assert mixture.mix_plan([("m", "a", 1.0, None)], {})[0]["copies_each"] == 0
    free = mixture.mix_plan([("m", "a", 1.0, None), ("m", "b", 1.0, None)], {"a": (1, 100), "b": (1, 300)})
    assert sum(p["wanted_tokens"] for p in free) == pytest.approx(400.0)
    assert mixture.mix_plan([("m", "a", 1.0, 0)], {"a": (1, 100)})[0]["copies_each"] == 0


def test_places_are_a_permutation(spark):
    sized = spark.range(5000).selectExpr("id % 4000 doc_id", "if(id % 3 = 0, 'hot', 'x') source", "id % 700 + 1 n_tokens")
    got = mixture.document_places(sized).collect()
    for source in ("hot", "x"):
        places = sorted(r["place"] for r in got if r["source"] == source)
        assert places == list(range(len(places)))


@needs_vocabulary
def test_selection(spark):
    docs = spark.createDataFrame(
        [(i, "word " * (i % 17 + 1), " Big" if i % 2 else "big") for i in range(800)] + [(1000 + i, "tiny text here", "small") for i in range(20)] + [(2000, None, "small"), (2001, "", "small"), (2002, "x", None)],
        "doc_id long, text string, source string",
    ).withColumnRenamed("source", "source")
    targets = spark.createDataFrame([("even", "BIG", 1.0, 3), ("even", "small", 1.0, 4), ("even", "gone", 5.0, None), ("solo", "small", 2.0, None)], "mix_name string, source string, target_share double, max_repeats int")
    sel = mixture.mix_sources(docs, targets).collect()
    tokens = Counter()
    for r in sel:
        assert r["copies"] <= {"big": 3, "small": 4}[r["source"]] and r["doc_id"] not in (2000, 2001, 2002)
        tokens[r["mix_name"], r["source"]] += r["copies"] * r["n_tokens"]
    assert tokens["even", "small"] == 20 * 4 * 3  # the tightest cap, used up
    assert tokens["even", "big"] == pytest.approx(240, rel=0.15)
    assert tokens["solo", "small"] == 60
    report = {(r["mix_name"], r["source"]): r for r in mixture.mix_report(docs, targets).collect()}
    assert report["even", "gone"]["tokens"] == 0 and report["even", "small"]["reached_share"] == pytest.approx(0.5, abs=0.05)
    assert report["even", "big"]["tokens"] == tokens["even", "big"]
    assert sel == mixture.mix_sources(docs, targets).collect() or sorted(sel) == sorted(mixture.mix_sources(docs, targets).collect())
    assert mixture.mix_sources(docs.limit(0), targets).count() == 0


@needs_vocabulary
def test_emits_once_per_whole_number_crossed(spark):
    """The copies of a source are those of one offset and equal steps, for any sizes."""
    docs = spark.createDataFrame([(i, "a b c " * (i % 5 + 1), "s") for i in range(300)] + [(900 + i, "q " * 11, "t") for i in range(30)], "doc_id long, text string, source string")
    targets = spark.createDataFrame([("m", "s", 0.5, None), ("m", "t", 0.5, 2)], "mix_name string, source string, target_share double, max_repeats int")
    report = {r["source"]: r for r in mixture.mix_report(docs, targets).collect()}
    each = report["s"]["copies_each"]
    assert abs(report["s"]["copies"] - each * 300) <= 1 and report["s"]["most_repeats"] <= int(each) + 1
