"""Linking mentions of machines to the machine list without a common identifier.

Method: collective graph linkage. Mentions (the rows of a status report) and machines
are nodes; candidate edges come from rare attributes that both share, weighted by
their rarity; meta-blocking drops the edges below the mean weight of their mention;
the remaining scores are refined by what the neighbours in the same report show -
the site that most of them name, and their claims on machines by their own current
scores and rarities - until no score changes; then the clear best edges are taken one
to one. Each match has a confidence.

Words are compared by the vocabulary of the machine list itself: exact, shortened or
with a slip. What stands for a word without looking like it (another language, a
house abbreviation) is learned from the mentions whose machine is clear without it,
and all mentions are read anew with what was learned.

Scale: blocking keys are pairs of attributes within a site, so blocks stay small even
where one site or word holds a large share; edges are made by an equi-join on these
keys and scored in the JVM; everything after is keyed by (report, mention) or (report,
machine). Only the vocabulary of machine names and the learned words go to the driver,
after a check of their size.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tremor.llm.mapping import one_slip, shortens
from tremor.session import checkpoint

VOCABULARY_LIMIT = 100_000

STOP = frozenset(("de", "del", "la", "el", "los", "no", "n", "num", "zona", "nd", "ver", "nota", "pl", "baja", "y", "d"))
#: A foreign word is learned from so many machines, if so large a share of its clear mentions stand for the word.
TAUGHT, AGREED = 3, 0.8
MIN_SCORE = 1.0
MARGIN = 0.25
#: What a neighbour's full claim on a machine takes from the scores of the others there.
CLAIM = 0.4
#: Claims are taken as settled when no score changes by more.
TOLERANCE = 1e-3


def words_of(text: str | None) -> list[str]:
    """Lower-case words without accents, letters and digits apart."""
    text = unicodedata.normalize("NFKD", text or "")
    text = "".join(c for c in text if not unicodedata.combining(c)).lower()
    return re.findall(r"[a-z]+|[0-9]+", text)


class Corrector:
    """Maps typed words to the vocabulary: exact, learned, abbreviation, then one slip (two in long words)."""

    def __init__(self, vocabulary: dict[str, int], learned: dict[str, str]) -> None:
        self.vocabulary = vocabulary
        self.learned = {s: w for s, w in learned.items() if w in vocabulary}
        #: spellings by first letter and by length, each with the word it stands for
        self.by_first: dict[str, list[str]] = {}
        self.by_length: dict[int, list[tuple[str, str]]] = {}
        for w in vocabulary:
            self.by_first.setdefault(w[0], []).append(w)
        for s, w in [*((w, w) for w in vocabulary), *self.learned.items()]:
            self.by_length.setdefault(len(s), []).append((s, w))
        self._seen: dict[str, str | None] = {}

    def word(self, token: str) -> str | None:
        if token in self.vocabulary:
            return token
        if token in self.learned:
            return self.learned[token]
        if len(token) < 3 or token in STOP:
            return None
        if token not in self._seen and len(self._seen) < 500_000:
            self._seen[token] = self._guess(token)
        return self._seen[token] if token in self._seen else self._guess(token)

    def _around(self, n: int, by: int) -> Iterator[tuple[str, str]]:
        for k in range(n - by, n + by + 1):
            yield from self.by_length.get(k, ())

    def _guess(self, token: str) -> str | None:
        same = self.by_first.get(token[0], [])
        options = [(0.0, w) for w in same if w.startswith(token)]
        if len(token) > 3:
            options += [(1.0, w) for s, w in self._around(len(token), 1) if one_slip(token, s)]
            options += [(1.2, w) for w in same if any(one_slip(token, w[:n]) for n in (len(token) - 1, len(token), len(token) + 1))]
        options += [(1.5 if len(token) > 3 else 1.6, w) for w in same if shortens(token, w) and not set(token[1:]) & set("aeiou")]
        if len(token) > 6:
            options += [(2.0, w) for s, w in self._around(len(token), 2) if len(s) > 6 and s == w and two_slips(token, s)]
        if not options:
            return None
        # the least supposition; of equals the one of like length, then the more frequent, then the first
        return min(options, key=lambda x: (x[0], abs(len(x[1]) - len(token)) if x[0] >= 1 and x[0] != 1.5 else 0, -self.vocabulary[x[1]], x[1]))[1]


def two_slips(a: str, b: str) -> bool:
    """Whether at most two insertions, deletions, replacements or swaps of neighbours lie between."""
    if abs(len(a) - len(b)) > 2:
        return False
    previous: list[list[int]] = []
    for i in range(len(a) + 1):
        row = [i]
        for j in range(1, len(b) + 1):
            if not i:
                row.append(j)
                continue
            c = min(previous[-1][j] + 1, row[j - 1] + 1, previous[-1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                c = min(c, previous[-2][j - 2] + 1)
            row.append(c)
        previous = [*previous[-1:], row]
    return previous[-1][-1] <= 2


def sister_letter(name: str | None) -> str | None:
    """The letter that tells sister machines apart, typed at the end of a name, or None."""
    text = re.sub(r"\[.*?\]|\(\s*(?:\d+|ver nota)\s*\)|\bn/d\b", " ", (name or "").lower()).strip(" .,*")
    m = re.search(r"(?:\(\s*([a-f])\s*\)|(?:^|[\s\-])(?:n[º°o]\.?\s*)?([a-f]))$", text)
    return (m[1] or m[2]).upper() if m else None


#: Correctors of this process by what they were made of: a Python worker keeps what it has learned from task to task.
_CORRECTORS: dict[tuple, Corrector] = {}


def shared_corrector(vocabulary: tuple, learned: tuple) -> Corrector:
    """The process' corrector for a vocabulary; only the latest few vocabularies are kept."""
    key = (vocabulary, learned)
    if key not in _CORRECTORS:
        if len(_CORRECTORS) > 7:
            _CORRECTORS.clear()
        _CORRECTORS[key] = Corrector(dict(vocabulary), dict(learned))
    return _CORRECTORS[key]


@dataclass(frozen=True)
class Lexicon:
    """The words of the machine list: how often each names a machine, the words of types and of parts of sites."""

    count: dict[str, int]
    parts: dict[str, int]
    #: tag prefix -> the words that its machines share, the noun first
    types: dict[str, list[str]]

    def rarity(self, word: str) -> float:
        return math.log(1 + (sum(self.count.values()) or 1) / self.count.get(word, 1))


_FEATURES = "free array<struct<w:string,x:double>>, typed array<string>, main boolean, part string, letter string, tokens array<string>, exact array<string>, foreign array<string>, elsewhere array<string>, taught boolean"


def _features(text: Column, area: Column, lexicon: Lexicon, learned: dict[str, str], learned_parts: dict[str, str]) -> Column:
    """What a name and an area say.

    ``free``: words with their rarity, without those of types (``typed``; ``main``: a
    noun of any type is said); ``part`` of the site; sister ``letter``; bare ``tokens``;
    ``exact``: the words of the list as they stand; ``foreign`` and ``elsewhere``: the
    tokens of name and area that aren't such words; ``taught``: what was learned
    changes what one of them is read as.
    """
    made_of = [(tuple(sorted(c.items())), tuple(sorted(s.items()))) for c, s in ((lexicon.count, learned), (lexicon.parts, learned_parts))]
    nouns = {ws[0] for ws in lexicon.types.values()}
    of_types = {w for ws in lexicon.types.values() for w in ws}
    rarity = {w: lexicon.rarity(w) for w in lexicon.count}

    @F.pandas_udf(_FEATURES)
    def parse(names: pd.Series, areas: pd.Series) -> pd.DataFrame:
        corrector, parts = (shared_corrector(*m) for m in made_of)
        unlearned, unlearned_parts = (shared_corrector(words, ()) for words, _ in made_of)
        out = []
        for name, place in zip(names, areas, strict=True):
            tokens, around = words_of(name), words_of(place)
            words = {w for t in tokens if (w := corrector.word(t))} - STOP
            found = [w for t in around if (w := parts.word(t))]
            typed = words & of_types
            out.append((
                [{"w": w, "x": rarity[w]} for w in sorted(words - typed)], sorted(typed), bool(words & nouns), found[-1] if found else None, sister_letter(name),
                sorted({t for t in tokens + around if len(t) > 3}), sorted({t for t in (*tokens, *around) if t in corrector.vocabulary or t in parts.vocabulary}),
                sorted({t for t in tokens if len(t) > 2 and t not in corrector.vocabulary and t not in STOP}), sorted({t for t in around if len(t) > 2 and t not in parts.vocabulary}),
                any(corrector.word(t) != unlearned.word(t) for t in tokens) or any(parts.word(t) != unlearned_parts.word(t) for t in around),
            ))
        return pd.DataFrame(out, columns=["free", "typed", "main", "part", "letter", "tokens", "exact", "foreign", "elsewhere", "taught"])

    return parse(text, area)


def _collect(df: DataFrame, what: str) -> list:
    """The rows of a small table, in one job; more than ``VOCABULARY_LIMIT`` are an error."""
    rows = df.limit(VOCABULARY_LIMIT + 1).agg(F.collect_list(F.struct(*df.columns))).first()[0]
    if len(rows) > VOCABULARY_LIMIT:
        raise ValueError(f"more than {VOCABULARY_LIMIT} {what}")
    return rows


def _counted(df: DataFrame, **conditions: Column) -> tuple[DataFrame, dict[str, int]]:
    """A checkpoint of a table and how many of its rows fulfil each condition, told by the job that writes it."""
    seen = Observation()
    kept = checkpoint(df.observe(seen, *[F.count_if(c).alias(name) for name, c in conditions.items()]))
    return kept, seen.get


def _deletes(token: Column) -> Column:
    """The token and all forms of it with one letter less."""
    n = F.length(token)
    return F.array_distinct(
        F.concat(F.array(token), F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(token, F.lit(1), i - 1), F.substring(token, i + 1, n))))
    )


def _site_words(area: Column) -> Column:
    """Words of a machine's area that name its site: all but the last, which names the part, or the only one."""
    words = F.filter(F.split(F.lower(area), "[^a-z]+"), lambda t: t != "")
    return F.array_distinct(F.filter(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1))), lambda t: F.length(t) > 3))


def mention_sites(mentions: DataFrame, machines: DataFrame) -> DataFrame:
    """(source_ref, mention, site): the site of a report for all of its mentions, and the sites that a mention itself names.

    All mentions of a report are neighbours: the word of the machines' areas that most
    of them speak of, weighed by rarity, holds for those whose area is missing or
    misspelt too. Of two sites voted for equally both hold. A mention that names
    another site as it stands has that too.
    """
    total = F.broadcast(machines.agg(F.count("*").alias("_all")))
    places = (
        machines.select(F.explode(_site_words(F.col("area_name"))).alias("site"))
        .groupBy("site")
        .agg(F.count("*").alias("df"))
        .crossJoin(total)  # one row
        .select("site", F.log1p(F.col("_all") / F.col("df")).alias("idf"))
    )
    told = mentions.select("source_ref", "mention", F.explode("tokens").alias("token"))
    said = told.groupBy("source_ref", "token").agg(F.count("*").alias("n"))
    forms = said.select("token").distinct().select("token", F.explode(_deletes(F.col("token"))).alias("form"))
    known = places.select("site", "idf", F.explode(_deletes(F.col("site"))).alias("form"))
    alike = (
        forms.join(known, "form")
        .select("token", "site", "idf", F.when(F.col("token") == F.col("site"), 1.0).otherwise(0.5).alias("w"))
        .dropDuplicates(["token", "site"])
    )
    votes = said.join(alike, "token").groupBy("source_ref", "site").agg(F.round(F.sum(F.col("n") * F.col("w") * F.col("idf")), 6).alias("vote"))
    top = F.max("vote").over(Window.partitionBy("source_ref"))
    voted = votes.withColumn("_top", top).where("vote = _top").select("source_ref", "site")
    own = told.join(places.select(F.col("site").alias("token")), "token").select("source_ref", "mention", F.col("token").alias("site"))
    return mentions.select("source_ref", "mention").join(voted, "source_ref").unionByName(own).distinct()


def own_score() -> Column:
    """How well a mention's own attributes fit a machine's: type, words by rarity, part, sister letter, ratings."""
    noun, kind = F.get("k_type", F.lit(0)), F.col("k_type")
    says = lambda w: F.array_contains("m_typed", w)
    second = F.slice(kind, 2, F.greatest(F.size(kind), F.lit(1)))
    another = F.exists("k_others", says) & ~F.exists(second, says)
    of_type = (
        F.when(F.coalesce(F.size(kind), F.lit(0)) <= 0, 0.0)
        .when(says(noun), 0.5 + F.when(F.forall(kind, says), 0.5).otherwise(0.0) - F.when(another, 1.5).otherwise(0.0))
        .when(F.col("m_main"), -3.0)
        .otherwise(0.0)
    )
    weigh = lambda words: F.aggregate(words, F.lit(0.0), lambda acc, x: acc + x["x"])
    names = F.transform("k_free", lambda x: x["w"])
    shared = weigh(F.filter("m_free", lambda x: F.array_contains(names, x["w"])))
    every = weigh(F.col("m_free")) + weigh(F.col("k_free")) - shared
    of_words = (
        F.when(F.size("k_free") == 0, 0.1)
        .when(F.size("m_free") == 0, -0.3)
        .otherwise(2.0 * F.when(every > 0, shared / every).otherwise(0.0) - 0.8 - F.when(shared == 0, 2.0).otherwise(0.0))
    )
    of_part = F.when(F.col("m_part").isNull() | F.col("k_part").isNull(), 0.0).when(F.col("m_part") == F.col("k_part"), 0.6).otherwise(-1.0)
    of_letter = (
        F.when(F.col("m_letter").isNotNull() & F.col("k_letter").isNotNull(), F.when(F.col("m_letter") == F.col("k_letter"), 0.5).otherwise(-5.0))
        .when(F.col("m_letter").isNotNull(), -1.5)
        .when(F.col("k_letter").isNotNull(), -0.1)
        .otherwise(0.0)
    )

    def near(a: str, b: str, tight: float, loose: float, good: float) -> Column:
        apart = F.when((F.col(a) > 0) & (F.col(b) > 0), F.abs(F.log(F.col(a) / F.col(b))))
        return F.when(apart <= tight, good).when(apart <= loose, 0.0).when(apart.isNotNull(), -2.5).otherwise(0.0)

    return of_type + of_words + of_part + of_letter + near("m_rpm", "k_rpm", 0.03, 0.05, 0.5) + near("m_power", "k_power", 0.06, 0.12, 0.7)


def propagate(edges: DataFrame) -> DataFrame:
    """Edges (source_ref, mention, normalized_tag, own, weight) with ``score``, settled between neighbours.

    The mentions of a report are neighbours, and a machine is one of them only. Each
    mention divides its claim over its machines, and over none, by the current scores,
    weighed by the rarity of what they share. An edge's score is its own similarity
    less ``CLAIM`` times what the largest claim of a neighbour on its machine has over
    its own: a neighbour's match raises a mention's other machines against it. Claims
    change by no more than scores do, so a round changes scores by 0.8 of the change
    before at most and the rounds end.
    """
    mention, machine = Window.partitionBy("source_ref", "mention"), Window.partitionBy("source_ref", "normalized_tag")
    now = checkpoint(edges.withColumn("score", F.col("own")))
    while True:
        share = F.exp(2 * (F.col("score") - MIN_SCORE))
        claims = now.withColumn("_e", share).withColumn("_c", F.col("_e") / (1 + F.sum("_e").over(mention)) * F.least("weight", F.lit(1.0)))
        ranked = claims.withColumn("_k", F.row_number().over(machine.orderBy(F.desc("_c"), "mention")))
        two = ranked.withColumn("_1", F.max(F.when(F.col("_k") == 1, F.col("_c"))).over(machine)).withColumn("_2", F.max(F.when(F.col("_k") == 2, F.col("_c"))).over(machine))
        rival = F.coalesce(F.when(F.col("_k") == 1, F.col("_2")).otherwise(F.col("_1")), F.lit(0.0))
        new = two.select("source_ref", "mention", "normalized_tag", "own", "weight", F.col("score").alias("_was"), (F.col("own") - CLAIM * F.greatest(rival - F.col("_c"), F.lit(0.0))).alias("score"))
        now, seen = _counted(new, moved=F.abs(F.col("score") - F.col("_was")) > TOLERANCE)
        if not seen["moved"]:
            return now.drop("_was")


def _settle(edges: DataFrame) -> DataFrame:
    """One machine per mention and one mention per machine within a report.

    In each round the clear best edge of a mention is taken if it is also the best of
    such edges at its machine, and the other edges of these ends go: what a neighbour stands for no longer stands for
    the rest. Rounds end when nothing is taken. Edges that tie to the end are not
    taken.
    """
    left, taken = edges, []
    m, k = Window.partitionBy("source_ref", "mention"), Window.partitionBy("source_ref", "normalized_tag")
    at_mention = m.orderBy(F.desc("score"), "normalized_tag")
    at_machine = k.orderBy(F.desc_nulls_last("_clear"), "mention")
    while True:  # every round takes a mention at least
        ranked = left.withColumn("_mr", F.row_number().over(at_mention)).withColumn("_m2", F.lead("score").over(at_mention))
        # the score of an edge that is clearly the best of its mention
        clear = ranked.withColumn("_clear", F.when((F.col("_mr") == 1) & (F.coalesce(F.col("score") - F.col("_m2"), F.lit(9.0)) >= MARGIN), F.col("score")))
        met = clear.withColumn("_kr", F.row_number().over(at_machine)).withColumn("_k2", F.lead("_clear").over(at_machine))
        best = F.col("_clear").isNotNull() & (F.col("_kr") == 1) & (F.coalesce(F.col("_clear") - F.col("_k2"), F.lit(9.0)) >= 1e-6)
        told = met.withColumn("best", best).withColumn("_gone", F.max("best").over(k)).withColumn("_done", F.max("best").over(m))
        lead = F.col("score") - F.greatest(F.coalesce("_m2", F.lit(-9.0)), F.lit(0.0))
        state, seen = _counted(
            told.where(F.col("best") | ~(F.col("_gone") | F.col("_done"))).select("source_ref", "mention", "normalized_tag", "score", "best", (1 / (1 + F.exp(-2 * lead))).alias("confidence")),
            best=F.col("best"), left=~F.col("best"),
        )
        taken.append(state.where("best").drop("best"))
        if not seen["best"] or not seen["left"]:
            return reduce(DataFrame.unionByName, taken)
        left = state.where("not best").drop("best", "confidence")


def _listed(crosswalk: DataFrame) -> DataFrame:
    """The machine list with its names, sister letters and ratings; one row per tag."""
    return crosswalk.where(F.col("normalized_tag").isNotNull()).select(
        "normalized_tag", "dataset_machine_id", F.col("area_name"),
        F.regexp_extract("normalized_tag", "^[A-Z]+", 0).alias("prefix"),
        F.nullif(F.regexp_extract("normalized_tag", "[0-9]([A-Z])$", 1), F.lit("")).alias("k_letter"),
        F.concat_ws(" ", F.regexp_replace(F.coalesce("external_name", F.lit("")), " [A-Fa-f]$", ""),
                    F.regexp_replace(F.coalesce("dataset_machine_id", F.lit("")), "[A-Z]{2}_?[0-9]+.*?(_|$)([A-Z](_|$))?", " ")).alias("text"),
        F.col("rpm1").cast("double").alias("k_rpm"), F.col("power_kw").cast("double").alias("k_power"),
    ).dropDuplicates(["normalized_tag"])


def read_lexicon(listed: DataFrame) -> Lexicon:
    """The vocabulary of names, and the words that nearly all machines with a tag prefix share: their type."""
    spoken = (
        listed.select("normalized_tag", "prefix", F.posexplode(F.split(F.lower("text"), "[^a-z]+")).alias("at", "w"))
        .where((F.length("w") > 2) & ~F.col("w").isin(*STOP))
        .groupBy("normalized_tag", "prefix", "w").agg(F.min("at").alias("at"))
    )
    count = {r["w"]: r["n"] for r in _collect(spoken.groupBy("w").agg(F.count("*").alias("n")), "words in machine names")}
    named = spoken.groupBy("prefix").agg(F.countDistinct("normalized_tag").alias("all"))
    shared = spoken.groupBy("prefix", "w").agg(F.count("*").alias("n"), F.avg("at").alias("at")).join(named, "prefix").where(F.col("n") >= 0.8 * F.col("all"))
    found: dict[str, list[tuple[float, str]]] = {}
    spread: dict[str, set[str]] = {}
    for r in _collect(shared.where("all > 1"), "words of tag prefixes"):
        found.setdefault(r["prefix"], []).append((r["at"], r["w"]))
        spread.setdefault(r["w"], set()).add(r["prefix"])
    # within a type the noun first: the word of the most related types, of equals the one that stands first
    types = {p: [w for _, w in sorted(ws, key=lambda x: (-len(spread[x[1]]), x))] for p, ws in found.items()}
    tails = listed.select(F.element_at(F.split(F.lower("area_name"), "[^a-z]+"), -1).alias("w")).where(F.length("w") > 2)
    return Lexicon(count, {r["w"]: r["n"] for r in _collect(tails.groupBy("w").agg(F.count("*").alias("n")), "parts of sites")}, types)


def _keys(site: Column, words: Column, part: Column, ratings: list[Column]) -> Column:
    """Blocking keys of a site: (key, plain) for each pair of different attributes; ``plain`` ones are of words only."""
    s = F.array_sort(F.array_distinct(words))
    key = lambda plain, *x: F.struct(F.xxhash64(site, *x).alias("key"), F.lit(plain).alias("plain"))
    cross = lambda xs, ys: F.flatten(F.transform(xs, lambda a: F.transform(ys, lambda b: key(False, a, b))))
    of_words = F.flatten(F.transform(s, lambda a: F.transform(F.filter(s, lambda b: b > a), lambda b: key(True, a, b))))
    parts = F.filter(F.array(F.concat(F.lit("@"), part)), lambda x: x.isNotNull())
    return F.concat(of_words, cross(s, parts), *[cross(F.concat(s, parts), r) for r in ratings], cross(*ratings))


def _classes(mark: str, x: Column, per: int, both: bool) -> Column:
    """The class of a rating on a logarithmic scale, for a machine also the nearer one beside it.

    Ratings apart by half a class at most share one then.
    """
    at = F.log(x) * per
    near = F.round(at) + F.when(at >= F.round(at), 1).otherwise(-1)
    named = lambda c: F.concat(F.lit(mark), c.cast("int"))
    return F.when(x > 0, F.array(named(F.round(at)), *([named(near)] if both else []))).otherwise(F.array().cast("array<string>"))


def _ratings(rpm: str, power: str, both: bool) -> list[Column]:
    return [_classes("#", F.col(rpm), 10, both), _classes("%", F.col(power), 4, both)]


def machine_keys(machines: DataFrame) -> DataFrame:
    """(key, normalized_tag, plain, df, of_plain, of_all): a machine's blocking keys with their rarity and what it could share at all."""
    of = F.array_union(F.transform("k_free", lambda x: x["w"]), F.col("k_typed"))
    keys = _keys(F.col("site"), of, F.col("k_part"), _ratings("k_rpm", "k_power", True))
    k = machines.withColumn("site", F.explode(_site_words(F.col("area_name")))).select("normalized_tag", F.explode_outer(keys).alias("k")).select("normalized_tag", "k.*").where("key is not null").distinct()
    rare = k.withColumn("df", F.count("*").over(Window.partitionBy("key")))
    mine = Window.partitionBy("normalized_tag")
    return rare.withColumn("of_plain", F.sum(F.when(F.col("plain"), 1 / F.col("df"))).over(mine)).withColumn("of_all", F.sum(1 / F.col("df")).over(mine))


def candidate_edges(mentions: DataFrame, sites: DataFrame, keys: DataFrame, machines: DataFrame) -> DataFrame:
    """Edges (source_ref, mention, normalized_tag, own, weight) after meta-blocking, scored by their own attributes.

    The weight is the rarity of what both ends share, of what the machine could share at all.
    """
    said = F.array_union(F.transform("m_free", lambda x: x["w"]), F.col("m_typed"))
    m_keys = _keys(F.col("site"), said, F.col("m_part"), _ratings("m_rpm", "m_power", False))
    placed = mentions.join(sites, ["source_ref", "mention"]).select("source_ref", "mention", F.explode_outer(m_keys).alias("k")).select("source_ref", "mention", "k.key").where("key is not null").distinct()
    edges = (
        placed.join(keys, "key")
        .groupBy("source_ref", "mention", "normalized_tag")
        .agg(F.sum(F.when(F.col("plain"), 1 / F.col("df"))).alias("_plain"), F.sum(1 / F.col("df")).alias("_all"), F.first("of_plain").alias("of_plain"), F.first("of_all").alias("of_all"))
        # words of its name alone, where it has some
        .withColumn("weight", F.when(F.col("of_plain").isNull(), F.col("_all") / F.col("of_all")).otherwise(F.coalesce("_plain", F.lit(0.0)) / F.col("of_plain")))
    )
    mine = Window.partitionBy("source_ref", "mention")
    kept = edges.withColumn("_mean", F.avg("weight").over(mine)).withColumn("_top", F.max("weight").over(mine)).where(
        F.col("weight") >= F.least(F.col("_mean"), 0.5 * F.col("_top"))
    ).select("source_ref", "mention", "normalized_tag", "weight")
    features = ["source_ref", "mention", "m_free", "m_typed", "m_main", "m_part", "m_letter", "m_rpm", "m_power"]
    full = kept.join(mentions.select(*features), ["source_ref", "mention"]).join(machines.drop("area_name", "dataset_machine_id"), "normalized_tag")
    # the score is made once: a filter on a column would be moved below and score anew
    good = F.filter(F.array(own_score()), lambda x: x >= MIN_SCORE)
    return full.select("source_ref", "mention", "normalized_tag", "weight", F.explode_outer(good).alias("own")).where("own is not null")


def learned_words(edges: DataFrame, mentions: DataFrame, machines: DataFrame) -> tuple[dict[str, str], dict[str, str]]:
    """What foreign tokens of names and of areas stand for, by the mentions whose machine is clear without them.

    A token is learned for a word if it stands in clear mentions of ``TAUGHT`` machines
    at least, and ``AGREED`` of all its clear mentions are of machines that have the
    word while the mention itself doesn't say it.
    """
    rank = Window.partitionBy("source_ref", "mention").orderBy(F.desc("own"), "normalized_tag")
    clear = edges.withColumn("_n", F.row_number().over(rank)).withColumn("_next", F.lead("own").over(rank)).where(
        (F.col("_n") == 1) & (F.coalesce(F.col("own") - F.col("_next"), F.lit(9.0)) >= 2 * MARGIN)
    ).select("source_ref", "mention", "normalized_tag")
    names = F.concat(F.transform("k_free", lambda x: x["w"]), F.col("k_typed"))
    met = clear.join(mentions.select("source_ref", "mention", "exact", "foreign", "elsewhere"), ["source_ref", "mention"]).join(
        machines.select("normalized_tag", names.alias("names"), F.array(F.col("k_part")).alias("parts")), "normalized_tag"
    )

    unsaid = lambda words: F.filter(words, lambda w: w.isNotNull() & ~F.array_contains("exact", w))
    told = lambda area, tokens, words: F.transform(tokens, lambda t: F.struct(F.lit(area).alias("area"), t.alias("token"), unsaid(words).alias("words")))
    each = met.select("normalized_tag", F.inline(F.concat(told(False, "foreign", "names"), told(True, "elsewhere", "parts"))))
    # a null word stands for the mention itself, so that each token's mentions are counted with its words
    words = F.explode(F.concat(F.array(F.lit(None).cast("string")), F.col("words"))).alias("word")
    pairs = each.select("normalized_tag", "area", "token", words).groupBy("area", "token", "word").agg(F.count("*").alias("n"), F.countDistinct("normalized_tag").alias("machines"))
    all_ = F.max(F.when(F.col("word").isNull(), F.col("n"))).over(Window.partitionBy("area", "token"))
    good = pairs.withColumn("all", all_).where(F.col("word").isNotNull() & (F.col("machines") >= TAUGHT) & (F.col("n") >= AGREED * F.col("all")))
    # of words that always come together the one that looks like the token
    begins, same_letter = (x.cast("int") for x in (F.startswith("word", F.col("token")), F.substring("word", 1, 1) == F.substring("token", 1, 1)))
    best = F.max_by("word", F.struct(begins.alias("a"), "n", "machines", same_letter.alias("b"), "word")).alias("word")
    rows = _collect(good.groupBy("area", "token").agg(best), "learned words")
    return {r["token"]: r["word"] for r in rows if not r["area"]}, {r["token"]: r["word"] for r in rows if r["area"]}


def link_cells(cells: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Each cell's machine: cell_id, normalized_tag, dataset_machine_id, confidence (0..1).

    Only cells whose machine is found come out. Cells with the same report, page,
    row, name, area and ratings are one mention. A null or blank name can't be
    linked; null ratings and areas say nothing; repeated cells come out as often as
    they are there; empty tables give no rows. ``external_tag`` and
    ``normalized_tag`` of the cells are the report's own marks and not used.
    """
    spark = cells.sparkSession
    area = F.coalesce(F.col("area"), F.lit(""))
    row = F.element_at(F.col("bbox"), 2) if "bbox" in cells.columns else F.lit(None).cast("double")
    base = cells.select(
        "cell_id", "source_ref", F.col("external_name").alias("name"), area.alias("area"),
        F.col("rpm1").cast("double").alias("m_rpm"), F.col("power_kw").cast("double").alias("m_power"),
        F.xxhash64(F.coalesce(F.col("source_page"), F.lit(-1)), F.coalesce(row, F.lit(-1.0)), F.coalesce(F.col("external_name"), F.lit("")),
                   area, F.coalesce(F.col("rpm1"), F.lit(-1.0)), F.coalesce(F.col("power_kw"), F.lit(-1.0))).alias("mention"),
    ).where(F.col("name").rlike(r"\S"))
    listed = checkpoint(_listed(crosswalk))
    lexicon = read_lexicon(listed)
    second: dict[str, set[str]] = {}
    for ws in lexicon.types.values():
        second.setdefault(ws[0], set()).update(ws[1:])
    kinds = spark.createDataFrame(
        [(p, ws, sorted(second[ws[0]] - set(ws))) for p, ws in lexicon.types.items()], "prefix string, k_type array<string>, k_others array<string>"
    )
    f = _features(F.col("text"), F.coalesce("area_name", F.lit("")), lexicon, {}, {})
    none = F.array().cast("array<string>")
    machines = checkpoint(
        listed.withColumn("f", f)
        .join(kinds, "prefix", "left")
        .select(
            "normalized_tag", "dataset_machine_id", "area_name", "k_letter", "k_rpm", "k_power", F.coalesce("k_type", none).alias("k_type"), F.coalesce("k_others", none).alias("k_others"),
            F.col("f.free").alias("k_free"), F.array_union("f.typed", F.coalesce("k_type", none)).alias("k_typed"), F.col("f.part").alias("k_part"),
        )
    )
    once = checkpoint(base.drop("cell_id").distinct())

    def read(learned: dict[str, str], parts: dict[str, str]) -> DataFrame:
        f = _features(F.col("name"), F.col("area"), lexicon, learned, parts)
        renamed = [F.col(f"f.{c}").alias(f"m_{c}") for c in ("free", "typed", "main", "part", "letter")]
        return once.withColumn("f", f).select("source_ref", "mention", "m_rpm", "m_power", *renamed, "f.tokens", "f.exact", "f.foreign", "f.elsewhere", "f.taught")

    mentions = checkpoint(read({}, {}))
    sites, keys = checkpoint(mention_sites(mentions, machines)), checkpoint(machine_keys(machines))
    edges = checkpoint(candidate_edges(mentions, sites, keys, machines))
    learned, parts = learned_words(edges, mentions, machines)
    if learned or parts:  # what was learned is read anew
        anew = checkpoint(read(learned, parts).where("taught"))
        edges = edges.join(anew.select("source_ref", "mention"), ["source_ref", "mention"], "left_anti").unionByName(candidate_edges(anew, sites, keys, machines))
    settled = _settle(propagate(edges))
    return (
        base.select("cell_id", "source_ref", "mention")
        .join(settled, ["source_ref", "mention"])
        .join(machines.select("normalized_tag", "dataset_machine_id"), "normalized_tag")
        .select("cell_id", "normalized_tag", "dataset_machine_id", F.round("confidence", 4).alias("confidence"))
    )
