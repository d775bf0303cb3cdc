"""Mapping of freely typed values to the entries of a reference list.

Method: a multi-pattern automaton over canonical names and aliases finds embedded
mentions, the longest non-overlapping ones win. Where the mentions of a value make
up one entry's words, that entry is meant. The remaining values go to a token-set
similarity that allows abbreviations and one slip per word. A value that fits no
entry, or more than one equally, is reported with 0.

Scale: narrow; every executor builds the automaton once from the reference list,
whose size is checked, and remembers the values it has resolved. The typed table is
read once, without a shuffle.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REFERENCE_LIMIT = 100_000
#: Values remembered per Python worker; beyond, values are resolved anew.
REMEMBERED = 200_000

#: How names of measuring points are typed: word -> its spellings. Fixed values.
POINT_WORDS = {
    "lado": ["l"],
    "acople": ["acopl", "acop"],
    "libre": ["lib"],
    "horizontal": ["horizont", "horiz", "hor", "hztal", "hztl"],
    "vertical": ["vertic", "vert", "vtcal"],
    "axial": ["axia", "axl", "ax"],
    "alta": ["a"],
    "frecuencia": ["frec"],
    "motor": ["mot", "mtr", "m"],
    "principal": ["princ", "ppal", "pral"],
    "reductor": ["reduct", "red"],
    "eje": ["e"],
    "rapido": ["rap"],
    "lento": ["lto"],
    "cuerpo": ["cpo"],
    "bomba": ["bba"],
    "rodete": ["rte", "rod"],
    "ventilador": ["ventil", "vent"],
    "rodillo": ["rod"],
    "prensor": ["prens", "prsr"],
    "husillo": ["hus"],
    "extrusor": ["extr", "ext"],
    "tambor": ["tamb", "tbor"],
    "motriz": ["mtz"],
    "turbina": ["turb", "turbna"],
    "multiplicadora": ["multiplicad", "multipl", "multip"],
    "alternador": ["alternad", "altern", "alt"],
    "triturador": ["tritur", "trit", "trtdor"],
}
#: One typed word for several.
POINT_PHRASES = {"laco": ("lado", "acople"), "llib": ("lado", "libre"), "hf": ("alta", "frecuencia")}
#: Typed marks that carry no meaning.
POINT_NOISE = frozenset(("n", "no", "num", "de", "del", "la", "el"))


def fold(text: str) -> str:
    """Lower case without accents; every run of other characters than letters and digits is one blank."""
    text = unicodedata.normalize("NFKD", text)
    text = "".join(c for c in text if not unicodedata.combining(c)).lower()
    return re.sub(r"[^a-z0-9]+", " ", text).strip()


def one_slip(a: str, b: str) -> bool:
    """Whether one insertion, deletion, replacement or swap of neighbours turns ``a`` into ``b``."""
    if a == b or abs(len(a) - len(b)) > 1:
        return a == b
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def shortens(short: str, word: str) -> bool:
    """Whether ``short`` keeps the first letter and some of the rest of ``word``, in order."""
    if len(short) < 2 or short[0] != word[0]:
        return False
    rest = iter(word)
    return all(c in rest for c in short)


def longest_mentions(automaton: ahocorasick.Automaton, text: str) -> list[tuple[int, int, object]]:
    """Non-overlapping (start, end, value) of patterns in ``text``, the longest first served, then the leftmost.

    Patterns begin and end with a blank; neighbours may share it.
    """
    if automaton.kind != ahocorasick.AHOCORASICK:  # no pattern at all
        return []
    found = [(end - len(word) + 1, end, value) for end, (word, value) in automaton.iter(text)]
    taken: list[tuple[int, int, object]] = []
    covered = bytearray(len(text) + 1)
    for start, end, value in sorted(found, key=lambda x: (x[0] - x[1], x[0])):
        if not any(covered[start + 1 : end]):
            covered[start + 1 : end] = b"\1" * (end - start - 1)
            taken.append((start, end, value))
    return sorted(taken, key=lambda x: x[0])


class NameResolver:
    """Resolves typed multi-word names against canonical names made of words."""

    SLIP, SHORT, SPARE = 1.0, 0.4, 0.05

    def __init__(self, entries: list[tuple[int, str]], words: dict[str, list[str]], phrases: dict[str, tuple], noise: frozenset) -> None:
        self.items: dict[frozenset, int] = {}
        self.clashing: set[frozenset] = set()
        for ref, canonical in entries:
            key = frozenset(fold(canonical).split())
            if self.items.setdefault(key, ref) != ref:
                self.clashing.add(key)
        #: entries by each of their words
        self.having: dict[str, list[frozenset]] = {}
        for key in self.items:
            for w in key:
                self.having.setdefault(w, []).append(key)
        names = dict(reversed(entries))
        vocabulary = set(self.having)
        self.noise = noise - vocabulary
        #: spelling -> the word sets it may stand for
        self.forms: dict[str, set[tuple]] = {}
        for w in vocabulary:
            for s in (w, *words.get(w, ())):
                self.forms.setdefault(s, set()).add((w,))
        for s, ws in phrases.items():
            if set(ws) <= vocabulary:
                self.forms.setdefault(s, set()).add(tuple(ws))
        self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        patterns: dict[str, set[tuple]] = {f" {s} ": v for s, v in self.forms.items()}
        for key, ref in self.items.items():  # whole canonical names as they stand
            patterns.setdefault(f" {fold(names[ref])} ", set()).add(tuple(key))
        for word, value in patterns.items():
            self.automaton.add_word(word, (word, value))
        if patterns:
            self.automaton.make_automaton()
        self._options: dict[str, dict[tuple, float]] = {}

    def options(self, token: str) -> dict[tuple, float]:
        """Word sets that a typed token may stand for, with what each supposes."""
        if token in self._options:
            return self._options[token]
        out = {ws: 0.0 for ws in self.forms.get(token, ())}
        if len(token) > 1:
            for w in self.vocabulary:
                if shortens(token, w):
                    out.setdefault((w,), self.SHORT)
            if not token.isdigit():
                for s, sets in self.forms.items():
                    if len(s) > 1 and one_slip(token, s):
                        for ws in sets:
                            out.setdefault(ws, self.SLIP if len(s) > 3 else self.SLIP + 0.2)
                            out[ws] = min(out[ws], self.SLIP) if len(s) > 3 else out[ws]
        if len(self._options) < REMEMBERED:
            self._options[token] = out
        return out

    def resolve(self, value: str) -> int:
        text = fold(value)
        if not text:
            return 0
        spaced = f" {text.replace(' ', '  ')} "
        # the automaton: mentions that stand for one thing each, nothing left but noise
        mentions = longest_mentions(self.automaton, f" {text} ")
        left = self._left(f" {text} ", mentions)
        if all(len(sets) == 1 for _, _, sets in mentions) and all(t in self.noise or t.isdigit() and len(t) == 1 for t in left):
            key = frozenset(w for _, _, sets in mentions for ws in sets for w in ws)
            if key in self.items and key not in self.clashing:
                return self.items[key]
        return self._similar(spaced.split())

    @staticmethod
    def _left(text: str, mentions: list) -> list[str]:
        at, out = 0, []
        for start, end, _ in mentions:
            out += text[at : start + 1].split()
            at = end
        return out + text[at:].split()

    def _similar(self, tokens: list[str]) -> int:
        """The one entry whose words the tokens cover at the least supposition, else 0."""
        options = []
        spare = 0.0
        for t in tokens:
            o = self.options(t)
            if not o or (t in self.noise and t not in self.forms):
                if t in self.noise or (t.isdigit() and len(t) == 1):
                    spare += self.SPARE
                    continue
                return 0
            options.append(o)
        if not options:
            return 0
        scored = []
        # every token stands for words of the entry: it is among those that have a word of the token with the fewest entries
        fewest = min(([w for ws in o for w in ws] for o in options), key=lambda words: sum(len(self.having[w]) for w in words))
        for key in dict.fromkeys(k for w in fewest for k in self.having[w]):
            cost = self._cover(options, key)
            if cost is not None:
                scored.append((cost + spare, self.items[key], key))
        if not scored:
            return 0
        scored.sort(key=lambda x: x[0])
        if scored[0][2] in self.clashing or (len(scored) > 1 and scored[1][0] - scored[0][0] < 0.15):
            return 0
        return scored[0][1]

    @staticmethod
    def _cover(options: list[dict[tuple, float]], key: frozenset) -> float | None:
        """Least cost at which every token stands for words of ``key`` and all its words are said."""
        states: dict[frozenset, float] = {frozenset(): 0.0}
        for o in options:
            fits = [(frozenset(ws), c) for ws, c in o.items() if key.issuperset(ws)]
            if not fits:
                return None
            nxt: dict[frozenset, float] = {}
            for said, cost in states.items():
                for ws, c in fits:
                    s, total = said | ws, cost + c + (0.3 if ws <= said else 0.0)
                    if total < nxt.get(s, 1e9):
                        nxt[s] = total
            states = nxt
        return states.get(key)


class CodeResolver:
    """Resolves typed codes (letters, then digits) found anywhere in a value.

    A code is one token: a digit more, less or other is another code. Separators
    inside, a maker's name before, a suffix behind and o, l, i for 0 and 1 between
    digits don't matter.
    """

    def __init__(self, entries: list[tuple[int, str]]) -> None:
        self.items: dict[str, set[int]] = {}
        self.series: set[str] = set()
        for ref, canonical in entries:
            code = re.sub(r"[^A-Z0-9]", "", canonical.upper())
            self.items.setdefault(code, set()).add(ref)
            self.series.add(re.match(r"[A-Z]*", code)[0])
        self.series.discard("")
        self.longest = max(map(len, self.series), default=0)
        self.automaton = ahocorasick.Automaton()
        for code in self.items:
            self.automaton.add_word(code, (code, code))
        if self.items:
            self.automaton.make_automaton()

    @staticmethod
    def clean(value: str) -> str:
        """Upper case with o, l and i turned to digits where only digits surround them."""
        out = list(value.upper())
        letter = lambda c: c.isalpha() and c.isascii()
        for i, c in enumerate(out):
            if c in "OLI":
                left, right = out[i - 1] if i else " ", out[i + 1] if i + 1 < len(out) else " "
                right_digit = right.isdigit() or (right in "OLI" and i + 2 < len(out) and out[i + 2].isdigit())
                if (left.isdigit() or (right_digit and not letter(left))) and (right_digit or not letter(right)):
                    out[i] = "0" if c == "O" else "1"
        return "".join(out)

    def resolve(self, value: str) -> int:
        text = self.clean(value)
        at = [i for i, c in enumerate(text) if c.isascii() and c.isalnum()]
        packed = "".join(text[i] for i in at)
        if not packed or not self.items:
            return 0
        found = []
        for end, (code, _) in self.automaton.iter(packed):
            start = end - len(code) + 1
            a, b = at[start], at[end]
            if b + 1 < len(text) and text[b + 1].isdigit():
                continue
            before = text[a - 1] if a else " "
            if code[0].isdigit():
                if before.isdigit() or (start and packed[start - 1].isdigit() and at[start] - at[start - 1] <= 2):
                    continue
                letters = re.search(r"[A-Z]*$", packed[max(0, start - self.longest - 1) : start])[0]  # one more than any series has
                if any(letters.endswith(s) and (len(letters) == len(s) or at[start - len(s)] - at[start - len(s) - 1] > 1) for s in self.series):
                    continue
            elif before.isalpha():
                continue
            if any(at[k + 1] - at[k] > 2 for k in range(start, end)):
                continue
            found.append((start, end, code))
        covered = bytearray(len(packed))
        refs: set[int] = set()
        for start, end, code in sorted(found, key=lambda x: (x[0] - x[1], x[0])):
            if not any(covered[start : end + 1]):
                covered[start : end + 1] = b"\1" * (end + 1 - start)
                refs |= self.items[code]
        return refs.pop() if len(refs) == 1 else 0


def reference_entries(reference: DataFrame) -> dict[str, list[tuple[int, str]]]:
    """The reference list by kind, after a check of its size; entries without id or name don't count."""
    rows = reference.select("ref_id", "kind", "canonical").limit(REFERENCE_LIMIT + 1).collect()
    if len(rows) > REFERENCE_LIMIT:
        raise ValueError(f"the reference list has more than {REFERENCE_LIMIT} entries")
    out: dict[str, list[tuple[int, str]]] = {}
    for r in sorted((r for r in rows if r["ref_id"] is not None and r["canonical"]), key=lambda r: r["ref_id"]):
        out.setdefault(r["kind"], []).append((r["ref_id"], r["canonical"]))
    return out


def typed_values(points: DataFrame) -> DataFrame:
    """(record_num, slot, typed): slot 0 the name, slot k the k-th designation; null and blank ones are left out."""
    # one scan: the name goes before the designations, so that places are slots
    every = F.concat(F.array("long_name"), F.coalesce("bearing_designations", F.array().cast("array<string>")))
    return points.select("record_num", F.posexplode(every).alias("slot", "typed")).where(F.col("typed").isNotNull() & F.col("typed").rlike(r"\S"))


@dataclass(frozen=True)
class Aliases:
    """How names are typed: word -> its spellings, one spelling for several words, marks without a meaning."""

    words: dict[str, list[str]] = field(default_factory=dict)
    phrases: dict[str, tuple] = field(default_factory=dict)
    noise: frozenset = frozenset()

    @staticmethod
    def read(table: DataFrame) -> Aliases:
        """From a table (spelling, means): one word or several, none for noise; its size is checked."""
        rows = table.select("spelling", "means").limit(REFERENCE_LIMIT + 1).collect()
        if len(rows) > REFERENCE_LIMIT:
            raise ValueError(f"more than {REFERENCE_LIMIT} aliases")
        words: dict[str, list[str]] = {}
        phrases, noise = {}, set()
        for spelling, means in sorted((fold(r["spelling"]), fold(r["means"] or "").split()) for r in rows if r["spelling"]):
            if not means:
                noise.add(spelling)
            elif len(means) == 1:
                words.setdefault(means[0], []).append(spelling)
            else:
                phrases[spelling] = tuple(means)
        return Aliases(words, phrases, frozenset(noise))


POINT_ALIASES = Aliases(POINT_WORDS, POINT_PHRASES, POINT_NOISE)
#: Resolvers of this process with what they have resolved, by what they were made of: a Python worker keeps them from task to task.
_RESOLVERS: dict[int, tuple[NameResolver, CodeResolver, dict]] = {}


def shared_resolvers(entries: dict[str, list[tuple[int, str]]], aliases: Aliases) -> tuple[NameResolver, CodeResolver, dict]:
    """The process' resolvers for a reference list; only the latest few lists are kept."""
    key = hash(repr((sorted(entries.items()), sorted(aliases.words.items()), sorted(aliases.phrases.items()), sorted(aliases.noise))))
    if key not in _RESOLVERS:
        if len(_RESOLVERS) > 3:
            _RESOLVERS.clear()
        _RESOLVERS[key] = (NameResolver(entries.get("point_name", []), aliases.words, aliases.phrases, aliases.noise), CodeResolver(entries.get("bearing", [])), {})
    return _RESOLVERS[key]


def map_points(points: DataFrame, reference: DataFrame, aliases: Aliases | DataFrame = POINT_ALIASES) -> DataFrame:
    """Every typed name and designation of ``points`` with the entry it means.

    ``aliases``: how names are typed, as such or as a table (spelling, means).

    Columns record_num, slot, typed, ref_id; ref_id 0 where no entry, or more than
    one equally, is meant. Null and blank values don't come out; repeated rows come
    out as often as they are there; an empty reference list maps all to 0.
    """
    entries = reference_entries(reference)
    if isinstance(aliases, DataFrame):
        aliases = Aliases.read(aliases)

    def resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, codes, seen = shared_resolvers(entries, aliases)
        for batch in batches:
            refs = []
            for slot, typed in zip(batch["slot"], batch["typed"], strict=True):
                key = (slot == 0, typed)
                ref = seen.get(key)
                if ref is None:
                    ref = (names if slot == 0 else codes).resolve(typed)
                    if len(seen) < REMEMBERED and len(typed) < 1000:
                        seen[key] = ref
                refs.append(ref)
            yield batch.assign(ref_id=pd.Series(refs, dtype="int64", index=batch.index))

    return typed_values(points).mapInPandas(resolve, "record_num long, slot int, typed string, ref_id long")
