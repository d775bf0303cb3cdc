"""Reading of typed measurement units by dynamic programming over tries.

A unit string is cut into prefixes, roots, exponents, separators and qualifiers.
Every cut is scored; ambiguous cuts ("mil" the length against "mil-" the prefix,
"gs" the plural against grams times seconds) are settled by the scores and by the
dimensions that the field can have at all.
"""

from __future__ import annotations

import math
import unicodedata
from dataclasses import dataclass, field

#: Dimensions are exponents of (length, time).
LENGTH, TIME, ACCELERATION = (1, 0), (0, 1), (1, -2)
NONE = (0, 0)

#: spelling -> factor. Fixed values of the metric system.
PREFIXES = {"m": 1e-3, "mili": 1e-3, "milli": 1e-3, "u": 1e-6, "micro": 1e-6, "c": 1e-2, "centi": 1e-2, "k": 1e3, "kilo": 1e3, "n": 1e-9}

#: spelling -> (dimension, factor in SI, score). 1 in = 0.0254 m, 1 g = 9.80665 m/s2.
ROOTS = {
    **dict.fromkeys(("m", "mt", "mts", "mtr", "metro", "metros", "meter", "meters"), (LENGTH, 1.0, 2.0)),
    **dict.fromkeys(("in", "inch", "inches", "plg", "plgs", "pulg", "pulgs", "pul", "pulgada", "pulgadas", '"'), (LENGTH, 0.0254, 3.0)),
    **dict.fromkeys(("mil", "mils", "milesima", "milesimas", "thou"), (LENGTH, 2.54e-5, 4.0)),
    **dict.fromkeys(("micra", "micras", "micron", "microns", "micrones"), (LENGTH, 1e-6, 5.0)),
    **dict.fromkeys(("s", "sg", "sgs", "seg", "segs", "sec", "secs", "segundo", "segundos", "second", "seconds"), (TIME, 1.0, 2.0)),
    **dict.fromkeys(("g", "g's", "gs", "g-s", "gee", "grav"), (ACCELERATION, 9.80665, 3.0)),
    "ips": ((1, -1), 0.0254, 5.0),
}

#: Words beside a unit that tell how it was detected, not what it is.
QUALIFIERS = ("rms", "pc", "pp", "p-p", "pk", "pk-pk", "0-p", "0p", "pico", "pico-pico", "peak", "eff")
EXPONENTS = {"2": 2, "^2": 2, "**2": 2, "-1": -1, "^-1": -1, "-2": -2, "^-2": -2, "1": 1}


class Trie:
    """Spellings with their values; ``at`` yields every entry that starts at a place."""

    def __init__(self, entries: dict) -> None:
        self.root: dict = {}
        for word, value in entries.items():
            node = self.root
            for ch in word:
                node = node.setdefault(ch, {})
            node[None] = value

    def at(self, text: str, i: int):
        node = self.root
        while True:
            if None in node:
                yield i, node[None]
            if i >= len(text) or text[i] not in node:
                return
            node = node[text[i]]
            i += 1


def fold(text: str) -> str:
    """Lower case, no accents, superscripts as digits, one spelling of micro, dot and quote."""
    text = text.replace("µ", "u").replace("μ", "u").replace("⁻", "-").replace("´", "'").replace("’", "'").replace("`", "'")
    text = unicodedata.normalize("NFKD", text.replace("·", "*").replace("⋅", "*"))
    return "".join(c for c in text if not unicodedata.combining(c)).lower().strip()


@dataclass(frozen=True)
class Cut:
    """A decomposition so far: dimension, SI factor, whether a slash came, score."""

    length: int = 0
    time: int = 0
    factor: float = 1.0
    sign: int = 1
    roots: int = 0
    score: float = 0.0
    joined: bool = True
    #: the cut before and the last piece
    path: tuple = field(default=(), compare=False)

    @property
    def pieces(self) -> list[str]:
        out, path = [], self.path
        while path:
            path, piece = path
            out.append(piece)
        return out[::-1]


_PREFIX, _ROOT, _EXP, _QUAL = Trie(PREFIXES), Trie(ROOTS), Trie(EXPONENTS), Trie({q: q for q in QUALIFIERS})
#: No unit has a base to a higher power, nor a factor further from one. Keeps the states of a place few, so that strings of any length take linear time.
HIGHEST_POWER, FURTHEST = 8, 1e30


def decompositions(text: str) -> list[Cut]:
    """All full cuts of a folded unit string of any length, best first."""
    n = len(text)
    if not n:
        return []
    best: list[dict] = [{} for _ in range(n + 1)]
    furthest = 0

    def put(i: int, cut: Cut) -> None:
        nonlocal furthest
        if max(abs(cut.length), abs(cut.time)) > HIGHEST_POWER or not 1 / FURTHEST < cut.factor < FURTHEST:
            return
        furthest = max(furthest, i)
        key = (cut.length, cut.time, round(math.log(cut.factor), 9), cut.sign, cut.roots > 0, cut.joined)
        old = best[i].get(key)
        if old is None or cut.score > old.score:
            best[i][key] = cut

    put(0, Cut())
    for i in range(n):
        if i > furthest:
            return []
        at, best[i] = best[i], {}
        for cut in at.values():
            ch = text[i]
            if ch in " .":
                put(i + 1, Cut(cut.length, cut.time, cut.factor, cut.sign, cut.roots, cut.score - 0.1, True, cut.path))
            if ch in "[]()" and (i == 0 or i == n - 1):
                put(i + 1, Cut(cut.length, cut.time, cut.factor, cut.sign, cut.roots, cut.score, True, cut.path))
            if ch == "*" and cut.roots:
                put(i + 1, Cut(cut.length, cut.time, cut.factor, cut.sign, cut.roots, cut.score, True, cut.path))
            if ch == "/" and cut.roots and cut.sign > 0:
                put(i + 1, Cut(cut.length, cut.time, cut.factor, -1, cut.roots, cut.score, True, cut.path))
            if cut.roots:
                for j, q in _QUAL.at(text, i):
                    if j > i and cut.joined:
                        put(j, Cut(cut.length, cut.time, cut.factor, cut.sign, cut.roots, cut.score, True, (cut.path, q)))
            if not cut.joined:  # two roots need something between them
                continue
            starts = [(i, 1.0, 0.0, "")]
            for j, factor in _PREFIX.at(text, i):
                if j > i:
                    k = j + 1 if j < n and text[j] == "-" else j
                    starts.append((k, factor, -0.5 - 0.5 * (k > j), text[i:j]))
            for a, scale, cost, prefix in starts:
                for b, (dim, size, worth) in _ROOT.at(text, a):
                    if b == a or (prefix and size not in (1.0, 9.80665)):
                        continue
                    exps = [(b, 1)] + [(c, e) for c, e in _EXP.at(text, b) if c > b]
                    for c, e in exps:
                        p = e * cut.sign
                        put(c, Cut(
                            cut.length + dim[0] * p, cut.time + dim[1] * p, cut.factor * (scale * size) ** p,
                            cut.sign, min(cut.roots + 1, 9), cut.score + worth + cost - 2.0, False, (cut.path, prefix + text[a:c]),
                        ))
    return sorted((c for c in best[n].values() if c.roots), key=lambda c: (-c.score, c.roots))


class UnitReader:
    """Maps typed units to the units of a catalogue.

    ``catalogue``: unit -> quantity. A typed unit means the catalogue unit with the
    same dimension and factor. ``priors`` weighs quantities against each other where
    cuts of different quantities tie.
    """

    def __init__(self, catalogue: dict[str, str], priors: dict[str, float] | None = None) -> None:
        self.priors = priors or {}
        self.units: dict[tuple, str] = {}
        for unit in catalogue:
            cuts = decompositions(fold(unit))
            if not cuts:
                raise ValueError(f"unit of the catalogue that can't be read: {unit!r}")
            self.units[self._key(cuts[0])] = unit
        self.quantity = dict(catalogue)
        self._seen: dict[str, str | None] = {}

    @staticmethod
    def _key(cut: Cut) -> tuple:
        return cut.length, cut.time, round(math.log10(cut.factor), 4)

    def read(self, text: str | None) -> str | None:
        """The catalogue unit that the whole string states, or None."""
        if text is None:
            return None
        if text in self._seen:
            return self._seen[text]
        found = None
        options = [(c.score + self.priors.get(self.quantity[u], 0.0), u) for c in decompositions(fold(text)) if (u := self.units.get(self._key(c)))]
        if options:
            found = max(options, key=lambda x: x[0])[1]
        if len(text) < 1000 and len(self._seen) < 100_000:  # remembered
            self._seen[text] = found
        return found

    def find(self, text: str | None, span: int = 4) -> str | None:
        """The unit stated by words within a free text: the longest run of words that is one.

        Of several longest runs the last counts. None without any.
        """
        if not text:
            return None
        words = text.replace("[", " ").replace("]", " ").replace("(", " ").replace(")", " ").split()
        for size in range(min(span, len(words)), 0, -1):
            for i in range(len(words) - size, -1, -1):
                if unit := self.read(" ".join(words[i : i + size])):
                    return unit
        return None
