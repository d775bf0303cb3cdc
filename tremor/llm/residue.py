"""Template residue, padding and messages that stand where a report should be.

Method: near-duplicates among the documents' cores are found with partitioned SimHash
tables and verified by Hamming distance and by the Jaccard similarity of their
five-word shingles; residue labels that are trusted from a text itself are propagated
through the connected components; an exact check of each document's own text follows.

The core of a document is its text without header lines, navigation, mark-up, ids and
decoration, with figures and template fields replaced by one sign. Documents of one
core are one node of the graph.

The hashes of two texts of Jaccard 0.8 differ in nine or ten of 64 bits on average, so
tables of near hashes alone lose most such links. Therefore a second pass joins on the
rarest shingles of each core, where every pair of the similarity must meet, and looks
only between components that the tables left apart. Together they give exactly the
components of all pairs of Jaccard 0.8. Only components with a labelled text come out,
so the second pass starts at these and goes on from what it reaches.

Scale: one narrow pass reads every whole text and keeps a core, a SimHash and flags;
cores that can be residue at all (they hold a field, or less than two whole sentences
of measured content) go on, once per class with a map-side combine. A table is the
hashes in the order of a rotation, cut by their first bits; each hash meets its next
neighbours only, so candidates grow in proportion to the classes, however alike they
are. In the second pass a cluster of near copies is one component and makes no pairs,
texts that no label can reach make none among themselves, and of the pairs that share
a shingle only those go on to the check whose sketches differ in no more bits than
the similarity allows for shingles.
Links are stored, components and labels stay distributed.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremor.session import checkpoint

SHINGLE = 5
SIMILARITY = 0.8
HAMMING = 6
#: Tables (rotations of the hash by a byte each) and the neighbours that a hash meets in each.
TABLES, NEIGHBOURS = 8, 4
#: 64-bit words of a sketch.
SKETCH = 4

_ASK = (
    r"tbd|to ?do|fill in|insert(?:ar)?|enter|complete|por completar|completar|rellenar|à compl[ée]ter|compl[ée]ter|remplir|ins[ée]rer|saisir"
    r"|auszuf[üu]llen|ausf[üu]llen|einf[üu]gen|eintragen|preencher|inserir|a preencher"
)
_NAME = r"[A-Za-z_][\w.]*"
#: Ways to write a template field.
FIELD = re.compile(
    rf"\{{\{{\s*{_NAME}\s*\}}\}}|\$\{{\s*{_NAME}\s*\}}|<%=?\s*{_NAME}\s*%>|\{{%\s*{_NAME}\s*%\}}|<<\s*{_NAME}\s*>>|«{_NAME}»"
    rf"|%[A-Z][A-Z_]{{2,}}%|#[A-Z][A-Z_]{{2,}}#|@@\w+@@|__[A-Z][A-Z_]*__|\{{{_NAME}\}}|\[[A-Z][A-Z_]{{2,}}\]"
    rf"|\[(?:{_ASK})\b[^\]\n]{{0,40}}\]|<(?:{_ASK})\b[^>\n]{{0,40}}>|<(?!/?(?:html|head|title|body|noscript|script|pre|p|h[1-6]|div|span|table|br|hr|tr|td|th|ul|ol|li|img|strong|em|b|i|a)\b){_NAME}>"
    r"|\[object Object\]|\bundefined\b|_{4,}|\bXX/XX/XXXX\b|(?<=[^\s]: )(?:None|null|NaN)(?=\s*(?:$|\n))",
    re.MULTILINE | re.IGNORECASE,
)
_STRICT = re.compile(r"^(?:%[A-Z_]+%|#[A-Z_]+#|__[A-Z_]+__|\[[A-Z_]+\]|(?:None|null|NaN)|XX/XX/XXXX)$")
#: A prompt of an empty form.
PROMPT = re.compile(
    r"(?:escriba aqu[íi]|haga clic para a[ñn]adir|saisir .{0,30} ici\b|cliquez pour ajouter|hier eingeben|klicken, um|(?:enter|type|write) .{0,30} here\b"
    r"|click to add|(?:digite|escreva|insira) aqui|clique para (?:adicionar|inserir))",
    re.I,
)
#: Sentences that speak of a template or its fields instead of leaving one unfilled.
SPEAKS = re.compile(
    r"plantilla|template|\bmod[eè]le\b|\bmodelo\b|\bvorlage\b|"
    r"^\W*(?:\d\d:\d\d\W+)?(?:replace|sustituya|reemplace|remplacez|ersetzen sie|substitua|troque)\s+□",
    re.I,
)
_HEAD = re.compile(r"^\s*[^\W\d][\w /.]{1,24}:\s+\S[^!?]{0,48}(?<![.!?])$")
_TITLE = re.compile(r"^\s*[^\W\d][^.!?:|]{4,40}(?:\s\d{1,5}/\d\d)?\s*$")
_NAVIGATION = re.compile(r"^\s*(?:[\w ]{3,20}\|)+[\w ]{3,20}\s*$|^\s*©.*$|^\s*(?:volver al inicio|back to home|retour .{0,20}|zur(?:ü|u)ck .{0,20}|voltar .{0,20})\s*$", re.I)
_GREETING = re.compile(r"^\W*(?:buenos d[íi]as|hola|bonjour|hello all|hello|hi|ol[áa]|bom dia|guten tag|hallo|saludos|cordialement|regards|gr[üu][ßs]e|atenciosamente|an-\d+)\W*$", re.I)
_TAG = re.compile(r"</?(?:html|head|title|body|h\d|noscript|script|pre|p|div|span|br)\b[^<>]*>", re.I)

#: What servers, viewers and browsers say: of failure and of scripts (strong), and what they say beside it (weak).
STRONG = re.compile(
    r"\berror\b|\berreur\b|\bfehler|\berro\b|\bfalhou\b|abgebrochen|fall[óo] por|\bfailed\b|[ée]chou[ée]|exit code|\bcode de sortie|returned by|too old|demasiado antiguo|trop ancien|zu alt|muito antigo|\bserver\b|\bservidor\b|\bserveur\b|\bsess?i[oó]n\b|\bsession\b|\bsitzung\b|\bsess[ãa]o\b|\bpermis|\bautoris|berechtigung"
    r"|disponib|available|verf[üu]gbar|erreichbar|indispon|timed out|time-?out|tiempo de espera|d[ée]lai d|zeit[üu]berschreitung|tempo limite|tempo esgotado"
    r"|not found|be found|introuvable|encontrad|gefunden|no existe|n'existe|existiert nicht|n[ãa]o existe|rendered|podido generar|podido mostrar|g[ée]n[ée]r[ée]|erstellt werden"
    r"|p[ôo]de ser ger|javascript|\bscripts?\b|scripting|skript|cookies|browser|navegador|navigateur|maintenance|mantenimiento|\bwartung|manuten[çc][ãa]o"
    r"|stack dumped|traceback|exception|keyerror|gateway|\bhttp\b|\bpanic\b|segmentation fault|core dumped|cannot open|internal|request (?:failed|timed)|acc[eè]s refus|access denied|denegado|verweigert|negado|expir|caducad|abgelaufen",
    re.I,
)
WEAK = re.compile(
    r"administra|try again|r[ée]essay|erneut|int[ée]ntelo|vuelva a|tente (?:de )?nova|sign in|log ?in|anmelden|inicie|reconnect|fa[çc]a login|direcci[óo]n\b|\baddress\b|\badresse\b|endere[çc]o"
    r"|\bloading\b|cargando|chargement|wird geladen|\bladen\b|carregando|\boops\b|\bsorry\b|\bvaya\b|hoppla|ups\b|d[ée]sol[ée]|desculp|request id|\bref\b|\bproxy\b|reload|recarg|recharg|recarreg"
    r"|\bfile \"|^\s*value =|status|checking|compatib|comprobando|v[ée]rification|verificando|gepr[üu]ft|novamente|mais tarde|plus tard|m[áa]s tarde|\blater\b|sp[äa]ter",
    re.I,
)
#: Measured content, in lower case: a figure with a unit, a bearing or a finding's vocabulary rules a message out.
MEASURED = re.compile(
    r"\d\s*(?:mm/s|in/s|µm|um\b|g\b|g's|g-s|hz|khz|rpm|tr/min|1/min|°?c\b|%|x\b)|\b(?:mm/s|in/s|µm|rpm)\b"
    r"|espectro|spectrum|spectre|espektrum|rodamiento|bearing|roulement|\blager|rolamento|vibraci|vibration|schwing|vibra[çc]|impact|ruta\b|route\b|tourn[ée]e|\brunde\b|\brota\b"
    r"|colector|collector|lecturas|readings|messstelle|medid|measure|mesur|gemessen|medi[çc]",
)
_FILLER = re.compile(
    r"^(?:lorem|ipsum|dolor|amet|sit|consec|adipisc|elit|curabit|vestib|velit|pelle|orna|sedi?$|tristi|tempus|nullam|quisq|aliqu|molli|porta|luct|ferment|massa|vagor|eget|integer|magna|vivam|donec|morbi|sapien)",
    re.I,
)
_SAMPLE = re.compile(r"texto? de (?:exemplo|ejemplo|prueba|teste)|sample text|dummy text|texte d.?exemple|exemple de texte|(?:beispiel|muster|blind|platzhalter)text|\bprobando\b|\btesting\b|placeholder", re.I)
_WORD = re.compile(r"[^\W\d_]+", re.UNICODE)
#: What a field may begin with; most texts have none of it.
_MAY_MARK = re.compile(r"[{<«]|\$\{|%[A-Z]|#[A-Z]|@@|__|\[[A-Za-zà]|undefined|XX/XX|: (?:None|null|NaN)\b", re.I)
#: Characters and, in lower case, words of which every such beginning has one, which is sooner seen.
_MARK_CHARACTERS, _MARK_WORDS = "{<«$#@_[ıİſ", ("undefined", "xx/xx", ": none", ": null", ": nan")
_PERCENT = re.compile(r"%[^\W\d_]")
#: Lines of a stack dump.
_TRACE = re.compile(r"^\s*(?:unhandled exception\b|traceback \(|caused by:|at [\w.$]+\(|file \"[^\"]+\", line \d|[\w.]+ = \w|\w*(?:error|exception): )", re.I)
_HIDDEN = re.compile("[\u200b\u200c\u200d\u2060\ufeff\u00ad]")
_SENTENCE_END = re.compile(r"(?<=[.!?])(?=\s)|\n")
_FIGURE = re.compile(r"\d+(?:[.,]\d+)*")
_HEX = re.compile(r"\b(?=[0-9a-f]*\d)(?=[0-9]*[a-f])[0-9a-f]{7,}\b")
#: Ids and marks beside a message, and letters of other scripts, that say nothing here.
_BESIDE = re.compile(r"\(\s*ref\b[^()\n]*\)|\(code \d+\)|\brequest id:? \w+|[\u2e80-\u9fff\uac00-\ud7af\u3040-\u30ff\uff00-\uffef]+", re.I)
#: Parts of every prompt, looked for first.
_PROMPT_PARTS = ("aqu", "clic", "klick", "here", " ici", "hier ein")


def tidy(text: str) -> str:
    """One form of equal characters, without hidden ones, and UTF-8 that was read as Latin read anew."""
    if text.isascii():
        return text
    if "Ã" in text or "Â" in text or "â€" in text:
        for encoding in ("cp1252", "latin-1"):
            try:
                text = text.encode(encoding).decode("utf-8")
                break
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
    return _HIDDEN.sub("", unicodedata.normalize("NFKC", text))


def fields_of(text: str) -> list[re.Match]:
    """Template fields in a text; upper-case forms count only in upper case, JSON braces don't count."""
    out = []
    for m in FIELD.finditer(text):
        s = m.group(0)
        if s[0] in "%#_[" and not _STRICT.match(s) and not re.match(rf"^\[(?:{_ASK})\b|^\[object Object\]$|^_+$", s, re.I):
            continue
        if s.lower() in ("none", "null", "nan") and not _STRICT.match(s):
            continue
        out.append(m)
    return out


def is_dump(text: str) -> bool:
    """Whether a text is a machine-readable dump (JSON objects or lists with several keys)."""
    head = text.lstrip("\ufeff \t\r\n")[:1]
    return head in ("{", "[") and len(re.findall(r'"[\w ]+"\s*:', text)) > 3


def is_padding(text: str) -> bool:
    """Whether a whole core is filler: repeated marks, filler Latin, sample text or struck keys."""
    words = [w.lower() for w in _WORD.findall(text)]
    if not words:
        return False
    if len(set(words)) <= 8 and _SAMPLE.search(text):
        return True
    if len(words) >= 4 and len(set(words)) == 1 or len(words) >= 6 and len(set(words)) <= max(2, len(words) // 12):
        return True
    if len(words) >= 4 and sum(1 for w in words if _FILLER.match(w)) >= 0.6 * len(words):
        return True
    letters = "".join(words)
    home = sum(1 for c in letters if c in "asdfghjklñ")
    return len(letters) >= 12 and home >= 0.97 * len(letters) and len(set(words)) > 1


def read_document(text: str) -> tuple[str, str | None, bool]:
    """(core, trusted label, whether it can be residue) of one text.

    Labels: ``field`` an unfilled field or prompt in any sentence that doesn't speak
    of templates; ``padding`` the whole core is filler; ``message`` every sentence of
    the core is what a server, viewer or browser says and one says it plainly.
    """
    text = tidy(text)
    dump = is_dump(text)
    low = text.lower()
    may_mark = any(c in text for c in _MARK_CHARACTERS) or any(w in low for w in _MARK_WORDS) or bool(_PERCENT.search(text))
    marks = fields_of(text) if may_mark and not dump and _MAY_MARK.search(text) else []
    asks = any(p in low for p in _PROMPT_PARTS) and bool(PROMPT.search(text))
    if not marks and not asks:
        measured = 0
        for x in _SENTENCE_END.split(low):
            if x.endswith((".", "!", "?")) and MEASURED.search(x):
                measured += 1
                if measured > 1:
                    return "", None, False  # whole sentences of measured content: no message, no padding
    out, at = [], 0
    for m in marks:
        out.append(text[at : m.start()] + "□")
        at = m.end()
    text = "".join(out) + text[at:]
    text = _HEX.sub("#", text)
    page = bool(re.search(r"<title>\s*[45]\d\d\s*</title>", text, re.I))  # a server's own error page
    text = _BESIDE.sub(" ", re.sub(r"<\|\w+\|>", "\n", _TAG.sub("\n", text)))
    lines = [x for x in re.split(r"[\r\n]+", text) if x.strip()]
    field, trace = False, 0
    sentences: list[str] = []
    for i, line in enumerate(lines):
        if _TRACE.match(line):
            trace += 1
            sentences.append("exception")
            continue
        parts = [p for p in re.split(r"(?<=[.!?…])\s+", line) if p.strip()]
        for p in parts:
            if ("□" in p and not SPEAKS.search(p)) or (asks and PROMPT.search(p) and not SPEAKS.search(p)):
                field = True
        if _NAVIGATION.match(line) or _GREETING.match(line):
            continue
        if _HEAD.match(line) and not STRONG.search(line):
            continue
        if i == 0 and len(lines) > 1 and _TITLE.match(line) and not STRONG.search(line) and not WEAK.search(line):
            continue
        sentences += parts
    plain = [re.sub(r"[^\w\s□'’.,:;/%°\"-]+", " ", s) for s in sentences]
    plain = [s for s in plain if re.search(r"[^\W_]|□", s)]
    core = " ".join(plain)
    # a table repeats its words, but not its figures
    varied = len(set(_FIGURE.findall(core))) > max(2, len(core.split()) // 12)
    core = re.sub(r"\b(?=\w*\d)(?=\w*[a-z])[0-9a-f]{6,}\b", "#", core.lower())
    core = re.sub(r"\d+(?:[.,:/-]\d+)*", "#", core)
    core = " ".join(re.findall(r"[^\W_]+|[#□]", core))
    if field:
        return core, "field", True
    if dump or not core:
        return core, None, False
    if trace:
        plain = [p for p in plain if p != "exception"]
    if not trace and not varied and is_padding(core):
        return core, "padding", True
    # a text that broke off at once: one unfinished sentence, then the message
    if len(plain) + (trace > 1) > 1 and not plain[0].rstrip().endswith((".", "!", "?", ":", ";")) and not STRONG.search(plain[0]) and (trace > 1 or STRONG.search(" ".join(plain[1:3]))):
        plain = plain[1:]
    strong, weak = int(trace > 1 or page), 0
    for s in plain:
        measured = bool(MEASURED.search(s.lower()))
        if measured and (len(plain) > 1 or re.search(r"\d", s)):
            return core, None, False
        told = bool(STRONG.search(s))
        if measured and not told:
            return core, None, False
        if told:
            strong += 1
        elif WEAK.search(s) or not _WORD.search(s):
            weak += 1
        else:
            return core, None, True
    return core, "message" if strong else None, True


def shingles(core: str) -> set[tuple]:
    """Five-word shingles of a core; a shorter core is one shingle."""
    words = core.split()
    return {tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(cores: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(place of its core, 64-bit hash) of each five-word shingle of each core, in order and with repeats."""
    words, sizes = [], []
    for c in cores:
        w = c.split() or [""]
        words += w
        sizes.append(len(w))
    if not sizes:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = pd.util.hash_array(np.array(words, dtype=object), categorize=True)
    size = np.array(sizes)
    doc = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
    mixed = np.zeros(len(h), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(SHINGLE):
            rolled = np.zeros(len(h), np.uint64)
            rolled[: max(len(h) - k, 0)] = h[k:]
            inside = place + k < np.repeat(size, size)
            mixed = mixed * np.uint64(0x100000001B3) + np.where(inside, rolled, np.uint64(0))
        mixed = _mix(mixed)
    starts = (place + SHINGLE <= np.repeat(size, size)) | (place == 0)
    return doc[starts], mixed[starts]


def simhashes(cores: list[str]) -> np.ndarray:
    """64-bit SimHash of each core over its five-word shingles."""
    if not len(cores):
        return np.zeros(0, np.int64)
    doc, mixed = shingle_hashes(cores)
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    n = np.diff(np.r_[first, len(doc)])
    out = np.zeros(len(cores), np.uint64)
    for b in range(64):
        ones = np.add.reduceat(((mixed >> np.uint64(b)) & np.uint64(1)).astype(np.int64), first)
        out |= (2 * ones > n).astype(np.uint64) << np.uint64(b)
    return out.view(np.int64)


def read_documents(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, core, label, sim) of the documents that can be residue.

    Null, empty and blank texts, rows without an id and texts of content throughout
    don't come out.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, cores = [], []
            for doc_id, text_hash, text in zip(b["doc_id"], b["text_hash"], b["text"], strict=True):
                core, label, may = read_document(text)
                if may:
                    rows.append((doc_id, text_hash, label))
                    cores.append(core)
            ids, hashes, labels = zip(*rows, strict=True) if rows else ((), (), ())
            yield pd.DataFrame({"doc_id": pd.Series(ids, dtype="int64"), "text_hash": pd.Series(hashes, dtype="int64"), "core": pd.Series(cores, dtype=object),
                                "label": pd.Series(labels, dtype=object), "sim": simhashes(cores)})

    texts = documents.where(F.col("doc_id").isNotNull() & F.col("text").rlike(r"\S")).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return texts.mapInPandas(read, "doc_id long, text_hash long, core string, label string, sim long")


def table_pairs(classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes that are neighbours in a SimHash table and at most ``HAMMING`` bits apart.

    A table is a rotation of the hashes by whole bytes, cut by its first two bytes and
    sorted; every hash meets its next ``NEIGHBOURS``.
    """
    rotated = lambda k: F.shiftleft("sim", 8 * k).bitwiseOR(F.shiftrightunsigned("sim", 64 - 8 * k)) if k else F.col("sim")
    tables = classes.select("class", "sim", F.posexplode(F.array(*[rotated(k) for k in range(TABLES)])).alias("table", "turned"))
    w = Window.partitionBy("table", F.shiftrightunsigned("turned", 48)).orderBy("turned", "class")
    after = F.collect_list(F.struct("class", "sim")).over(w.rowsBetween(1, NEIGHBOURS))
    met = tables.withColumn("after", after).select("class", "sim", F.explode("after").alias("o")).where(F.bit_count(F.col("sim").bitwiseXOR(F.col("o.sim"))) <= HAMMING)
    return met.select(F.least("class", "o.class").alias("a"), F.greatest("class", "o.class").alias("b")).distinct()


def sketches(doc: np.ndarray, s: np.ndarray, n: int) -> np.ndarray:
    """``SKETCH`` words for each of n cores, given its distinct shingles: each turns one bit, so two sketches differ in no more bits than the cores in shingles."""
    bit = _mix(s ^ np.uint64(0x9E3779B97F4A7C15)) % np.uint64(64 * SKETCH)
    out = np.zeros((n, SKETCH), np.uint64)
    np.bitwise_xor.at(out, (doc, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
    return out.view(np.int64)


def shingle_sets(classes: DataFrame) -> DataFrame:
    """(class, s, sketch): the hashes of each class's distinct shingles, and their sketch."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            doc, s = shingle_hashes(list(b["core"]))
            order = np.lexsort((s, doc))
            doc, s = doc[order], s[order]
            new = np.r_[True, (doc[1:] != doc[:-1]) | (s[1:] != s[:-1])][: len(s)]
            doc, s = doc[new], s[new]
            each = np.split(s.view(np.int64), np.cumsum(np.bincount(doc, minlength=len(b)))[:-1]) if len(b) else []
            yield pd.DataFrame({"class": b["class"], "s": pd.Series(each, dtype=object, index=b.index), "sketch": pd.Series(list(sketches(doc, s, len(b))), dtype=object, index=b.index)})

    return classes.select("class", "core").mapInPandas(sets, "class long, s array<long>, sketch array<long>")


def rare_keys(sets: DataFrame) -> DataFrame:
    """(class, s, n, least): the rarest shingles of each class, of which two alike classes must share one.

    Of n shingles alike texts share SIMILARITY * n at least, so one of the
    n - SIMILARITY * n + 1 first in any order that holds for all; here the rarest first.
    Shingles of one class alone are no keys.
    """
    each = sets.select("class", F.size("s").alias("n"), F.explode("s").alias("s"))
    often = each.groupBy("s").agg(F.count("*").alias("k"))
    least = F.ceil(F.lit(SIMILARITY) * F.col("n") - 1e-6)
    return (
        each.join(often, "s")
        .withColumn("_r", F.row_number().over(Window.partitionBy("class").orderBy("k", "s")))
        .where((F.col("_r") <= F.col("n") - least + 1) & (F.col("k") > 1))
        .select("class", "s", "n", least.alias("least"))
    )


def rare_pairs(keys: DataFrame, member: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes of different components that can be alike by a rare shingle, their sizes and their sketches; a or b is in the front.

    ``member`` has (class, component, sketch, front). A key that only one component has,
    or nothing in the front, makes no pairs. Alike sets of a and b shingles differ in
    (a + b) * (1 - SIMILARITY) / (1 + SIMILARITY) of them at most.
    """
    keyed = keys.join(member, "class")
    several = keyed.groupBy("s").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"), F.max("front").alias("_front")).where("_lo <> _hi and _front").select("s")
    rows = keyed.join(several, "s", "left_semi").select("class", "component", "s", "n", "least", "front", *[F.col("sketch")[k].alias(f"w{k}") for k in range(SKETCH)])
    a, b = rows.where("front").alias("a"), rows.alias("b")
    sizes = (F.col("a.n") >= F.col("b.least")) & (F.col("b.n") >= F.col("a.least"))
    apart = (F.col("a.component") != F.col("b.component")) & (~F.col("b.front") | (F.col("a.class") < F.col("b.class")))
    differ = sum(F.bit_count(F.col(f"a.w{k}").bitwiseXOR(F.col(f"b.w{k}"))) for k in range(SKETCH))
    near = differ <= F.floor((F.col("a.n") + F.col("b.n")) * (1 - SIMILARITY) / (1 + SIMILARITY) + 1e-6)
    return (
        a.join(b, (F.col("a.s") == F.col("b.s")) & apart & sizes & near)
        .select(F.least("a.class", "b.class").alias("a"), F.greatest("a.class", "b.class").alias("b"))
        .distinct()
    )


def alike_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose five-word shingles have the similarity."""

    @F.pandas_udf("boolean")
    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y, strict=True):
            s, t = shingles(p), shingles(q)
            out.append(len(s & t) >= SIMILARITY * len(s | t))
        return pd.Series(out, dtype=bool)

    text = classes.select("class", "core")
    return (
        pairs.join(text.withColumnRenamed("class", "a").withColumnRenamed("core", "x"), "a")
        .join(text.withColumnRenamed("class", "b").withColumnRenamed("core", "y"), "b")
        .where(alike("x", "y"))
        .select("a", "b")
    )


def near_components(classes: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(class, component): the components of all pairs of classes of the similarity.

    With ``wanted`` (class) only the components that hold one of these are sure to be
    whole: pairs are sought from the components with a wanted class, then from those
    that were reached, until no more are.
    """
    tables = checkpoint(alike_pairs(table_pairs(classes), classes))
    first = components(classes, tables)
    sets = checkpoint(shingle_sets(classes))
    keys = checkpoint(rare_keys(sets))
    rest = first.join(sets.select("class", "sketch"), "class")
    front = first.select("component") if wanted is None else first.join(wanted, "class", "left_semi").select("component")
    front = front.distinct().withColumn("front", F.lit(True))
    links, several = tables, False
    while True:
        # what was in front before has met all of the rest
        rest = checkpoint(rest.join(front, "component", "left").withColumn("front", F.coalesce("front", F.lit(False))))
        found = checkpoint(alike_pairs(rare_pairs(keys, rest), classes))
        if found.isEmpty():
            break
        links, several = links.unionByName(found), True
        rest = rest.where("not front").drop("front")
        ends = found.select(F.explode(F.array("a", "b")).alias("class"))
        front = checkpoint(rest.join(ends, "class", "left_semi").select("component").distinct().withColumn("front", F.lit(True)))
        if front.isEmpty():
            break
    return components(classes, links) if several else first


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(class, component) by spreading the least id over links, with pointer jumping, until nothing changes."""
    both = checkpoint(links.union(links.select("b", "a")).toDF("a", "b"))
    label = checkpoint(nodes.select("class", F.col("class").alias("component")))
    if both.isEmpty():
        return label
    while True:
        around = (
            both.join(label.withColumnRenamed("class", "b"), "b").groupBy(F.col("a").alias("class")).agg(F.min("component").alias("near"))
        )
        step = label.join(around, "class", "left").select("class", "component", F.least("component", F.coalesce("near", "component")).alias("new"))
        jump = step.select(F.col("class").alias("new"), F.col("new").alias("far"))
        nxt = checkpoint(
            step.join(jump, "new", "left").select("class", F.col("component").alias("old"), F.least("new", F.coalesce("far", "new")).alias("component"))
        )
        label = nxt.select("class", "component")
        if nxt.where("old <> component").isEmpty():
            return label


def residue_documents(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, reason, component, via) of each document that is residue.

    ``via`` tells how the label came: ``text`` from what the text itself says, ``copy``
    or ``link`` from its component, where a copy has the core of a trusted text and a
    link leads to one.

    Defined cases: null, empty and blank texts are none; repeated doc_ids come out
    once per row of residue; a document that only speaks of templates or errors
    within real content is none; dumps are none.
    """
    read = checkpoint(read_documents(documents).withColumn("class", F.xxhash64("core")))  # every text is read once
    whole = F.max(F.when(F.col("label") != "field", F.col("label")))
    classes = checkpoint(read.groupBy("class").agg(F.max("core").alias("core"), F.max("sim").alias("sim"), whole.alias("whole"), F.max("label").isNotNull().alias("labelled")))
    member = near_components(classes, classes.where("labelled").select("class"))
    placed = classes.select("class", "whole").join(member, "class")
    trusted = placed.groupBy("component").agg(F.max("whole").alias("spread"))
    # the exact check: a field must stand in the document itself; a message or padding must be all there is
    return (
        read.select("doc_id", "text_hash", "class", "label")
        .join(placed.join(trusted, "component"), "class")
        .select(
            "doc_id", "text_hash", F.coalesce("label", "spread").alias("reason"), "component",
            F.when(F.col("label").isNotNull(), "text").when(F.col("whole").isNotNull(), "copy").otherwise("link").alias("via"),
        )
        .where(F.col("reason").isNotNull())
    )


def clean_corpus(documents: DataFrame) -> DataFrame:
    """The corpus without its residue, every other document as it is: of a repeated doc_id only the texts that are residue go."""
    found = residue_documents(documents).select("doc_id", F.col("text_hash").alias("_text_hash")).distinct()
    hashed = documents.withColumn("_text_hash", F.xxhash64("text"))
    return hashed.join(found, ["doc_id", "_text_hash"], "left_anti").select(*documents.columns)
