"""Encoding of a corpus with a public byte-level tokenizer.

Method: prefix dynamic programming. For each prefix of a piece's bytes exactly one
token can be the last of its encoding; it is stored, and the encoding is read off
backwards. A prefix's last token doesn't depend on what follows, so texts can be
appended to, and edited, with re-encoding of the pieces near the change only.

Defined cases: null and empty texts have an empty list of ids, a blank text the ids of
its blanks. No special tokens are used; their strings in a text are ordinary text.

Scale: one narrow pass over whole texts, no shuffle. Vocabulary files are read from a
path that every executor has; tables are built once per Python worker, pieces already
encoded are remembered up to a bound.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Where vocabulary files lie, unless a path is given.
VOCABULARIES = os.environ.get("TREMOR_TOKENIZERS", "/opt/tokenizers")
DEFAULT = "byte_bpe_50k.tiktoken"
#: How byte-level vocabularies of this family cut a text into pieces. Fixed value.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED = 300_000


class PrefixEncoder:
    """Byte-pair encoder that works by last tokens of prefixes.

    ``ranks``: token bytes -> id, where a lower id merges first and every byte is a
    token.
    """

    def __init__(self, ranks: dict[bytes, int], pieces: str = PIECES) -> None:
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.pieces = regex.compile(pieces)
        #: length of the longest token that ends with each byte
        self.longest = [0] * 256
        for token in ranks:
            self.longest[token[-1]] = max(self.longest[token[-1]], len(token))
        self.halves: dict[int, tuple[int, int]] = {}
        self.merges: dict[tuple[int, int], int] = {}
        for token, i in ranks.items():
            if len(token) > 1 and (pair := self._halves(token, i)):
                self.halves[i] = pair
                self.merges[pair] = i
        self._compatible: dict[tuple[int, int], bool] = {}
        self._known: dict[str, list[int]] = {}

    def _halves(self, token: bytes, below: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``, found by merging with lower ids only."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = below, -1
            for k in range(len(parts) - 1):
                r = self.ranks.get(parts[k] + parts[k + 1], below)
                if r < best:
                    best, at = r, k
            if at < 0:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def compatible(self, a: int, b: int) -> bool:
        """Whether encoding the bytes of ``a`` then ``b`` gives just these two tokens.

        Undoes the merges of both, latest first, and asks at each step whether the
        tokens that then touch would have merged across the border earlier.
        """
        key = (a, b)
        known = self._compatible.get(key)
        if known is not None:
            return known
        right, left = a, b  # what touches the border from either side
        bound = float("inf")
        good = True
        while True:
            across = self.merges.get((right, left))
            if across is not None and across < bound:
                good = False
                break
            # the later of the two merges is undone; of equal ones that on the right hand
            whole_a, whole_b = right not in self.halves, left not in self.halves
            if whole_a and whole_b:
                break
            if not whole_a and (whole_b or right > left):
                bound, right = right, self.halves[right][1]
            else:
                bound, left = left + 1, self.halves[left][0]
        if len(self._compatible) < 4 * REMEMBERED:
            self._compatible[key] = good
        return good

    def last_tokens(self, data: bytes, last: list[int] | None = None) -> list[int]:
        """For each prefix of ``data`` the last token of its encoding; goes on from ``last`` if given."""
        last = [] if last is None else last
        ranks = self.ranks
        for end in range(len(last) + 1, len(data) + 1):
            for start in range(max(0, end - self.longest[data[end - 1]]), end):
                token = ranks.get(data[start:end])
                if token is not None and (start == 0 or self.compatible(last[start - 1], token)):
                    if start == 0 and len(data[:end]) > 1 and token not in self.halves:
                        continue
                    last.append(token)
                    break
        return last

    def piece(self, data: bytes) -> list[int]:
        """Ids of one piece, read off its last tokens from the end."""
        whole = self.ranks.get(data)
        if whole is not None and (len(data) == 1 or whole in self.halves):
            return [whole]
        last, at, ids = self.last_tokens(data), len(data), []
        while at:
            ids.append(last[at - 1])
            at -= len(self.tokens[last[at - 1]])
        return ids[::-1]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; none for null and empty ones."""
        if not text:
            return []
        known, out = self._known, []
        for p in self.pieces.findall(text):
            ids = known.get(p)
            if ids is None:
                ids = self.piece(p.encode("utf-8"))
                if len(known) < REMEMBERED:
                    known[p] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.tokens[i] for i in ids).decode("utf-8", errors="replace")


class EncodedText:
    """A text with its ids that can be appended to and edited exactly.

    Only pieces near a change are encoded anew: from the piece before the change on
    until the pieces are those of the old text again.
    """

    def __init__(self, encoder: PrefixEncoder, text: str = "") -> None:
        self.encoder = encoder
        self.text = text
        self._pieces = [(m.start(), m.end()) for m in encoder.pieces.finditer(text)]
        self._ids = [encoder.piece(text[a:b].encode("utf-8")) for a, b in self._pieces]

    @property
    def ids(self) -> list[int]:
        return [i for ids in self._ids for i in ids]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in the place of text[start:end]."""
        shift = len(new) - (end - start)
        text = self.text[:start] + new + self.text[end:]
        # pieces look one character ahead, white space runs to its end
        keep = 0
        while keep < len(self._pieces) and self._pieces[keep][1] < start:
            keep += 1
        keep = max(0, keep - 1)
        at = self._pieces[keep][0] if keep < len(self._pieces) else (self._pieces[-1][1] if self._pieces else 0)
        at = min(at, start)
        old = {a + shift: i for i, (a, _) in enumerate(self._pieces) if a >= end}
        pieces, ids = self._pieces[:keep], self._ids[:keep]
        for m in self.encoder.pieces.finditer(text, at):
            i = old.get(m.start())
            if i is not None and m.start() > start + len(new) and self._pieces[i][1] + shift == m.end():
                pieces += [(a + shift, b + shift) for a, b in self._pieces[i:]]
                ids += self._ids[i:]
                break
            pieces.append((m.start(), m.end()))
            ids.append(self.encoder.piece(m.group().encode("utf-8")))
        self.text, self._pieces, self._ids = text, pieces, ids


@lru_cache(maxsize=4)
def encoder(path: str = DEFAULT) -> PrefixEncoder:
    """The encoder of a vocabulary file of ranks; once per process. A bare name lies in the vocabularies' folder."""
    with open(path if os.path.sep in path else os.path.join(VOCABULARIES, path), "rb") as lines:
        return PrefixEncoder({base64.b64decode(t): int(i) for t, i in (line.split() for line in lines if line.strip())})


def encode_documents(documents: DataFrame, path: str = DEFAULT) -> DataFrame:
    """(doc_id, ids) of every document, null and empty texts included."""
    return _encoded(documents.select("doc_id", "text"), path)


def _encoded(texts: DataFrame, path: str) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            ids = [enc.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(ids, pa.list_(pa.int32()))], schema=schema)

    return texts.mapInArrow(encode, "doc_id long, ids array<int>")


def count_tokens(documents: DataFrame, path: str = DEFAULT) -> DataFrame:
    """(doc_id, source, n_tokens) of every document; the ids themselves don't leave the worker."""
    schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("n_tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            n = [len(enc.encode(t)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), pa.array(n, pa.int64())], schema=schema)

    return documents.select("doc_id", "source", "text").mapInArrow(count, "doc_id long, source string, n_tokens long")
