"""Writing of record databases: small files for tests, queries and the bench, record by record.

The counterpart of the record source. Everything is laid out in memory, so this is for
files of up to some hundred megabytes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable
from dataclasses import dataclass, field

RECORD = 512


@dataclass
class Capture:
    """A spectrum of ``lines`` bins, or a waveform of ``lines`` samples, all of one raw value."""

    ts: int
    lines: int
    value: float
    unit: str
    rpm: float = 0.0
    load: float = 0.0
    scale: float = 1.0


@dataclass
class Point:
    name: str
    rpm: float = 0.0
    bearings: list[str] = field(default_factory=list)
    spectra: list[Capture] = field(default_factory=list)
    waves: list[Capture] = field(default_factory=list)
    #: (time, overall, bands) in order of time
    readings: list[tuple[int, float, list[float]]] = field(default_factory=list)
    #: (severity, time, text)
    note: tuple[int, int, str] | None = None
    #: the last spectrum leads back to the first
    cyclic: bool = False


class RecordWriter:
    """Records under construction; a stored pointer is the record's number plus one."""

    def __init__(self) -> None:
        self.records = [bytearray(RECORD) for _ in range(8)]

    def new(self, tag: bytes | None = None) -> int:
        self.records.append(bytearray(RECORD))
        if tag:
            self.records[-1][8:12] = tag
        return len(self.records) - 1

    def put(self, n: int, at: int, fmt: str, *values) -> None:
        struct.pack_into("<" + fmt, self.records[n], at, *values)

    def point_to(self, n: int, at: int, target: int) -> None:
        self.put(n, at, "I", target + 1)

    def text(self, n: int, at: int, s: str, size: int) -> None:
        self.records[n][at : at + size] = s.encode("cp1252").ljust(size, b" ")[:size]

    def chain(self, tag: bytes, count: int, link_at: int) -> list[int]:
        """Records of one tag, each leading to the next."""
        made = [self.new(tag) for _ in range(count)]
        for a, b in zip(made, made[1:], strict=False):
            self.point_to(a, link_at, b)
        return made

    def samples(self, head: int, at: int, here: int, tag: bytes, per: int, fmt: str, values: list) -> None:
        """Samples in the head record, the rest in a chain of data records."""
        self.put(head, at, f"{min(here, len(values))}{fmt}", *values[:here])
        rest = values[here:]
        parts = self.chain(tag, -(-len(rest) // per), 0x14)
        for k, part in enumerate(parts):
            chunk = rest[k * per : (k + 1) * per]
            self.put(part, 0x18, f"{len(chunk)}{fmt}", *chunk)
        if parts:
            self.point_to(head, 0x18, parts[0])

    def spectrum(self, n: int, c: Capture) -> None:
        self.put(n, 0x20, "fIff", 1000.0, c.ts, c.rpm, c.load)
        self.put(n, 0x50, "I", c.lines)
        self.text(n, 0x78, c.unit, 8)
        self.samples(n, 0xC8, 78, b"vcps", 122, "f", [c.value] * c.lines)

    def waveform(self, n: int, c: Capture) -> None:
        self.put(n, 0x24, "ffI", 1 / 2560, c.scale, c.lines)
        self.put(n, 0x34, "Iff", c.ts, c.rpm, c.load)
        self.text(n, 0x6C, c.unit, 8)
        self.samples(n, 0xD4, 150, b"vcfw", 244, "h", [int(c.value)] * c.lines)

    def trend(self, readings: list[tuple[int, float, list[float]]]) -> int:
        """Trend records of readings; a slot holds the date of its successor."""
        bands = len(readings[0][2])
        stride = 13 + 4 * bands
        per = (RECORD - 0x2F) // stride
        nodes = self.chain(b"vddt", -(-len(readings) // per), 0x10)
        for k, n in enumerate(nodes):
            own = readings[k * per : (k + 1) * per]
            self.put(n, 0x18, "I", own[0][0])
            self.put(n, 0x24, "I", bands)
            for j, (_, overall, values) in enumerate(own):
                after = own[j + 1][0] if j + 1 < len(own) else 0
                self.put(n, 0x2F + stride * j, f"If{bands}fIB", 0, overall, *values, after, 0)
        return nodes[0]

    def point(self, p: Point) -> int:
        n, index = self.new(b"vdpm"), self.new(b"pdcd")
        self.point_to(n, 0x10, index)
        self.text(n, 0x18, p.name, 32)
        self.records[n][0x7D] = len(p.bearings)
        for i, b in enumerate(p.bearings):
            self.text(n, 0x7E + 14 * i, b, 14)
        self.put(n, 0x164, "f", p.rpm)
        for captures, tag, first_at, write in ((p.spectra, b"vdps", 0x44, self.spectrum), (p.waves, b"vdfw", 0x5C, self.waveform)):
            nodes = self.chain(tag, len(captures), 0x14)
            for node, c in zip(nodes, captures, strict=True):
                write(node, c)
            if nodes:
                self.point_to(index, first_at, nodes[0])
                if p.cyclic and tag == b"vdps":
                    self.point_to(nodes[-1], 0x14, nodes[0])
        if p.readings:
            self.point_to(index, 0x3C, self.trend(p.readings))
        self.put(index, 0xAC, "HH", 1, 1)
        if p.note:
            severity, at, text = p.note
            status, note = self.new(b"gdsc"), self.new(b"gdnl")
            self.point_to(n, 0x1E4, status)
            self.put(status, 0x18, "HHI", 2, severity, at)
            self.point_to(status, 0x38, note)
            self.text(note, 0x18, text, 488)
        return n

    def machine(self, points: list[Point]) -> int:
        n, slots = self.new(b"gdcm"), self.new(b"gipm")
        self.point_to(n, 0x14, slots)
        for i, p in enumerate(points[:16]):
            self.point_to(slots, 0x1C0 + 4 * i, self.point(p))
        return n

    def parameter_sets(self, bands: list[tuple[str, int, float, float]], alert: list[float], danger: list[float], codes: list[int]) -> None:
        """One template and one limit set with their directories."""
        template, limits = self.new(b"pdpa"), self.new(b"pdla")
        self.put(template, 0x30, "HH", 1, len(bands))
        for i, (name, kind, low, high) in enumerate(bands):
            self.text(template, 0x34 + 14 * i, name, 14)
            self.records[template][0xDC + i] = kind
            self.put(template, 0xE8 + 4 * i, "f", low)
            self.put(template, 0x118 + 4 * i, "f", high)
        self.text(limits, 0x10, "LIMITS", 32)
        pad = lambda xs: [*xs, *[0] * (13 - len(xs))]
        self.put(limits, 0x38, "13f", *pad(danger))
        self.put(limits, 0xA0, "13f", *pad(alert))
        self.put(limits, 0x108, "13H", *pad(codes))
        for label, record in ((b"pdpa", template), (b"pdla", limits)):
            span = [self.new() for _ in range(4)]
            self.point_to(span[0], 0x10, record)
            self.records[self.new()][0x10:0x14] = label


def write_database(path: str, areas: list[tuple[str, list[tuple[str, list[Point]]]]], bands: Iterable = (), alert: Iterable = (), danger: Iterable = (), codes: Iterable = ()) -> int:
    """A database of areas (at most 16) of machines of points; returns the number of records."""
    w = RecordWriter()
    w.records[0][8:12] = b"gddh"
    w.records[0][0x1C:0x22] = b"MT4.00"
    w.put(0, 0x2C, "I", 1_600_000_000)
    w.text(0, 0x58, "FIXTURE", 40)
    names, heads = w.new(), w.new(b"gits")
    w.put(0, 0xDC, "I", names)
    w.put(0, 0xE4, "I", heads)
    w.parameter_sets(list(bands), list(alert), list(danger), list(codes))  # directories lie among the first records
    for i, (name, machines) in enumerate(areas):
        w.text(names, 32 * i, name, 32)
        first = w.new(b"gdts")
        w.point_to(heads, 0x10 + 4 * i, first)
        groups = [machines[k : k + 20] for k in range(0, len(machines), 20)]
        # the names of more than twelve machines go on in the record behind
        lists = []
        for _ in groups:
            lists.append(w.new(b"gicm"))
            w.new()
        for a, b in zip(lists, lists[1:], strict=False):
            w.point_to(a, 0x0C, b)
        if lists:
            w.point_to(first, 0x18, lists[0])
        for n, group in zip(lists, groups, strict=True):
            for j, (machine, points) in enumerate(group):
                w.point_to(n, 0x10 + 4 * j, w.machine(points))
                w.text(*((n, 0xB0 + 28 * j) if j < 12 else (n + 1, 28 * (j - 12))), machine, 28)
    with open(path, "wb") as file:
        for r in w.records:
            file.write(r)
    return len(w.records)
