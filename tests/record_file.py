"""A small record database written byte by byte."""

import struct

RECORD = 512


class Builder:
    def __init__(self):
        self.records = [bytearray(RECORD) for _ in range(8)]

    def new(self, tag=None):
        self.records.append(bytearray(RECORD))
        n = len(self.records) - 1
        if tag:
            self.records[n][8:12] = tag
        return n

    def put(self, n, at, fmt, *values):
        struct.pack_into("<" + fmt, self.records[n], at, *values)

    def text(self, n, at, s, size):
        self.records[n][at : at + size] = s.encode("cp1252").ljust(size, b" ")[:size]

    def write(self, path):
        path.write_bytes(b"".join(self.records))
        return str(path)


D0 = 1362009600
DATES = [1366761600, 1372118400]


def spectrum(b, ts, lines, values, unit="plg/segs", rpm=1455.0, extra=None):
    n = b.new(b"vdps")
    b.put(n, 0x20, "f", 1000.0)
    b.put(n, 0x24, "I", ts)
    b.put(n, 0x28, "ff", rpm, 100.0)
    b.put(n, 0x50, "I", lines)
    b.text(n, 0x78, unit, 8)
    b.put(n, 0xC8, "78f", *values)
    if extra is not None:
        first = None
        before = None
        for k in range(0, len(extra), 122):
            part = b.new(b"vcps")
            chunk = extra[k : k + 122]
            b.put(part, 0x18, f"{len(chunk)}f", *chunk)
            if before is not None:
                b.put(before, 0x14, "I", part + 1)
            first, before = first if first is not None else part, part
        b.put(n, 0x18, "I", first + 1)
    return n


def database(path, cycle=False):
    """Two areas, the first with 14 machines (two of one name), one point with everything."""
    b = Builder()
    b.records[0][8:12] = b"gddh"
    b.records[0][0x1C:0x22] = b"MT4.00"
    b.put(0, 0x2C, "I", 1600000000)
    b.text(0, 0x58, "PLANTA ÑANDÚ", 40)
    simple, prefixed = b.new(), b.new(b"gits")
    b.put(0, 0xDC, "I", simple)
    b.put(0, 0xE4, "I", prefixed)
    b.text(simple, 0, "AREA UNO", 32)
    b.text(simple, 32, "AREA DOS", 32)
    gdts = b.new(b"gdts")
    b.put(prefixed, 0x10, "I", gdts + 1)
    gicm = b.new(b"gicm")
    more = b.new()
    b.put(gdts, 0x18, "I", gicm + 1)
    machines = []
    for i in range(14):
        m = b.new(b"gdcm")
        machines.append(m)
        b.put(gicm, 0x10 + 4 * i, "I", m + 1)
        name = "BOMBA AG-100" if i in (0, 1) else f"MAQUINA {i}"
        if i < 12:
            b.text(gicm, 0xB0 + 28 * i, name, 28)
        else:
            b.text(more, 28 * (i - 12), name, 28)
    gipm, point, empty = b.new(b"gipm"), b.new(b"vdpm"), b.new(b"vdpm")
    b.put(machines[0], 0x14, "I", gipm + 1)
    b.put(gipm, 0x1C0, "II", point + 1, empty + 1)
    b.text(point, 0x18, "MOTOR LA HORIZONTAL", 32)
    b.text(empty, 0x18, "MOTOR LA HORIZONTAL", 32)
    b.records[point][0x7D] = 3
    for i, s in enumerate(("6204", "INDEFINID", "SKF 6308")):
        b.text(point, 0x7E + 14 * i, s, 14)
    b.put(point, 0x164, "f", 1455.0)
    pdcd = b.new(b"pdcd")
    b.put(point, 0x10, "I", pdcd + 1)
    # spectra: the first with a chain of two data records
    s1 = spectrum(b, D0, 300, [1.0] * 78, extra=[2.0] * 244)
    s2 = spectrum(b, DATES[0], 100, [0.5] * 78, extra=[0.25] * 122)
    b.put(s1, 0x14, "I", s2 + 1)
    if cycle:
        b.put(s2, 0x14, "I", s1 + 1)
    b.put(pdcd, 0x44, "I", s1 + 1)
    # a waveform of 200 samples: 150 here, 50 in a data record, the rest zero
    w = b.new(b"vdfw")
    wd = b.new(b"vcfw")
    b.put(w, 0x18, "I", wd + 1)
    b.put(w, 0x24, "ff", 1 / 2560, 0.5)
    b.put(w, 0x2C, "I", 200)
    b.put(w, 0x34, "I", D0)
    b.put(w, 0x38, "ff", 0.0, 50.0)
    b.text(w, 0x6C, "G's", 8)
    b.put(w, 0xD4, "150h", *([2] * 150))
    b.put(wd, 0x18, "50h", *([4] * 50))
    b.put(pdcd, 0x5C, "I", w + 1)
    # trends: three readings of two bands, dated one slot ahead, then garbage
    t = b.new(b"vddt")
    b.put(t, 0x18, "I", D0)
    b.put(t, 0x24, "I", 2)
    for k, (overall, nxt) in enumerate([(0.1, DATES[0]), (0.2, DATES[1]), (0.5, 0), (1e30, 0)]):
        b.put(t, 0x2F + 21 * k, "IfffIB", 0, overall, overall / 2, overall / 4, nxt, 0)
    b.put(pdcd, 0x3C, "I", t + 1)
    b.put(pdcd, 0xAC, "HH", 1, 1)
    # parameter sets and their directories, each four records and a label
    def directory(label, record):
        span = [b.new() for _ in range(4)]
        b.put(span[0], 0x10, "I", record + 1)
        end = b.new()
        b.records[end][0x10:0x14] = label

    template = b.new(b"pdpa")
    b.put(template, 0x30, "HH", 1, 2)
    for i, (name, kind, low, high) in enumerate([("1X RPM", 2, 0.8, 1.2), ("Mp Wave", 11, 0.0, 0.0)]):
        b.text(template, 0x34 + 14 * i, name, 14)
        b.records[template][0xDC + i] = kind
        b.put(template, 0xE8 + 4 * i, "f", low)
        b.put(template, 0x118 + 4 * i, "f", high)
    limits = b.new(b"pdla")
    b.text(limits, 0x10, "LIMITES", 32)
    b.put(limits, 0x38, "13f", *([0.4, 0.2, 0.1] + [0.0] * 10))
    b.put(limits, 0xA0, "13f", *([0.15, 0.09, 0.03] + [0.0] * 10))
    b.put(limits, 0x108, "13H", *([1, 1, 1] + [0] * 10))
    directory(b"pdpa", template)
    directory(b"pdla", limits)
    status, note = b.new(b"gdsc"), b.new(b"gdnl")
    b.put(point, 0x1E4, "I", status + 1)
    b.put(status, 0x18, "HH", 2, 60)
    b.put(status, 0x1C, "I", D0)
    b.text(status, 0x28, "USER", 16)
    b.put(status, 0x38, "I", note + 1)
    b.text(note, 0x18, "OVERALL VALUE - 11.278 mm/Seg -  D Alarm  \r\n  Revisar", 100)
    return b.write(path)
