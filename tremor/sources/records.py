"""Files of 512-byte records as a Spark data source, and their decoding by layout.

``spark.read.format("records").load(path)`` gives (record_num, tag, rec). The file is
cut into ranges of records that are read independently, so it needs one path that all
executors see. Equality on ``tag`` and comparisons on ``record_num`` are pushed into
the reader (``read_records`` allows the session pushdown to Python sources); ``tags``
as an option (``vdps,vcps``) names the tags to be read.

A layout names fields with offset and kind; one vectorised pass over a batch of records
cuts all fields at once.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

RECORD = 512
#: Records per input partition: 32 MiB.
RANGE = 65_536
BATCH = 8_192
TAG_AT = 8
SCHEMA = "record_num bigint, tag string, rec binary"


@dataclass
class Range(InputPartition):
    path: str
    first: int
    last: int


def tag_name(tag: bytes) -> str:
    """A printable tag as it is, any other as hex."""
    return tag.decode("ascii") if all(32 <= b < 127 for b in tag) else f"0x{tag.hex()}"


class RecordReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options.get("path", "").removeprefix("file://")
        self.range = int(options.get("rangerecords", options.get("rangeRecords", RANGE)))
        self.tags = {t.strip() for t in options["tags"].split(",") if t.strip()} if options.get("tags") else None
        self.low, self.high = 0, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = getattr(f, "attribute", None)
            if column == ("tag",) and isinstance(f, (EqualTo, In)):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.tags = wanted if self.tags is None else self.tags & wanted
            elif column == ("record_num",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                low = {EqualTo: f.value, GreaterThan: f.value + 1, GreaterThanOrEqual: f.value}.get(type(f))
                high = {EqualTo: f.value + 1, LessThan: f.value, LessThanOrEqual: f.value + 1}.get(type(f))
                self.low = max(self.low, low) if low is not None else self.low
                self.high = high if self.high is None else self.high if high is None else min(self.high, high)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        size = os.stat(self.path).st_size
        if size == 0 or size % RECORD:
            raise ValueError(f"{self.path} has {size} bytes: not a positive multiple of {RECORD}")
        end = min(size // RECORD, self.high if self.high is not None else size // RECORD)
        return [Range(self.path, a, min(a + self.range, end)) for a in range(self.low, end, self.range)] or [Range(self.path, 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        wanted = None if self.tags is None else self.tags
        with open(partition.path, "rb") as file:
            file.seek(partition.first * RECORD)
            for at in range(partition.first, partition.last, BATCH):
                data = np.frombuffer(file.read(min(BATCH, partition.last - at) * RECORD), np.uint8).reshape(-1, RECORD)
                raw = np.ascontiguousarray(data[:, TAG_AT : TAG_AT + 4]).view("<u4")[:, 0]
                kinds, of = np.unique(raw, return_inverse=True)
                names = np.array([tag_name(int(k).to_bytes(4, "little")) for k in kinds], dtype=object)
                keep = np.arange(len(data)) if wanted is None else np.flatnonzero(np.isin(names, list(wanted))[of])
                if len(keep):
                    recs = pa.FixedSizeBinaryArray.from_buffers(pa.binary(RECORD), len(keep), [None, pa.py_buffer(np.ascontiguousarray(data[keep]).tobytes())])
                    yield pa.RecordBatch.from_arrays([pa.array(keep + at, pa.int64()), pa.array(names[of[keep]], pa.string()), recs.cast(pa.binary())], names=["record_num", "tag", "rec"])


class RecordSource(DataSource):
    """The data source ``records``."""

    @classmethod
    def name(cls) -> str:
        return "records"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return RecordReader(dict(self.options))


def read_records(spark: SparkSession, path: str, tags: Iterable[str] | None = None) -> DataFrame:
    """The records of a file, all or those of some tags."""
    spark.dataSource.register(RecordSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # a reader that takes filters needs it
    reader = spark.read.format("records")
    return (reader.option("tags", ",".join(tags)) if tags else reader).load(path)


def decode_text(raw: bytes) -> str:
    """Text without trailing zeros and blanks, in the first of three code pages that fits."""
    raw = raw.rstrip(b"\0 ")
    for page in ("cp1252", "cp850"):
        try:
            return raw.decode(page)
        except UnicodeDecodeError:
            continue
    return raw.decode("latin-1")


#: kind -> (bytes of one, numpy type, Arrow type, Spark type)
KINDS = {
    "u8": (1, "u1", pa.int32(), "int"),
    "u16": (2, "<u2", pa.int32(), "int"),
    "u32": (4, "<u4", pa.int64(), "bigint"),
    "ptr": (4, "<u4", pa.int64(), "bigint"),
    "i16": (2, "<i2", pa.int32(), "int"),
    "f32": (4, "<f4", pa.float32(), "float"),
}


@dataclass(frozen=True)
class Field:
    """A field of a record: offset, kind, and how many (0: a single value). ``text`` has a length instead.

    A pointer is stored plus one, 0 is null; a list of pointers ends at the first 0.
    """

    name: str
    at: int
    kind: str
    n: int = 0

    @property
    def sql(self) -> str:
        if self.kind == "text":
            return "string"
        if self.kind == "bytes":
            return "binary"
        one = KINDS[self.kind][3]
        return f"array<{one}>" if self.n else one

    def cut(self, data: np.ndarray) -> pa.Array:
        if self.kind in ("text", "bytes"):
            raw = [bytes(r) for r in data[:, self.at : self.at + self.n]]
            return pa.array([decode_text(r) for r in raw], pa.string()) if self.kind == "text" else pa.array(raw, pa.binary())
        size, dtype, arrow, _ = KINDS[self.kind]
        count = self.n or 1
        values = np.ascontiguousarray(data[:, self.at : self.at + size * count]).view(dtype)
        if not self.n:
            v = values[:, 0]
            if self.kind == "ptr":
                return pa.array(v.astype(np.int64) - 1, arrow, mask=v == 0)
            return pa.array(v.astype(v.dtype.newbyteorder("="))).cast(arrow)
        if self.kind == "ptr":
            lengths = np.where((values == 0).any(axis=1), (values == 0).argmax(axis=1), count)
            return pa.array([row[:k].astype(np.int64) - 1 for row, k in zip(values, lengths, strict=True)], pa.list_(arrow))
        flat = pa.array(values.reshape(-1).astype(values.dtype.newbyteorder("="))).cast(arrow)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * count, pa.int32()), flat)


def decode(records: DataFrame, fields: list[Field]) -> DataFrame:
    """Records cut into the fields of a layout; records of another length are left out."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            recs = batch.column(1).to_pylist()
            whole = [i for i, r in enumerate(recs) if r is not None and len(r) == RECORD]
            if whole:
                data = np.frombuffer(b"".join(recs[i] for i in whole), np.uint8).reshape(-1, RECORD)
                columns = [batch.column(0).take(pa.array(whole)), *[f.cut(data) for f in fields]]
                yield pa.RecordBatch.from_arrays(columns, names=["record_num", *[f.name for f in fields]])

    return records.select("record_num", "rec").mapInArrow(cut, ", ".join(["record_num bigint", *[f"{f.name} {f.sql}" for f in fields]]))


def record_count(path: str) -> int:
    return os.stat(path).st_size // RECORD


def tag_frequencies(records: DataFrame) -> DataFrame:
    """How many records have each tag."""
    return records.groupBy("tag").agg(F.count("*").alias("n"))
