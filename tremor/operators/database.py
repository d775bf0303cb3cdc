"""A record database as tables: areas, machines, points, captures, trends, notes.

Every pointer is an equi-join on the record number against the records of one tag;
chains are followed by set doubling. Payload records are met last, and only where a
table has them: inventories never touch them. What can't be decoded goes to ``faults``
instead of stopping the rest.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from tremor.functions.names import distinct_names
from tremor.operators import alarms, chains, ground_truth, inventory, signals
from tremor.session import checkpoint, shared_folder
from tremor.sources import layouts as L
from tremor.sources.records import decode, decode_text, read_records


def looks_like_name(slot: bytes) -> bool:
    """Two characters at least, none of them a control, one an ASCII letter."""
    text = slot.rstrip(b"\0 ")
    return len(text) > 1 and all(b >= 32 and b != 127 for b in text) and any(65 <= b & 0xDF <= 90 for b in text)


def cut_names(raw: bytes | None, size: int, count: int) -> list[str]:
    return [decode_text((raw or b"")[i * size : (i + 1) * size]) for i in range(count)]


def area_slots(raw: bytes) -> list[tuple[int, str]]:
    """The first stretch of name slots of an area record: (slot, name)."""
    out: list[tuple[int, str]] = []
    for i in range(L.AREA_SLOTS):
        slot = raw[i * L.AREA_SLOT : (i + 1) * L.AREA_SLOT]
        if looks_like_name(slot):
            out.append((i, decode_text(slot)))
        elif out:
            break
    return out


def trend_readings(first_ts: int, n_bands: int, body: bytes) -> list[tuple[int, int, float, list[float]]]:
    """(k, ts, overall, bands) of a trend record; a slot holds its successor's date.

    Ends at the first date or value that can't be, or at a slot without a successor.
    """
    if not 1 <= n_bands <= L.TREND_BANDS:
        return []
    stride = 13 + 4 * n_bands
    slots = np.frombuffer(body[: len(body) // stride * stride], np.dtype([("flags", "<u4"), ("overall", "<f4"), ("bands", "<f4", (n_bands,)), ("next", "<u4"), ("pad", "u1")]))
    dates = np.r_[first_ts, slots["next"][:-1]] if len(slots) else np.zeros(0)
    out = []
    for k, (slot, ts) in enumerate(zip(slots, dates, strict=True)):
        if not (L.TREND_EARLIEST <= ts <= L.TREND_LATEST and 0 < slot["overall"] <= L.TREND_TOP):
            break
        out.append((k, int(ts), float(slot["overall"]), slot["bands"].astype(float).tolist()))
        if slot["next"] == 0:
            break
    return out


class Database:
    """The tables of one record file; each is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._made: dict[str, DataFrame | tuple] = {}

    def _once(self, name: str, make):
        """A table that others build on, made and stored once."""
        if name not in self._made:
            made = make()
            self._made[name] = tuple(map(checkpoint, made)) if isinstance(made, tuple) else checkpoint(made)
        return self._made[name]

    def records(self) -> DataFrame:
        """All records by tag, stored once: the file itself is read a single time.

        Records of other tags than the layouts' share one part.
        """
        if "records" not in self._made:
            folder = shared_folder(self.spark, "records")
            part = F.when(F.col("tag").isin(*L.TAGS), F.col("tag")).otherwise("other")
            read_records(self.spark, self.path).withColumn("part", part).write.partitionBy("part").parquet(folder)
            self._made["records"] = self.spark.read.schema("record_num bigint, tag string, rec binary, part string").parquet(folder)
        return self._made["records"]

    def tagged(self, tag: str, fields: list, as_: str = "record_num") -> DataFrame:
        """Records of one tag cut by a layout; only their part is read."""
        return decode(self.records().where(F.col("part") == tag), fields).withColumnRenamed("record_num", as_)

    def header(self) -> DataFrame:
        """Record 0; a file without the signature is an error."""
        h = decode(self.records().where("record_num = 0"), L.HEADER)
        ok = F.assert_true(F.col("signature") == "MT4.00", F.lit("bad signature"))
        stamp = F.when(F.col("created_raw").between(631152000, 4102444800), F.timestamp_seconds("created_raw"))
        return h.where(ok.isNull()).withColumn("created_at", stamp)

    # --- hierarchy

    def _area_records(self) -> DataFrame:
        h = self.header().select(F.posexplode(F.array("areas_at", "more_areas_at")).alias("place", "record_num")).where("record_num > 0")
        first = h.groupBy("record_num").agg(F.min("place").alias("place"))
        return decode(self.records().join(F.broadcast(first), "record_num", "left_semi"), L.AREA).join(  # at most two records
            self.records().select("record_num", "tag"), "record_num"
        ).join(first, "record_num")

    def areas(self) -> DataFrame:
        """area_ordinal, area_name, area_code in the order of record and slot."""
        parse = F.udf(area_slots, "array<struct<slot:int,name:string>>")  # two records
        slots = self._area_records().select("record_num", F.inline(parse("slots")))
        coded = distinct_names(slots.withColumnRenamed("name", "area_name"), [], ["record_num", "slot"], "area_name", "area_code")
        return coded.select((F.row_number().over(Window.orderBy("record_num", "slot")) - 1).alias("area_ordinal"), "area_name", "area_code")

    def machines(self) -> DataFrame:
        """Machines of areas by the positional pairing of areas and chain heads, in chain and slot order."""
        return self._once("machines", self._machines)

    def _machine_lists(self, listed: DataFrame, chunks: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Chunks along the machine lists, and the lists that are broken: their areas have no machines."""

        def walk() -> tuple[DataFrame, DataFrame]:
            walked = chains.follow(listed.select("head"), edges, L.CHAIN_CAPS["gicm"])
            return walked, chains.faults(walked, edges, chunks.select("node"), L.CHAIN_CAPS["gicm"])

        return self._once("gicm", walk)

    def _machines(self) -> DataFrame:
        prefixed = self._area_records().where("tag = 'gits'").orderBy("place").limit(1)  # the first of at most two
        heads = prefixed.select(F.posexplode("chains").alias("area_ordinal", "chain_at"))
        lists = self.tagged("gdts", L.CHAIN_HEAD, "chain_at").where("list_at is not null")
        listed = heads.join(lists, "chain_at").select("area_ordinal", F.col("list_at").alias("head"))
        chunks = self.tagged("gicm", L.EQUIPMENT_LIST, "node")
        edges = chunks.select("node", "nxt")
        walked, broken = self._machine_lists(listed, chunks, edges)
        walked = chains.sound(walked, broken)
        more = decode(self.records().join(chunks.where(F.size("machines") > L.NAMES_HERE).select((F.col("node") + 1).alias("record_num")), "record_num", "left_semi"), L.MORE_NAMES)
        cut = F.pandas_udf(
            lambda here, there: pd.Series([cut_names(a, L.NAME_SLOT, L.NAMES_HERE) + cut_names(b, L.NAME_SLOT, 8) for a, b in zip(here, there, strict=True)]),
            ArrayType(StringType()),
        )
        named = chunks.join(more.select((F.col("record_num") - 1).alias("node"), "more"), "node", "left").select("node", "machines", cut("names", "more").alias("names"))
        rows = (
            listed.join(walked, "head").join(named, "node")
            .select("area_ordinal", "hop", F.posexplode("machines").alias("slot", "machine_at"), "names")
            .select("area_ordinal", "hop", "slot", "machine_at", F.element_at("names", F.col("slot") + 1).alias("machine_name"))
        )
        coded = distinct_names(rows, [], ["area_ordinal", "hop", "slot"], "machine_name", "machine_id")
        return rows.drop("machine_name").join(coded, ["area_ordinal", "hop", "slot"]).join(self.areas(), "area_ordinal")

    def points(self) -> DataFrame:
        """Points with codes that are distinct within their machine, bearings and nominal speed."""
        return self._once("points", self._points)

    def _points(self) -> DataFrame:
        lists = self.tagged("gdcm", L.MACHINE, "machine_at").where("points_at is not null")
        slots = self.tagged("gipm", L.POINT_LIST, "points_at").select("points_at", F.posexplode("points").alias("point_slot", "point_at"))
        raw = self.tagged("vdpm", L.POINT, "point_at")
        bearings = F.pandas_udf(
            lambda n, b: pd.Series([[x for x in cut_names(r, L.BEARING_SLOT, min(int(k), L.BEARING_SLOTS)) if x and x != L.BEARING_UNSET] for k, r in zip(n, b, strict=True)]),
            ArrayType(StringType()),
        )
        joined = self.machines().join(lists, "machine_at").join(slots, "points_at").join(raw, "point_at")
        codes = distinct_names(joined, ["machine_id"], ["point_slot"], "long_name", "point_id").select("machine_id", "point_slot", "point_id")
        return joined.join(codes, ["machine_id", "point_slot"]).select(
            "area_name", "area_code", "machine_id", "machine_name", "point_id", "long_name", F.col("point_at").alias("record_num"), "point_slot", "index_at", "status_at",
            bearings("n_bearings", "bearings").alias("bearing_designations"), F.when(F.col("rpm_raw") > 0, F.col("rpm_raw").cast("double")).alias("nominal_speed_rpm"),
        )

    def links(self) -> DataFrame:
        """Points with the heads of their chains; points without a sample index are left out."""
        keep = ["machine_id", "point_id", "record_num"]
        return self.points().select(*keep, "index_at").join(self.tagged("pdcd", L.SAMPLE_INDEX, "index_at"), "index_at")

    # --- chains

    def _chain(self, first: str, tag: str, fields: list) -> tuple[DataFrame, DataFrame]:
        """Descriptors along the points' chains of one tag, and what is broken.

        A broken chain has no captures at all.
        """
        return self._once(tag, lambda: self._follow(first, tag, fields))

    def _follow(self, first: str, tag: str, fields: list) -> tuple[DataFrame, DataFrame]:
        nodes = self.tagged(tag, fields, "node")
        heads = self.links().where(F.col(first).isNotNull()).select("machine_id", "point_id", "record_num", F.col(first).alias("head"))
        edges = nodes.select("node", "nxt")
        walked = chains.follow(heads.select("head"), edges, L.CHAIN_CAPS[tag])
        broken = chains.faults(walked, edges, nodes.select("node"), L.CHAIN_CAPS[tag])
        return heads.join(chains.sound(walked, broken), "head").join(nodes, "node"), broken

    def _payload(self, captures: DataFrame, tag: str, fields: list) -> DataFrame:
        """(node, chain) arrays of the data records behind captures, joined in order."""
        data = self.tagged(tag, fields, "part")
        heads = captures.select(F.col("data_at").alias("head")).distinct()
        walked = chains.follow(heads, data.select(F.col("part").alias("node"), "nxt"), L.CHAIN_CAPS[tag])
        broken = chains.faults(walked, data.select(F.col("part").alias("node"), "nxt"), data.select(F.col("part").alias("node")), L.CHAIN_CAPS[tag])
        parts = chains.sound(walked, broken).join(data.select(F.col("part").alias("node"), "data"), "node")
        joined = parts.groupBy("head").agg(F.array_sort(F.collect_list(F.struct("hop", "data"))).alias("p"))  # at most 256 records
        return joined.select(F.col("head").alias("data_at"), F.flatten(F.transform("p", lambda x: x["data"])).alias("chain"))

    def spectrum_refs(self) -> DataFrame:
        """Descriptors of spectra in chain order, without their data."""
        return self._chain("fft_first", "vdps", L.SPECTRUM)[0].where("data_at is not null")

    def waveform_refs(self) -> DataFrame:
        return self._chain("wave_first", "vdfw", L.WAVE)[0].where("data_at is not null")

    def spectra(self) -> DataFrame:
        """Spectra with calibrated amplitudes: velocity and acceleration scaled in single precision, other units as they are."""
        refs = self.spectrum_refs()
        low = self.tagged("vdps", L.SPECTRUM_LOW, "node")
        data = signals.assembled(F.col("low"), F.col("chain"), F.col("n_lines").cast("int"))
        factor = F.when(F.col("units").isin(*L.VELOCITY_UNITS), L.SPECTRUM_VELOCITY).when(F.col("units").isin(*L.ACCELERATION_UNITS), L.SPECTRUM_ACCELERATION).otherwise(1.0).cast("float")
        return refs.join(low, "node").join(self._payload(refs, "vcps", L.SPECTRUM_DATA), "data_at").select(
            "machine_id", "point_id", F.col("node").alias("record_num"), "hop", F.timestamp_seconds("ts").alias("timestamp_utc"), "fmax_hz", "n_lines",
            display_unit(F.col("units")).alias("unit"), "rpm", "load_pct", F.transform(data, lambda x: (x * factor).cast("float")).alias("data"),
        )

    def waveforms(self) -> DataFrame:
        """Waveforms of exactly their nominal length; short ones and those with data beyond it are left out."""
        refs = self.waveform_refs()
        low = self.tagged("vdfw", L.WAVE_LOW, "node")
        whole = F.concat("low", "chain")
        n = F.col("n_samples").cast("int")
        factor = F.col("scale") * F.when(F.col("units").isin(*L.VELOCITY_UNITS), L.INCH).otherwise(1.0).cast("float")
        rows = refs.join(low, "node").join(self._payload(refs, "vcfw", L.WAVE_DATA), "data_at").withColumn("_all", whole).where(signals.wave_state(F.col("_all"), n) == "ok")
        return rows.select(
            "machine_id", "point_id", F.col("node").alias("record_num"), "hop", F.timestamp_seconds("ts").alias("timestamp_utc"),
            F.when(F.col("period_s") > 0, 1.0 / F.col("period_s")).otherwise(0.0).alias("sample_rate_hz"), n.alias("n_samples"),
            display_unit(F.col("units")).alias("unit"), "rpm", "load_pct", F.transform(F.slice("_all", 1, n), lambda x: (x.cast("float") * factor).cast("float")).alias("data"),
        )

    def readings(self) -> DataFrame:
        """Raw trend readings with the unit of the point's first spectrum; points without a known unit have none."""
        found, _ = self._chain("trend_first", "vddt", L.TREND)
        unpack = F.pandas_udf(
            lambda ts, n, body: pd.Series([[{"k": k, "ts": t, "overall": o, "bands": b} for k, t, o, b in trend_readings(int(a), int(m), r)] for a, m, r in zip(ts, n, body, strict=True)]),
            "array<struct<k:int,ts:long,overall:float,bands:array<float>>>",
        )
        units = self._chain("fft_first", "vdps", L.SPECTRUM)[0].where("hop = 0").select("machine_id", "point_id", "units")
        return (
            found.select("machine_id", "point_id", "record_num", "hop", F.inline(unpack("first_ts", "n_bands", "body")))
            .join(units.where(F.col("units").isin(*L.VELOCITY_UNITS, *L.ACCELERATION_UNITS)), ["machine_id", "point_id"])
        )

    # --- parameter sets

    def _directory(self, label: str) -> DataFrame:
        """(set_index, record_num) of the directory that lies before its label record."""
        low = self.records().where(F.col("record_num") < L.DIRECTORY_LIMIT)
        name = label.encode().hex().upper() + "00000000"
        at = low.where((F.col("tag") == "0x00000000") & (F.col("record_num") >= L.DIRECTORY_SPAN) & (F.hex(F.substring("rec", 17, 8)) == name)).agg(
            (F.min("record_num") - L.DIRECTORY_SPAN).alias("first")
        )
        span = low.crossJoin(F.broadcast(at)).where(F.col("record_num").between(F.col("first"), F.col("first") + L.DIRECTORY_SPAN - 1))  # one row
        entries = F.pandas_udf(
            lambda first, rec: pd.Series([np.frombuffer(bytes(r)[16 if f else 0 :], "<u4").astype(np.int64).tolist() for f, r in zip(first, rec, strict=True)]), "array<long>"
        )
        per, lead = 128, 124
        rows = span.select("record_num", "first", F.posexplode(entries(F.col("record_num") == F.col("first"), "rec")).alias("i", "stored"))
        place = F.when(F.col("record_num") == F.col("first"), F.col("i")).otherwise(lead + (F.col("record_num") - F.col("first") - 1) * per + F.col("i"))
        return rows.where("stored > 0").select((place + 1).alias("set_index"), (F.col("stored") - 1).alias("record_num"))

    def templates(self) -> DataFrame:
        """Active band slots of the analysis templates: (template_index, slot, band, band_type, low, high, active)."""
        names = F.pandas_udf(lambda raw: pd.Series([cut_names(r, 14, 12) for r in raw]), ArrayType(StringType()))
        t = self._directory("pdpa").join(self.tagged("pdpa", L.TEMPLATE).drop("set_index"), "record_num")
        active = F.least("active", F.lit(12))
        z = F.arrays_zip(names("names").alias("band"), F.col("types").alias("band_type"), "low", "high")
        return t.select(F.col("set_index").alias("template_index"), active.alias("active"), F.posexplode(F.slice(z, 1, active)).alias("slot", "z")).select(
            "template_index", "active", "slot", F.col("z")["band"].alias("band"), F.col("z")["band_type"].alias("band_type"), F.col("z")["low"].alias("low"), F.col("z")["high"].alias("high")
        )

    def limits(self) -> DataFrame:
        """Limit sets in long form: (limits_index, set_name, slot, alert, danger, code)."""
        s = self._directory("pdla").join(self.tagged("pdla", L.LIMITS).drop("set_index"), "record_num")
        names = s.select(F.col("record_num").alias("limit_record_num"), F.col("set_index").alias("limits_index"), "set_name")
        return alarms.slots_of(s.select("record_num", "alert", "danger", "unit_codes")).join(names, "limit_record_num").drop("limit_record_num")

    def trends(self) -> DataFrame:
        """Overall and band values in display units with their derived alarm levels, in long form.

        Bands count for readings with as many columns as the template has active
        slots; thresholds count where their unit code fits.
        """
        r = self.readings().join(self.links().select("machine_id", "point_id", "template_index", "limits_index"), ["machine_id", "point_id"])
        lim = self.limits()
        velocity = F.col("units").isin(*L.VELOCITY_UNITS)
        keep = ["machine_id", "point_id", "t", "hop", "k"]
        base = r.withColumn("t", F.col("ts") * 1_000_000)
        o = base.join(lim.where("slot = 0"), "limits_index", "left")
        expected = F.when(velocity, alarms.VELOCITY).otherwise(alarms.ACCELERATION)
        alert, danger = F.when(F.col("code") == expected, F.col("alert")), F.when(F.col("code") == expected, F.col("danger"))
        overall = o.select(
            *keep, F.lit(None).cast("string").alias("band"), (F.col("overall") * F.when(velocity, F.lit(L.INCH)).otherwise(F.lit(1.0))).cast("float").alias("value"),
            F.when(velocity, "mm/s").otherwise("G's").alias("unit"), alarms.alarm_level(F.col("overall").cast("double"), alert, danger).alias("alarm"),
        )
        columns = alarms.band_columns(self.templates())
        b = (
            base.join(columns, "template_index").where(F.size("bands") == F.col("active"))
            .withColumn("_slot", F.col("slot")).join(lim.withColumn("_slot", F.col("slot") - 1).drop("slot"), ["limits_index", "_slot"], "left")
        )
        raw = F.element_at("bands", F.col("_slot") + 1)
        same = F.col("code") == F.col("expected_code")
        bands = b.select(
            *keep, "band", (raw * F.col("scale")).cast("float").alias("value"), "unit",
            alarms.alarm_level(raw.cast("double"), F.when(same, F.col("alert")), F.when(same, F.col("danger"))).alias("alarm"),
        )
        return overall.unionByName(bands)

    def notes(self) -> DataFrame:
        """Stored alarm notes with their status and text."""
        status = self.tagged("gdsc", L.STATUS, "status_at")
        text = self.tagged("gdnl", L.NOTE, "note_at").select("note_at", "text")
        when = lambda c: F.when(F.col(c) > 0, F.timestamp_seconds(c))
        lines = F.array_join(F.transform(F.split(F.replace("text", F.lit("\r\n"), F.lit("\n")), "\n"), lambda x: F.trim(x)), "\n")
        return self.points().select("machine_id", "point_id", "record_num", "status_at").join(status, "status_at").join(text, "note_at").select(
            "machine_id", "point_id", F.col("record_num").alias("point_record_num"), "severity", alarms.severity_level(F.col("severity")).alias("severity_level"), "user",
            when("measured_raw").alias("measured_at_utc"), when("review_raw").alias("review_at_utc"), F.trim(lines).alias("note_text"),
        )

    def checked_notes(self) -> DataFrame:
        """Notes against the thresholds of the band they name, with the reason a note isn't published."""
        links = self.links().select(F.col("record_num").alias("point_record_num"), "template_index", "limits_index")
        keep = ["machine_id", "point_id", "note_text", "measured_at_utc"]
        return alarms.checked_notes(self.notes(), links, self.limits(), self.templates(), keep)

    def alarm_observations(self, document_id: str) -> DataFrame:
        """Observations of the alarms that passed all gates, in the order of their ids."""
        return ground_truth.alarm_observations(self.checked_notes(), self.points(), document_id)

    # --- inventories

    def summaries(self) -> DataFrame:
        """Count, first and last capture per point and kind, without payloads."""
        kinds = [("fft", self.spectrum_refs(), "ts"), ("waveform", self.waveform_refs(), "ts"), ("trend", self.readings(), "ts")]
        rows = [df.select("machine_id", "point_id", F.lit(kind).alias("kind"), F.timestamp_seconds(at).alias("at")) for kind, df, at in kinds]
        return inventory.type_summary(rows[0].unionByName(rows[1]).unionByName(rows[2]), ["machine_id", "point_id", "kind"], "at")

    def per_machine(self) -> DataFrame:
        """Machines with their points and captures by kind, machines without any included."""
        counts = self.summaries().groupBy("machine_id").pivot("kind", ["fft", "waveform", "trend"]).agg(F.sum("n"))
        sizes = self.points().groupBy("machine_id").agg(F.count("*").alias("n_points"))
        return self.machines().join(sizes, "machine_id", "left").join(counts, "machine_id", "left").fillna(0, ["n_points", "fft", "waveform", "trend"])

    def totals(self) -> DataFrame:
        """One row of totals of the whole database, made once."""
        return self._once("totals", lambda: inventory.database_totals(self.per_machine()))

    def faults(self) -> DataFrame:
        """Heads of broken chains by kind, those of machine lists among them."""
        self.machines()
        lists = self._made["gicm"][1].withColumn("chain", F.lit("gicm"))
        parts = [self._chain(first, tag, fields)[1].withColumn("chain", F.lit(tag)) for first, tag, fields in (("fft_first", "vdps", L.SPECTRUM), ("wave_first", "vdfw", L.WAVE), ("trend_first", "vddt", L.TREND))]
        return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(lists)

    def decode_errors(self) -> DataFrame:
        """(family, record_num, expected, found): pointers to records of another tag, or, with a null, beyond the file.

        One error per family and record, whoever points there; what can be decoded
        comes out all the same.
        """
        points, links = self.points(), self.links()
        pointers = {
            ("machine", "gdcm"): self.machines().select(F.col("machine_at").alias("record_num")),
            ("point list", "gipm"): self.tagged("gdcm", L.MACHINE).select(F.col("points_at").alias("record_num")),
            ("point", "vdpm"): self.tagged("gipm", L.POINT_LIST).select(F.explode("points").alias("record_num")),
            ("sample index", "pdcd"): points.select(F.col("index_at").alias("record_num")),
            ("status", "gdsc"): points.select(F.col("status_at").alias("record_num")),
            ("note", "gdnl"): self.tagged("gdsc", L.STATUS).select(F.col("note_at").alias("record_num")),
            ("spectrum", "vdps"): links.select(F.col("fft_first").alias("record_num")),
            ("waveform", "vdfw"): links.select(F.col("wave_first").alias("record_num")),
            ("trend", "vddt"): links.select(F.col("trend_first").alias("record_num")),
            ("spectrum data", "vcps"): self.tagged("vdps", L.SPECTRUM).select(F.col("data_at").alias("record_num")),
            ("waveform data", "vcfw"): self.tagged("vdfw", L.WAVE).select(F.col("data_at").alias("record_num")),
        }
        rows = [df.where("record_num is not null").select(F.lit(family).alias("family"), "record_num", F.lit(tag).alias("expected")) for (family, tag), df in pointers.items()]
        every = rows[0]
        for r in rows[1:]:
            every = every.unionByName(r)
        found = every.distinct().join(self.records().select("record_num", F.col("tag").alias("found")), "record_num", "left")
        return found.where(F.col("found").isNull() | (F.col("found") != F.col("expected"))).select("family", "record_num", "expected", "found")


def display_unit(units: Column) -> Column:
    return F.when(units.isin(*L.VELOCITY_UNITS), "mm/s").otherwise(units)
