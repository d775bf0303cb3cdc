"""Layouts of the record types: fixed offsets of the file format, as data."""

from __future__ import annotations

from tremor.sources.records import Field as F

# Fixed values of the format.
HEADER = [
    F("tag", 0x08, "text", 4), F("guid", 0x0C, "bytes", 16), F("signature", 0x1C, "text", 6), F("created_raw", 0x2C, "u32"),
    F("description", 0x58, "text", 40), F("areas_at", 0xDC, "u32"), F("more_areas_at", 0xE4, "u32"),
]
AREA_SLOTS, AREA_SLOT = 16, 32
AREA = [F("slots", 0, "bytes", 512), F("chains", 0x10, "ptr", 20)]
CHAIN_HEAD = [F("list_at", 0x18, "ptr")]  # gdts
EQUIPMENT_LIST = [F("nxt", 0x0C, "ptr"), F("machines", 0x10, "ptr", 20), F("names", 0xB0, "bytes", 336)]  # gicm
NAME_SLOT, NAMES_HERE = 28, 12
MORE_NAMES = [F("more", 0, "bytes", 224)]
MACHINE = [F("points_at", 0x14, "ptr")]  # gdcm
POINT_LIST = [F("points", 0x1C0, "ptr", 16)]  # gipm
POINT = [
    F("index_at", 0x10, "ptr"), F("long_name", 0x18, "text", 32), F("n_bearings", 0x7D, "u8"), F("bearings", 0x7E, "bytes", 98),
    F("rpm_raw", 0x164, "f32"), F("status_at", 0x1E4, "ptr"),
]
BEARING_SLOT, BEARING_SLOTS, BEARING_UNSET = 14, 7, "INDEFINID"
SAMPLE_INDEX = [
    F("trend_first", 0x3C, "ptr"), F("trend_last", 0x40, "ptr"), F("fft_first", 0x44, "ptr"), F("fft_last", 0x48, "ptr"),
    F("wave_first", 0x5C, "ptr"), F("wave_last", 0x60, "ptr"), F("template_index", 0xAC, "u16"), F("limits_index", 0xAE, "u16"),
]
SPECTRUM = [
    F("nxt", 0x14, "ptr"), F("data_at", 0x18, "ptr"), F("fmax_hz", 0x20, "f32"), F("ts", 0x24, "u32"), F("rpm", 0x28, "f32"),
    F("load_pct", 0x2C, "f32"), F("n_lines", 0x50, "u32"), F("units", 0x78, "text", 8),
]
SPECTRUM_LOW = [F("low", 0xC8, "f32", 78)]
SPECTRUM_DATA = [F("nxt", 0x14, "ptr"), F("data", 0x18, "f32", 122)]
WAVE = [
    F("nxt", 0x14, "ptr"), F("data_at", 0x18, "ptr"), F("period_s", 0x24, "f32"), F("scale", 0x28, "f32"), F("n_samples", 0x2C, "u32"),
    F("ts", 0x34, "u32"), F("rpm", 0x38, "f32"), F("load_pct", 0x3C, "f32"), F("units", 0x6C, "text", 8),
]
WAVE_LOW = [F("low", 0xD4, "i16", 150)]
WAVE_DATA = [F("nxt", 0x14, "ptr"), F("data", 0x18, "i16", 244)]
TREND = [F("nxt", 0x10, "ptr"), F("first_ts", 0x18, "u32"), F("n_bands", 0x24, "u32"), F("body", 0x2F, "bytes", 465)]
TREND_EARLIEST, TREND_LATEST, TREND_TOP, TREND_BANDS = 946_684_800, 2_145_916_800, 200.0, 32
TEMPLATE = [
    F("name", 0x10, "text", 32), F("set_index", 0x30, "u16"), F("active", 0x32, "u16"), F("names", 0x34, "bytes", 168),
    F("types", 0xDC, "u8", 12), F("low", 0xE8, "f32", 12), F("high", 0x118, "f32", 12),
]
LIMITS = [F("set_name", 0x10, "text", 32), F("set_index", 0x30, "u16"), F("danger", 0x38, "f32", 13), F("alert", 0xA0, "f32", 13), F("unit_codes", 0x108, "u16", 13)]
DIRECTORY_SPAN, DIRECTORY_LIMIT = 4, 256
STATUS = [
    F("format_code", 0x18, "u16"), F("severity", 0x1A, "u16"), F("measured_raw", 0x1C, "u32"), F("review_raw", 0x24, "u32"), F("user", 0x28, "text", 16), F("note_at", 0x38, "ptr"),
]
NOTE = [F("text", 0x18, "text", 488)]
CHAIN_CAPS = {"vdps": 4096, "vdfw": 4096, "vddt": 4096, "vcps": 256, "vcfw": 256, "gicm": 256}
TAGS = ("gits", "gdts", "gicm", "gdcm", "gipm", "vdpm", "pdcd", "vdps", "vcps", "vdfw", "vcfw", "vddt", "pdpa", "pdla", "gdsc", "gdnl")
VELOCITY_UNITS, ACCELERATION_UNITS = ("plg/segs", "in/sec", "pul/sg"), ("G's",)
SPECTRUM_VELOCITY, SPECTRUM_ACCELERATION, INCH = 48.5, 1.30, 25.4
# End of the fixed values.
