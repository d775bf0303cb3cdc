"""Implausible values in measured series: non-values, spikes and stuck runs.

Per source (a measuring point) and channel (the overall and each band):

a. values that are not finite or lie outside (0, 200];
b. spikes: one or two readings whose logarithm lies outside the expanded
   interquartile fences of the source's own increments on the same side of both
   the readings before and those after, while before and after agree;
c. stuck runs: a value repeated in more consecutive readings than the source's own
   share of chance repeats explains.

The increments are kept as quantile sketches (counts in logarithmic buckets, 1 %
relative error) per source, channel and hour of the day; sketches of parts of a source
merge by adding counts. What is typical of an hour leans on the whole source by a
fixed weight, so that hours with few readings borrow from it.

Scale: a source that holds a large share of all rows is cut into blocks of whole
minutes with a margin of neighbouring readings on both sides, so no task holds a
whole hot source; a reading finds its blocks by an equi-join on source and minute.
Sources below ``BLOCK_ROWS`` readings are one block and need one pass. Repeated
deliveries of one reading are reduced to one before the shuffle by source and joined
back by key at the end, so a heap of copies is never one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.session import checkpoint

TOP = 200.0
#: Fences lie this many interquartile ranges outside the quartiles.
FENCE = 2.6
AROUND = 5
#: Gamma of the sketch's buckets: neighbouring bounds differ by 2 %.
GAMMA = 1.02
MIN_RUN = 6
CHANCE = 1e-3
#: Hours of the day; what is typical of one leans on the whole source with the weight of so many increments.
HOURS, BORROWED = 24, 200
#: The unit of time that blocks consist of, in microseconds.
SLICE = 60_000_000
#: Sources with more readings are cut; at most one part in 100,000 of all readings, 50,000 at least.
BLOCK_ROWS = 50_000
MARGIN = 400
_LOG_GAMMA = np.log(GAMMA)
_FLOOR = 1e-4


def bucket(x: np.ndarray) -> np.ndarray:
    """Sketch bucket of each positive value."""
    return np.ceil(np.log(np.maximum(x, _FLOOR)) / _LOG_GAMMA).astype(np.int64)


def bucket_value(k: np.ndarray) -> np.ndarray:
    """The value that stands for a bucket, within 1 % of all in it."""
    return 2.0 * GAMMA ** np.asarray(k, float) / (GAMMA + 1.0)


def sketch_medians(keys: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sketch median of each and its count, from (key, bucket) pairs."""
    order = np.lexsort((buckets, keys))
    k, b = keys[order], buckets[order]
    starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, int)
    n = np.diff(np.r_[starts, len(k)])
    return k[starts], bucket_value(b[starts + (n - 1) // 2]), n


def _shifted(values: np.ndarray, group: np.ndarray, step: int) -> np.ndarray:
    """The value ``step`` places before (after, if negative) within the group, else NaN."""
    out = np.full(len(values), np.nan)
    if abs(step) >= len(values):
        return out
    if step > 0:
        same = group[step:] == group[:-step]
        out[step:] = np.where(same, values[:-step], np.nan)
    else:
        same = group[:step] == group[-step:]
        out[:step] = np.where(same, values[-step:], np.nan)
    return out


def _median5(rows: list[np.ndarray]) -> np.ndarray:
    """Median of up to five values per column, NaN where all miss."""
    m = np.sort(np.vstack(rows), axis=0)  # NaN last
    n = (~np.isnan(m)).sum(axis=0)
    cols = np.arange(m.shape[1])
    lo, hi = m[np.maximum((n - 1) // 2, 0), cols], m[np.minimum(n // 2, len(rows) - 1), cols]
    return np.where(n > 0, (lo + hi) / 2, np.nan)


def excursions(level: np.ndarray, group: np.ndarray) -> np.ndarray:
    """How far each level lies off what is around it, with the course resumed after.

    The smaller of the distances to the median of the five before and the five
    after; 0 where these are on different sides or differ by half as much again.
    """
    before = _median5([_shifted(level, group, s) for s in range(1, AROUND + 1)])
    after = _median5([_shifted(level, group, -s) for s in range(1, AROUND + 1)])
    a, b = level - before, level - after
    with np.errstate(invalid="ignore"):
        off = np.where(np.sign(a) == np.sign(b), np.minimum(np.abs(a), np.abs(b)), 0.0)
        off[np.abs(before - after) > 0.6 * off] = 0.0
    return np.nan_to_num(off)


def repeat_runs(values: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Length of the run of equal consecutive values that each value is in, and where runs start."""
    n = len(values)
    first = np.r_[True, (values[1:] != values[:-1]) | (group[1:] != group[:-1])] if n else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    length = np.diff(np.r_[starts, n])
    return np.repeat(length, length), first


def own_chance(values: np.ndarray, group: np.ndarray, length: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Share of repeats in the other runs of each run's own value, 0 with fewer than two others.

    On a coarse scale one value can be most of a series; its long runs are chance.
    """
    at = np.flatnonzero(first)
    _, value = np.unique(values[at], return_inverse=True)
    _, key = np.unique(group[at].astype(np.int64) * (value.max(initial=0) + 1) + value, return_inverse=True)
    size = length[at]
    runs = np.bincount(key)[key]
    rest = np.bincount(key, weights=size)[key] - size
    with np.errstate(divide="ignore", invalid="ignore"):
        p = np.where(runs > 2, (rest - (runs - 1)) / rest, 0.0)
    return np.repeat(p, size)


def run_bound(n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Length from which a run isn't chance, given the share of repeats."""
    p = np.clip(p, 1e-9, 0.95)
    with np.errstate(divide="ignore"):
        chance = 1 + np.log(CHANCE / np.maximum(n, 1)) / np.log(p)
    return np.maximum(MIN_RUN, np.ceil(chance))


def _matrix(table: pa.Table) -> np.ndarray:
    """Rows x channels: the overall, then the bands, NaN where there is none."""
    overall = table["overall"].combine_chunks().to_numpy(zero_copy_only=False).astype(float)
    bands = table["bands"].combine_chunks()
    lengths = np.nan_to_num(np.asarray(pa.compute.list_value_length(bands).to_numpy(zero_copy_only=False), float)).astype(int)
    flat = np.asarray(bands.flatten().to_numpy(zero_copy_only=False), float)
    out = np.full((len(overall), 1 + int(lengths.max(initial=0))), np.nan)
    out[:, 0] = overall
    rows = np.repeat(np.arange(len(overall)), lengths)
    cols = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + 1
    out[rows, cols] = flat
    return out


_OUT = "point long, ts long, vhash long, kind int, channel int, context int, off double, run int, value double, block long, edge int"


def _examine(table: pa.Table) -> Iterator[pd.DataFrame]:
    """Findings of some whole blocks, sorted by point, block and time.

    kind 0: a finding of a source that is one block. Of a source in several blocks
    kind 1 is a reading off its course or in a run that may be too long, kind 2 a
    part of a sketch (bucket in ``run``, count in ``vhash``), kind 3 a part of the
    counts of runs with the smallest step, kind 4 a part of the counts of a value's
    runs, kind 5 the first or last run of a block (``edge`` 1 or 2), which may go on
    in the next. Nothing of a source in several blocks is judged here.
    """
    point, block = table["point"].to_numpy(), table["block"].to_numpy()
    ts, vhash = table["ts"].to_numpy(), table["vhash"].to_numpy()
    core, whole = table["core"].to_numpy(zero_copy_only=False).astype(bool), block < 0
    group = np.cumsum(np.r_[True, (point[1:] != point[:-1]) | (block[1:] != block[:-1])]) - 1
    hours = (ts // 3_600_000_000) % HOURS
    m = _matrix(table)
    for channel in range(m.shape[1]):
        v = m[:, channel]
        with np.errstate(invalid="ignore"):
            at = np.flatnonzero(np.isfinite(v) & (v > 0) & (v <= TOP))
        if len(at) < 2:
            continue
        v, g = v[at], group[at]
        level = np.log(v)
        step = np.abs(level - _shifted(level, g, 1))
        has = np.flatnonzero(step > 0)
        off = excursions(level, g)
        run, first = repeat_runs(v, g)
        n = np.bincount(g, minlength=group[-1] + 1)
        runs = np.bincount(g[first], minlength=len(n))
        repeats = np.bincount(g[first & (run > 1)], minlength=len(n))
        # the sketches: of each hour context and, merged, of each source
        b = bucket(step[has])
        typical, smallest = np.full(len(n), np.nan), np.full(len(n), np.nan)
        k, med, _ = sketch_medians(g[has], b)
        typical[k] = med
        np.minimum.at(low := np.full(len(n), np.inf), g[has], step[has])
        smallest[np.isfinite(low)] = low[np.isfinite(low)]
        ck, cmed, cn = sketch_medians(g[has] * HOURS + hours[at][has], b)
        by_context = np.repeat(typical, HOURS)
        by_context[ck] = np.exp((cn * np.log(cmed) + BORROWED * np.log(by_context[ck])) / (cn + BORROWED))
        half = np.maximum(by_context[g * HOURS + hours[at]], smallest[g] / 2)
        c, w = core[at], whole[at]
        with np.errstate(invalid="ignore"):
            spike = off > half * (1 + 2 * FENCE)
            lone = run >= run_bound(n[g], own_chance(v, g, run, first))
            stuck = lone & (run >= run_bound(n, repeats / np.maximum(runs, 1))[g])
        rows = np.flatnonzero(w & (spike | stuck))
        if len(rows):
            yield pd.DataFrame({
                "point": point[at][rows], "ts": ts[at][rows], "vhash": vhash[at][rows], "kind": 0, "channel": channel,
                "context": hours[at][rows], "off": off[rows], "run": run[rows], "value": v[rows], "block": -1, "edge": 0,
            })
        parts = ~w & c
        if parts.any():
            of = np.flatnonzero(parts)
            length, opens = repeat_runs(v[of], g[of])
            place = np.cumsum(opens) - 1
            begins = np.r_[True, g[of][1:] != g[of][:-1]]
            ends = np.r_[begins[1:], True]
            which = np.cumsum(begins) - 1
            is_first, is_last = place == place[begins][which], place == place[ends][which]
            edge = np.where(is_first, 1, np.where(is_last, 2, 0))
            for kind, some in ((1, (off[of] > 0) | (length >= MIN_RUN) | (edge > 0)), (5, opens & (edge > 0))):
                rows = of[some]
                if len(rows):
                    yield pd.DataFrame({
                        "point": point[at][rows], "ts": ts[at][rows], "vhash": vhash[at][rows], "kind": kind, "channel": channel, "context": hours[at][rows],
                        "off": off[rows], "run": length[some], "value": v[rows], "block": block[at][rows], "edge": edge[some],
                    })
            mine = has[parts[has]]
            s = pd.DataFrame({"point": point[at][mine], "context": hours[at][mine], "run": bucket(step[mine])})
            s = s.groupby(["point", "context", "run"]).size().rename("vhash").reset_index()
            none = {"ts": 0, "channel": channel, "off": 0.0, "block": -1, "edge": 0}
            yield s.assign(kind=2, value=0.0, **none)
            small = np.full(len(at), np.inf)
            small[has] = step[has]
            t = pd.DataFrame({"point": point[at][parts], "vhash": 1, "run": (first & (run > 1))[parts], "context": first[parts], "value": small[parts]})
            t = t.groupby("point").agg(vhash=("vhash", "sum"), run=("run", "sum"), context=("context", "sum"), value=("value", "min")).reset_index()
            yield t.assign(kind=3, **none)
            u = pd.DataFrame({"point": point[at][parts], "value": v[parts], "run": 1, "context": first[parts]})
            u = u.groupby(["point", "value"]).agg(run=("run", "sum"), context=("context", "sum")).reset_index()
            yield u.assign(kind=4, vhash=0, **none)


def _examine_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feeds whole blocks to ``_examine``; a block over a batch's end waits for the next batch."""
    schema = pa.schema([
        ("point", pa.int64()), ("ts", pa.int64()), ("vhash", pa.int64()), ("kind", pa.int32()), ("channel", pa.int32()),
        ("context", pa.int32()), ("off", pa.float64()), ("run", pa.int32()), ("value", pa.float64()), ("block", pa.int64()), ("edge", pa.int32()),
    ])

    def emit(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if table.num_rows:
            for out in _examine(table.combine_chunks()):
                if len(out):
                    yield pa.RecordBatch.from_pandas(out[schema.names], schema=schema, preserve_index=False)

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < 200_000:
            continue
        table = pa.Table.from_batches(held)
        point, block = table["point"].to_numpy(), table["block"].to_numpy()
        last = np.flatnonzero((point != point[-1]) | (block != block[-1]))
        if len(last):
            cut = int(last[-1]) + 1
            yield from emit(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
            rows = table.num_rows - cut
    if held:
        yield from emit(pa.Table.from_batches(held))


def _blocks(placed: DataFrame, hot: DataFrame, limit: int) -> DataFrame:
    """(point, slice, block, core): the blocks that each minute of a source above ``limit`` readings belongs to.

    A block is the minutes whose first reading has the same place in units of ``limit``;
    it also has, not as its core, the minutes with the ``MARGIN`` readings before and
    after it. Blocks and minutes meet by an equi-join on these units.
    """
    counted = placed.join(F.broadcast(hot), "point", "left_semi").groupBy("point", F.floor(F.col("ts") / SLICE).alias("slice")).agg(F.count("*").alias("k"))
    upto = F.sum("k").over(Window.partitionBy("point").orderBy("slice"))
    minutes = counted.withColumn("end", upto).select("point", "slice", (F.col("end") - F.col("k")).alias("start"), "end").withColumn("block", F.floor(F.col("start") / limit))
    units = lambda lo, hi: F.explode(F.sequence(F.floor(lo / limit), F.floor((hi - 1) / limit))).alias("unit")
    extent = minutes.groupBy("point", "block").agg(F.greatest(F.min("start") - MARGIN, F.lit(0)).alias("lo"), (F.max("end") + MARGIN).alias("hi"))
    reach = extent.select("point", F.col("block").alias("of"), "lo", "hi", units(F.col("lo"), F.col("hi")))
    met = minutes.select("*", units(F.col("start"), F.col("end"))).join(reach, ["point", "unit"]).where((F.col("start") < F.col("hi")) & (F.col("end") > F.col("lo")))
    return met.select("point", "slice", F.col("of").alias("block"), (F.col("of") == F.col("block")).alias("core")).distinct()


def _settle(found: DataFrame) -> DataFrame:
    """Findings of sources in several blocks, judged by their merged sketches and counts as a source in one block is.

    The fences are a row per source, channel and hour of sources in several blocks.
    """
    keys = ["point", "channel"]
    sketch = found.where("kind = 2").groupBy(*keys, "context", "run").agg(F.sum("vhash").alias("k"))
    merged = sketch.groupBy(*keys, "run").agg(F.sum("k").alias("k")).withColumn("context", F.lit(-1))
    both = sketch.unionByName(merged)
    w = Window.partitionBy(*keys, "context")
    medians = (
        both.withColumn("upto", F.sum("k").over(w.orderBy("run")))
        .withColumn("n", F.sum("k").over(w))
        .where(F.col("upto") > F.floor((F.col("n") - 1) / 2))
        .groupBy(*keys, "context")
        .agg(F.min("run").alias("b"), F.first("n").alias("n"))
        .withColumn("typical", 2 * F.pow(F.lit(GAMMA), "b") / (GAMMA + 1))
    )
    counts = found.where("kind = 3").groupBy(*keys).agg(
        F.sum("vhash").alias("n"), F.sum("run").alias("repeats"), F.sum("context").alias("runs"), F.min("value").alias("smallest")
    )

    def bound(share: Column) -> Column:
        p = F.least(F.greatest(share, F.lit(1e-9)), F.lit(0.95))
        return F.greatest(F.lit(MIN_RUN), F.ceil(1 + F.log(F.lit(CHANCE) / F.col("n")) / F.log(p)))

    whole = medians.where("context = -1").select(*keys, F.col("typical").alias("whole"))
    fences = counts.join(whole, keys, "left").select(*keys, "n", bound(F.col("repeats") / F.greatest("runs", F.lit(1))).alias("bound"), "whole", (F.col("smallest") / 2).alias("least"))
    maybe = found.where("kind = 1")
    own = medians.where("context >= 0").select(*keys, "context", F.col("typical").alias("own"), F.col("n").alias("own_n"))
    borrowed = F.exp((F.col("own_n") * F.log("own") + BORROWED * F.log("whole")) / (F.col("own_n") + BORROWED))
    half = F.greatest(F.coalesce(borrowed, "whole"), F.when(F.col("whole").isNotNull(), F.col("least")))
    off = maybe.where("off > 0").join(own, [*keys, "context"], "left").join(fences, keys).where(F.col("off") > half * (1 + 2 * FENCE)).select("point", "ts", "vhash")
    # runs that go on from block to block are one
    w = Window.partitionBy(*keys).orderBy("block", "edge")
    goes_on = (F.col("edge") == 1) & F.coalesce(F.lag("value").over(w) == F.col("value"), F.lit(False))
    edges = found.where("kind = 5").withColumn("new", (~goes_on).cast("int")).withColumn("one", F.sum("new").over(w))
    joined = edges.withColumn("total", F.sum(F.col("run").cast("long")).over(Window.partitionBy(*keys, "one"))).select(*keys, "block", "edge", "total")
    runs = (
        maybe.where(f"edge > 0 or run >= {MIN_RUN}")
        .join(joined, [*keys, "block", "edge"], "left")
        .withColumn("run", F.coalesce("total", F.col("run").cast("long")))
        .where(F.col("run") >= MIN_RUN)
        .join(fences, keys)
        .where(F.col("run") >= F.col("bound"))
        .select("point", "ts", "vhash", "channel", "value", "run", "n")
    )
    same = found.where("kind = 4").groupBy(*keys, "value").agg(F.sum("run").alias("all"), F.sum("context").alias("times"))
    rest = F.col("all") - F.col("run")
    own = F.when(F.col("times") > 2, (rest - (F.col("times") - 1)) / rest).otherwise(F.lit(0.0))
    stuck = runs.join(same, [*keys, "value"]).where(F.col("run") >= bound(own)).select("point", "ts", "vhash")
    return off.unionByName(stuck)


def implausible_readings(readings: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``reading_id`` of every reading whose overall or any band is implausible.

    Defined cases: null overalls, bands and whole arrays are no values and no cases;
    a reading without a time or point is judged by rule (a) only; copies of a
    reading (same point, time and values) are judged once and all come out; an
    empty table gives no rows; other columns are ignored.
    """
    typed = readings.select(
        "reading_id",
        F.col("point_record_num").cast("long").alias("point"),
        F.unix_micros("timestamp_utc").alias("ts"),
        F.col("overall_raw").cast("float").alias("overall"),
        F.col("bands_raw").cast("array<float>").alias("bands"),
    ).withColumn("vhash", F.xxhash64("overall", "bands"))
    bad = lambda x: F.isnan(x) | (x <= 0) | (x > TOP)
    no_value = F.coalesce(bad(F.col("overall")), F.lit(False)) | F.coalesce(
        F.exists("bands", lambda x: F.coalesce(bad(x), F.lit(False))), F.lit(False)
    )
    placed = typed.where(F.col("point").isNotNull() & F.col("ts").isNotNull())
    counts = placed.groupBy("point").agg(F.count("*").alias("n"))
    top = counts.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    limit = max(block_rows, int((top["all"] or 0) / 100_000))
    columns = ["point", "ts", "vhash", "overall", "bands"]
    some_hot = (top["most"] or 0) > limit
    cold = placed.select(*columns)
    if some_hot:
        # at most all/limit <= 100,000 sources are hot, whatever the data
        hot = counts.where(F.col("n") > limit).select("point")
        cold = cold.join(F.broadcast(hot), "point", "left_anti")
    laid = cold.distinct().withColumn("block", F.lit(-1).cast("long")).withColumn("core", F.lit(True))
    if some_hot:
        warm = placed.select(*columns).join(F.broadcast(hot), "point", "left_semi").distinct().withColumn("slice", F.floor(F.col("ts") / SLICE))
        laid = laid.unionByName(warm.join(_blocks(placed.select("point", "ts"), hot, limit), ["point", "slice"]).select(*columns, "block", "core"))
    ordered = laid.repartition("point", "block").sortWithinPartitions("point", "block", "ts", "vhash")
    found = ordered.mapInArrow(_examine_partition, _OUT)
    if some_hot:
        found = checkpoint(found)
        cases = found.where("kind = 0").select("point", "ts", "vhash").unionByName(_settle(found)).distinct()
    else:
        cases = found.where("kind = 0").select("point", "ts", "vhash").distinct()
    ids = typed.select("reading_id", "point", "ts", "vhash", no_value.alias("no_value"))
    cases = cases.withColumn("case", F.lit(True))
    return (
        ids.join(cases, ["point", "ts", "vhash"], "left")
        .where(F.col("no_value") | F.col("case").isNotNull())
        .select("reading_id")
    )
