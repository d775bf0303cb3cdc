"""Mixing of sources to target shares of a corpus' tokens.

Method: systematic sampling. Every document of a source has the same expected number
of copies, its source's share of the mix over its tokens; these are summed along the
source's documents, one random offset is added, and a document is emitted once for
each whole number that its stretch crosses. A mix is as large as the repeat caps
allow: some capped source is used up exactly.

Documents are laid out by size class, then by hash, so that large and small ones are
drawn evenly and a source's tokens come close to its share.

Scale: token counts are made once and stored. A document's place in its source is the
offset of its cell (size class x 1024 hash slices) plus its rank in the cell, so no task
holds a whole source; the cells are counted with a map-side combine. What goes to the
driver is one row per source that a mix names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.encoding import DEFAULT, count_tokens
from tremor.session import checkpoint

SOURCES_LIMIT = 100_000
#: Hash slices of a size class, the same for every corpus, so that a document keeps its place among the others as the corpus grows.
SLICES = 1024


def source_key(source: Column) -> Column:
    """Lower case without outer blanks; blank is null."""
    return F.nullif(F.lower(F.trim(source)), F.lit(""))


def mix_plan(targets: list[tuple[str, str, float, int | None]], sizes: dict[str, tuple[int, int]]) -> list[dict]:
    """One row per mix and source: share, expected copies of each document, tokens wanted.

    ``targets``: (mix, source, share, cap). ``sizes``: source -> (documents, tokens).
    Shares are relative to those sources of the mix that have tokens and may be used
    at least once. The mix has as many tokens as the tightest cap allows; without any
    cap as many as its sources have. A source named twice in a mix has the sum of its
    shares and the smaller cap; shares of zero, less, or null don't count.
    """
    mixes: dict[str, dict[str, list]] = {}
    for mix, source, share, cap in targets:
        row = mixes.setdefault(mix, {}).setdefault(source, [0.0, None])
        row[0] += max(share or 0.0, 0.0)
        row[1] = cap if row[1] is None else row[1] if cap is None else min(cap, row[1])
    out = []
    for mix, sources in sorted(mixes.items()):
        usable = {s for s, (share, cap) in sources.items() if share > 0 and sizes.get(s, (0, 0))[1] > 0 and (cap is None or cap >= 1)}
        whole = sum(sources[s][0] for s in usable)
        limits = {s: sources[s][1] * sizes[s][1] / (sources[s][0] / whole) for s in usable if sources[s][1] is not None}
        total = min(limits.values()) if limits else sum(sizes[s][1] for s in usable)
        for s, (share, cap) in sorted(sources.items()):
            part = share / whole if s in usable else 0.0
            documents, tokens = sizes.get(s, (0, 0))
            copies = total * part / tokens if s in usable else 0.0
            if cap is not None:
                copies = min(copies, float(cap))  # the tightest cap, met up to rounding
            out.append({
                "mix_name": mix, "source": s, "asked_share": float(share), "target_share": part, "max_repeats": cap, "copies_each": copies,
                "documents": documents, "available_tokens": tokens, "wanted_tokens": copies * tokens,
            })
    return out


_PLAN = (
    "mix_name string, source string, asked_share double, target_share double, max_repeats int, copies_each double, "
    "documents long, available_tokens long, wanted_tokens double"
)


def document_places(sized: DataFrame, slices: int = SLICES) -> DataFrame:
    """Each document's place among its source's documents, from 0: by size class, hash slice, size, id."""
    laid = sized.select(
        "doc_id", "source", "n_tokens",
        F.floor(F.log2(F.col("n_tokens")) * 8).cast("int").alias("cls"),
        F.pmod(F.xxhash64("doc_id"), F.lit(slices)).cast("int").alias("slice"),
    )
    cells = laid.groupBy("source", "cls", "slice").agg(F.count("*").alias("k"))
    before = Window.partitionBy("source").orderBy("cls", "slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("source", "cls", "slice", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("source", "cls", "slice").orderBy("n_tokens", "doc_id"))
    return (
        laid.withColumn("rank", rank)
        .join(offsets, ["source", "cls", "slice"])
        .select("doc_id", "source", "n_tokens", (F.col("offset") + F.col("rank") - 1).alias("place"))
    )


def _sized(documents: DataFrame, targets: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Documents with tokens of the sources that a mix names, and the plan of all mixes."""
    spark = documents.sparkSession
    wanted = targets.select(
        "mix_name", source_key(F.col("source")).alias("source"), F.col("target_share").cast("double"), F.col("max_repeats").cast("int")
    ).where(F.col("mix_name").isNotNull() & F.col("source").isNotNull())
    rows = wanted.limit(SOURCES_LIMIT + 1).collect()
    if len(rows) > SOURCES_LIMIT:
        raise ValueError(f"more than {SOURCES_LIMIT} targets")
    named = sorted({r["source"] for r in rows})
    keyed = documents.withColumn("source", source_key(F.col("source")))
    # the names are at most SOURCES_LIMIT rows, which was just checked
    names = F.broadcast(spark.createDataFrame([(n,) for n in named], "source string"))
    sized = checkpoint(count_tokens(keyed.join(names, "source", "left_semi"), path).where("n_tokens > 0"))
    sizes = {r["source"]: (r["k"], r["n"]) for r in sized.groupBy("source").agg(F.count("*").alias("k"), F.sum("n_tokens").alias("n")).collect()}
    plan = mix_plan([(r["mix_name"], r["source"], r["target_share"], r["max_repeats"]) for r in rows], sizes)
    return sized, spark.createDataFrame([tuple(p.values()) for p in plan], _PLAN)


def _select(sized: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    offset = F.pmod(F.xxhash64("mix_name", "source", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    lines = F.broadcast(plan.where("copies_each > 0").select("mix_name", "source", "copies_each", offset.alias("_u")))  # at most SOURCES_LIMIT rows
    crossed = lambda place: F.floor(place * F.col("copies_each") + F.col("_u"))
    return (
        document_places(sized)
        .join(lines, "source")
        .withColumn("copies", (crossed(F.col("place") + 1) - crossed(F.col("place"))).cast("int"))
        .where("copies > 0")
        .select("mix_name", "source", "doc_id", "n_tokens", "copies")
    )


def mix_sources(documents: DataFrame, targets: DataFrame, path: str = DEFAULT, seed: int = 7) -> DataFrame:
    """The selection of every mix: mix_name, source, doc_id, n_tokens, copies.

    Defined cases: documents without source or without tokens (null, empty) are never
    selected; sources differ neither by case nor by outer blanks; each row of a
    repeated doc_id is a document; a mix whose sources are all empty selects nothing.
    """
    return _select(*_sized(documents, targets, path), seed)


def mix_report(documents: DataFrame, targets: DataFrame, path: str = DEFAULT, seed: int = 7) -> DataFrame:
    """What each source was asked for and has reached, one row per mix and source."""
    sized, plan = _sized(documents, targets, path)
    got = _select(sized, plan, seed).groupBy("mix_name", "source").agg(
        F.count("*").alias("used_documents"), F.sum("copies").alias("copies"), F.max("copies").alias("most_repeats"),
        F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"),
    )
    all_ = Window.partitionBy("mix_name")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return plan.join(got, ["mix_name", "source"], "left").select(
        *plan.columns, zero(F.col("used_documents")).alias("used_documents"), zero(F.col("copies")).alias("copies"), zero(F.col("most_repeats")).alias("most_repeats"),
        zero(F.col("tokens")).alias("tokens"), (zero(F.col("tokens")) / F.sum(zero(F.col("tokens"))).over(all_)).alias("reached_share"),
    )
