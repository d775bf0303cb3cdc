"""Linked lists as edges: every node of every chain with its place, by set doubling.

In round k the nodes up to 2^k steps from a head are known and every edge is replaced
by the edge 2^k steps long; the number of rounds is the logarithm of the longest
chain, whatever the number of heads. Rounds are cut with reliable checkpoints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.session import checkpoint


def follow(heads: DataFrame, edges: DataFrame, cap: int = 4096) -> DataFrame:
    """(head, node, hop) for ``heads(head)`` and ``edges(node, nxt)``; hops from 0, below ``cap``.

    A chain ends at a null or missing successor. Chains may share nodes and start in
    the middle of others. In a cycle nodes come again until the cap: see ``faults``.
    """
    jump = checkpoint(edges.where(F.col("nxt").isNotNull()).select("node", "nxt"))
    seen = checkpoint(heads.select("head", F.col("head").alias("node"), F.lit(0).alias("hop")).where(F.col("head").isNotNull()).distinct())
    step = 1
    while step < cap:
        more = checkpoint(seen.join(jump, "node").select("head", F.col("nxt").alias("node"), (F.col("hop") + step).alias("hop")).where(F.col("hop") < cap))
        if more.isEmpty():
            break
        seen = seen.unionByName(more)
        far = jump.select(F.col("node").alias("nxt"), F.col("nxt").alias("far"))
        jump = checkpoint(jump.join(far, "nxt").select("node", F.col("far").alias("nxt")))
        step *= 2
    return seen


def faults(chains: DataFrame, edges: DataFrame, nodes: DataFrame, cap: int = 4096) -> DataFrame:
    """(head, fault) of broken chains: cycle, too_long, or missing (a node that isn't among ``nodes(node)``)."""
    cycle = chains.groupBy("head", "node").agg(F.count("*").alias("k")).where("k > 1").select("head").distinct().withColumn("fault", F.lit("cycle"))
    last = chains.where(F.col("hop") == cap - 1).join(edges.where("nxt is not null").select("node"), "node").select("head").distinct()
    long = last.join(cycle, "head", "left_anti").withColumn("fault", F.lit("too_long"))
    missing = chains.join(nodes.select("node"), "node", "left_anti").select("head").distinct().withColumn("fault", F.lit("missing"))
    return cycle.unionByName(long).unionByName(missing.join(cycle, "head", "left_anti"))


def sound(chains: DataFrame, broken: DataFrame) -> DataFrame:
    """Chains without those that are broken anywhere."""
    return chains.join(broken.select("head").distinct(), "head", "left_anti")


def debug_walk(records: DataFrame, start: int, at: int, max_steps: int = 32) -> list[tuple[int, int | None, str | None]]:
    """(record, what is stored as next, why the walk stops there) of at most ``max_steps`` records from one on.

    For looking at single chains: each step looks one record up. The number at byte
    ``at`` is taken as it is, 0 ends the chain.
    """
    out: list[tuple[int, int | None, str | None]] = []
    seen: set[int] = set()
    current = start
    while len(out) < max_steps:
        if current in seen:
            out.append((current, None, "cycle"))
            return out
        row = records.where(F.col("record_num") == current).select("rec").first()
        if row is None:
            out.append((current, None, "out of range"))
            return out
        seen.add(current)
        stored = int.from_bytes(bytes(row["rec"])[at : at + 4], "little")
        out.append((current, stored, "end" if stored == 0 else None))
        if stored == 0:
            return out
        current = stored
    return [*out[:-1], (*out[-1][:2], out[-1][2] or "max steps")]
