"""Ordered logic: precedence, validity, carrying forward, first and longest of a group.

All are windows over one key; ties are broken by every order given, so results
don't depend on the rows' order. Nulls in keys are a key of their own.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_per_key(df: DataFrame, keys: list[str], order: Iterable[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key under ``order``."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def latest_primary(df: DataFrame, keys: list[str], kind: str = "record_kind", date: str = "inspection_date", tie: Iterable[str] = ("document_id", "observation_id")) -> DataFrame:
    """Primary records beat retrospective ones, then the latest date, then the last of ``tie``."""
    order = [F.desc(F.coalesce((F.col(kind) == "primary").cast("int"), F.lit(0))), F.desc(F.coalesce(F.col(date), F.lit("")))]
    return best_per_key(df, keys, order + [F.desc_nulls_last(t) for t in tie])


def valid_until(df: DataFrame, keys: list[str], since: str, until: str = "valid_to") -> DataFrame:
    """The next ``since`` of the same key, null while open."""
    return df.withColumn(until, F.lead(since).over(Window.partitionBy(*keys).orderBy(since)))


def carried_forward(df: DataFrame, keys: list[str], order: list[str], column: str, out: str) -> DataFrame:
    """The last value that isn't null up to each row."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(column, ignorenulls=True).over(w))


def shifted_dates(df: DataFrame, keys: list[str], order: str, next_at: str, first_at: Column, out: str, block: Column) -> DataFrame:
    """A slot that stores its successor's date has its own in the slot before it.

    ``block`` never falls in ``order`` (a day, say): rows are ordered within a key's
    block only, and a block's first row looks at the last row of the block before, of
    which there is one per block; so a key with many rows is no window of its own.
    """
    placed = df.withColumn("_block", block)
    within = Window.partitionBy(*keys, "_block").orderBy(order)
    ends = placed.groupBy(*keys, "_block").agg(F.max_by(next_at, order).alias("_end"))
    before = ends.withColumn("_before", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_block"))).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_block").alias("_b"), "_before")
    same = F.col("_block").eqNullSafe(F.col("_b"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    # of rows that have one before them in the block, its value counts, also if it is null
    own = F.when(F.row_number().over(within) > 1, F.lag(next_at).over(within)).otherwise(F.col("_before"))
    joined = placed.join(before, same, "left").withColumn(out, F.coalesce(own, first_at))
    return joined.drop("_block", "_b", "_before", *[f"_{k}" for k in keys])


def take_while(df: DataFrame, keys: list[str], order: list[str], valid: Column) -> DataFrame:
    """Rows up to the first that isn't valid; a null isn't.

    The first that isn't valid is an aggregate that combines before the shuffle, so a
    key with many rows is no window of its own.
    """
    place = F.struct(*order)
    bad = df.where(~F.coalesce(valid, F.lit(False)))
    stop = bad.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(place).alias("_stop"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(stop, same, "left").where(F.col("_stop").isNull() | (place < F.col("_stop"))).drop("_stop", *[f"_{k}" for k in keys])


def skip_then_take(df: DataFrame, keys: list[str], order: str, valid: Column) -> DataFrame:
    """The first stretch of valid rows, whatever comes before it."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    hit = F.coalesce(valid, F.lit(False)).cast("int")
    return (
        df.withColumn("_hit", hit)
        .withColumn("_begun", F.max("_hit").over(w))
        .withColumn("_broken", F.sum(F.when((F.col("_begun") == 1) & (F.col("_hit") == 0), 1).otherwise(0)).over(w))
        .where("_hit = 1 and _broken = 0")
        .drop("_hit", "_begun", "_broken")
    )


def longest_per_key(df: DataFrame, keys: list[str], text: str, order: Iterable[Column]) -> DataFrame:
    """The longest text of each key, the first of equals.

    The planner keeps the best of each key before the shuffle, so few texts travel.
    """
    return best_per_key(df.where(F.col(text).isNotNull()), keys, [F.desc(F.length(text)), *order])


def indexed(df: DataFrame, keep: list[str], items: Column, item: str, index: str) -> DataFrame:
    """One row per item with a contiguous index from 0; nulls and empty strings don't count."""
    return df.select(*keep, F.posexplode(F.filter(items, lambda x: x.isNotNull() & (x != ""))).alias(index, item))


def zipped(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str]) -> DataFrame:
    """Left rows beside the right rows of the same place, nulls where right is shorter.

    For short lists (directories, pointer tables): the places are counted over one
    partition.
    """
    a = left.withColumn("ordinal", F.row_number().over(Window.orderBy(*left_order)) - 1)
    b = right.withColumn("ordinal", F.row_number().over(Window.orderBy(*right_order)) - 1)
    return a.join(b, "ordinal", "left")


def disagreements(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Keys that have more than one value, with all of them in order."""
    return (
        df.groupBy(*keys).agg(F.array_sort(F.collect_set(column)).alias("values")).where(F.size("values") > 1)
    )
