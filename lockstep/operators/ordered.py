"""Operators on ordered sequences: runs, patterns, as-of lookups, merged intervals, prefixes.

All work within ``keys``, so that many recordings spread over a cluster; only the order
within one recording is sequential. Rows keep an explicit ordinal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def runs(df: DataFrame, keys: list[str], order: str, value: Column, *aggregates: Column) -> DataFrame:
    """Maximal runs of consecutive rows with an equal, non-null value: keys, run, value, first and last order, length."""
    w = Window.partitionBy(*keys).orderBy(order)
    marked = df.withColumn("_v", value).withColumn("_new", (~F.col("_v").eqNullSafe(F.lag("_v").over(w))) | (F.row_number().over(w) == 1))
    numbered = marked.withColumn("run", F.sum(F.col("_new").cast("int")).over(w))
    return numbered.where("_v is not null").groupBy(*keys, "run").agg(F.first("_v").alias("value"), F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("length"), *aggregates)


def islands(df: DataFrame, keys: list[str], order: str, inside: Column, *aggregates: Column) -> DataFrame:
    """Maximal stretches of consecutive ordinals where inside holds: keys, first, last, aggregates.

    Rows outside are dropped before the sort: the difference of the ordinal and the row number tells stretches apart.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    kept = df.where(inside).withColumn("_g", F.col(order) - F.row_number().over(w))
    return kept.groupBy(*keys, "_g").agg(F.min(order).alias("first"), F.max(order).alias("last"), *aggregates).drop("_g")


def block_runs(df: DataFrame, keys: list[str], order: str, value: Column, block: int = 1 << 16, **largest: Column) -> DataFrame:
    """Maximal runs of consecutive ordinals with an equal, non-null value: keys, value, first, last, and the largest of each column asked for.

    Runs are found block by block of ordinals. Those that reach a block's first or last ordinal are then joined across blocks: two rows a block at most,
    so that no window holds more than a block, or as many rows as there are blocks.
    """
    at = df.withColumn("_v", value).where("_v is not null").withColumn("_b", F.floor(F.col(order) / block)).select(*keys, "_b", "_v", F.col(order).alias("_o"), *(c.alias(f"_m_{n}") for n, c in largest.items()))
    inner = Window.partitionBy(*keys, "_b", "_v").orderBy("_o")
    tops = lambda: (F.max(f"_m_{n}").alias(f"_m_{n}") for n in largest)
    found = at.withColumn("_g", F.col("_o") - F.row_number().over(inner)).groupBy(*keys, "_b", "_v", "_g").agg(F.min("_o").alias("first"), F.max("_o").alias("last"), *tops())
    open_ = (F.col("first") == F.col("_b") * block) | (F.col("last") == F.col("_b") * block + block - 1)
    placed = found.withColumn("_p", F.when(open_, F.lit(None).cast("long")).otherwise(F.col("_b")))
    w = Window.partitionBy(*keys, "_p").orderBy("first")
    goes_on = F.col("_v").eqNullSafe(F.lag("_v").over(w)) & (F.lag("last").over(w) + 1 == F.col("first"))
    numbered = placed.withColumn("_new", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(w))
    joined = numbered.groupBy(*keys, "_p", "_run").agg(F.first("_v").alias("value"), F.min("first").alias("first"), F.max("last").alias("last"), *tops())
    return joined.select(*keys, "value", "first", "last", *(F.col(f"_m_{n}").alias(n) for n in largest))


def matches_at(keys: list[str], order: str, column: str, pattern: list[str]) -> Column:
    """Whether the given pattern starts at a row."""
    w = Window.partitionBy(*keys).orderBy(order)
    hit = F.lit(True)
    for i, x in enumerate(pattern):
        hit = hit & F.coalesce((F.lead(column, i).over(w) if i else F.col(column)) == x, F.lit(False))
    return hit


def within_match(keys: list[str], order: str, start: Column | str, length: int, at: int | None = None) -> Column:
    """Whether a row belongs to a match that starts (column start) at it or up to length - 1 rows before; or is its at-th row."""
    w = Window.partitionBy(*keys).orderBy(order)
    offsets = range(length) if at is None else [at]
    return F.coalesce(*[F.when(F.lag(start, i).over(w) if i else F.col(start), True) for i in offsets], F.lit(False))


def as_of(left: DataFrame, right: DataFrame, keys: list[str], time: str, value: str, name: str, forward: bool = False) -> DataFrame:
    """left with the value of the last row of right at or before its time (forward: the first at or after), null if none.

    A union and one window in place of a range join: linear in both sides.
    """
    both = left.withColumn("_side", F.lit(0 if forward else 1)).withColumn(name, F.lit(None).cast(right.schema[value].dataType))
    other = right.select(*keys, F.col(time), F.col(value).alias(name), F.lit(1 if forward else 0).alias("_side"))
    rows = both.unionByName(other, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(*((F.desc(time), F.desc("_side")) if forward else (F.asc(time), F.asc("_side")))).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(name, True).over(w)).where(F.col("_side") == (0 if forward else 1)).drop("_side")


def overlap_groups(df: DataFrame, keys: list[str], start: str, end: str, order: str, name: str = "gap_group_index") -> DataFrame:
    """Numbers of groups of overlapping intervals; a null start is open before all, a null end after all.

    A group goes on while a start does not exceed the latest end so far; an interval counts at least one past its start.
    """
    low = F.coalesce(F.col(start).cast("double"), F.lit(float("-inf")))
    high = F.coalesce(F.col(end).cast("double"), F.lit(float("inf")))
    high = F.when(F.col(end).isNull(), high).otherwise(F.greatest(high, low + 1))
    w = Window.partitionBy(*keys).orderBy("_low", order)
    marked = df.withColumn("_low", low).withColumn("_high", high)
    before = F.max("_high").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = marked.withColumn("_new", F.coalesce(F.col("_low") > before, F.lit(True)).cast("int"))
    return marked.withColumn(name, F.sum("_new").over(w).cast("int")).drop("_low", "_high", "_new")
