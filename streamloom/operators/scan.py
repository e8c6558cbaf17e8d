"""Ordered scans over keys of any size.

A window partitioned by a key alone puts all of that key's rows into one task.
Here every key is cut into blocks along its order (a range of positions or of
time). Rows are scanned inside (key, block); one small row per block is scanned
per key; and what the earlier blocks carry over is joined back to the rows. A
key that holds a third of the table is thus spread over as many tasks as it has
blocks, and only block summaries meet in one place.

All keys travel as one struct column, so null keys equal each other and a join
on (KEY, block) reuses the partitioning of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamloom.operators.shared import OWN

KEY = f"{OWN}key"
BLOCK = f"{OWN}block"
START, END, HEAD, LATEST = f"{OWN}s", f"{OWN}e", f"{OWN}h", f"{OWN}l"


def block_of(order: Column, size: int) -> Column:
    """The block of a position or of a time: floor(order / size)."""
    return F.floor(order / F.lit(size)).cast("long")


def packed(keys: list[str]) -> Column:
    return F.struct(*[F.col(k).alias(f"k{n}") for n, k in enumerate(keys)]).alias(KEY)


def unpacked(keys: list[str]) -> list[Column]:
    return [F.col(f"{KEY}.k{n}").alias(k) for n, k in enumerate(keys)]


def carried(df: DataFrame, value: Column, how: str, name: str) -> DataFrame:
    """Adds `name`: what the blocks before a row's own block hand over.

    `value` is an aggregate that gives a block's value; how: "max" or "sum" of it
    over all earlier blocks, "last" non-null one before, or "next" non-null one
    after. df is read twice; it should be a scan or cheap to compute.
    """
    v = f"{OWN}v"
    per_block = df.groupBy(KEY, BLOCK).agg(value.alias(v))
    before = Window.partitionBy(KEY).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(KEY).orderBy(F.desc(BLOCK)).rowsBetween(Window.unboundedPreceding, -1)
    over = {
        "max": F.max(v).over(before),
        "sum": F.sum(v).over(before),
        "last": F.last(v, ignorenulls=True).over(before),
        "next": F.last(v, ignorenulls=True).over(after),
    }[how]
    return df.join(per_block.select(KEY, BLOCK, over.alias(name)), [KEY, BLOCK], "left")


def headed(local: DataFrame, gap: int) -> DataFrame:
    """Adds HEAD, the start of the whole key's session that a block's session is part of, and LATEST, the latest end before it (null at the first).

    local: (KEY, BLOCK, START, END, ...), whose sessions are more than `gap` apart inside a block.
    A block hands on its latest end and its last start, so one row per block tells both: what
    starts within `gap` of the ends carried in continues the last session begun before the block.
    """
    c, last, begun = f"{OWN}c", f"{OWN}ls", f"{OWN}bg"
    before = Window.partitionBy(KEY).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = local.groupBy(KEY, BLOCK).agg(F.max(END).alias(END), F.max(START).alias(last)).withColumn(c, F.max(END).over(before))
    fresh = lambda s: F.col(c).isNull() | (F.col(s) > F.col(c) + F.lit(gap))
    blocks = blocks.select(KEY, BLOCK, c, F.last(F.when(fresh(last), F.col(last)), ignorenulls=True).over(before).alias(begun))
    inside = Window.partitionBy(KEY, BLOCK).orderBy(START)
    df = local.join(blocks, [KEY, BLOCK], "left")
    return df.withColumn(HEAD, F.when(fresh(START), F.col(START)).otherwise(F.col(begun))).withColumn(LATEST, F.greatest(F.lag(END).over(inside), F.col(c))).drop(c, begun)


def joined(local: DataFrame, gap: int, aggregates: list[Column]) -> DataFrame:
    """Sessions of the whole key from block sessions: (KEY, START, END, aggregates)."""
    df = headed(local, gap).drop(LATEST)
    return df.groupBy(KEY, HEAD).agg(F.max(END).alias(END), *aggregates).withColumnRenamed(HEAD, START)
