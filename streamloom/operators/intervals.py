"""Continuous periods and gaps of overlapping time intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamloom.operators.scan import BLOCK, END, HEAD, KEY, LATEST, START, block_of, headed, joined, packed, unpacked
from streamloom.operators.shared import OWN, require_columns, write_and_read

#: Milliseconds of a time block: the unit over which a hot key is spread.
BLOCK_MS = 600_000


def millis(seconds: Column) -> Column:
    """Seconds as whole milliseconds, rounded half up; NaN and null give null."""
    return F.when(~F.isnan(seconds), F.round(seconds * 1000).cast("long"))


def periods_and_gaps(df: DataFrame, keys: list[str], start: str, end: str, block_ms: int = BLOCK_MS) -> DataFrame:
    """Maximal covered periods of each key, and the gaps between them.

    Input: `start` and `end` in whole milliseconds. Rows with a null bound, or
    whose end is not after their start, cover nothing and are left out. Touching
    intervals make one period. Null keys form a group of their own. Repeated
    rows change nothing; an empty table gives none. Other columns are ignored,
    whatever their names.
    Output: keys, piece ("period" or "gap"), start_ms, end_ms; a gap lies between
    two successive periods only.

    Spark's session_window merges the rows inside (key, time block); its gap is
    each row's own duration, and rows that touch merge too. The few sessions left
    are written to the shared folder once; those that overlap or touch over block
    edges are joined from block summaries, so no task ever holds a whole key. A
    gap is read off each period's head: it runs from the latest end before it.
    """
    require_columns(df, [*keys, start, end], "periods_and_gaps")
    t = f"{OWN}t"
    rows = df.select(packed(keys), F.col(start).cast("long").alias(START), F.col(end).cast("long").alias(END)).where(F.col(END) > F.col(START))
    rows = rows.withColumn(BLOCK, block_of(F.col(START), block_ms)).withColumn(t, F.timestamp_millis(START))
    window = F.session_window(t, F.concat((F.col(END) - F.col(START)).cast("string"), F.lit(" milliseconds")))
    local = rows.groupBy(KEY, BLOCK, window.alias(t)).agg(F.min(START).alias(START), F.max(END).alias(END)).drop(t)
    local = write_and_read(local, "periods")
    periods = joined(local, 0, []).select(*unpacked(keys), F.lit("period").alias("piece"), F.col(START).alias("start_ms"), F.col(END).alias("end_ms"))
    gaps = headed(local, 0).where((F.col(HEAD) == F.col(START)) & F.col(LATEST).isNotNull())
    gaps = gaps.select(*unpacked(keys), F.lit("gap").alias("piece"), F.col(LATEST).alias("start_ms"), F.col(START).alias("end_ms"))
    return periods.unionByName(gaps)
