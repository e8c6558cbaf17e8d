"""Pairing records with the nearest record in time of the same entity.

Each entity's times are cut into shards. In a shard the sorted distinct times are
described by a piecewise-linear learned index: segments whose line predicts every
position within a fixed error. A probe asks the line of its segment for a
position and searches only the few sorted entries the error allows, so the
neighbours found are exact. Shard edges overlap by the tolerance, so no pair is
lost between shards, and a hot entity is spread over as many tasks as it has
shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamloom.operators.arrow_groups import starts, whole_groups
from streamloom.operators.scan import block_of, packed
from streamloom.operators.shared import OWN, require_columns

#: Milliseconds of a shard, entries of error an index segment may have, rows a worker holds at once.
SHARD_MS = 600_000
ERROR = 8
CHUNK_ROWS = 400_000


class LearnedIndex:
    """Piecewise-linear index over sorted distinct values inside groups.

    group, value: arrays sorted by (group, value) without repeats. Segments start
    as whole groups and are halved until the line through a segment's end points
    predicts each of its positions within `error`.
    """

    def __init__(self, group: np.ndarray, value: np.ndarray, error: int = ERROR):
        self.value, self.error = value, error
        n = len(value)
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, np.int64)
        last = np.r_[first[1:], n] - 1 if n else first
        self.group_first, self.group_last, self.group_id = first, last, group[first] if n else group
        done_a, done_b = [], []
        a, b = first.astype(np.int64), last.astype(np.int64)
        while len(a):
            size = b - a + 1
            at = np.repeat(a, size) + (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
            miss = np.abs(self._line(np.repeat(a, size), np.repeat(b, size), value[at]) - at)
            worst = np.maximum.reduceat(miss, np.cumsum(size) - size)
            good = worst <= error
            done_a.append(a[good])
            done_b.append(b[good])
            a, b = a[~good], b[~good]
            mid = (a + b) // 2
            a, b = np.r_[a, mid + 1], np.r_[mid, b]
        self.first = np.sort(np.concatenate(done_a)) if done_a else np.zeros(0, np.int64)
        self.last = np.sort(np.concatenate(done_b)) if done_b else np.zeros(0, np.int64)
        self.first_value = value[self.first]
        # The number of each group's first segment.
        self.segment_of_group = np.searchsorted(self.first, first)
        self.segments_in_group = np.diff(np.r_[self.segment_of_group, len(self.first)])

    def _line(self, a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
        va, vb = self.value[a], self.value[b]
        span = np.maximum(vb - va, 1)
        return a + np.rint((b - a) * ((x - va) / span)).astype(np.int64)

    def lower_bound(self, group: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Position of the first value >= x in its group, and the group's first and last position.

        Groups that the index doesn't hold give an empty range (first > last).
        """
        g = np.minimum(np.searchsorted(self.group_id, group), max(len(self.group_id) - 1, 0))
        known = self.group_id[g] == group if len(self.group_id) else np.zeros(len(group), bool)
        lo_seg, count = self.segment_of_group[g], self.segments_in_group[g]
        # The last segment of the group whose first value is not above x, by halving.
        lo, hi = lo_seg.copy(), lo_seg + count - 1
        while np.any(lo < hi):
            mid = (lo + hi + 1) // 2
            up = self.first_value[mid] <= x
            lo, hi = np.where(up, mid, lo), np.where(up, hi, mid - 1)
        a, b = self.first[lo], self.last[lo]
        guess = np.clip(self._line(a, b, x), a, b)
        # The answer lies within the error of the guess, or just behind the segment.
        left = np.maximum(guess - self.error - 1, a)
        width = np.arange(2 * self.error + 3)
        at = left[:, None] + width[None, :]
        inside = at <= b[:, None]
        below = inside & (self.value[np.minimum(at, len(self.value) - 1)] < x[:, None])
        gf, gl = self.group_first[g], self.group_last[g]
        return left + below.sum(axis=1), np.where(known, gf, 0), np.where(known, gl, -1)


def _nearest(table: pa.Table, tolerance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the probes that have a partner, the partner's order and time."""
    group = np.cumsum(starts(table, [f"{OWN}h1", f"{OWN}h2"]))
    t, order = table[f"{OWN}t"].to_numpy(), table[f"{OWN}o"].to_numpy(zero_copy_only=False)
    probe = table[f"{OWN}side"].to_numpy() == 1
    tg, tt, to = group[~probe], t[~probe], order[~probe]
    if not len(tt) or not probe.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Of equal times the first has the lowest order: rows come sorted by it.
    distinct = np.r_[True, (tg[1:] != tg[:-1]) | (tt[1:] != tt[:-1])]
    tg, tt, to = tg[distinct], tt[distinct], to[distinct]
    rows = np.flatnonzero(probe)
    x = t[rows]
    at, first, last = LearnedIndex(tg, tt).lower_bound(group[rows], x)
    far = np.iinfo(np.int64).max
    best, order_of = np.full(len(rows), far), np.full(len(rows), far)
    when = np.zeros(len(rows), np.int64)
    for k in (at - 1, at):
        ok = (k >= first) & (k <= last)
        p = np.where(ok, k, 0)
        dist = np.where(ok, np.abs(tt[p] - x), far)
        better = (dist < best) | ((dist == best) & ok & (to[p] < order_of))
        best, order_of, when = np.where(better, dist, best), np.where(better, to[p], order_of), np.where(better, tt[p], when)
    hit = best <= tolerance
    return rows[hit], order_of[hit], when[hit]


def nearest_in_time(
    left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str,
    right_order: str, tolerance: int, out_order: str, out_time: str, shard: int = SHARD_MS,
) -> DataFrame:
    """Each left row with the right row of the same keys nearest in time, if within `tolerance`.

    Times and `right_order` are whole numbers. Of equally near right rows the one
    with the lowest order is taken. Left rows with a null key or time, or without
    a partner, are left out; right rows with a null key, time or order are never
    partners. Repeated left rows each come out; repeated right rows change nothing.
    Output: all columns of left, out_order, out_time (bigint); the other columns of
    right are not read, so their names may clash.
    """
    require_columns(left, [*keys, left_time], "nearest_in_time, left")
    require_columns(right, [*keys, right_time, right_order], "nearest_in_time, right")
    own = {c: f"{OWN}{c}" for c in ("h1", "h2", "side", "t", "o", "row")}

    def side(df: DataFrame, number: int, time: str, order, row, shards) -> DataFrame:
        known = F.col(time).isNotNull()
        for k in keys:
            known = known & F.col(k).isNotNull()
        df = df.where(known).select(packed(keys), F.col(time).cast("long").alias(own["t"]), order.cast("long").alias(own["o"]), row.alias(own["row"]))
        df = df.withColumn(f"{OWN}shard", shards(F.col(own["t"])))
        key = "__sl_key"
        return df.select(
            F.xxhash64(key, f"{OWN}shard").alias(own["h1"]), F.hash(key, f"{OWN}shard").alias(own["h2"]),
            F.lit(number).cast("byte").alias(own["side"]), own["t"], own["o"], own["row"],
        )

    payload = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    row_type = T.StructType([f for f in left.schema.fields])
    near = lambda t: F.explode(F.sequence(block_of(t - tolerance, shard), block_of(t + tolerance, shard)))
    probes = side(left, 1, left_time, F.lit(0), payload, lambda t: block_of(t, shard))
    targets = side(right.where(F.col(right_order).isNotNull()), 0, right_time, F.col(right_order), F.lit(None).cast(row_type), near)
    both = probes.unionByName(targets)
    both = both.repartition(own["h1"], own["h2"]).sortWithinPartitions(own["h1"], own["h2"], own["t"], own["side"], own["o"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, [own["h1"], own["h2"]], CHUNK_ROWS):
            rows, order, when = _nearest(table, tolerance)
            if len(rows):
                yield from pa.table({"row": table[own["row"]].take(pa.array(rows)), "o": order, "t": when}).to_batches()

    schema = T.StructType([T.StructField("row", row_type), T.StructField("o", T.LongType()), T.StructField("t", T.LongType())])
    out = both.mapInArrow(run, schema)
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in left.columns], F.col("o").alias(out_order), F.col("t").alias(out_time))
