"""Whole groups out of a sorted stream of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.Table]:
    """Tables of about `rows` rows, each cut where a group ends.

    Rows must come sorted, or at least grouped, by the integer columns `keys`. A
    group is never split: one larger than `rows` comes as one table.
    """
    held: list[pa.RecordBatch] = []
    n, enough = 0, rows
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < enough:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        change = np.flatnonzero(starts(table, keys))
        cut = int(change[-1]) if len(change) else 0
        if cut:
            yield table.slice(0, cut)
            rest = table.slice(cut).combine_chunks()
            held, n, enough = rest.to_batches(), rest.num_rows, rows
        else:
            held, enough = table.to_batches(), 2 * n  # a group larger than this is put together anew only when it has doubled
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """True where a row opens a new group."""
    first = np.zeros(table.num_rows, dtype=bool)
    if not len(first):
        return first
    first[0] = True
    for k in keys:
        v = table[k].to_numpy()
        first[1:] |= v[1:] != v[:-1]
    return first
