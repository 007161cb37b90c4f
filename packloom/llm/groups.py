"""Groups of rows from sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by their first column; a group's rows must fit in memory."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if rest and (rest[-1].column(0)[-1].as_py() != keys[-1] or cut):
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        rest.append(batch.slice(cut))
    if rest:
        yield pa.Table.from_batches(rest)


def groups_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """One table for each group."""
    for table in whole_groups(batches):
        keys = table.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for a, b in zip(edges, edges[1:], strict=False):
            yield table.slice(a, b - a)
