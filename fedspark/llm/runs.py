"""Runs of equal keys in sorted Arrow batches, a bounded number of rows at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str], most: int) -> Iterator[tuple[pa.Table, np.ndarray, int, bool]]:
    """Cuts rows that are sorted by keys (columns of longs) into tables of whole runs: (rows, starts of runs, part, split).

    At most about most rows and one batch are held. A longer run comes in parts of most rows, one table
    each, with split true and part counting from 0; what joins the parts is up to the caller.
    """
    held, part, split_key = None, 0, None

    def starts(table):
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for k in (table.column(x).to_numpy() for x in keys):
            new[1:] |= k[1:] != k[:-1]
        return np.flatnonzero(new)

    def key_of(table):
        return tuple(table.column(x)[0].as_py() for x in keys)

    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        while held.num_rows:
            s = starts(held)
            last = int(s[-1])
            first_key = key_of(held)
            if split_key is not None and first_key != split_key:
                split_key, part = None, 0
            if split_key is None and last > 0:
                yield held.slice(0, last), s[:-1], 0, False
                held = held.slice(last).combine_chunks()
            elif split_key is not None and len(s) > 1:
                yield held.slice(0, int(s[1])), s[:1], part, True
                held = held.slice(int(s[1])).combine_chunks()
            elif held.num_rows >= most:
                yield held.slice(0, most), s[:1], part, True
                split_key, part = first_key, part + 1
                held = held.slice(most).combine_chunks()
            else:
                break
    if held is not None and held.num_rows:
        s = starts(held)
        if split_key is not None and key_of(held) == split_key:
            yield held, s[:1], part, True
        else:
            yield held, s, 0, False
