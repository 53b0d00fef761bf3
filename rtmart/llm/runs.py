"""Streaming over Arrow batches that are sorted by a key."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that never cut a run of equal keys; only one run is held back."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        keys = table.column(key).to_numpy()
        whole = int(keys.searchsorted(keys[-1]))
        held = table.slice(whole)
        if whole:
            yield table.slice(0, whole)
    if held is not None:
        yield held


def blocks(keys, most: int) -> Iterator[tuple[int, int, list[int]]]:
    """(from, to, group starts) of consecutive whole groups of ``most`` rows together.

    A group of more rows is a block by itself.
    """
    starts = [0, *((keys[1:] != keys[:-1]).nonzero()[0] + 1).tolist(), len(keys)]
    at = 0
    while at < len(starts) - 1:
        to = at + 1
        while to < len(starts) - 1 and starts[to + 1] - starts[at] <= most:
            to += 1
        yield starts[at], starts[to], starts[at:to]
        at = to
