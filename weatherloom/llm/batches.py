"""Arrow batches in smaller parts, so that a task holds few texts as Python objects at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

ROWS = 500


def sliced(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
