"""Arrow batches in parts of bounded size, for Python steps on long texts.

Spark bounds a batch by rows and bytes, but as Python objects, with the
answers beside them, the same rows take many times that. A step that turns
one part at a time into objects needs memory for a part, whatever the size of
the batch or the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a step holds as Python objects.
PART = 1 << 20


def parts(batch: pa.RecordBatch, limit: int = PART) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in parts of at most ``limit`` bytes of
    text or binary data; a longer row is a part of its own."""
    size = np.ones(batch.num_rows, np.int64)
    for c in batch.columns:
        if pa.types.is_string(c.type) or pa.types.is_binary(c.type) or pa.types.is_large_string(c.type) or pa.types.is_large_binary(c.type):
            size += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False)
    upto, at = np.cumsum(size), 0
    while at < batch.num_rows:
        before = upto[at - 1] if at else 0
        end = max(int(np.searchsorted(upto, before + limit, "right")), at + 1)
        yield batch.slice(at, end - at)
        at = end
