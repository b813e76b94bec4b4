"""Batches of rows in pieces of bounded size."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Tasks carry this module along, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of text in a piece, unless one text has more.
PIECE_BYTES = 2 << 20


def sliced(batch: pa.RecordBatch, column: int, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, as slices with about `size` bytes of text in a column.

    A batch has up to 10,000 rows, whatever their texts. The objects that Python makes of a text take many times its bytes, so they
    are made for one slice at a time.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(sizes + 1), 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
