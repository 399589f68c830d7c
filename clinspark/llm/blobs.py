"""Many small records in few rows: numpy records of one Arrow batch, packed by target part.

A key's part is fixed by its value, so all records of a key meet in one part.
Rows of a part are blobs of records; shuffling them costs no more than their bytes.
"""
from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa


def packed(part: np.ndarray, records: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(part, bytes of its records) of one batch."""
    order = np.argsort(part, kind="stable")
    part, records = part[order], records[order]
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.empty(0, np.int64)
    for a, b in zip(starts, np.r_[starts[1:], len(part)] if len(starts) else starts):
        yield int(part[a]), records[a:b].tobytes()


def unpacked(column: pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    """The records of all blobs of a part."""
    blobs = [np.frombuffer(x.as_buffer(), kind) for x in column if x.is_valid]
    return np.concatenate(blobs) if blobs else np.empty(0, kind)
