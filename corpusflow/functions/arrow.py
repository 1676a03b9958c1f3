"""Rows of Arrow arrays through plain Python, a slice at a time."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa

#: Rows whose Python objects are there at once: a batch has up to 10,000, and an object takes many times what its values take in Arrow.
SLICE = 128


def by_row(f: Callable, kind: pa.DataType, *columns: pa.Array, rows: int = SLICE) -> pa.Array:
    """``f`` of each row's values, as an array of ``kind``."""
    parts = [pa.array([f(*x) for x in zip(*(c.slice(at, rows).to_pylist() for c in columns), strict=True)], kind) for at in range(0, len(columns[0]), rows)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)
