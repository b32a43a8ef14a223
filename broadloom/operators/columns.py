"""Arrow columns as matrices, inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401


def floats(column: pa.Array, width: int | None = None, name: str = "features") -> np.ndarray:
    """array<double> column -> matrix; a null element becomes NaN. A null array, or arrays that are not all of one length
    (``width`` if given), are an error: values must never move between rows."""
    if not len(column):
        return np.empty((0, width or 0))
    lengths = pa.compute.min_max(pa.compute.list_value_length(column)).as_py()
    width = lengths["max"] if width is None else width
    if column.null_count or not lengths["min"] == lengths["max"] == width:
        raise ValueError(f"{name}: every row needs an array of {width} values; {column.null_count} are null, "
                         f"lengths run from {lengths['min']} to {lengths['max']}")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), width)
