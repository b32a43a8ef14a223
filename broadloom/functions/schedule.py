"""Learning-rate schedule."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DECAY_VALUES = [  # fixed values: rates between eleven boundaries that all lie at 100 epochs
    1e-3, 1e-3, 1e-2, 1e-1, 1e-3, 1e-3, 1e-2, 1e-4, 1e-3, 1e-2, 1e-3, 1e-4,
]


def decay_boundaries(steps: int) -> list[int]:
    return [100 * steps] * (len(DECAY_VALUES) - 1)


def piecewise_lr(step: Column | str, boundaries: Sequence[int], values: Sequence[float]) -> Column:
    """values[0] up to and including boundaries[0], then values[1], ..., values[-1] past the last."""
    s = F.col(step) if isinstance(step, str) else step
    rate = F.when(s <= boundaries[0], F.lit(values[0]))
    for b, v in zip(boundaries[1:], values[1:-1]):
        rate = rate.when(s <= b, F.lit(v))
    return rate.otherwise(F.lit(values[-1]))


def lr_at(step: int, boundaries: Sequence[int], values: Sequence[float]) -> float:
    """The same for one step number, inside a task."""
    return values[bisect_left(boundaries, step)]
