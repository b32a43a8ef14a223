"""Integer mixing with 64-bit arithmetic only, so any SQL engine can repeat it.

``mix`` maps integer keys to [0, PRIME): keys are folded linearly, then raised to the fifth power
modulo the Mersenne prime 2^31 - 1. As 5 does not divide PRIME - 1, the power is a bijection, so
distinct single keys below PRIME never collide. A null key counts as NULL_KEY. Every product stays below 2^62 (safe under ANSI).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = 2147483647
FOLD = 1103515245
SEED_STEP = 69069
NULL_KEY = 1540483477  # stands for a null key
CELL_STEP = 998244353


def _int(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def mix(*keys: Column | str, seed: int = 0) -> Column:
    x = F.lit((seed * SEED_STEP + 1) % PRIME).cast("bigint")
    for k in keys:
        x = (x * F.lit(FOLD) + F.coalesce(F.pmod(_int(k), F.lit(PRIME)), F.lit(NULL_KEY))) % F.lit(PRIME)
    square = x * x % F.lit(PRIME)
    return square * square % F.lit(PRIME) * x % F.lit(PRIME)


def mix_int(key: int, seed: int = 0) -> int:
    """Driver-side twin of ``mix`` for one key (column numbers, trial numbers)."""
    x = ((seed * SEED_STEP + 1) % PRIME * FOLD + key % PRIME) % PRIME
    return pow(x, 5, PRIME)


def cell(base: Column, j: Column | int) -> Column:
    """Value in [0, PRIME) of column ``j`` in the row whose mixed id is ``base``."""
    j = F.lit(j) if isinstance(j, int) else j
    t = (base + j.cast("bigint") * F.lit(CELL_STEP)) % F.lit(PRIME)
    return t * t % F.lit(PRIME)


def uniform(value: Column) -> Column:
    """[0, 1) with six decimals."""
    return (value % F.lit(1000000)).cast("double") / F.lit(1e6)
