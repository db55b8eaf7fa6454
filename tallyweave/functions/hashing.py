"""Universal hashing for MinHash signatures."""

from __future__ import annotations

import random
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: 2**31 - 1 is prime, and a * x + b stays below 2**63 for a, x, b below it.
HASH_PRIME = 2147483647


class HashParams(NamedTuple):
    a: int
    b: int


def draw_hash_params(count: int, seed: int) -> list[HashParams]:
    """``count`` seeded parameter pairs; the same seed always gives the same pairs."""
    rng = random.Random(seed)
    return [
        HashParams(rng.randrange(1, HASH_PRIME), rng.randrange(1, HASH_PRIME))
        for _ in range(count)
    ]


def hashed_id(value: Column, dtype: T.DataType) -> Column:
    """Integer id below the prime; no lookup table of ids is needed."""
    number = value.cast("bigint") if isinstance(dtype, T.IntegralType) else F.xxhash64(value)
    return F.pmod(number, F.lit(HASH_PRIME).cast("bigint"))


def universal_hash_sql(x: str, params: HashParams) -> str:
    """SQL text of one hash of the integer column ``x``.

    Text, because a signature has many hashes and one parsed expression is built at once.
    """
    return f"({params.a}L * {x} + {params.b}L) % {HASH_PRIME}L"


def minima(x: str, params: Sequence[HashParams]) -> Column:
    """Array of aggregates: the minimum of each hash over the rows of a set."""
    each = ", ".join(f"min({universal_hash_sql(x, p)})" for p in params)
    return F.expr(f"array({each})")


def band_keys(signature: str, n_bands: int, n_rows: int) -> Column:
    """Array with one 64-bit key per band of ``n_rows`` minima.

    The band number is part of the key. Two keys that collide can only add a pair to
    check; the check itself is exact.
    """
    bands = (
        ", ".join(f"{signature}[{band * n_rows + row}]" for row in range(n_rows))
        for band in range(n_bands)
    )
    each = ", ".join(f"xxhash64({band}, {rows})" for band, rows in enumerate(bands))
    return F.expr(f"array({each})")


def band_slices(signature: str, n_bands: int, n_rows: int) -> Column:
    """Array with the minima of each band."""
    each = ", ".join(f"slice({signature}, {band * n_rows + 1}, {n_rows})" for band in range(n_bands))
    return F.expr(f"array({each})")
