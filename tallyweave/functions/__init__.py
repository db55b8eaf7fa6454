from .hashing import (
    HASH_PRIME,
    HashParams,
    band_keys,
    band_slices,
    draw_hash_params,
    hashed_id,
    minima,
    universal_hash_sql,
)
from .text import (
    categories,
    compact_categories,
    in_year,
    tokens,
)

__all__ = [
    "HASH_PRIME",
    "HashParams",
    "band_keys",
    "band_slices",
    "categories",
    "compact_categories",
    "draw_hash_params",
    "hashed_id",
    "in_year",
    "minima",
    "tokens",
    "universal_hash_sql",
]
