"""MinHash signatures and LSH buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import band_keys, band_slices, draw_hash_params, hashed_id, minima


def minhash_signatures(
    df: DataFrame, key: str, member: str, n_hashes: int, seed: int = 0
) -> DataFrame:
    """``(key, signature)``: the minimum of each seeded hash over the members of a key.

    The minima are plain aggregates, merged before the shuffle: a key with a third of
    all rows leaves each map task as one row, and no member list is ever built.
    """
    x = hashed_id(F.col("member"), df.schema[member].dataType)
    rows = df.select(F.col(key).alias("key"), F.col(member).alias("member")).dropna()
    hashed = rows.select("key", x.alias("x"))
    return hashed.groupBy("key").agg(minima("x", draw_hash_params(n_hashes, seed)).alias("signature"))


def band_rows(signed: DataFrame, n_bands: int, n_rows: int, *carry: str) -> DataFrame:
    """One row per set and band: ``(bucket, carry...)``."""
    keys = band_keys("signature", n_bands, n_rows)
    return signed.select(F.explode(keys).alias("bucket"), *carry)


def lsh_buckets(
    df: DataFrame, key: str, member: str, n_bands: int, n_rows: int, seed: int = 0
) -> DataFrame:
    """``(band, minima, sets)``: buckets that more than one key falls into."""
    signed = minhash_signatures(df, key, member, n_bands * n_rows, seed)
    bands = band_slices("signature", n_bands, n_rows)
    return (
        signed.select(F.posexplode(bands).alias("band", "minima"))
        .groupBy("band", "minima")
        .agg(F.count("*").alias("sets"))
        .filter(F.col("sets") > 1)
    )
