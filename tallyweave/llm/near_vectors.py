"""Near duplicates among embeddings by Euclidean p-stable hashing.

1. Vectors that are equal in direction and label are one class with a count; all further work
   is on classes, so copies are never expanded into pairs.
2. Normalised vectors are projected on Gaussian directions, shifted and quantised. A table's
   bucket is the tuple of some of these whole numbers; every class has a bucket in each table.
3. Classes that share label, table and bucket are compared by exact cosine in double precision.
   A large bucket is cut into blocks, and each pair of blocks is a task of its own, so the work
   of a hot bucket is spread and no pair is left out. A pair is reported by the first table
   that it meets in, which needs no removal of repeated pairs.
4. Links are counted per class, weighted by the copies, and connected.

Recall follows from the parameters: with the default ones a pair at the threshold meets in a
table with probability 0.243, in one of the tables with 0.998; closer pairs more surely.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .tables import written


class Hashing(NamedTuple):
    """``width``: of a quantisation step; ``digits``: projections to a table."""

    tables: int = 22
    digits: int = 4
    width: float = 1.0
    block: int = 256
    seed: int = 11


def _drawn(hashing: Hashing, size: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng([hashing.seed, size])
    count = hashing.tables * hashing.digits
    return draw.normal(size=(size, count)), draw.uniform(0, hashing.width, count)


def _units(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision."""
    values = values.astype(np.float64)
    # the largest component first, so that no square overflows or vanishes
    values = values / np.abs(values).max(1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _hashed(hashing: Hashing, kind: type):
    """Per vector: its components as bytes, a print of its unit vector and the bucket of each
    table; all null for a vector that can link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[None] * batch.num_rows for _ in range(3)]
            by_size: dict[int, list[int]] = {}
            vectors = batch.column("vector").to_pylist()
            usable = pc.and_(batch.column("id").is_valid(), batch.column("label").is_valid()).to_pylist()
            for i, vector in enumerate(vectors):
                if usable[i] and vector and None not in vector:
                    by_size.setdefault(len(vector), []).append(i)
            for size, at in by_size.items():
                values = np.array([vectors[i] for i in at], kind)
                good = np.isfinite(values).all(1) & (values != 0).any(1)
                values, at = values[good], np.array(at)[good]
                if not len(at):
                    continue
                unit = _units(values)
                directions, shifts = _drawn(hashing, size)
                steps = np.floor((unit @ directions + shifts) / hashing.width).astype(np.int64)
                steps = steps.reshape(len(at), hashing.tables, hashing.digits).astype(np.uint64)
                keys = np.full(steps.shape[:2], size, np.uint64)
                for digit in range(hashing.digits):
                    keys = (keys ^ steps[:, :, digit]) * np.uint64(0x9E3779B97F4A7C15)
                    keys ^= keys >> np.uint64(29)
                for i, value, own, key in zip(at, values, unit, keys.view(np.int64)):
                    out[0][i], out[1][i], out[2][i] = value.tobytes(), hashlib.sha256(own.tobytes()).digest(), key.tobytes()
            columns = [batch.column("id"), batch.column("label"), *(pa.array(x, pa.binary()) for x in out)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "raw", "print", "buckets"])

    return run


def _postings(hashing: Hashing):
    """One row per class and table, with the class's block in a bucket drawn from its id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = batch.num_rows
            keys = np.frombuffer(b"".join(batch.column("buckets").to_pylist()), np.int64).reshape(count, hashing.tables)
            for table in range(hashing.tables):
                columns = [batch.column("label"), pa.array(np.full(count, table, np.int32)), pa.array(keys[:, table].copy()), batch.column("class")]
                yield pa.RecordBatch.from_arrays(columns, names=["label", "table", "bucket", "class"])

    return run


def _compare(hashing: Hashing, threshold: float, kind: type):
    """Links between the two sides of a group, or within it where there is one side only."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        table, left_block, right_block = (int(group[x].iloc[0]) for x in ("table", "left", "right"))
        unit = _units(np.frombuffer(b"".join(group["raw"]), kind).reshape(len(group), -1))
        keys = np.frombuffer(b"".join(group["buckets"]), np.int64).reshape(len(group), hashing.tables)
        classes, blocks = group["class"].to_numpy(), group["block"].to_numpy()
        one, two = np.flatnonzero(blocks == left_block), np.flatnonzero(blocks == right_block)
        found_a, found_b = [], []
        for start in range(0, len(one), hashing.block):
            rows = one[start : start + hashing.block]
            cosines = unit[rows] @ unit[two].T
            # sums of products in another order may differ in the last bits
            i, j = np.nonzero(cosines >= threshold - 1e-12)
            a, b = rows[i], two[j]
            if left_block == right_block:
                a, b = a[classes[a] < classes[b]], b[classes[a] < classes[b]]
            exact = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
            a, b = a[exact], b[exact]
            earlier = (keys[a, :table] == keys[b, :table]).any(1)
            found_a.append(classes[a[~earlier]])
            found_b.append(classes[b[~earlier]])
        empty = np.zeros(0, np.int64)
        return pd.DataFrame({"a": np.concatenate([empty, *found_a]), "b": np.concatenate([empty, *found_b])})

    return run


def near_vectors(
    vectors: DataFrame, id_col: str, vector_col: str, label_col: str, threshold: float, hashing: Hashing = Hashing()
) -> DataFrame:
    """One row per input row: ``id, n_links, component_id, kept``.

    Two vectors link if their labels are equal and not null and their cosine, in double
    precision, reaches ``threshold`` (above 0). A vector that is null, empty, zero or holds a
    null or non-finite component links with nothing, nor do vectors of different sizes. Rows
    that repeat an id are vectors of their own that link like copies. A row with a null id is
    returned with a null component and no links. Other columns are not read, whatever their
    names; an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"))
    kind = np.float32 if rows.schema["vector"].dataType.elementType.simpleString() == "float" else np.float64
    hashed = rows.mapInArrow(_hashed(hashing, kind), "id long, label long, raw binary, print binary, buckets binary")
    hashed = written(hashed, "hashed-vectors")
    members = hashed.where("print is not null")
    # copies of a unit vector are one class
    members = members.withColumn("class", F.xxhash64("label", "print"))
    classes = members.groupBy("class", "label").agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("raw").alias("raw"), F.first("buckets").alias("buckets")
    )
    classes = written(classes, "vector-classes")

    postings = classes.select("label", "class", "buckets").mapInArrow(_postings(hashing), "label long, table int, bucket long, class long")
    postings = written(postings, "bucket-rows")
    key = ["label", "table", "bucket"]
    sizes = postings.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = sizes.withColumn("blocks", F.ceil(F.col("size") / hashing.block).cast("int"))
    # a class goes to its own block, and to each pair of blocks that has it
    placed = postings.join(sizes, key).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(F.least("block", other).alias("left"), F.greatest("block", other).alias("right"))))
    placed = placed.withColumn("pair", pair).select(*key, "class", "block", "pair.left", "pair.right")
    carried = placed.join(classes.select("class", "raw", "buckets"), "class")
    links = carried.groupBy(*key, "left", "right").applyInPandas(_compare(hashing, threshold, kind), "a long, b long")
    links = written(links, "vector-links")

    copies = classes.select(F.col("class").alias("to"), "copies")
    both = links.select("a", F.col("b").alias("to")).union(links.select(F.col("b").alias("a"), F.col("a").alias("to")))
    linked = both.join(copies, "to").groupBy(F.col("a").alias("class")).agg(F.sum("copies").alias("others"))
    roots = connected_components(links, "a", "b")
    known = roots.join(classes.select(F.col("class").alias("node"), "first_id"), "node")
    smallest = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    component = roots.join(smallest, "root").select(F.col("node").alias("class"), "component_id")
    told = classes.join(linked, "class", "left").join(component, "class", "left")
    told = told.select(
        "class", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component_id", "first_id").alias("component_id")
    )
    by_id = members.select("id", "class").join(told, "class").select("id", "n_links", "component_id")
    rest = hashed.where("print is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return by_id.union(rest).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
