"""Token ids in raw binary files with a minimal perfect hash index.

A dataset is a folder. ``ids-NNNNNNN.bin`` holds the ids of consecutive documents in ascending
order of their keys, nothing else: unsigned little-endian integers of 16 bits if the vocabulary
allows it, else 32. ``index-NNNNN.npz`` maps the keys of one hash bucket to (shard, first id,
number of ids): the bits of a minimal perfect hash and, by slot, a fingerprint and the place.
A key is an id and, for rows that share an id, the number of the row among them.

Files are written under a name of the attempt and moved into place, with the same content
whichever attempt does it, so a lost executor or a repeated task leaves a whole dataset.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .library_bpe import loaded
from .perfect_hash import PerfectHash, fingerprints
from .tables import fresh_path, text_slices, written

DOCS_PER_SHARD = 4_000
KEYS_PER_INDEX = 100_000


class IdFiles(NamedTuple):
    """A written dataset. ``manifest`` has a row per document: ``id, copy, shard, first, n_tokens``."""

    path: str
    width: int
    buckets: int
    manifest: DataFrame


def _put(folder: str, name: str, chunks: Iterator[bytes]) -> None:
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    context = TaskContext.get()
    attempt = f"{path}/_{name}.{context.taskAttemptId() if context else 0}"
    with system.open_output_stream(attempt) as out:
        for chunk in chunks:
            out.write(chunk)
    system.move(attempt, f"{path}/{name}")


def _key_columns(copy: str = "copy"):
    """Two 64-bit hashes of a key, salted first, and its index bucket comes from the first."""
    return [
        F.xxhash64(F.lit(salt), F.col("id").isNull(), "id", copy).alias(name)
        for salt, name in (("high", "high"), ("low", "low"))
    ]


def write(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    vocab: str,
    *,
    end_id: int = 1,
    docs_per_shard: int = DOCS_PER_SHARD,
    keys_per_index: int = KEYS_PER_INDEX,
    path: str | None = None,
) -> IdFiles:
    """Encode every whole text, append ``end_id`` and write a dataset to ``path``, a fresh folder.

    A null text counts as empty. Null ids come first and are kept; rows with equal ids follow
    one another in the order in which they were read and differ by ``copy``. An empty table
    gives a dataset without files. Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    path = path or fresh_path(spark, "id-files")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    n_docs = rows.count()
    shards = max(1, -(-n_docs // docs_per_shard))
    ordered = rows.withColumn("nth", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(shards, "id", "nth").sortWithinPartitions("id", "nth").select("id", "text")
    width = 2 if loaded(vocab).tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
    dtype = f"<u{width}"
    names = ["id", "copy", "shard", "first", "n_tokens"]
    schema = pa.schema(zip(names, [to_arrow_type(rows.schema["id"].dataType), pa.int64(), pa.int32(), pa.int64(), pa.int64()]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = loaded(vocab, dtype).encode, TaskContext.get().partitionId()
        end = np.array([end_id], dtype).tobytes()
        placed: list[pa.RecordBatch] = []

        def chunks() -> Iterator[bytes]:
            first, copy, previous = 0, 0, object()
            for batch in text_slices(batches):
                ids = batch.column("id").to_pylist()
                coded = [encode(text or "") + end for text in batch.column("text").to_pylist()]
                counts = np.array([len(x) // width for x in coded], np.int64)
                copies = []
                for key in ids:
                    copy, previous = (copy + 1 if key == previous else 0), key
                    copies.append(copy)
                firsts = first + np.cumsum(counts) - counts
                first += int(counts.sum())
                columns = [batch.column("id"), pa.array(copies, pa.int64()), pa.array([shard] * len(ids), pa.int32()), pa.array(firsts), pa.array(counts)]
                placed.append(pa.RecordBatch.from_arrays(columns, schema=schema))
                yield b"".join(coded)

        source = chunks()
        head = next(source, None)
        if head is None:
            return
        _put(path, f"ids-{shard:07d}.bin", (x for part in ([head], source) for x in part))
        yield from placed

    kind = rows.schema["id"].dataType.simpleString()
    manifest = written(ordered.mapInArrow(run, f"id {kind}, copy long, shard int, first long, n_tokens long"), "manifest")
    manifest = written(_numbered(manifest), "manifest")
    buckets = max(1, -(-n_docs // keys_per_index))
    keyed = manifest.select(*_key_columns(), "shard", "first", "n_tokens")
    keyed = keyed.withColumn("bucket", F.pmod("high", F.lit(buckets)).cast("int"))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        high, low = (group[x].to_numpy().view(np.uint64) for x in ("high", "low"))
        table = PerfectHash.build(high, low)
        order = np.argsort(table.slots(high, low))
        stored = {f"bits{i}": np.packbits(x) for i, x in enumerate(table.levels)}
        stored["widths"] = np.array([len(x) for x in table.levels], np.int64)
        stored["prints"] = fingerprints(high, low)[order]
        stored |= {x: group[x].to_numpy()[order] for x in ("shard", "first", "n_tokens")}
        sink = pa.BufferOutputStream()
        np.savez(sink, **stored)
        bucket = int(group["bucket"].iloc[0])
        _put(path, f"index-{bucket:05d}.npz", iter([sink.getvalue().to_pybytes()]))
        return pd.DataFrame({"bucket": [bucket], "keys": [len(group)]})

    written(keyed.groupBy("bucket").applyInPandas(build, "bucket int, keys long"), "index-sizes")
    return IdFiles(path, width, buckets, manifest)


def _numbered(manifest: DataFrame) -> DataFrame:
    """Copies of an id are counted within a shard; count on where an id spans several."""
    per_shard = manifest.groupBy("id", "shard").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    spans = per_shard.withColumn("base", F.sum("rows").over(before)).where("base > 0")
    spans = spans.select(F.col("id").alias("span_id"), F.col("shard").alias("span_shard"), "base")
    joined = manifest.join(spans, F.col("id").eqNullSafe(F.col("span_id")) & (F.col("shard") == F.col("span_shard")), "left")
    return joined.select("id", (F.col("copy") + F.coalesce("base", F.lit(0))).alias("copy"), "shard", "first", "n_tokens")


def _read_index(path: str, bucket: int) -> tuple[PerfectHash, dict[str, np.ndarray]] | None:
    system, folder = fs.FileSystem.from_uri(path)
    name = f"{folder}/index-{bucket:05d}.npz"
    if system.get_file_info(name).type == fs.FileType.NotFound:
        return None
    with system.open_input_file(name) as file, np.load(pa.BufferReader(file.read())) as stored:
        levels = [np.unpackbits(stored[f"bits{i}"])[:width] for i, width in enumerate(stored["widths"])]
        return PerfectHash(levels), {x: stored[x] for x in ("prints", "shard", "first", "n_tokens")}


def find(spark: SparkSession, files: IdFiles, keys: DataFrame) -> DataFrame:
    """``id, copy, shard, first, n_tokens`` of the keys (``id, copy``) that the index holds."""
    keyed = keys.select("id", "copy", *_key_columns())
    keyed = keyed.withColumn("bucket", F.pmod("high", F.lit(files.buckets)).cast("int"))
    kind, path = keyed.schema["id"].dataType.simpleString(), files.path
    names = ["id", "copy", "shard", "first", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, index = -1, None
        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            for bucket in np.unique(buckets):
                if bucket != at:
                    at, index = bucket, _read_index(path, int(bucket))
                if index is None:
                    continue
                part = batch.filter(pa.array(buckets == bucket))
                high, low = (part.column(x).to_numpy().view(np.uint64) for x in ("high", "low"))
                table, places = index
                slots = table.slots(high, low)
                known = slots >= 0
                known[known] = places["prints"][slots[known]] == fingerprints(high, low)[known]
                part, slots = part.filter(pa.array(known)), slots[known]
                columns = [part.column("id"), part.column("copy"), *(pa.array(places[x][slots]) for x in names[2:])]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    # salted, so that a single bucket of a small dataset does not tie the look-ups to one task
    salted = keyed.repartition("bucket", F.pmod("low", F.lit(8))).sortWithinPartitions("bucket")
    return salted.mapInArrow(run, f"id {kind}, copy long, shard int, first long, n_tokens long")


def read(spark: SparkSession, files: IdFiles, keys: DataFrame, *, with_ids: bool = True) -> DataFrame:
    """``id, copy, start, n_tokens, ids_crc32`` and, with ``with_ids``, ``ids`` of the given keys
    (``id, copy``), read from the files. ``start`` counts the ids of all documents before; the
    checksum is of the ids as little-endian unsigned 32-bit integers."""
    totals = files.manifest.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    # one row per payload file
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    found = find(spark, files, keys).join(bases, "shard")
    kind, path, width = found.schema["id"].dataType.simpleString(), files.path, files.width
    names = ["id", "copy", "start", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(path)
        at, file = -1, None
        for batch in batches:
            starts = pc.add(batch.column("base"), batch.column("first"))
            crcs, payloads = [], []
            places = (batch.column(x).to_pylist() for x in ("shard", "first", "n_tokens"))
            for shard, first, count in zip(*places):
                if shard != at:
                    if file:
                        file.close()
                    at, file = shard, system.open_input_file(f"{folder}/ids-{shard:07d}.bin")
                raw = file.read_at(count * width, first * width)
                if len(raw) != count * width:
                    raise OSError(f"shard {shard} ends before id {first + count}")
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes()
                crcs.append(zlib.crc32(ids))
                if with_ids:
                    payloads.append(ids)
            columns = [batch.column("id"), batch.column("copy"), starts, batch.column("n_tokens"), pa.array(crcs, pa.int64())]
            if with_ids:
                columns.append(pa.array(payloads, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "ids"][: len(columns)])
        if file:
            file.close()

    spread = found.repartition("shard").sortWithinPartitions("shard", "first")
    return spread.mapInArrow(run, f"id {kind}, copy long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
