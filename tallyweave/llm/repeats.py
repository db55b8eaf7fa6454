"""Repeated passages of a corpus, found exactly and cut out but for their first occurrence.

A byte goes if some string of ``length`` bytes that covers it also starts earlier in the corpus.

1. *Which places can repeat.* Every string of that length is keyed by the smallest hash among
   its shorter grams, so equal strings have equal keys. Neighbouring strings of one key are one
   segment. A segment whose key occurs once in the corpus and its gram once in the segment is
   unique and drops out; of segments that are equal as a whole all but the first are repeats,
   however many there are.
2. *Per-shard suffix arrays.* What is left, one segment for each content of a key that has
   several, is dealt to shards by key, with its text. A shard sorts all suffixes
   (Larsson-Sadakane), takes common prefixes (Kasai), and so has the classes of equal strings.
3. *Merging across shards.* A key with very many segments is salted over several shards. Their
   classes are merged by sorting them as prints, range by range; a key has as many ranges as
   salts, so a range stays small.
4. Repeats become byte spans, are gathered by document and cut out.

Keys that a sample of the documents shows to be frequent are spread over tasks in step 1, too:
of equal segments the first of each task, then the first of those. The sample decides where rows
go, never what is found.

Rows of steps 1 and 4 are a small part of the text for each segment; no document, key or group
of copies is taken as a whole by one task, except that each document is cut by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .suffix_array import common_prefixes, suffix_array
from .tables import text_bytes, text_slices, written
from .words import _FACTOR, _INVERSE, _VALUES, _powers_of, mixed

_NULL_ID = -(1 << 63)


#: One of so many documents is read for frequent keys, of which so many are told apart, at most.
SAMPLED = 32
MOST_HOT = 100_000


class Repeats(NamedTuple):
    """``length`` of the strings, of the ``gram`` that keys them; bytes of text to a shard, and the
    least ranges of a salted key."""

    length: int = 100
    gram: int = 24
    shard_bytes: int = 1 << 20
    ranges: int = 8


def _prefix_sums(raw: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[raw] * _powers_of(_FACTOR, len(raw)), out=sums[1:])
    return sums


def _hashes(sums: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hash of each stretch of bytes, from sums over the whole text."""
    inverse = _powers_of(_INVERSE, len(sums))[starts]
    return mixed((sums[stops] - sums[starts]) * inverse + (stops - starts).astype(np.uint64))


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    count = len(values) - width + 1
    blocks = np.full(-(-len(values) // width) * width, np.uint64(2**64 - 1))
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def segments(raw: np.ndarray, offsets: np.ndarray, rule: Repeats) -> list[np.ndarray]:
    """Maximal runs of strings with one key: number of the text, first start in it, number of
    strings, key, content hash, and whether the key's gram is in the run more than once, as only
    then two of its strings can be equal."""
    size, none = len(raw), np.zeros(0, np.int64)
    if size < rule.length:
        return [none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)]
    if size >= 1 << 32:
        raise ValueError("texts of 4 GiB and more are not supported")
    sums = _prefix_sums(raw)
    starts = np.arange(size - rule.gram + 1)
    grams = _hashes(sums, starts, starts + rule.gram)
    # half a hash in front of the place, or of what is left up to the end of 32 bits
    half, low = np.uint64(0xFFFFFFFF) << np.uint64(32), np.uint64(0xFFFFFFFF)
    places = starts.astype(np.uint64)
    width = rule.length - rule.gram + 1
    left = _smallest(grams & half | places, width) & low
    right = low - (_smallest(grams & half | (low - places), width) & low)
    keys = grams[left.astype(np.int64)]
    lengths = np.diff(offsets)
    owner = np.repeat(np.arange(len(lengths)), lengths)[: len(keys)]
    inside = np.arange(len(keys)) + rule.length <= offsets[1:][owner]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    if not len(at):
        return [none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)]
    # a run ends before the next one, or where its text has no further string
    ends = np.minimum(np.append(at[1:], len(keys)), offsets[1:][owner[at]] - rule.length + 1)
    cuts = np.stack([at, ends], axis=1).ravel()
    outermost = [f.reduceat(np.append(x, x[-1]), cuts)[::2] for f, x in ((np.minimum, left), (np.maximum, right))]
    return [owner[at], at - offsets[:-1][owner[at]], ends - at, keys[at], _hashes(sums, at, ends - 1 + rule.length), outermost[0] != outermost[1]]


_SEGMENT = "key long, content long, doc long, tie long, start int, count int, inner boolean, likely long"


def _segment_rows(rule: Repeats, hot: np.ndarray, likely: np.ndarray):
    """Segments, with the likely number of rows of their key if it is among the sorted ``hot``
    ones, else 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            owner, start, count, key, content, inner = segments(*text_bytes(batch.column("text")), rule)
            owners = pa.array(owner)
            columns = [pa.array(key.view(np.int64)), pa.array(content.view(np.int64)), batch.column("doc").take(owners), batch.column("tie").take(owners)]
            columns += [pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(inner)]
            rows = np.zeros(len(key), np.int64)
            if len(hot):
                own = key.view(np.int64)
                at = np.minimum(np.searchsorted(hot, own), len(hot) - 1)
                rows = np.where(hot[at] == own, likely[at], 0)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows)], names=["key", "content", "doc", "tie", "start", "count", "inner", "likely"])

    return run


def _cut_out(rule: Repeats):
    """Text of the wanted segments of each document."""
    names = ["shard", "salts", "key", "doc", "tie", "start", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            raw, offsets = text_bytes(batch.column("text"))
            data = raw.tobytes()
            out: list[list] = [[] for _ in names]
            docs = zip(offsets.tolist(), batch.column("doc").to_pylist(), batch.column("tie").to_pylist(), batch.column("wanted").to_pylist())
            for offset, doc, tie, wanted in docs:
                for x in wanted:
                    at = offset + x["start"]
                    row = (x["shard"], x["salts"], x["key"], doc, tie, x["start"], data[at : at + x["count"] - 1 + rule.length])
                    for column, value in zip(out, row):
                        column.append(value)
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(out, kinds)], names=names)

    return run


def string_classes(text: np.ndarray, valid: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the valid strings of ``length`` bytes in sorted order, and whether each
    begins a new class of equal ones."""
    order = suffix_array(text)
    prefixes = common_prefixes(text, order)
    new = prefixes < length
    kept = valid[order]
    # a class goes on over strings that are not valid
    classes = np.cumsum(new)[kept]
    begins = np.ones(len(classes), bool)
    begins[1:] = classes[1:] != classes[:-1]
    return order[kept], begins


_SPAN = "doc long, tie long, start int, count int"
_MERGE = f"{_SPAN}, key long, range int, prints binary, places binary"


def _shard_repeats(rule: Repeats):
    """Spans of strings that repeat within the shard; for salted keys also the first string of
    each class, as prints and places, to be merged with the other shards of the key."""
    schema = pa.schema(
        [("doc", pa.int64()), ("tie", pa.int64()), ("start", pa.int32()), ("count", pa.int32()), ("key", pa.int64()), ("range", pa.int32()), ("prints", pa.binary()), ("places", pa.binary())]
    )

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc", "ascending"), ("tie", "ascending"), ("start", "ascending")])
        texts = table["text"].to_pylist()
        sizes = np.array([len(x) + 1 for x in texts], np.int64)
        text = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        begins_at = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(texts)), sizes)
        offset = np.arange(len(text)) - begins_at[owner]
        valid = offset + rule.length <= sizes[owner] - 1
        order, begins = string_classes(text, valid, rule.length)
        doc, tie, start = (table[x].to_numpy() for x in ("doc", "tie", "start"))
        empty = pa.table({f.name: pa.array([], f.type) for f in schema}, schema=schema)
        if not len(order):
            return empty
        heads = np.flatnonzero(begins)
        # segments lie in corpus order, so the smallest position of a class is its first
        first = np.minimum.reduceat(order, heads)
        leads = np.zeros(len(text), bool)
        leads[first] = True
        repeated = valid & ~leads
        run_starts, counts = _runs_of(repeated, owner)
        own = owner[run_starts]
        spans = [doc[own], tie[own], (start[own] + offset[run_starts]).astype(np.int32), counts.astype(np.int32)]
        rows = len(run_starts)
        out = [pa.table([*map(pa.array, spans), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int32()), *[pa.nulls(rows, pa.binary())] * 2], schema=schema)]
        salted = table["salts"].to_numpy()[owner[first]] > 1
        if salted.any():
            lead = first[salted]
            sums = _prefix_sums(text)
            prints = _hashes(sums, lead, lead + rule.length)
            key, own = table["key"].to_numpy()[owner[lead]], owner[lead]
            ranges = (prints >> np.uint64(32)) % np.maximum(table["salts"].to_numpy()[own], rule.ranges).astype(np.uint64)
            sort = np.lexsort((prints, ranges, key))
            places = np.stack([doc[own], tie[own], start[own] + offset[lead]], axis=1).astype(np.int64)[sort]
            key, ranges, prints = key[sort], ranges[sort].astype(np.int32), prints[sort]
            cuts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (ranges[1:] != ranges[:-1])))
            stops = np.append(cuts[1:], len(key))
            merge = {
                "key": pa.array(key[cuts]),
                "range": pa.array(ranges[cuts]),
                "prints": pa.array([prints[a:b].tobytes() for a, b in zip(cuts, stops)], pa.binary()),
                "places": pa.array([places[a:b].tobytes() for a, b in zip(cuts, stops)], pa.binary()),
            }
            out.append(pa.table([merge.get(f.name, pa.nulls(len(cuts), f.type)) for f in schema], schema=schema))
        return pa.concat_tables(out)

    return run


def _runs_of(flags: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of set flags; a run stays within one owner."""
    first = flags.copy()
    first[1:] &= ~flags[:-1] | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(first)
    last = flags.copy()
    last[:-1] &= ~flags[1:] | (owner[1:] != owner[:-1])
    return starts, np.flatnonzero(last) - starts + 1


def _merged(table: pa.Table) -> pa.Table:
    """Of equal strings in several shards of a key all but the first are repeats."""
    prints = np.frombuffer(b"".join(table["prints"].to_pylist()), np.uint64)
    places = np.frombuffer(b"".join(table["places"].to_pylist()), np.int64).reshape(-1, 3)
    order = np.lexsort((places[:, 2], places[:, 1], places[:, 0], prints))
    found = places[order[1:][prints[order[1:]] == prints[order[:-1]]]]
    return pa.table([pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(found[:, 2].astype(np.int32)), pa.array(np.ones(len(found), np.int32))], names=["doc", "tie", "start", "count"])


def cut(text: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of ``text`` without the given stretches, and the stretches, joined."""
    marks = np.zeros(len(text) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, stops, -1)
    gone = np.cumsum(marks[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    left = np.frombuffer(text, np.uint8)[~gone].tobytes()
    return left, list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _keyed(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """``id, doc, tie, text`` of every row, and of every document: ``doc`` and ``tie`` order the
    documents. Texts that share an id are told apart by a hash of their bytes; rows equal in both
    are one document."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"), F.struct(F.lit(True).alias("row"), *carry).alias("carried"))
    rows = rows.withColumn("doc", F.coalesce("id", F.lit(_NULL_ID)))
    again = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(F.col("doc").alias("again"))
    again = written(again, "repeated-ids")
    if again.isEmpty():
        single = rows.withColumn("tie", F.lit(0).cast("long"))
        return single, single
    tied = rows.join(again, F.col("doc") == F.col("again"), "left")
    tie = F.when(F.col("again").isNotNull(), F.xxhash64("text")).otherwise(F.lit(0))
    tied = tied.select("id", "text", "carried", "doc", tie.alias("tie"))
    return tied, tied.dropDuplicates(["doc", "tie"])


def _hot_keys(keyed: DataFrame, rule: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """Keys of about a shard's worth of segments and more, sorted, and how many they are likely
    to have, by a sample of the documents."""
    none = np.zeros(0, np.int64)
    sample = keyed.where(F.pmod(F.xxhash64("doc", "tie"), F.lit(SAMPLED)) == 0).select("doc", "tie", "text")
    counts = sample.mapInArrow(_segment_rows(rule, none, none), _SEGMENT).groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    frequent = counts.where(F.col("rows") * F.lit(SAMPLED * 2 * rule.length) >= F.lit(rule.shard_bytes))
    found = frequent.orderBy(F.desc("rows"), "key").limit(MOST_HOT).toArrow().sort_by("key")
    return found["key"].to_numpy(), found["rows"].to_numpy() * SAMPLED


def _marked(keyed: DataFrame, rule: Repeats, hot: np.ndarray, likely: np.ndarray) -> DataFrame:
    """Segments that may repeat, and whether they are copies of an earlier one of their task. Those
    of a hot key are dealt out by their place, and all of them stay."""
    rows = keyed.select("doc", "tie", "text").mapInArrow(_segment_rows(rule, hot, likely), _SEGMENT)
    tasks = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.when(F.col("likely") > 0, F.pmod(F.xxhash64("doc", "tie", "start"), F.lit(tasks))).otherwise(F.lit(0)).cast("int")
    by_key = Window.partitionBy("key", "salt")
    by_content = Window.partitionBy("key", "salt", "content", "count").orderBy("doc", "tie", "start")
    marked = rows.withColumn("salt", salt).repartition("key", "salt").withColumns(
        {"nth": F.row_number().over(by_content), "low": F.min("content").over(by_key), "high": F.max("content").over(by_key), "rows": F.count(F.lit(1)).over(by_key)}
    )
    marked = marked.where("nth > 1 or low <> high or inner or likely > 0").withColumn("hot", F.col("likely") > 0)
    content = F.when(F.col("hot"), F.col("content")).alias("content")
    return marked.select("key", content, "doc", "tie", "start", "count", F.when(F.col("hot"), F.col("likely")).otherwise(F.col("rows")).alias("rows"), (F.col("nth") > 1).alias("copy"), "hot")


def repeated_spans(keyed: DataFrame, rule: Repeats = Repeats()) -> DataFrame:
    """``doc, tie, start, count``: strings of a document, ``count`` of them from ``start`` on, that
    also start earlier in the corpus. ``keyed`` has one row per document."""
    hot, likely = _hot_keys(keyed, rule)
    marked = written(_marked(keyed, rule, hot, likely), "repeated-segments")
    whole = marked.where("copy").select("doc", "tie", "start", "count")
    open_rows = marked.where("not copy and not hot").drop("content", "copy", "hot")
    if len(hot):
        # firsts of a task to firsts of all: one row at most per content and task
        by_content = Window.partitionBy("key", "content", "count").orderBy("doc", "tie", "start")
        firsts = marked.where("not copy and hot").withColumn("again", F.row_number().over(by_content) > 1)
        firsts = written(firsts.drop("content", "copy", "hot"), "frequent-segments")
        whole = whole.union(firsts.where("again").select("doc", "tie", "start", "count"))
        open_rows = open_rows.union(firsts.where("not again").drop("again"))
    size = open_rows.agg(F.sum(F.col("count") + F.lit(rule.length))).first()[0]
    if not size:
        return whole
    shards = -(-size // rule.shard_bytes)
    salts = F.ceil(F.col("rows") * F.lit(2 * rule.length) / F.lit(rule.shard_bytes)).cast("int")
    salt = F.pmod(F.xxhash64("doc", "tie", "start"), F.col("salts"))
    dealt = open_rows.withColumn("salts", salts).withColumn("shard", F.pmod(F.xxhash64("key", salt), F.lit(shards)).cast("int"))
    wanted = dealt.groupBy("doc", "tie").agg(F.collect_list(F.struct("shard", "salts", "key", "start", "count")).alias("wanted"))
    texts = keyed.join(wanted, ["doc", "tie"]).select("doc", "tie", "text", "wanted")
    pieces = texts.mapInArrow(_cut_out(rule), "shard int, salts int, key long, doc long, tie long, start int, text binary")
    found = written(pieces.groupBy("shard").applyInArrow(_shard_repeats(rule), _MERGE), "shard-repeats")
    merged = found.where("key is not null").select("key", "range", "prints", "places").groupBy("key", "range").applyInArrow(_merged, _SPAN)
    return whole.union(found.where("key is null").select("doc", "tie", "start", "count")).union(merged)


def remove_repeats(docs: DataFrame, id_col: str, text_col: str, *carry: str, rule: Repeats = Repeats()) -> DataFrame:
    """One row per input row: ``id, n_bytes, n_removed, spans`` (array of ``start, stop``, joined
    and sorted) and ``kept``, the bytes that remain; the columns named in ``carry`` come along in
    the struct ``carried``.

    Documents are ordered by id, null first. Texts that share an id are ordered by a hash of
    their bytes; rows equal in id and text are one document. A null text counts as empty.
    Strings never cross documents. Cutting can split a character, so ``kept`` is binary. Other
    columns are not read, whatever their names; an empty table gives no rows.
    """
    keyed, single = _keyed(docs, id_col, text_col, carry)
    spans = repeated_spans(single, rule).groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "count")).alias("found"))
    rows = keyed.join(written(spans, "repeated-spans"), ["doc", "tie"], "left").select("id", "carried", "text", "found")
    span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
    carried = to_arrow_type(rows.schema["carried"].dataType)
    schema = pa.schema([("id", pa.int64()), ("carried", carried), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(span)), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            raw, offsets = text_bytes(batch.column("text"))
            data = raw.tobytes()
            sizes, kept, spans = np.diff(offsets), [], []
            for a, b, found in zip(offsets[:-1], offsets[1:], batch.column("found")):
                text = data[a:b]
                if not found.is_valid:
                    kept.append(text)
                    spans.append([])
                    continue
                starts = found.values.field("start").to_numpy()
                stops = starts + found.values.field("count").to_numpy() - 1 + rule.length
                left, gone = cut(text, starts, stops)
                kept.append(left)
                spans.append([{"start": x, "stop": y} for x, y in gone])
            removed = sizes - np.array([len(x) for x in kept])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("carried"), pa.array(sizes), pa.array(removed), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())], schema=schema)

    kind = rows.schema["carried"].dataType.simpleString()
    ddl = "n_bytes long, n_removed long, spans array<struct<start: int, stop: int>>, kept binary"
    return rows.mapInArrow(run, f"id long, carried {kind}, {ddl}")
