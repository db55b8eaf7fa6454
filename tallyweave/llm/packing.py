"""Packing token sequences by shortest-pack-first over the length histogram.

1. Tasks encode whole texts, append the end id and cut documents into pieces of at most the
   sequence length. Each piece gets a number among the pieces of its length in its task.
2. The histogram of lengths, with one row for each length, is packed on the driver: lengths
   are placed longest first, each into the pack that is the shortest so far if it has room.
   Packs of the same content are one pattern with a count, so there are at most two patterns
   for each length whatever the number of documents.
3. The number of a piece among all pieces of its length (its rank) picks its pattern and its
   sequence: the places for a length are ranges of ranks, searched by bisection.

Only the histogram and the table of places, both bounded by the sequence length, pass through
the driver; pieces are joined by length and task, so a length that a third of all pieces have
is still spread over all tasks.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .library_bpe import loaded
from .tables import text_slices, written

SEQUENCE_TOKENS = 2048


def cut_pieces(docs: DataFrame, id_col: str, text_col: str, vocab: str, end_id: int, most: int, *, with_ids: bool) -> DataFrame:
    """Pieces of at most ``most`` ids: ``id, start, length, ids_crc32, doc_tokens, task, nth``
    and, if asked for, ``ids`` as little-endian unsigned 32-bit integers."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "task", "nth"]
    kinds = [to_arrow_type(rows.schema["id"].dataType), *[pa.int64()] * 4, pa.int32(), pa.int64()]
    schema = pa.schema([*zip(names, kinds), *([("ids", pa.binary())] if with_ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = loaded(vocab, "<u4").encode, TaskContext.get().partitionId()
        end, seen = np.array([end_id], "<u4").tobytes(), Counter()
        for batch in text_slices(batches):
            out: list[list] = [[] for _ in schema.names]
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                ids = encode(text or "") + end
                total = len(ids) // 4
                for start in range(0, total, most):
                    piece = ids[4 * start : 4 * (start + most)]
                    length = len(piece) // 4
                    row = [doc, start, length, zlib.crc32(piece), total, task, seen[length]]
                    for column, value in zip(out, [*row, piece] if with_ids else row):
                        column.append(value)
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema)], schema=schema)

    kind = rows.schema["id"].dataType.simpleString()
    ddl = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, task int, nth long"
    return rows.mapInArrow(run, ddl + ", ids binary" * with_ids)


def shortest_pack_first(histogram: dict[int, int], most: int) -> list[tuple[int, tuple[int, ...]]]:
    """Patterns ``(count, lengths)`` that hold every length as often as the histogram says."""
    by_room: dict[int, list[list]] = {}
    roomiest = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        placed: list[tuple[int, list]] = []
        while left:
            while roomiest and not by_room.get(roomiest):
                roomiest -= 1
            if roomiest >= length:
                count, lengths = by_room[roomiest].pop()
                taken = min(count, left)
                if count > taken:
                    by_room[roomiest].append([count - taken, lengths])
                placed.append((roomiest - length, [taken, (*lengths, length)]))
            else:
                taken = left
                fill = max(1, most // length)
                packs, rest = divmod(taken, fill)
                if packs:
                    placed.append((most - fill * length, [packs, (length,) * fill]))
                if rest:
                    placed.append((most - rest * length, [1, (length,) * rest]))
            left -= taken
            if roomiest >= length:
                # what was just filled may still be the shortest pack
                room, pack = placed.pop()
                by_room.setdefault(room, []).append(pack)
        for room, pack in placed:
            by_room.setdefault(room, []).append(pack)
            roomiest = max(roomiest, room)
    return [(count, lengths) for packs in by_room.values() for count, lengths in packs]


def places(patterns: list[tuple[int, tuple[int, ...]]]) -> dict[int, np.ndarray]:
    """For each length the ranges of ranks: rows ``first rank, first sequence, offset, step``;
    the ranks of a range go to sequences one after the other, ``step`` to each."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: Counter[int] = Counter()
    sequence = 0
    for count, lengths in patterns:
        offset = 0
        for length, times in sorted(Counter(lengths).items(), reverse=True):
            out.setdefault(length, []).append((ranks[length], sequence, offset, times))
            ranks[length] += count * times
            offset += length * times
        sequence += count
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def pack(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    vocab: str,
    *,
    end_id: int = 1,
    most: int = SEQUENCE_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and,
    with ``with_ids``, the ids themselves. Every id of every text, and the end id after each,
    lies in exactly one piece.

    A null or empty text is one piece that holds the end id. Null ids, repeated rows and equal
    lengths are packed like any other row; an empty table gives no rows. Other columns are
    not read, whatever their names. The pieces of a task are numbered as they are written,
    once; a lost executor does not change them.
    """
    pieces = written(cut_pieces(docs, id_col, text_col, vocab, end_id, most, with_ids=with_ids), "pieces")
    counts = written(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("pieces")), "piece-counts")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "task", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("base"))
    # at most one row for each length up to ``most``
    totals = counts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()
    table = places(shortest_pack_first({row["length"]: row["pieces"] for row in totals}, most))
    ranked = pieces.join(bases, ["length", "task"]).withColumn("rank", F.col("base") + F.col("nth"))
    kept = ["id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
    ranked = ranked.select(*kept, "rank")
    kind = ranked.schema["id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                first, start, base, step = table[int(length)].T
                at = np.searchsorted(first, ranks[own], side="right") - 1
                turn, slot = np.divmod(ranks[own] - first[at], step[at])
                sequence[own] = start[at] + turn
                offset[own] = base[at] + slot * length
            columns = [batch.column(name) for name in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"]
            )

    ddl = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return ranked.mapInArrow(place, ddl + ", sequence_id long, offset long")
