"""Exact Jaccard join of word n-gram sets by filtering under several global token orders.

Two sets of similarity t or more share a token of their prefixes, whatever global order the
tokens are taken in: the prefix of a set of n tokens is its first ``n - ceil(t n) + 1`` ones.
Each order used here takes tokens from rare to common, in levels, and draws those of a level
by a hash of its own, so pairs that only share a passage rarely meet, and must meet under
every order.

1. Documents with equal sets are one set. A table of counts over hash cells, of fixed size,
   tells the level of a token; it may err, as any function of the token alone makes an order.
2. Prefix tokens under the first order are the join keys; those of one set only are dropped.
   The smaller set of a pair needs but half as long a prefix, as the overlap of a pair is a
   larger share of it.
3. Sets that share a key become candidates if their sizes, the places of the key in both, and
   bitmaps of them allow it, and not where the key before is the same in both, by which they have
   met already; they stay if their prefixes under the other orders meet, too. Only
   then are whole sets compared. A bitmap holds for each cell of a token's hash whether an odd
   number of tokens lies in it: where two bitmaps differ, one token at least is in one set only.
4. As components are asked for, a large group of near copies is first linked to its most
   frequent partners, then to those that were linked most. What is left to test are pairs of different components, all of them. Two
   components are first compared as such, by the bits that all of their sets with the key agree on.

No cap is set anywhere: a key with very many sets is paired by component, and members of two
components only with each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..staging import stage_counted
from .components import connected_components
from .phrases import _bit_map, _in_map
from .tables import text_bytes, text_slices, written
from .words import WORD_CLASSES, mixed, runs, windows


class Join(NamedTuple):
    """``share``: the least similarity as (numerator, denominator). ``cell_bits`` fixes the size
    of the count table, which is counted and summed up in segments."""

    width: int = 3
    share: tuple[int, int] = (90, 100)
    cell_bits: int = 25
    segment_bits: int = 19
    other_orders: int = 2
    #: Longs of 64 bits of a set's bitmap. Twice as many are a method that Java no longer compiles.
    bitmap_longs: int = 8

    def orders(self) -> list[str]:
        return [f"order{i}" for i in range(2, self.other_orders + 2)]

    def prefix(self, size: int) -> int:
        """Tokens of a set among which it shares one with any similar set of no more tokens."""
        return size - -(-size * self.share[0] // self.share[1]) + 1

    def short_prefix(self, size: int) -> int:
        """The same for similar sets of no fewer tokens, with whom it has to share more."""
        return size - -(-2 * size * self.share[0] // sum(self.share)) + 1


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text. A text of fewer words gives one for all of
    them, a text without words none."""
    words = runs(raw, offsets, WORD_CLASSES, lower=True)
    grams = windows(words.hashes, width)
    out = []
    for start, stop in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if stop - start >= width:
            out.append(np.unique(grams[start : stop - width + 1]))
        elif stop > start:
            out.append(mixed(windows(words.hashes[start:stop], stop - start) + np.uint64(stop - start)))
        else:
            out.append(grams[:0])
    return out


def _print(tokens: np.ndarray) -> int | None:
    if not len(tokens):
        return None
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(join: Join, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sets = shingle_sets(*text_bytes(batch.column("text")), join.width)
            columns = [batch.column("id"), batch.column("digest"), pa.array([len(x) for x in sets], pa.int64()), pa.array([_print(x) for x in sets], pa.int64())]
            fields = [("id", kind), ("digest", pa.int64()), ("n", pa.int64()), ("print", pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    return run


def _cells(join: Join):
    """Cells of all tokens, as sorted 16-bit steps: ``segment`` and its packed ``steps``."""
    size = 1 << join.segment_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sets = shingle_sets(*text_bytes(batch.column("text")), join.width)
            cells = np.sort((np.concatenate(sets) >> np.uint64(64 - join.cell_bits)).astype(np.int64))
            bounds = np.searchsorted(cells, np.arange(0, (1 << join.cell_bits) + 1, size))
            segments, packed = [], []
            for segment in np.flatnonzero(np.diff(bounds)):
                own = cells[bounds[segment] : bounds[segment + 1]] - segment * size
                segments.append(segment)
                packed.append(_pack(own))
            yield pa.RecordBatch.from_arrays([pa.array(segments, pa.int32()), pa.array(packed, pa.binary())], names=["segment", "steps"])

    return run


def _pack(values: np.ndarray) -> bytes:
    """Sorted whole numbers as differences of 16 bits; 65535 says that the value goes on."""
    steps = np.diff(values, prepend=0)
    more, rest = np.divmod(steps, 65535)
    if not more.any():
        return steps.astype("<u2").tobytes()
    out = np.full(len(steps) + int(more.sum()), 65535, "<u2")
    out[np.cumsum(more + 1) - 1] = rest
    return out.tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(packed, "<u2").astype(np.int64)
    return np.cumsum(steps)[steps < 65535]


def _cell_levels(docs: DataFrame, join: Join) -> np.ndarray:
    """How common the tokens of each cell are, in 16 levels, two cells to a byte: a table of
    fixed size."""
    size = 1 << join.segment_bits
    n_segments = 1 << (join.cell_bits - join.segment_bits)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, packed in zip(batch.column("segment").to_pylist(), batch.column("steps").to_pylist()):
                counts.setdefault(segment, np.zeros(size, np.int64))
                counts[segment] += np.bincount(_unpack(packed), minlength=size)
        packed = []
        for found in counts.values():
            # half powers of two, counted from a quarter of a cell's fair share on
            base = max(0.0, 2 * np.log2(max(found.mean(), 1)) - 4)
            levels = np.clip(2 * np.log2(np.maximum(found, 1)) - base, 0, 15).astype(np.uint8)
            packed.append((levels[::2] | levels[1::2] << 4).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(packed, pa.binary())], names=["segment", "levels"])

    # by segment only, whose number is fixed; each holds an even share of the tokens
    parts = docs.mapInArrow(_cells(join), "segment int, steps binary").repartition(n_segments, "segment")
    out = np.zeros((n_segments, size // 2), np.uint8)
    for row in parts.mapInArrow(summed, "segment int, levels binary").collect():
        out[row["segment"]] = np.frombuffer(row["levels"], np.uint8)
    return out.ravel()


def _prefix(tokens: np.ndarray, order: int, levels: np.ndarray, join: Join) -> np.ndarray:
    """First tokens of a set under one of the orders, as what they are ordered by: the level of
    the token's cell, then a hash of the order's own."""
    cells = (tokens >> np.uint64(64 - join.cell_bits)).astype(np.int64)
    level = levels[cells >> 1] >> (4 * (cells & 1)).astype(np.uint8) & 15
    drawn = mixed(tokens + np.uint64(order)) >> np.uint64(4)
    drawn |= level.astype(np.uint64) << np.uint64(60)
    count = join.prefix(len(tokens))
    return drawn if count >= len(drawn) else np.partition(drawn, count - 1)[:count]


def _bitmap(tokens: np.ndarray, join: Join) -> np.ndarray:
    """For each cell of the tokens' last bits whether an odd number of tokens is in it."""
    size = 64 * join.bitmap_longs
    odd = np.bincount((tokens % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def _prefixes(join: Join, levels: np.ndarray):
    """Prefixes of each set: under the first order as its keys, under the others as halves of
    hashes, since meeting too often does no harm there; and its bitmap. A set seen before in this
    task is passed over, as far as it is remembered."""
    names = ["print", "n", "short", "bits", "keys", *join.orders()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in text_slices(batches):
            prints, sizes, shorts, bitmaps = [], [], [], []
            prefixes: list[list[np.ndarray]] = [[] for _ in names[4:]]
            for found in shingle_sets(*text_bytes(batch.column("text")), join.width):
                own = _print(found)
                if own is None or own in seen:
                    continue
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add(own)
                prints.append(own)
                sizes.append(len(found))
                for order, out in enumerate(prefixes, 1):
                    prefix = _prefix(found, order, levels, join)
                    out.append(np.sort(prefix).view(np.int64) if order == 1 else prefix.view(np.int64).astype(np.int32))
                shorts.append(join.short_prefix(len(found)))
                bitmaps.append(_bitmap(found, join))
            kinds = [pa.list_(pa.int64()), *[pa.list_(pa.int32())] * join.other_orders]
            columns = [*(pa.array(x, pa.int64()) for x in (prints, sizes, shorts)), pa.array(bitmaps, pa.list_(pa.int64()))]
            columns += [pa.array(x, kind) for x, kind in zip(prefixes, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _map_of(keys: DataFrame, name: str):
    """Bit map of the column ``key``, of bounded size, for all tasks."""
    counted, rows = stage_counted(keys, name)
    return keys.sparkSession.sparkContext.broadcast(_bit_map(counted, rows))


def _in_mapped(batch: pa.RecordBatch, column: str, bits) -> np.ndarray:
    return _in_map(bits.value, batch.column(column).to_numpy(zero_copy_only=False).view(np.uint64))


def _likely(df: DataFrame, column: str, keys: DataFrame, name: str) -> DataFrame:
    """Rows of which ``column`` is among ``keys``, and a few others, so that the rest is not shuffled."""
    bits = _map_of(keys, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_in_mapped(batch, column, bits), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def _several_tokens(bits):
    """Rows of tokens in the bit map, which are those of several sets and a few others; ``prev`` is the
    set's token before, of these, or the token itself where none is known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(_in_mapped(batch, "token", bits), pa.bool_()))
            prints, tokens = (batch.column(x).to_numpy() for x in ("print", "token"))
            before = tokens.copy()
            before[1:] = np.where(prints[1:] == prints[:-1], tokens[:-1], tokens[1:])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], names=[*batch.schema.names, "prev"])

    return run


def _whole_sets(join: Join, bits):
    """Sets of the documents in the bit map, those of repeated sets once in a task: the wanted ones
    and a few others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in text_slices(iter([batch.filter(pa.array(_in_mapped(batch, "key", bits), pa.bool_()))])):
                prints, whole = [], []
                for found in shingle_sets(*text_bytes(part.column("text")), join.width):
                    own = _print(found)
                    if own is not None and own not in seen:
                        seen.add(own)
                        prints.append(own)
                        whole.append(found.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(prints, pa.int64()), pa.array(whole, pa.binary())], names=["print", "tokens"])

    return run


def _linked(share: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("tokens_a").to_pylist(), batch.column("tokens_b").to_pylist()):
                one, two = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                both = np.concatenate([one, two])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(share[1] * shared >= share[0] * (len(both) - shared))
            kept = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"])
            yield kept.filter(pa.array(keep, pa.bool_()))

    return run


def _only_one_has(join: Join, one: tuple[str, str], two: tuple[str, str]) -> Column:
    """Cells of which the bitmaps on one side all have the bit and on the other none. Each side is
    given as the bits that all of its bitmaps have and those that any has."""
    cells = []
    for i in range(join.bitmap_longs):
        first, second = (F.col(x[0])[i].bitwiseAND(F.bitwise_not(F.col(y[1])[i])) for x, y in ((one, two), (two, one)))
        cells.append(F.bit_count(first.bitwiseOR(second) if (one[0], two[0]) != (one[1], two[1]) else F.col(one[0])[i].bitwiseXOR(F.col(two[0])[i])))
    return sum(cells[1:], cells[0])


def _differences_allow(join: Join, apart: Column, most: Column) -> Column:
    """Whether sets of ``most`` tokens together can be similar with ``apart`` tokens in only one."""
    least, whole = join.share
    return apart * (whole + least) <= most * (whole - least)


def _bits_allow(join: Join) -> Column:
    return _differences_allow(join, _only_one_has(join, ("bits_a", "bits_a"), ("bits_b", "bits_b")), F.col("n_a") + F.col("n_b"))


class _Verifier:
    """Candidate pairs to links: bitmaps and the filters of the other orders first, then whole sets."""

    def __init__(self, rows: DataFrame, first: DataFrame, prefixes: DataFrame, join: Join):
        self.rows, self.first, self.join = rows, first, join
        self.prefixes = prefixes.select("print", "n", "bits", *join.orders())

    def links(self, pairs: DataFrame, name: str) -> DataFrame:
        columns = ("n", "bits", *self.join.orders())
        pairs = written(pairs, f"{name}-met")
        either = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        prefixes = _likely(self.prefixes, "print", either, f"{name}-prints")
        a, b = (prefixes.select(F.col("print").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in columns)) for x in "ab")
        met = pairs.join(a, "a").join(b, "b").where(_bits_allow(self.join))
        for order in self.join.orders():
            met = met.where(F.arrays_overlap(f"{order}_a", f"{order}_b"))
        met = written(met.select("a", "b"), name)
        wanted = met.select("a").union(met.select("b")).distinct()
        # texts stay where they are; what is not wanted meets no pair, and a set that comes twice links the same
        first = self.first.join(wanted.withColumnRenamed("a", "first_print"), "first_print")
        bits = _map_of(first.select(F.xxhash64("first_id", "first_digest").alias("key")), f"{name}-wanted")
        texts = self.rows.select(F.xxhash64("id", "digest").alias("key"), "text")
        tokens = written(texts.mapInArrow(_whole_sets(self.join, bits), "print long, tokens binary"), f"{name}-sets")
        a, b = (tokens.select(F.col("print").alias(x), F.col("tokens").alias(f"tokens_{x}")) for x in "ab")
        return written(met.join(a, "a").join(b, "b").mapInArrow(_linked(self.join.share), "a long, b long"), f"{name}-links")


def _sizes_allow(share: tuple[int, int], a: str, b: str) -> Column:
    return (F.col(a) * share[1] >= F.col(b) * share[0]) & (F.col(b) * share[1] >= F.col(a) * share[0])


def _places_allow(share: tuple[int, int], least: Column, rest_a: str, rest_b: str) -> Column:
    """Whether sets of ``least`` tokens together can be similar if the first token that they share
    has ``rest_a`` and ``rest_b`` tokens behind it."""
    return (F.least(rest_a, rest_b) + 1) * sum(share) >= least * share[0]


def _new_here(last: str) -> Column:
    """False if each set on one side and each on the other has the same token before ``token``, by which
    they meet, too, with no less behind it. ``prev`` and ``last`` are the ends of these tokens."""
    same = [F.col(f"{x}_{side}") == F.col("prev_a") for x, side in (("prev", "b"), (last, "a"), (last, "b"))]
    return ~(same[0] & same[1] & same[2] & (F.col("prev_a") != F.col("token")))


def ngram_components(docs: DataFrame, id_col: str, text_col: str, join: Join = Join()) -> DataFrame:
    """One row per input row: ``id, n_shingles, component_id``.

    Letters A to Z count as a to z; words are runs of anything but space and U+0009 to U+000D.
    A document without words or text has an empty set and is a component of its own. Rows that
    repeat an id or a text are documents of their own. A null id stays null and never names a
    component, unless all ids in it are null. Other columns are not read, whatever their names;
    an empty table gives no rows. Sets are told apart by 64-bit prints of their 64-bit tokens.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("digest", F.xxhash64("text"))
    kind = rows.schema["id"].dataType
    told = written(rows.mapInArrow(_sets(join, to_arrow_type(kind)), f"id {kind.simpleString()}, digest long, n long, print long"), "shingle-sets")
    levels = _cell_levels(rows.select("text"), join)

    columns = ", ".join(f"{order} array<int>" for order in join.orders())
    prefixes = rows.select("text").mapInArrow(_prefixes(join, levels), f"print long, n long, short long, bits array<long>, keys array<long>, {columns}")
    prefixes = written(prefixes.dropDuplicates(["print"]), "prefixes")
    # ``rest``: tokens of the set that come after this one
    shared = prefixes.select("print", "n", "short", F.posexplode("keys").alias("at", "token"))
    shared = shared.select("print", "n", "token", (F.col("at") < F.col("short")).alias("short"), (F.col("n") - F.col("at") - 1).alias("rest"))
    several = shared.groupBy("token").agg(F.count(F.lit(1)).alias("sets"), F.max("short").alias("some"))
    several = written(several.where("sets > 1 and some").select("token"), "several-tokens")
    hits = _several_tokens(_map_of(several.withColumnRenamed("token", "key"), "several-keys"))
    shared = shared.mapInArrow(hits, "print long, n long, token long, short boolean, rest long, prev long")
    shared = written(shared.join(several, "token", "left_semi"), "shared-tokens")

    # whole sets are taken from one document each
    one = F.min(F.struct(F.col("id").isNull(), "id", "digest")).alias("first")
    first = told.where("print is not null").groupBy(F.col("print").alias("first_print")).agg(one)
    first = written(first.select("first_print", F.col("first.id").alias("first_id"), F.col("first.digest").alias("first_digest")), "first-documents")
    verifier = _Verifier(rows, first, prefixes, join)

    # a set and those it shares most tokens with, among the outermost of each token's sets
    ends = shared.groupBy("token").agg(F.min("print").alias("low"), F.max("print").alias("high"))
    near = shared.join(ends, "token").select("print", F.explode(F.array("low", "high")).alias("to")).where("print <> to")
    ranked = near.groupBy("print", "to").agg(F.count(F.lit(1)).alias("tokens"))
    best = ranked.groupBy("print").agg(F.max_by("to", F.struct("tokens", "to")).alias("to"))
    firsts = verifier.links(best.select(F.least("print", "to").alias("a"), F.greatest("print", "to").alias("b")).distinct(), "first-pairs")
    # then those with most links so far among the sets with one of its tokens, and with its rarest: copies
    # with few changes are alike even where those with many are not, and have been linked by some
    degrees = firsts.select(F.explode(F.array("a", "b")).alias("print")).groupBy("print").agg(F.count(F.lit(1)).alias("degree"))
    hubs = shared.join(degrees, "print").groupBy("token").agg(
        F.max(F.struct("degree", F.col("print").alias("to"))).alias("hub"), F.count(F.lit(1)).alias("linked")
    )
    ranked = shared.join(hubs, "token").where("print <> hub.to").groupBy("print")
    best = ranked.agg(F.max("hub").alias("most"), F.min(F.struct("linked", "hub")).alias("rare"))
    best = best.select("print", F.explode(F.array_distinct(F.array("most.to", "rare.hub.to"))).alias("to"))
    seconds = best.select(F.least("print", "to").alias("a"), F.greatest("print", "to").alias("b")).distinct()
    firsts = firsts.union(verifier.links(seconds.join(firsts, ["a", "b"], "left_anti"), "second-pairs"))
    components = connected_components(firsts, "a", "b").select(F.col("node").alias("print"), "root")

    # every pair of sets of different components that shares a token, the smaller set first
    member = shared.join(components, "print", "left").withColumn("root", F.coalesce("root", "print"))
    split = member.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("token")
    member = member.join(split, "token", "left_semi").join(prefixes.select("print", "bits"), "print")
    member = written(member, "token-members")
    places = range(join.bitmap_longs)
    roots = member.groupBy("token", "root").agg(
        F.max("short").alias("short"), F.min("n").alias("least"), F.max("n").alias("most"), F.max("rest").alias("rest"),
        F.min("prev").alias("prev"), F.max("prev").alias("last_prev"),
        F.array(*(F.bit_and(F.col("bits")[i]) for i in places)).alias("all"), F.array(*(F.bit_or(F.col("bits")[i]) for i in places)).alias("any"),
    )
    # all pairs that meet at a token have met before if all sets have the same token before it
    columns = ("root", "least", "most", "rest", "all", "any", "prev", "last_prev")
    one, two = (table.select("token", *(F.col(c).alias(f"{c}_{x}") for c in columns)) for x, table in (("a", roots.where("short")), ("b", roots)))
    apart = one.withColumnRenamed("token", "token_a").join(
        two,
        (F.col("token_a") == F.col("token")) & (F.col("root_a") != F.col("root_b")) & _new_here("last_prev")
        & (F.col("least_a") <= F.col("most_b")) & (F.col("most_a") * join.share[1] >= F.col("least_b") * join.share[0])
        & _places_allow(join.share, F.col("least_a") + F.col("least_b"), "rest_a", "rest_b")
        & _differences_allow(join, _only_one_has(join, ("all_a", "any_a"), ("all_b", "any_b")), F.col("most_a") + F.col("most_b")),
    ).select("token", "root_a", *(f"{c}_b" for c in columns[:6]))
    columns = ("root", "print", "n", "rest", "bits", "prev")
    one, two = (table.select("token", *(F.col(c).alias(f"{c}_{x}") for c in columns)) for x, table in (("a", member.where("short")), ("b", member)))
    # a member on its own against the other component, before it meets the members of that
    hopeful = (F.col("n_a") <= F.col("most_b")) & (F.col("n_a") * join.share[1] >= F.col("least_b") * join.share[0])
    hopeful &= _differences_allow(join, _only_one_has(join, ("all_b", "any_b"), ("bits_a", "bits_a")), F.col("n_a") + F.col("most_b"))
    hopeful &= _places_allow(join.share, F.col("n_a") + F.col("least_b"), "rest_a", "most_rest_b")
    apart = apart.withColumnRenamed("rest_b", "most_rest_b")
    one = apart.join(one, ["token", "root_a"]).where(hopeful).select("token", "root_b", "print_a", "n_a", "rest_a", "bits_a", "prev_a")
    fits = (F.col("n_a") <= F.col("n_b")) & _sizes_allow(join.share, "n_a", "n_b") & _bits_allow(join)
    fits &= _places_allow(join.share, F.col("n_a") + F.col("n_b"), "rest_a", "rest_b")
    pairs = one.join(two, ["token", "root_b"]).where(fits & _new_here("prev"))
    pairs = pairs.select(F.least("print_a", "print_b").alias("a"), F.greatest("print_a", "print_b").alias("b")).distinct()
    links = firsts.union(verifier.links(pairs, "other-pairs"))

    joined = connected_components(links, "a", "b").select(F.col("node").alias("print"), "root")
    named = written(told.join(joined, "print", "left").select("id", "n", F.coalesce("root", "print").alias("root")), "set-components")
    smallest = named.where("root is not null").groupBy("root").agg(F.min("id").alias("component_id"))
    return named.join(smallest, "root", "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
