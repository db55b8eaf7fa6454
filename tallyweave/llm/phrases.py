"""Phrase collocations, mined by partitions (Savasere, Omiecinski, Navathe) and scored exactly.

Documents are dealt to a fixed number of shards by the hash of their text; each shard is mined
by all tasks that hold a part of it. A phrase that occurs ``support`` times in a language occurs
in at least one shard so often as the shard's share of the language's words demands. So every
shard is mined completely at that lowered support (words, then pairs of frequent words, then
longer phrases of frequent pairs). What is frequent in any shard is counted over all documents
by hashes, and what then reaches the support is counted as text. Hashes can only add
candidates; counts and results come from the texts. Sets of frequent phrases reach the tasks as bit maps of bounded
size, whose false hits add rows to count and change no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage_counted
from .tables import text_bytes, text_slices, written
from .words import LOWER, mixed, runs, windows

#: What ends a piece, and what separates its words.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b" \t"

#: Language of documents without one.
UNKNOWN = "und"

#: Bits of the largest map of frequent phrases (32 MB).
MOST_BITS = 28
#: A phrase has two bits in a map: of its number, and of its number without so many low bits.
_SHIFT = 6
_BITS_A_MAP = 32768

#: A word, as Spark counts them: what neither breaks pieces nor separates words.
_WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"

#: Phrases that a task adds up before it passes them on, and those that it holds as text.
_ENTRIES = 1 << 20
_TEXTS = 250_000
_CLASSES = np.ones(256, np.uint8)
_CLASSES[list(BLANKS)] = 0
_CLASSES[list(BREAKS)] = 2


class Mining(NamedTuple):
    """``support``: occurrences that a phrase needs in its language; ``longest``: words of the
    longest phrase; ``shards``: parts that are mined each for itself."""

    support: int = 100
    longest: int = 5
    shards: int = 8


class _Words(NamedTuple):
    """Words of a block: hash, number of the document, place in the bytes, and whether the next
    word follows in the same piece."""

    hashes: np.ndarray
    owners: np.ndarray
    starts: np.ndarray
    joined: np.ndarray


def _words(raw: np.ndarray, offsets: np.ndarray) -> _Words:
    found = runs(raw, offsets, _CLASSES, lower=True)
    places = np.flatnonzero(found.kinds == 1)
    owners = found.owners()[places]
    joined = np.zeros(len(places), bool)
    joined[:-1] = (np.diff(places) == 1) & (owners[1:] == owners[:-1])
    return _Words(found.hashes[places], owners, found.starts[places], joined)


def _salts(langs: list[str]) -> np.ndarray:
    known = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(langs)}
    return np.array([known[x] for x in langs], np.uint64)


def _shard_marks(shards: int) -> np.ndarray:
    return mixed(np.arange(1, shards + 1, dtype=np.uint64))


def _in_map(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    found = np.ones(len(numbers), bool)
    for cells in (numbers, numbers >> np.uint64(_SHIFT)):
        cells = cells & np.uint64(8 * len(bits) - 1)
        found &= (bits[(cells >> np.uint64(3)).astype(np.int64)] >> (cells & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return found


def _phrases(words: _Words, salts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all phrases of ``length`` words, and their keys."""
    whole = np.ones(max(0, len(words.hashes) - length + 1), bool)
    for i in range(length - 1):
        whole &= words.joined[i : i + len(whole)]
    first = np.flatnonzero(whole)
    return first, mixed(windows(words.hashes, length)[first] ^ salts[words.owners[first]])


def _sums(codes: np.ndarray, counts: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of equal codes added up, codes ascending; ``more`` is the same for equal codes."""
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else order
    return codes[first], np.add.reduceat(counts[order], first) if len(codes) else counts, more[order][first]


class _Tally:
    """Counts of codes, added up whenever too many wait."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, codes: np.ndarray, counts: np.ndarray, more: np.ndarray) -> None:
        self.parts.append((codes, counts, more))
        self.waiting += len(codes)
        if self.waiting > 2 * _ENTRIES:
            self.parts = [self.all()]
            self.waiting = len(self.parts[0][0])

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return _sums(*(np.concatenate(x) for x in zip(*self.parts)))

    def full(self) -> bool:
        return self.waiting > _ENTRIES


def _blocks(codes: np.ndarray, counts: np.ndarray, needs: np.ndarray) -> pa.RecordBatch:
    """Sorted codes by segment: the low halves, the counts and the needs of each."""
    segments = codes >> np.uint64(32)
    first = np.flatnonzero(np.append(True, segments[1:] != segments[:-1])) if len(codes) else np.zeros(0, np.int64)
    low, counts, needs = codes.astype("<u4"), counts.astype("<i8"), needs.astype("<i8")
    bounds = [*first.tolist(), len(codes)]
    packed = [b"".join(x[a:b].tobytes() for x in (low, counts, needs)) for a, b in zip(bounds[:-1], bounds[1:])]
    return pa.RecordBatch.from_arrays([pa.array(segments[first].astype(np.int64)), pa.array(packed, pa.binary())], names=["segment", "entries"])


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes of whole segments, which come one after the other, that reach their need."""
    current, tally = None, _Tally()

    def enough() -> pa.RecordBatch:
        low, counts, needs = tally.all()
        found = low[counts >= needs].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found + (current or 0) * (1 << 32), pa.int64())], names=["code"])

    for batch in batches:
        for segment, entries in zip(batch.column("segment").to_pylist(), batch.column("entries").to_pylist()):
            if segment != current:
                yield enough()
                current, tally = segment, _Tally()
            n = len(entries) // 20
            low = np.frombuffer(entries, "<u4", n)
            tally.add(low, np.frombuffer(entries, "<i8", n, 4 * n), np.frombuffer(entries, "<i8", n, 12 * n))
    yield enough()


class _Shards(NamedTuple):
    """How phrases of shards are numbered: a code holds the shard and the first ``cell_bits`` bits
    of the key; its upper part, above 32 bits, is its segment."""

    mining: Mining
    cell_bits: int

    def codes(self, keys: np.ndarray, shards: np.ndarray) -> np.ndarray:
        return shards.astype(np.uint64) << np.uint64(self.cell_bits) | self.cells(keys)

    def cells(self, keys: np.ndarray) -> np.ndarray:
        return keys >> np.uint64(64 - self.cell_bits)


def _mined(docs: DataFrame, of: _Shards, lengths: range, name: str, parts: int = 0, bits=None) -> tuple[DataFrame, int]:
    """``code`` of the phrases that are frequent in a shard, and their number: of those phrases all
    of whose contiguous phrases of ``parts`` words are in the bit map, or of all without a map.
    Occurrences are added up in each task, travel by segment, and are added up there."""
    marks = _shard_marks(of.mining.shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        for batch in text_slices(batches):
            salts = _salts(batch.column("lang").to_pylist())
            shards, needs = batch.column("shard").to_numpy(), batch.column("need").to_numpy()
            words = _words(*text_bytes(batch.column("text")))
            allowed = np.zeros(len(words.hashes), bool)
            if bits is not None:
                first, keys = _phrases(words, salts, parts)
                allowed[first[_in_map(bits.value, of.cells(keys) ^ marks[shards[words.owners[first]]])]] = True
            for length in lengths:
                first, keys = _phrases(words, salts, length)
                if bits is not None:
                    inside = np.ones(len(first), bool)
                    for i in range(length - parts + 1):
                        inside &= allowed[first + i]
                    first, keys = first[inside], keys[inside]
                owners = words.owners[first]
                codes, sample, counts = np.unique(of.codes(keys, shards[owners]), return_index=True, return_counts=True)
                tally.add(codes, counts, needs[owners[sample]])
            if tally.full():
                yield _blocks(*tally.all())
                tally = _Tally()
        yield _blocks(*tally.all())

    return _added_up(docs.mapInArrow(run, "segment long, entries binary"), name)


def _added_up(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    segments = rows.repartition("segment").sortWithinPartitions("segment")
    return stage_counted(segments.mapInArrow(_frequent, "code long"), name)


def _hits(words: _Words, salts: np.ndarray, of: _Shards, bits: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, first words and keys of the phrases that are in the map with all of their parts."""
    allowed = np.ones(len(words.hashes) + 1, bool)
    for length in range(1, of.mining.longest + 1):
        first, keys = _phrases(words, salts, length)
        # every part of a frequent phrase is frequent
        hits = _in_map(bits, of.cells(keys)) & allowed[first] & (allowed[first + 1] if length > 1 else True)
        allowed[:] = False
        allowed[first[hits]] = True
        yield length, first[hits], keys[hits]


def _everywhere(docs: DataFrame, of: _Shards, bits) -> tuple[DataFrame, int]:
    """``code`` of the cells of phrases in the map that reach the support over all documents, and
    their number. Phrases that share a cell are counted together, which only adds some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        for batch in text_slices(batches):
            words = _words(*text_bytes(batch.column("text")))
            for _, _, keys in _hits(words, _salts(batch.column("lang").to_pylist()), of, bits.value):
                codes, counts = np.unique(of.cells(keys), return_counts=True)
                tally.add(codes, counts, np.full(len(codes), of.mining.support))
            if tally.full():
                yield _blocks(*tally.all())
                tally = _Tally()
        yield _blocks(*tally.all())

    return _added_up(docs.mapInArrow(run, "segment long, entries binary"), "frequent-everywhere")


def _bit_map(keys: DataFrame, rows: int) -> np.ndarray:
    """A map of the column ``key``: 64 bits for each row, up to the bound."""
    n_bits = 1 << min(MOST_BITS, max(15, (64 * rows).bit_length()))
    both = F.explode(F.array("key", F.shiftrightunsigned("key", _SHIFT))).alias("key")
    cell = F.col("key").bitwiseAND(n_bits - 1) + 1
    maps = keys.select(both).groupBy(F.bitmap_bucket_number(cell).alias("map"))
    maps = maps.agg(F.bitmap_construct_agg(F.bitmap_bit_position(cell)).alias("bits")).collect()
    bits = np.zeros(n_bits // 8, np.uint8)
    for row in maps:
        start = (row["map"] - 1) * _BITS_A_MAP // 8
        bits[start : start + _BITS_A_MAP // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits


def _candidates(docs: DataFrame, mining: Mining) -> tuple[_Shards, object, DataFrame]:
    """Bit map of what is frequent in any shard and over all documents, by the hashes of both passes,
    and ``lang, total`` words of each language."""
    share = docs.sparkSession.sparkContext.broadcast
    size = F.regexp_count("text", F.lit(_WORD)).cast("long")
    parts = written(docs.groupBy("shard", "lang").agg(F.sum(size).alias("words")), "shard-words")
    totals = written(parts.groupBy("lang").agg(F.sum("words").alias("total")).where("total > 0"), "totals")
    needs = parts.join(totals, "lang").select("shard", "lang", F.expr(f"({mining.support} * words + total - 1) div total").alias("need"))
    docs = docs.join(written(needs, "needs"), ["shard", "lang"])
    words = totals.agg(F.sum("total")).first()[0] or 0
    segments = mining.longest * words // (mining.shards * _ENTRIES)
    of = _Shards(mining, 32 + min(max(segments.bit_length(), _SHIFT), 24))

    marks = F.array(*(F.lit(int(x)) for x in _shard_marks(mining.shards).view(np.int64)))
    cell = F.col("code").bitwiseAND((1 << of.cell_bits) - 1)
    in_shard = cell.bitwiseXOR(F.get(marks, F.shiftright("code", of.cell_bits).cast("int"))).alias("key")
    found = [_mined(docs, of, range(1, 2), "frequent-words")]
    for parts_of, lengths in ((1, range(2, 3)), (2, range(3, mining.longest + 1))):
        if not lengths or lengths[0] > mining.longest:
            break
        bits = share(_bit_map(found[-1][0].select(in_shard), found[-1][1]))
        found.append(_mined(docs, of, lengths, f"frequent-{lengths[0]}", parts_of, bits))
    every = found[0][0]
    for more, _ in found[1:]:
        every = every.unionByName(more)
    bits = share(_bit_map(every.select(cell.alias("key")), sum(rows for _, rows in found)))
    kept, n_kept = _everywhere(docs, of, bits)
    return of, share(_bit_map(kept.select(F.col("code").alias("key")), n_kept)), totals


class _Counts:
    """Counts of phrases under their 64-bit keys, and each phrase as text."""

    def __init__(self):
        self.keys = np.zeros(0, np.uint64)
        self.rows = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.texts: list[tuple[str, str, int]] = []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Add counts of distinct keys; returns the places of those that are new, whose texts
        have to be appended."""
        places = np.searchsorted(self.keys, keys)
        known = places < len(self.keys)
        known[known] = self.keys[places[known]] == keys[known]
        self.counts[self.rows[places[known]]] += counts[known]
        new = np.flatnonzero(~known)
        rows = len(self.counts) + np.arange(len(new))
        self.keys = np.insert(self.keys, places[new], keys[new])
        self.rows = np.insert(self.rows, places[new], rows)
        self.counts = np.concatenate([self.counts, counts[new]])
        return new

    def batch(self) -> pa.RecordBatch:
        langs, phrases, lengths = zip(*self.texts) if self.texts else ((), (), ())
        columns = [pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(lengths, pa.int32()), pa.array(self.counts)]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "words", "n"])


def _counter(of: _Shards, bits) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Counts()
        for batch in text_slices(batches):
            langs = batch.column("lang").to_pylist()
            salts = _salts(langs)
            raw, offsets = text_bytes(batch.column("text"))
            words = _words(raw, offsets)
            changes = np.ones(len(raw) + 1, bool)
            if len(raw):
                changes[1:-1] = _CLASSES[raw[1:]] != _CLASSES[raw[:-1]]
            changes[offsets] = True
            changes = np.flatnonzero(changes)
            ends = changes[np.searchsorted(changes, words.starts, side="right")]
            data = LOWER[raw].tobytes()
            for length, first, keys in _hits(words, salts, of, bits.value):
                keys, sample, counts = np.unique(keys, return_index=True, return_counts=True)
                new = found.add(keys, counts)
                first = first[sample[new]]
                owners, starts, stops = words.owners[first], words.starts[first], ends[first + length - 1]
                for i, a, b in zip(owners.tolist(), starts.tolist(), stops.tolist()):
                    found.texts.append((langs[i], b" ".join(data[a:b].split()).decode(), length))
            if len(found.texts) > _TEXTS:
                yield found.batch()
                found = _Counts()
        yield found.batch()

    return run


def phrase_counts(docs: DataFrame, text_col: str, lang_col: str, mining: Mining = Mining()) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, n`` of every phrase of up to ``longest`` words, single words
    included, that occurs ``support`` times or more in its language; and ``lang, total`` words."""
    text, lang = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(lang_col), F.lit(UNKNOWN))
    shard = F.pmod(F.xxhash64(text), F.lit(mining.shards)).cast("int")
    rows = docs.select(text.alias("text"), lang.alias("lang"), shard.alias("shard"))
    of, bits, totals = _candidates(rows, mining)
    counted = rows.mapInArrow(_counter(of, bits), "lang string, phrase string, words int, n long")
    counted = counted.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
    return written(counted.where(F.col("n") >= mining.support), "phrases"), totals


def _split(at: Column | int) -> tuple[Column, Column]:
    words = F.split("phrase", " ", -1)
    return (
        F.array_join(F.slice(words, 1, at), " "),
        F.array_join(F.slice(words, at + F.lit(1), F.col("words") - at), " "),
    )


def collocations(
    docs: DataFrame, text_col: str, lang_col: str, mining: Mining = Mining(), top: int = 2000, absorbed: int = 100
) -> DataFrame:
    """The ``top`` phrases of two words or more of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A-Z are lower-cased, texts cut into pieces and these into words; phrases do not leave their
    piece. ``a`` is the number of occurrences, overlaps included, and ``n`` all words of the
    language. A phrase is cut in two where ``floor(1000 * a * n / (l * r))`` is smallest, at the
    first such place; ``l`` and ``r`` are the occurrences of both parts. Phrases within a longer
    one that has ``absorbed`` per cent of their occurrences are left out. Order: score, then
    ``a``, both descending, then the phrase by its bytes.

    Null texts are empty, a null language is ``und``. Repeated rows count each; no rows, or no
    phrase that is frequent enough, give no rows. Other columns are not read.
    """
    counted, totals = phrase_counts(docs, text_col, lang_col, mining)
    phrases = counted.where("words > 1")
    # a longer phrase absorbs through the phrases between, so one word more is far enough
    head, tail = _split(F.col("words") - 1)[0], _split(F.lit(1))[1]
    inner = phrases.select("lang", F.explode(F.array(head, tail)).alias("phrase"), F.col("n").alias("outer_n"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("outer_n").alias("outer_n"))
    alone = phrases.join(inner, ["lang", "phrase"], "left").where(f"outer_n is null or 100 * outer_n < {absorbed} * n")

    cuts = alone.select("lang", "phrase", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    left, right = _split(F.col("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", left.alias("left"), right.alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counted.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    cuts = cuts.join(totals.withColumnRenamed("total", "n"), "lang")
    # up to 38 digits; the quotient is at most 1000 * n / a
    score = F.expr("cast(a as decimal(17)) * cast(n as decimal(17)) * 1000bd div (cast(l as decimal(19)) * cast(r as decimal(19)))")
    cuts = cuts.withColumn("score", score)
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("best"))
    best = best.select("lang", "phrase", "best.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
