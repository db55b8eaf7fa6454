"""The trie of conversations that begin alike, with totals over every subtree.

A node is a sequence of first turns. Its id is a polynomial of the digests of the turns modulo
``2**127 - 1``, taken in one scan of the turns in order; conversations that a task boundary cuts
are joined up by the same polynomial, so no conversation has to lie in one task.

Totals are passed to parents by time-forward processing. Nodes are dealt to shards, sorted there
by reverse level (Spark's external sort), and each node takes from a priority queue what its
children have sent, and sends its own totals on. A shard holds all nodes below one first turn;
where these are too many, it holds a stretch of one conversation. First the sums of whole shards
are passed on between the roots of the shards, by doubling, so that neither a long conversation
nor a first turn with very many others below it takes more than a few rounds; then each shard is
swept once with what came from outside. Totals are sums, so an over-full queue gives up what
is needed last as rows of the shared table, which a further sweep delivers.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

_PRIME = (1 << 127) - 1
#: Drawn once; two sequences of n turns have one id with a probability of about n / 2**127.
_BASE = 0x5C8E1D90B7A3F2461E0D7B95C3A8F16B
_ROOT = (1).to_bytes(16, "big")

#: Conversations whose ids are written in one string before they are hashed.
_IDS_A_CHUNK = 1 << 16

#: Rows of a batch that a scan gives.
_ROWS = 20_000

_ORDER = ("turn", "digest")


class Sweep(NamedTuple):
    """``shard_nodes``: most nodes of a shard below one first turn; ``block``: turns of a stretch
    of one conversation; ``queue``: totals that wait in memory. None changes a result."""

    shard_nodes: int = 50_000
    block: int = 4_096
    queue: int = 250_000


def turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, turn, digest, n_chars, copies``: turns without their texts, equal rows once.

    Rows without a conversation are passed over. Null roles and texts are empty. Turns are ordered
    by ``turn``, null first; those of one number by the digest of role and text.
    """
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role_col, text_col))
    digest = F.unhex(F.md5(F.concat_ws(":", F.octet_length(role), F.concat(role, text))))
    rows = df.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        digest.alias("digest"),
        F.char_length(text).cast("long").alias("n_chars"),
    )
    rows = rows.groupBy("conv", "turn", "digest", "n_chars").agg(F.count(F.lit(1)).alias("copies"))
    return written(rows, "turns")


def share_openings(own: DataFrame, source: Column, shared: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Each conversation rebuilt: the first ``shared`` turns of the conversation ``source``, all
    if it has fewer and none if there is no such one, and then its own turns after its first
    ``shared``. ``source`` and ``shared``, at most ``most``, are expressions over ``conv``.

    Returns turns as ``prefix_trie`` takes them, and all conversations, as some are left empty.
    """
    convs = own.select("conv").distinct()
    place = Window.partitionBy("conv").orderBy(*_ORDER)
    opening = own.withColumn("row", F.row_number().over(place)).where(F.col("row") <= most)
    before = F.coalesce(F.sum("copies").over(place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    opening = written(opening.withColumn("before", before), "openings")

    def within(limit: Column) -> Column:
        return F.least(F.greatest(limit - F.col("before"), F.lit(0)), F.col("copies"))

    gone = opening.select("conv", *_ORDER, within(shared).alias("gone")).where("gone > 0")
    same = (F.col("o.conv") == F.col("g.conv")) & F.col("o.turn").eqNullSafe(F.col("g.turn")) & (F.col("o.digest") == F.col("g.digest"))
    kept = own.alias("o").join(gone.alias("g"), same, "left")
    kept = kept.select("o.*", "g.gone").withColumn("copies", F.col("copies") - F.coalesce("gone", F.lit(0)))
    kept = kept.where("copies > 0").select("conv", F.lit(1).alias("source"), *_ORDER, "n_chars", "copies")

    wanted = convs.select("conv", source.alias("from"), shared.alias("shared"))
    lent = wanted.join(opening.withColumnRenamed("conv", "from"), "from")
    lent = lent.withColumn("copies", within(F.col("shared"))).where("copies > 0")
    lent = lent.select("conv", F.lit(0).alias("source"), *_ORDER, "n_chars", "copies")
    return written(kept.unionByName(lent), "rebuilt"), convs


def _number(x: bytes) -> int:
    return int.from_bytes(x, "big")


def _bytes(x: int) -> bytes:
    return x.to_bytes(16, "big")


_SCANNED = "conv long, depth long, id binary, parent binary, opening binary, n_chars long, part int, first boolean, edge boolean"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Depth and ids of sorted turns as if each conversation began in this task. ``first`` marks
    its first conversation, which may have begun before; ``edge`` the last row of the first and of
    the last conversation."""
    conv, depth, value, opening, first = None, 0, 1, _ROOT, None
    held: tuple | None = None
    for batch in batches:
        rows = []
        columns = (batch.column(x).to_pylist() for x in ("conv", "digest", "n_chars", "copies", "part"))
        for own, digest, n_chars, copies, part in zip(*columns):
            if own != conv:
                if held:
                    rows.append((*held, held[-1]))
                    held = None
                first = first is None
                conv, depth, value = own, 0, 1
            x = _number(digest)
            for _ in range(copies):
                parent, value, depth = value, (value * _BASE + x) % _PRIME, depth + 1
                if depth == 1:
                    opening = _bytes(value)
                if held:
                    rows.append((*held, False))
                held = (own, depth, _bytes(value), _bytes(parent), opening, n_chars, part, first)
                if len(rows) >= _ROWS:
                    yield _record(rows)
                    rows = []
        yield _record(rows)
    if held:
        yield _record([(*held, True)])


def _record(rows: list[tuple]) -> pa.RecordBatch:
    names = ["conv", "depth", "id", "parent", "opening", "n_chars", "part", "first", "edge"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_()]
    columns = zip(*rows) if rows else ([] for _ in names)
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], names=names)


class _Before(NamedTuple):
    """Where a conversation stands that began in an earlier task."""

    conv: int
    depth: int
    value: int
    opening: bytes


def _continued(edges: Iterable) -> dict[int, _Before]:
    """Of each part that begins within a conversation, what came before."""
    found: dict[int, _Before] = {}
    last: _Before | None = None
    for row in sorted(edges, key=lambda r: (r["part"], r["conv"])):
        depth, value, opening = row["depth"], _number(row["id"]), row["opening"]
        if last and last.conv == row["conv"]:
            found[row["part"]] = last
            value = (value + (last.value - 1) * pow(_BASE, depth, _PRIME)) % _PRIME
            depth, opening = depth + last.depth, last.opening
        last = _Before(row["conv"], depth, value, bytes(opening))
    return found


def _carry(before: dict[int, _Before]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                known = before.get(row["part"])
                if known:
                    power, moved = pow(_BASE, row["depth"] - 1, _PRIME), known.value - 1
                    row["parent"] = _bytes((_number(row["parent"]) + moved * power) % _PRIME)
                    row["id"] = _bytes((_number(row["id"]) + moved * power * _BASE) % _PRIME)
                    row["depth"] += known.depth
                    row["opening"] = known.opening
                rows.append(tuple(row.values()))
            yield _record(rows)

    return run


def _scanned(rows: DataFrame) -> DataFrame:
    """A row for each turn: ``conv, depth, id, parent, opening, n_chars``."""
    spark = rows.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [x for x in ("conv", "source", *_ORDER) if x in rows.columns]
    ordered = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    ordered = ordered.select("conv", "digest", "n_chars", "copies", "part")
    local = written(ordered.mapInArrow(_scan, _SCANNED), "scanned")
    # two rows a task at most
    edges = local.where("edge").select("part", "conv", "depth", "id", "opening").collect()
    before = _continued(edges)
    if not before:
        return local
    inside = F.col("first") & F.col("part").isin(list(before))
    return local.where(~inside).unionByName(local.where(inside).mapInArrow(_carry(before), _SCANNED))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, count, state = None, 0, None
    for batch in batches:
        out = []
        for own, ids, rows in zip(*(batch.column(x).to_pylist() for x in ("id", "ids", "rows"))):
            if own != node:
                if node is not None:
                    out.append((node, count, state.hexdigest()))
                node, count, state = own, 0, hashlib.sha256()
            state.update((("," if count else "") + ids).encode())
            count += rows
        yield _ended(out)
    yield _ended([(node, count, state.hexdigest())] if node is not None else [])


def _ended(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([], [], [])
    arrays = [pa.array(x, kind) for x, kind in zip(columns, (pa.binary(), pa.int64(), pa.string()))]
    return pa.RecordBatch.from_arrays(arrays, names=["id", "n_ends", "ends_sha256"])


def _ends(scanned: DataFrame, convs: DataFrame) -> DataFrame:
    """``id, n_ends, ends_sha256`` of the nodes at which conversations end. Ids are joined in
    chunks before they meet; the digest itself is read in order, one chunk after the other."""
    last = scanned.groupBy("conv").agg(F.max_by("id", "depth").alias("id"))
    last = convs.join(last, "conv", "left").select("conv", F.coalesce("id", F.lit(_ROOT)).alias("id"))
    chunk = F.floor(F.col("conv") / _IDS_A_CHUNK).alias("chunk")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("ids")
    chunks = last.groupBy("id", chunk).agg(ids, F.count(F.lit(1)).alias("rows"))
    chunks = chunks.repartition("id").sortWithinPartitions("id", "chunk").select("id", "ids", "rows")
    return written(chunks.mapInArrow(_hashed, "id binary, n_ends long, ends_sha256 string"), "ends")


def _nodes(scanned: DataFrame, convs: DataFrame, sweep: Sweep) -> DataFrame:
    """Distinct nodes with their own share of the totals, their shard and their parent's."""
    nodes = scanned.groupBy("id").agg(
        F.min("parent").alias("parent"),
        F.min("depth").alias("depth"),
        F.min("conv").alias("conv"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("n_chars").alias("n_chars"),
        F.min("opening").alias("opening"),
    )
    # an aggregate without keys gives a row for no rows, too
    top = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root, long = F.lit(_ROOT), F.lit(0).cast("long")
    top = top.select(
        root.alias("id"), F.lit(None).cast("binary").alias("parent"), long.alias("depth"), "conv", "n_convs", long.alias("n_chars"), root.alias("opening")
    )
    nodes = written(nodes.unionByName(top), "nodes")
    crowded = nodes.groupBy("opening").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > sweep.shard_nodes)
    stretch = F.encode(F.concat_ws(":", "conv", F.floor(F.col("depth") / sweep.block)), "utf-8")
    nodes = nodes.join(crowded.select("opening", F.lit(True).alias("crowded")), "opening", "left")
    nodes = nodes.withColumn("crowded", F.coalesce("crowded", F.lit(False)))
    nodes = nodes.withColumn("shard", F.when(F.col("crowded"), stretch).otherwise(F.col("opening")))
    nodes = nodes.join(_ends(scanned, convs), "id", "left")
    nodes = nodes.withColumn("leaves", (F.col("n_convs") == F.col("n_ends")).cast("long"))
    nodes = nodes.withColumn("leaves", F.coalesce("leaves", F.lit(0).cast("long")))
    nodes = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("n_chars"))
    nodes = nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    nodes = nodes.drop("opening", "n_ends", "n_chars")
    nodes = written(nodes, "dealt-nodes")
    above = nodes.select(F.col("id").alias("parent"), F.col("conv").alias("parent_conv"), F.col("shard").alias("parent_shard"))
    return written(nodes.join(above, "parent", "left"), "linked-nodes")


def _messages(nodes: DataFrame) -> DataFrame:
    """What shards send to nodes of other shards: ``shard, depth, id, children, leaves, saved``."""
    top = F.col("parent_shard").isNotNull() & (F.col("parent_shard") != F.col("shard"))
    place = F.max(F.when(top, F.struct("parent", "parent_shard", "depth"))).alias("place")
    sums = nodes.groupBy("shard", "crowded").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), place)
    sums = written(sums.where("place is not null"), "shards")
    above = F.when(F.col("place.parent_shard") != F.lit(_ROOT), F.col("place.parent_shard")).alias("above")
    current = written(sums.where("crowded").select("shard", above, "leaves", "saved"), "totals")
    # what lies fewer than 2**k shards below is summed up; the next round adds as many again
    left_over = current.where("above is not null").limit(1).count()
    while left_over:
        below = current.where("above is not null").groupBy(F.col("above").alias("shard"))
        below = below.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        higher = current.select(F.col("shard").alias("above"), F.col("above").alias("next"))
        step = current.join(below, "shard", "left").join(higher, "above", "left").select(
            "shard",
            F.col("next").alias("above"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        )
        current = written(step, "totals")
        left_over = current.where("above is not null").limit(1).count()
    whole = current.select("shard", F.struct("leaves", "saved").alias("whole"))
    sums = sums.join(whole, "shard", "left").select(
        F.col("place.parent_shard").alias("shard"),
        (F.col("place.depth") - 1).alias("depth"),
        F.col("place.parent").alias("id"),
        F.coalesce("whole.leaves", "leaves").alias("leaves"),
        F.coalesce("whole.saved", "saved").alias("saved"),
    )
    sent = sums.groupBy("shard", "depth", "id")
    return sent.agg(F.count(F.lit(1)).alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


class TotalsQueue:
    """Totals under way to nodes, the deepest first. Of more than ``limit``, the half that is
    needed last is given up by ``push``."""

    def __init__(self, limit: int):
        self.limit = max(1, limit)
        self.heap: list[tuple[int, bytes]] = []
        self.totals: dict[tuple[int, bytes], list[int]] = {}

    def push(self, depth: int, node: bytes, totals: Iterable[int]) -> list[tuple]:
        key = (-depth, node)
        known = self.totals.get(key)
        if known:
            known[:] = map(int.__add__, known, totals)
            return []
        self.totals[key] = list(totals)
        heapq.heappush(self.heap, key)
        if len(self.heap) <= self.limit:
            return []
        kept = max(1, self.limit // 2)
        ordered = sorted(self.heap)
        self.heap, spilled = ordered[:kept], ordered[kept:]
        return [(-depth, node, *self.totals.pop((depth, node))) for depth, node in spilled]

    def pop(self, depth: int, node: bytes) -> list[int]:
        """Totals for the node, which is the next in reverse level order."""
        if self.heap and self.heap[0] == (-depth, node):
            return self.totals.pop(heapq.heappop(self.heap))
        return [0, 0, 0]


_CARRIED = ["conv", "parent_conv", "n_convs", "ends_sha256"]
_TOTALS = ["children", "leaves", "saved"]
_SWEPT = "shard binary, depth long, id binary, conv long, parent_conv long, n_convs long, ends_sha256 string, children long, leaves long, saved long, spilled boolean"


def _sweep_shards(limit: int, again: bool):
    """Nodes with their totals, and totals that the queue gave up. ``again`` says that nodes have
    been heard by their parents before, and send on what comes in addition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, queue, waiting = None, TotalsQueue(limit), [0, 0, 0]
        for batch in batches:
            names = ("shard", "depth", "id", "is_node", "parent", "inside", *_TOTALS)
            rows, sums, spilled = [], [], []
            for i, (own, depth, node, is_node, parent, inside, *totals) in enumerate(zip(*(batch.column(x).to_pylist() for x in names))):
                if own != shard:
                    shard, queue = own, TotalsQueue(limit)
                if not is_node:
                    waiting = list(map(int.__add__, waiting, totals))
                    continue
                whole = [sum(x) for x in zip(totals, waiting, queue.pop(depth, node))]
                waiting = [0, 0, 0]
                rows.append(i)
                sums.append(whole)
                sent = (0 if again else 1, *whole[1:])
                if inside and any(sent):
                    spilled += ((own, *x) for x in queue.push(depth - 1, parent, sent))
            done = batch.select(["shard", "depth", "id", *_CARRIED]).take(pa.array(rows, pa.int64()))
            more = [pa.array([x[k] for x in sums], pa.int64()) for k in range(3)]
            fields = pa.schema([(x, done.schema.field(x).type) for x in done.schema.names] + [(x, pa.int64()) for x in _TOTALS] + [("spilled", pa.bool_())])
            yield pa.RecordBatch.from_arrays([*done.columns, *more, pa.array([False] * len(rows), pa.bool_())], schema=fields)
            if spilled:
                own, depth, node, *totals = zip(*spilled)
                known = {"shard": own, "depth": depth, "id": node, **dict(zip(_TOTALS, totals)), "spilled": [True] * len(own)}
                yield pa.RecordBatch.from_arrays([pa.array(known.get(f.name, [None] * len(own)), f.type) for f in fields], schema=fields)

    return run


def _swept(nodes: DataFrame, messages: DataFrame, sweep: Sweep) -> DataFrame:
    """Nodes with their totals."""
    inside = F.coalesce(F.col("parent_shard") == F.col("shard"), F.lit(False)).alias("inside")
    nodes = nodes.select("shard", "depth", "id", F.lit(True).alias("is_node"), "parent", inside, F.lit(0).cast("long").alias("children"), "leaves", "saved", *_CARRIED)
    out = []
    while True:
        rows = nodes.unionByName(messages.withColumn("is_node", F.lit(False)), allowMissingColumns=True)
        rows = rows.repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "id", "is_node")
        swept = written(rows.mapInArrow(_sweep_shards(sweep.queue, bool(out)), _SWEPT), "swept")
        out.append(swept.where("not spilled"))
        messages = swept.where("spilled").select("shard", "depth", "id", *_TOTALS)
        if not messages.limit(1).count():
            break
        # what is under way has left its senders; only those above it still change
        messages = written(messages.groupBy("shard", "depth", "id").agg(*(F.sum(x).alias(x) for x in _TOTALS)), "spilled")
        own = {x: F.lit(0).cast("long") for x in ("leaves", "saved")}
        nodes = nodes.withColumns(own).join(messages.select("shard").distinct(), "shard", "left_semi")
    if len(out) == 1:
        return out[0]
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    return every.groupBy("id", "depth", *_CARRIED).agg(*(F.sum(x).alias(x) for x in _TOTALS))


def prefix_trie(rows: DataFrame, convs: DataFrame, sweep: Sweep = Sweep()) -> DataFrame:
    """The nodes of the trie of conversations, given by ``turns`` or ``share_openings``; ``convs``
    holds each ``conv`` once, those without turns included.

    ``conv_id`` is the smallest member, a conversation that begins with the node's turns, and with
    ``depth`` names the node; ``parent_conv_id`` is that of the parent, null for the root, which
    all conversations begin with. ``n_convs`` members, ``n_children`` children, ``n_leaves``
    childless nodes in the subtree, the node included; ``saved_tokens`` sums, over the subtree,
    members but one times the code points of the node's last text; ``ends_sha256`` is the digest of the
    ids of the members that end there, ascending and joined by commas.

    No conversations give no rows; conversations without turns only, the root alone.
    """
    scanned = _scanned(rows)
    nodes = _nodes(scanned, convs, sweep)
    found = _swept(nodes, _messages(nodes), sweep)
    return found.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        "n_convs",
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )
