"""Frequent itemsets over baskets, and the two-pass variant over chunks of baskets.

Baskets are mined level by level. A basket is a row ``(prefix, lasts, weight)``: the
items fixed so far, the later items it may grow by, and how many equal baskets it
stands for. One level is

1. move each item of ``lasts`` to the prefix and count ``(prefix, last)`` - one
   aggregation, merged before the shuffle;
2. join the frequent ones back by prefix and cut ``lasts`` down to them.

Items are numbered rare first, so prefixes shared by very many rows have few items left
to grow by. A basket with more than ``crowded`` frequent items is never one array: it lies
in blocks of neighbouring numbers, at most ``crowded`` to a block, and each pair of its
blocks is a row of its own when it grows. The limit is fixed; it bounds rows and changes
no support.

From the third level on, rows are first cut down to candidates: itemsets of which every subset
with one item less is frequent. Where baskets are short, so that all their subsets are few times
their pairs, no level is needed: all subsets of all baskets are counted in one aggregation.
Which way is taken follows from counted sizes; supports are the same.

Where there are few different items, a basket is one integer with a bit for each. Rows are then
merged by basket before the shuffle, and equal baskets right after it. Subsets are integers too,
and are counted for a range of sizes at a time until no larger one can be frequent.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import discard, first_row, shuffles_dropped, spread, stage, stage_counted
from . import pairs as pairing
from .pairs import dealt_by_first, largest_group, pairs_within

# Frequent items a basket may hold as one array; above it, it lies in blocks of as many.
CROWDED_BASKET = 200
# Items a prefix may grow by before they are matched by join instead of as one array.
WIDE_PREFIX = 4096
# Subsets for each pair up to which all subsets are counted at once, and the longest basket then.
SUBSETS_A_PAIR = 8
SHORT_BASKET = 14
# Different items up to which a basket is one integer, and what holds in place of the limits above then.
FEW_ITEMS = 62
FEW_SUBSETS_A_PAIR = 64
FEW_TIMES_LONGER = 1.7
# Sizes of subsets that are counted in one aggregation there.
SIZES_AT_ONCE = 5
# Baskets that a pair of items must share within one part of the baskets, where pairs are found by them.
SHARED_IN_PART = 3
# Parts of the baskets there: so many that a pair with ``need`` of them still shares two groups or more, from need 6 on.
PARTS = "greatest(1L, (need - 2) div 2)"
# Groups of baskets that are met at a time.
GROUPS_A_ROUND = 40_000_000
# Levels between two written basket tables; in between they are derived again.
STAGE_EVERY = 3


def frequent_itemsets(
    df: DataFrame,
    basket: str,
    item: str,
    min_support: int,
    min_basket_size: int = 0,
    *,
    crowded: int = CROWDED_BASKET,
    wide: int = WIDE_PREFIX,
) -> DataFrame:
    """``(items, size, support)`` for all itemsets held by ``min_support`` baskets or more.

    Only baskets with **more than** ``min_basket_size`` distinct items count. Items
    repeat in a basket once only; rows with a null basket or item are skipped.
    """
    _check(min_support)
    need = F.lit(int(min_support)).cast("bigint")
    few = _few_items(df, item)
    if few is not None:
        masks = _masks(df, basket, item, few, min_basket_size, F.lit(0))
        singles = _numbered_few(_mask_counts(masks, few).filter(F.col("support") >= need))
        grouped = _grouped_masks(masks, singles, few)
    else:
        rows = _basket_rows(df, basket, item, min_basket_size, F.lit(0))
        counts = rows.groupBy("item").agg(F.expr("count(*) AS support"))
        singles = _numbered(counts.filter(F.col("support") >= int(min_support)))
        grouped = _grouped(rows, singles, crowded)
    levels = _mine(grouped, need, wide)
    found = singles.selectExpr("array(number) AS numbers", "support")
    for level in levels:
        found = found.unionByName(level.select("numbers", "support"))
    return _named(found, singles, "support")


def son_candidates(
    df: DataFrame,
    basket: str,
    item: str,
    min_support: int,
    n_chunks: int,
    min_basket_size: int = 0,
    *,
    chunk: Column | None = None,
    crowded: int = CROWDED_BASKET,
    wide: int = WIDE_PREFIX,
) -> DataFrame:
    """``(items, size, chunks)``: itemsets frequent in at least one chunk of the baskets.

    A chunk with a share of all baskets needs that share of ``min_support``. ``chunk`` is
    an integer expression over the basket in ``0 .. n_chunks - 1``, by default its hash;
    ``chunks`` is the number of chunks that name the itemset.
    """
    mined = _first_pass(df, basket, item, min_support, n_chunks, min_basket_size, chunk, crowded, wide)
    named = mined.candidates.groupBy("numbers").agg(F.expr("count(*) AS chunks"))
    return _named(named, mined.singles, "chunks")


def son_itemsets(
    df: DataFrame,
    basket: str,
    item: str,
    min_support: int,
    n_chunks: int,
    min_basket_size: int = 0,
    *,
    chunk: Column | None = None,
    crowded: int = CROWDED_BASKET,
    wide: int = WIDE_PREFIX,
) -> DataFrame:
    """Frequent itemsets by two passes: chunk candidates, then one exact recount.

    Every itemset frequent overall is frequent in some chunk, so the result equals
    ``frequent_itemsets`` for any number of chunks. Items are numbered once for both
    passes, and both walk down the same baskets.
    """
    mined = _first_pass(df, basket, item, min_support, n_chunks, min_basket_size, chunk, crowded, wide)
    counted = _recount(mined, wide).filter(F.col("support") >= int(min_support))
    return _named(counted, mined.singles, "support")


def item_levels(itemsets: DataFrame) -> DataFrame:
    """Itemsets in report order: by size, then by items."""
    return itemsets.orderBy("size", "items")


class _Baskets(NamedTuple):
    """Light baskets ``(chunk, prefix, lasts, weight)``, and crowded ones in blocks: the same
    with ``basket`` and ``block``. ``crowded`` is None where no basket is. Where one is, ``ranked`` holds
    the staged ``(chunk, basket, number)`` of all baskets, and ``limit`` the items of a light one.
    ``few`` tells that all numbers are less than ``FEW_ITEMS``."""

    light: DataFrame
    crowded: DataFrame | None
    ranked: DataFrame | None = None
    limit: int = CROWDED_BASKET
    few: bool = False


def _check(min_support: int) -> None:
    if min_support <= 0:
        raise ValueError("min_support must be positive")


def _basket_rows(
    df: DataFrame, basket: str, item: str, min_basket_size: int, chunk: Column
) -> DataFrame:
    """Staged distinct ``(chunk, basket, item)`` of the baskets that count."""
    rows = (
        df.select(F.col(basket).alias("basket"), F.col(item).alias("item")).dropna().distinct()
    )
    if min_basket_size > 0:
        large = (
            rows.groupBy("basket").agg(F.count("*").alias("_items"))
            .filter(F.col("_items") > min_basket_size)
        )
        rows = rows.join(large, "basket", "left_semi")
    return stage(rows.select(chunk.cast("int").alias("chunk"), "basket", "item"), "baskets")


def _few_items(df: DataFrame, item: str) -> DataFrame | None:
    """Staged ``(item, bit)``, or None where there are more than ``FEW_ITEMS`` different items."""
    items = df.select(F.col(item).alias("item")).dropna().distinct().limit(FEW_ITEMS + 1).coalesce(1)
    few, n_items = stage_counted(items.withColumn("bit", F.monotonically_increasing_id().cast("int")), "few-items")
    return few if n_items <= FEW_ITEMS else None


def _masks(
    df: DataFrame, basket: str, item: str, few: DataFrame, min_basket_size: int, chunk: Column
) -> DataFrame:
    """Staged ``(chunk, mask, weight)``: the different baskets that count, and how many there are of each."""
    rows = df.select(F.col(basket).alias("basket"), F.col(item).alias("item")).dropna()
    bits = rows.join(F.broadcast(few), "item").selectExpr("basket", "shiftleft(1L, bit) AS mask")
    whole = bits.groupBy("basket").agg(F.bit_or("mask").alias("mask"))
    if min_basket_size > 0:
        whole = whole.filter(F.bit_count("mask") > min_basket_size)
    merged = whole.select(chunk.cast("int").alias("chunk"), "mask").groupBy("chunk", "mask")
    return stage(merged.agg(F.expr("count(*) AS weight")), "masks")


def _mask_counts(masks: DataFrame, few: DataFrame, *chunk: str) -> DataFrame:
    """``(item, bit, support)`` of the single items, of each chunk if asked."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(FEW_ITEMS - 1)), lambda i: F.getbit("mask", i) == 1)
    ones = masks.select(*chunk, "weight", F.explode(bits).alias("bit"))
    counts = ones.groupBy(*chunk, "bit").agg(F.expr("sum(weight) AS support"))
    return counts.join(F.broadcast(few), "bit")


def _numbered_few(singles: DataFrame) -> DataFrame:
    """As ``_numbered``, with ``bit``, for few items: numbers rise one by one from 0."""
    ordered = singles.select("item", "support", "bit").coalesce(1).sortWithinPartitions("support", "item")
    return stage(ordered.withColumn("number", F.monotonically_increasing_id()), "items")


def _grouped_masks(masks: DataFrame, singles: DataFrame, few: DataFrame) -> _Baskets:
    """As ``_grouped``. The driver sees the bits of the items, few by construction."""
    bits = [row["bit"] for row in singles.select("number", "bit").orderBy("number").collect()]
    rest = masks.selectExpr("chunk", f"mask & {sum(1 << bit for bit in bits)}L AS mask", "weight")
    rest = rest.filter("bit_count(mask) > 1").groupBy("chunk", "mask").agg(F.expr("sum(weight) AS weight"))
    places = F.array(*(F.lit(bit) for bit in bits)) if bits else F.array(F.lit(0))
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(max(0, len(bits) - 1)).cast("bigint"))
    lasts = F.filter(numbers, lambda i: F.getbit("mask", F.get(places, i.cast("int"))) == 1).alias("lasts")
    light = rest.select("chunk", F.expr("CAST(array() AS array<bigint>) AS prefix"), lasts, "weight")
    return _Baskets(stage(spread(light, "lasts"), "grown-1"), None, few=True)


class _Mined(NamedTuple):
    """What both passes share: numbered items, baskets of them, candidates of all chunks as
    ``(chunk, numbers)``, and the size of the largest."""

    singles: DataFrame
    baskets: _Baskets
    candidates: DataFrame
    deepest: int


def _first_pass(df, basket, item, min_support, n_chunks, min_basket_size, chunk, crowded, wide) -> _Mined:
    """Itemsets that reach the need of a chunk: ``ceil(min_support * baskets / all baskets)``,
    computed in integers. There is one need per chunk, so they are part of the plan."""
    _check(min_support)
    if chunk is None:
        chunk = F.pmod(F.xxhash64("basket"), F.lit(n_chunks))
    few = _few_items(df, item)
    if few is not None:
        rows = _masks(df, basket, item, few, min_basket_size, chunk)
        sizes = rows.groupBy("chunk").agg(F.expr("sum(weight) AS baskets"))
    else:
        rows = _basket_rows(df, basket, item, min_basket_size, chunk)
        sizes = rows.select("chunk", "basket").distinct().groupBy("chunk").agg(F.expr("count(*) AS baskets"))
    with shuffles_dropped(df.sparkSession):
        baskets = {row["chunk"]: row["baskets"] for row in sizes.collect()}
    total = sum(baskets.values())
    needs = {number: -(-int(min_support) * count // total) for number, count in baskets.items()}
    need = F.lit(None).cast("bigint")
    for number, least in needs.items():
        need = F.when(F.col("chunk") == number, F.lit(least).cast("bigint")).otherwise(need)
    if few is not None:
        counts, key = _mask_counts(rows, few, "chunk"), ["item", "bit"]
    else:
        counts, key = rows.groupBy("chunk", "item").agg(F.expr("count(*) AS support")), ["item"]
    counts = stage(counts, "chunk-items")
    some = counts.filter(F.col("support") >= need).select("item").distinct()
    each = counts.join(some, "item", "left_semi").groupBy(*key).agg(F.expr("sum(support) AS support"))
    singles = _numbered(each) if few is None else _numbered_few(each)
    ones = counts.filter(F.col("support") >= need).join(singles.select("item", "number"), "item")
    candidates = ones.selectExpr("chunk", "array(number) AS numbers")
    grouped = _grouped(rows, singles, crowded) if few is None else _grouped_masks(rows, singles, few)
    levels = _mine(grouped, need, wide)
    deepest = 1
    for level in levels:
        candidates = candidates.unionByName(level.select("chunk", "numbers"))
    if levels:
        deepest = first_row(candidates.agg(F.max(F.size("numbers"))))[0]
    return _Mined(singles, grouped, candidates, deepest)


def _short(baskets: _Baskets) -> bool:
    """Whether all subsets of all baskets are few beside their pairs."""
    if baskets.crowded is not None:
        return False
    sizes = baskets.light.select(F.size("lasts").cast("double").alias("n"))
    sums = first_row(sizes.agg(F.max("n").alias("longest"), F.sum(F.pow(F.lit(2.0), "n")).alias("subsets"), F.sum(F.expr("n * n")).alias("pairs")))
    longest, a_pair = SHORT_BASKET, SUBSETS_A_PAIR
    if baskets.few:
        longest, a_pair = FEW_TIMES_LONGER * SHORT_BASKET, FEW_SUBSETS_A_PAIR
    return (sums["longest"] or 0) <= longest and (sums["subsets"] or 0) <= a_pair * (sums["pairs"] or 0)


def _all_subsets(light: DataFrame, *chunk: str) -> DataFrame:
    """``(numbers, support)`` of every subset of two items or more, in one aggregation."""
    masks = light.select(*chunk, "lasts", "weight", F.explode(F.expr("sequence(3, (1 << size(lasts)) - 1)")).alias("mask"))
    several = masks.filter("bit_count(mask) > 1")
    numbers = F.filter("lasts", lambda x, i: F.getbit("mask", i) == 1).alias("numbers")
    return several.select(*chunk, numbers, "weight").groupBy(*chunk, "numbers").agg(F.expr("sum(weight) AS support"))


def _few_subsets(light: DataFrame, least: int, most: int, *chunk: str) -> DataFrame:
    """``(mask, support)`` of every subset of ``least`` to ``most`` few items, in one aggregation. Subsets of
    either half of a basket are met row by row, so that none is one array with all of them."""
    subsets = """aggregate({}, array(0L), (subsets, number) ->
        concat(subsets, transform(subsets, x -> x | shiftleft(1L, CAST(number AS int)))))"""
    first, second = "slice(lasts, 1, size(lasts) div 2)", "slice(lasts, 1 + size(lasts) div 2, size(lasts))"
    some = light.selectExpr(*chunk, "lasts", "weight", f"explode({subsets.format(first)}) AS some")
    all_ = some.selectExpr(*chunk, "some", "weight", f"explode({subsets.format(second)}) AS rest")
    masks = all_.selectExpr(*chunk, "some | rest AS mask", "weight").filter(f"bit_count(mask) BETWEEN {least} AND {most}")
    return masks.groupBy(*chunk, "mask").agg(F.expr("sum(weight) AS support"))


def _mask_numbers() -> Column:
    """The numbers of ``mask``, ascending."""
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(FEW_ITEMS - 1).cast("bigint"))
    return F.filter(numbers, lambda i: F.getbit("mask", i.cast("int")) == 1).alias("numbers")


def _mine_few(light: DataFrame, need: Column) -> list[DataFrame]:
    """As ``_mine``, by all subsets of as many sizes at once as are likely to be needed."""
    found, size = [], 2
    while True:
        largest = size + SIZES_AT_ONCE - 1
        counted = _few_subsets(light, size, largest, "chunk").filter(F.col("support") >= need)
        some, n_found = stage_counted(counted.select("chunk", _mask_numbers(), "support"), "itemsets")
        if n_found:
            found.append(some)
        # A larger frequent itemset has largest + 1 subsets of the largest size, all frequent.
        if n_found <= largest or some.filter(F.size("numbers") == largest).count() <= largest:
            return found
        size = largest + 1


def _candidates(level: DataFrame, size: int) -> DataFrame:
    """``(chunk, numbers)`` of ``size`` numbers, ascending, all of whose subsets with one less are
    in ``level``."""
    parts = level.selectExpr("chunk", f"slice(numbers, 1, {size - 2}) AS prefix", f"numbers[{size - 2}] AS last")
    later = parts.selectExpr("chunk", "prefix", "last AS later")
    grown = parts.join(later, ["chunk", "prefix"]).filter("last < later")
    grown = grown.selectExpr("chunk", "concat(prefix, array(last, later)) AS numbers")
    if size == 2:
        return grown
    # without the last or the last but one it is known to be there
    left_out = f"explode(sequence(1, {size - 2})) AS at"
    subsets = grown.selectExpr("chunk", "numbers", left_out)
    subsets = subsets.selectExpr("chunk", "numbers AS whole", f"concat(slice(numbers, 1, at - 1), slice(numbers, at + 1, {size})) AS numbers")
    there = subsets.join(level.select("chunk", "numbers"), ["chunk", "numbers"], "left_semi")
    complete = there.groupBy("chunk", "whole").agg(F.count("*").alias("_subsets"))
    return complete.filter(F.col("_subsets") == size - 2).selectExpr("chunk", "whole AS numbers")


def _mine(baskets: _Baskets, need: Column, wide: int) -> list[DataFrame]:
    """Staged ``(chunk, numbers, support)`` of two items or more that reach the need of their
    chunk: all at once where baskets are short, or else one table for each size."""
    if _short(baskets):
        if baskets.few:
            return _mine_few(baskets.light, need)
        every, n_found = stage_counted(_all_subsets(baskets.light, "chunk").filter(F.col("support") >= need), "itemsets")
        return [every] if n_found else []
    found, grown, level, size = [], baskets, None, 1
    held = _parts_of(baskets.ranked, need) if baskets.crowded is not None else None
    if held is not None:
        level, n_found = stage_counted(_frequent_pairs(baskets.ranked, held, need), "level-2")
        found, size = ([level] if n_found else []), 2
        # A frequent itemset of three has three frequent pairs.
        if n_found <= size:
            return found
        grown = _cut_down(_lengthen(_held(baskets, level)), _by_prefix(level, size), n_found, wide, size, 1)
    while True:
        size += 1
        longer = _lengthen(grown)
        if level is not None:
            candidates, n_candidates = stage_counted(_candidates(level, size), f"candidates-{size}")
            if not n_candidates:
                return found
            allowed = _by_prefix(candidates, size)
            longer = _cut_down(longer, allowed, n_candidates, wide, size, 1)
        dealt = _Baskets(_dealt(longer.light), None) if size == 2 and longer.crowded is None else longer
        counted = _count_lasts(dealt, size).filter(F.col("support") >= need)
        level, n_found = stage_counted(counted.select("chunk", F.concat("prefix", F.array("last")).alias("numbers"), "support"), f"level-{size}")
        if n_found:
            found.append(level)
        # A larger frequent itemset has size + 1 subsets of this size, all frequent.
        if n_found <= size:
            return found
        grown = longer


def _by_prefix(itemsets: DataFrame, size: int) -> DataFrame:
    return itemsets.selectExpr("chunk", f"slice(numbers, 1, {size - 1}) AS prefix", f"numbers[{size - 1}] AS last")


def _numbered(singles: DataFrame) -> DataFrame:
    """Staged ``(item, support, number)``; numbers rise with the support, then the item."""
    ordered = singles.select("item", "support").orderBy("support", "item")
    return stage(ordered.withColumn("number", F.monotonically_increasing_id()), "items")


def _named(found: DataFrame, singles: DataFrame, measure: str) -> DataFrame:
    """``(items, size, measure)``: item names in place of ``numbers``, in item order."""
    each = found.select("numbers", measure, F.explode("numbers").alias("number"))
    named = (
        each.join(singles.select("number", "item"), "number")
        .groupBy("numbers", measure)
        .agg(F.expr("array_sort(collect_list(item)) AS items"))
    )
    return named.selectExpr("items", "size(numbers) AS size", measure)


def _grouped(rows: DataFrame, singles: DataFrame, crowded: int) -> _Baskets:
    """Baskets of numbered items. Equal light baskets are one row with a weight."""
    return _in_blocks(rows.join(singles.select("item", "number"), "item").select("chunk", "basket", "number"), crowded)


def _in_blocks(ranked: DataFrame, crowded: int) -> _Baskets:
    sizes = ranked.groupBy("chunk", "basket").agg(F.count("*").alias("_items"))
    crowds = stage(sizes.filter(F.col("_items") > crowded).select("chunk", "basket"), "crowds")
    light, blocks = ranked, None
    none = "CAST(array() AS array<bigint>) AS prefix"
    if not crowds.isEmpty():
        ranked = stage(ranked, "ranked")
        light = ranked.join(crowds, ["chunk", "basket"], "left_anti")
        # numbers rise one by one within the upper 31 bits, so a block has ``crowded`` at most
        block = F.col("number") - F.col("number").bitwiseAND(F.lit((1 << 33) - 1)) % F.lit(crowded)
        blocks = (
            ranked.join(crowds, ["chunk", "basket"], "left_semi")
            .groupBy("chunk", "basket", block.alias("block"))
            .agg(F.expr("array_sort(collect_list(number)) AS lasts"))
            .selectExpr("chunk", "basket", "block", none, "lasts", "1L AS weight")
        )
        blocks = stage(spread(blocks, "chunk", "basket", "block"), "blocks-1")
    merged = (
        light.groupBy("chunk", "basket").agg(F.expr("array_sort(collect_list(number)) AS lasts"))
        .filter("size(lasts) > 1")
        .groupBy("chunk", "lasts")
        .agg(F.expr("count(*) AS weight"))
        .selectExpr("chunk", none, "lasts", "weight")
    )
    return _Baskets(stage(spread(merged, "lasts"), "grown-1"), blocks, None if blocks is None else ranked, crowded)


def _held(baskets: _Baskets, itemsets: DataFrame) -> _Baskets:
    """Baskets without the items that are in none of ``itemsets`` ``(chunk, numbers)``."""
    held = itemsets.select("chunk", F.explode("numbers").alias("number")).distinct()
    return _in_blocks(baskets.ranked.join(held, ["chunk", "number"], "left_semi"), baskets.limit)


def _parts_of(ranked: DataFrame, need: Column) -> DataFrame | None:
    """Staged ``(chunk, number, part, baskets)``: the baskets of each item, in as many parts as
    make a frequent pair share groups of ``SHARED_IN_PART`` of one part, two groups where it can, or None where
    baskets have fewer pairs of items than items have such groups of baskets. The parts have a hash of
    their own, as chunks go by that of the basket."""
    needs = ranked.select("chunk", need.alias("need"))
    if (first_row(needs.agg(F.min("need")))[0] or 0) < SHARED_IN_PART:
        return None
    parts = ranked.withColumn("need", need).withColumn("parts", F.expr(PARTS))
    parts = parts.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "basket"), "parts"))
    held = parts.groupBy("chunk", "number", "part").agg(F.sort_array(F.collect_set("basket")).alias("baskets"))
    held = stage(held.filter(F.size("baskets") >= SHARED_IN_PART), "item-baskets")
    sizes = ranked.groupBy("chunk", "basket").agg(F.count("*").cast("double").alias("n"))
    pairs = first_row(sizes.agg(F.sum(F.expr("n * (n - 1) / 2"))))[0] or 0.0
    return held if _groups(held) <= pairs else None


def _groups(held: DataFrame) -> float:
    """How many groups of baskets of one part the items have."""
    n = F.size("baskets").cast("double")
    return first_row(held.agg(F.sum(n * (n - 1) * (n - 2) / 6)))[0] or 0.0


def _shared_groups(held: DataFrame, n_groups: float, rounds: int, turn: int) -> DataFrame:
    """Staged ``(chunk, number_1, number_2, shared)``: pairs of items and how many groups of baskets they
    share, of the groups whose first basket has this turn.

    A group travels as its hash, and those of one item stay where they arrive. Where two hashes are
    equal, ``shared`` is too large, never too small.
    """
    ones = held.select("chunk", "number", "baskets", F.posexplode("baskets").alias("at", "b1"))
    ones = ones.filter(F.pmod(F.xxhash64(F.lit("turn"), "b1"), F.lit(rounds)) == turn)
    ones = ones.selectExpr("chunk", "number", "b1", "slice(baskets, at + 2, size(baskets)) AS baskets")
    twos = ones.select("chunk", "number", "b1", "baskets", F.posexplode("baskets").alias("at", "b2"))
    threes = twos.selectExpr("chunk", "number", "b1", "b2", "explode(slice(baskets, at + 2, size(baskets))) AS b3")
    groups = threes.select("chunk", "number", F.xxhash64("b1", "b2", "b3").alias("group"))
    least = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = groups.repartition(max(least, math.ceil(n_groups / rounds / pairing.PAIRS_A_TASK)), "chunk", "group")
    meet = dealt.withColumn("items", F.count("*").over(Window.partitionBy("chunk", "group")))
    meet = stage(meet.filter("items > 1").select("chunk", "group", "number"), "shared-groups")
    shared = pairs_within(meet, ["chunk", "group"], "number", by_first=True).filter("number_1 < number_2")
    shared = stage(shared.groupBy("chunk", "number_1", "number_2").agg(F.expr("count(*) AS shared")), "shared-pairs")
    discard(meet)
    return shared


def _frequent_pairs(ranked: DataFrame, held: DataFrame, need: Column) -> DataFrame:
    """``(chunk, numbers, support)`` of the pairs that reach the need of their chunk.

    A pair that shares ``need`` baskets shares, whatever the parts they are in, no fewer groups of
    three baskets of one part than if they were dealt evenly. Few pairs share so many
    groups by chance; these are counted over their baskets. Groups are met in as many turns as keep those of
    one turn on disk few.
    """
    n_groups = _groups(held)
    rounds = max(1, math.ceil(n_groups / GROUPS_A_ROUND))
    shared = _shared_groups(held, n_groups, rounds, 0)
    for turn in range(1, rounds):
        shared = shared.unionByName(_shared_groups(held, n_groups, rounds, turn))
    discard(held)
    if rounds > 1:
        shared = shared.groupBy("chunk", "number_1", "number_2").agg(F.sum("shared").alias("shared"))
    shared = shared.withColumn("need", need).withColumn("parts", F.expr(PARTS))
    evenly = F.expr("""
        (parts - need % parts) * ((need div parts) * ((need div parts) - 1) * ((need div parts) - 2) div 6)
        + (need % parts) * (((need div parts) + 1) * (need div parts) * ((need div parts) - 1) div 6)""")
    likely = stage(shared.filter(F.col("shared") >= evenly).select("chunk", "number_1", "number_2"), "likely-pairs")
    for side in (1, 2):
        on = ["chunk", f"number_{side}"] + ["basket"] * (side == 2)
        likely = likely.join(ranked.withColumnRenamed("number", f"number_{side}"), on)
    counted = likely.groupBy("chunk", "number_1", "number_2").agg(F.expr("count(*) AS support"))
    return counted.filter(F.col("support") >= need).select("chunk", F.array("number_1", "number_2").alias("numbers"), "support")


def _lengthen(grown: _Baskets) -> _Baskets:
    """Move each of ``lasts`` to the prefix; what follows it stays to grow by. A crowded basket
    does so for each pair of its blocks."""
    light = (
        grown.light.selectExpr("chunk", "prefix", "lasts", "weight", "posexplode(lasts) AS (at, number)")
        .filter("at + 1 < size(lasts)")
        .selectExpr(
            "chunk",
            "concat(prefix, array(number)) AS prefix",
            "slice(lasts, at + 2, size(lasts)) AS lasts",
            "weight",
        )
    )
    if grown.crowded is None:
        return _Baskets(light, None)
    firsts = grown.crowded.selectExpr("chunk", "basket", "prefix", "block AS first_block", "lasts AS firsts")
    pairs = grown.crowded.join(firsts, ["chunk", "basket", "prefix"]).filter("first_block <= block")
    crowded = pairs.selectExpr("*", "posexplode(firsts) AS (at, number)").selectExpr(
        "chunk",
        "basket",
        "block",
        "concat(prefix, array(number)) AS prefix",
        "IF(first_block = block, slice(lasts, at + 2, size(lasts)), lasts) AS lasts",
        "weight",
    )
    return _Baskets(light, crowded.filter("size(lasts) > 0"))


def _count_lasts(longer: _Baskets, size: int) -> DataFrame:
    """Support of each prefix with each of its ``lasts``. Pairs, by far the most, are counted
    under two plain numbers."""
    prefix = "prefix[0]" if size == 2 else "prefix"
    columns = ["chunk", f"{prefix} AS prefix", "explode(lasts) AS last", "weight"]
    each = longer.light.selectExpr(*columns)
    if longer.crowded is not None:
        each = each.unionByName(longer.crowded.selectExpr(*columns))
    counted = each.groupBy("chunk", "prefix", "last").agg(F.expr("sum(weight) AS support"))
    return counted.withColumn("prefix", F.array("prefix")) if size == 2 else counted


def _dealt(light: DataFrame) -> DataFrame:
    """Rows of one prefix in one task, if they hold more different pairs than a task may hold: else
    counting before the shuffle leaves few rows."""
    each = light.groupBy(F.col("prefix")[0].alias("first")).agg(F.count("*").alias("_rows"), F.sum(F.size("lasts")).alias("_pairs"))
    sums = first_row(each.agg(F.count("*").alias("items"), F.max("_rows").alias("hottest"), F.sum("_pairs").alias("pairs")))
    if (sums["items"] or 0) ** 2 / 2 <= pairing.PAIRS_A_TASK:
        return light
    first = light.withColumn("first", F.col("prefix")[0])
    dealt = dealt_by_first(first, "first", sums["pairs"], sums["hottest"], "lasts")
    return dealt.withColumn("prefix", F.array("first")).drop("first")


def _cut_down(longer: _Baskets, level: DataFrame, n_level: int, wide: int, size: int, least: int = 2) -> _Baskets:
    """Keep of ``lasts`` what makes an itemset of ``level`` with the prefix, and of light rows
    those with ``least`` items left."""
    narrow = n_level <= wide or largest_group(level, "chunk", "prefix") <= wide
    keep = _keep_allowed if narrow else lambda rows, allowed: _keep_wide(rows, allowed, wide)
    light = keep(longer.light, level).filter(f"size(lasts) >= {least}")
    if size % STAGE_EVERY == 0:
        light = stage(spread(light, "prefix", "lasts"), f"grown-{size}")
    if longer.crowded is None:
        return _Baskets(light, None)
    crowded = keep(longer.crowded, level).filter("size(lasts) > 0")
    return _Baskets(light, stage(spread(crowded, "basket", "prefix", "block"), f"blocks-{size}"))


def _keep_allowed(longer: DataFrame, level: DataFrame) -> DataFrame:
    allowed = level.groupBy("chunk", "prefix").agg(F.expr("collect_list(last) AS allowed"))
    return longer.join(allowed, ["chunk", "prefix"]).withColumn(
        "lasts", F.array_intersect("lasts", "allowed")
    ).select(longer.columns)


def _keep_wide(longer: DataFrame, level: DataFrame, wide: int) -> DataFrame:
    """The items a prefix may grow by travel as one array, but for wide prefixes: there the
    ``lasts`` of a row, few by construction, are matched one by one and put together again
    under the row itself."""
    widths = level.groupBy("chunk", "prefix").agg(F.expr("count(*) AS width"))
    prefixes = stage(widths.filter(f"width > {wide}").select("chunk", "prefix"), "wide")
    row = [c for c in longer.columns if c not in ("lasts", "weight")]
    whole = longer.groupBy(*row, "lasts").agg(F.expr("sum(weight) AS weight"))
    one_by_one = (
        whole.join(prefixes, ["chunk", "prefix"], "left_semi")
        .selectExpr(*row, "weight", "lasts AS row", "explode(lasts) AS last")
        .join(level, ["chunk", "prefix", "last"], "left_semi")
        .groupBy(*row, "row", "weight")
        .agg(F.expr("array_sort(collect_list(last)) AS lasts"))
        .select(longer.columns)
    )
    narrow = longer.join(prefixes, ["chunk", "prefix"], "left_anti")
    allowed = level.join(prefixes, ["chunk", "prefix"], "left_anti")
    return _keep_allowed(narrow, allowed).unionByName(one_by_one)


def _recount(mined: _Mined, wide: int) -> DataFrame:
    """Exact ``(numbers, support)`` of the candidates over all baskets.

    Candidates are closed under subsets, so baskets walk down them prefix by prefix.
    """
    wanted, n_wanted = stage_counted(mined.candidates.select("numbers").distinct(), "candidates")
    ones = wanted.filter("size(numbers) = 1").selectExpr("numbers", "numbers[0] AS number")
    found = ones.join(mined.singles, "number").select("numbers", "support")
    baskets = mined.baskets
    if baskets.crowded is not None:
        if mined.deepest == 1:
            return found
        # items that are in no larger candidate are not walked over
        larger = wanted.filter("size(numbers) > 1").select("numbers")
        chunks = baskets.ranked.select("chunk").distinct()
        baskets = _held(baskets, larger.crossJoin(chunks))
    light, crowded = baskets.light, baskets.crowded
    whole = light.drop("chunk").groupBy("prefix", "lasts").agg(F.expr("sum(weight) AS weight"))
    if _short(baskets):
        # one pass for all sizes
        if baskets.few:
            mask = F.expr("aggregate(numbers, 0L, (mask, number) -> mask | shiftleft(1L, CAST(number AS int)))")
            masks = wanted.filter("size(numbers) > 1").select(mask.alias("mask"))
            # written first, or the join would be moved below the count, to every subset of every basket
            counted = _few_subsets(stage(spread(whole, "lasts"), "whole"), 2, mined.deepest)
            counted = stage(counted, "recounted").join(masks, "mask", "left_semi")
            return found.unionByName(counted.select(_mask_numbers(), "support"))
        return found.unionByName(_all_subsets(whole).join(wanted, "numbers", "left_semi"))
    grown = _Baskets(
        whole.withColumn("chunk", F.lit(0)),
        crowded if crowded is None else crowded.withColumn("chunk", F.lit(0)),
    )
    for size in range(2, mined.deepest + 1):
        level = wanted.filter(f"size(numbers) = {size}").selectExpr(
            "0 AS chunk", f"slice(numbers, 1, {size - 1}) AS prefix", f"numbers[{size - 1}] AS last"
        )
        grown = _cut_down(_lengthen(grown), level, n_wanted, wide, size, 1)
        counted = _count_lasts(grown, size).selectExpr("concat(prefix, array(last)) AS numbers", "support")
        found = found.unionByName(counted)
    return found
