from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from tallyweave.operators import itemsets
from tallyweave.operators import frequent_itemsets, item_levels, son_candidates, son_itemsets


def brute(rows, support, more_than=0):
    """All itemsets of all baskets, counted one by one."""
    baskets = {}
    for basket, item in rows:
        if basket is not None and item is not None:
            baskets.setdefault(basket, set()).add(item)
    counts = Counter()
    for items in baskets.values():
        if len(items) > more_than:
            for size in range(1, len(items) + 1):
                counts.update(combinations(sorted(items), size))
    return sorted((items, len(items), n) for items, n in counts.items() if n >= support)


def random_rows(seed, baskets=60, items=9, most=6):
    rng = random.Random(seed)
    rows = []
    for basket in range(baskets):
        for _ in range(rng.randint(1, most)):
            rows.append((f"b{basket}", f"i{min(rng.randrange(items), rng.randrange(items))}"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "basket string, item string")


@pytest.mark.parametrize("seed,support,more_than", [(1, 3, 0), (2, 5, 3)])
def test_ways_agree_with_brute_force(spark, rows_of, seed, support, more_than):
    rows = random_rows(seed)
    want = brute(rows, support, more_than)
    df = frame(spark, rows)
    assert rows_of(frequent_itemsets(df, "basket", "item", support, more_than)) == want
    tight = frequent_itemsets(df, "basket", "item", support, more_than, crowded=4, wide=2)
    assert rows_of(tight) == want


@pytest.mark.parametrize("seed,chunks,crowded,wide", [(1, 2, 200, 4096), (3, 3, 3, 2)])
def test_two_passes_agree_with_brute_force(spark, rows_of, seed, chunks, crowded, wide):
    rows = random_rows(seed)
    got = son_itemsets(
        frame(spark, rows), "basket", "item", 4, chunks, 1, crowded=crowded, wide=wide
    )
    assert rows_of(got) == brute(rows, 4, 1)


def test_equals_fp_growth(spark, rows_of):
    df = frame(spark, random_rows(7, baskets=200))
    baskets = df.groupBy("basket").agg(F.collect_set("item").alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=(12 - 0.5) / baskets.count()).fit(baskets)
    want = rows_of(model.freqItemsets.select(F.array_sort("items"), F.size("items"), "freq"))
    assert rows_of(frequent_itemsets(df, "basket", "item", 12)) == want


def test_candidates_are_those_of_each_chunk(spark, rows_of):
    rows = [(int(b[1:]), i) for b, i in random_rows(5)]
    df = spark.createDataFrame(rows, "basket int, item string")
    total = len({b for b, _ in rows})
    named = Counter()
    for chunk in range(4):
        part = [(b, i) for b, i in rows if b % 4 == chunk]
        size = len({b for b, _ in part})
        named.update(items for items, _, n in brute(part, 1) if n * total >= 8 * size)
    want = sorted((items, len(items), n) for items, n in named.items())
    chunk = F.pmod("basket", F.lit(4))
    for crowded in (200, 3):
        got = son_candidates(df, "basket", "item", 8, 4, chunk=chunk, crowded=crowded)
        assert rows_of(got) == want


def test_one_crowded_basket_with_a_third_of_all_rows(spark, rows_of):
    rows = [("hot", f"i{n}") for n in range(12)] * 3 + random_rows(11, baskets=40, items=12, most=4)
    want = brute(rows, 3)
    assert rows_of(frequent_itemsets(frame(spark, rows), "basket", "item", 3, crowded=5)) == want


def test_more_crowded_baskets_than_the_support(spark, rows_of):
    rows = [(f"h{b}", f"i{n}") for b in range(6) for n in range(6)] + random_rows(12, baskets=10)
    want = brute(rows, 4)
    assert rows_of(frequent_itemsets(frame(spark, rows), "basket", "item", 4, crowded=3)) == want


def test_boundaries(spark, rows_of):
    rows = [("b1", "x"), ("b1", "x"), ("b1", "y"), ("b2", "x"), ("b2", "y"), ("b3", "x"), ("b3", "z"), ("b3", "w")]
    df = frame(spark, rows)
    # The support itself is kept; a repeated item counts once in a basket.
    assert rows_of(frequent_itemsets(df, "basket", "item", 2)) == [(("x",), 1, 3), (("x", "y"), 2, 2), (("y",), 1, 2)]
    # A basket of exactly the size is dropped.
    assert rows_of(frequent_itemsets(df, "basket", "item", 1, 2)) == brute(rows, 1, 2)
    assert rows_of(frequent_itemsets(df, "basket", "item", 4)) == []
    assert rows_of(son_itemsets(df, "basket", "item", 4, 2)) == []


def test_no_baskets(spark, rows_of):
    df = frame(spark, [("b", "x")]).limit(0)
    assert rows_of(frequent_itemsets(df, "basket", "item", 1)) == []
    assert rows_of(son_candidates(df, "basket", "item", 1, 2)) == []
    assert rows_of(son_itemsets(df, "basket", "item", 1, 2)) == []
    with pytest.raises(ValueError):
        frequent_itemsets(df, "basket", "item", 0)


def test_nulls_are_skipped_and_empty_strings_count(spark, rows_of):
    rows = [("b1", ""), ("b2", ""), (None, "x"), ("b1", None)]
    assert rows_of(frequent_itemsets(frame(spark, rows), "basket", "item", 1)) == [(("",), 1, 2)]


def test_items_are_ordered_as_strings(spark):
    rows = [("b1", "9"), ("b1", "10"), ("b2", "9"), ("b2", "10")]
    found = item_levels(frequent_itemsets(frame(spark, rows), "basket", "item", 2)).collect()
    assert [r["items"] for r in found] == [["10"], ["9"], ["10", "9"]]


def test_every_subset_of_a_frequent_itemset_is_frequent(spark, rows_of):
    found = rows_of(frequent_itemsets(frame(spark, random_rows(21)), "basket", "item", 4))
    supports = {items: n for items, _, n in found}
    for items, n in supports.items():
        for part in combinations(items, len(items) - 1):
            assert not part or supports[part] >= n


@pytest.mark.parametrize("short", [0, 14])
def test_all_subsets_at_once_or_level_by_level(spark, rows_of, monkeypatch, short):
    monkeypatch.setattr(itemsets, "SHORT_BASKET", short)
    monkeypatch.setattr(itemsets, "_mine", counted_calls(itemsets._mine, calls := []))
    rows = [("long", f"i{n}") for n in range(7)] * 2 + random_rows(31, baskets=50, items=7)
    assert rows_of(frequent_itemsets(frame(spark, rows), "basket", "item", 3, 1)) == brute(rows, 3, 1)
    assert rows_of(son_itemsets(frame(spark, rows), "basket", "item", 4, 2, 1)) == brute(rows, 4, 1)
    assert [len(x) == 1 for x in calls] == [short > 0] * 2


def counted_calls(function, calls):
    def call(*args):
        calls.append(function(*args))
        return calls[-1]

    return call


def test_long_baskets_are_not_expanded(spark):
    def baskets(*sizes):
        rows = [(0, [], list(range(n)), 1) for n in sizes]
        light = spark.createDataFrame(rows, "chunk int, prefix array<bigint>, lasts array<bigint>, weight bigint")
        return itemsets._Baskets(light, None)

    assert itemsets._short(baskets(7, 7, 3)) and itemsets._short(baskets())
    assert not itemsets._short(baskets(12, 12)) and not itemsets._short(baskets(15, *[8] * 9999))
    assert not itemsets._short(itemsets._Baskets(baskets(3).light, baskets(3).light))


def test_a_candidate_needs_all_its_subsets(spark, rows_of, monkeypatch):
    """Of {1,2,4}, prefix and last are frequent, but {2,4} is not: it is never counted."""
    level = spark.createDataFrame([(0, [1, 2]), (0, [1, 3]), (0, [1, 4]), (0, [2, 3]), (1, [2, 4])], "chunk int, numbers array<bigint>")
    assert rows_of(itemsets._candidates(level, 3)) == [(0, (1, 2, 3))]
    threes = [[1, 2, 3], [1, 2, 4], [1, 3, 4], [2, 3, 4], [2, 3, 5], [2, 4, 5]]
    level = spark.createDataFrame([(0, x) for x in threes], "chunk int, numbers array<bigint>")
    assert rows_of(itemsets._candidates(level, 4)) == [(0, (1, 2, 3, 4))]
    # the same in a run: only candidates reach the count
    monkeypatch.setattr(itemsets, "SHORT_BASKET", 0)
    monkeypatch.setattr(itemsets, "_count_lasts", counted_calls(itemsets._count_lasts, calls := []))
    rows = [(f"{n}{i}", x) for n, items in enumerate(("abd", "abc", "ab", "ad", "bc", "ac")) for i in range(2) for x in items]
    assert rows_of(frequent_itemsets(frame(spark, rows), "basket", "item", 3)) == brute(rows, 3)
    assert calls[1].count() == 1


def crowded_rows():
    draw = random.Random(11)
    rows = [(b, f"i{draw.randrange(40)}") for b in range(30) for _ in range(12)]
    return rows + [(b, f"i{i}") for b in range(12) for i in (1, 2, 3)]


def test_pairs_of_crowded_baskets_by_shared_groups(spark, rows_of, monkeypatch):
    """Pairs are found by groups of baskets that items share, so pairs of a crowded basket's items are
    not formed; which ones are found does not depend on it."""
    df = spark.createDataFrame(crowded_rows(), "b int, i string")
    monkeypatch.setattr(itemsets, "_lengthen", counted_calls(itemsets._lengthen, calls := []))
    support = 8
    found = rows_of(frequent_itemsets(df, "b", "i", support, crowded=3))
    assert any(size == 3 for _, size, _ in found)
    assert rows_of(son_itemsets(df, "b", "i", support, 2, crowded=3)) == found
    calls.clear()
    # no pair is in 25 baskets: nothing is lengthened
    assert all(size == 1 for _, size, _ in rows_of(frequent_itemsets(df, "b", "i", 25, crowded=3))) and not calls
    monkeypatch.setattr(itemsets, "_parts_of", lambda ranked, need: None)
    assert rows_of(frequent_itemsets(df, "b", "i", support, crowded=3)) == found


def test_parts_of_baskets_do_not_follow_their_chunks(spark):
    """Baskets of one chunk, which go by their hash, lie in all parts."""
    rows = [(basket, number) for basket in range(64) for number in range(4)]
    chunk = F.pmod(F.xxhash64("basket"), F.lit(2)).alias("chunk")
    ranked = spark.createDataFrame(rows, "basket long, number long").select(chunk, "basket", "number")
    need = F.lit(6).cast("bigint")
    held = itemsets._parts_of(ranked.unionByName(wide_baskets(spark)), need).filter("number < 4")
    parts = held.groupBy("chunk", "number").agg(F.count("*").alias("parts"), F.max(F.size("baskets")).alias("most"))
    assert all(row["parts"] == 2 and row["most"] < 32 for row in parts.collect())


def wide_baskets(spark):
    """Baskets of so many items that their pairs are more than any groups of baskets."""
    return spark.range(2_000).selectExpr("0 AS chunk", "-1L AS basket", "100 + id AS number")


def test_groups_of_baskets_are_met_in_turns(spark, rows_of, monkeypatch):
    """However many groups are met at a time, the itemsets are the same."""
    df = spark.createDataFrame(crowded_rows(), "b int, i string")
    found = rows_of(frequent_itemsets(df, "b", "i", 8, crowded=3))
    monkeypatch.setattr(itemsets, "FEW_ITEMS", 0)
    monkeypatch.setattr(itemsets, "GROUPS_A_ROUND", 500)
    monkeypatch.setattr(itemsets, "_shared_groups", counted_calls(itemsets._shared_groups, calls := []))
    assert rows_of(frequent_itemsets(df, "b", "i", 8, crowded=3)) == found
    assert rows_of(son_itemsets(df, "b", "i", 8, 2, crowded=3)) == found
    assert len(calls) > 2


def test_lists_of_pairs_are_dealt_by_prefix(spark, rows_of, monkeypatch):
    df = spark.createDataFrame(crowded_rows(), "b int, i string")
    monkeypatch.setattr(itemsets, "SHORT_BASKET", 0)
    plain = rows_of(frequent_itemsets(df, "b", "i", 8))
    monkeypatch.setattr(itemsets.pairing, "PAIRS_A_TASK", 5)
    monkeypatch.setattr(itemsets, "dealt_by_first", counted_calls(itemsets.dealt_by_first, calls := []))
    assert rows_of(frequent_itemsets(df, "b", "i", 8)) == plain and calls


def long_rows(baskets, items):
    """Baskets of up to 17 of few items, rows repeated, null baskets and items among them."""
    rng = random.Random(5)
    rows = [("long", f"i{n}") for n in range(17)] + [(None, "i1"), ("b0", None), (None, "rare")]
    for basket in range(baskets):
        for _ in range(rng.randint(1, 5)):
            rows += [(f"b{basket}", f"i{min(rng.randrange(items), rng.randrange(items))}")] * rng.randint(1, 2)
    return rows


def test_baskets_of_few_items_are_not_walked_level_by_level(spark, rows_of, monkeypatch):
    def walked(*_):
        raise AssertionError("a level was walked")

    monkeypatch.setattr(itemsets, "_lengthen", walked)
    rows = long_rows(50, 12)
    want = brute(rows, 4)
    assert rows_of(frequent_itemsets(frame(spark, rows), "basket", "item", 4)) == want
    assert rows_of(son_itemsets(frame(spark, rows), "basket", "item", 4, 2)) == want


def test_sizes_of_few_items_are_counted_until_none_is_frequent(spark, rows_of, monkeypatch):
    monkeypatch.setattr(itemsets, "SIZES_AT_ONCE", 2)
    rows = [(f"b{basket}", f"i{n}") for basket in range(4) for n in range(7 - basket % 2)]
    for support in (2, 3, 5):
        assert rows_of(frequent_itemsets(frame(spark, rows), "basket", "item", support, 1)) == brute(rows, support, 1)


@pytest.mark.parametrize("most", [0, 17, 62])
def test_few_and_many_items_agree(spark, rows_of, monkeypatch, most):
    monkeypatch.setattr(itemsets, "SHORT_BASKET", 2)
    monkeypatch.setattr(itemsets, "FEW_ITEMS", most)
    rows = long_rows(40, 9) + [("wide", f"w{n}") for n in range(45)]
    small = [row for row in rows if row[0] != "long"]
    # no item of the wide basket is frequent
    want = brute([row for row in small if row[0] != "wide"], 3, 1)
    got = frequent_itemsets(frame(spark, small), "basket", "item", 3, 1, crowded=3, wide=2)
    assert rows_of(got) == want
    assert rows_of(son_itemsets(frame(spark, small), "basket", "item", 3, 2, 1, crowded=3, wide=2)) == want
