from __future__ import annotations

import os
import random
import time
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tallyweave import staging
from tallyweave.functions import HASH_PRIME, draw_hash_params
from tallyweave.operators import pairs, similarity
from tallyweave.operators import (
    lsh_buckets,
    minhash_signatures,
    pairs_within,
    similar_pairs,
    similar_pairs_lsh,
)


def sets_of(rows):
    sets = {}
    for key, member in rows:
        if key is not None and member is not None:
            sets.setdefault(key, set()).add(member)
    return sets


def brute(rows, threshold):
    found = []
    for (k1, s1), (k2, s2) in combinations(sorted(sets_of(rows).items()), 2):
        sim = len(s1 & s2) / len(s1 | s2)
        if sim >= threshold:
            found.append((k1, k2, sim))
    return found


def brute_lsh(rows, threshold, n_bands, n_rows, seed):
    params = draw_hash_params(n_bands * n_rows, seed)
    signed = {
        k: [min((p.a * m + p.b) % HASH_PRIME for m in s) for p in params]
        for k, s in sets_of(rows).items()
    }

    def meet(k1, k2):
        return any(
            signed[k1][i * n_rows : (i + 1) * n_rows] == signed[k2][i * n_rows : (i + 1) * n_rows]
            for i in range(n_bands)
        )

    return [p for p in brute(rows, threshold) if meet(p[0], p[1])]


def random_rows(seed, keys=30, members=40, most=12):
    """Popular low members, a few equal sets, repeated rows."""
    rng = random.Random(seed)
    rows = []
    for key in range(keys):
        for _ in range(rng.randint(1, most)):
            rows.append((f"k{key}", min(rng.randrange(members), rng.randrange(members))))
    for copy in range(5):
        rows += [(f"copy{copy}", m) for m in (1, 2, 3, 17)]
    return rows + rows[:20]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, m int")


TIGHT = dict(hot_member=4, cell_rows=3, chunk_members=2)


@pytest.mark.parametrize("seed,threshold", [(1, 0.1), (2, 0.3), (3, 0.75)])
def test_exact_pairs(spark, rows_of, seed, threshold):
    rows = random_rows(seed)
    want = brute(rows, threshold)
    assert want
    assert rows_of(similar_pairs(frame(spark, rows), "k", "m", threshold)) == want
    assert rows_of(similar_pairs(frame(spark, rows), "k", "m", threshold, **TIGHT)) == want


@pytest.mark.parametrize("seed,threshold,bands,band_rows", [(1, 0.1, 10, 2), (2, 0.3, 20, 1), (3, 0.5, 6, 3)])
def test_lsh_pairs(spark, rows_of, seed, threshold, bands, band_rows):
    rows = random_rows(seed)
    want = brute_lsh(rows, threshold, bands, band_rows, seed)
    assert want
    df = frame(spark, rows)
    assert rows_of(similar_pairs_lsh(df, "k", "m", threshold, bands, band_rows, seed)) == want
    tight = similar_pairs_lsh(df, "k", "m", threshold, bands, band_rows, seed, hot_bucket=2, **TIGHT)
    assert rows_of(tight) == want


def test_threshold_itself_is_kept(spark, rows_of):
    rows = [("a", 1), ("b", 1)] + [("b", m) for m in range(2, 11)]
    assert rows_of(similar_pairs(frame(spark, rows), "k", "m", 0.1)) == [("a", "b", 0.1)]
    assert rows_of(similar_pairs(frame(spark, rows), "k", "m", 0.1, hot_member=1)) == [("a", "b", 0.1)]
    assert rows_of(similar_pairs(frame(spark, rows), "k", "m", 0.11)) == []


def test_equal_sets_and_bad_threshold(spark, rows_of):
    rows = [(f"c{i}", m) for i in range(7) for m in (1, 2)] + [("d", 1), ("n", None), (None, 1)]
    want = brute(rows, 0.5)
    assert ("c0", "c6", 1.0) in want and ("c0", "d", 0.5) in want
    for cell_rows in (2, 100):
        assert rows_of(similar_pairs(frame(spark, rows), "k", "m", 0.5, cell_rows=cell_rows)) == want
        assert rows_of(
            similar_pairs_lsh(frame(spark, rows), "k", "m", 1.0, 5, 2, cell_rows=cell_rows)
        ) == brute(rows, 1.0)
    for threshold in (0, 1.5):
        with pytest.raises(ValueError):
            similar_pairs(frame(spark, rows), "k", "m", threshold)


def test_one_key_with_a_third_of_all_rows(spark, rows_of):
    rows = random_rows(5) + [("big", m) for m in range(120)] + [("nearly", m) for m in range(3, 120)]
    want = brute(rows, 0.2)
    assert ("big", "nearly", 117 / 120) in want
    assert rows_of(similar_pairs(frame(spark, rows), "k", "m", 0.2, **TIGHT)) == want


def test_one_member_in_every_set(spark, rows_of):
    rows = random_rows(6) + [(f"k{k}", 999) for k in range(30)]
    want = brute(rows, 0.4)
    assert rows_of(similar_pairs(frame(spark, rows), "k", "m", 0.4, **TIGHT)) == want


def test_no_rows(spark, rows_of):
    df = frame(spark, [("a", 1)]).limit(0)
    assert rows_of(similar_pairs(df, "k", "m", 0.5)) == []
    assert rows_of(similar_pairs_lsh(df, "k", "m", 0.5)) == []


def test_lsh_recall_and_seed(spark, rows_of):
    rows = random_rows(9, keys=60)
    df = frame(spark, rows)
    exact = set(rows_of(similar_pairs(df, "k", "m", 0.3)))
    first = rows_of(similar_pairs_lsh(df, "k", "m", 0.3, seed=1))
    assert first == rows_of(similar_pairs_lsh(df, "k", "m", 0.3, seed=1))
    assert set(first) <= exact
    expected = sum(1 - (1 - sim**2) ** 50 for _, _, sim in exact)
    assert len(first) >= 0.95 * expected


def test_signatures_of_text_members(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "x"), ("b", "y"), ("b", "x")], "k string, m string")
    signed = {r["key"]: r["signature"] for r in minhash_signatures(df, "k", "m", 8, seed=3).collect()}
    assert signed["a"] == signed["b"] and len(signed["a"]) == 8
    assert all(0 <= v < HASH_PRIME for v in signed["a"])


def test_buckets_with_one_set_are_left_out(spark, rows_of):
    df = frame(spark, [("a", 1), ("b", 1), ("c", 2)])
    buckets = lsh_buckets(df, "k", "m", 3, 2, seed=1).collect()
    assert [(r["band"], r["sets"]) for r in sorted(buckets)] == [(0, 2), (1, 2), (2, 2)]


@pytest.mark.parametrize("cell_rows", [1, 3, 1000])
def test_pairs_within(spark, rows_of, cell_rows):
    rows = [("g", i, i % 5) for i in range(23)] + [("h", i, i) for i in (3, 1)] + [("single", 1, 1)]
    df = spark.createDataFrame(rows, "g string, id int, w int")
    want = sorted(
        (g, a, wa, b, wb)
        for (g, a, wa), (h, b, wb) in combinations(sorted(rows), 2)
        if g == h and abs(wa - wb) <= 2
    )
    got = pairs_within(df, ["g"], "id", ["w"], lambda l, r: F.abs(l[0] - r[0]) <= 2, cell_rows)
    assert got.columns == ["g", "id_1", "w_1", "id_2", "w_2"]
    assert rows_of(got) == want


@pytest.mark.parametrize("hot_id", [100_000, 5])
@pytest.mark.parametrize("cell_rows", [2_000, 3])
def test_pairs_by_first(spark, rows_of, monkeypatch, cell_rows, hot_id):
    monkeypatch.setattr(pairs, "HOT_ID", hot_id)
    rows = frame(spark, random_rows(4)).distinct().withColumn("n", F.length("k"))
    plain = pairs_within(rows, ["m"], "k", ["n"], cell_rows=cell_rows)
    by_first = pairs_within(rows, ["m"], "k", ["n"], cell_rows=cell_rows, by_first=True)
    assert by_first.columns == plain.columns
    assert rows_of(by_first) == rows_of(plain) != []
    counts = [p.groupBy("k_1", "k_2").count() for p in (by_first, plain)]
    assert rows_of(counts[0]) == rows_of(counts[1])


def exchanges_above_pairs(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan
    return plan[: plan.index("Generate")].count("Exchange")


def test_pairs_are_not_shuffled(spark):
    rows = frame(spark, random_rows(4)).distinct()
    counted = pairs_within(rows, ["m"], "k", by_first=True).groupBy("k_1", "k_2").count()
    assert exchanges_above_pairs(counted) == 0


@pytest.mark.parametrize("cell_rows", [2_000, 3])
def test_pairs_of_some_firsts_at_a_time(spark, rows_of, monkeypatch, cell_rows):
    """Turns hold each pair once, and all pairs of a first id in one of them."""
    rows = random_rows(4)
    members = frame(spark, rows).distinct()
    plain = rows_of(pairs_within(members, ["m"], "k", cell_rows=cell_rows))
    turns = [rows_of(turn) for turn in pairs.pairs_in_turns(members, ["m"], "k", cell_rows=cell_rows, pairs_a_turn=len(plain) // 4)]
    assert len(turns) > 3 and sorted(row for turn in turns for row in turn) == plain
    assert sum(len({row[1] for row in turn}) for turn in turns) == len({row[1] for row in plain})
    want = rows_of(similar_pairs(frame(spark, rows), "k", "m", 0.2))
    monkeypatch.setattr(similarity, "PAIRS_A_TURN", len(plain) // 3)
    assert rows_of(similar_pairs(frame(spark, rows), "k", "m", 0.2)) == want != []


def test_tasks_follow_the_number_of_pairs(spark, monkeypatch):
    monkeypatch.setattr(pairs, "PAIRS_A_TASK", 10)
    rows = frame(spark, [(f"k{k}", m) for k in range(10) for m in range(4)])
    assert pairs_within(rows, ["m"], "k", by_first=True).rdd.getNumPartitions() == 18


def test_lsh_overlap_counted_over_shared_members(spark, rows_of, monkeypatch):
    """Of long sets with few common members, only the common ones are counted, unless the
    candidates hold fewer; the pairs are the same."""
    rows = random_rows(7)
    want = brute_lsh(rows, 0.3, 20, 1, 7)
    for few in (True, False):
        monkeypatch.setattr(similarity, "_fewer_shared", lambda sized, n: few)
        compared = []
        plain = similarity._count_overlap
        monkeypatch.setattr(similarity, "_count_overlap", lambda *args: compared.append(1) or plain(*args))
        assert rows_of(similar_pairs_lsh(frame(spark, rows), "k", "m", 0.3, 20, 1, 7)) == want
        assert bool(compared) != few
        monkeypatch.setattr(similarity, "_count_overlap", plain)
    monkeypatch.undo()
    long = frame(spark, [(f"k{k}", m) for k in range(5) for m in [0, *range(100 * k + 1, 100 * k + 50)]])
    sized = long.toDF("key", "member")
    assert similarity._fewer_shared(sized, 10) and not similarity._fewer_shared(sized, 0)


def test_equal_sets_meet_nothing_else(spark, rows_of, monkeypatch):
    """At threshold 1 sets that are not equal are never compared, however many bands they share."""
    compared = []
    plain = similarity._count_overlap
    monkeypatch.setattr(similarity, "_count_overlap", lambda *args: compared.append(1) or plain(*args))
    rows = [(f"k{k}", m) for k in range(8) for m in [*range(40), 100 + k]] + [("copy", m) for m in [*range(40), 100]]
    found = similar_pairs_lsh(frame(spark, rows), "k", "m", 1.0, 4, 1, 3)
    assert rows_of(found) == [("copy", "k0", 1.0)] and not compared


def _near_copies(seed, n_sets, sizes, common):
    """Sets of rare and very common members, some of them a changed copy of an earlier one."""
    rng, sets = random.Random(seed), {}
    for key in range(n_sets):
        size = rng.choice(sizes)
        if sets and rng.random() < 0.4:
            members = list(sets[rng.choice(list(sets))])
            members = members[: max(1, int(len(members) * rng.uniform(0.45, 1)))] + [f"{key}-{i}" for i in range(rng.randrange(1 + len(members) // 3))]
        else:
            members = [f"c{rng.randrange(common)}" for _ in range(size // 2)] + [f"{key}-{i}" for i in range(size // 2)]
        sets[key] = set(members)
    return sets


@pytest.mark.parametrize(("seed", "threshold", "part"), [(1, 0.5, 8), (2, 0.3, 16), (3, 0.9, 4), (4, 0.5, 96), (5, 1.0, 8)])
def test_candidates_by_parts(spark, rows_of, monkeypatch, seed, threshold, part):
    monkeypatch.setattr(similarity, "PART_MEMBERS", part)
    sets = _near_copies(seed, 60, [2, 10, 40, 150], 60)
    rows = [(key, member) for key, members in sets.items() for member in members]
    df = spark.createDataFrame(rows, "k long, m string")
    wanted = [(a, b, len(sets[a] & sets[b]) / len(sets[a] | sets[b])) for a in sets for b in sets if a < b]
    wanted = sorted(x for x in wanted if x[2] >= threshold)
    assert rows_of(similar_pairs(df, "k", "m", threshold, hot_member=3, cell_rows=7, chunk_members=16)) == wanted


def test_members_are_compared_in_turns(spark, rows_of, monkeypatch):
    """However many members are compared at a time, the pairs are the same; tables that are read no more
    are deleted."""
    sets = _near_copies(7, 60, [2, 10, 40], 30)
    sets[60] = sets[3]
    df = spark.createDataFrame([(key, member) for key, members in sets.items() for member in members], "k long, m string")
    plain = rows_of(similar_pairs(df, "k", "m", 0.4, hot_member=3, cell_rows=7))
    monkeypatch.setattr(similarity, "ROWS_A_ROUND", 100)
    staged = []
    monkeypatch.setattr(similarity, "stage", lambda df, name, plain=similarity.stage: staged.append((name, plain(df, name))) or staged[-1][1])
    assert rows_of(similar_pairs(df, "k", "m", 0.4, hot_member=3, cell_rows=7)) == plain != []
    assert sum(name == "alike" for name, _ in staged) > 2
    folders = {name: table.inputFiles()[0].rpartition("/")[0].removeprefix("file://") for name, table in staged}
    assert {name for name, folder in folders.items() if not os.path.exists(folder)} >= {"member-rows", "members", "numbers", "set-parts"}


def test_a_written_table_leaves_no_shuffle_files(spark):
    def shuffle_files():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        names = (file.getName() for file in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllFiles()))
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffle_files()
    rows = spark.range(1000).repartition(3, "id")
    assert len(staging.stage(rows, "rows").collect()) == 1000
    assert staging.first_row(rows.groupBy((F.col("id") % 7).alias("k")).count().agg(F.max("count")))[0] == 143
    deadline = time.time() + 20
    while shuffle_files() - before and time.time() < deadline:
        time.sleep(0.1)
    left = {name for name in shuffle_files() - before if name.endswith(".data")}
    assert not left


def test_sets_of_common_members_are_no_candidates(spark):
    """Random sets of common members meet very often; hardly a pair of them leaves its task."""
    rng = random.Random(6)
    sets = [{rng.randrange(400) for _ in range(130)} for _ in range(200)]
    rows = [(key, member, len(members)) for key, members in enumerate(sets) for member in members]
    sized, n_rows = similarity._numbered(spark.createDataFrame(rows, "key long, member long, n long"))
    meet = sum(1 for a in range(200) for b in range(a) if sets[a] & sets[b])
    assert similarity._alike_in_part(sized, n_rows, 0.5, 2000).count() < meet / 20
