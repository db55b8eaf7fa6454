from __future__ import annotations

import math
import random
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tallyweave.operators import item_model, mean_ratings, predict_ratings
from tallyweave.operators import recommend


def plain_means(rows):
    seen = defaultdict(list)
    for user, item, rating in rows:
        if None not in (user, item, rating) and not math.isnan(rating):
            seen[user, item].append(rating)
    return {key: sum(own) / len(own) for key, own in seen.items()}


def plain_model(means, least):
    by_user = defaultdict(dict)
    for (user, item), rating in means.items():
        by_user[user][item] = rating
    pairs = defaultdict(list)
    for own in by_user.values():
        for a, b in combinations(sorted(own), 2):
            pairs[a, b].append((own[a], own[b]))
    out = {}
    for pair, both in pairs.items():
        n, (xs, ys) = len(both), zip(*both)
        if n >= least:
            mx, my = sum(xs) / n, sum(ys) / n
            vx, vy = sum((x - mx) ** 2 for x in xs), sum((y - my) ** 2 for y in ys)
            if vx > 1e-9 and vy > 1e-9:
                out[pair] = (n, sum((x - mx) * (y - my) for x, y in both) / math.sqrt(vx * vy))
    return out


def drawn(seed, users=25, items=12, most=9):
    draw = random.Random(seed)
    return [(f"u{u}", f"i{draw.randrange(items)}", float(draw.randint(1, 5))) for u in range(users) for _ in range(draw.randint(1, most))]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "who string, what string, stars double")
    return df.select("*", *(F.lit(7).alias(x) for x in ("user", "item", "rating", "n", "weight")))


ROWS = drawn(1) + [(None, "i1", 1.0), ("u1", None, 1.0), ("u1", "i1", None), ("u2", "i2", float("nan"))]
HOT = [(u, f"i{n}", float((7 * n + len(u)) % 5)) for u in ("hot", "warmer", "third") for n in range(12)]


def check_model(spark, rows, least, **more):
    found = item_model(frame(spark, rows), "who", "what", "stars", least, **more).collect()
    expected = plain_model(plain_means(rows), least)
    assert {(r["item_1"], r["item_2"]): r["co_raters"] for r in found} == {k: n for k, (n, _) in expected.items()}
    assert all(abs(r["weight"] - expected[r["item_1"], r["item_2"]][1]) < 1e-8 for r in found)
    return len(found)


@pytest.mark.parametrize("least", [2, 3, 5])
@pytest.mark.parametrize("heavy", [2_000, 8, 0])
def test_model(spark, least, heavy):
    assert check_model(spark, ROWS + HOT, least, heavy=heavy)


def test_heavy_raters_are_not_expanded(spark, monkeypatch):
    rows, expanded = drawn(3, users=10, most=4) + HOT, []
    plain = recommend.pairs_within

    def counted(*args, **kwargs):
        pairs = plain(*args, **kwargs)
        expanded.append(pairs.count())
        return pairs

    monkeypatch.setattr(recommend, "pairs_within", counted)
    check_model(spark, rows, 4, heavy=5)
    check_model(spark, rows, 4)
    # the three heavy raters have 66 pairs each
    assert expanded[1] - expanded[0] == 3 * 66


def test_nothing(spark):
    empty = frame(spark, ROWS).limit(0)
    model = item_model(empty, "who", "what", "stars", 3)
    assert model.count() == 0
    assert predict_ratings(mean_ratings(empty, "who", "what", "stars"), mean_ratings(empty, "who", "what", "stars"), model).count() == 0
    with pytest.raises(ValueError):
        item_model(empty, "who", "what", "stars", 1)


def plain_prediction(means, model, user, item, n):
    weights = {}
    for (a, b), (_, weight) in model.items():
        if item in (a, b) and weight > 1e-9:
            weights[b if a == item else a] = round(weight, 9)
    near = sorted((-w, other) for other, w in weights.items() if (user, other) in means)[:n]
    if near:
        return len(near), sum(-w * means[user, other] for w, other in near) / sum(-w for w, _ in near)
    own = [r for (_, i), r in means.items() if i == item] or list(means.values())
    return 0, sum(own) / len(own)


def test_predictions_and_fallbacks(spark):
    means = plain_means(ROWS)
    model = plain_model(means, 3)
    wanted = [(u, i) for u in ("u1", "u2", "u3", "new") for i in ("i0", "i1", "i5", "unheard")] * 2 + [(None, "i1"), ("u1", None)]
    ratings = mean_ratings(frame(spark, ROWS), "who", "what", "stars")
    found = predict_ratings(spark.createDataFrame(wanted, "user string, item string"), ratings, item_model(frame(spark, ROWS), "who", "what", "stars", 3), 2)
    got = {(r["user"], r["item"]): (r["neighbours"], r["prediction"]) for r in found.collect()}
    assert len(got) == 16 == found.count()
    for (user, item), (count, value) in got.items():
        expected = plain_prediction(means, model, user, item, 2)
        assert count == expected[0] and abs(value - expected[1]) < 1e-6


def test_neighbours_are_cut_before_the_shuffle(spark):
    ratings = mean_ratings(frame(spark, ROWS), "who", "what", "stars")
    plan = predict_ratings(ratings, ratings, item_model(frame(spark, ROWS), "who", "what", "stars", 3))
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_ties_go_to_the_smaller_item(spark):
    model = spark.createDataFrame([("a", "x", 3, 0.5), ("b", "x", 3, 0.5), ("c", "x", 3, 0.5)], "item_1 string, item_2 string, co_raters long, weight double")
    ratings = spark.createDataFrame([("u", "a", 1.0), ("u", "b", 2.0), ("u", "c", 9.0)], "user string, item string, rating double")
    wanted = spark.createDataFrame([("u", "x")], "user string, item string")
    assert predict_ratings(wanted, ratings, model, 2).first()["prediction"] == 1.5


def test_ratings_travel_as_lists(spark):
    """Pairs are made in the task of their first item, so that no pair is shuffled."""
    plan = item_model(frame(spark, ROWS + HOT), "who", "what", "stars", 3)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Exchange" not in plan[: plan.index("Generate")]
