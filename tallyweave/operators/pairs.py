"""Pairs of rows that share a group key, with hot groups split over many tasks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import first_row, stage

# Rows of one group that one join cell may hold on each side.
CELL_ROWS = 2000
# Pairs that one task may hold apart when they come together by their first id.
PAIRS_A_TASK = 1_500_000
# Rows of an id above which its pairs are dealt over several tasks.
HOT_ID = 100_000


def largest_group(rows: DataFrame, *group: str) -> int:
    """Row count of the largest group: one scalar, counted before the shuffle."""
    sizes = rows.groupBy(*group).agg(F.count("*").alias("_rows"))
    return first_row(sizes.agg(F.max("_rows")))[0] or 0


def lists_within(
    rows: DataFrame, group: Sequence[str], id_col: str, carry: Sequence[str] = (), cell_rows: int = CELL_ROWS, largest: int | None = None, written: bool = False
) -> DataFrame:
    """``(group, {id}_1, {carry}_1, {id}_2, {carry}_2)``: what ``pairs_within`` returns, with the second
    sides of a row in arrays. A pair is 8 bytes an id or carried number here, before compression. ``written`` groups are staged, for lists that are
    read several times."""
    columns = [id_col, *carry]
    if largest is None:
        largest = largest_group(rows, *group)
    each = F.array_sort(F.collect_list(F.struct(*columns))).alias("_all")

    def listed(held: DataFrame) -> DataFrame:
        grouped = held.groupBy(*group).agg(each)
        grouped = stage(grouped, "groups") if written else grouped
        whole = grouped.select(*group, "_all", F.posexplode("_all").alias("_at", "_row"))
        return whole.filter(F.col("_at") + 1 < F.size("_all")).select(
            *group,
            *(F.col(f"_row.{c}").alias(f"{c}_1") for c in columns),
            *(F.slice(F.col(f"_all.{c}"), F.col("_at") + 2, F.size("_all")).alias(f"{c}_2") for c in columns),
        )

    if largest <= cell_rows:
        return listed(rows)
    parts = F.ceil(F.count("*") / cell_rows).cast("int").alias("_parts")
    hot = rows.groupBy(*group).agg(parts).filter(F.col("_parts") > 1)
    placed = rows.join(hot, list(group)).withColumn("_part", F.pmod(F.xxhash64(id_col), "_parts").cast("int"))
    cells = placed.groupBy(*group, "_part").agg(each)
    # every row meets all parts of its group and keeps the ids above its own
    left = placed.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).join(cells, [*group, "_part"])
    above = left.withColumn("_all", F.filter("_all", lambda other: other[id_col] > F.col(id_col))).filter("size(_all) > 0")
    heavy = above.select(
        *group,
        *(F.col(c).alias(f"{c}_1") for c in columns),
        *(F.col(f"_all.{c}").alias(f"{c}_2") for c in columns),
    )
    return listed(rows.join(hot, list(group), "left_anti")).unionByName(heavy)


def dealt_by_first(lists: DataFrame, first: str, n_pairs: int, hottest: int, *salt: str) -> DataFrame:
    """Lists that begin with the same id, in the same task; an aggregation by the id and what is
    listed needs no further shuffle. Of an id in very many rows they lie in several tasks, and
    the aggregation adds them up. The number of tasks follows from that of the pairs."""
    least = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, -(-n_pairs // PAIRS_A_TASK))
    if hottest <= HOT_ID:
        return lists.repartition(tasks, first)
    return lists.repartition(tasks, F.col(first), F.pmod(F.xxhash64(*salt), F.lit(-(-hottest // HOT_ID))))


def pairs_by_first(
    rows: DataFrame,
    group: Sequence[str],
    id_col: str,
    carry: Sequence[str] = (),
    keep: Callable[[Sequence[Column], Sequence[Column]], Column] | None = None,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """The pairs of ``pairs_within``, for an aggregation by ``{id}_1`` and ``{id}_2``: rows travel as
    lists to the task of their first id, and pairs are made there."""
    return pairs_in_turns(rows, group, id_col, carry, keep, cell_rows)[0]


def pairs_in_turns(
    rows: DataFrame,
    group: Sequence[str],
    id_col: str,
    carry: Sequence[str] = (),
    keep: Callable[[Sequence[Column], Sequence[Column]], Column] | None = None,
    cell_rows: int = CELL_ROWS,
    pairs_a_turn: int | None = None,
) -> list[DataFrame]:
    """``pairs_by_first`` in tables of about ``pairs_a_turn`` pairs, before ``keep``: each has all pairs of some first
    ids, so that only the lists of one turn are on disk where one is worked off after the other."""
    sizes = rows.groupBy(*group).agg(F.count("*").alias("_rows"))
    sums = first_row(sizes.agg(F.max("_rows").alias("largest"), F.sum(F.expr("_rows * (_rows - 1) / 2")).cast("bigint").alias("pairs")))
    n_pairs = sums["pairs"] or 0
    turns = max(1, -(-n_pairs // max(1, pairs_a_turn))) if pairs_a_turn is not None else 1
    lists = lists_within(rows, group, id_col, carry, cell_rows, sums["largest"] or 0, turns > 1)
    hottest = largest_group(rows, id_col)
    turn = F.pmod(F.xxhash64(F.lit("turn"), f"{id_col}_1"), F.lit(turns))
    some = [lists.filter(turn == i) for i in range(turns)] if turns > 1 else [lists]
    return [_listed_pairs(dealt_by_first(x, f"{id_col}_1", -(-n_pairs // turns), hottest, *group), group, id_col, carry, keep) for x in some]


def _listed_pairs(
    lists: DataFrame,
    group: Sequence[str],
    id_col: str,
    carry: Sequence[str],
    keep: Callable[[Sequence[Column], Sequence[Column]], Column] | None,
) -> DataFrame:
    """The pairs of ``lists_within``, where the lists are."""
    columns = [id_col, *carry]
    at = F.posexplode(f"{id_col}_2").alias("_at", "_id")
    pairs = lists.select(*group, *(f"{c}_1" for c in columns), *(F.col(f"{c}_2").alias(f"_{c}_all") for c in carry), at).select(
        *group,
        *(f"{c}_1" for c in columns),
        F.col("_id").alias(f"{id_col}_2"),
        *(F.get(f"_{c}_all", "_at").alias(f"{c}_2") for c in carry),
    )
    if keep is not None:
        pairs = pairs.filter(keep(*([F.col(f"{c}_{side}") for c in carry] for side in (1, 2))))
    return pairs


def pairs_within(
    rows: DataFrame,
    group: Sequence[str],
    id_col: str,
    carry: Sequence[str] = (),
    keep: Callable[[Sequence[Column], Sequence[Column]], Column] | None = None,
    cell_rows: int = CELL_ROWS,
    largest: int | None = None,
    by_first: bool = False,
) -> DataFrame:
    """Each unordered pair of ids that share a group, once per shared group.

    ``rows`` holds an id at most once per group. The result has ``{id}_1 < {id}_2`` and
    the ``carry`` columns of both sides. ``keep`` is a symmetric test on the carried
    columns, evaluated inside the join.

    A group of more than ``cell_rows`` rows is cut into parts, and each pair of its parts is
    a join key of its own: no task sees more than about ``cell_rows`` rows of a group on a
    side. ``largest`` is the row count of the largest group, where the caller knows it.
    With ``by_first`` all pairs of an ``{id}_1`` are made in one task, for an aggregation by
    both ids.
    """
    if by_first:
        return pairs_by_first(rows, group, id_col, carry, keep, cell_rows)
    columns = [id_col, *carry]
    if largest is None:
        largest = largest_group(rows, *group)

    def plain(held: DataFrame) -> DataFrame:
        left = held.select(*group, *(F.col(c).alias(f"{c}_1") for c in columns))
        right = held.select(*group, *(F.col(c).alias(f"{c}_2") for c in columns))
        ordered = F.col(f"{id_col}_1") < F.col(f"{id_col}_2")
        joined = left.join(right, list(group)).filter(ordered)
        if keep is not None:
            joined = joined.filter(
                keep([F.col(f"{c}_1") for c in carry], [F.col(f"{c}_2") for c in carry])
            )
        return joined.select(*group, *(f"{c}_{side}" for side in (1, 2) for c in columns))

    if largest <= cell_rows:
        return plain(rows)

    hot = (
        rows.groupBy(*group)
        .agg(F.ceil(F.count("*") / cell_rows).cast("int").alias("_parts"))
        .filter(F.col("_parts") > 1)
    )
    placed = rows.join(hot, list(group)).select(
        *group,
        *columns,
        F.pmod(F.xxhash64(id_col), "_parts").cast("int").alias("_part"),
        "_parts",
    )
    left = placed.select(
        *group,
        F.col("_part").alias("_i"),
        F.explode(F.sequence("_part", F.col("_parts") - 1)).alias("_j"),
        *(F.col(c).alias(f"_l_{c}") for c in columns),
    )
    right = placed.select(
        *group,
        F.explode(F.sequence(F.lit(0), "_part")).alias("_i"),
        F.col("_part").alias("_j"),
        *(F.col(c).alias(f"_r_{c}") for c in columns),
    )
    rising = F.col(f"_l_{id_col}") < F.col(f"_r_{id_col}")
    joined = left.join(right, [*group, "_i", "_j"]).filter((F.col("_i") < F.col("_j")) | rising)
    if keep is not None:
        joined = joined.filter(
            keep([F.col(f"_l_{c}") for c in carry], [F.col(f"_r_{c}") for c in carry])
        )
    heavy = joined.select(
        *group,
        *(F.when(rising, F.col(f"_l_{c}")).otherwise(F.col(f"_r_{c}")).alias(f"{c}_1") for c in columns),
        *(F.when(rising, F.col(f"_r_{c}")).otherwise(F.col(f"_l_{c}")).alias(f"{c}_2") for c in columns),
    )
    return plain(rows.join(hot, list(group), "left_anti")).unionByName(heavy)
