"""Connected components of a graph that is given by its edges.

Each round maps every node to the neighbour, itself included, with the smallest hash drawn for
the round, and replaces the edges by those between the images. A drawn order shrinks chains
as well as stars, so rounds grow with the logarithm of the number of nodes. A node with very
many neighbours is one key of an aggregation with partial sums and of joins that Spark splits;
nothing but a row count reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage_counted
from .tables import written


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node, root`` for every node of an edge, self-edges included: nodes have the same root
    if and only if they are connected. The root is a node of the component, no particular one.

    Rows with a null end are passed over; repeated edges count once. Without edges, no rows.
    """
    kind = edges.schema[left].dataType
    pairs = edges.select(F.col(left).alias("a"), F.col(right).cast(kind).alias("b"))
    pairs = pairs.where("a is not null and b is not null").distinct()
    maps = []
    current, left_over = stage_counted(pairs, "edges")
    while left_over:
        order = F.struct(F.xxhash64(F.lit(len(maps)), "to"), "to")
        ends = F.explode(F.array(*(F.struct(F.col(x).alias("node"), F.col(y).alias("to")) for x in "ab" for y in "ab")))
        near = current.select(ends.alias("end")).select("end.*")
        image = written(near.groupBy("node").agg(F.min_by("to", order).alias("image")), "images")
        maps.append(image)
        a, b = (image.select(F.col("node").alias(x), F.col("image").alias(f"{x}_image")) for x in "ab")
        moved = current.where("a <> b").join(a, "a").join(b, "b")
        moved = moved.select(F.least("a_image", "b_image").alias("a"), F.greatest("a_image", "b_image").alias("b"))
        current, left_over = stage_counted(moved.where("a <> b").distinct(), "edges")
    if not maps:
        return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = maps[0].select("node", F.col("image").alias("root"))
    for image in maps[1:]:
        # nodes that no edge is left for stay as they are
        step = image.select(F.col("node").alias("root"), F.col("image").alias("next"))
        roots = roots.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return written(roots, "roots")
