"""Connected components of a link table by alternating large-star and small-star steps.

Every round is two grouped shuffles over the links; the link table never grows
and each step is written to the shared folder, so nothing is recomputed after a
lost executor and the driver plans one step at a time.  Minima are combined before the shuffle, and the links of a hub meet its
minimum where they lie (``join_by_key``), so no task gets more than about a thousandth of
all links for one node.  Rounds grow with the logarithm of the component size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import drop_scratch, scratch_mark, written


#: Rows of one key that may always go to one task, and the share of all rows beyond that.
FLOOR, SHARE = 256, 1024


def join_by_key(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row a key and in ``n`` the number of that key's
    rows; ``total`` is the number of all rows.  The result has no ``n``.

    Keys with more than ``max(FLOOR, total / SHARE)`` rows are fewer than ``SHARE``, so they are broadcast and
    their rows stay where they are; all others are shuffled by key.
    """
    limit = max(FLOOR, total // SHARE)
    often = table.filter(F.col("n") > limit)
    here = rows.join(F.broadcast(often.drop("n")), key)
    rest = rows.join(F.broadcast(often.select(key)), key, "left_anti").join(table.filter(F.col("n") <= limit).drop("n"), key)
    return here.unionByName(rest)


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    return join_by_key(both, least, "u", 2 * total).filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them.  a < b throughout."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"), F.count(F.lit(1)).alias("n"))
    moved = join_by_key(edges, least, "b", total).filter("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Links (a, b), a < b -> (node, component): the smallest node of its component.

    Nodes without links are not in the result.  No links: no rows.
    """
    now, spark, first = edges, edges.sparkSession, scratch_mark()
    for k in range(max_rounds):
        total = now.count()
        # Both steps are written: either reads its links several times, and one plan for both would hold the first step as often.
        large = written(_large_star(now, total).distinct(), f"components-large-{k}")
        new = written(_small_star(large, total), f"components-{k}")
        # A fixed point is a set of stars: no node is both a centre and a leaf, and no leaf has two centres.
        tangled = new.groupBy("b").count().filter("count > 1").limit(1).count() or new.select("a").distinct().join(new.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count()
        now = new
        drop_scratch(spark, first, keep=1)  # earlier rounds are not read any more
        if not tangled:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    leaves = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return leaves.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
