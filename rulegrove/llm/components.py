"""Connected components over a table of links, by alternating large and small stars.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Each round groups by one end
of a link and joins the group's minimum back, so no neighbourhood is ever gathered in one task, and
minima are pre-aggregated before the shuffle. Rounds are written to the shared folder, which keeps
the lineage short and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulegrove.llm.common import replaced, written

MAX_ROUNDS = 60


def _with_minimum(edges: DataFrame) -> DataFrame:
    """Directed edges (a, b) with m, the least of a and its neighbours.

    The join's key is ~a, not a: so both of its sides are shuffled for it alone, after the minima
    are known, and adaptive execution can split the edges of a hot node over tasks.
    """
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).select(F.bitwise_not("a").alias("k"), "m")
    return edges.withColumn("k", F.bitwise_not("a")).join(least.hint("merge"), "k").drop("k")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _with_minimum(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    linked = _with_minimum(down)
    ups = linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = linked.select("a", F.col("m").alias("b"))
    return ups.union(own)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link; component is the least node reachable.

    Self-links, repeated links and links with a null end are ignored; an empty table gives an empty
    result. Ends are whole numbers.
    """
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct()
    edges = written(edges)
    mark = None
    for _ in range(MAX_ROUNDS):
        edges = replaced(edges, written(_small_star(_large_star(edges).distinct()).filter("a <> b").distinct()))
        seen = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (seen.n, seen.h) == mark:
            break
        mark = (seen.n, seen.h)
    else:
        raise RuntimeError("components did not converge")
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.union(roots)
