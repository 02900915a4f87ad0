"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import drop_stored, store


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of the undirected edges ``(a, b)``.

    The component is the smallest node that the edges reach. Edges with a null end are
    ignored; a loop makes its node a component. Rows may repeat and the table may be empty.

    Alternating star contraction: the large star points every larger neighbour of a node at
    the smallest node around, the small star does the same among the smaller ones. Each half
    is one minimum per node (merged in the tasks before the shuffle, so a hub costs one row
    a task) and one equi-join (split by Spark where a hub makes it uneven). The edge list
    never outgrows the input, a round's list is stored in the shared folder, and only its
    row count and a checksum reach the driver.
    """
    ends = edges.select("a", "b").where("a is not null and b is not null")
    nodes = ends.select(F.col("a").alias("node")).union(ends.select("b")).distinct()
    links = store(
        ends.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    mark = _mark(links)
    while mark[0]:
        new = store(_small_star(_large_star(links)), "links")
        new_mark = _mark(new)
        drop_stored(links)
        links, done = new, new_mark == mark
        mark = new_mark
        if done:
            break
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("component")
    )


def _mark(links: DataFrame) -> tuple:
    """Row count and order-free checksum."""
    return tuple(
        links.agg(
            F.count("*"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
            F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")),
        ).first()
    )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select("b", "a"))
    least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    least = least.select("n", F.least("n", "m").alias("m"))
    return (
        both.where("b > a").join(least, F.col("a") == F.col("n"))
        .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` lead from larger to smaller nodes."""
    least = links.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    moved = (
        links.join(least, F.col("a") == F.col("n")).where("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )
    return moved.union(least).distinct()
