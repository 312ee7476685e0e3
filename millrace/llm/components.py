"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written


def _pointed(pairs: DataFrame) -> DataFrame:
    """Pairs as (hi, lo), each once, without loops."""
    return pairs.select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    ).where("hi <> lo").distinct()


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum over them that tells two edge sets apart."""
    mixed = F.xxhash64("hi", "lo").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())


def connected_components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of ``pairs`` (columns a, b of type long).

    ``root`` is the smallest node of the component. Each round joins every
    node's neighbours above it to its smallest neighbour (large star), then its
    neighbours below it to the smallest of them (small star); rounds repeat
    until the edges no longer change, which takes a number of rounds
    logarithmic in the size of the component. Smallest neighbours are
    aggregated before any shuffle and both inputs of each join are written
    tables, so Spark can split a node with very many neighbours. Loops and
    repeated pairs are allowed; pairs with a null are ignored; an empty table
    gives an empty result.
    """
    edges = written(_pointed(pairs.dropna()), "edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        above = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        large = above.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        edges = written(_pointed(large), "edges")
        below = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        least = written(below.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = below.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        star = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        edges = written(_pointed(small.unionByName(star)), "edges")
    nodes = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return nodes.unionByName(roots)


def smallest_reachable(classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, component_id) for every row of ``classes`` (id, first).

    ``component_id`` is the smallest ``first`` of all classes that ``pairs``
    (a, b) link to the class, itself included.
    """
    roots = connected_components(pairs)
    placed = written(
        classes.join(roots, classes["id"] == roots["node"], "left").select(
            "id", F.coalesce("root", "id").alias("root"), "first"
        ),
        "placed",
    )
    smallest = written(placed.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    return placed.join(smallest, "root").select("id", "component_id")
