"""Connected components by alternating large and small stars, all in joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from feedweave.session import drop_folder, fresh_dir, stage


def _least(edges: DataFrame, node: str, alias: str) -> DataFrame:
    """The smallest smaller neighbour of each node that has one, for a merge join.

    A side that is broadcast takes two megabytes or more of the driver's memory however few its rows are, and rounds are many.
    """
    return edges.groupBy(F.col("a").alias(node)).agg(F.min("b").alias(alias)).hint("merge")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to its smallest neighbour (itself included); edges are a > b, repeats may come."""
    return edges.join(_least(edges, "b", "m"), "b", "left").select("a", F.coalesce("m", "b").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours and itself to the smallest of them; edges are a > b."""
    # The row of the smallest neighbour becomes the node's own.
    met = edges.join(_least(edges, "a", "m"), "a")
    return met.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()


def components(edges: DataFrame, most_rounds: int = 60, rounds: int | None = None) -> DataFrame:
    """``id, component`` of every node of ``edges`` (a, b): the smallest node that links reach.

    Edges with a null end and loops are left out; repeated edges count once. Nodes without an edge
    are not returned: each is its own component. Every round is written to the shared folder, and what it gives is
    told apart from the round before by sums that the writing itself takes. After ``rounds`` rounds, if given, components
    may still be parts of the final ones, each under one of its nodes. The result is written too: who joins it several
    times plans no more than a read.
    """
    spark = edges.sparkSession
    folder = fresh_dir(spark, "components")
    state = stage(edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
                  .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "0", folder)
    before = None
    for turn in range(1, (most_rounds if rounds is None else rounds) + 1):
        # The same edges twice in a row: every node points at the smallest of its component.
        seen = Observation(f"round-{turn}")
        after = _small_star(_large_star(state)).observe(seen, F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x"))
        state = stage(after, str(turn), folder)
        drop_folder(spark, f"{folder}/{turn - 1}")
        now = seen.get
        if now == before:
            break
        before = now
    else:
        if rounds is None:
            raise RuntimeError(f"components did not settle in {most_rounds} rounds")
        # A node may point at several still: it goes with the smallest.
        state = state.groupBy("a").agg(F.min("b").alias("b"))
    roots = state.select("b").distinct().select(F.col("b").alias("id"), F.col("b").alias("component"))
    if rounds is not None:
        roots = roots.join(state.select(F.col("a").alias("id")), "id", "left_anti")
    whole = stage(state.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots), "whole", folder)
    drop_folder(spark, f"{folder}/{turn}")
    return whole
