"""Connected components (A9, A10) by hooking of trees and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathweave.session import cut, forget


def components(edges: DataFrame) -> DataFrame:
    """(node, component = smallest node) of undirected edges (a, b: long).

    Every node points to a parent, at first its smallest neighbour. A round takes for each node the
    least grandparent among its neighbours; the node takes it as its parent, and so does the node's
    old parent, so whole trees hook onto smaller ones. Then pointers jump. Rounds grow as the
    logarithm of the number of nodes, chains in any order included: the last round is that in which
    no grandparent changes. Rounds are tables in the checkpoint folder, and only a flag comes to the
    driver. A hub's edges are aggregated before each shuffle; what joins them has one row a node, so
    Spark can split a hub's partition.

    A node whose only edges are loops is its own component; a null end makes no edge.
    """
    known = edges.where("a is not null and b is not null")
    both = cut(known.select("a", "b").union(known.select("b", "a")).distinct())
    first = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("up"))
    trees = jumped(first.select("node", "up", F.lit(None).cast("bigint").alias("old")))
    while trees.where("not (top <=> old)").limit(1).count():
        near = both.join(trees.select(F.col("node").alias("b"), "top"), "b").groupBy(F.col("a").alias("node")).agg(F.min("top").alias("near"))
        own = cut(trees.select("node", "up", "top").join(near, "node"))
        hook = own.groupBy(F.col("up").alias("node")).agg(F.min("near").alias("hook"))
        new = own.join(hook, "node", "left").select("node", F.least("top", "near", "hook").alias("up"), F.col("top").alias("old"))
        done, trees = trees, jumped(new)
        forget(done, own)
    forget(both)
    out = trees.select("node", F.col("top").alias("component"))
    out.cut_path = trees.cut_path
    return out


def jumped(trees: DataFrame) -> DataFrame:
    """(node, up, old) plus top, the parent's parent."""
    # roots point to themselves: only the others' parents are looked up
    inner = trees.where("node <> up").select(F.col("node").alias("up"), F.col("up").alias("above"))
    return cut(trees.join(inner, "up", "left").select("node", "up", "old", F.coalesce("above", "up").alias("top")))


def same_component(labels: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (source, target) plus connected: both known and of one component.

    A node without edges is its own component.
    """
    own = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"__{c}"))
    found = pairs.join(own("source"), "source", "left").join(own("target"), "target", "left")
    same = F.coalesce("__source", "source") == F.coalesce("__target", "target")
    return found.select("source", "target", F.coalesce(same, F.lit(False)).alias("connected"))
