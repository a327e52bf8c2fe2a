"""Connected components of an edge table by contraction.

Each round labels every node with the least of its neighbours and itself and
replaces both ends of every edge by their labels; edges within a label go.  The
least is taken in an order drawn by a bijection of the ids, so that chains of
rising ids contract as fast as others: edges shrink by a constant factor a
round on average, and groups that are stars or cliques are done in one or two.

A round is one combinable aggregate over both directions, two joins of the
edges with one row per node (which AQE splits where a node has very many
edges), and a distinct of what is left.  Labels and edges are written to the
shared folder, so lineage stays short and a lost executor costs its tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import stage


def mixed(node: Column) -> Column:
    """A bijection of 64-bit ids that leaves no trace of their order: each half
    is masked by a hash of the other."""
    half = F.lit(0xFFFFFFFF)
    low = node.bitwiseAND(half)
    high = F.shiftrightunsigned(node, 32).bitwiseXOR(F.hash(low).cast("long").bitwiseAND(half))
    return F.shiftleft(high, 32).bitwiseOR(low.bitwiseXOR(F.hash(high).cast("long").bitwiseAND(half)))


def components(edges: DataFrame, left: str, right: str, name: str = "components") -> DataFrame:
    """``node, component`` for every node of an edge table (ids of type long)
    that is not itself the least node of its component."""
    ends = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b")
    live = stage(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-edges")
    rounds: list[DataFrame] = []
    while not live.isEmpty():
        first = not rounds  # later rounds' edges are between labels, which are mixed already
        two = [F.struct((mixed(F.col(u)) if first else F.col(u)).alias("u"), (mixed(F.col(v)) if first else F.col(v)).alias("v"), F.col(u).alias("node")) for u, v in ("ab", "ba")]
        labels = live.select(F.explode(F.array(*two)).alias("e")).groupBy("e.node", "e.u").agg(F.min("e.v").alias("v"))
        labels = stage(labels.select("node", "u", F.least("u", "v").alias("label")), f"{name}-labels")
        rounds.append(labels)
        moved = live.join(labels.select(F.col("node").alias("a"), F.col("label").alias("x")), "a").join(labels.select(F.col("node").alias("b"), F.col("label").alias("y")), "b")
        live = stage(moved.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), f"{name}-edges")
    if not rounds:
        return ends.select(F.col("a").alias("node"), F.col("b").alias("component")).where("false")
    found = rounds[0].select("node", "label")
    for labels in rounds[1:]:
        later = labels.select(F.col("node").alias("label"), F.col("label").alias("last"))
        found = found.join(later, "label", "left").select("node", F.coalesce("last", "label").alias("label"))
    found = stage(found, f"{name}-found") if len(rounds) > 1 else found
    # every node has an edge in the first round, so a label's nodes hold the least id of its component
    least = found.groupBy("label").agg(F.min("node").alias("component"))
    return found.join(least, "label").select("node", "component").where("node <> component")
