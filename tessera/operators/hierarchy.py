"""Hierarchy walk: every node's path up to its root, by path doubling.

Round k knows each node's ancestor 2**k levels up; joined with itself that is
the ancestor 2**(k+1) levels up.  A tree of depth d takes log2(d) + 1 rounds
of one join of a row a node, however deep it is, and no row carries the nodes
it has visited: a node that has an ancestor further up than there are nodes is
on a cycle or below one.  The pairs (node, ancestor) are put together from the
same jumps, each pair once; the caller joins the finished paths to its fact
rows instead of walking per fact row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def jumps(parents: DataFrame, n_nodes: int) -> list[DataFrame]:
    """[(node, up)]: for k = 0, 1, ... each node's ancestor 2**k levels up, until no node has one.

    ``parents`` is (node, up) of the direct parents.  Each round is kept in
    the checkpoint folder.  A cycle raises a ValueError that names a node.
    """
    out: list[DataFrame] = []
    now = parents.checkpoint()
    while (some := now.first()) is not None:
        if 2 ** len(out) > n_nodes:
            raise ValueError(f"cycle in the hierarchy at or above {some['node']}")
        out.append(now)
        further = now.select(F.col("node").alias("up"), F.col("up").alias("_up"))
        now = now.join(further, "up").select("node", F.col("_up").alias("up")).checkpoint()
    return out


def walk_to_root(spark: SparkSession, nodes: DataFrame, id_col: str = "category_id",
                 parent_col: str = "parent_id", name_col: str = "display_name") -> DataFrame:
    """(node_id, ancestor_id, ancestor_name, depth) for every node and each ancestor.

    depth 0 is the node itself, depth 1 its parent, and so on up to the root
    (a node with NULL or unknown parent).  A cycle raises before any pair is
    made.  Repeated rows count once, a node without an id has no path.
    """
    ensure_checkpoint_dir(spark)
    own = nodes.select(F.col(id_col).alias("node"), F.col(parent_col).alias("up"), F.col(name_col).alias("name"))
    own = own.filter(F.col("node").isNotNull()).distinct().checkpoint()
    known = own.select(F.col("node").alias("up")).distinct()
    steps = jumps(own.select("node", "up").distinct().join(known, "up", "left_semi").select("node", "up"), own.count())
    walk = known.select(F.col("up").alias("node_id"), F.col("up").alias("ancestor_id"), F.lit(0).alias("depth"))
    for k, step in enumerate(steps):
        if k > 1:  # each round reads the walk twice: cut the plan before it doubles further
            walk = walk.checkpoint()
        above = step.join(walk, F.col("up") == F.col("node_id")).select(
            F.col("node").alias("node_id"), "ancestor_id", (F.col("depth") + 2 ** k).alias("depth"))
        walk = walk.unionByName(above)
    named = own.select(F.col("node").alias("ancestor_id"), F.col("name").alias("ancestor_name"))
    return walk.join(named, "ancestor_id").select("node_id", "ancestor_id", "ancestor_name", "depth")
