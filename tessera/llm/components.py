"""Connected components of an edge list, as rounds of joins and aggregates.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): each round links every node's
larger neighbours to the smallest node it knows.  The edge list never leaves
the executors; each round is written to the shared folder, and a node with
very many neighbours is one key of a join that adaptive execution can split
(both sides are read from files, so each has its own exchange).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import delete_files, materialize


def _mins(edges: DataFrame, by: str, value: str) -> DataFrame:
    """(node, least): the smallest ``value`` of each ``by``, from files (map-side combined)."""
    found = edges.groupBy(F.col(by).alias("node")).agg(F.min(value).alias("least"))
    return materialize(found, "components-min")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("hi", "lo").union(edges.select("lo", "hi")).toDF("u", "v")
    mins = _mins(both, "u", "v").withColumn("least", F.least("node", "least"))
    out = (edges.join(mins, edges.lo == mins.node)
           .select("hi", F.col("least").alias("lo")).distinct())
    done = materialize(out, "components-large")
    delete_files(mins)
    return done


def _small_star(edges: DataFrame) -> DataFrame:
    mins = _mins(edges, "hi", "lo")
    moved = (edges.join(mins, edges.hi == mins.node).where("lo <> least")
             .select(F.col("lo").alias("hi"), F.col("least").alias("lo")))
    out = moved.union(mins.select("node", "least")).distinct()
    done = materialize(out, "components-small")
    delete_files(mins)
    return done


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo")),
                           F.bit_xor(F.xxhash64("lo", "hi"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an undirected edge list; root is the smallest node reachable.

    Edges with a null end and loops are ignored (a node that only has those
    is not in the result).  Repeated and reversed edges count once.  The
    rounds end when one changes nothing; their number grows with the
    logarithm of the longest path, not with the rows.
    """
    now = materialize(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
                      .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                      .distinct(), "components-edges")
    seen = _signature(now)
    while seen[0]:
        mid = _large_star(now)
        new = _small_star(mid)
        delete_files(mid)
        delete_files(now)
        last, seen, now = seen, _signature(new), new
        if seen == last:
            break
    roots = now.select(F.col("lo").alias("node")).distinct()
    return (now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
            .union(roots.select("node", F.col("node").alias("root"))))
