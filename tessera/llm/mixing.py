"""Mixing sources to target weights by weighted fair queueing.

Each source has a weight; the sources share the budget (all sizes together)
by weight.  A source is used three times over at most, so a target stops at
``repeats`` times the source's size and what it leaves goes to the others, by
weight, until none is above.

Documents are shuffled within their source by a seeded hash and queued up to
``repeats`` times, one round of the source after the other.  A copy's virtual
finish time is its source's cumulative size up to its own end divided by the
source's target: sources are served side by side, each at the rate of its
target, and time 1 is when all of them reach it.  The copies are sorted by
finish time over all sources and cut at the budget.  The one document that a
source is being served at time 1 is cut there, its rest queued as a piece of
its own; otherwise a very long document would keep its source a whole
document off the target.

Scale: sums by source are combined map-side; all running sums (of a source's
documents, of the sources, of the queue) are those of ``running_sums``, over
sorted ranges of the whole table, so a source with a third of all rows is
spread like any other.  Sizes are whole numbers; the queue has ``repeats``
narrow rows a document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, without
from .prefix import running_sums

WEIGHTS = (5, 2, 1)
REPEATS = 3
SEED = 42

RESULT = ["source_size", "target", "taken"]


def words(text: str) -> Column:
    """Number of words of a text, split at ASCII white space (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, number, begin, target) from (source, source_size).

    Sources are numbered by code point, null last, and take the weights in
    turn.  With the sources that are full first in line, full ones being
    those with the least limit (``repeats`` times the size) by weight, the
    level that the others share is the greatest, over all numbers k of full
    sources, of what k full sources leave divided by the weight of the rest.
    """
    spark = sizes.sparkSession
    one = sizes.withColumns({"_one": F.lit(1), "_null": F.col("source").isNull()})
    numbered = running_sums(one, ["_null", "source"], {"number": "_one", "end": "source_size"}, "mix-sources")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.col("number") - 1) % len(weights) + 1).cast("int"))
    limited = numbered.select("source", "source_size", "number", (F.col("end") - F.col("source_size")).alias("begin"),
                              weight.alias("weight"), (F.col("source_size") * repeats).alias("limit"))
    limited = limited.withColumn("_full_at", F.col("limit") / F.col("weight"))
    line = running_sums(limited, ["_full_at", "number"], {"limits": "limit", "weights": "weight"}, "mix-line")
    total, weight_sum = sizes.agg(F.sum("source_size")).first()[0] or 0, limited.agg(F.sum("weight")).first()[0] or 0
    left = F.lit(int(total)) - (F.col("limits") - F.col("limit"))
    level = line.agg(F.max(left / (F.lit(int(weight_sum)) - (F.col("weights") - F.col("weight"))))).first()[0] or 0.0
    return limited.select("source", "source_size", "number", "begin",
                          F.least(F.col("limit").cast("double"), F.lit(float(level)) * F.col("weight")).alias("target"))


def mix(df: DataFrame, key: str = "doc_id", source: str = "source", size: str = "size", weights: Sequence[int] = WEIGHTS,
        repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """``df`` with source_size, target (its source's) and taken: how much of each row the mix takes, repeats counted.

    Null sizes count 0; rows with a null source are one source.  Sources
    without any size have target 0.  Rows of one source with equal key and
    size hash alike and stand together; repeated rows are rows of their own.
    ``taken`` sums up to the budget, less the fractions of the targets.  The
    same table gives the same mix in any order and partitioning.  An empty
    table gives no rows.  Columns named like a result column are replaced.
    """
    base = without(df, RESULT)
    own = base.columns
    rows = base.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)],
                       F.col(f"`{source}`").alias("source"), F.coalesce(F.col(f"`{size}`"), F.lit(0)).cast("long").alias("size"),
                       F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(f"`{key}`").cast("string"))).alias("shuffle"), F.col(f"`{key}`").alias("key"))
    sizes = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    of_source = targets(sizes, weights, repeats).withColumnRenamed("source", "_source")
    joined = rows.join(of_source, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "source")
    queued = running_sums(joined, ["number", "shuffle", "key", "size"], {"end": "size"}, "mix-queued")
    rows = materialize(queued.withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    taken = _take(rows, repeats)
    return (rows.join(taken, "row").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(own)],
                                           "source_size", "target", "taken"))


def _take(rows: DataFrame, repeats: int) -> DataFrame:
    """(row, taken) of the queue over all sources, cut at the budget."""
    stop = F.floor("target").cast("long")
    copies = rows.select("row", "number", "target", "size", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("round"),
                         "source_size", "begin", "end")
    end = F.col("round") * F.col("source_size") + F.col("end") - F.col("begin")
    copies = copies.select("row", "number", "target", "size", end.alias("stop"), (end - F.col("size")).alias("start"))
    # the document in service when its source reaches its target is two pieces
    cut = (F.col("start") < stop) & (stop < F.col("stop"))
    whole = F.array(F.struct("size", "stop"))
    pieces = F.array(F.struct((stop - F.col("start")).alias("size"), stop.alias("stop")),
                     F.struct((F.col("stop") - stop).alias("size"), F.col("stop").alias("stop")))
    queue = (copies.select("row", "number", "target", F.explode(F.when(cut, pieces).otherwise(whole)).alias("p"))
             .where("p.size > 0")
             .select("row", "number", F.col("p.size").alias("size"), F.col("p.stop").alias("stop"),
                     (F.col("p.stop") / F.col("target")).alias("finish")))
    served = running_sums(queue, ["finish", "number", "stop"], {"so_far": "size"}, "mix-queue")
    budget = rows.agg(F.sum("size")).first()[0] or 0
    fits = F.greatest(F.least(F.col("size"), F.lit(int(budget)) - (F.col("so_far") - F.col("size"))), F.lit(0))
    got = served.groupBy("row").agg(F.sum(fits).alias("taken"))
    return rows.select("row").join(got, "row", "left").select("row", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
