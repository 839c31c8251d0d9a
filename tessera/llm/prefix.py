"""Running sums over a whole table in a total order, without a task that holds a group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize


def running_sums(df: DataFrame, order: Sequence[str | Column], sums: dict[str, str], name: str) -> DataFrame:
    """``df`` with a long column for each of ``sums`` ({new: column}): its sum over this row and all before it.

    Rows are range-sorted by ``order`` (make it total, or its ties are summed
    in any order), so a key that holds much of the table is spread over the
    ranges by the keys after it.  Each range is summed as a stream of batches;
    the sums of the ranges, one row each, are added up and joined back.  Null
    values count 0.  The rows are written once, in the shared folder.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = df.withColumns({new: F.coalesce(F.col(c).cast("long"), F.lit(0)) for new, c in sums.items()})
    sorted_ = values.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id())
    at = [sorted_.columns.index(new) for new in sums]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = [0] * len(at)
        for b in batches:
            if not b.num_rows:
                continue
            cols = list(b.columns)
            for k, i in enumerate(at):
                total = np.cumsum(cols[i].to_numpy()) + before[k]
                before[k] = int(total[-1])
                cols[i] = pa.array(total, pa.int64())
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in sorted_.schema.fields])
    done = materialize(sorted_.mapInArrow(run, schema), name)
    ends = sorted(done.groupBy("_range").agg(*[F.max(new).alias(new) for new in sums]).collect())  # one row a range
    begins, so_far = [], [0] * len(sums)
    for r in ends:
        begins.append((r["_range"], *so_far))
        so_far = [x + y for x, y in zip(so_far, r[1:])]
    schema = T.StructType([T.StructField("_range", T.IntegerType()), *[T.StructField(f"_{c}", T.LongType()) for c in sums]])
    out = done.join(F.broadcast(spark.createDataFrame(begins, schema)), "_range")
    return out.withColumns({c: F.col(c) + F.col(f"_{c}") for c in sums}).drop("_range", *[f"_{c}" for c in sums])


