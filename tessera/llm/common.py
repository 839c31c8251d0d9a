"""Helpers shared by the operators: shared storage, Arrow column functions, name clashes."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import ensure_checkpoint_dir

#: Rows that one Arrow batch carries to a Python worker.  Texts may be long: the batch, not
#: the partition, is what a worker holds at a time.
BATCH_ROWS = 512


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the session's shared checkpoint folder."""
    base = spark.sparkContext.getCheckpointDir() or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: later stages, and the retries after a lost executor,
    start from shared files instead of recomputing the plan.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_files(df: DataFrame) -> None:
    """Delete the files of a ``materialize`` result that no later plan reads."""
    spark = df.sparkSession
    jvm = spark._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns whose names clash (in any case) with ``names``."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def map_text(df: DataFrame, text_col: str, fields: list[T.StructField],
             start: Callable[[], Callable[[list], list]], as_bytes: bool = False) -> DataFrame:
    """Append ``fields``, computed from the text column in Arrow batches.

    ``start()`` runs once in each task and returns a function from a list of
    texts (None for null; UTF-8 bytes with ``as_bytes``) to one list or Arrow
    array per field.  Input
    columns named like a result column are replaced.  Memory is one batch of
    ``BATCH_ROWS`` rows and whatever ``start`` sets up.
    """
    base = without(df, [f.name for f in fields])
    at = base.columns.index(text_col)
    kinds = [to_arrow_type(f.dataType) for f in fields]
    names = base.columns + [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for big in batches:
            for lo in range(0, big.num_rows, BATCH_ROWS):
                batch = big.slice(lo, BATCH_ROWS)
                texts = batch.column(at)
                made = work((texts.cast(pa.binary()) if as_bytes else texts).to_pylist())
                cols = [c if isinstance(c, pa.Array) else pa.array(c, kind)
                        for c, kind in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=names)

    small_batches(df.sparkSession)
    return base.mapInArrow(run, T.StructType([*base.schema.fields, *fields]))


def worker_state(kind: str, key, make: Callable):
    """``make()``, kept for later tasks of this Python worker; one value a kind, for the last key."""
    held = vars(sys).setdefault("_worker_state", {})
    if kind not in held or held[kind][0] != key:
        held[kind] = (key, make())
    return held[kind][1]


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_ROWS`` rows at most, so that long texts fit a worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
