"""Vector code compression: a codebook for each part of the vector, entries found by a GNAT.

Vectors become whole numbers and are cut into equal parts.  Each part has a
codebook of entries that are moved to the mean of the parts nearest to them,
for a fixed number of rounds; a vector's code is the number of the nearest
entry of each part.

The nearest entry is found in a GNAT (Brin, "Near Neighbor Search in Large
Metric Spaces", 1995) over the entries: a node's split points are far apart,
each other entry is below its nearest split point, and every split point
knows the least and greatest distance to the entries below each of them.  A
query's distance to a split point rules out a whole subtree when, by the
triangle inequality, all of it is farther than the best entry so far.  That
is decided strictly and on bounds widened beyond the rounding of the
floating-point roots, so an entry that is as near is never ruled out; entries
are compared by their squared distances in whole numbers, and ties go to the
lower entry.  A task searches for all parts of a batch at once, as arrays.

Scale: a round is one pass over the table without a shuffle but of the sums:
a task sends one row for each part and entry.  The codebooks (parts x entries
x part length) are all that the driver holds.  The table is read rounds + 2
times; nothing but the result is written.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BATCH_ROWS, small_batches, without

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
DEGREE = 4
#: Relative widening of distances: far above the rounding of a root or a sum, far below any real difference.
SLACK = 2.0 ** -45

RESULT = ["code", "error", "label_error", "codebooks_sha256"]


def whole_numbers(vectors: np.ndarray, limit: int) -> np.ndarray:
    """floor(SCALE * x), held to ``limit`` on either side."""
    return np.clip(np.floor(vectors.astype(np.float64) * SCALE), -limit, limit).astype(np.int64)


def limit_of(length: int) -> int:
    """The greatest component for which a squared distance of parts of this length is below 2**62."""
    return math.isqrt((1 << 60) // max(length, 1))


def matrix(column: pa.Array, width: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(rows, vectors) of the lists that are kept: not null, of ``width`` finite numbers."""
    length = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    ok = np.asarray(flat.is_valid()) & np.isfinite(flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64))
    end = np.cumsum(np.maximum(length, 0))
    bad = np.concatenate(([0], np.cumsum(~ok)))
    clean = bad[end] == bad[end - np.maximum(length, 0)]
    rows = np.flatnonzero(clean & (length == width)) if width is not None else np.flatnonzero(clean & (length > 0))
    if not len(rows):
        return rows, np.zeros((0, width or 0))
    if width is None:
        return rows, None
    at = (end[rows] - width)[:, None] + np.arange(width)
    return rows, flat.fill_null(0).to_numpy(zero_copy_only=False)[at]


class Gnat:
    """Entries (int64 rows) as a tree of split points with distance ranges."""

    def __init__(self, entries: np.ndarray, degree: int = DEGREE):
        self.entries = entries
        self.degree = degree
        d2 = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        self.root = self._node(list(range(len(entries))), d2)

    def _node(self, own: list[int], d2: np.ndarray):
        """(split points, low, high, children): low and high are [split point, child] distances."""
        split = own[:1]
        while len(split) < min(self.degree, len(own)):  # the entry farthest from all split points so far
            split.append(max((e for e in own if e not in split), key=lambda e: (min(d2[e, s] for s in split), -e)))
        below: list[list[int]] = [[] for _ in split]
        for e in own:
            if e not in split:
                below[min(range(len(split)), key=lambda k: (d2[e, split[k]], k))].append(e)
        low, high = np.zeros((len(split),) * 2), np.zeros((len(split),) * 2)
        for i, s in enumerate(split):
            for j, t in enumerate(split):
                to = [int(d2[s, e]) for e in [t, *below[j]]]
                low[i, j], high[i, j] = math.sqrt(min(to)) * (1 - SLACK), math.sqrt(max(to)) * (1 + SLACK)
        return split, low, high, [self._node(b, d2) if b else None for b in below]

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row of ``q``; ties go to the lower entry."""
        best = np.full(len(q), np.iinfo(np.int64).max)
        entry = np.full(len(q), len(self.entries))
        self._search(self.root, q, np.arange(len(q)), best, entry)
        return entry, best

    def _search(self, node, q, rows, best, entry) -> None:
        split, low, high, children = node
        alive = np.ones((len(rows), len(split)), bool)
        for i, e in enumerate(split):
            at = np.flatnonzero(alive[:, i])
            if not len(at):
                continue
            r = rows[at]
            d2 = ((q[r] - self.entries[e]) ** 2).sum(axis=1)
            nearer = (d2 < best[r]) | ((d2 == best[r]) & (e < entry[r]))
            best[r[nearer]], entry[r[nearer]] = d2[nearer], e
            root, reach = np.sqrt(d2.astype(np.float64)), np.sqrt(best[r].astype(np.float64)) * (1 + SLACK)
            least = (root * (1 - SLACK))[:, None] - high[i]  # no entry below j is nearer than this ...
            other = low[i] - (root * (1 + SLACK))[:, None]  # ... or than this
            room = SLACK * (root[:, None] + high[i] + reach[:, None])  # rounding of the differences
            alive[at] &= ~(np.maximum(least, other) > reach[:, None] + room)
        for j, child in enumerate(children):
            if child is not None:
                at = np.flatnonzero(alive[:, j])
                if len(at):
                    self._search(child, q, rows[at], best, entry)


def assign(books: np.ndarray, trees: list[Gnat], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries, squared distances), [row, part], of whole-number vectors."""
    parts = x.reshape(len(x), books.shape[0], -1)
    found = [t.nearest(np.ascontiguousarray(parts[:, p])) for p, t in enumerate(trees)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _batches(batches: Iterator[pa.RecordBatch], column: int, width: int) -> Iterator:
    for b in batches:
        for lo in range(0, b.num_rows, BATCH_ROWS * 8):
            piece = b.slice(lo, BATCH_ROWS * 8)
            rows, x = matrix(piece.column(column), width)
            yield piece, rows, x


def _first_books(vectors: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """[part, entry, component]: the parts of the vectors with the least ids; None without a vector that is kept."""
    ids = vectors.schema["id"]

    def widths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict = {}
        for b in batches:
            rows, _ = matrix(b.column(1), None)
            if len(rows):
                kept = b.take(pa.array(rows))
                for key, v in zip(kept.column(0).to_pylist(), kept.column(1).to_pylist()):
                    if len(v) % parts == 0:
                        bound = limit_of(len(v) // parts)
                        numbers = whole_numbers(np.array(v), bound).tolist()
                        if key not in least or numbers < least[key]:
                            least[key] = numbers
                        if len(least) > 4 * entries:
                            least = dict(sorted(least.items(), key=_by_id)[:entries])
        if least:
            first = sorted(least.items(), key=_by_id)[:entries]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in first], b.schema.field(0).type),
                                              pa.array([v for _, v in first], pa.list_(pa.int64()))], names=["id", "v"])

    schema = T.StructType([ids, T.StructField("v", T.ArrayType(T.LongType()))])
    first = (vectors.select("id", "vector").mapInArrow(widths, schema).groupBy("id").agg(F.min("v").alias("v"))
             .orderBy(F.col("id").asc_nulls_last()).limit(entries).collect())  # ``entries`` rows
    if not first:
        return None
    width = len(first[0]["v"])
    rows = [r["v"] for r in first if len(r["v"]) == width]
    return np.array(rows, np.int64).reshape(len(rows), parts, -1).transpose(1, 0, 2).copy()


def _by_id(item) -> tuple:
    return item[0] is None, item[0]


def _round(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """The books with each entry moved to the floor of the mean of its parts; unused entries stay."""
    parts, entries, length = books.shape
    width, limit = parts * length, limit_of(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        sums, n = np.zeros((parts * entries, length), np.int64), np.zeros(parts * entries, np.int64)
        held = 0

        def out():
            used = np.flatnonzero(n)
            made = [pa.array(used, pa.int32()), pa.array(sums[used].tolist(), pa.list_(pa.int64())), pa.array(n[used])]
            return pa.RecordBatch.from_arrays(made, names=["slot", "sums", "n"])

        for _, _, x in _batches(batches, 0, width):
            if not len(x):
                continue
            x = whole_numbers(x, limit)
            entry, _ = assign(books, trees, x)
            for p in range(parts):
                np.add.at(sums, p * entries + entry[:, p], x[:, p * length:(p + 1) * length])
                n += np.bincount(p * entries + entry[:, p], minlength=parts * entries)
            held += len(x)
            if held * limit > 1 << 61:  # the sums of a task fit a long
                yield out()
                sums[:], n[:], held = 0, 0, 0
        if held:
            yield out()

    got = vectors.select("vector").mapInArrow(run, "slot int, sums array<long>, n long")
    total = got.groupBy("slot").agg(F.sum("n").alias("n"), F.array(*[
        F.sum(F.col("sums")[i].cast("decimal(20,0)")) for i in range(length)]).alias("sums"))
    out = books.copy()
    for r in total.collect():  # parts x entries rows
        out[r["slot"] // entries, r["slot"] % entries] = [int(s) // r["n"] for s in r["sums"]]
    return out


def books_text(books: np.ndarray) -> str:
    """All components by part, entry and place, comma-joined."""
    return ",".join(str(x) for x in books.reshape(-1).tolist())


def compress(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``df`` (without its vectors) with code, error, label_error and codebooks_sha256.

    code has two hex digits a part: the entry's number.  error is the sum of
    the squared distances of the parts to their entries, label_error the sum
    of the errors of all rows with an equal label (nulls together).

    Rows are left out whose vector is null or holds a null or a non-finite
    number, and those whose length is not that of the vector with the least
    id among those of a positive multiple of ``parts``.  The first codebooks
    are the parts of the ``entries`` least distinct ids (null last, fewer
    where there are fewer; the least vector of a repeated id).  Repeated rows
    are rows of their own.  Components are held to ``limit_of`` the part's
    length (beyond 90,000 for parts of 8), so that errors fit a long; a sum of
    errors beyond it is held to the greatest long.  An empty table gives no rows.
    Columns named like a result column are replaced.  ``df`` is read rounds +
    2 times: give a table, not a long plan.
    """
    small_batches(df.sparkSession)
    vectors = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").alias("vector"))
    books = _first_books(vectors, parts, entries)
    for _ in range(rounds if books is not None else 0):
        books = _round(vectors, books)
    base = without(df, RESULT)
    kept = [c for c in base.columns if c != vector]
    schema = T.StructType([base.schema[c] for c in kept] + [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if books is None:
        out = df.sparkSession.createDataFrame([], schema)
    else:
        out = base.select(*[F.col(f"`{c}`") for c in [*kept, vector]]).mapInArrow(_coder(books), schema)
    own = F.col(f"`{label}`")
    of_label = out.groupBy(own.alias("_label")).agg(
        F.least(F.sum(F.col("error").cast("decimal(20,0)")), F.lit((1 << 63) - 1).cast("decimal(20,0)")).cast("long").alias("label_error"))
    digest = hashlib.sha256(books_text(books).encode()).hexdigest() if books is not None else None
    return (out.join(of_label, own.eqNullSafe(F.col("_label"))).drop("_label")
            .withColumn("codebooks_sha256", F.lit(digest).cast("string")))


def _coder(books: np.ndarray):
    parts, _, length = books.shape
    width, limit = parts * length, limit_of(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        for b, rows, x in _batches(batches, -1, width):
            if not len(rows):
                continue
            entry, d2 = assign(books, trees, whole_numbers(x, limit))
            text = entry.astype(np.uint8).tobytes().hex()
            code = [text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)]
            # the sum over parts can pass a long only where components are at their limit
            error = d2.sum(axis=1) if float(d2.max()) * parts < 2 ** 62 else [min(sum(r), (1 << 63) - 1) for r in d2.tolist()]
            own = b.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*own.columns[:-1], pa.array(code), pa.array(error, pa.int64())],
                                             names=[*own.schema.names[:-1], "code", "error"])

    return run
