"""SimHash near-dedup: segment-popcount embedding, grid range-join, exact verification.

1. Each text gets a 64-bit fingerprint: a bit is 1 when it is set in more than
   half of the XXH64 values of the text's word shingles.
2. Equal fingerprints are one row from here on (counted before any shuffle of
   documents), so copies never meet in pairs.
3. A fingerprint is embedded as the bit counts of its 32 two-bit segments.  A
   count is kept as its thermometer code (``sorted_bits``: the ones of a
   segment moved to its low end), so the Manhattan distance of two embeddings
   is the bit count of one XOR.  It never exceeds the bit distance.
4. Grid range-join: the segments form ``BLOCKS`` blocks.  Within Manhattan
   distance d at most d blocks differ, so two such embeddings agree on
   ``BLOCKS - d`` whole blocks: every choice of that many blocks is a
   projection of the grid, and a fingerprint goes to one cell in each.
5. Inside a cell, candidates within the Manhattan bound are verified by their
   exact bit distance.  A cell gives a spanning forest of its links instead
   of its pairs.  Cells beyond ``cell_rows`` fingerprints are cut into chunks,
   and each pair of chunks is a cell of its own: exact, and bounded in memory.
6. Connected components of the forests (``components``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_text, materialize
from .components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
BLOCKS = 8
CELL_ROWS = 8192
_EVEN = 0x5555555555555555


def fingerprint(text: str | None, words_each: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of one text (0 for a text without words or a null)."""
    return int(_fingerprints([text and text.encode()], words_each)[0])


def _fingerprints(texts: list, words_each: int) -> np.ndarray:
    """Fingerprints of UTF-8 texts (bytes or None)."""
    out = np.zeros(len(texts), np.uint64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = text.lower().split() if text else ()  # both know ASCII only
        n = len(words)
        if not n:
            continue
        if n <= words_each:
            out[i] = digest(b" ".join(words), SEED)
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[:n - words_each + 1].tolist(), ends[words_each - 1:].tolist())
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64,
                        n - words_each + 1)
        ones = np.zeros(64, np.int64)
        for lo in range(0, len(h), 8192):
            ones += np.unpackbits(h[lo:lo + 8192].view(np.uint8).reshape(-1, 8), axis=1,
                                  bitorder="little").sum(axis=0, dtype=np.int64)
        out[i] = weights[2 * ones > len(h)].sum(dtype=np.uint64)
    return out


def with_fingerprint(df: DataFrame, text_col: str = "text", out_col: str = "fp",
                     words_each: int = SHINGLE_WORDS) -> DataFrame:
    """Append the fingerprint of each whole text as a signed long (same 64 bits)."""
    def start():
        return lambda texts: [pa.array(_fingerprints(texts, words_each).view(np.int64))]

    return map_text(df, text_col, [T.StructField(out_col, T.LongType())], start, as_bytes=True)


def sorted_bits(fp):
    """Thermometer code of a fingerprint's two-bit segment counts (ints or uint64 arrays)."""
    any_bit, both = (fp | (fp >> 1)) & _EVEN, fp & (fp >> 1) & _EVEN
    return any_bit | (both << 1)


def _masks(max_bits: int) -> list[int]:
    """One mask for each choice of ``BLOCKS - max_bits`` blocks."""
    width = 64 // BLOCKS
    one = (1 << width) - 1
    return [sum(one << (width * b) for b in chosen)
            for chosen in combinations(range(BLOCKS), BLOCKS - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(fps: np.ndarray, split: int, max_bits: int) -> Iterator[tuple[int, int]]:
    """Spanning forest of the links among ``fps`` (all pairs, or only across ``split``).

    Breadth-first: a fingerprint that is reached leaves the pool, so a dense
    cell costs about one pass and a sparse one n*n/2 XORs.
    """
    codes = sorted_bits(fps)
    left = np.zeros(len(fps), bool)
    left[:split] = True
    pool = np.arange(len(fps))
    while len(pool):
        queue, pool = [pool[0]], pool[1:]
        while queue and len(pool):
            x = queue.pop()
            near = np.bitwise_count(codes[pool] ^ codes[x]) <= max_bits  # Manhattan bound
            if split:
                near &= left[pool] != left[x]
            hit = np.flatnonzero(near)
            hit = hit[np.bitwise_count(fps[pool[hit]] ^ fps[x]) <= max_bits]  # exact
            if len(hit):
                queue.extend(pool[hit].tolist())
                for y in pool[hit]:
                    yield int(x), int(y)
                pool = np.delete(pool, hit)


def _cell_links(max_bits: int):
    """mapInArrow function over rows sorted by (cell, chunk pair, side): links of each cell."""
    def links(part, keys) -> list:
        cell, pair, side, fp = part
        edges = []
        same = np.flatnonzero(keys[1:] == keys[:-1])
        if not len(same):
            return edges
        bounds = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
        sizes = np.diff(bounds)
        two = bounds[:-1][(sizes == 2)]
        if len(two):  # most cells: one pair, all at once
            a, b = fp[two], fp[two + 1]
            ok = np.bitwise_count(sorted_bits(a) ^ sorted_bits(b)) <= max_bits
            ok &= np.bitwise_count(a ^ b) <= max_bits
            ok &= (pair[two] <= 0) | (side[two] != side[two + 1])
            edges += zip(a[ok].view(np.int64).tolist(), b[ok].view(np.int64).tolist())
        for k in np.flatnonzero(sizes > 2):
            lo, hi = bounds[k], bounds[k + 1]
            own = fp[lo:hi]
            across = pair[lo] > 0
            split = int((side[lo:hi] == 0).sum()) if across else 0
            if across and split in (0, hi - lo):
                continue  # a pair of chunks of which one is empty
            for x, y in _forest(own, split, max_bits):
                edges.append((int(own[x].view(np.int64)), int(own[y].view(np.int64))))
        return edges

    def batch(edges) -> pa.RecordBatch:
        a, b = zip(*edges)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                          names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        kinds = np.dtype([("m", "i8"), ("k", "i8"), ("p", "i8")])
        for rb in batches:
            cols = [rb.column(c).to_numpy(zero_copy_only=False) for c in
                    ("mask_no", "cell", "pair", "side", "fp")]
            cols[4] = cols[4].view(np.uint64)
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            keys = np.empty(len(cols[0]), kinds)
            keys["m"], keys["k"], keys["p"] = cols[0], cols[1], cols[2]
            last = len(keys) - int(np.argmax((keys != keys[-1])[::-1])) if (keys != keys[-1]).any() else 0
            if last:  # the last cell may go on in the next batch
                if edges := links([c[:last] for c in cols[1:]], keys[:last]):
                    yield batch(edges)
            held = [c[last:] for c in cols]
        if held is not None and len(held[0]):
            keys = np.empty(len(held[0]), kinds)
            keys["m"], keys["k"], keys["p"] = held[0], held[1], held[2]
            if edges := links(held[1:], keys):
                yield batch(edges)

    return run


def link_forest(fps: DataFrame, max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b): links at ``max_bits`` or fewer differing bits that connect what any links connect.

    ``fps`` has distinct fingerprints in ``fp``.  The number of rows in a
    cell decides only how it is cut into chunks, never what is compared.
    """
    code = ((F.col("fp").bitwiseOR(F.shiftrightunsigned("fp", 1))).bitwiseAND(F.lit(_EVEN))
            .bitwiseOR(F.shiftleft(F.col("fp").bitwiseAND(F.shiftrightunsigned("fp", 1))
                                   .bitwiseAND(F.lit(_EVEN)), 1)))
    masks = F.array(*[F.lit(_signed(m)) for m in _masks(max_bits)])
    # each fingerprint becomes a row a mask: deal them to all tasks first, they may come from a few files
    dealt = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    cells = (dealt.select("fp", code.alias("code"), F.posexplode(masks).alias("mask_no", "mask"))
             .select(F.col("mask_no").cast("long"),
                     F.col("code").bitwiseAND(F.col("mask")).alias("cell"), "fp"))
    big = materialize(cells.groupBy("mask_no", "cell").count()
                      .where(F.col("count") > cell_rows)
                      .withColumn("chunks", F.ceil(F.col("count") / (cell_rows // 2)))
                      .drop("count"), "simhash-cells")
    if not big.isEmpty():
        # A chunk's rows go to each of its pairs: (i, j) with i < j, and (i, i) for its own.
        chunk = F.pmod(F.xxhash64("fp"), F.col("chunks"))
        sides = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.struct(
            (F.least(chunk, j) * F.col("chunks") + F.greatest(chunk, j) + 1).alias("n"),
            F.when(chunk == j, F.lit(0)).otherwise(F.lit(1)).alias("across"),
            F.when(chunk > j, F.lit(1)).otherwise(F.lit(0)).alias("side")))
        cells = (cells.join(big, ["mask_no", "cell"], "left")
                 .withColumn("to", F.explode(F.when(F.col("chunks").isNull(), F.array(F.struct(
                     F.lit(0).cast("long").alias("n"), F.lit(0).alias("across"),
                     F.lit(0).alias("side")))).otherwise(sides)))
                 # the sign of pair tells pairs of two chunks (> 0) from whole chunks (<= 0)
                 .select("mask_no", "cell", "fp", F.col("to.side").cast("long").alias("side"),
                         F.when(F.col("to.across") == 1, F.col("to.n"))
                         .otherwise(-F.col("to.n")).alias("pair")))
    else:
        cells = cells.select("mask_no", "cell", "fp", F.lit(0).cast("long").alias("side"),
                             F.lit(0).cast("long").alias("pair"))
    ordered = (cells.repartition("mask_no", "cell", "pair")
               .sortWithinPartitions("mask_no", "cell", "pair", "side"))
    return ordered.mapInArrow(_cell_links(max_bits), "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words_each: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    cell_rows: int = CELL_ROWS) -> tuple[DataFrame, DataFrame]:
    """Fingerprint rows and the component of each distinct fingerprint.

    Returns ``rows`` (id, fp), one for each input row, and ``groups``
    (fp, root, component_id): root is the component's smallest signed
    fingerprint, component_id the smallest id of any row in the component.

    Null and empty texts, and texts without words, have fingerprint 0 and
    link like any other.  A text of fewer words than a shingle is one
    shingle.  A null id is never the smallest; a component of null ids only
    has a null component_id.  Rows with a repeated id each keep their row.
    An empty table gives empty results.  Other columns are not read.
    """
    rows = materialize(with_fingerprint(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                                        "text", "fp", words_each).select("id", "fp"), "simhash-rows")
    fps = materialize(rows.groupBy("fp").agg(F.min("id").alias("id")), "simhash-distinct")
    roots = materialize(components(link_forest(fps.select("fp"), max_bits, cell_rows)), "simhash-roots")
    member = (fps.join(roots, fps.fp == roots.node, "left")
              .select("fp", "id", F.coalesce("root", "fp").alias("root")))
    least = materialize(member.groupBy("root").agg(F.min("id").alias("component_id")), "simhash-least")
    groups = member.select("fp", "root").join(least, "root").select("fp", "root", "component_id")
    return rows, materialize(groups, "simhash-groups")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``df`` with one row of each near-duplicate group: the one with the smallest id.

    Clean rows (alone in their group) always stay.  Where several rows share
    the smallest id, or a group has null ids only, one of them stays.
    Columns are those of ``df``.
    """
    rows, groups = near_duplicates(df, id_col, text_col, **how)
    first = rows.join(groups, "fp").where(F.col("id").eqNullSafe(F.col("component_id"))).select("id", "root").distinct()
    # an id of one row names that row; a repeated one may be in several groups
    again = rows.groupBy("id").count().where("count > 1").select("id", F.lit(True).alias("again"))
    kept = materialize(first.join(again, "id", "left"), "simhash-kept")
    marked = df.join(kept.where("id is not null and again is null").select(F.col("id").alias("_kept")),
                     df[f"`{id_col}`"] == F.col("_kept"), "left_semi")
    shared = kept.where("id is null or again")
    if shared.isEmpty():
        return marked
    again = with_fingerprint(df, text_col, "_fp").join(
        groups.select(F.col("fp").alias("_fp"), F.col("root").alias("_root"),
                      F.col("component_id").alias("_least")), "_fp")
    again = (again.where(F.col(f"`{id_col}`").eqNullSafe(F.col("_least")))
             .join(shared.select(F.col("root").alias("_root")), "_root", "left_semi")
             .dropDuplicates(["_root"]))
    return marked.unionByName(again.select(*[f"`{c}`" for c in df.columns]))
