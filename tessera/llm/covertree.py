"""Embedding near-dedup: exact threshold pairs by cover-tree dual traversal.

Unit vectors at cosine c lie sqrt(2 - 2c) apart, so the threshold is a radius.

1. Equal vectors of a label become one class with its number of copies.
2. The cover tree's upper level is a set of pivots (a bounded sample of the
   vectors, the same for all labels): one for every ``chunk_rows`` classes,
   within ``PIVOTS``.  They decide how the work is cut, not what is found.
   A class lives in the cell of its
   nearest pivot and visits, as a guest, each cell of a later pivot that its
   radius ball may reach: the cell's covering radius and the border between
   the two pivots both bound that.
3. Cells are cut into chunks of at most ``chunk_rows`` classes; each chunk
   meets the later chunks and the guests of its cell once.  A pair of chunks
   is one task's work, of bounded memory.
4. In a task, each side is a tree of nested levels with halving radii.  The
   dual traversal drops a pair of nodes that lie further apart than their
   covering radii and the threshold; it takes a pair whole when no two points
   can be further apart than the threshold; what is left at the leaves is
   verified with the cosine in double precision.
5. A task gives the number of links of each class and a spanning forest of
   them, never the pairs, so a dense cluster's output is linear.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_batches
from .components import components

THRESHOLD = 0.98
PIVOTS = (16, 4096)
CHUNK_ROWS = 4096
LEAF = 64
_SLACK = 1e-6  # bounds are taken this much wider, so rounding never loses a pair


class Node:
    """Points (by index), a center among them, the covering radius, and children of half the radius."""

    __slots__ = ("center", "children", "points", "radius")

    def __init__(self, points, center, radius, children):
        self.points, self.center, self.radius, self.children = points, center, radius, children


def build_tree(unit: np.ndarray, points: np.ndarray, center: int, scale: float) -> Node:
    """Tree over ``points``, all within ``scale`` of ``center``; a child's scale is half as large."""
    gap = _distance(unit[points], unit[center])
    gap[points == center] = 0.0
    radius = float(gap.max())
    if len(points) <= LEAF or radius <= _SLACK:
        return Node(points, center, radius, [])
    half = scale / 2
    while radius <= half:
        half /= 2
    children, left, at, near = [], points, center, gap
    while len(left):
        inside = near <= half
        own, left = left[inside], left[~inside]
        children.append(build_tree(unit, own, at, half) if len(own) > 1 else Node(own, at, 0.0, []))
        if len(left):
            at = int(left[0])
            near = _distance(unit[left], unit[at])
            near[0] = 0.0
    return Node(points, center, radius, children)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b), 0.0))


class Links:
    """Number of links of each point (weighted by the other's copies) and their components."""

    def __init__(self, vectors: np.ndarray, weight: np.ndarray, threshold: float):
        self.v = vectors
        self.norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        self.unit = vectors / self.norm[:, None]
        self.weight, self.threshold = weight, threshold
        self.reach = float(np.sqrt(max(2.0 - 2.0 * threshold, 0.0)))
        self.count = np.zeros(len(vectors), np.int64)
        self.part = np.arange(len(vectors))

    def join(self, points: np.ndarray) -> None:
        """One component for all ``points``."""
        parts = np.unique(self.part[points])
        if len(parts) > 1:
            self.part[np.isin(self.part, parts[1:])] = parts[0]

    def verify(self, a: np.ndarray, b: np.ndarray) -> None:
        """Link those of the candidate pairs (a[i], b[i]) whose cosine reaches the threshold."""
        cos = np.einsum("ij,ij->i", self.v[a], self.v[b]) / (self.norm[a] * self.norm[b])
        a, b = a[cos >= self.threshold], b[cos >= self.threshold]
        np.add.at(self.count, a, self.weight[b])
        np.add.at(self.count, b, self.weight[a])
        while len(a := a[(apart := self.part[a] != self.part[b])]):
            b = b[apart]
            self.join(np.array([a[0], b[0]]))
            a, b = a[1:], b[1:]

    def leaves(self, a: np.ndarray, b: np.ndarray, same: bool) -> None:
        near = _distance(self.unit[a], self.unit[b].T) <= self.reach + _SLACK
        i, j = np.nonzero(np.triu(near, 1) if same else near)
        if len(i):
            self.verify(a[i], b[j])

    def dual(self, p: Node, q: Node) -> None:
        """Links between the points of two nodes, or within one (p is q)."""
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            if p is q:
                if 2 * p.radius <= self.reach - _SLACK and len(p.points) > 1:
                    total = int(self.weight[p.points].sum())
                    self.count[p.points] += total - self.weight[p.points]
                    self.join(p.points)
                elif not p.children:
                    self.leaves(p.points, p.points, True)
                else:
                    todo += [(c, c) for c in p.children if len(c.points) > 1]
                    self._children(p.children, p.children, True, todo)
                continue
            if not p.children and not q.children:
                self.leaves(p.points, q.points, False)
            else:
                self._children(p.children or [p], q.children or [q], False, todo)

    def _children(self, ps: list[Node], qs: list[Node], same: bool, todo: list) -> None:
        """Prune all pairs of children at once by their covering radii; the rest goes on."""
        rp, rq = np.array([c.radius for c in ps]), np.array([c.radius for c in qs])
        cp, cq = np.array([c.center for c in ps]), np.array([c.center for c in qs])
        np_, nq = np.array([len(c.points) for c in ps]), np.array([len(c.points) for c in qs])
        for lo in range(0, len(ps), 512):
            part = slice(lo, lo + 512)
            far = _distance(self.unit[cp[part]], self.unit[cq].T)
            bound = rp[part, None] + rq[None, :]
            keep = far - bound <= self.reach + _SLACK
            if same:
                keep &= np.arange(len(qs))[None, :] > np.arange(lo, lo + len(far))[:, None]
            i, j = np.nonzero(keep)
            single = (np_[i + lo] == 1) & (nq[j] == 1)
            if single.any():
                self.verify(cp[i[single] + lo], cq[j[single]])
            for x, y in zip(i[~single].tolist(), j[~single].tolist()):
                a, b = ps[x + lo], qs[y]
                if far[x, y] + a.radius + b.radius <= self.reach - _SLACK:  # all of a with all of b
                    self.count[a.points] += int(self.weight[b.points].sum())
                    self.count[b.points] += int(self.weight[a.points].sum())
                    self.join(np.concatenate((a.points, b.points)))
                else:
                    todo.append((a, b))


def links_of(vectors: np.ndarray, weight: np.ndarray, split: int, threshold: float) -> Links:
    """All links among the vectors (split 0), or between the first ``split`` and the rest."""
    out = Links(vectors, weight, threshold)
    at = np.arange(len(vectors))
    if split:
        trees = [build_tree(out.unit, own, int(own[0]), 2.0) for own in (at[:split], at[split:])]
        out.dual(*trees)
    else:
        tree = build_tree(out.unit, at, 0, 2.0)
        out.dual(tree, tree)
    return out


def _usable(embedding: str) -> F.Column:
    """Not null, no null or non-finite component, not all zero."""
    e = F.col(embedding)
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return e.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(e, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix (all of one length)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def threshold_links(df: DataFrame, id_col: str = "vec_id", embedding_col: str = "embedding",
                    label_col: str = "label", threshold: float = THRESHOLD, pivots: int | None = None,
                    chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(id, n_links, component_id, kept), one row for each row of ``df``.

    Rows are compared only when their labels are equal and not null (and
    their vectors have the same length).  n_links counts the other rows at
    ``threshold`` or more in cosine, copies included; component_id is the
    smallest id reachable by links, a row's own included; kept says that the
    row has that id.  Vectors that are null, empty, all zero, or hold a null
    or non-finite component link with nothing.  A null id is never the
    smallest.  Rows that share an id are rows of their own.  Other columns
    are not read, whatever their names.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("id"), F.col(embedding_col).alias("e"), F.col(label_col).alias("label"))
    sound = rows.where(F.col("label").isNotNull() & _usable("e"))
    classes = materialize(
        sound.groupBy("label", "e").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
        .withColumn("class", F.monotonically_increasing_id()), "cover-classes")
    # a bounded sample: the vectors with the least hashes, of each length
    pivots = pivots or min(max(classes.count() // chunk_rows, PIVOTS[0]), PIVOTS[1])
    top = [r["e"] for r in classes.select("e").orderBy(F.xxhash64("e")).limit(pivots).collect()]
    lengths = sorted({len(e) for e in top})
    pivot = {n: np.array([e for e in top if len(e) == n], np.float64) for n in lengths}
    pivot = {n: m / np.linalg.norm(m, axis=1)[:, None] for n, m in pivot.items()}
    reach = float(np.sqrt(max(2.0 - 2.0 * threshold, 0.0))) + _SLACK

    def unit_of(column: pa.Array, n: int) -> np.ndarray:
        m = _matrix(column)
        return m / np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]

    def by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, pa.RecordBatch]]:
        sizes = pc.list_value_length(batch.column(column)).to_numpy()
        for n in np.unique(sizes):
            yield int(n), batch.take(pa.array(np.flatnonzero(sizes == n)))

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, own in by_length(batch, "e"):
                if n in pivot:
                    d = _distance(unit_of(own.column("e"), n), pivot[n].T)
                    cell, radius = d.argmin(axis=1), d.min(axis=1)
                else:
                    cell, radius = np.zeros(len(own), np.int64), np.full(len(own), 2.0)
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(np.full(len(own), n)), pa.array(cell.astype(np.int64)), pa.array(radius)],
                    names=[*own.schema.names, "dim", "cell", "far"])

    small_batches(spark)
    schema = "label {0}, e {1}, class long, copies long, dim long, cell long, far double".format(
        classes.schema["label"].dataType.simpleString(), classes.schema["e"].dataType.simpleString())
    placed = materialize(classes.select("label", "e", "class", "copies").mapInArrow(home, schema), "cover-home")
    cells = materialize(placed.groupBy("label", "dim", "cell").agg(
        F.max("far").alias("radius"), F.count("*").alias("n")), "cover-cells")
    radius = {n: np.full(len(m), -1.0) for n, m in pivot.items()}  # covering radius of each pivot, over all labels
    for r in cells.where(F.col("dim").isin(lengths)).groupBy("dim", "cell").agg(F.max("radius").alias("r")).collect():
        radius[r["dim"]][r["cell"]] = r["r"]

    def guests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, own in by_length(batch, "e"):
                if n not in pivot:
                    continue
                d = _distance(unit_of(own.column("e"), n), pivot[n].T)
                cell = own.column("cell").to_numpy()
                between = _distance(pivot[n], pivot[n].T)
                at = np.arange(len(own))
                border = (d ** 2 - d[at, cell][:, None] ** 2) / (2 * np.maximum(between[cell], 1e-12))
                go = (radius[n] >= 0) & (d <= radius[n] + reach) & (border <= reach) & (
                    np.arange(d.shape[1])[None, :] > cell[:, None])
                i, to = np.nonzero(go)
                if len(i):
                    kept = own.take(pa.array(i))
                    yield pa.RecordBatch.from_arrays(
                        [kept.column(c) for c in ("label", "e", "class", "copies", "dim")] + [pa.array(to.astype(np.int64))],
                        names=["label", "e", "class", "copies", "dim", "cell"])

    key = ["label", "dim", "cell"]
    visiting = materialize(placed.mapInArrow(
        guests, schema.removesuffix(", far double")), "cover-guests")
    # A chunk of a cell meets itself, the chunks after it and every chunk of guests (-1, -2, ...).
    chunks = F.ceil(F.col("n") / chunk_rows)
    sized = cells.select(*key, chunks.alias("chunks"))
    guest_sized = visiting.groupBy(*key).agg(F.count("*").alias("n")).select(*key, chunks.alias("guest_chunks"))
    chunk = F.pmod(F.xxhash64("class"), F.col("chunks"))
    at_home = placed.drop("far").join(sized, key).withColumn("chunk", chunk)
    pairs = at_home.withColumn("to", F.explode(F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.struct(
        F.least("chunk", j).alias("i"), F.greatest("chunk", j).alias("j"),
        F.when(F.col("chunk") > j, 1).otherwise(0).alias("side"))))).select(*key, "e", "class", "copies", "to.*")
    met = (visiting.join(sized, key).join(guest_sized, key)
           .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
           .select(*key, "e", "class", "copies", "i", F.lit(1).alias("side"),
                   (F.lit(-1) - F.pmod(F.xxhash64("class"), F.col("guest_chunks"))).alias("j")))
    hosts = (at_home.join(guest_sized, key)
             .withColumn("j", F.explode(F.sequence(-F.col("guest_chunks"), F.lit(-1).cast("long"))))
             .select(*key, "e", "class", "copies", F.col("chunk").alias("i"), "j", F.lit(0).alias("side")))
    work = (pairs.unionByName(met).unionByName(hosts).repartition(*key, "i", "j")
            .sortWithinPartitions(*key, "i", "j", "side", "class"))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, [*key, "i", "j"]):
            side = group.column("side").to_numpy()
            across = group.column("i")[0].as_py() != group.column("j")[0].as_py()
            split = int((side == 0).sum()) if across else 0
            if len(group) < 2 or across and split in (0, len(group)):
                continue
            found = links_of(_matrix(group.column("e")), group.column("copies").to_numpy(), split, threshold)
            at = np.flatnonzero(found.count)
            if len(at):
                ids = group.column("class").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(found.count[at]), pa.array(ids[found.part[at]])],
                    names=["class", "links", "mate"])

    found = materialize(work.mapInArrow(solve, "class long, links long, mate long"), "cover-links")
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("class").alias("a"), F.col("mate").alias("b")))
    member = (classes.select("class", "label", "e", "copies", "least").join(counts, "class", "left")
              .join(roots.withColumnRenamed("node", "class"), "class", "left")
              .withColumn("root", F.coalesce("root", "class")))
    least = materialize(member.groupBy("root").agg(F.min("least").alias("component")), "cover-least")
    final = materialize(
        member.join(least, "root").select("label", "e", "component", (
            F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")), "cover-final")
    linked = sound.join(final, ["label", "e"]).select("id", "links", "component")
    alone = rows.where(~(F.col("label").isNotNull() & _usable("e"))).select(
        "id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal keys, from sorted batches; one run is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        cols = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*cols))
        lo = 0
        for i, row in enumerate(rows):
            if row != last:
                if held or i > lo:
                    if i > lo:
                        held.append(batch.slice(lo, i - lo))
                    yield pa.concat_batches(held)
                held, lo, last = [], i, row
        if lo < len(rows):
            held.append(batch.slice(lo))
    if held:
        yield pa.concat_batches(held)
