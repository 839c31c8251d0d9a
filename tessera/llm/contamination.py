"""Benchmark decontamination: Wu-Manber multi-pattern search over word sequences.

Texts become word sequences (A-Z lower-cased; runs of digits, letters and
non-ASCII characters).  Every run of 13 consecutive words of a benchmark item
is a pattern (an item of fewer words is one pattern).  For the patterns of one
length the search keeps

* a block shift table: the last ``BLOCK`` words of the current window tell how
  far the window may move without passing an occurrence; a block in no
  pattern moves it by nearly a whole window,
* buckets of patterns by their last block, looked at where the shift is 0, and
* a direct comparison of the window with the patterns of the bucket.

The benchmark is a stated query set.  Its tables are broadcast in blocks of at
most ``max_block_bytes`` of item text.  A larger benchmark takes a pass over
the documents for each block, one after the other: a worker holds the tables
of one block, and what a pass finds (the documents with hits) is written.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_text, materialize, without, worker_state

WINDOW_WORDS = 13
BLOCK = 2
MAX_BLOCK_BYTES = 1 << 20
_SPLIT = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
               for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: A-Z lower-cased, then runs of 0-9, a-z and non-ASCII characters."""
    return text.translate(_SPLIT).split() if text else []


class WuManber:
    """Patterns (word tuples) of one length with their shift table and buckets."""

    def __init__(self, length: int, patterns: dict[tuple, set]):
        self.length = length
        self.block = min(BLOCK, length)
        self.default = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, set]] = defaultdict(dict)
        for p, items in patterns.items():
            for end in range(self.block, length + 1):
                key = p[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, self.default), length - end)
            self.buckets[p[length - self.block:]][p] = items

    def search(self, words: list[bytes]):
        """(start, items) of every occurrence, overlapping ones included."""
        m, b, default, n = self.length, self.block, self.default, len(words)
        shift, end = self.shift.get, self.length
        while end <= n:
            key = tuple(words[end - b:end])
            move = shift(key, default)
            if move:
                end += move
                continue
            window = tuple(words[end - m:end])
            items = self.buckets[key].get(window)  # equality of all words, not of a hash alone
            if items is not None:
                yield end - m, items
            end += 1


def build(items: list[tuple[str | None, bytes | None]], window: int) -> list[WuManber]:
    """Searchers for the windows of (item id, text) rows, one for each pattern length."""
    by_length: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for lo in range(len(words) - size + 1 if size else 0):
            by_length[size][tuple(words[lo:lo + size])].add(item)
    return [WuManber(m, dict(p)) for m, p in sorted(by_length.items())]


def scan(searchers: list[WuManber], text: bytes | None) -> tuple[int, list[list[int]], list[str]]:
    """(number of words, merged [start, end) spans of hit words, sorted ids of items found)."""
    words = words_of(text)
    spans, found = [], set()
    for s in searchers:
        for start, items in s.search(words):
            spans.append((start, start + s.length))
            found |= items
    merged: list[list[int]] = []
    for lo, hi in sorted(spans):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(hi, merged[-1][1])
        else:
            merged.append([lo, hi])
    return len(words), merged, sorted(i for i in found if i is not None)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, max_bytes: int):
    """Lists of (id, text): the benchmark in blocks of about ``max_bytes``."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("id"),
                            F.encode(F.col(text_col), "UTF-8").alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.length("text") + 16)).first()[0] or 0
    n = total // max_bytes + 1
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        yield [(r["id"], bytes(r["text"])) for r in part.collect()]


def _search(df: DataFrame, text_col: str, block: list, window: int):
    """``df`` with n_words, spans and items of one block's windows, and the broadcast of its tables."""
    kinds = [pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string())]
    tables = df.sparkSession.sparkContext.broadcast((block, window))
    key = uuid.uuid4().hex

    def start():
        searchers = worker_state("wu-manber", key, lambda: build(*tables.value))

        def work(texts):
            n, spans, items = zip(*(scan(searchers, t) for t in texts))
            return [pa.array(n, kinds[0]),
                    pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], kinds[1]),
                    pa.array(items, kinds[2])]
        return work

    return map_text(df, text_col, [T.StructField("n_words", T.LongType()), T.StructField("spans", _SPANS),
                                   T.StructField("items", T.ArrayType(T.StringType()))], start, as_bytes=True), tables


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _search_blocks(df: DataFrame, text_col: str, blocks: Iterable[list], window: int) -> DataFrame:
    """The same for more than one block: a pass and a table of hits for each, merged by document."""
    docs = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "contamination-docs")
    hits = None
    for block in blocks:
        found, tables = _search(docs.select("_row", f"`{text_col}`"), text_col, block, window)
        part = materialize(found.where(F.size("spans") > 0).select("_row", "spans", "items"), "contamination-hits")
        tables.destroy()
        hits = part if hits is None else hits.unionByName(part)
    by_doc = hits.groupBy("_row").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
                                      F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    merged = F.reduce("spans", F.array().cast(_SPANS), lambda acc, x: F.when(
        (F.size(acc) > 0) & (x["start"] <= F.element_at(acc, -1)["end"]),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["start"].alias("start"),
            F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(x))))
    counted = map_text(docs, text_col, [T.StructField("n_words", T.LongType())],
                       lambda: lambda texts: [[len(words_of(t)) for t in texts]], as_bytes=True)
    return (counted.join(by_doc, "_row", "left").drop("_row")
            .withColumns({"spans": F.coalesce(merged, F.array().cast(_SPANS)),
                          "items": F.coalesce("items", F.array().cast("array<string>"))}))


def find_contamination(df: DataFrame, benchmark: DataFrame, text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text",
                       window: int = WINDOW_WORDS,
                       max_block_bytes: int = MAX_BLOCK_BYTES) -> DataFrame:
    """``df`` with n_words, n_hit (long), spans (hit words, [start, end)), items, contaminated.

    A word inside any occurrence of a window is hit; a document is
    contaminated when it has a hit and hits are a twentieth of its words or
    more.  Null and empty texts have no words and are never contaminated;
    null or wordless items have no window.  Items with a null id count as
    hits but have no id to list.  Repeated items, and windows that several
    items share, list every id.  An empty benchmark hits nothing.  Columns of
    ``df`` named like a result column are replaced.
    """
    base = without(df, ["n_words", "n_hit", "spans", "items", "contaminated"])
    blocks = _blocks(benchmark, item_id_col, item_text_col, max_block_bytes)
    first = next(blocks)
    if (second := next(blocks, None)) is None:
        out, _ = _search(base, text_col, first, window)
    else:
        out = _search_blocks(base, text_col, chain((first, second), blocks), window)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])
    return (out.withColumn("n_hit", hit)
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))))
