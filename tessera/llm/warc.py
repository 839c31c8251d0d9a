"""WARC archives with a two-level capture index.

Writing: captures are range-partitioned and sorted by reversed-host URL key
(``com,example,www)/path``).  Each task writes one archive (every record its
own gzip member) and, beside it, the index of its captures: sorted lines in
compressed blocks.  The block directory, one row a block (first and last key,
file, place), is a Parquet table in key order: the sparse level.

Reading: a lookup sorts its keys by range, so each task needs a slice of the
directory.  It finds the blocks of a key there by binary search; the blocks are
then dealt out evenly, each is read once by range, searched again by binary
search, and the records found are read by range from the archive.

Files are reached through the URI of the shared folder (pyarrow.fs), so
archives can lie in any store that the executors share.  A task writes under a
name of its own and renames at its end: a retry replaces the same files.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BATCH_ROWS, materialize, shared_dir, small_batches

BLOCK_LINES = 512
READ_BYTES = 4 << 20
#: Archive bytes that a task of the read side serves, where there are tasks enough.
TASK_BYTES = 4 << 20
_CAPTURED = "1970-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DIRECTORY = "file string, first_key string, last_key string, offset long, length long, lines long, bytes long"
_RECORD = ("key string, page_id long, url string, record_type string, refers_to long, "
           "payload_bytes long, payload_digest string, payload binary")


def url_key(url: F.Column) -> F.Column:
    """Reversed-host key of a URL: host labels from right to left, ``)``, then path and query.

    Scheme, user, port and fragment are left out; the host is lower-cased. A
    null URL has the empty key; what has no ``://`` is a path without host.
    Control characters and blanks become ``%20``.
    """
    rest = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"(?s)#.*$", ""), r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://", "//")
    there = rest.startswith("//")
    host = F.lower(F.regexp_replace(F.regexp_extract(rest, r"(?s)^//([^/?]*)", 1), r"^.*@|:\d*$", ""))
    path = F.when(there, F.regexp_replace(rest, r"(?s)^//[^/?]*", "")).otherwise(rest)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)
    return F.when(url.isNull(), F.lit("")).otherwise(F.regexp_replace(key, r"[\x00-\x20\x7f]", "%20"))


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    got = (name or "").removeprefix("<urn:x-page:").removesuffix(">")
    return None if got in ("", "none") else int(got)


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                revisit: bool) -> bytes:
    """One WARC record; a revisit has the HTTP headers of its page but no payload."""
    target = re.sub(r"[\x00-\x20\x7f]", "%20", url) if url is not None else _name(page_id)[1:-1]
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}",
            f"WARC-Date: {_CAPTURED}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {_name(refers_to)}"]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (
        f"Content-Length: {len(payload)}\r\n\r\n".encode())
    block += b"" if revisit else payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in raw.decode().split("\r\n")[1:])}


def parse_record(raw: bytes) -> dict:
    """A record's fields; size and digest of a response are those of the payload that was read."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[:int(warc["content-length"])]
    http_head, _, payload = block.partition(b"\r\n\r\n")
    revisit = warc["warc-type"] == "revisit"
    digest = warc["warc-payload-digest"].removeprefix("sha1:")
    if not revisit:
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest:
            raise ValueError(f"{warc['warc-record-id']}: payload digest {found}, header {digest}")
    return {"page_id": _page(warc["warc-record-id"]), "url": warc["warc-target-uri"],
            "record_type": warc["warc-type"], "refers_to": _page(warc.get("warc-refers-to")),
            "payload_bytes": int(_headers(http_head)["content-length"]) if revisit else len(payload),
            "payload_digest": digest, "payload": None if revisit else payload}


def write_archives(pages: DataFrame, root: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", block_lines: int = BLOCK_LINES) -> str:
    """Write a record for each page; returns the archive's folder.

    The payload is the html in UTF-8 (null: empty).  Of equal payloads the
    page with the largest id is the response and the others are revisits that
    refer to it; pages that share the largest id are all responses.  A null
    id is the smallest (if all are null, all are responses).  An empty table
    gives an archive without files.  Other columns are not read.
    """
    spark = pages.sparkSession
    root = root or shared_dir(spark, "warc")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        url_key(F.col(url_col)).alias("key"),
                        F.encode(F.coalesce(html_col, F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    copies = materialize(rows.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
                         .where("n > 1 and refers_to is not null").select("sha", "refers_to"), "warc-copies")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    ordered = (rows.join(copies, "sha", "left").withColumn("revisit", revisit)
               .repartitionByRange("key", "page_id", "sha").sortWithinPartitions("key", "page_id", "sha")
               .select("key", "page_id", "url", "payload", "sha", "refers_to", "revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, folder = _store(root)
        store.create_dir(folder, recursive=True)
        name = f"captures-{task.partitionId():06d}"
        own = f"{folder}/.{name}-{uuid.uuid4().hex}"
        archive = index = None
        lines, blocks = [], []
        at = done = block_start = 0

        def close_block():
            nonlocal done, block_start
            packed = zlib.compress("\n".join(x for _, x in lines).encode(), 6)
            index.write(packed)
            blocks.append((name, lines[0][0], lines[-1][0], done, len(packed), len(lines), at - block_start))
            done, block_start = done + len(packed), at
            lines.clear()

        for batch in batches:
            for key, page_id, url, payload, sha, refers_to, again in zip(*(c.to_pylist() for c in batch.columns)):
                if archive is None:
                    archive, index = (store.open_output_stream(own + end, compression=None) for end in (".warc.gz", ".cdx"))
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                record = gzip.compress(make_record(page_id, url, payload, digest, refers_to if again else None, again), 6, mtime=0)
                archive.write(record)
                lines.append((key, f"{key}\t{at}\t{len(record)}"))
                at += len(record)
                if len(lines) >= block_lines:
                    close_block()
        if archive is None:
            return
        if lines:
            close_block()
        for stream, end in ((archive, ".warc.gz"), (index, ".cdx")):
            stream.close()
            store.move(own + end, f"{folder}/{name}{end}")
        names = [x.split()[0] for x in _DIRECTORY.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*blocks)], names=names)

    small_batches(spark)
    ordered.mapInArrow(write, _DIRECTORY).write.parquet(f"{root}/directory")
    return root


def lookup(spark: SparkSession, root: str, keys: DataFrame) -> DataFrame:
    """Every capture of the given keys (column ``key``): its fields and its payload (null for a revisit).

    Repeated keys count once; null keys and keys without captures give nothing.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directory = None
        for batch in batches:
            wanted = batch.column(0).to_pylist()
            if not wanted:
                continue
            if directory is None:
                store, folder = _store(root)
                directory = ds.dataset(f"{folder}/directory", filesystem=store, format="parquet",
                                       exclude_invalid_files=False, schema=_directory_schema())
            part = directory.to_table(filter=(ds.field("last_key") >= wanted[0]) & (ds.field("first_key") <= wanted[-1]))
            part = part.sort_by([("first_key", "ascending"), ("last_key", "ascending"), ("file", "ascending"), ("offset", "ascending")])
            first, last = part["first_key"].to_pylist(), part["last_key"].to_pylist()
            at, hit = [], []
            for key in wanted:
                for i in range(bisect_left(last, key), bisect_right(first, key)):
                    at.append(i)
                    hit.append(key)
            got = part.select(["file", "offset", "length"]).take(pa.array(at, pa.int64())).combine_chunks()
            if len(hit):
                yield pa.RecordBatch.from_arrays(
                    [got[c].combine_chunks() for c in ("file", "offset", "length")] + [pa.array(hit)],
                    names=["file", "offset", "length", "key"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(root)
        names = [x.split()[0] for x in _RECORD.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        block_at, name, index, archive = None, None, None, None
        lines: list[str] = []
        line_keys: list[str] = []

        def records(places: list[tuple[str, int, int]]):
            """The records at (key, offset, length) in order; neighbours are read together."""
            lo = 0
            while lo < len(places):
                hi, start = lo + 1, places[lo][1]
                while (hi < len(places) and places[hi][1] == places[hi - 1][1] + places[hi - 1][2]
                       and places[hi][1] + places[hi][2] - start <= READ_BYTES):
                    hi += 1
                archive.seek(start)
                raw = archive.read(places[hi - 1][1] + places[hi - 1][2] - start)
                for key, offset, length in places[lo:hi]:
                    yield {"key": key} | parse_record(gzip.decompress(raw[offset - start:offset - start + length]))
                lo = hi

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)

        def serve(places):
            held, size = [], 0
            for r in records(places):
                held.append(r)
                size += r["payload_bytes"]
                if len(held) >= BATCH_ROWS or size > READ_BYTES:
                    yield batch_of(held)
                    held, size = [], 0
            if held:
                yield batch_of(held)

        places: list[tuple[str, int, int]] = []
        for batch in batches:
            for file, offset, length, key in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, offset) != block_at:
                    yield from serve(places)
                    places, block_at = [], (file, offset)
                    if file != name:
                        name = file
                        index, archive = (store.open_input_file(f"{folder}/{file}{end}") for end in (".cdx", ".warc.gz"))
                    index.seek(offset)
                    lines = zlib.decompress(index.read(length)).decode().split("\n")
                    line_keys = [x.partition("\t")[0] for x in lines]
                for line in lines[bisect_left(line_keys, key):bisect_right(line_keys, key)]:
                    k, o, n = line.split("\t")
                    places.append((k, int(o), int(n)))
        yield from serve(places)

    small_batches(spark)
    wanted = keys.select("key").where("key is not null").distinct().repartitionByRange("key").sortWithinPartitions("key")
    blocks = wanted.mapInArrow(find, "file string, offset long, length long, key string")
    # by the archive bytes behind the index rows: a number, which adaptive execution does not lower by the rows' own size
    stored = spark.read.schema(_DIRECTORY).parquet(f"{root}/directory").agg(F.sum("bytes")).first()[0] or 0
    n = min(stored // TASK_BYTES + 1, 16 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    return (blocks.repartition(n, "file", "offset").sortWithinPartitions("file", "offset", "key")
            .mapInArrow(read, _RECORD))


def _directory_schema() -> pa.Schema:
    return pa.schema([(n, pa.string() if t == "string" else pa.int64())
                      for n, t in (x.split() for x in _DIRECTORY.split(", "))])
