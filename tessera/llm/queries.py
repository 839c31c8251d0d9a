"""Registered queries of the operators: the production call and the digest columns of each."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    codes, contamination, covertree, langid, licenses, mixing, oracle, pieces, shards, simhash, suffix_tree, toolcalls,
    turns, warc,
)

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remainder(n: int, id_col: str = "doc_id"):
    """crc32(id as text) mod n."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % n


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op2_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    out, _ = shards.shard_by_bytes(rows, ["doc_id", "text_crc32"], "size", 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "vslot")


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pieces.encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), PIECE_MODEL)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find_contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(3) == 1, F.lit(False))
    train = docs.where(~held_out).select(F.col("doc_id").alias("key"), F.col("lang").alias("label"), "text")
    guess = langid.predict(docs.select("doc_id", "text"), langid.fit(train))
    return guess.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    root = warc.write_archives(pages)
    found = warc.lookup(spark, root, pages.select(warc.url_key(F.col("url")).alias("key")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.threshold_links(table(spark, sf_dir, "embeddings"))


def op8_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(remainder(7) == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    return suffix_tree.score_texts(docs, docs.where(~F.col("held_out")))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.join(groups, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn is a call, each assistant turn the result of the call before it.

    A call is a search or a note (by the length of the text), and follows up
    the call two turns earlier.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    size = F.length(F.coalesce("text", F.lit("")))
    at = lambda turn: F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))
    search = F.to_json(F.struct(F.col("text").alias("query"), (size % 50).alias("limit")))
    note = F.to_json(F.struct((F.col("turn") % 4 == 0).alias("pinned"), F.col("text").alias("body"),
                              F.when(F.col("turn") % 8 == 6, F.col("turn")).alias("mark")))
    is_note = size % 5 == 0
    calls = turns.where("role = 'user'").select(
        F.col("conv_id").alias("thread"), F.col("turn").alias("place"), at(F.col("turn")).alias("call_id"),
        F.when(is_note, "note").otherwise("search").alias("tool"),
        F.when(is_note, note).otherwise(search).alias("arguments"), at(F.col("turn") - 2).alias("after"))
    results = turns.where("role = 'assistant'").select(
        F.col("conv_id").alias("thread"), F.col("turn").alias("place"), at(F.col("turn") - 1).alias("call_id"),
        F.col("text").alias("content"))
    linked = toolcalls.link_calls(calls, results)
    return linked.select(F.col("thread").alias("conv_id"), F.col("place").alias("turn"), "kind", "call_id", "status",
                         "level", F.array_join("errors", ",").alias("errors"), "message")


def damaged_turns(df: DataFrame) -> DataFrame:
    """The turns with one fault in four or so, by the remainder of crc32(``conv_id:turn``); nulls are one space."""
    space = F.lit(" ")
    at = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(F.encode(at, "UTF-8")) % 20
    text = F.coalesce("text", space)
    return df.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1))).alias("_")).drop("_")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report, repaired = turns.repair(damaged_turns(given))
    # one row a conversation from each; grouping takes a null conversation like any other
    parts = given.select(F.col("conv_id").alias("conv")).distinct()
    for part in (report, turns.digests(repaired)):
        parts = parts.unionByName(part, allowMissingColumns=True)
    count = lambda c: F.coalesce(F.max(c), F.lit(0)).alias(c)
    return parts.groupBy(F.col("conv").alias("conv_id")).agg(
        *[count(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = codes.compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.words("text").alias("size"))
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source")


REGISTRY = {f.__name__: f for f in (
    op1_licenses, op2_virtual_slots, op3_pieces, op4_contamination, op5_language, op6_warc, op7_cover_tree, op8_suffix_tree, op9_simhash, op10_tool_calls,
    op11_turn_repair, op12_vector_codes, op13_fair_mix)}

#: DuckDB SQL of the queries that SQL can express.
SQL: dict[str, str] = oracle.SQL
