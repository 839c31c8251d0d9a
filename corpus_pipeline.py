"""The corpus pipeline: language ID, near-dedup, decontamination, piece encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept.  ``run`` writes each stage's rows as Parquet in the shared
checkpoint folder and reads them back, so a lost executor costs a stage at
most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import contamination, langid, pieces, simhash
from tessera.llm.common import materialize
from tessera.llm.queries import PIECE_MODEL, remainder, table

#: Documents with a lower calibrated probability than this have no language (``und`` has 0).
MIN_LANGUAGE_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language can be told: not ``und``, and not as good as a guess."""
    train = docs.where(~F.coalesce(remainder(3) == 1, F.lit(False))).select(
        F.col("doc_id").alias("key"), F.col("lang").alias("label"), "text")
    told = langid.predict(docs, langid.fit(train))
    return told.where(F.col("score") >= MIN_LANGUAGE_SCORE).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each SimHash group (3-word shingles, 3 bits)."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents of which less than a twentieth of the words are benchmark passages."""
    found = contamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each whole text, and whether they decode to the text again."""
    done = pieces.encode_texts(docs, PIECE_MODEL)
    return done.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding", encode),
]

#: No SQL: training, fingerprints and piece encoding are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
