"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed character n-grams (1 to 3 characters, words padded with a
space, letters only, lower case).  Document frequencies are counted over all
training rows.  The weights are learned by follow-the-regularised-leader
(FTRL-Proximal) with an elastic-net penalty, so most stay exactly zero.  A
temperature, fitted on training rows that the weights never saw, calibrates
the probabilities.

The fit uses a bounded sample of labelled rows (``max_train_rows``, the same
number from each label, chosen by a hash of the key); everything else covers
all rows.  Prediction reads the text only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import map_text, materialize, small_batches

BUCKETS = 1 << 14
MAX_TRAIN_ROWS = 2400
UNDETERMINED = "und"
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_CHUNK = 1 << 20


def letters_only(text: str) -> np.ndarray:
    """Code points of a text: lower case, every other character than a letter one space, padded."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    seen, where = np.unique(raw, return_inverse=True)
    keep = np.fromiter((chr(c).isalpha() for c in seen.tolist()), bool, len(seen))
    codes = np.where(keep, seen, 32)[where].astype(np.uint32)
    codes = np.concatenate(([32], codes, [32])).astype(np.uint32)
    return codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))]


def counts_of(text: str | None, buckets: int) -> np.ndarray | None:
    """Hashed n-gram counts of a whole text; None if it is null or has no letter."""
    if not text:
        return None
    codes = letters_only(text)
    if len(codes) < 3:
        return None
    out = np.zeros(buckets, np.int64)
    shift = np.uint32(32 - buckets.bit_length() + 1)
    for lo in range(0, len(codes), _CHUNK):  # two characters overlap: each n-gram counts once
        c = codes[lo:lo + _CHUNK + 2]
        end = min(_CHUNK, len(codes) - lo)
        h = np.zeros(0, np.uint32)
        grams = []
        for n in range(1, 4):
            x = c[n - 1:] if n == 1 else (h[:len(c) - n + 1] ^ c[n - 1:])
            h = x * _MIX[n - 1]
            h ^= h >> np.uint32(15)
            grams.append(h[:end] >> shift if n > 1 else h[:end][c[:end] != 32] >> shift)
        out += np.bincount(np.concatenate(grams), minlength=buckets)
    return out


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_labels: int, buckets: int, epochs: int = 3,
         alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> np.ndarray:
    """Weights (buckets x labels) from (indices, values, label) rows, visited in a fixed shuffled order."""
    z = np.zeros((buckets, n_labels))
    n = np.zeros((buckets, n_labels))

    def weights(at):
        zz, nn = z[at], n[at]
        return np.where(np.abs(zz) <= l1, 0.0,
                        -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(nn)) / alpha + l2))

    rng = np.random.default_rng(42)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at, values, label = rows[k]
            w = weights(at)
            p = softmax(values @ w)
            p[label] -= 1
            g = values[:, None] * p
            nn = n[at]
            z[at] += g - (np.sqrt(nn + g * g) - np.sqrt(nn)) / alpha * w
            n[at] = nn + g * g
    return weights(slice(None))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature (0.05 to 20) with the least negative log-likelihood, by golden section."""
    if not len(labels):
        return 1.0

    def loss(t):
        return -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(labels)), labels], 1e-300)).mean()

    lo, hi, g = np.log(0.05), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


@dataclass
class LanguageModel:
    """What prediction needs: labels in order, idf by bucket, weights, temperature."""

    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def features(self, counts: np.ndarray) -> np.ndarray:
        x = counts * self.idf
        return x / max(float(np.sqrt(x @ x)), 1e-12)

    def predict(self, texts: list) -> tuple[list[str], list[float]]:
        """(label, probability) lists; ``und`` with score 0 for null texts and texts without a letter."""
        out, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if not self.labels:
            return out, scores
        for i, text in enumerate(texts):
            counts = counts_of(text, len(self.idf))
            if counts is not None:
                at = np.flatnonzero(counts)
                x = counts[at] * self.idf[at]
                logits = (x / max(float(np.sqrt(x @ x)), 1e-12)) @ self.weights[at]
                p = softmax(logits / self.temperature)
                k = int(p.argmax())  # ties: the first label in order
                out[i], scores[i] = self.labels[k], float(p[k])
        return out, scores


def document_frequencies(texts: DataFrame, buckets: int) -> tuple[np.ndarray, int]:
    """In how many of all texts each bucket occurs, and the number of texts with letters.

    Each task adds up its own texts and gives ``buckets`` rows at most; the
    sums the driver gets have a size fixed by ``buckets``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(buckets, np.int64), 0
        for b in batches:
            for text in b.column(0).to_pylist():
                counts = counts_of(text, buckets)
                if counts is not None:
                    df += counts > 0
                    n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))],
                                         names=["bucket", "n"])

    small_batches(texts.sparkSession)
    sums = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out, total = np.zeros(buckets, np.int64), 0
    for r in sums:
        if r["bucket"] < 0:
            total = r["n"]
        else:
            out[r["bucket"]] = r["n"]
    return out, total


def sample_by_label(train: DataFrame, max_rows: int) -> DataFrame:
    """(label, text, calibrate): max_rows / labels rows of each label, the least by a hash of key and text.

    Repeated rows have one hash and are taken together or not.  One pass
    counts each label's rows below 2**30, 2**29, ... of the hashes' range; the
    least of these bounds that leaves enough rows thins the label, so that a
    frequent label's rows do not meet in one task.  A label is not thinned
    where no bound leaves enough, as where it is one row many times over; then
    each task's window keeps what one label may give before rows are moved.
    """
    span = 30
    place = F.pmod(F.xxhash64("key", "text"), F.lit(1 << span))
    below = [F.count(F.when(F.col("h") < (1 << k), 1)).alias(f"n{k}") for k in range(span + 1)]
    sizes = materialize(train.select("label", place.alias("h")).groupBy("label").agg(*below), "label-counts")
    n_labels = sizes.count()
    if n_labels > max_rows:
        raise ValueError(f"{n_labels} labels, and {max_rows} rows to learn them from")
    each = max(1, max_rows // max(n_labels, 1))
    bound = F.coalesce(*[F.when(F.col(f"n{k}") >= each, F.lit(1 << k)) for k in range(span + 1)], F.lit(1 << span))
    near = (train.join(sizes.select("label", bound.alias("bound")), "label").withColumn("h", place)
            .where(F.col("h") < F.col("bound")))
    best = F.row_number().over(W.partitionBy("label").orderBy("h", F.xxhash64("key", "text")))
    return (near.withColumn("place", best).where(F.col("place") <= each)
            .select("label", "text", (F.col("place") % 5 == 0).alias("calibrate")))


def fit(train: DataFrame, buckets: int = BUCKETS, max_train_rows: int = MAX_TRAIN_ROWS) -> LanguageModel:
    """Fit on (key, label, text) rows; rows with a null label or text teach nothing.

    Document frequencies come from all rows.  The weights come from
    ``max_train_rows`` rows at most (four fifths of them; the rest fits the
    temperature).  Without any labelled row the model has no label and
    predicts ``und`` throughout.
    """
    train = train.where("label is not null and text is not null")
    seen, total = document_frequencies(train.select("text"), buckets)
    idf = np.log((1 + total) / (1 + seen)) + 1
    fields = "label string, calibrate boolean, at array<int>, n array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for label, text, calibrate in zip(*(c.to_pylist() for c in b.columns)):
                counts = counts_of(text, buckets)
                if counts is not None:
                    at = np.flatnonzero(counts)
                    rows.append((label, calibrate, at, counts[at]))
            if rows:
                kinds = [pa.string(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 names=["label", "calibrate", "at", "n"])

    got = sample_by_label(train, max_train_rows).select("label", "text", "calibrate").mapInArrow(run, fields).toArrow()
    labels = sorted(set(got["label"].to_pylist()))
    model = LanguageModel(labels, idf, np.zeros((buckets, len(labels))), 1.0)
    if not labels:
        return model
    rows, held = [], []
    for label, calibrate, at, n in zip(*(got[c].to_numpy() for c in ("label", "calibrate", "at", "n"))):
        x = n * idf[at]
        (held if calibrate else rows).append((at, x / np.sqrt(x @ x), labels.index(label)))
    rows.sort(key=lambda r: (r[2], len(r[0]), r[0].tobytes(), r[1].tobytes()))  # the same fit in whatever order rows come
    model.weights = ftrl(rows, len(labels), buckets)
    logits = np.array([v @ model.weights[at] for at, v, _ in held]).reshape(len(held), len(labels))
    model.temperature = fit_temperature(logits, np.array([y for *_, y in held], int))
    return model


def predict(df: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``df`` with lang_pred and score (0 to 1), from the whole text alone.

    Null texts and texts without a letter are ``und`` with score 0.  Columns
    named like a result column are replaced.
    """
    parts = (model.labels, model.idf, model.weights, model.temperature)
    held = df.sparkSession.sparkContext.broadcast(parts)  # buckets x labels numbers

    def start():
        own = LanguageModel(*held.value)
        return lambda texts: list(own.predict(texts))

    return map_text(df, text_col, [T.StructField("lang_pred", T.StringType()),
                                   T.StructField("score", T.DoubleType())], start)
