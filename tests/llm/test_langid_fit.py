"""Language ID against naive versions: n-gram counts, FTRL, and the sample of a label."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import langid


def naive_counts(text, buckets):
    """Hashed 1- to 3-grams of the padded letters, one by one."""
    shown = re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in f" {text.lower()} "))
    if not shown.strip():
        return None
    out = Counter()
    for i in range(len(shown)):
        h = 0
        for n in range(3):
            if i + n < len(shown):
                h = ((h ^ ord(shown[i + n])) * [0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D][n]) % 2 ** 32
                h ^= h >> 15
                if n or shown[i] != " ":
                    out[h >> (32 - buckets.bit_length() + 1)] += 1
    return out


def test_ngram_counts_equal_a_naive_version():
    rng = random.Random(4)
    for text in ["a", "Zwölf Boxkämpfer!", "x1y 2 zz", "ÀÉ  ß", "日本 語"] + ["".join(rng.choice("abc é.Z\n") for _ in range(60)) for _ in range(40)]:
        got = langid.counts_of(text, 1 << 8)
        want = naive_counts(text, 1 << 8)
        assert (got is None and want is None) or {i: int(x) for i, x in enumerate(got) if x} == dict(want), text


def test_ftrl_equals_a_naive_version():
    """Per-coordinate FTRL-Proximal, one weight at a time."""
    rng = np.random.default_rng(6)
    rows = []
    for _ in range(12):
        at = np.sort(rng.choice(9, 4, replace=False))
        rows.append((at, rng.random(4), int(rng.integers(3))))
    z, n = [[0.0] * 3 for _ in range(9)], [[0.0] * 3 for _ in range(9)]
    alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 0.02

    def weight(i, j):
        if abs(z[i][j]) <= l1:
            return 0.0
        return -(z[i][j] - math.copysign(l1, z[i][j])) / ((beta + math.sqrt(n[i][j])) / alpha + l2)

    order = np.random.default_rng(42)
    for _ in range(3):
        for k in order.permutation(len(rows)):
            at, values, label = rows[k]
            w = {(i, j): weight(i, j) for i in at for j in range(3)}
            e = [math.exp(sum(v * w[i, j] for i, v in zip(at, values))) for j in range(3)]
            for i, v in zip(at, values):
                for j in range(3):
                    g = v * (e[j] / sum(e) - (j == label))
                    z[i][j] += g - (math.sqrt(n[i][j] + g * g) - math.sqrt(n[i][j])) / alpha * w[i, j]
                    n[i][j] += g * g
    want = [[weight(i, j) for j in range(3)] for i in range(9)]
    assert langid.ftrl(rows, 3, 9) == pytest.approx(np.array(want), abs=1e-12)


def test_no_label_is_lost_to_repeated_rows(spark):
    """A label of one row many times over has one hash; it is learned whatever that is."""
    for text in ("the cat sat", "a dog ran off", "there and then", "one more text"):
        rows = spark.range(30_000).select(F.lit(1).alias("key"), F.lit("en").alias("label"), F.lit(text).alias("text")).union(
            spark.range(2_000).select(F.col("id") + 5, F.lit("de"), F.concat(F.lit("der Hund und die Katze "), F.col("id").cast("string"))))
        took = langid.sample_by_label(rows, 240).groupBy("label").count().collect()
        assert {r["label"]: r["count"] for r in took} == {"en": 120, "de": 120}
    few = spark.createDataFrame([(1, "fr", "le"), (1, "fr", "le"), (2, "fr", "la"), (3, "it", "il")], "key int, label string, text string")
    assert sorted(r["label"] for r in langid.sample_by_label(few, 240).collect()) == ["fr", "fr", "fr", "it"]
    model = langid.fit(rows, max_train_rows=240)
    assert model.labels == ["de", "en"] and model.predict([text, "der Hund"])[0] == ["en", "de"]
