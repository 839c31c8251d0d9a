"""Expression edge rows (FIXTURES section 4), asserted exactly."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from tessera.functions.dates import parse_date_text, valid_on
from tessera.functions.flags import all_true_text, iif, positive_flag, true_false_text
from tessera.functions.money import parse_money, range_high, range_low
from tessera.functions.text import (concat_nullable, concat_skip_null, nonblank, product_path,
                                    scalar_or_array)


def _one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_price_range_edges(spark):
    cases = {
        "19.99-29.99": ("19.9900", "29.9900"),
        "19.99": ("19.9900", "19.9900"),
        "10-20-30": ("10.0000", "30.0000"),
        " 7.5 - 8 ": ("7.5000", "8.0000"),
        "$1,234.50": ("1234.5000", "1234.5000"),
        "abc": (None, None),
        "-5": ("-5.0000", "5.0000"),
        "10-": ("10.0000", "0.0000"),
        "": ("0.0000", "0.0000"),
    }
    df = _one_col(spark, list(cases) + [None])
    rows = df.select("x", range_low("x").alias("lo"), range_high("x").alias("hi")).collect()
    got = {r.x: (r.lo, r.hi) for r in rows}
    for text, (lo, hi) in cases.items():
        assert got[text] == (lo and Decimal(lo), hi and Decimal(hi)), text
    assert got[None] == (None, None)


def test_parse_money_shapes(spark):
    want = {"1e2": None, "12.": "12", ".5": "0.5", "1$2": None, "5$": None, "$5": "5", "-$5": "-5", "$-5": "-5", "- $ 5": "-5",
            "1,234.5": "1234.5", "1.2,3": None, ",5": None, "--5": None, "$$5": None, " ": "0", "": "0", "5-": None}
    rows = _one_col(spark, list(want)).select("x", parse_money("x").alias("m")).collect()
    assert {r.x: r.m for r in rows} == {k: v and Decimal(v) for k, v in want.items()}


def test_date_cleaning(spark):
    want = {
        "2024-01-01": (2024, 1, 1), "20240101": (2024, 1, 1), "01/02/2024": (2024, 1, 2), "2024": (2024, 1, 1),
        "2024-01-01 10:30": (2024, 1, 1, 10, 30), "2024-01-01T10:30:05": (2024, 1, 1, 10, 30, 5),
        "01/02/2024 10:30": (2024, 1, 2, 10, 30), "Jan 5 2024": (2024, 1, 5), "Jan 5, 2024": (2024, 1, 5),
        "5 Jan 2024": (2024, 1, 5), "January 15, 2024": (2024, 1, 15), "Jan 15 2024 08:05": (2024, 1, 15, 8, 5),
        "2024/1/5": (2024, 1, 5), "2024.01.05 7:08:09": (2024, 1, 5, 7, 8, 9), "1-5-2024": (2024, 1, 5), "12.31.2024": (2024, 12, 31),
        "20240105 23:59": (2024, 1, 5, 23, 59), "1/5/2024 12:30 AM": (2024, 1, 5, 0, 30), "1/5/2024 12:30PM": (2024, 1, 5, 12, 30),
        "jan 5 2024 3:04pm": (2024, 1, 5, 15, 4), "5 SEPTEMBER, 2024 03:04": (2024, 9, 5, 3, 4), "May 5 2024": (2024, 5, 5),
        "2024-02-29": (2024, 2, 29), "  2024-01-01  ": (2024, 1, 1), "2024-01-01 10:30:05.123456": (2024, 1, 1, 10, 30, 5, 123456),
        "2024-01-01 10:30:05.5": (2024, 1, 1, 10, 30, 5, 500000), "2024 10:30": (2024, 1, 1, 10, 30),
        "2023-02-29": None, "1/5/2024 13:30 PM": None, "1/5/2024 0:30 AM": None, "2024-01-01 24:00": None, "2024-01-01 10:61": None,
        "2024-01-01 10": None, "2024010": None, "202401011": None, "Janet 5 2024": None, "2024-1": None, "on 2024-01-01": None,
        "1/2/24": None, "\x012024\x011\x015": None, "13/45/2024 10:30": None, "0/5/2024": None,
        "junk": None, "n/a": None, "13/45/2024": None, "": None, None: None}
    rows = _one_col(spark, list(want)).select("x", parse_date_text("x").alias("t")).collect()
    assert {r.x: r.t for r in rows} == {k: v and dt.datetime(*v) for k, v in want.items()}


def test_a_date_text_is_read_once(spark):
    df = _one_col(spark, ["2024"]).select(parse_date_text("x").alias("t")).filter("t < current_timestamp()")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") <= 2 and plan.count("try_make_timestamp") <= 2  # the value and the filter


def test_validity_interval_at_tomorrow(spark):
    # as_of 2024-01-15 -> tomorrow midnight 2024-01-16
    cases = [((None, None), True), ((None, "2024-01-16"), True), ((None, "2024-01-15"), False),
             (("2024-01-15", None), True), (("2024-01-16", None), False)]
    df = spark.createDataFrame([(a, b) for (a, b), _ in cases], "f string, t string")
    df = df.select(parse_date_text("f").alias("f"), parse_date_text("t").alias("t"))
    got = [r.ok for r in df.select(valid_on("f", "t", "2024-01-15").alias("ok")).collect()]
    assert got == [ok for _, ok in cases]


def test_visibility_and_online_defaults(spark):
    df = spark.createDataFrame([(None, "true"), (1, "true"), (0, None), (0, "true")],
                               "h int, o string")
    vis = (F.coalesce(F.col("h"), F.lit(0)) == 0) & (F.coalesce(F.col("o"), F.lit("false")) == "true")
    assert [r.v for r in df.select(vis.alias("v")).collect()] == [True, False, False, True]


def test_nonblank(spark):
    df = _one_col(spark, [None, "", "  ", "true", " x"])
    got = [r.v for r in df.select(nonblank("x").alias("v")).collect()]
    assert got == [None, False, False, True, True]


def test_all_true_text(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (2, 0), (3, 1), (3, None), (4, None)],
                               "g int, b int")
    got = dict(df.groupBy("g").agg(all_true_text("b").alias("t")).collect())
    assert got == {1: "true", 2: "false", 3: "true", 4: "true"}


def test_flags_and_iif(spark):
    df = spark.createDataFrame([(5,), (0,), (None,), (1,)], "x int")
    out = df.select(positive_flag("x").alias("p"), true_false_text("x").alias("t"),
                    iif(F.col("x") > 0, F.lit("a"), F.lit("b")).alias("i")).collect()
    assert [(r.p, r.t, r.i) for r in out] == [(True, "false", "a"), (False, "false", "b"),
                                              (False, "false", "b"), (True, "true", "a")]


def test_concat_null_rules(spark):
    df = _one_col(spark, ["a", None])
    out = df.select(concat_nullable(F.lit("/p/"), "x").alias("plus"),
                    concat_skip_null(F.lit('"'), "x", F.lit('"')).alias("fn")).collect()
    assert [(r.plus, r.fn) for r in out] == [("/p/a", '"a"'), (None, '""')]


def test_product_path(spark):
    df = spark.createDataFrame([(12,)], "x bigint")
    assert df.select(product_path("x").alias("p")).first().p == "/products/12"


def test_scalar_or_array_json(spark):
    df = _one_col(spark, ["tankini", 'bikini|one "piece"', None])
    out = [r.j for r in df.select(F.to_json(F.struct(scalar_or_array("x").alias("k"))).alias("j"))
           .collect()]
    assert [json.loads(o) for o in out] == [{"k": "tankini"}, {"k": ["bikini", 'one "piece"']}, {}]
