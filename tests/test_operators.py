"""Operators on tiny literal frames, checked against brute force."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators.aggregates import eav_pivot, string_agg
from tessera.operators.hierarchy import jumps, walk_to_root
from tessera.operators.joins import exists_in, fallback_lookup, left_join_on, top1_per_key
from tessera.operators.nested import collect_ordered, keyed_object, nonempty


def test_top1_per_key_total_order(spark):
    df = spark.createDataFrame([(1, 2, 9, "b"), (1, 1, 9, "a"), (1, 1, 3, "c"), (2, 5, 1, "z")],
                               "k int, a int, b int, v string")
    got = {r.k: r.v for r in top1_per_key(df, ["k"], ["a", "b"], ["v"]).collect()}
    assert got == {1: "c", 2: "z"}


def test_fallback_lookup_matches_double_left_join(spark):
    left = spark.createDataFrame([(1, "s1"), (2, "s1"), (3, "s1"), (4, "s2"), (1, "s1"),    # a repeated left row
                                  (5, "s1"), (6, "s1"), (6, None), (None, "s1")], "pid int, site string")
    right = spark.createDataFrame(
        [(1, "s1", "c1", "t"), (1, "s2", "c2", "t"), (1, "s2", "c3", "t"),   # own site wins
         (2, "s2", "c4", "t"), (2, "s3", "c5", "t"),                         # no own site: two rows
         (2, "s2", "c6", " "),                                               # blank: ignored
         (4, "s2", "c7", "t"), (4, "s2", "c7", "t"),                         # duplicates count
         (5, "s1", None, "t"), (5, "s2", "c8", "t"), (5, "s1", "c9", "t"),   # own site without a value
         (6, "s1", None, "t"), (6, None, "c1", "t"), (None, "s1", "c1", "t")],
        "pid int, site_id string, cat string, flag string")
    out = fallback_lookup(left, right, key="pid", prefer=("site", "site_id"), value="cat",
                          out="pc", right_filter=F.rtrim("flag") != "")
    got = Counter({(r.pid, r.site, r.pc): r.mult for r in out.collect()})
    # brute force: literal double left join
    lrows, rrows = left.collect(), [r for r in right.collect() if r.flag.rstrip() != ""]
    brute = Counter()
    for l in lrows:
        r1 = [r for r in rrows if l.pid is not None and r.pid == l.pid and l.site is not None and r.site_id == l.site] or [None]
        r2 = [r for r in rrows if l.pid is not None and r.pid == l.pid] or [None]
        for a in r1:
            for b in r2:
                own = a.cat if a else None
                brute[(l.pid, l.site, own if own is not None else (b.cat if b else None))] += 1
    assert got == brute


def test_left_join_residual_keeps_left_rows(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(1, 5), (1, 50)], "k int, v int")
    out = left_join_on(a, b, ["k"], b["v"] > 10).collect()
    assert sorted((r.k, r.v) for r in out) == [(1, 50), (2, None)]


def test_exists_in_never_multiplies(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(1,), (1,), (1,)], "k int")
    assert [r.k for r in exists_in(a, b, "k").collect()] == [1]


def test_keyed_object_dedupes_and_drops_null_keys(spark):
    df = spark.createDataFrame([(1, "b", 2, "x"), (1, "a", 1, "y"), (1, "a", 0, "z"), (1, None, 0, "n")],
                               "s int, k string, o int, v string")
    out = keyed_object(df, ["s"], "k", ["o"], F.struct("v"), "m")
    row = out.select(F.to_json("m").alias("j")).first()
    assert row.j == '{"a":{"v":"z"},"b":{"v":"x"}}'


def test_collect_ordered_descending_nulls_last(spark):
    df = spark.createDataFrame([(1, "", "c1"), (1, "true", "c9"), (1, None, "c0"), (1, "true", "c2")],
                               "s int, p string, c string")
    out = collect_ordered(df, ["s"], [(F.col("p"), True), F.col("c")], F.col("c"), "arr").first()
    assert out.arr == ["c2", "c9", "c1", "c0"]


def test_nonempty(spark):
    df = spark.createDataFrame([([1],), ([],)], "a array<int>")
    assert [r.a for r in df.select(nonempty("a").alias("a")).collect()] == [[1], None]


def test_string_agg_sorted_and_distinct(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (2, "z")], "k int, v string")
    assert dict(string_agg(df, ["k"], "v").collect()) == {1: "a|b|b", 2: "z"}
    assert dict(string_agg(df, ["k"], "v", distinct=True).collect()) == {1: "a|b", 2: "z"}


def test_eav_pivot_ignores_unlisted_but_keeps_entity(spark):
    df = spark.createDataFrame([(1, "color", "red"), (1, "size", "m"), (2, "other", "x")],
                               "id int, name string, v string")
    out = {r.id: r for r in eav_pivot(df, "id", "name", "v", ["color", "rod-type"]).collect()}
    assert out[1]["color"] == "red" and out[1]["rod-type"] is None
    assert out[2]["color"] is None  # only unlisted names: row kept, all NULL


def test_walk_to_root(spark):
    nodes = spark.createDataFrame([("root", None, "R"), ("a", "root", "A"), ("b", "a", "B")],
                                  "category_id string, parent_id string, display_name string")
    w = walk_to_root(spark, nodes)
    got = sorted((r.node_id, r.depth, r.ancestor_id) for r in w.collect())
    assert ("b", 2, "root") in got and ("b", 0, "b") in got and ("root", 0, "root") in got
    assert len([g for g in got if g[0] == "b"]) == 3


def _nodes(spark, pairs):
    return spark.createDataFrame([(a, b, a) for a, b in pairs], "category_id string, parent_id string, display_name string")


def test_walk_goes_as_deep_as_the_tree(spark):
    chain = [(f"n{i}", f"n{i - 1}" if i else None) for i in range(130)]
    got = {r.ancestor_id for r in walk_to_root(spark, _nodes(spark, chain)).filter("node_id = 'n129'").collect()}
    assert got == {f"n{i}" for i in range(130)}


def test_walk_raises_on_a_cycle(spark):
    with pytest.raises(Exception, match="cycle in the hierarchy"):
        walk_to_root(spark, _nodes(spark, [("a", "b"), ("b", "a"), ("c", "a")])).collect()


def test_walk_beyond_a_million_pairs(spark):
    flat = spark.range(600_000).select(F.col("id").cast("string").alias("category_id"),
                                       F.when(F.col("id") > 0, "0").alias("parent_id"), F.lit("x").alias("display_name"))
    assert walk_to_root(spark, flat).count() == 2 * 600_000 - 1


def test_walk_of_a_long_chain_takes_few_rounds_and_no_session_setting(spark):
    before = {r.key: r.value for r in spark.sql("SET").collect()}
    chain = [(f"n{i}", f"n{i - 1}" if i else None) for i in range(1000)]
    steps = jumps(_nodes(spark, chain).filter("parent_id is not null").select(
        F.col("category_id").alias("node"), F.col("parent_id").alias("up")), 1000)
    assert len(steps) == 10 and [s.count() for s in steps[:3]] == [999, 998, 996]
    walk = walk_to_root(spark, _nodes(spark, chain))
    got = walk.filter("node_id = 'n999'").agg(F.count("*"), F.max("depth"), F.countDistinct("ancestor_id")).first()
    assert tuple(got) == (1000, 999, 1000)
    assert {r.key: r.value for r in spark.sql("SET").collect()} == before


def test_walk_of_odd_nodes(spark):
    rows = [("a", None, "A"), ("a", None, "A"), ("b", "nowhere", "B"), ("c", "b", None), (None, "a", "N"), ("d", "c", "D")]
    walk = walk_to_root(spark, spark.createDataFrame(rows, "category_id string, parent_id string, display_name string"))
    got = sorted((r.node_id, r.depth, r.ancestor_id, r.ancestor_name or "") for r in walk.collect())
    assert got == [("a", 0, "a", "A"), ("b", 0, "b", "B"), ("c", 0, "c", ""), ("c", 1, "b", "B"),
                   ("d", 0, "d", "D"), ("d", 1, "c", ""), ("d", 2, "b", "B")]
    empty = spark.createDataFrame([], "category_id string, parent_id string, display_name string")
    assert walk_to_root(spark, empty).count() == 0
    for loop in ([("x", "x")], [("r", None), ("x", "y"), ("y", "z"), ("z", "x")]):
        with pytest.raises(ValueError, match="cycle in the hierarchy"):
            walk_to_root(spark, _nodes(spark, loop))
