"""Applies, table functions, collated keys, named tables and bound parameters."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.apply import apply_function, apply_rows, define_table_function, outer
from tessera.operators.collation import ANY_CASE, ANY_CASE_PADDED, PADDED, collated_join, one_spelling, with_collation
from tessera.plans import queries
from tessera.plans.context import named_tables, stages_for
from tessera.plans.job import brand_lookup, brand_parameter
from tessera.plans.lookups import define_lookups
from tessera.sources.catalog import Catalog
from tessera.sources.tables import SCHEMAS, NamedTables, register_folder


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are where no side is small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


def keyed_only(p):
    return "NestedLoop" not in p and "Cartesian" not in p


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# -- Correlated applies ------------------------------------------------------------------------


def test_applied_sums_equal_the_hand_made_plan(spark, sf_small, no_broadcast):
    st = stages_for(spark, sf_small)
    applied = queries.leg_applies(st).where("vg1_inventory > 0 and vg2_inventory > 0")
    assert keyed_only(plan(applied))
    assert rows(applied) == rows(st.gated_sets.select(*applied.columns))
    one = queries.leg_applies(st).select("set_id", "vg1_inventory")  # one aggregate: one join with the sets
    p = plan(one)
    assert keyed_only(p) and "Window" not in p
    assert one.count() == st.cat.set_header.count()


def test_applied_distinct_is_one_join(spark, sf_small, no_broadcast):
    st = stages_for(spark, sf_small)
    sites = st.cat.set_category.select(F.col("set_id").alias("own"), "site_id").distinct()
    got = apply_rows(st.cat.set_header.select("set_id"), lambda: sites.where(F.col("own") == outer("set_id")).select("site_id"))
    assert keyed_only(plan(got))
    want = st.cat.set_category.select("set_id", "site_id").distinct()
    assert rows(got) == rows(want)


def test_inner_and_outer_apply_of_rows(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(1, 10), (1, 11), (3, 30), (None, 0)], "k2 int, w int")
    inner = right.where(F.col("k2") == outer("k")).select("w")
    assert rows(apply_rows(left, inner)) == [(1, "a", 10), (1, "a", 11)]
    assert rows(apply_rows(left, inner, keep_all=True)) == sorted(
        [(1, "a", 10), (1, "a", 11), (2, "b", None), (2, "b", None), (None, "c", None)], key=str)
    total = right.where(F.col("k2") == outer("k")).select(F.sum("w").alias("s"), F.count("w").alias("n"))
    assert rows(apply_rows(left, total)) == sorted([(1, "a", 21, 2), (2, "b", None, 0), (2, "b", None, 0), (None, "c", None, 0)], key=str)


# -- Table functions ---------------------------------------------------------------------------


def test_table_functions_inner_and_outer(spark):
    urls = spark.createDataFrame([(1, "x", "/1"), (1, "y", "/1y"), (2, "x", None), (2, "x", "/2")], "k long, s string, url string")
    define_table_function(spark, "t_url", {"p_k": "BIGINT", "p_s": "STRING"}, {"url": "STRING"},
                          "SELECT u.url FROM {urls} u WHERE u.k = p_k AND u.s = p_s", urls=urls)
    left = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (None, "x")], "k long, s string")
    inner = apply_function(left, "t_url", "l.k", "l.s")
    assert rows(inner) == sorted([(1, "x", "/1"), (2, "x", None), (2, "x", "/2")], key=str)
    assert rows(apply_function(left, "t_url", "l.k", "l.s", keep_all=True)) == sorted(
        [(1, "x", "/1"), (2, "x", None), (2, "x", "/2"), (3, "x", None), (None, "x", None)], key=str)
    assert rows(apply_function(left, "t_url", "l.k", "'y'")) == [(1, "x", "/1y")]
    define_table_function(spark, "t_url", {"p_k": "BIGINT"}, {"n": "BIGINT"}, "SELECT count(*) FROM {urls} u WHERE u.k = p_k", urls=urls)
    assert rows(apply_function(left, "t_url", "l.k")) == sorted([(1, "x", 2), (2, "x", 2), (3, "x", 0), (None, "x", 0)], key=str)
    assert rows(inner) == sorted([(1, "x", "/1"), (2, "x", None), (2, "x", "/2")], key=str)  # applied before


def test_feed_lookups_join_on_their_keys(spark, sf_small, no_broadcast):
    for name in ("table_function_apply", "category_function_apply"):
        p = plan(queries.REGISTRY[name](spark, sf_small))
        assert keyed_only(p) and "SortMergeJoin" in p, name
    st = stages_for(spark, sf_small)
    define_lookups(st)
    urls = apply_function(st.known_products.select("product_id", "brand_code"), "product_url", "l.product_id", "l.brand_code", keep_all=True)
    want = st.known_products.select("product_id", "brand_code").join(st.cat.product_url, ["product_id", "brand_code"], "left")
    assert rows(urls) == rows(want)


# -- Collated keys -----------------------------------------------------------------------------


def test_collated_join_and_group(spark):
    a = spark.createDataFrame([("Ab", 1), ("AB ", 2), ("é", 3), (None, 4), ("", 5)], "k string, x int")
    b = spark.createDataFrame([("aB", 10), ("ab ", 20), ("É", 30), (None, 40), ("  ", 50)], "k string, y int")
    pairs = lambda c: sorted((r.x, r.y) for r in collated_join(a, b, ["k"], c).collect())
    assert pairs(ANY_CASE) == [(1, 10), (2, 20), (3, 30)]
    assert pairs(PADDED) == [(5, 50)]
    assert pairs(ANY_CASE_PADDED) == [(1, 10), (1, 20), (2, 10), (2, 20), (3, 30), (5, 50)]
    left = collated_join(a, b, ["k"], ANY_CASE, "left_anti").collect()
    assert sorted(r.x for r in left) == [4, 5]
    both = a.select("k").union(b.select("k"))
    got = one_spelling(with_collation(both, ANY_CASE_PADDED, "k").groupBy("k").agg(F.count("*").alias("n")), "k")
    assert {r.k: r.n for r in got.collect()} == {"ab": 4, "é": 2, None: 2, "": 2}
    assert with_collation(both, ANY_CASE, "k").distinct().count() == 6


def test_collated_join_is_keyed(spark, sf_small, no_broadcast):
    p = plan(queries.REGISTRY["collated_join"](spark, sf_small))
    assert keyed_only(p) and "SortMergeJoin" in p and "hashpartitioning" in p


# -- Named tables ------------------------------------------------------------------------------


def test_named_tables_in_two_databases(spark, sf_small):
    names = named_tables(spark, sf_small)
    assert names.name("events").split(".")[0] != names.name("part").split(".")[0]
    by_name, by_folder = Catalog(spark, names), Catalog(spark, sf_small)
    for relation in ("reviews", "promo", "product", "legs", "set_header", "category"):
        assert rows(getattr(by_name, relation)) == rows(getattr(by_folder, relation)), relation
    p = by_name.reviews._jdf.queryExecution().analyzed().toString().lower()
    assert names.name("events") in p
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)" in plan(by_name.reviews)


def test_columns_are_held_against_the_declaration(spark, tmp_path):
    good = spark.createDataFrame([], SCHEMAS["region"])
    good.write.parquet(str(tmp_path / "ok" / "region.parquet"))
    good.select("r_name", "r_regionkey").withColumn("extra", F.lit(1)).write.parquet(str(tmp_path / "more" / "region.parquet"))
    good.select(F.col("r_regionkey").cast("long")).write.parquet(str(tmp_path / "bad" / "region.parquet"))
    try:
        register_folder(spark, str(tmp_path / "ok"), "t_names", ["region"])
        register_folder(spark, str(tmp_path / "more"), "t_more", ["region"])
        assert NamedTables("t_names").read(spark, "region").columns == ["r_regionkey", "r_name"]
        assert NamedTables("t_names", {"region": "t_more.region"}).read(spark, "region").columns == ["r_regionkey", "r_name"]
        with pytest.raises(ValueError, match="r_regionkey is bigint, not int; r_name is missing, not string"):
            register_folder(spark, str(tmp_path / "bad"), "t_bad", ["region"])
        spark.sql(f"CREATE TABLE t_bad.region USING parquet LOCATION '{tmp_path}/bad/region.parquet'")
        with pytest.raises(ValueError, match="t_bad.region differs from the declaration of region"):
            NamedTables("t_bad").read(spark, "region")
    finally:
        for db in ("t_names", "t_more", "t_bad"):
            spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    assert spark.read.parquet(str(tmp_path / "ok" / "region.parquet")).count() == 0  # external: the files stay


# -- Bound parameters --------------------------------------------------------------------------


def test_the_brand_code_is_bound_and_cut(spark, sf_small):
    cat = stages_for(spark, sf_small).cat
    want = rows(cat.brand.filter("brand_code = 'r1'").select("brand_id", "brand_name"))
    assert want and rows(brand_lookup(cat, "r1")) == want == rows(brand_lookup(cat, "r1x"))
    assert brand_lookup(cat, "r' OR 1=1 --").count() == 0 == brand_lookup(cat, "").count()
    assert brand_parameter("r12") == "r1" and brand_parameter("r") == "r"
