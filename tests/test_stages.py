"""Staged relations on a tiny literal catalog, against a brute-force literal join."""

from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera.plans.stages import Stages
from tessera.sources.catalog import Catalog


@pytest.fixture(scope="module")
def tiny(spark):
    cat = Catalog(spark, "unused")
    d = cat.__dict__
    d["legs"] = spark.createDataFrame(
        # set, leg, product, colour
        [(1, 1, 10, 100), (1, 2, 20, 200), (1, 2, 20, 201),
         (2, 1, 10, 100),                      # only leg 1 -> dropped by the gate
         (3, 1, 10, 100), (3, 1, 20, 200), (3, 2, 30, 300),
         (4, 1, 10, 0), (4, 2, 9, 100000)],    # colours 0 and 100000 on adjacent products
        "set_id bigint, leg_no int, product_id bigint, color_id bigint")
    d["product"] = spark.createDataFrame(
        [(9, 1, "T", 1, None), (10, 1, "T", 1, 1), (20, 2, "T", 1, 0), (30, 1, "T", 0, 1)],
        "product_id bigint, brand_id int, classification string, status int, is_international int")
    d["site_product"] = spark.createDataFrame([(9, "S1"), (10, "S1"), (20, "S2"), (30, "S1")], "product_id bigint, site_brand string")
    d["brand"] = spark.createDataFrame([(1, "B1", "s1"), (2, "B2", "s2")],
                                       "brand_id int, brand_name string, brand_code string")
    d["classification"] = spark.createDataFrame([("T",)], "classification string")
    d["style"] = spark.createDataFrame(
        [(10, 100, 1), (20, 200, 1), (20, 201, 1), (30, 300, 1), (40, 100, 1), (10, 0, 1), (9, 100000, 1)],
        "product_id bigint, color_id bigint, status int")
    key = "product_id bigint, color_id bigint, size_no int"
    d["size"] = spark.createDataFrame(
        [(10, 100, 1, 1, Decimal("5.00")), (10, 100, 2, 0, Decimal("6.00")), (20, 200, 1, 1, Decimal("7.00")),
         (20, 201, 1, 1, Decimal("8.00")), (30, 300, 1, 1, Decimal("9.00")), (40, 100, 1, 1, Decimal("1.00")),
         (10, 0, 1, 1, Decimal("2.00")), (9, 100000, 1, 1, Decimal("3.00"))],
        key + ", status int, was_price decimal(10,2)")
    d["inventory"] = spark.createDataFrame(
        [(10, 100, 1, 3, 0), (10, 100, 2, 2, None), (20, 200, 1, 0, 4), (20, 201, 1, 1, 1), (30, 300, 1, 5, 0),
         (40, 100, 1, 2, 2), (10, 0, 1, 7, 0), (9, 100000, 1, 1, 0)],
        key + ", quantity bigint, backorder_quantity bigint")
    d["price"] = spark.createDataFrame(
        [(10, 100, 1, Decimal("10.00"), 1), (10, 100, 1, Decimal("12.00"), 1), (10, 100, 2, Decimal("9.00"), 1),
         (20, 200, 1, Decimal("20.00"), 1), (20, 201, 1, Decimal("21.00"), 0), (30, 300, 1, Decimal("30.00"), 1),
         (40, 100, 1, Decimal("1.00"), 1), (10, 0, 1, Decimal("4.00"), 1), (9, 100000, 1, Decimal("3.00"), 1)],
        key + ", selling_price decimal(10,2), status int")
    d["category_product"] = spark.createDataFrame(
        [(10, "s1", "c1", "true"), (10, "s2", "c2", "true"), (20, "s1", "c3", "true"),
         (20, "s3", "c4", "true"), (20, "s3", "c5", " ")],
        "product_id bigint, site_id string, category_id string, primary_category string")
    tables = {k: [r.asDict() for r in v.collect()] for k, v in d.items() if hasattr(v, "collect")}
    # the size grain of the catalog, from the literal relations by plain loops
    sku = []
    for z in tables["size"]:
        k = _key(z)
        i = next(x for x in tables["inventory"] if _key(x) == k)
        own = [x for x in tables["price"] if _key(x) == k]
        act = [x["selling_price"] for x in own if x["status"] == 1]
        all_ = [x["selling_price"] for x in own]
        style = next(x["status"] for x in tables["style"] if (x["product_id"], x["color_id"]) == k[:2])
        sku.append((*k, z["was_price"], i["quantity"], i["backorder_quantity"], len(own), sum(all_), min(all_), max(all_),
                    len(act), min(act, default=None), max(act, default=None), style, z["status"]))
    d["sku"] = spark.createDataFrame(sku, key + """, was_price decimal(10,2), quantity bigint,
        backorder_quantity bigint, n_prices bigint, sum_price decimal(20,2), min_price decimal(10,2),
        max_price decimal(10,2), n_active bigint, min_active decimal(10,2), max_active decimal(10,2),
        style_status int, size_status int""")
    return Stages(cat), tables


def _key(row):
    return row["product_id"], row["color_id"], row["size_no"]


def _sum(vals):
    vals = [v for v in vals if v is not None]
    return sum(vals) if vals else None


def test_leg_gate_and_set_rollup_match_literal_join(tiny):
    st, t = tiny
    ps, sty, sz, inv, pc = t["legs"], t["style"], t["size"], t["inventory"], t["price"]
    prod = {p["product_id"]: p for p in t["product"]}
    brand = {b["brand_id"]: b for b in t["brand"]}

    def leg(set_id, leg_no):   # colour-only style match, active sizes
        vals = [(i["quantity"] + i["backorder_quantity"]) if i["backorder_quantity"] is not None else None
                for p in ps if p["set_id"] == set_id and p["leg_no"] == leg_no
                for s in sty if s["color_id"] == p["color_id"]
                for z in sz if _key(z)[:2] == (s["product_id"], s["color_id"]) and z["status"] == 1
                for i in inv if _key(i) == _key(z)]
        return _sum(vals) if vals else None

    groups = defaultdict(list)
    for p in ps:
        pr = prod[p["product_id"]]
        if pr["status"] != 1:
            continue
        l1, l2 = leg(p["set_id"], 1), leg(p["set_id"], 2)
        if not (l1 and l1 > 0 and l2 and l2 > 0):
            continue
        for s in sty:
            if s["product_id"] != p["product_id"]:
                continue
            for z in sz:
                if _key(z)[:2] != (s["product_id"], s["color_id"]):
                    continue
                for i in inv:
                    if _key(i) != _key(z):
                        continue
                    for c in pc:
                        if _key(c) == _key(z):
                            u = None if i["backorder_quantity"] is None else i["quantity"] + i["backorder_quantity"]
                            groups[(p["set_id"], brand[pr["brand_id"]]["brand_name"], p["product_id"])].append(
                                (u, c["selling_price"], pr["is_international"]))
    brute = {}
    for k, rows in groups.items():
        inv_sum = _sum([r[0] for r in rows])
        if inv_sum is not None and inv_sum > 0:
            brute[k] = (inv_sum, min(r[1] for r in rows), sum(r[1] for r in rows),
                        "false" if min((r[2] for r in rows if r[2] is not None), default=None) == 0 else "true")
    got = {(r.set_id, r.brand_name, r.product_id):
           (r.inv_availability, r.min_price, r.total_price, r.is_international_set)
           for r in st.sets.collect()}
    assert got == brute
    gated = {p["set_id"] for p in ps if (leg(p["set_id"], 1) or 0) > 0 and (leg(p["set_id"], 2) or 0) > 0}
    assert {r.set_id for r in st.gated_sets.collect()} == gated == {1, 3, 4}   # set 2 has no leg 2


def test_product_rollup_matches_double_left_join(tiny):
    st, t = tiny
    ps, sty, sz, inv, pc, cp = (t["legs"], t["style"], t["size"], t["inventory"], t["price"],
                                t["category_product"])
    prod = {p["product_id"]: p for p in t["product"]}
    brand = {b["brand_id"]: b for b in t["brand"]}
    groups = defaultdict(list)
    for p in ps:
        pr = prod[p["product_id"]]
        if pr["status"] != 1:
            continue
        code = brand[pr["brand_id"]]["brand_code"]
        c1 = [c for c in cp if c["product_id"] == p["product_id"] and c["site_id"] == code
              and c["primary_category"].rstrip() != ""] or [None]
        c2 = [c for c in cp if c["product_id"] == p["product_id"]
              and c["primary_category"].rstrip() != ""] or [None]
        for s in sty:
            if s["product_id"] != p["product_id"] or s["color_id"] != p["color_id"]:
                continue
            for z in sz:
                if _key(z)[:2] != (s["product_id"], s["color_id"]) or z["status"] != 1:
                    continue
                for i in inv:
                    if _key(i) != _key(z):
                        continue
                    for c in pc:
                        if _key(c) != _key(z) or c["status"] != 1:
                            continue
                        for a in c1:
                            for b in c2:
                                cat = a["category_id"] if a else (b["category_id"] if b else None)
                                u = None if i["backorder_quantity"] is None else i["quantity"] + i["backorder_quantity"]
                                groups[(p["set_id"], p["product_id"], cat, f"{p['product_id']}-{p['color_id']}")].append(
                                    (u, c["selling_price"]))
    brute = {}
    for k, rows in groups.items():
        s_ = _sum([r[0] for r in rows])
        if s_ is not None and s_ > 0:
            brute[k] = (s_, min(r[1] for r in rows), max(r[1] for r in rows))
    got = {(r.set_id, r.product_id, r.primary_category, r.variation_group):
           (r.inv_availability, r.min_price, r.max_price) for r in st.products.collect()}
    assert got == brute


def test_stage_grains_on_fixture(spark, sf_small):
    from tessera.plans.context import stages_for
    st = stages_for(spark, sf_small)
    checks = {"sets": ["set_id", "brand_name", "product_id"],
              "products": ["set_id", "product_id", "primary_category", "variation_group"],
              "set_pricing": ["set_id"], "attributes": ["product_id"], "products2": ["product_id"],
              "product_in_stock": ["product_id"], "gated_sets": ["set_id"]}
    for name, keys in checks.items():
        df = getattr(st, name)
        assert df.count() == df.select(*keys).distinct().count(), name


def test_sku_is_the_join_of_its_relations(spark, sf_small):
    cat = Catalog(spark, sf_small)
    key = ["product_id", "color_id", "size_no"]
    act = F.col("price_status") == 1
    price = cat.price.withColumnRenamed("status", "price_status")
    plain = (cat.style.withColumnRenamed("status", "style_status").drop("mf_item_id")
             .join(cat.size.withColumnRenamed("status", "size_status"), key[:2]).join(cat.inventory, key).join(price, key)
             .groupBy(*key, "style_status", "size_status", "was_price", "quantity", "backorder_quantity").agg(
                 F.count("*").alias("n_prices"), F.sum("selling_price").alias("sum_price"),
                 F.min("selling_price").alias("min_price"), F.max("selling_price").alias("max_price"),
                 F.count(F.when(act, 1)).alias("n_active"), F.min(F.when(act, F.col("selling_price"))).alias("min_active"),
                 F.max(F.when(act, F.col("selling_price"))).alias("max_active")))
    sku = cat.sku.select(*plain.columns)
    assert sku.count() == plain.count() and sku.exceptAll(plain).isEmpty()


def _scans(df, table):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.count(f"{table}.parquet")


def test_lineitem_is_scanned_few_times(spark, sf_small):
    from tessera.plans.context import stages_for
    st = stages_for(spark, sf_small)
    assert _scans(st.gated_sets, "lineitem") <= 2
    assert _scans(st.sets, "lineitem") <= 3 and _scans(st.products, "lineitem") <= 3


@pytest.mark.parametrize("name", ["gated_sets", "sets", "products", "product_in_stock"])
def test_a_hot_key_changes_no_result(spark, sf_small, name):
    """A third of all rows on one set, product and colour, without broadcasts: same rows as with them."""
    base = Catalog(spark, sf_small)
    n = base.lineitem.count()
    hot = base.lineitem.limit(1).select(*[c for c in base.lineitem.columns if c not in ("l_linenumber", "l_extendedprice")])
    more = (hot.join(spark.range(n // 2)).withColumn("l_linenumber", (F.col("id") % 6 + 1).cast("int"))
            .withColumn("l_extendedprice", (F.col("id") + 1).cast("double")).drop("id"))
    rows = base.lineitem.unionByName(more).cache()

    def run():
        cat = Catalog(spark, sf_small)
        cat.__dict__["lineitem"] = rows
        return sorted(map(str, getattr(Stages(cat), name).collect()))

    keep = {k: spark.conf.get(k, None) for k in HOT}
    want = run()
    try:
        for k, v in HOT.items():
            spark.conf.set(k, v)
        assert run() == want
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        rows.unpersist()


def test_adaptive_execution_splits_a_hot_join_key(spark):
    """The shape of the fact joins: rows of a hot colour against a table with one row a colour."""
    facts = spark.range(400_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("color_id"),
                                        F.col("id").alias("set_id"))
    stock = spark.range(997).select(F.col("id").alias("color_id"), (F.col("id") + 1).alias("stock"))
    keep = {k: spark.conf.get(k, None) for k in HOT}
    try:
        for k, v in HOT.items():
            spark.conf.set(k, v)
        j = facts.join(stock, "color_id")
        assert j.count() == 400_000
        done = j.groupBy().agg(F.sum("stock"))
        done.collect()
        assert "SortMergeJoin(skew=true)" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


HOT = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
       "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
       "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
       "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}
