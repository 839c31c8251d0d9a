"""Product-set rows are dealt by a key to as many tasks as their number asks for."""

import re

import pytest
from pyspark.sql import functions as F

from tessera.plans.stages import Stages
from tessera.sources import catalog
from tessera.sources.tables import SCHEMAS

LINES = 3_000


class Tables(catalog.Catalog):
    """Tables made here, not read."""

    def __init__(self, spark, **tables):
        super().__init__(spark, "nowhere")
        self.tables = tables

    def table(self, name):
        return self.tables[name]


def rows(spark, name, n, **columns):
    """n rows of a table: the columns given as expressions of ``id``, the others null."""
    wanted = dict(x.split(" ") for x in SCHEMAS[name].split(", "))
    return spark.range(n).select(*[F.expr(columns.get(c, "null")).cast(t).alias(c) for c, t in wanted.items()])


@pytest.fixture
def cat(spark, monkeypatch):
    monkeypatch.setattr(catalog, "LINES_PER_TASK", 100, raising=False)
    line = rows(spark, "lineitem", LINES, l_orderkey="id div 4", l_partkey="id * 7 % 200", l_suppkey="id * 13 % 50",
                l_linenumber="id % 4 + 1", l_quantity="id % 9", l_extendedprice="id % 700 + 1", l_discount="0.01", l_returnflag="'A'")
    part = rows(spark, "part", 200, p_partkey="id", p_name="'n'", p_brand="concat('Brand#', id % 4 + 11)", p_type="'STEEL'", p_size="id % 9 + 1")
    return Tables(spark, lineitem=line, part=part, supplier=rows(spark, "supplier", 50, s_suppkey="id", s_nationkey="id % 6"),
                  nation=rows(spark, "nation", 6, n_nationkey="id", n_name="'n'", n_regionkey="id % 2"))


@pytest.mark.parametrize("relation", ["legs", "product_legs", "sku", "style", "size", "price", "inventory", "category_product", "set_category",
                                      "set_price_text"])
def test_a_relation_of_lines_is_grouped_in_tasks_by_their_number(cat, relation):
    plan = getattr(cat, relation)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\((.*?), (\d+)\), (\w+)", plan)
    assert cat.line_tasks == LINES // 100 and [n for _, n, why in dealt if why == "REPARTITION_BY_NUM"] == ["30"]
    assert not re.search(r"partial|HashAggregate", plan[plan.index("REPARTITION_BY_NUM"):])  # nothing is held before


def test_products_and_prices_of_dealt_lines(cat):
    st = Stages(cat)
    legs = {(r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey) for r in cat.lineitem.collect()}
    assert {tuple(r) for r in cat.legs.collect()} == legs == {tuple(r) for r in cat.product_legs.collect()}
    lowest = {}
    for r in cat.lineitem.collect():
        key = r.l_partkey, r.l_suppkey
        lowest[key] = min(lowest.get(key, 1e9), r.l_extendedprice)
    got = {(r.product_id, r.color_id): r.min_all for r in st.sku_rollup.collect()}
    assert {k: float(v) for k, v in got.items()} == lowest
    plan = st.products._jdf.queryExecution().executedPlan().toString()
    # legs and sizes meet where they were dealt; what comes of them is dealt by product
    assert len(re.findall(r"Exchange hashpartitioning\(l_partkey#\d+L, l_suppkey#\d+L, 30\), REPARTITION_BY_NUM", plan)) == 2
    assert not re.search(r"Exchange hashpartitioning\(product_id#\d+L, color_id#\d+L,", plan)
    assert re.search(r"Exchange hashpartitioning\(product_id#\d+L, 30\), REPARTITION_BY_NUM", plan)
