"""Semi-join reduction of the feed's inputs.

Few sets get a document.  Before anything wide is built, the sets that can
have one (searchable, online, available, both legs in stock) are found from
narrow rows; then the product-set rows are reduced to those sets, the products
to those rows, and every other relation to those products or sets.  Each
reduction is a left semi join, which Catalyst pushes below the aggregates and
joins that derive a relation, down to its scan.

The size-level fact is rolled up once per (product, colour) and staged: the
leg gate, the set's stock, the variants' prices and the styles are all
aggregates of that table.  So is the stock per colour, staged as well: where
it is small, its size tells Spark to broadcast it to the product-set rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import exists_in
from ..sources.catalog import Catalog
from .staging import Staging
from .stages import Stages


def sellable(header: DataFrame) -> DataFrame:
    """(set_id) of the searchable, online and available sets."""
    on = [F.col(c) == 1 for c in ("searchable_flag", "online_flag", "available_flag")]
    return header.filter(on[0] & on[1] & on[2]).select("set_id")


class ReducedCatalog(Catalog):
    """The relations of one catalog, reduced to the staged rows ``legs`` and the ``products`` in them."""

    def __init__(self, full: Catalog, legs: DataFrame, products: DataFrame, rollup: DataFrame):
        super().__init__(full.spark, full.source)
        self.kept_products = products
        self.rollup = rollup
        self.__dict__["legs"] = legs

    def _kept(self, relation: DataFrame) -> DataFrame:
        return exists_in(relation, self.kept_products, "product_id")

    @cached_property
    def product(self) -> DataFrame:
        return self._kept(super().product)

    @cached_property
    def product_attribute_value(self) -> DataFrame:
        return self._kept(super().product_attribute_value)

    @cached_property
    def category_product(self) -> DataFrame:
        return self._kept(super().category_product)

    @cached_property
    def style(self) -> DataFrame:
        """The styles are the keys of the rollup."""
        return self._styles(self._kept(self.rollup.select("product_id", "color_id")))

    @cached_property
    def set_category(self) -> DataFrame:
        """From the kept rows: they have the keys of their lines."""
        return self._set_categories(self.with_geo(self.legs, "color_id"), "set_id", "leg_no")


class ReducedStages(Stages):
    """The stages over reduced relations, from staged tables."""

    def __init__(self, full: Stages, store: Staging):
        super().__init__(full.cat, full.as_of, full.brand_code)
        rollup = store.table("sku_rollup", full.sku_rollup)
        self.__dict__["sku_rollup"] = rollup
        self.__dict__["color_stock"] = store.table("color_stock", self.color_stock)
        kept = store.table("kept_sets", exists_in(self.gated_sets.select("set_id"), sellable(full.cat.set_header), "set_id"), by="set_id")
        legs = store.table("legs", exists_in(full.cat.legs, kept, "set_id"), by="set_id")
        products = store.table("kept_products", legs.select("product_id").distinct())
        self.cat = ReducedCatalog(full.cat, legs, products, rollup)
        self.__dict__.pop("leg_stock"), self.__dict__.pop("gated_sets")
        self.__dict__["products"] = store.table("products", self.products, by="set_id")

    @cached_property
    def color_stock(self) -> DataFrame:
        by_color = self.sku_rollup.groupBy("color_id").agg(F.sum("stock_sizes").alias("stock"), F.sum("n_sizes").alias("n"))
        return by_color.filter(F.col("n") > 0).select("color_id", "stock")

    @cached_property
    def gated_rows(self) -> DataFrame:
        """The kept rows are those of gated sets."""
        return self.cat.legs.groupBy("set_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
