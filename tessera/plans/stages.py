"""The staged relations of the feed job, as lazy DataFrames.

Each property is one intermediate result of the batch job (sets with their
leg gates, products with their price rollup, set pricing, promo price
ranges, pivoted attributes, merchandise ids, cleaned categories).

Plan shape, chosen for a 1000-executor run:

* **Aggregate before joining.**  The size-level fact (style x size x
  inventory x price) is rolled up per product (or per product and colour)
  *before* it meets the product-set rows.  Joining first would pair every
  set row with every size of its product; rolling up first keeps one row
  per product.  SUM/MIN/MAX distribute over the join exactly: a set row
  that matched ``n`` product-set rows contributes ``n`` times the product
  sum, and MIN/MAX ignore repetition.
* **No pair explosion.**  The category fallback (own site first, else any
  site) is counted per key instead of joining candidates to candidates
  (see ``fallback_lookup``).
* **Partial aggregation everywhere.**  All rollups are SUM/MIN/MAX/COUNT or
  ``row_number`` top-1s with a partial limit, all reduced map-side; a product or colour holding a
  third of all rows is pre-reduced in every map task before the shuffle.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import parse_date_text, valid_on
from ..functions.money import range_high, range_low
from ..functions.text import nonblank
from ..operators.aggregates import eav_pivot, string_agg
from ..operators.joins import exists_in, fallback_lookup
from ..sources.catalog import PIVOT_NAMES, Catalog

DEC2 = "decimal(10,2)"
SUM_DEC = "decimal(38,2)"

# Published key for each pivoted name whose key differs from the name.
OUTPUT_KEY_RENAMES = {
    "capacity": "capacity_",
    "fabric_/_material": "fabric_material",
    "height": "height_",
    "rod-type": "rod_type",
    "width": "width_",
}


def output_key(name: str) -> str:
    return OUTPUT_KEY_RENAMES.get(name, name)


class Stages:
    """Staged relations over one catalog, run date and brand code."""

    def __init__(self, catalog: Catalog, as_of="2024-01-15", brand_code: str = "r1"):
        self.cat = catalog
        self.as_of = as_of
        self.brand_code = brand_code

    # -- categories ------------------------------------------------------------
    @cached_property
    def categories(self) -> DataFrame:
        """Categories with non-date bound texts set to NULL (keys compare case-sensitively)."""
        c = self.cat.category.select(
            "category_id", "parent_id", "display_name", "online_flag", "online_from", "online_to",
            "is_hidden", parse_date_text("online_from").alias("online_from_ts"),
            parse_date_text("online_to").alias("online_to_ts"))
        return c.select(
            "category_id", "parent_id", "display_name", "online_flag",
            F.when(F.col("online_from_ts").isNotNull(), F.col("online_from")).alias("online_from"),
            F.when(F.col("online_to_ts").isNotNull(), F.col("online_to")).alias("online_to"),
            "is_hidden", "online_from_ts", "online_to_ts")

    @cached_property
    def live_categories(self) -> DataFrame:
        """Visible, online categories whose validity interval covers the next midnight."""
        c = self.categories
        return c.filter((F.coalesce(F.col("is_hidden"), F.lit(0)) == 0)
                        & (F.coalesce(F.col("online_flag"), F.lit("false")) == "true")
                        & valid_on("online_from_ts", "online_to_ts", self.as_of))

    # -- products ----------------------------------------------------------------
    @cached_property
    def known_products(self) -> DataFrame:
        """Products whose brand and classification exist (inner-join existence)."""
        p = self.cat.product
        p = exists_in(p, self.cat.classification, "classification")
        return p.join(self.cat.brand, "brand_id")

    @cached_property
    def active_products(self) -> DataFrame:
        return self.known_products.filter(F.col("status") == 1)

    # -- stock and prices ---------------------------------------------------------------
    @cached_property
    def color_stock(self) -> DataFrame:
        """Per colour: units (on hand + back order) over active sizes of every style in it."""
        return (self.cat.sku.filter(F.col("size_status") == 1)
                .groupBy("color_id")
                .agg(F.sum(F.col("quantity") + F.col("backorder_quantity")).alias("stock")))

    @cached_property
    def sku_rollup(self) -> DataFrame:
        """Per (product, colour): every size-price rollup the feed needs, from one pass over the sizes.

        A size counts once for each of its price rows, as in the join; each
        rollup keeps its own row filter as a conditional aggregate, and a
        count of qualifying rows tells whether its inner join would have
        produced the group at all.
        """
        units = F.col("quantity") + F.col("backorder_quantity")
        active = (F.col("size_status") == 1) & (F.col("n_active") > 0)
        stocked = active & (F.col("style_status") == 1) & (units > 0)
        return self.cat.sku.groupBy("product_id", "color_id").agg(
            F.sum(units * F.col("n_prices")).alias("stock_all"), F.min("min_price").alias("min_all"),
            F.max("max_price").alias("max_all"), F.sum("sum_price").alias("sum_all"),
            F.sum("n_prices").alias("n_all"),
            F.coalesce(F.sum(F.when(active, F.col("n_active"))), F.lit(0)).alias("n_active"),
            F.sum(F.when(active, units * F.col("n_active"))).alias("stock_active"),
            F.min(F.when(active, F.col("min_active"))).alias("min_active"),
            F.max(F.when(active, F.col("max_active"))).alias("max_active"),
            F.coalesce(F.sum(F.when(stocked, F.col("n_active"))), F.lit(0)).alias("n_stocked"),
            F.max(F.when(stocked, F.col("was_price"))).alias("was_high"),
            F.min(F.when(stocked, F.col("was_price"))).alias("was_low"),
            F.max(F.when(stocked, F.col("max_active"))).alias("sale_high"),
            F.min(F.when(stocked, F.col("min_active"))).alias("sale_low"),
            F.sum(F.when(stocked, F.col("quantity") * F.col("n_active"))).alias("qty_stocked"),
            F.sum(F.when(F.col("size_status") == 1, units)).alias("stock_sizes"),
            F.count(F.when(F.col("size_status") == 1, 1)).alias("n_sizes"))

    # -- leg gates ------------------------------------------------------------------
    @cached_property
    def leg_stock(self) -> DataFrame:
        """Per set: stock behind leg 1 and leg 2 (NULL when the leg has none)."""
        j = self.cat.legs.filter(F.col("leg_no").isin(1, 2)).join(self.color_stock, "color_id")
        return j.groupBy("set_id").agg(*self._leg_sums("vg1_inventory", "vg2_inventory"))

    @staticmethod
    def _leg_sums(one: str, two: str) -> list:
        return [F.sum(F.when(F.col("leg_no") == leg, F.col("stock"))).alias(name)
                for leg, name in ((1, one), (2, two))]

    @cached_property
    def gated_sets(self) -> DataFrame:
        return self.leg_stock.filter((F.col("vg1_inventory") > 0) & (F.col("vg2_inventory") > 0))

    # -- set rollup (one row per set and child product) -------------------------------
    @cached_property
    def product_stock(self) -> DataFrame:
        """Per product: units, lowest and total selling price over all its size-price rows."""
        return self.sku_rollup.groupBy("product_id").agg(
            F.sum("stock_all").alias("stock"), F.min("min_all").alias("min_price"),
            F.sum("sum_all").alias("sum_price"))

    @cached_property
    def gated_rows(self) -> DataFrame:
        """(set, product, n): rows of each product in the sets whose legs 1 and 2 both have stock.

        The legs are read once: their rows are counted and their stock summed
        per (set, product); a window over a set's few rows adds up its legs.
        """
        rows = (self.cat.legs.join(self.color_stock, "color_id", "left").groupBy("set_id", "product_id")
                .agg(F.count(F.lit(1)).alias("n"), *self._leg_sums("v1", "v2")))
        w = Window.partitionBy("set_id")
        return (rows.withColumns({"g1": F.sum("v1").over(w), "g2": F.sum("v2").over(w)})
                .filter((F.col("g1") > 0) & (F.col("g2") > 0)).select("set_id", "product_id", "n"))

    @cached_property
    def sets(self) -> DataFrame:
        """Sets passing both leg gates, per child product: stock, min/total price, international."""
        prod = exists_in(self.active_products.select("product_id", "brand_name", "is_international"),
                         self.cat.site_product.select("product_id"), "product_id")
        j = self.gated_rows.join(prod, "product_id").join(self.product_stock, "product_id")
        n = F.col("n")
        return j.select(
            (n * F.col("stock")).alias("inv_availability"),
            F.col("min_price"),
            (n * F.col("sum_price")).cast(SUM_DEC).alias("total_price"),
            F.when(F.col("is_international") == 0, "false").otherwise("true")
            .alias("is_international_set"),
            "set_id", "brand_name", "product_id",
        ).filter(F.col("inv_availability") > 0)

    # -- product rollup (per set, product, primary category, variation group) -----------
    @cached_property
    def sku_by_product_color(self) -> DataFrame:
        """Per (product, colour): units and price range over active sizes with active prices."""
        return (self.sku_rollup.filter(F.col("n_active") > 0)
                .select("product_id", "color_id", F.col("stock_active").alias("stock"),
                        F.col("min_active").alias("min_price"),
                        F.col("max_active").alias("max_price")))

    @cached_property
    def product_category(self) -> DataFrame:
        """Per active product: primary category (own site first, else any site) and multiplicity."""
        left = self.active_products.select("product_id", "brand_code").join(
            self.cat.site_product.withColumnRenamed("site_brand", "brand_name"), "product_id")
        return fallback_lookup(left, self.cat.category_product, key="product_id",
                               prefer=("brand_code", "site_id"), value="category_id",
                               out="primary_category",
                               right_filter=nonblank("primary_category"))

    @cached_property
    def products(self) -> DataFrame:
        """Set x product x primary category x variation group: stock, min and max price."""
        n_rows = (self.cat.product_legs.groupBy("set_id", "product_id", "color_id")
                  .agg(F.count(F.lit(1)).alias("n"))
                  .withColumn("variation_group", F.concat_ws("-", "product_id", "color_id")))
        j = (n_rows.join(self.sku_by_product_color, ["product_id", "color_id"])
             .repartition(self.cat.line_tasks, "product_id").join(self.product_category, "product_id"))
        units = F.col("n") * F.col("mult") * F.col("stock")
        g = j.groupBy("set_id", "product_id", "primary_category", "brand_name",
                      "variation_group").agg(
            F.sum(units).alias("inv_availability"),
            F.min("min_price").alias("min_price"),
            F.max("max_price").alias("max_price"))
        return g.filter(F.col("inv_availability") > 0)

    @cached_property
    def set_pricing(self) -> DataFrame:
        """Sum of per-row minimum prices per set, literally (one term per category row)."""
        return (self.products.groupBy("set_id")
                .agg(F.sum("min_price").cast(SUM_DEC).alias("sale_price")))

    @cached_property
    def set_pricing_dedup(self) -> DataFrame:
        """Sum of one minimum price per (set, product, variation group)."""
        one = (self.products.groupBy("set_id", "product_id", "variation_group")
               .agg(F.min("min_price").alias("min_price")))
        return one.groupBy("set_id").agg(F.sum("min_price").cast(SUM_DEC).alias("sale_price"))

    # -- promo price ranges --------------------------------------------------------------
    @cached_property
    def promo_prices(self) -> DataFrame:
        ps = self.cat.set_price_text.distinct()
        return ps.select(
            "set_id", "list_price", "sale_price",
            range_low("list_price").alias("list_price_low"),
            range_high("list_price").alias("list_price_high"),
            range_low("sale_price").alias("sale_price_low"),
            range_high("sale_price").alias("sale_price_high"))

    # -- attributes -------------------------------------------------------------------------
    @cached_property
    def attribute_text(self) -> DataFrame:
        """Per (product, attribute name): active values joined by '|' (display value first)."""
        av = (self.cat.product_attribute_value.filter(F.col("status") == 1)
              .join(self.cat.attribute, "attribute_id").join(self.cat.attribute_value, "value_id"))
        return string_agg(av, ["product_id", "name"],
                          F.coalesce(F.col("display_value"), F.col("attribute_value")),
                          alias="attribute_value")

    @cached_property
    def attributes(self) -> DataFrame:
        """One row per product with any active attribute, one column per listed name."""
        return eav_pivot(self.attribute_text, "product_id", "name", "attribute_value",
                         PIVOT_NAMES)

    @cached_property
    def products2(self) -> DataFrame:
        """Per active product: its distinct merchandise ids joined by '|'."""
        st = self.cat.style.select("mf_item_id", "product_id")
        act = self.cat.product.filter(F.col("status") == 1).select("product_id")
        d = exists_in(st, act, "product_id")
        return string_agg(d, ["product_id"], "mf_item_id", distinct=True, alias="mf_item_id")

    # -- in-stock existence --------------------------------------------------------------------
    @cached_property
    def product_in_stock(self) -> DataFrame:
        """Per product with at least one active, stocked size-price: price and stock rollup."""
        return (self.sku_rollup.filter(F.col("n_stocked") > 0).groupBy("product_id").agg(
            F.max("was_high").alias("item_listpricehigh"),
            F.min("was_low").alias("item_listpricelow"),
            F.max("sale_high").alias("item_salepricehigh"),
            F.min("sale_low").alias("item_salepricelow"),
            F.sum("qty_stocked").alias("inventory")))
