"""The feed's input relations, derived from the driver's TPC-H-like tables.

Each property stands for one source relation of the catalog feed (product
sets, products, styles, sizes, inventory, prices, categories, ...).  The
mapping is the one in FIXTURES.md section 3; columns marked *extra* below
are our additions for fields the feed reads but FIXTURES does not define.

Everything is lazy: a property returns a DataFrame plan and is cached on the
instance.  Nothing is persisted.

Scale notes (1000 executors, lineitem ~ 600 billion rows):
* keys are natural: a style is (product, colour), a size (product, colour,
  size number).  No key is computed from others, so none can collide.
* ``legs`` has the keys of the product-set rows only; set columns and price
  texts are relations of their own, joined where they are read.
* ``sku`` is the size grain with its stock, style status and price summary in
  one pass over lineitem.
* The product-set rows are dealt by a key (the set, style, size or product) before
  they are grouped, to as many tasks as their number asks for (``line_tasks``).
  All that is grouped by more keys is grouped where it is, and what a task
  holds does not grow with the input.
* Joins are left to AQE, which turns one into a broadcast only when the
  runtime size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import NamedTables, read_table

DEC2 = "decimal(10,2)"
SIZE_KEY = ["product_id", "color_id", "size_no"]
#: The keys of a style and of a size as lineitem names them.
STYLE_LINE = ["l_partkey", "l_suppkey"]
SIZE_LINE = [*STYLE_LINE, "l_linenumber"]

#: Product-set rows dealt to one task: a hash map or a sort of them takes a page or two of 64 MB.
LINES_PER_TASK = 250_000

# The attribute names that the feed pivots into columns, in source order.
PIVOT_NAMES = (
    "application", "beauty_concern", "beauty_hair_type", "beauty_scent", "body_shape",
    "bottom_fit", "bra_lining", "bra_support_level", "capacity", "care", "coat_weight",
    "comfort_level", "construction", "coverage", "fabric", "fabric_/_material", "features",
    "fill_material", "fit", "heel_height", "height", "included", "item_type", "length",
    "light_count", "light_filtration", "lighting_color", "lighting_type", "material",
    "multi_packs", "neckline", "occasion", "pillow_type", "product_thickness", "purpose",
    "rod-type", "room", "sets", "shape", "sheet_type", "shorts_inseam", "sleep_position",
    "sleeve_length", "sleeve_shape", "style", "swim_coverage", "theme", "thread_count",
    "towel-type", "voltage", "weight", "width", "window_style", "wreath_size",
)


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


class Catalog:
    """Lazy source relations over one folder of tables, or over named tables (``NamedTables``)."""

    def __init__(self, spark: SparkSession, source: str | NamedTables):
        self.spark = spark
        self.source = source

    def table(self, name: str) -> DataFrame:
        if isinstance(self.source, NamedTables):
            return self.source.read(self.spark, name)
        return read_table(self.spark, self.source, name)

    # -- raw tables -------------------------------------------------------
    @cached_property
    def lineitem(self) -> DataFrame:
        return self.table("lineitem")

    @cached_property
    def line_tasks(self) -> int:
        """Tasks that the product-set rows are dealt to."""
        given = self._given_legs()
        rows = self.lineitem if given is None else given  # Parquet has their number in the files' footers
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // LINES_PER_TASK))

    def dealt(self, rows: DataFrame, *keys: str) -> DataFrame:
        """Rows of lineitem, those of a key in one task."""
        return rows.repartition(self.line_tasks, *keys)

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders")

    @cached_property
    def part(self) -> DataFrame:
        return self.table("part")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    def with_geo(self, rows: DataFrame, supplier_key: str) -> DataFrame:
        """Rows with their supplier's nation and region; the suppliers are joined first, as a table whose size is known."""
        nation = self.table("nation").select("n_nationkey", "n_regionkey")
        supplier = self.table("supplier").select("s_suppkey", "s_nationkey")
        return (rows.join(supplier, F.col(supplier_key) == F.col("s_suppkey"))
                .join(nation, F.col("s_nationkey") == F.col("n_nationkey")).drop("s_nationkey"))

    @cached_property
    def line_geo(self) -> DataFrame:
        """lineitem rows with the supplier's nation and region attached."""
        return self.with_geo(self.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"), "l_suppkey")

    # -- products, brands --------------------------------------------------
    @cached_property
    def product(self) -> DataFrame:
        """The master product.  extra: description, pcm_brand, customer review columns."""
        p = self.part
        size = F.col("p_size")
        return p.select(
            F.col("p_partkey").alias("product_id"),
            F.substring("p_brand", 7, 100).cast("int").alias("brand_id"),
            F.col("p_type").alias("classification"),
            F.when(size % 10 == 0, 0).otherwise(1).alias("status"),
            F.when(size % 17 == 3, F.lit(None)).when(size <= 40, 1).otherwise(0).alias("is_international"),
            F.col("p_name").alias("title"),
            F.col("p_retailprice").cast(DEC2).alias("retail_price"),
            F.col("p_type").alias("description"),
            F.col("p_brand").alias("pcm_brand"),
            size.alias("customer_review_count"),
            ((F.col("p_partkey") % 50) / F.lit(10)).cast("decimal(3,1)")
            .alias("customer_review_average"),
        )

    @cached_property
    def site_product(self) -> DataFrame:
        """The storefront's product: not every master product is on the site."""
        return (self.part.filter(F.col("p_partkey") % 31 != 7)
                .select(F.col("p_partkey").alias("product_id"), F.upper("p_brand").alias("site_brand")))

    @cached_property
    def product_price(self) -> DataFrame:
        """Products with a published price: the variants' existence join reads no more of it."""
        return self.part.filter(F.col("p_partkey") % 23 != 0).select(F.col("p_partkey").alias("product_id"))

    @cached_property
    def brand(self) -> DataFrame:
        """The brand dimension; some brands of products are missing."""
        bid = F.substring("p_brand", 7, 100).cast("int")
        return (self.part.filter(bid % 12 != 5).select(
            bid.alias("brand_id"),
            F.col("p_brand").alias("brand_name"),
            F.concat(F.lit("r"), _s(bid % 5)).alias("brand_code"),
        ).distinct())

    @cached_property
    def classification(self) -> DataFrame:
        """The classification dimension (extra): part types, some of them missing."""
        return (self.part.filter(F.length("p_type") % 9 != 6)
                .select(F.col("p_type").alias("classification")).distinct())

    # -- product sets ------------------------------------------------------
    @cached_property
    def legs(self) -> DataFrame:
        """The keys of the product-set rows, dealt by set: (set, leg, product, colour)."""
        return self._line_legs

    @cached_property
    def _line_legs(self) -> DataFrame:
        return self._leg_keys(self.dealt(self.lineitem, "l_orderkey"))

    def _given_legs(self) -> DataFrame | None:
        """``legs`` where it was set to another relation than that of lineitem."""
        legs = self.__dict__.get("legs")
        return None if legs is self.__dict__.get("_line_legs") else legs

    @cached_property
    def product_legs(self) -> DataFrame:
        """The rows of ``legs``, dealt by product and colour (as they are where ``legs`` was given)."""
        given = self._given_legs()
        return given if given is not None else self._leg_keys(self.dealt(self.lineitem, *STYLE_LINE))

    @staticmethod
    def _leg_keys(lines: DataFrame) -> DataFrame:
        return lines.select(
            F.col("l_orderkey").alias("set_id"), F.col("l_linenumber").alias("leg_no"),
            F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("color_id")).distinct()

    @cached_property
    def set_header(self) -> DataFrame:
        """The columns of a set that all its rows share.  extra: url."""
        return self.orders.select(
            F.col("o_orderkey").alias("set_id"),
            F.col("o_custkey").alias("uber_set_id"),
            F.concat(F.lit("Set "), _s("o_orderkey")).alias("display_name"),
            F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("searchable_flag"),
            F.when(F.col("o_orderpriority") == "5-LOW", 0).otherwise(1).alias("online_flag"),
            F.when(F.col("o_totalprice") < 1000, 0).otherwise(1).alias("available_flag"),
            F.concat(F.lit("/sets/"), _s("o_orderkey")).alias("url"))

    @cached_property
    def set_price_text(self) -> DataFrame:
        """(set, list_price, sale_price) texts: 'low-high' or one amount, one row for odd and one for even legs."""
        li = self.dealt(self.lineitem, "l_orderkey")
        sale = F.col("l_extendedprice").cast(DEC2) * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))

        def text(amount):
            lo = F.min(amount).cast(DEC2).cast("string")
            hi = F.max(amount).cast(DEC2).cast("string")
            return F.when(F.count(F.lit(1)) == 1, lo).otherwise(F.concat(lo, F.lit("-"), hi))

        return (li.groupBy(F.col("l_orderkey").alias("set_id"), (F.col("l_linenumber") % 2).alias("odd"))
                .agg(text(F.col("l_extendedprice").cast(DEC2)).alias("list_price"), text(sale).alias("sale_price"))
                .drop("odd"))

    # -- style / size / inventory / price -----------------------------------
    def _line_keys(self) -> list[F.Column]:
        return [F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("color_id"),
                F.col("l_linenumber").alias("size_no")]

    @staticmethod
    def _style_status():
        return F.when(F.col("color_id") % 7 == 0, 0).otherwise(1)

    @staticmethod
    def _size_status():
        return F.when(F.col("size_no") == 7, 0).otherwise(1)

    @cached_property
    def style(self) -> DataFrame:
        return self._styles(self.dealt(self.lineitem, *STYLE_LINE).select(*self._line_keys()[:2]).distinct())

    def _styles(self, keys: DataFrame) -> DataFrame:
        return keys.select("product_id", "color_id", self._style_status().alias("status"),
                           F.concat(F.lit("MF"), _s(F.col("color_id") % 11)).alias("mf_item_id"))

    @cached_property
    def size(self) -> DataFrame:
        return (self.dealt(self.lineitem, *SIZE_LINE).groupBy(*self._line_keys())
                .agg(F.max("l_extendedprice").cast(DEC2).alias("was_price"))
                .select(*SIZE_KEY, self._size_status().alias("status"), "was_price"))

    @staticmethod
    def _units(flag: str) -> F.Column:
        """Units of the rows with a flag; for some sizes NULL, not 0, where there are none."""
        known = (F.col("l_partkey") + F.col("l_linenumber")) % 11 != 3
        return F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity").cast("int")).when(known, 0)).cast("bigint")

    @cached_property
    def inventory(self) -> DataFrame:
        return self.dealt(self.lineitem, *SIZE_LINE).groupBy(*self._line_keys()).agg(
            self._units("A").alias("quantity"), self._units("N").alias("backorder_quantity"))

    def _price_columns(self) -> list[F.Column]:
        return [F.col("l_extendedprice").cast(DEC2).alias("selling_price"),
                F.when(F.col("l_discount") > 0.085, 0).otherwise(1).alias("price_status")]

    @cached_property
    def price(self) -> DataFrame:
        return (self.dealt(self.lineitem, *SIZE_LINE).select(*self._line_keys(), *self._price_columns()).distinct()
                .withColumnRenamed("price_status", "status"))

    @cached_property
    def sku(self) -> DataFrame:
        """The size grain in one pass: stock, style and size status, and a summary of the size's price rows.

        Equal to style x size x inventory with the (distinct) prices counted:
        first per price row, then per size, both in the task that has the style.
        """
        rows = self.dealt(self.lineitem, *STYLE_LINE).groupBy(*self._line_keys(), *self._price_columns()).agg(
            F.max("l_extendedprice").cast(DEC2).alias("was"),
            self._units("A").alias("a"), self._units("N").alias("n"))
        price, active = F.col("selling_price"), F.col("price_status") == 1
        return rows.groupBy(*SIZE_KEY).agg(
            F.max("was").alias("was_price"), F.sum("a").alias("quantity"), F.sum("n").alias("backorder_quantity"),
            F.count(F.lit(1)).alias("n_prices"), F.sum(price).alias("sum_price"), F.min(price).alias("min_price"),
            F.max(price).alias("max_price"), F.count(F.when(active, 1)).alias("n_active"),
            F.min(F.when(active, price)).alias("min_active"), F.max(F.when(active, price)).alias("max_active"),
        ).withColumns({"style_status": self._style_status(), "size_status": self._size_status()})

    # -- categories ----------------------------------------------------------
    @cached_property
    def category(self) -> DataFrame:
        """The categories, with ``parent_id`` (our addition: nation -> region -> root)."""
        n = self.table("nation")
        k = F.col("n_nationkey")
        nations = n.select(
            F.concat(F.lit("n"), _s(k)).alias("category_id"),
            F.concat(F.lit("r"), _s("n_regionkey")).alias("parent_id"),
            F.col("n_name").alias("display_name"),
            F.when(k % 6 == 5, "false").otherwise("true").alias("online_flag"),
            F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, "1995-01-01")
            .when(k % 5 == 2, "2030-01-01").when(k % 5 == 3, "junk")
            .when(k % 2 == 0, "2000").otherwise("Jun 1 2000").alias("online_from"),
            F.when(k % 4 == 0, F.lit(None)).when(k % 4 == 1, "2030-01-01")
            .when(k % 4 == 2, "n/a").when(k % 8 == 3, "2024-01-15 10:30")
            .otherwise("Jan 20 2024").alias("online_to"),
            F.when(k % 11 == 10, 1).when(k % 2 == 0, 0).alias("is_hidden"),
        )
        regions = self.table("region").select(
            F.concat(F.lit("r"), _s("r_regionkey")).alias("category_id"),
            F.lit("root").alias("parent_id"),
            F.col("r_name").alias("display_name"),
            F.lit("true").alias("online_flag"),
            F.lit(None).cast("string").alias("online_from"),
            F.lit(None).cast("string").alias("online_to"),
            F.lit(None).cast("int").alias("is_hidden"),
        )
        root = self.spark.range(1).select(
            F.lit("root").alias("category_id"),
            F.lit(None).cast("string").alias("parent_id"),
            F.lit("root").alias("display_name"),
            F.lit("true").alias("online_flag"),
            F.lit(None).cast("string").alias("online_from"),
            F.lit(None).cast("string").alias("online_to"),
            F.lit(None).cast("int").alias("is_hidden"),
        )
        return nations.unionByName(regions).unionByName(root)

    @cached_property
    def category_product(self) -> DataFrame:
        """Category rows keyed by child product."""
        g = self.dealt(self.line_geo, "l_partkey")
        # max over the text ('' < ' ' < 'true'), taken on an int code so the
        # aggregate stays a hash aggregate (a string max sorts)
        code = F.when(F.col("l_linenumber") == 1, 2).when(F.col("l_linenumber") == 2, 1).otherwise(0)
        top = F.max(code)
        return (g.groupBy("l_partkey", "n_regionkey", "n_nationkey").agg(
            F.when(top == 2, "true").when(top == 1, " ").otherwise("").alias("primary_category"))
            .select(F.col("l_partkey").alias("product_id"),
                    F.concat(F.lit("r"), _s("n_regionkey")).alias("site_id"),
                    F.concat(F.lit("n"), _s("n_nationkey")).alias("category_id"),
                    "primary_category"))

    @cached_property
    def set_category(self) -> DataFrame:
        """Category rows whose product is a set."""
        return self._set_categories(self.dealt(self.line_geo, "l_orderkey"), "l_orderkey", "l_linenumber")

    @staticmethod
    def _set_categories(rows: DataFrame, set_col: str, leg_col: str) -> DataFrame:
        top = F.max(F.when(F.col(leg_col) == 1, 1).otherwise(0))
        return (rows.groupBy(set_col, "n_regionkey", "n_nationkey").agg(
            F.when(top == 1, "true").otherwise("").alias("primary_category"))
            .select(F.col(set_col).alias("set_id"),
                    F.concat(F.lit("r"), _s("n_regionkey")).alias("site_id"),
                    F.concat(F.lit("n"), _s("n_nationkey")).alias("category_id"),
                    "primary_category"))

    # -- attributes (EAV) ----------------------------------------------------
    @cached_property
    def attribute(self) -> DataFrame:
        """The attribute dimension: the published names, and one that is not published."""
        names = F.array(*map(F.lit, (*PIVOT_NAMES, "unlisted")))
        return self.spark.range(1).select(F.posexplode(names).alias("attribute_id", "name"))

    @cached_property
    def attribute_value(self) -> DataFrame:
        """The attribute-value dimension: a display text (or none), some with quotes; some ids are missing."""
        n = F.col("p_size")
        return (self.part.filter(n % 13 != 0).select(n.cast("bigint").alias("value_id")).distinct().select(
            "value_id",
            F.when(F.col("value_id") % 3 == 1, F.concat(F.lit("Value "), _s("value_id")))
            .when(F.col("value_id") % 3 == 2, F.concat(F.lit('Size "'), _s("value_id"), F.lit('"'))).alias("display_value"),
            F.concat(F.lit("v"), _s("value_id")).alias("attribute_value")))

    @cached_property
    def product_attribute_value(self) -> DataFrame:
        """Eight attributes of each product, every other one with two values; some ids are in no dimension."""
        key, k = F.col("p_partkey"), F.col("k")
        rows = self.part.select("p_partkey", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("k"))
        values = F.when(k % 2 == 0, F.array(1 + (key + k * 11) % 50, 1 + (key * 3 + k) % 50)).otherwise(
            F.array(1 + (key + k * 11) % 50))
        return rows.select(
            key.alias("product_id"), ((key * 5 + k * k * 3 + k) % (len(PIVOT_NAMES) + 2)).cast("int").alias("attribute_id"),
            F.explode(values.cast("array<bigint>")).alias("value_id"),
            F.when((key + k) % 9 == 0, 0).otherwise(1).alias("status"))

    # -- reviews, promos, lookups ---------------------------------------------
    @cached_property
    def reviews(self) -> DataFrame:
        """Set reviews (the cross-database source)."""
        return (self.events.filter(F.col("event_type") == "view").groupBy("user_id")
                .agg(F.count(F.lit(1)).alias("review_count"),
                     F.max("value").cast(DEC2).alias("average_rating"))
                .withColumnRenamed("user_id", "product_set_id"))

    @cached_property
    def promo(self) -> DataFrame:
        """Final-price promos."""
        return (self.events.filter(F.col("event_type") == "purchase")
                .select(F.col("user_id").alias("product_id"), F.col("ts").alias("date_created"),
                        F.col("value").cast(DEC2).alias("promo_price")))

    @cached_property
    def set_url(self) -> DataFrame:
        """Result of the set-url function: (set, site) -> url.

        Its rows are the (set, site) pairs of ``set_category`` (same join, same
        grain), so it is projected from that aggregate instead of another pass.
        """
        sc = self.set_category.filter(F.col("set_id") % 10 != 0)
        site_no = F.substring("site_id", 2, 20)
        return sc.select("set_id", "site_id",
                         F.concat(F.lit("/"), site_no, F.lit("/sets/"), _s("set_id")).alias("url")
                         ).distinct()

    @cached_property
    def product_url(self) -> DataFrame:
        """Result of the product-url function: (product, brand code) -> url."""
        b = self.brand.select("brand_id", "brand_code")
        return (self.product.select("product_id", "brand_id")
                .filter(F.col("product_id") % 13 != 0)
                .join(b, "brand_id")
                .select("product_id", "brand_code",
                        F.concat(F.lit("/"), F.col("brand_code"), F.lit("/p/"), _s("product_id"))
                        .alias("url")))

    @cached_property
    def set_image(self) -> DataFrame:
        """Result of the set main-image function (extra): (set, brand code) -> path."""
        o = self.orders.filter(F.col("o_orderkey") % 4 != 0)
        return o.select(F.col("o_orderkey").alias("set_id"),
                        F.concat(F.lit("r"), _s(F.col("o_custkey") % 5)).alias("brand_code"),
                        F.concat(F.lit("/img/sets/"), _s("o_orderkey"), F.lit(".jpg"))
                        .alias("image_path"))

    @cached_property
    def set_hover_image(self) -> DataFrame:
        """Result of the set hover-image function (extra): (set, brand code) -> url."""
        o = self.orders.filter(F.col("o_orderkey") % 3 != 0)
        return o.select(F.col("o_orderkey").alias("set_id"),
                        F.concat(F.lit("r"), _s(F.col("o_custkey") % 5)).alias("brand_code"),
                        F.concat(F.lit("/img/hover/"), _s("o_orderkey"), F.lit(".jpg"))
                        .alias("image_url"))

    @cached_property
    def sps_attributes(self) -> DataFrame:
        """Set-level '|'-joined item types."""
        o = self.orders.filter(F.col("o_orderkey") % 5 != 0)
        k = F.col("o_orderkey") % 3
        return o.select(F.col("o_orderkey").alias("set_id"),
                        F.when(k == 0, 'bikini|one "piece"').when(k == 1, "tankini")
                        .alias("item_type"))
