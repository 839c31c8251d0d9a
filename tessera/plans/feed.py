"""The catalog feed: one ``add`` operation per product set, as nested JSON.

    {"op":"add","path":"/products/<set>","value":{
        "attributes":{...set header...},
        "variants":{"<variation group>":{"attributes":{...}}, ...},
        "views":{"<site>":{"attributes":{"category_paths":[[{"id","name"},...],...],"url":...}}}}}

The published set ids come first: gates, flags, pricing and the set's first
row.  Children (variants, views) are restricted to them before they are
deduplicated, widened and collected, then joined once.  Each correlated
per-set subquery of the source becomes one ``groupBy(set_id).agg(...)``.
Decisions where the source is ambiguous (see README):

* variant and view keys are deduplicated (smallest full row wins) before
  the keyed object is built;
* the set-level international flag covers all children of the set;
* the set price sums one minimum price per (set, product, variation group)
  unless ``dedupe_products=False``;
* a set with several promo price rows takes the smallest (list, sale) pair;
* collections get a total order: variants and views by key, category paths
  by primary-category flag descending then category id, path nodes root first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.flags import all_true_text, gender_label, positive_flag, true_false_text
from ..functions.text import fixed_text, product_path, scalar_or_array
from ..operators.hierarchy import walk_to_root
from ..operators.joins import exists_in, top1_per_key
from ..operators.nested import collect_ordered, keyed_object, nonempty
from ..sources.catalog import PIVOT_NAMES
from .stages import Stages, output_key

# Set-level attribute keys that the feed always publishes as ''.
EMPTY_SET_KEYS = (
    "minBrwVariants", "maxBrwVariants", "minPriceVariants", "maxPriceVariants",
    "minFSPriceVariants", "maxFSPriceVariants", "backOrderMinVariantsBrw",
    "backOrderMaxVariantsBrw", "backOrderMinVariants", "backOrderMaxVariants",
    "brwPromoID", "clrPromoID", "fsPromoID", "brwssVariantID", "clrssVariantID",
    "fsssVariantID", "brwPLPSS", "clrPLPSS", "fsPLPSS",
)


# -- header ---------------------------------------------------------------------------------

def set_flags(st: Stages) -> DataFrame:
    """Per set: availability and the all-children international flag."""
    s = st.sets
    return s.groupBy("set_id").agg(
        F.max(positive_flag("inv_availability")).alias("availability"),
        all_true_text(F.when(F.col("is_international_set") == "false", 0).otherwise(1))
        .alias("is_international"))


def set_top_row(st: Stages) -> DataFrame:
    """The first product-set row of each set (total order: leg, product, colour)."""
    first = top1_per_key(st.cat.legs, ["set_id"], ["leg_no", "product_id", "color_id"], ["product_id"])
    return first.join(st.cat.set_header, "set_id")


def published(st: Stages, dedupe_products: bool = True) -> DataFrame:
    """The sets that get a document: flags, price and first row, one row each."""
    top = set_top_row(st).filter((F.col("searchable_flag") == 1) & (F.col("online_flag") == 1)
                                 & (F.col("available_flag") == 1))
    top = exists_in(top, st.cat.site_product.select("product_id"), "product_id")
    pricing = (st.set_pricing_dedup if dedupe_products else st.set_pricing) \
        .withColumnRenamed("sale_price", "set_price")
    return set_flags(st).join(top, "set_id").join(pricing, "set_id")


def headers(st: Stages, sets: DataFrame, brand_label: Column) -> DataFrame:
    """(set_id, attributes) of the published ``sets``."""
    cat = st.cat
    promo = top1_per_key(exists_in(st.promo_prices, sets.select("set_id"), "set_id"), ["set_id"], ["list_price", "sale_price"],
                         ["list_price", "sale_price", "sale_price_low", "sale_price_high"]) \
        .withColumnRenamed("sale_price", "sale_price_text")
    img = (cat.set_image.filter(F.col("brand_code") == st.brand_code)
           .select("set_id", "image_path"))
    hover = (cat.set_hover_image.filter(F.col("brand_code") == st.brand_code)
             .select("set_id", "image_url"))
    rev = cat.reviews.withColumnRenamed("product_set_id", "uber_set_id")
    attr2 = cat.sps_attributes.select("set_id", F.col("item_type").alias("set_item_type"))

    h = (sets.join(promo, "set_id", "left").join(img, "set_id", "left")
         .join(hover, "set_id", "left").join(rev, "uber_set_id", "left")
         .join(attr2, "set_id", "left"))

    low, high = F.col("sale_price_low"), F.col("sale_price_high")
    # The published header keys, in source order.
    fields: list[Column] = [
        brand_label.alias("brand"),
        F.col("display_name").alias("title"),
        F.col("availability").alias("availability"),
        F.col("is_international").alias("is_international"),
        F.col("set_price").alias("price"),
        F.col("set_price").alias("minbrowseprice"),
        low.alias("minBrwPrice"), high.alias("maxBrwPrice"),
        low.alias("minClrPrice"), high.alias("maxClrPrice"),
        low.alias("minFSPrice"), high.alias("maxFSPrice"),
        F.col("list_price").alias("brwListPrice"), F.col("sale_price_text").alias("brwSalePrice"),
        F.col("list_price").alias("clrListPrice"), F.col("sale_price_text").alias("clrSalePrice"),
        F.col("list_price").alias("fsListPrice"), F.col("sale_price_text").alias("fsSalePrice"),
        *[F.lit("").alias(k) for k in EMPTY_SET_KEYS],
        fixed_text("review_count").alias("review_count"),
        fixed_text("average_rating").alias("review_average"),
        F.col("url").alias("url"),
        F.col("image_path").alias("thumb_image"),
        F.col("image_url").alias("onhover_image"),
        F.lit("Y").alias("is_special_productset"),
        scalar_or_array("set_item_type").alias("item_type"),
    ]
    return h.select("set_id", F.struct(*fields).alias("attributes"))


# -- variants --------------------------------------------------------------------------------

# The published keys of a variant before the pivoted ones.
VARIANT_BASE = ("title", "description", "brand", "is_marketplace_item", "availability",
                "is_international", "gender", "brand_label", "review_count",
                "review_average", "url", "price", "sale_price")


def variant_rows(st: Stages, sets: DataFrame) -> DataFrame:
    """One row per (published set, variation group) that qualifies as a variant, with its raw fields."""
    cat = st.cat
    p1 = exists_in(st.products, sets.select("set_id"), "set_id").select("set_id", "product_id", "variation_group", "inv_availability",
                            "min_price", "max_price")
    p1 = exists_in(p1, st.products2.select("product_id"), "product_id")
    # (the set's own rows always match: these rows were built from them)
    p1 = exists_in(p1, cat.product_price, "product_id")
    p1 = exists_in(p1, st.product_in_stock.select("product_id"), "product_id")
    p1 = exists_in(p1, st.known_products.select("product_id"), "product_id")
    # one row per (set, variation group) -- picked on these narrow rows, before the
    # wide attribute columns are attached (the smallest full row wins)
    p1 = top1_per_key(p1.filter(F.col("variation_group").isNotNull()),
                      ["set_id", "variation_group"],
                      ["product_id", "min_price", "max_price", "inv_availability"],
                      ["product_id", "inv_availability", "min_price", "max_price"])
    pr = st.known_products.select(
        "product_id", "title", "description", "brand_name", "brand_code", "is_international",
        "brand_id", "pcm_brand", "customer_review_count", "customer_review_average")
    url = cat.product_url.select("product_id", "brand_code", F.col("url"))
    attrs = st.attributes
    j = (p1.join(pr, "product_id").join(attrs, "product_id", "left")
         .join(url, ["product_id", "brand_code"], "left"))
    return j.select(
        "set_id", "variation_group", "product_id",
        F.col("title"), F.col("description"), F.col("brand_name").alias("brand"),
        F.lit("N").alias("is_marketplace_item"),
        positive_flag("inv_availability").alias("availability"),
        true_false_text("is_international").alias("is_international"),
        gender_label("brand_id").alias("gender"),
        F.col("pcm_brand").alias("brand_label"),
        fixed_text("customer_review_count").alias("review_count"),
        F.col("customer_review_average").alias("review_average"),
        F.col("url"),
        F.col("max_price").alias("price"),
        F.col("min_price").alias("sale_price"),
        *[F.col(f"`{n}`").alias(f"a_{i}") for i, n in enumerate(PIVOT_NAMES)],
    )


def _variant_value() -> Column:
    """{"attributes": {13 base fields, 54 pivoted fields as string-or-array}} as one SQL expression."""
    def soa(c: str) -> str:
        return (f"CASE WHEN {c} IS NULL THEN CAST(NULL AS VARIANT) "
                f"WHEN instr({c}, '|') = 0 THEN CAST({c} AS VARIANT) "
                f"ELSE CAST(split({c}, '[|]') AS VARIANT) END")
    base = [f"'{k}', `{k}`" for k in VARIANT_BASE]
    piv = [f"'{output_key(n)}', {soa(f'`a_{i}`')}" for i, n in enumerate(PIVOT_NAMES)]
    return F.expr(f"named_struct('attributes', named_struct({', '.join(base + piv)}))")


def variants(rows: DataFrame) -> DataFrame:
    """(set_id, variants) from ``variant_rows``; rows clustered by set are not moved."""
    return keyed_object(rows, ["set_id"], "variation_group", ["product_id"], _variant_value(),
                        "variants", unique=True)


# -- views -----------------------------------------------------------------------------------

def category_path_lists(st: Stages) -> DataFrame:
    """Per category: its path as an array of {id, name}, root first."""
    walk = walk_to_root(st.cat.spark, st.cat.category)
    return collect_ordered(walk, ["node_id"], [(F.col("depth"), True)],
                           F.struct(F.col("ancestor_id").alias("id"),
                                    F.col("ancestor_name").alias("name")), "path")


def live_paths(st: Stages) -> DataFrame:
    """(category_id, path) of the live categories."""
    paths = category_path_lists(st).withColumnRenamed("node_id", "category_id")
    return exists_in(paths, st.live_categories.select("category_id"), "category_id")


def _site_paths(rows: DataFrame) -> DataFrame:
    """Per (set, site): its paths, primary categories first (a NULL path keeps its place)."""
    return collect_ordered(rows, ["set_id", "site_id"],
                           [(F.col("primary_category"), True), (F.col("category_id"), False)],
                           F.col("path"), "category_paths")


def view_paths(st: Stages) -> DataFrame:
    """Per (set, site): the paths of its live categories, primary ones first."""
    return _site_paths(st.cat.set_category.join(live_paths(st), "category_id"))


def views(st: Stages, sets: DataFrame) -> DataFrame:
    """Per published set, its sites with a url; a site without live categories has no paths."""
    own = exists_in(st.cat.set_category, sets.select("set_id"), "set_id")
    sites = _site_paths(own.join(live_paths(st), "category_id", "left")).select(
        "set_id", "site_id", F.filter("category_paths", lambda p: p.isNotNull()).alias("category_paths"))
    urls = exists_in(st.cat.set_url, sets.select("set_id"), "set_id")
    # one url per (set, site), picked before it meets the path arrays
    urls = top1_per_key(urls.filter(F.col("site_id").isNotNull()), ["set_id", "site_id"], ["url"], ["url"])
    value = F.struct(F.struct(nonempty(F.col("category_paths")).alias("category_paths"),
                              F.col("url").alias("url")).alias("attributes"))
    return keyed_object(sites.join(urls, ["set_id", "site_id"]), ["set_id"], "site_id", ["url"], value, "views", unique=True)


# -- documents ---------------------------------------------------------------------------------

def documents(headers: DataFrame, variants: DataFrame, views: DataFrame) -> DataFrame:
    """(set_id, doc) with doc the JSON text of the set's ``add`` operation."""
    j = headers.join(variants, "set_id", "left").join(views, "set_id", "left")
    value = F.struct(F.col("attributes"), nonempty(F.col("variants")).alias("variants"),
                     nonempty(F.col("views")).alias("views"))
    doc = F.struct(F.lit("add").alias("op"), product_path("set_id").alias("path"),
                   value.alias("value"))
    return j.select("set_id", F.to_json(doc).alias("doc"))
