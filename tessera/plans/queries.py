"""Registered queries: one per operator of the inventory, each (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through the catalog, so its work grows
with them.  Column names match the oracle SQL in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.catalog import SIZE_KEY
from .context import stages_for

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


# -- rollups ------------------------------------------------------------------------------

@query("leg_gate")
def leg_gate(spark, sf_dir):
    """Sets whose leg 1 and leg 2 both have stock (correlated per-leg sums as one pre-aggregate)."""
    return stages_for(spark, sf_dir).gated_sets


@query("set_rollup")
def set_rollup(spark, sf_dir):
    """Per set and child product: stock, min and total price, all-international flag."""
    return stages_for(spark, sf_dir).sets


@query("product_rollup")
def product_rollup(spark, sf_dir):
    """Per set, product, primary category (fallback) and variation group: stock and price range."""
    return stages_for(spark, sf_dir).products


@query("set_price_two_level")
def set_price_two_level(spark, sf_dir):
    """Minimum price per product row, then their sum per set."""
    return stages_for(spark, sf_dir).set_pricing


# -- scans, projections, filters ------------------------------------------------------------

def _st(spark, sf_dir):
    return stages_for(spark, sf_dir)


@query("scan_project")
def scan_project(spark, sf_dir):
    """Scan with explicit column list (pruned at the Parquet reader)."""
    return _st(spark, sf_dir).cat.product.select(
        "product_id", "brand_id", "classification", "status", "is_international",
        "title", "retail_price")


@query("status_filter")
def status_filter(spark, sf_dir):
    """Active sizes with active prices (equality filters pushed to the scan side)."""
    cat = _st(spark, sf_dir).cat
    sz = cat.size.filter(F.col("status") == 1).drop("status")
    pc = cat.price.filter(F.col("status") == 1).drop("status")
    return sz.join(pc, SIZE_KEY)


@query("sellable_filter")
def sellable_filter(spark, sf_dir):
    """Product-set rows that are searchable, online and available."""
    cat = _st(spark, sf_dir).cat
    sellable = cat.set_header.filter((F.col("searchable_flag") == 1) & (F.col("online_flag") == 1)
                                     & (F.col("available_flag") == 1))
    return cat.legs.join(sellable.select("set_id"), "set_id").select("set_id", "leg_no", "product_id", "color_id")


@query("nonblank_filter")
def nonblank_filter(spark, sf_dir):
    """Category rows with a non-blank primary flag (NULL, '' and blanks fail)."""
    from ..functions.text import nonblank
    cp = _st(spark, sf_dir).cat.category_product
    return cp.filter(nonblank("primary_category")).select(
        "product_id", "site_id", "category_id", "primary_category")


@query("visible_filter")
def visible_filter(spark, sf_dir):
    """Categories not hidden (NULL = visible) and online (NULL = offline)."""
    c = _st(spark, sf_dir).categories
    return (c.filter((F.coalesce(F.col("is_hidden"), F.lit(0)) == 0)
                     & (F.coalesce(F.col("online_flag"), F.lit("false")) == "true"))
            .select("category_id", "display_name"))


@query("constant_columns")
def constant_columns(spark, sf_dir):
    """Constant feed columns per set (op, flags and the always-empty keys)."""
    from .feed import EMPTY_SET_KEYS
    sets = _st(spark, sf_dir).cat.legs.select("set_id").distinct()
    return sets.select("set_id", F.lit("add").alias("op"), F.lit("Y").alias("is_special_productset"),
                       F.lit("N").alias("is_marketplace_item"),
                       *[F.lit("").alias(k) for k in EMPTY_SET_KEYS])


@query("iif_labels")
def iif_labels(spark, sf_dir):
    from ..functions.flags import gender_label, true_false_text
    p = _st(spark, sf_dir).cat.product
    return p.select("product_id", gender_label("brand_id").alias("gender"),
                    true_false_text("is_international").alias("is_international"))


@query("product_path")
def product_path_q(spark, sf_dir):
    from ..functions.text import product_path
    sets = _st(spark, sf_dir).cat.legs.select("set_id").distinct()
    return sets.select("set_id", product_path("set_id").alias("path"))


@query("concat_null_rules")
def concat_null_rules(spark, sf_dir):
    """'+' concatenation (NULL wins) next to CONCAT (NULL is '')."""
    from ..functions.text import concat_nullable, concat_skip_null
    a = _st(spark, sf_dir).cat.sps_attributes
    return a.select("set_id",
                    concat_nullable(F.lit("/types/"), F.col("item_type")).alias("plus_concat"),
                    concat_skip_null(F.lit('"'), F.col("item_type"), F.lit('"')).alias("fn_concat"))


@query("replace_text")
def replace_text(spark, sf_dir):
    from ..functions.text import pipe_to_json_list_body, quote_escape
    a = _st(spark, sf_dir).cat.sps_attributes
    return a.select("set_id", quote_escape("item_type").alias("escaped"),
                    pipe_to_json_list_body("item_type").alias("list_body"))


@query("stringify_numbers")
def stringify_numbers(spark, sf_dir):
    """Numbers to bounded text; decimals keep their scale."""
    from ..functions.text import fixed_text
    r = _st(spark, sf_dir).cat.reviews
    return r.select("product_set_id", fixed_text("review_count").alias("review_count"),
                    fixed_text("average_rating").alias("review_average"))


@query("availability_flag")
def availability_flag(spark, sf_dir):
    from ..functions.flags import positive_flag
    inv = _st(spark, sf_dir).cat.inventory
    return inv.select(*SIZE_KEY, positive_flag(F.col("quantity") + F.col("backorder_quantity"))
                      .alias("available"))


@query("brand_lookup")
def brand_lookup_q(spark, sf_dir):
    from .context import BRAND_CODE
    from .job import brand_lookup
    return brand_lookup(_st(spark, sf_dir).cat, BRAND_CODE)


@query("collated_match")
def collated_match(spark, sf_dir):
    """Case-sensitive key match (default) next to the case-insensitive collation."""
    c = _st(spark, sf_dir).cat.category
    return c.select("category_id", (F.col("category_id") == "R1").alias("cs_match"),
                    (F.collate(F.col("category_id"), "UTF8_LCASE") == "R1").alias("ci_match"))


@query("collated_join")
def collated_join_q(spark, sf_dir):
    """Products of the storefront with the brand whose name is theirs in another case (a case-insensitive key)."""
    from ..operators.collation import ANY_CASE, collated_join
    cat = _st(spark, sf_dir).cat
    brand = cat.brand.select(F.col("brand_name").alias("site_brand"), "brand_id", "brand_code")
    return collated_join(cat.site_product, brand, ["site_brand"], ANY_CASE).select(
        "product_id", F.collate("site_brand", "UTF8_BINARY").alias("site_brand"), "brand_id", "brand_code")


@query("collated_group")
def collated_group(spark, sf_dir):
    """Category rows by site and primary flag, whatever their case and the blanks at their end."""
    from ..operators.collation import ANY_CASE_PADDED, one_spelling, with_collation
    rows = _st(spark, sf_dir).cat.category_product.withColumn(
        "site_id", F.when(F.col("product_id") % 2 == 0, F.upper("site_id")).otherwise(F.concat("site_id", F.lit("  "))))
    keys = ["site_id", "primary_category"]
    n = with_collation(rows, ANY_CASE_PADDED, *keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return one_spelling(n, *keys)


# -- dates ------------------------------------------------------------------------------------

@query("clean_dates")
def clean_dates(spark, sf_dir):
    """Validity bounds that are not dates become NULL."""
    return _st(spark, sf_dir).categories.select("category_id", "online_from", "online_to")


@query("date_shapes")
def date_shapes(spark, sf_dir):
    """Order dates written in a dozen layouts, some of them no dates, and read back."""
    from ..functions.dates import parse_date_text
    o = _st(spark, sf_dir).cat.orders.select(
        F.col("o_orderkey").alias("set_id"), (F.col("o_orderdate") + F.make_dt_interval(
            F.lit(0), (F.col("o_orderkey") % 24).cast("int"), (F.col("o_orderkey") % 60).cast("int"))).alias("at"))
    layouts = ["yyyy/MM/dd", "MM-dd-yyyy", "yyyyMMdd HH:mm", "M/d/yyyy h:mm a", "yyyy.MM.dd HH:mm:ss", "MMM d yyyy h:mma",
               "d MMMM yyyy HH:mm", "yyyy-MM-dd'T'HH:mm:ss.SSS", "MMMM d, yyyy", "yyyy", "'on' yyyy-MM-dd", "yyyy-MM-dd 25:mm"]
    layout = F.col("set_id") % len(layouts)
    text = F.coalesce(*[F.when(layout == i, F.date_format("at", x)) for i, x in enumerate(layouts)])
    parsed = o.select("set_id", text.alias("text"), parse_date_text(text).alias("t"))
    return parsed.select("set_id", "text", F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("online_interval")
def online_interval(spark, sf_dir):
    """Visible, online categories valid at the run date's next midnight."""
    return _st(spark, sf_dir).live_categories.select("category_id", "display_name")


@query("price_range")
def price_range(spark, sf_dir):
    """'low-high' price text -> low/high amounts for list and sale price."""
    return _st(spark, sf_dir).promo_prices


# -- joins ------------------------------------------------------------------------------------

@query("inner_join_star")
def inner_join_star(spark, sf_dir):
    """Set -> product -> brand -> style -> size -> price, rolled up per set and product.

    The prices are summed up per (product, colour) before they meet the set rows.
    """
    st = _st(spark, sf_dir)
    cat = st.cat
    rows = cat.product_legs.groupBy("set_id", "product_id", "color_id").agg(F.count(F.lit(1)).alias("n"))
    pr = st.known_products.select("product_id", "brand_name")
    priced = st.sku_rollup.select("product_id", "color_id", "n_all", "min_all", "max_all")
    j = rows.join(priced, ["product_id", "color_id"]).repartition(cat.line_tasks, "product_id").join(pr, "product_id")
    return j.groupBy("set_id", "product_id", "brand_name").agg(
        F.sum(F.col("n") * F.col("n_all")).alias("n_rows"), F.min("min_all").alias("min_price"),
        F.max("max_all").alias("max_price"))


@query("composite_key_join")
def composite_key_join(spark, sf_dir):
    cat = _st(spark, sf_dir).cat
    sty = cat.style.select("product_id", "color_id", "status")
    return cat.product_legs.join(sty, ["product_id", "color_id"])


@query("left_join_on_residual")
def left_join_on_residual(spark, sf_dir):
    """Products LEFT JOIN promos created on/after the run date (residual kept in ON)."""
    from ..operators.joins import left_join_on
    from .context import AS_OF
    cat = _st(spark, sf_dir).cat
    p = cat.product.select("product_id")
    pro = cat.promo
    j = left_join_on(p, pro, ["product_id"], pro["date_created"] >= F.lit(AS_OF).cast("timestamp_ntz"))
    return j.groupBy("product_id").agg(F.count("promo_price").alias("n_recent_promos"),
                                       F.max("promo_price").alias("max_promo_price"))


@query("fallback_join")
def fallback_join(spark, sf_dir):
    """Primary category: own site first, else any site; with the double join's multiplicity."""
    pc = _st(spark, sf_dir).product_category
    return pc.select("product_id", "primary_category", F.col("mult").alias("n_rows"))


@query("in_stock_semi_join")
def in_stock_semi_join(spark, sf_dir):
    """Products with an active, stocked size that has an active price (EXISTS)."""
    from ..operators.joins import exists_in
    st = _st(spark, sf_dir)
    return exists_in(st.cat.product.select("product_id", "title"),
                     st.product_in_stock.select("product_id"), "product_id")


@query("existence_semi_join")
def existence_semi_join(spark, sf_dir):
    """Product-set rows whose product is an active product with styles."""
    from ..operators.joins import exists_in
    st = _st(spark, sf_dir)
    return exists_in(st.cat.legs.select("set_id", "leg_no", "product_id"),
                     st.products2.select("product_id"), "product_id")


@query("product_price_stock")
def product_price_stock(spark, sf_dir):
    """Per product: was-price and selling-price range and units, active stocked sizes only."""
    return _st(spark, sf_dir).product_in_stock


@query("top1_per_key")
def top1_per_key_q(spark, sf_dir):
    from .feed import set_top_row
    return set_top_row(_st(spark, sf_dir))


@query("sites_per_set")
def sites_per_set(spark, sf_dir):
    return _st(spark, sf_dir).cat.set_category.select("set_id", "site_id").distinct()


@query("url_lookup_join")
def url_lookup_join(spark, sf_dir):
    """Each (set, site) joined to the url lookup (inner: no url, no row)."""
    cat = _st(spark, sf_dir).cat
    sites = cat.set_category.select("set_id", "site_id").distinct()
    return sites.join(cat.set_url, ["set_id", "site_id"]).select("set_id", "site_id", "url")


@query("table_function_apply")
def table_function_apply(spark, sf_dir):
    """Each (set, site) with its url (inner apply: none, no row) and its images (outer applies) by SQL table functions."""
    from ..operators.apply import apply_function
    from .context import BRAND_CODE
    from .lookups import define_lookups
    st = _st(spark, sf_dir)
    define_lookups(st)
    rows = apply_function(st.cat.set_category.select("set_id", "site_id").distinct(), "set_url", "l.set_id", "l.site_id")
    rows = apply_function(rows, "set_image", "l.set_id", f"'{BRAND_CODE}'", keep_all=True)
    return apply_function(rows, "set_hover_image", "l.set_id", f"'{BRAND_CODE}'", keep_all=True)


@query("category_function_apply")
def category_function_apply(spark, sf_dir):
    """Each category row of a set with the categories up to the root, as the rows of a SQL table function."""
    from ..operators.apply import apply_function
    from .lookups import define_lookups
    st = _st(spark, sf_dir)
    define_lookups(st)
    return apply_function(st.cat.set_category.select("set_id", "site_id", "category_id"), "category_list", "l.category_id")


def leg_applies(st):
    """Sets with the stock behind legs 1 and 2, each by an outer apply of a correlated sum."""
    from ..operators.apply import apply_rows, outer
    stocked = st.cat.legs.join(st.color_stock, "color_id")
    rows = st.cat.set_header.select("set_id")
    for leg, name in ((1, "vg1_inventory"), (2, "vg2_inventory")):
        own = stocked.where((F.col("leg_no") == leg) & (F.col("set_id") == outer("set_id")))
        rows = apply_rows(rows, own.select(F.sum("stock").alias(name)), keep_all=True)
    return rows


@query("correlated_apply")
def correlated_apply(spark, sf_dir):
    """Sets that pass the leg gate, once for each of their sites: correlated sums and a correlated DISTINCT."""
    from ..operators.apply import apply_rows, outer
    st = _st(spark, sf_dir)
    gated = leg_applies(st).where("vg1_inventory > 0 and vg2_inventory > 0")
    sites = st.cat.set_category.select(F.col("set_id").alias("own_set"), "site_id").distinct()
    return apply_rows(gated, sites.where(F.col("own_set") == outer("set_id")).select("site_id"))


@query("self_join_legs")
def self_join_legs(spark, sf_dir):
    """The set relation in two roles (leg 1, leg 2), as per-set sums side by side."""
    return _st(spark, sf_dir).leg_stock


@query("reviews_left_join")
def reviews_left_join(spark, sf_dir):
    """Sets with their reviews, by named tables: the reviews' rows are in a database of their own."""
    from ..functions.text import fixed_text
    from .context import named_stages
    from .feed import set_top_row
    st = named_stages(spark, sf_dir)
    rev = st.cat.reviews.withColumnRenamed("product_set_id", "uber_set_id")
    j = set_top_row(st).join(rev, "uber_set_id", "left")
    return j.select("set_id", fixed_text("review_count").alias("review_count"),
                    fixed_text("average_rating").alias("review_average"))


# -- aggregates -------------------------------------------------------------------------------

@query("having_in_stock")
def having_in_stock(spark, sf_dir):
    """Per product: units over active sizes, kept only when positive (HAVING)."""
    cat = _st(spark, sf_dir).cat
    j = cat.size.filter(F.col("status") == 1).select(*SIZE_KEY).join(cat.inventory, SIZE_KEY)
    g = j.groupBy("product_id").agg(
        F.sum(F.col("quantity") + F.col("backorder_quantity")).alias("stock"))
    return g.filter(F.col("stock") > 0)


@query("international_flag")
def international_flag(spark, sf_dir):
    """Per set: 'true' only when every child product is international."""
    from .feed import set_flags
    return set_flags(_st(spark, sf_dir))


@query("distinct_rows")
def distinct_rows(spark, sf_dir):
    """Distinct (product, site) of category rows whose product exists."""
    from ..operators.joins import exists_in
    cat = _st(spark, sf_dir).cat
    return exists_in(cat.category_product.select("product_id", "site_id"),
                     cat.product.select("product_id"), "product_id").distinct()


@query("string_agg_attributes")
def string_agg_attributes(spark, sf_dir):
    return _st(spark, sf_dir).attribute_text


@query("string_agg_distinct")
def string_agg_distinct(spark, sf_dir):
    return _st(spark, sf_dir).products2


@query("pivot_attributes")
def pivot_attributes(spark, sf_dir):
    """EAV -> one column per listed attribute name, renamed to the published keys."""
    from .stages import OUTPUT_KEY_RENAMES
    return _st(spark, sf_dir).attributes.withColumnsRenamed(OUTPUT_KEY_RENAMES)


# -- nested JSON ------------------------------------------------------------------------------

def _products_once(st):
    """One row per (set, product, variation group): lowest and highest price."""
    return (st.products.groupBy("set_id", "product_id", "variation_group")
            .agg(F.min("min_price").alias("sale_price"), F.max("max_price").alias("price")))


@query("nested_struct_json")
def nested_struct_json(spark, sf_dir):
    """Dotted output names as nested objects: {"op","path","value":{"attributes":{...}}}."""
    from ..functions.text import product_path
    from .feed import set_top_row
    top = set_top_row(_st(spark, sf_dir))
    doc = F.struct(F.lit("add").alias("op"), product_path("set_id").alias("path"),
                   F.struct(F.struct(F.col("display_name").alias("title"), F.col("url"),
                                     F.lit("Y").alias("is_special_productset"))
                            .alias("attributes")).alias("value"))
    return top.select("set_id", F.to_json(doc).alias("doc"))


@query("nested_collection")
def nested_collection(spark, sf_dir):
    """Per set, its product rows as a JSON array (one grouped pass, no per-set subquery)."""
    from ..operators.nested import collect_ordered
    rows = _products_once(_st(spark, sf_dir))
    item = F.struct("variation_group", "product_id", "sale_price", "price")
    out = collect_ordered(rows, ["set_id"], [F.col("variation_group"), F.col("product_id")],
                          item, "products")
    return out.select("set_id", F.to_json("products").alias("products_json"))


@query("ordered_collection")
def ordered_collection(spark, sf_dir):
    """Per (set, site), category ids ordered by primary flag descending, then id."""
    from ..operators.nested import collect_ordered
    cp = _st(spark, sf_dir).cat.set_category
    out = collect_ordered(cp, ["set_id", "site_id"],
                          [(F.col("primary_category"), True), (F.col("category_id"), False)],
                          F.col("category_id"), "categories")
    return out.select("set_id", "site_id", F.to_json("categories").alias("categories_json"))


@query("null_omission_json")
def null_omission_json(spark, sf_dir):
    """NULL fields are left out of the JSON object (no nulls written)."""
    from .context import BRAND_CODE
    from .feed import set_top_row
    st = _st(spark, sf_dir)
    cat = st.cat
    img = cat.set_image.filter(F.col("brand_code") == BRAND_CODE).select("set_id", "image_path")
    hov = cat.set_hover_image.filter(F.col("brand_code") == BRAND_CODE).select("set_id", "image_url")
    j = (set_top_row(st).join(img, "set_id", "left").join(hov, "set_id", "left")
         .join(cat.sps_attributes, "set_id", "left"))
    doc = F.struct(F.col("display_name").alias("title"), F.col("image_path").alias("thumb_image"),
                   F.col("image_url").alias("onhover_image"), F.col("item_type"))
    return j.select("set_id", F.to_json(doc).alias("doc"))


@query("scalar_or_array_json")
def scalar_or_array_json(spark, sf_dir):
    """'a' -> "a", 'a|b' -> ["a","b"], NULL -> key absent."""
    from ..functions.text import scalar_or_array
    a = _st(spark, sf_dir).cat.sps_attributes
    return a.select("set_id", F.to_json(F.struct(scalar_or_array("item_type").alias("item_type")))
                    .alias("doc"))


@query("keyed_map_json")
def keyed_map_json(spark, sf_dir):
    """Per set, an object keyed by variation group (duplicates collapsed first)."""
    from ..operators.nested import keyed_object
    rows = _products_once(_st(spark, sf_dir))
    value = F.struct("product_id", "sale_price", "price")
    out = keyed_object(rows, ["set_id"], "variation_group", ["product_id", "sale_price", "price"],
                       value, "variants")
    return out.select("set_id", F.to_json("variants").alias("variants_json"))


# -- hierarchy --------------------------------------------------------------------------------

@query("category_walk")
def category_walk(spark, sf_dir):
    """Per category, its path of {id, name} from the root down to itself."""
    from .feed import category_path_lists
    p = category_path_lists(_st(spark, sf_dir))
    return p.select(F.col("node_id").alias("category_id"), F.to_json("path").alias("path_json"))


@query("category_paths")
def category_paths(spark, sf_dir):
    """Per (set, site), the paths of its live categories (array of arrays)."""
    from .feed import view_paths
    p = view_paths(_st(spark, sf_dir))
    return p.select("set_id", "site_id", F.to_json("category_paths").alias("paths_json"))


# -- the feed ---------------------------------------------------------------------------------

@query("feed_ops")
def feed_ops(spark, sf_dir):
    """The whole catalog feed: one JSON add-operation per product set."""
    from .context import AS_OF, BRAND_CODE
    from .job import build_feed
    return build_feed(spark, sf_dir, brand_code=BRAND_CODE, as_of=AS_OF)
