"""The feed's lookup functions as SQL table functions, one for each published lookup."""

from __future__ import annotations

from ..operators.apply import define_table_function
from ..operators.hierarchy import walk_to_root
from .stages import Stages


def define_lookups(st: Stages) -> None:
    """Define set_url, product_url, set_image, set_hover_image and category_list over one catalog.

    The urls and images give a row or none; ``category_list`` gives the
    categories on the path from a category up to the root.
    """
    cat, spark = st.cat, st.cat.spark
    one = "SELECT r.{value} FROM {{rows}} r WHERE r.{a} = p_{a} AND r.{b} = p_{b}"
    for name, (a, b), value, rows in (
            ("set_url", ("set_id", "site_id"), "url", cat.set_url),
            ("product_url", ("product_id", "brand_code"), "url", cat.product_url),
            ("set_image", ("set_id", "brand_code"), "image_path", cat.set_image),
            ("set_hover_image", ("set_id", "brand_code"), "image_url", cat.set_hover_image)):
        define_table_function(spark, name, {f"p_{a}": "BIGINT", f"p_{b}": "STRING"}, {value: "STRING"},
                              one.format(value=value, a=a, b=b), rows=rows)
    define_table_function(
        spark, "category_list", {"p_category_id": "STRING"}, {"id": "STRING", "name": "STRING", "depth": "INT"},
        "SELECT w.ancestor_id, w.ancestor_name, w.depth FROM {walk} w WHERE w.node_id = p_category_id",
        walk=walk_to_root(spark, cat.category))
