"""The source relations as plain SQL over the driver's base tables (for the DuckDB oracle).

The same relations as ``sources.catalog.Catalog`` (which builds them with the
DataFrame API); kept as independent text so the oracle check compares two
separate derivations.  ``with_views`` inlines the needed ones as CTEs,
dependencies first.
"""

from __future__ import annotations

import re

# The attribute dimension's published names, in source order.
ATTRIBUTE_NAMES = (
    "application beauty_concern beauty_hair_type beauty_scent body_shape bottom_fit bra_lining "
    "bra_support_level capacity care coat_weight comfort_level construction coverage fabric "
    "fabric_/_material features fill_material fit heel_height height included item_type length "
    "light_count light_filtration lighting_color lighting_type material multi_packs neckline "
    "occasion pillow_type product_thickness purpose rod-type room sets shape sheet_type "
    "shorts_inseam sleep_position sleeve_length sleeve_shape style swim_coverage theme "
    "thread_count towel-type voltage weight width window_style wreath_size").split()

_NAME_LIST = ", ".join(f"'{n}'" for n in (*ATTRIBUTE_NAMES, "unlisted"))

VIEWS: dict[str, str] = {
    "product": """
select p_partkey as product_id, cast(substr(p_brand,7) as int) as brand_id,
  p_type as classification, case when p_size % 10 = 0 then 0 else 1 end as status,
  case when p_size % 17 = 3 then null when p_size <= 40 then 1 else 0 end as is_international, p_name as title,
  cast(p_retailprice as decimal(10,2)) as retail_price, p_type as description, p_brand as pcm_brand,
  p_size as customer_review_count,
  cast((p_partkey % 50) / 10 as decimal(3,1)) as customer_review_average
from part""",
    "site_product": "select p_partkey as product_id, upper(p_brand) as site_brand from part where p_partkey % 31 <> 7",
    "product_price": "select p_partkey as product_id from part where p_partkey % 23 <> 0",
    "brand": """
select distinct cast(substr(p_brand,7) as int) as brand_id, p_brand as brand_name,
  concat('r', cast(cast(substr(p_brand,7) as int) % 5 as varchar)) as brand_code
from part where cast(substr(p_brand,7) as int) % 12 <> 5""",
    "classification": "select distinct p_type as classification from part where length(p_type) % 9 <> 6",
    "legs": """
select distinct l_orderkey as set_id, l_linenumber as leg_no, l_partkey as product_id, l_suppkey as color_id
from lineitem""",
    "set_header": """
select o_orderkey as set_id, o_custkey as uber_set_id, concat('Set ', cast(o_orderkey as varchar)) as display_name,
  case when o_orderstatus = 'P' then 0 else 1 end as searchable_flag,
  case when o_orderpriority = '5-LOW' then 0 else 1 end as online_flag,
  case when o_totalprice < 1000 then 0 else 1 end as available_flag,
  concat('/sets/', cast(o_orderkey as varchar)) as url
from orders""",
    "set_price_text": """
select set_id,
  case when n = 1 then cast(a as varchar) else concat(cast(a as varchar), '-', cast(b as varchar)) end as list_price,
  case when n = 1 then cast(c as varchar) else concat(cast(c as varchar), '-', cast(d as varchar)) end as sale_price
from (select l_orderkey as set_id, l_linenumber % 2 as odd, count(*) as n,
        min(cast(l_extendedprice as decimal(10,2))) as a, max(cast(l_extendedprice as decimal(10,2))) as b,
        cast(min(cast(l_extendedprice as decimal(10,2)) * (1 - cast(l_discount as decimal(4,2)))) as decimal(10,2)) as c,
        cast(max(cast(l_extendedprice as decimal(10,2)) * (1 - cast(l_discount as decimal(4,2)))) as decimal(10,2)) as d
      from lineitem group by l_orderkey, l_linenumber % 2)""",
    "style": """
select distinct l_partkey as product_id, l_suppkey as color_id,
  case when l_suppkey % 7 = 0 then 0 else 1 end as status,
  concat('MF', cast(l_suppkey % 11 as varchar)) as mf_item_id
from lineitem""",
    "size": """
select l_partkey as product_id, l_suppkey as color_id, l_linenumber as size_no,
  case when l_linenumber = 7 then 0 else 1 end as status, cast(max(l_extendedprice) as decimal(10,2)) as was_price
from lineitem group by l_partkey, l_suppkey, l_linenumber""",
    "inventory": """
select l_partkey as product_id, l_suppkey as color_id, l_linenumber as size_no,
  cast(sum(case when l_returnflag = 'A' then cast(l_quantity as int)
    when (l_partkey + l_linenumber) % 11 <> 3 then 0 end) as bigint) as quantity,
  cast(sum(case when l_returnflag = 'N' then cast(l_quantity as int)
    when (l_partkey + l_linenumber) % 11 <> 3 then 0 end) as bigint) as backorder_quantity
from lineitem group by l_partkey, l_suppkey, l_linenumber""",
    "price": """
select distinct l_partkey as product_id, l_suppkey as color_id, l_linenumber as size_no,
  cast(l_extendedprice as decimal(10,2)) as selling_price,
  case when l_discount > 0.085 then 0 else 1 end as status
from lineitem""",
    "size_stock": """
select z.product_id, z.color_id, z.size_no, z.status, z.was_price, i.quantity,
  i.quantity + i.backorder_quantity as units
from size z, inventory i
where (z.product_id, z.color_id, z.size_no) = (i.product_id, i.color_id, i.size_no)""",
    "attribute": f"""
select unnest(range(len(names)))::int as attribute_id, unnest(names) as name
from (select [{_NAME_LIST}] as names)""",
    "attribute_value": """
select distinct p_size::bigint as value_id,
  case p_size % 3 when 1 then 'Value ' || p_size when 2 then 'Size "' || p_size || '"' end as display_value,
  'v' || p_size as attribute_value
from part where p_size % 13 <> 0""",
    "product_attribute_value": f"""
select p_partkey as product_id, (p_partkey * 5 + k * k * 3 + k) % {len(ATTRIBUTE_NAMES) + 2} as attribute_id, v as value_id,
  case when (p_partkey + k) % 9 = 0 then 0 else 1 end as status
from (select p_partkey, k, unnest(case when k % 2 = 0 then [1 + (p_partkey + k * 11) % 50, 1 + (p_partkey * 3 + k) % 50]
                                       else [1 + (p_partkey + k * 11) % 50] end) as v
      from (select p_partkey, unnest(range(8)) as k from part))""",
    "category": """
select concat('n', cast(n_nationkey as varchar)) as category_id, concat('r', cast(n_regionkey as varchar)) as parent_id,
  n_name as display_name, case when n_nationkey % 6 = 5 then 'false' else 'true' end as online_flag,
  case n_nationkey % 5 when 0 then null when 1 then '1995-01-01' when 2 then '2030-01-01' when 3 then 'junk'
    else case when n_nationkey % 2 = 0 then '2000' else 'Jun 1 2000' end end as online_from,
  case n_nationkey % 4 when 0 then null when 1 then '2030-01-01' when 2 then 'n/a'
    else case when n_nationkey % 8 = 3 then '2024-01-15 10:30' else 'Jan 20 2024' end end as online_to,
  case when n_nationkey % 11 = 10 then 1 when n_nationkey % 2 = 0 then 0 else null end as is_hidden
from nation
union all select concat('r', cast(r_regionkey as varchar)), 'root', r_name, 'true', null, null, null from region
union all select 'root', null, 'root', 'true', null, null, null""",
    "category_product": """
select l_partkey as product_id, concat('r', cast(n_regionkey as varchar)) as site_id,
  concat('n', cast(n_nationkey as varchar)) as category_id,
  max(case when l_linenumber = 1 then 'true' when l_linenumber = 2 then ' ' else '' end) as primary_category
from lineitem join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey
group by l_partkey, n_regionkey, n_nationkey""",
    "set_category": """
select l_orderkey as set_id, concat('r', cast(n_regionkey as varchar)) as site_id,
  concat('n', cast(n_nationkey as varchar)) as category_id,
  max(case when l_linenumber = 1 then 'true' else '' end) as primary_category
from lineitem join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey
group by l_orderkey, n_regionkey, n_nationkey""",
    "reviews": """
select user_id as product_set_id, count(*) as review_count, cast(max(value) as decimal(10,2)) as average_rating
from events where event_type = 'view' group by user_id""",
    "promo": """
select user_id as product_id, ts as date_created, cast(value as decimal(10,2)) as promo_price
from events where event_type = 'purchase'""",
    "set_url": """
select distinct l_orderkey as set_id, concat('r', cast(n_regionkey as varchar)) as site_id,
  concat('/', cast(n_regionkey as varchar), '/sets/', cast(l_orderkey as varchar)) as url
from lineitem join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey
where l_orderkey % 10 <> 0""",
    "product_url": """
select product_id, brand_code, concat('/', brand_code, '/p/', cast(product_id as varchar)) as url
from product join brand using (brand_id) where product_id % 13 <> 0""",
    "set_image": """
select o_orderkey as set_id, concat('r', cast(o_custkey % 5 as varchar)) as brand_code,
  concat('/img/sets/', cast(o_orderkey as varchar), '.jpg') as image_path
from orders where o_orderkey % 4 <> 0""",
    "set_hover_image": """
select o_orderkey as set_id, concat('r', cast(o_custkey % 5 as varchar)) as brand_code,
  concat('/img/hover/', cast(o_orderkey as varchar), '.jpg') as image_url
from orders where o_orderkey % 3 <> 0""",
    "sps_attributes": """
select o_orderkey as set_id,
  case when o_orderkey % 3 = 0 then 'bikini|one "piece"' when o_orderkey % 3 = 1 then 'tankini' else null end as item_type
from orders where o_orderkey % 5 <> 0""",
}


def _deps(sql: str, known: dict[str, str]) -> list[str]:
    words = set(re.findall(r"[a-z_0-9]+", sql.lower()))
    return [n for n in known if n in words]


def with_views(body: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """Prefix ``body`` with the CTEs it (transitively) references, dependencies first.

    ``extra`` adds query-specific CTEs (which may use catalog views).
    """
    known = dict(VIEWS)
    if extra:
        known.update(extra)
    order: list[str] = []

    def visit(name: str, stack: tuple[str, ...] = ()):
        if name in order or name in stack:
            return
        for d in _deps(known[name], known):
            if d != name:
                visit(d, stack + (name,))
        order.append(name)

    for n in _deps(body, known):
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} as ({known[n]}\n)" for n in order)
    return f"with {'recursive ' if recursive else ''}{ctes}\n{body}"
