"""The same results in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

import re

# -- the views of FIXTURES.md -------------------------------------------------------

VIEWS = {
    "sales": """
  select year_month, city, store_code, brand, product_sku_code, outlet_category_name, category_desc,
    address, metro, region, bucket, yago, beat_code, value_sales, vol_sales, rr, num_invoices from base
  union all
  select year_month, city, store_code, brand, product_sku_code, outlet_category_name, category_desc,
    'DUP ' || address, metro, region, bucket, yago, beat_code, value_sales, vol_sales, rr, num_invoices
  from base where l_orderkey % 20 = 0""",
    "base": """
  select strftime(l_shipdate, '%Y/%m') as year_month, n_name as city,
    cast(1000341000 + c_nationkey as varchar) || '_' ||
      case when o_custkey % 50 = 0 then 'ZOOM' when o_custkey % 50 = 1 then 'ADJ'
           when o_custkey % 10 = 3 then 'C>' else 'C_' end || cast(o_custkey as varchar) as store_code,
    p_brand as brand, 'S_' || cast(p_partkey as varchar) as product_sku_code,
    ' ' || case when o_orderkey % 3 = 0 then c_mktsegment else 'GENERAL' end || chr(9) as outlet_category_name,
    case when p_size % 10 = 0 then null else p_type end as category_desc,
    c_name as address, n_name as metro, r_name as region,
    case o_orderpriority when '1-URGENT' then 'Pharmacy' when '2-HIGH' then 'WSPharmacy'
      when '3-MEDIUM' then 'Based on history' else ' Retail ' end as bucket,
    format('{:,}', cast(floor(l_extendedprice * 0.9) as bigint)) as yago,
    cast(l_linenumber as varchar) as beat_code, l_extendedprice as value_sales,
    case when l_quantity = 1 then 0 else l_quantity end as vol_sales,
    format('{:,}', cast(floor(l_extendedprice) as bigint)) as rr, l_linenumber as num_invoices, l_orderkey
  from lineitem join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey join part on l_partkey = p_partkey""",
    "pos": """
  select pos_code, pos_desc,
    cast(1000341000 + case when k % 9 = 0 then (n + 1) % 25 else n end as varchar) as partner_code,
    pos_status, sales_rep_code, sales_rep_name from pos_base
  union all
  select pos_code, pos_desc, cast(1000341000 + (n + 2) % 25 as varchar), pos_status, sales_rep_code, sales_rep_name
  from pos_base where k % 20 = 0""",
    "pos_base": """
  select c_custkey as k, c_nationkey as n,
    case when c_custkey % 50 = 0 then 'ZOOM' when c_custkey % 50 = 1 then 'ADJ' else 'C_' end
      || cast(c_custkey as varchar) as pos_code,
    c_name || case when c_custkey % 13 = 0 then ' Counter' else '' end as pos_desc,
    case when c_custkey % 11 = 0 then '0' else '1' end as pos_status,
    case when c_custkey % 7 = 0 then null when c_custkey % 7 = 1 then ''
      else 'REP' || cast(c_custkey as varchar) end as sales_rep_code,
    case when c_custkey % 17 = 0 then 'COUNTER desk' else 'Rep' end as sales_rep_name
  from customer where c_custkey % 6 <> 0 or c_custkey % 20 = 0""",
    "area_map": """
  select cast(1000341000 + n_nationkey as varchar) as partner_code,
    case n_nationkey % 3 when 0 then 'Area_B X/Y' when 1 then 'area_' || n_name else 'AREA_A-Home' end as new_area
  from nation where n_nationkey % 4 <> 0
  union all
  select cast(1000341000 + n_nationkey as varchar), 'area_second' from nation where n_nationkey % 5 = 1""",
    "extract": """
  select o_orderkey as order_key, strftime(o_orderdate, '%Y/%m') as year_month,
    cast(1000341000 + n_nationkey as varchar) as distributor_code, n_name as distributor_name,
    'S' || cast(c_custkey as varchar) as store_code,
    case c_custkey % 4 when 0 then 'Distributor' when 1 then 'DISTRIBUTOR' when 2 then null else 'Modern' end as db_channel,
    '  ' || c_mktsegment || ' ' as channel_local,
    case n_nationkey % 5 when 0 then 'AREA_A-Home' when 1 then 'AREA_B X/Y' else 'Area_' || n_name end as asm,
    case when c_custkey % 13 = 0 then 'NA' when c_custkey % 17 = 0 then 'Pareto' when c_custkey % 23 = 0 then null
      else 'R' || cast(c_custkey as varchar) end as restated_store_code,
    case when c_custkey % 15 = 0 then 'NA' when c_custkey % 19 = 0 then 'Unknown'
      else 'SFC_' || cast(c_custkey as varchar) end as outlet_unique_code
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    "dist_list": """
  select cast(1000341000 + n_nationkey as varchar) as distributor_code from nation where n_nationkey % 5 <> 0""",
    "restricted_skus": """
  select cast(p_partkey as varchar) as material from part where p_partkey % 40 = 0""",
    "route_stores": """
  select cast(1000341000 + c_nationkey as varchar) || '_C_' || cast(c_custkey as varchar) as store_id,
    'REP' || cast(c_custkey % 30 as varchar) as sales_rep_id
  from customer where c_custkey % 3 <> 0""",
    "order_days": "select distinct cast(o_orderdate as date) as as_of from orders",
    # lookups shared by several queries
    "active": """
  select * from pos where sales_rep_code is not null and sales_rep_code <> '' and partner_code is not null
    and pos_code is not null and try_cast(pos_status as integer) = 1""",
    "pairs": "select distinct pos_code, partner_code from active",
    "counters": """
  select distinct pos_code from active
  where contains(upper(pos_desc), 'COUNTER') or contains(upper(sales_rep_name), 'COUNTER')""",
    "areas": """
  select partner_code, min(new_area) as new_area from (
    select partner_code, case upper(new_area) when 'AREA_B X/Y' then 'AREA_B XY' else upper(new_area) end as new_area
    from area_map) group by partner_code""",
    "windows": """
  select as_of, market,
    case when first_month is null then strftime(as_of - to_months(back), '%Y%m') else first_month end as start_month,
    case when month_end_open and as_of = last_day(as_of) then strftime(as_of, '%Y%m')
      else strftime(as_of - interval 1 month, '%Y%m') end as end_month
  from order_days, (values ('INDIA_HOME', 36, null, false), ('PAK_HEALTH', 36, null, false),
    ('INDIA_HEALTH', 25, null, false), ('INDO_HOME', 38, null, true),
    ('PAKISTAN_HOME', 0, '201701', true)) rules(market, back, first_month, month_end_open)""",
    # region preparation, one step per view
    "clean": """
  select * from (select * replace (trim(bucket, ' ' || chr(9) || chr(13) || chr(10)) as bucket,
      trim(outlet_category_name, ' ' || chr(9) || chr(13) || chr(10)) as outlet_category_name) from sales)
  where region is not null and value_sales > 0 and vol_sales > 0 and not coalesce(contains(bucket, 'Based on'), false)""",
    "uniq": """
  select * from clean qualify row_number() over (
    partition by region, year_month, city, store_code, brand, product_sku_code, value_sales, vol_sales
    order by address nulls first, outlet_category_name nulls first, category_desc nulls first, metro nulls first,
      bucket nulls first, yago nulls first, beat_code nulls first, rr nulls first, num_invoices nulls first) = 1""",
    "classed": """
  select u.* replace (c.outlet_category_name as outlet_category_name, c.bucket as bucket) from uniq u join (
    select region, store_code, outlet_category_name, bucket from uniq qualify row_number() over (
      partition by region, store_code order by (year_month is null) desc, year_month desc,
        outlet_category_name desc nulls last, bucket desc nulls last) = 1) c
  on u.region = c.region and u.store_code = c.store_code""",
    "remapped": """
  select c.* replace (coalesce(partner_code, 'NA') || '_' || substr(store_code, strpos(store_code, '_') + 1) as store_code)
  from classed c left join pairs on replace(substr(store_code, strpos(store_code, '_') + 1), '>', '_') = pos_code""",
    "ranked_months": """
  select region, year_month, row_number() over (partition by region order by year_month desc) as month_rank
  from (select distinct region, year_month from remapped)""",
    "routed": "select * from remapped where store_code in (select store_id from route_stores)",
    "active_codes": """
  select distinct region, store_code from remapped r where not regexp_matches(store_code, 'ZOOM|ADJ')
  and year_month in (select year_month from (
      select region as g, year_month, row_number() over (partition by region order by year_month desc) as k
      from (select distinct region, year_month from remapped where not regexp_matches(store_code, 'ZOOM|ADJ')))
    where g = r.region and k <= 4)""",
}

SALES = (
    "year_month, city, store_code, brand, product_sku_code, outlet_category_name, category_desc, address, metro, "
    "region, bucket, yago, beat_code, value_sales, vol_sales, rr, num_invoices"
)
HISTORY = (
    "Year_Month, City, Store_Code, Brand, Product_SKU_Code, Outlet_category_name, Category_Desc, Address, Metro, "
    "Region, Bucket, YAGO, Beat_Code, ValueSales, VolSales, RR, NUM_INVOICES"
)


def _named(columns: str, names: str) -> str:
    return ", ".join(
        f'{column.strip()} as "{name.strip()}"' for column, name in zip(columns.split(","), names.split(","), strict=True)
    )


EXTRACT_NAMES = ", ".join(f"V{n}" for n in range(1, 18))
REST = "substr(store_code, strpos(store_code, '_') + 1)"
OUTLET_OF = f"case when strpos(store_code, '_') > 0 then {REST} else '' end"
NOT_COUNTER = f"replace({OUTLET_OF}, '>', '_') not in (select pos_code from counters)"
NOT_RESTRICTED = (
    "not (product_sku_code in (select 'S_' || material from restricted_skus) "
    "and not coalesce(bucket in ('Pharmacy', 'WSPharmacy'), false))"
)
FILLED = "case when category_desc is null and value_sales > 0 then 'Others' else category_desc end"
ACTIVE_STORE = "(region, store_code) in (select (region, store_code) from active_codes)"
NUMBERS = "try_cast(replace(yago, ',', '') as double) as yago, try_cast(replace(rr, ',', '') as double) as rr"


def _history(source: str, *conditions: str) -> str:
    kept = " and ".join((NOT_COUNTER, "not regexp_matches(store_code, 'ZOOM|ADJ')", *conditions))
    return (
        f"select distinct {_named(SALES, HISTORY)} from "
        f"(select * replace ({NUMBERS}, {FILLED} as category_desc) from {source} where {kept})"
    )


def _extract(source: str, months: int, *conditions: str) -> str:
    kept = " and ".join(
        (
            NOT_COUNTER,
            f"(region, year_month) in (select (region, year_month) from ranked_months where month_rank <= {months})",
            *conditions,
        )
    )
    return (
        f"select distinct {_named(SALES, EXTRACT_NAMES)} from "
        f"(select * replace ({FILLED} as category_desc) from {source} where {kept})"
    )


RAW_RULED = """
  select * replace (
    upper(case asm when 'AREA_A-Home' then 'AREA_A-HOME' when 'AREA_B X/Y' then 'AREA_B XY' else asm end) as asm,
    case when outlet_unique_code = 'NA' then restated_store_code else outlet_unique_code end as outlet_unique_code)
  from (select * replace (case when distributor_code in ('1000341003', '1000341007') then 'DISTRIBUTOR'
    else db_channel end as db_channel) from extract) where year_month between '1996/12' and '1998/12'"""
VALID = """upper(db_channel) = 'DISTRIBUTOR' and restated_store_code not in ('NA', 'Not Available', 'Pareto')
  and outlet_unique_code not in ('NA', 'Not Available', 'Pareto', 'Unknown')"""
COUNTRY = f"select * from ({RAW_RULED}) where {VALID}"
CORRECTED = f"""
  select distinct s.* replace (coalesce(p.partner_code, s.distributor_code) as distributor_code,
    replace(s.outlet_unique_code, 'SF', '') as outlet_unique_code, coalesce(a.new_area, s.asm) as asm)
  from ({COUNTRY}) s left join pairs p on replace(s.outlet_unique_code, 'SF', '') = p.pos_code
  left join areas a on a.partner_code = coalesce(p.partner_code, s.distributor_code)"""


def _area_choice(seen: str) -> str:
    return f"""select partner_code, new_area from (
      select partner_code, new_area, 0 as priority from areas union all
      select distinct distributor_code, asm, 1 from ({seen})) where new_area is not null
    qualify row_number() over (partition by partner_code order by priority, new_area) = 1"""


QUERIES = {
    # sources and sinks give back what was written
    "scan_csv_pipe": "select * from extract",
    "scan_csv_lookup": "select * from area_map",
    # an empty field of a file reads as null
    "scan_csv_strings": "select * replace (nullif(sales_rep_code, '') as sales_rep_code) from pos",
    "latest_file_rows": "select * from sales where year_month[1:4] = (select max(year_month)[1:4] from sales)",
    "latest_dated_snapshot": """select * from sales where year_month[1:4] = '2000'
      and num_invoices % 2 = (select max(num_invoices % 2) from sales where year_month[1:4] = '2000')""",
    "scan_table_where": "select * from sales where region = 'ASIA'",
    "temp_view_roundtrip": "select * from pos",
    "sink_overwrite_table": "select * from sales",
    "sink_ctas_copy": "select * from extract",
    "sink_partition_by_region": """
      select * replace (case when region = 'ASIA' then 'again' else rr end as rr) from sales where region <> 'EUROPE'""",
    # names and columns
    "normalize_names": "select * from extract",
    "rename_columns": """select order_key, year_month, distributor_code as "DB", distributor_name, store_code, db_channel,
      channel_local, asm, restated_store_code, outlet_unique_code as "POSCode" from extract""",
    "rename_positional": f"select {_named(SALES, HISTORY)} from sales",
    "drop_columns": "select * exclude (metro, num_invoices, yago) from sales",
    "select_columns": "select year_month, store_code, outlet_category_name, bucket from sales",
    "restore_column_order": """select e.* replace (coalesce(p.partner_code, e.distributor_code) as distributor_code)
      from extract e left join pairs p on e.outlet_unique_code = p.pos_code""",
    "take_leading_columns": "select * from sales",
    # filters
    "filter_month_window": "select * from extract where year_month between '1996/12' and '1998/12'",
    "filter_valid_outlets": f"select * from extract where {VALID}",
    "filter_active_pos": "select * from active",
    "filter_positive_sales": "select * from sales where value_sales > 0 and vol_sales > 0 and not isnan(value_sales) and not isnan(vol_sales)",
    "filter_not_contains": "select * from sales where not coalesce(contains(bucket, 'Based on'), false)",
    "filter_not_regex": "select * from sales where not coalesce(regexp_matches(store_code, 'ZOOM|ADJ'), false)",
    "counter_outlets": """select distinct pos_code from pos
      where contains(upper(pos_desc), 'COUNTER') or contains(upper(sales_rep_name), 'COUNTER')""",
    # scalar functions
    "override_by_code": """select * replace (case when distributor_code in ('1000341003', '1000341007')
      then 'DISTRIBUTOR' else db_channel end as db_channel) from extract""",
    "map_values": """select * replace (upper(case asm when 'AREA_A-Home' then 'AREA_A-HOME'
      when 'AREA_B X/Y' then 'AREA_B XY' else asm end) as asm) from extract""",
    "sentinel_fallback": """select * replace (case when outlet_unique_code = 'NA' then restated_store_code
      else outlet_unique_code end as outlet_unique_code) from extract""",
    "fill_null_category": f"select * replace ({FILLED} as category_desc) from sales",
    "regex_recode": "select * replace (replace(distributor_code, '341', '161') as distributor_code) from extract",
    "strip_token": "select * replace (replace(outlet_unique_code, 'SF', '') as outlet_unique_code) from extract",
    "replace_char": f"select *, replace({OUTLET_OF}, '>', '_') as outlet from sales",
    "compose_store_code": "select *, partner_code || '_' || pos_code as store_code from pos",
    "split_store_code": f"select *, split_part(store_code, '_', 1) as v18, {OUTLET_OF} as v19 from sales",
    "trim_spaces": "select * replace (trim(channel_local) as channel_local) from extract",
    "trim_whitespace": """select * replace (trim(bucket, ' ' || chr(9) || chr(13) || chr(10)) as bucket,
      trim(outlet_category_name, ' ' || chr(9) || chr(13) || chr(10)) as outlet_category_name) from sales""",
    "sanitize_value": "select * replace (regexp_replace(region, '[^A-Za-z0-9_]', '_', 'g') as region) from sales",
    "parse_number": f"select * replace ({NUMBERS}) from sales",
    "month_to_date": "select *, cast(replace(year_month, '/', '-') || '-01' as date) as month_start from sales",
    "date_to_month": "select as_of, strftime(as_of, '%Y/%m') as year_month, strftime(as_of, '%Y%m') as month_code from order_days",
    "snapshot_tag": """select as_of, as_of = last_day(as_of) as month_end, strftime(case when as_of = last_day(as_of)
      then as_of + interval 1 day else as_of end, '%Y%m%d') as tag from order_days""",
    "market_windows": "select * from windows",
    "month_sequence": """select as_of, market, strftime(m.month, '%Y/%m') as year_month
      from windows left join (select distinct start_month, end_month, unnest(generate_series(
        strptime(start_month, '%Y%m'), strptime(end_month, '%Y%m'), interval 1 month)) as month from windows) m
        using (start_month, end_month)""",
    # joins
    "remap_distributor": """select e.* replace (coalesce(p.partner_code, e.distributor_code) as distributor_code,
      replace(e.outlet_unique_code, 'SF', '') as outlet_unique_code)
      from extract e left join pairs p on replace(e.outlet_unique_code, 'SF', '') = p.pos_code""",
    "remap_area": """select e.* replace (coalesce(a.new_area, e.asm) as asm)
      from extract e left join areas a on e.distributor_code = a.partner_code""",
    "latest_class_per_store": """select s.* replace (c.outlet_category_name as outlet_category_name, c.bucket as bucket)
      from sales s join (select region, store_code, outlet_category_name, bucket from sales qualify row_number() over (
        partition by region, store_code order by (year_month is null) desc, year_month desc,
          outlet_category_name desc nulls last, bucket desc nulls last) = 1) c
      on s.region = c.region and s.store_code = c.store_code""",
    "remap_store_code": f"""select s.* replace (coalesce(partner_code, 'NA') || '_' || {OUTLET_OF} as store_code)
      from sales s left join pairs on replace({OUTLET_OF}, '>', '_') = pos_code""",
    "semi_distributors": "select * from extract where distributor_code in (select distributor_code from dist_list)",
    "semi_route_stores": "select * from sales where store_code in (select store_id from route_stores)",
    "semi_active_stores": """select * from sales where (region, store_code) in (
      select (s.region, s.store_code) from sales s join (
        select region, year_month from (select distinct region, year_month from sales)
        qualify row_number() over (partition by region order by year_month desc) <= 4) m
      on s.region = m.region and s.year_month = m.year_month where s.vol_sales > 0)""",
    "anti_counter_outlets": f"select * from sales where {NOT_COUNTER}",
    "anti_restricted_skus": f"select * from sales where {NOT_RESTRICTED}",
    # distinct, dedupe, top months
    "distinct_rows": "select distinct * from (select * from sales union all select * from sales where num_invoices = 1)",
    "distinct_pairs": "select distinct pos_code, partner_code from pos",
    "distinct_values": "select distinct store_code from sales",
    "dedupe_by_key": "select partner_code, min(new_area) as new_area from area_map group by partner_code",
    "dedupe_sales": """select * from sales qualify row_number() over (
      partition by region, year_month, city, store_code, brand, product_sku_code, value_sales, vol_sales
      order by address nulls first, outlet_category_name nulls first, category_desc nulls first, metro nulls first,
        bucket nulls first, yago nulls first, beat_code nulls first, rr nulls first, num_invoices nulls first) = 1""",
    "precedence_union_map": _area_choice("select * from extract"),
    "stage_row_counts": """select 'loaded' as stage, region, count(*) as row_count from sales group by region
      union all select 'positive', region, count(*) from sales where value_sales > 0 and vol_sales > 0 group by region
      union all select 'measured', region, count(*) from sales
        where value_sales > 0 and vol_sales > 0 and bucket not like '%Based on%' group by region
      union all select 'unique', region, count(*) from (
        select distinct region, year_month, city, store_code, brand, product_sku_code, value_sales, vol_sales
        from sales where value_sales > 0 and vol_sales > 0 and bucket not like '%Based on%') group by region""",
    "focus_months_extract": """select s.* from sales s join (
        select region, year_month from (select distinct region, year_month from sales)
        qualify row_number() over (partition by region order by year_month desc) <= 6) m
      on s.region = m.region and s.year_month = m.year_month""",
    "months_present": "select distinct region, year_month from sales order by region, year_month",
    # whole jobs
    "country_extract": COUNTRY,
    "country_extract_channel": """select * replace (trim(channel_local) as channel_local,
      case when distributor_code in ('1000341003', '1000341007') then 'DISTRIBUTOR' else db_channel end as db_channel)
      from extract where year_month between '1996/01' and '1998/12'""",
    "country_extract_listed": """select order_key, year_month,
      replace(distributor_code, '341', '161') || '_' || store_code as store_code, db_channel, channel_local, asm,
      restated_store_code, outlet_unique_code from extract
      where year_month between '1997/03' and '1999/06' and distributor_code in (select distributor_code from dist_list)""",
    "country_extract_open_month": """select * from extract where year_month between '1995/11' and '1999/01'
      and distributor_code in (select distributor_code from dist_list)""",
    "corrected_sales": CORRECTED,
    "built_area_map": _area_choice(CORRECTED),
    "sales_history": _history("remapped", NOT_RESTRICTED),
    "sales_history_active_stores": _history("remapped", ACTIVE_STORE),
    "sales_history_route_stores": _history("routed"),
    "published_history": _history("remapped", NOT_RESTRICTED),
    "focus_extract": _extract("remapped", 6, NOT_RESTRICTED),
    "focus_extract_five_months": _extract("remapped", 5),
    "focus_extract_active_stores": _extract("remapped", 6, ACTIVE_STORE),
}


def _with_views(query: str) -> str:
    """Put the views a query needs, and those they need, in front of it."""
    order: list[str] = []

    def need(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in order and _mentions(text, name):
                need(body)
                if name not in order:
                    order.append(name)

    need(query)
    return "with " + ",\n".join(f"{name} as materialized ({VIEWS[name]})" for name in order) + "\n" + query


def _mentions(text: str, name: str) -> bool:
    return re.search(rf"\b(from|join|,)\s+{name}\b", text) is not None


def oracle() -> dict[str, str]:
    return {name: _with_views(query) for name, query in QUERIES.items()}
