"""The models as SQL for DuckDB, written apart from the DataFrame plans, to compare results with."""

from __future__ import annotations

import re

from tidemart.config import DEFAULT
from tidemart.operators.silver import TIES
from tidemart.schemas import MERGE_SET

AS_OF = f"date '{DEFAULT.as_of}'"
END = f"date '{DEFAULT.scd2_end}'"
NOW = f"cast({AS_OF} as timestamp)"


def money(x: str) -> str:
    return f"cast(sum(cast({x} as decimal(18,4))) as double)"


def fine(x: str) -> str:
    return f"cast(sum(cast({x} as decimal(20,8))) as double)"


def key(*fields: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce(cast({f} as varchar), '_null_')" for f in fields) + ")"


def pct(part: str) -> str:
    return f"cast(round(cast(100 * cast({part} as decimal(18,4)) / nullif(transaction_count, 0) as decimal(18,6)), 2) as double)"


def place(city: str, state: str, country: str) -> str:
    return "concat_ws(', ', " + ", ".join(f"nullif(trim({x}), '')" for x in (city, state, country)) + ")"


SALES = """
select l_orderkey || '-' || l_linenumber as row_id, 'ORD-' || l_orderkey as order_id, cast(o_orderdate as date) as order_date,
  cast(l_shipdate as date) as ship_date, l_returnflag as ship_mode, 'CUST-' || o_custkey as customer_id, c_name as customer_name,
  c_mktsegment as segment, n_name as city, cast(null as varchar) as state, n_name as country, cast(null as varchar) as postal_code,
  r_name as market, upper(r_name) as region, 'PROD-' || l_partkey as product_id, p_type as category, p_brand as sub_category,
  p_name as product_name, l_extendedprice as sales, cast(l_quantity as int) as quantity, l_discount as discount,
  l_extendedprice * (0.15::double - l_discount) as profit, l_extendedprice * l_tax as shipping_cost, o_orderpriority as order_priority,
  cast(l_shipdate as timestamp) + to_hours(l_partkey % 24) as processing_timestamp
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey join part on l_partkey = p_partkey
"""

squeeze = lambda x: f"regexp_replace(trim({x}), '\\s+', ' ', 'g')"

CLEANED = f"""
select sha256(coalesce(source_row_id, '') || '||' || coalesce(order_id, '') || '||' || coalesce(product_id, '') || '||BATCH') as row_id,
  * exclude (row_id), case when quantity > 0 then sales / quantity else 0.0 end as unit_price,
  case when sales > 0 then profit / sales else 0.0 end as profit_margin,
  case when (upper(trim(city)), upper(trim(country))) in (('SÃO PAULO', 'CHILE'), ('BUENOS AIRES', 'CHILE'), ('LAGOS', 'SOUTH AFRICA'))
    then 'INVALID_CITY_COUNTRY' else 'VALID' end as geo_quality_flag
from (
  select * replace (trim(order_id) as order_id, trim(product_id) as product_id, trim(customer_id) as customer_id,
      upper({squeeze('category')}) as category, upper({squeeze('sub_category')}) as sub_category, {squeeze('segment')} as segment,
      {squeeze('region')} as region, {squeeze('country')} as country, {squeeze('state')} as state, {squeeze('city')} as city,
      case when sales > {DEFAULT.sales_threshold} then {DEFAULT.sales_threshold} else sales end as sales),
    nullif(trim(row_id), '') as source_row_id, {NOW} as ingestion_timestamp, 'BATCH' as source_system, 'batch' as batch_id,
    strftime({AS_OF}, '%Y-%m-%d') as partition_date
  from sales_view where order_id is not null
)
"""

JUDGED = """
select *, case when order_id is null or order_id = '' then 'missing_order_id' when product_id is null or product_id = '' then 'missing_product_id'
  when sales is null or sales <= 0 then 'invalid_sales' when quantity is null or quantity <= 0 then 'invalid_quantity'
  when order_date is null or ship_date is null then 'missing_date' when order_date > ship_date then 'date_violation' end as rejection_reason
from cleaned
"""

#: Columns of a cleaned row in the order in which a tie falls to them.
ROW = (
    "source_row_id order_id order_date ship_date ship_mode customer_id customer_name segment city state country postal_code market region "
    "product_id category sub_category product_name sales quantity discount profit shipping_cost order_priority processing_timestamp"
).split()
_ties = ", ".join(f"{x} desc nulls last" for x in ["processing_timestamp", *TIES, *[x for x in ROW if x not in TIES]])

BY_SOURCE = f"""
select * exclude (rejection_reason) from judged where rejection_reason is null
qualify row_number() over (partition by coalesce(source_row_id, row_id) order by {_ties}) = 1
"""
SILVER = f"select * from by_source qualify row_number() over (partition by order_id, product_id order by {_ties}) = 1"

STG_SALES = f"""
select * from (
  select {key('order_id', 'product_id')} as sales_silver_key, order_id, customer_id, product_id, order_date, ship_date, ship_mode, order_priority,
    customer_name, segment as customer_segment, city, state, country, postal_code, market, region, product_name, category, sub_category, quantity,
    case when quantity > 0 then sales / quantity else 0.0 end as unit_price, sales as sales_amount, coalesce(discount, 0.0::double) as discount_rate,
    profit as profit_amount, shipping_cost, sales as gross_amount, sales * discount as discount_amount,
    sales * (1 - coalesce(discount, 0.0::double)) as net_amount, order_date as sale_date, processing_timestamp, upper(trim(source_system)) as source_system,
    case when quantity <= 0 then false when sales <= 0 then false when order_date is null then false
      when ship_date is not null and ship_date < order_date then false when discount < 0 or discount > 1 then false else true end as is_valid_record,
    cast((order_id is not null)::int * 15 + (customer_id is not null)::int * 15 + (product_id is not null)::int * 15
      + coalesce(quantity > 0, false)::int * 10 + coalesce(sales > 0, false)::int * 10 + (order_date is not null)::int * 10
      + (customer_name is not null)::int * 5 + (category is not null)::int * 5 + (region is not null)::int * 5 + (country is not null)::int * 5
      + coalesce(upper(trim(source_system)) in ('BATCH', 'KAFKA'), false)::int * 5 as int) as data_quality_score,
    {NOW} as created_at, {NOW} as updated_at, 'local' as invocation_id, 'dev' as target_name
  from silver
) where is_valid_record and data_quality_score >= 70
"""

STG_CUSTOMERS = f"""
with newest as (
  select * from stg_sales where customer_id is not null
  qualify row_number() over (partition by customer_id order by case when trim(coalesce(customer_name, '')) <> '' then 0 else 1 end,
    order_date desc, processing_timestamp desc, order_id desc, product_id desc) = 1
), totals as (
  select customer_id, count(distinct order_id) as total_orders, cast(sum(quantity) as bigint) as total_items_purchased, {money('sales_amount')} as lifetime_value,
    {money('sales_amount')} / count(sales_amount) as avg_order_value, {money('profit_amount')} as total_profit_generated,
    max(order_date) as last_order_date, min(order_date) as effective_date, max(processing_timestamp) as ingestion_timestamp
  from stg_sales group by customer_id
)
select {key('t.customer_id')} as customer_key, upper(trim(t.customer_id)) as customer_id, trim(customer_name) as customer_name,
  upper(trim(customer_segment)) as customer_segment, trim(city) as city, upper(trim(state)) as state, upper(trim(country)) as country,
  trim(postal_code) as postal_code, upper(trim(market)) as market, upper(trim(region)) as region, {place('city', 'state', 'country')} as full_location,
  total_orders, total_items_purchased, lifetime_value, avg_order_value, total_profit_generated,
  case when lifetime_value >= 10000 then 'PLATINUM' when lifetime_value >= 5000 then 'GOLD' when lifetime_value >= 1000 then 'SILVER' else 'BRONZE' end as value_tier,
  case when last_order_date - effective_date >= 1095 then 'LOYAL' when last_order_date - effective_date >= 365 then 'ESTABLISHED'
    when last_order_date - effective_date >= 90 then 'REGULAR' else 'NEW' end as tenure_category,
  effective_date, last_order_date, cast(last_order_date - effective_date as int) as customer_tenure_days,
  last_order_date >= {AS_OF} - 90 as is_active, true as is_valid_record,
  cast(20 + (trim(coalesce(customer_name, '')) <> '')::int * 15 + (customer_segment is not null)::int * 15 + (city is not null)::int * 10
    + (country is not null)::int * 10 + (region is not null)::int * 10 + (total_orders > 0)::int * 10 + (lifetime_value > 0)::int * 10 as int) as data_quality_score,
  t.ingestion_timestamp, {NOW} as created_at, {NOW} as updated_at, 'local' as invocation_id, 'dev' as target_name
from totals t join newest n on t.customer_id = n.customer_id
where trim(t.customer_id) <> '' and total_orders > 0 and lifetime_value > 0 and effective_date is not null
"""

STG_PRODUCTS = f"""
with newest as (
  select * from stg_sales where product_id is not null and product_id <> ''
  qualify row_number() over (partition by product_id order by sale_date desc, processing_timestamp desc, order_id desc) = 1
), totals as (
  select product_id, {fine('unit_price')} / count(unit_price) as unit_price, min(unit_price) as min_unit_price, max(unit_price) as max_unit_price,
    count(distinct order_id) as total_orders, cast(sum(quantity) as bigint) as total_quantity_sold, {money('sales_amount')} as total_sales,
    {money('profit_amount')} / count(profit_amount) as profit, max(sale_date) as last_sale_date, min(sale_date) as effective_date,
    max(processing_timestamp) as ingestion_timestamp
  from stg_sales group by product_id
)
select {key('t.product_id')} as product_key, upper(trim(t.product_id)) as product_id, trim(product_name) as product_name,
  upper(trim(category)) as category, upper(trim(sub_category)) as sub_category, t.unit_price, min_unit_price, max_unit_price,
  case when t.unit_price > 0 then cast(round(cast(profit / t.unit_price as decimal(20,8)), 4) as double) end as estimated_profit_margin_pct,
  total_orders, total_quantity_sold, total_sales, effective_date, last_sale_date, last_sale_date >= {AS_OF} - 30 as is_active, true as is_valid_record,
  cast(25 + 20 + 15 + (sub_category is not null)::int * 10 + 15 + (total_orders > 0)::int * 10 + (total_sales > 0)::int * 5 as int) as data_quality_score,
  t.ingestion_timestamp, {NOW} as created_at, {NOW} as updated_at, 'local' as invocation_id, 'dev' as target_name
from totals t join newest n on t.product_id = n.product_id
where trim(coalesce(product_name, '')) <> '' and t.unit_price > 0 and category is not null
"""

PART_OF_DAY = "case when {h} between 6 and 11 then 'MORNING' when {h} between 12 and 17 then 'AFTERNOON' when {h} between 18 and 21 then 'EVENING' else 'NIGHT' end"

UNIFIED = f"""
select sales_silver_key as unified_sales_key, order_id, customer_id as store_id, product_id, customer_id, product_name, category, quantity, unit_price,
  sales_amount as total_price, discount_rate, gross_amount, discount_amount, net_amount, profit_amount,
  coalesce(profit_amount, net_amount * 0.15::double) as estimated_profit,
  case when net_amount > 0 then coalesce(profit_amount, net_amount * 0.15::double) / net_amount end as profit_margin_pct,
  processing_timestamp as sale_timestamp, sale_date, cast(hour(processing_timestamp) as int) as sale_hour, ship_date, 'UNKNOWN' as payment_method,
  {place('city', 'state', 'country')} as store_location, customer_segment, region, country, state, city,
  case when net_amount < 50 then 'SMALL' when net_amount < 200 then 'MEDIUM' when net_amount < 500 then 'LARGE' else 'EXTRA_LARGE' end as transaction_size_category,
  case when discount_rate = 0 then 'NO_DISCOUNT' when discount_rate <= 0.1::double then 'LOW_DISCOUNT' when discount_rate <= 0.25::double then 'MEDIUM_DISCOUNT' else 'HIGH_DISCOUNT' end as discount_category,
  case when quantity = 1 then 'SINGLE_ITEM' when quantity <= 5 then 'FEW_ITEMS' when quantity <= 10 then 'MULTIPLE_ITEMS' else 'BULK_PURCHASE' end as quantity_category,
  {PART_OF_DAY.format(h='hour(processing_timestamp)')} as time_of_day,
  case when dayofweek(order_date) in (0, 6) then 'WEEKEND' else 'WEEKDAY' end as day_type,
  case when source_system = 'KAFKA' then 'STREAMING' else source_system end as data_source, source_system, processing_timestamp as ingestion_timestamp,
  order_date as partition_date, is_valid_record, data_quality_score,
  cast(data_quality_score + (coalesce(customer_id, '') <> '')::int * 5 + (profit_amount is not null)::int * 5 + (region is not null)::int * 5
    + (customer_segment is not null)::int * 5 as int) as enhanced_quality_score, created_at, updated_at
from stg_sales where enhanced_quality_score >= 75
"""

PRODUCT_SCD2 = f"""
select {key('product_id', 'effective_date', 'version_number')} as product_scd2_key, product_id, product_name, category, sub_category, 'UNKNOWN' as brand,
  cast(round(cast(unit_price * 0.70::double as decimal(20,8)), 2) as double) as unit_cost, unit_price, 0.30::double as profit_margin_pct, effective_date, expiration_date,
  version_number = 1 as is_current, is_active, version_number, case when version_number = 1 then 'CURRENT_VERSION' else 'HISTORICAL_VERSION' end as change_type,
  case when expiration_date <> {END} then cast(expiration_date - effective_date + 1 as int) end as days_active,
  case when unit_price < 10 then 'LOW_PRICE' when unit_price < 50 then 'MEDIUM_PRICE' when unit_price < 200 then 'HIGH_PRICE' else 'PREMIUM_PRICE' end as price_tier,
  'HIGH_MARGIN' as margin_tier, is_valid_record, data_quality_score, ingestion_timestamp, created_at, updated_at
from (
  select *, cast(row_number() over (partition by product_id order by effective_date desc, ingestion_timestamp desc, product_key desc) as int) as version_number,
    coalesce(lead(effective_date) over (partition by product_id order by effective_date, ingestion_timestamp, product_key) - 1, {END}) as expiration_date
  from stg_products
)
"""

_age = f"(year({AS_OF}) - year(effective_date))"
STORE_SCD2 = f"""
select {key('customer_id', 'effective_date', '1')} as store_scd2_key, customer_id as store_id, customer_name as store_name, city as store_location, 'RETAIL' as store_type,
  city, state, country, region, full_location, effective_date as opening_date,
  case when customer_tenure_days >= 1095 then 'LEGACY' when customer_tenure_days >= 365 then 'ESTABLISHED' when customer_tenure_days >= 90 then 'MATURE' else 'NEW' end as store_age_category,
  effective_date, {END} as expiration_date, true as is_current, is_active, 1 as version_number, 'NEW_STORE' as change_type, cast(null as int) as days_active,
  case when {_age} >= 10 then 'LEGACY' when {_age} >= 5 then 'ESTABLISHED' when {_age} >= 2 then 'MATURE' when {_age} >= 1 then 'DEVELOPING' else 'NEW' end as maturity_level,
  case when region in ('NORTH', 'NORTHEAST', 'NORTHWEST') then 'NORTHERN_REGIONS' when region in ('SOUTH', 'SOUTHEAST', 'SOUTHWEST') then 'SOUTHERN_REGIONS'
    when region in ('EAST', 'WEST') then 'COASTAL_REGIONS' when region in ('CENTRAL', 'MIDWEST') then 'CENTRAL_REGIONS' else 'OTHER_REGIONS' end as geographic_cluster,
  is_valid_record, data_quality_score, ingestion_timestamp, created_at, updated_at
from stg_customers
"""

SPINE = f"select cast(d as date) as date_day from range(timestamp '{DEFAULT.spine_start}', timestamp '{DEFAULT.spine_end}', interval 1 day) as r(d)"

DIM_DATE = f"""
select cast(strftime(date_day, '%Y%m%d') as int) as date_key, date_day as date_value, cast(dayofweek(date_day) as int) as day_of_week,
  cast(day(date_day) as int) as day_of_month, cast(dayofyear(date_day) as int) as day_of_year, dayname(date_day) as day_name,
  cast(weekofyear(date_day) as int) as week_of_year, cast(date_trunc('week', date_day) as date) as week_start_date,
  cast(date_trunc('week', date_day) as date) + 6 as week_end_date, cast(month(date_day) as int) as month_number, monthname(date_day) as month_name,
  monthname(date_day)[1:3] as month_abbreviation, cast(quarter(date_day) as int) as quarter, 'Q' || quarter(date_day) as quarter_name,
  cast(year(date_day) as int) as year_number, dayofweek(date_day) in (0, 6) as is_weekend, holiday_name is not null as is_holiday, holiday_name,
  cast(year(date_day) - (month(date_day) = 1)::int as int) as fiscal_year,
  case when month(date_day) in (2, 3, 4) then 1 when month(date_day) in (5, 6, 7) then 2 when month(date_day) in (8, 9, 10) then 3 else 4 end as fiscal_quarter,
  cast(case when month(date_day) >= 2 then month(date_day) - 1 else month(date_day) + 11 end as int) as fiscal_month, {NOW} as created_at, {NOW} as updated_at
from int_date_spine left join (values (1, 1, 'New Year''s Day'), (7, 4, 'Independence Day'), (12, 25, 'Christmas Day')) as h(m, d, holiday_name)
  on month(date_day) = h.m and day(date_day) = h.d
"""

DIM_PRODUCT = """
select row_number() over (order by product_id, effective_date) as product_key, product_id, product_name, category, sub_category, brand, unit_cost, unit_price,
  profit_margin_pct, cast(null as varchar) as product_size, cast(null as varchar) as product_color, cast(null as double) as product_weight, effective_date,
  expiration_date, is_current, is_active, version_number, change_type, days_active, price_tier, margin_tier,
  case when category in ('TECHNOLOGY', 'ELECTRONICS') then 'HIGH_TECH' when category in ('FURNITURE', 'OFFICE_SUPPLIES') then 'TRADITIONAL' else 'OTHER' end as product_family,
  case when unit_price / nullif(unit_cost, 0) >= 3 then 'HIGH_MARKUP' when unit_price / nullif(unit_cost, 0) >= 2 then 'MEDIUM_MARKUP'
    when unit_price / nullif(unit_cost, 0) >= 1.5::double then 'LOW_MARKUP' else 'MINIMAL_MARKUP' end as markup_category,
  data_quality_score, ingestion_timestamp, created_at, updated_at
from int_product_scd2 where is_valid_record and data_quality_score >= 80
"""

_open = f"(year({AS_OF}) - year(opening_date))"
DIM_STORE = f"""
select row_number() over (order by store_id, effective_date) as store_key, store_id, store_name, store_location, city, state, country, region, store_type, opening_date,
  cast(null as double) as latitude, cast(null as double) as longitude, cast(null as varchar) as timezone, cast(null as int) as store_size_sqft,
  cast(null as int) as employee_count, effective_date, expiration_date, is_current, is_active, version_number, change_type, days_active,
  store_age_category, maturity_level, geographic_cluster, full_location,
  case when store_type in ('FLAGSHIP', 'WAREHOUSE') then 'LARGE_FORMAT' when store_type in ('OUTLET', 'KIOSK') then 'SMALL_FORMAT' else 'STANDARD_FORMAT' end as store_format,
  case when region in ('WEST', 'EAST') then 'COASTAL' when region in ('CENTRAL', 'MIDWEST') then 'INLAND' else 'OTHER' end as geographic_tier,
  case when {_open} < 1 then 'RAMP_UP' when {_open} < 3 then 'GROWTH' when {_open} < 10 then 'MATURE' else 'LEGACY' end as lifecycle_stage,
  data_quality_score, ingestion_timestamp, created_at, updated_at
from int_store_scd2 where is_valid_record and data_quality_score >= 80
"""

DIM_CUSTOMER = f"""
with newest as (
  select * from int_sales_unified where coalesce(customer_id, '') <> ''
  qualify row_number() over (partition by customer_id order by sale_date desc, ingestion_timestamp desc, unified_sales_key desc) = 1
), totals as (
  select customer_id, min(sale_date) as first_purchase_date, max(sale_date) as last_purchase_date, count(distinct order_id) as total_orders,
    {money('net_amount')} as total_spent, {money('net_amount')} / count(net_amount) as avg_order_value, cast(sum(quantity) as bigint) as total_items_purchased,
    cast({AS_OF} - max(sale_date) as int) as since, max(enhanced_quality_score) as score, min(ingestion_timestamp) as first_seen
  from int_sales_unified group by customer_id
)
select row_number() over (order by t.customer_id) as customer_key, t.customer_id, cast(null as varchar) as customer_name,
  coalesce(customer_segment, 'UNKNOWN') as customer_segment, 'INDIVIDUAL' as customer_type, cast(null as varchar) as age_range, cast(null as varchar) as gender,
  cast(null as varchar) as income_bracket, city, state, country, region, first_purchase_date, last_purchase_date, since <= 30 as is_active, total_orders,
  total_spent, avg_order_value, total_items_purchased, since as days_since_last_purchase, total_orders as purchase_frequency, total_spent as monetary_value,
  case when since <= 30 then 'RECENT' when since <= 90 then 'MODERATE' when since <= 365 then 'DORMANT' else 'LOST' end as recency_segment,
  case when total_orders >= 10 then 'HIGH_FREQUENCY' when total_orders >= 5 then 'MEDIUM_FREQUENCY' when total_orders >= 2 then 'LOW_FREQUENCY' else 'ONE_TIME' end as frequency_segment,
  case when total_spent >= 1000 then 'HIGH_VALUE' when total_spent >= 500 then 'MEDIUM_VALUE' when total_spent >= 100 then 'LOW_VALUE' else 'MINIMAL_VALUE' end as monetary_segment,
  case when total_spent >= 10000 then 'VIP' when total_spent >= 5000 then 'HIGH_VALUE' when total_spent >= 1000 then 'REGULAR' else 'OCCASIONAL' end as customer_value_tier,
  score as data_quality_score, first_seen as ingestion_timestamp, {NOW} as created_at, {NOW} as updated_at
from totals t join newest n on t.customer_id = n.customer_id where score >= 75
"""

FACT = """
select row_number() over (order by date_key, unified_sales_key) as sales_key, date_key, sale_hour * 10000 as time_key, product_key, store_key, customer_key,
  s.order_id, payment_method, quantity as quantity_sold, gross_amount as gross_sales_amount, discount_amount, net_amount as net_sales_amount,
  s.unit_price * quantity - estimated_profit as cost_amount, estimated_profit as profit_amount, s.unit_price,
  coalesce(s.unit_price * quantity - estimated_profit, 0) as unit_cost, s.profit_margin_pct, discount_rate as discount_pct, sale_timestamp,
  data_source as source_system, transaction_size_category, discount_category, quantity_category, time_of_day, day_type, data_source,
  s.data_quality_score, s.created_at, s.updated_at
from int_sales_unified s join dim_date d on s.sale_date = d.date_value
  left join dim_product p on s.product_id = p.product_id and p.is_current and s.sale_date between p.effective_date and p.expiration_date
  left join dim_store t on s.store_id = t.store_id and t.is_current and s.sale_date between t.effective_date and t.expiration_date
  left join dim_customer c on s.customer_id = c.customer_id
where product_key is not null and store_key is not null and s.data_quality_score >= 80
"""

_parts = ("morning", "afternoon", "evening", "night")
_pays = ("credit_card", "cash", "digital_wallet")
_count = lambda c, name: f"count(*) filter (where {c}) as {name}"
DAILY = f"""
with sums as (
  select date_key, product_key, store_key, count(*) as transaction_count, cast(sum(quantity_sold) as bigint) as total_quantity_sold,
    {money('gross_sales_amount')} as total_gross_sales, {money('discount_amount')} as total_discount_amount, {money('net_sales_amount')} as total_net_sales,
    {money('cost_amount')} as total_cost_amount, {money('profit_amount')} as total_profit_amount,
    {money('net_sales_amount')} / count(net_sales_amount) as avg_transaction_size, cast(sum(cast(profit_margin_pct as decimal(24,12))) as double) / count(profit_margin_pct) as avg_profit_margin_pct,
    count(distinct customer_key) as unique_customers, {_count('discount_pct > 0', 'discounted_transactions')},
    {_count("transaction_size_category in ('LARGE', 'EXTRA_LARGE')", 'large_transactions')}, {_count("quantity_category = 'BULK_PURCHASE'", 'bulk_purchases')},
    avg(data_quality_score) as avg_data_quality_score, {_count("data_source = 'STREAMING'", 'streaming_transactions')},
    {_count("data_source = 'BATCH'", 'batch_transactions')}, {', '.join(_count(f"time_of_day = '{p.upper()}'", f'{p}_transactions') for p in _parts)},
    {', '.join(_count(f"payment_method = '{p.upper()}'", f'{p}_transactions') for p in _pays)}, min(created_at) as created_at, max(updated_at) as updated_at
  from fact_sales group by date_key, product_key, store_key
)
select row_number() over (order by date_key, product_key, store_key) as daily_sales_key, *,
  {pct('discounted_transactions')} as discount_penetration_pct, {pct('large_transactions')} as large_transaction_pct, {pct('bulk_purchases')} as bulk_purchase_pct,
  {pct('streaming_transactions')} as streaming_mix_pct, {pct('credit_card_transactions')} as credit_card_pct, {pct('digital_wallet_transactions')} as digital_wallet_pct,
  case when afternoon_transactions >= greatest(morning_transactions, evening_transactions, night_transactions) then 'AFTERNOON'
    when evening_transactions >= greatest(morning_transactions, afternoon_transactions, night_transactions) then 'EVENING'
    when morning_transactions >= greatest(afternoon_transactions, evening_transactions, night_transactions) then 'MORNING' else 'NIGHT' end as peak_time_period,
  case when total_net_sales >= 10000 then 'HIGH_PERFORMANCE' when total_net_sales >= 5000 then 'GOOD_PERFORMANCE' when total_net_sales >= 1000 then 'AVERAGE_PERFORMANCE'
    else 'LOW_PERFORMANCE' end as daily_performance_tier
from sums where avg_data_quality_score >= 70
"""

TIE_ORDER = _ties
UPDATED = [x for x in MERGE_SET if x != "order_id"]
KEPT = ("customer_name", "ingestion_timestamp", "geo_quality_flag")



def merged(target: str, source: str) -> str:
    """MERGE of two views: strictly newer rows of the source set the columns that are updated, new keys are inserted."""
    updated = ", ".join(f"case when t.order_id is null or s.processing_timestamp > t.processing_timestamp then s.{x} else t.{x} end as {x}" for x in UPDATED)
    kept = ", ".join(f"case when t.order_id is null then s.{x} else t.{x} end as {x}" for x in KEPT)
    return f"""
select coalesce(t.order_id, s.order_id) as order_id, {updated}, {kept}
from {target} t full join {source} s on t.order_id = s.order_id and t.product_id = s.product_id
"""


STAR = """
select f.*, d.date_value, d.year_number, d.quarter, d.month_number, p.product_id, p.product_name, p.category, p.sub_category, c.customer_segment, c.region, c.country, c.state, c.city
from fact_sales f left join dim_date d using (date_key) left join dim_product p using (product_key) left join dim_customer c using (customer_key)
"""


def kpis(*by: str) -> str:
    names = "".join(f"{x}, " for x in by)
    group = f" group by {', '.join(by)}" if by else ""
    net = money("net_sales_amount")
    return f"""
select {names}{money("profit_amount")} / nullif({net}, 0) as profit_margin, {net} / count(sales_key) as average_order_value,
  {money("discount_amount")} / nullif({money("gross_sales_amount")}, 0) as discount_rate,
  cast(sum(quantity_sold) as double) / count(distinct sales_key) as units_per_order, count(distinct sales_key) as total_orders
from ({STAR}){group}
"""


def _rule(layer: str, rule: str, model_: str, count: str, source: str) -> str:
    return f"select '{layer}' as layer, '{rule}' as rule_type, '{model_}' as model_name, cast({count} as bigint) as violation_count from {source}"


_where = lambda condition: f"count(*) filter (where {condition})"
_versions = f"effective_date > expiration_date or (is_current and expiration_date <> {END}) or (not is_current and expiration_date = {END})"
_variance = f"""(select abs(total_net_sales - coalesce(detail, 0)) as variance from fact_sales_daily left join
  (select date_key, product_key, store_key, {money("net_sales_amount")} as detail from fact_sales group by all) using (date_key, product_key, store_key))"""

BUSINESS_RULES = " union all ".join(
    [
        _rule("STAGING", "INVALID_DISCOUNT_RATES", "stg_sales", _where("discount_rate < 0 or discount_rate > 1"), "stg_sales"),
        _rule("STAGING", "AMOUNT_CALCULATION_ERROR", "stg_sales", _where("abs(gross_amount - quantity * unit_price) > 0.01 or abs(net_amount - (gross_amount - discount_amount)) > 0.01"), "stg_sales"),
        _rule("STAGING", "INCORRECT_QUALITY_SCORE", "stg_sales", _where("data_quality_score < 70 or (data_quality_score = 100 and (order_id is null or customer_id is null or product_id is null or quantity <= 0 or unit_price <= 0 or sale_date is null))"), "stg_sales"),
        _rule("INTERMEDIATE", "DUPLICATE_UNIFIED_RECORDS", "int_sales_unified", "count(*) - count(distinct (order_id, product_id, data_source))", "int_sales_unified"),
        _rule("INTERMEDIATE", "INCORRECT_SIZE_CATEGORY", "int_sales_unified", _where("transaction_size_category <> case when net_amount < 50 then 'SMALL' when net_amount < 200 then 'MEDIUM' when net_amount < 500 then 'LARGE' else 'EXTRA_LARGE' end"), "int_sales_unified"),
        *[_rule("INTERMEDIATE", "INVALID_SCD2_DATES", x, _where(_versions), x) for x in ("int_product_scd2", "int_store_scd2")],
        _rule("MARTS", "BROKEN_REFERENTIAL_INTEGRITY", "fact_sales", "count(*)", "fact_sales f where not exists (select 1 from dim_date d where d.date_key = f.date_key)"),
        _rule("MARTS", "UNREALISTIC_PROFIT_MARGINS", "fact_sales", _where("profit_amount / nullif(net_sales_amount, 0) > 0.95::double or profit_amount / nullif(net_sales_amount, 0) < -35"), "fact_sales"),
        _rule("MARTS", "INCORRECT_CUSTOMER_TIERS", "dim_customer", _where("customer_value_tier <> case when total_spent >= 10000 then 'VIP' when total_spent >= 5000 then 'HIGH_VALUE' when total_spent >= 1000 then 'REGULAR' else 'OCCASIONAL' end"), "dim_customer"),
        _rule("MARTS", "DATE_DIMENSION_LOGIC_ERROR", "dim_date", _where("is_weekend <> (day_of_week in (0, 6)) or quarter not between 1 and 4 or month_number not between 1 and 12 or day_of_week not between 0 and 6"), "dim_date"),
        _rule("MARTS", "DAILY_AGGREGATION_ERROR", "fact_sales_daily", _where("variance > 0.01"), _variance),
        _rule("CROSS_LAYER", "DATA_LOSS_IN_PIPELINE", "staging_to_facts", "case when a > b * 1.05 then a - b else 0 end", f"(select count(*) as a from int_sales_unified where sale_date >= {AS_OF} - 7), (select count(*) as b from fact_sales join dim_date using (date_key) where date_value >= {AS_OF} - 7)"),
        _rule("CROSS_LAYER", "METRIC_OUT_OF_RANGE", "daily_sales_volume", "case when s < 1000 or s > 1000000 then 1 else 0 end", f"(select {money('net_sales_amount')} as s from fact_sales join dim_date using (date_key) where date_value = {AS_OF} - 1)"),
    ]
)


def _issue(table_: str, issue: str, source: str) -> str:
    return f"select '{table_}' as table_name, '{issue}' as issue_type, count(*) as issue_count from {source}"


DIMENSIONAL = " union all ".join(
    [_issue(d, "MISSING_SURROGATE_KEYS", f"{d} where {k} is null") for d, k in (("dim_date", "date_key"), ("dim_product", "product_key"), ("dim_store", "store_key"), ("dim_customer", "customer_key"))]
    + [_issue(d, "MULTIPLE_CURRENT_RECORDS", f"(select {k} from {d} where is_current group by 1 having count(*) > 1)") for d, k in (("dim_product", "product_id"), ("dim_store", "store_id"))]
    + [_issue("fact_sales", f"ORPHANED_{k.upper()}", f"fact_sales where {k} not in (select {k} from {d} where {k} is not null)") for d, k in (("dim_product", "product_key"), ("dim_store", "store_key"), ("dim_date", "date_key"))]
    + [
        _issue("fact_sales", "NULL_MEASURES", "fact_sales where quantity_sold is null or net_sales_amount is null or profit_amount is null"),
        _issue("fact_sales", "INVALID_MEASURES", "fact_sales where quantity_sold <= 0 or net_sales_amount <= 0"),
        _issue("fact_sales_daily", "AGGREGATION_MISMATCH", f"{_variance} where variance > 0.01"),
        _issue("fact_sales_daily", "IMPOSSIBLE_AGGREGATIONS", "fact_sales_daily where unique_customers > transaction_count"),
    ]
)

VERSIONS = " union all ".join(
    f"""select '{kind}' as dimension_type, 'OVERLAPPING_DATES' as issue_type, a.{key_} as business_key, count(*) as issue_count from {t} a join {t} b
      on a.{key_} = b.{key_} and a.{tie} <> b.{tie} and a.effective_date <= b.expiration_date and b.effective_date <= a.expiration_date group by a.{key_}
    union all select '{kind}', 'DATE_GAPS', a.{key_}, 1 from {t} a left join {t} b on a.{key_} = b.{key_} and b.effective_date = a.expiration_date + 1
      where a.expiration_date <> {END} and b.{tie} is null
    union all select '{kind}', 'MULTIPLE_CURRENT', {key_}, count(*) from {t} where is_current group by {key_} having count(*) > 1"""
    for kind, t, key_, tie in (("PRODUCT", "int_product_scd2", "product_id", "product_scd2_key"), ("STORE", "int_store_scd2", "store_id", "store_scd2_key"))
)

DAILY_ACCURACY = f"""
select date_key, product_key, store_key, expected_transaction_count, expected_net_sales, expected_unique_customers, transaction_count, total_net_sales, unique_customers,
  abs(expected_transaction_count - coalesce(transaction_count, 0)) as transaction_diff, abs(expected_net_sales - coalesce(total_net_sales, 0)) as sales_diff,
  abs(expected_unique_customers - coalesce(unique_customers, 0)) as customer_diff
from (select date_key, product_key, store_key, count(*) as expected_transaction_count, {money("net_sales_amount")} as expected_net_sales,
    count(distinct customer_key) as expected_unique_customers from fact_sales where date_key >= cast(strftime({AS_OF} - 7, '%Y%m%d') as int) group by all)
  left join fact_sales_daily using (date_key, product_key, store_key)
where transaction_diff > 0 or sales_diff > 0.01 or customer_diff > 0
"""

_share = lambda a, b: f"cast(round(cast(100 * cast({a} as decimal(18,4)) / nullif({b}, 0) as decimal(18,6)), 2) as double)"
COMPLETENESS = f"""
select s.sale_date, staging_record_count, staging_order_count, coalesce(fact_record_count, 0) as fact_record_count, coalesce(fact_order_count, 0) as fact_order_count,
  {_share("coalesce(fact_record_count, 0)", "staging_record_count")} as record_completeness_pct, {_share("coalesce(fact_order_count, 0)", "staging_order_count")} as order_completeness_pct
from (select sale_date, count(*) as staging_record_count, count(distinct order_id) as staging_order_count from int_sales_unified where sale_date >= {AS_OF} - 7 group by 1) s
left join (select date_value as sale_date, count(*) as fact_record_count, count(distinct order_id) as fact_order_count
  from fact_sales join dim_date using (date_key) where date_value >= {AS_OF} - 7 group by 1) f using (sale_date)
"""

EXPORT = """
select order_id as ORDER_ID, customer_id as STORE_ID, product_id as PRODUCT_ID, product_name as PRODUCT_NAME, category as CATEGORY, sub_category as SUB_CATEGORY,
  quantity as QUANTITY, unit_price as UNIT_PRICE, sales as TOTAL_PRICE, order_date as ORDER_DATE, ship_date as SHIP_DATE, sales as SALES, profit as PROFIT,
  shipping_cost as SHIPPING_COST, segment as CUSTOMER_SEGMENT, market as MARKET, region as REGION, country as COUNTRY, state as STATE, city as CITY,
  order_priority as ORDER_PRIORITY, cast(null as varchar) as SOURCE_FILE, batch_id as BATCH_ID, ingestion_timestamp as INGESTION_TIMESTAMP,
  source_system as SOURCE_SYSTEM, cast(partition_date as date) as PARTITION_DATE
from silver
"""

#: Tables with the faults that ``queries.faulty_tables`` plants.
FAULTY = {
    "fact_sales_daily": ("faulty_daily", """
select * replace (total_net_sales + case when product_key % 4 = 0 then 1 else 0 end as total_net_sales,
  transaction_count + case when product_key % 4 = 1 then 1 else 0 end as transaction_count) from fact_sales_daily where product_key % 4 <> 2
"""),
    "fact_sales": ("faulty_fact", "select * from fact_sales where date_key % 2 = 0 or product_key % 3 = 0"),
    "int_product_scd2": ("faulty_versions", f"""
select * exclude (n) replace (
  case when n % 7 = 3 then effective_date - 1 when n % 5 in (1, 2) then effective_date + 10 else expiration_date end as expiration_date,
  case when n % 7 <> 3 and n % 5 in (1, 2) then false else is_current end as is_current)
from (select *, cast(substring(product_id, 6) as int) as n from int_product_scd2)
union all by name
select * exclude (n) replace (effective_date + case n % 5 when 0 then 30 when 1 then 20 else 11 end as effective_date, product_scd2_key || '-2' as product_scd2_key)
from (select *, cast(substring(product_id, 6) as int) as n from int_product_scd2) where n % 7 <> 3 and n % 5 < 3
"""),
}


def faulty(sql: str) -> str:
    """``sql`` over the faulty tables; names in quotes stay."""
    for name, (other, _) in FAULTY.items():
        sql = re.sub(rf"(?<!')\b{name}\b(?!')", other, sql)
    return sql


FILE_COLUMNS = [x for x in ROW if x not in ("source_row_id", "processing_timestamp")]


def file_score(source: str, columns: list[str], name: str) -> str:
    n, all_ = len(columns), ", ".join(columns)
    missing = sorted({*FILE_COLUMNS, "row_id"} - set(columns))
    field = f"(100.0::double * {24 - len(missing)} / 24)"
    texts = " + ".join(f"case when count(*) filter (where {x} is not null and try_cast(cast({x} as varchar) as double) is null) > 0 then 1 else 0 end" for x in columns)
    mostly = ", ".join(f"case when rows > 0 and n_{x} / rows < 0.5 then '{x} is mostly null' end" for x in columns)
    return f"""
select '{name}' as file_name, rows as row_count, {field} as field_score, completeness_score, consistency_score,
  cast(floor(0.4::double * {field} + 0.3::double * completeness_score + 0.3::double * consistency_score) as int) as overall_score, {str(not missing).lower()} as schema_valid,
  cast({missing} as varchar[]) as missing, cast([] as varchar[]) as extra,
  list_filter([{mostly}, case when repeated > 0 then cast(repeated as varchar) || ' duplicate rows' end], lambda x: x is not null) as issues
from (select count(*) as rows, {", ".join(f"count({x}) as n_{x}" for x in columns)}, 100.0::double * ({" + ".join(f"count({x})" for x in columns)}) / (count(*) * {n}) as completeness_score,
    greatest(0.0::double, 100.0::double - 10.0::double * ({texts})) as consistency_score from {source}),
  (select cast(coalesce(sum(c - 1), 0) as bigint) as repeated from (select count(*) as c from {source} group by {all_}))
"""


FILE_SCORE = file_score("sales_view", ["row_id", *FILE_COLUMNS], "file")
BATCH_REPORT = f"""
select *, case when mean_score >= 90 and invalid_files = 0 then 'excellent' when mean_score >= 80 and invalid_files <= 1 then 'good' when mean_score >= 70 then 'acceptable' else 'poor' end as grade
from (select count(*) as total_files, count(*) filter (where schema_valid and overall_score >= 70) as valid_files, avg(overall_score) as mean_score,
    count(*) filter (where not (schema_valid and overall_score >= 70)) as invalid_files
  from ({" union all ".join(file_score(f"(select * from sales_view where year(order_date) = {y})", c, str(y)) for y, c in ((1996, ["row_id", *FILE_COLUMNS]), (1997, ["row_id", *FILE_COLUMNS]), (1998, ["order_id", "sales"])))}))
"""


def _check(stage: str, name: str, passed: str, score: str, source: str, **details: str) -> str:
    text = " || ',' || ".join(f"'\"{k}\":' || cast({v} as varchar)" for k, v in details.items())
    return f"select '{stage}' as stage, '{name}' as check_name, {passed} as passed, cast({score} as double) as score, '{{' || {text} || '}}' as details from {source}"


_schema = lambda stage: f"""select '{stage}' as stage, 'schema' as check_name, true as passed, 1.0::double as score, '{{"missing": []}}' as details"""
_raw = "order_id order_date ship_date customer_id customer_name product_id product_name category sales quantity profit".split()
RAW_VALIDATION = " union all ".join(
    [
        _schema("raw"),
        _check("raw", "completeness", "null_rate <= 0.1::double and null_keys = 0", "1 - null_rate",
            f"(select ({' + '.join(f'count(*) filter (where {x} is null)' for x in _raw)}) / (count(*) * {len(_raw)}) as null_rate, count(*) filter (where order_id is null) + count(*) filter (where customer_id is null) + count(*) filter (where product_id is null) as null_keys from sales_view)",
            null_rate="null_rate", null_keys="null_keys"),
        _check("raw", "types", "bad_types = 0", "case when bad_types = 0 then 1 else 0 end", f"(select {' + '.join(f'count(*) filter (where {x} is not null and try_cast({x} as double) is null)' for x in ('sales', 'quantity', 'profit'))} as bad_types from sales_view)", bad_types="bad_types"),
        _check("raw", "business_rules", "violation_rate <= 0.05::double", "1 - violation_rate", "(select count(*) filter (where sales <= 0 or quantity <= 0) / count(*) as violation_rate from sales_view)", violation_rate="violation_rate"),
        _check("raw", "duplicates", "duplicate_rate <= 0.05::double", "1 - duplicate_rate", "(select (sum(c) - count(*)) / sum(c) as duplicate_rate from (select count(*) as c from sales_view group by all))".replace("count(*) as c from sales_view group by all", "count(*) as c from sales_view group by " + ", ".join(["row_id", *FILE_COLUMNS, "processing_timestamp"])), duplicate_rate="duplicate_rate"),
        _check("raw", "outliers", "outlier_rate <= 0.1::double", "1 - outlier_rate",
            "(select q1, q3, count(*) filter (where sales < q1 - 1.5::double * (q3 - q1) or sales > q3 + 1.5::double * (q3 - q1)) / count(*) as outlier_rate from sales_view, (select quantile_cont(sales, 0.25) as q1, quantile_cont(sales, 0.75) as q3 from sales_view) group by q1, q3)",
            q1="q1", q3="q3", outlier_rate="outlier_rate"),
    ]
)
_kept = "(select (select count(*) from sales_view) as rows_in, count(*) as rows_out, count(*) filter (where abs(unit_price * quantity - sales) <= 0.01::double) / count(*) as accuracy, (select count(*) from sales_view) / 1.0::double as rate from silver)"
ETL_VALIDATION = " union all ".join(
    [
        _check("etl", "retention", "rows_out / rows_in >= 0.9::double", "least(1.0::double, rows_out / rows_in)", _kept, rows_in="rows_in", rows_out="rows_out"),
        _schema("etl"),
        _check("etl", "calculation", "accuracy >= 0.95::double", "accuracy", _kept, accuracy="accuracy"),
        _check("etl", "throughput", "rate >= 1000", "least(1.0::double, rate / 1000)", _kept, rate="rate"),
    ]
)
_seen = "(select count(*) as rows, (count(*) filter (where event_id is null) + count(*) filter (where user_id is null) + count(*) filter (where value is null)) / (count(*) * 3) as null_rate, count(user_id) - count(distinct user_id) as repeated, (epoch_us(max(ts)) - epoch_us(min(ts))) / 3.6e9::double as hours, count(*) / 60.0::double as rate from events)"
STREAM_VALIDATION = " union all ".join(
    [
        _schema("stream"),
        _check("stream", "completeness", "null_rate <= 0.05::double", "1 - null_rate", _seen, null_rate="null_rate"),
        _check("stream", "duplicates", "repeated = 0", "1 - repeated / rows", _seen, repeated="repeated"),
        _check("stream", "time_range", "hours <= 24", "case when hours <= 24 then 1 else 0 end", _seen, hours="hours"),
        _check("stream", "throughput", "rate >= 100", "least(1.0::double, rate / 100)", _seen, rate="rate"),
    ]
)

VIEWS = {
    "sales_view": SALES,
    "cleaned": CLEANED,
    "judged": JUDGED,
    "by_source": BY_SOURCE,
    "silver": SILVER,
    "stg_sales": STG_SALES,
    "stg_customers": STG_CUSTOMERS,
    "stg_products": STG_PRODUCTS,
    "int_sales_unified": UNIFIED,
    "int_product_scd2": PRODUCT_SCD2,
    "int_store_scd2": STORE_SCD2,
    "int_date_spine": SPINE,
    "dim_date": DIM_DATE,
    "dim_product": DIM_PRODUCT,
    "dim_store": DIM_STORE,
    "dim_customer": DIM_CUSTOMER,
    "fact_sales": FACT,
    "fact_sales_daily": DAILY,
    **dict(FAULTY.values()),
}


def over(sql: str) -> str:
    """``sql`` with the views that it names, and those that they name, as common table expressions before it."""
    wanted: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        new = (words & VIEWS.keys()) - wanted
        wanted |= new
        todo += [VIEWS[n] for n in new]
    ctes = ",\n".join(f"{n} as materialized ({VIEWS[n]})" for n in VIEWS if n in wanted)
    if not ctes:
        return sql
    own = re.match(r"\s*with\s", sql)
    return f"with {ctes},\n{sql[own.end() :]}" if own else f"with {ctes}\n{sql}"


def model(name: str) -> str:
    return over(f"select * from {name}")
