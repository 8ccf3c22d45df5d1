"""DuckDB adapter CTEs: the derived source contract, as independent SQL.

The driver registers only its own tables in DuckDB, so every oracle query
carries the adapters it needs as leading CTEs.  These mirror
``lading.sources.contract`` formula for formula but are written directly in
DuckDB's dialect: an independent second implementation of the same contract.
"""

from __future__ import annotations


def pad(prefix: str, expr: str, width: int) -> str:
    s = f"cast({expr} as varchar)"
    return f"concat('{prefix}', lpad({s}, cast(greatest({width}, length({s})) as integer), '0'))"


LATEST = "ingestion_timestamp desc, l_partkey desc, l_suppkey desc, l_extendedprice desc"

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


cte("src_customers", f"""
select {pad('C', 'c_custkey', 7)} customer_id, c_mktsegment customer_segment, r_name region
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")

cte("src_suppliers", f"""
select {pad('SUP', 's_suppkey', 6)} supplier_id, s_name supplier_name,
       cast(5 + s_suppkey % 17 as integer) base_lead_time_days,
       case when s_suppkey % 20 < 11 then 'Low' when s_suppkey % 20 < 17 then 'Medium' else 'High' end supplier_risk_tier
from supplier""")

cte("src_products", f"""
select {pad('SKU-', 'p_partkey', 7)} sku, p_partkey, p_type product_category,
       {pad('SUP', 'p_partkey % (select count(*) from supplier)', 6)} supplier_id,
       cast(p_retailprice as decimal(18,2)) unit_price,
       cast(cast(p_size as decimal(18,3)) * cast(0.48 as decimal(4,2)) as decimal(18,3)) unit_weight_kg
from part""")

cte("src_order_headers", f"""
select o_orderkey, {pad('O', 'o_orderkey', 9)} order_id, {pad('C', 'o_custkey', 7)} customer_id,
       case when (o_orderkey*37) % 103 < 35 then 'WH-NORTH' when (o_orderkey*37) % 103 < 78 then 'WH-CENTRAL' else 'WH-SOUTH' end warehouse,
       cast(o_orderdate as date) order_date, o_orderstatus order_status,
       cast(case when (o_orderkey*53) % 101 < 10 then 2 when (o_orderkey*53) % 101 < 40 then 3
                 when (o_orderkey*53) % 101 < 86 then 5 else 7 end as integer) service_days,
       cast(case when (o_orderkey*71) % 97 < 4 then -1 when (o_orderkey*71) % 97 < 70 then 0
                 when (o_orderkey*71) % 97 < 81 then 1 when (o_orderkey*71) % 97 < 89 then 2
                 when (o_orderkey*71) % 97 < 94 then 3 else 5 end as integer) delay_days
from orders""")

_SHIPPED = ("case when (l_orderkey*13 + l_linenumber*7 + l_partkey) % 100 < 94 then l_quantity "
            "else floor(l_quantity * (l_partkey % 10) / 10) end")

cte("src_erp_order_lines", f"""
select concat('OL', {pad('', 'l_orderkey', 9)}, '-', cast(l_linenumber as varchar)) order_line_id,
       h.order_id, h.customer_id, h.warehouse, h.order_date,
       cast(h.order_date + h.service_days as date) promised_date, p.sku, p.supplier_id,
       cast(l_quantity as integer) units_ordered,
       cast({_SHIPPED} as integer) units_shipped,
       p.unit_price, p.unit_weight_kg,
       cast(cast({_SHIPPED} as integer) * p.unit_price as decimal(18,2)) revenue,
       l_shipdate ingestion_timestamp, l_partkey, l_suppkey, l_extendedprice
from lineitem join src_order_headers h on l_orderkey = h.o_orderkey
join src_products p on l_partkey = p.p_partkey""", "src_order_headers", "src_products")

cte("lines", f"""
select * exclude (rn) from (
  select *, row_number() over (partition by order_line_id order by {LATEST}) rn
  from src_erp_order_lines) t
where rn = 1""", "src_erp_order_lines")

cte("src_tms_shipments", """
select concat('S', substr(h.order_id, 2)) shipment_id, h.order_id,
       case when (o_orderkey*29) % 100 < 30 then 'CarrierA' when (o_orderkey*29) % 100 < 58 then 'CarrierB'
            when (o_orderkey*29) % 100 < 82 then 'CarrierC' else 'CarrierD' end carrier,
       h.warehouse, h.order_date,
       cast(h.order_date + cast(o_orderkey % 4 as integer) as date) ship_date,
       cast(h.order_date + (h.service_days + h.delay_days) as date) delivery_date,
       cast(h.order_date + h.service_days as date) promised_date,
       h.delay_days <= 0 on_time,
       w.kg shipment_weight_kg,
       cast(24 + w.kg * cast(0.35 + ((o_orderkey*17) % 51) / 100.0 as decimal(4,2)) as decimal(18,2)) freight_cost,
       cast(4 + (o_orderkey % 15) as decimal(18,2)) handling_cost,
       cast(case when h.delay_days > 0 then 5 + (o_orderkey % 56) else 0 end as decimal(18,2)) exception_cost
from src_order_headers h
join (select order_id, cast(sum(units_shipped * unit_weight_kg) as decimal(18,2)) kg
      from lines group by order_id) w on h.order_id = w.order_id""", "src_order_headers", "lines")

cte("src_demand_grid", """
select m.month_start snapshot_date, w.warehouse, p.sku, p.p_partkey, p.unit_price, month(m.month_start) mi, w.wi,
       coalesce(d.units, 0) monthly_demand,
       cast(coalesce(d.units, 0) as double) / day(last_day(m.month_start)) avg_daily
from (select cast(unnest(generate_series(date_trunc('month', min(order_date)), date_trunc('month', max(order_date)), interval 1 month)) as date) month_start
      from src_order_headers) m
cross join (select warehouse, row_number() over (order by warehouse) - 1 wi
            from (select distinct warehouse from src_order_headers) names) w
cross join src_products p
left join (select year(order_date) y, month(order_date) mo, warehouse, sku, sum(units_ordered) units
           from lines group by year(order_date), month(order_date), warehouse, sku) d
  on d.y = year(m.month_start) and d.mo = month(m.month_start) and d.warehouse = w.warehouse and d.sku = p.sku""", "src_products", "src_order_headers", "lines")

cte("src_inventory", """
select snapshot_date, warehouse, sku, average_daily_demand, on_hand_units,
       cast(on_hand_units * unit_price * cast(0.55 as decimal(4,2)) as decimal(18,2)) inventory_value
from (select snapshot_date, warehouse, sku, unit_price, cast(avg_daily as decimal(18,4)) average_daily_demand,
             cast(greatest(0, floor(avg_daily * (5 + (p_partkey*7 + mi*3 + wi) % 21))
                              + (p_partkey*11 + mi*5 + wi) % 17 - 8) as integer) on_hand_units
      from src_demand_grid) t""", "src_demand_grid")

cte("src_forecast", """
select snapshot_date "month", warehouse, sku,
       cast(floor(monthly_demand * (70 + (p_partkey*13 + mi*7 + wi) % 61) / 100.0) as integer) forecast_units,
       cast(monthly_demand as integer) actual_units
from src_demand_grid""", "src_demand_grid")

cte("src_warehouse_activity", """
select m.month_start activity_date, w.warehouse, coalesce(a.units, 0) units_processed,
       cast(greatest(cast(80 as double), cast(coalesce(a.units, 0) as double) / 26) as decimal(18,2)) labor_hours
from (select cast(unnest(generate_series(date_trunc('month', min(order_date)), date_trunc('month', max(order_date)), interval 1 month)) as date) month_start
      from src_order_headers) m
cross join (select distinct warehouse from src_order_headers) w
left join (select year(order_date) y, month(order_date) mo, warehouse, cast(sum(units_shipped) as bigint) units
           from lines group by year(order_date), month(order_date), warehouse) a
  on a.y = year(m.month_start) and a.mo = month(m.month_start) and a.warehouse = w.warehouse""", "src_order_headers", "lines")

cte("src_stg_dirty", """
select concat(' ', order_line_id, ' ') order_line_id, order_id, customer_id, warehouse, sku,
       case when l_partkey % 50 = 0 then 'N/A' else cast(order_date as varchar) end order_date,
       case when l_suppkey % 43 = 0 then '' else cast(promised_date as varchar) end promised_date,
       case when l_partkey % 41 = 0 then 'bad' else cast(units_ordered as varchar) end units_ordered,
       case when l_partkey % 47 = 0 then '2.5' else cast(units_shipped as varchar) end units_shipped,
       case when l_suppkey % 37 = 0 then '' else cast(revenue as varchar) end revenue,
       ingestion_timestamp, l_partkey, l_suppkey, l_extendedprice
from src_erp_order_lines""", "src_erp_order_lines")

cte("merge_target", f"""
select * exclude (rn) from (
  select *, row_number() over (partition by order_line_id order by {LATEST}) rn
  from src_erp_order_lines where ingestion_timestamp < timestamp '2000-01-01 00:00:00') t
where rn = 1""", "src_erp_order_lines")

cte("merge_source", f"""
select * exclude (rn) from (
  select *, row_number() over (partition by order_line_id order by {LATEST}) rn
  from src_erp_order_lines where ingestion_timestamp >= timestamp '1999-07-01 00:00:00') t
where rn = 1""", "src_erp_order_lines")

# --- the reference's clean layer over the derived extracts -------------------
cte("dim_customer", """
select trim(customer_id) customer_id, trim(customer_segment) customer_segment, trim(region) region
from src_customers""", "src_customers")

cte("dim_supplier", """
select trim(supplier_id) supplier_id, trim(supplier_name) supplier_name,
       cast(base_lead_time_days as integer) base_lead_time_days, trim(supplier_risk_tier) supplier_risk_tier
from src_suppliers""", "src_suppliers")

cte("dim_product", """
select trim(sku) sku, trim(product_category) product_category, trim(supplier_id) supplier_id,
       cast(unit_price as decimal(18,2)) unit_price, cast(unit_weight_kg as decimal(18,3)) unit_weight_kg
from src_products""", "src_products")

cte("fct_order_line", """
select trim(order_line_id) order_line_id, trim(order_id) order_id, trim(customer_id) customer_id,
       trim(warehouse) warehouse, cast(order_date as date) order_date, cast(promised_date as date) promised_date,
       trim(sku) sku, trim(supplier_id) supplier_id, cast(units_ordered as integer) units_ordered,
       cast(units_shipped as integer) units_shipped, cast(unit_price as decimal(18,2)) unit_price,
       cast(unit_weight_kg as decimal(18,3)) unit_weight_kg, cast(revenue as decimal(18,2)) revenue
from lines""", "lines")

cte("fct_shipment", """
select trim(shipment_id) shipment_id, trim(order_id) order_id, trim(carrier) carrier, trim(warehouse) warehouse,
       cast(ship_date as date) ship_date, cast(delivery_date as date) delivery_date,
       cast(promised_date as date) promised_date, cast(shipment_weight_kg as decimal(18,3)) shipment_weight_kg,
       cast(freight_cost as decimal(18,2)) freight_cost, cast(handling_cost as decimal(18,2)) handling_cost,
       cast(exception_cost as decimal(18,2)) exception_cost, cast(on_time as boolean) source_on_time
from src_tms_shipments""", "src_tms_shipments")

cte("fct_inventory_snapshot", """
select cast(snapshot_date as date) snapshot_date, trim(warehouse) warehouse, trim(sku) sku,
       cast(on_hand_units as integer) on_hand_units, cast(average_daily_demand as decimal(18,3)) average_daily_demand,
       cast(inventory_value as decimal(18,2)) inventory_value
from src_inventory""", "src_inventory")

cte("fct_demand_forecast", """
select cast("month" as date) forecast_month, trim(warehouse) warehouse, trim(sku) sku,
       cast(forecast_units as integer) forecast_units, cast(actual_units as integer) actual_units
from src_forecast""", "src_forecast")


def resolve(*names: str) -> list[str]:
    """Names plus their dependencies, dependencies first."""
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_ctes(body: str, *names: str, extra: list[tuple[str, str]] | None = None,
              overrides: dict[str, str] | None = None) -> str:
    """``with [recursive] <adapters...>, <extra...> <body>``.

    ``overrides`` replaces the SQL of named CTEs (dependencies unchanged
    unless the override names its own via ``extra``)."""
    overrides = overrides or {}
    body = body.strip()
    recursive = body[:15].lower() == "with recursive "
    if recursive:
        body = "with " + body[15:]
    parts = [f"{n} as ({overrides.get(n, CTES[n][0]).strip()})" for n in resolve(*names)]
    parts += [f"{n} as ({sql.strip()})" for n, sql in (extra or [])]
    head = "with recursive " if recursive else "with "
    if body[:5].lower() == "with ":
        return head + ",\n".join(parts) + ",\n" + body[5:]
    return head + ",\n".join(parts) + "\n" + body
