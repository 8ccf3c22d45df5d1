"""Mart definitions as DuckDB CTEs over the clean-layer CTEs.

Written from the business definitions (README "Coverage", SURVEY §1) as an
independent check of the Spark jobs.  Output types are cast explicitly so
they agree with Spark (DuckDB sums to HUGEINT / DECIMAL(38,x)); doubles whose
summation order differs between engines are rounded to 6 places on both
sides.
"""

from __future__ import annotations

from oracle.ctes import cte

# Order grain: lines rolled up per (order, customer, warehouse); shipment
# attached when present; unknown customers removed; flags are 0 when their
# condition is unknown.
cte("order_facts", """
select o.order_id, o.customer_id, o.warehouse, o.order_date, o.promised_date,
       o.units_ordered, o.units_shipped, o.recognized_revenue, o.calculated_shipped_weight_kg,
       o.order_line_count, c.customer_segment, c.region,
       s.shipment_id, s.carrier, s.ship_date, s.delivery_date, s.shipment_weight_kg,
       s.freight_cost, s.handling_cost, s.exception_cost,
       o.units_shipped::double / nullif(o.units_ordered::double, 0) as unit_fill_rate,
       coalesce(o.units_shipped >= o.units_ordered, false)::integer as complete_order_flag,
       coalesce(s.delivery_date <= o.promised_date, false)::integer as on_time_flag,
       coalesce(o.units_shipped >= o.units_ordered and s.delivery_date <= o.promised_date, false)::integer
           as otif_flag,
       (s.delivery_date - o.order_date)::bigint as order_lead_time_days,
       s.freight_cost::double / nullif(s.shipment_weight_kg::double, 0) as freight_cost_per_kg,
       (s.freight_cost + s.handling_cost + s.exception_cost)::decimal(38,2) as logistics_cost,
       (s.freight_cost + s.handling_cost + s.exception_cost)::double
           / nullif(o.recognized_revenue::double, 0) as logistics_cost_pct_revenue
from (
    select order_id, customer_id, warehouse, min(order_date) as order_date,
           max(promised_date) as promised_date, sum(units_ordered)::bigint as units_ordered,
           sum(units_shipped)::bigint as units_shipped, sum(revenue)::decimal(38,2) as recognized_revenue,
           sum(units_shipped * unit_weight_kg)::decimal(38,3) as calculated_shipped_weight_kg,
           count(*) as order_line_count
    from fct_order_line
    group by order_id, customer_id, warehouse
) o
inner join dim_customer c on c.customer_id = o.customer_id
left join fct_shipment s on s.order_id = o.order_id""", "fct_order_line", "dim_customer", "fct_shipment")

cte("mart_order_fulfillment", """
select f.*,
       (row_number() over by_customer)::bigint as customer_order_number,
       (sum(recognized_revenue) over (by_customer rows between unbounded preceding and current row))::decimal(38,2)
           as customer_lifetime_revenue
from order_facts f
window by_customer as (partition by customer_id order by order_date, order_id)""", "order_facts")

cte("mart_daily_service_level", """
select d.*,
       lag(otif_rate) over by_day as prior_day_otif,
       round(avg(otif_rate) over last_30, 6) as rolling_30d_otif,
       (sum(revenue) over last_30)::decimal(38,2) as rolling_30d_revenue,
       units_shipped::double / nullif(units_ordered::double, 0) as unit_fill_rate,
       otif_rate - lag(otif_rate) over by_day as day_over_day_otif_change
from (
    select order_date, count(*) as orders, sum(units_ordered)::bigint as units_ordered,
           sum(units_shipped)::bigint as units_shipped, avg(complete_order_flag) as complete_order_rate,
           avg(on_time_flag) as on_time_delivery_rate, avg(otif_flag) as otif_rate,
           sum(recognized_revenue)::decimal(38,2) as revenue, sum(logistics_cost)::decimal(38,2) as logistics_cost
    from order_facts
    group by order_date
) d
window by_day as (order by order_date asc nulls last),
       last_30 as (order by order_date asc nulls last rows between 29 preceding and current row)""",
    "order_facts")

cte("mart_carrier_performance", """
select m.*,
       (dense_rank() over (order by otif_rate desc nulls last, freight_cost_per_kg asc nulls last))::bigint
           as service_cost_rank,
       percent_rank() over (order by p90_lead_time_days asc nulls last) as lead_time_percentile
from (
    select carrier, count(*) as shipments, avg(on_time_flag) as on_time_delivery_rate,
           avg(complete_order_flag) as complete_order_rate, avg(otif_flag) as otif_rate,
           round(avg(order_lead_time_days), 6) as average_lead_time_days,
           round(quantile_cont(order_lead_time_days, 0.5), 6) as median_lead_time_days,
           round(quantile_cont(order_lead_time_days, 0.9), 6) as p90_lead_time_days,
           sum(freight_cost)::decimal(38,2) as freight_cost,
           sum(shipment_weight_kg)::decimal(38,3) as shipment_weight_kg,
           sum(freight_cost)::double / nullif(sum(shipment_weight_kg)::double, 0) as freight_cost_per_kg,
           sum(exception_cost)::decimal(38,2) as exception_cost
    from order_facts
    where carrier is not null
    group by carrier
) m""", "order_facts")

# Status precedence: STOCKOUT, then CRITICAL (< 7 days), WATCH (< 14), EXCESS (> 90), else HEALTHY.
cte("mart_inventory_risk", """
select snapshot_date, warehouse, sku, product_category, supplier_id, supplier_risk_tier, on_hand_units,
       average_daily_demand, inventory_value, days_of_inventory,
       case when on_hand_units = 0 and average_daily_demand > 0 then 'STOCKOUT'
            when days_of_inventory < 7 then 'CRITICAL'
            when days_of_inventory < 14 then 'WATCH'
            when days_of_inventory > 90 then 'EXCESS'
            else 'HEALTHY' end as inventory_risk_status
from (
    select i.*, p.product_category, p.supplier_id, s.supplier_risk_tier,
           i.on_hand_units::double / nullif(i.average_daily_demand::double, 0) as days_of_inventory
    from fct_inventory_snapshot i
    join dim_product p on p.sku = i.sku
    join dim_supplier s on s.supplier_id = p.supplier_id
) t""", "fct_inventory_snapshot", "dim_product", "dim_supplier")

cte("mart_forecast_accuracy", """
select forecast_month, warehouse, forecast_units, actual_units,
       abs_error::double / nullif(actual_units::double, 0) as wape,
       signed_error::double / nullif(actual_units::double, 0) as forecast_bias,
       1 - abs_error::double / nullif(actual_units::double, 0) as forecast_accuracy
from (
    select forecast_month, warehouse, sum(forecast_units)::bigint as forecast_units,
           sum(actual_units)::bigint as actual_units,
           sum(abs(actual_units - forecast_units)) as abs_error,
           sum(forecast_units - actual_units) as signed_error
    from fct_demand_forecast
    group by forecast_month, warehouse
) t""", "fct_demand_forecast")
