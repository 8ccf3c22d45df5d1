"""Oracle SQL per registered query (DuckDB over the driver's tables)."""

from __future__ import annotations

import oracle.marts  # noqa: F401  (registers mart CTEs)
from oracle.ctes import CTES, with_ctes

ORACLE: dict[str, str] = {}

for _n in ("dim_customer", "dim_supplier", "dim_product", "fct_order_line", "fct_shipment",
           "fct_inventory_snapshot", "fct_demand_forecast", "mart_order_fulfillment",
           "mart_daily_service_level", "mart_carrier_performance", "mart_inventory_risk",
           "mart_forecast_accuracy"):
    ORACLE[_n] = with_ctes(f"select * from {_n}", _n)

# Order-grain service rows, ranked over every order by (date, id), with the
# 0/1 OTIF averaged over the current and 29 previous orders.
def _rolling_sql(lines: str) -> str:
    return f"""
select t.*, round(avg(otif_flag) over last_30_orders, 6) as rolling_30_order_otif,
       freight_cost::double / nullif(shipment_weight_kg::double, 0) as freight_cost_per_kg
from (
    select o.*, s.carrier, s.delivery_date, s.freight_cost, s.shipment_weight_kg,
           o.units_shipped::double / nullif(o.units_ordered::double, 0) as unit_fill_rate,
           coalesce(o.units_shipped >= o.units_ordered, false)::integer as complete_order_flag,
           coalesce(s.delivery_date <= o.promised_date, false)::integer as on_time_flag,
           coalesce(o.units_shipped >= o.units_ordered and s.delivery_date <= o.promised_date, false)::integer
               as otif_flag
    from (select order_id, customer_id, warehouse, min(order_date) as order_date,
                 max(promised_date) as promised_date, sum(units_ordered)::bigint as units_ordered,
                 sum(units_shipped)::bigint as units_shipped, sum(revenue)::decimal(38,2) as revenue
          from {lines} group by order_id, customer_id, warehouse) o
    left join fct_shipment s on s.order_id = o.order_id
) t
window last_30_orders as (order by order_date, order_id rows between 29 preceding and current row)"""


ORACLE["rolling_30_order_otif"] = with_ctes(_rolling_sql("fct_order_line"), "fct_order_line", "fct_shipment")

# Calendar: every day from the first order date to the last delivery date.
ORACLE["dim_date"] = with_ctes("""
select d as calendar_date, year(d)::integer as calendar_year, quarter(d)::integer as calendar_quarter,
       month(d)::integer as calendar_month, strftime(d, '%Y-%m') as year_month,
       weekofyear(d)::integer as calendar_week, dayname(d) as day_name,
       isodow(d) in (6, 7) as is_weekend
from (select unnest(generate_series(lo, greatest(lo, coalesce(hi, lo)), interval 1 day))::date as d
      from (select min(order_date) as lo from fct_order_line),
           (select max(delivery_date) as hi from fct_shipment))""", "fct_order_line", "fct_shipment")

# Cohort = a customer's first active month; age = month boundaries since it.
ORACLE["cohort_revenue"] = with_ctes("""
with monthly as (
    select customer_id, date_trunc('month', order_date)::date as activity_month, sum(revenue) as revenue
    from fct_order_line group by customer_id, date_trunc('month', order_date)::date
), firsts as (
    select customer_id, min(activity_month) as cohort_month from monthly group by customer_id
)
select f.cohort_month,
       ((year(m.activity_month) - year(f.cohort_month)) * 12
        + month(m.activity_month) - month(f.cohort_month))::integer as months_since_first_order,
       count(distinct m.customer_id) as active_customers, sum(m.revenue)::decimal(38,2) as cohort_revenue
from monthly m join firsts f on f.customer_id = m.customer_id
group by 1, 2 order by 1, 2""", "fct_order_line")

_NESTED = """
with nested as (
    select order_id, customer_id, order_date,
           list({'sku': sku, 'quantity': units_ordered, 'extended_price': revenue} order by sku) as items
    from fct_order_line group by order_id, customer_id, order_date
)"""

ORACLE["nested_order_items"] = with_ctes(_NESTED + """
select order_id, customer_id, order_date, it.sku as sku, it.quantity as quantity,
       it.extended_price as extended_price
from (select order_id, customer_id, order_date, unnest(items) as it from nested) x""", "fct_order_line")

ORACLE["nested_orders"] = with_ctes(_NESTED + """
select order_id, customer_id, order_date, len(items)::bigint as item_count,
       items[1].sku as first_sku, items[len(items)].sku as last_sku
from nested""", "fct_order_line")

# Events of open orders ('order_created'), one row per item.
ORACLE["order_events_flatten"] = with_ctes("""
select l.order_id, max(l.ingestion_timestamp) over (partition by l.order_id) as event_timestamp, l.sku,
       l.units_ordered::decimal(38,0) as quantity, l.revenue::decimal(18,2) as extended_price
from lines l join src_order_headers h on h.order_id = l.order_id
where h.order_status = 'O'""", "lines", "src_order_headers")

_STAGED = """
select order_line_id, order_id, customer_id, warehouse, order_date, promised_date, sku,
       units_ordered, units_shipped, revenue, ingestion_timestamp
from (
    select trim(order_line_id) as order_line_id, trim(order_id) as order_id, trim(customer_id) as customer_id,
           trim(warehouse) as warehouse, try_cast(order_date as date) as order_date,
           try_cast(promised_date as date) as promised_date, trim(sku) as sku,
           try_cast(units_ordered as decimal(38,0)) as units_ordered,
           try_cast(units_shipped as decimal(38,0)) as units_shipped,
           try_cast(revenue as decimal(18,2)) as revenue, ingestion_timestamp,
           row_number() over (partition by trim(order_line_id)
                              order by ingestion_timestamp desc, l_partkey desc, l_suppkey desc,
                                       l_extendedprice desc) as pick
    from src_stg_dirty) t
where pick = 1"""
ORACLE["stg_order_lines"] = with_ctes(_STAGED, "src_stg_dirty")
ORACLE["rolling_30_order_otif_staged"] = with_ctes(_rolling_sql(f"({_STAGED}) staged"), "src_stg_dirty", "fct_shipment")


ORACLE["silver_order_lines"] = with_ctes("""
select * exclude (l_partkey, l_suppkey, l_extendedprice) from lines where order_line_id is not null""", "lines")

# Gold flags propagate NULL (boolean cast), unlike the marts.
ORACLE["gold_order_service"] = with_ctes("""
select o.*, s.shipment_id, s.carrier, s.ship_date, s.delivery_date, s.shipment_weight_kg, s.freight_cost,
       s.handling_cost, s.exception_cost,
       o.units_shipped::double / nullif(o.units_ordered::double, 0) as unit_fill_rate,
       (o.units_shipped >= o.units_ordered)::integer as complete_order_flag,
       (s.delivery_date <= o.promised_date)::integer as on_time_flag,
       (o.units_shipped >= o.units_ordered and s.delivery_date <= o.promised_date)::integer as otif_flag
from (select order_id, customer_id, warehouse, min(order_date) as order_date,
             max(promised_date) as promised_date, sum(units_ordered)::bigint as units_ordered,
             sum(units_shipped)::bigint as units_shipped, sum(revenue)::decimal(38,2) as revenue
      from fct_order_line group by order_id, customer_id, warehouse) o
left join fct_shipment s on s.order_id = o.order_id""", "fct_order_line", "fct_shipment")

ORACLE["quality_summary"] = with_ctes("""
select count(*) as row_count, count(distinct order_line_id) as distinct_order_line_ids,
       count(*) filter (where order_line_id is null) as null_order_line_ids,
       count(*) filter (where units_shipped > units_ordered) as over_shipped_rows
from src_erp_order_lines""", "src_erp_order_lines")

_MERGE_COLS = ("order_line_id", "order_id", "customer_id", "order_date", "promised_date", "sku",
               "units_ordered", "units_shipped", "revenue")
_UPDATED = ("units_shipped", "revenue")


def _merge_sql(conditional: bool) -> str:
    both = "t.order_line_id is not null and s.order_line_id is not null"
    if conditional:
        # a NULL on either side is not a change
        change = " or ".join(f"coalesce(t.{c} <> s.{c}, false)" for c in _UPDATED)
        update = f"({both} and ({change}))"
    else:
        update = f"({both})"
    cols = [f"case when t.order_line_id is null {'or ' + update if c in _UPDATED else ''} "
            f"then s.{c} else t.{c} end as {c}" for c in _MERGE_COLS]
    sel = ", ".join(_MERGE_COLS)
    return with_ctes(f"""
select {', '.join(cols)},
       case when t.order_line_id is null then 'inserted' when {update} then 'updated' else 'unchanged' end
           as merge_action
from (select {sel} from merge_target) t
full outer join (select {sel} from merge_source) s on t.order_line_id = s.order_line_id""",
                     "merge_target", "merge_source")


ORACLE["merge_conditional"] = _merge_sql(True)
ORACLE["merge_upsert"] = _merge_sql(False)


def _report_sql(raw: str) -> str:
    """Nine checks from per-relation statistics (one scan each)."""
    return f"""
with line_stats as (select count(*) as n, count(distinct order_line_id) as d, sum(revenue) as rev
                    from fct_order_line),
     raw_stats as (select count(*) as n, sum(revenue) as rev from {raw}),
     ship_stats as (select count(*) as n, count(distinct order_id) as d from fct_shipment),
     order_stats as (select count(*) as n, count(distinct order_id) as d,
                            count(*) filter (where unit_fill_rate between 0 and 1) as fill_ok,
                            count(*) filter (where otif_flag <= on_time_flag
                                             and otif_flag <= complete_order_flag) as otif_ok
                     from order_facts),
     carrier_stats as (select count(*) as n from mart_carrier_performance),
     forecast_stats as (select count(*) as n,
                               count(*) filter (where forecast_accuracy between -1 and 1) as ok
                        from mart_forecast_accuracy),
     checks(check_name, actual_value, expected_value, passed) as (
        select 'order_line_key_unique', n::double, d::double, n = d from line_stats
        union all select 'shipment_order_unique', n::double, d::double, n = d from ship_stats
        union all select 'source_to_fact_order_line_count', r.n::double, l.n::double, r.n = l.n
                  from raw_stats r, line_stats l
        union all select 'source_to_fact_revenue_reconciliation', r.rev::double, l.rev::double,
                         abs(r.rev - l.rev) < 0.01 from raw_stats r, line_stats l
        union all select 'mart_order_grain_unique', n::double, d::double, n = d from order_stats
        union all select 'unit_fill_rate_range', fill_ok::double, n::double, fill_ok = n from order_stats
        union all select 'otif_not_above_components', otif_ok::double, n::double, otif_ok = n from order_stats
        union all select 'carrier_mart_non_empty', n::double, 1::double, n >= 1 from carrier_stats
        union all select 'forecast_accuracy_reasonable', ok::double, n::double, ok = n from forecast_stats
     )
select check_name, round(actual_value, 2) as actual_value, round(expected_value, 2) as expected_value,
       case when passed then 'PASS' else 'FAIL' end as status
from checks"""


_REPORT_DEPS = ("lines", "fct_order_line", "fct_shipment", "order_facts", "mart_carrier_performance",
                "mart_forecast_accuracy")
ORACLE["quality_report"] = with_ctes(_report_sql("lines"), *_REPORT_DEPS)
# Bronze (repeating keys) published as the clean fact: the failing checks.
ORACLE["quality_gate"] = with_ctes(
    f"select * from ({_report_sql('src_erp_order_lines')}) q where status <> 'PASS'",
    "src_erp_order_lines", *_REPORT_DEPS,
    overrides={"fct_order_line": CTES["fct_order_line"][0].replace("from lines", "from src_erp_order_lines")})

ORACLE["build_summary"] = with_ctes("""
select count(*) as orders, round(100 * avg(unit_fill_rate), 2) as fill_pct, round(100 * avg(otif_flag), 2) as otif_pct,
       round(sum(recognized_revenue), 2)::decimal(38,2) as revenue
from order_facts""", "order_facts")

ORACLE["export_checks"] = with_ctes(f"""
with o as (select count(*) as n, count(distinct order_id) as d,
                  count(*) filter (where unit_fill_rate between 0 and 1) as fill_ok,
                  count(*) filter (where otif_flag <= on_time_flag and otif_flag <= complete_order_flag) as otif_ok
           from order_facts),
     c as (select count(*) as n from mart_carrier_performance),
     q as (select count(*) as n, count(*) filter (where status = 'PASS') as passed
           from ({_report_sql('lines')}) r)
select 'order_output_non_empty' as check_name, o.n > 0 as passed, o.n::varchar as detail from o
union all select 'order_id_unique', o.n = o.d, o.d::varchar from o
union all select 'service_metrics_in_range', o.fill_ok = o.n, 'fill rate' from o
union all select 'otif_logic', o.otif_ok = o.n, 'OTIF components' from o
union all select 'carrier_output_non_empty', c.n > 0, c.n::varchar from c
union all select 'warehouse_quality_report', q.passed = q.n, q.passed::varchar from q""", *_REPORT_DEPS)

ORACLE["qa_duplicate_keys"] = with_ctes("""
select order_line_id, count(*) as row_count from src_erp_order_lines
group by order_line_id having count(*) > 1""", "src_erp_order_lines")

ORACLE["qa_mart_violations"] = with_ctes("""
select * from mart_order_fulfillment
where not (unit_fill_rate between 0 and 1) or otif_flag > on_time_flag or otif_flag > complete_order_flag""",
                                         "mart_order_fulfillment")

ORACLE["qa_violation_counts"] = with_ctes("""
select count(*) filter (where not (unit_fill_rate between 0 and 1)) as invalid_fill_rates,
       count(*) filter (where otif_flag > on_time_flag) as invalid_otif_on_time,
       count(*) filter (where otif_flag > complete_order_flag) as invalid_otif_complete
from order_facts""", "order_facts")

# the same rules over a mart whose OTIF ignores the delivery and whose fill rate is inverted
_BROKEN = """(select order_id, units_ordered::double / nullif(units_shipped::double, 0) as unit_fill_rate, on_time_flag,
       complete_order_flag, complete_order_flag as otif_flag from order_facts) broken"""
ORACLE["qa_mart_violations_found"] = with_ctes(f"""
select * from {_BROKEN}
where not (unit_fill_rate between 0 and 1) or otif_flag > on_time_flag or otif_flag > complete_order_flag""", "order_facts")
ORACLE["qa_violation_counts_found"] = with_ctes(f"""
select count(*) filter (where not (unit_fill_rate between 0 and 1)) as invalid_fill_rates,
       count(*) filter (where otif_flag > on_time_flag) as invalid_otif_on_time,
       count(*) filter (where otif_flag > complete_order_flag) as invalid_otif_complete
from {_BROKEN}""", "order_facts")

ORACLE["order_weight"] = with_ctes("""
select order_id, sum(units_shipped * unit_weight_kg)::decimal(18,2) as kg from lines group by order_id""", "lines")

ORACLE["demand_grid"] = with_ctes("""
select snapshot_date, warehouse, sku, monthly_demand::bigint as monthly_demand, avg_daily::decimal(18,4) as avg_daily
from src_demand_grid""", "src_demand_grid")

ORACLE["warehouse_activity"] = with_ctes("select * from src_warehouse_activity", "src_warehouse_activity")

ORACLE["src_scan"] = with_ctes("""
select order_line_id, order_id, customer_id, warehouse, order_date, promised_date, sku, supplier_id,
       units_ordered, units_shipped, unit_price, unit_weight_kg, revenue
from lines""", "lines")
ORACLE["export_order_mart"] = ORACLE["mart_order_fulfillment"]
ORACLE["fact_partitioned"] = ORACLE["fct_order_line"]
ORACLE["fact_pruned_read"] = with_ctes(
    "select * from fct_order_line where order_date between date '1995-01-01' and date '1995-12-31'",
    "fct_order_line")
ORACLE["fact_bucketed"] = with_ctes("""
select order_id, customer_id, warehouse, min(order_date) as order_date, max(promised_date) as promised_date,
       sum(units_ordered)::bigint as units_ordered, sum(units_shipped)::bigint as units_shipped,
       sum(revenue)::decimal(38,2) as recognized_revenue,
       sum(units_shipped * unit_weight_kg)::decimal(38,3) as calculated_shipped_weight_kg,
       count(*) as order_line_count
from fct_order_line group by order_id, customer_id, warehouse""", "fct_order_line")

# Approximate percentile: lead times are small integers in long runs, so the
# sketch's rank error (1/10,000 of the rows) cannot move the 0.5 / 0.9 value
# off its run and it equals the exact discrete quantile.
ORACLE["carrier_lead_time_approx"] = with_ctes("""
select carrier, quantile_disc(order_lead_time_days, 0.5) as median_lead_time_days,
       quantile_disc(order_lead_time_days, 0.9) as p90_lead_time_days
from order_facts where carrier is not null group by carrier""", "order_facts")

ORACLE["order_rollup"] = ORACLE["fact_bucketed"]

ORACLE["customer_order_number"] = with_ctes("""
select order_id, customer_id, order_date,
       (row_number() over (partition by customer_id order by order_date, order_id))::bigint as customer_order_number
from order_facts""", "order_facts")

ORACLE["customer_lifetime_revenue"] = with_ctes("""
select order_id, customer_id, order_date, recognized_revenue,
       (sum(recognized_revenue) over (partition by customer_id order by order_date, order_id
                                      rows between unbounded preceding and current row))::decimal(38,2)
           as customer_lifetime_revenue
from order_facts""", "order_facts")

ORACLE["dedup_latest_lines"] = with_ctes(
    "select * exclude (l_partkey, l_suppkey, l_extendedprice) from lines", "lines")


def _bucket_sql(lines: str) -> str:
    shown = lambda c: f"coalesce('=' || cast({c} as varchar), '~')"
    row = " || '|' || ".join(shown(c) for c in ("order_line_id", "order_id", "sku", "units_ordered", "units_shipped", "revenue"))
    return f"""
    select (('0x' || substr(md5({shown('order_line_id')}), 1, 15))::bigint % 1024)::integer as bucket, count(*) as n,
           sum(revenue)::decimal(38,2) as revenue, sum(('0x' || substr(md5({row}), 1, 15))::bigint::hugeint) as checksum
    from {lines} group by 1"""


ORACLE["reconcile_lines"] = with_ctes(f"""
select coalesce(s.bucket, t.bucket) as bucket, coalesce(s.n, 0) as source_rows, coalesce(t.n, 0) as target_rows,
       s.revenue as source_revenue, t.revenue as target_revenue
from ({_bucket_sql('src_erp_order_lines')}) s full outer join ({_bucket_sql('fct_order_line')}) t on s.bucket = t.bucket
where s.checksum is distinct from t.checksum or s.n is distinct from t.n""", "src_erp_order_lines", "fct_order_line")

ORACLE["mart_clustered_read"] = with_ctes("""
select * from mart_order_fulfillment where order_date between date '1995-01-01' and date '1995-12-31'""", "mart_order_fulfillment")

ORACLE["fact_dimension_pruned"] = with_ctes("""
select order_date as calendar_date, dayname(order_date) as day_name, count(*) as lines, sum(revenue)::decimal(38,2) as revenue
from fct_order_line where year(order_date) = 1995 and quarter(order_date) = 2 and isodow(order_date) in (6, 7)
group by order_date""", "fct_order_line")

ORACLE["bucketed_join"] = with_ctes("""
select l.order_id, sum(units_shipped)::bigint as units_shipped, sum(revenue)::decimal(38,2) as revenue,
       any_value(s.carrier) as carrier, any_value(s.delivery_date) as delivery_date, any_value(s.freight_cost) as freight_cost
from fct_order_line l join fct_shipment s on s.order_id = l.order_id group by l.order_id""", "fct_order_line", "fct_shipment")

ORACLE["merge_folders"] = f"select * exclude (merge_action) from ({ORACLE['merge_conditional']})"
