"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each callable derives the source contract from the driver's tables under
``sf_dir`` and runs one job (or one composite mart) over all of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lading.plans.fulfillment import SHIPMENT_COLUMNS
from lading.plans.warehouse import Warehouse
from lading.sources.contract import ORDER_LINE_COLUMNS, SourceContract

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _wh(spark: SparkSession, sf_dir: str, materialize: bool = True) -> Warehouse:
    """Warehouse over the derived extracts.  With ``materialize``, tables that
    several consumers of one query read (raw order lines, shipments,
    customers) are written once; queries that read the order lines once plan
    straight through instead (measured faster)."""
    return Warehouse.from_testdata(spark, sf_dir, materialize=materialize)


# queries whose plan reads the order lines (and each dimension) only once
# (or, as the order mart, in two branches of one plan that share the dedup's exchange)
SINGLE_READ = {"dim_customer", "dim_supplier", "dim_product", "fct_order_line", "fct_shipment",
               "fct_inventory_snapshot", "fct_demand_forecast", "mart_order_fulfillment",
               "mart_inventory_risk", "mart_forecast_accuracy"}


def _mart(attr: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(_wh(spark, sf_dir, attr not in SINGLE_READ), attr)
    run.__name__ = attr
    return run


for _name in ("dim_customer", "dim_supplier", "dim_product", "fct_order_line", "fct_shipment",
              "fct_inventory_snapshot", "fct_demand_forecast", "mart_order_fulfillment",
              "mart_daily_service_level", "mart_carrier_performance", "mart_inventory_risk",
              "mart_forecast_accuracy"):
    register(_name)(_mart(_name))


@register("rolling_30_order_otif")
def rolling_30_order_otif(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lading.plans.fulfillment import service_mart_rolling
    wh = _wh(spark, sf_dir)
    return service_mart_rolling(wh.fct_order_line, wh.fct_shipment)


@register("rolling_30_order_otif_staged")
def rolling_30_order_otif_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8 over the tolerant staging, whose dates may be NULL (ordered last)."""
    from lading.plans.fulfillment import service_mart_rolling
    from lading.plans.lakehouse import stg_order_lines
    staged = stg_order_lines(SourceContract(spark, sf_dir).order_lines_dirty, tie_break=TIE_BREAK, with_warehouse=True)
    return service_mart_rolling(staged, _wh(spark, sf_dir, False).fct_shipment)     # each is read once


TIE_BREAK = ("l_partkey", "l_suppkey", "l_extendedprice")


@register("dim_date")
def dim_date_q(spark, sf_dir):
    # two dates are read: aggregate straight from the scans, write nothing
    return _wh(spark, sf_dir, False).dim_date


@register("cohort_revenue")
def cohort_revenue_q(spark, sf_dir):
    from lading.plans.cohorts import cohort_revenue
    return cohort_revenue(_wh(spark, sf_dir, False).fct_order_line)


@register("nested_order_items")
def nested_order_items_q(spark, sf_dir):
    from lading.plans.nested import nested_order_items
    return nested_order_items(_wh(spark, sf_dir).fct_order_line)


@register("nested_orders")
def nested_orders_q(spark, sf_dir):
    """D13 kept nested, then summarised per order (scalar columns only)."""
    from pyspark.sql import functions as F
    from lading.plans.nested import nested_orders
    n = nested_orders(_wh(spark, sf_dir).fct_order_line)
    return (n.select("order_id", "customer_id", "order_date",
                     F.size("items").cast("bigint").alias("item_count"),
                     F.col("items")[0]["sku"].alias("first_sku"),
                     F.element_at("items", -1)["sku"].alias("last_sku")))


@register("order_events_flatten")
def order_events_flatten_q(spark, sf_dir):
    """Order events landed as JSON lines, read back, filtered and flattened."""
    from lading.operators.materialize import Materializer
    from lading.plans.nested import flatten_order_events, order_events
    from lading.sources.events import read_order_events, write_order_events
    c = SourceContract(spark, sf_dir, Materializer(spark))   # lines feed counts, items and stamps
    landed = _scratch(spark, "order_events")
    write_order_events(order_events(c.order_lines, c.order_headers.select("order_id", "order_status")), landed)
    return flatten_order_events(read_order_events(spark, landed))


@register("stg_order_lines")
def stg_order_lines_q(spark, sf_dir):
    from lading.plans.lakehouse import stg_order_lines
    return stg_order_lines(SourceContract(spark, sf_dir).order_lines_dirty, tie_break=TIE_BREAK,
                           with_warehouse=True)


@register("silver_order_lines")
def silver_order_lines_q(spark, sf_dir):
    from pyspark.sql import functions as F
    from lading.plans.lakehouse import silver_order_lines
    b = SourceContract(spark, sf_dir).order_lines_bronze
    # bronze as landed text: dates and numbers arrive as strings
    text = b.withColumns({c: F.col(c).cast("string") for c in
                          ("order_date", "promised_date", "units_ordered", "units_shipped", "revenue")})
    return silver_order_lines(text, tie_break=TIE_BREAK).drop(*TIE_BREAK, "l_orderkey", "l_linenumber")


@register("gold_order_service")
def gold_order_service_q(spark, sf_dir):
    from lading.plans.lakehouse import gold_order_service
    wh = _wh(spark, sf_dir)
    return gold_order_service(wh.fct_order_line, wh.fct_shipment)


@register("quality_summary")
def quality_summary_q(spark, sf_dir):
    from lading.plans.lakehouse import quality_summary
    return quality_summary(SourceContract(spark, sf_dir).order_lines_bronze)


MERGE_COLUMNS = ("order_line_id", "order_id", "customer_id", "order_date", "promised_date", "sku",
                 "units_ordered", "units_shipped", "revenue")


def _merge(spark, sf_dir, conditional):
    from lading.operators.merge import merge_into
    c = SourceContract(spark, sf_dir)
    out = merge_into(c.merge_target, c.merge_source, "order_line_id", MERGE_COLUMNS,
                     ("units_shipped", "revenue"), conditional=conditional)
    return out.drop("updated_at")


@register("merge_conditional")
def merge_conditional_q(spark, sf_dir):
    return _merge(spark, sf_dir, True)


@register("merge_upsert")
def merge_upsert_q(spark, sf_dir):
    return _merge(spark, sf_dir, False)


@register("merge_folders")
def merge_folders_q(spark, sf_dir):
    """I1 over a target in folders by key: only folders with source keys are
    read and replaced; the whole target afterwards."""
    from lading.operators.merge import merge_folders, write_folders
    c = SourceContract(spark, sf_dir)
    path = _scratch(spark, "merge_folders")
    write_folders(c.merge_target.select(*MERGE_COLUMNS), path, "order_line_id")
    merge_folders(path, c.merge_source, "order_line_id", MERGE_COLUMNS, ("units_shipped", "revenue"), conditional=True)
    return spark.read.parquet(path).select(*MERGE_COLUMNS)


# relations that several metrics of one report read, written once
REPORTED = frozenset({"dim_customer", "fct_shipment", "order_facts"})
# what the checks and the carrier mart read of them
REPORTED_COLUMNS = {
    "raw_order_lines": ORDER_LINE_COLUMNS,
    "fct_shipment": SHIPMENT_COLUMNS,
    "order_facts": ("order_id", "carrier", "unit_fill_rate", "complete_order_flag", "on_time_flag", "otif_flag",
                    "order_lead_time_days", "freight_cost", "shipment_weight_kg", "exception_cost"),
}


@register("quality_report")
def quality_report_q(spark, sf_dir):
    return Warehouse.from_testdata(spark, sf_dir, materialize=True, keep=REPORTED, columns=REPORTED_COLUMNS).data_quality_report


@register("reconcile_lines")
def reconcile_lines_q(spark, sf_dir):
    """K3/K4 by bucket of keys: where the bronze lines (with their repeated
    deliveries) and the clean fact differ."""
    from lading.plans.quality import reconcile
    c = SourceContract(spark, sf_dir)
    return reconcile(c.order_lines_bronze, Warehouse(c.extracts()).fct_order_line)


@register("quality_gate")
def quality_gate_q(spark, sf_dir):
    """Failing checks when bronze (repeating keys) is published as the clean fact."""
    from lading.operators.materialize import Materializer
    from lading.plans.quality import failing_checks
    m = Materializer(spark, columns=REPORTED_COLUMNS)
    c = SourceContract(spark, sf_dir, m)
    raw = c.extracts()
    raw["erp_order_lines"] = m("bronze_order_lines", c.order_lines_bronze.select(*ORDER_LINE_COLUMNS))
    return failing_checks(Warehouse(raw, m, keep=REPORTED).data_quality_report)


@register("build_summary")
def build_summary_q(spark, sf_dir):
    from lading.plans.quality import build_summary
    return build_summary(_wh(spark, sf_dir).order_facts)


@register("export_checks")
def export_checks_q(spark, sf_dir):
    """The six checks over the *exported* CSV outputs, read back with
    their schemas (export -> validate, as in the reference's verify chain)."""
    from lading.operators.layout import export_ordered_csv, read_csv
    from lading.plans.build import EXPORTS
    from lading.plans.quality import export_checks
    wh = Warehouse.from_testdata(spark, sf_dir, materialize=True, keep=REPORTED)
    root = _scratch(spark, "exports")
    back = {}
    for relation, frame in (("mart_order_fulfillment", wh.mart_order_fulfillment),
                            ("mart_carrier_performance", wh.mart_carrier_performance),
                            ("data_quality_report", wh.data_quality_report)):
        folder, order_by = EXPORTS[relation]
        export_ordered_csv(frame, f"{root}/{folder}", order_by)
        back[relation] = read_csv(spark, f"{root}/{folder}", frame.schema)
    return export_checks(back["mart_order_fulfillment"], back["mart_carrier_performance"],
                         back["data_quality_report"])


@register("qa_duplicate_keys")
def qa_duplicate_keys_q(spark, sf_dir):
    from lading.operators.merge import duplicate_keys
    return duplicate_keys(SourceContract(spark, sf_dir).order_lines_bronze, "order_line_id")


@register("qa_mart_violations")
def qa_mart_violations_q(spark, sf_dir):
    from lading.plans.quality import mart_violations
    return mart_violations(_wh(spark, sf_dir).mart_order_fulfillment)


@register("qa_violation_counts")
def qa_violation_counts_q(spark, sf_dir):
    from lading.plans.quality import violation_counts
    return violation_counts(_wh(spark, sf_dir).order_facts)


def _skewed_flags(spark, sf_dir):
    """An order mart that breaks its rules: OTIF ignores the delivery, the
    fill rate is inverted (for the checks to find something)."""
    from pyspark.sql import functions as F
    from lading.functions.exprs import ratio
    return (_wh(spark, sf_dir, False).order_facts
            .select("order_id", ratio("units_ordered", "units_shipped").alias("unit_fill_rate"), "on_time_flag",
                    "complete_order_flag", F.col("complete_order_flag").alias("otif_flag")))


@register("qa_mart_violations_found")
def qa_mart_violations_found_q(spark, sf_dir):
    """K14 on a mart with violations."""
    from lading.plans.quality import mart_violations
    return mart_violations(_skewed_flags(spark, sf_dir))


@register("qa_violation_counts_found")
def qa_violation_counts_found_q(spark, sf_dir):
    """K15 on a mart with violations."""
    from lading.plans.quality import violation_counts
    return violation_counts(_skewed_flags(spark, sf_dir))


@register("order_weight")
def order_weight_q(spark, sf_dir):
    return SourceContract(spark, sf_dir).order_weights


@register("demand_grid")
def demand_grid_q(spark, sf_dir):
    grid = SourceContract(spark, sf_dir).demand_grid
    return grid.select("snapshot_date", "warehouse", "sku", "monthly_demand", grid.avg_daily.cast("decimal(18,4)").alias("avg_daily"))


@register("warehouse_activity")
def warehouse_activity_q(spark, sf_dir):
    return SourceContract(spark, sf_dir).warehouse_activity


@register("carrier_lead_time_sketch")
def carrier_lead_time_sketch_q(spark, sf_dir):
    """Lead time quantiles per carrier from daily sketches merged over the
    days (engine-specific: rows-only check)."""
    from lading.plans.sketches import daily_lead_time_sketches, lead_time_quantiles
    return lead_time_quantiles(daily_lead_time_sketches(_wh(spark, sf_dir).order_facts))


@register("carrier_lead_time_approx")
def carrier_lead_time_approx_q(spark, sf_dir):
    """Approximate percentiles (engine-specific: rows-only check)."""
    from pyspark.sql import functions as F
    m = _wh(spark, sf_dir).order_facts.filter(F.col("carrier").isNotNull())
    lead = F.col("order_lead_time_days")
    return m.groupBy("carrier").agg(F.percentile_approx(lead, 0.5).alias("median_lead_time_days"),
                                    F.percentile_approx(lead, 0.9).alias("p90_lead_time_days"))


def _scratch(spark, name):
    import uuid
    from lading.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("src_scan")
def src_scan_q(spark, sf_dir):
    """A1/A2: the order-line extract written as header CSV, scanned back with its declared schema."""
    from lading.sources.extracts import read_extract, write_extracts
    d = _scratch(spark, "extracts")
    write_extracts({"erp_order_lines": SourceContract(spark, sf_dir).extracts()["erp_order_lines"]}, d)
    return read_extract(spark, d, "erp_order_lines")


@register("export_order_mart")
def export_order_mart_q(spark, sf_dir):
    """A5/F1: ordered CSV export of the order mart, read back."""
    from lading.operators.layout import export_ordered_csv, read_csv
    mart = _wh(spark, sf_dir, False).mart_order_fulfillment
    d = _scratch(spark, "mart_order_fulfillment.csv")
    export_ordered_csv(mart, d, ["customer_id", "order_date", "order_id"])
    return read_csv(spark, d, mart.schema)


def _partitioned_fact(spark, sf_dir):
    from lading.operators.layout import write_partitioned
    f = _wh(spark, sf_dir).fct_order_line
    d = _scratch(spark, "fct_order_lines_by_date")
    write_partitioned(f, d, "order_date", ["warehouse", "customer_id", "sku"])
    return d, f.schema


@register("fact_partitioned")
def fact_partitioned_q(spark, sf_dir):
    """Date-partitioned order-line fact, sorted inside its folders, read back whole."""
    from lading.operators.layout import read_partitioned_all
    d, schema = _partitioned_fact(spark, sf_dir)
    return read_partitioned_all(spark, d, schema)


PRUNED_RANGE = ("1995-01-01", "1995-12-31")


@register("fact_pruned_read")
def fact_pruned_read_q(spark, sf_dir):
    """The partitioned fact read with its mandatory date range."""
    from lading.operators.layout import read_partitioned
    d, schema = _partitioned_fact(spark, sf_dir)
    return read_partitioned(spark, d, schema, "order_date", *PRUNED_RANGE)


@register("fact_bucketed")
def fact_bucketed_q(spark, sf_dir):
    """Order lines bucketed by order_id; the order rollup over the
    bucketed table needs no shuffle of the lines."""
    import uuid
    from lading.operators.layout import write_bucketed
    from lading.plans.fulfillment import order_rollup
    f = _wh(spark, sf_dir).fct_order_line
    name = f"fct_order_lines_{uuid.uuid4().hex[:12]}"
    write_bucketed(f, name, _scratch(spark, name), "order_id", ["order_date"])
    return order_rollup(spark.table(name))


@register("mart_clustered_read")
def mart_clustered_read_q(spark, sf_dir):
    """The order mart clustered by (order date, warehouse), read with a date range."""
    from pyspark.sql import functions as F
    from lading.operators.layout import write_clustered
    d = _scratch(spark, "mart_clustered")
    write_clustered(_wh(spark, sf_dir, False).mart_order_fulfillment, d, ["order_date", "warehouse"])
    return spark.read.parquet(d).where(F.col("order_date").between(*[F.lit(x).cast("date") for x in PRUNED_RANGE]))


@register("fact_dimension_pruned")
def fact_dimension_pruned_q(spark, sf_dir):
    """Weekend revenue of one quarter per day.  The filter is on the
    calendar alone; its days reach the fact's scan as a dynamic partition filter."""
    from lading.operators.layout import read_partitioned_all
    from lading.plans.calendar import revenue_by_day
    d, schema = _partitioned_fact(spark, sf_dir)
    wh = Warehouse.from_testdata(spark, sf_dir, materialize=True, keep={"dim_date"})
    days = wh.dim_date.where("calendar_year = 1995 and calendar_quarter = 2 and is_weekend")
    return revenue_by_day(read_partitioned_all(spark, d, schema), days)


@register("bucketed_join")
def bucketed_join_q(spark, sf_dir):
    """Lines and shipments bucketed alike by order, rolled up and
    joined bucket to bucket."""
    import uuid
    from lading.operators.layout import write_bucketed
    from lading.plans.fulfillment import order_shipments
    wh = _wh(spark, sf_dir)
    names = []
    for frame in (wh.fct_order_line, wh.fct_shipment):
        names.append(f"by_order_{uuid.uuid4().hex[:12]}")
        write_bucketed(frame, names[-1], _scratch(spark, names[-1]), "order_id")
    return order_shipments(*[spark.table(n) for n in names])


@register("order_rollup")
def order_rollup_q(spark, sf_dir):
    """Order-grain rollup of the clean order lines."""
    from lading.plans.fulfillment import order_rollup
    return order_rollup(_wh(spark, sf_dir, False).fct_order_line)


def _history(spark, sf_dir):
    from lading.plans.fulfillment import with_customer_history
    return with_customer_history(_wh(spark, sf_dir).order_facts)


@register("customer_order_number")
def customer_order_number_q(spark, sf_dir):
    """Each order's number in its customer's history (date, then id)."""
    return _history(spark, sf_dir).select("order_id", "customer_id", "order_date", "customer_order_number")


@register("customer_lifetime_revenue")
def customer_lifetime_revenue_q(spark, sf_dir):
    """Running revenue over the customer's orders up to and including this one."""
    return _history(spark, sf_dir).select("order_id", "customer_id", "order_date", "recognized_revenue",
                                          "customer_lifetime_revenue")


@register("dedup_latest_lines")
def dedup_latest_lines_q(spark, sf_dir):
    """Keep-latest bronze order line per key (the raw extract)."""
    return SourceContract(spark, sf_dir).order_lines
