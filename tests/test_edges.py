"""Hand-made edge rows per operator."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

D = dt.date


def lines_df(spark, rows):
    schema = ("order_line_id string, order_id string, customer_id string, warehouse string, "
              "order_date date, promised_date date, sku string, supplier_id string, units_ordered int, "
              "units_shipped int, unit_price decimal(18,2), unit_weight_kg decimal(18,3), revenue decimal(18,2)")
    return spark.createDataFrame(rows, schema)


def ship_df(spark, rows):
    schema = ("shipment_id string, order_id string, carrier string, warehouse string, ship_date date, "
              "delivery_date date, promised_date date, shipment_weight_kg decimal(18,3), "
              "freight_cost decimal(18,2), handling_cost decimal(18,2), exception_cost decimal(18,2), "
              "source_on_time boolean")
    return spark.createDataFrame(rows, schema)


def line(lid, oid, cust, od, pd, ordered, shipped, wh="WH-NORTH", sku="S1", price="10.00"):
    p = Decimal(price)
    return (lid, oid, cust, wh, od, pd, sku, "SUP1", ordered, shipped, p, Decimal("1.000"),
            p * shipped)


@pytest.fixture(scope="module")
def mart(spark):
    from lading.plans.fulfillment import mart_order_fulfillment
    lines = lines_df(spark, [
        line("L1", "O1", "C1", D(2025, 1, 1), D(2025, 1, 3), 0, 0),        # zero ordered
        line("L2", "O2", "C1", D(2025, 1, 2), D(2025, 1, 4), 5, 7),        # over-shipped line ...
        line("L3", "O2", "C1", D(2025, 1, 2), D(2025, 1, 4), 5, 2),        # ... beside a short line
        line("L4", "O3", "C1", D(2025, 1, 2), D(2025, 1, 4), 4, 4),        # no shipment
        line("L5", "O4", "CX", D(2025, 1, 3), D(2025, 1, 5), 4, 4),        # unknown customer
        line("L6", "O5", "C2", D(2025, 1, 3), D(2025, 1, 5), 3, 3),        # NULL cost component
    ])
    cust = spark.createDataFrame([("C1", "SMB", "North"), ("C2", "Enterprise", "South")],
                                 "customer_id string, customer_segment string, region string")
    ship = ship_df(spark, [
        ("S1", "O1", "CarrierA", "WH-NORTH", D(2025, 1, 1), D(2025, 1, 2), D(2025, 1, 3), Decimal("0.000"),
         Decimal("10.00"), Decimal("1.00"), Decimal("0.00"), True),
        ("S2", "O2", "CarrierA", "WH-NORTH", D(2025, 1, 2), D(2025, 1, 4), D(2025, 1, 4), Decimal("9.000"),
         Decimal("18.00"), Decimal("2.00"), Decimal("0.00"), True),
        ("S5", "O5", "CarrierB", "WH-NORTH", D(2025, 1, 3), D(2025, 1, 9), D(2025, 1, 5), Decimal("3.000"),
         Decimal("6.00"), None, Decimal("5.00"), False),
    ])
    return {r["order_id"]: r for r in mart_order_fulfillment(lines, cust, ship).collect()}


def test_unknown_customer_drops_order(mart):
    assert set(mart) == {"O1", "O2", "O3", "O5"}


def test_zero_ordered_has_null_fill_and_is_complete(mart):
    assert mart["O1"]["unit_fill_rate"] is None
    assert mart["O1"]["complete_order_flag"] == 1
    assert mart["O1"]["freight_cost_per_kg"] is None      # zero weight


def test_over_shipping_hides_short_line(mart):
    assert mart["O2"]["units_shipped"] == 9 and mart["O2"]["units_ordered"] == 10
    assert mart["O2"]["complete_order_flag"] == 0


def test_unshipped_order_scores_zero_not_null(mart):
    o = mart["O3"]
    assert o["shipment_id"] is None and o["on_time_flag"] == 0 and o["otif_flag"] == 0


def test_null_cost_component_nulls_logistics_cost(mart):
    assert mart["O5"]["logistics_cost"] is None
    assert mart["O5"]["on_time_flag"] == 0


def test_customer_history(mart):
    assert [mart[o]["customer_order_number"] for o in ("O1", "O2", "O3")] == [1, 2, 3]
    assert mart["O3"]["customer_lifetime_revenue"] == Decimal("130.00")


def test_gold_flags_are_null_when_undelivered(spark):
    from lading.plans.lakehouse import gold_order_service
    lines = lines_df(spark, [line("L1", "O1", "C1", D(2025, 1, 1), D(2025, 1, 3), 2, 2),
                             line("L2", "O2", "C1", D(2025, 1, 1), D(2025, 1, 3), 2, 1)])
    g = {r["order_id"]: r for r in gold_order_service(lines, ship_df(spark, [])).collect()}
    assert g["O1"]["on_time_flag"] is None and g["O1"]["otif_flag"] is None   # complete, undelivered
    assert g["O2"]["otif_flag"] == 0                                          # incomplete


@pytest.mark.parametrize("on_hand,demand,status", [
    (0, "1.000", "STOCKOUT"), (0, "0.000", "HEALTHY"), (6, "1.000", "CRITICAL"), (7, "1.000", "WATCH"),
    (14, "1.000", "HEALTHY"), (90, "1.000", "HEALTHY"), (91, "1.000", "EXCESS"), (5, "0.000", "HEALTHY"),
])
def test_inventory_status_thresholds(spark, on_hand, demand, status):
    from lading.plans.inventory import mart_inventory_risk
    inv = spark.createDataFrame([(D(2000, 1, 1), "WH", "S1", on_hand, Decimal(demand), Decimal("1.00"))],
                                "snapshot_date date, warehouse string, sku string, on_hand_units int, "
                                "average_daily_demand decimal(18,3), inventory_value decimal(18,2)")
    prod = spark.createDataFrame([("S1", "Cat", "SUP1")], "sku string, product_category string, supplier_id string")
    sup = spark.createDataFrame([("SUP1", "Low")], "supplier_id string, supplier_risk_tier string")
    assert mart_inventory_risk(inv, prod, sup).collect()[0]["inventory_risk_status"] == status


def test_forecast_zero_actuals(spark):
    from lading.plans.inventory import mart_forecast_accuracy
    fc = spark.createDataFrame([(D(2000, 1, 1), "WH", "S1", 5, 0)],
                               "forecast_month date, warehouse string, sku string, forecast_units int, actual_units int")
    r = mart_forecast_accuracy(fc).collect()[0]
    assert r["wape"] is None and r["forecast_accuracy"] is None


def test_carrier_ties_and_single_carrier(spark):
    from lading.plans.fulfillment import mart_carrier_performance
    rows = [("A", 1, 1, 1, 2, Decimal("10.00"), Decimal("1.000"), Decimal("0.00")),
            ("B", 1, 1, 1, 2, Decimal("10.00"), Decimal("1.000"), Decimal("0.00"))]
    df = spark.createDataFrame(rows, "carrier string, on_time_flag int, complete_order_flag int, otif_flag int, "
                                     "order_lead_time_days bigint, freight_cost decimal(18,2), "
                                     "shipment_weight_kg decimal(18,3), exception_cost decimal(18,2)")
    out = mart_carrier_performance(df).collect()
    assert {r["service_cost_rank"] for r in out} == {1}
    single = mart_carrier_performance(df.filter("carrier = 'A'")).collect()[0]
    assert single["lead_time_percentile"] == 0.0


def test_calendar_week_53_and_weekend(spark):
    from lading.plans.calendar import dim_date
    lines = lines_df(spark, [line("L1", "O1", "C1", D(2026, 12, 30), D(2027, 1, 2), 1, 1)])
    ship = ship_df(spark, [("S1", "O1", "A", "WH", D(2027, 1, 1), D(2027, 1, 3), D(2027, 1, 2),
                            Decimal("1.000"), Decimal("1.00"), Decimal("1.00"), Decimal("0.00"), True)])
    cal = {r["calendar_date"]: r for r in dim_date(lines, ship).collect()}
    assert len(cal) == 5
    assert cal[D(2027, 1, 1)]["calendar_week"] == 53 and cal[D(2027, 1, 1)]["calendar_year"] == 2027
    assert cal[D(2027, 1, 2)]["day_name"] == "Saturday" and cal[D(2027, 1, 2)]["is_weekend"]
    assert not cal[D(2026, 12, 31)]["is_weekend"]


def test_calendar_week_1_at_year_end(spark):
    from lading.plans.calendar import dim_date
    lines = lines_df(spark, [line("L1", "O1", "C1", D(2024, 12, 30), D(2024, 12, 31), 1, 1)])
    ship = ship_df(spark, [("S1", "O1", "A", "WH", D(2024, 12, 30), D(2024, 12, 30), D(2024, 12, 31),
                            Decimal("1.000"), Decimal("1.00"), Decimal("1.00"), Decimal("0.00"), True)])
    r = dim_date(lines, ship).collect()
    assert len(r) == 1 and r[0]["calendar_week"] == 1


def test_cohort_month_boundaries(spark):
    from lading.plans.cohorts import cohort_revenue
    lines = lines_df(spark, [line("L1", "O1", "C1", D(2025, 1, 31), D(2025, 2, 2), 1, 1),
                             line("L2", "O2", "C1", D(2025, 2, 1), D(2025, 2, 3), 1, 1),
                             line("L3", "O3", "C1", D(2025, 4, 1), D(2025, 4, 3), 1, 1)])  # gap month
    out = [(r["months_since_first_order"], r["active_customers"]) for r in cohort_revenue(lines).collect()]
    assert out == [(0, 1), (1, 1), (3, 1)]


def test_merge_null_is_not_a_change_and_inserts(spark):
    from lading.operators.merge import merge_into
    schema = "k string, a int, v decimal(18,2)"
    tgt = spark.createDataFrame([("1", None, Decimal("1.00")), ("2", 5, Decimal("2.00")), ("3", 1, Decimal("1.00"))], schema)
    src = spark.createDataFrame([("1", 4, Decimal("1.00")), ("2", 6, Decimal("2.00")), ("4", 9, Decimal("9.00"))], schema)
    cond = {r["k"]: r for r in merge_into(tgt, src, "k", ["k", "a", "v"], ["a", "v"], True).collect()}
    assert cond["1"]["merge_action"] == "unchanged" and cond["1"]["a"] is None   # NULL <> 4 is not a change
    assert cond["2"]["merge_action"] == "updated" and cond["2"]["a"] == 6
    assert cond["3"]["merge_action"] == "unchanged"
    assert cond["4"]["merge_action"] == "inserted" and cond["4"]["updated_at"] is not None
    upsert = {r["k"]: r for r in merge_into(tgt, src, "k", ["k", "a", "v"], ["a", "v"], False).collect()}
    assert upsert["1"]["merge_action"] == "updated" and upsert["1"]["a"] == 4


def test_merge_source_must_be_unique(spark):
    from lading.operators.merge import assert_unique_keys
    df = spark.createDataFrame([("1",), ("1",)], "k string")
    with pytest.raises(ValueError):
        assert_unique_keys(df, "k")


def test_tolerant_staging(spark):
    from lading.plans.lakehouse import stg_order_lines
    schema = ("order_line_id string, order_id string, customer_id string, order_date string, promised_date string, "
              "sku string, units_ordered string, units_shipped string, revenue string, ingestion_timestamp timestamp")
    ts = dt.datetime(2025, 1, 1)
    raw = spark.createDataFrame([
        (" L1 ", "O1", "C1", "N/A", "2025-01-03", "S", "bad", "2.5", "", ts),
        ("L1", "O1", "C1", "2025-01-01", "2025-01-03", "S", "3", "3", "1.50", ts - dt.timedelta(days=1)),
    ], schema)
    r = stg_order_lines(raw).collect()
    assert len(r) == 1                                     # padded key collapses; latest kept
    assert r[0]["order_date"] is None and r[0]["units_ordered"] is None and r[0]["revenue"] is None
    assert r[0]["units_shipped"] == Decimal("3")           # '2.5' -> decimal(38,0) rounds half up


def test_strict_staging_raises(spark):
    from lading.operators.conform import silver_types
    df = spark.createDataFrame([("L1", "2025-01-01", "2025-01-02", "x", "1", "1.0")],
                               "order_line_id string, order_date string, promised_date string, "
                               "units_ordered string, units_shipped string, revenue string")
    with pytest.raises(Exception):
        silver_types(df).collect()


def test_nested_empty_and_missing_items_drop(spark):
    from lading.plans.nested import flatten_order_events
    ev = spark.createDataFrame([
        ('{"order_id":"O1","event_type":"order_created","event_timestamp":"2025-01-01T00:00:00","items":[]}',),
        ('{"order_id":"O2","event_type":"order_created","event_timestamp":"2025-01-01T00:00:00"}',),
        ('{"order_id":"O3","event_type":"order_created","event_timestamp":"2025-01-01T00:00:00",'
         '"items":[{"sku":"A","quantity":2,"extended_price":3.5}]}',),
        ('{"order_id":"O4","event_type":"order_updated","event_timestamp":"2025-01-01T00:00:00",'
         '"items":[{"sku":"A","quantity":2,"extended_price":3.5}]}',),
    ], "event_payload string")
    out = flatten_order_events(ev).collect()
    assert [(r["order_id"], r["sku"], r["quantity"], r["extended_price"]) for r in out] == \
        [("O3", "A", Decimal("2"), Decimal("3.50"))]


def test_quality_summary_counts(spark):
    from lading.plans.lakehouse import quality_summary
    df = spark.createDataFrame([("L1", 1, 2), ("L1", 3, 1), (None, 1, 1)],
                               "order_line_id string, units_ordered int, units_shipped int")
    r = quality_summary(df).collect()[0]
    assert (r["row_count"], r["distinct_order_line_ids"], r["null_order_line_ids"], r["over_shipped_rows"]) == (3, 1, 1, 1)


def test_grain_breaks_are_reported_not_masked(spark):
    """H1: a second shipment and a split-warehouse order duplicate order rows;
    the mart keeps them and the grain checks fail."""
    from lading.plans.fulfillment import mart_carrier_performance, mart_order_fulfillment
    from lading.plans.inventory import mart_forecast_accuracy
    from lading.plans.quality import quality_checks
    lines = lines_df(spark, [line("L1", "O1", "C1", D(2025, 1, 1), D(2025, 1, 3), 2, 2),
                             line("L2", "O2", "C1", D(2025, 1, 1), D(2025, 1, 3), 2, 2, wh="WH-NORTH"),
                             line("L3", "O2", "C1", D(2025, 1, 1), D(2025, 1, 3), 2, 2, wh="WH-SOUTH")])
    cust = spark.createDataFrame([("C1", "SMB", "North")], "customer_id string, customer_segment string, region string")
    s = ("CarrierA", "WH-NORTH", D(2025, 1, 1), D(2025, 1, 2), D(2025, 1, 3), Decimal("1.000"),
         Decimal("1.00"), Decimal("1.00"), Decimal("0.00"), True)
    ship = ship_df(spark, [("S1", "O1") + s, ("S1b", "O1") + s])
    mart = mart_order_fulfillment(lines, cust, ship)
    assert mart.count() == 4                       # O1 twice (two shipments), O2 twice (two warehouses)
    fc = spark.createDataFrame([(D(2000, 1, 1), "WH", "S1", 5, 5)],
                               "forecast_month date, warehouse string, sku string, forecast_units int, actual_units int")
    report = {r["check_name"]: r["status"] for r in quality_checks(
        lines, lines, ship, mart, mart_carrier_performance(mart), mart_forecast_accuracy(fc)).collect()}
    assert report["shipment_order_unique"] == "FAIL"
    assert report["mart_order_grain_unique"] == "FAIL"
    assert report["order_line_key_unique"] == "PASS"


def test_grid_counts_every_ordered_unit(spark):
    from lading.sources.contract import SourceContract
    from tests.conftest import SF_SMALL
    c = SourceContract(spark, SF_SMALL)
    grid = c.demand_grid.agg(F.sum("monthly_demand")).first()[0]
    assert grid == c.order_lines.agg(F.sum("units_ordered")).first()[0] > 0


def test_merge_source_with_a_repeated_key_fails(spark):
    from lading.operators.merge import merge_into
    t = spark.createDataFrame([("a", 1)], "k string, v int")
    s = spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int")
    with pytest.raises(Exception, match="merge source repeats k=a"):
        merge_into(t, s, "k", ("k", "v"), ("v",), conditional=True).collect()
