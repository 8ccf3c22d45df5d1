"""Quality report and gate on good and bad data."""

import pytest

from tests.conftest import SF_SMALL, whole_months


def test_report_passes_on_clean_data(spark):
    from lading.operators.materialize import Materializer
    from lading.plans.warehouse import Warehouse
    m = Materializer(spark)
    report = Warehouse(whole_months(spark, m).extracts(), m).data_quality_report
    rows = report.collect()
    assert len(rows) == 9
    assert {r["status"] for r in rows} == {"PASS"}


def test_gate_raises_on_bronze(spark):
    from lading.plans.quality import QualityGateError, enforce_gate
    from lading.plans.warehouse import Warehouse
    from lading.sources.contract import SourceContract
    c = SourceContract(spark, SF_SMALL)
    raw = c.extracts()
    raw["erp_order_lines"] = c.order_lines_bronze            # repeated order_line_id
    with pytest.raises(QualityGateError, match="order_line_key_unique"):
        enforce_gate(Warehouse(raw).data_quality_report)


def test_export_checks_pass(spark):
    from lading.plans.quality import export_checks
    from lading.operators.materialize import Materializer
    from lading.plans.warehouse import Warehouse
    m = Materializer(spark)
    wh = Warehouse(whole_months(spark, m).extracts(), m)
    out = export_checks(wh.mart_order_fulfillment, wh.mart_carrier_performance, wh.data_quality_report)
    assert all(r["passed"] for r in out.collect())


def test_warehouse_month_without_demand_fails_the_forecast_check(spark):
    """The grid is dense, so a month without demand has no accuracy (NULL),
    which is not in range."""
    from lading.plans.quality import failing_checks
    from lading.plans.warehouse import Warehouse
    report = Warehouse.from_testdata(spark, SF_SMALL, materialize=True).data_quality_report
    assert [r["check_name"] for r in failing_checks(report).collect()] == ["forecast_accuracy_reasonable"]
