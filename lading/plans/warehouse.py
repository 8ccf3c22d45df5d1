"""Wiring of the layered warehouse: raw extracts -> clean -> marts -> quality.

``Warehouse`` holds lazy DataFrames only.  Each property is a plan; nothing
runs until an action.  ``build`` (in ``lading.plans.build``) materialises the
layers to Parquet in dependency order, gates on the quality report and only
then publishes the exports.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lading.operators import conform
from lading.sources.contract import SourceContract


class Warehouse:
    # Tables materialised when a Materializer is given and no explicit list:
    # those read by several consumers in a single job.
    SHARED = frozenset({"dim_customer", "fct_shipment"})

    def __init__(self, raw, materialize=None, keep=None):
        missing = {"customers", "suppliers", "products", "erp_order_lines", "tms_shipments",
                   "wms_inventory_snapshots", "demand_forecasts"} - set(raw)
        if missing:
            raise KeyError(f"missing raw extracts: {sorted(missing)}")
        self.raw = raw
        self._m = materialize
        self._names = frozenset(keep) if keep is not None else self.SHARED

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        """Materialise ``name`` (a layer table) when enabled for it."""
        if self._m is not None and name in self._names:
            return self._m(name, df)
        return df

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, materialize: bool = False,
                      keep=None, columns=None) -> "Warehouse":
        """Warehouse over the extracts derived from the driver's tables.  With
        ``materialize``, the raw order lines and the ``keep`` tables (default
        ``SHARED``) are written once to the shared checkpoint folder, each with
        its ``columns`` alone where they are given."""
        m = None
        if materialize:
            from lading.operators.materialize import Materializer
            m = Materializer(spark, columns=columns)
        return cls(SourceContract(spark, sf_dir, m).extracts(), m, keep)

    # --- clean -----------------------------------------------------------
    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._keep("dim_customer", conform.dim_customer(self.raw["customers"]))

    @cached_property
    def dim_supplier(self) -> DataFrame:
        return self._keep("dim_supplier", conform.dim_supplier(self.raw["suppliers"]))

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._keep("dim_product", conform.dim_product(self.raw["products"]))

    @cached_property
    def fct_order_line(self) -> DataFrame:
        return self._keep("fct_order_line", conform.fct_order_line(self.raw["erp_order_lines"]))

    @cached_property
    def fct_shipment(self) -> DataFrame:
        return self._keep("fct_shipment", conform.fct_shipment(self.raw["tms_shipments"]))

    @cached_property
    def fct_inventory_snapshot(self) -> DataFrame:
        return self._keep("fct_inventory_snapshot", conform.fct_inventory_snapshot(self.raw["wms_inventory_snapshots"]))

    @cached_property
    def fct_demand_forecast(self) -> DataFrame:
        return self._keep("fct_demand_forecast", conform.fct_demand_forecast(self.raw["demand_forecasts"]))

    # --- calendar and marts ------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        from lading.plans.calendar import dim_date
        return self._keep("dim_date", dim_date(self.fct_order_line, self.fct_shipment))

    @cached_property
    def order_facts(self) -> DataFrame:
        """Orders for rollups that need no customer history: the materialised
        order mart when the build wrote it, else the mart without history."""
        if self._m is not None and "mart_order_fulfillment" in self._names:
            return self.mart_order_fulfillment
        from lading.plans.fulfillment import order_facts
        return self._keep("order_facts", order_facts(self.fct_order_line, self.dim_customer, self.fct_shipment))

    @cached_property
    def mart_order_fulfillment(self) -> DataFrame:
        from lading.plans.fulfillment import order_facts, with_customer_history
        facts = self._keep("order_facts", order_facts(self.fct_order_line, self.dim_customer, self.fct_shipment))
        return self._keep("mart_order_fulfillment", with_customer_history(facts))

    @cached_property
    def mart_daily_service_level(self) -> DataFrame:
        from lading.plans.fulfillment import mart_daily_service_level
        return self._keep("mart_daily_service_level", mart_daily_service_level(self.order_facts))

    @cached_property
    def mart_carrier_performance(self) -> DataFrame:
        from lading.plans.fulfillment import mart_carrier_performance
        return self._keep("mart_carrier_performance", mart_carrier_performance(self.order_facts))

    @cached_property
    def mart_inventory_risk(self) -> DataFrame:
        from lading.plans.inventory import mart_inventory_risk
        return self._keep("mart_inventory_risk", mart_inventory_risk(self.fct_inventory_snapshot, self.dim_product, self.dim_supplier))

    @cached_property
    def mart_forecast_accuracy(self) -> DataFrame:
        from lading.plans.inventory import mart_forecast_accuracy
        return self._keep("mart_forecast_accuracy", mart_forecast_accuracy(self.fct_demand_forecast))

    @cached_property
    def data_quality_report(self) -> DataFrame:
        from lading.plans.quality import data_quality_report
        return self._keep("data_quality_report", data_quality_report(self))
