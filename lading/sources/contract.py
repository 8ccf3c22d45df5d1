"""The reference's source contract, derived from the driver's tables.

The reference reads eight ERP/WMS/TMS extracts.  The driver ships TPC-H-style
Parquet instead, so each extract is derived here with deterministic
arithmetic (FIXTURES.md §2).  Everything is a lazy DataFrame: but for the count
of a join's small side (``broadcast_if_small``) nothing runs until a job's
action, and Catalyst prunes unused columns back to the scans.

Fixed values below (moduli, thresholds, labels) define the synthetic
carriers, warehouses, delays and costs; the DuckDB oracle uses the same ones.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lading.functions.exprs import padded_id
from lading.functions.joins import broadcast_if_small
from lading.operators.dedup import latest_by
from lading.sources.tables import read_table

# --- fixed values of the derived contract --------------------------------
# warehouse split: (o_orderkey*37) % 103  -> <35 WH-NORTH, <78 WH-CENTRAL, else WH-SOUTH
# service days:    (o_orderkey*53) % 101  -> <10: 2, <40: 3, <86: 5, else 7
# delay days:      (o_orderkey*71) % 97   -> <4: -1, <70: 0, <81: 1, <89: 2, <94: 3, else 5
# carrier:         (o_orderkey*29) % 100  -> <30 CarrierA, <58 CarrierB, <82 CarrierC, else CarrierD
# shipped in full: (l_orderkey*13 + l_linenumber*7 + l_partkey) % 100 < 94
# supplier tier:   s_suppkey % 20 -> <11 Low, <17 Medium, else High
# demand grid:     months from the first to the last order x warehouses (numbered by name) x SKU
# merge fixture windows on ingestion_timestamp
MERGE_TARGET_BEFORE = "2000-01-01 00:00:00"
MERGE_SOURCE_FROM = "1999-07-01 00:00:00"

# keep-latest ordering for bronze order lines (ties broken on all payload)
LATEST_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
LINE_KEY = ("l_orderkey", "l_linenumber")


def _bucket(value: Column, bounds_labels, otherwise) -> Column:
    out = None
    for bound, label in bounds_labels:
        out = F.when(value < bound, label) if out is None else out.when(value < bound, label)
    return out.otherwise(otherwise)


class SourceContract:
    """Lazy DataFrames for every derived extract of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize=None):
        """``materialize`` (a ``Materializer``) writes the extracts that
        several consumers read — the deduplicated order lines — once."""
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._m = materialize

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        return self._m(name, df) if self._m is not None else df

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # --- dimensions ------------------------------------------------------
    @cached_property
    def customers(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", "n_regionkey")
        region = self.table("region").select("r_regionkey", "r_name")
        geo = broadcast_if_small(nation.join(broadcast_if_small(region),
                                              nation.n_regionkey == region.r_regionkey))
        c = self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        return (c.join(geo, c.c_nationkey == geo.n_nationkey)
                .select(padded_id("C", "c_custkey", 7).alias("customer_id"),
                        F.col("c_mktsegment").alias("customer_segment"),
                        F.col("r_name").alias("region")))

    @cached_property
    def suppliers(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.table("supplier").select(
            padded_id("SUP", k, 6).alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            (F.lit(5) + k % 17).cast("int").alias("base_lead_time_days"),
            _bucket(k % 20, [(11, "Low"), (17, "Medium")], "High").alias("supplier_risk_tier"))

    @staticmethod
    def _of_product(k: Column, n_suppliers: Column) -> tuple[Column, Column]:
        """SKU and supplier, which follow from the product's key."""
        return padded_id("SKU-", k, 7).alias("sku"), padded_id("SUP", k % n_suppliers, 6).alias("supplier_id")

    @staticmethod
    def _price_and_weight() -> tuple[Column, Column]:
        return (F.col("p_retailprice").cast("decimal(18,2)").alias("unit_price"),
                (F.col("p_size").cast("decimal(18,3)") * F.lit(0.48).cast("decimal(4,2)"))
                .cast("decimal(18,3)").alias("unit_weight_kg"))

    @cached_property
    def products(self) -> DataFrame:
        n_suppliers = self.table("supplier").select(F.count(F.lit(1))).scalar()
        k = F.col("p_partkey")
        sku, supplier_id = self._of_product(k, n_suppliers)
        return self.table("part").select(
            sku,
            k,
            F.col("p_type").alias("product_category"),
            supplier_id,
            *self._price_and_weight())

    # --- order headers (helper) -------------------------------------------
    @staticmethod
    def _of_order(k: Column) -> tuple[Column, Column, Column]:
        """Id, warehouse and service days, which follow from the order's key."""
        return (padded_id("O", k, 9).alias("order_id"),
                _bucket((k * 37) % 103, [(35, "WH-NORTH"), (78, "WH-CENTRAL")], "WH-SOUTH").alias("warehouse"),
                _bucket((k * 53) % 101, [(10, 2), (40, 3), (86, 5)], 7).cast("int").alias("service_days"))

    @cached_property
    def order_headers(self) -> DataFrame:
        k = F.col("o_orderkey")
        order_id, warehouse, service_days = self._of_order(k)
        dl = (k * 71) % 97
        return self.table("orders").select(
            k,
            order_id,
            padded_id("C", "o_custkey", 7).alias("customer_id"),
            warehouse,
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_orderstatus").alias("order_status"),
            service_days,
            _bucket(dl, [(4, -1), (70, 0), (81, 1), (89, 2), (94, 3)], 5).cast("int").alias("delay_days"))

    # --- order lines -------------------------------------------------------
    @property
    def _deliveries(self) -> DataFrame:
        """The seven columns of ``lineitem`` that the extract is made of."""
        return self.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                             "l_extendedprice", "l_shipdate")

    def _lines(self, li: DataFrame) -> DataFrame:
        """Order lines in the extract's form, one per row of ``li``.

        The joins move keys, dates and prices; the ids and labels that follow
        from a key are derived above them.  The orders come last, so the lines
        of an order leave a shuffle join side by side."""
        k = F.col("o_orderkey")
        order_id, warehouse, service_days = self._of_order(k)
        n_suppliers = self.table("supplier").select(F.count(F.lit(1))).scalar()
        h = broadcast_if_small(self.table("orders").select(
            k, "o_custkey", F.col("o_orderdate").cast("date").alias("order_date")))
        p = broadcast_if_small(self.table("part").select("p_partkey", *self._price_and_weight()))
        full = (F.col("l_orderkey") * 13 + F.col("l_linenumber") * 7 + F.col("l_partkey")) % 100 < 94
        shipped = F.when(full, F.col("l_quantity")) \
            .otherwise(F.floor(F.col("l_quantity") * (F.col("l_partkey") % 10) / 10)).cast("int")
        return (li.join(p, li.l_partkey == p.p_partkey)
                .join(h, li.l_orderkey == h.o_orderkey)
                .select(
                    F.concat(F.lit("OL"), padded_id("", "l_orderkey", 9), F.lit("-"),
                             F.col("l_linenumber").cast("string")).alias("order_line_id"),
                    order_id, padded_id("C", "o_custkey", 7).alias("customer_id"), warehouse, "order_date",
                    F.date_add("order_date", service_days).alias("promised_date"),
                    *self._of_product(F.col("p_partkey"), n_suppliers),
                    F.col("l_quantity").cast("int").alias("units_ordered"),
                    shipped.alias("units_shipped"),
                    "unit_price", "unit_weight_kg",
                    (shipped * F.col("unit_price")).cast("decimal(18,2)").alias("revenue"),
                    F.col("l_shipdate").alias("ingestion_timestamp"),
                    "l_partkey", "l_suppkey", "l_extendedprice", *LINE_KEY))

    def _latest_lines(self, li: DataFrame) -> DataFrame:
        """The last delivery of every order line, in the extract's form.

        ``order_line_id`` is built injectively from (l_orderkey, l_linenumber),
        so the numeric pair names the same lines: the seven columns of the
        scan are reduced per pair before any join or derived column."""
        return self._lines(latest_by(li, LINE_KEY, LATEST_ORDER)).drop(*LINE_KEY, *LATEST_ORDER[1:])

    @cached_property
    def order_lines_bronze(self) -> DataFrame:
        """Bronze ERP order lines: ``order_line_id`` repeats (re-deliveries)."""
        return self._lines(self._deliveries)

    @cached_property
    def order_lines(self) -> DataFrame:
        """Raw ERP extract: the last delivery per ``order_line_id``."""
        return self._keep("raw_order_lines", self._latest_lines(self._deliveries))

    # --- shipments -----------------------------------------------------------
    @cached_property
    def order_weights(self) -> DataFrame:
        """Shipped kilograms per order, rounded to two places (L1)."""
        return (self.order_lines.groupBy("order_id")
                .agg(F.sum(F.col("units_shipped") * F.col("unit_weight_kg"))
                     .cast("decimal(18,2)").alias("kg")))

    @cached_property
    def shipments(self) -> DataFrame:
        h = self.order_headers
        k = F.col("o_orderkey")
        carrier = _bucket((k * 29) % 100, [(30, "CarrierA"), (58, "CarrierB"), (82, "CarrierC")],
                          "CarrierD")
        rate = (F.lit(0.35) + ((k * 17) % 51) / F.lit(100.0)).cast("decimal(4,2)")
        return (h.join(self.order_weights, "order_id")
                .select(
                    F.concat(F.lit("S"), F.substring("order_id", 2, 1 << 20)).alias("shipment_id"),
                    "order_id",
                    carrier.alias("carrier"),
                    "warehouse", "order_date",
                    F.date_add("order_date", (k % 4).cast("int")).alias("ship_date"),
                    F.date_add("order_date", F.col("service_days") + F.col("delay_days")).alias("delivery_date"),
                    F.date_add("order_date", F.col("service_days")).alias("promised_date"),
                    (F.col("delay_days") <= 0).alias("on_time"),
                    F.col("kg").alias("shipment_weight_kg"),
                    (F.lit(24) + F.col("kg") * rate).cast("decimal(18,2)").alias("freight_cost"),
                    (F.lit(4) + k % 15).cast("decimal(18,2)").alias("handling_cost"),
                    F.when(F.col("delay_days") > 0, F.lit(5) + k % 56).otherwise(F.lit(0))
                    .cast("decimal(18,2)").alias("exception_cost")))

    # --- demand grid, inventory, forecast, activity ----------------------------
    @cached_property
    def monthly_demand(self) -> DataFrame:
        return (self.order_lines
                .groupBy(F.trunc("order_date", "month").alias("snapshot_date"), "warehouse", "sku")
                .agg(F.sum("units_ordered").alias("units")))

    @cached_property
    def _axes(self) -> DataFrame:
        """One row: the months from the first to the last order and the
        warehouses by name, as arrays (bounded by the calendar and by the
        number of warehouses)."""
        return self.order_headers.agg(
            F.expr("sequence(trunc(min(order_date), 'month'), trunc(max(order_date), 'month'), interval 1 month)").alias("months"),
            F.array_sort(F.collect_set("warehouse")).alias("warehouses"))

    @staticmethod
    def _cells(df: DataFrame) -> DataFrame:
        """``df`` (with the axes) once per month and warehouse, whether or not
        the warehouse has orders in the month."""
        return (df.select("*", F.explode("months").alias("snapshot_date"))
                .select("*", F.posexplode("warehouses").alias("wi", "warehouse")).drop("months", "warehouses"))

    @cached_property
    def demand_grid(self) -> DataFrame:
        """Dense month x warehouse x SKU grid; missing demand is 0 (L3).

        The axes come from the orders alone.  The demand of a SKU in a
        warehouse travels as one map by month (at most one entry per month)
        and meets the SKU before the months are exploded: the dense cells are
        generated last and never shuffled or sorted."""
        axes = self._axes
        shelves = (self.products.select("sku", "p_partkey", "unit_price", axes.select("warehouses").scalar().alias("warehouses"))
                   .select("sku", "p_partkey", "unit_price", F.posexplode("warehouses").alias("wi", "warehouse")))
        sold = (self.monthly_demand.where("snapshot_date is not null").groupBy("sku", "warehouse")
                .agg(F.map_from_entries(F.collect_list(F.struct("snapshot_date", "units"))).alias("sold")))
        cells = (shelves.join(sold, ["sku", "warehouse"], "left")
                 .select("*", axes.select("months").scalar().alias("months"))
                 .select("*", F.explode("months").alias("snapshot_date")))
        units = F.coalesce(F.col("sold")[F.col("snapshot_date")], F.lit(0).cast("bigint"))
        return (cells.select("snapshot_date", "warehouse", "sku", "p_partkey", "unit_price",
                             F.month("snapshot_date").alias("mi"), "wi", units.alias("monthly_demand"))
                .withColumn("avg_daily", F.col("monthly_demand").cast("double") / F.dayofmonth(F.last_day("snapshot_date"))))

    @cached_property
    def inventory(self) -> DataFrame:
        g = self.demand_grid
        k, mi, wi = F.col("p_partkey"), F.col("mi"), F.col("wi")
        raw = (F.floor(F.col("avg_daily") * (F.lit(5) + (k * 7 + mi * 3 + wi) % 21))
               + (k * 11 + mi * 5 + wi) % 17 - 8)
        on_hand = F.when(raw < 0, F.lit(0)).otherwise(raw).cast("int")
        return (g.select("snapshot_date", "warehouse", "sku", "unit_price",
                         F.col("avg_daily").cast("decimal(18,4)").alias("average_daily_demand"),
                         on_hand.alias("on_hand_units"))
                .select("snapshot_date", "warehouse", "sku", "average_daily_demand", "on_hand_units",
                        (F.col("on_hand_units") * F.col("unit_price") * F.lit(0.55).cast("decimal(4,2)"))
                        .cast("decimal(18,2)").alias("inventory_value")))

    @cached_property
    def forecasts(self) -> DataFrame:
        g = self.demand_grid
        k, mi, wi = F.col("p_partkey"), F.col("mi"), F.col("wi")
        fc = F.floor(F.col("monthly_demand").cast("double") * (F.lit(70) + (k * 13 + mi * 7 + wi) % 61)
                     / F.lit(100.0))
        return g.select(F.col("snapshot_date").alias("month"), "warehouse", "sku",
                        fc.cast("int").alias("forecast_units"),
                        F.col("monthly_demand").cast("int").alias("actual_units"))

    @cached_property
    def warehouse_activity(self) -> DataFrame:
        """Units shipped and labor hours of every month and warehouse, the
        months in which a warehouse ships nothing included (L4)."""
        shipped = (self.order_lines.groupBy(F.trunc("order_date", "month").alias("snapshot_date"), "warehouse")
                   .agg(F.sum("units_shipped").cast("bigint").alias("units")))
        units = F.coalesce("units", F.lit(0).cast("bigint"))
        return (self._cells(self._axes).join(shipped, ["snapshot_date", "warehouse"], "left")
                .select(F.col("snapshot_date").alias("activity_date"), "warehouse", units.alias("units_processed"),
                        F.greatest(F.lit(80.0), units.cast("double") / 26).cast("decimal(18,2)").alias("labor_hours")))

    # --- fixtures for tolerant staging, merges and events ----------------------
    @cached_property
    def order_lines_dirty(self) -> DataFrame:
        """String-typed bronze copy with unparsable values (for try_cast staging)."""
        b = self.order_lines_bronze
        return b.select(
            F.concat(F.lit(" "), "order_line_id", F.lit(" ")).alias("order_line_id"),
            "order_id", "customer_id", "warehouse", "sku",
            F.when(F.col("l_partkey") % 50 == 0, F.lit("N/A"))
            .otherwise(F.col("order_date").cast("string")).alias("order_date"),
            F.when(F.col("l_suppkey") % 43 == 0, F.lit(""))
            .otherwise(F.col("promised_date").cast("string")).alias("promised_date"),
            F.when(F.col("l_partkey") % 41 == 0, F.lit("bad"))
            .otherwise(F.col("units_ordered").cast("string")).alias("units_ordered"),
            F.when(F.col("l_partkey") % 47 == 0, F.lit("2.5"))
            .otherwise(F.col("units_shipped").cast("string")).alias("units_shipped"),
            F.when(F.col("l_suppkey") % 37 == 0, F.lit(""))
            .otherwise(F.col("revenue").cast("string")).alias("revenue"),
            "ingestion_timestamp", "l_partkey", "l_suppkey", "l_extendedprice")

    @cached_property
    def merge_target(self) -> DataFrame:
        return self._latest_lines(self._deliveries.filter(
            F.col("l_shipdate") < F.lit(MERGE_TARGET_BEFORE).cast("timestamp_ntz")))

    @cached_property
    def merge_source(self) -> DataFrame:
        return self._latest_lines(self._deliveries.filter(
            F.col("l_shipdate") >= F.lit(MERGE_SOURCE_FROM).cast("timestamp_ntz")))

    def extracts(self) -> "LazyExtracts":
        """The eight raw extracts under the reference's names (built on access)."""
        return LazyExtracts({
            "customers": lambda: self.customers,
            "suppliers": lambda: self.suppliers,
            "products": lambda: self.products.drop("p_partkey"),
            "erp_order_lines": lambda: self.order_lines.select(*ORDER_LINE_COLUMNS),
            "tms_shipments": lambda: self.shipments,
            "wms_inventory_snapshots": lambda: self.inventory,
            "demand_forecasts": lambda: self.forecasts,
            "warehouse_activity": lambda: self.warehouse_activity,
        })


class LazyExtracts(Mapping):
    """name -> DataFrame, each built (and possibly materialised) on first access."""

    def __init__(self, factories):
        self._factories = dict(factories)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._factories[name]()
        return self._built[name]

    def __setitem__(self, name: str, df: DataFrame) -> None:
        self._factories[name] = lambda: df
        self._built.pop(name, None)

    def __iter__(self):
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)


ORDER_LINE_COLUMNS = ("order_line_id", "order_id", "customer_id", "warehouse", "order_date",
                      "promised_date", "sku", "supplier_id", "units_ordered", "units_shipped",
                      "unit_price", "unit_weight_kg", "revenue")

