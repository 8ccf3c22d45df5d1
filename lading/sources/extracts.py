"""The eight CSV extracts: declared schemas, registry, read and write.

Schemas are declared (no inference pass over 100 TB of CSV); inference over
the whole file (``samplingRatio=1.0``) is available only as a fallback.  A
missing extract fails before any job runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

S, I, L, D, B, DBL = T.StringType(), T.IntegerType(), T.LongType(), T.DateType(), T.BooleanType(), T.DoubleType()
M2, M3, M4 = T.DecimalType(18, 2), T.DecimalType(18, 3), T.DecimalType(18, 4)


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# name -> (file name, schema)
EXTRACTS: dict[str, tuple[str, T.StructType]] = {
    "customers": ("customers.csv", _schema(("customer_id", S), ("customer_segment", S), ("region", S))),
    "suppliers": ("suppliers.csv", _schema(("supplier_id", S), ("supplier_name", S),
                                           ("base_lead_time_days", I), ("supplier_risk_tier", S))),
    "products": ("products.csv", _schema(("sku", S), ("product_category", S), ("supplier_id", S),
                                         ("unit_price", M2), ("unit_weight_kg", M3))),
    "erp_order_lines": ("erp_order_lines.csv", _schema(
        ("order_line_id", S), ("order_id", S), ("customer_id", S), ("warehouse", S), ("order_date", D),
        ("promised_date", D), ("sku", S), ("supplier_id", S), ("units_ordered", I), ("units_shipped", I),
        ("unit_price", M2), ("unit_weight_kg", M3), ("revenue", M2))),
    "tms_shipments": ("tms_shipments.csv", _schema(
        ("shipment_id", S), ("order_id", S), ("carrier", S), ("warehouse", S), ("order_date", D),
        ("ship_date", D), ("delivery_date", D), ("promised_date", D), ("on_time", B),
        ("shipment_weight_kg", M2), ("freight_cost", M2), ("handling_cost", M2), ("exception_cost", M2))),
    "wms_inventory_snapshots": ("wms_inventory_snapshots.csv", _schema(
        ("snapshot_date", D), ("warehouse", S), ("sku", S), ("average_daily_demand", M4),
        ("on_hand_units", I), ("inventory_value", M2))),
    "demand_forecasts": ("demand_forecasts.csv", _schema(
        ("month", D), ("warehouse", S), ("sku", S), ("forecast_units", I), ("actual_units", I))),
    "warehouse_activity": ("warehouse_activity.csv", _schema(
        ("activity_date", D), ("warehouse", S), ("units_processed", L), ("labor_hours", M2))),
}


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_extract(spark: SparkSession, data_dir: str, name: str, infer: bool = False) -> DataFrame:
    """A1: header CSV scan with the declared schema (or full-file inference)."""
    file_name, schema = EXTRACTS[name]
    path = f"{data_dir.rstrip('/')}/{file_name}"
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    if infer:
        return reader.option("inferSchema", True).option("samplingRatio", 1.0).csv(path)
    return reader.schema(schema).csv(path)


def read_extracts(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    """A2: every registered extract; a missing one raises FileNotFoundError."""
    return {name: read_extract(spark, data_dir, name) for name in EXTRACTS}


def write_extracts(extracts: dict[str, DataFrame], data_dir: str) -> None:
    """Write extracts as header CSV folders named like the source files."""
    for name, df in extracts.items():
        file_name, schema = EXTRACTS[name]
        (df.select(*[f.name for f in schema.fields]).write.mode("overwrite")
         .option("header", True).csv(f"{data_dir.rstrip('/')}/{file_name}"))
