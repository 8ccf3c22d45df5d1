"""Quality report, publication gate, reconciliation, build summary and QA listings.

All metrics of one relation come from one aggregate (partial per task, one row
to merge).  The relations' metric rows meet as scalar subqueries in one row,
which ``stack`` turns into one row per check, so every relation is computed
once per report.  Nothing but the (bounded) list of failing check names ever
reaches the driver.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from lading.plans.warehouse import Warehouse

PASS, FAIL = "PASS", "FAIL"


def _metrics(relations: dict[str, tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """One row with a struct of metrics per relation."""
    spark = next(iter(relations.values()))[0].sparkSession
    found = [df.agg(F.struct(*[m.alias(n) for n, m in metrics.items()]).alias("m")).scalar().alias(name)
             for name, (df, metrics) in relations.items()]
    return spark.range(1).select(*found)


def _stack(row: DataFrame, names: tuple[str, ...], rows: list[tuple]) -> DataFrame:
    """One output row per tuple of expressions over the one metric row."""
    made = F.array(*[F.struct(*[c.alias(n) for n, c in zip(names, values)]) for values in rows])
    return row.select(F.explode(made).alias("r")).select("r.*")


def _check(name: str, actual: Column, expected: Column, ok: Column) -> tuple:
    def shown(c: Column) -> Column:
        return F.round(c.cast("double"), 2)
    return F.lit(name), shown(actual), shown(expected), F.when(ok, F.lit(PASS)).otherwise(F.lit(FAIL))


def _count() -> Column:
    return F.count(F.lit(1))


def fill_rate_in_range() -> Column:
    return F.col("unit_fill_rate").between(0, 1)


def otif_consistent() -> Column:
    return (F.col("otif_flag") <= F.col("on_time_flag")) & (F.col("otif_flag") <= F.col("complete_order_flag"))


def quality_checks(raw_lines: DataFrame, lines: DataFrame, shipments: DataFrame, orders: DataFrame,
                   carriers: DataFrame, forecast: DataFrame) -> DataFrame:
    """K1-K9 as one row per check: name, actual, expected, PASS/FAIL.

    A NULL fill rate or accuracy fails its range check (it is not counted as
    in range), as in the reference.
    """
    n, d = _count(), F.count_distinct
    row = _metrics({
        "raw": (raw_lines, {"n": n, "rev": F.sum("revenue")}),
        "line": (lines, {"n": n, "d": d("order_line_id"), "rev": F.sum("revenue")}),
        "ship": (shipments, {"n": n, "d": d("order_id")}),
        "mart": (orders, {"n": n, "d": d("order_id"), "fill_ok": F.count_if(fill_rate_in_range()),
                          "otif_ok": F.count_if(otif_consistent())}),
        "carrier": (carriers, {"n": n}),
        "forecast": (forecast, {"n": n, "ok": F.count_if(F.col("forecast_accuracy").between(-1, 1))})})
    m = F.col
    return _stack(row, ("check_name", "actual_value", "expected_value", "status"), [
        _check("order_line_key_unique", m("line.n"), m("line.d"), m("line.n") == m("line.d")),
        _check("shipment_order_unique", m("ship.n"), m("ship.d"), m("ship.n") == m("ship.d")),
        _check("source_to_fact_order_line_count", m("raw.n"), m("line.n"), m("raw.n") == m("line.n")),
        _check("source_to_fact_revenue_reconciliation", m("raw.rev"), m("line.rev"),
               F.abs(m("raw.rev") - m("line.rev")) < F.lit(0.01)),
        _check("mart_order_grain_unique", m("mart.n"), m("mart.d"), m("mart.n") == m("mart.d")),
        _check("unit_fill_rate_range", m("mart.fill_ok"), m("mart.n"), m("mart.fill_ok") == m("mart.n")),
        _check("otif_not_above_components", m("mart.otif_ok"), m("mart.n"), m("mart.otif_ok") == m("mart.n")),
        _check("carrier_mart_non_empty", m("carrier.n"), F.lit(1), m("carrier.n") >= 1),
        _check("forecast_accuracy_reasonable", m("forecast.ok"), m("forecast.n"), m("forecast.ok") == m("forecast.n"))])


# columns whose sums a reconciliation shows beside the checksum
RECONCILED = ("order_line_id", "order_id", "sku", "units_ordered", "units_shipped", "revenue")


def bucket_checksums(df: DataFrame, key: str, columns: tuple[str, ...], buckets: int) -> DataFrame:
    """Rows, revenue and an order-insensitive checksum per bucket of the key:
    the sum of a 60-bit digest of every row, so it does not depend on the
    order of rows, and a repeated row counts twice.  NULL has a form that no
    value has."""
    def shown(c: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~"))

    def number(text: Column) -> Column:
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")

    return (df.select((number(shown(key)) % buckets).cast("int").alias("bucket"), "revenue",
                      number(F.concat_ws("|", *[shown(c) for c in columns])).alias("digest"))
            .groupBy("bucket").agg(_count().alias("n"), F.sum("revenue").cast("decimal(38,2)").alias("revenue"),
                                   F.sum(F.col("digest").cast("decimal(38,0)")).alias("checksum")))


def reconcile(source: DataFrame, target: DataFrame, key: str = "order_line_id", columns: tuple[str, ...] = RECONCILED,
              buckets: int = 1024) -> DataFrame:
    """K3/K4 by key: the buckets in which ``source`` and ``target`` differ, with
    both sides' rows and revenue.  Each side is one aggregate with map-side
    partials; what meets is one row per bucket, so a difference is narrowed to
    one bucket of keys before any rows are compared."""
    a, b = (bucket_checksums(df, key, columns, buckets) for df in (source, target))
    a, b = (df.select("bucket", *[F.col(c).alias(f"{side}_{c}") for c in ("n", "revenue", "checksum")])
            for side, df in (("source", a), ("target", b)))
    both = a.join(b, "bucket", "full_outer")
    return (both.where(~F.col("source_checksum").eqNullSafe(F.col("target_checksum"))
                       | ~F.col("source_n").eqNullSafe(F.col("target_n")))
            .select("bucket", *[F.coalesce(F.col(f"{side}_n"), F.lit(0)).alias(f"{side}_rows") for side in ("source", "target")],
                    "source_revenue", "target_revenue"))


def differing_rows(source: DataFrame, target: DataFrame, differing: DataFrame, key: str = "order_line_id",
                   columns: tuple[str, ...] = RECONCILED, buckets: int = 1024) -> DataFrame:
    """The rows that only one side has, looked for in the differing buckets alone."""
    def of_bucket(df: DataFrame) -> DataFrame:
        digest = F.md5(F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("~")))
        rows = df.select(*columns, (F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % buckets).cast("int").alias("bucket"))
        return rows.join(F.broadcast(differing.select("bucket")), "bucket").drop("bucket")     # at most ``buckets`` rows

    a, b = of_bucket(source), of_bucket(target)
    return (a.exceptAll(b).withColumn("side", F.lit("source")).unionByName(b.exceptAll(a).withColumn("side", F.lit("target"))))


def data_quality_report(wh: "Warehouse") -> DataFrame:
    return quality_checks(wh.raw["erp_order_lines"], wh.fct_order_line, wh.fct_shipment,
                          wh.order_facts, wh.mart_carrier_performance,
                          wh.mart_forecast_accuracy)


def failing_checks(report: DataFrame) -> DataFrame:
    """K10 (as data): the checks whose status is not PASS."""
    return report.filter(F.col("status") != PASS).select("check_name", "actual_value",
                                                         "expected_value", "status")


class QualityGateError(RuntimeError):
    pass


def enforce_gate(report: DataFrame) -> None:
    """Raise with the failing check names; the report is one row per
    check, so at most that many names are read back."""
    names = sorted(r["check_name"] for r in failing_checks(report).select("check_name").collect())
    if names:
        raise QualityGateError("Failed checks: " + ", ".join(names))


def build_summary(orders: DataFrame) -> DataFrame:
    """Orders, average fill %, OTIF %, revenue (one global aggregate)."""
    return orders.agg(
        _count().alias("orders"),
        F.round(F.avg("unit_fill_rate") * 100, 2).alias("fill_pct"),
        F.round(F.avg("otif_flag") * 100, 2).alias("otif_pct"),
        F.round(F.sum("recognized_revenue"), 2).cast("decimal(38,2)").alias("revenue"))


def export_checks(orders: DataFrame, carriers: DataFrame, report: DataFrame) -> DataFrame:
    """The six exported-output checks as one row each (name, passed, detail).

    ``between`` on a NULL fill rate is not true, so a NULL fails the range
    check, as a NaN does in the pandas original.
    """
    row = _metrics({
        "mart": (orders, {"n": _count(), "d": F.count_distinct("order_id"), "fill_ok": F.count_if(fill_rate_in_range()),
                          "otif_ok": F.count_if(otif_consistent())}),
        "carrier": (carriers, {"n": _count()}),
        "report": (report, {"n": _count(), "passed": F.count_if(F.col("status") == PASS)})})
    m = F.col

    def check(name: str, ok: Column, detail: Column) -> tuple:
        return F.lit(name), ok, detail.cast("string")

    return _stack(row, ("check_name", "passed", "detail"), [
        check("order_output_non_empty", m("mart.n") > 0, m("mart.n")),
        check("order_id_unique", m("mart.n") == m("mart.d"), m("mart.d")),
        check("service_metrics_in_range", m("mart.fill_ok") == m("mart.n"), F.lit("fill rate")),
        check("otif_logic", m("mart.otif_ok") == m("mart.n"), F.lit("OTIF components")),
        check("carrier_output_non_empty", m("carrier.n") > 0, m("carrier.n")),
        check("warehouse_quality_report", m("report.passed") == m("report.n"), m("report.passed"))])


def mart_violations(orders: DataFrame) -> DataFrame:
    """Order rows breaking the fill-range or OTIF rules (NULL fill is not listed)."""
    bad = (~F.col("unit_fill_rate").between(0, 1)
           | (F.col("otif_flag") > F.col("on_time_flag"))
           | (F.col("otif_flag") > F.col("complete_order_flag")))
    return orders.filter(bad)


def violation_counts(orders: DataFrame) -> DataFrame:
    """Violation counts by rule (``countif``)."""
    return orders.agg(
        F.count_if(~F.col("unit_fill_rate").between(0, 1)).alias("invalid_fill_rates"),
        F.count_if(F.col("otif_flag") > F.col("on_time_flag")).alias("invalid_otif_on_time"),
        F.count_if(F.col("otif_flag") > F.col("complete_order_flag")).alias("invalid_otif_complete"))
