"""Property tests: the decomposed operators equal their plain forms on random
inputs (hot keys, NULL values, tiny and uneven blocks)."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

ROW = st.tuples(
    st.integers(min_value=0, max_value=2999),                 # order number (unique after dedup below)
    st.sampled_from(["A", "B", "HOT", "HOT", "HOT"]),          # customer, one hot
    st.integers(min_value=0, max_value=9),                    # day offset
    st.one_of(st.none(), st.integers(min_value=0, max_value=10_000)),  # revenue cents or NULL
    st.integers(min_value=0, max_value=1),                    # flag
)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _frame(spark, rows):
    seen, out = set(), []
    for n, cust, day, cents, flag in rows:
        if n in seen:
            continue
        seen.add(n)
        out.append((f"O{n:09d}", cust, dt.date(2025, 1, 1) + dt.timedelta(days=day),
                    None if cents is None else Decimal(cents) / 100, flag))
    return spark.createDataFrame(out, "order_id string, customer_id string, order_date date, "
                                      "revenue decimal(18,2), otif_flag int")


@SETTINGS
@given(rows=st.lists(ROW, min_size=1, max_size=120), ranges=st.integers(min_value=1, max_value=10))
def test_running_rank_and_sum_property(spark, rows, ranges):
    from lading.operators.running import running_rank_and_sum
    df = _frame(spark, rows)
    got = running_rank_and_sum(df, ["customer_id"], ["order_date", "order_id"], "revenue", "rn", "cum", ranges=ranges)
    w = Window.partitionBy("customer_id").orderBy("order_date", "order_id")
    want = df.select("order_id", F.row_number().over(w).alias("rn"),
                     F.sum("revenue").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"))
    assert sorted(got.select("order_id", "rn", "cum").collect()) == sorted(want.collect())


@SETTINGS
@given(rows=st.lists(ROW, min_size=1, max_size=120), block=st.integers(min_value=4, max_value=40),
       frame=st.integers(min_value=0, max_value=3))
def test_global_rolling_property(spark, rows, block, frame):
    from lading.operators.running import global_positions, rolling_by_position
    df = _frame(spark, rows)
    pos = global_positions(df, ["order_date", "order_id"], ranges=5)
    got = rolling_by_position(pos, "_pos", "otif_flag", frame, "r", block_rows=block)
    w = Window.orderBy("order_date", "order_id")
    want = df.select("order_id", F.row_number().over(w).alias("_pos"),
                     F.avg("otif_flag").over(w.rowsBetween(-frame, 0)).alias("r"))
    assert sorted(got.select("order_id", "_pos", "r").collect()) == sorted(want.collect())


@SETTINGS
@given(rows=st.lists(ROW, min_size=1, max_size=120))
def test_nest_unnest_property(spark, rows):
    from lading.plans.nested import nested_orders, unnest_items
    df = _frame(spark, rows)
    lines = df.select(F.col("order_id").alias("order_line_id"), F.col("customer_id").alias("order_id"),
                      F.lit("C").alias("customer_id"), "order_date", F.lit("S").alias("sku"),
                      F.col("otif_flag").alias("units_ordered"), "revenue")
    flat = unnest_items(nested_orders(lines))
    want = lines.select("order_id", "customer_id", "order_date", "sku", F.col("units_ordered").alias("quantity"),
                        F.col("revenue").alias("extended_price"))
    assert sorted(map(str, flat.collect())) == sorted(map(str, want.collect()))


VAL = st.one_of(st.none(), st.integers(min_value=0, max_value=3))


@SETTINGS
@given(target=st.dictionaries(st.integers(0, 30), st.tuples(VAL, VAL, VAL), max_size=25),
       source=st.dictionaries(st.integers(0, 30), st.tuples(VAL, VAL, VAL), max_size=25),
       conditional=st.booleans())
def test_merge_property(spark, target, source, conditional):
    """merge_into equals the MERGE rules applied row by row in Python: matched
    rows update (a, b) when any differs (NULL is no difference) or always;
    unmatched source rows insert; target-only rows stay."""
    from lading.operators.merge import merge_into
    schema = "k int, a int, b int, c int"
    t = spark.createDataFrame([(k, *v) for k, v in target.items()], schema)
    s = spark.createDataFrame([(k, *v) for k, v in source.items()], schema)
    got = {r["k"]: (r["a"], r["b"], r["c"], r["merge_action"])
           for r in merge_into(t, s, "k", ["k", "a", "b", "c"], ["a", "b"], conditional).collect()}
    want = {}
    for k in set(target) | set(source):
        if k not in source:
            want[k] = (*target[k], "unchanged")
        elif k not in target:
            want[k] = (*source[k], "inserted")
        else:
            (ta, tb, tc), (sa, sb, _) = target[k], source[k]
            changed = any(x is not None and y is not None and x != y for x, y in ((ta, sa), (tb, sb)))
            if changed or not conditional:
                want[k] = (sa, sb, tc, "updated")
            else:
                want[k] = (ta, tb, tc, "unchanged")
    assert got == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 6), st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 50)),
                     min_size=1, max_size=60, unique_by=lambda r: (r[0], r[2])))
def test_keep_latest_property(spark, rows):
    """keep_latest = per key, the row first by (ts desc NULLs last, tie desc)."""
    from lading.operators.dedup import keep_latest
    df = spark.createDataFrame(rows, "k int, ts int, tie int")
    got = {r["k"]: (r["ts"], r["tie"]) for r in keep_latest(df, ["k"], ["ts", "tie"]).collect()}
    want = {}
    for k, ts, tie in rows:
        rank = (ts is not None, ts if ts is not None else 0, tie)
        if k not in want or rank > want[k][0]:
            want[k] = (rank, (ts, tie))
    assert got == {k: v for k, (_, v) in want.items()}
