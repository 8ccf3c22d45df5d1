"""Candidates without digits and short ones, and the forest on held-out findings."""

import pytest
from pyspark.sql import functions as F

from lading.llm import secret_scan


def values(spark, text):
    return [r["value"] for r in secret_scan.candidates(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()]


@pytest.mark.parametrize("text, want", [
    ('token: "abcdefghijklmnopqrstuvwx"', ["abcdefghijklmnopqrstuvwx"]),
    ('my password = "hunter2xyz" is', ["hunter2xyz"]),
    ("db_password=Tr0ub4dor&user=x", ["Tr0ub4dor"]),
    ("token=secretvalue next words here", ["secretvalue"]),
    ("the token of the password is nothing", []),
    ("pwd: ab1", []),
    ('api_key="0123456789abcdef01"', ["0123456789abcdef01"]),
])
def test_values_given_to_a_name_are_candidates(spark, text, want):
    assert values(spark, text) == want


def test_long_assignments_end(spark):
    assert len(values(spark, "token=" * 50_000 + " x=" + "password=" * 20_000)) >= 1


def test_forest_on_held_out_findings(spark):
    made = secret_scan.labelled_findings(spark, 800, seed=77).cache()       # values that no training row holds
    got = secret_scan.scan(made).groupBy("doc_id").agg(F.max("is_secret").alias("said"))
    rows = made.join(got, "doc_id", "left").select("is_secret", F.coalesce("said", F.lit(False)).alias("said")).collect()
    hit = sum(r["is_secret"] and r["said"] for r in rows)
    recall, precision = hit / sum(r["is_secret"] for r in rows), hit / sum(r["said"] for r in rows)
    print(f"recall {recall:.3f} precision {precision:.3f}")
    assert recall >= 0.9 and precision >= 0.9
