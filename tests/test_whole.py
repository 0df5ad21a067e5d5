"""Queries take every row, whatever its place."""

import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyspark.operators.joins import in_window
from tests.helpers import SF, assert_same, duck


@pytest.mark.parametrize("name, table, key", [("segment_values", "orders", "o_orderkey"), ("period_mode", "documents", "doc_id"), ("answer_json", "events", "event_id")])
def test_every_row(spark, name, table, key):
    want = duck(f"SELECT {key} FROM {table}")[key].to_pylist()
    assert sorted(r[key] for r in entry.queries()[name](spark, SF).select(key).collect()) == sorted(want)


def test_alias_in_a_late_row(spark, tmp_path):
    rows = [(i, f"part {i}", "economy tin" if i == 3 else "small tin", "Brand#11") for i in range(1, 400)] + [(400, "Red Widget", "economy", "Brand#17")]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_type string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    got = dict(entry.queries()["alias_resolve"](spark, str(tmp_path)).collect())
    assert got == {"Red Widget": 400, "brand#17": 400, "economy": 400, "ring": None, "nothing": None}


def test_candidates_beyond_the_third(spark, tmp_path):
    """All filings are of one company."""
    for name in ("orders", "customer", "nation"):
        t = spark.read.parquet(f"{SF}/{name}.parquet")
        (t.withColumn("o_custkey", F.lit(1).cast(t.schema["o_custkey"].dataType)) if name == "orders" else t).coalesce(1).write.parquet(f"{tmp_path}/{name}")
        next((tmp_path / name).glob("part-*.parquet")).rename(tmp_path / f"{name}.parquet")
    out = entry.queries()["release_candidates"](spark, str(tmp_path))
    assert max(r["rank"] for r in out.select("rank").collect()) > 3
    for name in ("release_candidates", "nearest_within_days", "window_match"):
        assert_same(entry.queries()[name](spark, str(tmp_path)), entry.oracle_sql()[name], str(tmp_path))


@pytest.mark.parametrize("lo, hi", [(7, 120), (-10, 10), (-60, 60)])
def test_in_window(spark, lo, hi):
    """One key has most rows; each pair in the window comes once, and the join is by month, too."""
    day = lambda i: datetime.date(1996, 1, 1) + datetime.timedelta(days=i * 37 % 400)
    a, b = ([(i, 1 if i % 5 else i, day(i + shift)) for i in range(120)] for shift in (0, 11))
    left, right = spark.createDataFrame(a, "l long, k long, at date"), spark.createDataFrame(b, "r long, k long, on date")
    out = in_window(left, right, "k", "at", "on", lo, hi)
    assert "__month" in out._jdf.queryExecution().optimizedPlan().toString()
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and lo <= (y[2] - x[2]).days <= hi)
    assert sorted(tuple(r) for r in out.select("l", "r").collect()) == want
