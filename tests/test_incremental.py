"""The incremental audit: marks that can be merged, and only changed groups audited again."""

import random

from pyspark.sql import functions as F

from tallyspark.operators import incremental as I
from tallyspark.operators import stored
from tallyspark.operators.audit import _audited, _cells
from tallyspark.plans.views import facts, filings
from tests.helpers import SF


def bag(df):
    return sorted(map(str, df.collect()))


def test_marks_can_be_merged(spark):
    """Any order; added rows, removed rows, rows that repeat; groups without rows are gone."""
    rng = random.Random(2)
    rows = [(rng.randrange(4), "m", rng.choice(["a", None, "c"]), rng.random()) for _ in range(60)] + [(9, "m", "x", 1.0)] * 3
    frame = lambda x: spark.createDataFrame(x, "ticker long, metric string, s string, v double")
    went, stay, came = rows[:20] + rows[-3:], rows[20:-3], [(5, "m", "new", 0.5), (1, "m", None, None)]
    before = I.marks(frame(rows), I.GROUP)
    now = I.merged(before, I.marks(frame(came), I.GROUP), I.marks(frame(went), I.GROUP), I.GROUP)
    want = I.marks(frame(stay + came).repartition(3), I.GROUP)
    assert bag(now.select(*want.columns)) == bag(want)
    assert bag(I.changed(want, now)) == [] and all(r.ticker != 9 for r in now.collect())
    assert {(r.ticker, r.n) for r in I.changed(before, now).collect() if r.n is None or r.ticker == 5} == {(9, None), (5, 1)}


def test_one_filing_changes(spark, tmp_path):
    """The result equals a whole run; other groups' buckets stay as they are."""
    f, cells, docs = facts(spark, SF), _cells(spark, SF), filings(spark, SF)
    doc = f.filter("metric = 'm3'").agg(F.min("doc_id")).first()[0]
    late = (F.col("doc_id") == doc) & (F.col("metric") == "m3")
    store = I.new_store(spark, f"{tmp_path}/audit", f.filter(~late), cells, docs, 64)
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "audit" / "cells").rglob("*.parquet")}
    before = files()
    now = I.merged(store.read("marks"), I.marks(f.filter(late), I.GROUP), I.marks(f.limit(0), I.GROUP), I.GROUP)
    todo = I.refresh(store, now, f, cells, docs, 0).collect()
    assert len(todo) == 1 and todo[0].metric == "m3"
    names = ["ticker", "fy", "metric", "period_type", "gap", "class", "fix", "doc_id"]
    assert bag(store.read("cells").select(names)) == bag(_audited(spark, SF).select(names))
    assert len({p.parent for p, _ in set(before.items()) ^ set(files().items())}) == 1
    again = I.group_marks(f, docs, I.METRICS)
    assert I.changed(store.read("marks"), again).count() == 0
    assert not stored.merge(store, store.read("marks").limit(1), 0, lambda old, new: old)


def test_a_filing_changes_its_company(spark, tmp_path):
    f, cells, docs = facts(spark, SF), _cells(spark, SF), filings(spark, SF)
    doc, ticker = docs.select("doc_id", "ticker").orderBy("doc_id").first()
    store = I.new_store(spark, f"{tmp_path}/audit", f, cells, docs.filter(F.col("doc_id") != doc), 16)
    todo = I.refresh(store, I.group_marks(f, docs, I.METRICS), f, cells, docs, 0)
    assert {(r.ticker, r.metric) for r in todo.collect()} == {(ticker, m) for m in I.METRICS}
    names = ["ticker", "fy", "metric", "period_type", "gap", "class"]
    assert bag(store.read("cells").select(names)) == bag(_audited(spark, SF).select(names))


def test_unmoved_tables_are_written_where_they_are(spark, tmp_path):
    """Each task writes a file a bucket, so nothing is shuffled; merging gives the same rows."""
    rows = spark.range(0, 4000, 1, 4).select("id", (F.col("id") % 7).alias("v"))
    before = spark.conf.get(stored.WRITERS)
    store = stored.create(spark, f"{tmp_path}/s", ["id"], {"cells": rows, "marks": rows}, 8, ("cells",))
    files = lambda name: [len(list(p.glob("*.parquet"))) for p in (tmp_path / "s" / name).iterdir() if p.is_dir()]
    assert files("cells") == [4] * 8 and max(files("marks")) < 4
    new = spark.range(3990, 4010).select("id", F.lit(9).cast("long").alias("v"))
    stored.merge(store, new, 0, lambda old, new: {n: t.join(new.select("id"), "id", "left_anti").unionByName(new) for n, t in old.items()})
    want = bag(rows.filter("id < 3990").unionByName(new))
    assert bag(store.read("cells")) == want and bag(store.read("marks")) == want
    assert spark.conf.get(stored.WRITERS) == before
