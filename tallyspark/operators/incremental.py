"""The audit kept up to date: only groups whose facts or filings changed are audited again.

A group (ticker, metric) has a mark: how many facts and filings it rests on, and the sum of their hashes. A mark doesn't depend
on the rows' order, and the marks of added and removed rows are added to it and taken off, so a change is found without reading
what is unchanged. The audited cells are stored by buckets of the group, beside the marks that they were made of.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators import stored
from tallyspark.operators.audit import AUDITED, METRICS, _cells, audited
from tallyspark.plans.shared import fresh_folder, sent
from tallyspark.plans.views import facts, filings

GROUP = ["ticker", "metric"]
CELL = ["ticker", "fy", "metric", "period_type"]
MARK = ["n", "total"]


def marks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, total) of rows: their number, and the sum of their hashes. Rows that repeat count."""
    hashed = F.xxhash64(*sorted(rows.columns)).cast("decimal(38,0)")
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(hashed).cast("decimal(38,0)").alias("total"))


def merged(before: DataFrame, added: DataFrame, removed: DataFrame, keys: list[str]) -> DataFrame:
    """The marks after rows with the marks `added` came and such with the marks `removed` went; groups without rows are gone."""
    all_ = before.unionByName(added).unionByName(removed.select(*keys, *[(-F.col(c)).cast(removed.schema[c].dataType).alias(c) for c in MARK]))
    return all_.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total")).filter("n <> 0")


def group_marks(stored_facts: DataFrame, docs: DataFrame, metrics: list[str]) -> DataFrame:
    """The marks of all groups: their facts, and the filings of their company."""
    by_company = marks(docs, ["ticker"]).withColumn("metric", F.explode(F.array(*map(F.lit, metrics))))
    return merged(marks(stored_facts, GROUP), by_company.select(*GROUP, *MARK), by_company.select(*GROUP, *MARK).limit(0), GROUP)


def changed(before: DataFrame, now: DataFrame) -> DataFrame:
    """(ticker, metric, n, total) of groups that are new, differ, or are gone (then n is null)."""
    old = before.select(*GROUP, *[F.col(c).alias(f"__{c}") for c in MARK])
    both = old.join(now, GROUP, "full_outer")
    return both.filter(~(F.col("n").eqNullSafe(F.col("__n")) & F.col("total").eqNullSafe(F.col("__total")))).select(*GROUP, *MARK)


def refresh(store: stored.Store, now: DataFrame, stored_facts: DataFrame, cells: DataFrame, docs: DataFrame, batch: int) -> DataFrame:
    """Audits the groups whose marks differ from the store's, puts their cells there, and returns these groups.

    Facts, expected cells and filings of other groups are dropped by semi-joins before the audit; a facts table that is stored
    by buckets of the group is read in part only. Other buckets of the store aren't rewritten."""
    path = fresh_folder(store.spark, "changed-groups")
    changed(store.read("marks"), now).write.parquet(path)
    todo = store.spark.read.schema(now.select(*GROUP, *MARK).schema).parquet(path)

    def plan(old: dict[str, DataFrame], new: DataFrame) -> dict[str, DataFrame]:
        keys = new.select(*GROUP)
        asked = keys.groupBy("ticker").agg(F.collect_set("metric").alias("__asked"))
        own = audited(stored_facts.join(keys, GROUP, "left_semi"), cells.join(asked, "ticker").withColumn("metrics", F.array_intersect("metrics", "__asked")).drop("__asked"), docs.join(keys.select("ticker").distinct(), "ticker", "left_semi"))
        gone = sent(keys, by_hash=True)
        keep = {n: t.join(gone, GROUP, "left_anti") for n, t in old.items()}
        return {"marks": keep["marks"].unionByName(new.filter("n is not null")), "cells": keep["cells"].unionByName(own.select(*keep["cells"].columns))}

    stored.merge(store, todo, batch, plan)
    return todo


def new_store(spark, path: str, stored_facts: DataFrame, cells: DataFrame, docs: DataFrame, buckets: int = 64) -> stored.Store:
    """A store of the whole audit. Cells are many times the facts in number, and aren't shuffled when they are made."""
    rows = audited(stored_facts, cells, docs).select(*CELL, "gap", "failed", "class", "fix", "value_usd", "doc_id")
    now = group_marks(stored_facts, docs, METRICS)
    return stored.create(spark, path, GROUP, {"cells": rows, "marks": now.select(*GROUP, *MARK)}, buckets, ("cells",))


def audit_incremental(spark, sf_dir):
    """An audit without the facts of some filings, brought up to date when these come: all cells."""
    f, cells, docs = facts(spark, sf_dir), _cells(spark, sf_dir), filings(spark, sf_dir)
    late = F.col("doc_id") % 97 == 5
    store = new_store(spark, fresh_folder(spark, "audit"), f.filter(~late), cells, docs, 32)
    now = merged(store.read("marks"), marks(f.filter(late), GROUP), marks(f.filter(late).limit(0), GROUP), GROUP)
    refresh(store, now, f, cells, docs, 0)
    return store.read("cells").select(*CELL, "gap", F.array_join("failed", ";").alias("failed"), "class", "fix", "doc_id")


QUERIES = {"audit_incremental": audit_incremental}
ORACLES = {"audit_incremental": f"{AUDITED} SELECT ticker, fy, metric, period_type, gap, failed, class, fix, doc_id FROM audited"}
