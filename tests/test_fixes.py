"""Cells with a fix are made alone, and are those of the whole audit."""

from collections import Counter

from pyspark.sql import functions as F

from tallyspark.operators import audit as A
from tallyspark.plans.views import facts, filings
from tests.helpers import SF

CELL = ["ticker", "fy", "metric", "period_type"]


def bag(df):
    return Counter(map(str, df.collect()))


def test_fixes_are_those_of_the_audit(spark):
    """Also for winners without a document, companies without filings, years or kinds, and companies that come twice."""
    f, docs, firms = facts(spark, SF), filings(spark, SF), A._cells(spark, SF)
    f = f.filter("ticker % 9 < 4").withColumn("doc_id", F.when(F.col("doc_id") % 5 > 0, F.col("doc_id")))
    docs = docs.filter("ticker % 9 < 5 and ticker % 9 <> 1")
    none = F.array().cast("array<string>")
    firms = firms.filter("ticker % 9 < 6").withColumn("kinds", F.when(F.col("ticker") % 18 == 3, none).otherwise(F.col("kinds"))).withColumn("metrics", F.when(F.col("ticker") % 18 == 4, none).otherwise(F.col("metrics")))
    firms = firms.unionByName(firms.filter("ticker % 18 = 2"))
    columns = [*CELL, "doc_id", "value_usd", "failed", "fix"]
    got = bag(A.fixes(f, firms, docs).select(columns))
    assert got == bag(A.audited(f, firms, docs).filter("fix is not null").select(columns))
    assert any("doc_id=None" in k and "refetch" in k for k in got) and any("extract" in k for k in got)


def test_a_cell_carries_its_own_year_only(spark):
    """All winners of a company went with each of its cells, so that its work grew with their product."""
    f, docs, firms = facts(spark, SF), filings(spark, SF), A._cells(spark, SF)
    years = A._company_years(firms, A.checked(f), docs, ["doc_id"])
    most = f.filter("period_type <> ''").select(*CELL).distinct().groupBy("ticker", "fy").count().agg(F.max("count")).first()[0]
    assert years.agg(F.max(F.size("__won"))).first()[0] == most


def test_batches_are_counted_where_the_cells_are(spark):
    """No cell is repeated to count companies, and cells are summed by company before they are shuffled."""
    plan = A.fix_batches(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "partial_count(distinct" not in plan
    last = plan[: plan.index("Exchange hashpartitioning(fix")]
    assert "partial_sum(n" in plan and "partial_count(1" not in last
