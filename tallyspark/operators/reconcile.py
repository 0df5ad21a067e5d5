"""Reconciliation of periods: de-cumulation and derivation of missing periods by identities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions import periods as P
from tallyspark.operators.winners import RECONCILE, WORKBOOK, reconcile, workbook
from tallyspark.plans.views import SQL, facts

PERIODS = ["Q1", "Q2", "Q3", "Q4", "H1", "9M", "FY"]
#: Fixed values: (target, added, subtracted), in the order in which they are tried; later rules see what earlier ones gave.
IDENTITIES = [
    ("Q2", ["H1"], ["Q1"]),
    ("Q3", ["9M"], ["H1"]),
    ("Q4", ["FY"], ["9M"]),
    ("9M", ["Q1", "Q2", "Q3"], []),
    ("H1", ["Q1", "Q2"], []),
    ("9M", ["H1", "Q3"], []),
    ("Q4", ["FY"], ["Q1", "Q2", "Q3"]),
    ("Q1", ["FY"], ["Q2", "Q3", "Q4"]),
    ("Q2", ["FY"], ["Q1", "Q3", "Q4"]),
    ("Q3", ["FY"], ["Q1", "Q2", "Q4"]),
]
#: Two passes reach the fixed point: no third pass derives anything.
PASSES = 2
TOLERANCE = 0.005


def v(period: str) -> str:
    """The column with a period's value; names differ from the key fy also where case is ignored."""
    return f"v_{period.lower()}"


def relative_difference(a: Column, b: Column) -> Column:
    return F.abs(a - b) / F.greatest(F.abs(a), F.abs(b), F.lit(1.0))


def pivot_periods(cells: DataFrame, keys: list[str], value: str = "v", kind: str = "period_type") -> DataFrame:
    """One row per key with a nullable column for each period type."""
    return cells.groupBy(*keys).agg(*[F.max(F.when(F.col(kind) == p, F.col(value))).alias(v(p)) for p in PERIODS])


def derive(wide: DataFrame) -> DataFrame:
    """wide with missing periods derived, a formula for each derived one (by_<period>) and the number of conflicts.

    A flat chain of columns, which compiles. A conflict, where a year differs from its quarters, is counted once for each
    pass that is run: one, and another one after each pass that derived something (the third derives nothing).
    """
    out = wide.withColumns({f"by_{p}": F.lit(None).cast("string") for p in PERIODS} | {"conflicts": F.lit(0), "__derived": F.lit(0)})
    runs = F.lit(True)
    for _ in range(PASSES):
        for target, plus, minus in IDENTITIES:
            value = reduce(lambda a, b: a - b, [F.col(v(p)) for p in minus], reduce(lambda a, b: a + b, [F.col(v(p)) for p in plus]))
            found = F.col(v(target)).isNull() & (value > 0)
            formula = "+".join(plus) + "".join(f"-{p}" for p in minus)
            out = out.withColumns({v(target): F.when(found, value).otherwise(F.col(v(target))), f"by_{target}": F.when(found, formula).otherwise(F.col(f"by_{target}"))})
        known = sum((F.col(f"by_{p}").isNotNull().cast("int") for p in PERIODS), F.lit(0))
        out = out.withColumns({"conflicts": F.col("conflicts") + F.when(runs, _differs()).otherwise(0), "__last": F.col("__derived"), "__derived": known})
        runs = F.col("__derived") > F.col("__last")
    out = out.withColumn("conflicts", F.col("conflicts") + F.when(runs, _differs()).otherwise(0))
    return out.drop("__derived", "__last")


def _differs() -> Column:
    total = F.col("v_q1") + F.col("v_q2") + F.col("v_q3") + F.col("v_q4")
    return F.coalesce((relative_difference(F.col("v_fy"), total) > TOLERANCE).cast("int"), F.lit(0))


def decumulate(rows: DataFrame, keys: list[str], order: str, token: str = "token", value: str = "v") -> DataFrame:
    """Standalone values of cumulative ones: Q1 as it is, Q2, Q3 and the year less what came before within the key."""
    w = Window.partitionBy(*keys).orderBy(order, token).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.coalesce(F.last(F.when(F.col(token).isin("Q1", "Q2", "Q3"), F.col(value)), ignorenulls=True).over(w), F.lit(0.0))
    return rows.withColumn("standalone", F.when(F.col(token).isin("Q2", "Q3", "AR"), F.col(value) - prev).otherwise(F.col(value)))


def decumulate_workbook(rows: DataFrame, keys: list[str], order: str = "period", value: str = "v") -> DataFrame:
    """Years whose only token is AR are left out; a 6-K is standalone already and leaves what came before untouched."""
    year = Window.partitionBy(*keys)
    rows = rows.withColumn("__some", F.max(F.when(F.col("token") != "AR", 1).otherwise(0)).over(year)).filter("__some = 1").drop("__some")
    w = year.orderBy(order, "token", "form", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    cumulative = F.col("token").isin("Q1", "Q2", "Q3") & (F.col("form") != "6-K")
    prev = F.coalesce(F.last(F.when(cumulative, F.col(value)), ignorenulls=True).over(w), F.lit(0.0))
    takes = (F.col("token").isin("Q2", "Q3") & (F.col("form") != "6-K")) | (F.col("token") == "AR")
    return rows.withColumn("standalone", F.when(takes, F.col(value) - prev).otherwise(F.col(value)))


def anchors(cells: DataFrame, docs: DataFrame) -> DataFrame:
    """The document to which derived rows are attached: the year's annual report, else the first component's document."""
    annual = docs.filter("token = 'AR'").groupBy("ticker", "fy").agg(F.max_by("doc_id", F.struct("period", "doc_id")).alias("annual"))
    first = cells.groupBy("ticker", "fy", "metric").agg(F.min_by("doc_id", F.struct("period", "doc_id")).alias("component"))
    return first.join(annual, ["ticker", "fy"], "left").select("ticker", "fy", "metric", F.coalesce("annual", "component").alias("doc_id"))


KEYS = ["ticker", "fy", "metric"]


def _wide(spark, sf_dir):
    return pivot_periods(reconcile(facts(spark, sf_dir)), KEYS)


def reconcile_derive(spark, sf_dir):
    """Periods after derivation, with the formulas of derived ones."""
    out = derive(_wide(spark, sf_dir))
    return out.select(*KEYS, *[F.round(v(p), 4).alias(v(p)) for p in PERIODS], F.concat_ws(";", *[F.concat(F.lit(f"{p}="), F.col(f"by_{p}")) for p in PERIODS]).alias("formulas"))


def reconcile_conflicts(spark, sf_dir):
    """Per metric: groups, derived periods, conflicts and groups still without a fourth quarter."""
    out = derive(_wide(spark, sf_dir))
    derived = sum((F.col(f"by_{p}").isNotNull().cast("int") for p in PERIODS), F.lit(0))
    return out.groupBy("metric").agg(F.count("*").alias("groups"), F.sum(derived).alias("derived"), F.sum("conflicts").alias("conflicts"), F.count_if(F.col("v_q4").isNull()).alias("without_q4"))


def decumulate_ytd(spark, sf_dir):
    rows = workbook(facts(spark, sf_dir)).withColumn("v", F.abs(F.coalesce("value_usd", "value"))).filter("token is not null and form in ('10-Q', '10-K')")
    return decumulate(rows, KEYS, "period").select(*KEYS, "period", "token", "doc_id", F.round("standalone", 4).alias("standalone"))


def decumulate_skip_standalone(spark, sf_dir):
    rows = workbook(facts(spark, sf_dir)).withColumn("v", F.col("value_usd")).filter("token is not null and form <> 'HK-IR'")
    return decumulate_workbook(rows, KEYS).select(*KEYS, "period", "token", "form", "doc_id", F.round("standalone", 4).alias("standalone"))


def reconcile_anchor(spark, sf_dir):
    rows = reconcile(facts(spark, sf_dir))
    return anchors(rows, rows)


def derived_rows(wide: DataFrame, cells: DataFrame, stored: DataFrame) -> DataFrame:
    """A row for each derived period that isn't stored: value, formula, months, the components' documents (none for those
    that are derived themselves) and the document that it is attached to."""
    docs = cells.groupBy(*KEYS).agg(F.map_from_entries(F.collect_list(F.struct("period_type", "doc_id"))).alias("docs"))
    each = F.array(*[F.struct(F.lit(p).alias("period_type"), F.col(v(p)).alias("value"), F.col(f"by_{p}").alias("formula")) for p in PERIODS])
    rows = derive(wide).select(*KEYS, F.explode(F.filter(each, lambda x: x["formula"].isNotNull())).alias("d")).select(*KEYS, "d.*")
    rows = rows.join(docs, KEYS).withColumn("components", F.transform(F.split("formula", "[+-]"), lambda p: F.col("docs")[p])).drop("docs")
    rows = rows.join(anchors(cells, cells), KEYS).withColumn("months", P.basis_months(F.col("period_type")))
    return rows.join(stored.select(*KEYS, "period_type").distinct(), [*KEYS, "period_type"], "left_anti")


def decumulate_rows(rows: DataFrame, flow: Column, keys: list[str], order: str = "period") -> DataFrame:
    """Stored rows as quarterly values: flows by their absolute values, quarters less what came before in the year, years as
    they are; stocks unchanged. A value in dollars that is 0 or null gives way to the native one."""
    value = F.coalesce(F.nullif(F.col("value_usd"), F.lit(0.0)), F.col("value"), F.lit(0.0))
    w = Window.partitionBy(*keys).orderBy(order, "token", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    quarter = F.col("token").isin("Q1", "Q2", "Q3")
    before = F.coalesce(F.last(F.when(quarter, F.abs(value)), ignorenulls=True).over(w), F.lit(0.0))
    alone = F.when(F.col("token").isin("Q2", "Q3"), F.abs(value) - before).otherwise(F.abs(value))
    return rows.withColumn("quarterly", F.when(flow, alone).otherwise(value))


def reconcile_write(spark, sf_dir):
    """Derived rows to be inserted; derived ones of the third metric are stored already."""
    cells = reconcile(facts(spark, sf_dir))
    wide = pivot_periods(cells, KEYS)
    stored = cells.unionByName(cells.filter("metric = 'm3'").withColumn("period_type", F.lit("Q4")))
    out = derived_rows(wide, cells, stored)
    return out.select(*KEYS, "period_type", F.round("value", 4).alias("value"), "formula", F.array_join("components", ",", "-").alias("components"), "doc_id", F.col("months").cast("long").alias("months"))


def decumulate_stored(spark, sf_dir):
    rows = workbook(facts(spark, sf_dir)).filter("token is not null")
    return decumulate_rows(rows, F.col("metric") != "m2", KEYS).select(*KEYS, "period", "token", "doc_id", F.round("quarterly", 4).alias("quarterly"))


def basis(spark, sf_dir):
    cells = reconcile(facts(spark, sf_dir))
    return cells.groupBy("period_type").agg(F.count("*").alias("cells"), F.max(P.basis_months(F.col("period_type"))).cast("long").alias("months"))


QUERIES = {
    "reconcile_derive": reconcile_derive,
    "reconcile_conflicts": reconcile_conflicts,
    "decumulate_ytd": decumulate_ytd,
    "decumulate_skip_standalone": decumulate_skip_standalone,
    "reconcile_anchor": reconcile_anchor,
    "reconcile_write": reconcile_write,
    "decumulate_stored": decumulate_stored,
    "basis_months": basis,
}


def _pass_sql(k: int) -> str:
    """One pass written out; a later column sees the ones before it."""
    return f"""p{k} AS (SELECT ticker, fy, metric, q1d AS v_q1, q2e AS v_q2, q3e AS v_q3, q4b AS v_q4, h1b AS v_h1, m9b AS v_9m, v_fy,
  CASE WHEN by_q1 IS NULL AND v_q1 IS NULL AND q1d IS NOT NULL THEN 'FY-Q2-Q3-Q4' ELSE by_q1 END AS by_q1,
  CASE WHEN by_q2 IS NULL AND v_q2 IS NULL THEN CASE WHEN q2a IS NOT NULL THEN 'H1-Q1' WHEN q2e IS NOT NULL THEN 'FY-Q1-Q3-Q4' END ELSE by_q2 END AS by_q2,
  CASE WHEN by_q3 IS NULL AND v_q3 IS NULL THEN CASE WHEN q3a IS NOT NULL THEN '9M-H1' WHEN q3e IS NOT NULL THEN 'FY-Q1-Q2-Q4' END ELSE by_q3 END AS by_q3,
  CASE WHEN by_q4 IS NULL AND v_q4 IS NULL THEN CASE WHEN q4a IS NOT NULL THEN 'FY-9M' WHEN q4b IS NOT NULL THEN 'FY-Q1-Q2-Q3' END ELSE by_q4 END AS by_q4,
  CASE WHEN by_h1 IS NULL AND v_h1 IS NULL AND h1b IS NOT NULL THEN 'Q1+Q2' ELSE by_h1 END AS by_h1,
  CASE WHEN by_9m IS NULL AND v_9m IS NULL THEN CASE WHEN m9a IS NOT NULL THEN 'Q1+Q2+Q3' WHEN m9b IS NOT NULL THEN 'H1+Q3' END ELSE by_9m END AS by_9m
FROM (SELECT *, coalesce(v_q2, CASE WHEN v_h1 - v_q1 > 0 THEN v_h1 - v_q1 END) AS q2a, coalesce(v_q3, CASE WHEN v_9m - v_h1 > 0 THEN v_9m - v_h1 END) AS q3a,
  coalesce(v_q4, CASE WHEN v_fy - v_9m > 0 THEN v_fy - v_9m END) AS q4a, coalesce(v_9m, CASE WHEN v_q1 + q2a + q3a > 0 THEN v_q1 + q2a + q3a END) AS m9a,
  coalesce(v_h1, CASE WHEN v_q1 + q2a > 0 THEN v_q1 + q2a END) AS h1b, coalesce(m9a, CASE WHEN h1b + q3a > 0 THEN h1b + q3a END) AS m9b,
  coalesce(q4a, CASE WHEN v_fy - v_q1 - q2a - q3a > 0 THEN v_fy - v_q1 - q2a - q3a END) AS q4b, coalesce(v_q1, CASE WHEN v_fy - q2a - q3a - q4b > 0 THEN v_fy - q2a - q3a - q4b END) AS q1d,
  coalesce(q2a, CASE WHEN v_fy - q1d - q3a - q4b > 0 THEN v_fy - q1d - q3a - q4b END) AS q2e, coalesce(q3a, CASE WHEN v_fy - q1d - q2e - q4b > 0 THEN v_fy - q1d - q2e - q4b END) AS q3e FROM p{k - 1}))"""


def _derive_sql() -> str:
    """The passes written out; conflicts of each pass that is run, by how many periods are known after it."""
    part = lambda p: f"max(v) FILTER (period_type = '{p}') AS {v(p)}"
    start = f"r AS ({RECONCILE}), p0 AS (SELECT ticker, fy, metric, {', '.join(map(part, PERIODS))}, {', '.join(f'NULL::VARCHAR AS by_{x}' for x in ('q1', 'q2', 'q3', 'q4', 'h1', '9m'))} FROM r GROUP BY ALL)"
    off = lambda k: f"coalesce((abs(p{k}.v_fy - (p{k}.v_q1 + p{k}.v_q2 + p{k}.v_q3 + p{k}.v_q4)) > 0.005 * greatest(p{k}.v_fy, p{k}.v_q1 + p{k}.v_q2 + p{k}.v_q3 + p{k}.v_q4, 1))::INT, 0)"
    known = lambda k: " + ".join(f"(p{k}.{v(p)} IS NOT NULL)::INT" for p in PERIODS)
    ran = f"SELECT p2.*, NULL::VARCHAR AS by_fy, {off(1)} + CASE WHEN {known(1)} > {known(0)} THEN {off(2)} ELSE 0 END + CASE WHEN {known(2)} > {known(1)} THEN {off(2)} ELSE 0 END AS conflicts FROM p2 JOIN p1 USING (ticker, fy, metric) JOIN p0 USING (ticker, fy, metric)"
    return f"{SQL}, {start}, {_pass_sql(1)}, {_pass_sql(2)}, wide AS ({ran})"


ORACLES = {
    "reconcile_derive": f"{_derive_sql()} SELECT ticker, fy, metric, " + ", ".join(f"round({v(p)}, 4) AS {v(p)}" for p in PERIODS) + ", concat_ws(';', " + ", ".join(f"'{p}=' || by_{p}" for p in PERIODS) + ") AS formulas FROM wide",
    "reconcile_conflicts": f"{_derive_sql()} SELECT metric, count(*) AS groups, sum({' + '.join(f'(by_{p} IS NOT NULL)::INT' for p in PERIODS)})::BIGINT AS derived, sum(conflicts)::BIGINT AS conflicts, count(*) FILTER (v_q4 IS NULL) AS without_q4 FROM wide GROUP BY metric",
    "decumulate_ytd": f"""{SQL}, w AS ({WORKBOOK}), x AS (SELECT *, abs(coalesce(value_usd, value)) AS v FROM w WHERE token IS NOT NULL AND form IN ('10-Q', '10-K'))
SELECT ticker, fy, metric, period, token, doc_id, round(CASE WHEN token IN ('Q2', 'Q3', 'AR') THEN v - coalesce(last_value(CASE WHEN token IN ('Q1', 'Q2', 'Q3') THEN v END IGNORE NULLS)
  OVER (PARTITION BY ticker, fy, metric ORDER BY period, token ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) ELSE v END, 4) AS standalone FROM x""",
    "decumulate_skip_standalone": f"""{SQL}, w AS ({WORKBOOK}), x AS (SELECT *, value_usd AS v, max(CASE WHEN token <> 'AR' THEN 1 ELSE 0 END) OVER (PARTITION BY ticker, fy, metric) AS has_other FROM w WHERE token IS NOT NULL AND form <> 'HK-IR')
SELECT ticker, fy, metric, period, token, form, doc_id, round(CASE WHEN (token IN ('Q2', 'Q3') AND form <> '6-K') OR token = 'AR' THEN v - coalesce(last_value(CASE WHEN token IN ('Q1', 'Q2', 'Q3') AND form <> '6-K' THEN v END IGNORE NULLS)
  OVER (PARTITION BY ticker, fy, metric ORDER BY period, token, form, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) ELSE v END, 4) AS standalone FROM x WHERE has_other = 1""",
    "reconcile_anchor": f"""{SQL}, r AS ({RECONCILE}), a AS (SELECT ticker, fy, arg_max(doc_id, (period, doc_id)) AS annual FROM r WHERE token = 'AR' GROUP BY ALL)
SELECT ticker, fy, metric, coalesce(max(annual), arg_min(r.doc_id, (r.period, r.doc_id))) AS doc_id FROM r LEFT JOIN a USING (ticker, fy) GROUP BY ticker, fy, metric""",
    "reconcile_write": f"""{_derive_sql()}, l AS (SELECT ticker, fy, metric, unnest(['Q1', 'Q2', 'Q3', 'Q4', 'H1', '9M']) AS period_type, unnest([v_q1, v_q2, v_q3, v_q4, v_h1, v_9m]) AS value, unnest([by_q1, by_q2, by_q3, by_q4, by_h1, by_9m]) AS formula FROM wide),
d AS (SELECT * FROM l WHERE formula IS NOT NULL AND NOT (metric = 'm3' AND period_type = 'Q4')), p AS (SELECT *, unnest(regexp_split_to_array(formula, '[+-]')) AS part, generate_subscripts(regexp_split_to_array(formula, '[+-]'), 1) AS i FROM d),
c AS (SELECT p.ticker, p.fy, p.metric, p.period_type, p.value, p.formula, string_agg(coalesce(r.doc_id::VARCHAR, '-'), ',' ORDER BY i) AS components FROM p LEFT JOIN r ON r.ticker = p.ticker AND r.fy = p.fy AND r.metric = p.metric AND r.period_type = part GROUP BY ALL),
a AS (SELECT ticker, fy, arg_max(doc_id, (period, doc_id)) AS annual FROM r WHERE token = 'AR' GROUP BY ALL), h AS (SELECT r.ticker, r.fy, r.metric, coalesce(max(annual), arg_min(r.doc_id, (r.period, r.doc_id))) AS doc_id FROM r LEFT JOIN a USING (ticker, fy) GROUP BY r.ticker, r.fy, r.metric)
SELECT ticker, fy, metric, period_type, round(value, 4) AS value, formula, components, doc_id, CASE period_type WHEN 'H1' THEN 6 WHEN '9M' THEN 9 ELSE 3 END::BIGINT AS months FROM c JOIN h USING (ticker, fy, metric)""",
    "decumulate_stored": f"""{SQL}, w AS ({WORKBOOK}), x AS (SELECT *, CASE WHEN value_usd IS NULL OR value_usd = 0 THEN coalesce(value, 0) ELSE value_usd END AS raw FROM w WHERE token IS NOT NULL)
SELECT ticker, fy, metric, period, token, doc_id, round(CASE WHEN metric = 'm2' THEN raw WHEN token IN ('Q2', 'Q3') THEN abs(raw) - coalesce(last_value(CASE WHEN token IN ('Q1', 'Q2', 'Q3') THEN abs(raw) END IGNORE NULLS) OVER (PARTITION BY ticker, fy, metric ORDER BY period, token, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) ELSE abs(raw) END, 4) AS quarterly FROM x""",
    "basis_months": f"{SQL}, r AS ({RECONCILE}) SELECT period_type, count(*) AS cells, CASE period_type WHEN 'FY' THEN 12 WHEN '9M' THEN 9 WHEN 'H1' THEN 6 WHEN 'H2' THEN 6 ELSE 3 END::BIGINT AS months FROM r GROUP BY period_type",
}
