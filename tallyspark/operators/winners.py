"""Winner selection: one authoritative fact per cell, by named precedence rules. They differ on purpose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions import periods as P
from tallyspark.functions.numbers import exact_sum, rounded
from tallyspark.plans.views import SQL, TIES, facts, filings

FLOW_METRICS = ["m1", "m2", "m3", "m4", "m5"]
KIND_RANK = {"direct": 0, "inferred": 1}


#: Companies of the test tables with a first year of their own.
FLOORS = {1: 1998, 4: 1997, 7: 1999}


def pick(df: DataFrame, cell: list[str], order: list[Column], ties: list[str] = TIES) -> DataFrame:
    """The first row of each cell; the tie columns make the order total."""
    w = Window.partitionBy(*cell).orderBy(*order, *[F.col(t) for t in ties])
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def usd(value_usd="value_usd", value="value") -> Column:
    return F.coalesce(F.col(value_usd), F.col(value))


def above_floor(df: DataFrame, first_year: int | None, floors: dict | None) -> DataFrame:
    """Years from the first one on, and from its own one on for a company that has one."""
    if first_year is not None:
        df = df.filter(F.col("fy") >= first_year)
    if floors:
        own = F.coalesce(*[F.when(F.col("ticker") == t, F.lit(y)) for t, y in floors.items()])
        df = df.filter(F.coalesce(F.col("fy") >= own, F.lit(True)))
    return df


def chart_annual(df: DataFrame, first_year: int | None = None, floors: dict | None = None) -> DataFrame:
    """Annual reports only; null, zero and negative values never win; the newest filing, then extraction, wins."""
    rows = df.withColumn("v", usd()).filter((F.col("token") == "AR") & (F.col("period_type") == "FY") & (F.col("v") > 0))
    rows = above_floor(rows, first_year, floors)
    return pick(rows, ["ticker", "fy", "metric"], [F.desc("filing_date"), F.desc("extracted_at"), F.desc("doc_id")])


def chart_quarterly(df: DataFrame, first_label: str = "") -> DataFrame:
    """Zero and null last, direct before inferred before others, newest filing, newest extraction; then absolute values."""
    rank = F.when(F.col("kind") == "direct", 0).when(F.col("kind") == "inferred", 1).otherwise(2)
    rows = df.filter(F.col("period_type").isin(*P.QUARTER_TYPES) & F.col("value_usd").isNotNull())
    order = [F.when(F.coalesce("value_usd", F.lit(0.0)) == 0, 1).otherwise(0), rank, F.desc("filing_date"), F.desc("extracted_at"), F.desc("doc_id")]
    rows = pick(rows, ["ticker", "fy", "metric", "period_type"], order).withColumn("v", F.abs("value_usd")).filter("v > 0")
    quarter = F.substring("period_type", 2, 1).cast("int")
    label = F.when(F.month("period") == F.col("fye"), P.calendar_from_fiscal(F.col("fy"), quarter, F.col("fye"))).otherwise(P.calendar_label(F.col("period")))
    return rows.withColumn("label", label).filter(F.col("label") >= first_label)


def workbook(df: DataFrame) -> DataFrame:
    """The largest value wins, not the newest filing."""
    return pick(df, ["ticker", "period", "metric"], [F.desc_nulls_last("value_usd"), F.desc("extracted_at"), F.desc("doc_id")])


def audit(df: DataFrame) -> DataFrame:
    """Stored facts beat derived ones; then the newest filing, then the highest document."""
    derived = F.when(F.col("model").startswith("reconcile-derived"), 1).otherwise(0)
    return pick(df.filter("period_type <> ''"), ["ticker", "metric", "fy", "period_type"], [derived, F.desc("filing_date"), F.desc("doc_id")])


def reconcile(df: DataFrame, flow: list[str] = FLOW_METRICS) -> DataFrame:
    """Flow metrics; a zero never replaces a value; the latest (period, filing) wins."""
    rows = df.filter(F.col("metric").isin(*flow) & (F.col("period_type") != "")).withColumn("v", F.abs(usd()))
    order = [F.when(F.coalesce("v", F.lit(0.0)) == 0, 1).otherwise(0), F.desc("period"), F.desc("filing_date"), F.desc("doc_id")]
    return pick(rows, ["ticker", "fy", "metric", "period_type"], order)


def lookup(df: DataFrame) -> DataFrame:
    """The latest annual period of a company, and there the latest extraction of each metric."""
    annual = df.filter(F.col("form").isin(*P.ANNUAL_FORMS))
    latest = annual.groupBy("ticker").agg(F.max("period").alias("period"))
    return pick(annual.join(latest, ["ticker", "period"]), ["ticker", "metric"], [F.desc("extracted_at"), F.desc("doc_id")])


def notification(df: DataFrame) -> DataFrame:
    """Native values, newest filing, highest id."""
    return pick(df.filter("value is not null and period_type <> ''"), ["ticker", "metric", "period_type", "fy"], [F.desc("filing_date"), F.desc("doc_id")])


def earliest_filing(docs: DataFrame) -> DataFrame:
    return docs.groupBy("ticker", "period").agg(F.min_by("doc_id", F.struct("filing_date", "doc_id")).alias("doc_id"), F.min("filing_date").alias("filing_date"))


STRATEGIES = {"chart_annual": chart_annual, "chart_quarterly": chart_quarterly, "workbook": workbook, "audit": audit, "reconcile": reconcile, "lookup": lookup, "notification": notification}


def select_winner(df: DataFrame, strategy: str) -> DataFrame:
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy}; known: {', '.join(STRATEGIES)}")
    return STRATEGIES[strategy](df)


def annual_totals(winners: DataFrame) -> DataFrame:
    out = winners.groupBy("metric", "fy").agg(exact_sum(F.col("v")).alias("exact"), F.count_distinct("ticker").alias("n"))
    return out.withColumn("total", F.col("exact").cast("double"))


def _q(f, *columns):
    return lambda spark, sf_dir: f(facts(spark, sf_dir)).select(*columns)


def annual_winner_growth(spark, sf_dir):
    """Totals of the annual winners over visible companies, with growth on the year before."""
    t = annual_totals(chart_annual(facts(spark, sf_dir)))
    prev = t.select("metric", (F.col("fy") + 1).alias("fy"), F.col("total").alias("prev"))
    out = t.join(prev, ["metric", "fy"], "left")
    growth = F.when(F.col("prev") > 0, (F.col("total") / F.col("prev") - 1) * 100)
    return out.select("metric", "fy", "n", rounded(F.col("exact"), 3).alias("total"), F.round(growth, 4).alias("yoy_pct"))


QUERIES = {
    "annual_winner_growth": annual_winner_growth,
    "annual_winner": _q(chart_annual, "ticker", "fy", "metric", "doc_id", "v"),
    "annual_winner_floors": _q(lambda f: chart_annual(f, 1996, FLOORS), "ticker", "fy", "metric", "doc_id", "v"),
    "quarterly_winner": _q(chart_quarterly, "ticker", "fy", "metric", "period_type", "label", "doc_id", "v"),
    "workbook_winner": _q(workbook, "ticker", "period", "metric", "doc_id", "value_usd"),
    "audit_winner": _q(audit, "ticker", "fy", "metric", "period_type", "model", "doc_id", "value_usd"),
    "reconcile_winner": _q(reconcile, "ticker", "fy", "metric", "period_type", "doc_id", "v"),
    "lookup_latest": _q(lookup, "ticker", "metric", "period", "doc_id", "value"),
    "notification_winner": _q(notification, "ticker", "metric", "period_type", "fy", "doc_id", "value"),
    "earliest_filing": lambda spark, sf_dir: earliest_filing(filings(spark, sf_dir)),
}


def _first(columns: str, source: str, cell: str, order: str) -> str:
    return f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {cell} ORDER BY {order}, {', '.join(TIES)}) AS n FROM ({source})) WHERE n = 1"


ANNUAL = _first("*", "SELECT *, coalesce(value_usd, value) AS v FROM facts WHERE token = 'AR' AND period_type = 'FY' AND coalesce(value_usd, value) > 0", "ticker, fy, metric", "filing_date DESC, extracted_at DESC, doc_id DESC")
QUARTERLY = f"""SELECT *, abs(value_usd) AS v, CASE WHEN month(period) = fye THEN ((fy * 12 + fye - 1 - (4 - substr(period_type, 2, 1)::INT) * 3) // 12) || 'Q' || ((fy * 12 + fye - 1 - (4 - substr(period_type, 2, 1)::INT) * 3) % 12 // 3 + 1)
  ELSE year(period) || 'Q' || quarter(period) END AS label FROM ({_first("*", "SELECT * FROM facts WHERE period_type IN ('Q1', 'Q2', 'Q3', 'Q4') AND value_usd IS NOT NULL", "ticker, fy, metric, period_type", "CASE WHEN value_usd = 0 THEN 1 ELSE 0 END, CASE kind WHEN 'direct' THEN 0 WHEN 'inferred' THEN 1 ELSE 2 END, filing_date DESC, extracted_at DESC, doc_id DESC")}) WHERE abs(value_usd) > 0"""
AUDIT = _first("*", "SELECT * FROM facts WHERE period_type <> ''", "ticker, fy, metric, period_type", "CASE WHEN starts_with(model, 'reconcile-derived') THEN 1 ELSE 0 END, filing_date DESC, doc_id DESC")
RECONCILE = _first("*", "SELECT *, abs(coalesce(value_usd, value)) AS v FROM facts WHERE metric IN ('m1', 'm2', 'm3', 'm4', 'm5') AND period_type <> ''", "ticker, fy, metric, period_type", "CASE WHEN v IS NULL OR v = 0 THEN 1 ELSE 0 END, period DESC, filing_date DESC, doc_id DESC")
NOTIFICATION = _first("*", "SELECT * FROM facts WHERE value IS NOT NULL AND period_type <> ''", "ticker, metric, period_type, fy", "filing_date DESC, doc_id DESC")
WORKBOOK = _first("*", "SELECT * FROM facts", "ticker, period, metric", "value_usd DESC NULLS LAST, extracted_at DESC, doc_id DESC")

ORACLES = {
    "annual_winner_growth": f"""{SQL}, w AS ({ANNUAL}), t AS (SELECT metric, fy, sum(v::DECIMAL(24,6)) AS exact, exact::DOUBLE AS total, count(DISTINCT ticker) AS n FROM w GROUP BY 1, 2)
SELECT t.metric, t.fy, t.n, round(t.exact, 3)::DOUBLE AS total, round((t.total / p.total - 1) * 100, 4) AS yoy_pct FROM t LEFT JOIN t p ON p.metric = t.metric AND p.fy = t.fy - 1""",
    "annual_winner": f"{SQL} SELECT ticker, fy, metric, doc_id, v FROM ({ANNUAL})",
    "annual_winner_floors": f"{SQL} SELECT ticker, fy, metric, doc_id, v FROM ({ANNUAL}) WHERE fy >= CASE ticker WHEN 1 THEN 1998 WHEN 4 THEN 1997 WHEN 7 THEN 1999 ELSE 1996 END",
    "quarterly_winner": f"{SQL} SELECT ticker, fy, metric, period_type, label, doc_id, v FROM ({QUARTERLY})",
    "workbook_winner": f"{SQL} SELECT ticker, period, metric, doc_id, value_usd FROM ({WORKBOOK})",
    "audit_winner": f"{SQL} SELECT ticker, fy, metric, period_type, model, doc_id, value_usd FROM ({AUDIT})",
    "reconcile_winner": f"{SQL} SELECT ticker, fy, metric, period_type, doc_id, v FROM ({RECONCILE})",
    "lookup_latest": f"{SQL}, a AS (SELECT * FROM facts WHERE form IN ('10-K', '20-F')) " + _first("ticker, metric, period, doc_id, value", "SELECT * FROM a WHERE (ticker, period) IN (SELECT (ticker, max(period)) FROM a GROUP BY ticker)", "ticker, metric", "extracted_at DESC, doc_id DESC"),
    "notification_winner": f"{SQL} SELECT ticker, metric, period_type, fy, doc_id, value FROM ({NOTIFICATION})",
    "earliest_filing": f"{SQL} SELECT ticker, period, arg_min(doc_id, (filing_date, doc_id)) AS doc_id, min(filing_date) AS filing_date FROM filings GROUP BY ticker, period",
}
