"""Growth series, totals, carry-forward placeholders, period comparisons and outliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.numbers import exact_sum, rounded
from tallyspark.operators.winners import NOTIFICATION, QUARTERLY, WORKBOOK, chart_quarterly, notification, workbook
from tallyspark.plans.views import SQL, facts


def change_pct(now: Column, before: Column) -> Column:
    """Null where a value is missing or zero."""
    return F.when((now != 0) & (before != 0), (now / before - 1) * 100)


def label_index(label: Column) -> Column:
    """Quarters since year 0 of a label like 2020Q3."""
    return F.substring(label, 1, 4).cast("long") * 4 + F.substring(label, 6, 1).cast("long")


def growth(series: DataFrame, keys: list[str], mode: str, value: str = "v") -> DataFrame:
    """series (keys, label, value) with pct. yoy: against the same quarter of the year before, whatever lies between;
    qoq: against the entry before it in the series."""
    if mode == "qoq":
        before = F.lag(value).over(Window.partitionBy(*keys).orderBy("label"))
        return series.withColumn("pct", change_pct(F.col(value), before))
    if mode != "yoy":
        raise ValueError("mode is yoy or qoq")
    # One row per quarter, so the frame four quarters back holds at most one: no self-join.
    back = Window.partitionBy(*keys).orderBy(label_index(F.col("label"))).rangeBetween(-4, -4)
    return series.withColumn("pct", change_pct(F.col(value), F.max(value).over(back)))


def fill_placeholders(series: DataFrame, keys: list[str], within: list[str], value: str = "v", most: int = 2, excluded: Column | None = None) -> DataFrame:
    """Later quarters of the chart, filled with a key's last value where it lags by at most `most` quarters.

    The chart of each `within` group ends with its latest quarter. Rows get `filled_from`, the quarter that a filled
    value comes from; measured rows have null there. Excluded keys aren't filled.
    """
    last = series.withColumn("i", label_index(F.col("label"))).groupBy(*keys).agg(F.max("i").alias("i"), F.max_by(value, "i").alias(value), F.max("label").alias("filled_from"))
    end = last.groupBy(*within).agg(F.max("i").alias("end"))
    shown = last if excluded is None else last.filter(~excluded)
    late = shown.join(end, within).filter((F.col("end") > F.col("i")) & (F.col("end") - F.col("i") <= most))
    late = late.withColumn("q", F.explode(F.sequence(F.col("i") + 1, F.col("end"))))
    late = late.withColumn("label", F.concat(F.floor((F.col("q") - 1) / 4), F.lit("Q"), F.pmod(F.col("q") - 1, F.lit(4)) + 1))
    columns = [*keys, "label", value, "filled_from"]
    return series.withColumn("filled_from", F.lit(None).cast("string")).select(*columns).unionByName(late.select(*columns))


def compare_periods(cells: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Each cell's change against the quarter before (the first quarter's is the last fourth one) and the year before."""
    quarter = F.when(F.col("period_type").rlike("^Q[1-4]$"), F.substring("period_type", 2, 1).cast("int"))
    base = cells.select(*keys, "fy", "period_type", value)
    before = base.withColumn("fy", F.when(quarter == 4, F.col("fy") + 1).otherwise(F.col("fy"))).withColumn("period_type", F.when(quarter.isNotNull(), F.concat(F.lit("Q"), quarter % 4 + 1))).withColumnRenamed(value, "__q")
    year = base.withColumn("fy", F.col("fy") + 1).withColumnRenamed(value, "__y")
    pct = lambda b: F.when(F.col(b) != 0, (F.col(value) - F.col(b)) / F.abs(b) * 100)
    out = cells.join(before, [*keys, "fy", "period_type"], "left").join(year, [*keys, "fy", "period_type"], "left")
    return out.withColumn("vs_quarter", pct("__q")).withColumn("vs_year", pct("__y")).drop("__q", "__y")


def outliers(series: DataFrame, keys: list[str], order: str = "period", value: str = "value_usd", low: float = -0.5, high: float = 2.0) -> DataFrame:
    """series with the change against the latest strictly earlier period, and whether it lies within bounds."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(order))
    out = series.withColumn("change", F.when(before != 0, (F.col(value) - before) / F.abs(before)))
    return out.withColumn("passed", F.col("change").isNull() | F.col("change").between(low, high))


def _series(spark, sf_dir):
    return chart_quarterly(facts(spark, sf_dir)).groupBy("ticker", "metric", "label").agg(F.max("v").alias("v"))


def _growth(mode):
    return lambda spark, sf_dir: growth(_series(spark, sf_dir), ["ticker", "metric"], mode).select("ticker", "metric", "label", F.round("pct", 4).alias("pct"))


def period_totals(spark, sf_dir):
    return _series(spark, sf_dir).groupBy("metric", "label").agg(rounded(exact_sum(F.col("v")), 3).alias("total"), F.count("*").alias("n"))


def placeholder_fill(spark, sf_dir):
    """Companies with a number divisible by 20 are excluded from filling."""
    return fill_placeholders(_series(spark, sf_dir), ["ticker", "metric"], ["metric"], excluded=F.col("ticker") % 20 == 0)


def suppressed_growth(spark, sf_dir):
    """Totals with placeholders; growth is suppressed in quarters that hold a filled value."""
    out = fill_placeholders(_series(spark, sf_dir), ["ticker", "metric"], ["metric"], excluded=F.col("ticker") % 20 == 0)
    t = out.groupBy("metric", "label").agg(exact_sum(F.col("v")).alias("exact"), F.count("filled_from").alias("filled")).withColumn("v", F.col("exact").cast("double"))
    return growth(t, ["metric"], "yoy").select("metric", "label", "filled", rounded(F.col("exact"), 3).alias("total"), F.when(F.col("filled") == 0, F.round("pct", 4)).alias("pct"))


def notify_triple(spark, sf_dir):
    cells = notification(facts(spark, sf_dir))
    return compare_periods(cells, ["ticker", "metric"]).select("ticker", "metric", "fy", "period_type", "value", F.round("vs_quarter", 4).alias("vs_quarter"), F.round("vs_year", 4).alias("vs_year"))


def yoy_outlier(spark, sf_dir):
    return outliers(workbook(facts(spark, sf_dir)), ["ticker", "metric"]).select("ticker", "metric", "period", F.round("change", 6).alias("change"), "passed")


QUERIES = {
    "growth_yoy": _growth("yoy"),
    "growth_qoq": _growth("qoq"),
    "period_totals": period_totals,
    "placeholder_fill": placeholder_fill,
    "suppressed_growth": suppressed_growth,
    "notify_triple": notify_triple,
    "yoy_outlier": yoy_outlier,
}

SERIES = f"{SQL}, s AS (SELECT ticker, metric, label, max(v) AS v FROM ({QUARTERLY}) GROUP BY ALL)"
FILLED = f"""{SERIES}, l AS (SELECT ticker, metric, max(substr(label, 1, 4)::BIGINT * 4 + substr(label, 6, 1)::BIGINT) AS i, arg_max(v, label) AS v, max(label) AS filled_from FROM s GROUP BY ALL),
e AS (SELECT *, max(i) OVER (PARTITION BY metric) AS last FROM l), z AS (SELECT *, unnest(range(i + 1, last + 1)) AS q FROM e WHERE last > i AND last - i <= 2 AND ticker % 20 > 0),
f AS (SELECT ticker, metric, label, v, NULL::VARCHAR AS filled_from FROM s UNION ALL SELECT ticker, metric, ((q - 1) // 4) || 'Q' || ((q - 1) % 4 + 1), v, filled_from FROM z)"""
ORACLES = {
    "growth_yoy": f"{SERIES} SELECT s.ticker, s.metric, s.label, round(CASE WHEN s.v <> 0 AND p.v <> 0 THEN (s.v / p.v - 1) * 100 END, 4) AS pct FROM s LEFT JOIN s p ON p.ticker = s.ticker AND p.metric = s.metric AND p.label = (substr(s.label, 1, 4)::INT - 1) || substr(s.label, 5, 2)",
    "growth_qoq": f"{SERIES} SELECT ticker, metric, label, round(CASE WHEN v <> 0 AND lag(v) OVER w <> 0 THEN (v / lag(v) OVER w - 1) * 100 END, 4) AS pct FROM s WINDOW w AS (PARTITION BY ticker, metric ORDER BY label)",
    "period_totals": f"{SERIES} SELECT metric, label, round(sum(v::DECIMAL(24,6)), 3)::DOUBLE AS total, count(*) AS n FROM s GROUP BY ALL",
    "placeholder_fill": f"{FILLED} SELECT * FROM f",
    "suppressed_growth": f"""{FILLED}, t AS (SELECT metric, label, sum(v::DECIMAL(24,6)) AS exact, exact::DOUBLE AS v, count(filled_from) AS filled FROM f GROUP BY ALL)
SELECT t.metric, t.label, t.filled, round(t.exact, 3)::DOUBLE AS total, CASE WHEN t.filled = 0 THEN round((t.v / p.v - 1) * 100, 4) END AS pct FROM t LEFT JOIN t p ON p.metric = t.metric AND p.label = (substr(t.label, 1, 4)::INT - 1) || substr(t.label, 5, 2)""",
    "notify_triple": f"""{SQL}, n AS ({NOTIFICATION}), k AS (SELECT ticker, metric, fy, period_type, value, CASE WHEN period_type LIKE 'Q_' THEN substr(period_type, 2, 1)::INT END AS q FROM n)
SELECT c.ticker, c.metric, c.fy, c.period_type, c.value, round((c.value - b.value) / abs(b.value) * 100, 4) AS vs_quarter, round((c.value - y.value) / abs(y.value) * 100, 4) AS vs_year FROM k c
LEFT JOIN k b ON b.ticker = c.ticker AND b.metric = c.metric AND b.q = CASE c.q WHEN 1 THEN 4 ELSE c.q - 1 END AND b.fy = CASE c.q WHEN 1 THEN c.fy - 1 ELSE c.fy END
LEFT JOIN k y ON y.ticker = c.ticker AND y.metric = c.metric AND y.period_type = c.period_type AND y.fy = c.fy - 1""",
    "yoy_outlier": f"""{SQL}, w AS ({WORKBOOK}), c AS (SELECT ticker, metric, period, (value_usd - lag(value_usd) OVER o) / abs(lag(value_usd) OVER o) AS change FROM w WINDOW o AS (PARTITION BY ticker, metric ORDER BY period))
SELECT ticker, metric, period, round(change, 6) AS change, change IS NULL OR change BETWEEN -0.5 AND 2.0 AS passed FROM c""",
}
