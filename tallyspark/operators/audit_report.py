"""The audit's report: all parts of the Markdown page as ordered lines, and all cells, counts, fixes and restatements as JSON.

Lines are rows (section, company, metric, place, n, line); sorted by these they are the page. No part is gathered in one task:
what a line needs of the whole are the counts, one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.audit import AUDITED, CELL, _cells, audited, restatements
from tallyspark.plans.shared import fresh_folder
from tallyspark.plans.views import facts, filings

CLASSES = ["verified", "derived", "flagged", "gap_fixable", "gap_unfixable"]
#: The signs of the classes.
SIGNS = dict(zip(CLASSES, "✓*⚠⊘✗", strict=True))
ORDER = ["section", "company", "metric", "place", "n"]
MOST_DETAILS = 3


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _money(x: Column) -> Column:
    return F.coalesce(_text("$", F.format_number(x, 0), "M"), F.lit("—"))


def _tag(fy: Column, period: Column) -> Column:
    return F.when(period == "FY", _text("FY", fy)).otherwise(_text(fy, period))


def _lines(rows: DataFrame, section: int, line: Column, company="", metric="", place="", n: int | Column = 0) -> DataFrame:
    text = lambda x: F.lit(x) if isinstance(x, str) else x.cast("string")
    n = F.lit(n) if isinstance(n, int) else n
    return rows.select(F.lit(section).alias("section"), text(company).alias("company"), text(metric).alias("metric"), text(place).alias("place"), n.cast("int").alias("n"), line.alias("line"))


def details(failed: Column, violations: Column, range_: Column, factor: Column) -> Column:
    """What the first failed checks say, a line each; checks without more to say have none."""
    none = F.array().cast("array<string>")
    said = F.slice(failed, 1, MOST_DETAILS)
    own = lambda name, lines: F.when(F.array_contains(said, name), lines).otherwise(none)
    parts = [own("identity", F.transform(violations, lambda v: _text("  - identity `", v, "` is off"))), own("range", F.array(_text("  - out-of-range (", range_, ")"))), own("continuity", F.array(_text("  - continuity jump factor ", F.format_number(factor, 2), "x")))]
    return F.concat(*[F.coalesce(p, none) for p in parts])


def report_document(cells: DataFrame, fixes: DataFrame, changes: DataFrame, metrics: dict[str, str], run: str) -> DataFrame:
    """All lines of the report. cells: CELL, class, failed, violations, range, factor, value_usd; fixes: CELL, fix, old_usd,
    new_usd; changes: CELL, first, last, change, and the filing dates first_filed and last_filed. metrics: their names for display."""
    spark = cells.sparkSession
    ticker, metric, fy, kind = (F.col(c) for c in ("ticker", "metric", "fy", "period_type"))
    shown = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in metrics.items() for x in pair]), metric), metric)
    is_ = lambda c: F.col("class") == c
    counts = cells.agg(F.count("*").alias("n"), *[F.count_if(is_(c)).alias(c) for c in CLASSES]).first()
    n_fixes, n_changes = fixes.count(), changes.count()

    def fixed(section: int, *lines: str) -> DataFrame:
        rows = spark.createDataFrame(list(enumerate(lines)), "n int, line string")
        return _lines(rows, section, F.col("line"), n=F.col("n"))

    status = " · ".join(f"{SIGNS[c]} {counts[c]} {c.replace('_', ' ')}" for c in CLASSES)
    parts = [fixed(1, "# Data quality audit", f"**Run**: `{run}`", f"**Total cells in universe**: {counts['n']}", f"**Status**: {status}")]

    parts.append(fixed(2, "## Coverage matrix", "| Ticker | " + " | ".join(metrics.values()) + " |", "|---|" + "|".join("---" for _ in metrics) + "|"))
    good = lambda m: F.count_if((metric == m) & F.col("class").isin("verified", "derived"))
    own = lambda m: F.count_if(metric == m)
    share = lambda m: F.when(own(m) == 0, "—").otherwise(_text(F.format_number(100.0 * good(m) / own(m), 0), "% ", F.when(F.count_if((metric == m) & is_("flagged")) > 0, "⚠").otherwise("✓")))
    matrix = cells.groupBy("ticker").agg(_text("| ", F.concat_ws(" | ", F.first("ticker").cast("string"), *[share(m) for m in metrics]), " |").alias("line"))
    parts.append(_lines(matrix, 2, F.col("line"), ticker, n=9))

    flagged = cells.filter(is_("flagged"))
    parts.append(fixed(3, f"## Flagged items ({counts['flagged']})", *([] if counts["flagged"] else ["_No mechanical flags in this run._"])))
    parts.append(_lines(flagged.select("ticker", "metric").distinct(), 3, _text("### ", ticker.cast("string"), " — ", shown), ticker, metric))
    failed = F.array_join(F.transform("failed", lambda x: _text("`", x, "`")), ", ")
    bullet = _text("- **", _tag(fy, kind), "** ", _money(F.col("value_usd")), ": failed ", F.when(failed != "", failed).otherwise("(no mechanical fail)"))
    lines = flagged.select(*CELL, F.posexplode(F.concat(F.array(bullet), details(F.col("failed"), F.col("violations"), F.col("range"), F.col("factor")))).alias("n", "line"))
    parts.append(_lines(lines, 3, F.col("line"), ticker, metric, _text(fy, kind), F.col("n") + 1))

    parts.append(fixed(4, f"## Fixed in this run ({n_fixes})", *([] if n_fixes else ["_No fixes applied (dry-run or nothing flagged fixable)._"])))
    parts.append(_lines(fixes.select("ticker").distinct(), 4, _text("### ", ticker.cast("string")), ticker))
    both = _text(_money(F.col("old_usd")), " → ", _money(F.col("new_usd")), " (", F.col("fix"), ")")
    change = F.when(F.col("old_usd").isNotNull() & F.col("new_usd").isNotNull(), both).otherwise(F.col("fix"))
    parts.append(_lines(fixes, 4, _text("- **", fy, kind, "** ", shown, ": ", change), ticker, metric, _text(fy, kind), 1))

    head = ["| Cell | Original | Latest | Δ | Original filed | Latest filed |", "|---|---|---|---|---|---|"]
    parts.append(fixed(5, *([f"## Restatements ({n_changes})", *head] if n_changes else ["## Restatements", "_No restatements detected._"])))
    cell = _text(ticker.cast("string"), ":", metric, ":", fy, kind)
    row = F.concat_ws(" | ", cell, _money(F.col("first")), _money(F.col("last")), _text(F.format_number(F.col("change") * 100, 1), "%"), F.coalesce("first_filed", F.lit("")), F.coalesce("last_filed", F.lit("")))
    parts.append(_lines(changes, 5, _text("| ", row, " |"), ticker, metric, _text(fy, kind), 9))

    parts.append(fixed(6, f"## Known unfixable gaps ({counts['gap_unfixable']})", *([] if counts["gap_unfixable"] else ["_None._"])))
    names = F.array_join(F.transform(F.array_sort(F.collect_set(F.struct(metric.alias("m"), shown.alias("s")))), lambda x: x["s"]), ", ")
    gaps = cells.filter(is_("gap_unfixable")).groupBy("ticker").agg(_text("- **", F.first("ticker").cast("string"), "**: ", F.count("*"), " cells (metrics: ", names, "; years: ", F.min("fy"), "-", F.max("fy"), ")").alias("line"))
    parts.append(_lines(gaps, 6, F.col("line"), ticker, n=9))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_snapshot(path: str, cells: DataFrame, fixes: DataFrame, changes: DataFrame, run: str) -> None:
    """Everything for other programs, as JSON (gzip) in four folders: cells (all classes), counts, fixes, restatements."""
    key = _text(F.col("ticker").cast("string"), ":", F.col("metric"), ":", F.col("fy"), F.col("period_type"))
    tables = {"cells": cells.withColumn("cell_key", key), "counts": cells.groupBy("class").agg(F.count("*").alias("n")), "fixes": fixes, "restatements": changes}
    for name, rows in tables.items():
        rows.withColumn("run", F.lit(run)).write.option("ignoreNullFields", "false").option("compression", "gzip").json(f"{path}/{name}")


def read_snapshot(spark: SparkSession, path: str, name: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(f"{path}/{name}")


def report_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Audited cells with what their checks found, fixes (every third of those that are routed), and restatements."""
    f, found = facts(spark, sf_dir), ["violations", "range", "factor"]
    path = fresh_folder(spark, "report-cells")
    audited(f, _cells(spark, sf_dir), filings(spark, sf_dir), *found).select(*CELL, "class", "failed", "fix", "value_usd", "model", "doc_id", *found).write.parquet(path)
    cells = spark.read.parquet(path)
    fixes = cells.filter("fix is not null and (fy + length(period_type)) % 3 = 0").select(*CELL, "fix", F.col("value_usd").alias("old_usd"), F.when(F.col("ticker") % 2 == 0, F.col("value_usd") + 1).alias("new_usd"))
    at = fresh_folder(spark, "report-changes")
    restatements(f.filter("period_type <> ''"), first_filed=F.min("filing_date").cast("string"), last_filed=F.max("filing_date").cast("string")).write.parquet(at)
    return cells, fixes, spark.read.parquet(at)


DISPLAY = {"m1": "CapEx", "m2": "Revenue", "m3": "OCF", "m4": "D&A", "m5": "PP&E", "m6": "Cloud Seg"}


def report_page(spark, sf_dir):
    """All lines of the report over all cells."""
    cells, fixes, changes = report_tables(spark, sf_dir)
    return report_document(cells, fixes, changes, DISPLAY, "run-1").select(*ORDER, F.md5("line").alias("digest"))


def report_snapshot(spark, sf_dir):
    """The cells and counts of the snapshot, written and read again."""
    cells, fixes, changes = report_tables(spark, sf_dir)
    path = fresh_folder(spark, "snapshot")
    write_snapshot(path, cells, fixes, changes, "run-1")
    out = read_snapshot(spark, path, "cells", "cell_key string, class string, failed array<string>, value_usd double").select(F.lit("cell").alias("what"), F.col("cell_key").alias("key"), "class", F.array_join("failed", ";").alias("failed"))
    none = F.lit(None).cast("string")
    counts = read_snapshot(spark, path, "counts", "class string, n long").select(F.lit("count").alias("what"), F.col("n").cast("string").alias("key"), "class", none.alias("failed"))
    fixed = read_snapshot(spark, path, "fixes", "ticker long, fy long, metric string, period_type string, fix string, run string")
    changed = read_snapshot(spark, path, "restatements", "ticker long, fy long, metric string, period_type string, run string")
    key = F.concat("ticker", F.lit(":"), "metric", F.lit(":"), "fy", "period_type")
    return out.unionByName(counts).unionByName(fixed.select(F.lit("fix").alias("what"), key.alias("key"), F.col("fix").alias("class"), F.col("run").alias("failed"))).unionByName(changed.select(F.lit("restatement").alias("what"), key.alias("key"), none.alias("class"), F.col("run").alias("failed")))


QUERIES = {"report_page": report_page, "report_snapshot": report_snapshot}
_NAME = "CASE metric " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DISPLAY.items()) + " ELSE metric END"
_MONEY = "coalesce('$' || format('{:,}', round_even(%s, 0)::BIGINT) || 'M', '—')"
_TAG = "CASE WHEN period_type = 'FY' THEN 'FY' || fy ELSE fy || period_type END"
_PARTS = f"""{AUDITED}, a AS (SELECT audited.*, range, factor, violations FROM audited LEFT JOIN (SELECT ticker, fy, metric, period_type, range FROM ranged) USING (ticker, fy, metric, period_type) LEFT JOIN cont USING (ticker, fy, metric, period_type) LEFT JOIN ident USING (ticker, fy, metric)), x AS (SELECT * FROM a WHERE fix IS NOT NULL AND (fy + length(period_type)) % 3 = 0),
r0 AS (SELECT ticker, fy, metric, period_type, arg_min(value_usd, (filing_date, doc_id, partkey, suppkey, quantity, tax, value)) AS f, arg_max(value_usd, (filing_date, doc_id, partkey, suppkey, quantity, tax, value)) AS l, count(*) AS k, min(filing_date) AS d0, max(filing_date) AS d1 FROM facts WHERE period_type <> '' GROUP BY ALL),
r AS (SELECT *, abs(l - f) / greatest(abs(f), 1.0) AS change FROM r0 WHERE k >= 2 AND abs(l - f) / greatest(abs(f), 1.0) > 0.005), n AS (SELECT count(*) AS n, {", ".join(f"count(*) FILTER (class = '{c}') AS {c}" for c in CLASSES)} FROM a)"""
_SHARE = " || ' | ' || ".join(f"CASE WHEN count(*) FILTER (metric = '{m}') = 0 THEN '—' ELSE round_even(100.0::DOUBLE * count(*) FILTER (metric = '{m}' AND class IN ('verified', 'derived')) / count(*) FILTER (metric = '{m}'), 0)::BIGINT || '% ' || CASE WHEN count(*) FILTER (metric = '{m}' AND class = 'flagged') > 0 THEN '⚠' ELSE '✓' END END" for m in DISPLAY)
ORACLES = {
    "report_page": f"""{_PARTS}, f AS (SELECT *, string_split(failed, ';') AS c FROM a WHERE class = 'flagged'),
b AS (SELECT *, list_concat(['- **' || {_TAG} || '** ' || {_MONEY % "value_usd"} || ': failed ' || array_to_string(list_transform(c, lambda y: '`' || y || '`'), ', ')],
    CASE WHEN list_contains(c[1:3], 'identity') THEN list_transform(string_split(violations, ';'), lambda y: '  - identity `' || y || '` is off') ELSE [] END,
    CASE WHEN list_contains(c[1:3], 'range') THEN ['  - out-of-range (' || range || ')'] ELSE [] END, CASE WHEN list_contains(c[1:3], 'continuity') THEN ['  - continuity jump factor ' || format('{{:,.2f}}', round_even(factor, 2)) || 'x'] ELSE [] END) AS ls FROM f),
l AS (SELECT 1 AS section, '' AS company, '' AS metric, '' AS place, unnest([0, 1, 2, 3]) AS n, unnest(['# Data quality audit', '**Run**: `run-1`', '**Total cells in universe**: ' || n, '**Status**: ' || {" || ' · ' || ".join(f"'{SIGNS[c]} ' || {c} || ' {c.replace('_', ' ')}'" for c in CLASSES)}]) AS line FROM n
UNION ALL SELECT 2, '', '', '', unnest([0, 1, 2]), unnest(['## Coverage matrix', '| Ticker | {" | ".join(DISPLAY.values())} |', '|---|{"|".join("---" for _ in DISPLAY)}|'])
UNION ALL SELECT 2, ticker::VARCHAR, '', '', 9, '| ' || ticker || ' | ' || {_SHARE} || ' |' FROM a GROUP BY ticker
UNION ALL SELECT 3, '', '', '', 0, '## Flagged items (' || flagged || ')' FROM n UNION ALL SELECT DISTINCT 3, ticker::VARCHAR, metric, '', 0, '### ' || ticker || ' — ' || {_NAME} FROM f
UNION ALL SELECT 3, ticker::VARCHAR, metric, fy || period_type, unnest(range(1, len(ls) + 1))::INT, unnest(ls) FROM b
UNION ALL SELECT 4, '', '', '', 0, '## Fixed in this run (' || count(*) || ')' FROM x UNION ALL SELECT DISTINCT 4, ticker::VARCHAR, '', '', 0, '### ' || ticker FROM x
UNION ALL SELECT 4, ticker::VARCHAR, metric, fy || period_type, 1, '- **' || fy || period_type || '** ' || {_NAME} || ': ' || CASE WHEN ticker % 2 = 0 AND value_usd IS NOT NULL THEN {_MONEY % "value_usd"} || ' → ' || {_MONEY % "(value_usd + 1)"} || ' (' || fix || ')' ELSE fix END FROM x
UNION ALL SELECT 5, '', '', '', unnest([0, 1, 2]), unnest(['## Restatements (' || (SELECT count(*) FROM r) || ')', '| Cell | Original | Latest | Δ | Original filed | Latest filed |', '|---|---|---|---|---|---|'])
UNION ALL SELECT 5, ticker::VARCHAR, metric, fy || period_type, 9, '| ' || ticker || ':' || metric || ':' || fy || period_type || ' | ' || {_MONEY % "f"} || ' | ' || {_MONEY % "l"} || ' | ' || format('{{:,.1f}}', round_even(change * 100, 1)) || '% | ' || d0 || ' | ' || d1 || ' |' FROM r
UNION ALL SELECT 6, '', '', '', 0, '## Known unfixable gaps (' || gap_unfixable || ')' FROM n
UNION ALL SELECT 6, ticker::VARCHAR, '', '', 9, '- **' || ticker || '**: ' || count(*) || ' cells (metrics: ' || (SELECT string_agg({_NAME}, ', ' ORDER BY metric) FROM (SELECT DISTINCT metric FROM a AS i WHERE i.class = 'gap_unfixable' AND i.ticker = a.ticker)) || '; years: ' || min(fy) || '-' || max(fy) || ')' FROM a WHERE class = 'gap_unfixable' GROUP BY ticker)
SELECT section, company, metric, place, n, md5(line) AS digest FROM l""",
    "report_snapshot": f"""{_PARTS} SELECT 'cell' AS what, ticker || ':' || metric || ':' || fy || period_type AS key, class, failed FROM a UNION ALL SELECT 'count', count(*)::VARCHAR, class, NULL FROM a GROUP BY class
UNION ALL SELECT 'fix', ticker || ':' || metric || ':' || fy || period_type, fix, 'run-1' FROM x UNION ALL SELECT 'restatement', ticker || ':' || metric || ':' || fy || period_type, NULL, 'run-1' FROM r""",
}
