"""Text extraction from filings: sections, windows, tables, values by pattern, conventions."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import MapType, StringType

from tallyspark.functions import labels as L
from tallyspark.functions import text as T
from tallyspark.operators.documents import SAID, said_around
from tallyspark.plans.views import SQL, companies, filings, table

#: Headings of half-yearly reports, in the order in which they are tried.
HEADINGS = [
    (r"management\s+discussion\s+and\s+analysis", "Management Discussion and Analysis"),
    (r"management\s+discussion", "Management Discussion"),
    (r"md&a", "Management Discussion"),
    (r"consolidated\s+statement\s+of\s+cash\s+flows?", "Consolidated Statement of Cash Flows"),
    (r"consolidated\s+cash\s+flow", "Consolidated Cash Flow Statement"),
    (r"notes?\s+to\s+(?:the\s+)?(?:consolidated\s+)?financial\s+statements?", "Notes to Financial Statements"),
    (r"notes?\s+to\s+(?:the\s+)?(?:consolidated\s+)?accounts?", "Notes to Accounts"),
    (r"financial\s+review", "Financial Review"),
    (r"report\s+of\s+the\s+directors", "Report of the Directors"),
]
#: Lengths of what is kept of long texts.
WHOLE, HEAD, TAIL = 500_000, 35_000, 60_000
#: Cues of tables with segment revenue.
INDICATORS = ["North America", "International", "Total", "Productivity", "Personal Computing", "Google Services", "Other Bets"]

def headed_sections(text: str) -> dict[str, str]:
    """Sections by headings near the start of a line; a later one of the same name counts if it is longer than 500 signs."""
    found = []
    for pattern, label in HEADINGS:
        for m in re.finditer(pattern, text, re.IGNORECASE):
            before = text[text.rfind("\n", 0, m.start()) + 1 : m.start()].strip()
            if len(before) < 20:
                found.append((m.start(), label))
    found.sort(key=lambda x: x[0])
    out: dict[str, str] = {}
    for (at, label), end in zip(found, [*(a for a, _ in found[1:]), len(text)], strict=True):
        part = text[at:end].strip()
        if len(part) > 500 or label not in out:
            out[label] = part
    return out


@arrow_udf(MapType(StringType(), StringType()))
def headed(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else list(headed_sections(t).items()) for t in texts.to_pylist()], pa.map_(pa.string(), pa.string()))


def chosen_sections(sections: Column, wanted: list[str]) -> Column:
    """The first section for each wanted prefix, without regard to case; without any the first signs of the whole text."""
    entries = F.map_entries(sections)
    first = lambda p: F.try_element_at(F.filter(entries, lambda e: F.lower(e["key"]).startswith(p.lower())), F.lit(1))
    found = F.array_distinct(F.array_compact(F.array(*map(first, wanted))))
    rest = F.array(F.struct(F.lit("_full (truncated)").alias("key"), F.substring(F.coalesce(sections["_full"], F.lit("")), 1, WHOLE).alias("value")))
    return F.map_from_entries(F.when(F.size(found) > 0, found).otherwise(rest))


def release_window(text: Column) -> Column:
    """A release as it is, or the beginning and the end of a long one."""
    n = F.length(text)
    part = lambda name, x: F.struct(F.lit(name).alias("name"), x.alias("text"))
    whole = F.array(part("whole", text))
    return F.when(n <= HEAD + TAIL, whole).otherwise(F.array(part("highlights", F.substring(text, 1, HEAD)), part("statements", F.substring(text, n - TAIL + 1, F.lit(TAIL)))))


def token_estimate(parts: Column) -> Column:
    return F.floor(F.aggregate(parts, F.lit(0), lambda acc, x: acc + F.length(x)) / 4)


def table_blocks(text: Column) -> Column:
    """The tables between markers."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(?s)\[TABLE\](.*?)\[/TABLE\]"), 1), lambda t: F.btrim(t, F.lit(" \t\n\r")))


def table_score(raw: Column, names: Column) -> Column:
    """How likely a table holds segment revenue; 0 without a segment's name, else by cues, also below 0."""
    hit = lambda p, n: F.when(raw.rlike(p), n).otherwise(0)
    years = F.size(F.array_distinct(F.regexp_extract_all(raw, F.lit("20[12][0-9]"), 0)))
    numbers = F.transform(F.regexp_extract_all(raw, F.lit("[0-9,]{4,}"), 0), lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("decimal(38,0)"))
    score = F.lit(10) + hit(r"(?i)net\s+sales|revenue|total\s+revenues", 5) + F.when(years >= 2, 3).otherwise(0) + F.when(F.coalesce(F.array_max(numbers), F.lit(0)) > 1000, 3).otherwise(0)
    score = score - hit(r"(?i)square\s+foot|headcount|employees|shares", 20) - hit("(?i)goodwill|intangible|restructur", 10)
    score = score + 2 * sum((F.contains(raw, F.lit(x)).cast("int") for x in INDICATORS), F.lit(0))
    return F.when(F.exists(names, lambda n: F.contains(raw, n)), score).otherwise(0)


def best_table(text: Column, names: Column) -> Column:
    """(score, raw) of the best table with a positive score, the first on ties."""
    scored = F.transform(table_blocks(text), lambda t, i: F.struct(table_score(t, names).alias("score"), (-i).alias("place"), t.alias("raw")))
    best = F.array_max(F.filter(scored, lambda x: x["score"] > 0))
    return F.struct(best["score"].alias("score"), best["raw"].alias("raw"))


def first_match(text: Column, patterns: list[str]) -> Column:
    """(number, unit) of the first pattern that matches, in millions; patterns have a number's group and a unit's group."""
    value = lambda p: F.when(text.rlike(p), L.scaled_millions(F.regexp_extract(text, p, 1), F.regexp_extract(text, p, 2)))
    return F.coalesce(*map(value, patterns)) if patterns else F.lit(None).cast("double")


def by_company(text: Column, key: Column, patterns: dict[str, list[str]]) -> Column:
    """first_match with the patterns of each key; null for other keys."""
    return F.coalesce(*[F.when(key == k, first_match(text, p)) for k, p in patterns.items()]) if patterns else F.lit(None).cast("double")


def derived_rest(total: Column, online: Column, third: Column, non_online: Column) -> Column:
    """What is left of the total, where both other parts are known, else what is said directly."""
    return F.coalesce(total - online - third, non_online)


def convention_warnings(text: Column, known: Column, declared: Column, expect: Column, forbid: Column) -> Column:
    """Where a filing's period headers don't fit the company's convention: warnings, as an array.

    known: whether the company has a convention; without one that is the only warning. declared: that of the metric, if it
    has one of its own, else the company's. One of the phrases of expect must be in the text, and none of forbid, in any case."""
    n, low = T.header_counts(text), F.lower(text)
    listed = lambda xs: F.coalesce(xs, F.array().cast("array<string>"))
    within = lambda x: F.contains(low, F.lower(x))
    rules = [
        ((F.size(listed(expect)) > 0) & ~F.exists(listed(expect), within), "expected phrase missing"),
        ((declared == "standalone_quarterly") & (n["nine_months"] > 0), "nine months in a standalone filer"),
        ((declared == "ytd_cumulative") & (n["three_months"] == 0) & (n["nine_months"] == 0), "no cumulative headers"),
        ((declared == "semi_annual") & (n["three_months"] > 0) & (n["six_months"] == 0), "three months in a half-yearly filer"),
    ]
    said = [F.when(bad, F.lit(name)) for bad, name in rules]
    seen = F.transform(F.filter(listed(forbid), within), lambda x: F.concat(F.lit("disallowed phrase: "), x))
    return F.when(known, F.concat(F.array_compact(F.array(said[0])), seen, F.array_compact(F.array(*said[1:])))).otherwise(F.array(F.lit("undeclared")))


def check_conventions(texts: DataFrame, conventions: DataFrame) -> DataFrame:
    """texts (ticker, metric or null, text, and others) with `declared` and `warnings`.

    conventions: one row a company: ticker, convention, per_metric (a map of metrics' own), expect, forbid (phrases). Each
    company's row meets its texts by an equality join."""
    c = conventions.select("ticker", F.lit(True).alias("__known"), "convention", "per_metric", "expect", "forbid")
    out = texts.join(c, "ticker", "left")
    declared = F.coalesce(F.try_element_at("per_metric", F.coalesce("metric", F.lit(""))), "convention")
    warnings = convention_warnings(F.coalesce("text", F.lit("")), F.coalesce("__known", F.lit(False)), declared, F.col("expect"), F.col("forbid"))
    return out.select(*texts.columns, declared.alias("declared"), warnings.alias("warnings"))


def release_search(candidates: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The release for each key: candidates (keys, filed, size, score, period, period_end, accession) 7 to 120 days after the
    period's end whose size suffices or isn't known, that score 4 and whose period is within 7 days; of those on the first
    day by `order` the best score, the earlier place on ties."""
    lag = F.date_diff("filed", "period_end")
    fits = lag.between(7, 120) & ((F.col("size") >= 40_000) | (F.col("size") == 0)) & (F.col("score") >= 4) & (F.abs(F.date_diff("period", "period_end")) <= 7)
    rows = candidates.filter(fits)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    rows = rows.withColumn("__place", place).withColumn("__day", F.first("filed").over(Window.partitionBy(*keys).orderBy("__place")))
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), "__place")
    return rows.filter(F.col("filed") == F.col("__day")).withColumn("__n", F.row_number().over(best)).filter("__n = 1").drop("__n", "__place", "__day")


def _reports(spark, sf_dir):
    """Texts with headings and tables set in."""
    d = table(spark, sf_dir, "documents")
    body = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\[\]]", " ")
    tables = F.concat(F.lit("\n[TABLE]\nSegment\t2014\t2013\nCloud\t"), F.col("doc_id") * 37 + 800, F.lit("\t900\nTotal revenue\t5,000\n[/TABLE]\nand "), F.lit("[TABLE]Cloud goodwill"), F.when(F.col("doc_id") % 3 == 0, " employees").otherwise(" 2012 2011 net  sales International"), F.lit("[/TABLE][TABLE]AI\t12[/TABLE]"))
    heads = F.concat(F.lit("\nFinancial  Review\n"), body, F.lit("\nsee md&a above, notes to the accounts\nManagement discussion and analysis\n"), F.when(F.col("doc_id") % 2 == 0, body).otherwise("short"), F.lit("\nFinancial review\nend"))
    return d.select("doc_id", F.concat(heads, tables).alias("text"))


def headed_report(spark, sf_dir):
    out = _reports(spark, sf_dir).select("doc_id", F.explode(headed(F.col("text"))).alias("name", "part"))
    return out.select("doc_id", "name", F.length("part").cast("long").alias("n"), F.md5("part").alias("digest"))


def section_choice(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    m = F.create_map(F.lit("_full"), F.coalesce("text", F.lit("")), F.concat(F.lit("Item "), F.col("doc_id") % 4), F.lit("one"), F.lit("ITEM 7A"), F.lit("two"))
    out = d.select("doc_id", F.explode(chosen_sections(m, ["item 7", "item 1", "item 9"])).alias("name", "part"))
    return out.select("doc_id", "name", "part")


def section_fallback(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    m = F.create_map(F.lit("_full"), F.coalesce("text", F.lit("")), F.lit("Item 1"), F.lit("one"))
    return d.select("doc_id", F.explode(chosen_sections(m, ["item 7"])).alias("name", "part")).select("doc_id", "name", F.md5("part").alias("digest"))


def release_windows(spark, sf_dir):
    text = F.repeat(F.coalesce("text", F.lit("")), 6)
    out = table(spark, sf_dir, "documents").select("doc_id", release_window(text).alias("w"))
    return out.select("doc_id", F.array_join(F.transform("w", lambda x: x["name"]), ",").alias("names"), F.md5(F.array_join(F.transform("w", lambda x: x["text"]), "|")).alias("digest"), token_estimate(F.transform("w", lambda x: x["text"])).alias("tokens"))


def report_tables(spark, sf_dir):
    out = _reports(spark, sf_dir).select("doc_id", F.posexplode(table_blocks(F.col("text"))).alias("pos", "raw"))
    return out.select("doc_id", "pos", "raw", table_score(F.col("raw"), F.array(F.lit("Cloud"), F.lit("AI"))).cast("long").alias("score"))


def report_best_table(spark, sf_dir):
    out = _reports(spark, sf_dir).select("doc_id", best_table(F.col("text"), F.array(F.lit("Cloud"), F.lit("AI"))).alias("b"))
    return out.select("doc_id", F.col("b.score").cast("long").alias("score"), F.md5("b.raw").alias("digest"))


PATTERNS = {
    "A": [r"[Rr]evenue\s+(?:was|were)\s+RMB\s*(\d{1,3}(?:,\d{3})*(?:\.\d+)?)\s*(million|billion)", r"[Tt]otal\s+of\s+RMB\s*(\d{1,3}(?:,\d{3})*(?:\.\d+)?)\s*(million|billion)"],
    "B": [r"[Ss]ales\s+of\s+\$\s*(\d{1,3}(?:,\d{3})*(?:\.\d+)?)\s*(million|billion)"],
}


def _sentences(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    n = F.format_number(F.floor("o_totalprice"), 0)
    said = F.concat(F.lit("In 1999 "), F.expr("element_at(array('Revenue was RMB ', 'total of RMB', 'Sales  of $', 'nothing of '), cast(o_orderkey % 4 as int) + 1)"), n, F.when(F.col("o_orderkey") % 3 == 0, " billion").otherwise(".5 million"), F.lit(" and more. Total of RMB 7 million"))
    return o.select("o_orderkey", said.alias("said"), F.expr("element_at(array('A', 'A', 'B', 'C', 'B'), cast(o_orderkey % 5 as int) + 1)").alias("key"))


def pattern_values(spark, sf_dir):
    return _sentences(spark, sf_dir).select("o_orderkey", by_company(F.col("said"), F.col("key"), PATTERNS).alias("value"))


def derived_values(spark, sf_dir):
    """The rest of a total, from texts that name two, one or none of the parts."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("Total revenues were RMB "), F.col("o_orderkey") + 500, F.lit(" million"), F.when(F.col("o_orderkey") % 2 == 0, ", online RMB 100 million").otherwise(""), F.when(F.col("o_orderkey") % 3 == 0, ", video RMB 0.2 billion").otherwise(""), F.when(F.col("o_orderkey") % 5 == 0, ", others RMB 77 million").otherwise("")).alias("t"))
    v = lambda word: first_match(F.col("t"), [rf"{word}\s+RMB\s*([\d,.]+)\s*(million|billion)"])
    return o.select("o_orderkey", derived_rest(v("were"), v("online"), v("video"), v("others")).alias("rest"))


def convention_check(spark, sf_dir):
    """Documents with period headers set in, against conventions of companies and of metrics."""
    d = table(spark, sf_dir, "documents")
    texts = d.select("doc_id", (F.col("doc_id") % 30).alias("ticker"), F.expr("element_at(array('revenue', 'other', null), cast(doc_id % 3 as int) + 1)").alias("metric"), said_around(d).alias("text"))
    kind = F.expr("element_at(array('standalone_quarterly', 'ytd_cumulative', 'semi_annual'), cast(ticker % 3 as int) + 1)")
    own = F.when(F.col("ticker") % 4 == 0, F.create_map(F.lit("revenue"), F.lit("semi_annual")))
    expect = F.when(F.col("ticker") % 5 == 0, F.array(F.lit("INTERIM"), F.lit("Quarterly ended")))
    rows = companies(spark, sf_dir).filter("ticker < 30 and ticker % 7 > 0").select("ticker", kind.alias("convention"), own.alias("per_metric"), expect.alias("expect"), F.array(F.lit("six-Months"), F.lit("twelve-")).alias("forbid"))
    return check_conventions(texts, rows).select("doc_id", "declared", F.array_join("warnings", ";").alias("warnings"))


def releases(spark, sf_dir):
    """A company's releases for each period that it reported on."""
    f = filings(spark, sf_dir)
    c = f.select("ticker", F.col("filing_date").alias("filed"), F.col("doc_id").alias("accession"), F.when(F.col("doc_id") % 7 == 0, 0).otherwise(F.col("total").cast("long") % 90_000).alias("size"), (F.col("doc_id") % 10).alias("score"), F.date_add("period", (F.col("doc_id") % 11).cast("int")).alias("period"), F.col("period").alias("period_end"))
    announced = F.date_add("period_end", 45)
    out = release_search(c, ["ticker", "period_end"], [F.abs(F.date_diff("filed", announced)), F.desc("filed"), "accession"])
    return out.select("ticker", "period_end", "accession", "score")


def chosen_releases(asked: DataFrame, candidates: DataFrame, day: Column, days: int = 210) -> DataFrame:
    """asked (ticker, accession or null) with the release to read and whether it was chosen: the filing that was asked for,
    whatever it looks like, else the company's newest release of the last days; null where there is neither.

    candidates: ticker, filed, accession, score (4 or more is a release)."""
    given = candidates.select("ticker", "accession", F.lit(True).alias("__given")).distinct()
    recent = candidates.filter((F.col("score") >= 4) & F.col("filed").between(F.date_sub(day, days), day))
    latest = recent.groupBy("ticker").agg(F.max_by("accession", F.struct("filed", "accession")).alias("__latest"))
    out = asked.join(given, ["ticker", "accession"], "left").join(latest, "ticker", "left")
    chosen = F.col("__given").isNotNull()
    release = F.when(chosen, F.col("accession")).when(F.col("accession").isNull(), F.col("__latest"))
    return out.select(*asked.columns, release.alias("release"), chosen.alias("chosen"))


def chosen_release(spark, sf_dir):
    """Every customer asks for a filing of theirs, an unknown one, or the latest."""
    f = filings(spark, sf_dir).select("ticker", F.col("filing_date").alias("filed"), F.col("doc_id").alias("accession"), (F.col("doc_id") % 10).alias("score"))
    own = f.groupBy("ticker").agg(F.min("accession").alias("first"))
    asked = companies(spark, sf_dir).join(own, "ticker", "left").select("ticker", F.when(F.col("ticker") % 3 == 0, F.col("first")).when(F.col("ticker") % 3 == 1, F.lit(-1)).alias("accession"))
    return chosen_releases(asked, f, F.lit("1998-01-01").cast("date"))


def latest_releases(spark, sf_dir):
    """A company's newest release within 210 days of a day."""
    f = filings(spark, sf_dir).filter("doc_id % 10 >= 4").filter(F.col("filing_date").between(F.date_sub(F.lit("1998-01-01").cast("date"), 210), F.lit("1998-01-01").cast("date")))
    return f.groupBy("ticker").agg(F.max_by("doc_id", F.struct("filing_date", "doc_id")).alias("doc_id"))


#: Sentences around a value, set into documents; without a full stop before, of other endings, or with an odd unit.
AROUND_VALUE = [" Spending was {} for us. More of it.", " note 1.2 spending {}! Then", " capex: $ {} and so on without an end, which goes further than a quote does, for a whole line and more of it", "? We spent {}.\nNext line. ", " of 3.{} (capex). "]


def quote_texts(spark, sf_dir):
    """Documents with a value set into the middle: doc_id, value, keywords, text."""
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    v = (i * 977 % 20_000 - 50).cast("double") + F.when(i % 4 == 0, 0.5).otherwise(0.0)
    said = F.when(i % 3 == 0, F.concat(F.format_number(v, 0), F.lit(" million"))).when(i % 3 == 1, F.format_number(v, 0)).otherwise(F.concat(F.format_number(v / 1000, 1), F.lit(" billion")))
    pick = F.element_at(F.array(*[F.lit(x) for x in AROUND_VALUE]), (i % len(AROUND_VALUE) + 1).cast("int"))
    half = F.floor(F.length("text") / 2).cast("int")
    text = F.concat(F.substring(F.col("text"), F.lit(1), half), F.replace(pick, F.lit("{}"), said), F.substring(F.col("text"), half + 1, F.length("text")))
    keys = F.when(i % 7 == 0, F.array().cast("array<string>")).when(i % 7 == 1, F.array(F.lit("nothing"))).otherwise(F.array(F.lit("CAPEX"), F.lit("sp")))
    return d.select("doc_id", v.alias("value"), keys.alias("keywords"), text.alias("text"))


def found_quotes(spark, sf_dir):
    """The sentence around a known value in each document."""
    return quote_texts(spark, sf_dir).select("doc_id", T.quotes(F.col("text"), F.col("value"), F.col("keywords")).alias("quote"))


def keyword_lists(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    out = p.select("p_partkey", L.keywords(F.split("p_name", " "), F.array(F.lower("p_type"), F.lit("widget"), F.lit("cloud"))).alias("k"))
    return out.select("p_partkey", F.array_join("k", ",").alias("keywords"))


QUERIES = {
    "headed_report": headed_report,
    "section_choice": section_choice,
    "section_fallback": section_fallback,
    "release_windows": release_windows,
    "report_tables": report_tables,
    "report_best_table": report_best_table,
    "pattern_values": pattern_values,
    "derived_values": derived_values,
    "convention_check": convention_check,
    "release_search": releases,
    "latest_releases": latest_releases,
    "chosen_release": chosen_release,
    "found_quotes": found_quotes,
    "keyword_lists": keyword_lists,
}
_RAW = """t AS (SELECT doc_id, 0 AS pos, 'Segment' || chr(9) || '2014' || chr(9) || '2013' || chr(10) || 'Cloud' || chr(9) || (doc_id * 37 + 800) || chr(9) || '900' || chr(10) || 'Total revenue' || chr(9) || '5,000' AS raw, 23 AS score FROM documents
UNION ALL SELECT doc_id, 1, 'Cloud goodwill' || CASE WHEN doc_id % 3 = 0 THEN ' employees' ELSE ' 2012 2011 net  sales International' END, CASE WHEN doc_id % 3 = 0 THEN -20 ELSE 13 END FROM documents UNION ALL SELECT doc_id, 2, 'AI' || chr(9) || '12', 10 FROM documents)"""
_SAID = "[" + ", ".join(f"'{x}'" for x in SAID) + "]"
ORACLES = {
    "section_choice": "SELECT doc_id, 'ITEM 7A' AS name, 'two' AS part FROM documents UNION ALL SELECT doc_id, 'Item 1', 'one' FROM documents WHERE doc_id % 4 = 1",
    "section_fallback": "SELECT doc_id, '_full (truncated)' AS name, md5(substr(coalesce(text, ''), 1, 500000)) AS digest FROM documents",
    "release_windows": """WITH t AS (SELECT doc_id, repeat(coalesce(text, ''), 6) AS t FROM documents) SELECT doc_id, CASE WHEN length(t) <= 95000 THEN 'whole' ELSE 'highlights,statements' END AS names, md5(CASE WHEN length(t) <= 95000 THEN t ELSE left(t, 35000) || '|' || right(t, 60000) END) AS digest, least(length(t), 95000) // 4 AS tokens FROM t""",
    "report_tables": f"WITH {_RAW} SELECT doc_id, pos, raw, score::BIGINT AS score FROM t",
    "report_best_table": f"WITH {_RAW} SELECT doc_id, max(score)::BIGINT AS score, md5(arg_max(raw, (score, -pos))) AS digest FROM t GROUP BY doc_id",
    "pattern_values": """WITH s AS (SELECT o_orderkey, floor(o_totalprice) + CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 0.5 END AS n, CASE WHEN o_orderkey % 3 = 0 THEN 1000 ELSE 1 END AS f, ['A', 'A', 'B', 'C', 'B'][o_orderkey % 5 + 1] AS key FROM orders)
SELECT o_orderkey, CASE key WHEN 'A' THEN CASE WHEN o_orderkey % 4 < 2 THEN n * f ELSE 7 END WHEN 'B' THEN CASE WHEN o_orderkey % 4 = 2 THEN n * f END END::DOUBLE AS value FROM s""",
    "derived_values": "SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN o_orderkey + 200 WHEN o_orderkey % 5 = 0 THEN 77 END::DOUBLE AS rest FROM orders",
    "convention_check": f"""{SQL}, t AS (SELECT doc_id, doc_id % 30 AS ticker, ['revenue', 'other', NULL][doc_id % 3 + 1] AS metric, lower({_SAID}[doc_id % 10 + 1] || '. ' || coalesce(text, '') || ' ' || {_SAID}[doc_id // 10 % 10 + 1] || '; ' || {_SAID}[doc_id // 3 % 10 + 1]) AS t FROM documents),
c AS (SELECT ticker, ['standalone_quarterly', 'ytd_cumulative', 'semi_annual'][ticker % 3 + 1] AS kind FROM companies WHERE ticker < 30 AND ticker % 7 > 0),
x AS (SELECT t.*, kind, CASE WHEN kind IS NOT NULL AND metric = 'revenue' AND ticker % 4 = 0 THEN 'semi_annual' ELSE kind END AS declared, regexp_matches(t, 'three[-\\s–—]*months?\\s+ended') AS m3, regexp_matches(t, 'six[-\\s–—]*months?\\s+ended') AS m6, regexp_matches(t, 'nine[-\\s–—]*months?\\s+ended') AS m9 FROM t LEFT JOIN c USING (ticker))
SELECT doc_id, declared, CASE WHEN kind IS NULL THEN 'undeclared' ELSE concat_ws(';', CASE WHEN ticker % 5 = 0 AND NOT contains(t, 'interim') AND NOT contains(t, 'quarterly ended') THEN 'expected phrase missing' END, CASE WHEN contains(t, 'six-months') THEN 'disallowed phrase: six-Months' END, CASE WHEN contains(t, 'twelve-') THEN 'disallowed phrase: twelve-' END,
  CASE WHEN declared = 'standalone_quarterly' AND m9 THEN 'nine months in a standalone filer' END, CASE WHEN declared = 'ytd_cumulative' AND NOT m3 AND NOT m9 THEN 'no cumulative headers' END, CASE WHEN declared = 'semi_annual' AND m3 AND NOT m6 THEN 'three months in a half-yearly filer' END) END AS warnings FROM x""",
    "release_search": f"""{SQL}, c AS (SELECT ticker, filing_date AS filed, doc_id AS accession, doc_id % 10 AS score, period AS period_end, abs(filing_date - (period + 45)) AS off FROM filings
  WHERE filing_date - period BETWEEN 7 AND 120 AND (doc_id % 7 = 0 OR trunc(total)::BIGINT % 90000 >= 40000 OR trunc(total)::BIGINT % 90000 = 0) AND doc_id % 10 >= 4 AND doc_id % 11 <= 7),
d AS (SELECT *, first_value(filed) OVER (PARTITION BY ticker, period_end ORDER BY off, filed DESC, accession) AS day FROM c)
SELECT ticker, period_end, accession, score FROM d WHERE filed = day QUALIFY row_number() OVER (PARTITION BY ticker, period_end ORDER BY score DESC, off, filed DESC, accession) = 1""",
    "chosen_release": f"""{SQL}, l AS (SELECT ticker, arg_max(doc_id, (filing_date, doc_id)) AS latest FROM filings WHERE doc_id % 10 >= 4 AND filing_date BETWEEN DATE '1998-01-01' - 210 AND DATE '1998-01-01' GROUP BY ticker), o AS (SELECT ticker, min(doc_id) AS first FROM filings GROUP BY ticker)
SELECT ticker, CASE ticker % 3 WHEN 0 THEN first WHEN 1 THEN -1 END AS accession, CASE WHEN ticker % 3 = 0 AND first IS NOT NULL THEN first WHEN ticker % 3 = 1 THEN NULL ELSE latest END AS release, ticker % 3 = 0 AND first IS NOT NULL AS chosen FROM companies LEFT JOIN o USING (ticker) LEFT JOIN l USING (ticker)""",
    "latest_releases": f"{SQL} SELECT ticker, arg_max(doc_id, (filing_date, doc_id)) AS doc_id FROM filings WHERE doc_id % 10 >= 4 AND filing_date BETWEEN DATE '1998-01-01' - 210 AND DATE '1998-01-01' GROUP BY ticker",
    "keyword_lists": "SELECT p_partkey, array_to_string(list_transform(list_sort(list_distinct(list_transform(list_zip(w, range(len(w))), lambda z: list_position(w, z[1])))), lambda i: w[i]), ',') AS keywords FROM (SELECT p_partkey, list_concat(string_split(p_name, ' '), [lower(p_type), 'widget', 'cloud']) AS w FROM part)",
}
