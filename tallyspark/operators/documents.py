"""Queries on texts: pages, filing texts, headers, releases, provenance, answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import text as T
from tallyspark.plans.views import table

#: Period headers in the spellings of filings, set around whole texts.
SAID = ["Three months ended", "for the SIX-MONTHS ended", "nine\u2013 month  ended", "fiscal\nyear ended", "Twelve-months ended", "Quarterly ended", "interim Results", "an interim, three month ended", "years ended", "quarters ended"]


def said_around(d: DataFrame):
    pick = lambda k: F.element_at(F.array(*[F.lit(x) for x in SAID]), (F.floor(F.col("doc_id") / k) % len(SAID) + 1).cast("int"))
    return F.concat(pick(1), F.lit(". "), F.coalesce("text", F.lit("")), F.lit(" "), pick(10), F.lit("; "), pick(3))


def header_counts(spark, sf_dir):
    """How often each period header stands in a text."""
    d = table(spark, sf_dir, "documents")
    n = T.header_counts(said_around(d))
    return d.select("doc_id", *[n[k].cast("long").alias(f"n_{k}") for k in T.HEADERS])


def quote_first_numeric(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.first_numeric_sentence(F.col("text")).alias("quote"))


def html_text(spark, sf_dir):
    out = table(spark, sf_dir, "pages").select("page_id", T.html_text("html").alias("t"))
    return out.select("page_id", F.length("t").cast("long").alias("n"), F.md5("t").alias("digest"))


def light_strip(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.length(T.light_strip(F.col("html"))).cast("long").alias("n"))


def section_split(spark, sf_dir):
    """Texts with headings set in, split again: each section's length. Items change with the document's number."""
    i = F.col("doc_id")
    body = F.regexp_replace(F.concat(F.coalesce("text", F.lit("")), F.lit("x"), F.repeat(F.lit("x"), F.greatest(2000 - F.length("text"), F.lit(0)))), "(?i)item", "thing")
    contents = F.when(i % 3 == 0, "Item 1. Business\nItem 2: Risks\n").otherwise("")
    text = F.concat(contents, F.lit("begin\n"), body, F.lit("\nITEM "), i % 4 + 1, F.lit(". One\n"), body, F.lit("\n  item "), i % 5 + 1, F.lit("a - Two\nmore\nItem "), i % 5 + 1, F.lit("A again\nitem 1 end"))
    out = table(spark, sf_dir, "documents").select("doc_id", F.explode(T.sections(text)).alias("name", "part"))
    return out.select("doc_id", "name", F.length("part").cast("long").alias("n"))


def _split_segments(t):
    return F.array_join(F.transform(t, lambda x: F.concat_ws("=", x["year"], x["value"].cast("long"))), ";")


def segment_values(spark, sf_dir):
    """Tables made of order data, read again: values on the segment's line, in a revenue line below it, or near it."""
    o = table(spark, sf_dir, "orders").withColumn("v", F.floor("o_totalprice"))
    a, b = F.format_number("v", 0), F.format_number(F.col("v") + 200, 0)
    head = F.when(F.col("o_orderkey") % 2 == 0, "Segments\nYear Ended December 31, 2014 2013\n").otherwise("Segment\t2016\t2015\t2016\n")
    rows = F.element_at(F.array(
        F.concat(F.lit("Cloud services\t$"), a, F.lit("\t$ "), b), F.concat(F.lit("Cloud\nCost 9 8\nNet  sales "), a, F.lit(" "), b), F.concat(F.lit("Cloud note 7\nprofit "), a, F.lit("\nall "), b, F.lit(" "), a),
        F.concat(F.lit("Other "), a, F.lit(" "), b), F.concat(F.lit("Cloud 500 600 700 800\nRevenue "), b)), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return o.select("o_orderkey", _split_segments(T.segments(F.concat(head, rows, F.lit("\nRest\t12\t9")), F.array(F.lit("AI"), F.lit("Cloud")))).alias("found"))


def segment_quarters(spark, sf_dir):
    """Quarterly tables of both column orders and layouts, read again."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").withColumn("v", F.floor("o_totalprice"))
    years = F.when(k % 2 == 0, "2024 2023").otherwise("2023 2024")
    months = F.element_at(F.array(F.lit("Three Months Ended"), F.lit("Three months ended Six Months Ended"), F.lit("three months ended Nine months ended")), (k % 3 + 1).cast("int"))
    number = lambda x: F.concat(F.lit("$ "), F.format_number(x, 0))
    values = F.concat_ws(" ", number(F.col("v")), number(F.col("v") + 50), number(F.col("v") * 2), number(F.col("v") * 2 + 70))
    row = F.when(k % 5 < 3, F.concat(F.lit("Cloud "), values)).otherwise(F.concat(F.lit("Cloud\nnote\nNet sales "), values))
    text = F.concat(F.lit("[TABLE]Cloud headcount 5 6[/TABLE] x [TABLE]"), months, F.lit(" "), years, F.lit("\nRevenue by segment\n"), row, F.lit("\n[/TABLE]"))
    token = F.concat(F.lit("Q"), k % 3 + 1)
    return o.select("o_orderkey", _split_segments(T.quarters(text, F.array(F.lit("Cloud")), token)).alias("found"))


#: Beginnings and ends that are set around texts, so that the rules meet varied ones.
OPENINGS = ["ACME Announces\nFirst Quarter 1999\nResults. ", "Notice of the Annual General Meeting. ", "", "Foo reports full year results; proxy form enclosed. Financial results for the ", "announces something else. ", "Bar Reports Quarterly Unaudited Results. Monthly return of equity. "]
MIDDLES = ["For the three months ended March 31, 1999. ", "for the year ended March 31, 1999; ", "second quarter ended Jun. 30 1999 and three and six months ended June 30, 1999 ", "3 months\nended Sept 31, 1999, quarter ended feb 28, 1999 "]
ENDINGS = ["", " Condensed consolidated balance sheets", " condensed  consolidated statement of cash flows", " consolidated statements of income"]


def _set_around(d: DataFrame):
    pick = lambda xs, k: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.floor(F.col("doc_id") / k) % len(xs) + 1).cast("int"))
    return F.concat(pick(OPENINGS, 1), pick(MIDDLES, 6), F.coalesce("text", F.lit("")), pick(MIDDLES, 24), pick(ENDINGS, 96))


def release_score(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    out = d.select("doc_id", T.release_score(_set_around(d)).cast("long").alias("score"))
    return out.withColumn("is_release", F.col("score") >= 4)


def period_mode(spark, sf_dir):
    """The period that each text, with dates set in, speaks of."""
    d = table(spark, sf_dir, "documents")
    filed = F.date_add(F.lit("1999-04-20").cast("date"), (F.col("doc_id") % 200).cast("int"))
    return d.select("doc_id", T.mode_date(T.period_ends(_set_around(d)), filed).alias("period"))


def json_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


def answers(spark, sf_dir):
    """JSON found in answers: fenced, bare or none."""
    e = table(spark, sf_dir, "events")
    said = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Here:\n```json\n"), "props", F.lit("\n```\nok"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("so "), "props", F.lit(" it is"))).otherwise("none")
    return e.select("event_id", F.get_json_object(T.json_block(said), "$.k").alias("k"))


#: Messages that are set before the events' types.
MESSAGES = ["HTTP 429 from ", "Error 401: ", "You've hit your weekly limit ", "model x-1 is not available: ", "Unknown model ", "read timed out ", "code 1500 ", "HTTP 503 ", "please /login ", "Claims the limit reached ", "odd ", "too many requests, network ", "invalid token, try again "]


def error_classes(spark, sf_dir):
    texts = F.array(*[F.lit(x) for x in MESSAGES])
    e = table(spark, sf_dir, "events")
    message = F.concat(F.element_at(texts, (F.col("event_id") % len(MESSAGES) + 1).cast("int")), "event_type")
    return e.select("event_id", T.error_class(message).alias("class"))


QUERIES = {
    "header_counts": header_counts,
    "quote_first_numeric": quote_first_numeric,
    "html_text": html_text,
    "light_strip": light_strip,
    "section_split": section_split,
    "segment_values": segment_values,
    "segment_quarters": segment_quarters,
    "release_score": release_score,
    "period_mode": period_mode,
    "json_props": json_props,
    "answer_json": answers,
    "error_classes": error_classes,
}
MONTH = "(?:January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sept|Sep|Oct|Nov|Dec)"
_texts = lambda xs: "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"
AROUND = f"""WITH around AS (SELECT doc_id, {_texts(OPENINGS)}[doc_id % 6 + 1] || {_texts(MIDDLES)}[doc_id // 6 % 4 + 1] || coalesce(text, '') || {_texts(MIDDLES)}[doc_id // 24 % 4 + 1] || {_texts(ENDINGS)}[doc_id // 96 % 4 + 1] AS t FROM documents)"""
ORACLES = {
    "header_counts": f"""WITH t AS (SELECT doc_id, lower({_texts(SAID)}[doc_id % 10 + 1] || '. ' || coalesce(text, '') || ' ' || {_texts(SAID)}[doc_id // 10 % 10 + 1] || '; ' || {_texts(SAID)}[doc_id // 3 % 10 + 1]) AS t FROM documents)
SELECT doc_id, """ + ", ".join(f"len(regexp_extract_all(t, '{p}'))::BIGINT AS n_{k}" for k, p in {
        "three_months": r"three[-\s–—]*months?\s+ended", "six_months": r"six[-\s–—]*months?\s+ended", "nine_months": r"nine[-\s–—]*months?\s+ended", "year": r"(year|twelve[-\s]?months?|fiscal\s+year)\s+ended",
        "quarter": r"(quarter|quarterly)\s+ended", "interim": r"interim\s+(report|results|consolidated)"}.items()) + " FROM t",
    "light_strip": r"SELECT page_id, length(trim(regexp_replace(regexp_replace(html, '(?s)<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) AS n FROM pages",
    "section_split": r"""WITH b AS (SELECT doc_id, regexp_replace(coalesce(text, '') || 'x' || repeat('x', greatest(2000 - length(text), 0)::BIGINT), '(?i)item', 'thing', 'g') AS body, CASE WHEN doc_id % 3 = 0 THEN E'Item 1. Business\nItem 2: Risks\n' ELSE '' END AS contents FROM documents),
p AS (SELECT doc_id, contents || E'begin\n' || body AS a, E'ITEM ' || (doc_id % 4 + 1) || E'. One\n' || body AS b, 'item ' || (doc_id % 5 + 1) || E'a - Two\nmore\nItem ' || (doc_id % 5 + 1) || 'A again' AS c FROM b),
t AS (SELECT *, a || chr(10) || b || E'\n  ' || c || E'\nitem 1 end' AS whole FROM p),
s AS (SELECT doc_id, '_full' AS name, length(whole) AS n, 0 AS k FROM t
  UNION ALL SELECT doc_id, 'Item ' || (doc_id % 4 + 1), length(rtrim(b, E' \t\n\r\x0b\x0c')), 1 FROM t UNION ALL SELECT doc_id, 'Item ' || (doc_id % 5 + 1) || 'A', length(c), 2 FROM t UNION ALL SELECT doc_id, 'Item 1', 10, 3 FROM t)
SELECT doc_id, name, arg_max(n, k) AS n FROM s GROUP BY doc_id, name""",
    "segment_values": """WITH v AS (SELECT o_orderkey, floor(o_totalprice)::BIGINT AS v, CASE WHEN o_orderkey % 2 = 0 THEN '2014' ELSE '2016' END AS y, CASE WHEN o_orderkey % 2 = 0 THEN '2013' ELSE '2015' END AS z FROM orders)
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN y || '=' || v || ';' || z || '=' || (v + 200) WHEN 1 THEN y || '=' || v || ';' || z || '=' || (v + 200) WHEN 2 THEN y || '=' || (v + 200) || ';' || z || '=' || v WHEN 3 THEN '' ELSE y || '=' || (v + 200) END AS found FROM v""",
    "segment_quarters": """WITH v AS (SELECT o_orderkey, floor(o_totalprice)::BIGINT AS v, o_orderkey % 2 AS late, o_orderkey % 3 AS q FROM orders)
SELECT o_orderkey, CASE WHEN q = 0 THEN CASE WHEN v >= 100 THEN 'Q1=' || (v + 50 * late) ELSE '' END ELSE 'Q' || (q + 1) || '=' || (v + 50 * late) || CASE q WHEN 1 THEN ';H1=' ELSE ';9M=' END || (v * 2 + 70 * late) END AS found FROM v""",
    "quote_first_numeric": r"SELECT doc_id, substr(list_filter(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: regexp_matches(x, '[0-9]'))[1], 1, 200) AS quote FROM documents",
    "release_score": rf"""{AROUND}, h AS (SELECT doc_id, substr(trim(regexp_replace(substr(t, 1, 6000), '\s+', ' ', 'g')), 1, 4000) AS head, trim(regexp_replace(substr(t, 1, 60000), '\s+', ' ', 'g')) AS body FROM around),
s AS (SELECT doc_id, 4 * regexp_matches(head, '(?i)\b(announces?|reports?)\b[^\n]{{0,80}}?\b(quarter|quarterly|fiscal year|full year)\b[^\n]{{0,60}}?\bresults\b')::INT + 2 * regexp_matches(head, '(?i)\bfinancial results for the\b')::INT
  + 2 * regexp_matches(body, '(?i)condensed consolidated (statements? of (operations|income|comprehensive|cash flows)|balance sheets?)')::INT + regexp_matches(head, '(?i)(three|3)( and (six|nine|twelve))? months ended {MONTH}\.? [0-9]{{1,2}},? [0-9]{{4}}|quarter ended {MONTH}\.? [0-9]{{1,2}},? [0-9]{{4}}')::INT
  - 6 * regexp_matches(substr(head, 1, 600), '(?i)annual general meeting|extraordinary general meeting|notice of (the )?(annual|extraordinary)|proxy (statement|form)|next day disclosure return|monthly return of equity|this circular is important')::INT AS score FROM h)
SELECT doc_id, score::BIGINT AS score, score >= 4 AS is_release FROM s""",
    "period_mode": rf"""{AROUND}, e AS (SELECT doc_id, unnest(regexp_extract_all(substr(t, 1, 40000), '(?i)(?:months|quarter)\s+ended\s+{MONTH}\.?\s+\d{{1,2}},?\s+\d{{4}}')) AS said FROM around),
p AS (SELECT doc_id, list_position(['jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec'], lower(regexp_extract(said, '(?i)ended\s+([a-z]{{3}})', 1))) AS m, regexp_extract(said, '(\d{{1,2}}),?\s+\d{{4}}$', 1)::INT AS d, right(said, 4)::INT AS y FROM e),
k AS (SELECT doc_id, try_cast(y || '-' || lpad(m::VARCHAR, 2, '0') || '-' || lpad(d::VARCHAR, 2, '0') AS DATE) AS day FROM p),
n AS (SELECT doc_id, day, count(*) AS n FROM k WHERE (DATE '1999-04-20' + (doc_id % 200)::INT) - day BETWEEN 0 AND 120 GROUP BY ALL)
SELECT doc_id, arg_max(day, (n, day)) AS period FROM documents LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "json_props": "SELECT event_id, regexp_extract(props, '[0-9]+')::BIGINT AS k FROM events",
    "answer_json": "SELECT event_id, CASE WHEN event_id % 3 < 2 THEN regexp_extract(props, '[0-9]+') END AS k FROM events",
    "error_classes": rf"""SELECT event_id, CASE WHEN regexp_matches(m, '(?i)\b401\b|invalid (api key|token|bearer)|/login\b|expired|authenticat') THEN 'auth' WHEN regexp_matches(m, '(?i)\b429\b|limit|too many requests') THEN 'limit'
  WHEN regexp_matches(m, '(?i)model.*not available|unknown model') THEN 'model' ELSE 'transient' END AS class FROM (SELECT event_id, {MESSAGES!r}[event_id % {len(MESSAGES)} + 1] || event_type AS m FROM events)""".replace('"You\'ve', "'You''ve").replace('limit ", ', "limit ', "),
}
