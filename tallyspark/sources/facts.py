"""Structured facts: nested JSON to rows, one entry per period and form, concept fallback, and the anchor check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions import labels as L
from tallyspark.plans.views import SQL, facts, filings, table

ENTRY = "struct<start:string,end:string,val:double,form:string,filed:string,fy:int,fp:string,accn:string>"
SCHEMA = f"struct<facts:map<string,map<string,struct<units:map<string,array<{ENTRY}>>>>>>"
#: Units in the order in which they are preferred, and those of the anchor check.
UNITS = ["USD", "CNY", "HKD", "AUD"]
ANCHOR_UNITS = ["USD", "USD/shares", "pure"]
ANNUAL = ["10-K", "20-F"]


def facts_scan(pages: DataFrame, json_col: str, *keys: str) -> DataFrame:
    """A row per entry of each concept's preferred unit, else of its first one, with its place in the input order."""
    parsed = pages.select(*keys, F.from_json(json_col, SCHEMA)["facts"].alias("facts"))
    rows = parsed.select(*keys, F.explode("facts").alias("taxonomy", "concepts")).select(*keys, "taxonomy", F.explode("concepts").alias("concept", "body"))
    first = F.try_element_at(F.map_keys("body.units"), F.lit(1))
    unit = F.coalesce(*[F.when(F.map_contains_key("body.units", u), F.lit(u)) for u in UNITS], first)
    rows = rows.withColumn("unit", unit).withColumn("entries", F.try_element_at("body.units", F.col("unit")))
    return rows.select(*keys, "taxonomy", "concept", "unit", F.posexplode("entries").alias("pos", "e")).select(*keys, "taxonomy", "concept", "unit", "pos", "e.*")


def split_concept(concept: Column) -> tuple[Column, Column]:
    """(taxonomy, name); an error where there is no colon."""
    parts = F.split(concept, ":", 2)
    ok = F.when(F.size(parts) == 2, parts).otherwise(F.raise_error(F.concat(F.lit("concept must be taxonomy:name, not "), concept)).cast("array<string>"))
    return ok[0], ok[1]


def base_form(form: Column) -> Column:
    """The form without trailing signs of an amendment."""
    return F.rtrim(form, F.lit("/A"))


def duration_score(start: Column, end: Column, form: Column, fp: Column) -> Column:
    """How far an entry's days are from its form's usual ones, a wrong fiscal period counting 50; unknown days 10,000."""
    days, annual = L.safe_days(start, end), base_form(form).isin(*ANNUAL)
    wrong = F.when(annual, F.coalesce(fp, F.lit("")) != "FY").otherwise(~F.coalesce(fp, F.lit("")).isin("Q1", "Q2", "Q3"))
    return F.coalesce(F.abs(days - F.when(annual, 365).otherwise(90)) + F.when(wrong, 50).otherwise(0), F.lit(10_000))


def best_entries(rows: DataFrame, keys: list[str], forms: list[str], order: list[str], start=None, end=None) -> DataFrame:
    """One entry per key, end and form (amendments with their form): the best score, the first in the input order on ties."""
    kept = rows.filter(F.col("end").isNotNull() & (F.col("end") != "") & F.col("val").isNotNull() & F.col("form").isin(*forms))
    if start is not None:
        kept = kept.filter(F.col("end") >= start)
    if end is not None:
        kept = kept.filter(F.col("end") <= end)
    kept = kept.withColumn("base", base_form(F.col("form"))).withColumn("score", duration_score(F.col("start"), F.col("end"), F.col("form"), F.col("fp")))
    w = Window.partitionBy(*keys, "end", "base").orderBy("score", *order)
    return kept.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def concept_fallback(series: DataFrame, keys: list[str], priority: Column) -> DataFrame:
    """All rows of a key's first concept that has any."""
    rows = series.withColumn("priority", priority).filter("priority is not null")
    first = rows.groupBy(*keys).agg(F.min("priority").alias("priority"))
    return rows.join(first, [*keys, "priority"])


def concept_merge(series: DataFrame, keys: list[str], priority: Column) -> DataFrame:
    """For each end the row of the first concept that has it."""
    rows = series.withColumn("priority", priority).filter("priority is not null")
    w = Window.partitionBy(*keys, "end").orderBy("priority")
    return rows.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def anchor_concept(aliases: Column) -> Column:
    """The first alias that names a concept."""
    return F.try_element_at(F.filter(aliases, lambda a: a.startswith("us-gaap:") | a.startswith("ifrs:")), F.lit(1))


def anchor_values(pages: DataFrame, json_col: str, *keys: str) -> DataFrame:
    """(keys, taxonomy, concept, end, value): the first entry of each end in the first unit that has one; US dollars in millions."""
    parsed = pages.select(*keys, F.from_json(json_col, SCHEMA)["facts"].alias("facts"))
    rows = parsed.select(*keys, F.explode("facts").alias("taxonomy", "concepts")).select(*keys, "taxonomy", F.explode("concepts").alias("concept", "body"))
    known = F.filter(F.map_entries("body.units"), lambda e: e["key"].isin(*ANCHOR_UNITS))
    rows = rows.select(*keys, "taxonomy", "concept", F.explode(known).alias("u")).select(*keys, "taxonomy", "concept", "u.key", F.posexplode("u.value").alias("pos", "e"))
    rank = F.array_position(F.array(*[F.lit(u) for u in ANCHOR_UNITS]), F.col("key"))
    value = F.when(F.col("key") == "USD", F.round(F.col("e.val") / 1e6, 1)).otherwise(F.col("e.val"))
    return rows.filter("e.val is not null").groupBy(*keys, "taxonomy", "concept", F.col("e.end").alias("end")).agg(F.min_by(value, F.struct(rank, "pos")).alias("anchor"))


def anchor_check(value: Column, anchor: Column, tolerance: float = 0.01) -> Column:
    """Passes within a hundredth, if both are zero, or where there is no anchor; null where there is no value."""
    near = F.when((value == 0) | (anchor == 0), value == anchor).otherwise(F.abs(value - anchor) / F.abs(anchor) <= tolerance)
    return F.when(value.isNotNull(), F.coalesce(near, F.lit(True)))


def _pages(spark, sf_dir):
    """A JSON text per filing: its items as entries of three concepts, in units by their flag."""
    unit = F.expr("CASE l_returnflag WHEN 'A' THEN 'USD' WHEN 'N' THEN 'CNY' ELSE 'EUR' END")
    end = F.date_format("l_shipdate", "yyyy-MM-dd")
    start = F.when(F.col("l_linenumber") == 6, "bad").when(F.col("l_linenumber") < 7, F.date_format(F.date_sub("l_shipdate", (F.col("l_quantity") * 8).cast("int")), "yyyy-MM-dd"))
    form = F.expr("CASE WHEN l_suppkey % 3 = 0 THEN '10-K' WHEN l_suppkey % 3 = 1 THEN '10-Q' ELSE '10-K/A' END")
    fp = F.expr("element_at(array('Q1', 'Q2', 'Q3', 'FY'), cast(l_partkey % 4 as int) + 1)")
    entry = F.struct(start.alias("start"), end.alias("end"), F.col("l_extendedprice").alias("val"), form.alias("form"), F.date_format(F.date_add("l_shipdate", 40), "yyyy-MM-dd").alias("filed"), F.year("l_shipdate").alias("fy"), fp.alias("fp"), F.col("l_linenumber").cast("string").alias("accn"))
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_quantity", "l_suppkey", "l_partkey", "l_extendedprice")
    items = items.repartition("l_orderkey")  # once, as plain columns; the groups below lie within a filing
    rows = items.select("l_orderkey", "l_linenumber", F.concat(F.lit("c"), F.col("l_linenumber") % 3).alias("concept"), unit.alias("unit"), entry.alias("e"))
    entries = F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "e"))), lambda x: x["e"])  # a filing has seven items at most
    rows = rows.groupBy("l_orderkey", "concept", "unit").agg(entries.alias("entries"))
    rows = rows.groupBy("l_orderkey", "concept").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("unit", "entries")))).alias("units"))
    rows = rows.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("concept", F.struct("units")))).alias("concepts"))
    return rows.select("l_orderkey", F.to_json(F.struct(F.create_map(F.lit("us-gaap"), "concepts").alias("facts"))).alias("page"))


def nested_facts(spark, sf_dir):
    return facts_scan(_pages(spark, sf_dir), "page", "l_orderkey").select("l_orderkey", "taxonomy", "concept", "unit", "start", "end", "val", "form", "filed", "fy", "fp", "accn")


def fact_dedup(spark, sf_dir):
    """One entry per filing, concept, end and form; ends are brought together by quarters, so that some meet."""
    rows = facts_scan(_pages(spark, sf_dir), "page", "l_orderkey").withColumn("end", F.concat(F.substring("end", 1, 4), F.lit("-12-31")))
    return best_entries(rows, ["l_orderkey", "concept"], ["10-K", "10-K/A", "10-Q"], ["pos"]).select("l_orderkey", "concept", "end", "base", "form", "score", "val", "accn")


def _priority():
    return F.array_position(F.array(F.lit("c2"), F.lit("c0"), F.lit("c1")), F.col("concept"))


def fallback_concepts(spark, sf_dir):
    rows = facts_scan(_pages(spark, sf_dir), "page", "l_orderkey")
    return concept_fallback(rows, ["l_orderkey"], _priority()).select("l_orderkey", "concept", "accn", "end", "val")


def merged_concepts(spark, sf_dir):
    rows = facts_scan(_pages(spark, sf_dir), "page", "l_orderkey").withColumn("end", F.substring("end", 1, 7)).dropDuplicates(["l_orderkey", "concept", "end"])
    return concept_merge(rows.select("l_orderkey", "concept", "end"), ["l_orderkey"], _priority()).select("l_orderkey", "end", "concept")


def anchor_match(spark, sf_dir):
    """Extracted values (some altered, zero or null) against the anchors of their filing, concept and end."""
    aliases = F.expr("array('sales', concat('us-gaap:c', l_linenumber % 3), 'ifrs:Revenue')")
    value = F.expr("CASE WHEN l_partkey % 11 = 0 THEN 0D WHEN l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 3 = 0 THEN l_extendedprice / 1e6 * 1.5D ELSE round(l_extendedprice / 1e6, 1) END")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", value.alias("value"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("end"), *[c.alias(n) for c, n in zip(split_concept(anchor_concept(aliases)), ("taxonomy", "concept"), strict=True)])
    out = rows.join(anchor_values(_pages(spark, sf_dir), "page", "l_orderkey"), ["l_orderkey", "taxonomy", "concept", "end"], "left")
    return out.select("l_orderkey", "l_linenumber", "concept", "value", "anchor", anchor_check(F.col("value"), F.col("anchor")).alias("passed"))


def fact_labels(spark, sf_dir):
    """Keys and names of filings and of the pages that hold them."""
    form = F.concat("form", F.when(F.col("doc_id") % 3 == 0, "/A").otherwise(""))
    f = filings(spark, sf_dir)
    padded = F.lpad(F.col("doc_id").cast("string"), 10, "0")
    accession = F.concat(padded, F.lit("-"), F.date_format("filing_date", "yy"), F.lit("-"), F.lpad(F.col("ticker").cast("string"), 6, "0"))
    cik = F.concat(F.lit("000"), F.col("ticker"))
    url = F.when(F.col("doc_id") % 4 > 0, F.concat(F.lit("https://example.org/"), F.col("doc_id"))).otherwise("restated-virtual://x")
    return f.select(
        "doc_id",
        base_form(form).alias("base"),
        L.cik(cik).alias("cik"),
        L.accession_url(F.lit("https://example.org/data"), cik, accession).alias("url"),
        L.canonical_name(F.col("filing_date"), F.col("ticker"), F.coalesce("token", F.lit("AR")), F.col("form"), F.lit("htm")).alias("name"),
        L.external_url(url).alias("external"),
        L.is_virtual(url).alias("virtual"),
    )


QUERIES = {
    "nested_facts": nested_facts,
    "fact_dedup": fact_dedup,
    "fallback_concepts": fallback_concepts,
    "merged_concepts": merged_concepts,
    "anchor_match": anchor_match,
    "fact_labels": fact_labels,
}

_ENTRIES = """e AS (SELECT l_orderkey, 'us-gaap' AS taxonomy, 'c' || (l_linenumber % 3) AS concept, CASE l_returnflag WHEN 'A' THEN 'USD' WHEN 'N' THEN 'CNY' ELSE 'EUR' END AS unit, l_linenumber,
  CASE WHEN l_linenumber = 6 THEN 'bad' WHEN l_linenumber < 7 THEN strftime(l_shipdate::DATE - (l_quantity * 8)::INT, '%Y-%m-%d') END AS start, strftime(l_shipdate, '%Y-%m-%d') AS "end", l_extendedprice AS val,
  CASE l_suppkey % 3 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q' ELSE '10-K/A' END AS form, strftime(l_shipdate + INTERVAL 40 DAY, '%Y-%m-%d') AS filed, year(l_shipdate)::INT AS fy, ['Q1', 'Q2', 'Q3', 'FY'][l_partkey % 4 + 1] AS fp, l_linenumber::VARCHAR AS accn FROM lineitem),
u AS (SELECT *, min(CASE unit WHEN 'USD' THEN 1 WHEN 'CNY' THEN 2 ELSE 3 END) OVER (PARTITION BY l_orderkey, concept) AS best FROM e),
k AS (SELECT * EXCLUDE (best) FROM u WHERE CASE unit WHEN 'USD' THEN 1 WHEN 'CNY' THEN 2 ELSE 3 END = best)"""
ORACLES = {
    "nested_facts": f"WITH {_ENTRIES} SELECT * EXCLUDE (l_linenumber) FROM k",
    "fact_dedup": f"""WITH {_ENTRIES}, b AS (SELECT l_orderkey, concept, substr("end", 1, 4) || '-12-31' AS "end", "end" AS was, start AS began, replace(form, '/A', '') AS base, form, val, accn, l_linenumber, try_cast(start AS DATE) AS s, fp FROM k),
s AS (SELECT *, CASE WHEN s IS NULL THEN 10000 WHEN base = '10-K' THEN abs(("end"::DATE - s) - 365) + CASE WHEN fp <> 'FY' THEN 50 ELSE 0 END ELSE abs(("end"::DATE - s) - 90) + CASE WHEN fp = 'FY' THEN 50 ELSE 0 END END::INT AS score FROM b)
SELECT l_orderkey, concept, "end", base, form, score, val, accn FROM s QUALIFY row_number() OVER (PARTITION BY l_orderkey, concept, "end", base ORDER BY score, l_linenumber, began NULLS FIRST, was, val, form) = 1""",
    "fallback_concepts": f"WITH {_ENTRIES}, p AS (SELECT *, list_position(['c2', 'c0', 'c1'], concept) AS pri FROM k) SELECT l_orderkey, concept, accn, \"end\", val FROM p QUALIFY pri = min(pri) OVER (PARTITION BY l_orderkey)",
    "merged_concepts": f"WITH {_ENTRIES} SELECT l_orderkey, substr(\"end\", 1, 7) AS \"end\", arg_min(concept, list_position(['c2', 'c0', 'c1'], concept)) AS concept FROM k GROUP BY 1, 2",
    "anchor_match": f"""WITH {_ENTRIES}, a AS (SELECT l_orderkey, concept, "end", arg_min(round(val / 1e6, 1), (l_linenumber, coalesce(start, ''), val)) AS anchor FROM e WHERE unit = 'USD' GROUP BY ALL),
r AS (SELECT l_orderkey, l_linenumber, 'c' || (l_linenumber % 3) AS concept, strftime(l_shipdate, '%Y-%m-%d') AS "end", CASE WHEN l_partkey % 11 = 0 THEN 0 WHEN l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 3 = 0 THEN l_extendedprice / 1e6 * 1.5::DOUBLE ELSE round(l_extendedprice / 1e6, 1) END AS value FROM lineitem)
SELECT l_orderkey, l_linenumber, r.concept, value, anchor, CASE WHEN value IS NOT NULL THEN CASE WHEN anchor IS NULL THEN true WHEN value = 0 OR anchor = 0 THEN value = anchor ELSE abs(value - anchor) / abs(anchor) <= 0.01::DOUBLE END END AS passed FROM r LEFT JOIN a USING (l_orderkey, concept, "end")""",
    "fact_labels": f"""{SQL}, x AS (SELECT *, form || CASE WHEN doc_id % 3 = 0 THEN '/A' ELSE '' END AS f, lpad(doc_id::VARCHAR, 10, '0') || strftime(filing_date, '%y') || lpad(ticker::VARCHAR, 6, '0') AS acc FROM filings)
SELECT doc_id, rtrim(f, '/A') AS base, lpad(ticker::VARCHAR, 10, '0') AS cik, 'https://example.org/data/' || ticker || '/' || acc || '/' AS url, '[' || strftime(filing_date, '%Y.%m.%d') || '][' || ticker || '][' || coalesce(token, 'AR') || '][' || form || '].htm' AS name,
  CASE WHEN doc_id % 4 > 0 THEN 'https://example.org/' || doc_id END AS external, doc_id % 4 = 0 AS virtual FROM x""",
}
