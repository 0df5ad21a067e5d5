"""Citations of facts: where a value stands, how it was found and converted, who verified it, and where to read it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import labels as L
from tallyspark.plans.views import SQL, facts

#: What a citation is made of; missing ones are null.
FIELDS = "ticker string, source string, kind string, form string, period string, filed string, section string, quote string, model string, value double, value_usd double, currency string, fx_rate double, fx_date string, verified boolean, excerpt string, url string, caution string, formula string, rationale string, explanation array<string>"
#: Fixed value: a fact that structured data gives has its concept in the quote, after this.
CONCEPT = "XBRL:"


def _text(*parts) -> Column:
    """Parts in a row; null if one is null."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def fiscal_label(period: Column, form: Column) -> Column:
    """FY and the year, with the quarter for quarterly reports; a question mark without a period."""
    quarter = F.element_at(F.create_map(*[F.lit(x) for x in ("03", " Q1", "06", " Q2", "09", " Q3")]), F.substring(period, 6, 2))
    label = _text("FY", F.substring(period, 1, 4), F.when(form == "10-Q", F.coalesce(quarter, F.lit(""))).otherwise(""))
    return F.when(F.coalesce(period, F.lit("")) == "", "?").otherwise(label)


def _amount(x: Column) -> Column:
    return F.format_number(x, 0)


def _lines(kind: Column, c: dict[str, Column]) -> list[Column]:
    """All lines that a citation of a kind (sec, hkex or derived) may have, in order; null where it hasn't."""
    said = lambda x: F.coalesce(x, F.lit("")) != ""
    known = lambda x, otherwise="?": F.coalesce(x, F.lit(otherwise))
    sec, hkex, derived = kind == "sec", kind == "hkex", kind == "derived"
    structured = F.contains(known(c["model"], ""), F.lit("xbrl"))
    concept = F.when(structured & F.startswith(known(c["quote"], ""), F.lit(CONCEPT)), F.element_at(F.split(F.btrim(F.element_at(F.split("quote", CONCEPT), 2)), " "), 1))
    concept = F.when(concept != "", concept)
    currency = known(c["currency"], "USD")
    foreign = (currency != "USD") & c["value"].isNotNull() & c["value_usd"].isNotNull()
    converted = F.when(hkex, c["value"].isNotNull() & c["value_usd"].isNotNull()).otherwise(foreign)
    money, unit = F.when(hkex, "RMB").otherwise(currency), F.when(hkex, "CNY").otherwise(currency)
    rate_date = known(F.coalesce(c["fx_date"], c["period"]))
    source = F.when(hkex, _text("Source: [", known(c["ticker"]), "] FY", known(F.substring(c["period"], 1, 4)), F.when(F.contains(known(c["form"], "HK-AR"), F.lit("AR")), " Annual Report (HKEXnews").otherwise(" Interim Report (HKEXnews"), F.when(said(c["filed"]), _text(", filed ", c["filed"])).otherwise(""), ")"))
    form = F.when(derived & F.contains(known(c["form"]), F.lit("20-F")), "20-F").otherwise(known(c["form"]))
    source = F.coalesce(source, _text("Source: [", known(c["ticker"]), "] ", fiscal_label(c["period"], c["form"]), " ", form, " (filed ", known(c["filed"]), ")"))
    own = said(c["quote"]) & (hkex | (~F.startswith(c["quote"], F.lit("XBRL")) & ~F.contains(known(c["section"], ""), c["quote"])))
    fact = _text("Line item: XBRL fact ", concept, " · period ending ", F.when(F.length("period") >= 10, c["period"]).otherwise("?"), " · ", F.when(currency == "USD", "$").otherwise(_text(currency, " ")), _amount(c["value"]), "M")
    explained = F.when(c["explanation"].isNotNull(), F.concat(F.transform("explanation", lambda x: F.concat(F.lit("  "), x)), F.when(F.contains(known(c["quote"], ""), F.lit("-")), F.array(_text("  Calculation: ", c["quote"]))).otherwise(F.array().cast("array<string>"))))
    adjusted = F.concat(F.when(said(c["formula"]), F.array(_text("  Formula: ", c["formula"]))).otherwise(F.array().cast("array<string>")), F.when(said(c["rationale"]), F.transform(F.split(F.btrim("rationale"), "\n"), lambda x: F.concat(F.lit("  "), F.btrim(x)))).otherwise(F.array().cast("array<string>")))
    reasons = F.coalesce(explained, F.when(c["formula"].isNotNull() | c["rationale"].isNotNull(), adjusted), F.when(said(c["quote"]), F.array(_text("  ", c["quote"]))), F.array().cast("array<string>"))
    sentence = F.try_element_at(F.filter(F.split(L.clean_entities(c["excerpt"]), r"(?<=[.!?])\s+"), lambda s: s.rlike("[0-9]")), F.lit(1))
    method = F.when(hkex, _text("Method: ", known(c["model"], ""))).when(structured, F.coalesce(_text("Method: XBRL companyfacts API (", concept, ")"), F.lit("Method: XBRL companyfacts API"))).when(said(c["model"]), _text("Method: ", c["model"]))
    link = F.startswith(known(c["url"], ""), F.lit("http"))
    return [
        source,
        F.when(~derived & said(c["section"]), _text("Section: ", c["section"])),
        F.when(~derived, F.when(own, _text('Line item: "', c["quote"], '"')).when(sec, fact)),
        F.when(derived, F.array_join(F.concat(F.array(F.lit("Derivation:")), reasons), "\n")),
        F.when(converted, _text("Value: ", money, " ", _amount(c["value"]), "M → $", _amount(c["value_usd"]), "M USD")).when(sec, _text("Value: $", _amount(c["value"]), "M (as reported)")),
        F.when(converted & (c["fx_rate"] != 0), _text("FX: ", unit, "/USD ", F.format_string("%.4f", c["fx_rate"]), " @ ", rate_date, " (source: ECB via frankfurter.app)")),
        F.when(hkex & said(c["caution"]), _text("\nIMPORTANT: ", c["caution"])),
        F.when(~derived, method),
        F.when(~derived & known(c["verified"], False), F.lit("Independently verified")),
        F.when(~derived, _text('Quote: "', F.substring(sentence, 1, 200), '"')),
        F.when(link, _text("\nReport: ", c["url"])),
    ]


def cite(rows: DataFrame, name: str = "citation") -> DataFrame:
    """rows with a citation of several lines, from the columns FIELDS; those that rows lacks count as null.

    A derived value tells its derivation: an explanation's lines with the calculation, else formula and rationale, else the
    quote. Values of the exchange in Hong Kong are in its currency; others name theirs, and the rate, where it isn't the dollar."""
    have = {f.strip().split(" ")[0]: f.strip().split(" ", 1)[1] for f in FIELDS.split(", ")}
    full = rows.withColumns({n: F.lit(None).cast(t) for n, t in have.items() if n not in rows.columns})
    kind = F.when(F.col("kind") == "derived", "derived").when(F.col("source") == "hkex", "hkex").otherwise("sec")
    lines = _lines(kind, {n: F.col(n) for n in have})
    return full.withColumn(name, F.array_join(F.array_compact(F.array(*lines)), "\n")).select(*rows.columns, name)


def _cited(spark, sf_dir) -> DataFrame:
    f = facts(spark, sf_dir)
    quote = F.expr("element_at(array('XBRL: us-gaap:Capex (FY)', concat('It was ', partkey), 'Notes', '', 'A - B', null), cast(partkey % 6 as int) + 1)")
    return f.select(
        "doc_id", "metric", "partkey", "suppkey", "quantity", "tax", "value", F.col("ticker").cast("string").alias("ticker"), "form", "currency", quote.alias("quote"),
        F.when(F.col("form").startswith("HK"), "hkex").otherwise("sec").alias("source"), F.when(F.col("suppkey") % 5 == 0, "derived").otherwise("direct").alias("kind"),
        F.col("period").cast("string").alias("period"), F.col("filing_date").cast("string").alias("filed"), F.when(F.col("suppkey") % 2 == 0, "Notes to the accounts").alias("section"),
        F.expr("element_at(array('xbrl-facts', 'model-x', null), cast(suppkey % 3 as int) + 1)").alias("model"), (F.col("value") * 0.25).alias("value_usd"), F.when(F.col("partkey") % 4 > 0, F.lit(0.5)).alias("fx_rate"),
        (F.col("suppkey") % 3 == 0).alias("verified"), F.concat(F.lit("Well said!&nbsp;It was&#160;"), F.col("partkey"), F.lit(" in all. End")).alias("excerpt"),
        F.when(F.col("partkey") % 3 > 0, F.concat(F.lit("https://files.example/"), F.col("doc_id"))).otherwise("/local/file").alias("url"), F.when(F.col("metric") == "m5", "This is a proxy.").alias("caution"),
        F.when(F.col("partkey") % 10 == 0, "A - B").alias("formula"), F.when(F.col("partkey") % 20 == 0, " Both are \n reported. ").alias("rationale"), F.when(F.col("suppkey") % 35 == 0, F.array(F.lit("As the notes say:"), F.lit("others."))).alias("explanation"),
    )


def citations(spark, sf_dir):
    """Facts with their citations, of all three forms."""
    return cite(_cited(spark, sf_dir)).select("doc_id", "metric", "partkey", "suppkey", "quantity", "tax", "value", F.md5("citation").alias("digest"))


QUERIES = {"citations": citations}
_N = "format('{:,}', round_even(%s, 0)::BIGINT)"
ORACLES = {
    "citations": f"""{SQL}, x AS (SELECT *, ['XBRL: us-gaap:Capex (FY)', 'It was ' || partkey, 'Notes', '', 'A - B', NULL][partkey % 6 + 1] AS quote, form LIKE 'HK%' AS hk, suppkey % 5 = 0 AS der, ['xbrl-facts', 'model-x', NULL][suppkey % 3 + 1] AS said_by, value * 0.25 AS usd, partkey % 4 > 0 AS rated, suppkey % 2 = 0 AS sec FROM facts),
l AS (SELECT *, CASE WHEN hk AND NOT der THEN 'Source: [' || ticker || '] FY' || year(period) || ' Interim Report (HKEXnews, filed ' || filing_date || ')' ELSE 'Source: [' || ticker || '] FY' || year(period) || CASE WHEN form = '10-Q' THEN CASE month(period) WHEN 3 THEN ' Q1' WHEN 6 THEN ' Q2' WHEN 9 THEN ' Q3' ELSE '' END ELSE '' END || ' ' || form || ' (filed ' || filing_date || ')' END AS l1,
  CASE WHEN NOT der AND sec THEN 'Section: Notes to the accounts' END AS l2,
  CASE WHEN der THEN NULL WHEN quote IS NULL OR quote = '' THEN NULL WHEN hk THEN 'Line item: "' || quote || '"' WHEN partkey % 6 = 0 THEN CASE WHEN suppkey % 3 = 0 THEN 'Line item: XBRL fact us-gaap:Capex · period ending ' || period || ' · ' || CASE WHEN currency = 'USD' THEN '$' ELSE currency || ' ' END || {_N % "value"} || 'M' END
    WHEN quote = 'Notes' AND sec THEN NULL ELSE 'Line item: "' || quote || '"' END AS l3,
  CASE WHEN der THEN 'Derivation:' || CASE WHEN suppkey % 35 = 0 THEN chr(10) || '  As the notes say:' || chr(10) || '  others.' || CASE WHEN contains(coalesce(quote, ''), '-') THEN chr(10) || '  Calculation: ' || quote ELSE '' END
    WHEN partkey % 10 = 0 THEN chr(10) || '  Formula: A - B' || CASE WHEN partkey % 20 = 0 THEN chr(10) || '  Both are' || chr(10) || '  reported.' ELSE '' END WHEN coalesce(quote, '') <> '' THEN chr(10) || '  ' || quote ELSE '' END END AS l4,
  CASE WHEN hk AND NOT der THEN 'RMB' WHEN currency <> 'USD' THEN currency END AS money FROM x)
SELECT doc_id, metric, partkey, suppkey, quantity, tax, value, md5(concat_ws(chr(10), l1, l2, l3, l4,
  CASE WHEN money IS NOT NULL THEN 'Value: ' || money || ' ' || {_N % "value"} || 'M → $' || {_N % "usd"} || 'M USD' WHEN NOT der THEN 'Value: $' || {_N % "value"} || 'M (as reported)' END,
  CASE WHEN money IS NOT NULL AND rated THEN 'FX: ' || CASE money WHEN 'RMB' THEN 'CNY' ELSE money END || '/USD 0.5000 @ ' || period || ' (source: ECB via frankfurter.app)' END,
  CASE WHEN hk AND NOT der AND metric = 'm5' THEN chr(10) || 'IMPORTANT: This is a proxy.' END,
  CASE WHEN der THEN NULL WHEN hk THEN 'Method: ' || coalesce(said_by, '') WHEN said_by = 'xbrl-facts' THEN CASE WHEN partkey % 6 = 0 THEN 'Method: XBRL companyfacts API (us-gaap:Capex)' ELSE 'Method: XBRL companyfacts API' END WHEN said_by IS NOT NULL THEN 'Method: ' || said_by END,
  CASE WHEN NOT der AND suppkey % 3 = 0 THEN 'Independently verified' END, CASE WHEN NOT der THEN 'Quote: "It was ' || partkey || ' in all."' END, CASE WHEN partkey % 3 > 0 THEN chr(10) || 'Report: https://files.example/' || doc_id END)) AS digest FROM l"""
}
