"""Scans of documents' surroundings: columnar indexes, exhibits, feeds, calendars, sidecars, configuration, file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.functions import labels as L
from tallyspark.plans.views import SQL, companies, filings, table

INDEX = "struct<filings:struct<recent:struct<accessionNumber:array<string>,filingDate:array<string>,reportDate:array<string>,primaryDocument:array<string>,form:array<string>>>>"
FEED = "struct<newsInfoLst:array<struct<id:bigint,stock:array<struct<sc:string>>,t2Code:string,title:string,relTime:string>>>"
#: Fields that a sidecar must have.
SIDECAR = ["ticker", "form_type", "filing_date", "period_of_report", "sha256", "source", "source_url", "accession_number", "fetched_at", "fetcher_version", "content_type"]
CALENDAR = ["symbol", "name", "reportDate", "fiscalDateEnding", "estimate", "currency"]


def submissions(pages: DataFrame, json_col: str, form: str, *keys: str, amendments: bool = False) -> DataFrame:
    """A row per filing of a form, from parallel arrays (the shortest decides), with its place: the index is newest first."""
    recent = F.from_json(json_col, INDEX)["filings"]["recent"]
    names = ["accessionNumber", "filingDate", "reportDate", "primaryDocument", "form"]
    arrays = [F.coalesce(recent[n], F.array().cast("array<string>")) for n in names]
    zipped = F.slice(F.arrays_zip(*[a.alias(n) for a, n in zip(arrays, names, strict=True)]), F.lit(1), F.least(*map(F.size, arrays)))
    rows = pages.select(*keys, F.posexplode(zipped).alias("pos", "f")).select(*keys, "pos", "f.*")
    return rows.filter(F.col("form").isin(form, f"{form}/A") if amendments else F.col("form") == form)


def exhibits(items: Column) -> Column:
    """EX-99 pages among items (name, size), by number and name: (number, name, size); a bad size is 0, no number is 1."""
    pattern = r"(?i)ex(?:hibit)?[-_ .]?99(?:[-_ .d])?([0-9]*)"

    def fits(x):
        name = F.lower(x["name"])
        return (name.endswith(".htm") | name.endswith(".html")) & ~name.endswith("-index.html") & x["name"].rlike(pattern)

    def row(x):
        number = F.regexp_extract(x["name"], pattern, 1)
        return F.struct(F.when(number == "", 1).otherwise(number.try_cast("int")).alias("number"), x["name"].alias("name"), F.coalesce(x["size"].try_cast("int"), F.lit(0)).alias("size"))

    return F.array_sort(F.transform(F.filter(items, fits), row))


def main_exhibit(found: Column, least: int = 40_000) -> Column:
    """The first exhibit that is large enough, or whose size isn't known."""
    return F.try_element_at(F.filter(found, lambda x: (x["size"] >= least) | (x["size"] == 0)), F.lit(1))


#: A field of comma-separated text, quoted or not, and a record of such fields; a quoted one may hold commas and line ends.
FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,\r\n]*+|(?!")[^,\r\n]*+|"[^,\r\n]*+)'
RECORD = rf"{FIELD}(?:,{FIELD})*+"


def csv_fields(record: Column) -> Column:
    """The fields of a record, without their quotes."""
    fields = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(rf",({FIELD})"), 1)
    inner = lambda x: F.replace(F.regexp_extract(x, r'(?s)^"(.*)"([^"]*)$', 1), F.lit('""'), F.lit('"'))
    after = lambda x: F.regexp_extract(x, r'(?s)^"(.*)"([^"]*)$', 2)
    return F.transform(fields, lambda x: F.when(x.rlike(r'(?s)^".*"[^"]*$'), F.concat(inner(x), after(x))).otherwise(x))


def calendar_rows(replies: DataFrame, text_col: str, *keys: str) -> DataFrame:
    """Rows of earnings calendars as comma-separated text with a header; an error body or an unknown header is an error.

    Fields may be quoted, with commas, line ends and doubled quotes within. Missing fields are null, empty lines are skipped."""
    text = F.ltrim(text_col)
    records = F.filter(F.regexp_extract_all(text, F.lit(RECORD), 0), lambda x: x != "")
    head = csv_fields(F.try_element_at(records, F.lit(1)))
    fault = F.when(text.startswith("{"), F.raise_error(F.concat(F.lit("an error instead of a calendar: "), F.substring(text, 1, 200))))
    fault = fault.when(~F.forall(F.array(*[F.lit(x) for x in ("symbol", "reportDate", "fiscalDateEnding")]), lambda n: F.coalesce(F.array_contains(head, n), F.lit(False))), F.raise_error(F.lit("no earnings-calendar header")))
    rows = replies.select(*keys, F.coalesce(fault.cast("array<string>"), records).alias("records"))
    rows = rows.select(*keys, csv_fields(F.col("records")[0]).alias("head"), F.explode(F.slice("records", F.lit(2), F.size("records"))).alias("record"))
    rows = rows.withColumn("fields", csv_fields(F.col("record")))
    at = lambda n: F.try_element_at("fields", F.array_position("head", n).cast("int"))
    return rows.select(*keys, *[F.when(F.array_contains("head", n), at(n)).alias(n) for n in CALENDAR])


def first_in_feed(pages: DataFrame, json_col: str, page: str, kind: Column, *keys: str) -> DataFrame:
    """For each stock code of a feed (keys) the first item of its pages, in their order, whose category contains `kind`."""
    rows = pages.select(*keys, page, F.posexplode(F.from_json(json_col, FEED)["newsInfoLst"]).alias("pos", "item"))
    rows = rows.filter(F.contains(F.coalesce("item.t2Code", F.lit("")), kind))
    rows = rows.withColumn("code", F.explode(F.array_distinct(F.transform("item.stock", lambda s: s["sc"]))))
    return rows.groupBy(*keys, "code").agg(F.min_by(F.struct("item.id", "item.title", "item.relTime"), F.struct(page, "pos")).alias("item")).select(*keys, "code", "item.*")


def cached_rates(asked: DataFrame, cache: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(asked with rate and where it came from, cache). asked: pair, rate_date; cache: the same with rate; source: also asked_date.

    What the cache lacks comes from the source, which may know only an earlier day; it is stored under both days."""
    got = asked.join(cache.select("pair", "rate_date", F.col("rate").alias("__hit")), ["pair", "rate_date"], "left")
    src = source.select("pair", F.col("asked_date").alias("rate_date"), F.col("rate_date").alias("actual"), F.col("rate").alias("__rate"))
    got = got.join(src, ["pair", "rate_date"], "left").withColumn("rate", F.coalesce("__hit", "__rate"))
    new = got.filter("__hit is null and __rate is not null")
    both = new.select("pair", "rate_date", "rate").unionByName(new.select("pair", F.col("actual").alias("rate_date"), "rate")).distinct()
    merged = cache.unionByName(both.join(cache, ["pair", "rate_date"], "left_anti"))
    return got.select("pair", "rate_date", "rate", F.col("__hit").isNotNull().alias("cached")), merged


def sidecars(texts: DataFrame, json_col: str, firms: DataFrame) -> DataFrame:
    """Sidecar texts with all their fields and the company's year end; `missing` names those that a text lacks."""
    said = F.from_json(json_col, "map<string,string>")
    out = texts.withColumn("__m", said)
    missing = F.array_compact(F.array(*[F.when(F.coalesce(F.col("__m")[n], F.lit("")) == "", F.lit(n)) for n in SIDECAR]))
    out = out.withColumn("missing", missing).select(*texts.columns, "missing", *[F.col("__m")[n].alias(n) for n in SIDECAR])
    return out.join(F.broadcast(firms) if firms.count() <= 100_000 else firms, "ticker", "left")


def config_rows(config: DataFrame, json_col: str) -> DataFrame:
    """Coverage configuration as rows (dataset, metric, ticker, excluded, treatment, segment_names). Entries are a ticker or an
    object; exclusions are tickers."""
    kind = "map<string,struct<metric:string,companies_included:array<string>,companies_excluded:array<string>>>"
    rows = config.select(F.explode(F.from_json(json_col, kind)).alias("dataset", "d"))
    body = "struct<ticker:string,treatment:string,segment_names:array<string>>"

    def entry(x):
        o = F.from_json(x, body)
        plain = ~x.startswith("{")
        return F.struct(F.when(plain, x).otherwise(o["ticker"]).alias("ticker"), F.when(~plain, o["treatment"]).alias("treatment"), F.when(~plain, o["segment_names"]).alias("segment_names"), F.lit(False).alias("excluded"))

    def gone(x):
        return F.struct(x.alias("ticker"), F.lit(None).cast("string").alias("treatment"), F.lit(None).cast("array<string>").alias("segment_names"), F.lit(True).alias("excluded"))

    none = F.array().cast("array<string>")
    entries = F.concat(F.transform(F.coalesce("d.companies_included", none), entry), F.transform(F.coalesce("d.companies_excluded", none), gone))
    return rows.select("dataset", "d.metric", F.explode(entries).alias("e")).select("dataset", "metric", "e.*")


def filing_name(path: Column) -> Column:
    """(filed, ticker, token) of a quarterly page's canonical name, else null."""
    pattern = r"\[(\d{4}\.\d{2}\.\d{2})\]\[(\w+)\]\[(Q[1-3])\]\[10-Q\]\.htm$"
    part = lambda k: F.regexp_extract(path, pattern, k)
    return F.when(path.rlike(pattern), F.struct(F.try_to_date(part(1), "yyyy.MM.dd").alias("filed"), part(2).alias("ticker"), part(3).alias("token")))


def workbook_name(name: Column, stem: str = "sourcebook") -> Column:
    """(time, version) of a workbook's name, without a suffix version 1; else null."""
    pattern = rf"^\[(\d{{4}})\.(\d{{2}})\.(\d{{2}}) - (\d{{2}})[h:](\d{{2}})\] {stem}(?: v(\d+))?\.xlsx$"
    p = [F.regexp_extract(name, pattern, k) for k in range(1, 7)]
    time = F.try_to_timestamp(F.concat(p[0], F.lit("-"), p[1], F.lit("-"), p[2], F.lit(" "), p[3], F.lit(":"), p[4]), F.lit("yyyy-MM-dd HH:mm"))
    return F.when(name.rlike(pattern), F.struct(time.alias("time"), F.when(p[5] == "", 1).otherwise(p[5].try_cast("int")).alias("version")))


def literal(spark: SparkSession, values: dict, key: str, value: str) -> DataFrame:
    """A hand-kept table."""
    return spark.createDataFrame(sorted(values.items()), f"{key} int, {value} double")


def _index(spark, sf_dir):
    """A company's filings as parallel arrays, newest first (a test company has some ten a table scale)."""
    f = filings(spark, sf_dir).withColumn("form", F.when(F.col("doc_id") % 5 == 0, F.concat("form", F.lit("/A"))).otherwise(F.col("form")))
    row = F.struct((-F.unix_date("filing_date")).alias("k"), "doc_id", F.concat(F.lit("a-"), "doc_id").alias("accessionNumber"), F.col("filing_date").cast("string").alias("filingDate"), F.col("period").cast("string").alias("reportDate"), F.lit("x.htm").alias("primaryDocument"), "form")
    rows = f.groupBy("ticker").agg(F.sort_array(F.collect_list(row)).alias("r"))
    recent = F.struct(*[F.col(f"r.{n}").alias(n) for n in ("accessionNumber", "filingDate", "reportDate", "primaryDocument", "form")])
    return rows.select("ticker", F.to_json(F.struct(F.struct(recent.alias("recent")).alias("filings"))).alias("page"))


def submissions_scan(spark, sf_dir):
    return submissions(_index(spark, sf_dir), "page", "10-K", "ticker", amendments=True).select("ticker", "pos", "accessionNumber", "filingDate", "form")


def exhibit_index(spark, sf_dir):
    items = F.expr("""array(named_struct('name', concat('ex99-', o_orderkey % 4, '.htm'), 'size', cast(o_totalprice as bigint) || ''), named_struct('name', 'exhibit99.HTML', 'size', 'n/a'),
      named_struct('name', concat('EX-99d', o_orderkey % 13, '-index.html'), 'size', '1'), named_struct('name', 'logo.jpg', 'size', '2'), named_struct('name', 'ex10.htm', 'size', '3'))""")
    out = table(spark, sf_dir, "orders").select("o_orderkey", exhibits(items).alias("e"))
    text = F.array_join(F.transform("e", lambda x: F.concat_ws(":", x["number"], x["name"], x["size"])), "|")
    return out.select("o_orderkey", text.alias("exhibits"), main_exhibit(F.col("e"), 100_000)["name"].alias("main"))


def calendar_feed(spark, sf_dir):
    """A reply per company, with its columns in one of two orders."""
    c = companies(spark, sf_dir)
    a = F.concat(F.lit("symbol,name,reportDate,fiscalDateEnding,estimate,currency\n"), "ticker", F.lit(',"Foo, ""the"" Corp",1997-05-0'), F.col("ticker") % 9 + 1, F.lit(",1997-03-31,,"), "currency", F.lit("\n"), "ticker", F.lit(",Foo,1997-08-01,1997-06-30,1.5,\n"))
    b = F.concat(F.lit('reportDate,symbol,"fiscalDateEnding"\r\n\r\n1998-01-02,'), "ticker", F.lit(",1997-12-31\r\n"))
    return calendar_rows(c.select(F.when(F.col("ticker") % 3 > 0, a).otherwise(b).alias("text")), "text")


def feed_pages(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders as feed items, twenty companies a feed, a hundred items a page, newest first; and what each company's code is."""
    o = table(spark, sf_dir, "orders").withColumn("n", F.row_number().over(Window.partitionBy(F.floor(F.col("o_custkey") / 20)).orderBy(F.desc("o_orderkey"))) - 1)
    item = F.struct("n", F.struct(F.col("o_orderkey").alias("id"), F.array(F.struct(F.lit("x").alias("sc")), F.struct(L.padded(F.col("o_custkey").cast("string"), 5).alias("sc"))).alias("stock"), F.when(F.col("o_orderstatus") == "F", "40000,40100").otherwise("40300").alias("t2Code"), F.concat(F.lit("Report 20"), F.lpad(F.col("o_orderkey") % 30, 2, "0")).alias("title"), F.date_format("o_orderdate", "dd/MM/yyyy HH:mm").alias("relTime")).alias("i"))
    pages = o.groupBy(F.floor(F.col("o_custkey") / 20).alias("feed"), F.floor(F.col("n") / 100).alias("page")).agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["i"]).alias("newsInfoLst"))
    pages = pages.select("feed", "page", F.to_json(F.struct("newsInfoLst")).alias("text"))
    asked = companies(spark, sf_dir).select("ticker", F.floor(F.col("ticker") / 20).alias("feed"), L.padded(F.col("ticker").cast("string"), 5).alias("code"))
    return pages, asked


def paged_feed(spark, sf_dir):
    """The first annual report of each company in its feed."""
    pages, asked = feed_pages(spark, sf_dir)
    out = asked.join(first_in_feed(pages, "text", "page", F.lit("40100"), "feed"), ["feed", "code"])
    filed = L.feed_date(F.col("relTime"))
    return out.select("ticker", "id", filed.alias("filed"), *[L.feed_period(F.col("title"), filed, F.lit(f)).alias(n) for f, n in (("HK-AR", "annual"), ("HK-IR", "interim"))])


def rate_cache(spark, sf_dir):
    """Rates of periods asked for; a part is cached, the source answers most of the rest with the day before."""
    f = filings(spark, sf_dir).select(F.concat("currency", F.lit("USD")).alias("pair"), F.col("period").alias("rate_date")).distinct()
    rate = F.round(F.month("rate_date") / 10 + F.length("pair"), 4)
    cache = f.filter("month(rate_date) = 3").withColumn("rate", rate)
    source = f.filter("month(rate_date) <> 12").select("pair", F.col("rate_date").alias("asked_date"), F.date_sub("rate_date", 1).alias("rate_date"), rate.alias("rate"))
    got, merged = cached_rates(f, cache, source)
    return got.select("pair", "rate_date", "rate", F.when(F.col("cached"), "cache").otherwise("source").alias("origin")).unionByName(merged.select("pair", "rate_date", "rate", F.lit("stored").alias("origin")))


def sidecar_sweep(spark, sf_dir):
    f = filings(spark, sf_dir)
    fields = {n: F.lit("x") for n in SIDECAR} | {"ticker": F.col("ticker").cast("string"), "sha256": F.when(F.col("doc_id") % 4 > 0, F.lit("ab")), "source_url": F.when(F.col("doc_id") % 3 > 0, "u").otherwise("")}
    texts = f.select("doc_id", F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("text"))
    firms = companies(spark, sf_dir).select(F.col("ticker").cast("string").alias("ticker"), "fye")
    return sidecars(texts, "text", firms).select("doc_id", "ticker", "fye", F.array_join("missing", ",").alias("missing"))


CONFIG = '{"cloud": {"metric": "m5", "companies_included": ["1", {"ticker": "2", "treatment": "named_segment", "segment_names": ["Cloud", "AI"]}, {"ticker": "3", "treatment": "whole_company"}], "companies_excluded": ["4", "5"]}, "spending": {"metric": "m3", "companies_included": ["1", "2"]}}'


def coverage_config(spark, sf_dir):
    """Configuration joined with the companies' names."""
    rows = config_rows(spark.createDataFrame([(CONFIG,)], "text string"), "text")
    names = companies(spark, sf_dir).select(F.col("ticker").cast("string").alias("ticker"), "name")
    return F.broadcast(rows).join(names, "ticker").select("dataset", "metric", "ticker", "name", "excluded", "treatment", F.array_join("segment_names", ",").alias("segments"))


def file_names(spark, sf_dir):
    f = filings(spark, sf_dir)
    path = L.canonical_name(F.col("filing_date"), F.concat(F.lit("T"), "ticker"), F.coalesce("token", F.lit("Q4")), F.col("form"), F.lit("htm"))
    return f.select("doc_id", filing_name(path).alias("n")).select("doc_id", "n.filed", F.col("n.ticker").alias("ticker"), "n.token")


def newest_workbook(spark, sf_dir):
    """A company's newest workbook by time and version, not by name."""
    f = filings(spark, sf_dir)
    name = F.concat(F.lit("["), F.date_format(F.trunc("filing_date", "year"), "yyyy.MM.dd"), F.lit(" - 09h30] sourcebook"), F.when(F.col("doc_id") % 12 > 1, F.concat(F.lit(" v"), F.col("doc_id") % 12)).otherwise(""), F.lit(".xlsx"))
    named_ = f.select("ticker", name.alias("name"), workbook_name(name).alias("k")).filter("k is not null")
    return named_.groupBy("ticker").agg(F.max_by("name", "k").alias("name"))


#: A hand-kept table of yearly rates.
KEPT = {1995: 0.12, 1996: 0.15, 1997: 0.2}


def kept_values(spark, sf_dir):
    rows = literal(spark, KEPT, "fy", "rate")
    return filings(spark, sf_dir).select("doc_id", F.col("fy").cast("int").alias("fy")).join(F.broadcast(rows), "fy").select("doc_id", "fy", "rate")


QUERIES = {
    "submissions_scan": submissions_scan,
    "exhibit_index": exhibit_index,
    "calendar_feed": calendar_feed,
    "paged_feed": paged_feed,
    "rate_cache": rate_cache,
    "sidecar_sweep": sidecar_sweep,
    "coverage_config": coverage_config,
    "file_names": file_names,
    "newest_workbook": newest_workbook,
    "kept_values": kept_values,
}
ORACLES = {
    "submissions_scan": f"""{SQL}, f AS (SELECT ticker, doc_id, filing_date, form || CASE WHEN doc_id % 5 = 0 THEN '/A' ELSE '' END AS form FROM filings), n AS (SELECT *, (row_number() OVER (PARTITION BY ticker ORDER BY filing_date DESC, doc_id) - 1)::INT AS pos FROM f)
SELECT ticker, pos, 'a-' || doc_id AS "accessionNumber", filing_date::VARCHAR AS "filingDate", form FROM n WHERE form IN ('10-K', '10-K/A')""",
    "exhibit_index": """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '0:ex99-0.htm:' || trunc(o_totalprice)::BIGINT || '|1:exhibit99.HTML:0' WHEN o_orderkey % 4 = 1 THEN '1:ex99-1.htm:' || trunc(o_totalprice)::BIGINT || '|1:exhibit99.HTML:0'
  ELSE '1:exhibit99.HTML:0|' || (o_orderkey % 4) || ':ex99-' || (o_orderkey % 4) || '.htm:' || trunc(o_totalprice)::BIGINT END AS exhibits, CASE WHEN o_orderkey % 4 < 2 AND trunc(o_totalprice) >= 100000 THEN 'ex99-' || (o_orderkey % 4) || '.htm' ELSE 'exhibit99.HTML' END AS main FROM orders""",
    "calendar_feed": f"""{SQL} SELECT ticker::VARCHAR AS symbol, 'Foo, "the" Corp' AS name, '1997-05-0' || (ticker % 9 + 1) AS "reportDate", '1997-03-31' AS "fiscalDateEnding", '' AS estimate, currency FROM companies WHERE ticker % 3 > 0
UNION ALL SELECT ticker::VARCHAR, 'Foo', '1997-08-01', '1997-06-30', '1.5', '' FROM companies WHERE ticker % 3 > 0 UNION ALL SELECT ticker::VARCHAR, NULL, '1998-01-02', '1997-12-31', NULL, NULL FROM companies WHERE ticker % 3 = 0""",
    "paged_feed": """WITH a AS (SELECT o_custkey AS ticker, max(o_orderkey) AS id FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) SELECT ticker, id, o_orderdate::DATE AS filed,
  make_date(CASE WHEN id % 30 BETWEEN 10 AND 29 THEN 2000 + id % 30 ELSE year(o_orderdate) - 1 END, 12, 31) AS annual, make_date(CASE WHEN id % 30 BETWEEN 10 AND 29 THEN 2000 + id % 30 ELSE year(o_orderdate) END, 6, 30) AS interim FROM a JOIN orders ON o_orderkey = id""",
    "rate_cache": f"""{SQL}, f AS (SELECT DISTINCT currency || 'USD' AS pair, period AS rate_date, month(period) AS m FROM filings), r AS (SELECT *, round(m / 10 + length(pair), 4) AS rate FROM f)
SELECT pair, rate_date, CASE WHEN m <> 12 THEN rate END AS rate, CASE WHEN m = 3 THEN 'cache' ELSE 'source' END AS origin FROM r UNION ALL SELECT pair, rate_date, rate, 'stored' FROM r WHERE m <> 12 UNION ALL SELECT pair, rate_date - 1, rate, 'stored' FROM r WHERE m NOT IN (3, 12)""",
    "sidecar_sweep": f"{SQL} SELECT doc_id, ticker::VARCHAR AS ticker, fye, concat_ws(',', CASE WHEN doc_id % 4 = 0 THEN 'sha256' END, CASE WHEN doc_id % 3 = 0 THEN 'source_url' END) AS missing FROM filings",
    "coverage_config": f"""{SQL}, k AS (SELECT * FROM (VALUES ('cloud', 'm5', 1, false, NULL, NULL), ('cloud', 'm5', 2, false, 'named_segment', 'Cloud,AI'), ('cloud', 'm5', 3, false, 'whole_company', NULL), ('cloud', 'm5', 4, true, NULL, NULL), ('cloud', 'm5', 5, true, NULL, NULL), ('spending', 'm3', 1, false, NULL, NULL), ('spending', 'm3', 2, false, NULL, NULL)) v(dataset, metric, ticker, excluded, treatment, segments))
SELECT dataset, metric, ticker::VARCHAR AS ticker, name, excluded, treatment, segments FROM k JOIN companies USING (ticker)""",
    "file_names": f"{SQL} SELECT doc_id, CASE WHEN form = '10-Q' AND token IN ('Q1', 'Q2', 'Q3') THEN filing_date END AS filed, CASE WHEN form = '10-Q' AND token IN ('Q1', 'Q2', 'Q3') THEN 'T' || ticker END AS ticker, CASE WHEN form = '10-Q' AND token IN ('Q1', 'Q2', 'Q3') THEN token END AS token FROM filings",
    "newest_workbook": f"{SQL}, w AS (SELECT ticker, year(filing_date) AS y, greatest(doc_id % 12, 1) AS v FROM filings), m AS (SELECT ticker, max((y, v)) AS k FROM w GROUP BY ticker) SELECT ticker, '[' || k[1] || '.01.01 - 09h30] sourcebook' || CASE WHEN k[2] > 1 THEN ' v' || k[2] ELSE '' END || '.xlsx' AS name FROM m",
    "kept_values": f"{SQL} SELECT doc_id, fy::INT AS fy, CASE fy WHEN 1995 THEN 0.12 WHEN 1996 THEN 0.15 ELSE 0.2 END::DOUBLE AS rate FROM filings WHERE fy BETWEEN 1995 AND 1997",
}
