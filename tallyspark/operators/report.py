"""Views, labels and report data: evidence, clusters, contexts, treatments, routing, formats, and sinks as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions import labels as L
from tallyspark.functions import periods as P
from tallyspark.functions import text as T
from tallyspark.functions.numbers import exact_sum, rounded
from tallyspark.operators.audit import AUDITED, CELL, _audited, _flagged
from tallyspark.operators.winners import AUDIT, audit
from tallyspark.plans.shared import fresh_folder, sent
from tallyspark.plans.views import SQL, companies, facts, filings, table

#: Plausible ranges in millions, metrics of the statements, and the order of companies in displays.
RANGES = {"capital_expenditures": (0, 200_000), "revenue": (0, 700_000), "operating_cash_flow": (-50_000, 250_000), "depreciation_amortization": (0, 100_000), "property_plant_equipment_net": (0, 500_000), "cloud_segment_revenue": (0, 200_000)}
HEADLINE = ["capital_expenditures", "revenue", "operating_cash_flow", "depreciation_amortization", "property_plant_equipment_net"]
NAMES = {f"m{i}": m for i, m in enumerate(RANGES, 1)}


def plausible(metric: Column, value: Column) -> Column:
    """Whether a value lies in its metric's range; null for other metrics and without a value."""
    return F.coalesce(*[F.when(metric == m, value.between(lo, hi)) for m, (lo, hi) in RANGES.items()])


def extraction_chain(metric: Column, approach: Column, treatment: Column, form: Column) -> Column:
    """The extractors to try, in order: facts before the model for statements and whole companies, segments where they are
    named and facts are the main source, else the model; none for an unknown company. Of a 6-K only the model remains."""
    chain = lambda *names: F.array(*map(F.lit, names))
    segment = F.when(treatment == "whole_company", chain("facts", "model")).when(treatment.isin("named_segment", "named_segment_fuzzy") & (approach == "xbrl_primary"), chain("segment", "model"))
    known = F.when(metric.isin(*HEADLINE), chain("facts", "model")).when(metric == "cloud_segment_revenue", F.coalesce(segment, chain("model"))).otherwise(chain("model"))
    known = F.when(form == "6-K", F.filter(known, lambda x: x == "model")).otherwise(known)
    return F.when(approach.isNull(), F.array().cast("array<string>")).otherwise(known)


def filtered(df: DataFrame, ticker=None, metric: str | None = None, years: tuple[int, int] | None = None) -> DataFrame:
    """df with those filters that are given."""
    for given, at in ((ticker, "ticker"), (metric, "metric")):
        df = df if given is None else df.filter(F.col(at) == given)
    return df if years is None else df.filter(F.col("fy").between(*years))


def evidence_of(evidence: DataFrame, ids: DataFrame, key: str, role: str | None = None) -> DataFrame:
    """The excerpts of some facts, of one role if it is given."""
    rows = evidence.join(ids.select(key).distinct(), key, "left_semi")
    return rows if role is None else rows.filter(F.col("role") == role)


def first_excerpt(evidence: DataFrame, key: str, order: list[str]) -> DataFrame:
    """(key, excerpt): the first by order."""
    return evidence.groupBy(key).agg(F.min_by("excerpt", F.struct(*order)).alias("excerpt"))


def filing_context(asked: DataFrame, docs: DataFrame) -> DataFrame:
    """The document of each request: by its id, else the latest filing of its company and period."""
    latest = docs.groupBy("ticker", "period").agg(F.max_by("doc_id", F.struct("filing_date", "doc_id")).alias("__latest"))
    known = docs.select(F.col("doc_id").alias("asked_id"), F.col("doc_id").alias("__known")).distinct()
    out = asked.join(known, "asked_id", "left").join(latest, ["ticker", "period"], "left")
    return out.withColumn("doc_id", F.coalesce("__known", "__latest")).drop("__known", "__latest")


def with_context(flagged: DataFrame, evidence: DataFrame, notes: DataFrame, treatments: DataFrame) -> DataFrame:
    """Clusters of flagged cells by company and metric, each with its members, their first excerpt, notes and treatment."""
    rows = flagged.join(first_excerpt(evidence, "doc_id", ["pos"]), "doc_id", "left")
    rows = rows.groupBy("ticker", "metric").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("fy", "period_type", "doc_id", F.md5("excerpt").alias("excerpt")))).alias("members"))
    said = notes.groupBy("ticker").agg(F.sort_array(F.collect_list("note")).alias("notes"))
    return rows.join(said, "ticker", "left").join(sent(treatments), "metric", "left")


def treatments_view(config: DataFrame, notes: DataFrame, feedback: DataFrame) -> DataFrame:
    """Configuration with its notes, and each note's first feedback."""
    first = feedback.groupBy("note").agg(F.min_by("said", F.struct("seq")).alias("feedback"))
    return config.join(notes, "ticker", "left").join(first, "note", "left")


def pivot_columns(*pivots: DataFrame, label: str = "label") -> DataFrame:
    """The labels of all pivots, each once."""
    out = pivots[0].select(label)
    for p in pivots[1:]:
        out = out.unionByName(p.select(label))
    return out.distinct()


def display_order(df: DataFrame, key: str, order: list) -> DataFrame:
    """df with `place`: that of the key in a fixed list, others after it."""
    at = F.array_position(F.array(*map(F.lit, order)), F.col(key))
    return df.withColumn("place", F.when(at > 0, at).otherwise(len(order) + 1))


def write_sidecar(cells: DataFrame, path: str) -> None:
    """Cells as JSON, a file for each task; read_sidecar() reads them again."""
    cells.write.mode("overwrite").json(path)


def read_sidecar(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("header", True).csv(path)


def flagged_fragments(flagged: DataFrame) -> DataFrame:
    """A line of Markdown for each flagged cell, with its first three failures."""
    failed = F.array_join(F.slice("failed", 1, 3), ", ")
    line = F.concat(F.lit("- **"), F.col("ticker"), F.lit("** "), F.col("metric"), F.lit(" FY"), F.col("fy"), F.lit(" "), F.col("period_type"), F.lit(": "), failed, F.when(F.size("failed") > 3, F.concat(F.lit(" and "), F.size("failed") - 3, F.lit(" more"))).otherwise(""))
    return flagged.select(*CELL, line.alias("line"))


def publish_diff(now: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """(key, action): what is to be uploaded or deleted, by content and headers."""
    sign = lambda d, n: d.select(key, F.md5(F.concat_ws("|", F.md5("content"), "headers")).alias(n))
    both = sign(now, "__a").join(sign(stored, "__b"), key, "full_outer")
    action = F.when(F.col("__a").isNull(), "delete").when(F.col("__b").isNull() | (F.col("__a") != F.col("__b")), "upload")
    return both.select(key, action.alias("action")).filter("action is not null")


def _named(spark, sf_dir):
    return audit(facts(spark, sf_dir)).withColumn("name", F.coalesce(F.create_map(*[F.lit(x) for p in NAMES.items() for x in p])[F.col("metric")], F.lit("other")))


def range_plausibility(spark, sf_dir):
    value = (F.col("value_usd") - 20_000) * F.when(F.col("suppkey") % 5 == 0, 20).otherwise(1)
    return _named(spark, sf_dir).select(*CELL, plausible(F.col("name"), value).alias("passed"))


def chains(spark, sf_dir):
    approach = F.expr("element_at(array('xbrl_primary', 'llm_primary', null), cast(ticker % 3 as int) + 1)")
    treatment = F.expr("element_at(array('whole_company', 'named_segment', 'named_segment_fuzzy', 'derived_subtraction', null), cast(ticker % 5 as int) + 1)")
    form = F.when(F.col("ticker") % 4 == 0, "6-K").otherwise("10-K")
    return _named(spark, sf_dir).select("ticker", "name").distinct().select("ticker", "name", F.array_join(extraction_chain(F.col("name"), approach, treatment, form), ">").alias("chain"))


def filtered_facts(spark, sf_dir):
    return filtered(audit(facts(spark, sf_dir)), metric="m2", years=(1995, 1997)).select(*CELL, (F.col("value_usd") / 1000).alias("billions"))


def _evidence(spark, sf_dir):
    """Items as excerpts of their filings."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("pos"), F.when(F.col("l_partkey") % 2 == 0, "primary_value").otherwise("supporting").alias("role"), F.col("l_partkey").cast("string").alias("excerpt"))


def evidence_rows(spark, sf_dir):
    return evidence_of(_evidence(spark, sf_dir), filings(spark, sf_dir).filter("form = '20-F'"), "doc_id", "primary_value").select("doc_id", "pos", "excerpt")


def evidence_quote(spark, sf_dir):
    """A filing's first excerpt, or none."""
    quotes = first_excerpt(_evidence(spark, sf_dir).filter("role = 'primary_value'"), "doc_id", ["pos", "excerpt"])
    return filings(spark, sf_dir).select("doc_id").join(quotes, "doc_id", "left")


def contexts(spark, sf_dir):
    f = filings(spark, sf_dir)
    asked = f.select(F.col("doc_id").alias("request"), F.when(F.col("doc_id") % 3 == 0, -1).otherwise(F.col("doc_id")).alias("asked_id"), "ticker", F.when(F.col("doc_id") % 2 == 0, F.col("period")).otherwise(F.add_months("period", 600)).alias("period"))
    return filing_context(asked, f).select("request", "doc_id")


def cluster_context(spark, sf_dir):
    flagged = _flagged(spark, sf_dir)
    notes = companies(spark, sf_dir).filter("ticker % 3 = 0").select("ticker", F.concat(F.lit("see "), "currency").alias("note"))
    treatments = spark.createDataFrame([("m1", "whole"), ("m5", "segment")], "metric string, treatment string")
    out = with_context(flagged, _evidence(spark, sf_dir).withColumn("pos", F.struct("pos", "excerpt")), notes, treatments)
    return out.select("ticker", "metric", "n", F.array_join(F.transform("members", lambda m: F.concat_ws(":", m["fy"], m["period_type"], m["doc_id"], m["excerpt"])), ",").alias("members"), F.array_join("notes", ",").alias("notes"), "treatment")


def treatments(spark, sf_dir):
    c = companies(spark, sf_dir)
    config = c.select("ticker", "currency")
    notes = c.filter("ticker % 2 = 0").select("ticker", F.concat(F.lit("n"), F.col("ticker") % 20).alias("note"))
    feedback = table(spark, sf_dir, "events").select(F.concat(F.lit("n"), F.col("event_id") % 40).alias("note"), F.col("event_id").alias("seq"), F.col("event_type").alias("said"))
    return treatments_view(config, notes, feedback).select("ticker", "currency", "note", "feedback")


def label_union(spark, sf_dir):
    a = audit(facts(spark, sf_dir))
    annual = a.filter("period_type = 'FY'").select(F.concat(F.lit("FY"), "fy").alias("label"))
    return pivot_columns(annual, a.filter("period_type like 'Q%'").select(P.calendar_label(F.col("period")).alias("label")))


def ordered_display(spark, sf_dir):
    return display_order(companies(spark, sf_dir), "currency", ["HKD", "USD", "CNY"]).select("ticker", F.col("place").cast("long").alias("place"))


def recent_listing(spark, sf_dir):
    """The newest hundred filings: the limit is the listing's."""
    return filings(spark, sf_dir).orderBy(F.desc("doc_id")).limit(100).select("doc_id", "form")


def value_labels(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.floor("l_extendedprice") / F.when(F.col("l_suppkey") % 2 == 0, 100).otherwise(1)).alias("v"), (F.col("l_partkey") % 61 - 30).alias("p"))
    days = (F.col("l_partkey") % 7 - 3).cast("int")
    quote = F.concat(F.lit("&amp; a&#38;b&#x1F;  c "), "l_partkey")
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "v", L.money(F.floor("v").cast("double")).alias("money"), L.short_money(F.floor("v").cast("double")).alias("short"), L.signed_pct(F.col("p").cast("double")).alias("pct"), L.countdown(days).alias("countdown"), L.clean_entities(quote).alias("clean"))


def list_operations(spark, sf_dir):
    """Words of part names: each once, the first two, and the largest number of a text."""
    p = table(spark, sf_dir, "part")
    words = F.array_distinct(F.concat(F.split("p_name", " "), F.split(F.lower("p_type"), " "), F.split("p_name", " ")))
    numbers = F.array_max(F.transform(F.regexp_extract_all(F.concat("p_brand", F.lit(" "), "p_size"), F.lit("[0-9]+"), 0), lambda x: x.cast("long")))
    return p.select("p_partkey", F.array_join(words, ",").alias("words"), F.array_join(F.slice(words, 1, 2), ",").alias("two"), numbers.alias("largest"))


def shares(spark, sf_dir):
    """Each company's share of its metric's total, in hundredths to three places."""
    t = audit(facts(spark, sf_dir)).groupBy("metric", "ticker").agg(exact_sum(F.col("value_usd")).alias("v"))
    all_ = t.groupBy("metric").agg(F.sum("v").alias("all"))
    return t.join(sent(all_), "metric").select("metric", "ticker", L.pct_of(F.col("v").cast("double"), F.col("all").cast("double")).alias("pct"))


def limit_resets(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    said = F.expr("element_at(array(concat('limit reached|17', lpad(event_id, 8, '0')), 'resets 7:10pm (UTC)', 'resets 9am (UTC)', 'nothing', concat('resets Oct ', event_id % 28 + 1, ', 11pm (UTC)'), 'resets Jan 2 at 3am (Nowhere)'), cast(event_id % 6 as int) + 1)")
    now = F.lit("2024-12-28 12:30:00").cast("timestamp")
    return e.select("event_id", T.reset_time(said, now).alias("at"))


def json_blocks(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    said = F.concat(F.lit("so } "), F.when(F.col("event_id") % 3 > 0, F.concat(F.lit('{"a": {"b": "}{"}, "n": '), "event_id", F.lit("}"))).otherwise("{ open "), F.lit(" then {x}"))
    return e.select("event_id", L.balanced_json(said).alias("block"))


def period_rules(spark, sf_dir):
    """What a filing's dates say by the rules that have no other query."""
    f = filings(spark, sf_dir)
    basis = F.expr("element_at(array(3, 6, 9, 12, 5), cast(doc_id % 5 as int) + 1)")
    days = (F.col("doc_id") % 400).cast("int")
    six, by_six = F.col("form") == "6-K", F.col("doc_id") % 2 == 0
    return f.select(
        "doc_id",
        P.calendar_event(F.col("period"), F.col("fye")).alias("event"),
        P.type_from_basis(basis, F.col("period"), F.col("fye")).alias("basis_type"),
        P.type_from_duration(days, F.coalesce("token", F.lit("")), F.col("period"), F.col("fye")).alias("duration_type"),
        P.year_end(F.col("fy").cast("int"), F.col("fye")).alias("year_end"),
        P.expected_form(F.col("period"), F.col("fye"), six, by_six).alias("expected"),
        P.cadence_forms(F.col("form")).alias("cadence"),
        P.period_of_filing_month(F.col("filing_date")).alias("filed_for"),
        P.march_quarter(F.col("filing_date")).alias("march"),
        P.token_error(F.col("form"), F.col("period"), F.col("fye")).alias("error"),
    )


def report_sidecar(spark, sf_dir):
    """Flagged cells written as JSON and read again."""
    cells = _flagged(spark, sf_dir).select(*CELL, "class", "failed")
    at = fresh_folder(spark, "report")
    write_sidecar(cells, at)
    return read_sidecar(spark, at, cells.schema).select(*CELL, "class", F.array_join("failed", ";").alias("failed"))


def action_log(spark, sf_dir):
    """Two batches of actions appended to a log, read again."""
    f = filings(spark, sf_dir).select("doc_id", F.col("form").alias("action"))
    at = fresh_folder(spark, "log")
    for part in (0, 1):
        append_log(f.filter(F.col("doc_id") % 2 == part), at)
    return spark.read.schema(f.schema).option("header", True).csv(at)


def report_lines(spark, sf_dir):
    return flagged_fragments(_flagged(spark, sf_dir))


def report_matrix(spark, sf_dir):
    """The report's matrix as Markdown rows by metric: cells of each class and the share that is good."""
    rows = _audited(spark, sf_dir)
    n = lambda c: F.count_if(F.col("class") == c)
    good = F.round(F.count_if(F.col("class").isin("verified", "derived")) * 100 / F.count("*"), 1)
    line = F.concat(F.lit("| "), F.col("metric"), *[F.concat(F.lit(" | "), n(c)) for c in ("verified", "derived", "flagged", "gap_fixable", "gap_unfixable")], F.lit(" | "), good, F.lit("% |"))
    return rows.groupBy("metric").agg(line.alias("line"))


def publish_plan(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    page = lambda d, v: d.select("o_orderkey", v.alias("content"), F.lit("text/html").alias("headers"))
    now = page(o.filter("o_orderkey % 7 > 0"), F.col("o_totalprice").cast("string"))
    stored = page(o.filter("o_orderkey % 5 > 0"), F.when(F.col("o_orderkey") % 3 == 0, F.lit("old")).otherwise(F.col("o_totalprice").cast("string")))
    return publish_diff(now, stored, "o_orderkey")


QUERIES = {
    "range_plausibility": range_plausibility,
    "extraction_chains": chains,
    "filtered_facts": filtered_facts,
    "evidence_rows": evidence_rows,
    "evidence_quote": evidence_quote,
    "filing_contexts": contexts,
    "cluster_context": cluster_context,
    "treatments_view": treatments,
    "label_union": label_union,
    "ordered_display": ordered_display,
    "recent_listing": recent_listing,
    "value_labels": value_labels,
    "list_operations": list_operations,
    "metric_shares": shares,
    "limit_resets": limit_resets,
    "json_blocks": json_blocks,
    "period_rules": period_rules,
    "report_sidecar": report_sidecar,
    "action_log": action_log,
    "report_lines": report_lines,
    "report_matrix": report_matrix,
    "publish_plan": publish_plan,
}
_won = f"{SQL}, won AS ({AUDIT})"
_ev = "ev AS (SELECT l_orderkey AS doc_id, l_linenumber AS pos, CASE WHEN l_partkey % 2 = 0 THEN 'primary_value' ELSE 'supporting' END AS role, l_partkey::VARCHAR AS excerpt FROM lineitem)"
ORACLES = {
    "range_plausibility": f"""{_won}, x AS (SELECT *, (value_usd - 20000) * CASE WHEN suppkey % 5 = 0 THEN 20 ELSE 1 END AS x FROM won)
SELECT ticker, fy, metric, period_type, CASE metric WHEN 'm1' THEN x BETWEEN 0 AND 200000 WHEN 'm2' THEN x BETWEEN 0 AND 700000 WHEN 'm3' THEN x BETWEEN -50000 AND 250000 WHEN 'm4' THEN x BETWEEN 0 AND 100000 WHEN 'm5' THEN x BETWEEN 0 AND 500000 WHEN 'm6' THEN x BETWEEN 0 AND 200000 END AS passed FROM x""",
    "extraction_chains": f"""{_won}, d AS (SELECT DISTINCT ticker, metric FROM won) SELECT ticker, CASE metric WHEN 'm1' THEN 'capital_expenditures' WHEN 'm2' THEN 'revenue' WHEN 'm3' THEN 'operating_cash_flow' WHEN 'm4' THEN 'depreciation_amortization' WHEN 'm5' THEN 'property_plant_equipment_net' WHEN 'm6' THEN 'cloud_segment_revenue' ELSE 'other' END AS name,
  CASE WHEN ticker % 3 = 2 THEN '' WHEN ticker % 4 = 0 THEN 'model' WHEN metric IN ('m1', 'm2', 'm3', 'm4', 'm5') THEN 'facts>model' WHEN metric = 'm6' AND ticker % 5 = 0 THEN 'facts>model' WHEN metric = 'm6' AND ticker % 5 IN (1, 2) AND ticker % 3 = 0 THEN 'segment>model' ELSE 'model' END AS chain FROM d""",
    "filtered_facts": f"{_won} SELECT ticker, fy, metric, period_type, value_usd / 1000 AS billions FROM won WHERE metric = 'm2' AND fy BETWEEN 1995 AND 1997",
    "evidence_rows": f"{SQL}, {_ev} SELECT doc_id, pos, excerpt FROM ev WHERE role = 'primary_value' AND doc_id IN (SELECT doc_id FROM filings WHERE form = '20-F')",
    "evidence_quote": f"{SQL}, {_ev} SELECT f.doc_id, arg_min(excerpt, (pos, excerpt)) AS excerpt FROM filings f LEFT JOIN ev ON ev.doc_id = f.doc_id AND role = 'primary_value' GROUP BY f.doc_id",
    "filing_contexts": f"{SQL}, l AS (SELECT ticker, period, arg_max(doc_id, (filing_date, doc_id)) AS latest FROM filings GROUP BY ALL) SELECT doc_id AS request, CASE WHEN doc_id % 3 > 0 THEN doc_id WHEN doc_id % 2 = 0 THEN latest END AS doc_id FROM filings JOIN l USING (ticker, period)",
    "cluster_context": f"""{AUDITED}, {_ev}, q AS (SELECT doc_id, arg_min(excerpt, (pos, excerpt)) AS excerpt FROM ev GROUP BY doc_id)
SELECT ticker, metric, count(*) AS n, string_agg(fy || ':' || period_type || ':' || doc_id || ':' || md5(excerpt), ',' ORDER BY fy, period_type) AS members, CASE WHEN ticker % 3 = 0 THEN 'see ' || max(currency) END AS notes, CASE metric WHEN 'm1' THEN 'whole' WHEN 'm5' THEN 'segment' END AS treatment
FROM audited JOIN q USING (doc_id) JOIN companies USING (ticker) WHERE class = 'flagged' GROUP BY ticker, metric""",
    "treatments_view": f"""{SQL}, f AS (SELECT 'n' || (event_id % 40) AS note, arg_min(event_type, event_id) AS feedback FROM events GROUP BY 1)
SELECT ticker, currency, n.note, feedback FROM (SELECT *, CASE WHEN ticker % 2 = 0 THEN 'n' || (ticker % 20) END AS note FROM companies) n LEFT JOIN f ON f.note = n.note""",
    "label_union": f"{_won} SELECT DISTINCT CASE WHEN period_type = 'FY' THEN 'FY' || fy ELSE year(period) || 'Q' || quarter(period) END AS label FROM won WHERE period_type = 'FY' OR period_type LIKE 'Q%'",
    "ordered_display": f"{SQL} SELECT ticker, CASE currency WHEN 'HKD' THEN 1 WHEN 'USD' THEN 2 WHEN 'CNY' THEN 3 ELSE 4 END::BIGINT AS place FROM companies",
    "recent_listing": f"{SQL} SELECT doc_id, form FROM filings ORDER BY doc_id DESC LIMIT 100",
    "value_labels": """WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, floor(l_extendedprice) / CASE WHEN l_suppkey % 2 = 0 THEN 100 ELSE 1 END AS v, l_partkey % 61 - 30 AS p, l_partkey % 7 - 3 AS d FROM lineitem), y AS (SELECT *, floor(v)::BIGINT AS w FROM x)
SELECT l_orderkey, l_linenumber, l_partkey, v, '$' || CASE WHEN w >= 1000 THEN format('{:,}', w) || 'M' ELSE w || '.0M' END AS money, '$' || CASE WHEN w >= 1000 THEN format('{:.1f}', w / 1000) || 'B' ELSE w || 'M' END AS short,
  '(' || CASE WHEN p >= 0 THEN '+' ELSE '' END || p || '.0%)' AS pct, ['3 days ago', '2 days ago', 'yesterday', 'today', 'tomorrow', 'in 2 days', 'in 3 days'][d + 4] AS countdown, 'a b c ' || l_partkey AS clean FROM y""",
    "list_operations": """WITH w AS (SELECT p_partkey, string_split(p_name, ' ') || string_split(lower(p_type), ' ') AS w, regexp_extract(p_brand, '[0-9]+')::BIGINT AS b, p_size FROM part), u AS (SELECT p_partkey, word, min(i) AS i FROM (SELECT p_partkey, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w) GROUP BY ALL),
g AS (SELECT p_partkey, list(word ORDER BY i) AS words FROM u GROUP BY p_partkey) SELECT p_partkey, array_to_string(words, ',') AS words, array_to_string(words[1:2], ',') AS two, greatest(b, p_size)::BIGINT AS largest FROM g JOIN w USING (p_partkey)""",
    "metric_shares": f"{_won}, t AS (SELECT metric, ticker, sum(value_usd::DECIMAL(24,6)) AS v FROM won GROUP BY ALL) SELECT metric, ticker, round(v::DOUBLE / (sum(v) OVER (PARTITION BY metric))::DOUBLE * 100, 3) AS pct FROM t",
    "limit_resets": """SELECT event_id, CASE event_id % 6 WHEN 0 THEN make_timestamp(('17' || lpad(event_id::VARCHAR, 8, '0'))::BIGINT * 1000000) WHEN 1 THEN TIMESTAMP '2024-12-28 19:10:00' WHEN 2 THEN TIMESTAMP '2024-12-29 09:00:00' WHEN 4 THEN make_timestamp(2025, 10, event_id % 28 + 1, 23, 0, 0) WHEN 5 THEN TIMESTAMP '2025-01-02 03:00:00' END AS at FROM events""",
    "json_blocks": """SELECT event_id, CASE WHEN event_id % 3 > 0 THEN '{"a": {"b": "}{"}, "n": ' || event_id || '}' END AS block FROM events""",
    "period_rules": f"""{SQL}, q AS (SELECT *, 'Q' || ((mi + 2) // 3) AS q FROM filings) SELECT doc_id, CASE WHEN month(period) = fye THEN 'FY' ELSE 'Q' || ((mi - 1) // 3 + 1) END AS event, [q, 'H1', '9M', 'FY', NULL][doc_id % 5 + 1] AS basis_type,
  CASE WHEN doc_id % 400 <= 100 THEN q WHEN doc_id % 400 BETWEEN 150 AND 200 THEN 'H1' WHEN doc_id % 400 BETWEEN 250 AND 290 THEN '9M' WHEN doc_id % 400 >= 350 THEN NULL ELSE coalesce(token, '') END AS duration_type, make_date(fy, fye, [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][fye]) AS year_end,
  CASE WHEN form = '6-K' THEN CASE WHEN month(period) = fye AND doc_id % 2 > 0 THEN '20-F' ELSE '6-K' END WHEN month(period) = fye THEN '10-K' ELSE '10-Q' END AS expected, CASE form WHEN '20-F' THEN '6-K' WHEN 'HK-AR' THEN 'HK-IR' ELSE '10-Q' END AS cadence,
  CASE WHEN month(filing_date) IN (2, 3) THEN (year(filing_date) - 1) || 'Q4' WHEN month(filing_date) IN (4, 5) THEN year(filing_date) || 'Q1' WHEN month(filing_date) IN (7, 8) THEN year(filing_date) || 'Q2' WHEN month(filing_date) IN (10, 11) THEN year(filing_date) || 'Q3' END AS filed_for,
  'Q' || ((month(filing_date) + 8) % 12 // 3 + 1) AS march, CASE WHEN form = '10-Q' AND mi > 9 THEN '10-Q on the fiscal year end' END AS error FROM q""",
    "report_sidecar": f"{AUDITED} SELECT ticker, fy, metric, period_type, class, failed FROM audited WHERE class = 'flagged'",
    "action_log": f"{SQL} SELECT doc_id, form AS action FROM filings",
    "report_lines": f"""{AUDITED}, l AS (SELECT *, string_split(failed, ';') AS f FROM audited WHERE class = 'flagged') SELECT ticker, fy, metric, period_type, '- **' || ticker || '** ' || metric || ' FY' || fy || ' ' || period_type || ': ' || array_to_string(f[1:3], ', ') || CASE WHEN len(f) > 3 THEN ' and ' || (len(f) - 3) || ' more' ELSE '' END AS line FROM l""",
    "report_matrix": f"""{AUDITED}, m AS (SELECT metric, count(*) AS n, {", ".join(f"count(*) FILTER (class = '{c}') AS {c}" for c in ("verified", "derived", "flagged", "gap_fixable", "gap_unfixable"))} FROM audited GROUP BY metric)
SELECT metric, '| ' || metric || ' | ' || verified || ' | ' || derived || ' | ' || flagged || ' | ' || gap_fixable || ' | ' || gap_unfixable || ' | ' || round((verified + derived) * 100 / n, 1) || '% |' AS line FROM m""",
    "publish_plan": "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'delete' ELSE 'upload' END AS action FROM orders WHERE (o_orderkey % 7 = 0 AND o_orderkey % 5 > 0) OR (o_orderkey % 7 > 0 AND (o_orderkey % 5 = 0 OR o_orderkey % 3 = 0))",
}
