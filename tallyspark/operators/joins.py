"""Joins beyond equality: as of a date, nearest date, windows of days, positions, wildcards, priorities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions import periods as P
from tallyspark.plans.shared import sent
from tallyspark.plans.views import CURRENCIES, SQL, companies, facts, filings, table


#: Months for which values hold that are broadcast at most.
MOST_HELD = 200_000


def asof(left: DataFrame, right: DataFrame, key: str, date: str, right_date: str, value: str) -> DataFrame:
    """left with the value of the latest row of right (one per key and date) on or before the date, or null.

    Each row of right holds until the next one. It is repeated for the months in which it holds, so that the join is an
    equality of key and month with a filter that at most one row fits; left rows, repeated ones too, stay as they are. Of
    right rows of one key and date the largest value counts. A
    right side of counted size is broadcast, so that left isn't shuffled; a larger one is spread over keys and months.
    """
    end = F.lead(right_date).over(Window.partitionBy(key).orderBy(right_date, value))
    last = left.agg(F.max(date)).first()[0]
    held = right.select(F.col(key).alias("__key"), F.col(right_date).alias("__from"), end.alias("__to"), F.col(value))
    held = held.filter("__to is null or __to > __from").withColumn("__until", F.coalesce(F.date_sub("__to", 1), F.greatest(F.lit(last).cast("date"), "__from")))
    month = F.explode(F.sequence(F.trunc("__from", "month"), F.trunc("__until", "month"), F.expr("interval 1 month")))
    held = held.withColumn("__month", month)
    held = sent(held, MOST_HELD)
    fits = (F.col(key) == F.col("__key")) & (F.trunc(date, "month") == F.col("__month")) & F.col(date).between(F.col("__from"), F.col("__until"))
    return left.join(held, fits, "left").select(*left.columns, value)


def in_window(left: DataFrame, right: DataFrame, key: str, date: str, right_date: str, lo: int, hi: int) -> DataFrame:
    """Pairs of one key whose right date is lo to hi days after the left one.

    Rows of right are repeated for the months of the left dates that they may meet; left rows are in one month each. So pairs
    meet once, and a key with many rows is spread over its months.
    """
    first, last = F.date_sub(right_date, hi), F.date_sub(right_date, lo)
    month = F.explode(F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month")))
    hit = left.withColumn("__month", F.trunc(date, "month")).join(right.withColumn("__month", month), [key, "__month"])
    return hit.filter(F.date_diff(right_date, date).between(lo, hi)).drop("__month")


def nearest(left: DataFrame, right: DataFrame, key: str, date: str, right_date: str, right_id: str, days: int) -> DataFrame:
    """left (id column first) with the right row nearest in time within so many days; the earlier date, then lower id on ties."""
    id_ = left.columns[0]
    r = right.select(key, F.col(right_date).alias("__d"), F.col(right_id).alias("__id"))
    gap = F.abs(F.date_diff(F.col("__d"), F.col(date)))
    hit = in_window(left, r, key, date, "__d", -days, days).groupBy(id_).agg(F.min_by(F.struct(F.col("__id").alias("match"), gap.alias("gap")), F.struct(gap, "__d", "__id")).alias("__m"))
    return left.join(hit.select(id_, "__m.match", "__m.gap"), id_, "left")


def priority_merge(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """The union of two event sets; where both have a key the first one's row stands."""
    both = first.withColumn("__p", F.lit(0)).unionByName(second.withColumn("__p", F.lit(1)))
    w = Window.partitionBy(*keys).orderBy("__p", *[c for c in first.columns if c not in keys])
    return both.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n", "__p")


def zip_join(left: DataFrame, right: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """The n-th row of left with the n-th of right in each key; left rows without a partner have a null."""
    w = Window.partitionBy(*keys).orderBy(order)
    a = left.withColumn("pos", F.row_number().over(w)).select(*keys, "pos", F.col(value).alias("a"))
    b = right.withColumn("pos", F.row_number().over(w)).select(*keys, "pos", F.col(value).alias("b"))
    return a.join(b, [*keys, "pos"], "left")


def rates(spark, sf_dir) -> DataFrame:
    """A rate per currency and odd month from 1994 on, by formula."""
    n = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("i"), F.element_at(F.array(*[F.lit(c) for c in CURRENCIES]), F.col("r_regionkey") + 1).alias("currency"))
    months = n.withColumn("rate_date", F.explode(F.sequence(F.lit("1995-03-01").cast("date"), F.lit("2001-12-01").cast("date"), F.expr("interval 2 months"))))
    rate = F.when(F.col("currency") == "USD", 1.0).otherwise(0.5 + ((F.col("i") * 7 + F.month("rate_date") + F.year("rate_date")) % 10) / 20.0)
    return months.select("currency", "rate_date", rate.alias("rate"))


RATES = f"""rates AS (SELECT {CURRENCIES}[r_regionkey + 1] AS currency, d::DATE AS rate_date, CASE WHEN r_regionkey = 0 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE + ((r_regionkey * 7 + month(d) + year(d)) % 10) / 20.0::DOUBLE END AS rate
  FROM region, (SELECT unnest(generate_series(TIMESTAMP '1995-03-01', TIMESTAMP '2001-12-01', INTERVAL 2 MONTH)) AS d))"""


def fx_asof(spark, sf_dir):
    docs = filings(spark, sf_dir).select("doc_id", "currency", "filing_date")
    return asof(docs, rates(spark, sf_dir), "currency", "filing_date", "rate_date", "rate")


def fx_normalise(spark, sf_dir):
    """Values in USD: those in USD as they are, others by the rate of the period, rounded; without a rate null."""
    rows = facts(spark, sf_dir).select("doc_id", "metric", "partkey", "suppkey", "quantity", "tax", "currency", "value", F.trunc("period", "month").alias("rate_date"))
    out = rows.join(sent(rates(spark, sf_dir)), ["currency", "rate_date"], "left")
    usd = F.when(F.col("currency") == "USD", F.col("value")).otherwise(F.round(F.col("value") * F.col("rate"), 4))
    return out.select("doc_id", "metric", "partkey", "suppkey", "quantity", "tax", "currency", "rate", usd.alias("usd"))


def nearest_within_days(spark, sf_dir):
    docs = filings(spark, sf_dir)
    left = docs.filter("form = '6-K'").select("doc_id", "ticker", "filing_date")
    out = nearest(left, docs.filter(F.col("form").isin(*P.ANNUAL_FORMS)), "ticker", "filing_date", "filing_date", "doc_id", 60)
    return out.select("doc_id", "match", F.col("gap").cast("long").alias("gap"))


def window_match(spark, sf_dir):
    """Each release's newest quarterly report filed within ten days of it."""
    docs = filings(spark, sf_dir)
    left = docs.filter("form = '6-K'").select("doc_id", "ticker", F.col("filing_date").alias("at"))
    right = docs.filter("form = '10-Q'").select("ticker", F.col("doc_id").alias("match"), "filing_date")
    hit = in_window(left, right, "ticker", "at", "filing_date", -10, 10)
    return hit.groupBy("doc_id").agg(F.max_by("match", F.struct("filing_date", "match")).alias("match"))


def release_candidates(spark, sf_dir):
    """For each annual report, all releases filed 7 to 120 days after its period, ranked: closest to its filing date first."""
    docs = filings(spark, sf_dir)
    left = docs.filter("token = 'AR'").select("doc_id", "ticker", "period", F.col("filing_date").alias("announced"))
    right = docs.filter("form = '6-K'").select("ticker", F.col("doc_id").alias("release"), "filing_date")
    hit = in_window(left, right, "ticker", "period", "filing_date", 7, 120)
    w = Window.partitionBy("doc_id").orderBy(F.abs(F.date_diff("filing_date", "announced")), "release")
    return hit.withColumn("rank", F.row_number().over(w).cast("long")).select("doc_id", "release", "rank")


def calendar_merge(spark, sf_dir):
    """Calendar entries (status F or O) and filings as one event list, where the calendar wins."""
    docs = filings(spark, sf_dir)
    cols = ["ticker", "period", "at", "status"]
    calendar = docs.filter("status <> 'P'").groupBy("ticker", "period").agg(F.max("filing_date").alias("at"), F.max("status").alias("status")).select(*cols)
    filed = docs.groupBy("ticker", "period").agg(F.min("filing_date").alias("at")).withColumn("status", F.lit("filed")).select(*cols)
    return priority_merge(calendar, filed, ["ticker", "period"])


def exists_semi(spark, sf_dir):
    """Companies that have filed an annual report in the fiscal year of some quarterly one."""
    docs = filings(spark, sf_dir)
    annual = docs.filter("token = 'AR'").select("ticker", "fy").distinct()
    return docs.filter("form = '10-Q'").select("ticker", "fy").distinct().join(annual, ["ticker", "fy"], "left_semi")


def unverified_anti(spark, sf_dir):
    """Documents without a label of good quality."""
    good = table(spark, sf_dir, "labels").filter("quality = 1")
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(good, "doc_id", "left_anti")


def multi_key_match(spark, sf_dir):
    """For each event, the lowest filing with the same number as id, company or document: a union of equality joins."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id")
    docs = filings(spark, sf_dir).select("doc_id", "ticker")
    by_company = e.join(docs.groupBy(F.col("ticker").alias("user_id")).agg(F.min("doc_id").alias("m")), "user_id").select("event_id", "m")
    by_event = e.join(docs, e["event_id"] == docs["doc_id"]).select("event_id", F.col("doc_id").alias("m"))
    by_user = e.join(docs, e["user_id"] == docs["doc_id"]).select("event_id", F.col("doc_id").alias("m"))
    return by_company.unionByName(by_event).unionByName(by_user).groupBy("event_id").agg(F.min("m").alias("doc_id"))


def subscriber_match(spark, sf_dir):
    """Subscribers (suppliers: all companies, or those of their nation) and the filings of a day that they get."""
    day = F.to_date(F.lit("1998-06-15"))
    docs = filings(spark, sf_dir).filter(F.col("filing_date").between(F.date_sub(day, 5), day)).join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ticker"), F.col("c_nationkey").alias("nation")), "ticker")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 10 == 0, F.array(F.lit(-1))).otherwise(F.array("s_nationkey")).alias("wanted"))
    # A wildcard becomes one row per nation, so that the match is an equality.
    every = table(spark, sf_dir, "nation").agg(F.collect_set("n_nationkey").alias("all"))
    s = s.join(F.broadcast(every)).select("s_suppkey", F.explode(F.when(F.array_contains("wanted", -1), F.col("all")).otherwise(F.col("wanted"))).alias("nation"))
    return docs.join(s, "nation").select("s_suppkey", "doc_id")


def note_scope_match(spark, sf_dir):
    """Notes with wildcards and year ranges, matched with filings: parts that may be null are compared only where set."""
    notes = spark.createDataFrame([(1, None, 1997, 1998, None), (2, 7, None, None, None), (3, None, 1999, None, "10-K"), (4, 12, 1996, 2000, "6-K")], "note long, ticker long, y0 int, y1 int, form string")
    d, n = filings(spark, sf_dir).alias("d"), F.broadcast(notes.alias("n"))  # a handful of hand-written notes
    fits = (F.col("n.ticker").isNull() | (F.col("n.ticker") == F.col("d.ticker"))) & (F.col("n.y0").isNull() | (F.col("d.fy") >= F.col("n.y0"))) & (F.col("n.y1").isNull() | (F.col("d.fy") <= F.col("n.y1"))) & (F.col("n.form").isNull() | (F.col("n.form") == F.col("d.form")))
    return d.join(n, fits).groupBy("n.note").agg(F.count("*").alias("filings"), F.min("d.doc_id").alias("first"))


def alias_resolve(spark, sf_dir):
    """Phrases against names and aliases: exact name, then equal alias, then a part of either; the first in table order."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pos"), F.lower("p_name").alias("key"), F.array(F.lower("p_type"), F.lower("p_brand")).alias("aliases"))
    phrases = spark.createDataFrame([("Red Widget",), ("brand#17",), ("economy",), ("ring",), ("nothing",)], "phrase string").withColumn("p", F.lower("phrase"))
    # The phrases are a handful of rows, whatever the catalogue; each task keeps one best row per phrase.
    tier = F.when(F.col("key") == F.col("p"), 0).when(F.array_contains("aliases", F.col("p")), 1).when(F.contains("key", F.col("p")) | F.exists("aliases", lambda a: F.contains(a, F.col("p"))), 2)
    hit = parts.join(F.broadcast(phrases), tier.isNotNull()).groupBy("phrase").agg(F.min_by("pos", F.struct(tier, "pos")).alias("pos"))
    return phrases.select("phrase").join(hit, "phrase", "left")


def latest_per_parent(spark, sf_dir):
    """Companies with their number of filings and the latest one."""
    docs = filings(spark, sf_dir).groupBy("ticker").agg(F.count("*").alias("n"), F.max_by("doc_id", F.struct("filing_date", "doc_id")).alias("latest"))
    return companies(spark, sf_dir).select("ticker", "name").join(docs, "ticker", "left").select("ticker", "name", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "latest")


def verify_pairs(spark, sf_dir):
    """The n-th user turn of a conversation with its n-th answer: lengths compared."""
    t = table(spark, sf_dir, "conversations").withColumn("size", F.length("text").cast("double"))
    out = zip_join(t.filter("role = 'user'"), t.filter("role = 'assistant'"), ["conv_id"], "turn", "size")
    # Every seventh answer can't be determined; like a missing one it is not found and goes to review, as a mismatch does.
    said = F.when((F.col("conv_id") + F.col("pos")) % 7 > 0, F.col("b"))
    verdict = compare_values(F.col("a"), said)
    return out.select("conv_id", F.col("pos").cast("long").alias("pos"), verdict.alias("verdict"), verdict.isin("mismatch", "not_found").alias("needs_review"))


def compare_values(a, b):
    """exact (under 0.1 %), approximate (under 5 %), mismatch, or not_found where a value is missing; two zeros are exact."""
    diff = F.try_divide(F.abs(a - b), F.greatest(F.abs(a), F.abs(b)))
    return F.when(a.isNull() | b.isNull(), "not_found").when((a == 0) & (b == 0), "exact").when(diff < 0.001, "exact").when(diff < 0.05, "approximate").otherwise("mismatch")


QUERIES = {
    "fx_asof": fx_asof,
    "fx_normalise": fx_normalise,
    "nearest_within_days": nearest_within_days,
    "window_match": window_match,
    "release_candidates": release_candidates,
    "calendar_merge": calendar_merge,
    "exists_semi": exists_semi,
    "unverified_anti": unverified_anti,
    "multi_key_match": multi_key_match,
    "subscriber_match": subscriber_match,
    "note_scope_match": note_scope_match,
    "alias_resolve": alias_resolve,
    "latest_per_parent": latest_per_parent,
    "verify_pairs": verify_pairs,
}
ORACLES = {
    "fx_asof": f"{SQL}, {RATES} SELECT doc_id, currency, filing_date, (SELECT arg_max(rate, rate_date) FROM rates r WHERE r.currency = f.currency AND r.rate_date <= f.filing_date) AS rate FROM filings f",
    "fx_normalise": f"{SQL}, {RATES} SELECT doc_id, metric, partkey, suppkey, quantity, tax, f.currency, rate, CASE WHEN f.currency = 'USD' THEN value ELSE round((value * rate)::DECIMAL(28,10), 4)::DOUBLE END AS usd FROM facts f LEFT JOIN rates r ON r.currency = f.currency AND r.rate_date = date_trunc('month', period)",
    "nearest_within_days": f"""{SQL}, h AS (SELECT l.doc_id, arg_min(r.doc_id, (abs(r.filing_date - l.filing_date), r.filing_date, r.doc_id)) AS match, min(abs(r.filing_date - l.filing_date)) AS gap
FROM filings l JOIN filings r ON r.ticker = l.ticker AND r.form IN ('10-K', '20-F') AND abs(r.filing_date - l.filing_date) <= 60 WHERE l.form = '6-K' GROUP BY l.doc_id) SELECT f.doc_id, match, gap FROM filings f LEFT JOIN h USING (doc_id) WHERE form = '6-K'""",
    "window_match": f"{SQL} SELECT l.doc_id, arg_max(r.doc_id, (r.filing_date, r.doc_id)) AS match FROM filings l JOIN filings r ON r.ticker = l.ticker AND r.form = '10-Q' AND abs(r.filing_date - l.filing_date) <= 10 WHERE l.form = '6-K' GROUP BY l.doc_id",
    "release_candidates": f"{SQL} SELECT l.doc_id, r.doc_id AS release, row_number() OVER (PARTITION BY l.doc_id ORDER BY abs(r.filing_date - l.filing_date), r.doc_id) AS rank FROM filings l JOIN filings r ON r.ticker = l.ticker AND r.form = '6-K' AND r.filing_date - l.period BETWEEN 7 AND 120 WHERE l.token = 'AR'",
    "calendar_merge": f"""{SQL}, c AS (SELECT ticker, period, max(filing_date) AS at_, max(status) AS status FROM filings WHERE status <> 'P' GROUP BY ALL), f AS (SELECT ticker, period, min(filing_date) AS at_ FROM filings GROUP BY ALL)
SELECT ticker, period, coalesce(c.at_, f.at_) AS at, coalesce(c.status, 'filed') AS status FROM f LEFT JOIN c USING (ticker, period)""",
    "exists_semi": f"{SQL} SELECT DISTINCT ticker, fy FROM filings q WHERE form = '10-Q' AND EXISTS (SELECT 1 FROM filings a WHERE a.token = 'AR' AND a.ticker = q.ticker AND a.fy = q.fy)",
    "unverified_anti": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)",
    "multi_key_match": f"{SQL}, m AS (SELECT event_id, doc_id FROM events JOIN filings ON ticker = user_id UNION ALL SELECT event_id, doc_id FROM events JOIN filings ON doc_id = event_id UNION ALL SELECT event_id, doc_id FROM events JOIN filings ON doc_id = user_id) SELECT event_id, min(doc_id) AS doc_id FROM m GROUP BY event_id",
    "subscriber_match": f"{SQL} SELECT s_suppkey, doc_id FROM filings JOIN customer ON c_custkey = ticker JOIN supplier ON s_suppkey % 10 = 0 OR s_nationkey = c_nationkey WHERE filing_date BETWEEN DATE '1998-06-10' AND DATE '1998-06-15'",
    "note_scope_match": f"{SQL}, n AS (SELECT * FROM (VALUES (1::BIGINT, NULL, 1997, 1998, NULL), (2, 7, NULL, NULL, NULL), (3, NULL, 1999, NULL, '10-K'), (4, 12, 1996, 2000, '6-K')) t(note, ticker, y0, y1, form)) SELECT note, count(*) AS filings, min(doc_id) AS first FROM n JOIN filings d ON (n.ticker IS NULL OR n.ticker = d.ticker) AND (y0 IS NULL OR fy >= y0) AND (y1 IS NULL OR fy <= y1) AND (n.form IS NULL OR n.form = d.form) GROUP BY note",
    "alias_resolve": """WITH p AS (SELECT p_partkey AS pos, lower(p_name) AS key, [lower(p_type), lower(p_brand)] AS aliases FROM part), q AS (SELECT unnest(['Red Widget', 'brand#17', 'economy', 'ring', 'nothing']) AS phrase),
h AS (SELECT phrase, pos, CASE WHEN key = lower(phrase) THEN 0 WHEN list_contains(aliases, lower(phrase)) THEN 1 WHEN contains(key, lower(phrase)) OR contains(aliases[1], lower(phrase)) OR contains(aliases[2], lower(phrase)) THEN 2 END AS tier FROM q, p)
SELECT phrase, arg_min(pos, (tier, pos)) FILTER (tier IS NOT NULL) AS pos FROM h GROUP BY phrase""",
    "latest_per_parent": f"{SQL} SELECT c.ticker, c.name, count(f.doc_id) AS n, arg_max(f.doc_id, (f.filing_date, f.doc_id)) AS latest FROM companies c LEFT JOIN filings f USING (ticker) GROUP BY ALL",
    "verify_pairs": """WITH t AS (SELECT conv_id, role, length(text)::DOUBLE AS s, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS pos FROM conversations WHERE role IN ('user', 'assistant')),
p AS (SELECT a.conv_id, a.pos, a.s AS x, CASE WHEN (a.conv_id + a.pos) % 7 > 0 THEN b.s END AS y FROM t a LEFT JOIN t b ON b.conv_id = a.conv_id AND b.pos = a.pos AND b.role = 'assistant' WHERE a.role = 'user'),
v AS (SELECT conv_id, pos, CASE WHEN x IS NULL OR y IS NULL THEN 'not_found' WHEN x = 0 AND y = 0 THEN 'exact' WHEN abs(x - y) / greatest(x, y) < 0.001 THEN 'exact' WHEN abs(x - y) / greatest(x, y) < 0.05 THEN 'approximate' ELSE 'mismatch' END AS verdict FROM p)
SELECT *, verdict IN ('mismatch', 'not_found') AS needs_review FROM v""",
}
