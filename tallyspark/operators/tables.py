"""Table maintenance and summaries: upserts, differences, retention, histograms, pivots and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions import periods as P
from tallyspark.operators.winners import ANNUAL, chart_annual
from tallyspark.plans.views import SQL, facts, filings, named, table


def upsert(old: DataFrame, new: DataFrame, keys: list[str], force: bool = True) -> DataFrame:
    """old and new rows with one row per key: new ones replace old ones (force) or only fill in what is missing."""
    if force:
        return old.join(new.select(*keys), keys, "left_anti").unionByName(new)
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti").select(*old.columns))


def upsert_guarded(old: DataFrame, new: DataFrame, keys: list[str], guard) -> DataFrame:
    """Old rows are replaced only where the guard, a condition on old columns, holds."""
    locked = old.filter(~F.coalesce(guard, F.lit(False)))
    open_ = old.filter(F.coalesce(guard, F.lit(False)))
    fresh = new.join(locked.select(*keys), keys, "left_anti").select(*old.columns)
    return locked.unionByName(open_.join(new.select(*keys), keys, "left_anti")).unionByName(fresh)


def upsert_first(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; in each column the old value stands unless it is null."""
    rest = [c for c in old.columns if c not in keys]
    n = new.select(*keys, *[F.col(c).alias(f"__{c}") for c in rest])
    return old.join(n, keys, "full_outer").select(*keys, *[F.coalesce(c, f"__{c}").alias(c) for c in rest])


def manifest_diff(local: DataFrame, remote: DataFrame, key: str, sign: str) -> DataFrame:
    """added, removed, changed or same for each item of either side; null signatures are equal to each other."""
    a, b = local.select(key, F.col(sign).alias("__a"), F.lit(True).alias("__l")), remote.select(key, F.col(sign).alias("__b"), F.lit(True).alias("__r"))
    state = F.when(F.col("__r").isNull(), "added").when(F.col("__l").isNull(), "removed").when(F.col("__a").eqNullSafe(F.col("__b")), "same").otherwise("changed")
    return a.join(b, key, "full_outer").select(key, state.alias("state"))


def orphans(old: DataFrame, new: DataFrame, key: str, uses: DataFrame) -> DataFrame:
    """Keys that vanished from new, with the number of rows that still use them: they may go only at 0."""
    gone = old.select(key).join(new.select(key), key, "left_anti")
    return gone.join(uses.groupBy(key).agg(F.count("*").alias("uses")), key, "left").select(key, F.coalesce("uses", F.lit(0).cast("long")).alias("uses"))


def keep_newest(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")


def relabel(df: DataFrame, column: str, names: dict[str, str]) -> DataFrame:
    return df.withColumn(column, F.coalesce(named(F.col(column), names), F.col(column)))


def change_tables(spark, sf_dir):
    """A table before a change and the rows of the change."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    old = o.filter("id % 3 <> 0").withColumn("price", F.when(F.col("id") % 7 > 0, F.col("price")))
    new = o.filter("id % 5 < 2").withColumn("price", F.col("price") + 1)
    return old, new


def upsert_force(spark, sf_dir):
    return upsert(*change_tables(spark, sf_dir), ["id"])


def upsert_skip(spark, sf_dir):
    return upsert(*change_tables(spark, sf_dir), ["id"], force=False)


def guarded(spark, sf_dir):
    return upsert_guarded(*change_tables(spark, sf_dir), ["id"], F.col("status") == "O")


def first_value(spark, sf_dir):
    return upsert_first(*change_tables(spark, sf_dir), ["id"])


def manifest(spark, sf_dir):
    old, new = change_tables(spark, sf_dir)
    sign = F.md5(F.concat_ws("|", "status", F.col("price").isNull().cast("string")))
    return manifest_diff(new.select("id", sign.alias("s")), old.select("id", sign.alias("s")), "id", "s")


def quarter_rotation(spark, sf_dir):
    """Quarter labels of a company whose year was taken to end in the wrong month, moved on by one."""
    names = {"Q1": "Q2", "Q2": "Q3", "Q3": "Q4", "Q4": "Q1"}
    return relabel(filings(spark, sf_dir), "token", names).select("doc_id", "token")


def period_backfill(spark, sf_dir):
    """The period type that is stored, else the one that follows from form and dates."""
    stored = F.when(F.col("doc_id") % 4 == 0, "FY").when(F.col("doc_id") % 4 == 1, "")
    f = filings(spark, sf_dir)
    return f.select("doc_id", P.period_type(stored, F.col("form"), F.col("token"), F.col("period"), F.col("fye")).alias("period_type"))


def orphan_diff(spark, sf_dir):
    old, new = change_tables(spark, sf_dir)
    uses = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    return orphans(old, new, "id", uses)


def newest(spark, sf_dir):
    docs = filings(spark, sf_dir)
    return keep_newest(docs, ["form"], [F.desc("filing_date"), F.desc("doc_id")], 20).select("form", "doc_id", "filing_date")


def oldest_queue(spark, sf_dir):
    """The open filings that have waited longest; the limit is the queue's."""
    return filings(spark, sf_dir).filter("status = 'O'").orderBy("filing_date", "doc_id").limit(50).select("doc_id", "filing_date")


def status_histogram(spark, sf_dir):
    return filings(spark, sf_dir).filter(F.col("status").isin("F", "O")).groupBy("form", "status").agg(F.count("*").alias("n"))


def sparse_flags(spark, sf_dir):
    """Companies with few metrics or rows."""
    out = facts(spark, sf_dir).groupBy("ticker").agg(F.count("*").alias("n"), F.count_distinct("metric").alias("metrics"), F.min("fy").alias("first"))
    return out.withColumn("few_metrics", F.col("metrics") < 5).withColumn("few_rows", F.col("n") < 10)


def group_concat_models(spark, sf_dir):
    out = facts(spark, sf_dir).groupBy("ticker").agg(F.min("fy").alias("first"), F.max("fy").alias("last"), F.count("*").alias("n"), F.sort_array(F.collect_set("model")).alias("m"))
    return out.select("ticker", "first", "last", "n", F.array_join("m", ",").alias("models"))


def daily_budget(spark, sf_dir):
    """Calls and failures of each day against a limit, with a warning from 80 % on."""
    e = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("used"), F.count_if(F.col("event_type") == "error").alias("failed"))
    limit = 300
    return e.withColumn("state", F.when(F.col("used") >= limit, "exhausted").when(F.col("used") >= 0.8 * limit, "warn").otherwise("ok"))


def fingerprint(spark, sf_dir):
    """Count, largest id and latest date of each form: equal where nothing has changed."""
    out = filings(spark, sf_dir).groupBy("form").agg(F.count("*").alias("n"), F.max("doc_id").alias("id"), F.max("filing_date").alias("at"))
    return out.select("form", F.md5(F.concat_ws("|", "n", "id", "at")).alias("print"))


def data_fingerprint(spark, sf_dir):
    """One text that changes whenever facts or filings do."""
    f = facts(spark, sf_dir).agg(F.count("*").alias("n"), F.max("partkey").alias("id"), F.max("extracted_at").alias("at"))
    d = filings(spark, sf_dir).agg(F.count("*").alias("docs"), F.max("doc_id").alias("doc"))
    return f.join(F.broadcast(d)).select(F.concat(F.lit("[["), F.concat_ws(", ", "n", "id", F.concat(F.lit('"'), "at", F.lit('"'))), F.lit("], ["), F.concat_ws(", ", "docs", "doc"), F.lit("]]")).alias("print"))


def stored_models(spark, sf_dir):
    """Facts whose model isn't a derivation, in files with a name like a price list's."""
    f = facts(spark, sf_dir)
    return f.filter(~F.col("model").like("reconcile%") & F.col("form").like("_0-_")).select("doc_id", "metric", "partkey", "suppkey", "value")


def pivot_company_period(spark, sf_dir):
    """Companies and metrics (those without data too) by fiscal year, the years that the filings have."""
    first, last = filings(spark, sf_dir).agg(F.min("fy"), F.max("fy")).first()
    v = chart_annual(facts(spark, sf_dir))
    years = [F.round(F.max(F.when(F.col("fy") == y, F.col("v"))), 4).alias(f"fy{y}") for y in range(first, last + 1)]
    every = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ticker"), F.explode(F.array(*[F.lit(f"m{i}") for i in range(1, 8)])).alias("metric"))
    return every.join(v.groupBy("ticker", "metric").agg(*years), ["ticker", "metric"], "left")


def display_pivot(spark, sf_dir):
    """The same as rows, for tables of any number of years."""
    v = chart_annual(facts(spark, sf_dir)).select("ticker", "metric", F.concat(F.lit("FY"), "fy").alias("label"), F.round("v", 0).alias("v"))
    every = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ticker"))
    return every.join(v, "ticker", "left")


def traces(spark, sf_dir):
    """Per company and metric the series as arrays in order of the year, joined as text."""
    v = chart_annual(facts(spark, sf_dir)).groupBy("ticker", "metric").agg(F.sort_array(F.collect_list(F.struct("fy", "doc_id"))).alias("s"))
    return v.select("ticker", "metric", F.array_join(F.col("s.fy"), ",").alias("years"), F.array_join(F.col("s.doc_id"), ",").alias("docs"))


def verdict(spark, sf_dir):
    """Per user the worst event: error, then click, else ok."""
    rank = F.when(F.col("event_type") == "error", 2).when(F.col("event_type") == "click", 1).otherwise(0)
    worst = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max(rank).alias("r"), F.max_by("event_id", F.struct("ts", "event_id")).alias("last"))
    return worst.select("user_id", F.element_at(F.array(F.lit("OK"), F.lit("WARN"), F.lit("CRITICAL")), F.col("r") + 1).alias("verdict"), "last")


def scale_factor(spark, sf_dir):
    """Per metric and year the annual total over four thirds of the first three quarters."""
    f = facts(spark, sf_dir).filter("period_type <> ''").groupBy("metric", "fy").agg(F.sum(F.when(F.col("period_type") == "FY", F.col("value"))).alias("a"), F.sum(F.when(F.col("period_type").isin("Q1", "Q2", "Q3"), F.col("value"))).alias("q"))
    return f.select("metric", "fy", F.round(F.try_divide("a", F.col("q") * 4 / 3), 6).alias("factor"))


QUERIES = {
    "upsert_force": upsert_force,
    "upsert_skip": upsert_skip,
    "upsert_guarded": guarded,
    "upsert_first_value": first_value,
    "manifest_diff": manifest,
    "orphan_diff": orphan_diff,
    "keep_newest": newest,
    "oldest_queue": oldest_queue,
    "status_histogram": status_histogram,
    "sparse_flags": sparse_flags,
    "group_concat_models": group_concat_models,
    "daily_budget": daily_budget,
    "fingerprint": fingerprint,
    "data_fingerprint": data_fingerprint,
    "stored_models": stored_models,
    "pivot_company_period": pivot_company_period,
    "display_pivot": display_pivot,
    "quarter_rotation": quarter_rotation,
    "period_backfill": period_backfill,
    "series_traces": traces,
    "verdict_reduce": verdict,
    "scale_factor": scale_factor,
}
_O = "WITH o AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price FROM orders), old AS (SELECT id, status, CASE WHEN id % 7 > 0 THEN price END AS price FROM o WHERE id % 3 <> 0), new AS (SELECT id, status, price + 1 AS price FROM o WHERE id % 5 < 2)"
_S = "SELECT id, status, price FROM r"
ORACLES = {
    "upsert_force": f"{_O}, r AS (SELECT * FROM old WHERE id NOT IN (SELECT id FROM new) UNION ALL SELECT * FROM new) {_S}",
    "upsert_skip": f"{_O}, r AS (SELECT * FROM old UNION ALL SELECT * FROM new WHERE id NOT IN (SELECT id FROM old)) {_S}",
    "upsert_guarded": f"{_O}, r AS (SELECT coalesce(old.id, new.id) AS id, CASE WHEN old.id IS NULL OR (old.status = 'O' AND new.id IS NOT NULL) THEN new.status ELSE old.status END AS status, CASE WHEN old.id IS NULL OR (old.status = 'O' AND new.id IS NOT NULL) THEN new.price ELSE old.price END AS price FROM old FULL JOIN new ON old.id = new.id) {_S}",
    "upsert_first_value": f"{_O}, r AS (SELECT coalesce(old.id, new.id) AS id, coalesce(old.status, new.status) AS status, coalesce(old.price, new.price) AS price FROM old FULL JOIN new ON old.id = new.id) {_S}",
    "manifest_diff": f"{_O} SELECT coalesce(old.id, new.id) AS id, CASE WHEN old.id IS NULL THEN 'added' WHEN new.id IS NULL THEN 'removed' WHEN old.status = new.status AND old.price IS NULL = (new.price IS NULL) THEN 'same' ELSE 'changed' END AS state FROM old FULL JOIN new ON old.id = new.id",
    "quarter_rotation": f"{SQL} SELECT doc_id, CASE WHEN token LIKE 'Q_' THEN 'Q' || (substr(token, 2, 1)::INT % 4 + 1) ELSE token END AS token FROM filings",
    "period_backfill": f"{SQL} SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'FY' ELSE period_type END AS period_type FROM filings",
    "display_pivot": f"{SQL}, a AS ({ANNUAL}) SELECT c_custkey AS ticker, metric, 'FY' || fy AS label, round(v, 0) AS v FROM customer LEFT JOIN a ON ticker = c_custkey",
    "orphan_diff": f"{_O} SELECT id, (SELECT count(*) FROM lineitem WHERE l_orderkey = id) AS uses FROM old WHERE id NOT IN (SELECT id FROM new)",
    "keep_newest": f"{SQL} SELECT form, doc_id, filing_date FROM filings QUALIFY row_number() OVER (PARTITION BY form ORDER BY filing_date DESC, doc_id DESC) <= 20",
    "oldest_queue": f"{SQL} SELECT doc_id, filing_date FROM filings WHERE status = 'O' ORDER BY filing_date, doc_id LIMIT 50",
    "status_histogram": f"{SQL} SELECT form, status, count(*) AS n FROM filings WHERE status IN ('F', 'O') GROUP BY ALL",
    "sparse_flags": f"{SQL} SELECT ticker, count(*) AS n, count(DISTINCT metric) AS metrics, min(fy) AS first, count(DISTINCT metric) < 5 AS few_metrics, count(*) < 10 AS few_rows FROM facts GROUP BY ticker",
    "group_concat_models": f"{SQL} SELECT ticker, min(fy) AS first, max(fy) AS last, count(*) AS n, string_agg(DISTINCT model, ',' ORDER BY model) AS models FROM facts GROUP BY ticker",
    "daily_budget": "SELECT ts::DATE AS day, count(*) AS used, count(*) FILTER (event_type = 'error') AS failed, CASE WHEN count(*) >= 300 THEN 'exhausted' WHEN count(*) >= 240 THEN 'warn' ELSE 'ok' END AS state FROM events GROUP BY day",
    "data_fingerprint": f"""{SQL}, f AS (SELECT count(*) AS n, max(partkey) AS id, max(extracted_at) AS last FROM facts), d AS (SELECT count(*) AS docs, max(doc_id) AS doc FROM filings) SELECT '[[' || n || ', ' || id || ', "' || last || '"], [' || docs || ', ' || doc || ']]' AS print FROM f, d""",
    "stored_models": f"{SQL} SELECT doc_id, metric, partkey, suppkey, value FROM facts WHERE model NOT LIKE 'reconcile%' AND form LIKE '_0-_'",
    "fingerprint": f"{SQL} SELECT form, md5(count(*) || '|' || max(doc_id) || '|' || max(filing_date)) AS print FROM filings GROUP BY form",
    "pivot_company_period": f"{SQL}, a AS ({ANNUAL}), e AS (SELECT c_custkey AS ticker, 'm' || i AS metric FROM customer, range(1, 8) r(i)) SELECT ticker, metric, " + ", ".join(f"round(max(v) FILTER (fy = {y}), 4) AS fy{y}" for y in range(1994, 2003)) + " FROM e LEFT JOIN a USING (ticker, metric) GROUP BY ALL",
    "series_traces": f"{SQL}, a AS ({ANNUAL}) SELECT ticker, metric, string_agg(fy, ',' ORDER BY fy) AS years, string_agg(doc_id, ',' ORDER BY fy) AS docs FROM a GROUP BY ALL",
    "verdict_reduce": "SELECT user_id, CASE WHEN bool_or(event_type = 'error') THEN 'CRITICAL' WHEN bool_or(event_type = 'click') THEN 'WARN' ELSE 'OK' END AS verdict, arg_max(event_id, (ts, event_id)) AS last FROM events GROUP BY user_id",
    "scale_factor": f"{SQL} SELECT metric, fy, round(sum(value) FILTER (period_type = 'FY') / (sum(value) FILTER (period_type IN ('Q1', 'Q2', 'Q3')) * 4 / 3), 6) AS factor FROM facts WHERE period_type <> '' GROUP BY ALL",
}
