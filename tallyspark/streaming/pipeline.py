"""The event pipeline: calendar rows that are polled, filing events that are processed, alerts and health.

Every step is a function of tables to tables, so a run is a batch fold over status rows; `now` and `today` are parameters,
never the clock. Tables: calendar (cal_id, ticker, report_date, fiscal_end, form, status, source, attempts, last_attempt,
next_attempt, event_id, error) and events (event_id, ticker, form, accession, filed, period, status, attempts, next_attempt,
doc_id, cal_id, error).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.plans.views import SQL, filings, named, table

#: Days after the report date at which a row goes stale, by default; minutes of the first and longest pause.
STALE_DAYS = 45
FIRST_PAUSE, LONGEST_PAUSE = 15, 720
MATCH_DAYS = 10
RETRYABLE = ["failed", "stale", "skipped"]


def backoff_minutes(attempts: Column) -> Column:
    """A quarter of an hour, doubled with each further attempt, half a day at most."""
    power = F.least(F.greatest(attempts - 1, F.lit(0)), F.lit(20))
    return F.least(FIRST_PAUSE * F.pow(F.lit(2.0), power), F.lit(float(LONGEST_PAUSE))).cast("long")


def later(now: Column, minutes: Column) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(now) + minutes * 60)


def is_due(next_attempt: Column, now: Column) -> Column:
    return next_attempt.isNull() | (next_attempt <= now)


def due_rows(calendar: DataFrame, watched: DataFrame, today: Column, now: Column, lookback: int, since=None) -> DataFrame:
    """Rows of watched companies that were to report by today, aren't found yet, don't pause and aren't too old."""
    floor = F.date_sub(today, lookback)
    floor = floor if since is None else F.greatest(floor, since)
    due = calendar.filter((F.col("status") == "upcoming") & F.col("report_date").between(floor, today) & is_due(F.col("next_attempt"), now))
    return due.join(watched, "ticker", "left_semi")


def is_stale(report_date: Column, form: Column, last_attempt: Column, today: Column, lookback: int, days: dict[str, int]) -> Column:
    """Past the form's deadline, and polled since, or too old to be polled again."""
    wait = F.coalesce(named(form, days) if days else F.lit(None).cast("int"), F.lit(STALE_DAYS))
    deadline = F.date_add(report_date, wait)
    looked = F.coalesce(F.to_date(last_attempt) >= deadline, F.lit(False))
    return (deadline < today) & (looked | (report_date < F.date_sub(today, lookback)))


def mark_stale(calendar: DataFrame, today: Column, lookback: int, days: dict[str, int]) -> DataFrame:
    stale = (F.col("status") == "upcoming") & is_stale(F.col("report_date"), F.col("form"), F.col("last_attempt"), today, lookback, days)
    return calendar.withColumn("status", F.when(stale, "stale").otherwise(F.col("status")))


def record_polls(calendar: DataFrame, polls: DataFrame, now: Column) -> DataFrame:
    """calendar after one poll a row: polls (cal_id, outcome, detail, event_id).

    hit: detected, with its event; known: skipped; not_yet: only looked at; error and unsupported: paused for an hour or a day.
    """
    out = calendar.join(polls, "cal_id", "left")
    said = F.col("outcome")
    status = F.when(said == "hit", "detected").when(said == "known", "skipped").otherwise(F.col("status"))
    pause = F.when(said == "error", 60).when(said == "unsupported", 1440)
    next_ = F.when(said.isin("hit", "not_yet"), None).when(pause.isNotNull(), later(now, pause)).otherwise(F.col("next_attempt"))
    error = F.when(said.isin("hit", "not_yet"), None).when(said.isNotNull(), F.substring("detail", 1, 500)).otherwise(F.col("error"))
    event = F.when(said == "hit", F.col("polled_event")).otherwise(F.col("event_id"))
    last = F.when(said.isNotNull(), now).otherwise(F.col("last_attempt"))
    return out.withColumns({"status": status, "next_attempt": next_, "error": error, "event_id": event, "last_attempt": last}).drop("outcome", "detail", "polled_event")


def due_events(events: DataFrame, now: Column, limit: int) -> DataFrame:
    open_ = F.col("status").isin("discovered", "fetched", "partial") & is_due(F.col("next_attempt"), now)
    return events.filter(open_).orderBy("filed", "event_id").limit(limit)


def process(events: DataFrame, results: DataFrame, now: Column, max_attempts: int) -> DataFrame:
    """events after an attempt: results (event_id, fatal, crashed, done, review, retry), the last three lists of metrics.

    Fatal errors aren't the filing's fault and don't count. A crash or something to retry pauses, or fails at the last
    attempt; what needs a person isn't retried.
    """
    out = events.join(results, "event_id", "left")
    tried = F.coalesce(~F.col("fatal"), F.lit(False))
    attempts = F.col("attempts") + F.when(tried, 1).otherwise(0)
    again = F.coalesce(F.col("crashed"), F.lit(False)) | (F.size(F.coalesce("retry", F.array().cast("array<string>"))) > 0)
    spent = attempts >= max_attempts
    status = F.when(again & spent, "failed").when(F.col("crashed"), F.col("status")).when(again, "partial").otherwise("extracted")
    issues = F.concat_ws("; ", F.array_sort("retry"), F.array_sort("review"))
    error = F.when(F.col("fatal"), "deferred").when(F.col("crashed"), "crashed").otherwise(F.nullif(issues, F.lit("")))
    pause = F.when(again & ~spent, later(now, backoff_minutes(attempts)))
    pick = lambda new, old: F.when(tried, new).otherwise(F.col(old))
    new = {"status": pick(status, "status"), "next_attempt": pick(pause, "next_attempt"), "attempts": attempts, "error": F.when(F.col("fatal").isNotNull(), error).otherwise(F.col("error"))}
    return out.withColumns(new).drop("fatal", "crashed", "done", "review", "retry")


def unseen(filings_: DataFrame, docs: DataFrame, events: DataFrame, calendar: DataFrame, cutoff: Column) -> DataFrame:
    """Recent filings with a period that neither documents nor events know, each with the open calendar row of its period.

    Periods match within ten days. The join is by ticker and month, the calendar's row repeated for the months that it
    touches; the row with the smallest id is taken.
    """
    new = filings_.filter((F.col("filed") >= cutoff) & F.col("period").isNotNull())
    new = new.join(docs.select("ticker", "form", "period").distinct(), ["ticker", "form", "period"], "left_anti")
    new = new.join(events.select("accession").distinct(), "accession", "left_anti").withColumn("__m", F.trunc("period", "month"))
    months = F.sequence(F.trunc(F.date_sub("fiscal_end", MATCH_DAYS), "month"), F.trunc(F.date_add("fiscal_end", MATCH_DAYS), "month"), F.expr("interval 1 month"))
    open_ = calendar.filter(F.col("status").isin("upcoming", "stale", "failed")).select("ticker", "cal_id", "fiscal_end", F.explode(months).alias("__m"))
    hit = new.join(open_, ["ticker", "__m"], "left")
    near = F.abs(F.date_diff("fiscal_end", "period")) <= MATCH_DAYS
    return hit.groupBy("accession", "ticker", "form", "filed", "period").agg(F.min(F.when(near, F.col("cal_id"))).alias("cal_id"))


def first_seen(discoveries: DataFrame, order: list[str]) -> DataFrame:
    """One event per accession number, the first; its calendar row is the first known one."""
    w = Window.partitionBy("accession").orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = discoveries.withColumn("cal_id", F.first("cal_id", ignorenulls=True).over(whole)).withColumn("__n", F.row_number().over(w))
    return out.filter("__n = 1").drop("__n")


def act(calendar: DataFrame, actions: DataFrame) -> DataFrame:
    """calendar after a person's actions (cal_id, action, reason): requeue, retry (failed, stale or skipped rows only) and skip
    (not of extracted rows); others change nothing."""
    out = calendar.join(actions, "cal_id", "left")
    again = ((F.col("action") == "requeue") & F.col("status").isin("failed", "stale")) | ((F.col("action") == "retry") & F.col("status").isin(*RETRYABLE))
    skip = (F.col("action") == "skip") & (F.col("status") != "extracted")
    again, skip = F.coalesce(again, F.lit(False)), F.coalesce(skip, F.lit(False))
    note = F.concat(F.lit("skipped"), F.when(F.col("reason") != "", F.concat(F.lit(": "), "reason")).otherwise(""))
    return out.withColumns(
        {
            "status": F.when(again, "upcoming").when(skip, "skipped").otherwise(F.col("status")),
            "attempts": F.when(again, 0).otherwise(F.col("attempts")),
            "last_attempt": F.when(~again, F.col("last_attempt")),
            "next_attempt": F.when(~again & ~skip, F.col("next_attempt")),
            "error": F.when(again, None).when(skip, note).otherwise(F.col("error")),
        }
    ).drop("action", "reason")


def add_manual(calendar: DataFrame, entries: DataFrame) -> DataFrame:
    """calendar with manual entries (ticker, fiscal_end, report_date, form): a known row gets the date and becomes manual, and
    upcoming again unless extracted; others are new."""
    new = entries.select("ticker", "fiscal_end", F.col("report_date").alias("__date"), F.col("form").alias("__form"))
    out = calendar.join(new, ["ticker", "fiscal_end"], "full_outer")
    given = F.col("__date").isNotNull()
    return out.withColumns(
        {
            "report_date": F.coalesce("__date", "report_date"),
            "form": F.coalesce("form", "__form"),
            "source": F.when(given, "manual").otherwise(F.col("source")),
            "status": F.when(given & (F.coalesce("status", F.lit("")) != "extracted"), "upcoming").otherwise(F.col("status")),
            "attempts": F.coalesce("attempts", F.lit(0)),
        }
    ).drop("__date", "__form")


def freshness(hours: Column, warn: Column, critical: Column) -> Column:
    """A job's age since its last success; one that never succeeded warns."""
    return F.when(hours.isNull(), "WARN").when(hours > critical, "CRITICAL").when(hours > warn, "WARN").otherwise("OK")


def close_orphans(runs: DataFrame, alive: DataFrame, now: Column) -> DataFrame:
    """Runs that are marked as running while their process is gone end as failed."""
    out = runs.join(alive.select("run_id", F.lit(True).alias("__alive")), "run_id", "left")
    gone = (F.col("status") == "running") & F.col("__alive").isNull()
    return out.withColumns({"status": F.when(gone, "failed").otherwise(F.col("status")), "finished": F.when(gone, now).otherwise(F.col("finished"))}).drop("__alive")


def _calendar(spark, sf_dir):
    """Orders as calendar rows: a status, a form and a report date each."""
    status = F.expr("element_at(array('upcoming', 'detected', 'extracted', 'failed', 'stale', 'upcoming', 'skipped', 'upcoming'), cast(doc_id % 8 as int) + 1)")
    f = filings(spark, sf_dir)
    last = F.when(F.col("doc_id") % 3 > 0, F.timestamp_seconds(F.unix_timestamp(F.col("filing_date").cast("timestamp")) + F.col("doc_id") % 90 * 86400))
    pause = F.when(F.col("doc_id") % 5 == 0, F.timestamp_seconds(F.unix_timestamp(F.lit(NOW).cast("timestamp")) + (F.col("doc_id") % 7 - 3) * 3600))
    return f.select(F.col("doc_id").alias("cal_id"), "ticker", F.col("filing_date").alias("report_date"), F.col("period").alias("fiscal_end"), "form", status.alias("status"), F.when(F.col("doc_id") % 4 == 0, "manual").otherwise("feed").alias("source"), (F.col("doc_id") % 4).alias("attempts"), last.alias("last_attempt"), pause.alias("next_attempt"), F.when(F.col("doc_id") % 8 == 1, F.col("doc_id")).alias("event_id"), F.lit(None).cast("string").alias("error"))


#: The clock of the queries, a time within the tables'.
TODAY, NOW = "1997-06-30", "1997-06-30 12:00:00"
STALE_AFTER = {"10-K": 60, "10-Q": 30, "6-K": 20}


def _today():
    return F.lit(TODAY).cast("date")


def _now():
    return F.lit(NOW).cast("timestamp")


def _events(spark, sf_dir):
    """Every other order as a filing event."""
    status = F.expr("element_at(array('discovered', 'fetched', 'partial', 'extracted', 'failed'), cast(doc_id % 5 as int) + 1)")
    f = filings(spark, sf_dir).filter("doc_id % 2 = 0")
    pause = F.when(F.col("doc_id") % 3 == 0, F.timestamp_seconds(F.unix_timestamp(F.lit(NOW).cast("timestamp")) + (F.col("doc_id") % 7 - 3) * 3600))
    return f.select(F.col("doc_id").alias("event_id"), "ticker", "form", F.concat(F.lit("A"), "doc_id").alias("accession"), F.col("filing_date").alias("filed"), "period", status.alias("status"), (F.col("doc_id") % 4).alias("attempts"), pause.alias("next_attempt"), F.col("doc_id").alias("cal_id"), F.lit(None).cast("string").alias("error"))


CAL = ["cal_id", "status", "attempts", "last_attempt", "next_attempt", "event_id", "error"]


def due_calendar(spark, sf_dir):
    watched = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("ticker"))
    return due_rows(_calendar(spark, sf_dir), watched, _today(), _now(), 400).select("cal_id", "ticker", "report_date", "form", "attempts")


def stale_rows(spark, sf_dir):
    return mark_stale(_calendar(spark, sf_dir), _today(), 400, STALE_AFTER).select("cal_id", "status")


def poll_outcomes(spark, sf_dir):
    c = _calendar(spark, sf_dir)
    outcome = F.expr("element_at(array('hit', 'known', 'not_yet', 'error', 'unsupported'), cast(cal_id % 5 as int) + 1)")
    polls = c.filter("status = 'upcoming'").select("cal_id", outcome.alias("outcome"), F.concat(F.lit("because "), "cal_id").alias("detail"), (F.col("cal_id") + 100).alias("polled_event"))
    return record_polls(c, polls, _now()).select(*CAL)


def event_attempts(spark, sf_dir):
    e = _events(spark, sf_dir)
    lists = lambda k: F.expr(f"CASE WHEN event_id % {k} = 0 THEN array('b', 'a') ELSE array() END").cast("array<string>")
    results = due_events(e, _now(), 1 << 30).select("event_id", (F.col("event_id") % 22 == 0).alias("fatal"), (F.col("event_id") % 14 == 0).alias("crashed"), F.array(F.lit("x")).alias("done"), lists(6).alias("review"), lists(4).alias("retry"))
    return process(e, results, _now(), 3).select("event_id", "status", "attempts", "next_attempt", "error")


def event_queue(spark, sf_dir):
    """The oldest fifty open events: the limit is the queue's."""
    return due_events(_events(spark, sf_dir), _now(), 50).select("event_id", "filed")


def sweep_tables(spark, sf_dir):
    """Filings found, documents, events, the calendar, and the day from which on filings are swept."""
    f = filings(spark, sf_dir)
    rows = f.select("ticker", "form", F.concat(F.lit("A"), "doc_id").alias("accession"), F.col("filing_date").alias("filed"), F.when(F.col("doc_id") % 10 > 0, F.date_add("period", (F.col("doc_id") % 15).cast("int"))).alias("period"))
    docs = f.filter("doc_id % 7 = 0").select("ticker", "form", F.date_add("period", (F.col("doc_id") % 15).cast("int")).alias("period"))
    events = _events(spark, sf_dir).filter("event_id % 6 = 0")
    return rows, docs, events, _calendar(spark, sf_dir), F.lit("1996-01-01").cast("date")


def sweep(spark, sf_dir):
    return unseen(*sweep_tables(spark, sf_dir))


def event_dedup(spark, sf_dir):
    """Discoveries of the same accession number by calendar, sweep and hand: one event each."""
    f = filings(spark, sf_dir).select(F.concat(F.lit("A"), F.floor(F.col("doc_id") / 3)).alias("accession"), "filing_date", F.col("doc_id").alias("found"), F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")).alias("cal_id"))
    return first_seen(f, ["filing_date", "found"]).select("accession", "found", "cal_id")


def operator_actions(spark, sf_dir):
    c = _calendar(spark, sf_dir)
    actions = c.filter("cal_id % 3 = 0").select("cal_id", F.expr("element_at(array('requeue', 'retry', 'skip'), cast(cal_id % 9 / 3 as int) + 1)").alias("action"), F.when(F.col("cal_id") % 2 == 0, "dup").otherwise("").alias("reason"))
    return act(c, actions).select(*CAL)


def manual_entries(spark, sf_dir):
    c = _calendar(spark, sf_dir).dropDuplicates(["ticker", "fiscal_end"]).select("ticker", "fiscal_end", F.lit(None).cast("string").alias("form"), F.lit("x").alias("source"), F.when(F.col("ticker") % 3 == 0, "extracted").otherwise("failed").alias("status"), F.col("fiscal_end").alias("report_date"), F.lit(2).alias("attempts"))
    given = filings(spark, sf_dir).filter("doc_id % 5 = 0").groupBy("ticker", F.date_add("period", (F.col("doc_id") % 2).cast("int")).alias("fiscal_end")).agg(F.max("filing_date").alias("report_date"), F.min("form").alias("form"))
    return add_manual(c, given).select("ticker", "fiscal_end", "report_date", "form", "source", "status", "attempts")


def backoff_schedule(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", backoff_minutes(F.col("event_id") % 12).alias("minutes"))


def fresh_outcomes(spark, sf_dir):
    """Outcomes that subscribers are told of: extracted or partial, at most 14 days old."""
    age = F.date_diff(_today(), F.col("filed"))
    return _events(spark, sf_dir).filter(F.col("status").isin("extracted", "partial") & (age <= 14)).select("event_id", "ticker", "filed", age.cast("long").alias("age"))


def recent_rows(spark, sf_dir):
    """Reported within thirty days, newest first."""
    rows = _calendar(spark, sf_dir).filter(F.col("report_date") >= F.date_sub(_today(), 30)).filter(F.col("report_date") < _today())
    return rows.orderBy(F.desc("report_date"), "ticker").select("cal_id", "ticker", "report_date", "form", "status")


def status_counts(spark, sf_dir):
    c = _calendar(spark, sf_dir)
    return c.groupBy((F.col("report_date") < _today()).alias("past"), "status").agg(F.count("*").alias("n"))


def outcome_counts(spark, sf_dir):
    """Batch counters by form and status of events."""
    return _events(spark, sf_dir).groupBy("form").agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("discovered", "fetched", "partial", "extracted", "failed")])


def failed_filings(spark, sf_dir):
    """Failures of the last ninety days, with the newest five."""
    rows = _events(spark, sf_dir).filter((F.col("status") == "failed") & (F.col("filed") >= F.date_sub(_today(), 90)))
    listed = rows.orderBy(F.desc("filed"), "event_id").limit(5)  # the five that the report names
    said = F.struct(-F.unix_date("filed"), "event_id", F.concat_ws(" ", "ticker", "form", "period").alias("said"))
    first = listed.agg(F.array_join(F.transform(F.sort_array(F.collect_list(said)), lambda x: x["said"]), ", ").alias("listed"))
    return rows.agg(F.count("*").alias("n")).join(F.broadcast(first))


def latest_check_run(spark, sf_dir):
    """The latest run of each job (users' events as runs)."""
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("run"), F.max("ts").alias("started"))


def job_freshness(spark, sf_dir):
    """Hours since the last event of each user and type that isn't an error, against limits of 24 and 240 hours."""
    e = table(spark, sf_dir, "events").filter("user_id is not null")
    now = F.lit("2024-01-08 00:00:00").cast("timestamp")
    out = e.groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("last"))
    hours = F.floor((F.unix_timestamp(now) - F.unix_timestamp("last")) / 3600)
    return out.select("user_id", hours.alias("hours"), freshness(hours, F.lit(24), F.lit(72)).alias("level"))


def orphan_runs(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    runs = e.select(F.col("event_id").alias("run_id"), F.when(F.col("event_id") % 3 == 0, "running").otherwise("ok").alias("status"), F.when(F.col("event_id") % 3 > 0, F.col("ts").cast("timestamp")).alias("finished"))
    return close_orphans(runs, runs.filter("run_id % 2 = 0").select("run_id"), _now()).select("run_id", "status", (F.col("finished") == _now()).alias("closed"))


def retention(spark, sf_dir):
    """Events that are kept: younger than three days at the clock."""
    return table(spark, sf_dir, "events").filter("ts >= timestamp'2024-01-05 00:00:00' - interval 3 days").select("event_id")


def enqueue(spark, sf_dir):
    """Requests (job, parameters) that aren't queued already; of those that repeat among themselves the first."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("job"), "props")
    queued = e.filter("event_id % 4 = 0").select("job", "props").distinct()
    w = Window.partitionBy("job", "props").orderBy("event_id")
    new = e.filter("event_id % 4 > 0").join(queued, ["job", "props"], "left_anti")
    return new.withColumn("k", F.row_number().over(w)).filter("k = 1").select("event_id", "job", "props")


def fingerprint_changes(spark, sf_dir):
    """Companies whose data changed since the stored fingerprint (that of the filings before the clock's year)."""
    f = filings(spark, sf_dir)
    mark = lambda d, name: d.groupBy("ticker").agg(F.to_json(F.array(F.count("*"), F.max("doc_id"))).alias(name))
    out = mark(f, "now").join(mark(f.filter("filing_date < date'1998-01-01'"), "stored"), "ticker", "left")
    return out.select("ticker", "now", (~F.col("now").eqNullSafe(F.col("stored"))).alias("changed"))


def unseen_releases(found: DataFrame, ignored: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """Releases that a poll has found, without those ignored before and those that are documents already."""
    gone = ignored.select(key).unionByName(documents.select(key)).distinct()
    return found.join(gone, key, "left_anti")


def ignored_polls(spark, sf_dir):
    """6-Ks to look at; every third filing of a company is a document already."""
    f = filings(spark, sf_dir)
    ignored = _events(spark, sf_dir).filter("status = 'failed'").select(F.col("cal_id").alias("doc_id"))
    return unseen_releases(f.filter("form = '6-K'"), ignored, f.filter("(doc_id + ticker) % 3 = 0"), "doc_id").select("doc_id", "ticker", "filing_date")


def period_match(spark, sf_dir):
    """Calendar rows and the filings whose period lies within ten days of theirs (date range by ticker and month)."""
    rows = filings(spark, sf_dir).select("ticker", "form", F.col("doc_id").cast("string").alias("accession"), F.col("filing_date").alias("filed"), F.date_add("period", (F.col("doc_id") % 15).cast("int")).alias("period"))
    none = rows.limit(0)
    return unseen(rows, none, none, _calendar(spark, sf_dir), F.lit("1900-01-01").cast("date")).select("accession", "cal_id")


QUERIES = {
    "due_calendar": due_calendar,
    "stale_rows": stale_rows,
    "poll_outcomes": poll_outcomes,
    "event_attempts": event_attempts,
    "event_queue": event_queue,
    "sweep_unseen": sweep,
    "event_dedup": event_dedup,
    "operator_actions": operator_actions,
    "manual_entries": manual_entries,
    "backoff_schedule": backoff_schedule,
    "fresh_outcomes": fresh_outcomes,
    "recent_rows": recent_rows,
    "status_counts": status_counts,
    "outcome_counts": outcome_counts,
    "failed_filings": failed_filings,
    "latest_check_run": latest_check_run,
    "job_freshness": job_freshness,
    "orphan_runs": orphan_runs,
    "retention_delete": retention,
    "enqueue_once": enqueue,
    "fingerprint_changes": fingerprint_changes,
    "ignored_polls": ignored_polls,
    "period_match": period_match,
}

CAL_SQL = f"""{SQL}, cal AS (SELECT doc_id AS cal_id, ticker, filing_date AS report_date, period AS fiscal_end, form, ['upcoming', 'detected', 'extracted', 'failed', 'stale', 'upcoming', 'skipped', 'upcoming'][doc_id % 8 + 1] AS status, (doc_id % 4) AS attempts,
  CASE WHEN doc_id % 3 > 0 THEN filing_date::TIMESTAMP + to_days((doc_id % 90)::INT) END AS last_attempt, CASE WHEN doc_id % 5 = 0 THEN TIMESTAMP '{NOW}' + to_hours((doc_id % 7 - 3)::INT) END AS next_attempt, CASE WHEN doc_id % 8 = 1 THEN doc_id END AS event_id, NULL::VARCHAR AS error FROM filings),
ev AS (SELECT doc_id AS event_id, ticker, form, 'A' || doc_id AS accession, filing_date AS filed, period, ['discovered', 'fetched', 'partial', 'extracted', 'failed'][doc_id % 5 + 1] AS status, doc_id % 4 AS attempts,
  CASE WHEN doc_id % 3 = 0 THEN TIMESTAMP '{NOW}' + to_hours((doc_id % 7 - 3)::INT) END AS next_attempt, doc_id AS cal_id FROM filings WHERE doc_id % 2 = 0)"""
_CAL = "cal_id, status, attempts, last_attempt, next_attempt, event_id, error"
_DUE = f"(next_attempt IS NULL OR next_attempt <= TIMESTAMP '{NOW}')"
_MATCH = "abs(c.fiscal_end - f.period) <= 10 AND c.status IN ('upcoming', 'stale', 'failed') AND c.ticker = f.ticker"
ORACLES = {
    "due_calendar": f"{CAL_SQL} SELECT cal_id, ticker, report_date, form, attempts FROM cal WHERE status = 'upcoming' AND report_date BETWEEN DATE '{TODAY}' - 400 AND DATE '{TODAY}' AND {_DUE} AND ticker IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
    "stale_rows": f"{CAL_SQL}, d AS (SELECT *, report_date + CASE form WHEN '10-K' THEN 60 WHEN '10-Q' THEN 30 WHEN '6-K' THEN 20 ELSE 45 END AS deadline FROM cal) SELECT cal_id, CASE WHEN status = 'upcoming' AND deadline < DATE '{TODAY}' AND (coalesce(last_attempt::DATE >= deadline, false) OR report_date < DATE '{TODAY}' - 400) THEN 'stale' ELSE status END AS status FROM d",
    "poll_outcomes": f"""{CAL_SQL} SELECT * FROM (SELECT {_CAL} FROM cal WHERE status <> 'upcoming' UNION ALL
SELECT cal_id, CASE cal_id % 5 WHEN 0 THEN 'detected' WHEN 1 THEN 'skipped' ELSE 'upcoming' END, attempts, TIMESTAMP '{NOW}', CASE cal_id % 5 WHEN 1 THEN next_attempt WHEN 3 THEN TIMESTAMP '1997-06-30 13:00:00' WHEN 4 THEN TIMESTAMP '1997-07-01 12:00:00' END,
  CASE WHEN cal_id % 5 = 0 THEN cal_id + 100 ELSE event_id END, CASE WHEN cal_id % 5 IN (1, 3, 4) THEN 'because ' || cal_id END FROM cal WHERE status = 'upcoming')""",
    "event_attempts": f"""{CAL_SQL}, r AS (SELECT event_id, event_id % 22 = 0 AS fatal, event_id % 14 = 0 AS crashed, event_id % 6 = 0 AS review, event_id % 4 = 0 AS retry FROM ev WHERE status IN ('discovered', 'fetched', 'partial') AND {_DUE}),
x AS (SELECT ev.*, fatal, crashed, review, retry, attempts + CASE WHEN NOT fatal THEN 1 ELSE 0 END AS tries FROM ev LEFT JOIN r USING (event_id))
SELECT event_id, CASE WHEN fatal IS NULL OR fatal THEN status WHEN (crashed OR retry) AND tries >= 3 THEN 'failed' WHEN crashed THEN status WHEN retry THEN 'partial' ELSE 'extracted' END AS status, tries AS attempts,
  CASE WHEN fatal IS NULL OR fatal THEN next_attempt WHEN (crashed OR retry) AND tries < 3 THEN TIMESTAMP '{NOW}' + to_minutes(CASE tries WHEN 1 THEN 15 ELSE 30 END) END AS next_attempt,
  CASE WHEN fatal THEN 'deferred' WHEN crashed THEN 'crashed' WHEN retry AND review THEN 'a; b; a; b' WHEN retry OR review THEN 'a; b' END AS error FROM x""",
    "event_queue": f"{CAL_SQL} SELECT event_id, filed FROM ev WHERE status IN ('discovered', 'fetched', 'partial') AND {_DUE} ORDER BY filed, event_id LIMIT 50",
    "sweep_unseen": f"""{CAL_SQL}, f AS (SELECT ticker, form, 'A' || doc_id AS accession, filing_date AS filed, CASE WHEN doc_id % 10 > 0 THEN period + (doc_id % 15)::INT END AS period FROM filings),
n AS (SELECT * FROM f WHERE filed >= DATE '1996-01-01' AND period IS NOT NULL AND (ticker, form, period) NOT IN (SELECT (ticker, form, period + (doc_id % 15)::INT) FROM filings WHERE doc_id % 7 = 0) AND accession NOT IN (SELECT accession FROM ev WHERE event_id % 6 = 0))
SELECT f.accession, f.ticker, f.form, f.filed, f.period, min(c.cal_id) AS cal_id FROM n f LEFT JOIN cal c ON {_MATCH} GROUP BY ALL""",
    "event_dedup": f"{SQL}, f AS (SELECT 'A' || (doc_id // 3) AS accession, filing_date, doc_id AS found, CASE WHEN doc_id % 3 > 0 THEN doc_id END AS cal_id FROM filings) SELECT accession, arg_min(found, (filing_date, found)) AS found, arg_min(cal_id, (filing_date, found)) FILTER (cal_id IS NOT NULL) AS cal_id FROM f GROUP BY accession",
    "operator_actions": f"""{CAL_SQL}, a AS (SELECT *, CASE WHEN cal_id % 3 > 0 THEN '' WHEN cal_id % 9 = 0 THEN 'requeue' WHEN cal_id % 9 = 3 THEN 'retry' ELSE 'skip' END AS act FROM cal),
b AS (SELECT *, (act = 'requeue' AND status IN ('failed', 'stale')) OR (act = 'retry' AND status IN ('failed', 'stale', 'skipped')) AS again, act = 'skip' AND status <> 'extracted' AS skip FROM a)
SELECT cal_id, CASE WHEN again THEN 'upcoming' WHEN skip THEN 'skipped' ELSE status END AS status, CASE WHEN again THEN 0 ELSE attempts END AS attempts, CASE WHEN NOT again THEN last_attempt END AS last_attempt, CASE WHEN NOT again AND NOT skip THEN next_attempt END AS next_attempt, event_id, CASE WHEN skip THEN CASE WHEN cal_id % 2 = 0 THEN 'skipped: dup' ELSE 'skipped' END END AS error FROM b""",
    "manual_entries": f"""{CAL_SQL}, c AS (SELECT DISTINCT ticker, fiscal_end FROM cal), g AS (SELECT ticker, period + (doc_id % 2)::INT AS fiscal_end, max(filing_date) AS given, min(form) AS form FROM filings WHERE doc_id % 5 = 0 GROUP BY 1, 2)
SELECT ticker, fiscal_end, coalesce(given, fiscal_end) AS report_date, g.form, CASE WHEN given IS NOT NULL THEN 'manual' ELSE 'x' END AS source, CASE WHEN c.fiscal_end IS NULL THEN 'upcoming' WHEN ticker % 3 = 0 THEN 'extracted' WHEN given IS NOT NULL THEN 'upcoming' ELSE 'failed' END AS status, CASE WHEN c.fiscal_end IS NULL THEN 0 ELSE 2 END AS attempts FROM c FULL JOIN g USING (ticker, fiscal_end)""",
    "backoff_schedule": f"{CAL_SQL} SELECT event_id, [15, 15, 30, 60, 120, 240, 480, 720, 720, 720, 720, 720][event_id % 12 + 1]::BIGINT AS minutes FROM ev",
    "fresh_outcomes": f"{CAL_SQL} SELECT event_id, ticker, filed, (DATE '{TODAY}' - filed)::BIGINT AS age FROM ev WHERE status IN ('extracted', 'partial') AND filed >= DATE '{TODAY}' - 14",
    "recent_rows": f"{CAL_SQL} SELECT cal_id, ticker, report_date, form, status FROM cal WHERE report_date >= DATE '{TODAY}' - 30 AND report_date < DATE '{TODAY}'",
    "status_counts": f"{CAL_SQL} SELECT report_date < DATE '{TODAY}' AS past, status, count(*) AS n FROM cal GROUP BY ALL",
    "outcome_counts": f"{CAL_SQL} SELECT form, " + ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in ("discovered", "fetched", "partial", "extracted", "failed")) + " FROM ev GROUP BY form",
    "failed_filings": f"{CAL_SQL}, f AS (SELECT *, row_number() OVER (ORDER BY filed DESC, event_id) AS k FROM ev WHERE status = 'failed' AND filed >= DATE '{TODAY}' - 90) SELECT count(*) AS n, coalesce(string_agg(ticker || ' ' || form || ' ' || period, ', ' ORDER BY k) FILTER (k <= 5), '') AS listed FROM f",
    "latest_check_run": "SELECT event_type, arg_max(event_id, (ts, event_id)) AS run, max(ts) AS started FROM events GROUP BY event_type",
    "job_freshness": "SELECT user_id, h AS hours, CASE WHEN h IS NULL THEN 'WARN' WHEN h > 72 THEN 'CRITICAL' WHEN h > 24 THEN 'WARN' ELSE 'OK' END AS level FROM (SELECT user_id, floor((epoch(TIMESTAMP '2024-01-08') - floor(epoch(max(ts) FILTER (event_type = 'purchase')))) / 3600)::BIGINT AS h FROM events WHERE user_id IS NOT NULL GROUP BY user_id)",
    "orphan_runs": "SELECT event_id AS run_id, CASE WHEN event_id % 3 = 0 THEN CASE WHEN event_id % 2 = 0 THEN 'running' ELSE 'failed' END ELSE 'ok' END AS status, CASE WHEN event_id % 3 > 0 THEN false WHEN event_id % 2 > 0 THEN true END AS closed FROM events",
    "retention_delete": "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-02'",
    "enqueue_once": "SELECT min(event_id) AS event_id, event_type AS job, props FROM events GROUP BY event_type, props, event_id % 4 > 0 HAVING min(event_id % 4) > 0 AND (event_type, props) NOT IN (SELECT (event_type, props) FROM events WHERE event_id % 4 = 0)",
    "fingerprint_changes": f"{SQL} SELECT ticker, '[' || count(*) || ',' || max(doc_id) || ']' AS now, count(*) FILTER (filing_date >= DATE '1998-01-01') > 0 AS changed FROM filings GROUP BY ticker",
    "ignored_polls": f"{CAL_SQL} SELECT doc_id, ticker, filing_date FROM filings WHERE form = '6-K' AND NOT (doc_id % 2 = 0 AND doc_id % 5 = 4) AND (doc_id + ticker) % 3 > 0",
    "period_match": f"{CAL_SQL}, f AS (SELECT ticker, doc_id::VARCHAR AS accession, period + (doc_id % 15)::INT AS period FROM filings) SELECT f.accession, min(c.cal_id) AS cal_id FROM f LEFT JOIN cal c ON {_MATCH} GROUP BY f.accession",
}
