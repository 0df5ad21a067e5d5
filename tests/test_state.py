"""The calendar's state machine: against the batch transitions, batch against stream, restarts, and state that vanishes."""

import random
from collections import Counter
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyspark.streaming import calendar_state as C
from tallyspark.streaming import interval
from tallyspark.streaming import pipeline as P

START = datetime(2024, 1, 1, tzinfo=UTC)
WORDS = {"poll": ["hit", "known", "not_yet", "error", "unsupported"], "attempt": ["done", "retry", "crashed", "fatal"], "action": ["requeue", "retry", "skip"]}


def micros(t):
    return round((t - datetime(1970, 1, 1, tzinfo=UTC)).total_seconds() * 1e6)


def scripts(n, seed, days=700):
    """Random messages of n rows, in the order of their times."""
    rng, out = random.Random(seed), []
    for key in range(n):
        at = START + timedelta(days=rng.randrange(days))
        out.append((key, at, 0, "entry", None, None, at.date(), rng.choice(["10-K", "10-Q", None])))
        for seq in range(1, rng.randrange(2, 14)):
            at += timedelta(minutes=rng.choice([5, 20, 60, 600, 1441, 60 * 24 * 20, 60 * 24 * 90]))
            kind = rng.choice(list(WORDS))
            out.append((key, at, seq, kind, rng.choice(WORDS[kind]), rng.choice([None, "why", "x" * 600]), None, None))
    return sorted(out, key=lambda r: (r[1], r[0], r[2]))


def row_of(s):
    stamp = lambda t: None if t is None else datetime(1970, 1, 1, tzinfo=UTC) + timedelta(microseconds=t)
    return (s.status, s.attempts, stamp(s.polled), stamp(s.next), s.error)


def got_of(r):
    fix = lambda t: t if t is None else t.replace(tzinfo=UTC) if t.tzinfo is None else t.astimezone(UTC)
    return (r.status, r.attempts, fix(r.last_attempt), fix(r.next_attempt), r.error)


STATES = [C.State(status, n, 19_800, "10-K", polled, next_, error, 5 if status in C.CLOSED else None) for status in ("upcoming", "detected", "partial", "extracted", "skipped", "failed", "stale") for n, polled, next_, error in ((0, None, None, None), (2, micros(START) - 1_000_000, micros(START) - 5_000_000, "old"))]
CALENDAR = "cal_id int, status string, attempts int, last_attempt timestamp, next_attempt timestamp, event_id long, error string"


def table_of(spark, states):
    return spark.createDataFrame([(k, s.status, s.attempts, *row_of(s)[2:4], None, s.error) for k, s in enumerate(states)], CALENDAR)


@pytest.mark.parametrize("word", WORDS["poll"])
def test_polls_as_in_batch(spark, word):
    states = [s for s in STATES if s.status == "upcoming"]
    polls = spark.range(len(states)).select(F.col("id").cast("int").alias("cal_id"), F.lit(word).alias("outcome"), F.lit("why").alias("detail"), F.lit(7).alias("polled_event"))
    got = {r.cal_id: got_of(r) for r in P.record_polls(table_of(spark, states), polls, F.lit(START)).collect()}
    m = {"kind": "poll", "word": word, "t": micros(START), "detail": "why"}
    assert got == {k: row_of(C.applied(s, m, C.Rules())) for k, s in enumerate(states)}


@pytest.mark.parametrize("word", WORDS["action"])
def test_actions_as_in_batch(spark, word):
    actions = spark.range(len(STATES)).select(F.col("id").cast("int").alias("cal_id"), F.lit(word).alias("action"), F.lit("why").alias("reason"))
    got = {r.cal_id: got_of(r) for r in P.act(table_of(spark, STATES), actions).collect()}
    m = {"kind": "action", "word": word, "t": micros(START), "detail": "why"}
    want = {k: row_of(C.applied(s, m, C.Rules())) for k, s in enumerate(STATES)}
    # A person's action on a row that it doesn't fit: the batch keeps all, and so does the state.
    assert got == want


@pytest.mark.parametrize("word", WORDS["attempt"])
def test_attempts_as_in_batch(spark, word):
    states = [s for s in STATES if s.status in ("detected", "partial")]
    none = F.array().cast("array<string>")
    retry = F.array(F.lit("why")) if word == "retry" else none
    results = spark.range(len(states)).select(F.col("id").cast("int").alias("event_id"), F.lit(word == "fatal").alias("fatal"), F.lit(word == "crashed").alias("crashed"), none.alias("done"), none.alias("review"), retry.alias("retry"))
    events = table_of(spark, states).drop("event_id").withColumnRenamed("cal_id", "event_id")
    got = {r.event_id: got_of(r) for r in P.process(events, results, F.lit(START), 3).collect()}
    m = {"kind": "attempt", "word": word, "t": micros(START), "detail": "why" if word == "retry" else None}
    want = {k: row_of(C.applied(s, m, C.Rules())) for k, s in enumerate(states)}
    assert got == want


def test_deadlines_as_in_batch(spark):
    """The day on which a row goes stale is the first on which the batch calls it so."""
    rules = C.Rules(stale_days=(("10-K", 60), ("6-K", 20)), lookback=90)
    days = dict(rules.stale_days)
    due = 19_800
    cases = [(form, polled) for form in ("10-K", "6-K", "20-F") for polled in (None, 3, 19, 20, 45, 46, 59, 60, 61, 100)]
    rows, want = [], []
    for k, (form, polled) in enumerate(cases):
        s = C.State("upcoming", 0, due, form, None if polled is None else (due + polled) * C.DAY + 5)
        at, cause = C.wake(s, rules)
        assert cause == "deadline"
        first = at // C.DAY - due
        for today in (first - 1, first):
            if polled is None or polled <= today:
                rows.append((k, form, None if polled is None else polled, today))
                want.append(today == first)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, k int, form string, polled int, today int")
    day = lambda c: F.date_from_unix_date(F.lit(due) + c)
    stale = P.is_stale(F.date_from_unix_date(F.lit(due)), F.col("form"), day(F.col("polled")).cast("timestamp"), day(F.col("today")), rules.lookback, days)
    assert [r.x for r in sorted(df.select("i", stale.alias("x")).collect())] == want


def messages(spark, rows):
    return spark.createDataFrame(rows, C.MESSAGE)


def parts(spark, rows, path, n):
    """Files of messages, in the order of their times."""
    size = -(-len(rows) // n)
    for k in range(n):
        if rows[k * size : k * size + size]:
            messages(spark, rows[k * size : k * size + size]).coalesce(1).write.mode("append").parquet(path)


RULES = C.Rules(stale_days=(("10-K", 60),), lookback=90, keep_days=200)


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_gives_what_the_fold_gives(spark, tmp_path, seed):
    """Four triggers, in two runs with a stop between them."""
    rows = scripts(60, seed)
    half = len(rows) // 2
    want = Counter(map(tuple, C.fold(messages(spark, rows), RULES).collect()))
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    stream = lambda: spark.readStream.schema(C.MESSAGE).option("maxFilesPerTrigger", 1).parquet(source)
    parts(spark, rows[:half], source, 2)
    C.run(stream(), target, RULES)
    first = spark.read.parquet(target).count()
    parts(spark, rows[half:], source, 2)
    C.run(stream(), target, RULES)
    got = Counter(map(tuple, spark.read.parquet(target).collect()))
    assert 0 < first < sum(want.values())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
    causes = {k[-1] for k in want}
    assert {"deadline", "pause over"} <= causes


def test_state_of_closed_rows_vanishes(spark, tmp_path):
    """All rows close; a late message of another row moves the time past the days for which they are kept."""
    rows = [(k, START, 0, "entry", None, None, START.date(), "10-K") for k in range(30)] + [(k, START + timedelta(hours=1), 1, "poll", "known", "x", None, None) for k in range(30)]
    late = [(99, START + timedelta(days=500), 0, "entry", None, None, (START + timedelta(days=500)).date(), "10-K")]
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    for part in (rows, late):
        messages(spark, part).coalesce(1).write.mode("append").parquet(source)
    spark.conf.set(C.PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = C.running(spark.readStream.schema(C.MESSAGE).option("maxFilesPerTrigger", 1).parquet(source), RULES)
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"{target}-state").trigger(availableNow=True).start(target)
        query.awaitTermination()
    finally:
        spark.conf.unset(C.PROVIDER)
    kept = spark.read.format("statestore").option("path", f"{target}-state").option("stateVarName", "row").load()
    assert [r.key.cal_id for r in kept.collect()] == [99]


def test_interval_join_keeps_rows_without_a_match(spark, tmp_path):
    day = lambda k: START.date() + timedelta(days=k)
    found = [(f"a{k}", k % 3, "10-K", day(k + 30), day(k)) for k in range(60)] + [("old", 1, "10-K", day(-400), day(2)), ("none", 1, "10-K", day(30), None)]
    rows = [(k, k % 3, day(k + k % 23), ["upcoming", "stale", "extracted"][k % 4 % 3]) for k in range(0, 60, 5)]
    filings = spark.createDataFrame(found, "accession string, ticker int, form string, filed date, period date")
    calendar = spark.createDataFrame(rows, "cal_id int, ticker int, fiscal_end date, status string")
    docs = spark.createDataFrame([(0, "10-K", day(3))], "ticker int, form string, period date")
    events = spark.createDataFrame([("a7",)], "accession string")
    cutoff = F.lit(day(-10))
    want = P.unseen(filings, docs, events, calendar, cutoff)
    end = datetime(2300, 1, 1).date()
    sentinels = (spark.createDataFrame([("z", -1, "10-K", end, end)], filings.schema), spark.createDataFrame([(-1, -1, end, "upcoming")], calendar.schema))
    streams = []
    for name, df, last, time in (("f", filings, sentinels[0], "period"), ("c", calendar, sentinels[1], "fiscal_end")):
        interval.stored_in_parts(df.unionByName(last), F.coalesce(F.floor(F.date_diff(time, F.lit(day(0))) / 25), F.lit(-1)), f"{tmp_path}/{name}")
        streams.append(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}"))
    out = interval.swept(streams[0], docs, events, streams[1], cutoff)
    query = out.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/s").outputMode("append").trigger(availableNow=True).start(f"{tmp_path}/o")
    query.awaitTermination()
    got = spark.read.schema(out.schema).parquet(f"{tmp_path}/o").filter("accession <> 'z'")
    columns = ["accession", "ticker", "form", "filed", "period", "cal_id"]
    assert Counter(map(tuple, got.select(columns).collect())) == Counter(map(tuple, want.select(columns).collect()))
    assert {r.cal_id is None for r in want.collect()} == {True, False}


def test_a_stream_has_no_more_state_partitions_than_cores(spark, tmp_path):
    """Each trigger loads and commits every partition, whether it has messages or not. The session's values come back."""
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    parts(spark, scripts(20, 4), source, 2)
    before = spark.conf.get(C.PARTITIONS), spark.conf.get(C.PROVIDER)
    spark.conf.set(C.PARTITIONS, "24")
    try:
        C.run(spark.readStream.schema(C.MESSAGE).parquet(source), target, RULES)
        assert spark.conf.get(C.PARTITIONS) == "24" and spark.conf.get(C.PROVIDER) == before[1]
    finally:
        spark.conf.set(C.PARTITIONS, before[0])
    assert len([p for p in (tmp_path / "out-state" / "state" / "0").iterdir() if p.name.isdigit()]) == spark.sparkContext.defaultParallelism


def test_a_group_costs_few_calls_to_its_state():
    """One to read, one to write, and those of a timer that changes; rows come back as they were."""
    calls, stored = [], []

    class Handle:
        def getValueState(self, name, schema):
            return self

        def get(self):
            calls.append("get")
            return stored[-1] if stored else None

        def update(self, value):
            calls.append("update")
            stored.append(value)

        def registerTimer(self, at):
            calls.append(("set", at))

        def deleteTimer(self, at):
            calls.append(("delete", at))

    machine, said = C.Machine(RULES), lambda *m: C.Row(said=C.json.dumps(dict(zip(("cal_id", "t", "seq", "kind", "word", "detail", "due", "form"), m, strict=True))))
    machine.init(Handle())
    entries = [said(k, micros(START), 0, "entry", None, None, 19_723, "10-K") for k in (5, 6)]
    (first,) = machine.handleInputRows((0,), iter(entries), None)
    assert (first.cal_id, first.n, first.status) == ([5, 6], [0, 0], ["upcoming"] * 2)
    (timer,) = [x[1] for x in calls if x[0] == "set"]
    calls.clear()
    (after,) = machine.handleInputRows((0,), iter([said(6, micros(START) + 5, 1, "poll", "not_yet", 'é "x"\n', None, None)]), None)
    assert (after.cal_id, after.n, after.cause) == ([6], [1], ["poll not_yet"])
    assert calls == ["get", "update"] and stored[-1][0] == timer


def test_half_years_are_dealt_to_files_in_order(spark, tmp_path):
    """Each part has as many files, all of them before the next part's, and the stream gives what the fold gives."""
    rows = messages(spark, scripts(1500, 5))
    files = C.stored_by_half(rows, f"{tmp_path}/in", 2000)
    paths = sorted((tmp_path / "in").glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
    assert files > 1 and len(paths) % files == 0 and len(paths) > files
    spans = [spark.read.parquet(*map(str, paths[k : k + files])).agg(F.min("at"), F.max("at")).first() for k in range(0, len(paths), files)]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
    C.run(spark.readStream.schema(C.MESSAGE).option("maxFilesPerTrigger", files).parquet(f"{tmp_path}/in"), f"{tmp_path}/out", RULES)
    want = Counter(map(tuple, C.fold(rows, RULES).collect()))
    assert Counter(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == want
