"""Calendar rows as a running state machine: polls, processing attempts, people's actions, pauses and deadlines.

Messages about a row (cal_id, at, seq, kind, word, detail, due, form) come in the order of their time. A row's state lives in
the stream's state store, with those of the rows whose ids are next to its own; timers in event time wake it when a pause is over, when it goes stale, and when a closed row is
forgotten, so the state holds open rows and recently closed ones only. The same rules fold a batch: both give the same changes
for the same messages, however these are dealt to triggers and wherever a run is stopped and started again.

Kinds of messages:
- entry: a row with its report date (due) and form; a known row gets the date and is upcoming again unless it is extracted.
- poll: hit, known, not_yet, error or unsupported. Rows that aren't upcoming ignore polls.
- attempt: done, retry, crashed or fatal. Only detected and partial rows are processed.
- action: requeue, retry or skip.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyspark.plans.shared import fresh_folder
from tallyspark.plans.views import filings
from tallyspark.streaming.pipeline import FIRST_PAUSE, LONGEST_PAUSE, RETRYABLE, STALE_DAYS

MESSAGE = "cal_id long, at timestamp, seq long, kind string, word string, detail string, due date, form string"
CHANGED = "cal_id long, t long, n long, status string, attempts int, next long, error string, cause string"
CHANGED_NAMES = [x.split()[0] for x in CHANGED.split(", ")]
#: What the stream's state store holds for a group of 2^GROUP_BITS consecutive ids: its timer, and its rows as one text (a JSON
#: list of a row's id, state, number of changes and time to wake), as each field that crosses to Python by itself costs more
#: than the rules do.
ROWS = "timer bigint, rows string"
N, WAKE = -2, -1
GROUP_BITS = 7
#: The changes of a group, column by column.
CHANGED_LISTS = ", ".join(f"{x.split()[0]} array<{x.split()[1]}>" for x in CHANGED.split(", "))
MINUTE, DAY = 60_000_000, 86_400_000_000
#: After all times.
LAST = 1 << 80
CLOSED = ("extracted", "skipped", "failed", "stale")
ERROR_CHARS = 500


@dataclass(frozen=True)
class Rules:
    """Days until a row of a form goes stale, days for which rows are polled, attempts, days that closed rows are kept, and
    the delay of the watermark in microseconds."""

    stale_days: tuple[tuple[str, int], ...] = ()
    lookback: int = 120
    max_attempts: int = 3
    keep_days: int = 400
    delay: int = DAY


class State(NamedTuple):
    """A row: due is a day, the times are microseconds."""

    status: str
    attempts: int
    due: int
    form: str | None
    polled: int | None = None
    next: int | None = None
    error: str | None = None
    closed: int | None = None


def backoff(attempts: int) -> int:
    """A quarter of an hour, doubled with each further attempt, half a day at most, in microseconds."""
    return min(FIRST_PAUSE * 2 ** min(max(attempts - 1, 0), 20), LONGEST_PAUSE) * MINUTE


def applied(s: State | None, m: dict, rules: Rules) -> State | None:
    """The state after a message; the same where it changes nothing."""
    kind, word, t = m["kind"], m["word"], m["t"]
    detail = (m["detail"] or "")[:ERROR_CHARS] or None
    if kind == "entry":
        if s is None:
            return State("upcoming", 0, m["due"], m["form"])
        return s._replace(due=m["due"]) if s.status == "extracted" else s._replace(due=m["due"], status="upcoming", closed=None)
    if s is None:
        return None
    if kind == "poll" and s.status == "upcoming":
        s = s._replace(polled=t)
        if word == "hit":
            return s._replace(status="detected", next=None, error=None)
        if word == "known":
            return s._replace(status="skipped", error=detail, closed=t)
        if word == "not_yet":
            return s._replace(next=None, error=None)
        return s._replace(next=t + (60 if word == "error" else 1440) * MINUTE, error=detail)
    if kind == "attempt" and s.status in ("detected", "partial"):
        if word == "fatal":
            return s._replace(error="deferred")
        s = s._replace(attempts=s.attempts + 1)
        if word == "done":
            return s._replace(status="extracted", next=None, error=detail, closed=t)
        error = "crashed" if word == "crashed" else detail
        if s.attempts >= rules.max_attempts:
            return s._replace(status="failed", next=None, error=error, closed=t)
        return s._replace(status=s.status if word == "crashed" else "partial", next=t + backoff(s.attempts), error=error)
    if kind == "action":
        if (word == "requeue" and s.status in ("failed", "stale")) or (word == "retry" and s.status in RETRYABLE):
            return s._replace(status="upcoming", attempts=0, polled=None, next=None, error=None, closed=None)
        if word == "skip" and s.status != "extracted":
            return s._replace(status="skipped", next=None, error="skipped" + (f": {detail}" if detail else ""), closed=t)
    return s


@lru_cache(maxsize=16)
def _by_form(days: tuple[tuple[str, int], ...]) -> dict[str, int]:
    return dict(days)


def wake(s: State, rules: Rules) -> tuple[int, str]:
    """When a row is to be woken next, and why. A row is never without a timer, so none stays for ever."""
    status, _, due, form, polled, next_, _, closed = s
    first = None
    if next_ is not None and closed is None:
        first = (next_, "pause over")
    if status == "upcoming":
        deadline = due + _by_form(rules.stale_days).get(form, STALE_DAYS)
        looked = polled is not None and polled // DAY >= deadline
        day = deadline + 1 if looked else max(deadline, due + rules.lookback) + 1
        first = min(first or (LAST, ""), (max(day * DAY, polled or 0), "deadline"))
    if closed is not None:
        first = min(first or (LAST, ""), (closed + rules.keep_days * DAY, "forgotten"))
    return first or ((due + rules.lookback + rules.keep_days) * DAY + rules.keep_days * DAY, "forgotten")


def woken(s: State, cause: str, t: int) -> State | None:
    if cause == "pause over":
        return s._replace(next=None)
    if cause == "deadline":
        return s._replace(status="stale", closed=t, error="no filing by the deadline")
    return None


Change = tuple[int, State, str]


def until(s: State | None, t: int, rules: Rules) -> tuple[State | None, list[Change]]:
    """All timers up to a time, one after the other."""
    out: list[Change] = []
    while s is not None:
        at, cause = wake(s, rules)
        if at > t:
            break
        s = woken(s, cause, at)
        if s is not None:
            out.append((at, s, cause))
    return s, out


def advanced(s: State | None, messages: list[dict], rules: Rules) -> tuple[State | None, list[Change]]:
    """The state and changes after messages in their order, with the timers between them."""
    out: list[Change] = []
    for m in messages:
        s, fired = until(s, m["t"], rules)
        after = applied(s, m, rules)
        out += fired
        if after is not None and after != s:
            out.append((m["t"], after, f"{m['kind']} {m['word']}" if m["word"] else m["kind"]))
        s = after
    return s, out


def _shaped(messages: DataFrame) -> DataFrame:
    """Messages with their time and day as whole numbers."""
    return messages.select("cal_id", "at", F.unix_micros("at").alias("t"), "seq", "kind", "word", "detail", F.unix_date("due").alias("due"), "form")


def _named(changes: DataFrame) -> DataFrame:
    stamp = lambda c: F.timestamp_micros(c)
    return changes.select("cal_id", stamp("t").alias("at"), "n", "status", "attempts", stamp("next").alias("next_attempt"), "error", "cause")


def _change_rows(key: int, changes: list[Change], first: int) -> list[tuple]:
    return [(key, t, first + k, s.status, s.attempts, s.next, s.error, cause) for k, (t, s, cause) in enumerate(changes)]


def _said(batch: pa.RecordBatch) -> Iterator[dict]:
    """The messages of a batch. Texts repeat, so each different one is made once."""
    columns = []
    for column in batch.columns:
        if pa.types.is_string(column.type):
            coded = column.dictionary_encode()
            texts = [*coded.dictionary.to_pylist(), None]  # null is the last
            columns.append([texts[k] for k in coded.indices.fill_null(-1).to_numpy().tolist()])
        else:
            columns.append(column.to_pylist() if column.null_count else column.to_numpy().tolist())
    names = batch.schema.names
    return (dict(zip(names, row)) for row in zip(*columns))  # noqa: B905


def fold(messages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The changes (cal_id, at, n, status, attempts, next_attempt, error, cause) of a batch of messages, timers included up to
    the watermark that a stream of them ends with. n counts a row's changes.

    A task walks its sorted messages batch by batch and holds one row's state."""
    shaped = _shaped(messages)
    last = shaped.agg(F.max("t")).first()[0]
    end = (last or 0) // 1000 * 1000 - rules.delay
    names = [f.name for f in shaped.drop("at").schema]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, n = None, None, 0

        def given(rows):
            columns = list(zip(*rows, strict=True)) or [()] * 8
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in CHANGED.split(", ")])

        for batch in batches:
            out = []
            for own, rows in groupby(_said(batch), key=itemgetter("cal_id")):
                if own != key:
                    out += _change_rows(key, until(state, end, rules)[1], n)
                    key, state, n = own, None, 0
                state, changes = advanced(state, list(rows), rules)
                out += _change_rows(own, changes, n)
                n += len(changes)
            yield given(out)
        yield given(_change_rows(key, until(state, end, rules)[1], n))

    rows = shaped.select(*names).filter("cal_id is not null and t is not null").repartition("cal_id").sortWithinPartitions("cal_id", "t", "seq")
    return _named(rows.mapInArrow(walk, CHANGED))


def _state(row: list | None) -> State | None:
    return None if row is None else State(*row[1:N])


def _listed(changes: list[tuple]) -> Iterator[Row]:
    """One row with the changes of a call, if there are any."""
    if changes:
        yield Row(**{c: list(x) for c, x in zip(CHANGED_NAMES, zip(*changes, strict=True), strict=True)})


class Machine(StatefulProcessor):
    """The states of a group of calendar rows in the state store, with one timer: each call to the store serves them all."""

    def __init__(self, rules: Rules):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("rows", ROWS)

    def _load(self) -> tuple[int | None, dict[int, list]]:
        """A group's timer and rows by id."""
        timer, text = self.state.get() or (None, "[]")
        return timer, {row[0]: row for row in json.loads(text)}

    def _store(self, known: bool, timer: int | None, held: dict[int, list]) -> None:
        """timer: the one that is still set, if any."""
        # Timers have milliseconds; the rules look at the exact time again.
        at = -(-min(row[WAKE] for row in held.values()) // 1000) if held else None
        if timer is not None and timer != at:
            self.handle.deleteTimer(timer)
        if held:
            if timer != at:
                self.handle.registerTimer(at)
            self.state.update((at, json.dumps(list(held.values()), separators=(",", ":"))))
        elif known:
            self.state.clear()

    def _put(self, held: dict[int, list], own: int, s: State | None, changes: list[Change], out: list[tuple]) -> None:
        """The changes of a row go to out, its new state to held."""
        n = held[own][N] if own in held else 0
        out += _change_rows(own, changes, n)
        if s is None:
            held.pop(own, None)
        else:
            held[own] = [own, *s, n + len(changes), wake(s, self.rules)[0]]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        timer, held = self._load()
        known, out = bool(held), []
        messages = sorted((json.loads(r.said) for r in rows), key=lambda m: (m["cal_id"], m["t"], m["seq"] is not None, m["seq"] or 0))
        for own, said in groupby(messages, key=itemgetter("cal_id")):
            self._put(held, own, *advanced(_state(held.get(own)), list(said), self.rules), out)
        if known or held:
            self._store(known, timer, held)
        yield from _listed(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        _, held = self._load()
        out: list[tuple] = []
        now = timerValues.getCurrentWatermarkInMs() * 1000
        for own, row in list(held.items()):
            if row[WAKE] <= now:
                self._put(held, own, *until(_state(row), now, self.rules), out)
        self._store(True, None, held)  # Spark deletes the expired timer
        yield from _listed(out)

    def close(self) -> None:
        pass


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
PARTITIONS = "spark.sql.shuffle.partitions"


def running(messages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The same changes from a stream of messages. Those later than the watermark are left out. The session must keep its
    state in RocksDB when the query starts: run() sees to that."""
    rows = _shaped(messages.withWatermark("at", f"{rules.delay // 1000} milliseconds")).filter("cal_id is not null and t is not null")
    said = F.to_json(F.struct(*[c for c in rows.columns if c != "at"]), {"ignoreNullFields": "false"})
    rows = rows.select(F.shiftright("cal_id", GROUP_BITS).alias("id_group"), "at", said.alias("said"))
    changes = rows.groupBy("id_group").transformWithState(Machine(rules), CHANGED_LISTS, "Append", "EventTime")
    return _named(changes.select(F.inline(F.arrays_zip(*CHANGED_NAMES))))


@contextmanager
def _session(spark, **values: str):
    """Values of the session's configuration, for a while."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run(messages: DataFrame, path: str, rules: Rules = Rules()) -> None:
    """Writes the changes of all messages that are there to a folder, from where its checkpoint has come to.

    Each trigger loads and commits the state of each partition, so a new stream has no more of them than cores; a trigger
    commits what it changed, not the whole state."""
    spark = messages.sparkSession
    parts = min(int(spark.conf.get(PARTITIONS)), max(spark.sparkContext.defaultParallelism, 2))
    with _session(spark, **{PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", CHANGELOG: "true", PARTITIONS: str(parts)}):
        query = running(messages, rules).writeStream.format("parquet").option("checkpointLocation", f"{path}-state").outputMode("append").trigger(availableNow=True).start(path)
        query.awaitTermination()


def script(spark, sf_dir) -> DataFrame:
    """Messages made of filings: an entry, polls, attempts after a hit, some actions, some of them long after the deadline."""
    f = filings(spark, sf_dir).select("doc_id", "form", F.col("filing_date").cast("timestamp").alias("filed"), F.col("filing_date").alias("due"))
    words = "case when doc_id % 11 = 3 then array('error', 'error', 'hit', 'done') when doc_id % 7 = 1 then array('hit', 'retry', 'crashed', 'done') when doc_id % 5 = 2 then array('not_yet', 'known', 'retry:', 'hit') when doc_id % 13 = 4 then array('hit', 'crashed', 'retry', 'retry', 'retry:', 'hit', 'done') when doc_id % 3 = 0 then array('not_yet', 'not_yet', 'requeue:', 'not_yet', 'hit') else array('hit', 'fatal', 'done', 'skip:') end"
    steps = f.select("*", F.posexplode(F.expr(words)).alias("k", "said"))
    polls, tries = ["hit", "known", "not_yet", "error", "unsupported"], ["done", "retry", "crashed", "fatal"]
    kind = F.when(F.col("said").endswith(":"), "action").when(F.col("said").isin(*polls), "poll").when(F.col("said").isin(*tries), "attempt")
    long_after = F.expr(f"array_contains({words}, 'requeue:')") & (F.col("k") >= 2)
    hours = (F.col("k") + 1) * (F.col("doc_id") % 37 * 3 + 5) + F.when(long_after, 24 * 130).otherwise(0)
    later = F.timestamp_seconds(F.unix_timestamp("filed") + hours * 3600)
    rows = steps.select(F.col("doc_id").alias("cal_id"), later.alias("at"), (F.col("k") + 1).cast("long").alias("seq"), kind.alias("kind"), F.rtrim("said", F.lit(":")).alias("word"), F.concat(F.lit("step "), "k").alias("detail"), F.lit(None).cast("date").alias("due"), F.lit(None).cast("string").alias("form"))
    none = F.lit(None).cast("string")
    entries = f.select(F.col("doc_id").alias("cal_id"), F.col("filed").alias("at"), F.lit(0).cast("long").alias("seq"), F.lit("entry").alias("kind"), none.alias("word"), none.alias("detail"), "due", "form")
    return entries.unionByName(rows)


#: Messages of a file, and those that each file of a part has at least, so that no part has fewer files than others.
FILE_ROWS, LEAST_ROWS = 2_000_000, 1_000


def stored_by_half(messages: DataFrame, path: str, file_rows: int = FILE_ROWS) -> int:
    """Messages as files, half year by half year in their order; how many files each of these parts has. A half year with few
    messages goes with the next one."""
    spark, stored = messages.sparkSession, fresh_folder(messages.sparkSession, "messages-all")
    # As many slices of a half year as there are tasks: some tens of files.
    slices = F.pmod(F.xxhash64("cal_id"), F.lit(max(spark.sparkContext.defaultParallelism // 8, 1)))
    half = F.year("at") * 2 + F.floor((F.month("at") - 1) / 6)
    messages.withColumn("half", half).repartition("half", slices).write.partitionBy("half").parquet(stored)
    all_ = spark.read.schema(f"{MESSAGE}, half int").parquet(stored)
    counts = sorted(tuple(r) for r in all_.groupBy("half").count().collect())  # half years: a few dozen
    files = -(-max((n for _, n in counts), default=1) // file_rows)
    parts, n = [[]], 0
    for k, rows in counts:
        if n >= LEAST_ROWS * files or (files == 1 and n):
            parts, n = [*parts, []], 0
        parts[-1].append(k)
        n += rows
    if files > 1 and len(parts) > 1 and n < LEAST_ROWS * files:
        parts[-2:] = [parts[-2] + parts[-1]]
    for halves in parts:
        rows = all_.filter(F.col("half").isin(halves)).drop("half")
        (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.mode("append").parquet(path)
    return files


def calendar_fold(spark, sf_dir):
    """All changes of all calendar rows, in one batch."""
    return fold(script(spark, sf_dir)).drop("error")


def calendar_stream(spark, sf_dir):
    """The same from a stream of files, a half year each trigger."""
    source, target = fresh_folder(spark, "messages"), fresh_folder(spark, "changes")
    files = stored_by_half(script(spark, sf_dir), source)
    run(spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", files).parquet(source), target)
    return spark.read.schema(_named(spark.createDataFrame([], CHANGED)).schema).parquet(target).drop("error")


QUERIES = {"calendar_fold": calendar_fold, "calendar_stream": calendar_stream}
ORACLES: dict[str, str] = {}
