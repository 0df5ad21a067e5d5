"""Work that grows with the input: what is shuffled, written and repeated."""

import json
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Row
from pyspark.sql import functions as F

from tallyspark.operators import audit
from tallyspark.operators import rules as R
from tallyspark.operators import write
from tallyspark.sources import facts, scans
from tallyspark.streaming import calendar_state as C
from tallyspark.streaming import interval
from tests.helpers import SF


def test_cells_are_not_shuffled(spark):
    """Cells, many times the facts, are exploded after the last shuffle of the audit."""
    plan = audit._audited(spark, SF)._jdf.queryExecution().sparkPlan().toString() + audit._audited(spark, SF)._jdf.queryExecution().executedPlan().toString()
    for part in plan.split("AdaptiveSparkPlan")[1:] or [plan]:
        assert "Generate explode" in part
        assert part.rindex("Generate explode") < part.index("Exchange")


def test_totals_repeat_counts_only(spark):
    """Grouping sets expand one row per company, metric and class."""
    plan = audit.audit_totals(audit._audited(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.index("Expand"):plan.index("Generate")]


def test_null_metrics_are_dropped(spark):
    """A fact without a metric is in no cell and doesn't end the audit."""
    firms = spark.createDataFrame([(1, [2000], ["FY", "Q1"], ["m1"]), (2, [2000], ["FY"], ["m1"])], "ticker long, years array<bigint>, kinds array<string>, metrics array<string>")
    won = spark.createDataFrame([(1, 2000, "m1", "FY", 5, 1.0, "x"), (1, 2000, None, "FY", 6, 1.0, "x"), (None, 2000, "m1", "FY", 7, 1.0, "x")], "ticker long, fy long, metric string, period_type string, doc_id long, value_usd double, model string")
    docs = spark.createDataFrame([(1, 2000, "10-Q"), (2, None, "10-K"), (2, 2001, "20-F")], "ticker long, fy long, form string")
    got = sorted((r.ticker, r.period_type, r.gap, r.doc_id) for r in audit.check_gap(firms, won, docs).collect())
    assert got == [(1, "FY", "present", 5), (1, "Q1", "gap_fixable", None), (2, "FY", "gap_unfixable", None)]


def test_flagged_cells_need_no_others(spark):
    """Flagged cells are winners: no cell is exploded for them, and they are those of the whole audit."""
    out = audit._flagged(spark, SF)
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()
    columns = ["ticker", "fy", "metric", "period_type", "doc_id", "class", "fix", "failed"]
    want = audit._audited(spark, SF).filter("class = 'flagged'").select(columns).collect()
    assert sorted(map(str, out.select(columns).collect())) == sorted(map(str, want)) and want


def test_checks_are_compiled(spark):
    """Conditions aren't put into an array that a lambda filters, and a cell doesn't look its winner up in a map."""
    plan = audit._audited(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(array(CASE" not in plan and "array_except" in plan and "map_from_entries(collect_list(struct(metric" not in plan
    firms = spark.createDataFrame([(1, [], ["FY"], ["m1"]), (2, [2000, 2001], ["Q1", "FY"], ["m1", "m2"]), (3, [2000], [], ["m1"])], "ticker long, years array<bigint>, kinds array<string>, metrics array<string>")
    won = spark.createDataFrame([(2, 2001, "m2", "Q1", 5, 1.0, "x"), (2, 2001, "m9", "Q1", 6, 1.0, "x"), (2, 1999, "m1", "FY", 7, 1.0, "x"), (2, 2000, "m1", "FY", None, 1.0, "x"), (1, 2000, "m1", "FY", 8, 1.0, "x")], "ticker long, fy long, metric string, period_type string, doc_id long, value_usd double, model string")
    docs = spark.createDataFrame([(2, 2000, "10-K"), (2, 2001, "6-K")], "ticker long, fy long, form string")
    got = {(r.fy, r.metric, r.period_type): (r.gap, r.doc_id) for r in audit.check_gap(firms, won, docs).collect()}
    gap = lambda y, k: ("gap_fixable" if (y, k) in ((2000, "FY"), (2001, "Q1")) else "gap_unfixable", None)
    assert got == {(y, m, k): gap(y, k) for y in (2000, 2001) for m in ("m1", "m2") for k in ("Q1", "FY")} | {(2001, "m2", "Q1"): ("present", 5)}


def test_scope_totals_make_no_pairs(spark):
    """As many as the pairs of scope_matches(); a rule for all meets a row for each value, not each filing."""
    rules = spark.createDataFrame([(k, None if k % 3 else k % 5, "a" if k % 4 == 0 else None, None if k % 7 == 0 else k % 9, 5 + k % 6) for k in range(60)], "rule long, t int, f string, low int, high int")
    rows = spark.createDataFrame([(k % 5 if k % 11 else None, "ab"[k % 2], k % 12 if k % 13 else None, k) for k in range(1, 2000)], "t int, f string, y int, k int")
    pairs = R.scope_matches(rules, rows, "rule", ["t", "f"], "y").groupBy("rule").agg(F.count("*").alias("n"), F.min("k").alias("first"))
    out = R.scope_totals(rules, rows, "rule", ["t", "f"], "y", "k")
    assert sorted(out.select("rule", "n", "first").collect()) == sorted(pairs.collect())
    met = R._met(rules, rows.withColumn("n", F.lit(1)).withColumn("first", F.col("k")), lambda held: rows.groupBy(*held, "y").agg(F.count("*").alias("n"), F.min("k").alias("first")), "rule", ["t", "f"], "y", "low", "high")
    assert met.groupBy("rule").count().agg(F.max("count")).first()[0] <= 60  # of some 2,000 rows
    assert R.scope_totals(rules.limit(0), rows, "rule", ["t", "f"], "y", "k").count() == 0


def test_owners_texts_meet_their_patterns_only(spark):
    """Many owners' patterns make one walk by a join, not one for each block; an owner with many has several rows."""
    n = R.OWN_PATTERNS * 3
    patterns = [(k, "f", 1, rf"unit {k} ([\d,]+)") for k in range(200)] + [(1, "f", 2 + k, rf"no {k} ([\d,]+)") for k in range(n)] + [(1, "f", 2 + n, r"late ([\d,]+)"), (None, "f", 0, r"first ([\d,]+)")]
    texts = [(k, k, f"unit {k} 5") for k in range(200)] + [(500, 1, "late 9, no 7 8"), (501, 1, "late 9"), (502, 3, "late 9"), (503, 3, "unit 3 5, first 4")]
    out = R.pattern_table_values(spark.createDataFrame(texts, "i int, o int, t string"), spark.createDataFrame(patterns, "owner int, field string, priority int, pattern string"), "i", "o", "t", 20)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2
    got = {r.i: (r.value, r.priority) for r in out.collect()}
    assert got == {**{k: (5.0, 1) for k in range(200)}, 500: (8.0, 9), 501: (9.0, 2 + n), 503: (4.0, 0)}


def test_bundled_files(spark, tmp_path):
    """Files in bundles give what files of their own give, with filters and errors; few are written, however many companies."""
    page = lambda *forms: json.dumps({"filings": {"recent": {n: [f"{n}\n{k}" for k in range(len(forms))] for n in scans.ARRAYS[:-1]} | {"form": list(forms)}}})
    files = [("ticker=A/f.json", page("10-K", "6-K")), ("ticker=B/f.json", page("10-Q")), ("ticker=C/f.json", "{broken"), ("ticker=D/deep/f.json", page("10-K"))]
    scans.bundle(spark.createDataFrame(files, "path string, text string").coalesce(1), f"file://{tmp_path}/b")
    for path, text in files:
        at = tmp_path / "f" / path
        at.parent.mkdir(parents=True)
        at.write_text(text)
    for condition in ("true", "form = '10-K'", "ticker = 'A'", "ticker in ('B', 'C')"):
        got, want = (sorted(map(str, scans.scan(spark, "submissions", f"file://{tmp_path}/{x}").filter(condition).drop("file").collect())) for x in "bf")
        assert got == want and want, condition
    (tmp_path / "b" / "all.bundle" / "z.json.gz").write_bytes(b"no gzip")
    assert scans.scan(spark, "submissions", f"file://{tmp_path}/b").filter("error is not null").count() == 2
    path = scans._folder(spark, "many", spark.range(3000).selectExpr("id as ticker", "'{}' as text").coalesce(2), "ticker")
    assert len(list(Path(path.removeprefix("file://")).rglob("*.json.gz"))) == 2


class Store:
    """A state store of one group that counts what it is asked."""

    def __init__(self):
        self.value, self.timers, self.calls = None, [], 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.value = None

    def listTimers(self):
        self.calls += 1
        return iter(self.timers)

    def deleteTimer(self, t):
        self.calls += 1
        self.timers.remove(t)

    def registerTimer(self, t):
        self.calls += 1
        self.timers.append(t)


def test_a_group_of_calendar_rows_asks_the_store_once(spark):
    """64 rows of two messages each: a few calls, and the changes of each row by itself."""
    store, rules = Store(), C.Rules()
    m = C.Machine(rules)
    m.init(store)
    said = lambda k: [{"cal_id": k, "t": k, "seq": 0, "kind": "entry", "word": None, "detail": None, "due": k, "form": "10-K"}, {"cal_id": k, "t": k + 1, "seq": 1, "kind": "poll", "word": "error" if k % 2 else "hit", "detail": "x", "due": None, "form": None}]
    rows = [Row(**x) for k in range(64) for x in said(k)]
    got = list(m.handleInputRows((0,), iter(rows[::2] + rows[1::2]), None))
    want = [r for k in range(64) for r in C._change_rows(k, C.advanced(None, said(k), rules)[1], 0)]
    assert [tuple(r) for r in got] == want and store.calls <= 6 and len(store.timers) == 1

    class Late:
        def getCurrentWatermarkInMs(self):
            return C.DAY * 90 // 1000

    fired = list(m.handleExpiredTimer((0,), Late(), None))
    want = [r for k in range(64) for r in C._change_rows(k, C.until(C.advanced(None, said(k), rules)[0], C.DAY * 90, rules)[1], 2)]
    assert [tuple(r) for r in fired] == want and any(r.cause == "pause over" for r in fired)


def test_many_doomed_keys_are_dealt(spark):
    """Beyond MOST_SENT the doomed keys are neither broadcast nor sorted; few are broadcast."""
    parent = spark.range(300_000).withColumnRenamed("id", "k")
    child = spark.range(600_000).select((F.col("id") % 300_000).alias("k"))
    doomed = parent.filter("k % 4 > 0")
    left, children, log = write.cascade_delete(parent, {"c": child}, doomed.union(doomed), "k")
    assert (left.count(), children["c"].count(), log.count()) == (75_000, 150_000, 225_000)
    for rows in (left, children["c"], log):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan and "Sort " not in plan
    few = write.cascade_delete(parent, {"c": child}, doomed.limit(10), "k")[0]
    assert few.count() == 299_990 and "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()


def test_anchor_pages_shuffle_items_once(spark):
    """A filing's items are brought together once, before they are JSON."""
    plan = facts._pages(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.rindex("collect_list") < plan.index("Exchange ")


def test_messages_are_decoded_by_columns():
    """A fold's messages: repeated texts are one object, nulls stay null, and states are plain tuples."""
    rows = [{"cal_id": k // 2, "t": k, "kind": "poll", "word": [None, "", "hit"][k % 3], "due": None if k % 2 else k} for k in range(9)]
    batch = pa.RecordBatch.from_pylist(rows, pa.schema([("cal_id", pa.int64()), ("t", pa.int64()), ("kind", pa.string()), ("word", pa.string()), ("due", pa.int32())]))
    for part, want in ((batch, rows), (batch.slice(3, 4), rows[3:7]), (batch.slice(0, 0), [])):
        got = list(C._said(part))
        assert got == want and len({id(m["kind"]) for m in got}) == min(len(got), 1)
    assert isinstance(C.State("upcoming", 0, 5, None), tuple)


def test_wake_takes_the_first_timer():
    """Of timers at one time that with the smallest name."""
    rules = C.Rules(stale_days=(("10-K", 3),), lookback=5, keep_days=2)
    for s in [C.State(status, 0, 10, form, polled, next_, None, closed) for status in ("upcoming", "failed") for form in ("10-K", None) for polled in (None, 14 * C.DAY, 300 * C.DAY) for next_ in (None, 5, 16 * C.DAY) for closed in (None, 14 * C.DAY)]:
        deadline = 10 + (3 if s.form else C.STALE_DAYS)
        day = deadline + 1 if s.polled is not None and s.polled // C.DAY >= deadline else max(deadline, 15) + 1
        times = [(s.next, "pause over")] * (s.next is not None and s.closed is None) + [(max(day * C.DAY, s.polled or 0), "deadline")] * (s.status == "upcoming") + ([(s.closed + 2 * C.DAY, "forgotten")] if s.closed is not None else [])
        assert C.wake(s, rules) == (min(times) if times else (19 * C.DAY, "forgotten"))


def test_known_rows_are_stored_once(spark):
    """What the sweep's batches read anew is a scan of different rows, not the joins that made them."""
    rows = interval.P.sweep_tables(spark, SF)[1].select("ticker", "form", "period")
    stored = interval.stored_once(rows.unionByName(rows), "known")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert stored.count() == rows.distinct().count() and stored.exceptAll(rows.distinct()).count() == 0
