"""Rules against plain expectations, case by case."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import labels as L
from tallyspark.functions import text as T
from tallyspark.operators import audit, extract, reconcile, report, write
from tallyspark.operators.provenance import provenance
from tallyspark.operators.joins import asof
from tallyspark.sources import facts, files
from tallyspark.streaming import pipeline, windows
from tests.helpers import SF

D = datetime.date


def values(spark, schema, rows, column):
    out = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}").select("i", column.alias("x")).collect()
    return [r.x for r in sorted(out)]


def test_duration(spark):
    rows = [("Q1", 89), ("Q1", 364), ("FY", 364), ("FY", 371), ("H1", 159), ("H1", 160), ("9M", 290), ("3M_reported", 75), ("H2", 5), ("", 5), (None, 5), ("Q2", None)]
    assert values(spark, "k string, d int", rows, audit.check_duration(F.col("k"), F.col("d"))) == [True, False, True, False, False, True, True, True, True, True, True, True]


def test_cross_source(spark):
    rows = [("Total revenue 245,122 211,915 198,270", 245122.0), ("Total revenue 245,122", -245122.0), ("revenue 245,122", 250000.0), ("no numbers", 5.0), (None, 5.0), ("only 12 and 99", 12.0), ("was 500", 0.2), ("values 1,005", 1000.0), ("1,006", 1000.0)]
    assert values(spark, "q string, v double", rows, audit.check_cross_source(F.col("q"), F.col("v"))) == [True, True, False, True, True, True, False, True, False]


def test_sign(spark):
    rows = [("A", "revenue", -1.0), ("A", "revenue", 1.0), ("A", "capital_expenditures", -5.0), ("A", "operating_cash_flow", -5.0), ("CRWV", "operating_cash_flow", -5.0), ("A", "operating_cash_flow", 5.0), ("A", "revenue", None), ("A", "other", -1.0)]
    assert values(spark, "t string, m string, v double", rows, audit.check_sign(F.col("t"), F.col("m"), F.col("v"))) == ["error", "ok", "ok", "warn", "ok", "ok", "ok", "ok"]


def test_currency(spark):
    rows = [("CNY", 1000.0, 140.0, 0.14), ("CNY", 1000.0, 200.0, 0.14), ("CNY", 1000.0, 140.0, None), ("CNY", 0.0, 0.0, 0.14), ("USD", 5.0, 5.4, None), ("USD", 5.0, 6.0, None), ("USD", None, 6.0, None), ("CNY", None, 1.0, 0.1)]
    assert values(spark, "c string, v double, u double, r double", rows, audit.check_currency(F.col("c"), F.col("v"), F.col("u"), F.col("r"))) == ["ok", "warn", "warn", "ok", "ok", "error", "ok", "warn"]


def test_segment_def(spark):
    rows = [("cloud_segment_revenue", ["Cloud"], "Note on CLOUD", None), ("cloud_segment_revenue", ["Cloud"], None, "x"), ("cloud_segment_revenue", [], None, "x"), ("cloud_segment_revenue", None, None, None), ("revenue", ["Cloud"], "", ""), ("cloud_segment_revenue", ["", "AI unit"], "", "the ai UNIT grew")]
    assert values(spark, "m string, n array<string>, s string, q string", rows, audit.check_segment_def(*map(F.col, "mnsq"))) == [True, False, True, True, True, True]


def test_routes(spark):
    rows = [("present", ["period_type", "identity"]), ("present", ["cross_source"]), ("present", ["cross_source", "identity"]), ("present", ["identity"]), ("present", ["identity", "range"]), ("present", ["sign_error"]), ("gap_fixable", []), ("gap_unfixable", []), ("present", ["continuity"])]
    assert values(spark, "g string, f array<string>", rows, audit.route(F.col("g"), F.col("f"))) == ["refetch", "refetch", None, "reconcile", "refetch", None, "extract", None, "refetch"]


def test_identity_and_neighbours(spark):
    rows = [(1, "m", 2000, p, v) for p, v in (("Q1", 10.0), ("Q2", -20.0), ("Q3", 30.0), ("Q4", 40.0), ("FY", 90.0))] + [(1, "m", 2001, "Q1", 170.0), (1, "m", 2001, "Q3", 1700.0), (2, "m", 2000, "Q1", 0.0), (2, "m", 2000, "Q2", 5.0), (3, "m", 2000, "Q1", 20.0), (3, "m", 2000, "Q2", 20.0), (3, "m", 2000, "Q3", 20.0), (3, "m", 2000, "9M", 80.0)]
    out = {(r.ticker, r.fy, r.period_type): r for r in audit.with_neighbours(spark.createDataFrame(rows, "ticker int, metric string, fy int, period_type string, value_usd double")).collect()}
    assert out[1, 2000, "Q1"].violations == ["FY=Q1+Q2+Q3+Q4"] and out[1, 2001, "Q1"].violations == [] and out[3, 2000, "Q1"].violations == ["9M=Q1+Q2+Q3"]
    assert out[1, 2001, "Q1"].factor == 170 / 40 and out[1, 2001, "Q3"].factor == 10 and out[2, 2000, "Q2"].factor is None and out[1, 2000, "FY"].factor is None


def plain_derive(p):
    """(periods, conflicts) by the rules in words: pass after pass until one derives nothing."""
    rules = [("Q2", "H1", ["Q1"], 0), ("Q3", "9M", ["H1"], 0), ("Q4", "FY", ["9M"], 0), ("9M", None, ["Q1", "Q2", "Q3"], 1), ("H1", None, ["Q1", "Q2"], 1), ("9M", None, ["H1", "Q3"], 1), ("Q4", "FY", ["Q1", "Q2", "Q3"], 0), ("Q1", "FY", ["Q2", "Q3", "Q4"], 0), ("Q2", "FY", ["Q1", "Q3", "Q4"], 0), ("Q3", "FY", ["Q1", "Q2", "Q4"], 0)]
    p, conflicts = dict(p), 0
    for _ in range(8):
        new = 0
        for target, whole, parts, adds in rules:
            if p.get(target) is None and all(p.get(x) is not None for x in parts) and (adds or p.get(whole) is not None):
                v = sum(p[x] for x in parts) if adds else p[whole] - sum(p[x] for x in parts)
                if v > 0:
                    p[target], new = v, new + 1
        q = [p.get(x) for x in ("Q1", "Q2", "Q3", "Q4", "FY")]
        if None not in q:
            conflicts += abs(q[4] - sum(q[:4])) / max(abs(q[4]), abs(sum(q[:4])), 1) > 0.005
        if not new:
            break
    return p, conflicts


def test_derive_all_masks(spark):
    """Every set of known periods, with values that fit and values that don't."""
    cases = []
    for mask in range(128):
        for k, values_ in enumerate(({"Q1": 10, "Q2": 20, "Q3": 30, "Q4": 40, "H1": 30, "9M": 60, "FY": 100}, {"Q1": 50, "Q2": 20, "Q3": 30, "Q4": 90, "H1": 31, "9M": 80, "FY": 99})):
            cases.append((mask * 2 + k, {p: float(v) for i, (p, v) in enumerate(values_.items()) if mask >> i & 1}))
    rows = [(i, *[c.get(p) for p in reconcile.PERIODS]) for i, c in cases]
    wide = spark.createDataFrame(rows, "i int, " + ", ".join(f"{reconcile.v(p)} double" for p in reconcile.PERIODS))
    got = {r.i: r for r in reconcile.derive(wide).collect()}
    for i, c in cases:
        want, conflicts = plain_derive(c)
        assert {p: got[i][reconcile.v(p)] for p in reconcile.PERIODS} == {p: want.get(p) for p in reconcile.PERIODS} and got[i].conflicts == conflicts


RELEASE = "BEIJING\nFoo Corp Announces\nSecond Quarter 2026 Results\n"


def test_release(spark):
    rows = [
        RELEASE + "financial results for the second quarter ended June 30, 2026. " + "x " * 3000 + "Condensed  consolidated\nbalance sheets",
        RELEASE,
        "Notice of the annual general meeting. " + RELEASE,
        "Monthly return of equity",
        "Foo Corp reports a fire. results",
        "x " * 4000 + RELEASE,
        "announces full year results for the three months ended Sept. 30 2025",
        "for the year ended March 31, 1999",
    ]
    assert values(spark, "t string", [(r,) for r in rows], T.release_score(F.col("t"))) == [9, 4, -2, -6, 0, 0, 5, 0]


def test_period_ends(spark):
    rows = ["three months ended June 30, 2026, and 3 months ended Jun. 30 2025; quarter ended Sept 30, 2026", "year ended March 31, 1999 and ended May 1, 1999", "First  quarter\nended feb 30, 2024, june quarter ended June 5, 2024", "three and six months ended December 31, 2020"]
    assert values(spark, "t string", [(r,) for r in rows], T.period_ends(F.col("t"))) == [[D(2026, 6, 30), D(2025, 6, 30), D(2026, 9, 30)], [], [D(2024, 6, 5)], [D(2020, 12, 31)]]
    rows = [([D(2026, 6, 30)] * 2 + [D(2025, 6, 30)] * 5 + [D(2026, 3, 31)] * 2,), ([],), ([D(2027, 1, 1)],)]
    assert values(spark, "d array<date>", rows, T.mode_date(F.col("d"), F.lit(D(2026, 7, 20)))) == [D(2026, 6, 30), None, None]


def test_errors(spark):
    rows = ["Error 401", "code 14010", "OAuth token revoked", "You've hit your weekly limit", "usage limit reached|1700000000", "HTTP 429", "model x does not exist", "HTTP 503", "port 1503x", "whatever", None]
    assert values(spark, "m string", [(r,) for r in rows], T.error_class(F.col("m"))) == ["auth", "transient", "auth", "limit", "limit", "limit", "model", "transient", "transient", "transient", None]


def test_labels(spark):
    assert values(spark, "v double", [(1234.5,), (999.94,), (-1500.0,), (None,)], L.money(F.col("v"))) == ["$1,234M", "$999.9M", "$-1,500M", "—"]
    assert values(spark, "d int", [(0,), (1,), (-1,), (5,), (-3,)], L.countdown(F.col("d"))) == ["today", "tomorrow", "yesterday", "in 5 days", "3 days ago"]
    rows = [("20250131", None), ("2025-02-30", "2025-03-01"), ("2025-01-01", "2025-01-31"), (None, "2025-01-31")]
    assert values(spark, "a string, b string", rows, L.safe_days(F.col("a"), F.col("b"))) == [None, None, 30, None]
    rows = [('x {"a": "}", "b": {"c": 1}} tail }',), ("{ open",), ("none",), ('{"q": "\\""}',)]
    assert values(spark, "t string", rows, L.balanced_json(F.col("t"))) == ['{"a": "}", "b": {"c": 1}}', None, None, '{"q": "\\""}']


def test_submissions_and_exhibits(spark):
    page = '{"filings": {"recent": {"accessionNumber": ["a", "b", "c"], "filingDate": ["2", "1", "0"], "reportDate": ["", "", ""], "primaryDocument": ["x", "y", "z"], "form": ["6-K", "6-K/A"]}}}'
    df = spark.createDataFrame([(1, page), (2, "{}"), (3, None)], "k int, page string")
    assert [(r.k, r.accessionNumber) for r in files.submissions(df, "page", "6-K", "k").collect()] == [(1, "a")]
    assert [r.accessionNumber for r in files.submissions(df, "page", "6-K", "k", amendments=True).collect()] == ["a", "b"]
    items = [("ex99-2.htm", "5"), ("EX99.htm", "n/a"), ("ex99-index.html", "1"), ("a.jpg", "1"), ("exhibit99_10.html", "70000"), ("ex10.htm", "9")]
    out = spark.createDataFrame([(items,)], "i array<struct<name:string,size:string>>").select(files.exhibits(F.col("i")).alias("e"), files.main_exhibit(files.exhibits(F.col("i")))["name"].alias("m")).first()
    assert [tuple(x) for x in out.e] == [(1, "EX99.htm", 0), (2, "ex99-2.htm", 5), (10, "exhibit99_10.html", 70000)] and out.m == "EX99.htm"


def test_calendar_errors(spark):
    for text, said in (('{"Information": "slow down"}', "slow down"), ("a,b\n1,2", "header")):
        with pytest.raises(Exception, match=said):
            files.calendar_rows(spark.createDataFrame([(text,)], "t string"), "t").collect()


def test_concepts(spark):
    assert values(spark, "a array<string>", [(["x", "ifrs:R", "us-gaap:S"],), (["x"],), ([],)], facts.anchor_concept(F.col("a"))) == ["ifrs:R", None, None]
    with pytest.raises(Exception, match="taxonomy:name"):
        values(spark, "c string", [("nocolon",)], facts.split_concept(F.col("c"))[0])
    rows = [(100.0, 100.9), (100.0, 102.0), (0.0, 0.0), (0.0, 5.0), (5.0, 0.0), (5.0, None), (None, 5.0)]
    assert values(spark, "v double, a double", rows, facts.anchor_check(F.col("v"), F.col("a"))) == [True, False, True, False, False, True, None]
    entries = [(0, "2017-03-31", "2016-04-01", 7417.0, "10-Q", "Q1"), (1, "2017-03-31", "2017-01-01", 1861.0, "10-Q/A", "Q1"), (2, "2017-12-31", None, 5.0, "10-K", "FY"), (3, "2017-12-31", "2017-01-01", 6.0, "10-K", "FY"), (4, "2017-12-31", "2017-01-01", 7.0, "10-K", "FY")]
    df = spark.createDataFrame(entries, "pos int, end string, start string, val double, form string, fp string")
    assert sorted(r.val for r in facts.best_entries(df, [], ["10-Q", "10-Q/A", "10-K"], ["pos"]).collect()) == [6.0, 1861.0]


def test_asof_of_rows_of_one_day(spark):
    """Two rates on the first of a month: the larger one counts."""
    left = spark.createDataFrame([("a", D(2020, 1, 15)), ("a", D(2020, 3, 1))], "k string, at date")
    right = spark.createDataFrame([("a", D(2020, 1, 1), 1.0), ("a", D(2020, 1, 1), 3.0), ("a", D(2020, 3, 1), 2.0), ("a", D(2020, 3, 1), 1.5)], "k string, on date, v double")
    assert sorted(r.v for r in asof(left, right, "k", "at", "on", "v").collect()) == [2.0, 3.0]


def test_asof_keeps_repeated_rows(spark):
    left = spark.createDataFrame([("a", D(2020, 1, 15)), ("a", D(2020, 1, 15)), ("a", D(2019, 1, 1)), ("b", D(2020, 5, 5)), ("a", D(2030, 1, 1))], "k string, at date")
    right = spark.createDataFrame([("a", D(2020, 1, 1), 1.0), ("a", D(2020, 1, 20), 2.0)], "k string, on date, v double")
    got = sorted(((r.k, r.at, r.v) for r in asof(left, right, "k", "at", "on", "v").collect()), key=str)
    assert got == [("a", D(2019, 1, 1), None), ("a", D(2020, 1, 15), 1.0), ("a", D(2020, 1, 15), 1.0), ("a", D(2030, 1, 1), 2.0), ("b", D(2020, 5, 5), None)]


def test_evidence_roles(spark):
    rows = [([("a", ""), ("b", None), ("c", "odd"), ("d", "footnote")],), ([("a", "primary_value"), ("b", "")],), ([("a", "footnote"), ("b", " ")],), ([],)]
    out = values(spark, "e array<struct<text:string,role:string>>", rows, F.transform(write.evidence_roles(F.col("e")), lambda x: x["role"]))
    assert out == [["primary_value", "supporting", "supporting", "footnote"], ["primary_value", "supporting"], ["footnote", "primary_value"], []]


def test_sync_conventions_errors(spark):
    firms = spark.createDataFrame([(1,), (2,)], "ticker long")
    stored = spark.createDataFrame([(1, "old"), (2, "kept")], "ticker long, convention string")
    schema = "ticker long, block struct<default:string>"
    out = write.sync_conventions(stored, spark.createDataFrame([(1, ("new",)), (2, None)], schema), firms)
    assert sorted(map(tuple, out.collect())) == [(1, "new"), (2, "kept")]
    for row, said in (((9, ("x",)), "unknown company"), ((1, (None,)), "no default")):
        with pytest.raises(Exception, match=said):
            write.sync_conventions(stored, spark.createDataFrame([row], schema), firms).collect()


def test_backoff_and_freshness(spark):
    assert values(spark, "n int", [(n,) for n in (0, 1, 2, 3, 6, 7, 50)], pipeline.backoff_minutes(F.col("n"))) == [15, 15, 30, 60, 480, 720, 720]
    assert values(spark, "h double", [(None,), (1.0,), (25.0,), (80.0,)], pipeline.freshness(F.col("h"), F.lit(24), F.lit(72))) == ["WARN", "OK", "WARN", "CRITICAL"]


def test_headed_sections():
    text = "see notes to the accounts\nFinancial review\n" + "a" * 600 + "\n" + " " * 5 + "MD&A: short\nsome long words before it: financial review\nFinancial  Review\nend"
    out = extract.headed_sections(text)
    assert list(out) == ["Notes to Accounts", "Financial Review", "Management Discussion"] and out["Financial Review"].startswith("Financial review\naaa")


def test_html_text(spark):
    """Against the standard library's parser: words outside markup, scripts and heads, in order."""
    from html.parser import HTMLParser

    class Words(HTMLParser):
        def __init__(self):
            super().__init__()
            self.skip, self.said = 0, []

        def handle_starttag(self, tag, attrs):
            self.skip += tag in ("script", "style", "head")

        def handle_endtag(self, tag):
            self.skip -= tag in ("script", "style", "head")

        def handle_data(self, data):
            if not self.skip:
                self.said.append(data)

    for r in spark.read.parquet(f"{SF}/pages.parquet").select("html", T.html_text("html").alias("t")).collect():
        parser = Words()
        parser.feed(r.html)
        want = "".join("".join(parser.said).split())
        assert "".join(r.t.replace("[TABLE]", "").replace("[/TABLE]", "").split()) == want


def test_provenance(spark):
    texts = spark.createDataFrame([(1, "one two three four five six"), (2, "xone two three four fivex"), (3, None), (4, "two"), (4, "two")], "i int, t string")
    quotes = spark.createDataFrame([(1, "one two three four five"), (2, "two"), (3, ""), (4, None), (5, "three four")], "q int, s string")
    got = {tuple(r) for r in provenance(texts, quotes, "i", "t", "q", "s").collect()}
    assert got == {(i, q) for i, t in ((1, "one two three four five six"), (2, "xone two three four fivex"), (4, "two")) for q, s in ((1, "one two three four five"), (2, "two"), (5, "three four")) if s in t}


def test_held_back_in_stream(spark, tmp_path):
    """State is kept between batches: the stream sends what the batch form sends."""
    rows = [(k, datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h)) for k in (1, 2) for h in (0, 5, 11, 12, 13, 30, 41, 43)]
    for n in range(2):
        spark.createDataFrame(rows[n * 4 : n * 4 + 4] + rows[8 + n * 4 : 12 + n * 4], "k long, ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    sent = sorted((r.k, r.ts) for r in windows.drained(windows.held_back_stream(stream, "k", "ts", 12 * 3600), "held").collect())
    whole = windows.held_back(spark.createDataFrame(rows, "k long, ts timestamp"), "k", "ts", 12 * 3600)
    assert sent == sorted((r.k, r.ts) for r in whole.filter("sent").collect())


def test_late_events_are_left_out(spark, tmp_path):
    """A batch with an event older than the watermark of the batches before: its window is closed."""
    at = lambda h: datetime.datetime(2024, 1, 1, h)
    for n, rows in enumerate(([("a", at(1), 1.0), ("a", at(20), 1.0)], [("a", at(23), 1.0)], [("a", at(2), 1.0)], [("b", at(23), 1.0)])):
        spark.createDataFrame(rows, "event_type string, ts timestamp, value double").coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    stream = spark.readStream.schema("event_type string, ts timestamp, value double").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    out = windows.drained(windows.windowed(stream, "6 hours"), "late").collect()
    assert [(r.start.hour, r.n) for r in out if r.start.hour == 0] == [(0, 1)]


def test_plausible_and_chains(spark):
    rows = [("revenue", 700_000.0), ("revenue", 700_001.0), ("operating_cash_flow", -50_000.0), ("x", 1.0), ("revenue", None)]
    assert values(spark, "m string, v double", rows, report.plausible(F.col("m"), F.col("v"))) == [True, False, True, None, None]
    assert math.isclose(values(spark, "v double", [(1.0,)], L.pct_of(F.col("v"), F.lit(3.0)))[0], 33.333)


