"""Text rules on varied, generated texts against plain versions, and case by case."""

import csv
import io
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyspark.functions import labels as L
from tallyspark.functions import text as T
from tallyspark.operators import extract, report, write
from tallyspark.operators import provenance as provenances
from tallyspark.operators.provenance import provenance
from tallyspark.sources import files
from tallyspark.streaming import pipeline
from tests.helpers import SF


def values(spark, schema, rows, column):
    out = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}").select("i", column.alias("x")).collect()
    return [r.x for r in sorted(out)]


def pairs(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("block", [1_000_000, 20])
def test_provenance_cases(spark, block):
    """Parts of words, signs, line ends, quotes within quotes, ids of any type, and quotes over several automata."""
    rows = [(1, "Capex was ($1,234) in all, foobar."), (2, "line one\nline two é日本 🙂"), (3, None), (4, ""), (5, "aaaa"), (5, "aaaa")]
    quotes = [("a", "$1,234"), ("b", "foobar"), ("c", "in all"), ("d", "oba"), ("e", "one\nline"), ("f", "日"), ("g", "aa"), ("h", ""), ("i", None), ("j", " \n"), ("k", "a"), ("l", "aa"), ("m", "🙂"), ("n", "1234")]
    got = pairs(provenance(spark.createDataFrame(rows, "i int, t string"), spark.createDataFrame(quotes, "q string, s string"), "i", "t", "q", "s", block))
    assert got == {(i, q) for i, t in rows for q, s in quotes if s and s.strip() and t and s in t}


def test_provenance_of_cuts(spark):
    """Five thousand pieces of 1 to 200 characters, cut at random, against DuckDB's contains."""
    docs = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    rng = random.Random(3)
    cuts = []
    for k in range(5_000):
        t = rng.choice(docs)
        at = rng.randrange(max(1, len(t)))
        cuts.append((k, t[at : at + rng.randint(1, 200)]))
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    found = provenance(texts, spark.createDataFrame(cuts, "q int, s string"), "doc_id", "text", "q", "s", 50_000)
    got = dict(found.groupBy("q").agg(F.count("*").alias("n")).collect())
    want = {k: n for k, c in cuts if c.strip() and (n := sum(c in t for t in docs))}
    assert got == want


def test_provenance_empty(spark):
    none = spark.createDataFrame([], "q int, s string")
    some = spark.createDataFrame([(1, "a")], "i int, t string")
    assert provenance(some, none, "i", "t", "q", "s").columns == ["i", "q"] and provenance(some, none, "i", "t", "q", "s").count() == 0
    assert provenance(some.limit(0), some.toDF("q", "s"), "i", "t", "q", "s").count() == 0


QUOTES = [
    ("note 1.2 capex policy", 1200.0, ["capex"], None),
    ("note 1.2 billion capex policy", 1200.0, ["capex"], "note 1.2 billion capex policy"),
    ("capex of 1234 in all", 1234.0, ["capex"], None),
    ("Capex of 1,234 in all", 1234.0, [], "Capex of 1,234 in all"),
    ("Capex of 1,234 in all", 1234.0, ["other"], None),
    ("capex of 0", 0.0, [], None),
    ("capex of -5", -5.0, [], None),
    ("It was so! Capex was $1,234.5 million then. More", 1234.0, ["capex"], "! Capex was $1,234.5 million then"),
    ("Was it? Capex: 0.5 billion", 500.0, [], None),
    ("first. 12,345 no word near" + " " * 300 + "capex 12,345M here", 12345.0, ["CAPEX"], "capex 12,345M here"),
    ("a" * 400 + " 1,500 " + "b" * 400, 1500.0, [], "a" * 180 + " 1,500 " + "b" * 80),
]


@pytest.mark.parametrize("text, value, keywords, want", QUOTES)
def test_quotes(text, value, keywords, want):
    got = T.find_quote(text, value, keywords)
    assert got == want
    assert got is None or len(got) <= 300


def plain_quote(text, value, keywords):
    """By a walk over all places of the digits: written as millions, then as billions with one and two places."""
    if value <= 0:
        return None
    forms = [(f"{round(value):,}", r"(?:\.\d+)?\s*(?:million|m)?\b")] + [(f"{value / 1000:.{d}f}", r"\s*(?:billion|bn|b)\b") for d in (1, 2) if value >= 1000]
    for digits, tail in forms:
        at = text.find(digits)
        while at >= 0:
            rest = re.compile(tail, re.I).match(text, at + len(digits))
            begin = at
            while begin and text[begin - 1].isspace():
                begin -= 1
            begin = begin - 1 if begin and text[begin - 1] == "$" else begin
            if rest:
                low, high = max(0, begin - 180), rest.end() + 120
                if not keywords or any(k.lower() in text[low:high].lower() for k in keywords):
                    starts = [text.rfind(s, low, begin) for s in (". ", ".\n", "!", "?")]
                    start = max(low, *starts)
                    stop = text.find(". ", rest.end(), high)
                    quote = text[start : stop if stop > rest.end() else min(rest.end() + 80, high)].strip(" .\n")
                    return quote if len(quote) <= 300 else quote[:297] + "..."
            at = text.find(digits, at + 1)
    return None


def test_quotes_in_documents(spark):
    rows = extract.quote_texts(spark, SF).collect()
    got = dict(extract.found_quotes(spark, SF).collect())
    assert got == {r.doc_id: plain_quote(r.text, r.value, r.keywords) for r in rows}
    assert sum(q is not None for q in got.values()) > 50 and sum(q is None for q in got.values()) > 20


HEADS = ["three months ended", "Three-Months ended", "three–month ended", "threemonths ended", "six months  ended", "nine-months ended", "nine— months\nended", "year ended", "twelve months ended", "twelvemonth ended", "fiscal year ended", "years ended", "quarter ended", "quarterly ended", "quarters ended", "interim", "interim report", "Interim Consolidated", "three months end"]


def test_headers(spark):
    names = ["three_months", "six_months", "nine_months", "year", "quarter", "interim"]
    n = T.header_counts(F.col("t"))
    got = values(spark, "t string", [(h,) for h in HEADS], F.array(*[n[k] for k in names]))
    want = {0: [1, 0, 0, 0, 0, 0], 1: [1, 0, 0, 0, 0, 0], 2: [1, 0, 0, 0, 0, 0], 3: [1, 0, 0, 0, 0, 0], 4: [0, 1, 0, 0, 0, 0], 5: [0, 0, 1, 0, 0, 0], 6: [0, 0, 1, 0, 0, 0]}
    want |= {7: [0, 0, 0, 1, 0, 0], 8: [0, 0, 0, 1, 0, 0], 9: [0, 0, 0, 1, 0, 0], 10: [0, 0, 0, 1, 0, 0], 12: [0, 0, 0, 0, 1, 0], 13: [0, 0, 0, 0, 1, 0], 16: [0, 0, 0, 0, 0, 1], 17: [0, 0, 0, 0, 0, 1]}
    assert got == [want.get(k, [0] * 6) for k in range(len(HEADS))]


def test_conventions(spark):
    """A metric's own convention goes before the company's; a company without one has that warning only."""
    rows = spark.createDataFrame([(1, {"m": "semi_annual"}, ["Quarterly"], ["six months"]), (2, None, None, None)], "ticker int, per_metric map<string,string>, expect array<string>, forbid array<string>")
    rows = rows.withColumn("convention", F.when(F.col("ticker") == 1, "standalone_quarterly").otherwise("ytd_cumulative"))
    texts = [(1, "m", "three months ended. quarterly"), (1, None, "Nine months ended, SIX MONTHS"), (1, "x", "quarterly"), (2, None, ""), (2, "m", "nine months ended"), (3, "m", "nine months ended"), (1, "m", None)]
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "i int, ticker int, metric string, text string")
    got = {r.i: (r.declared, r.warnings) for r in extract.check_conventions(df, rows).collect()}
    assert got == {
        0: ("semi_annual", ["three months in a half-yearly filer"]),
        1: ("standalone_quarterly", ["expected phrase missing", "disallowed phrase: six months", "nine months in a standalone filer"]),
        2: ("standalone_quarterly", []),
        3: ("ytd_cumulative", ["no cumulative headers"]),
        4: ("ytd_cumulative", []),
        5: (None, ["undeclared"]),
        6: ("semi_annual", ["expected phrase missing"]),
    }


def test_calendar_of_random_fields(spark):
    """Against the standard library's reader: quoted commas, line ends and quotes, empty lines, short rows."""
    rng = random.Random(1)
    pieces = ["a", "Applied Digital, Corp", 'the "X"', "line\nend", "", "1.5", "é", "x,y\r\nz", '"', "  b "]
    texts = []
    for _ in range(60):
        head = rng.sample(files.CALENDAR, k=len(files.CALENDAR))
        out = io.StringIO()
        w = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]), quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
        w.writerow(head)
        for _ in range(rng.randint(0, 5)):
            w.writerow([rng.choice(pieces) or "z" if k == 0 else rng.choice(pieces) for k in range(rng.randint(3, 6))])
        texts.append(out.getvalue() + rng.choice(["", "\n", "\r\n\r\n"]))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = sorted((r.i, *[r[c] for c in files.CALENDAR]) for r in files.calendar_rows(df, "t", "i").fillna("-").collect())
    want = sorted((i, *[x.get(c) if x.get(c) is not None else "-" for c in files.CALENDAR]) for i, t in enumerate(texts) for x in csv.DictReader(io.StringIO(t, newline="")))
    assert got == want


def test_ids_and_widths(spark):
    assert values(spark, "x string", [("00012",), ("12345678901234",), ("",)], L.cik(F.col("x"))) == ["0000000012", "12345678901234", "0000000000"]
    assert values(spark, "x string", [("7",), ("123456",)], L.padded(F.col("x"), 5)) == ["00007", "123456"]


def test_note_ids(spark):
    """Numbers go on beyond 999, are all different, and start behind the day's highest."""
    notes = spark.range(2_500).select(F.lit("2024-03-05").cast("date").alias("day"), (F.col("id") * 9).alias("seq"))
    old = spark.createDataFrame([("2024-03-05", "HN-2024-03-05-009"), ("2024-03-05", "HN-2024-03-05-odd"), ("2024-03-06", "HN-2024-03-06-500")], "day string, note_id string").withColumn("day", F.to_date("day"))
    got = {r.seq: r.note_id for r in write.note_ids(notes, old).collect()}
    assert got == {k * 9: f"HN-2024-03-05-{k + 10:03d}" for k in range(2_500)}
    marked, unknown = write.revoke_notes(spark.createDataFrame([("a", "active"), ("b", "active"), ("c", "revoked")], "note_id string, state string"), spark.createDataFrame([("b",), ("z",), ("b",)], "note_id string"))
    assert pairs(marked) == {("a", "active"), ("b", "revoked"), ("c", "revoked")} and pairs(unknown) == {("z",)}


def test_routing_of_six_k(spark):
    rows = [("revenue", "xbrl_primary", None, "6-K"), ("revenue", "xbrl_primary", None, "10-K"), ("cloud_segment_revenue", "xbrl_primary", "named_segment", "6-K"), ("revenue", "xbrl_primary", None, None), ("revenue", None, None, "6-K")]
    assert values(spark, "m string, a string, t string, f string", rows, report.extraction_chain(*map(F.col, "matf"))) == [["model"], ["facts", "model"], ["model"], ["facts", "model"], []]


def test_polls_leave_out_documents(spark):
    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "doc_id int")
    assert pairs(pipeline.unseen_releases(ids(1, 2, 3, 4), ids(2), ids(3, 9), "doc_id")) == {(1,), (4,)}


def test_first_revenue_line_decides():
    table = "[TABLE]three months ended six months ended 2024 2023\nCloud\nRevenue small\nNet sales 500 400 900 800\n[/TABLE]"
    assert T.quarterly_values(table, ["Cloud"], "Q2") == []
    assert T.quarterly_values(table.replace("Revenue small\n", ""), ["Cloud"], "Q2") == [("Q2", 500.0), ("H1", 900.0)]


def test_missing_rate_is_told(spark):
    schema = "doc_id long, metric string, model string, period_type string, value double, value_text string, unit string, quote string, section string, kind string, value_usd double, fx_rate double, fx_date date, currency string"
    row = (1, "m", "x", "FY", 5.0, "5", "count", "it is so", "s", "direct", None, None, None, None)
    new = spark.createDataFrame([row], schema)
    docs = spark.createDataFrame([(1, "CNY")], "doc_id long, currency string").withColumn("period", F.lit("2020-01-01").cast("date"))
    rates = spark.createDataFrame([], "currency string, rate_date date, rate double")
    out = write.write_results(new.limit(0), new, docs, rates, ["value"])
    assert [r.messages for r in out["errors"].collect()] == [["no exchange rate: the value in dollars is missing"]] and out["facts"].count() == 1




def said_in(texts, quotes):
    """(text, quote) pairs that an index finds and the counts that it gives, without Spark."""
    columns = list(provenances._indexed([pa.RecordBatch.from_pydict({"q": quotes, "block": pa.array([0] * len(quotes), pa.int32())})]))
    tiers = provenances.tiers_of(pa.Table.from_batches(columns))
    short, long = {}, Counter()
    provenances.counted_in(texts, np.ones(len(texts), np.int64), tiers, short, long)
    counts = {**long, **{q: n for t in tiers if t.length in short for q, n in zip(t.short, short[t.length].tolist(), strict=True)}}
    return set(provenances.found_in(texts, tiers)), counts


@pytest.mark.parametrize("base", [provenances._BASE, 1])
def test_provenance_index(monkeypatch, base):
    """Pairs and counts from windows' hashes, also with a base for which all strings of the same letters share a hash."""
    monkeypatch.setattr(provenances, "_BASE", base)
    monkeypatch.setattr(provenances, "_INVERSE", pow(base, -1, 1 << 64))
    monkeypatch.setattr(provenances, "_POWERS", {})
    monkeypatch.setattr(provenances, "BATCH_CHARS", 700)
    monkeypatch.setattr(provenances, "MOST_AT_ONCE", 50)
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab日🙂\0") for _ in range(rng.choice([0, 1, 5, 300]))) for _ in range(60)] + ["ab" * 600, "", "ba" * 80]
    whole = [t for t in texts if t]
    quotes = sorted({t[k : k + rng.choice([1, 2, 3, 7, 15, 16, 17, 33, 70, 130, 400])] for t in whole * 4 for k in [rng.randrange(len(t))]} | {"x", "ab" * 100, "aab", whole[0][-1] + whole[1][0]})
    found, counts = said_in(texts, quotes)
    want = {(i, q) for i, t in enumerate(texts) for q in quotes if q in t}
    assert {(i, q) for i, q in found if q in set(quotes)} == want
    assert {q: n for q, n in counts.items() if n and q in set(quotes)} == Counter(q for _, q in want)


def test_provenance_reads_texts_once(spark):
    """Eighteen thousand quotes of 180 characters, more than an automaton of a million held, are one index; copies count."""
    texts = spark.range(18_000).select(F.col("id").alias("i"), F.repeat(F.concat(F.lit("w"), F.expr("id div 2"), F.lit(" ")), 30).alias("t"))
    quotes = texts.select(F.col("i").alias("q"), F.rpad(F.substring("t", 1, 180), 180, "-").alias("s"))
    sent = list(provenances._sent(provenances._asked(quotes, "q", "s"), provenances.BLOCK_CHARS))
    assert len(sent) == 1
    got = provenances.containing(texts, texts.selectExpr("i q", "substring(t, 2, 21) s"), "i", "t", "q", "s")
    assert got.agg(F.count("*"), F.sum("n")).first()[:] == (18_000, 36_000)


def test_containing_counts_ids_once(spark):
    """Ids that repeat or are null: their texts and quotes count together."""
    texts = [(1, "a b"), (1, "b c"), (2, "b"), (None, "c")]
    quotes = [("x", "a"), ("x", "c"), ("y", "b"), ("z", "q"), ("n", " ")]
    got = dict(provenances.containing(spark.createDataFrame(texts, "i int, t string"), spark.createDataFrame(quotes, "q string, s string"), "i", "t", "q", "s").collect())
    assert got == {"x": 1, "y": 2}
    some = spark.createDataFrame([(1, "a"), (2, "a")], "i int, t string")
    assert provenances.containing(some, some.limit(0).toDF("q", "s"), "i", "t", "q", "s").count() == 0
    assert dict(provenances.containing(some, some.toDF("q", "s"), "i", "t", "q", "s").collect()) == {1: 2, 2: 2}
