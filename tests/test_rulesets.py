"""Rules kept as tables against nested loops: scopes, names, patterns."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import rules as R


def test_blocks_cover_ranges(spark):
    """Every range below 40: its blocks are disjoint and together the range; an empty one has none."""
    rows = [(a, b) for a in range(40) for b in range(a - 2, 40)]
    df = spark.createDataFrame(rows, "a int, b int").select("a", "b", R.blocks_of_range(F.col("a"), F.col("b"), 6).alias("blocks"))
    for r in df.collect():
        got = sorted(x for k in r.blocks for x in range(k.block << k.level, (k.block + 1) << k.level))
        assert got == list(range(r.a, r.b + 1)), r


@pytest.mark.parametrize("n", [0, 300])
def test_scopes(spark, n):
    """Random rules, with wildcards, open and empty ranges, beyond the values, and rows with nulls and repeats."""
    rng = random.Random(4)
    pick = lambda *xs: rng.choice([None, *xs])
    rules = [(k, pick(1, 2, 3), pick("a", "b"), pick(*range(-3, 60)), pick(*range(-3, 60))) for k in range(n)]
    rows = [(pick(1, 2, 3, 4), pick("a", "b", "c"), pick(*range(5, 50)), k) for k in range(120)] * 2
    out = R.scope_matches(spark.createDataFrame(rules, "rule long, t int, f string, low int, high int"), spark.createDataFrame(rows, "t int, f string, y int, k int"), "rule", ["t", "f"], "y") if n else None
    if out is None:
        empty = R.scope_matches(spark.createDataFrame([(1, 1)], "rule long, t int").select("rule", "t", F.lit(1).alias("low"), F.lit(2).alias("high")).limit(0).withColumn("f", F.lit("a")), spark.createDataFrame(rows, "t int, f string, y int, k int").withColumn("rule", F.lit(0).cast("long")), "rule", ["t", "f"], "y")
        assert empty.count() == 0
        return

    def fits(rule, row):
        _, t, f, low, high = rule
        ranged = low is not None or high is not None
        return (t is None or t == row[0]) and (f is None or f == row[1]) and (not ranged or (row[2] is not None and (low is None or low <= row[2]) and (high is None or row[2] <= high)))

    want = sorted((row[3], rule[0]) for rule in rules for row in rows if fits(rule, row))
    assert sorted((r.k, r.rule) for r in out.collect()) == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_names(spark):
    rng = random.Random(6)
    words = ["Red", "green", "Blue-ish", "wid", "WIDGET", "é日", "x", "a b"]
    names = [(k, " ".join(rng.choices(words, k=rng.randint(1, 3))), [rng.choice([*words, None]) for _ in range(rng.randint(0, 2))]) for k in range(60)] + [(90, None, None), (3, "Red", ["zz"])]
    phrases = ["red", "RED", "wid", "ish w", "é日", "日", "x", "", None, "a b", "zz", "zzz", "idge", "green widget", "b", "d g"]
    got = dict(R.resolve(spark.createDataFrame([(p,) for p in phrases * 2], "phrase string"), spark.createDataFrame(names, "pos int, key string, a array<string>"), "phrase", "pos", "key", "a").collect())

    def plain(p):
        if not p:
            return None
        p, found = p.lower(), []
        for pos, key, aliases in names:
            k, a = (key or "\0").lower(), [x.lower() for x in aliases or [] if x]
            tier = 0 if k == p else 1 if p in a else 2 if any(p in x for x in [k, *a]) else None
            if tier is not None:
                found.append((tier, pos))
        return min(found)[1] if found else None

    assert got == {p: plain(p) for p in phrases}


PATTERNS = [r"revenue of RMB\s*([\d,.]+)\s*(million|billion)", r"[Tt]otal ([\d,]+)", r"a(?:b|c)d ([0-9]+) (million)", r"x?yz\.w ([0-9]+)", r"(?i)SALES ([0-9]+)", r"one ([0-9]+)|two", r"\bnet\s+([0-9]+)", r"q{2}r ([0-9]+)", r"k+end ([0-9]+)", r"[a-z]+ at ([0-9]+)", r"end\$ ([0-9]+)"]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_literals(pattern):
    """Whatever a pattern matches has its literal."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=40, deadline=None, database=None)
    @given(st.from_regex(pattern))
    def check(text):
        assert R.literal_of(pattern) in re.search(pattern, text)[0]

    check()


def test_literal_cases():
    got = [R.literal_of(p) for p in PATTERNS]
    assert got == ["revenue of RMB", "otal ", "d ", "yz.w ", "", "", "net", "r ", "end ", " at ", "end$ "]


@pytest.mark.parametrize("block", [3, 5_000])
def test_pattern_table(spark, block):
    """The first pattern by priority, of the text's owner or of all, whatever the block."""
    patterns = [(1, "f", 2, r"revenue of ([\d,]+) (million|billion)"), (1, "f", 1, r"sales ([\d,]+)"), (None, "f", 5, r"([\d,]+) (million|billion)"), (2, "f", 1, r"other ([\d,]+)"), (2, "g", 1, r"(?i)G ([\d,]+)"), (None, "h", 1, r"h([0-9]) (million)"), (1, "f", 3, None)]
    texts = [(1, 1, "revenue of 1,500 million, sales 7"), (2, 1, "revenue of 2 billion"), (3, 2, "revenue of 2 billion g 12"), (4, 3, "nothing"), (5, None, "h1 million"), (6, 1, None), (7, 2, "other 5, h2 million")]
    out = R.pattern_table_values(spark.createDataFrame(texts, "i int, o int, t string"), spark.createDataFrame(patterns, "owner int, field string, priority int, pattern string"), "i", "o", "t", block)
    assert sorted(map(tuple, out.collect())) == [(1, "f", 7.0, 1), (2, "f", 2000.0, 2), (3, "f", 2000.0, 5), (3, "g", 12.0, 1), (5, "f", 1.0, 5), (5, "h", 1.0, 1), (7, "f", 5.0, 1), (7, "h", 2.0, 1)]
    none = spark.createDataFrame([], "owner int, field string, priority int, pattern string")
    assert R.pattern_table_values(spark.createDataFrame(texts, "i int, o int, t string"), none, "i", "o", "t").count() == 0
