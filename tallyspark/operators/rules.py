"""Rules kept as tables: scopes with wildcards and ranges, names and aliases by their trigrams, value patterns by literals."""

from __future__ import annotations

import re
from collections import OrderedDict
from collections.abc import Callable
from itertools import combinations
from uuid import uuid4

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import labels as L
from tallyspark.plans.shared import fresh_folder, sent
from tallyspark.plans.views import SQL, companies, filings, table

#: Patterns for all owners that are sent to all tasks at once; each worker compiles those that a text meets.
BLOCK_PATTERNS = 5_000
#: Patterns of an owner that meet a text in a row, and such rows whose patterns a worker keeps compiled.
OWN_PATTERNS, KEPT = 64, 500


def _written(rows: DataFrame, name: str) -> DataFrame:
    path = fresh_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def blocks_of_range(low: Column, high: Column, levels: int) -> Column:
    """The blocks (level, block) of 2^level numbers from 0 on that together are the range, both ends in it: two a level at most."""
    start = F.struct(low.cast("long").alias("a"), high.cast("long").alias("b"), F.array().cast("array<struct<level:int,block:bigint>>").alias("out"))

    def step(acc, level):
        a, b = acc["a"], acc["b"]
        one = lambda x: F.array(F.struct(level.cast("int").alias("level"), x.alias("block")))
        none = F.array().cast("array<struct<level:int,block:bigint>>")
        left, right = a % 2 == 1, (b % 2 == 0) & ~((a == b) & (a % 2 == 1))
        out = F.concat(acc["out"], F.when(left, one(a)).otherwise(none), F.when(right, one(b)).otherwise(none))
        wider = F.struct(F.shiftright(F.when(left, a + 1).otherwise(a), 1).alias("a"), F.floor(F.when(right, b - 1).otherwise(b) / 2).cast("long").alias("b"), out.alias("out"))
        return F.when(a <= b, wider).otherwise(acc)  # what is covered, or was empty, stays so

    return F.aggregate(F.sequence(F.lit(0), F.lit(levels - 1)), start, step, lambda acc: acc["out"])


def scope_matches(rules: DataFrame, rows: DataFrame, rule_id: str, fields: list[str], value: str, low: str = "low", high: str = "high") -> DataFrame:
    """rows with rule_id, once for each rule that fits: each of its fields is null or equal, and the row's value is within its
    range, whose ends count and may be null.

    Rules are grouped by the fields that they set, so that each group is an equality join. A range is cut into blocks of powers
    of two, and a value lies in one block of each size; it meets a rule in exactly one of them. Nulls in a row's fields fit
    rules that don't set them; rows without a value fit rules without a range."""
    out = _met(rules, rows, lambda held: rows, rule_id, fields, value, low, high)
    return out if out is not None else rows.withColumn(rule_id, F.lit(None).cast(rows.schema[rule_id].dataType)).limit(0)


def scope_totals(rules: DataFrame, rows: DataFrame, rule_id: str, fields: list[str], value: str, key: str, low: str = "low", high: str = "high") -> DataFrame:
    """(rule_id, n, first): how many rows each rule fits, and their smallest key; rules that fit none are left out.

    What scope_matches() gives, counted without its pairs: rows are counted by the fields that a group of rules sets and the
    value, so a rule for all meets one row for each value, however many rows there are."""
    every = _written(rows.groupBy(*fields, value).agg(F.count("*").alias("n"), F.min(key).alias("first")), "scope-counts")
    totals = [F.sum("n").alias("n"), F.min("first").alias("first")]
    out = _met(rules, every, lambda held: every.groupBy(*held, value).agg(*totals), rule_id, fields, value, low, high)
    return out.groupBy(rule_id).agg(*totals) if out is not None else rules.select(rule_id).crossJoin(every.select("n", "first")).limit(0)


def _met(rules: DataFrame, rows: DataFrame, side: Callable[[tuple], DataFrame], rule_id: str, fields: list[str], value: str, low: str, high: str) -> DataFrame | None:
    """The rows that side() gives for the fields held by a group of rules, with each rule that fits; None without rules."""
    first, last = rows.agg(F.min(value), F.max(value)).first()
    first, last = (0, 0) if first is None else (int(first), int(last))
    levels = max(1, (last - first + 1).bit_length())
    a, b = F.greatest(F.coalesce(F.col(low), F.lit(first)), F.lit(first)) - first, F.least(F.coalesce(F.col(high), F.lit(last)), F.lit(last)) - first
    ranged = F.col(low).isNotNull() | F.col(high).isNotNull()
    whole = F.array(F.struct(F.lit(-1).alias("level"), F.lit(0).cast("bigint").alias("block")))
    cut = rules.select(rule_id, *[F.col(f).alias(f"__{f}") for f in fields], F.explode(F.when(ranged, blocks_of_range(a, b, levels)).otherwise(whole)).alias("p"))
    cut = _written(cut.select(rule_id, *[f"__{f}" for f in fields], F.col("p.level").alias("__level"), F.col("p.block").alias("__block")), "scopes")
    blocks = F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), lambda k: F.struct(k.alias("level"), F.floor((F.col(value) - first) / F.pow(F.lit(2.0), k)).cast("bigint").alias("block")))
    own = F.concat(whole, F.when(F.col(value).isNotNull(), blocks).otherwise(F.array().cast("array<struct<level:int,block:bigint>>")))
    out = None
    for k in range(len(fields) + 1):
        for held in combinations(fields, k):
            mask = [F.col(f"__{f}").isNotNull() if f in held else F.col(f"__{f}").isNull() for f in fields]
            group = cut.filter(F.lit(True) if not mask else _all(mask)).select(rule_id, *[F.col(f"__{f}").alias(f) for f in held], "__level", "__block")
            if group.isEmpty():
                continue
            given = side(held)
            spread = given.withColumn("__p", F.explode(own)).withColumns({"__level": F.col("__p.level"), "__block": F.col("__p.block")}).drop("__p")
            hit = spread.join(sent(group), [*held, "__level", "__block"]).select(*given.columns, rule_id)
            out = hit if out is None else out.unionByName(hit, allowMissingColumns=True)
    return out


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _grams(text: Column, n: int) -> Column:
    """The different runs of n characters; none of shorter texts."""
    places = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(n))))


def resolve(phrases: DataFrame, names: DataFrame, phrase: str, pos: str, key: str, aliases: str) -> DataFrame:
    """phrases (once each) with the pos of what they name, or null: exactly the key, else equal to an alias, else a part of a
    key or an alias; of several the smallest pos. Letter case doesn't matter. Empty phrases name nothing.

    Keys and aliases are indexed by their trigrams. A phrase looks up the rarest of its own and is compared with the texts that
    have it; phrases of one or two characters are looked up as such. Texts are indexed once, with their smallest pos."""
    asked = _written(phrases.select(phrase).distinct().withColumn("__p", F.lower(phrase)), "phrases")
    some = asked.select("__p").filter("__p <> ''").distinct()
    own = names.select(F.col(pos).alias("pos"), F.lower(key).alias("text"))
    other = names.select(F.col(pos).alias("pos"), F.explode(F.transform(aliases, lambda x: F.lower(x))).alias("text"))
    least = lambda rows, tier: rows.filter("text is not null").groupBy("text").agg(F.min("pos").alias("pos")).withColumn("tier", F.lit(tier))
    exact = least(own, 0).unionByName(least(other, 1)).withColumnRenamed("text", "__p")
    hits = some.join(exact, "__p").select("__p", "tier", "pos")
    texts = _written(least(own.unionByName(other), 2), "name-texts")
    for n in (1, 2, 3):
        sized = some.filter(F.length("__p") == n if n < 3 else F.length("__p") >= 3)
        if sized.isEmpty():
            continue
        index = texts.select("text", "pos", F.explode(_grams(F.col("text"), n)).alias("gram"))
        wanted = _written(sized.select("__p", F.explode(_grams(F.col("__p"), n)).alias("gram")), "phrase-grams")
        common = index.groupBy("gram").agg(F.count("*").alias("n"))
        rarest = wanted.join(common, "gram", "left").groupBy("__p").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
        found = index.join(sent(_written(rarest, "rarest-grams")), "gram").filter(F.contains("text", F.col("__p")))
        hits = hits.unionByName(found.select("__p", F.lit(2).alias("tier"), "pos"))
    best = hits.groupBy("__p").agg(F.min_by("pos", F.struct("tier", "pos")).alias("pos"))
    return asked.join(best, "__p", "left").select(phrase, "pos")


_ANY = re.compile(r"\\.|\[(?:\\.|[^\]])*\]|\(\?[a-zA-Z]+\)|[(|)?*+{}.^$]|[^\\\[(|)?*+{}.^$]+")


def literal_of(pattern: str) -> str:
    """A piece of text that is in whatever a pattern matches: the longest run of plain characters outside groups, choices and
    repetitions; empty where there is none, and for patterns that ignore case or have flags."""
    if re.search(r"\(\?[a-zA-Z]", pattern) or "|" in re.sub(r"\\.|\[(?:\\.|[^\]])*\]|\([^()]*\)", "", pattern):
        return ""
    runs, depth = [""], 0
    for m in _ANY.finditer(pattern):
        part = m[0]
        if part == "(":
            depth += 1
            runs.append("")
        elif part == ")":
            depth -= 1
            runs.append("")
        elif part in "?*+{":
            runs[-1] = runs[-1][:-1]  # the sign before it may be missing
            runs.append("")
            depth += part == "{"
        elif part == "}":
            depth -= 1
        elif depth == 0 and len(part) == 2 and part[0] == "\\" and not part[1].isalnum():
            runs[-1] += part[1]
        elif depth == 0 and part[0] not in "\\[(|.^$":
            runs[-1] += part
        else:
            runs.append("")
    return max(runs, key=len)


#: What a Python worker has compiled last: by its block, and by owner.
_LAST: dict[str, tuple] = {}
_OWN: OrderedDict[tuple, tuple] = OrderedDict()


def _prepared(rows: list[tuple]) -> tuple:
    """(automaton of literals or None, patterns without one, compiled patterns) of (owner or None, field, priority, pattern)."""
    by: dict[str, list[int]] = {}
    for k, r in enumerate(rows):
        by.setdefault(literal_of(r[3]), []).append(k)
    always, automaton = by.pop("", []), None
    if by:
        automaton = ahocorasick.Automaton()
        for literal, own in by.items():
            automaton.add_word(literal, own)
        automaton.make_automaton()
    return automaton, always, {}


def _ready(key: str, rows: list[tuple]) -> tuple:
    if key not in _LAST:
        _LAST.clear()
        _LAST[key] = _prepared(rows)
    return _LAST[key]


def _own_ready(key: tuple, rows: pa.Scalar) -> tuple:
    """(rows, what _prepared() gives) of an owner's patterns; texts come in the order of their owners."""
    if key not in _OWN:
        given = [(None, x["field"], x["priority"], x["pattern"]) for x in rows.as_py()]
        _OWN[key] = given, _prepared(given)
        if len(_OWN) > KEPT:
            _OWN.popitem(last=False)
    return _OWN[key]


def matches(text: str, rows: list[tuple], prepared: tuple) -> list[tuple[str, int, str, str, str]]:
    """(field, priority, number, unit, pattern) of the first matching pattern of each field; rows are in their order."""
    automaton, always, compiled = prepared
    may = set(always)
    for _, own in automaton.iter(text) if automaton else ():
        may.update(own)
    out: dict[str, tuple] = {}
    for k in sorted(may):
        _, field, priority, pattern = rows[k]
        if field not in out:
            if k not in compiled:
                compiled[k] = re.compile(pattern)
            if m := compiled[k].search(text):
                out[field] = (field, priority, m[1], m[2] if m.re.groups > 1 else None, pattern)
    return list(out.values())


def _found(ids: pa.Array, id_col: str, said: list[list[tuple]]) -> pa.RecordBatch:
    take = pa.array([k for k, x in enumerate(said) for _ in x], pa.int64())
    parts = list(zip(*[v for x in said for v in x], strict=True)) or [()] * 5
    columns = [pa.array(c, t) for c, t in zip(parts, (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()), strict=True)]
    return pa.RecordBatch.from_arrays([ids.take(take), *columns], [id_col, "field", "priority", "number", "unit", "pattern"])


def pattern_table_values(texts: DataFrame, patterns: DataFrame, id_col: str, owner_col: str, text_col: str, block: int = BLOCK_PATTERNS) -> DataFrame:
    """(id, field, value, priority): of each field the value, in millions, of the first pattern that a text matches.

    patterns: owner (null: for all), field, priority, pattern (Python's; its groups are the number and, if there are two, the
    unit). An owner's patterns meet its texts in a join by the owner, some of them in a row, so a text is walked for those of
    its owner only, however many owners there are. Patterns for all go to all tasks in blocks. One walk over a text tells, by
    their literals, which patterns it can match; these are tried in the order of priority, then of the pattern's text."""
    spark = texts.sparkSession
    rows = patterns.select(F.col("owner").cast("string").alias("owner"), "field", "priority", "pattern").filter("pattern is not null").distinct()
    kept = _written(rows, "patterns")
    kind = texts.schema[id_col].dataType.simpleString()
    given = texts.filter(F.col(text_col).isNotNull()).select(id_col, F.col(owner_col).cast("string").alias("__owner"), F.col(text_col).alias("__text"))
    name = uuid4().hex
    shape = f"`{id_col}` {kind}, field string, priority int, number string, unit string, pattern string"

    own = kept.filter("owner is not null").withColumnRenamed("owner", "__owner")
    sizes = own.groupBy("__owner").agg(F.ceil(F.count("*") / OWN_PATTERNS).alias("__chunks"))
    dealt = own.join(sizes, "__owner").withColumn("__chunk", F.pmod(F.xxhash64("field", "pattern"), F.col("__chunks")))
    chunks = dealt.groupBy("__owner", "__chunk").agg(F.sort_array(F.collect_list(F.struct("priority", "pattern", "field"))).alias("__patterns"))

    def walk_own(batches, name=name):
        for batch in batches:
            said = []
            for owner, chunk, text, held in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), batch.column(4), strict=True):
                said.append(matches(text.as_py(), *_own_ready((name, owner, chunk), held)))
            yield _found(batch.column(0), id_col, said)

    # Merged, not broadcast: texts then come in the order of their owners, whose patterns a worker compiles once.
    met = given.join(chunks.hint("merge"), "__owner").select(id_col, "__owner", "__chunk", "__text", "__patterns")
    out = met.mapInArrow(walk_own, shape)

    every = kept.filter("owner is null")
    n = max(1, -(-every.count() // block))
    for b in range(n):
        part = every.filter(F.pmod(F.xxhash64("field", "pattern"), F.lit(n)) == b)
        held = sorted((tuple(r) for r in part.select("owner", "field", "priority", "pattern").collect()), key=lambda r: (r[2], r[3]))  # about a block
        if not held:
            continue
        shared, of = spark.sparkContext.broadcast(held), f"{name}-{b}"

        def walk(batches, shared=shared, of=of):
            for batch in batches:
                yield _found(batch.column(0), id_col, [matches(t.as_py(), shared.value, _ready(of, shared.value)) for t in batch.column(1)])

        out = out.unionByName(given.select(id_col, "__text").mapInArrow(walk, shape))
    best = F.min_by(F.struct("number", "unit", "priority"), F.struct("priority", "pattern", "number", "unit")).alias("m")
    first = out.groupBy(id_col, "field").agg(best)
    return first.select(id_col, "field", L.scaled_millions(F.col("m.number"), F.coalesce("m.unit", F.lit("million"))).alias("value"), "m.priority")


def _rules(spark, sf_dir) -> DataFrame:
    """Parts as rules: most for a company or a form, few for all; ranges of years with open ends."""
    k = F.col("p_partkey")
    some = F.when(k % 97 > 0, k * 31 % 997 + 1)
    return table(spark, sf_dir, "part").select(
        k.alias("rule"), some.alias("ticker"), F.when(k % 4 == 0, F.element_at(F.array(*[F.lit(x) for x in ("10-K", "10-Q", "6-K", "20-F", "HK-IR")]), (k % 5 + 1).cast("int"))).alias("form"),
        F.when(k % 3 > 0, 1990 + k % 11).cast("int").alias("low"), F.when(k % 5 > 0, 1990 + k % 11 + k % 7).cast("int").alias("high"),
    )


def scope_rules(spark, sf_dir):
    """How many filings each rule fits, and the first."""
    out = scope_totals(_rules(spark, sf_dir), filings(spark, sf_dir).select("doc_id", "ticker", "form", "fy"), "rule", ["ticker", "form"], "fy", "doc_id")
    return out.withColumnRenamed("n", "filings")


def alias_phrases(spark, sf_dir):
    """Pieces cut from all part names, whole names and brands as phrases, against names, types and brands."""
    p = table(spark, sf_dir, "part")
    cut = F.expr("substring(upper(p_name), cast(p_partkey % 6 + 1 as int), cast(p_partkey % 9 + 1 as int))")
    said = F.explode(F.array(cut, F.when(F.col("p_partkey") % 10 == 0, F.col("p_name")), F.when(F.col("p_partkey") % 50 == 0, F.concat("p_brand", F.lit("x"))))).alias("phrase")
    phrases = p.select(said).filter("phrase is not null")
    return resolve(phrases, p.select("p_partkey", "p_name", F.array("p_type", "p_brand").alias("aliases")), "phrase", "p_partkey", "p_name", "aliases")


def _statements(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders")
    number, unit = F.format_number(F.floor("o_totalprice"), 0), F.when(F.col("o_orderkey") % 3 == 0, "billion").otherwise("million")
    said = F.element_at(F.array(*[F.lit(x) for x in ("revenue was", "sales came to", "income of", "nothing for")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    text = F.concat(F.lit("Unit-"), F.col("o_custkey") + F.col("o_orderkey") % 7 % 2, F.lit("; "), said, F.lit(" RMB "), number, F.lit(" "), unit, F.lit(". Total of RMB 7 million"))
    texts = o.select("o_orderkey", "o_custkey", text.alias("text"))
    c = companies(spark, sf_dir)
    own = c.select(F.col("ticker").alias("owner"), F.lit("revenue").alias("field"), F.explode(F.array(
        F.struct(F.lit(1).alias("priority"), F.concat(F.lit(r"Unit-"), "ticker", F.lit(r"; revenue was RMB ([\d,]+) (million|billion)")).alias("pattern")),
        F.struct(F.lit(2).alias("priority"), F.concat(F.lit(r"Unit-"), "ticker", F.lit(r"; (?:sales came to|income of) RMB ([\d,]+) (million|billion)")).alias("pattern")))).alias("p"))
    every = spark.createDataFrame([(None, "revenue", 9, r"[Tt]otal of RMB\s+([\d,]+) (million|billion)"), (None, "units", 1, r"Unit-(\d+);")], "owner long, field string, priority int, pattern string")
    return texts, own.select("owner", "field", "p.*").unionByName(every)


def pattern_table(spark, sf_dir):
    """Values of orders' sentences by two patterns for each company and two for all."""
    texts, patterns = _statements(spark, sf_dir)
    return pattern_table_values(texts, patterns, "o_orderkey", "o_custkey", "text")


QUERIES = {"scope_rules": scope_rules, "alias_phrases": alias_phrases, "pattern_table": pattern_table}
ORACLES = {
    "scope_rules": f"""{SQL}, r AS (SELECT p_partkey AS rule, CASE WHEN p_partkey % 97 > 0 THEN p_partkey * 31 % 997 + 1 END AS ticker, CASE WHEN p_partkey % 4 = 0 THEN ['10-K', '10-Q', '6-K', '20-F', 'HK-IR'][p_partkey % 5 + 1] END AS form,
  CASE WHEN p_partkey % 3 > 0 THEN 1990 + p_partkey % 11 END AS low, CASE WHEN p_partkey % 5 > 0 THEN 1990 + p_partkey % 11 + p_partkey % 7 END AS high FROM part)
SELECT rule, count(*) AS filings, min(doc_id) AS first FROM r JOIN filings f ON (r.ticker IS NULL OR r.ticker = f.ticker) AND (r.form IS NULL OR r.form = f.form) AND (low IS NULL OR fy >= low) AND (high IS NULL OR fy <= high) GROUP BY rule""",
    "alias_phrases": """WITH n AS (SELECT p_partkey AS pos, lower(p_name) AS k, [lower(p_type), lower(p_brand)] AS a FROM part),
q AS (SELECT DISTINCT phrase FROM (SELECT unnest([substr(upper(p_name), (p_partkey % 6 + 1)::INT, (p_partkey % 9 + 1)::INT), CASE WHEN p_partkey % 10 = 0 THEN p_name END, CASE WHEN p_partkey % 50 = 0 THEN p_brand || 'x' END]) AS phrase FROM part) WHERE phrase IS NOT NULL),
t AS (SELECT phrase, pos, CASE WHEN k = lower(phrase) THEN 0 WHEN list_contains(a, lower(phrase)) THEN 1 WHEN contains(k, lower(phrase)) OR contains(a[1], lower(phrase)) OR contains(a[2], lower(phrase)) THEN 2 END AS tier FROM q, n WHERE phrase <> '')
SELECT phrase, arg_min(pos, (tier, pos)) FILTER (tier IS NOT NULL) AS pos FROM q LEFT JOIN t USING (phrase) GROUP BY phrase""",
    "pattern_table": """WITH o AS (SELECT o_orderkey, o_orderkey % 7 % 2 = 0 AS own, o_orderkey % 4 AS s, floor(o_totalprice) * CASE WHEN o_orderkey % 3 = 0 THEN 1000 ELSE 1 END AS v, o_custkey + o_orderkey % 7 % 2 AS unit FROM orders)
SELECT o_orderkey, 'revenue' AS field, CASE WHEN own AND s < 3 THEN v ELSE 7 END::DOUBLE AS value, CASE WHEN own AND s = 0 THEN 1 WHEN own AND s < 3 THEN 2 ELSE 9 END::INTEGER AS priority FROM o UNION ALL SELECT o_orderkey, 'units', unit::DOUBLE, 1 FROM o""",
}
