"""Personal data: base patterns, and terms that disclose it by corpus co-occurrence. DataFrame functions only.

Base spans are found by pattern (email, ip, card, phone) with their checks; positions come from the lengths of the matches
and of what lies between them. The values found are the protected entities. Terms are letter runs of three or more,
lowered, outside base spans. A term discloses an entity as far as it tells it: PMI(term, entity) / IC(entity), which is 1 when each occurrence
of the term in the corpus stands near the entity. Near is within `window` code points of one of its spans; a term must be
near in min_contexts different contexts, so that copies of one text are no evidence. Terms above `threshold` are
generalised where they stand near the entity, those above `removal` are removed.

Counts cover every text, equal ones once: near and anywhere alike are occurrences in different texts. Only terms that are
candidates (near one entity in enough contexts) are kept while counting.

Defined cases: a null text is an empty one; null ids are allowed. Rows that repeat get equal results. In clean_text
overlapping spans count from the left, the longer first. Other columns pass through; where a name clashes, the added column replaces the caller's. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import BROADCAST_ROWS, checked_join, need, plain, table, written

#: The contract's patterns. Lookbehind or \\G start each match at the first character that can start one, and possessive
#: loops never go back, so that long runs take linear time; the matches are those of the plain patterns.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold to be searched at all.
HINTS = {"email": "@", "phone": "+"}
TERM = r"\p{L}{3,}"
WINDOW = 64
MIN_CONTEXTS = 2
THRESHOLD = 0.9
REMOVAL = 0.98
SPAN = "struct<start:int,end:int,value:string>"
SPANS = f"array<{SPAN}>"
SCAN_BLOCK = 64
BLOCK = 512


def bound(value: Column, f) -> Column:
    """f(value), with the value computed once however often f uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def scan(items: Column, kind: str, step) -> Column:
    """What a walk over an array gives: step(at, item) -> (next at, items to give), from at = 0.

    An array that grows by one item a step is copied each time; so items are walked in blocks, whose results are joined.
    """
    empty, block = F.array().cast(f"array<{kind}>"), F.lit(SCAN_BLOCK)

    def over(all_):
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.size(all_) - 1, F.lit(0)), block), lambda i: F.slice(all_, i + 1, block))

        def one(acc, items):
            def inner(acc, x):
                at, more = step(acc["at"], x)
                return F.struct(at.alias("at"), F.concat(acc["out"], more.cast(f"array<{kind}>")).alias("out"))

            got = F.aggregate(items, F.struct(acc["at"].alias("at"), empty.alias("out")), inner)
            return bound(got, lambda g: F.struct(g["at"].alias("at"), F.concat(acc["parts"], F.array(g["out"])).alias("parts")))

        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("parts"))
        return F.aggregate(blocks, start, one, lambda acc: F.flatten(acc["parts"]))

    return bound(items, over)


def located(text: Column, pattern: str) -> Column:
    """The matches of a pattern in a text, with their places in code points."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1)
    parts = F.zip_with(found, F.slice(between, F.lit(1), F.size(found)), lambda m, gap: F.struct(m.alias("m"), F.length(gap).alias("gap"), F.length(m).alias("n")))

    def step(at, x):
        a = at + x["gap"]
        return a + x["n"], F.array(F.struct(a.alias("start"), (a + x["n"]).alias("end"), x["m"].alias("value")))

    return scan(parts, SPAN, step)


def blocks_of(text: Column) -> Column:
    """A text in blocks of BLOCK characters, of which a part can be read without walking through the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), 0)


def part(blocks: Column, start: Column, end: Column) -> Column:
    """The characters from start to end of a text in blocks."""
    first = F.floor(start / BLOCK).cast("int")
    some = F.array_join(F.slice(blocks, first + 1, F.floor(end / BLOCK).cast("int") - first + 1), "")
    return F.when(end > start, F.substring(some, start - first * BLOCK + 1, end - start)).otherwise("")


def luhn(digits: Column) -> Column:
    signs = F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), 0), lambda c, i: c.cast("int") * (1 + i % 2))
    return F.aggregate(signs, F.lit(0), lambda acc, d: acc + d - F.when(d > 9, 9).otherwise(0)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$")
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """The valid spans of one kind."""
    hint = text.contains(HINTS[kind]) if kind in HINTS else text.rlike(r"[0-9]\.[0-9]" if kind == "ip" else r"[0-9](?:[\x20-]?[0-9]){12}")
    return F.when(hint, F.filter(located(text, PATTERNS[kind]), lambda x: _valid(kind, x["value"]))).otherwise(F.array().cast(SPANS))


def _entities() -> Column:
    """All base spans of a row with their kind and normalised value."""

    def of(kind):
        def entity(x):
            value = F.lower(x["value"]) if kind == "email" else x["value"] if kind == "ip" else F.regexp_replace(x["value"], "[^0-9]", "")
            return F.struct(F.concat(F.lit(f"{kind}:"), value).alias("entity"), x["start"].alias("start"), x["end"].alias("end"))

        return F.transform(f"__{kind}", entity)

    return F.concat(*map(of, PATTERNS))


def _near(window: int) -> Column:
    """The terms near each entity of a row: letter runs of the text with base spans blanked out."""
    text, blank, spans, length = F.col("__blocks"), F.col("__blank"), F.col("__entities"), F.col("__length")

    def of(x):
        first, last = F.greatest(x["start"] - window, F.lit(0)), F.least(x["end"] + window, length)
        context = F.xxhash64(part(text, first, x["start"]), part(text, x["end"], last))
        left = part(blank, first, x["start"])
        left = F.when(first > 0, F.regexp_replace(left, r"^\p{L}+", "")).otherwise(left)  # words that the window cuts
        right = part(blank, x["end"], last)
        right = F.when(last < length, F.regexp_replace(right, r"\p{L}+$", "")).otherwise(right)
        return bound(F.struct(left.alias("left"), right.alias("right"), context.alias("context")), lambda sides: around(x, sides))

    def around(x, sides):
        def terms(side, offset):
            return F.transform(located(side, TERM), lambda t: F.struct(x["entity"].alias("entity"), x["start"].alias("at"), F.lower(t["value"]).alias("term"), (offset + t["start"]).alias("start"), (offset + t["end"]).alias("end"), sides["context"].alias("context")))

        return F.concat(terms(sides["left"], x["start"] - F.length(sides["left"])), terms(sides["right"], x["end"]))

    return F.flatten(F.transform(spans, of))


def _one_of_each(texts: DataFrame) -> DataFrame:
    """Each different text once. Only hashes are shuffled, and of texts that repeat one a task, so that large groups of copies
    are no large groups of rows; where more texts repeat than are broadcast, all go that way."""
    one = lambda rows: rows.groupBy("__hash").agg(F.first("text").alias("text")).select("text")
    twice = texts.groupBy("__hash").agg(F.count("*").alias("n")).filter("n > 1").select("__hash", F.lit(True).alias("__copied"))
    twice = written(twice, "pii-copied")
    if twice.count() > BROADCAST_ROWS:
        return one(texts)
    marked = texts.join(F.broadcast(twice), "__hash", "left")
    return marked.filter("__copied is null").select("text").unionByName(one(marked.filter("__copied")))


def disclosing(near: DataFrame, texts: DataFrame, min_contexts: int, threshold: float) -> DataFrame:
    """(entity, term, disclosure) above the threshold. near: (hash, entity, at, term, start, context) rows; texts: (hash, text) of every row."""
    contexts = near.select("entity", "term", "context").distinct().groupBy("entity", "term").agg(F.count("*").alias("contexts"))
    pairs = near.select("entity", "term", "__hash", "start").distinct().groupBy("entity", "term").agg(F.count("*").alias("together"))
    entities = near.select("entity", "__hash", "at").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    pairs = written(contexts.filter(F.col("contexts") >= min_contexts).join(pairs, ["entity", "term"]).join(entities, "entity"), "pii-pairs")
    candidates = written(pairs.select("term").distinct().withColumn("known", F.lit(True)), "pii-candidates")
    own = _one_of_each(texts)
    counts = own.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(TERM), 0)).alias("term"))
    known = F.when(F.col("known"), F.col("term")).alias("term")
    if candidates.count() <= BROADCAST_ROWS:
        # All other terms are counted under one null, for the corpus total; partial sums meet there, not rows.
        counts = counts.join(F.broadcast(candidates), "term", "left").groupBy(known).agg(F.count("*").alias("n_term"))
    else:  # partial sums of all different terms meet before the join
        counts = counts.groupBy("term").agg(F.count("*").alias("n")).join(candidates, "term", "left").groupBy(known).agg(F.sum("n").alias("n_term"))
    counts = written(counts, "pii-counts")
    total = counts.agg(F.coalesce(F.sum("n_term"), F.lit(0)).alias("n")).first()["n"]
    out = pairs.join(counts.filter("term is not null"), "term")
    # PMI / IC, where the total cancels out but for IC; of an entity as frequent as all terms only equality tells.
    less = F.try_divide(F.ln(F.try_divide("together", "n_term")), F.ln(F.try_divide(F.lit(float(total)), "n_entity")))
    less = F.when(F.col("n_entity") < total, F.coalesce(1 + less, F.lit(0.0))).otherwise(0.0)
    out = out.withColumn("disclosure", F.when(F.col("together") >= F.col("n_term"), 1.0).otherwise(less))
    return out.filter(F.col("disclosure") >= threshold).select("entity", "term", "disclosure")


def find_pii(docs: DataFrame, id_col="doc_id", text_col="text", window: int = WINDOW, min_contexts: int = MIN_CONTEXTS, threshold: float = THRESHOLD, removal: float = REMOVAL) -> DataFrame:
    """docs with `pii` (array of kind, start, end, action) and clean_text. Kinds are those of PATTERNS, then term."""
    need(docs, id_col, text_col)
    docs = plain(docs, "pii", "clean_text")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = {"__id": F.coalesce(F.col(id_col).cast("string"), F.lit("-")), "__hash": F.xxhash64(text)}
    rows = docs.withColumns(keys).withColumn("__text", text)
    spans = rows.withColumns({f"__{k}": base_spans(F.col("__text"), k) for k in PATTERNS})
    some = spans.filter(" + ".join(f"size(__{k})" for k in PATTERNS) + " > 0").select("__id", "__hash", "__text", _entities().alias("__entities"))
    some = some.withColumn("__blocks", blocks_of(F.col("__text"))).withColumn("__length", F.length("__text"))
    blank = _replaced(F.col("__blocks"), F.col("__length"), F.col("__entities"), lambda x: F.repeat(F.lit(" "), x["end"] - x["start"]))
    some = some.withColumn("__blank", blocks_of(blank)).drop("__text")
    near = written(some.select("__id", "__hash", F.explode(_near(window)).alias("t")).select("__id", "__hash", "t.*"), "pii-near")
    risky = written(disclosing(near, docs.select(keys["__hash"].alias("__hash"), text.alias("text")), min_contexts, threshold), "pii-disclosing")
    hits = checked_join(near, risky, ["entity", "term"], "inner", spread="__hash")
    action = F.when(F.max("disclosure") >= removal, "remove").otherwise("generalise")
    hits = hits.groupBy("__id", "__hash", "start", "end").agg(action.alias("action"))
    hits = hits.groupBy("__id", "__hash").agg(F.sort_array(F.collect_list(F.struct("start", "end", "action"))).alias("__terms"))
    out = checked_join(spans, written(hits, "pii-terms"), ["__id", "__hash"], "left", spread="__id", limit=20_000, size=F.size("__terms") * 32)
    kind = "array<struct<kind:string,start:int,end:int,action:string>>"

    def said(name, column, action):
        return F.transform(column, lambda x: F.struct(F.lit(name).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), action(x).alias("action")))

    base = [said(k, f"__{k}", lambda x: F.lit("mask")) for k in PATTERNS]
    terms = said("term", "__terms", lambda x: x["action"])
    out = out.withColumn("pii", F.concat(*base, F.coalesce(terms, F.array().cast(kind))).cast(kind))
    return out.withColumn("clean_text", _masked(F.col("__text"), F.col("pii"))).drop("__text", "__terms", *keys, *[f"__{k}" for k in PATTERNS])


def _replaced(blocks: Column, length: Column, spans: Column, mark) -> Column:
    """A text in blocks with each span replaced by its mark; overlapping ones count from the left, the longer first."""
    rest = F.struct(length.alias("start"), (-length).alias("back"), F.lit("").alias("mark"))
    marks = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), mark(x).alias("mark"))))

    def step(at, x):
        kept = F.struct(at.alias("from"), x["start"].alias("to"), x["mark"].alias("mark"))
        return F.when(x["start"] >= at, -x["back"]).otherwise(at), F.when(x["start"] >= at, F.array(kept)).otherwise(F.array().cast("array<struct<from:int,to:int,mark:string>>"))

    cuts = scan(F.concat(marks, F.array(rest)), "struct<from:int,to:int,mark:string>", step)
    return F.array_join(F.transform(cuts, lambda c: F.concat(part(blocks, c["from"], c["to"]), c["mark"])), "")


def _masked(text: Column, pii: Column) -> Column:
    """The text with spans replaced by their kind, generalised terms by <TERM>, removed ones by nothing."""
    mark = lambda x: F.when(x["action"] == "remove", "").otherwise(F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">")))
    return F.when(F.size(pii) == 0, text).otherwise(bound(blocks_of(text), lambda b: _replaced(b, F.length(text), pii, mark)))


def op8_pii(spark, sf_dir):
    """Every document's spans: base kinds, then disclosing terms."""
    out = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    said = lambda pii: F.array_join(F.transform(pii, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    of_kind = lambda k: F.size(F.filter("pii", lambda x: x["kind"] == k)).cast("long")
    counts = {f"n_{k}": of_kind(k) for k in PATTERNS}
    out = out.select("doc_id", "pii").withColumns(counts)
    base = said(F.filter("pii", lambda x: x["kind"] != "term"))
    return out.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), said(F.col("pii")).alias("spans"))


QUERIES = {"op8_pii": op8_pii}
ORACLES: dict[str, str] = {}
