"""Mixing sources to target weights by Efraimidis-Spirakis sampling. DataFrame functions only.

A document's size is its number of words. Sources in code point order (null last) get the weights in turn and share a
budget, a multiple of all sizes; a target stops at max_epochs times its source's size and the excess is shared again by
weight. Targets are filled by complete epochs of the source first; the rest is a sample without replacement: documents in
the order of exponential keys -ln(u)/quality, taken while their middle lies within the rest. u comes from a hash of the
document, so reruns agree.

Prefix sums don't sort a source in one task: keys fall into a fixed number of buckets, whose sums give each source one
bucket in which its rest ends, and only that bucket's documents are sorted, by one task: about a 4096th of the source. Per
source there are at most `BUCKETS` sums. Sources are a catalogue, ordered by one task; a source for each host of a crawl isn't
meant. The quality is a column that the caller may give.

Defined cases: a null text has size 0; null ids are allowed; a document's quality, where none is given, is 0.5 to 1, by its share of signs other
than digits and markup. Rows that repeat have equal keys and are
taken together. Sources whose sizes are all
0 have target 0. Other columns pass through; where a name clashes, the added column replaces the caller's. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import WORD, checked_join, need, plain, table, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
BUCKETS = 4096
NOISE = "0123456789#*$%&|<>{}[]\\^~_=+@"


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def quality_of(text: Column) -> Column:
    known = F.coalesce(text, F.lit(""))
    return F.lit(0.5) + F.lit(0.5) * F.length(F.translate(known, NOISE, "")) / F.greatest(F.length(known), F.lit(1))


def _key(id_: Column, text: Column, quality: Column) -> Column:
    digest = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))
    return -F.ln(u) / quality


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) with weight and target. Sources are a catalogue: a row each, so one task may order them."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
    out = sizes.withColumn("weight", weight).withColumn("cap", max_epochs * F.col("source_size"))
    all_ = Window.partitionBy()
    out = out.withColumn("budget", F.sum("source_size").over(all_) * F.lit(share))
    # By cap / weight, those that stop at their cap come first; the level is what each weight gets of what they leave.
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    capped = F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = out.withColumn("level", (F.col("budget") - capped) / F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)))
    out = out.withColumn("full", F.col("cap") / F.col("weight") <= F.col("level"))
    out = out.withColumn("level", F.max(F.when(~F.col("full"), F.col("level"))).over(all_))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("level"))
    return out.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, quality: Column | None = None) -> DataFrame:
    """docs with size, source_size, target, copies (how often the mix takes the document) and taken (words)."""
    need(docs, id_col, text_col, source_col)
    docs = plain(docs, "size", "source_size", "target", "copies", "taken")
    rows = docs.withColumn("size", size_of(F.col(text_col))).withColumn("__key", _key(F.col(id_col), F.col(text_col), quality_of(F.col(text_col)) if quality is None else quality))
    rows = rows.withColumn("__bucket", F.floor(F.lit(BUCKETS) * F.col("__key") / (1 + F.col("__key"))).cast("int"))
    rows = rows.withColumn("__source", F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("-")))
    # Sizes and keys without texts: what follows reads those only, until the plan meets the documents.
    small = written(rows.select("__source", F.col(source_col).alias("source"), "size", F.col("__key").alias("key"), F.col("__bucket").alias("bucket")), "mix-keys")
    sums = written(small.groupBy("__source", "source", "bucket").agg(F.sum("size").alias("sum")), "mix-buckets")
    sizes = sums.groupBy("source").agg(F.sum("sum").alias("source_size"))
    plan = targets(sizes, weights, share, max_epochs)
    size, target = F.col("source_size"), F.col("target")
    plan = plan.withColumn("epochs", F.when(size == 0, 0).otherwise(F.floor(target / size)).cast("int")).withColumn("rest", target - F.col("epochs") * size)
    plan = written(plan.withColumn("__source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))).drop("source"), "mix-plan")
    before = F.coalesce(F.sum("sum").over(Window.partitionBy("__source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = checked_join(sums.withColumn("before", before), plan, ["__source"], "inner", spread="bucket", limit=20_000).filter("before <= rest and rest < before + sum")
    ends = written(ends.select("__source", F.col("bucket").alias("cut"), "before", "rest"), "mix-ends")
    # Within the bucket where a source's rest ends, the last key that is taken; keys before it are taken too.
    order = Window.partitionBy("__source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    last = checked_join(small, ends, ["__source"], "inner", spread="key", limit=20_000).filter("bucket = cut")
    last = last.withColumn("at", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)) + F.col("size") / 2).filter("at <= rest")
    last = last.groupBy("__source").agg(F.max("key").alias("__last"))
    plan = plan.join(ends.select("__source", F.col("cut").alias("__cut")), "__source", "left").join(last, "__source", "left")
    plan = written(plan.select("__source", "source_size", "target", F.col("epochs").alias("__epochs"), "__cut", "__last"), "mix-cuts")
    out = checked_join(rows, plan, ["__source"], "left", spread="__key", limit=20_000)
    more = F.coalesce((F.col("__bucket") < F.col("__cut")) | ((F.col("__bucket") == F.col("__cut")) & (F.col("__key") <= F.col("__last"))), F.lit(False))
    out = out.withColumn("copies", F.col("__epochs") + more.cast("int")).withColumn("taken", F.col("copies") * F.col("size"))
    return out.drop("__key", "__bucket", "__source", "__epochs", "__cut", "__last")


def op9_mixing(spark, sf_dir):
    """Every document with the words that the mix takes of it."""
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
k AS (SELECT *, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  -ln((('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(t)), 1, 13))::BIGINT + 0.5::DOUBLE) / {2**52}::DOUBLE)
  / (0.5::DOUBLE + 0.5::DOUBLE * length(translate(t, '{NOISE}', '')) / greatest(length(t), 1)) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (SELECT source, source_size, [{", ".join(map(str, WEIGHTS))}][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % {len(WEIGHTS)}] AS weight FROM s),
l AS (SELECT *, (sum(source_size) OVER () * {SHARE}::DOUBLE - coalesce(sum({MAX_EPOCHS} * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level, {MAX_EPOCHS} * source_size / weight AS ratio FROM w WINDOW o AS (ORDER BY {MAX_EPOCHS} * source_size / weight, encode(source) NULLS LAST)),
p AS (SELECT source, source_size, CASE WHEN ratio <= level THEN ({MAX_EPOCHS} * source_size)::DOUBLE ELSE weight * max(CASE WHEN ratio > level THEN level END) OVER () END AS target FROM l),
e AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END AS epochs FROM p),
c AS (SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs,
    coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 <= target - epochs * source_size AS more
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (size * (epochs + more::INT))::BIGINT AS taken FROM c
"""

QUERIES = {"op9_mixing": op9_mixing}
ORACLES = {"op9_mixing": OP9_SQL}
