"""URL filter: host and path rules, then the ratio of two character language models. DataFrame functions only.

URLs that a rule judges are the labelled ones. Their normalised text (after the scheme; A-Z lowered, digits as 0, other
signs as _) gives character 4-gram counts of accepted and of rejected URLs. Each class has a smoothed variable-order Markov
model: the probability of a character given up to three before it, each order's counts interpolated with the next shorter
order's estimate, down to the uniform one. A URL's score is the difference of the two log-likelihoods by its length. About
3/16 of the labelled URLs (by a hash) are left out of the counts and calibrate the threshold: the score, in steps of 0.01,
that best separates accepted from rejected ones.

The alphabet has 31 signs besides two marks, so there are at most 33^4 different 4-grams whatever the input is; that
bounds the tables that are joined by broadcast.

Defined cases: a null URL, or one without "://", has an empty host and path and is judged by the model (null: as an empty
text). Without any labelled URL of a class left for calibration the threshold is 0. Rows that repeat are judged and
returned each. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import checked_join, need, table, written

#: (rule, verdict): a host, then the start of a path.
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
ORDER = 3
#: Weight of the shorter order's estimate, in observations.
BETA = 5.0
SIGNS = 32
#: The model is broadcast, as it has a bound: some 40 bytes for each of at most 33^4 grams.
MODEL_BYTES = 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path)."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    known = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(known, pattern, 1), UPPER, LOWER), F.regexp_extract(known, pattern, 2)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls where none does."""
    ordered = sorted(rules, key=lambda r: (-len(r[0]), r[0]))

    def fits(rule):
        at = rule.index("/")
        own, start = rule[:at], rule[at:]
        return ((host == own) | host.endswith("." + own)) & path.startswith(start)

    rule = F.coalesce(*[F.when(fits(r), F.lit(r)) for r, _ in ordered]) if ordered else F.lit(None).cast("string")
    verdict = F.coalesce(*[F.when(fits(r), F.lit(v)) for r, v in ordered]) if ordered else F.lit(None).cast("string")
    return rule, verdict


def _signs(url: Column) -> Column:
    """The URL's normalised characters between start and end marks."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"(?s)^.*?://", "")
    text = F.regexp_replace(F.regexp_replace(F.translate(rest, UPPER, LOWER), "[0-9]", "0"), "(?s)[^a-z0./-]", "_")
    return F.regexp_extract_all(F.concat(F.lit("^" * ORDER), text, F.lit("$")), F.lit("."), 0)


def _grams(signs: Column) -> Column:
    def of(s):  # s is computed once for a URL
        return F.transform(F.sequence(F.lit(ORDER), F.size(s) - 1), lambda i: F.concat(*[F.get(s, i - k) for k in range(ORDER, -1, -1)]))

    return F.element_at(F.transform(F.array(signs), of), 1)


def gram_scores(counts: DataFrame) -> DataFrame:
    """(gram, llr) from (gram, allow, block): the log ratio of the two models' probabilities of the last character."""
    out = counts.withColumns({f"p_{c}": F.lit(1.0 / SIGNS) for c in ("allow", "block")})
    for k in range(ORDER + 1):
        seen, before = F.substring("gram", ORDER + 1 - k, k + 1), F.substring("gram", ORDER + 1 - k, k)
        one = counts.groupBy(seen.alias("__seen")).agg(F.sum("allow").alias("n_allow"), F.sum("block").alias("n_block"))
        all_ = counts.groupBy(before.alias("__before")).agg(F.sum("allow").alias("m_allow"), F.sum("block").alias("m_block"))
        out = out.withColumn("__seen", seen).withColumn("__before", before)
        out = out.join(F.broadcast(one), "__seen").join(F.broadcast(all_), "__before")
        out = out.withColumns({f"p_{c}": (F.col(f"n_{c}") + BETA * F.col(f"p_{c}")) / (F.col(f"m_{c}") + BETA) for c in ("allow", "block")})
        out = out.select("gram", "p_allow", "p_block")
    return out.select("gram", (F.ln("p_allow") - F.ln("p_block")).alias("llr"))


def threshold(scored: DataFrame) -> float:
    """The step of 0.01 that best separates the scores of (score, label) rows; 0 where a class is missing."""
    bins = scored.groupBy(F.least(F.greatest(F.floor(F.col("score") * 100), F.lit(-2000)), F.lit(2000)).alias("bin"))
    bins = bins.agg(F.count_if(F.col("label") == "allow").alias("a"), F.count_if(F.col("label") == "block").alias("b"))
    # At most 4001 rows.
    below, every = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    above_a, below_b = F.sum("a").over(every) - F.coalesce(F.sum("a").over(below), F.lit(0)), F.coalesce(F.sum("b").over(below), F.lit(0))
    gain = F.try_divide(above_a, F.sum("a").over(every)) + F.try_divide(below_b, F.sum("b").over(every))  # null where a class is missing
    best = bins.select("bin", gain.alias("gain")).filter("gain is not null").orderBy(F.desc("gain"), F.abs("bin"), "bin").first()
    return 0.0 if best is None else best["bin"] / 100


def judge_urls(pages: DataFrame, id_col="page_id", url_col="url", rules=RULES) -> DataFrame:
    """id, url, host, path, rule, verdict, and the model's score of each row."""
    need(pages, id_col, url_col)
    host, path = split_url(F.col("url"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.withColumn("host", host).withColumn("path", path)
    rule, label = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("label", label)
    left_out = F.substring(F.md5(F.coalesce("url", F.lit(""))), 1, 1).isin("0", "1", "2")
    rows = rows.withColumn("trains", F.col("label").isNotNull() & ~left_out).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "url-rows")
    # Counts of all grams, those that no labelled URL has included: the model covers every URL.
    grams = rows.select("label", "trains", F.explode(_grams(_signs(F.col("url")))).alias("gram"))
    counts = grams.groupBy("gram").agg(*[F.count_if(F.col("trains") & (F.col("label") == c)).alias(c) for c in ("allow", "block")])
    model = written(gram_scores(written(counts, "url-grams")), "url-model")
    # Only a row's number goes with each gram.
    parts = rows.select("row", F.explode(_grams(_signs(F.col("url")))).alias("gram"))
    scored = checked_join(parts, model, ["gram"], "inner", spread="row", limit=(SIGNS + 1) ** (ORDER + 1), size=F.lit(40), most=MODEL_BYTES)
    scored = written(scored.groupBy("row").agg(F.avg("llr").alias("score")).join(rows, "row"), "url-scores")
    at = threshold(scored.filter("label is not null and not trains").select("score", "label"))
    method = F.when(F.col("score") >= at, "allow").otherwise("block")
    return scored.select(F.col("id").alias(id_col), "url", "host", "path", "rule", F.coalesce("label", method).alias("verdict"), "score")


def op3_url_filter(spark, sf_dir):
    """Every page's URL judged by rules, else by the models."""
    out = judge_urls(table(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))


def _sql() -> str:
    fits = [(f"(host = '{r[: r.index('/')]}' OR host LIKE '%.{r[: r.index('/')]}') AND starts_with(path, '{r[r.index('/') :]}')", r, v) for r, v in sorted(RULES, key=lambda r: (-len(r[0]), r[0]))]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in fits) + " END"
    label = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits) + " END"

    def prob(c):
        return reduce(lambda p, k: f"((sum({c}) OVER (PARTITION BY substr(gram, {ORDER + 1 - k}, {k + 1})) + {BETA} * {p}) / (sum({c}) OVER (PARTITION BY substr(gram, {ORDER + 1 - k}, {k})) + {BETA}))", range(ORDER + 1), f"{1.0 / SIGNS}::DOUBLE")

    return rf"""
WITH u AS (SELECT page_id, url, row_number() OVER () AS r,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
l AS (SELECT *, {rule} AS rule, {label} AS label, substr(md5(coalesce(url, '')), 1, 1) IN ('0', '1', '2') AS left_out,
    '{"^" * ORDER}' || regexp_replace(regexp_replace(translate(regexp_replace(coalesce(url, ''), '(?s)^.*?://', ''), '{UPPER}', '{LOWER}'), '[0-9]', '0', 'g'), '(?s)[^a-z0./-]', '_', 'g') || '$' AS t FROM u),
g AS (SELECT r, label, label IS NOT NULL AND NOT left_out AS trains, substr(t, i, {ORDER + 1}) AS gram FROM (SELECT *, unnest(range(1, length(t) - {ORDER} + 1)) AS i FROM l)),
n AS (SELECT gram, count(*) FILTER (trains AND label = 'allow') AS allow, count(*) FILTER (trains AND label = 'block') AS block FROM g GROUP BY gram),
m AS (SELECT gram, ln({prob("allow")}) - ln({prob("block")}) AS llr FROM n),
s AS (SELECT r, avg(llr) AS score FROM g JOIN m USING (gram) GROUP BY r),
b AS (SELECT least(greatest(floor(score * 100), -2000), 2000) AS bin, count(*) FILTER (label = 'allow') AS a, count(*) FILTER (label = 'block') AS b
    FROM l JOIN s USING (r) WHERE label IS NOT NULL AND left_out GROUP BY 1),
e AS (SELECT bin, (sum(a) OVER () - coalesce(sum(a) OVER w, 0)) / sum(a) OVER () + coalesce(sum(b) OVER w, 0) / sum(b) OVER () AS gain
    FROM b WINDOW w AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT coalesce((SELECT bin / 100 FROM e WHERE gain IS NOT NULL AND NOT isnan(gain) ORDER BY gain DESC, abs(bin), bin LIMIT 1), 0.0) AS cut)
SELECT page_id, host, path, rule, coalesce(label, CASE WHEN score >= (SELECT cut FROM t) THEN 'allow' ELSE 'block' END) AS verdict, round(score, 6) AS score
FROM l JOIN s USING (r)
"""


QUERIES = {"op3_url_filter": op3_url_filter}
ORACLES = {"op3_url_filter": _sql()}
