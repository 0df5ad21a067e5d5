"""A training corpus from `documents`: five stages, each written as Parquet and read again as the next one's input.

Every stage takes (spark, docs, sf_dir). It works on the columns of documents; others are left out, whatever their names.
All but the last return those columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import bpe, langid, mixing, pii, simhash
from tallyspark.llm.common import fresh_dir, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents whose language is less likely than this many times chance are rejected, like those without a letter.
MIN_OVER_CHANCE = 1.5


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; learned from those that aren't held out."""
    docs = docs.select(*COLUMNS)
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))
    if not model.langs:  # nothing to learn from: nothing is rejected
        return docs
    said = langid.predict(docs, model, lang_col="__pred", score_col="__score")
    least = min(1.0, MIN_OVER_CHANCE / len(model.langs)) if len(model.langs) > 1 else 0.0
    return said.filter((F.col("__pred") != "und") & (F.col("__score") >= least)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group. Different texts with one id are different documents; those without
    an id come first. Of rows that repeat one stays."""
    row = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text"))
    docs = docs.select(*COLUMNS).withColumn("__row", row)
    groups = simhash.near_duplicates(docs.select("__row", "text"), id_col="__row")
    first = groups.select(F.col("component_id").alias("__row")).distinct()
    return docs.join(first, "__row", "left_semi").dropDuplicates(["__row"]).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and disclosing terms generalised or removed."""
    out = pii.find_pii(docs.select(*COLUMNS))
    changed = F.size("pii") > 0
    out = out.withColumn("text", F.when(changed, F.col("clean_text")).otherwise(F.col("text")))
    return out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix(docs.select(*COLUMNS)).filter("copies > 0")
    return mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids, and a digest of what they decode to."""
    path = tokenizer_path()
    docs = docs.select(*COLUMNS)
    out = written(bpe.encode(docs, bpe.build_lexicon(docs, path), path, ids_col="ids").select("doc_id", "lang", "source", "ids"), "pipeline-ids")
    out = bpe.decode(out, path, ids_col="ids", text_col="decoded")
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing", mixture),
    ("BPE", tokens),
]

#: SQL can't express the first, second and last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = fresh_dir(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
