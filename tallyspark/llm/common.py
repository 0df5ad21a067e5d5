"""Helpers shared by the training-data operators: shared folders, written tables, checked joins."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: A side is broadcast only if its counted rows stay at or below this.
BROADCAST_ROWS = 200_000
#: The same for the bytes of rows that hold arrays.
BROADCAST_BYTES = 8 << 20
#: Keys with fewer rows are never split.
HOT_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or a local one where that is unset (tests)."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    at = os.path.join(tempfile.gettempdir(), "tallyspark-shared")
    os.makedirs(at, exist_ok=True)
    return f"file://{at}"


#: Folders that this driver made in the shared one, until clear_written() removes them.
_MADE: list[str] = []


def fresh_dir(spark: SparkSession, name: str) -> str:
    _MADE.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


def clear_written(spark: SparkSession, *paths: str) -> None:
    """Removes the given folders of fresh_dir(), or all of this driver's; call it when the results that read them are taken."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths or tuple(_MADE):
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
        _MADE.remove(path)


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """df as a table in the shared folder: computed once, its lineage cut, readable after the loss of any executor. Options are
    the Parquet writer's."""
    path = fresh_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, size: str = "8m", rows: int = 2_000) -> None:
    """Bounds the bytes and rows of the Arrow batches that Python tasks get. A bound that the user has set, for the
    application or for the session, stays; otherwise the session keeps this one for its later queries, too."""
    for key, value in (("maxBytesPerBatch", size), ("maxRecordsPerBatch", str(rows))):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}", None) is None:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", value)


def checked_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, spread: str, salts: int = 16, limit: int = BROADCAST_ROWS, size: Column | None = None, most: int = BROADCAST_BYTES) -> DataFrame:
    """Joins left with a written table that has one row per key.

    The table is broadcast if its counted rows are at most limit and its bytes (by the column `size`, where rows hold
    arrays) at most `most`. Beyond that both sides are shuffled on the keys and a salt: left rows get theirs from
    a hash of the column `spread`, right rows are repeated for each salt, so that a key with a large part of the left rows
    is dealt to `salts` tasks.
    """
    rows, total = right.agg(F.count("*"), F.coalesce(F.sum(F.lit(0) if size is None else size), F.lit(0)).cast("long")).first()
    if rows <= limit and total <= most:
        return left.join(F.broadcast(right), keys, how)
    salted = left.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = right.withColumn("__salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return salted.join(copies, [*keys, "__salt"], how).drop("__salt")


def skew_join(left: DataFrame, right: DataFrame, key: str, n: str, total: int, most: int, share: int = 1_000, few: int = HOT_ROWS) -> DataFrame:
    """Inner join with a written table of one row per key, whose column n says how many rows of left have it, `total` in all
    and `most` at most.

    Keys with at least a thousandth of the rows are at most a thousand, so these are broadcast; the others are shuffled,
    and none of them is large. Where no key has `few` rows all are shuffled.
    """
    if most < few:
        return left.join(right, key).drop(n)
    hot = right.filter(F.col(n) * share >= total)
    cold = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(right.filter(F.col(n) * share < total), key)
    return left.join(F.broadcast(hot), key).unionByName(cold).drop(n)


def need(df: DataFrame, *names: str) -> None:
    missing = [x for x in names if x not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def plain(df: DataFrame, *added: str) -> DataFrame:
    """df without columns that an operator is about to add, and without names that start with two underscores, which
    are the operators' own: where a name clashes, the operator's column replaces the caller's."""
    return df.drop(*added, *[c for c in df.columns if c.startswith("__")])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
