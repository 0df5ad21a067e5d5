"""Stored tables that a change rewrites in proportion: buckets by a hash of the key, and batches that count once.

A store has one or more tables (facts, their evidence, ...), all with the key's columns, each partitioned by the key's bucket.
A batch of new rows is merged in three steps, each of which can be repeated:
1. the new contents of the buckets that occur are computed from the old ones and written to the batch's log, with what else
   the batch tells (its audit), and the names of its files; a mark says that the log is complete;
2. these buckets are published: the log's files are moved to the place of the store's, others aren't touched;
3. a mark says that the batch is done; it is never applied again.
A run that is lost in the first step leaves the store as it was; one that is lost in the second is published from the log: a
file is there or in the store already. Rows are thus dealt to buckets and written once.
One writer at a time merges into a store; readers see a batch bucket by bucket.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tallyspark.operators import tables
from tallyspark.operators.tables import change_tables, upsert, upsert_first, upsert_guarded
from tallyspark.operators.write import KEY, ORDER, RESULTS, write_results, write_tables
from tallyspark.plans.shared import fresh_folder

BUCKET = "__bucket"
#: What is merged: (the old rows by table, the new rows) to the new rows by table; other names are tables of the log.
Plan = Callable[[dict[str, DataFrame], DataFrame], dict[str, DataFrame]]


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    schemas: dict[str, StructType]
    buckets: int
    #: Tables whose rows are written where they are.
    unmoved: tuple[str, ...] = ()

    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def with_bucket(self, name: str) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schemas[name].fields]).add(BUCKET, IntegerType())).parquet(f"{self.path}/{name}")

    def read(self, name: str) -> DataFrame:
        return self.with_bucket(name).drop(BUCKET)

    def log(self, batch: int, name: str) -> DataFrame:
        """What a batch has told besides its rows."""
        return self.spark.read.parquet(f"{self.path}/log/batch={batch}/{name}")


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _there(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def _mark(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.create(at, True).close()


def _remove(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def _by_bucket(rows: DataFrame, store: Store) -> DataFrame:
    """Rows with their bucket, so dealt that a bucket is a file, or several where it is large."""
    return rows.select("*", store.bucket()).hint("rebalance", BUCKET)


#: How many files a task writes at once; beyond, it sorts its rows by their bucket first.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def _write(rows: DataFrame, store: Store, name: str, path: str) -> None:
    """Rows by bucket. Those of an unmoved table aren't shuffled: each task writes a file for each bucket that it has rows of,
    all at once and without a sort. That fits rows that are made in many times the number of what they are made of."""
    if name not in store.unmoved:
        _by_bucket(rows, store).write.partitionBy(BUCKET).parquet(path)
        return
    conf = store.spark.conf
    before = conf.get(WRITERS)
    conf.set(WRITERS, str(store.buckets + 1))  # Spark sorts what comes after the last writer that is allowed
    try:
        rows.select("*", store.bucket()).write.partitionBy(BUCKET).parquet(path)
    finally:
        conf.set(WRITERS, before)


def create(spark: SparkSession, path: str, keys: list[str], tables: dict[str, DataFrame], buckets: int = 64, unmoved: tuple[str, ...] = ()) -> Store:
    """A store of the given rows. With some hundred MB a bucket, a change of few keys reads and writes little."""
    store = Store(spark, path, tuple(keys), {}, buckets, unmoved)
    for name, rows in tables.items():
        store = added(store, name, rows)
    return store


def added(store: Store, name: str, rows: DataFrame) -> Store:
    """The store with one more table, which may be made of those that it has."""
    _write(rows, store, name, f"{store.path}/{name}")
    return replace(store, schemas=store.schemas | {name: rows.schema})


def _files(spark: SparkSession, path: str) -> list[str]:
    """The names of a folder's Parquet files; none where it isn't there."""
    fs, at = _file_system(spark, path)
    names = [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []
    return [x for x in names if x.endswith(".parquet")]


def stage(store: Store, new: DataFrame, batch: int, plan: Plan) -> None:
    """The first step; nothing where it was done before."""
    spark, log = store.spark, f"{store.path}/log/batch={batch}"
    if _there(spark, f"{log}/_STAGED"):
        return
    _remove(spark, log)
    touched = sorted(r[0] for r in new.select(store.bucket()).distinct().collect())  # at most the number of buckets
    old = {name: store.with_bucket(name).filter(F.col(BUCKET).isin(touched)).drop(BUCKET) for name in store.schemas}
    for name, rows in plan(old, new).items():
        if name in store.schemas:
            _write(rows.select(*store.schemas[name].names), store, name, f"{log}/{name}")
        else:
            rows.write.parquet(f"{log}/{name}")
    files = [(name, b, _files(spark, f"{log}/{name}/{BUCKET}={b}")) for name in store.schemas for b in touched]
    spark.createDataFrame(files, f"name string, {BUCKET} int, files array<string>").coalesce(1).write.parquet(f"{log}/touched")
    _mark(spark, f"{log}/_STAGED")


def publish(store: Store, batch: int) -> None:
    """The second step and the third: the log's buckets replace the store's. A file that an earlier run has moved stays."""
    spark, log = store.spark, f"{store.path}/log/batch={batch}"
    for name, b, files in spark.read.parquet(f"{log}/touched").collect():  # at most the number of buckets, by table
        source, target = f"{log}/{name}/{BUCKET}={b}", f"{store.path}/{name}/{BUCKET}={b}"
        waiting, there = set(_files(spark, source)), _files(spark, target)
        if lost := set(files) - waiting - set(there):
            raise FileNotFoundError(f"neither in the log nor in the store: {target}/{min(lost)}")
        for x in set(there) - set(files):
            _remove(spark, f"{target}/{x}")
        fs, at = _file_system(spark, target)
        fs.mkdirs(at)
        for x in waiting.intersection(files):
            _remove(spark, f"{target}/{x}")
            if not fs.rename(_file_system(spark, f"{source}/{x}")[1], at):
                raise OSError(f"could not move {source}/{x}")
        if not files:  # all its rows are gone
            _remove(spark, target)
    _mark(spark, f"{log}/_DONE")


def merge(store: Store, new: DataFrame, batch: int, plan: Plan) -> bool:
    """Merges a batch into the store, once: False where it was merged before."""
    if _there(store.spark, f"{store.path}/log/batch={batch}/_DONE"):
        return False
    stage(store, new, batch, plan)
    publish(store, batch)
    return True


def forget(store: Store, before: int) -> None:
    """Drops what the logs of batches before one hold, but for their marks."""
    fs, at = _file_system(store.spark, f"{store.path}/log")
    for x in fs.listStatus(at) if fs.exists(at) else []:
        name = x.getPath().getName()
        if name.startswith("batch=") and int(name.removeprefix("batch=")) < before:
            for y in fs.listStatus(x.getPath()):
                if y.isDirectory():
                    fs.delete(y.getPath(), True)


def sink(store: Store, plan: Plan) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: a batch that the stream repeats after a loss is merged once."""

    def write(rows: DataFrame, batch: int) -> None:
        merge(store, rows, batch, plan)

    return write


def upserts(store: Store, how: str = "force", guard=None) -> Plan:
    """force: new rows replace old ones; skip: old ones stay; first: the old value stands unless it is null; guarded: old rows
    are replaced where the guard, a condition on old columns, holds. New rows have each key once."""
    keys, name = list(store.keys), next(iter(store.schemas))
    put = {
        "force": lambda old, new: upsert(old, new, keys),
        "skip": lambda old, new: upsert(old, new, keys, force=False),
        "first": lambda old, new: upsert_first(old, new, keys),
        "guarded": lambda old, new: upsert_guarded(old, new, keys, guard),
    }[how]
    return lambda old, new: {name: put(old[name], new)}


#: Rows of results and stored facts that a task compares at most, as far as they are evenly spread: it sorts them in memory.
TASK_ROWS = 1_000_000


def facts_plan(docs: DataFrame, rates: DataFrame, order: list[str], force: bool, **hooks) -> Plan:
    """Results into facts with their evidence and verdicts, both removed where a fact is overwritten; the audit, the errors and
    the summary go to the log. What all these are made of is written to a folder first, which the plan's next batch removes."""
    last: list[str] = []

    def plan(old: dict[str, DataFrame], new: DataFrame) -> dict[str, DataFrame]:
        spark = new.sparkSession

        def kept(rows: DataFrame) -> DataFrame:
            while last:
                _remove(spark, last.pop())
            last.append(fresh_folder(spark, "merged"))
            rows.write.parquet(last[0])
            return spark.read.schema(rows.schema).parquet(last[0])

        parts = -(-(new.count() + old["facts"].count()) // TASK_ROWS)
        parts = parts if parts > int(spark.conf.get("spark.sql.shuffle.partitions")) else None
        return write_results(old["facts"], new, docs, rates, order, force, children={n: t for n, t in old.items() if n != "facts"}, kept=kept, parts=parts, **hooks)

    return plan


def stored_upsert(spark, sf_dir):
    """A change of orders as a stream of three batches, the first of them merged twice."""
    old, new = change_tables(spark, sf_dir)
    store = create(spark, fresh_folder(spark, "store"), ["id"], {"orders": old}, 16)
    source = fresh_folder(spark, "changes")
    for k in range(3):
        new.filter(F.col("id") % 3 == k).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(new.schema).option("maxFilesPerTrigger", 1).parquet(source)
    put = sink(store, upserts(store))

    def twice(rows, batch):
        put(rows, batch)
        put(rows, batch)

    query = stream.writeStream.foreachBatch(twice).option("checkpointLocation", f"{store.path}-state").trigger(availableNow=True).start()
    query.awaitTermination()
    return store.read("orders")


def stored_facts(spark, sf_dir):
    """Results over stored facts, with evidence and verdicts of old ones: what is stored then."""
    stored, results, docs, rates = write_tables(spark, sf_dir)
    store = create(spark, fresh_folder(spark, "facts"), KEY, {"facts": stored}, 16)
    stored = store.read("facts")
    store = added(store, "evidence", stored.select(*KEY, F.col("quote").alias("excerpt")))
    store = added(store, "verdicts", stored.select(*KEY, F.lit(True).alias("passed")))
    merge(store, results, 0, facts_plan(docs, rates, ORDER, force=True))
    keys = lambda name, more: store.read(name).select(F.lit(name).alias("stored"), *KEY[:2], more.alias("value"))
    out = keys("facts", F.col("value"))
    for name in ("evidence", "verdicts"):
        out = out.unionByName(keys(name, F.lit(None).cast("double")))
    return out


QUERIES = {"stored_upsert": stored_upsert, "stored_facts": stored_facts}
ORACLES = {
    "stored_upsert": tables.ORACLES["upsert_force"],
    "stored_facts": f"""{RESULTS}, f AS (SELECT coalesce(stored.doc_id, one.doc_id) AS doc_id, coalesce(stored.metric, one.metric) AS metric, coalesce(value, 1.0) AS value, one.doc_id IS NOT NULL AS written, stored.doc_id IS NOT NULL AS known FROM stored FULL JOIN one USING (doc_id, metric))
SELECT 'facts' AS stored, doc_id, metric, value FROM f UNION ALL SELECT t, doc_id, metric, NULL FROM f, (VALUES ('evidence'), ('verdicts')) v(t) WHERE known AND NOT written""",
}
