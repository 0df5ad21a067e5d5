"""The sweep for unknown filings as a join of two streams: filings and calendar rows whose periods lie within some days.

Both streams have watermarks on their periods, so the join's state holds only rows that a later one can still meet: a filing
waits until no calendar row of its days can come, and is then given without one. A filing that meets several rows gets the
smallest id, counted when its period has passed the watermark; that state is bounded by the same delay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.plans.shared import fresh_folder
from tallyspark.streaming import pipeline as P

DELAY = "1 day"


def swept(filings: DataFrame, docs: DataFrame, events: DataFrame, calendar: DataFrame, cutoff: Column, days: int = P.MATCH_DAYS, delay: str = DELAY) -> DataFrame:
    """What pipeline.unseen() gives, from a stream of filings (accession, ticker, form, filed, period) and one of calendar rows
    (cal_id, ticker, fiscal_end, status). Known documents and events are tables, read anew with each batch.

    A row is given once its period is `days` and the delay behind both streams; those later than the watermark are left out.
    An accession that comes twice within the watermark is one filing."""
    new = filings.filter((F.col("filed") >= cutoff) & F.col("period").isNotNull())
    new = new.join(docs.select("ticker", "form", "period").distinct(), ["ticker", "form", "period"], "left_anti")
    new = new.join(events.select("accession").distinct(), "accession", "left_anti")
    new = new.withColumn("__at", F.col("period").cast("timestamp")).withWatermark("__at", delay)
    open_ = calendar.filter(F.col("status").isin("upcoming", "stale", "failed"))
    open_ = open_.select(F.col("ticker").alias("__ticker"), "cal_id", F.col("fiscal_end").cast("timestamp").alias("__end")).withWatermark("__end", delay)
    wide = F.expr(f"interval {days} days")
    near = (F.col("ticker") == F.col("__ticker")) & (F.col("__end") >= F.col("__at") - wide) & (F.col("__end") <= F.col("__at") + wide)
    hit = new.join(open_, near, "left_outer")
    day = F.window("__at", "1 day")  # one period each: windows of a day close as it passes the watermark
    return hit.groupBy(day, "accession", "ticker", "form", "filed", "period").agg(F.min("cal_id").alias("cal_id")).drop("window")


#: A day after all others, which moves the watermarks past them. The row that has it needs a ticker: those without are filtered out below the watermark.
END = "2300-01-01"


def stored_in_parts(rows: DataFrame, part: Column, path: str) -> None:
    """rows as files, one for each part (a few dozen), in the parts' order."""
    spark, whole = rows.sparkSession, fresh_folder(rows.sparkSession, "parts")
    rows.withColumn("__part", part).repartition("__part").write.partitionBy("__part").parquet(whole)
    stored = spark.read.parquet(whole)
    for k in sorted(r[0] for r in stored.select("__part").distinct().collect()):
        stored.filter(F.col("__part") == k).drop("__part").coalesce(1).write.mode("append").parquet(path)


def stored_once(rows: DataFrame, name: str) -> DataFrame:
    """Different rows as files, so that batches that read them anew don't make them anew."""
    path = fresh_folder(rows.sparkSession, name)
    rows.distinct().write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def sweep_stream(spark, sf_dir):
    """sweep_unseen() from streams of files, a year each."""
    found, docs, events, calendar, cutoff = P.sweep_tables(spark, sf_dir)
    docs, events = stored_once(docs.select("ticker", "form", "period"), "sweep-docs"), stored_once(events.select("accession"), "sweep-events")
    sources = {}
    for name, rows, time in (("filings", found, "period"), ("calendar", calendar.select("cal_id", "ticker", "fiscal_end", "status"), "fiscal_end")):
        last = rows.limit(1).select(*[F.lit(END).cast("date").alias(c) if c in (time, "filed") else F.lit("upcoming").alias(c) if c == "status" else F.lit(-1).cast(rows.schema[c].dataType).alias(c) if c == "ticker" else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns])
        path = fresh_folder(spark, f"sweep-{name}")
        stored_in_parts(rows.unionByName(last), F.year(F.coalesce(time, F.lit("1900-01-01").cast("date"))), path)
        sources[name] = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out, target = swept(sources["filings"], docs, events, sources["calendar"], cutoff), fresh_folder(spark, "swept")
    query = out.writeStream.format("parquet").option("checkpointLocation", f"{target}-state").outputMode("append").trigger(availableNow=True).start(target)
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(target)


QUERIES = {"sweep_stream": sweep_stream}
ORACLES = {"sweep_stream": P.ORACLES["sweep_unseen"]}
