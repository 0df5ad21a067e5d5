"""Structured Streaming over the events: windows with watermarks, deduplication, and alerts that are held back by state.

The same functions take batch and streaming DataFrames, except `held_back_stream`, whose batch form is `held_back`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyspark.plans.shared import fresh_folder
from tallyspark.plans.views import table

DELAY = "1 hour"


def windowed(events: DataFrame, length: str, slide: str | None = None, delay: str = DELAY, keys: tuple[str, ...] = ("event_type",), time: str = "ts") -> DataFrame:
    """Counts and sums in tumbling windows, or in sliding ones; late events beyond the delay are left out."""
    w = F.window(time, length, slide or length)
    out = events.withWatermark(time, delay).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(24,6)")).alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", F.col("total").cast("double").alias("total"))


def sessions(events: DataFrame, gap: str, delay: str = DELAY, keys: tuple[str, ...] = ("user_id",), time: str = "ts") -> DataFrame:
    """Sessions of a key: its events with less than the gap between them."""
    out = events.withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def once(events: DataFrame, keys: list[str], delay: str = DELAY, time: str = "ts") -> DataFrame:
    """Each key once: in a stream within the watermark, so the state is bounded; in batch once at all."""
    if events.isStreaming:
        return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
    return events.dropDuplicates(keys)


def _keep(times: np.ndarray, last: float | None, seconds: float) -> tuple[np.ndarray, float | None]:
    """Which of a key's sorted times are kept: those at least so many seconds after the one kept before."""
    out = np.zeros(len(times), bool)
    for i, t in enumerate(times.tolist()):
        if last is None or t - last >= seconds:
            out[i], last = True, t
    return out, last


def held_back(alerts: DataFrame, key: str, time: str, seconds: float) -> DataFrame:
    """alerts with `sent`: false for those within so many seconds of the last one sent for their key.

    Each task walks its sorted rows batch by batch and keeps one time, so a key of any size takes no memory.
    """
    columns = alerts.columns

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last = None, None
        for batch in batches:
            keys, times = batch.column(columns.index(key)).to_pylist(), batch.column(columns.index(time)).cast(pa.int64()).to_numpy() / 1e6
            sent = []
            for k, t in zip(keys, times.tolist(), strict=True):
                if k != now:
                    now, last = k, None
                ok = last is None or t - last >= seconds
                last = t if ok else last
                sent.append(ok)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sent, pa.bool_())], [*columns, "sent"])

    rows = alerts.filter(F.col(key).isNotNull()).repartition(key).sortWithinPartitions(key, time)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", sent boolean"
    return rows.mapInArrow(walk, schema)


def held_back_stream(alerts: DataFrame, key: str, time: str, seconds: float) -> DataFrame:
    """The streaming form: (key, time, suppressed) of each alert sent, with how many were held back since the one before."""

    def update(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, held = state.get if state.exists else (None, 0)
        times = np.sort(np.concatenate([p[time].astype("int64").to_numpy() / 1e9 for p in parts]))
        kept, last_ = _keep(times, last, seconds)
        out = []
        for t, ok in zip(times.tolist(), kept.tolist(), strict=True):
            if ok:
                out.append((k[0], pd.Timestamp(t, unit="s"), held))
            held = 0 if ok else held + 1
        state.update((last_, held))
        yield pd.DataFrame(out, columns=[key, time, "suppressed"])

    kind = alerts.schema[key].dataType.simpleString()
    return alerts.groupBy(key).applyInPandasWithState(update, f"{key} {kind}, {time} timestamp, suppressed long", "last double, held long", "append", GroupStateTimeout.NoTimeout)


def stream_of(spark: SparkSession, sf_dir: str, name: str = "events") -> DataFrame:
    return spark.readStream.schema(table(spark, sf_dir, name).schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def drained(stream: DataFrame, name: str) -> DataFrame:
    """What a stream has given when all that is there now is read: written with a checkpoint, then read as a table."""
    spark, at = stream.sparkSession, fresh_folder(stream.sparkSession, name)
    run = stream.writeStream.format("parquet").option("checkpointLocation", f"{at}-state").outputMode("append").trigger(availableNow=True).start(at)
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(at)


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling_windows(spark, sf_dir):
    return windowed(_stamped(table(spark, sf_dir, "events")), "6 hours")


def sliding_windows(spark, sf_dir):
    return windowed(_stamped(table(spark, sf_dir, "events")), "1 day", "6 hours")


def session_windows(spark, sf_dir):
    return sessions(_stamped(table(spark, sf_dir, "events")), "2 hours")


def stream_tumbling(spark, sf_dir):
    """Windows that the watermark has closed when the stream is drained."""
    return drained(windowed(_stamped(stream_of(spark, sf_dir)), "6 hours"), "tumbling")


def stream_once(spark, sf_dir):
    """Users and types, each once within the watermark of one batch."""
    return drained(once(_stamped(stream_of(spark, sf_dir)), ["user_id", "event_type"], "365 days").select("user_id", "event_type"), "once")


def alert_suppression(spark, sf_dir):
    """A user's events as alerts, at most one in twelve hours."""
    return held_back(_stamped(table(spark, sf_dir, "events")).select("event_id", "user_id", "ts").filter("ts is not null"), "user_id", "ts", 12 * 3600).select("event_id", "sent")


QUERIES = {
    "tumbling_windows": tumbling_windows,
    "sliding_windows": sliding_windows,
    "session_windows": session_windows,
    "stream_tumbling": stream_tumbling,
    "stream_once": stream_once,
    "alert_suppression": alert_suppression,
}
_TUMBLE = """SELECT time_bucket(INTERVAL 6 HOUR, ts) AS start, start + INTERVAL 6 HOUR AS "end", event_type, count(*) AS n, sum(value::DECIMAL(24,6))::DOUBLE AS total FROM events GROUP BY ALL"""
ORACLES = {
    "tumbling_windows": _TUMBLE,
    "sliding_windows": """SELECT time_bucket(INTERVAL 6 HOUR, ts) - to_hours((6 * k)::INT) AS start, start + INTERVAL 24 HOUR AS "end", event_type, count(*) AS n, sum(value::DECIMAL(24,6))::DOUBLE AS total FROM events, (SELECT unnest(range(4)) AS k) GROUP BY ALL""",
    "session_windows": """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
SELECT min(ts) AS start, max(ts) + INTERVAL 2 HOUR AS "end", user_id, count(*) AS n FROM s GROUP BY user_id, k""",
    "stream_tumbling": f"SELECT * FROM ({_TUMBLE}) WHERE \"end\" <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)",
    "stream_once": "SELECT DISTINCT user_id, event_type FROM events",
    "alert_suppression": """WITH RECURSIVE e AS (SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
n AS (SELECT a.user_id, a.i, min(b.i) AS next FROM e a LEFT JOIN e b ON b.user_id = a.user_id AND b.ts >= a.ts + INTERVAL 12 HOUR GROUP BY ALL),
k AS (SELECT user_id, 1::BIGINT AS i FROM e GROUP BY user_id UNION ALL SELECT n.user_id, n.next FROM k JOIN n ON n.user_id = k.user_id AND n.i = k.i WHERE n.next IS NOT NULL)
SELECT event_id, k.i IS NOT NULL AS sent FROM e LEFT JOIN k USING (user_id, i)""",
}
