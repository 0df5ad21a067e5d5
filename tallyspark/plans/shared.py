"""Folders that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a side that is broadcast at most.
MOST_SENT = 200_000
#: Folders that this driver has made, until clear_folders() removes them.
_MADE: list[str] = []


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir; on a local master, where that is unset, in the temporary folder (tests)."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = f"file://{os.path.join(tempfile.gettempdir(), 'tallyspark-streams')}"
    _MADE.append(f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


def clear_folders(spark: SparkSession, *paths: str) -> None:
    """Removes the given folders of fresh_folder(), or all of this driver's, and the checkpoints beside them; call it when the
    results that read them are taken."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths or tuple(_MADE):
        for name in (path, f"{path}-state"):
            at = jvm.org.apache.hadoop.fs.Path(name)
            at.getFileSystem(conf).delete(at, True)
        _MADE.remove(path)


def sent(rows: DataFrame, most: int = MOST_SENT, by_hash: bool = False) -> DataFrame:
    """rows to be broadcast, if they are at most so many: counted up to there, not further. Others are joined as Spark decides,
    or by_hash: both sides shuffled and these rows, evenly spread by the key, held in tasks without a sort."""
    if rows.limit(most + 1).count() <= most:
        return F.broadcast(rows)
    return rows.hint("shuffle_hash") if by_hash else rows
