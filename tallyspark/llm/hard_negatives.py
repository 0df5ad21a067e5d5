"""Hard negatives by exact integer scores: for each anchor and positive, rows of other labels that score nearly as high.

Rows and anchors meet in a grid of cells: a cell has about CELL_ROWS rows and CELL_ANCHORS anchors of one vector length, so
every task's memory is bounded whatever the input is. In a cell, component j of all rows is biased to be non-negative and
packed into the fields of one wide integer (Kronecker packing). Multiplying that integer by an anchor's biased component
gives the products of all rows at once; the sum over the components holds every row's score in its field, exactly, as no
field can overflow. The biases' share is taken off when the fields are unpacked.

Two passes: the first finds each anchor's best rows of its own label, the positives; the second finds, below each positive's
score, the best rows of other labels. Each cell gives its best few, which are merged by a ranking with a group limit.

Defined cases: rows with a null label or vector, or a null or non-finite component, take no part. Rows that repeat an id,
label and vector count once; rows that share an id only are rows of their own. A null id comes after all others in ties. An
anchor without positives, or a positive without negatives, gives no row; a negative score has no negatives, as 0.8 of it is
larger. Vectors of different lengths never meet. Empty vectors score 0. Scores must fit into 62 bits; larger components
raise an error. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import need, table, written

CELL_ROWS = 4096
CELL_ANCHORS = 1024
TOP = 5
SCALE = 256
ROWS = "g int, h int, id long, label int, v array<long>"
FOUND = "anchor long, positive int, score long, id long"


class Packed:
    """Rows' integer vectors, packed by component."""

    def __init__(self, rows: np.ndarray, most: int):
        """most: the largest size of a component of an anchor."""
        n, d = rows.shape
        self.n, self.bias, self.anchor_bias = n, int(-rows.min(initial=0)), most
        sums = rows.sum(axis=1, dtype=object) if d else np.zeros(n, object)
        largest = d * (int(rows.max(initial=0)) + self.bias) * 2 * most
        self.width = next((w for w in (4, 8) if largest < 1 << (8 * w - 2)), 0)
        if not self.width:
            raise ArithmeticError("vector components are too large for scores of 62 bits")
        fields = (rows + self.bias).astype(f"<u{self.width}")
        self.wide = [int.from_bytes(np.ascontiguousarray(fields[:, j]).tobytes(), "little") for j in range(d)]
        self.own = self.anchor_bias * (sums.astype(np.int64) + d * self.bias)

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """Inner products of all rows with an anchor."""
        total = 0
        for wide, a in zip(self.wide, anchor.tolist(), strict=True):
            total += wide * (a + self.anchor_bias)
        fields = np.frombuffer(total.to_bytes(self.n * self.width, "little"), f"<u{self.width}").astype(np.int64)
        # sum (a+A)(r+R) = sum a*r + R*sum a + A*sum (r+R)
        return fields - self.own - self.bias * int(anchor.sum())


def _first(scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray, among: np.ndarray, n: int) -> np.ndarray:
    """The first n of the rows `among`: highest score, then smallest id, nulls last."""
    if len(among) > n:
        own = scores[among]
        among = among[own >= np.partition(own, len(own) - n)[len(own) - n]]
    return among[np.lexsort((ids[among], nulls[among], -scores[among]))][:n]


def _vectors(column: pa.ChunkedArray, n: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.int64)


def _cell(rows: pa.Table, anchors: pa.Table, top: int, low: int, per: int, most: int) -> pa.Table:
    """The first rows for each anchor in a cell: of its label if positives are sought (per = 0), else of others below each
    positive's score, down to low / per of it."""
    out: list[tuple] = []
    if rows.num_rows and anchors.num_rows:
        packed = Packed(_vectors(rows["v"], rows.num_rows), most)
        ids, nulls = rows["id"].fill_null(0).to_numpy(), rows["id"].is_null().to_numpy()
        labels, numbers = rows["label"].to_numpy(), rows["row"].to_numpy()
        targets = anchors["targets"].to_pylist() if per else [()] * anchors.num_rows
        vectors = _vectors(anchors["v"], anchors.num_rows)
        for own, vector, label, goals in zip(anchors["row"].to_pylist(), vectors, anchors["label"].to_pylist(), targets, strict=True):
            scores = packed.scores(vector)
            if per:
                other = np.flatnonzero((labels != label) & (scores <= max(goals)) & (per * scores >= low * min(goals)))
                for k, goal in enumerate(goals):
                    fit = other[(scores[other] <= goal) & (per * scores[other] >= low * goal)]
                    out += [(own, k, scores[i], ids[i], nulls[i]) for i in _first(scores, ids, nulls, fit, top)]
            else:
                same = np.flatnonzero((labels == label) & (numbers != own))
                out += [(own, 0, scores[i], ids[i], nulls[i]) for i in _first(scores, ids, nulls, same, top)]
    anchor, positive, score, found, null = zip(*out, strict=True) if out else [()] * 5
    arrays = [pa.array(anchor, pa.int64()), pa.array(positive, pa.int32()), pa.array(score, pa.int64()), pa.array(np.array(found, np.int64), pa.int64(), mask=np.array(null, bool))]
    return pa.Table.from_arrays(arrays, names=["anchor", "positive", "score", "id"])


def _ranked(cells: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return cells.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def integer_rows(embeddings: DataFrame, id_col="vec_id", vector_col="embedding", label_col="label", scale: int = SCALE) -> DataFrame:
    """(id, label, v) of the rows that take part: floor(scale * x) of each component. Rows that repeat count once."""
    need(embeddings, id_col, vector_col, label_col)
    x = F.col(vector_col)
    rows = embeddings.filter(F.col(label_col).isNotNull() & x.isNotNull())
    usable = ~F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    # A filter on nulls inside an array must not be null itself.
    rows = rows.filter(F.coalesce(usable, F.lit(False)))
    wide = F.lit(float(1 << 61))
    whole = F.transform(x, lambda c: F.floor(F.greatest(-wide, F.least(wide, F.lit(float(scale)) * c.cast("double")))).cast("long"))
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"), whole.alias("v")).distinct()


def mine_negatives(rows: DataFrame, is_anchor, top_positives: int = TOP, top: int = TOP, low: int = 80, per: int = 100, cell_rows: int = CELL_ROWS, cell_anchors: int = CELL_ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (id, label, v) rows.

    is_anchor: a condition on id. A negative's score is between low / per of the positive's and that itself.
    """
    rows = written(rows.select("id", "label", "v").withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    anchors = rows.filter(F.coalesce(is_anchor, F.lit(False)))
    most = F.coalesce(F.max(F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v")))), F.lit(0)).cast("long")
    n_rows = rows.count()
    n_anchors, largest = anchors.agg(F.count("*"), most).first()
    n_h, n_g = max(1, -(-n_rows // cell_rows)), max(1, -(-n_anchors // cell_anchors))
    # A cell is a task's work of some tenths of a second or more: Spark isn't to join several in a task.
    tasks = min(n_h * n_g, 20_000)
    key = F.xxhash64("row")

    def cells(own: DataFrame, per: int, top: int) -> DataFrame:
        grid_rows = rows.withColumn("h", F.pmod(key, F.lit(n_h)).cast("int")).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(n_g - 1))))
        own = own.toDF(*own.columns)  # names of its own, as both sides come from one table
        grid_own = own.withColumn("g", F.pmod(key, F.lit(n_g)).cast("int")).withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(n_h - 1))))
        sides = [x.withColumn("d", F.size("v")).repartition(tasks, "d", "g", "h").groupBy("d", "g", "h") for x in (grid_rows, grid_own)]
        return sides[0].cogroup(sides[1]).applyInArrow(lambda a, b: _cell(a, b, top, low, per, max(1, largest)), FOUND)

    positives = written(_ranked(cells(anchors, 0, top_positives), top_positives).select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), "rank"), "negatives-positives")
    goals = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_score"))).alias("own"))  # top_positives at most
    goals = goals.select(F.col("anchor").alias("row"), F.col("own.positive_score").alias("targets"))
    found = _ranked(cells(anchors.join(goals, "row"), per, top), top)
    found = found.withColumn("place", F.col("positive") + 1).select("anchor", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = found.join(positives.withColumnRenamed("rank", "place"), ["anchor", "place"])
    out = out.join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector, against all vectors."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return mine_negatives(integer_rows(rows), F.col("id") % 100 == 0)


OP12_SQL = f"""
WITH r AS (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n AS (SELECT *, row_number() OVER () AS r FROM r),
s AS (SELECT a.r AS anchor, a.id AS anchor_id, b.id, a.label = b.label AS same, list_sum(list_transform(list_zip(a.v, b.v), lambda x: x[1] * x[2]))::BIGINT AS score
  FROM n a JOIN n b ON a.r <> b.r AND len(a.v) = len(b.v) WHERE a.id % 100 = 0),
p AS (SELECT anchor, anchor_id, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id NULLS LAST) AS place FROM s WHERE same QUALIFY place <= {TOP}),
m AS (SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.id NULLS LAST) AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM m WHERE rank <= {TOP}
"""

QUERIES = {"op12_hard_negatives": op12_hard_negatives}
ORACLES = {"op12_hard_negatives": OP12_SQL}
