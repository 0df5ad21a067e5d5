"""Ranked lexical search over a length-stratified index, with integer scores.

A term is a run of ASCII letters and digits (A-Z lowered) and characters beyond ASCII. A document of n terms has the
normaliser m = 75 + (25 * n * N) div L, with N documents that have terms and L terms in all. The index groups documents by
equal m. A stratum is dealt to segments of about SEGMENT_BYTES of text by a hash, so that no stratum, however many documents
share a length, is one task's work. A segment is one row: its documents, its terms, and each term's postings in runs of
equal tf, highest first. As all of a segment shares m, a run has one impact, (10^9 * tf) div (1000 * tf + 12 * m), computed
once; the first run gives the term's largest.

A search takes the items in blocks of at most BLOCK_ITEMS items and about BLOCK_TERMS terms, the only things sent to the
driver and to all tasks. For each block: (1) document frequencies of its terms are summed; (2) for each item the segments
with the highest bounds, the sums of the terms' largest impacts, are found and visited first, which gives a score that
TOP documents reach; (3) all segments whose bound reaches that score are visited, no others, and each task's best are merged.
Every segment with a bound above the TOP-th score is visited, so the result is exact.

Defined cases: a null or empty text has no terms; such documents aren't counted and such items get no rows. Rows that repeat a
document are ranked each. Items that repeat an id and text count once; items that share an id only are ranked each. Null ids
come last among equal scores. Only the named columns are read. Very long texts are brought to terms in pieces, and make a segment of their own.
An empty table of documents or items gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from tallyspark.llm.common import bounded_batches, checked_join, fresh_dir, need, table, written
from tallyspark.llm.license_scan import PIECE, TO_WORDS, as_words

#: A term, for the query's SQL.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 20
SEGMENT_BYTES = 4 << 20
SEGMENT_DOCS = 4096
BLOCK_ITEMS = 1_000
BLOCK_TERMS = 200_000
#: Segments that an item visits first.
FIRST = 4
ROW_GROUP = 4 << 20
SEGMENT = "m long, piece int, docs array<long>, terms array<string>, df array<int>, max_tf array<int>, runs array<int>, run_tf array<int>, run_end array<int>, post array<int>"


#: While an index is built or searched: rows that a Parquet reader decodes at once, and bytes of Arrow batches. Texts and
#: segments are large rows, of which the usual 4,096 would be held decoded.
SETTINGS = {"spark.sql.parquet.columnarReaderBatchSize": "256", "spark.sql.execution.arrow.maxBytesPerBatch": "2m"}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """SETTINGS for the jobs within, which all run there; then the session has its own again."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@dataclass
class Index:
    segments: DataFrame
    n_docs: int
    n_terms: int


def _split(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, in pieces."""
    words, at = as_words(text), 0
    while at < len(words):
        end = words.find(b" ", at + PIECE)
        end = len(words) if end < 0 else end
        yield words[at:end].split()
        at = end


def count_terms(text: str | None) -> int:
    """How many terms a text has: the places where one begins."""
    signs = np.frombuffer(b" " + (text or "").encode().translate(TO_WORDS), np.uint8) != 32
    return int(np.count_nonzero(signs[1:] & ~signs[:-1]))


@arrow_udf(LongType())
def _count_udf(texts: pa.Array) -> pa.Array:
    return pa.array([count_terms(t.as_py()) for t in texts], pa.int64())


def _segment(group: pa.Table) -> pa.Table:
    group = group.take(pc.sort_indices(group["id"], null_placement="at_end"))
    numbers: defaultdict = defaultdict(count().__next__)
    codes, docs = [], []
    for k, text in enumerate(group["text"]):
        for own in _split(text.as_py()):
            codes.append(np.fromiter(map(numbers.__getitem__, own), np.int64, len(own)))
            docs.append(np.full(len(own), k, np.int64))
    n = group.num_rows
    pairs, tf = np.unique(np.concatenate(codes) * n + np.concatenate(docs), return_counts=True)
    code, doc = pairs // n, pairs % n
    order = np.lexsort((doc, -tf, code))
    code, doc, tf = code[order], doc[order], tf[order]
    last = np.flatnonzero(np.append((np.diff(code) != 0) | (np.diff(tf) != 0), True))  # the last posting of each run
    runs = np.cumsum(np.bincount(code[last], minlength=len(numbers)))
    first = np.append(0, runs[:-1])
    row = {
        "m": group["m"][0].as_py(),
        "piece": group["piece"][0].as_py(),
        "docs": group["id"].combine_chunks(),
        "terms": pa.array(list(numbers), pa.binary()).cast(pa.string()),
        "df": np.bincount(code, minlength=len(numbers)),
        "max_tf": tf[last][first],
        "runs": runs,
        "run_tf": tf[last],
        "run_end": last + 1,
        "post": doc,
    }
    arrays = [pa.array([row["m"]], pa.int64()), pa.array([row["piece"]], pa.int32())]
    for name in list(row)[2:]:
        values = row[name] if isinstance(row[name], pa.Array) else pa.array(row[name].astype(np.int32))
        arrays.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
    return pa.Table.from_arrays(arrays, names=list(row))


def normaliser(n, n_docs: int, n_terms: int):
    """m of a document of n terms. Decimals, as the product may be larger than 64 bits."""
    return 75 + F.expr(f"(25 * cast({n} AS decimal(20, 0)) * cast({n_docs} AS decimal(15, 0))) div cast({max(1, n_terms)} AS decimal(20, 0))").cast("long")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = SEGMENT_BYTES, segment_docs: int = SEGMENT_DOCS) -> Index:
    """A written index of all documents that have terms."""
    need(docs, id_col, text_col)
    spark = docs.sparkSession
    bounded_batches(spark)
    with small_batches(spark):
        return _built(docs, id_col, text_col, segment_bytes, segment_docs)


def _built(docs: DataFrame, id_col: str, text_col: str, segment_bytes: int, segment_docs: int) -> Index:
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("n", _count_udf("text"))
    lengths = written(rows.groupBy("n").agg(F.count("*").alias("docs"), F.sum(F.octet_length("text").cast("long")).alias("bytes")).filter("n > 0"), "index-lengths")
    n_docs, n_terms = lengths.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum(F.col("docs") * F.col("n")), F.lit(0))).first()
    m = normaliser("n", n_docs, n_terms)
    pieces = F.greatest(F.ceil(F.sum("bytes") / segment_bytes), F.ceil(F.sum("docs") / segment_docs)).cast("int")
    large = written(lengths.groupBy(m.alias("m")).agg(pieces.alias("pieces")).filter("pieces > 1"), "index-strata")
    rows = rows.filter("n > 0").select("id", "text", m.alias("m"), F.monotonically_increasing_id().alias("place"))
    rows = checked_join(rows, large, ["m"], "left", spread="place")
    rows = rows.select("id", "text", "m", F.pmod(F.xxhash64("place"), F.coalesce("pieces", F.lit(1))).cast("int").alias("piece"))
    path = fresh_dir(spark, "index")
    rows.groupBy("m", "piece").applyInArrow(_segment, SEGMENT).write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return Index(spark.read.schema(SEGMENT).parquet(path), n_docs, n_terms)


class Query:
    """The terms of a block of items: numbers of terms, and weights, item after item."""

    def __init__(self, items: list[Counter]):
        numbers: defaultdict = defaultdict(count().__next__)
        self.ends = np.cumsum([len(x) for x in items])
        self.term = np.array([numbers[t] for x in items for t in x], np.int64)
        self.times = np.array([k for x in items for k in x.values()], np.int64)
        self.terms = pa.array(list(numbers), pa.binary()).cast(pa.string())
        self.weight = self.times

    def weigh(self, df: dict[int, int], n_docs: int) -> None:
        by_term = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[k] + 1))) if k in df else 0 for k in range(len(self.terms))], np.int64)
        self.weight = self.times * by_term[self.term]

    def bounds(self, best: np.ndarray) -> np.ndarray:
        """Each item's sum, given each term's largest impact."""
        return np.add.reduceat(best[self.term] * self.weight, np.append(0, self.ends[:-1]))


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 12 * m)


def _ints(values) -> np.ndarray:
    return values.values.to_numpy(zero_copy_only=False)


def _found(row: dict, terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(places in the segment, numbers of the query's terms) of the terms that it holds."""
    number = pc.index_in(row["terms"].values, terms)
    place = np.flatnonzero(number.is_valid().to_numpy(zero_copy_only=False))
    return place, number.drop_null().to_numpy().astype(np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(i)[k] for i, name in enumerate(batch.schema.names)}


def _frequencies(segments: DataFrame, terms: pa.Array) -> dict[int, int]:
    def counted(batches):
        total = np.zeros(len(terms), np.int64)
        for row in _rows(batches):
            place, number = _found(row, terms)
            total[number] += _ints(row["df"])[place]
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], names=["term", "df"])

    out = segments.select("terms", "df").mapInArrow(counted, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return dict(map(tuple, out.collect()))  # at most a block's terms


def _best_impacts(row: dict, query: Query, found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    best = np.zeros(len(query.terms), np.int64)
    best[found[1]] = impact(_ints(row["max_tf"])[found[0]], row["m"].as_py())
    return best


def _first_visits(segments: DataFrame, query: Query, first: int) -> DataFrame:
    """(m, piece, items): the segments with the `first` highest bounds of each item."""

    def bounds(batches):
        n = len(query.ends)
        top, at = np.zeros((n, first), np.int64), np.zeros((n, first, 2), np.int64)
        for row in _rows(batches):
            own = query.bounds(_best_impacts(row, query, _found(row, query.terms)))
            least = top.argmin(axis=1)
            better = np.flatnonzero(own > top[np.arange(n), least])
            top[better, least[better]] = own[better]
            at[better, least[better]] = row["m"].as_py(), row["piece"].as_py()
        item, k = np.nonzero(top)
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(top[item, k]), pa.array(at[item, k, 0]), pa.array(at[item, k, 1].astype(np.int32))], names=["item", "bound", "m", "piece"])

    order = Window.partitionBy("item").orderBy(F.desc("bound"), "m", "piece")
    out = segments.select("m", "piece", "terms", "max_tf").mapInArrow(bounds, "item long, bound long, m long, piece int")
    out = out.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= first)
    return out.groupBy("m", "piece").agg(F.collect_set("item").alias("items"))  # a block's items at most


class _Best:
    """The best documents so far of each item."""

    def __init__(self, reached: list[int], top: int):
        self.top, self.reached = top, np.maximum(np.array(reached, np.int64), 1)
        self.rows: dict[int, tuple] = {}

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        if item in self.rows:
            scores, ids, nulls = (np.concatenate(x) for x in zip(self.rows[item], (scores, ids, nulls), strict=True))
        if len(scores) >= self.top:
            order = np.lexsort((ids, nulls, -scores))[: self.top]
            scores, ids, nulls = scores[order], ids[order], nulls[order]
            self.reached[item] = max(self.reached[item], scores[-1])
        self.rows[item] = scores, ids, nulls

    def batch(self) -> pa.RecordBatch:
        item = np.repeat(np.array(list(self.rows), np.int64), [len(x[0]) for x in self.rows.values()])
        scores, ids, nulls = (np.concatenate(x) for x in zip(*self.rows.values(), strict=True)) if self.rows else (np.zeros(0, np.int64),) * 3
        return pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, pa.int64(), mask=nulls.astype(bool)), pa.array(scores, pa.int64())], names=["item", "doc_id", "score"])


def _visit(row: dict, query: Query, best: _Best) -> None:
    """Scores a segment's documents for the items (of row["items"], if given) whose bound reaches what is sought."""
    found = _found(row, query.terms)
    bound = query.bounds(_best_impacts(row, query, found))
    items = np.flatnonzero(bound >= best.reached)
    if "items" in row:
        items = np.intersect1d(items, _ints(row["items"]))
    if not len(items):
        return
    at = np.full(len(query.terms), -1, np.int64)
    at[found[1]] = found[0]
    m, runs, run_end, post = row["m"].as_py(), _ints(row["runs"]), _ints(row["run_end"]), _ints(row["post"])
    run_impact = impact(_ints(row["run_tf"]), m)
    ids = row["docs"].values
    nulls, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
    cached: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def postings(place: int) -> tuple[np.ndarray, np.ndarray]:
        if place not in cached:
            a, b = runs[place - 1] if place else 0, runs[place]
            start = run_end[a - 1] if a else 0
            cached[place] = post[start : run_end[b - 1]], np.repeat(run_impact[a:b], np.diff(run_end[a:b], prepend=start))
        return cached[place]

    for item in items[np.argsort(-bound[items], kind="stable")].tolist():
        scores = np.zeros(len(ids), np.int64)
        own = slice(query.ends[item - 1] if item else 0, query.ends[item])
        for place, weight in zip(at[query.term[own]].tolist(), query.weight[own].tolist(), strict=True):
            if place >= 0 and weight:
                docs, impacts = postings(place)
                scores[docs] += weight * impacts  # a document occurs once among a term's postings
        good = np.flatnonzero(scores >= best.reached[item])
        if len(good):
            best.add(item, scores[good], ids[good], nulls[good])


def _visited(segments: DataFrame, query: Query, reached: list[int], top: int) -> DataFrame:
    def visit(batches):
        best = _Best(reached, top)
        for row in _rows(batches):
            _visit(row, query, best)
        yield best.batch()

    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    out = segments.mapInArrow(visit, "item long, doc_id long, score long")
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _blocks(items: DataFrame, most_items: int, most_terms: int) -> Iterator[list[tuple]]:
    block, size = [], 0
    for item_id, text in items.toLocalIterator():
        terms = Counter(t for own in _split(text or "") for t in own)
        if not terms:
            continue
        if block and (len(block) >= most_items or size + len(terms) > most_terms):
            yield block
            block, size = [], 0
        block.append((item_id, terms))
        size += len(terms)
    if block:
        yield block


def search(index: Index, items: DataFrame, id_col: str = "item_id", text_col: str = "text", top: int = TOP, first: int = FIRST, block_items: int = BLOCK_ITEMS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's `top` documents by score."""
    need(items, id_col, text_col)
    with small_batches(items.sparkSession):
        return _ranked(index, items, id_col, text_col, top, first, block_items, block_terms)


def _ranked(index: Index, items: DataFrame, id_col: str, text_col: str, top: int, first: int, block_items: int, block_terms: int) -> DataFrame:
    spark, segments = items.sparkSession, index.segments
    path = fresh_dir(spark, "search")
    schema = "item_id long, rank int, doc_id long, score long"
    spark.createDataFrame([], schema).write.parquet(path)
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).distinct()
    for block in _blocks(rows, block_items, block_terms):
        query = Query([terms for _, terms in block])
        query.weigh(_frequencies(segments, query.terms), index.n_docs)
        visits = _first_visits(segments, query, first)  # at most block_items * first rows
        started = _visited(segments.join(F.broadcast(visits), ["m", "piece"]), query, [0] * len(block), top)
        reached = [0] * len(block)
        for item, score in started.filter(F.col("rank") == top).select("item", "score").collect():
            reached[item] = score
        names = spark.createDataFrame([(k, item_id) for k, (item_id, _) in enumerate(block)], "item long, item_id long")
        found = _visited(segments, query, reached, top).join(F.broadcast(names), "item")
        found.select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def op13_lexical_search(spark, sf_dir):
    """All documents ranked for each benchmark item."""
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


_SQL_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')"
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS w FROM documents),
c AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
f AS (SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM p, c GROUP BY t),
q AS (SELECT i, item_id, t FROM (SELECT row_number() OVER () AS i, item_id, unnest({_SQL_WORDS}) AS t FROM (SELECT DISTINCT item_id, text FROM benchmark))),
i AS (SELECT i, any_value(item_id) AS item_id, t, count(*) AS times FROM q GROUP BY i, t),
s AS (SELECT i.i, any_value(i.item_id) AS item_id, d.r, any_value(d.doc_id) AS doc_id,
    sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(w) * n_docs) // n_terms))))::BIGINT AS score
  FROM i JOIN f USING (t) JOIN p USING (t) JOIN d USING (r), c GROUP BY i.i, d.r)
SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score FROM s
WHERE score > 0 QUALIFY rank <= {TOP}
"""

QUERIES = {"op13_lexical_search": op13_lexical_search}
ORACLES = {"op13_lexical_search": OP13_SQL}
