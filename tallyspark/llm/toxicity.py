"""Toxicity by a classifier chain.

Each category is predicted by a linear model on hashed word features (a document's distinct words, their prefixes of 4 and
6 letters) and on the probabilities of the categories before it. Categories are columns of 0/1 labels, in the chain's order;
the caller names them, the last one gives the verdict. Those that train a later model are out of fold: each
fifth of the sample gets them from models of the other four; at prediction they come from models of the whole sample. The
last category's threshold is the one of best F1 on its out-of-fold probabilities, at the corpus rate of the labels.

The models are trained (follow-the-regularised-leader, elastic net) on labelled rows up to a documented bound, `max_rows`,
whose sparse rows are made by Spark tasks, gathered on the driver and broadcast; the five folds' models of a category and that
of the whole sample are fitted as a task each. Prediction covers every text whole.

Defined cases: a null or empty text has no features, and the probabilities of the bias alone. Labelled rows without a
document, or with a null in the last category, aren't used; a null in an earlier one is 0. Of labels that repeat an id the
largest counts, of its texts the one with the smallest hash. Without labels of both kinds a
category has probability 0. Rows that repeat get equal results. Other columns pass through; where a name clashes,
the added column replaces the caller's.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType, StructField, StructType

from tallyspark.llm.common import bounded_batches, need, plain, table
from tallyspark.llm.linear import Ftrl, lists, logits, sigmoid

BITS = 18
DIM = 1 << BITS
PREFIXES = (4, 6)
MAX_ROWS = 6_000
FOLDS = 5
EPOCHS = 3
#: The categories of the query: documents of low quality, then toxic ones.
CHAIN = ("low_quality", "toxic")
SLICE_CHARS = 2_000_000
WORDS = regex.compile(r"\p{L}+")


def _features_of(word: str) -> list[int]:
    data = word.encode()
    parts = [b"w:" + data, *(b"p%d:" % n + word[:n].encode() for n in PREFIXES if len(word) > n)]
    return [zlib.crc32(p) >> (32 - BITS) for p in parts]


def distinct_words(text: str) -> set[str]:
    """The words of a text; those of a very long one aren't held all at once."""
    low = text.lower()
    return set(WORDS.findall(low)) if len(low) <= SLICE_CHARS else {m[0] for m in WORDS.finditer(low)}


def doc_features(text: str | None) -> np.ndarray:
    """The distinct features of a text, with how many of its distinct words have each."""
    got: defaultdict = defaultdict(int)
    for w in distinct_words(text or ""):
        for f in _features_of(w):
            got[f] += 1
    at = np.fromiter(got.keys(), np.int64, len(got))
    return np.stack([at, np.fromiter(got.values(), np.int64, len(got))])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [doc_features(t.as_py()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.list_(pa.int32()))], ["id", "labels", "at", "n"])


class Chain:
    """Weights of each category's model (features, earlier probabilities, bias), and the last one's threshold."""

    def __init__(self, names, weights, threshold: float):
        self.names, self.weights, self.threshold = names, weights, threshold


def _own_rows(rows: list, earlier: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    k = earlier.shape[1]
    return [(np.concatenate([at, DIM + np.arange(k)]), np.concatenate([x.astype(float), earlier[i]])) for i, (at, x) in enumerate(rows)]


def fit_here(rows: list, earlier: np.ndarray, y: np.ndarray, parts: list[np.ndarray]) -> list[np.ndarray]:
    """The weights of a model of each part of the rows."""
    own = _own_rows(rows, earlier)
    return [Ftrl(DIM + earlier.shape[1], 1, l1=0.6).fit([own[i] for i in part], y[part], EPOCHS).weights() for part in parts]


def fit_as_tasks(spark: SparkSession):
    """fit_here() with a Spark task for each part; the sampled rows are broadcast, once for all models."""
    sent: dict[int, object] = {}

    def fit(rows, earlier, y, parts):
        if id(rows) not in sent:
            flat = [np.concatenate([r[k] for r in rows]) if rows else np.zeros(0, np.int32) for k in (0, 1)]
            sent[id(rows)] = spark.sparkContext.broadcast((*flat, np.cumsum([len(r[0]) for r in rows])[:-1]))
        shared = sent[id(rows)]

        def of(batches):
            at, n, ends = shared.value
            own = list(zip(np.split(at, ends), np.split(n, ends), strict=True))
            for batch in batches:
                for k in batch.column(0).to_pylist():
                    w = fit_here(own, earlier, y, [parts[k]])[0]
                    yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([w.tobytes()])], ["part", "weights"])

        got = spark.range(0, len(parts), 1, len(parts)).mapInArrow(of, "part long, weights binary").collect()
        return [np.frombuffer(bytes(w)).reshape(-1, 1) for _, w in sorted(got)]

    return fit


def train_chain(rows: list[tuple[np.ndarray, np.ndarray]], labels: dict[str, np.ndarray], rates: np.ndarray, seed: int = 1, fit=fit_here) -> Chain:
    """rows: (features, counts); labels: category -> 0/1, in the chain's order; rates: how many rows each stands for."""
    n, names = len(rows), list(labels)
    fold = np.random.default_rng(seed).permutation(n) % FOLDS
    weights, earlier, threshold = [], np.zeros((n, 0)), 0.5
    for k, name in enumerate(names):
        y = labels[name].astype(float)
        if not 0 < y.sum() < n:
            weights.append(None)
            earlier = np.column_stack([earlier, np.zeros(n)])
            continue
        *folds, whole = fit(rows, earlier, y, [*(np.flatnonzero(fold != f) for f in range(FOLDS)), np.arange(n)])
        own, out = _own_rows(rows, earlier), np.zeros(n)
        for f, w in enumerate(folds):
            rest = np.flatnonzero(fold == f)
            out[rest] = sigmoid(logits([own[i] for i in rest], w)[:, 0]) if len(rest) else 0
        weights.append(whole)
        earlier = np.column_stack([earlier, out])
        if k == len(names) - 1:
            order = np.argsort(-out, kind="stable")
            hit, said = np.cumsum((y * rates)[order]), np.cumsum(rates[order])
            f1 = 2 * hit / (said + (y * rates).sum())
            best = int(f1.argmax())
            after = out[order[best + 1]] if best + 1 < n else 0.0
            threshold = float((out[order[best]] + after) / 2)
    return Chain(names, weights, threshold)


def train(docs: DataFrame, labels: DataFrame, categories=CHAIN, id_col="doc_id", text_col="text", max_rows: int = MAX_ROWS) -> Chain:
    """A chain of the categories, columns of labels. About max_rows labelled documents train it, 2 of 5 with the last label."""
    need(docs, id_col, text_col)
    need(labels, id_col, *categories)
    bounded_batches(docs.sparkSession)
    last = categories[-1]
    known = labels.filter(F.col(id_col).isNotNull() & F.col(last).isin(0, 1)).groupBy(F.col(id_col).alias("id"))
    known = known.agg(F.array(*[F.coalesce(F.max(c), F.lit(0)).cast("int") for c in categories]).alias("labels")).withColumn("last", F.element_at("labels", -1))
    sizes = dict(known.groupBy("last").count().collect())
    share = {c: min(1.0, max_rows * part / max(1, sizes.get(c, 0))) for c, part in ((1, 0.4), (0, 0.6))}
    u = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.filter(u < F.when(F.col("last") == 1, share[1]).otherwise(share[0])).limit(2 * max_rows)
    # At most 2 * max_rows labels, so they may be broadcast. The ids are different, so no more than these can be sampled.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    rows = rows.groupBy("id", "labels").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    got = rows.mapInArrow(_rows, f"id {kind}, labels array<int>, at array<int>, n array<int>").toArrow().sort_by("id")
    sparse = list(zip(lists(got["at"]), lists(got["n"]), strict=True))
    said = np.array(lists(got["labels"]), np.int64).reshape(len(sparse), len(categories))
    rates = np.array([1 / share[int(y)] for y in said[:, -1]])
    return train_chain(sparse, {c: said[:, k] for k, c in enumerate(categories)}, rates, fit=fit_as_tasks(docs.sparkSession))


def slice_scores(texts: list[str], chain: Chain) -> np.ndarray:
    """(texts, categories) probabilities. Weights add up over a text's distinct words, each looked up once for the slice."""
    numbers: defaultdict = defaultdict(count().__next__)  # with its own __len__ it would hold itself, and stay
    codes, counts = [], []
    for t in texts:
        own = distinct_words(t)
        codes += map(numbers.__getitem__, own)
        counts.append(len(own))
    at, starts = [], []
    for w in numbers:
        starts.append(len(at))
        at += _features_of(w)
    at, doc = np.array(at, np.int64), np.repeat(np.arange(len(texts)), counts)
    codes = np.array(codes, np.int64)
    out = np.zeros((len(texts), 0))
    for k, w in enumerate(chain.weights):
        if w is None:
            out = np.column_stack([out, np.zeros(len(texts))])
            continue
        word = np.add.reduceat(w[at, 0], starts) if len(at) else np.zeros(0)
        logit = np.bincount(doc, word[codes] if len(codes) else None, len(texts)) + w[-1, 0] + out @ w[DIM : DIM + k, 0]
        out = np.column_stack([out, sigmoid(logit)])
    return out


def predict(docs: DataFrame, chain: Chain, text_col="text", prefix="p_") -> DataFrame:
    """docs with a probability for each category, and `is_toxic` by the last one."""
    need(docs, text_col)
    docs = plain(docs, *[prefix + c for c in chain.names], "is_toxic")
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(chain.weights)
    names, threshold = chain.names, chain.threshold

    @arrow_udf(StructType([StructField(c, DoubleType()) for c in names]))
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Chain(names, sent.value, threshold)
        for batch in batches:
            parts, part, size = [np.zeros((0, len(names)))], [], 0
            for t in batch:
                part.append(t.as_py() or "")
                size += len(part[-1])
                if size >= SLICE_CHARS:
                    parts.append(slice_scores(part, own))
                    part, size = [], 0
            if part:
                parts.append(slice_scores(part, own))
            p = np.round(np.concatenate(parts), 6)
            yield pa.StructArray.from_arrays([pa.array(p[:, k]) for k in range(len(names))], names)

    out = docs.withColumn("__p", of(F.col(text_col)))
    out = out.withColumns({prefix + c: F.col(f"__p.{c}") for c in names})
    return out.withColumn("is_toxic", F.col(prefix + names[-1]) >= threshold).drop("__p")


def op10_toxicity(spark, sf_dir):
    """Every document's probabilities along the chain, and the verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").withColumn("low_quality", 1 - F.col("quality"))
    return predict(docs, train(docs, labels)).drop("text")


QUERIES = {"op10_toxicity": op10_toxicity}
ORACLES: dict[str, str] = {}
