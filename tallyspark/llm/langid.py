"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lowered and runs of signs other than letters become one blank (none before the first letter); hashed n-grams of 1
to 3 characters are counted. Document frequencies are sums over every text that may be learned from. The classifier is
trained (follow-the-regularised-leader, elastic net) on a sample with a documented bound, about `max_rows` texts, equally of
each language, whose sparse rows are made by Spark tasks and gathered on the driver; a fifth of the sample sets the
temperature instead. It knows the `max_langs` most frequent languages (of like frequent ones the first by name), a bound on
the model's size.

Counts are sparse, and taken in slices of at most SLICE_TEXTS texts and SLICE_CHARS characters; a longer text is counted in
pieces that overlap by two characters, so memory doesn't grow with the texts beyond the text itself.

Defined cases: a text that is null or has no letter is `und` with score 0. Without anything to learn from every text is
`und`. Null languages are never learned. Of equally probable languages the first by name is given. Rows that repeat get
equal results, and count once in the sample. Other columns pass through; where a name clashes, the added column replaces
the caller's.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tallyspark.llm.common import bounded_batches, need, plain, table
from tallyspark.llm.linear import Ftrl, lists, logits, softmax, temperature

DIM = 1 << 13
MAX_ROWS = 2_400
MAX_LANGS = 400
EPOCHS = 4
SLICE_CHARS = 1 << 18
SLICE_TEXTS = 64
NGRAM = 3
#: Length of a text's row of features.
NORM = 10.0
RESULT = StructType([StructField("lang", StringType()), StructField("score", DoubleType())])


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.strings.isalpha(np.arange(0x110000, dtype=np.uint32).view("<U1"))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _signs(cp: np.ndarray, before: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(signs, which of cp they are): letters, and one blank after a run of them; before: a letter comes before cp."""
    is_letter = _letters()[cp]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[:1] |= before
    return np.where(is_letter, cp, np.uint32(32))[keep], keep


def _buckets(cp: np.ndarray, n: int) -> np.ndarray:
    """The bucket of the n-gram that starts at each sign."""
    h = cp[: max(0, len(cp) - n + 1)].astype(np.uint64)
    with np.errstate(over="ignore"):
        for k in range(1, n):
            h = (h * np.uint64(0x100000001B3)) ^ cp[k : len(cp) - n + 1 + k].astype(np.uint64)
        return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(51)).astype(np.int64)


def counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, count) of the hashed n-grams of a few texts, in this order."""
    short = [t.lower() if len(t) <= SLICE_CHARS else "" for t in texts]
    cp, keep = _signs(_points(" ".join([*short, ""])))
    doc = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in short])[keep]
    out = np.zeros(len(texts) * DIM, np.int64)
    for n in range(1, NGRAM + 1):
        bucket = _buckets(cp, n)
        same = doc[: len(bucket)] == doc[len(doc) - len(bucket) :]
        out += np.bincount((doc[: len(bucket)] * DIM + bucket)[same], minlength=len(out))
    for i, t in enumerate(texts):
        if len(t) > SLICE_CHARS:
            out[i * DIM : (i + 1) * DIM] = _long_counts(t.lower() + " ")
    at = np.flatnonzero(out)
    return at // DIM, at % DIM, out[at]


def _long_counts(text: str) -> np.ndarray:
    """Counts of one lowered text, piece by piece; the last signs of a piece begin the next one."""
    out, rest, before = np.zeros(DIM, np.int64), np.zeros(0, np.uint32), False
    for at in range(0, len(text), SLICE_CHARS):
        points = _points(text[at : at + SLICE_CHARS])
        piece, _ = _signs(points, before)
        before = bool(_letters()[points[-1]])
        cp = np.concatenate([rest, piece])
        for n in range(1, NGRAM + 1):
            out += np.bincount(_buckets(cp[max(0, len(rest) - n + 1) :], n), minlength=DIM)
        rest = cp[max(0, len(cp) - NGRAM + 1) :]
    return out


def _slices(texts: pa.Array) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        t = t.as_py() or ""
        if part and (size + len(t) > SLICE_CHARS or len(part) >= SLICE_TEXTS):
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def _weighted(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value): log counts by inverse document frequency, each text's row of length NORM."""
    doc, feature, n = counts(texts)
    x = np.log1p(n) * idf[feature]
    norm = np.sqrt(np.bincount(doc, x * x, len(texts)))
    return doc, feature, x * NORM / norm[doc]


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(DIM, np.int64), 0
    for batch in batches:
        for texts in _slices(batch.column(0)):
            doc, feature, _ = counts(texts)
            total += np.bincount(feature, minlength=DIM)
            n += len(np.unique(doc))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIM, dtype=np.int32)), pa.array(np.concatenate([[n], total]))], ["feature", "n"])


def _rows(idf: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _slices(batch.column(0)):
                doc, feature, x = _weighted(texts, idf)
                ends = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (feature.astype(np.int32), x)]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(at, len(texts)), batch.column(2).slice(at, len(texts)), *lists], ["lang", "u", "at", "x"])
                at += len(texts)

    return rows


class Model:
    """Languages, inverse document frequencies, weights and temperature; small, and the same whatever the input is."""

    def __init__(self, langs, idf, weights, temp):
        self.langs, self.idf, self.weights, self.temp = langs, idf, weights, temp


def train(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", max_rows: int = MAX_ROWS, max_langs: int = MAX_LANGS) -> Model:
    """A model of the rows of docs with a language. About max_rows of them train the classifier."""
    need(docs, id_col, text_col, lang_col)
    bounded_batches(docs.sparkSession)
    known = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.col(id_col).alias("id")).filter("text is not null and lang is not null")
    df = dict(known.select("text").mapInArrow(_document_frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n")).collect())
    total = df.get(-1, 0)
    idf = np.array([np.log((1 + total) / (1 + df.get(i, 0))) + 1 for i in range(DIM)])
    sizes = dict(known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).collect())
    langs = sorted(sizes)
    if not langs or not total:
        return Model([], idf, np.zeros((DIM + 1, 0)), 1.0)
    u = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30)
    share = F.element_at(F.create_map(*[F.lit(y) for lang in langs for y in (lang, min(1.0, max_rows / len(langs) / sizes[lang]))]), F.col("lang"))
    sample = known.select("text", "lang", (u / share).alias("u")).filter("u < 1").dropDuplicates()  # null for other languages
    got = sample.mapInArrow(_rows(idf), "lang string, u double, at array<int>, x array<double>").toArrow().sort_by([("u", "ascending"), ("lang", "ascending")])
    rows = list(zip(lists(got["at"]), lists(got["x"]), strict=True))
    label = np.array([langs.index(x) for x in got["lang"].to_pylist()], np.int64)
    order = np.array([i for i, (at, _) in enumerate(rows) if len(at)], np.int64)
    fit, rest = order[len(order) // 5 :], order[: len(order) // 5]
    weights = Ftrl(DIM, len(langs)).fit([rows[i] for i in fit], label[fit], EPOCHS).weights() if len(langs) > 1 else np.zeros((DIM + 1, 1))
    return Model(langs, idf, weights, temperature(logits([rows[i] for i in rest], weights), label[rest]))


def scores(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(probabilities of the languages, whether the text has a letter) of a few texts."""
    doc, feature, x = _weighted(texts, model.idf)
    z = np.stack([np.bincount(doc, x * model.weights[feature, k], len(texts)) for k in range(len(model.langs))], axis=1)
    return softmax((z + model.weights[-1]) / model.temp), np.bincount(doc, minlength=len(texts)) > 0


def predict(docs: DataFrame, model: Model, text_col="text", lang_col="lang_pred", score_col="score") -> DataFrame:
    """docs with the predicted language and its calibrated probability."""
    need(docs, text_col)
    docs = plain(docs, lang_col, score_col)
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((model.langs, model.idf, model.weights, model.temp))

    @arrow_udf(RESULT)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(*sent.value)
        for batch in batches:
            named, said = [], []
            for texts in _slices(batch):
                p, some = scores(texts, own) if own.langs else (np.zeros((len(texts), 1)), np.zeros(len(texts), bool))
                best = p.argmax(1)
                named += [own.langs[k] if ok else "und" for k, ok in zip(best, some, strict=True)]
                said += np.where(some, np.round(p.max(1), 6), 0.0).tolist()
            yield pa.StructArray.from_arrays([pa.array(named, pa.string()), pa.array(said, pa.float64())], ["lang", "score"])

    out = docs.withColumn("__lang", of(F.col(text_col)))
    return out.withColumn(lang_col, F.col("__lang.lang")).withColumn(score_col, F.col("__lang.score")).drop("__lang")


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string")) % 4 == 2, F.lit(False))


def op4_langid(spark, sf_dir):
    """Every document's language, learned from those that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES = {"op4_langid": op4_langid}
ORACLES: dict[str, str] = {}
