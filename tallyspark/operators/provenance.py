"""Provenance: which texts contain which quotes, exactly, by hashes of windows of the texts.

A text is walked once for all quotes: of each of a few lengths, all its windows are hashed at once and looked up. Quotes below
SHORT characters are looked up whole, longer ones by the window that they begin with, and by a hash of all of it where that is
met. What is met is cut out of the text and compared with the quotes character by character, so hashes decide nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.plans.shared import fresh_folder
from tallyspark.plans.views import table

SHORT = 16
#: Lengths of the windows: all below SHORT, then those that longer quotes begin with.
TIERS = [*range(1, SHORT), 16, 32, 64, 128]
#: What an index holds of quotes, in characters; one longer than SHORT counts as so many. Some 200 MB in a Python worker.
BLOCK_CHARS = 64_000_000
#: Characters of texts that are hashed at once; a longer text is hashed alone.
BATCH_CHARS = 500_000
#: Candidates that are looked at at once, and found quotes that a task counts before it gives them.
MOST_AT_ONCE, MOST_COUNTED = 1_000_000, 200_000
#: Texts whose pairs are made at once.
ROWS_AT_ONCE = 200

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: Powers of the base and of its inverse, as many as were asked for yet.
_POWERS: dict[int, np.ndarray] = {}
#: The index that a Python worker has built last, by its block.
_LAST: dict[str, list] = {}

INDEXED = "length int, head long, whole long, short string"


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _POWERS or len(_POWERS[base]) < n:
        of = np.full(max(n, BATCH_CHARS + 1), base, np.uint64)
        of[0] = 1
        _POWERS[base] = np.multiply.accumulate(of)
    return _POWERS[base][:n]


class _Hashed:
    """Texts behind one another with the hashes of their windows: sums of code points times powers of the base, modulo 2^64."""

    def __init__(self, texts: list[str]):
        self.joined = "".join(texts)
        self.codes = codes = np.frombuffer(self.joined.encode("utf-32-le"), np.uint32)
        self.ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * _powers(_BASE, len(codes)), out=self.sums[1:])
        self.back = _powers(_INVERSE, len(codes) + 1)

    def windows(self, length: int) -> np.ndarray:
        n = max(0, len(self.sums) - length)
        return (self.sums[length:] - self.sums[:n]) * self.back[:n]

    def at(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return (self.sums[starts + lengths] - self.sums[starts]) * self.back[starts]


def _batches(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts with the number of their first, each of about BATCH_CHARS characters."""
    first, size = 0, 0
    for k, text in enumerate(texts):
        if k > first and size + len(text) > BATCH_CHARS:
            yield first, texts[first:k]
            first, size = k, 0
        size += len(text)
    if first < len(texts):
        yield first, texts[first:]


def _windowed(lengths: np.ndarray) -> np.ndarray:
    """The windows that quotes of these lengths are looked up by."""
    return np.array(TIERS)[np.searchsorted(TIERS, lengths, "right") - 1]


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What an index needs of quotes: length, hash of the window that it begins with, hash of the whole, and a short one itself."""
    for batch in batches:
        for first, quotes in _batches(batch.column(0).to_pylist()):
            hashed = _Hashed(quotes)
            lengths = np.diff(hashed.ends, prepend=0)
            starts = hashed.ends - lengths
            hashes = [pa.array(hashed.at(starts, n).view(np.int64)) for n in (_windowed(lengths), lengths)]
            short = pa.array([q if len(q) < SHORT else None for q in quotes], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(lengths.astype(np.int32)), *hashes, short, batch.column(1).slice(first, len(quotes))], names=["length", "head", "whole", "short", "block"])


class _Tier:
    """The quotes looked up by windows of one length: the windows' hashes in order, and for each the quotes that begin so."""

    def __init__(self, rows: pa.Table, length: int):
        head = rows["head"].to_numpy().view(np.uint64)
        order = np.argsort(head, kind="stable")
        self.length = length
        self.lengths = rows["length"].to_numpy()[order].astype(np.int64)
        self.wholes = rows["whole"].to_numpy()[order].view(np.uint64)
        self.heads, first = np.unique(head[order], return_index=True)
        self.offsets = np.append(first, len(order))
        #: Short quotes in the order of their hashes, as strings and as code points; none where two share a hash.
        self.short = None
        if length < SHORT and len(self.heads) == len(order):
            self.short = rows["short"].take(pa.array(order)).to_pylist()
            self.codes = np.frombuffer("".join(self.short).encode("utf-32-le"), np.uint32).reshape(-1, length)
        bits = max(10, (8 * len(self.heads)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.there = np.zeros(1 << bits, bool)
        self.there[(self.heads * _MIX) >> self.shift] = True

    def _met(self, hashed: _Hashed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(numbers of texts, places, numbers of heads) of windows that don't leave their text."""
        windows = hashed.windows(self.length)
        at = np.flatnonzero(self.there[(windows * _MIX) >> self.shift])
        own = windows[at]
        head = np.minimum(np.searchsorted(self.heads, own), len(self.heads) - 1)
        same = self.heads[head] == own
        at, head = at[same], head[same]
        text = np.searchsorted(hashed.ends, at, "right")
        inside = at + self.length <= hashed.ends[text]
        return text[inside], at[inside], head[inside]

    def shorts(self, hashed: _Hashed) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of texts, numbers of short quotes that they contain), each pair once."""
        text, at, head = self._met(hashed)
        bits, wide = np.int64(len(hashed.codes).bit_length()), np.int64(len(self.heads))
        placed = np.sort(((text * wide + head) << bits) | at)
        key = placed >> bits
        first = np.flatnonzero(np.diff(key, prepend=-1))
        at, text, head = placed[first] & ((np.int64(1) << bits) - 1), key[first] // wide, key[first] % wide
        same = np.ones(len(at), bool)
        for j in range(self.length):
            same &= hashed.codes[at + j] == self.codes[head, j]
        for k in np.flatnonzero(~same):  # other characters have the quote's hash; the quote may stand further on
            end = int(hashed.ends[text[k]])
            same[k] = hashed.joined.find(self.short[head[k]], int(hashed.ends[text[k] - 1]) if text[k] else 0, end) >= 0
        return text[same], head[same]

    def longs(self, hashed: _Hashed) -> set[tuple[int, str]]:
        """(number of a text, a part of it that has a quote's length and hash)."""
        text, at, head = self._met(hashed)
        many = self.offsets[head + 1] - self.offsets[head]
        upto, found, first = np.cumsum(many), set(), 0
        while first < len(at):
            last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + MOST_AT_ONCE, "right")))
            n = many[first:last]
            which = np.repeat(np.arange(first, last), n)
            quote = np.repeat(self.offsets[head[first:last]] - np.cumsum(n) + n, n) + np.arange(len(which))
            lengths = self.lengths[quote]
            inside = at[which] + lengths <= hashed.ends[text[which]]
            which, quote, lengths = which[inside], quote[inside], lengths[inside]
            same = hashed.at(at[which], lengths) == self.wholes[quote]
            which, lengths = which[same], lengths[same]
            found.update((t, hashed.joined[p : p + k]) for t, p, k in zip(text[which].tolist(), at[which].tolist(), lengths.tolist(), strict=True))
            first = last
        return found


def tiers_of(rows: pa.Table) -> list[_Tier]:
    """An index of quotes."""
    windows = _windowed(rows["length"].to_numpy())
    return [_Tier(rows.filter(pa.array(windows == t)), int(t)) for t in np.unique(windows)]


def _compiled(key: str, rows: Broadcast) -> list[_Tier]:
    if key not in _LAST:
        _LAST.clear()
        _LAST[key] = tiers_of(rows.value)
    return _LAST[key]


def found_in(texts: list[str], tiers: list[_Tier]) -> Iterator[tuple[int, str]]:
    """(number of a text, a quote that it contains), each pair once; where hashes are shared, other parts of the text as well."""
    for first, some in _batches(texts):
        hashed = _Hashed(some)
        for tier in tiers:
            if tier.short:
                text, quote = tier.shorts(hashed)
                yield from ((first + t, tier.short[q]) for t, q in zip(text.tolist(), quote.tolist(), strict=True))
            else:
                yield from ((first + t, said) for t, said in tier.longs(hashed))


def counted_in(texts: list[str], times: np.ndarray, tiers: list[_Tier], short: dict[int, np.ndarray], long: Counter) -> None:
    """Adds how many texts, each so many times, contain a quote: the short ones to arrays by the length, others to long."""
    for first, some in _batches(texts):
        hashed = _Hashed(some)
        for tier in tiers:
            if tier.short:
                text, quote = tier.shorts(hashed)
                n = np.bincount(quote, times[first + text], len(tier.short)).astype(np.int64)
                short[tier.length] = short[tier.length] + n if tier.length in short else n
            else:
                for t, said in tier.longs(hashed):
                    long[said] += int(times[first + t])


def _asked(quotes: DataFrame, quote_id: str, quote_col: str) -> DataFrame:
    """Ids and quotes, without nulls and quotes of blanks only."""
    return quotes.filter(F.btrim(quote_col, F.lit(" \t\n\r\x0b\x0c")) != "").select(F.col(quote_id).alias("__id"), F.col(quote_col).alias("__quote")).distinct()


def _sent(asked: DataFrame, block_chars: int) -> Iterator[tuple[str, Broadcast]]:
    """What indexes need of the quotes, for each block a name and what is sent to the tasks."""
    spark, different = asked.sparkSession, asked.select("__quote").distinct()
    total = different.agg(F.coalesce(F.sum(F.least(F.length("__quote"), F.lit(SHORT)).cast("long")), F.lit(0))).first()[0]
    n = max(1, -(-total // block_chars))
    path = fresh_folder(spark, "quotes")
    dealt = different.select("__quote", F.pmod(F.xxhash64("__quote"), F.lit(n)).cast("int").alias("block"))
    dealt.mapInArrow(_indexed, f"{INDEXED}, block int").write.partitionBy("block").parquet(path)
    stored = spark.read.schema(f"{INDEXED}, block int").parquet(path)
    for block in range(n):
        rows = stored.filter(F.col("block") == block).drop("block").toArrow()  # some 30 bytes a quote, of a block
        if rows.num_rows:
            yield f"{path}/{block}", spark.sparkContext.broadcast(rows)


def provenance(texts: DataFrame, quotes: DataFrame, id_col: str, text_col: str, quote_id: str, quote_col: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Pairs (id of a text, id of a quote) where the text contains the quote, character by character.

    Different quotes are dealt by a hash to blocks, of about block_chars characters where one longer than SHORT counts as so
    many. The hashes of a block are sent to all tasks and the texts are walked where they are: they aren't shuffled, and every
    text is read once for each block. What is found meets the quotes in a join. Null quotes and quotes of blanks only are found
    nowhere; null texts contain none. Rows that repeat count once.
    """
    asked = _asked(quotes, quote_id, quote_col)
    rows = texts.filter(F.col(text_col).isNotNull()).select(id_col, text_col)
    kind, pairs = texts.schema[id_col].dataType.simpleString(), None
    for key, sent in _sent(asked, block_chars):

        def walk(batches, key=key, sent=sent):
            tiers = _compiled(key, sent)
            for batch in batches:
                for k in range(0, len(batch), ROWS_AT_ONCE):
                    part = batch.slice(k, ROWS_AT_ONCE)
                    found = list(found_in(part.column(1).to_pylist(), tiers))
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array([t for t, _ in found], pa.int64())), pa.array([q for _, q in found], pa.string())], names=[id_col, "__quote"])

        part = rows.mapInArrow(walk, f"`{id_col}` {kind}, __quote string")
        pairs = part if pairs is None else pairs.unionByName(part)
    if pairs is None:
        return texts.select(id_col).limit(0).crossJoin(quotes.select(quote_id).limit(0))
    return pairs.join(asked, "__quote").select(id_col, F.col("__id").alias(quote_id)).distinct()


def containing(texts: DataFrame, quotes: DataFrame, id_col: str, text_col: str, quote_id: str, quote_col: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id of a quote, n): how many texts contain it, where any does; what counting provenance()'s pairs gives.

    Pairs aren't made: equal texts are walked once, and tasks count what they find. Only where ids are null or repeat, the
    pairs are counted, as then texts or quotes of one id count together."""
    unique = lambda rows, c: rows.agg(F.count("*") == F.count_distinct(c)).first()[0]
    named = texts.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__within"), F.col(text_col).alias("__text"))
    if not (unique(named, "__within") and unique(quotes, quote_id)):
        pairs = provenance(named, quotes, "__within", "__text", quote_id, quote_col, block_chars)
        return pairs.groupBy(quote_id).agg(F.count_distinct("__within").alias("n")).filter("n > 0")
    asked = _asked(quotes, quote_id, quote_col)
    rows, counts = named.groupBy("__text").agg(F.count("*").alias("times")), None
    for key, sent in _sent(asked, block_chars):

        def walk(batches, key=key, sent=sent):
            tiers, short, long = _compiled(key, sent), {}, Counter()
            given = lambda n: pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], names=["__quote", "n"])
            for batch in batches:
                counted_in(batch.column(0).to_pylist(), batch.column(1).to_numpy(), tiers, short, long)
                if len(long) > MOST_COUNTED:
                    yield given(long)
                    long.clear()
            yield given(long)
            for tier in tiers:
                if tier.length in short:
                    yield given({q: n for q, n in zip(tier.short, short[tier.length].tolist(), strict=True) if n})

        part = rows.mapInArrow(walk, "__quote string, n long")
        counts = part if counts is None else counts.unionByName(part)
    if counts is None:
        return quotes.select(quote_id, F.lit(0).cast("long").alias("n")).limit(0)
    return counts.groupBy("__quote").agg(F.sum("n").alias("n")).join(asked, "__quote").select(F.col("__id").alias(quote_id), "n")


def provenance_contains(spark, sf_dir):
    """Documents that contain a benchmark item."""
    return provenance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark").withColumnRenamed("text", "quote"), "doc_id", "text", "item_id", "quote")


def provenance_cut(spark, sf_dir):
    """A piece of 1 to 200 characters cut from each document, wherever words end: how many documents contain it."""
    d = table(spark, sf_dir, "documents")
    cut = d.select("doc_id", F.expr("substring(text, cast(doc_id * 7919 % greatest(length(text), 1) + 1 as int), cast(doc_id * 31 % 200 + 1 as int))").alias("quote"))
    return containing(d.select(F.col("doc_id").alias("within"), "text"), cut, "within", "text", "doc_id", "quote").withColumnRenamed("n", "n_documents")


QUERIES = {"provenance_contains": provenance_contains, "provenance_cut": provenance_cut}
ORACLES = {
    "provenance_contains": "SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)",
    "provenance_cut": r"""WITH q AS (SELECT doc_id, substr(text, (doc_id * 7919 % greatest(length(text), 1) + 1)::INT, (doc_id * 31 % 200 + 1)::INT) AS quote FROM documents)
SELECT q.doc_id, count(DISTINCT d.doc_id) AS n_documents FROM q JOIN documents d ON contains(d.text, quote) WHERE regexp_matches(quote, '[^ \t\n\r\x0b\x0c]') GROUP BY q.doc_id""",
}
