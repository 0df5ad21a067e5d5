"""Quality rules by cross-document line frequency.

Each normalised line (A-Z lowered, digit runs as 0, white space as one blank, trimmed; empty ones don't count) is hashed,
and the distinct documents that hold it are counted for each host. Lines held by more than max_docs documents of a host
are removed there; a document that keeps under min_kept_share of its words is rejected as depleted.

Distinct documents are distinct ids, so the lines of a group of more than max_docs copies are common there. Where copies are
another operator's work, count_copies=False counts distinct texts instead, so that a group doesn't deplete its last member.

Defined cases: a null text is an empty one; rows without an id are told apart by their texts; null hosts form one host; a document without words is not depleted (base rules
judge it). Rows that repeat a document get its verdict each. Only the named columns are read; the
caller's other columns pass through, and where a name clashes, the added column replaces the caller's.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType, StructField, StructType

from tallyspark.llm.common import bounded_batches, checked_join, need, plain, table, written

MAX_DOCS = 20
MIN_KEPT_SHARE = 0.5
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
BASE = StructType([StructField(c, LongType()) for c in COUNTS])
#: Texts are handled in slices of about so many characters.
SLICE_CHARS = 2_000_000
WINDOW = 5
BREAK = re.compile(rb"[ \t\n\x0b\x0c\r]")


def _covered(code: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each text (ends: where its words end among the word numbers), the words in 5-word windows that its text has twice or more."""
    n = len(code)
    if n < WINDOW:
        return np.zeros(len(ends), np.int64)
    doc = np.repeat(np.arange(len(ends), dtype=np.uint64), np.diff(ends, prepend=0))
    with np.errstate(over="ignore"):
        h = doc[: n - WINDOW + 1] * np.uint64(0x9E3779B97F4A7C15)
        for k in range(WINDOW):
            h = (h ^ (code[k : n - WINDOW + 1 + k] * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
    whole = np.flatnonzero(doc[: n - WINDOW + 1] == doc[WINDOW - 1 :])
    h = h[whole]
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    starts = np.zeros(n, bool)
    starts[whole[order[1:][same]]] = True
    starts[whole[order[:-1][same]]] = True
    inside = starts.copy()
    for k in range(1, WINDOW):
        inside[k:] |= starts[:-k]
    return np.bincount(doc[inside].astype(np.int64), minlength=len(ends))


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in pieces of about SLICE_CHARS bytes."""
    at = 0
    while at < len(text):
        end = next((m.start() for m in BREAK.finditer(text, at + SLICE_CHARS)), len(text))
        yield text[at:end].split()
        at = end


def base_stats(texts: list[str]) -> list[tuple]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of each text."""
    ids: defaultdict = defaultdict(count().__next__)
    codes, counts, rest = [np.zeros(0, np.uint64)], [], []
    for t in texts:
        n = 0
        for own in _words(t.encode()):
            codes.append(np.fromiter(map(ids.__getitem__, own), np.uint64, len(own)))
            n += len(own)
        counts.append(n)
        lines = [x for x in t.split("\n") if x.strip(SPACE)]
        rest.append((len(t) - sum(map(t.count, SPACE)) if n else 0, sum(map(t.count, SYMBOLS)), len(lines) - len(set(lines))))
    repeat = _covered(np.concatenate(codes), np.cumsum(counts)) if texts else []
    return [(n, *r, int(k)) for n, r, k in zip(counts, rest, repeat, strict=True)]


@arrow_udf(BASE)
def _base_udf(texts: pa.Array) -> pa.Array:
    out, part, size = [], [], 0
    for t in texts:
        part.append(t.as_py() or "")
        size += len(part[-1])
        if size >= SLICE_CHARS:
            out += base_stats(part)
            part, size = [], 0
    out += base_stats(part)
    columns = list(zip(*out, strict=True)) or [()] * 5
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], COUNTS)


def normal_line(line: Column) -> Column:
    lower = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.btrim(F.regexp_replace(F.regexp_replace(lower, "[0-9]+", "0"), r"[\x20\x09-\x0D]+", " "))


def _lines(docs: DataFrame) -> DataFrame:
    """(host, id, text hash, place, line hash, words) of each line with a word of each document."""
    lines = F.transform(F.split("text", "\n", -1), normal_line)
    parts = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("line"), F.when(x == "", 0).otherwise(F.length(x) - F.length(F.translate(x, " ", "")) + 1).alias("words")))
    out = docs.select("host", "id", "text_hash", F.posexplode(parts).alias("place", "p"))
    return out.select("host", "id", "text_hash", "place", "p.line", "p.words").filter("words > 0")


def filter_lines(docs: DataFrame, id_col="doc_id", text_col="text", host_col="source", max_docs: int = MAX_DOCS, min_kept_share: float = MIN_KEPT_SHARE, count_copies: bool = True) -> DataFrame:
    """docs with base counts, base_failed, kept, removed_words, clean_text (the lines that stay) and kept_share."""
    need(docs, id_col, text_col, host_col)
    docs = plain(docs, *COUNTS, "base_failed", "kept", "removed_words", "kept_share", "clean_text")
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    host = F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit("-"))
    keys = [host.alias("host"), F.coalesce(F.col(id_col).cast("string"), F.lit("-")).alias("id"), F.xxhash64(text).alias("text_hash")]
    lines = _lines(docs.select(*keys, text.alias("text")))
    document = F.when(F.lit(count_copies) & (F.col("id") != "-"), F.xxhash64("id")).otherwise(F.col("text_hash"))
    common = lines.groupBy("host", "line").agg(F.count_distinct(document).alias("docs")).filter(F.col("docs") > max_docs)
    common = written(common.select("host", "line"), "common-lines")
    hit = checked_join(lines, common, ["host", "line"], "inner", spread="text_hash")
    # A line counts at each of its places, but once where rows repeat a document.
    hit = hit.dropDuplicates(["id", "host", "text_hash", "place"]).groupBy("id", "host", "text_hash")
    hit = written(hit.agg(F.collect_set("line").alias("lines"), F.sum("words").alias("words")), "hit-documents")
    names = {"id": "__id", "host": "__host", "text_hash": "__text_hash"}
    base = docs.withColumns({"__base": _base_udf(F.col(text_col))} | {f"__{n}": c for n, c in zip(("host", "id", "text_hash"), keys, strict=True)})
    renamed = hit.withColumnsRenamed(names | {"lines": "__lines", "words": "__words"})
    out = checked_join(base, renamed, list(names.values()), "left", spread="__id", limit=20_000, size=F.size("__lines") * 8)
    n, repeat = F.col("__base.n_words"), F.col("__base.n_repeat_words")
    failed = (n < 10) | (100 * repeat > 20 * n)
    stays = F.filter(F.split(text, "\n", -1), lambda x: ~F.array_contains("__lines", F.xxhash64(normal_line(x))))
    clean = F.when(F.col("__lines").isNull(), text).otherwise(F.array_join(stays, "\n"))
    removed = F.coalesce("__words", F.lit(0).cast("long"))
    share = F.when(n == 0, F.lit(1.0)).otherwise((n - F.col("removed_words")) / n)
    out = out.withColumns({c: F.col(f"__base.{c}") for c in COUNTS})
    out = out.withColumn("clean_text", clean).withColumn("removed_words", removed).withColumn("kept_share", share)
    out = out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("kept_share") >= min_kept_share))
    return out.drop("__base", "__lines", "__words", *names.values())


def op2_line_frequency(spark, sf_dir):
    """Every document judged by base rules and by the lines that it shares with others of its source."""
    out = filter_lines(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", *COUNTS, "base_failed", "kept", "removed_words")


OP2_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, source, row_number() OVER () AS r FROM documents),
b AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, string_split(text, chr(10)) AS l FROM d),
nl AS (SELECT r, doc_id, source, text, unnest(l) AS raw FROM b),
n AS (SELECT r, doc_id, source, text, raw, trim(regexp_replace(regexp_replace(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS line FROM nl),
common AS (SELECT source, line FROM n WHERE line <> '' GROUP BY source, line HAVING count(DISTINCT coalesce('=' || doc_id, text)) > {MAX_DOCS}),
gone AS (SELECT r, sum(len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+'))) AS gone FROM n WHERE EXISTS (SELECT 1 FROM common c WHERE c.source IS NOT DISTINCT FROM n.source AND c.line = n.line) GROUP BY r),
dup AS (SELECT r, (count(*) - count(DISTINCT raw))::BIGINT AS k FROM nl WHERE regexp_matches(raw, '[^\x20\x09-\x0D]') GROUP BY r),
p AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM b WHERE len(w) >= 5),
g AS (SELECT r, array_to_string(w[i:i+4], ' ') AS win, list(i) AS starts FROM p GROUP BY r, win HAVING count(*) > 1),
c AS (SELECT r, count(DISTINCT first + k)::BIGINT AS k FROM (SELECT r, unnest(starts) AS first FROM g), (SELECT unnest(range(0, 5)) AS k) GROUP BY r),
s AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  coalesce(dup.k, 0) AS n_dup_lines, coalesce(c.k, 0) AS n_repeat_words, coalesce(gone, 0)::BIGINT AS removed_words
  FROM b LEFT JOIN dup USING (r) LEFT JOIN c USING (r) LEFT JOIN gone USING (r))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND (n_words - removed_words) / n_words >= {MIN_KEPT_SHARE} AS kept FROM s
"""

QUERIES = {"op2_line_frequency": op2_line_frequency}
ORACLES = {"op2_line_frequency": OP2_SQL}
