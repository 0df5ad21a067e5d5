"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints within `radius` 3 differ in at most three bits. Half of that is one bit and a half: every fingerprint emits,
for each of three blocks of its bits, the variants in which that block is erased and at most one other bit is flipped
(132 keys). Two fingerprints within three bits always meet: some block holds one of the three differing bits (or all),
erasing it leaves at most two (or none), and one flip from either side bridges those. Flipping two bits from one side
would need 2,081 keys instead. Keys are shuffled and sorted; within a run of equal keys the fingerprints are verified, and
links are given as a star to the smallest member of each linked set, so a large run doesn't give all its pairs. In runs of
many fingerprints the links are found with a sorted list of all variants, without comparing all pairs. A run is one task's
work: only different fingerprints of one erased block are in it, copies are none.

Exact copies meet in one fingerprint before anything is emitted. Components come from alternating large-star and small-star
steps on the links between different fingerprints, each step a written table. Nodes with many links are joined by broadcast.

Defined cases: a null or empty text, or one without words, has fingerprint 0, linked like any other. Null ids are allowed;
component_id is null only where no member has an id. Rows that repeat get equal results. Empty tables give empty results.
Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from tallyspark.llm.common import HOT_ROWS, bounded_batches, need, skew_join, table, written

RADIUS = 3
SHINGLE = 3
SEED = 42
#: The first bits of the three blocks, and the end.
BLOCKS = (0, 21, 42, 64)
#: Runs with more fingerprints are linked through a sorted list of variants.
LONG_RUN = 512
CHUNK = 1 << 16


def fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(SHINGLE, len(words))
    joined, end, ends = b" ".join(words), -1, []
    for w in words:
        end += len(w) + 1
        ends.append(end)
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    n, ones = len(words) - k + 1, np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at : min(at + CHUNK, n)], ends[at + k - 1 :], strict=False)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


@arrow_udf(LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array(np.array([fingerprint(t.as_py()) for t in texts], np.uint64).view(np.int64))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def variants() -> list[tuple[int, int]]:
    """(bits that are kept, bit that is flipped or 0) of each key."""
    out = []
    for a, b in zip(BLOCKS[:-1], BLOCKS[1:], strict=True):
        kept = (1 << 64) - 1 - ((1 << b) - (1 << a))
        out += [(_signed(kept), 0), *((_signed(kept), _signed(1 << i)) for i in range(64) if not a <= i < b)]
    return out


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each member's component, from links a-b between 0..n-1."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def link_set(fps: np.ndarray) -> np.ndarray:
    """The root of each of the distinct sorted fingerprints, as places, where those within RADIUS bits are linked."""
    n = len(fps)
    if n <= LONG_RUN:
        a, b = np.nonzero(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= RADIUS, 1))
        return _roots(n, a, b)
    flips = np.concatenate([[0], 1 << np.arange(64, dtype=np.uint64)]).astype(np.uint64)
    near = (fps[:, None] ^ flips[None, :]).ravel()
    order = np.argsort(near, kind="stable")
    near, owner = near[order], order // len(flips)
    same = np.flatnonzero(near[1:] == near[:-1])
    links = [np.stack([owner[same], owner[same + 1]])]  # those that share a variant are two bits apart at most
    for i in range(65):
        for j in range(i + 1, 65):  # two flips from one side meet one flip from the other
            want = fps ^ flips[i] ^ flips[j]
            at = np.minimum(np.searchsorted(near, want), len(near) - 1)
            hit = np.flatnonzero(near[at] == want)
            links.append(np.stack([hit, owner[at[hit]]]))
        if i % 8 == 7:  # what is linked already needs no more room
            root = _roots(n, *np.concatenate(links, axis=1))
            links = [np.stack([np.arange(n), root])]
    return _roots(n, *np.concatenate(links, axis=1))


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from rows (key, fp) in the order of keys; a run may span batches."""
    rest: list[tuple[np.ndarray, np.ndarray]] = []  # parts of the run that isn't over, joined only when it is

    def links(key, fp):
        bounds = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        start, size = bounds[:-1], np.diff(bounds)
        two = start[size == 2]
        a, b = np.minimum(fp[two], fp[two + 1]), np.maximum(fp[two], fp[two + 1])
        ok = (np.bitwise_count(a ^ b) <= RADIUS) & (a != b)
        found = [np.stack([a[ok], b[ok]])]
        for s, n in zip(start[size > 2], size[size > 2], strict=True):
            own = np.unique(fp[s : s + n])
            root = link_set(own)
            other = np.flatnonzero(root != np.arange(len(own)))
            found.append(np.stack([own[root[other]], own[other]]))
        out = np.unique(np.concatenate(found, axis=1), axis=1).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1])], ["a", "b"])

    for batch in batches:
        key, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        if not len(key):
            continue
        if rest and rest[0][0][0] != key[-1]:
            cut = int(np.searchsorted(key, key[-1]))
            yield links(np.concatenate([*(k for k, _ in rest), key[:cut]]), np.concatenate([*(f for _, f in rest), fp[:cut]]))
            rest, key, fp = [], key[cut:], fp[cut:]
        elif not rest and (cut := int(np.searchsorted(key, key[-1]))):
            yield links(key[:cut], fp[:cut])
            key, fp = key[cut:], fp[cut:]
        rest.append((key, fp))
    if rest:
        yield links(np.concatenate([k for k, _ in rest]), np.concatenate([f for _, f in rest]))


def find_links(fps: DataFrame) -> DataFrame:
    """(a, b): links between the distinct fingerprints in the column fp that connect all within RADIUS bits."""
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(kept)).bitwiseXOR(F.lit(flip)) for kept, flip in variants()])
    rows = fps.select(F.explode(keys).alias("key"), "fp").repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(_link, "a long, b long").distinct()


def components(links: DataFrame) -> tuple[DataFrame, int]:
    """(node, root) of every node with a link, root its component's smallest node; and the largest number of one root's nodes."""

    def stars(edges: DataFrame, large: bool, most: int) -> DataFrame:
        """Each node's neighbours (the larger ones, or the smaller ones with the node) are linked to the smallest of all."""
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        if most >= HOT_ROWS:
            low = written(low, "simhash-low")
            joined = skew_join(both, low, "u", "n", *low.agg(F.sum("n"), F.max("n")).first())
        else:
            joined = both.join(low, "u")
        out = joined.filter("v > u" if large else "v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
        if not large:
            out = out.unionByName(low.select(F.col("m").alias("a"), F.col("u").alias("b")))
        return out.filter("a <> b").distinct()

    state, most = None, 0
    while True:
        # How many links a node has bounds what one key brings to the next joins.
        at = links.groupBy("a").agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31))).alias("h"))
        new = at.agg(F.sum("n"), F.sum("h"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
        if new == state:
            break
        state, most = new, new["most"]
        links = written(stars(stars(links, True, most), False, most), "simhash-stars")
    return links.select(F.col("b").alias("node"), F.col("a").alias("root")), most


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, fp, component_id) of each row: its fingerprint as a long, and the smallest id in its component."""
    need(docs, id_col, text_col)
    bounded_batches(docs.sparkSession)
    rows = written(docs.select(F.col(id_col).alias("id"), _fingerprints(F.col(text_col)).alias("fp")), "simhash-rows")
    fps = written(rows.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("n")), "simhash-fps")
    total, copies = fps.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    parts, most = components(written(find_links(fps), "simhash-links"))
    roots = fps.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "n", "first", F.coalesce("root", "fp").alias("root"))
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("fps"))
    if most >= HOT_ROWS:
        roots, least = written(roots, "simhash-roots"), written(least, "simhash-least")
        named = skew_join(roots, least, "root", "fps", *least.agg(F.sum("fps"), F.max("fps")).first())
    else:
        named = roots.join(least, "root")
    named = written(named.select("fp", "n", "component_id"), "simhash-components")
    return skew_join(rows, named, "fp", "n", total, copies).select(F.col("id").alias(id_col), "fp", "component_id")


def op5_simhash(spark, sf_dir):
    """Every document's fingerprint and component."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op5_simhash": op5_simhash}
ORACLES: dict[str, str] = {}
