"""BPE encoding and decoding with a lexicon of frequent words in a minimal acyclic transducer.

The words of all texts are counted; the most frequent ones (at most max_words, whole groups of like counts) are encoded
once and compiled into a minimal acyclic automaton whose transitions add up to a word's number, which leads to its ids.
The tables, those of the merges included, lie in the shared folder and are memory-mapped by every Python task (on a store
that can't be mapped a task reads them, 10 MB at most), so the tokenizer's file is read by the driver only. A task looks up
the distinct words of a slice of texts in it all at once; words that it lacks are merged exactly by rank. Long texts are
encoded in pieces that end at white space, which no word holds.

Defined cases: a null or empty text has no tokens and decodes to an empty text. Long words are merged with a heap, in
n log n steps. Special tokens in a text are encoded as such. Equal texts get equal rows. Other columns pass through;
where a name clashes, the added column replaces the caller's.
"""

from __future__ import annotations

import hashlib
import heapq
import io
import json
import os
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType, StringType

from tallyspark.llm.common import bounded_batches, fresh_dir, need, plain, table, written

MAX_WORDS = 200_000
#: Longer words are never in the lexicon.
MAX_WORD_BYTES = 64
SLICE_CHARS = 1 << 19
SPACE = re.compile(r"[ \t\r\n]")
#: Different words that a task counts before it hands them on.
FLUSH_WORDS = 50_000
END = "</w>"
#: Longer words are merged one by one with a heap.
LONG_WORD = 48
#: In place of a rank: the pair is never merged.
NONE = 1 << 40

#: The published byte-level alphabet maps printable bytes to themselves and the others to 256 and on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The tokenizer file's pattern for words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: The same for lower-case ASCII texts.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)


def tokenizer_file(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def special_tokens(path: str) -> dict[str, int]:
    return {x["content"]: x["id"] for x in tokenizer_file(path)["added_tokens"]}


def tokens_of(path: str) -> list[str]:
    """Each id's token; as many as the tokenizer file has."""
    known = {**tokenizer_file(path)["model"]["vocab"], **special_tokens(path)}
    out = [""] * (max(known.values()) + 1)
    for token, i in known.items():
        out[i] = token
    return out


def byte_signs() -> list[str]:
    rest = iter(range(256, 512))
    return [chr(b) if b in set(PRINTABLE) else chr(next(rest)) for b in range(256)]


class Merges:
    """Exact merging of one word by the ranks of a tokenizer file; no lexicon. Its parts are arrays."""

    PARTS = ("pairs", "ranks", "made", "first", "last")

    def __init__(self, parts: dict[str, np.ndarray]):
        self.pairs, self.ranks, self.made, self.first, self.last = (parts[x] for x in self.PARTS)

    @classmethod
    def of(cls, path: str) -> Merges:
        said = tokenizer_file(path)["model"]
        vocab, signs, pairs, made = said["vocab"], byte_signs(), [], []
        for pair in said["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            pairs.append(vocab[a] << 32 | vocab[b])
            made.append(vocab[a + b])
        order = np.argsort(np.array(pairs, np.int64))
        first, last = [vocab[s] for s in signs], [vocab[s + END] for s in signs]
        return cls({"pairs": np.array(pairs, np.int64)[order], "ranks": order, "made": np.array(made), "first": np.array(first), "last": np.array(last)})

    def words(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word. Words of like length are merged together, all by one pair a step, the lowest rank and
        among its places the first; so their rows keep a common length."""
        out: list = [None] * len(words)
        groups = defaultdict(list)
        for i, w in enumerate(words):
            groups[len(w)].append(i)
        for n, members in groups.items():
            if n > LONG_WORD:
                for i in members:
                    out[i] = np.array(self._long([*(int(self.first[b]) for b in words[i][:-1]), int(self.last[words[i][-1]])]), np.uint32)
                continue
            at = np.array(members)
            data = np.frombuffer(b"".join([words[i] for i in members]), np.uint8).reshape(len(members), n)
            ids = self.first[data]
            ids[:, -1] = self.last[data[:, -1]]
            ranks = self._ranks(ids[:, :-1], ids[:, 1:])
            while True:
                best = ranks.argmin(1) if ids.shape[1] > 1 else np.zeros(len(at), np.int64)
                rank = ranks[np.arange(len(at)), best] if ids.shape[1] > 1 else np.full(len(at), NONE)
                done = rank == NONE
                for i, row in zip(at[done].tolist(), ids[done].astype(np.uint32), strict=True):
                    out[i] = row
                if done.all():
                    break
                at, ids, ranks, best, rank = at[~done], ids[~done], ranks[~done], best[~done], rank[~done]
                row, cols, spot = np.arange(len(at)), np.arange(ids.shape[1] - 1), best[:, None]
                ids = np.take_along_axis(ids, cols + (cols > spot), 1)
                ids[row, best] = self.made[rank]
                cols = cols[:-1]
                ranks = np.take_along_axis(ranks, cols + (cols >= spot), 1)
                for x in (best - 1, best):
                    r = np.flatnonzero((x >= 0) & (x < ids.shape[1] - 1))
                    ranks[r, x[r]] = self._ranks(ids[r, x[r]], ids[r, x[r] + 1])
        return out

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NONE)

    def _pair(self, a: int, b: int) -> tuple[int, int] | None:
        """(rank, made id) of one pair."""
        at = int(np.searchsorted(self.pairs, a << 32 | b))
        if at == len(self.pairs) or self.pairs[at] != a << 32 | b:
            return None
        return int(self.ranks[at]), int(self.made[self.ranks[at]])

    def _long(self, ids: list[int]) -> list[int]:
        n, pair = len(ids), lru_cache(maxsize=1 << 14)(self._pair)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(got[0], i, ids[i], ids[i + 1], got[1]) for i in range(n - 1) if (got := pair(ids[i], ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] >= 0 and (got := pair(ids[left], ids[after[left]])):
                    heapq.heappush(heap, (got[0], left, ids[left], ids[after[left]], got[1]))
        return [x for x in ids if x >= 0]


def split_words(text: str, special) -> list[str]:
    """The words of a text as the tokenizer file normalises and splits it; special tokens stay whole."""
    if special is not None and "<|" in text and len(parts := special.split(text)) > 1:
        return [w for k, part in enumerate(parts) for w in ([part] if k % 2 else split_words(part, None))]
    if text.isascii():
        return ASCII_WORDS.findall(text.lower())
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return WORDS.findall(text.replace("Σ", "σ").lower())  # each sign by itself: no rule for a word's last sigma


def _special_pattern(special: dict):
    return re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None


def compile_words(words: list[bytes]) -> dict[str, np.ndarray]:
    """The minimal acyclic automaton of sorted distinct words. Along a word's path the numbers `adds` sum to its place."""
    register: dict = {}
    states: list = []

    def freeze(final: bool, edges: list[int]) -> int:
        sign = (final, *edges)
        if (known := register.get(sign)) is None:
            known = register[sign] = len(states)
            states.append(sign)
        return known

    path, last = [[False, []]], b""
    for word in [*words, b""]:
        p = len(os.path.commonprefix((word, last)))
        while len(path) > p + 1:
            final, edges = path.pop()
            path[-1][1].append(last[len(path) - 1] << 32 | freeze(final, edges))
        if word:
            path += [[False, []] for _ in word[p:]]
            path[-1][0], last = True, word
    root = freeze(*path[0])
    below, keys, targets, adds = [], [], [], []
    for s, (final, *edges) in enumerate(states):
        n = int(final)
        for edge in edges:
            keys.append(s << 8 | edge >> 32)
            targets.append(edge & 0xFFFFFFFF)
            adds.append(n)
            n += below[targets[-1]]
        below.append(n)
    return {"keys": np.array(keys, np.int64), "targets": np.array(targets, np.int32), "adds": np.array(adds, np.int32), "finals": np.array([s[0] for s in states], bool), "root": np.array([root], np.int64)}


class Lexicon:
    """A compiled lexicon with the merges for other words, memory-mapped."""

    PARTS = ("keys", "targets", "adds", "finals", "root", "offsets", "ids")

    def __init__(self, directory: str):
        fs, root = pyarrow.fs.FileSystem.from_uri(directory)
        local = isinstance(fs, pyarrow.fs.LocalFileSystem)

        def part(name):
            path = f"{root}/{name}.npy"
            if local:
                return np.asarray(np.load(path, mmap_mode="r"))  # still mapped
            with fs.open_input_stream(path) as f:
                return np.load(io.BytesIO(f.read()))

        self.keys, self.targets, self.adds, self.finals, self.root, self.offsets, self.ids = map(part, self.PARTS)
        self.merges = Merges({x: part(x) for x in Merges.PARTS})

    @staticmethod
    def save(directory: str, words: list[str], merges: Merges) -> None:
        coded = sorted(w.encode() for w in words)
        ids = merges.words(coded)
        parts = compile_words(coded) | {"offsets": np.cumsum([0, *map(len, ids)], dtype=np.int64), "ids": np.concatenate([np.zeros(0, np.uint32), *ids])}
        parts |= {x: getattr(merges, x) for x in Merges.PARTS}
        fs, root = pyarrow.fs.FileSystem.from_uri(directory)
        fs.create_dir(root, recursive=True)
        for name, array in parts.items():
            np.save(out := io.BytesIO(), array)
            with fs.open_output_stream(f"{root}/{name}.npy") as f:
                f.write(out.getvalue())

    def find(self, words: list[bytes]) -> np.ndarray:
        """Each word's place in the lexicon, or -1."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        if not n or not len(self.keys):
            return out
        sizes = np.fromiter(map(len, words), np.int64, n)
        data, starts = np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes
        live = np.flatnonzero((sizes > 0) & (sizes <= MAX_WORD_BYTES))
        state, place = np.full(len(live), self.root[0], np.int64), np.zeros(len(live), np.int64)
        for k in range(MAX_WORD_BYTES):
            done = sizes[live] == k
            end = live[done]
            out[end] = np.where(self.finals[state[done]], place[done], -1)
            live, state, place = live[~done], state[~done], place[~done]
            if not len(live):
                break
            key = state << 8 | data[starts[live] + k]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[at] == key
            live, at, place = live[ok], at[ok], place[ok]
            state, place = self.targets[at].astype(np.int64), place + self.adds[at]
        else:
            out[live] = np.where(self.finals[state], place, -1)
        return out


def encode_slice(texts: list[str], lexicon: Lexicon, special: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row, how many each has)."""
    pattern, numbers, codes, counts = _special_pattern(special), defaultdict(count().__next__), [], []
    for t in texts:
        own = split_words(t, pattern)
        codes.append(np.fromiter(map(numbers.__getitem__, own), np.int64, len(own)))
        counts.append(len(own))
    codes, distinct = np.concatenate([np.zeros(0, np.int64), *codes]), list(numbers)
    places = lexicon.find([w.encode() for w in distinct])
    known = places >= 0
    unseen = [distinct[k] for k in np.flatnonzero(~known)]
    merged = iter(lexicon.merges.words([w.encode() for w in unseen if w not in special]))
    more = [np.array([special[w]], np.uint32) if w in special else next(merged) for w in unseen]
    sizes = np.zeros(len(distinct), np.int64)
    sizes[known] = lexicon.offsets[places[known] + 1] - lexicon.offsets[places[known]]
    sizes[~known] = [len(x) for x in more]
    starts = np.cumsum(sizes) - sizes
    pool = np.zeros(int(sizes.sum()), np.uint32)  # the ids of each distinct word
    pool[_ranges(starts[known], sizes[known])] = lexicon.ids[_ranges(lexicon.offsets[places[known]], sizes[known])]
    pool[_ranges(starts[~known], sizes[~known])] = np.concatenate([np.zeros(0, np.uint32), *more])
    ends = np.concatenate([[0], np.cumsum(sizes[codes])])
    return pool[_ranges(starts[codes], sizes[codes])], np.diff(ends[np.cumsum([0, *counts])])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each range, in a row."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def pieces(text: str) -> Iterator[str]:
    """A long text cut at white space, about every SLICE_CHARS characters."""
    at = 0
    while len(text) - at > SLICE_CHARS and (found := SPACE.search(text, at + SLICE_CHARS)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def _slices(texts: pa.Array) -> Iterator[tuple[list[str], list[int]]]:
    """(pieces of texts, the text of each) of at most about SLICE_CHARS characters."""
    part, owner, size = [], [], 0
    for i, t in enumerate(texts):
        for piece in pieces(t.as_py() or ""):
            part.append(piece)
            owner.append(i)
            size += len(piece)
            if size >= SLICE_CHARS:
                yield part, owner
                part, owner, size = [], [], 0
    if part:
        yield part, owner


def _counter(special):
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for texts, _ in _slices(batch.column(0)):
                for t in texts:
                    seen.update(split_words(t, special))
                if len(seen) >= FLUSH_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["word", "n"])
                    seen.clear()
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["word", "n"])

    return words


def build_lexicon(docs: DataFrame, tokenizer_path: str, text_col="text", max_words: int = MAX_WORDS) -> str:
    """Counts the words of all texts, compiles the frequent ones, and returns the lexicon's folder."""
    need(docs, text_col)
    spark = docs.sparkSession
    bounded_batches(spark)
    special = special_tokens(tokenizer_path)
    counts = docs.select(text_col).mapInArrow(_counter(_special_pattern(special)), "word string, n long")
    counts = counts.groupBy("word").agg(F.sum("n").alias("n")).filter((F.col("n") > 1) & (F.octet_length("word") <= MAX_WORD_BYTES) & ~F.col("word").isin(*special))
    counts = written(counts.select("word", F.floor(F.log2("n") * 8).cast("int").alias("level")), "bpe-words")
    # At most 512 levels: the highest ones that together hold at most max_words words.
    levels, total, least = dict(counts.groupBy("level").count().collect()), 0, 1 << 30
    for level in sorted(levels, reverse=True):
        total += levels[level]
        if total > max_words:
            break
        least = level
    words = [r[0] for r in counts.filter(F.col("level") >= least).select("word").collect()]
    directory = fresh_dir(spark, "bpe-lexicon")
    Lexicon.save(directory, words, Merges.of(tokenizer_path))
    return directory


def encode(docs: DataFrame, lexicon: str, tokenizer_path: str, text_col="text", ids_col="ids") -> DataFrame:
    """docs with the ids of each text."""
    need(docs, text_col)
    docs = plain(docs, ids_col)
    bounded_batches(docs.sparkSession)
    special = special_tokens(tokenizer_path)

    @arrow_udf(ArrayType(IntegerType()))
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Lexicon(lexicon)
        for batch in batches:
            flats, sizes = [np.zeros(0, np.uint32)], np.zeros(len(batch), np.int64)
            for texts, owner in _slices(batch):
                flat, counts = encode_slice(texts, own, special)
                flats.append(flat)
                np.add.at(sizes, owner, counts)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(flats).view(np.int32)))

    return docs.withColumn(ids_col, ids(F.col(text_col)))


def decode(docs: DataFrame, tokenizer_path: str, ids_col="ids", text_col="decoded") -> DataFrame:
    """docs with the decoded text of each row's ids; the tokens joined by blanks, as the tokenizer file has no decoder."""
    need(docs, ids_col)
    docs = plain(docs, text_col)
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(tokens_of(tokenizer_path))

    @arrow_udf(StringType())
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = np.array(sent.value, object)
        for ids in batches:
            yield pa.array([" ".join(tokens[x.values.to_numpy(zero_copy_only=False)].tolist()) if x.is_valid else "" for x in ids], pa.string())

    return docs.withColumn(text_col, text(F.col(ids_col)))


@arrow_udf(StringType())
def _ids_digest(ids: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(x.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()).hexdigest() for x in ids], pa.string())


def op6_bpe(spark, sf_dir):
    """Every text encoded and decoded."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # The ids are a table of their own: a task that encodes and one that decodes each have one Python worker, not three.
    out = written(encode(docs, build_lexicon(docs, path), path).select("doc_id", "ids"), "bpe-ids")
    out = decode(out.withColumn("ids_sha256", _ids_digest("ids")), path)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op6_bpe": op6_bpe}
ORACLES: dict[str, str] = {}
