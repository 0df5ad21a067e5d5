"""Media columns: payloads as 8-bit audio, and audio features.

A payload is stored as a WAV file (PCM, mono, unsigned 8-bit samples at SOURCE_RATE) in a binary column of a written table.
Features are computed from the stored bytes, and the tensors written as Arrow files by the tasks: samples are resampled by a polyphase filter to TARGET_RATE; frames of FRAME
samples that overlap by half give log-mel filterbanks, as 8-bit steps of half a decibel; blocks of BLOCK frames (the
last one padded with its floor) form an Arrow fixed-shape tensor array, each block with its time span; and the frame energies
are segmented with hysteresis (a segment starts above the high level and ends below the low one; levels are set from the
text's own median and spread).

Defined cases: a null payload is an empty one, padded to one unit. Every text is handled whole, in chunks of outputs and of
frames, so memory stays within about six times the text. Equal texts give equal values. Other columns pass through; where a name
clashes, the added column replaces the caller's.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, BinaryType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from tallyspark.llm.common import bounded_batches, fresh_dir, need, plain, table, written

UNIT = 576
SOURCE_RATE, TARGET_RATE = 8000, 6000
UP, DOWN, TAPS = 3, 4, 16
FRAME, HOP, MELS, BLOCK = 256, 128, 24, 32
CHUNK_FRAMES = 2048
#: A multiple of UP * DOWN.
CHUNK_SAMPLES = 12 << 14
SPAN = StructType([StructField("start", FloatType()), StructField("end", FloatType())])
FEATURES = StructType(
    [
        StructField("payload_bytes", LongType()),
        StructField("payload_sha256", StringType()),
        StructField("tail_crc32", LongType()),
        StructField("media_bytes", LongType()),
        StructField("media_sha256", StringType()),
        StructField("shape", ArrayType(IntegerType())),
        StructField("tensors", BinaryType()),
        StructField("spans", ArrayType(SPAN)),
        StructField("segments", ArrayType(SPAN)),
    ]
)


def wav(samples: bytes, rate: int = SOURCE_RATE) -> bytes:
    head = b"fmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8) + b"data" + struct.pack("<I", len(samples))
    body = b"WAVE" + head + samples + b"\0" * (len(samples) % 2)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_wav(data: bytes) -> bytes:
    """The samples of an 8-bit mono WAV file."""
    if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at = 12
    while at + 8 <= len(data):
        kind, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if kind == b"data":
            return data[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("a WAV file without samples")


def _filters() -> np.ndarray:
    """Row p: the taps of the windowed-sinc low-pass for outputs of phase p."""
    t = np.arange(UP * TAPS) - (UP * TAPS - 1) / 2
    cut = 1 / max(UP, DOWN)
    h = np.sinc(t * cut) * np.hanning(UP * TAPS + 2)[1:-1]
    h *= UP / h.sum()
    return np.stack([h[p::UP][::-1] for p in range(UP)]).astype(np.float32)


def resample(x: np.ndarray, filters: np.ndarray) -> np.ndarray:
    """8-bit samples at UP / DOWN times their rate, from -1 to 1: each output is one phase's taps on the inputs before it."""
    n = len(x) * UP // DOWN
    out = np.empty(n, np.float32)
    silence = np.zeros(TAPS - 1, np.float32)
    for at in range(0, n, CHUNK_SAMPLES):  # a multiple of UP
        first, part = at // UP * DOWN, out[at : at + CHUNK_SAMPLES]
        own = x[max(0, first - TAPS + 1) : first + CHUNK_SAMPLES // UP * DOWN].astype(np.float32)
        own = (own - 128) / 128
        windows = np.lib.stride_tricks.sliding_window_view(own if first else np.concatenate([silence, own]), TAPS)
        for k in range(UP):  # outputs k, k + UP, ... share a phase and step DOWN inputs at a time
            part[k::UP] = windows[k * DOWN // UP :: DOWN][: len(part[k::UP])] @ filters[k * DOWN % UP]
    return out


def _mel() -> np.ndarray:
    """(bins, MELS) triangular filters."""
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(40.0), mel(TARGET_RATE / 2), MELS + 2) / 2595) - 1)
    f = np.arange(FRAME // 2 + 1)[:, None] * TARGET_RATE / FRAME
    up, down = (f - edges[:-2]) / (edges[1:-1] - edges[:-2]), (edges[2:] - f) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(up, down)).astype(np.float32)


def hysteresis(energy: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) frames of the segments."""
    middle, spread = np.median(energy), np.std(energy)
    mark = np.where(energy > middle + 0.5 * spread, 1, np.where(energy < middle - 0.25 * spread, 0, -1))
    last = np.maximum.accumulate(np.where(mark >= 0, np.arange(len(mark)), -1))
    on = np.where(last >= 0, mark[np.maximum(last, 0)], 0)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], on, [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def features(samples: bytes, filters: np.ndarray, mel: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(blocks of BLOCK x MELS steps, frame energies in decibels)."""
    y = resample(np.frombuffer(samples, np.uint8), filters)
    # Silence fills the last frame, so that every sample is in one.
    y = np.concatenate([y, np.zeros(FRAME - len(y) if len(y) < FRAME else (FRAME - len(y)) % HOP, np.float32)])
    frames = np.lib.stride_tricks.sliding_window_view(y, FRAME)[::HOP]
    steps, energy = [], []
    for at in range(0, len(frames), CHUNK_FRAMES):
        power = np.abs(np.fft.rfft(frames[at : at + CHUNK_FRAMES] * window, axis=1)) ** 2
        bands = 10 * np.log10(power.astype(np.float32) @ mel + 1e-6)
        steps.append(np.clip(np.rint((bands + 60) * 2), 0, 255).astype(np.uint8))
        energy.append(10 * np.log10(power.sum(1) + 1e-6))
    steps = np.concatenate(steps)
    steps = np.concatenate([steps, np.zeros((-len(steps) % BLOCK, MELS), np.uint8)])
    return steps.reshape(-1, BLOCK, MELS), np.concatenate(energy)


def tensor_array(blocks: np.ndarray) -> pa.Array:
    """Blocks as an Arrow array of fixed-shape tensors."""
    return pa.FixedShapeTensorArray.from_numpy_ndarray(np.ascontiguousarray(blocks), dim_names=["frame", "mel"])


def to_ipc(blocks: np.ndarray) -> bytes:
    array = tensor_array(blocks)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([pa.field("tensor", array.type)])) as out:
        out.write_batch(pa.record_batch([array], ["tensor"]))
    return sink.getvalue().to_pybytes()


def from_ipc(data: bytes) -> np.ndarray:
    return pa.ipc.open_stream(data).read_all()["tensor"].combine_chunks().to_numpy_ndarray()


@arrow_udf(BinaryType())
def _media(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        out = []
        for t in batch:
            data = (t.as_py() or "").encode()
            out.append(wav(data + b"\xff" * (-len(data) % UNIT if data else UNIT)))
        yield pa.array(out, pa.binary())


class _Extractor:
    """What is computed from one stored file."""

    def __init__(self):
        self.given = _filters(), _mel(), np.hanning(FRAME).astype(np.float32)

    def of(self, data: bytes) -> tuple[tuple, np.ndarray, list[dict], list[dict]]:
        """(digests and lengths, blocks, their time spans, segments)."""
        second = np.float32(HOP / TARGET_RATE)
        samples = read_wav(data)
        blocks, energy = features(samples, *self.given)
        spans = [{"start": k * BLOCK * second, "end": (min((k + 1) * BLOCK, len(energy)) + 1) * second} for k in range(len(blocks))]
        segments = [{"start": a * second, "end": (b + 1) * second} for a, b in hysteresis(energy)]
        return (len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-32:]), len(data), hashlib.sha256(data).hexdigest()), blocks, spans, segments


SPANS = pa.list_(pa.struct([("start", pa.float32()), ("end", pa.float32())]))
DIGESTS = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]


def _columns(rows: list[tuple], kinds: list[pa.DataType]) -> list[pa.Array]:
    return [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * len(kinds), kinds, strict=True)]


@arrow_udf(FEATURES)
def _features(media: Iterator[pa.Array]) -> Iterator[pa.Array]:
    own = _Extractor()
    for batch in media:
        rows = [(*said, list(blocks.shape), to_ipc(blocks), spans, segments) for said, blocks, spans, segments in map(own.of, (m.as_py() for m in batch))]
        yield pa.StructArray.from_arrays(_columns(rows, [*DIGESTS, pa.list_(pa.int32()), pa.binary(), SPANS, SPANS]), FEATURES.names)


def _tensor_writer(directory: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(directory)
        task, own, out = TaskContext.get(), _Extractor(), None
        draft = f"{root}/_{task.taskAttemptId()}.tmp"
        for batch in batches:
            rows = []
            for id_, n, m in zip(*(batch.column(i) for i in range(3)), strict=True):
                said, blocks, spans, segments = own.of(m.as_py())
                parts = [pa.array([id_.as_py()] * len(blocks), id_.type), pa.array(range(len(blocks)), pa.int32()), *_columns([(x["start"], x["end"]) for x in spans], [pa.float32()] * 2), tensor_array(blocks)]
                given = pa.RecordBatch.from_arrays(parts, ["id", "block", "start", "end", "tensor"])
                if out is None:
                    sink = fs.open_output_stream(draft)
                    out = pa.ipc.new_file(sink, given.schema, options=pa.ipc.IpcWriteOptions(compression="zstd"))
                out.write_batch(given)
                rows.append((id_.as_py(), n.as_py(), *said, list(blocks.shape), hashlib.sha256(blocks.tobytes()).hexdigest(), spans, segments))
            kinds = [batch.schema.field(0).type, pa.int64(), *DIGESTS, pa.list_(pa.int32()), pa.string(), SPANS, SPANS]
            yield pa.RecordBatch.from_arrays(_columns(rows, kinds), ["id", "n_bytes", *FEATURES.names[:5], "shape", "tensors_sha256", "spans", "segments"])
        if out is not None:
            out.close()
            sink.close()
            fs.move(draft, f"{root}/part-{task.partitionId():05d}.arrow")

    return write


def store(docs: DataFrame, text_col="text", name: str = "audio") -> DataFrame:
    """docs with the payload of each text stored as media, written and reread."""
    need(docs, text_col)
    docs = plain(docs, "media", "n_bytes")
    bounded_batches(docs.sparkSession)
    media = docs.withColumn("n_bytes", F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")).withColumn("media", _media(F.col(text_col)))
    return written(media.drop(text_col), name, compression="zstd")


def audio_features(stored: DataFrame) -> DataFrame:
    """stored with the columns of FEATURES: payload and media digests, tensors as an Arrow stream, spans and segments."""
    need(stored, "media")
    stored = plain(stored, *FEATURES.names)
    bounded_batches(stored.sparkSession)
    out = stored.withColumn("__f", _features(F.col("media")))
    return out.withColumns({c: F.col(f"__f.{c}") for c in FEATURES.names}).drop("__f")


def write_tensors(stored: DataFrame, directory: str, id_col="doc_id") -> DataFrame:
    """Writes every block as a row of Arrow files in the shared folder: id, block, start, end, and a fixed-shape tensor.

    Returns the written rows of digests, shapes, spans and segments. A task names its file by its partition and renames it
    when it is complete, so a repeated task replaces what a lost one left behind.
    """
    need(stored, id_col, "n_bytes", "media")
    bounded_batches(stored.sparkSession)
    fs, root = pyarrow.fs.FileSystem.from_uri(directory)
    fs.create_dir(root, recursive=True)
    kind = stored.schema[id_col].dataType.simpleString()
    times = "array<struct<start:float,end:float>>"
    schema = f"id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, shape array<int>, tensors_sha256 string, spans {times}, segments {times}"
    rows = stored.select(F.col(id_col).alias("id"), "n_bytes", "media").mapInArrow(_tensor_writer(directory), schema)
    return written(rows, "audio-features").withColumnRenamed("id", id_col)


def op7_audio(spark, sf_dir):
    """Every text as audio, stored, read back, its features stored as tensors, and their digest."""
    stored = store(table(spark, sf_dir, "documents").select("doc_id", "text"))
    out = write_tensors(stored, fresh_dir(spark, "audio-tensors"))
    times = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws("-", x["start"].cast("decimal(12,3)"), x["end"].cast("decimal(12,3)"))), ",")
    feature = F.concat_ws(":", F.array_join("shape", "x"), "tensors_sha256", F.size("segments"), F.md5(times("segments")), F.md5(times("spans")))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))


QUERIES = {"op7_audio": op7_audio}
ORACLES: dict[str, str] = {}
