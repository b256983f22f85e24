"""Audio features: a lossless 8-bit WAV, polyphase resampling, log-mel, hysteresis segments.

Each payload is written as a mono WAV of unsigned 8-bit samples, the stored bytes
are read back, and features are computed from what was read. The log-mel frames
are cut into fixed-shape patches and stored as an Arrow IPC stream whose column
``mel`` is a fixed-shape tensor, beside the start and end of each patch in seconds.
Segments open where the frame energy reaches the high mark and last while it stays
at or above the low mark.

Work is one pass without a shuffle; every document is handled alone, in blocks of
frames, so equal payloads give equal values and memory is bounded by one document.

Defined results: a null or empty text is 192 spaces; repeated rows repeat; an empty
table gives an empty result; columns besides the key and the text are not read.
"""

from __future__ import annotations

import functools
import hashlib
import io
import math
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

UNIT = 192
RATE, UP, DOWN = 8000, 3, 4
FRAME, HOP, MELS, PATCH = 256, 128, 32, 32
TAPS = 16  # for each phase
HIGH_DB, LOW_DB = 3.0, 1.0  # above the median frame energy
BLOCK = 8192  # frames at a time


def payload(text: str | None) -> bytes:
    """UTF-8 bytes, then spaces up to a positive multiple of 192."""
    raw = (text or "").encode()
    return raw.ljust(max(UNIT, -(-len(raw) // UNIT) * UNIT))


def to_wav(samples: bytes, rate: int = RATE) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(samples)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


@functools.cache
def _phases(up: int, down: int) -> np.ndarray:
    """A windowed-sinc low-pass, dealt to its phases: phase p holds taps p, p+up, ..."""
    n = TAPS * up
    t = np.arange(n) - (n - 1) / 2
    cut = 1 / max(up, down)
    h = np.sinc(t * cut) * np.hamming(n)
    h *= up / h.sum()
    return h.reshape(TAPS, up).T.astype(np.float32)[:, ::-1].copy()


def resample(x: np.ndarray, up: int = UP, down: int = DOWN) -> np.ndarray:
    """Polyphase: only the taps that meet a real sample, only the kept outputs."""
    h = _phases(up, down)
    n_out = -(-len(x) * up // down)
    padded = np.concatenate([np.zeros(TAPS - 1, np.float32), x, np.zeros(down, np.float32)])
    view = np.lib.stride_tricks.sliding_window_view(padded, TAPS)
    y = np.empty(n_out, np.float32)
    for r in range(up):  # outputs r, r+up, ... share one phase
        k = len(range(r, n_out, up))
        if k:
            first = r * down // up
            y[r::up] = view[first : first + (k - 1) * down + 1 : down] @ h[r * down % up]
    return y


@functools.cache
def _mel_bank() -> np.ndarray:
    rate = RATE * UP / DOWN
    mel = lambda f: 2595 * math.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(20), mel(rate / 2), MELS + 2) / 2595) - 1)
    freq = np.fft.rfftfreq(FRAME, 1 / rate)[:, None]
    rise = (freq - edges[:-2]) / (edges[1:-1] - edges[:-2])
    fall = (edges[2:] - freq) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(rise, fall)).astype(np.float32)


_WINDOW = np.hanning(FRAME).astype(np.float32)


def log_mel(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapped frames -> (frames x MELS log energies, frame energy in dB)."""
    if len(y) < FRAME:
        y = np.pad(y, (0, FRAME - len(y)))
    frames = np.lib.stride_tricks.sliding_window_view(y, FRAME)[::HOP]
    mels, energy = [], []
    for i in range(0, len(frames), BLOCK):
        f = frames[i : i + BLOCK]
        power = np.abs(np.fft.rfft(f * _WINDOW, axis=1)).astype(np.float32) ** 2
        mels.append(np.log(power @ _mel_bank() + 1e-6))
        energy.append(10 * np.log10(np.einsum("ij,ij->i", f, f) / FRAME + 1e-9))
    return np.concatenate(mels), np.concatenate(energy)


def segments(energy: np.ndarray) -> np.ndarray:
    """Runs at or above the low mark that reach the high mark: rows of (first, past last) frame."""
    mid = float(np.median(energy))
    low = np.concatenate([[False], energy >= mid + LOW_DB, [False]])
    edge = np.flatnonzero(low[1:] != low[:-1]).reshape(-1, 2)
    high = np.concatenate([[0], np.cumsum(energy >= mid + HIGH_DB)])
    return edge[high[edge[:, 1]] > high[edge[:, 0]]]


TENSOR = pa.fixed_shape_tensor(pa.float32(), (PATCH, MELS))


def tensors(mel: np.ndarray) -> bytes:
    """Arrow IPC stream of the patches as fixed-shape tensors with time spans; the last is padded with the floor."""
    n = -(-len(mel) // PATCH)
    full = np.full((n * PATCH, MELS), math.log(1e-6), np.float32)
    full[: len(mel)] = mel
    step = HOP * DOWN / (RATE * UP)
    start = np.arange(n) * PATCH * step
    end = np.minimum(start + PATCH * step, len(mel) * step)
    flat = pa.FixedSizeListArray.from_arrays(pa.array(full.ravel()), PATCH * MELS)
    batch = pa.record_batch(
        [pa.ExtensionArray.from_storage(TENSOR, flat), pa.array(start), pa.array(end)], ["mel", "start_s", "end_s"]
    )
    out = io.BytesIO()
    with pa.ipc.new_stream(out, batch.schema) as w:
        w.write_batch(batch)
    return out.getvalue()


def read_tensors(stored: bytes) -> pa.RecordBatch:
    return next(iter(pa.ipc.open_stream(stored)))


def patches(stored: bytes) -> np.ndarray:
    """The stored tensors as an array (patches, PATCH, MELS)."""
    return read_tensors(stored).column(0).to_numpy_ndarray()


SCHEMA = (
    "n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, "
    "media_sha256 string, feature string, spans array<struct<start_s:double,end_s:double>>, media binary, tensors binary"
)
_SPANS = pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())]))


def _one(text: str | None, keep: bool) -> dict:
    sent = payload(text)
    media = to_wav(sent)
    back = from_wav(media)
    x = (np.frombuffer(back, np.uint8).astype(np.float32) - 128) / 128
    mel, energy = log_mel(resample(x))
    runs = segments(energy)
    stored = tensors(mel)
    step = HOP * DOWN / (RATE * UP)
    kept = patches(stored).reshape(-1, MELS)[: len(mel)]  # the features come from what is stored
    head = kept.mean(axis=0)[:: MELS // 4]
    return {
        "n_bytes": len((text or "").encode()), "payload_bytes": len(back),
        "payload_sha256": hashlib.sha256(back).hexdigest(), "tail_crc32": zlib.crc32(back[-16:]),
        "media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest(),
        "feature": f"frames={len(mel)};segments={len(runs)};active={int((runs[:, 1] - runs[:, 0]).sum())};"
        f"energy={energy.mean():.2f};mel={','.join(f'{v:.2f}' for v in head)}",
        "spans": [{"start_s": a * step, "end_s": b * step} for a, b in runs.tolist()],
        "media": media if keep else None, "tensors": stored,
    }


def audio_features(docs: DataFrame, key: str = "doc_id", text_col: str = "text", keep_media: bool = True) -> DataFrame:
    """key + SCHEMA for each row. keep_media=False leaves the WAV out of the result, which 44 bytes and the text make again."""
    kind = docs.schema[key].dataType

    def work(batches):
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            done, rows, size = 0, [], 0
            for i, text in enumerate(texts):
                rows.append(_one(text.as_py(), keep_media))
                size += len(rows[-1]["tensors"]) + rows[-1]["payload_bytes"] + 1000
                if size > 4_000_000 or i == len(texts) - 1:
                    own = pa.Table.from_pylist(rows, schema).select(schema.names)
                    cols = [keys.slice(done, len(rows)), *(c.combine_chunks() for c in own.columns)]
                    yield pa.RecordBatch.from_arrays(cols, [key, *schema.names])
                    done, rows, size = i + 1, [], 0

    long, text = pa.int64(), pa.string()
    schema = pa.schema([
        ("n_bytes", long), ("payload_bytes", long), ("payload_sha256", text), ("tail_crc32", long),
        ("media_bytes", long), ("media_sha256", text), ("feature", text), ("spans", _SPANS),
        ("media", pa.binary()), ("tensors", pa.binary()),
    ])
    picked = docs.select(F.col(f"`{key}`"), F.col(f"`{text_col}`").cast("string"))
    return picked.mapInArrow(work, f"`{key}` {kind.simpleString()}, {SCHEMA}")


def op10_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return audio_features(docs, keep_media=False).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature",
        F.size("spans").cast("bigint").alias("n_spans"), "spans", "tensors",
    )
