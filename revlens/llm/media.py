"""Media columns: lossless 8-bit audio in a binary column, and its features as fixed-shape Arrow tensors.

* ``encode_wav`` stores payload bytes as the samples of an unsigned 8-bit mono PCM file;
* ``audio_features`` reads the stored bytes back, resamples them with a polyphase filter, takes overlapped log-mel
  filterbanks and finds active segments by an energy threshold with hysteresis. Per document it gives fixed-shape tensors
  of ``TENSOR_FRAMES`` x ``MELS`` (an Arrow IPC stream with a ``fixed_shape_tensor`` column) and their time spans.

Samples are read in blocks; what is held of a document are its frames, a third of the bytes of its text, and its tensors.
All is computed in double precision and log-mel values are rounded to a tenth of a decibel, so that equal audio has equal
features whatever the processor.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blank

UNIT = 192
RATE, TARGET_RATE = 12_000, 8_000
UP, DOWN = 2, 3
TAPS = 12
FRAME, HOP, MELS = 256, 128, 16
TENSOR_FRAMES = 32
#: Hysteresis in decibels below the loudest frame's energy: a segment opens above the first and closes below the second.
OPEN_DB, CLOSE_DB = -12.0, -18.0
BLOCK = 3 * 128 * 512
HEADER = 44


def wav_header(n: int) -> bytes:
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + n, b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", n)


def wav_samples(stored: bytes) -> memoryview:
    """The sample bytes of a stored file, found by walking its chunks."""
    view = memoryview(stored)
    if view[:4] != b"RIFF" or view[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE file")
    at = 12
    while at + 8 <= len(view):
        kind, n = struct.unpack_from("<4sI", view, at)
        if kind == b"data":
            return view[at + 8 : at + 8 + n]
        at += 8 + n + n % 2
    raise ValueError("no data chunk")


@lru_cache(maxsize=1)
def filters() -> np.ndarray:
    """Polyphase bank of a windowed-sinc low-pass filter: one column of TAPS coefficients per output phase."""
    n = UP * TAPS
    t = np.arange(n) - (n - 1) / 2
    h = np.sinc(t / max(UP, DOWN)) * np.hamming(n)
    bank = np.stack([h[p::UP][::-1] for p in range(UP)], 1)
    return bank / bank.sum(0)


@lru_cache(maxsize=1)
def mel_weights() -> tuple[np.ndarray, np.ndarray]:
    """Hann window, and triangular mel filters over the power spectrum."""
    mel = np.linspace(0, 2595 * np.log10(1 + TARGET_RATE / 2 / 700), MELS + 2)
    edge = 700 * (10 ** (mel / 2595) - 1)
    f = np.linspace(0, TARGET_RATE / 2, FRAME // 2 + 1)[:, None]
    up, down = (f - edge[:-2]) / (edge[1:-1] - edge[:-2]), (edge[2:] - f) / (edge[2:] - edge[1:-1])
    weights = np.maximum(0, np.minimum(up, down)) + 1e-6
    return np.hanning(FRAME), weights


def resample(samples: np.ndarray) -> np.ndarray:
    """UP/DOWN of a block that starts with TAPS samples of context; every DOWN inputs give UP outputs."""
    windows = np.lib.stride_tricks.sliding_window_view(samples, TAPS)
    bank = filters()
    n = (len(samples) - TAPS) // DOWN
    out = np.empty((n, UP))
    for phase in range(UP):
        shift = (phase * DOWN) // UP + 1
        out[:, phase] = windows[shift : shift + n * DOWN : DOWN][:n] @ bank[:, (phase * DOWN) % UP]
    return out.ravel()


def log_mel(payload: memoryview) -> tuple[np.ndarray, np.ndarray]:
    """Frames x MELS of log-mel energies, overlapped by FRAME - HOP samples, and each frame's whole energy; in decibels,
    rounded to tenths."""
    raw = np.frombuffer(payload, np.uint8)
    window, weights = mel_weights()
    mels, energies, carry = [], [], np.zeros(FRAME - HOP)
    before = np.zeros(TAPS)
    for at in range(0, len(raw), BLOCK):
        block = np.concatenate([before, (raw[at : at + BLOCK].astype(np.float64) - 128) / 128])
        before = block[-TAPS:]
        signal = np.concatenate([carry, resample(block)])
        frames = max(0, (len(signal) - FRAME) // HOP + 1)
        if frames:
            view = np.lib.stride_tricks.sliding_window_view(signal, FRAME)[::HOP][:frames]
            spectrum = np.fft.rfft(view * window, axis=1)
            power = spectrum.real**2 + spectrum.imag**2
            mels.append(power @ weights)
            energies.append(power.sum(1))
        carry = signal[frames * HOP :]
    if not mels:
        return np.zeros((0, MELS), np.float32), np.zeros(0)
    return tuple(np.round(10 * np.log10(np.concatenate(x) + 1e-9), 1) for x in (mels, energies))


def active_segments(energy: np.ndarray) -> list[tuple[int, int]]:
    """Runs of frames that open above OPEN_DB and stay while above CLOSE_DB, relative to the loudest frame."""
    if not len(energy):
        return []
    level = energy - energy.max()
    above = np.flatnonzero(np.diff(np.concatenate([[False], level > CLOSE_DB, [False]]).astype(np.int8)))
    spans = above.reshape(-1, 2)
    opened = np.add.reduceat(np.append(level > OPEN_DB, False).astype(np.int64), spans.ravel())[::2] > 0 if len(spans) else []
    return [(int(a), int(b)) for (a, b), keep in zip(spans, opened, strict=True) if keep]


def tensor_stream(frames: np.ndarray) -> bytes:
    """Arrow IPC stream of (start_ms, end_ms, log_mel fixed_shape_tensor[TENSOR_FRAMES, MELS]); the last is zero-padded."""
    n = max(1, -(-len(frames) // TENSOR_FRAMES))
    padded = np.zeros((n * TENSOR_FRAMES, MELS), np.float32)
    padded[: len(frames)] = frames
    kind = pa.fixed_shape_tensor(pa.float32(), (TENSOR_FRAMES, MELS))
    flat = pa.FixedSizeListArray.from_arrays(pa.array(padded.ravel()), TENSOR_FRAMES * MELS)
    starts = np.arange(n) * TENSOR_FRAMES * HOP * 1000 // TARGET_RATE
    ends = np.minimum((np.arange(n) + 1) * TENSOR_FRAMES, len(frames)) * HOP * 1000 // TARGET_RATE
    batch = pa.record_batch([pa.array(starts), pa.array(ends), pa.ExtensionArray.from_storage(kind, flat)], ["start_ms", "end_ms", "log_mel"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def encode_wav(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store each text losslessly as 8-bit audio: doc_id, n_bytes, media.

    The payload is the UTF-8 text (null: empty) with spaces appended up to a positive multiple of UNIT bytes. Repeated
    rows give repeated rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            for at in range(0, len(texts), 512):
                part = texts[at : at + 512]
                media = []
                for text in part:
                    n = max(UNIT, -(-len(text) // UNIT) * UNIT)
                    media.append(wav_header(n) + text.ljust(n))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 512), pa.array(map(len, part), pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), blank(text_col).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def audio_features(media: DataFrame, *, tensors: bool = True) -> DataFrame:
    """Read stored audio back and compute its features.

    Adds payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, n_frames, segments (start_ms, end_ms),
    feature, and with ``tensors`` the IPC stream of fixed-shape tensors. ``feature`` is a digest of the tensors and
    spans with the mean energy of each mel band, so equal audio has equal features. Null media is an error: use
    ``encode_wav``, which never makes any.
    """
    out = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, n_frames long, segments array<struct<start_ms:long,end_ms:long>>, feature string" + (", tensors binary" if tensors else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start_ms", pa.int64()), ("end_ms", pa.int64())]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), span, pa.string()] + [pa.binary()] * tensors
        names = [x.strip().split(" ")[0] for x in out.replace("struct<start_ms:long,end_ms:long>", "").split(",")]
        for batch in batches:
            ids, sizes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(ids), 256):
                rows = []
                for doc, n, stored in zip(ids[at : at + 256], sizes[at : at + 256], batch.column(2).slice(at, 256), strict=True):
                    whole = memoryview(stored.as_buffer())
                    payload = wav_samples(whole)
                    frames, energy = log_mel(payload)
                    spans = [{"start_ms": a * HOP * 1000 // TARGET_RATE, "end_ms": b * HOP * 1000 // TARGET_RATE} for a, b in active_segments(energy)]
                    stream = tensor_stream(frames)
                    means = ",".join(f"{x:.2f}" for x in (frames.mean(0) if len(frames) else np.zeros(MELS)))
                    digest = hashlib.blake2b(stream + repr(spans).encode(), digest_size=12).hexdigest()
                    row = (doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(whole), hashlib.sha256(whole).hexdigest(), len(frames), spans, f"{digest}:{len(spans)}:{means}")
                    rows.append(row + (stream,) * tensors)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, out)
