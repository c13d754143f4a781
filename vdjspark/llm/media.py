"""Audio columns: lossless 8-bit PCM storage, polyphase resampling, log-mel frames, energy segments.

A document's features come from what is read back from the stored bytes: the samples are resampled by a
polyphase filter, cut into overlapping frames, and turned into log-mel bands; frames whose energy rises
over a high threshold open a segment that lasts while it stays over a low one. The bands are kept as
fixed-shape Arrow tensors, each with its span of time.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vdjspark.llm.frames import map_frames

RATE, UP, DOWN, TAPS = 8000, 3, 4, 16
TARGET = RATE * UP // DOWN
FRAME, HOP, FFT, BANDS = TARGET // 40, TARGET // 100, 256, 20
#: Frames of one tensor.
BLOCK = 32
MULTIPLE, PAD = 192, b" "


def payload_of(text: bytes) -> bytes:
    return text + PAD * (max(1, -(-len(text) // MULTIPLE)) * MULTIPLE - len(text))


def stored(samples: bytes, rate: int = RATE) -> bytes:
    """RIFF/WAVE, one channel of unsigned 8-bit PCM."""
    pad = b"\0" * (len(samples) % 2)
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(samples) + len(pad), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(samples)) + samples + pad


def read_back(media: bytes) -> tuple[int, bytes]:
    """Sampling rate and samples of a stored() file, chunk by chunk."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE file")
    at, rate = 12, None
    while at + 8 <= len(media):
        name, size = struct.unpack_from("<4sI", media, at)
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", media, at + 8)
            if (kind, channels, bits) != (1, 1, 8):
                raise ValueError("one channel of 8-bit PCM expected")
        elif name == b"data" and rate is not None:
            return rate, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no samples")


def _filters() -> np.ndarray:
    """Windowed-sinc low pass at the lower rate, split into UP phases of TAPS taps."""
    k = np.arange(UP * TAPS) - (UP * TAPS - 1) / 2
    h = np.sinc(k / DOWN) * np.hamming(UP * TAPS)
    h *= UP / h.sum()
    return np.stack([h[p::UP][::-1] for p in range(UP)])


def _mel_bank() -> np.ndarray:
    def mel(f: np.ndarray | float) -> np.ndarray:
        return 2595 * np.log10(1 + np.asarray(f) / 700)

    edges = 700 * (10 ** (np.linspace(0, mel(TARGET / 2), BANDS + 2) / 2595) - 1)
    f = np.fft.rfftfreq(FFT, 1 / TARGET)
    rise = (f[:, None] - edges[:-2]) / (edges[1:-1] - edges[:-2])
    fall = (edges[2:] - f[:, None]) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(rise, fall))


FILTERS, MEL, HANN = _filters(), _mel_bank(), np.hanning(FRAME)


def resampled(x: np.ndarray) -> np.ndarray:
    """x at RATE -> at TARGET: each output is one phase's taps over the input around it."""
    n = len(x) * UP // DOWN
    padded = np.concatenate([np.zeros(TAPS // 2), x, np.zeros(TAPS)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, TAPS)
    out = np.empty(-(-n // UP) * UP)
    for p in range(UP):
        phase, offset = p * DOWN % UP, p * DOWN // UP
        out[p::UP] = windows[offset::DOWN][: len(out) // UP] @ FILTERS[phase]
    return out[:n]


def log_mel(samples: bytes) -> np.ndarray:
    """Frames x bands; shorter input is one frame, padded with silence. Sums are in double precision, so that equal input gives equal floats."""
    y = resampled((np.frombuffer(samples, np.uint8).astype(np.float64) - 128) / 128)
    if len(y) < FRAME:
        y = np.pad(y, (0, FRAME - len(y)))
    frames = np.lib.stride_tricks.sliding_window_view(y, FRAME)[::HOP]
    out = np.empty((len(frames), BANDS), np.float32)
    for at in range(0, len(frames), 1024):
        spectrum = np.fft.rfft(frames[at : at + 1024] * HANN, FFT, axis=1)
        out[at : at + 1024] = np.log((spectrum.real**2 + spectrum.imag**2) @ MEL + 1e-6)
    return out


def segments(energy: np.ndarray, high: float = 0.5, low: float = 0.0) -> list[tuple[int, int]]:
    """Frame spans where energy stays over mean + low deviations and reaches mean + high deviations."""
    mean, dev = float(energy.mean()), float(energy.std())
    on = energy > mean + low * dev
    edge = np.diff(on.astype(np.int8), prepend=0, append=0)
    peak = np.concatenate([[0], np.cumsum(energy > mean + high * dev)])
    return [(int(a), int(b)) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True) if peak[b] > peak[a]]


def blocks(mel: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tensors of BLOCK x BANDS, the last filled with zeros, and their spans in milliseconds."""
    n = -(-len(mel) // BLOCK)
    full = np.zeros((n * BLOCK, BANDS), np.float32)
    full[: len(mel)] = mel
    first = np.arange(n) * BLOCK
    last = np.minimum(first + BLOCK, len(mel)) - 1
    return full.reshape(n, BLOCK, BANDS), np.stack([first * HOP * 1000 // TARGET, (last * HOP + FRAME) * 1000 // TARGET], axis=1)


def tensor_bytes(tensors: np.ndarray, spans: np.ndarray) -> bytes:
    """One Arrow IPC stream: a fixed_shape_tensor column and the span of each tensor."""
    batch = pa.record_batch([pa.FixedShapeTensorArray.from_numpy_ndarray(np.ascontiguousarray(tensors)), pa.array(spans[:, 0]), pa.array(spans[:, 1])], names=["log_mel", "start_ms", "end_ms"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def tensors_from(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """tensor_bytes() backwards."""
    got = pa.ipc.open_stream(data).read_all().combine_chunks()
    return got["log_mel"].chunk(0).to_numpy_ndarray(), np.stack([got["start_ms"].to_numpy(), got["end_ms"].to_numpy()], axis=1)


SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, n_frames int, segments string, feature string"


def encode(docs: DataFrame, keep: bool = False) -> DataFrame:
    """Documents -> sizes and hashes of payload and stored form, segments (milliseconds) and a feature text.

    The feature text is of the tensors as read back from their Arrow stream (see tensor_bytes). With
    ``keep`` also ``media`` (the stored file) and ``tensors`` (that stream).
    Null text counts as empty, which is one block of blanks. Equal texts give equal values.
    """

    def row(text: bytes) -> tuple:
        media = stored(payload_of(text))
        _, samples = read_back(media)
        mel = log_mel(samples)
        spans = segments(mel.mean(axis=1))
        data = tensor_bytes(*blocks(mel))
        tensors, _ = tensors_from(data)
        kept = tensors.reshape(-1, BANDS)[: len(mel)]
        ms = ",".join(f"{a * HOP * 1000 // TARGET}-{((b - 1) * HOP + FRAME) * 1000 // TARGET}" for a, b in spans)
        feature = f"frames={len(mel)};segments={len(spans)};bands=" + "|".join(f"{v:.2f}" for v in kept.mean(axis=0, dtype=np.float64)) + f";tensors={'x'.join(map(str, tensors.shape))}"
        out = (len(text), len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(media), hashlib.sha256(media).hexdigest(), len(mel), ms, feature)
        return (*out, media, data) if keep else out

    schema = SCHEMA + ", media binary, tensors binary" * keep
    names = [c.split()[0] for c in schema.split(", ")[1:]]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([row(t) for t in batch["text"]], columns=names)
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return map_frames(rows, work, schema)
