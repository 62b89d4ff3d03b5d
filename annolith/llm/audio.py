"""Media columns: audio clips with log-mel features and energy segments.

A payload is stored losslessly as unsigned 8-bit mono PCM in a WAV container and read back from those
stored bytes.  Its samples are resampled by a polyphase filter, cut into overlapping frames, and turned
into log-mel energies, which stand in fixed-shape Arrow tensors of FRAMES x BANDS with the time span of
each.  A hysteresis over the frame energy (opened above one level, closed below a lower one) gives the
active segments.  Tensors and spans are stored as Arrow IPC bytes beside the clip, since Parquet as Spark writes it has
no tensor type; ``from_ipc`` gives them back as Arrow's fixed-shape tensors.

Nulls count as empty texts; an empty payload is one block of filler.  Equal texts give equal values: each
clip is computed by itself, in blocks of a fixed size, so neither its neighbours in a batch nor the size
of the batch matter, and a very long clip takes no more memory than its bytes and one block.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches

UNIT, FILLER = 576, b"\xff"
RATE_IN, UP, DOWN, TAPS = 16_000, 1, 2, 24
FRAME, HOP, FFT, BANDS = 200, 80, 256, 32
FRAMES = 64
OPEN_DB, CLOSE_DB = 3.0, 1.0
BLOCK = 2048  # frames worked on at once
CLIPS = 128  # clips whose media and tensors a worker holds at once


def payload_of(text: str | None) -> tuple[bytes, int]:
    """UTF-8 bytes filled up to a positive multiple of UNIT, and how many of them are the text's."""
    raw = (text or "").encode()
    whole = max(UNIT, -(-len(raw) // UNIT) * UNIT)
    return raw + FILLER * (whole - len(raw)), len(raw)


def to_wav(samples: bytes, rate: int = RATE_IN) -> bytes:
    """8-bit mono PCM; WAV keeps such samples unsigned."""
    pad = len(samples) % 2
    form = struct.pack("<HHIIHH", 1, 1, rate, rate, 1, 8)
    return b"RIFF" + struct.pack("<I", 36 + len(samples) + pad) + b"WAVEfmt " + struct.pack("<I", 16) + form + b"data" + struct.pack("<I", len(samples)) + samples + b"\0" * pad


def from_wav(stored: bytes) -> tuple[bytes, int]:
    """Samples and rate; raises ValueError on anything but whole 8-bit mono PCM."""
    if stored[:4] != b"RIFF" or stored[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, rate = 12, 0
    while at + 8 <= len(stored):
        name, size = stored[at : at + 4], struct.unpack_from("<I", stored, at + 4)[0]
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", stored, at + 8)
            if (kind, channels, bits) != (1, 1, 8):
                raise ValueError("not 8-bit mono PCM")
        elif name == b"data":
            samples = stored[at + 8 : at + 8 + size]
            if len(samples) != size or not rate:
                raise ValueError("the samples are cut short")
            return samples, rate
        at += 8 + size + size % 2
    raise ValueError("no samples")


@lru_cache(maxsize=8)
def _phases(up: int, down: int, taps: int) -> np.ndarray:
    """The windowed-sinc low pass, one row of taps for each of the up phases."""
    n = taps * up
    t = np.arange(n) - (n - 1) / 2
    cut = 1 / max(up, down)
    h = np.sinc(cut * t) * cut * np.hamming(n) * up
    h = h / h.sum() * up
    return np.ascontiguousarray(h.reshape(taps, up).T[:, ::-1], np.float32)


def resample(x: np.ndarray, up: int = UP, down: int = DOWN, taps: int = TAPS) -> np.ndarray:
    """Each output sample takes the phase that it falls on; no zero is multiplied and no sample computed in vain."""
    phases = _phases(up, down, taps)
    n = -(-len(x) * up // down)
    padded = np.concatenate([np.zeros(taps // 2, np.float32), x.astype(np.float32), np.zeros(taps, np.float32)])
    out = np.empty(n, np.float32)
    step = BLOCK * HOP
    for phase in range(up):
        first = next((k for k in range(up) if k * down % up == phase), None)
        if first is None:
            continue
        places = np.arange(first, n, up)
        for k in range(0, len(places), step):
            some = places[k : k + step]
            starts = some * down // up
            view = np.lib.stride_tricks.sliding_window_view(padded[starts[0] : starts[-1] + taps], taps)[:: down if up == 1 else 1]
            out[some] = (view if up == 1 else view[starts - starts[0]]) @ phases[phase]
    return out


@lru_cache(maxsize=8)
def mel_bank(rate: float, fft: int = FFT, bands: int = BANDS) -> np.ndarray:
    """Triangles evenly spaced in mel from 60 Hz to half the rate, as a (bins, bands) matrix."""
    mel = np.linspace(1127 * np.log1p(60 / 700), 1127 * np.log1p(rate / 2 / 700), bands + 2)
    edges = 700 * np.expm1(mel / 1127)
    bins = np.arange(fft // 2 + 1) * rate / fft
    rise = (bins[:, None] - edges[:-2]) / (edges[1:-1] - edges[:-2])
    fall = (edges[2:] - bins[:, None]) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(rise, fall)).astype(np.float32)


def log_mel(x: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """(frames, BANDS) log energies and the level of each frame in dB; the last frame is filled with zeros."""
    n = max(1, 1 + -(-(len(x) - FRAME) // HOP))
    x = np.concatenate([x, np.zeros((n - 1) * HOP + FRAME - len(x), np.float32)])
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    window, bank = np.hanning(FRAME).astype(np.float32), mel_bank(rate)
    mel, level = np.empty((n, BANDS), np.float32), np.empty(n, np.float32)
    for k in range(0, n, BLOCK):
        part = frames[k : k + BLOCK]
        f = np.fft.rfft(part * window, FFT)
        mel[k : k + BLOCK] = np.log((f.real**2 + f.imag**2).astype(np.float32) @ bank + 1e-6)
        level[k : k + BLOCK] = 10 * np.log10((part**2).mean(1) + 1e-6)
    return mel, level


def segments(level: np.ndarray, open_db: float = OPEN_DB, close_db: float = CLOSE_DB) -> np.ndarray:
    """(first, past) frames of the active segments; levels count from the clip's quietest tenth."""
    floor = np.quantile(level, 0.1)
    known = np.where(level >= floor + open_db, 1, np.where(level < floor + close_db, 0, -1))
    last = np.maximum.accumulate(np.where(known >= 0, np.arange(len(level)), -1))
    active = np.where(last >= 0, known[np.maximum(last, 0)], 0)
    turns = np.diff(np.concatenate([[0], active, [0]]))
    return np.stack([np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)], axis=1)


def tensors(mel: np.ndarray) -> pa.Array:
    """Fixed-shape Arrow tensors of FRAMES x BANDS; the last is filled with zeros."""
    n = -(-len(mel) // FRAMES)
    filled = np.zeros((n, FRAMES, BANDS), np.float32)
    filled.reshape(-1, BANDS)[: len(mel)] = mel
    return pa.FixedShapeTensorArray.from_numpy_ndarray(filled)


def analyse(stored: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Tensors, their (start, end) seconds, and the active segments' seconds."""
    samples, rate = from_wav(stored)
    x = (np.frombuffer(samples, np.uint8).astype(np.float32) - 128) / 128
    now = rate * UP / DOWN
    mel, level = log_mel(resample(x), now)
    first = np.arange(0, len(mel), FRAMES)
    spans = np.stack([first * HOP, (np.minimum(first + FRAMES, len(mel)) - 1) * HOP + FRAME], axis=1) / now
    found = segments(level)
    return tensors(mel), spans, np.stack([found[:, 0] * HOP, (found[:, 1] - 1) * HOP + FRAME], axis=1) / now


#: What a clip's tensors are stored as: an Arrow IPC stream of one batch, a row for each tensor.
TENSOR = pa.fixed_shape_tensor(pa.float32(), (FRAMES, BANDS), dim_names=("frame", "band"))
TENSORS = pa.schema([("start_s", pa.float64()), ("end_s", pa.float64()), ("active_s", pa.float64()), ("log_mel", TENSOR)])


def to_ipc(stored: bytes) -> tuple[bytes, np.ndarray]:
    """A clip's tensors with their spans as an Arrow IPC stream, and its active segments in seconds."""
    found, spans, active = analyse(stored)
    batch = pa.RecordBatch.from_arrays([pa.array(spans[:, 0]), pa.array(spans[:, 1]), pa.array(_overlaps(spans, active)), pa.ExtensionArray.from_storage(TENSOR, found.storage)], schema=TENSORS)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, TENSORS) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes(), active


def _overlaps(spans: np.ndarray, active: np.ndarray) -> np.ndarray:
    """Active seconds inside each span, from running sums over the segments."""
    if not len(active):
        return np.zeros(len(spans))
    edges = np.concatenate([[0.0], np.cumsum(active[:, 1] - active[:, 0])])

    def until(t: np.ndarray) -> np.ndarray:
        k = np.searchsorted(active[:, 0], t, "right")
        inside = np.where(k > 0, np.minimum(t, active[np.maximum(k - 1, 0), 1]) - active[np.maximum(k - 1, 0), 0], 0.0)
        return np.where(k > 0, edges[np.maximum(k - 1, 0)] + inside, 0.0)

    return until(spans[:, 1]) - until(spans[:, 0])


def from_ipc(raw: bytes) -> pa.RecordBatch:
    """start_s, end_s, active_s and log_mel (fixed-shape tensors) of a clip; raises ValueError on any other schema."""
    with pa.ipc.open_stream(raw) as reader:
        if reader.schema != TENSORS:
            raise ValueError("not a clip's tensors")
        return reader.read_next_batch()


def describe(tensors: pa.RecordBatch, active: pa.StructArray) -> str:
    """Clip length, tensors, active segments and seconds, and the mean log energy of four groups of bands."""
    end = tensors["end_s"][len(tensors) - 1].as_py()
    mel = tensors["log_mel"].to_numpy_ndarray()
    n = round((end * RATE_IN * UP / DOWN - FRAME) / HOP) + 1
    mean = mel.reshape(-1, BANDS)[:n].mean(0, dtype=np.float64).reshape(4, -1).mean(1)
    seconds = (active.field("end_s").to_numpy() - active.field("start_s").to_numpy()).sum()
    return f"seconds={end:.3f};tensors={len(tensors)};segments={len(active)};active={seconds:.3f};mel=" + ",".join(f"{x:.2f}" for x in mean)


def store(df: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_bytes and media (the WAV bytes)."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [payload_of(x.as_py()) for x in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for _, n in got], pa.int64()), pa.array([to_wav(p) for p, _ in got], pa.binary())], ["doc_id", "n_bytes", "media"])

    kind = df.schema[key].dataType.simpleString()
    return map_batches(df.select(df[key].alias("doc_id"), df[text]), f"doc_id {kind}, n_bytes bigint, media binary", rows, CLIPS)


def features(media: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media, tensors (see ``from_ipc``) and active (array of start and end in seconds) of each clip."""
    kind = media.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())])

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [to_ipc(x.as_py()) for x in batch.column(2)]
        counts = np.concatenate([[0], np.cumsum([len(a) for _, a in got])]).astype(np.int32)
        flat = np.concatenate([a for _, a in got] or [np.zeros((0, 2))])
        spans = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], fields=list(span))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array([t for t, _ in got], pa.binary()), pa.ListArray.from_arrays(pa.array(counts), spans)], ["doc_id", "n_bytes", "media", "tensors", "active"])

    return map_batches(media.select("doc_id", "n_bytes", "media"), f"doc_id {kind}, n_bytes bigint, media binary, tensors binary, active array<struct<start_s:double,end_s:double>>", rows, CLIPS)


def digest(clips: DataFrame) -> DataFrame:
    """What is read back from each clip's stored bytes and stored tensors (from ``features``), the latter in one string."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[] for _ in range(6)]
        for x, raw, active in zip(batch.column(2), batch.column(3), batch.column(4), strict=True):
            stored = x.as_py()
            payload = from_wav(stored)[0]
            for column, value in zip(out, (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), describe(from_ipc(raw.as_py()), active.values)), strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, out, kinds)], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    kind = clips.schema["doc_id"].dataType.simpleString()
    return map_batches(clips.select("doc_id", "n_bytes", "media", "tensors", "active"), f"doc_id {kind}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string", rows)
