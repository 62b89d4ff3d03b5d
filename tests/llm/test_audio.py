import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest

from annolith.llm import audio


def test_round_trip(odd):
    texts = {r.doc_id: r.text for r in odd.collect()}
    seen = {}
    for r in audio.digest(audio.features(audio.store(odd))).collect():
        raw = (texts[r.doc_id] or "").encode()
        whole = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(whole), hashlib.sha256(whole).hexdigest(), zlib.crc32(whole[-32:]))
        assert r.media_bytes == len(whole) + 44
        assert seen.setdefault(texts[r.doc_id], r.feature) == r.feature


def test_containers_are_checked():
    payload, _ = audio.payload_of("x" * 577)
    stored = audio.to_wav(payload)
    assert len(payload) == 1152 and audio.from_wav(stored) == (payload, 16_000)
    for bad in (b"", stored[:-10], stored.replace(b"WAVE", b"AVI ")):
        with pytest.raises(ValueError):
            audio.from_wav(bad)


@pytest.mark.parametrize("up,down", [(1, 2), (3, 2), (2, 3), (5, 8)])
def test_resampling_keeps_a_tone(up, down):
    x = np.sin(np.arange(16_000) * 2 * np.pi * 440 / 16_000).astype(np.float32)
    y = audio.resample(x, up, down)
    assert len(y) == -(-len(x) * up // down)
    t = np.arange(len(y)) * down / up / 16_000
    errors = [np.abs(y[400:-400] - np.sin(2 * np.pi * 440 * (t + shift / 16_000))[400:-400]).max() for shift in np.linspace(-1, 1, 81)]
    assert min(errors) < 0.02


def test_blocks_do_not_show():
    x = np.random.default_rng(0).normal(size=audio.BLOCK * audio.HOP * 2 + 77).astype(np.float32)
    mel, level = audio.log_mel(x, 8000)
    short, _ = audio.log_mel(x[: audio.HOP * 10 + audio.FRAME], 8000)
    assert np.allclose(mel[:10], short[:10], atol=1e-4) and len(level) == len(mel)


def test_hysteresis():
    level = np.array([0, 0, 0, 0, 2, 4, 2, 2, 0.5, 2, 5, 5, 0], float)
    assert audio.segments(level).tolist() == [[5, 8], [10, 12]]


def test_log_mel_is_the_definition():
    """Frame by frame: window, Fourier sum, triangles, logarithm."""
    x, rate = np.random.default_rng(1).normal(size=audio.FRAME + 3 * audio.HOP), 8000.0
    mel, level = audio.log_mel(x.astype(np.float32), rate)
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(audio.FRAME) / (audio.FRAME - 1))
    to_mel, to_hz = (lambda f: 1127 * np.log(1 + f / 700)), (lambda m: 700 * (np.exp(m / 1127) - 1))
    edges = [to_hz(to_mel(60) + k * (to_mel(rate / 2) - to_mel(60)) / (audio.BANDS + 1)) for k in range(audio.BANDS + 2)]
    t = np.arange(audio.FRAME)
    for n in range(4):
        part = x[n * audio.HOP : n * audio.HOP + audio.FRAME]
        power = [abs(np.sum(part * window * np.exp(-2j * np.pi * k * t / audio.FFT))) ** 2 for k in range(audio.FFT // 2 + 1)]
        for b, (lo, mid, hi) in enumerate(zip(edges, edges[1:], edges[2:], strict=False)):
            weight = [max(0, min((f - lo) / (mid - lo), (hi - f) / (hi - mid))) for f in (k * rate / audio.FFT for k in range(audio.FFT // 2 + 1))]
            assert abs(mel[n, b] - np.log(np.dot(weight, power) + 1e-6)) < 1e-3
        assert abs(level[n] - 10 * np.log10(np.mean(part**2) + 1e-6)) < 1e-3


def test_tensors(odd, none):
    row = audio.features(audio.store(odd.where("doc_id = 5"))).first()
    got = audio.from_ipc(bytes(row.tensors))
    assert got.schema == audio.TENSORS and got["log_mel"].type.shape == [audio.FRAMES, audio.BANDS] and len(got) > 5
    found, spans, active = audio.analyse(bytes(row.media))
    assert np.array_equal(got["log_mel"].to_numpy_ndarray(), found.to_numpy_ndarray()) and got["start_s"].to_pylist() == spans[:, 0].tolist()
    assert [(a.start_s, a.end_s) for a in row.active] == [tuple(a) for a in active.tolist()]
    inside = [sum(max(0, min(e, z) - max(s, a)) for a, z in active) for s, e in spans]
    assert np.allclose(got["active_s"].to_pylist(), inside)
    with pytest.raises(ValueError):
        audio.from_ipc(pa.ipc.new_stream(sink := pa.BufferOutputStream(), pa.schema([("x", pa.int8())])).close() or sink.getvalue().to_pybytes())
    assert audio.digest(audio.features(audio.store(none))).count() == 0
