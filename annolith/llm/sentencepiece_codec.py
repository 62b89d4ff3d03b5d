"""SentencePiece encoding and decoding with every piece projected to its bytes in the source text.

The compiled character map of the model (a double-array trie and a pool of replacements) is applied by
longest-prefix match, and each byte of the normalised text keeps the source bytes that it came from.
The pieces tile the normalised text, so their running lengths, looked up in that alignment, are the
source spans.  The tiling is checked for every text: a model whose normalisation differed from the
alignment would fail loudly and not return wrong spans.

Nulls count as empty texts, which have no pieces.  Texts are encoded whole, whatever their length;
repeated rows give repeated results; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches

#: Fixed values of the public model format: field numbers of ModelProto, NormalizerSpec and TrainerSpec.
MODEL_TRAINER, MODEL_NORMALIZER = 2, 3
SPEC_CHARSMAP, SPEC_DUMMY_PREFIX, SPEC_EXTRA_SPACE, SPEC_ESCAPE = 2, 3, 4, 5
TRAINER_SUFFIX = 24
#: The visible space.
SPACE = "▁".encode()


def _fields(buf: bytes):
    """(number, value) of every field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = buf[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(buf):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            yield key >> 3, buf[at : at + size]
            at += size
        else:
            size = 8 if kind == 1 else 4
            yield key >> 3, buf[at : at + size]
            at += size


class CharacterMap:
    """Longest-prefix lookups in a compiled character map: uint32 size of the trie, its units, then the replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.pool = blob[4 + size :]
        #: First bytes that begin some key; all others are copied without a lookup.
        self.starts = frozenset(b for b in range(256) if self._step(0, b) is not None) if size else frozenset()

    def _step(self, node: int, byte: int) -> int | None:
        unit = self.units[node]
        to = node ^ ((unit >> 10) << ((unit & 512) >> 6)) ^ byte
        if to < len(self.units) and self.units[to] & 0x800000FF == byte:
            return to
        return None

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes matched at a place and what replaces them."""
        if text[at] not in self.starts:
            return None
        node, found = 0, None
        for k in range(at, len(text)):
            node = self._step(node, text[k])
            if node is None:
                break
            unit = self.units[node]
            if unit >> 8 & 1:
                leaf = self.units[node ^ ((unit >> 10) << ((unit & 512) >> 6))] & 0x7FFFFFFF
                found = k + 1 - at, self.pool[leaf : self.pool.index(b"\0", leaf)]
        return found


class Normalizer:
    def __init__(self, model: bytes):
        spec = suffix = b""
        for number, value in _fields(model):
            if number == MODEL_NORMALIZER:
                spec = value
            elif number == MODEL_TRAINER:
                suffix = dict(_fields(value)).get(TRAINER_SUFFIX, 0)
        got = dict(_fields(spec))
        self.map = CharacterMap(got.get(SPEC_CHARSMAP, b""))
        self.dummy = bool(got.get(SPEC_DUMMY_PREFIX, 1))
        self.squeeze = bool(got.get(SPEC_EXTRA_SPACE, 1))
        self.escape = bool(got.get(SPEC_ESCAPE, 1))
        self.suffix = bool(suffix)

    def align(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for each of them, and for the end, its place in the text."""
        if not text:
            return b"", np.zeros(1, np.int64)
        if not (self.map.units or self.squeeze or self.suffix):
            return self._plain(text)
        out, places, at = bytearray(), [], 0
        space = SPACE if self.escape else b" "
        chars: list[tuple[bytes, int]] = []
        while at < len(text):
            hit = self.map.longest(text, at) if self.map.units else None
            if hit is None:
                first = text[at]
                size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                hit = size, text[at : at + size]
            chars.append((hit[1], at))
            at += hit[0]
        end = len(text)
        if self.squeeze:
            while chars and chars[0][0] == b" ":
                chars.pop(0)
            while chars and chars[-1][0].endswith(b" "):
                end = chars[-1][1]
                chars[-1] = (chars[-1][0].rstrip(b" "), end)
                if chars[-1][0]:
                    end = chars[-1][1] + len(chars[-1][0])
                    break
                chars.pop()
        if not any(new for new, _ in chars):
            return b"", np.zeros(1, np.int64)
        if self.dummy and not self.suffix:
            out += space
            places += [chars[0][1]] * len(space)
        blank = self.squeeze
        for new, place in chars:
            if blank:
                new = new.lstrip(b" ")
            for k in range(len(new)):
                one = space if new[k] == 32 else new[k : k + 1]
                out += one
                places += [place] * len(one)
            if new:
                blank = self.squeeze and new.endswith(b" ")
        if self.dummy and self.suffix:
            out += space
            places += [end] * len(space)
        return bytes(out), np.array([*places, end], np.int64)

    def _plain(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Without a map: only spaces change their width."""
        space = SPACE if self.escape else b" "
        raw = np.frombuffer(text, np.uint8)
        width = np.where(raw == 32, len(space), 1)
        places = np.repeat(np.arange(len(raw)), width)
        lead = len(space) if self.dummy else 0
        return (space if lead else b"") + text.replace(b" ", space), np.concatenate([np.zeros(lead, np.int64), places, [len(raw)]])


class Codec:
    def __init__(self, model_file: str):
        import sentencepiece

        with open(model_file, "rb") as f:
            model = f.read()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.normalizer = Normalizer(model)
        n = self.library.get_piece_size()
        self.width = np.array([1 if self.library.is_byte(i) else len(self.library.id_to_piece(i).encode()) for i in range(n)], np.int64)
        self.unknown = self.library.unk_id()

    def encode(self, text: str) -> tuple[list[int], np.ndarray]:
        """Ids, and their byte spans in the text as an (n, 2) array."""
        raw = text.encode()
        ids = self.library.encode(text)
        normal, places = self.normalizer.align(raw)
        if ids and self.unknown in ids:
            width = np.array([len(p.piece.encode()) for p in self.library.encode(text, out_type="immutable_proto").pieces], np.int64)
        else:
            width = self.width[ids] if ids else np.zeros(0, np.int64)
        ends = np.cumsum(width)
        if (int(ends[-1]) if len(ends) else 0) != len(normal):
            raise ValueError("the pieces do not tile the normalised text")
        spans = np.stack([places[ends - width], places[ends]], axis=1) if len(ends) else np.zeros((0, 2), np.int64)
        return ids, spans

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(maxsize=2)
def codec(model_file: str) -> Codec:
    return Codec(model_file)


def encode(df: DataFrame, model_file: str, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, ids, span_start and span_end (bytes of the UTF-8 text, one for each id)."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(model_file)
        got = [own.encode(x or "") for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([g[0] for g in got], pa.list_(pa.int32())),
                pa.array([g[1][:, 0] for g in got], pa.list_(pa.int64())),
                pa.array([g[1][:, 1] for g in got], pa.list_(pa.int64())),
            ],
            ["doc_id", "ids", "span_start", "span_end"],
        )

    kind = df.schema[key].dataType.simpleString()
    return map_batches(df.select(df[key].alias("doc_id"), df[text]), f"doc_id {kind}, ids array<int>, span_start array<bigint>, span_end array<bigint>", rows)


def decode(df: DataFrame, model_file: str, *, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """key and text; null ids give an empty text."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(model_file)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    kind = df.schema[key].dataType.simpleString()
    return map_batches(df.select(df[key].alias("doc_id"), df[ids]), f"doc_id {kind}, text string", rows)


def round_trip_digest(df: DataFrame, model_file: str, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encodes and decodes in one pass and keeps digests: no id list leaves the worker.

    spans_sha256 is over the projected byte spans (start and end as little-endian int64).
    """

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(model_file)
        count, of_ids, of_text, of_spans = [], [], [], []
        for x in batch.column(1):
            ids, spans = own.encode(x.as_py() or "")
            count.append(len(ids))
            of_ids.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
            of_text.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            of_spans.append(hashlib.sha256(np.ascontiguousarray(spans, "<i8").tobytes()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(count, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string()), pa.array(of_spans, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"],
        )

    kind = df.schema[key].dataType.simpleString()
    return map_batches(df.select(df[key].alias("doc_id"), df[text]), f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_sha256 string", rows)
