"""SentencePiece encoding that projects every piece back to bytes of the original text.

The model's normaliser is followed here step by step: the longest prefix
that the compiled character map knows is replaced, every byte written
remembers where its source begins.  Piece boundaries in the normalised text
then become byte spans of the original.  The ids are the library's own.
"""
from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ids, pieces, raw

SPACE = "▁".encode()


class CharacterMap:
    """The compiled character map: a double-array trie over bytes and the replacement strings."""

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.strings = blob[4 + size:]

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """(replacement, bytes read) of the longest key that starts at ``at``."""
        if not self.units:
            return None
        shift = lambda unit: (unit >> 10) << ((unit & 0x200) >> 6)
        node, found = shift(self.units[0]), None
        for end in range(at, len(text)):
            node ^= text[end]
            unit = self.units[node] if node < len(self.units) else 0
            if unit & 0x800000FF != text[end]:
                break
            node ^= shift(unit)
            if unit >> 8 & 1:
                value = self.units[node] & 0x7FFFFFFF
                found = self.strings[value:self.strings.index(b"\0", value)], end + 1 - at
        return found


class Normaliser:
    """``align(text)``: boundaries in the normalised text -> byte offsets in ``text``."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    def steps(self, text: bytes) -> Iterator[tuple[bytes, int, int]]:
        """(bytes written, source begin, source end) of each replaced prefix or character."""
        at = 0
        while at < len(text):
            hit = self.map.longest(text, at)
            if hit is None:
                lead = text[at]
                n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                hit = text[at:at + n], n
            yield hit[0], at, at + hit[1]
            at += hit[1]

    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes and, for each of its bytes and its end, the source offset."""
        space = SPACE if self.escape else b" "
        out, where, before_space = bytearray(), [], self.squeeze
        steps = list(self.steps(text))
        end = len(text)
        if self.squeeze:
            while steps and not steps[-1][0].strip(b" "):
                end = steps.pop()[1]
            while steps and not steps[0][0].strip(b" "):
                steps.pop(0)
        if self.prefix and steps:
            out += space
            where += [steps[0][1]] * len(space)
        for written, begin, _ in steps:
            if self.squeeze and before_space:
                written = written.lstrip(b" ")
            for byte in written:
                add = space if byte == 0x20 else bytes([byte])
                if self.squeeze and byte == 0x20 and out.endswith(space):
                    continue
                out += add
                where += [begin] * len(add)
            if written:
                before_space = written.endswith(b" ")
        return bytes(out), np.array([*where, end], np.int64)

    def align(self, text: bytes, bounds: np.ndarray) -> np.ndarray:
        if self.map.units or self.squeeze or not self.escape:
            return self.normalise(text)[1][bounds]
        # Nothing is replaced but spaces, which grow from one byte to three.
        spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20)
        lead = len(SPACE) if self.prefix else 0
        grown = spaces + lead + 2 * np.arange(len(spaces))
        return np.maximum(bounds - lead - 2 * np.searchsorted(grown, bounds, "left"), 0)


class Encoder:
    """Built in each task from the model's bytes (half a megabyte for 32,000 pieces)."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto
        spec = proto.ModelProto()
        spec.ParseFromString(model)
        self.lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.normaliser = Normaliser(spec.normalizer_spec)
        byte, unknown = 6, 2  # the model format's piece types
        self.sizes = np.array([1 if p.type == byte else len(p.piece.encode()) for p in spec.pieces], np.int64)
        self.unknown = {i for i, p in enumerate(spec.pieces) if p.type == unknown}
        self.names = [str(i) for i in range(len(spec.pieces))]

    def encode(self, text: bytes) -> list[int]:
        return self.lib.encode(text.decode())

    def spans(self, text: bytes, found: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Byte spans of the original text, one for each id; together they cover it in order."""
        sizes = self.sizes[found] if found else np.zeros(0, np.int64)
        if self.unknown.intersection(found):  # models without byte pieces: an unknown piece is as long as its surface
            sizes = np.array([len(p.encode()) for p in self.lib.encode(text.decode(), out_type=str)], np.int64)
        at = self.normaliser.align(text, np.concatenate([[0], np.cumsum(sizes)]))
        return at[:-1], at[1:]


def encode_documents(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ids, begins, ends (byte spans in the text), decoded.

    Whole texts; null counts as empty and has no ids.  One pass, no shuffle."""
    def run(batches):
        own = Encoder(model)
        for b in pieces(batches, text_col):
            texts = [t or b"" for t in raw(b, text_col)]
            found = [own.encode(t) for t in texts]
            spans = [own.spans(t, f) for t, f in zip(texts, found)]
            yield pa.record_batch([
                pa.array(ids(b, id_col), pa.int64()), pa.array(found, pa.list_(pa.int32())),
                pa.array([s[0] for s in spans], pa.list_(pa.int64())), pa.array([s[1] for s in spans], pa.list_(pa.int64())),
                pa.array([own.lib.decode(f) for f in found], pa.string())], ["id", "ids", "begins", "ends", "decoded"])
    out = docs.select(id_col, text_col).mapInArrow(run, "id long, ids array<int>, begins array<long>, ends array<long>, decoded string")
    return out.withColumnRenamed("id", id_col)


def digest_documents(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode_documents`` with its long outputs digested in the same task: id, n_tokens, ids_sha256,
    decoded_sha256, spans_ok (the spans begin at 0, meet without gaps and end with the text)."""
    def run(batches):
        own = Encoder(model)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in pieces(batches, text_col):
            rows = []
            for t in raw(b, text_col):
                t = t or b""
                found = own.encode(t)
                begins, ends = own.spans(t, found)
                whole = bool(not len(t) if not found else begins[0] == 0 and ends[-1] == len(t)
                             and np.array_equal(begins[1:], ends[:-1]))
                rows.append((len(found), sha(",".join([own.names[i] for i in found]).encode()),
                             sha(own.lib.decode(found).encode()), whole))
            n, a, c, ok = zip(*rows)
            yield pa.record_batch([pa.array(ids(b, id_col), pa.int64()), pa.array(n, pa.int64()), pa.array(a), pa.array(c),
                                   pa.array(ok)], ["id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_ok"])
    out = docs.select(id_col, text_col).mapInArrow(
        run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_ok boolean")
    return out.withColumnRenamed("id", id_col)
