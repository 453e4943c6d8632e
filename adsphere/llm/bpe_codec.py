"""Byte-level BPE through sentencepiece (operator 8).

A sentencepiece BPE model is written directly from a rank file: each vocabulary entry becomes
a piece whose bytes are spelled with one printable character per byte, scored by its negative
rank, with identity normalisation.  sentencepiece merges the adjacent pair with the highest
score first, leftmost on ties, which is the lowest-rank-first rule of the rank file.  Texts
are cut into pre-tokens, each is spelled and encoded by itself (one that is a vocabulary
entry as a whole is that entry), and decoding maps ids back through the spelled pieces.

Defined cases: a NULL text is empty; an empty text has no ids and the digests of no bytes;
repeated rows are encoded each; an empty table gives an empty result; other columns of the
input are ignored.  Each row is encoded by itself: no shuffle, whole texts, bounded caches.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .tokens import PATTERN, PieceEncoder, byte_slices, vocabulary_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
UNKNOWN = "\ue000"  # no spelled byte uses it, so no text ever meets it


def byte_spelling() -> list[str]:
    """One printable, non-space character per byte: itself where it is one, else from U+0100 on."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return [chr(b if b in keep else next(other)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes → rank, from a rank file (base64 token and rank on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protocol-buffer field: bytes (length-delimited), int (varint) or float (32 bits)."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value & (1 << 64) - 1)


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The serialised sentencepiece model: piece i is the token of rank i, the unknown piece last."""
    spell = byte_spelling()
    by_rank = sorted(ranks.items(), key=lambda kv: kv[1])
    if [r for _, r in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must be 0, 1, 2, …")
    # field numbers and enum values of the public model format (fixed values)
    normal, unknown, bpe = 1, 2, 2
    out = [_field(1, _field(1, "".join(spell[b] for b in token).encode()) + _field(2, -float(rank)) + _field(3, normal))
           for token, rank in by_rank]
    out.append(_field(1, _field(1, UNKNOWN.encode()) + _field(2, 0.0) + _field(3, unknown)))
    trainer = (_field(3, bpe) + _field(4, len(ranks) + 1) + _field(40, len(ranks))
               + b"".join(_field(n, -1) for n in (41, 42, 43)) + _field(45, UNKNOWN.encode()))
    normalizer = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return b"".join(out) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Text → ids and ids → bytes by a rank file, through sentencepiece."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        ranks = read_ranks(path)
        self.ranks = ranks
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        spell = byte_spelling()
        self.spell = {b: c for b, c in enumerate(spell)}  # for str.translate on latin-1 text
        unspell = {c: bytes([b]) for b, c in enumerate(spell)}
        self.bytes_of = [b"".join(unspell[c] for c in self.sp.id_to_piece(i)) for i in range(len(ranks))]
        self.find = regex.compile(pattern).findall
        self.cuttable = pattern == PATTERN
        self.cached = PieceEncoder(self._pieces)
        self.known: dict[str, list[int]] = {}

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = [self.find(p) for p in pieces]
        if len(self.known) > 500_000:
            self.known.clear()
        new = list({t for c in cut for t in c} - self.known.keys())
        raw = [t.encode() for t in new]
        merge = [i for i, b in enumerate(raw) if b not in self.ranks]
        found = self.sp.encode([raw[i].decode("latin-1").translate(self.spell) for i in merge],
                               out_type=int, num_threads=1) if merge else []
        fresh = {t: [self.ranks[b]] for t, b in zip(new, raw, strict=True) if b in self.ranks}
        fresh.update((new[i], ids) for i, ids in zip(merge, found, strict=True))
        known = self.known
        out = [[i for t in c for i in (known.get(t) or fresh[t])] for c in cut]
        known.update((t, v) for t, v in fresh.items() if len(t) <= 64)
        return (np.fromiter((i for o in out for i in o), np.uint32),
                np.fromiter(map(len, out), np.int64, len(out)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of a batch of texts."""
        if self.cuttable:
            return self.cached.encode(texts)
        ids, counts = self._pieces([t or "" for t in texts.to_pylist()])
        return ids, np.concatenate([[0], np.cumsum(counts)])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a run of ids, by the inverse of the spelling."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


_LOADED: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a file, made once per Python worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Codec(path, pattern)
    return _LOADED[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids as little-endian 32-bit words, decoded the bytes they stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            for a, b in byte_slices(batch["text"]):
                ids, bounds = c.encode(batch["text"][a:b])
                ids = ids.astype("<u4")
                parts = [ids[i:j] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][a:b], pa.array(np.diff(bounds), pa.int64()),
                     pa.array([p.tobytes() for p in parts], pa.binary()),
                     pa.array([c.decode(p) for p in parts], pa.binary())],
                    names=["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary, decoded binary")


def codec_digests(docs: DataFrame, path: str, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256); the digests are taken in the workers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            for a, b in byte_slices(batch["text"]):
                ids, bounds = c.encode(batch["text"][a:b])
                ids = ids.astype("<u4")
                parts = [ids[i:j] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][a:b], pa.array(np.diff(bounds), pa.int64()),
                     pa.array([hashlib.sha256(p.tobytes()).hexdigest() for p in parts], pa.string()),
                     pa.array([hashlib.sha256(c.decode(p)).hexdigest() for p in parts], pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, "
             "ids_sha256 string, decoded_sha256 string")


def codec_report(docs: DataFrame) -> DataFrame:
    """The digests under the installed multi-language vocabulary and its own pattern."""
    import public_tokenizers

    return codec_digests(docs, vocabulary_path(VOCABULARY), public_tokenizers.PATTERN)
