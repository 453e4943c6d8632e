"""Encoding batches of texts with one library call per *distinct* piece of text.

A byte-level BPE never merges across pre-tokens, and its pre-token pattern (:data:`PATTERN`)
always starts a new pre-token at a space that stands before a visible character: a letter,
number or symbol run takes one space in front, and a run of white space gives its last
space to the word after it.  So a text may be cut there, the pieces encoded one by one,
and the ids put together again.  Texts repeat words, so a worker encodes each distinct
piece once and looks the others up.

A batch is cut, numbered and put together by Arrow and numpy; Python objects are made for a
batch's distinct pieces only.  The cache is bounded: it is emptied when it holds
``MAX_CACHED`` pieces, which costs time and changes no result, and pieces of more than
``MAX_CACHED_CHARS`` are kept for their batch only.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed value: the pre-token pattern of the byte-level vocabularies this module may cut up.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

MAX_CACHED = 1_000_000
MAX_CACHED_CHARS = 64  # a longer piece is encoded in every batch that holds it
BATCH_BYTES = 16 << 20

#: A space before another white-space character or the end (RE2, for Arrow): such texts are cut with CUT.
ODD = r" (?:\z|[\s\p{Z}\x0b\x1c-\x1f\x85])"
CUT = re.compile(r"(?= \S)")


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, … of each (start, count) range, one range after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total, dtype=np.int64)


def byte_slices(texts: pa.Array, limit: int = BATCH_BYTES):
    """Runs of a text column of about ``limit`` bytes (a longer text is a run of its own)."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield at, i
            at, held = i, 0
        held += int(n)
    if at < len(sizes):
        yield at, len(sizes)


class PieceEncoder:
    """Ids of whole texts through a cache of pieces.

    ``encode_pieces`` gets distinct pieces (each a text that starts and ends at pre-token
    borders) and returns their ids in a row and the number of ids of each.
    """

    def __init__(self, encode_pieces: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.encode_pieces = encode_pieces
        self.clear()

    def clear(self) -> None:
        self.spaced: dict[str, int] = {}  # by what follows the space
        self.first: dict[str, int] = {}   # what a text begins with
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)
        self.late: list[tuple[np.ndarray, np.ndarray]] = []  # (ids, counts) of a batch's long pieces

    def _places(self, pieces: list[str], cache: dict[str, int], prefix: str) -> np.ndarray:
        """The place in the pool of each piece; pieces not seen before are encoded first."""
        places = np.fromiter((cache.get(p, -1) for p in pieces), np.int64, len(pieces))
        missing = np.flatnonzero(places < 0)
        long = np.fromiter((len(pieces[i]) > MAX_CACHED_CHARS for i in missing), bool, len(missing))
        late, missing = missing[long], missing[~long]
        if len(missing):
            ids, counts = self.encode_pieces([prefix + pieces[i] for i in missing])
            at = len(self.start) + np.arange(len(missing))
            self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(counts) - counts])
            self.count = np.concatenate([self.count, counts])
            self.pool = np.concatenate([self.pool, ids.astype(np.uint32)])
            places[missing] = at
            cache.update(zip((pieces[i] for i in missing), at.tolist(), strict=True))
        if len(late):  # kept for this batch only, under places -2, -3, …
            places[late] = -2 - sum(len(c) for _, c in self.late) - np.arange(len(late))
            ids, counts = self.encode_pieces([prefix + pieces[i] for i in late])
            self.late.append((ids.astype(np.uint32), counts))
        return places

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): text i has ``ids[bounds[i]:bounds[i + 1]]``.  A NULL text is empty."""
        if len(self.spaced) + len(self.first) > MAX_CACHED:
            self.clear()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False).astype(bool)
        order = np.arange(len(texts))
        if odd.any():
            order = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
            cut = [[c if k == 0 else c[1:] for k, c in enumerate(CUT.split(t))]
                   for t in texts.filter(pa.array(odd)).to_pylist()]
            plain = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
            lists = pa.chunked_array([plain, pa.array(cut, plain.type)]).combine_chunks()
        else:
            lists = pc.split_pattern(texts, " ")
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.combine_chunks()
        bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        index = coded.indices.to_numpy()
        heads = bounds[:-1]
        tail = np.ones(len(index), bool)
        tail[heads] = False
        # a distinct piece is looked up as "spaced" unless it only ever begins a text
        distinct = coded.dictionary.to_pylist()
        used = np.zeros(len(distinct), bool)
        used[index[tail]] = True
        which = np.flatnonzero(used)
        place = np.full(len(distinct), -1, np.int64)
        place[which] = self._places([distinct[i] for i in which], self.spaced, " ")
        places = place[index]
        used = np.unique(index[heads])
        place[used] = self._places([distinct[i] for i in used], self.first, "")
        places[heads] = place[index[heads]]
        start, count, pool = self.start, self.count, self.pool
        if self.late:
            more = np.concatenate([c for _, c in self.late])
            places = np.where(places < -1, len(start) - 2 - places, places)
            start = np.concatenate([start, len(pool) + np.cumsum(more) - more])
            count = np.concatenate([count, more])
            pool = np.concatenate([pool, *[i for i, _ in self.late]])
            self.late = []
        counts = count[places]
        ids = pool[ragged(start[places], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])
        out = ends[bounds]
        if odd.any():  # back to the order of the texts
            back = np.argsort(order)
            lens = np.diff(out)
            ids = ids[ragged(out[:-1][back], lens[back])]
            out = np.concatenate([[0], np.cumsum(lens[back])])
        return ids, out.astype(np.int64)


class TokenizerFile:
    """A byte-level BPE file of the ``tokenizers`` library as a piece encoder."""

    def __init__(self, path: str):
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        spec = json.loads(self.tokenizer.to_str())
        pre = spec["pre_tokenizer"] or {}
        self.byte_level = (pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                           and not spec["normalizer"] and spec["model"]["type"] == "BPE"
                           and all(t["special"] for t in spec["added_tokens"]))
        vocab = self.tokenizer.get_vocab()
        self.size = max(vocab.values()) + 1
        self.bytes_of = np.zeros(self.size, np.int64)  # every character of a byte-level token is one byte
        for token, i in vocab.items():
            self.bytes_of[i] = len(token)
        self.cached = PieceEncoder(self._pieces)

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Many pieces in one call: all that begin with a space form one text, cut up by byte lengths."""
        if not pieces or not pieces[0].startswith(" "):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            return (np.fromiter((i for f in found for i in f), np.uint32),
                    np.fromiter(map(len, found), np.int64, len(found)))
        ids, counts = [], []
        for k in range(0, len(pieces), 20_000):
            part = pieces[k:k + 20_000]
            got = np.array(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.cumsum(np.fromiter((len(p.encode()) for p in part), np.int64, len(part)))
            done = np.cumsum(self.bytes_of[got])
            at = np.searchsorted(done, ends)
            if not np.array_equal(done[at], ends):
                raise ValueError("a token crosses a border between pieces")
            ids.append(got)
            counts.append(np.diff(at + 1, prepend=0))
        return np.concatenate(ids), np.concatenate(counts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of a batch of texts."""
        if self.byte_level:
            return self.cached.encode(texts)
        found = [e.ids for e in self.tokenizer.encode_batch_fast(
            pc.fill_null(texts, "").to_pylist(), add_special_tokens=False)]
        lens = np.fromiter(map(len, found), np.int64, len(found))
        return (np.fromiter((i for f in found for i in f), np.uint32), np.concatenate([[0], np.cumsum(lens)]))


_LOADED: dict[str, TokenizerFile] = {}


def tokenizer_file(path: str) -> TokenizerFile:
    """The tokenizer of a file, loaded once per Python worker with its cache of pieces."""
    if path not in _LOADED:
        _LOADED[path] = TokenizerFile(path)
    return _LOADED[path]


def vocabulary_path(name: str) -> str:
    """The place of one of the installed public vocabularies."""
    import public_tokenizers

    return public_tokenizers.path(name)
