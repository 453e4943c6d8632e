"""Operators 6, 7 and 8 against the tokenizer libraries, and exact round trips."""

import collections
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from adsphere.llm import bpe_codec, packing, token_output, tokens
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

PATH = tokens.vocabulary_path("byte_bpe_50k.json")
RANKS = tokens.vocabulary_path("byte_bpe_multi_50k.tiktoken")
TEXT = st.text(alphabet=st.sampled_from(list("ab1 .,'\n\t  \x1cé日'st")), max_size=30)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_codec.read_ranks(RANKS),
                             special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_pieces_encode_as_the_libraries_do(texts):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    ids, b = tokens.tokenizer_file(PATH).encode(pa.array(texts))
    assert [ids[i:j].tolist() for i, j in zip(b[:-1], b[1:], strict=True)] == [
        t.encode(x, add_special_tokens=False).ids for x in texts]
    c = bpe_codec.codec(RANKS, public_tokenizers.PATTERN)
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    ids, b = c.encode(pa.array(texts))
    for i, x in enumerate(texts):
        own = ids[b[i]:b[i + 1]]
        assert own.tolist() == e.encode_ordinary(x) and c.decode(own) == x.encode()


def test_special_strings_are_ordinary_text(library):
    texts = ["<|endoftext|> a <|endoftext|>", None, ""]
    ids, b = tokens.tokenizer_file(PATH).encode(pa.array(texts))
    assert [ids[i:j].tolist() for i, j in zip(b[:-1], b[1:], strict=True)] == [library(t) for t in texts]


def test_cache_may_be_emptied(monkeypatch, library):
    monkeypatch.setattr(tokens, "MAX_CACHED", 3)
    t = tokens.TokenizerFile(PATH)
    for text in ("one two three four five", "one six seven", "one two"):
        assert t.encode(pa.array([text]))[0].tolist() == library(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=9), min_size=1, max_size=6))
def test_ranks_round_trip(runs):
    n = np.array([len(r) for r in runs])
    flat = np.array([x for r in runs for x in r], np.uint32)
    control, cb, data, db = token_output.pack_ranks(flat, np.concatenate([[0], np.cumsum(n)]))
    assert np.array_equal(token_output.unpack_ranks(control, data, n), flat)
    assert len(control) == sum(-(-k // 4) for k in n) and db[-1] == len(data)


def check_token_files(docs, library, monkeypatch):
    monkeypatch.setattr(token_output, "FILE_IDS", 20_000)
    rows = token_output.token_files_report(docs).collect()
    want, start = [], 0
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        ids = np.array([*library(r.text), 2], "<u4")
        want.append((r.doc_id, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    key = lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])
    assert sorted(want, key=key) == sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in rows], key=key)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert at == start
    ids = [r.doc_id for r in sorted(rows, key=lambda r: r.start) if r.doc_id is not None]
    assert ids == sorted(ids)


def test_token_files(small, edge_docs, no_docs, library, monkeypatch):
    check_token_files(small("documents"), library, monkeypatch)
    check_token_files(edge_docs, library, monkeypatch)
    assert token_output.token_files_report(no_docs).count() == 0


def test_codec_digests(small, edge_docs, no_docs, tik):
    for docs in (small("documents"), edge_docs):
        want = collections.Counter()
        for r in docs.collect():
            ids = np.array(tik.encode_ordinary(r.text or ""), "<u4")
            want[r.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                 hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
        assert want == collections.Counter(map(tuple, bpe_codec.codec_report(docs).collect()))
    assert bpe_codec.codec_report(no_docs).count() == 0
    full = bpe_codec.encode_documents(small("documents"), RANKS).first()
    assert tik.decode(np.frombuffer(full.ids, "<u4").tolist()).encode() == bytes(full.decoded)


def test_another_pattern_is_matched_per_text(tik):
    c = bpe_codec.Codec(RANKS, r"\S+|\s+")
    e = tiktoken.Encoding("other", pat_str=r"\S+|\s+", mergeable_ranks=c.ranks, special_tokens={})
    ids, _ = c.encode(pa.array(["it's  a\n test"]))
    assert ids.tolist() == e.encode_ordinary("it's  a\n test")


def check_packing(docs, library, **options):
    path = PATH
    rows = packing.pack_pieces(packing.cut_documents(docs, path), **options).collect()
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id].append(r)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= packing.CAPACITY
    want = collections.Counter()
    for r in docs.collect():
        ids = np.array([*library(r.text), 0], "<u4")
        first = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            want[r.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert want == collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    return len(sequences), sum(r.length for r in rows)


def test_packing(small, edge_docs, no_docs, library):
    n, total = check_packing(small("documents"), library)
    assert n <= 1.02 * total / 2048 + 1
    check_packing(edge_docs, library)
    check_packing(small("documents"), library, group_rows=7)  # many groups: documents are exchanged
    assert packing.pack_documents(no_docs).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=9))
def test_bounds_and_bins(lengths):
    """bound ≤ optimum ≤ best fit, by trying all packings."""
    capacity, x = 30, np.array(lengths)

    def optimum(left, bins):
        if not left:
            return len(bins)
        best, seen = len(bins) + len(left), set()
        for i, room in enumerate(bins):
            if room >= left[0] and room not in seen:
                seen.add(room)
                best = min(best, optimum(left[1:], [*bins[:i], room - left[0], *bins[i + 1:]]))
        return min(best, optimum(left[1:], [*bins, capacity - left[0]]))

    bins, offsets, room = packing.best_fit_decreasing(x, capacity)
    for b in range(bins.max() + 1):
        own = np.flatnonzero(bins == b)
        own = own[np.argsort(offsets[own])]
        assert (np.cumsum(x[own]) - x[own] == offsets[own]).all() and x[own].sum() + room[own[0]] == capacity
    bound = packing.lower_bound(np.bincount(x, minlength=capacity + 1), capacity)
    assert bound <= optimum(sorted(lengths, reverse=True), []) <= bins.max() + 1


def test_long_pieces_leave_nothing_behind():
    """Texts without spaces: their pieces are encoded per batch, the pool stays as it was."""
    import random

    import pyarrow as pa
    from adsphere.llm import tokens
    t = tokens.TokenizerFile(tokens.vocabulary_path("byte_bpe_50k.json"))
    r = random.Random(4)
    pool = None
    for _ in range(100):
        texts = ["short words here " + "".join(r.choice("的一是不了人我在有他abcXYZ09+/=") for _ in range(300)) + " " + "q" * 90
                 for _ in range(4)]
        ids, bounds = t.encode(pa.array(texts))
        for i, text in enumerate(texts):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == t.tokenizer.encode(text, add_special_tokens=False).ids
        pool = pool or len(t.cached.pool)
    assert len(t.cached.pool) == pool and not t.cached.late
