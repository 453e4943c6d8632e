"""Toxic spans by a linear-chain conditional random field (operator 1).

Fitting, on a bounded sample of labelled documents (``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` rows,
taken in the order of a hash; rows with texts over ``MAX_FIT_CHARS`` are not sampled):

1. *Labelled tokens.*  Labels mark documents, not words.  A word form, or the beginning or end
   of one, is taken for toxic if far more toxic than clean documents contain it than chance
   allows (a log-likelihood-ratio test); tokens of toxic documents that carry such a mark are
   the positive tokens.  Near copies among the sampled documents are left out first: they
   would make every rare word of a copied document look significant.
2. *The field.*  Two tags (clean, toxic), emissions from hashed features of the word (form,
   beginnings, endings), four transitions and two start weights, fitted to the tagged tokens
   by gradient ascent on the penalised conditional likelihood; gradients come from
   forward-backward marginals.
3. *The document score.*  A logistic regression on three aggregates of the marginals: the
   largest one, the number of toxic tokens (as a logarithm) and their share.  A token counts
   by how far its marginal is above one half, so that many slight doubts in a long text do
   not add up to a toxic one.

Scoring runs forward-backward over every whole text.  The recursion is a product of 2 × 2
matrices, so a batch of documents is one long chain in which each document's first matrix
forgets what came before; blocks of the chain are multiplied side by side, their products
linked, and the blocks filled in.  That is exact and takes a fixed number of numpy operations
per token.  Tokens whose toxic marginal is at least one half are joined to spans.

Words are lower-cased runs of letters, marks and digits; ``labels``, ``lang``, ``source`` and
``doc_id`` enter no score.  The model (a hashed weight table of fixed size) goes to the
workers as a broadcast; scoring needs no shuffle.

Defined cases: a NULL or empty text, or one without words, gets the score of three zero
aggregates; NULL labels teach nothing; without both labels among the training rows every
document gets the share of toxic ones (0 without any); repeated rows are scored each; an
empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .tokens import byte_slices, ragged

SAMPLE_TOXIC = 1000
SAMPLE_CLEAN = 2000
MAX_FIT_CHARS = 20_000
REJECT_AT = 0.7

TOKEN = re.compile(r"\w+")
BITS = 18            # of the hashed weight table
PREFIXES = (3, 4, 5, 6)
SUFFIXES = (3, 4)
COPY_HASHES = 12     # least hashes of a document's longer words, by which near copies are told
COPY_SHARED = 6
MIN_TOXIC_DOCS = 3   # documents that carry a mark
MAX_CLEAN_RATE = 0.1  # of a mark's document rate among clean documents to that among toxic ones
STEPS = 60
RUN_TOKENS = 50_000   # of the sample, in one call of the recursion
RATE = 0.3
PENALTY = 1e-4
SLICE_BYTES = 1 << 20  # of text scored at once: a worker holds some 40 bytes per byte of it
MAX_WORDS = 200_000  # cached words per worker; beyond it the cache starts anew


def folded(text: str) -> str:
    """The text in lower case, of the same length: a character whose lower case is several keeps its own."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def features(word: str) -> list[str]:
    """Names of a word's features."""
    out = ["w " + word]
    out += ["p " + word[:n] for n in PREFIXES if len(word) > n]
    out += ["s " + word[-n:] for n in SUFFIXES if len(word) > n]
    return out


def _hashed(name: str) -> int:
    return zlib.crc32(name.encode()) & (1 << BITS) - 1


# ---------------------------------------------------------------- the chain


def chain_marginals(toxic: np.ndarray, first: np.ndarray, transitions: np.ndarray, start: np.ndarray,
                    pairs: bool = False):
    """Forward-backward over many documents laid end to end.

    ``toxic`` is each token's emission score of the toxic tag over the clean one, ``first``
    marks first tokens, ``transitions`` and ``start`` are log weights.  Returns the toxic
    marginal of each token and, with ``pairs``, the expected number of each transition.
    """
    n = len(toxic)
    if n == 0:
        return np.zeros(0), np.zeros((2, 2))
    emit = np.exp(np.clip(toxic, -30, 30))
    t = np.exp(transitions)
    s = np.exp(start)
    # step[i][a, b]: weight of tag b at token i after tag a at the token before
    step = np.empty((4, n))
    for k, (a, b) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
        step[k] = np.where(first, s[b], t[a, b])
        if b:
            step[k] *= emit
    length = 64
    blocks = -(-n // length)
    whole = np.empty((4, blocks * length))
    whole[:, :n] = step
    whole[:, n:] = np.array([1.0, 0.0, 0.0, 1.0])[:, None]  # the identity behind the end
    m = whole.reshape(4, blocks, length)
    # product of each block, all blocks side by side
    p = [m[k, :, 0].copy() for k in range(4)]
    for j in range(1, length):
        x = m[:, :, j]
        p = [p[0] * x[0] + p[1] * x[2], p[0] * x[1] + p[1] * x[3], p[2] * x[0] + p[3] * x[2], p[2] * x[1] + p[3] * x[3]]
        scale = 1.0 / (p[0] + p[1] + p[2] + p[3])
        p = [q * scale for q in p]
    # the vector that enters each block from the left, and from the right
    left, right = np.empty((2, blocks)), np.empty((2, blocks))
    a0, a1 = 0.5, 0.5
    rows = list(zip(*[q.tolist() for q in p], strict=True))
    for k, (p0, p1, p2, p3) in enumerate(rows):
        left[0, k], left[1, k] = a0, a1
        a0, a1 = a0 * p0 + a1 * p2, a0 * p1 + a1 * p3
        z = a0 + a1
        a0, a1 = a0 / z, a1 / z
    b0, b1 = 0.5, 0.5
    for k in range(blocks - 1, -1, -1):
        right[0, k], right[1, k] = b0, b1
        p0, p1, p2, p3 = rows[k]
        b0, b1 = p0 * b0 + p1 * b1, p2 * b0 + p3 * b1
        z = b0 + b1
        b0, b1 = b0 / z, b1 / z
    alpha, beta = np.empty((2, blocks, length)), np.empty((2, blocks, length))
    a0, a1 = left
    for j in range(length):
        x = m[:, :, j]
        a0, a1 = a0 * x[0] + a1 * x[2], a0 * x[1] + a1 * x[3]
        z = 1.0 / (a0 + a1)
        a0, a1 = a0 * z, a1 * z
        alpha[0, :, j], alpha[1, :, j] = a0, a1
    b0, b1 = right
    for j in range(length - 1, -1, -1):
        beta[0, :, j], beta[1, :, j] = b0, b1
        x = m[:, :, j]
        b0, b1 = x[0] * b0 + x[1] * b1, x[2] * b0 + x[3] * b1
        z = 1.0 / (b0 + b1)
        b0, b1 = b0 * z, b1 * z
    alpha, beta = alpha.reshape(2, -1)[:, :n], beta.reshape(2, -1)[:, :n]
    both = alpha * beta
    marginal = both[1] / (both[0] + both[1])
    if not pairs:
        return marginal, None
    inner = np.flatnonzero(~first)
    before, after, x = alpha[:, inner - 1], beta[:, inner], step[:, inner]
    joint = np.stack([before[0] * x[0] * after[0], before[0] * x[1] * after[1],
                      before[1] * x[2] * after[0], before[1] * x[3] * after[1]])
    return marginal, (joint / joint.sum(0)).sum(1).reshape(2, 2)


# ---------------------------------------------------------------- fitting


@dataclass
class Model:
    """Weights of the field and of the document score."""

    weights: np.ndarray      # by hashed feature, toxic over clean
    bias: float
    transitions: np.ndarray  # log weights [from, to]
    start: np.ndarray
    document: np.ndarray     # intercept and three aggregate weights
    constant: float | None = None  # the score of every document where there was nothing to learn


def llr(k1, n1, k2, n2):
    """Log-likelihood ratio of two rates k1/n1 and k2/n2."""
    def term(k, n, p):
        p = np.clip(p, 1e-12, 1 - 1e-12)
        return k * np.log(p) + (n - k) * np.log(1 - p)
    p = (k1 + k2) / (n1 + n2)
    return 2 * (term(k1, n1, k1 / n1) + term(k2, n2, k2 / n2) - term(k1, n1, p) - term(k2, n2, p))


def without_copies(word_sets: Iterable[set[str]]) -> list[int]:
    """Indices of the documents that are no near copy of an earlier one."""
    kept: list[int] = []
    holders: dict[int, list[int]] = {}
    for i, words in enumerate(word_sets):
        own = sorted(zlib.crc32(w.encode()) for w in words if len(w) > 5)[:COPY_HASHES]
        least = COPY_SHARED
        if len(own) < COPY_HASHES:  # too few to tell: only an equal set of words is a copy
            own, least = [zlib.crc32(" ".join(sorted(words)).encode())], 1
        shared: dict[int, int] = {}
        for h in own:
            for j in holders.get(h, ()):
                shared[j] = shared.get(j, 0) + 1
        if max(shared.values(), default=0) >= least:
            continue
        kept.append(i)
        for h in own:
            holders.setdefault(h, []).append(i)
    return kept


def toxic_marks(doc_words: list[np.ndarray], labels: np.ndarray, owner: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Whether each feature marks a token as toxic.

    ``doc_words`` holds each document's word numbers; word ``owner[i]`` has feature ``name[i]``, ``owner`` ascending.
    """
    names = int(name.max(initial=-1)) + 1
    first = np.searchsorted(owner, np.arange(int(owner.max(initial=-1)) + 2))
    counts = np.zeros((2, names))
    for words, y in zip(doc_words, labels.tolist(), strict=True):
        words = np.unique(words)
        found = np.unique(name[ragged(first[words], first[words + 1] - first[words])])
        counts[y, found] += 1
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    k0, k1 = counts
    least = 2 * np.log(max(2, names))  # by chance, about one of all candidates gets this far
    return (k1 >= MIN_TOXIC_DOCS) & (k0 / n0 <= MAX_CLEAN_RATE * k1 / n1) & (llr(k1, n1, k0, n0) >= least)


def _name_number(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


def aggregates(marginal: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Largest marginal, log of one plus the toxic tokens, their share; per document."""
    n = np.diff(bounds)
    out = np.zeros((len(n), 3))
    some = np.flatnonzero(n)
    if len(some):
        at = bounds[:-1][some]
        sums = np.add.reduceat(np.maximum(2 * marginal - 1, 0), at)
        out[some, 0] = np.maximum.reduceat(marginal, at)
        out[some, 1] = np.log1p(sums)
        out[some, 2] = sums / n[some]
    return out


def fit(texts: list[str], toxic: list[int]) -> Model:
    """Fit the field and the document score to labelled texts."""
    labels = np.array(toxic, int)
    if len(set(toxic)) < 2:
        return Model(np.zeros(1), 0.0, np.zeros((2, 2)), np.zeros(2), np.zeros(4),
                     float(labels.mean()) if len(labels) else 0.0)
    index: dict[str, int] = {}
    docs: list[np.ndarray] = []

    def word_sets() -> Iterator[set[str]]:
        for t in texts:
            words = TOKEN.findall(folded(t))
            docs.append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.int32, len(words)))
            yield set(words)

    single = without_copies(word_sets())
    docs, labels = [docs[i] for i in single], labels[single]
    n = np.array([len(d) for d in docs])
    # only words of the documents that stay, in the order in which they were met
    held, word = np.unique(np.concatenate([*docs, np.zeros(0, np.int32)]), return_inverse=True)
    word = word.astype(np.int32)
    spelled = list(index)
    spelled = [spelled[i] for i in held.tolist()]
    del index
    bounds = np.concatenate([[0], np.cumsum(n)])
    first = np.zeros(len(word), bool)
    first[bounds[:-1][n > 0]] = True
    # words × features as index arrays: the feature's own number for the marks, its hash for the weights
    sizes = np.fromiter((len(features(w)) for w in spelled), np.int32, len(spelled))
    owner = np.repeat(np.arange(len(spelled), dtype=np.int32), sizes)
    name = np.fromiter((_name_number(f) for w in spelled for f in features(w)), np.uint64, len(owner))
    column = np.fromiter((_hashed(f) for w in spelled for f in features(w)), np.int32, len(owner))
    name = np.unique(name, return_inverse=True)[1].astype(np.int32)
    marks = toxic_marks([word[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], labels, owner, name)
    marked = np.zeros(len(spelled), bool)
    marked[owner[marks[name]]] = True
    del name
    tag = marked[word] & np.repeat(labels == 1, n)
    used, column = np.unique(column, return_inverse=True)
    column = column.astype(np.int32)
    inner = ~first
    observed = np.zeros((2, 2))
    np.add.at(observed, (tag[:-1][inner[1:]].astype(int), tag[1:][inner[1:]].astype(int)), 1)
    opened = np.bincount(tag[first].astype(int), minlength=2)
    positives = np.bincount(word, tag, len(spelled))
    words_n = len(spelled)
    # runs of whole documents of about RUN_TOKENS tokens
    cuts = bounds[np.unique(np.searchsorted(bounds, np.arange(0, bounds[-1] + RUN_TOKENS, RUN_TOKENS)).clip(max=len(n)))]

    def marginals_of(emission, transitions, start):
        """Each token's marginal and the expected transitions, a run at a time."""
        marginal, expected = np.empty(len(word)), np.zeros((2, 2))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            marginal[a:b], part = chain_marginals(emission[word[a:b]], first[a:b], transitions, start, pairs=True)
            expected += part
        return marginal, expected

    weights, bias = np.zeros(len(used)), -4.0
    transitions, start = np.zeros((2, 2)), np.zeros(2)
    sums = [np.full_like(weights, 1e-8), 1e-8, np.full((2, 2), 1e-8), np.full(2, 1e-8)]
    scale = 1.0 / max(1, tag.sum())
    for _ in range(STEPS):  # ascent with per-weight step sizes (AdaGrad)
        emission = bias + np.bincount(owner, weights[column], words_n)
        marginal, expected = marginals_of(emission, transitions, start)
        miss = positives - np.bincount(word, marginal, words_n)
        grads = [scale * np.bincount(column, miss[owner], len(used)) - PENALTY * weights, scale * miss.sum(),
                 scale * (observed - expected) - PENALTY * transitions,
                 scale * (opened - np.array([(1 - marginal[first]).sum(), marginal[first].sum()])) - PENALTY * start]
        sums = [s + g * g for s, g in zip(sums, grads, strict=True)]
        move = [RATE * g / np.sqrt(s) for s, g in zip(sums, grads, strict=True)]
        weights, bias, transitions, start = (weights + move[0], bias + move[1], transitions + move[2], start + move[3])
    table = np.zeros(1 << BITS)
    table[used] = weights
    marginal, _ = marginals_of(bias + np.bincount(owner, weights[column], words_n), transitions, start)
    x = np.hstack([np.ones((len(n), 1)), aggregates(marginal, bounds)])
    return Model(table, float(bias), transitions, start, _logistic(x, labels))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 40, ridge: float = 1e-2) -> np.ndarray:
    """Ridge logistic regression by Newton's method; both classes weigh the same."""
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w = np.zeros(x.shape[1])
    keep = ridge * np.eye(len(w))
    keep[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (y - p)) - keep @ w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + keep
        step = np.linalg.solve(h, g)
        w = w + step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
    return w


# ---------------------------------------------------------------- scoring


class Scorer:
    """A model with its cache of word scores."""

    def __init__(self, model: Model):
        self.model = model
        self.words: dict[str, float] = {}

    def emission(self, word: str) -> float:
        return self.model.bias + float(sum(self.model.weights[_hashed(f)] for f in features(word)))

    def marginals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(marginal of each token, bounds of documents)."""
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        tokens = [TOKEN.findall(folded(t)) for t in texts]
        n = np.fromiter(map(len, tokens), np.int64, len(tokens))
        flat = pa.array([w for t in tokens for w in t], pa.string()).dictionary_encode()
        distinct = flat.dictionary.to_pylist()
        known = self.words
        for w in distinct:
            if w not in known:
                known[w] = self.emission(w)
        scores = np.fromiter(map(known.__getitem__, distinct), float, len(distinct))[flat.indices.to_numpy()]
        bounds = np.concatenate([[0], np.cumsum(n)])
        first = np.zeros(len(scores), bool)
        first[bounds[:-1][n > 0]] = True
        marginal, _ = chain_marginals(scores, first, self.model.transitions, self.model.start)
        return marginal, bounds

    def score(self, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        """(score, toxic spans) of each text; a span is a start and an end in code points."""
        if self.model.constant is not None:
            return np.full(len(texts), self.model.constant), [[] for _ in texts]
        marginal, bounds = self.marginals(texts)
        x = aggregates(marginal, bounds)
        z = self.model.document[0] + x @ self.model.document[1:]
        spans: list[list[tuple[int, int]]] = []
        hot = marginal >= 0.5
        any_hot = np.concatenate([[0], np.cumsum(hot)])
        for i, text in enumerate(texts):
            a, b = int(bounds[i]), int(bounds[i + 1])
            found: list[tuple[int, int]] = []
            if any_hot[b] > any_hot[a]:
                flags, last = hot[a:b], -2
                for k, m in enumerate(TOKEN.finditer(folded(text))):
                    if flags[k]:
                        if last == k - 1:
                            found[-1] = (found[-1][0], m.end())
                        else:
                            found.append(m.span())
                        last = k
            spans.append(found)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), spans


_SCORERS: dict[int, Scorer] = {}


def scorer(model: Model) -> Scorer:
    """The scorer of a model, kept while the worker lives (the latest model only)."""
    if id(model) not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[id(model)] = Scorer(model)
    return _SCORERS[id(model)]


def held_out(doc_id: Column) -> Column:
    """True for the third of the documents that nothing is learnt from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, sample_toxic: int = SAMPLE_TOXIC,
                    sample_clean: int = SAMPLE_CLEAN) -> DataFrame:
    """(doc_id, text, toxic) of a bounded sample of labelled documents that are not held out.

    Only ids with a text short enough are drawn, and each gives one row (its least such text).
    """
    fits = docs.where(F.length("text") <= MAX_FIT_CHARS).select("doc_id", "text")
    known = (labels.select("doc_id", "toxic").where(F.col("toxic").isin(0, 1))
             .where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = materialize(known.join(fits.select("doc_id").distinct(), "doc_id", "left_semi"), "toxicity-known")
    order = F.xxhash64("doc_id")
    chosen = None
    for y, k in ((1, sample_toxic), (0, sample_clean)):
        part = known.where(F.col("toxic") == y).orderBy(order, "doc_id").limit(k)
        chosen = part if chosen is None else chosen.unionByName(part)
    return (fits.join(F.broadcast(chosen), "doc_id")  # at most the two sample sizes
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the driver: the sample is bounded in rows and characters."""
    rows = training_sample(docs, labels).orderBy("doc_id").collect()
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows])


def score_documents(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """(_doc, score, toxic_spans) of every document; ``_doc`` holds the columns ``keep``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scorer(shared.value)
        for batch in batches:
            text = pc.struct_field(batch["_doc"], "text")
            for a, b in byte_slices(text, SLICE_BYTES):
                part = batch["_doc"].slice(a, b - a)
                scores, spans = s.score(pc.fill_null(text[a:b], "").to_pylist())
                rest = pa.StructArray.from_arrays([pc.struct_field(part, c) for c in keep], names=keep)
                yield pa.RecordBatch.from_arrays(
                    [rest, pa.array(scores, pa.float64()),
                     pa.array([";".join(f"{x}:{y}" for x, y in f) for f in spans], pa.string())],
                    names=["_doc", "score", "toxic_spans"])
        s.words.clear()  # the worker may go on to other stages
        pa.default_memory_pool().release_unused()

    columns = list(dict.fromkeys([*keep, "text"]))
    kept = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in keep])
    out = T.StructType([T.StructField("_doc", kept), T.StructField("score", T.DoubleType()),
                        T.StructField("toxic_spans", T.StringType())])
    return docs.select(F.struct(*columns).alias("_doc")).mapInArrow(run, out)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, toxic_spans) of every document."""
    scored = score_documents(docs, learn(docs, labels), ["doc_id"])
    return scored.select("_doc.doc_id", held_out(F.col("_doc.doc_id")).alias("held_out"), "score",
                         (F.col("score") >= REJECT_AT).cast("int").alias("predicted"), "toxic_spans")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents under the rejection score, with their own columns."""
    return score_documents(docs, learn(docs, labels), docs.columns).where(F.col("score") < REJECT_AT).select("_doc.*")
