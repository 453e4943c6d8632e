"""Document quality by a generalised additive model with pairwise interactions (operator 13).

A document becomes some thirty numbers (:data:`FEATURES`: lengths, shares of character classes,
repeated words, windows and lines), computed over its whole text in numpy.  The model is a sum of
lookup tables: one per feature over its quantile bins, and one per chosen pair of features over a
coarser grid.  Scoring finds each value's bin and adds table cells, for a whole batch at once; the
sum is the logarithm of the odds of label 1.

Fitting, on a bounded sample (``SAMPLE_GOOD`` and ``SAMPLE_BAD`` documents, in the order of a hash):

1. *Main effects.*  Rounds of cyclic boosting: feature after feature gets one shallow tree (up to
   four leaves) over its bins, fitted to the loss's gradient and curvature, and the tree's leaves
   are added to the feature's table with a small step.
2. *Pairs.*  Of all pairs those are chosen whose best cut into four quadrants lowers the remaining
   loss most; pair after pair then gets trees with one cut in one feature and one in the other in
   each half.
3. Rounds end where the loss on a fifth of the sample, kept back, no longer falls.  The intercept is
   moved by the two labels' true frequencies, which are counted over all labelled documents.

Labels, ``lang``, ``source`` and ``doc_id`` enter no score.  Only features of the sample reach the
driver, no texts.  The model (tables of a few thousand cells) goes to the workers as a broadcast;
scoring needs no shuffle and holds about ``SLICE_BYTES`` of text, or one longer text, at a time.

Defined cases: a NULL or empty text, or one without words, has all features 0 and the score that
gives; NULL labels, labels other than 0 and 1, and ids with both labels teach nothing; without both
labels among the training rows every document gets the share of label 1 (0 without any); of a
repeated ``doc_id`` one row is learnt from, and each row is scored; ties have equal scores; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tokens import byte_slices

SAMPLE_GOOD = 6000
SAMPLE_BAD = 4000
PREDICT_AT = 0.7
SLICE_BYTES = 1 << 20

BINS = 32          # of a feature
PAIR_BINS = 8      # of a feature in a pair
PAIRS = 10
ROUNDS = 300       # at most
PAIR_ROUNDS = 150  # at most
PATIENCE = 25      # rounds without a lower loss on the rows kept back
STEP = 0.1
RIDGE = 1.0        # added to a leaf's curvature
MIN_LEAF = 10      # rows

# ---------------------------------------------------------------- features

SYMBOLS = b"#*$%&|<>"
LOWER, UPPER, DIGIT, BLANK, SYMBOL, SENTENCE, MARK, HIGH, FOLLOW = range(9)
FEATURES = ("words", "word length", "word length deviation", "longest word", "upper", "digit", "blank", "symbol",
            "sentence end", "mark", "non-ascii", "characters", "capitalised words", "shouted words",
            "words with a symbol", "words with a digit", "single-letter words", "ended words", "distinct words",
            "top word", "word after itself", "distinct pairs", "distinct windows", "lines", "words in a line",
            "repeated lines", "longest line", "entropy", "clauses")


def _classes() -> np.ndarray:
    out = np.full(256, MARK, np.uint8)
    out[ord("a"):ord("z") + 1] = LOWER
    out[ord("A"):ord("Z") + 1] = UPPER
    out[ord("0"):ord("9") + 1] = DIGIT
    out[[32, *range(9, 14)]] = BLANK
    out[list(SYMBOLS)] = SYMBOL
    out[list(b".!?")] = SENTENCE
    out[128:192] = FOLLOW  # the further bytes of a character
    out[192:] = HIGH
    return out


CLASS = _classes()
_RNG = np.random.default_rng(20240213)
BYTE_HASH = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
PLACE_HASH = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)


def _per_doc(doc: np.ndarray, n: int, values=None) -> np.ndarray:
    return np.bincount(doc, values, n).astype(float)


def _distinct(doc: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct hashes of each document, rows of its most frequent one)."""
    key = (doc.astype(np.uint64) << np.uint64(40)) | (hashes * MIX >> np.uint64(24))
    one, counts = np.unique(key, return_counts=True)
    owner = (one >> np.uint64(40)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, owner, counts)
    return _per_doc(owner, n), most


def _windows(doc: np.ndarray, hashes: np.ndarray, size: int, n: int) -> np.ndarray:
    """Distinct runs of ``size`` words over all of them, per document (1 without any)."""
    if len(doc) < size:
        return np.ones(n)
    h = np.zeros(len(doc) - size + 1, np.uint64)
    for k in range(size):
        h = h * MIX + hashes[k:len(hashes) - size + 1 + k]
    inside = doc[:len(h)] == doc[size - 1:]
    own = doc[:len(h)][inside]
    total = _per_doc(own, n)
    return np.where(total > 0, _distinct(own, h[inside], n)[0] / np.maximum(total, 1), 1.0)


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Documents × :data:`FEATURES` of UTF-8 texts that lie end to end in ``data``."""
    n = len(bounds) - 1
    out = np.zeros((n, len(FEATURES)))
    kind = CLASS[data]
    owner = np.repeat(np.arange(n), np.diff(bounds))
    counts = np.bincount(owner * 9 + kind, minlength=9 * n).reshape(n, 9).astype(float)
    spelled = np.bincount(owner * 256 + data, minlength=256 * n).reshape(n, 256)
    dark = kind != BLANK
    begin = dark.copy()
    begin[1:] &= ~dark[:-1]
    heads = bounds[:-1][np.diff(bounds) > 0]
    begin[heads] |= dark[heads]
    starts = np.flatnonzero(begin)
    if not len(starts):
        return out
    place = np.arange(len(data)) - starts[np.cumsum(begin) - 1]
    hashes = np.add.reduceat(np.where(dark, BYTE_HASH[data] * PLACE_HASH[place & 63], np.uint64(0)), starts)
    size = np.add.reduceat(dark & (kind != FOLLOW), starts).astype(float)
    doc = owner[starts]

    def within(*kinds):
        return np.add.reduceat(np.isin(kind, kinds), starts)

    words = _per_doc(doc, n)
    some = words > 0
    per_word = 1.0 / np.maximum(words, 1)
    length = _per_doc(doc, n, size) * per_word
    longest = np.zeros(n)
    np.maximum.at(longest, doc, size)
    chars = counts.sum(1) - counts[:, FOLLOW]
    per_char = 1.0 / np.maximum(chars, 1)
    letters = counts[:, LOWER] + counts[:, UPPER] + counts[:, HIGH]
    first, low, up = kind[starts], within(LOWER), within(UPPER)
    last = np.minimum(starts + np.add.reduceat(dark, starts), len(data)) - 1
    distinct, most = _distinct(doc, hashes, n)
    again = np.zeros(len(doc), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    # lines: runs of words without a line feed between them
    line = np.cumsum(data == 10)[starts]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    rows = np.flatnonzero(fresh)
    number = np.cumsum(fresh) - 1
    step = np.arange(len(doc)) - rows[number]
    line_hash = np.add.reduceat(hashes * PLACE_HASH[step & 63], rows)
    line_words = np.diff([*rows, len(doc)]).astype(float)
    line_doc = doc[rows]
    lines = _per_doc(line_doc, n)
    long_line = np.zeros(n)
    np.maximum.at(long_line, line_doc, line_words)
    share = spelled * (1.0 / np.maximum(spelled.sum(1), 1))[:, None]
    columns = {
        "words": np.log1p(words), "word length": length,
        "word length deviation": np.sqrt(np.maximum(_per_doc(doc, n, size * size) * per_word - length * length, 0)),
        "longest word": np.log1p(longest), "upper": counts[:, UPPER] / np.maximum(letters, 1),
        "digit": counts[:, DIGIT] * per_char, "blank": counts[:, BLANK] * per_char, "symbol": counts[:, SYMBOL] * per_char,
        "sentence end": counts[:, SENTENCE] * per_word, "mark": counts[:, MARK] * per_char,
        "non-ascii": counts[:, HIGH] * per_char, "characters": np.log1p(chars),
        "capitalised words": _per_doc(doc, n, (first == UPPER) & (low > 0)) * per_word,
        "shouted words": _per_doc(doc, n, (up > 0) & (low == 0) & (size > 1)) * per_word,
        "words with a symbol": _per_doc(doc, n, within(SYMBOL) > 0) * per_word,
        "words with a digit": _per_doc(doc, n, within(DIGIT) > 0) * per_word,
        "single-letter words": _per_doc(doc, n, size == 1) * per_word,
        "ended words": _per_doc(doc, n, kind[last] == SENTENCE) * per_word,
        "distinct words": distinct * per_word, "top word": most * per_word,
        "word after itself": _per_doc(doc, n, again) * per_word,
        "distinct pairs": _windows(doc, hashes, 2, n), "distinct windows": _windows(doc, hashes, 5, n),
        "lines": np.log1p(lines), "words in a line": np.log1p(words / np.maximum(lines, 1)),
        "repeated lines": 1 - _distinct(line_doc, line_hash, n)[0] / np.maximum(lines, 1),
        "longest line": np.log1p(long_line),
        "entropy": -(share * np.log2(np.where(share > 0, share, 1))).sum(1),
        "clauses": spelled[:, ord(",")] * per_word,
    }
    for k, name in enumerate(FEATURES):
        out[:, k] = np.where(some, columns[name], 0.0)
    return out


# ---------------------------------------------------------------- the model


@dataclass
class Model:
    """Lookup tables over bins; the sum of a document's cells is its log odds."""

    cuts: list[np.ndarray] = field(default_factory=list)          # by feature, between bins
    tables: list[np.ndarray] = field(default_factory=list)        # by feature
    pair_cuts: list[np.ndarray] = field(default_factory=list)     # by feature, coarser
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    intercept: float = 0.0
    constant: float | None = None  # the score of every document where there was nothing to learn

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores by bin additions."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        total = np.full(len(x), self.intercept)
        for k, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, x[:, k], "right")]
        coarse = {k: np.searchsorted(self.pair_cuts[k], x[:, k], "right") for k in {i for p in self.pairs for i in p}}
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def quantile_cuts(x: np.ndarray, bins: int) -> np.ndarray:
    """Borders between bins of about equal numbers of rows, halfway between values that occur."""
    values = np.unique(x)
    if len(values) <= bins:
        return (values[1:] + values[:-1]) / 2
    at = np.unique(np.quantile(x, np.arange(1, bins) / bins, method="lower"))
    return at[at > values[0]]


def _gain(g, h):
    return g * g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray, c: np.ndarray, lo: int, hi: int) -> tuple[float, int]:
    """(gain, border) of the best cut of the bins ``lo`` to ``hi``; border 0 where none is allowed."""
    if hi - lo < 2:
        return 0.0, 0
    gs, hs, cs = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi]), np.cumsum(c[lo:hi])
    gain = _gain(gs[:-1], hs[:-1]) + _gain(gs[-1] - gs[:-1], hs[-1] - hs[:-1]) - _gain(gs[-1], hs[-1])
    gain = np.where((cs[:-1] >= MIN_LEAF) & (cs[-1] - cs[:-1] >= MIN_LEAF), gain, 0.0)
    k = int(np.argmax(gain))
    return (float(gain[k]), lo + k + 1) if gain[k] > 0 else (0.0, 0)


def line_tree(g: np.ndarray, h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The leaf values, by bin, of a tree of two levels over gradient, curvature and row sums of bins."""
    ends = [0, len(g)]
    for _ in range(2):
        cuts = [_best_cut(g, h, c, lo, hi)[1] for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
        ends = sorted({*ends, *(x for x in cuts if x)})
    lows = np.array(ends[:-1])
    return np.repeat(np.add.reduceat(g, lows) / (np.add.reduceat(h, lows) + RIDGE), np.diff(ends))


def grid_tree(g: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, leaf values) of the best tree with one cut in one feature and one of the other in each half."""
    best, table = 0.0, np.zeros_like(g)
    for flip in (False, True):
        gg, hh, cc = (x.T if flip else x for x in (g, h, c))
        for cut in range(1, gg.shape[0]):
            gain, cells = 0.0, np.zeros_like(gg)
            for part in (slice(0, cut), slice(cut, None)):
                gs, hs, cs = gg[part].sum(0), hh[part].sum(0), cc[part].sum(0)
                if cs.sum() < MIN_LEAF:
                    break
                k = _best_cut(gs, hs, cs, 0, len(gs))[1]
                for side in ((slice(0, k), slice(k, None)) if k else (slice(None),)):
                    gain += _gain(gs[side].sum(), hs[side].sum())
                    cells[part, side] = gs[side].sum() / (hs[side].sum() + RIDGE)
            else:
                if gain > best:
                    best, table = gain, cells.T if flip else cells
    return best - _gain(g.sum(), h.sum()), table


def fit(x: np.ndarray, y: np.ndarray, frequency: float | None = None) -> Model:
    """The model of features ``x`` and labels ``y``; ``frequency`` is that of label 1 among all rows."""
    if len(set(y.tolist())) < 2:
        return Model(constant=float(y.mean()) if len(y) else 0.0)
    kept = np.arange(len(y)) % 5 == 4  # rows come in the order of a hash
    if len(set(y[~kept].tolist())) < 2:
        kept[:] = False
    used = ~kept
    m = Model(cuts=[quantile_cuts(x[used, k], BINS) for k in range(x.shape[1])],
              pair_cuts=[quantile_cuts(x[used, k], PAIR_BINS) for k in range(x.shape[1])])
    bins = [np.searchsorted(c, x[:, k], "right") for k, c in enumerate(m.cuts)]
    coarse = [np.searchsorted(c, x[:, k], "right") for k, c in enumerate(m.pair_cuts)]
    m.tables = [np.zeros(len(c) + 1) for c in m.cuts]
    start = np.log(y[used].sum() / (1 - y[used]).sum())
    total = np.full(len(y), start)

    def slopes():
        p = 1 / (1 + np.exp(-total[used]))
        return y[used] - p, p * (1 - p)

    def loss():
        rows = kept if kept.any() else used
        return float(np.logaddexp(0, np.where(y[rows] == 1, -total[rows], total[rows])).mean())

    def boost(rounds, one_round, tables):
        """Rounds until the loss on the rows kept back no longer falls; the best round's tables stay."""
        nonlocal total
        best, since, saved = loss(), 0, ([t.copy() for t in tables], total.copy())
        for _ in range(rounds):
            one_round()
            now = loss()
            if now < best - 1e-6:
                best, since, saved = now, 0, ([t.copy() for t in tables], total.copy())
            elif (since := since + 1) >= PATIENCE:
                break
        for t, s in zip(tables, saved[0], strict=True):
            t[:] = s
        total = saved[1]

    own = [b[used] for b in bins]

    def main_round():
        for k, table in enumerate(m.tables):
            if len(table) < 2:
                continue
            g, h = slopes()
            sums = [np.bincount(own[k], v, len(table)) for v in (g, h, None)]
            leaf = STEP * line_tree(*sums)
            table += leaf
            total[:] += leaf[bins[k]]

    boost(ROUNDS, main_round, m.tables)

    def grid(a, b, g, h):
        shape = (len(m.pair_cuts[a]) + 1, len(m.pair_cuts[b]) + 1)
        cell = coarse[a][used] * shape[1] + coarse[b][used]
        return [np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h, None)]

    g, h = slopes()
    many = [k for k, c in enumerate(m.pair_cuts) if len(c)]
    gains = [(grid_tree(*grid(a, b, g, h))[0], a, b) for a, b in combinations(many, 2)]
    m.pairs = [(a, b) for gain, a, b in sorted(gains, key=lambda t: (-t[0], t[1], t[2]))[:PAIRS] if gain > 0]
    m.pair_tables = [np.zeros((len(m.pair_cuts[a]) + 1, len(m.pair_cuts[b]) + 1)) for a, b in m.pairs]

    def pair_round():
        for (a, b), table in zip(m.pairs, m.pair_tables, strict=True):
            g, h = slopes()
            leaf = STEP * grid_tree(*grid(a, b, g, h))[1]
            table += leaf
            total[:] += leaf[coarse[a], coarse[b]]

    if m.pairs:
        boost(PAIR_ROUNDS, pair_round, m.pair_tables)
    m.intercept = float(start)
    if frequency is not None:  # the sample has its own share of label 1
        m.intercept += float(np.log(frequency / (1 - frequency)) - np.log(y.mean() / (1 - y.mean())))
    return m


# ---------------------------------------------------------------- on Spark


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the documents that nothing is learnt from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def batch_features(texts: pa.Array) -> np.ndarray:
    """Features of a batch of texts, a slice of about ``SLICE_BYTES`` at a time."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    out = []
    for a, b in byte_slices(texts, SLICE_BYTES):
        part = texts[a:b]
        sizes = pc.binary_length(part).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        first = np.frombuffer(part.buffers()[1], np.int64)[part.offset]
        held = part.buffers()[2]
        data = np.frombuffer(held, np.uint8)[first:first + bounds[-1]] if held is not None else np.zeros(0, np.uint8)
        out.append(features(data, bounds))
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))


def training_sample(docs: DataFrame, labels: DataFrame, good: int = SAMPLE_GOOD,
                    bad: int = SAMPLE_BAD) -> tuple[DataFrame, DataFrame]:
    """((doc_id, y, x) of a bounded sample of labelled documents that are not held out, (y, n) of all such)."""
    known = (labels.select("doc_id", F.col("quality").alias("y")).where(F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("_max")).where("y = _max").drop("_max"))
    known = materialize(known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "quality-known")
    order = F.xxhash64("doc_id")
    chosen = None
    for y, k in ((1, good), (0, bad)):
        part = known.where(F.col("y") == y).orderBy(order, "doc_id").limit(k)
        chosen = part if chosen is None else chosen.unionByName(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch_features(batch["text"])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["y"], pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    # at most the two sample sizes go out
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")
    seen = rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                                f"y {known.schema['y'].dataType.simpleString()}, x array<double>")
    one = seen.groupBy("doc_id").agg(F.min("y").alias("y"), F.min("x").alias("x"))
    return one.orderBy(order, "doc_id"), known.groupBy("y").agg(F.count(F.lit(1)).alias("n"))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the driver: the sample is bounded, and only its features come there."""
    sample, counts = training_sample(docs, labels)
    rows = sample.collect()
    n = {r["y"]: r["n"] for r in counts.collect()}
    frequency = n.get(1, 0) / sum(n.values()) if n.get(0) and n.get(1) else None
    x = np.array([r["x"] for r in rows]).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["y"] for r in rows], int), frequency)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand table cells

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score(batch_features(batch["text"]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    scored = score_documents(docs, learn(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))
