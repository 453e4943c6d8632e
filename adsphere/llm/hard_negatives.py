"""Hard negatives by threshold joins over norm-bounded inverted indexes (operator 11).

An anchor's *positives* are the best rows of its own label, its *negatives* the best rows of other
labels whose score lies in a window set by a positive's score.  Both are searches for the first
``k`` rows of a window, ``lower <= score <= upper``, and both run as threshold joins in the manner
of L2AP (Anastasiu and Karypis, 2014):

1. Rows are packed into blocks of ``BLOCK`` rows, anchors into blocks of ``ANCHORS``.
2. A pair of blocks is joined at the thresholds of its anchors.  The rows' inverted index is a run
   of rows per group of ``GROUP`` dimensions; a row drops out of the index at the first group from
   which on its suffix norm, times that of the longest anchor suffix, stays under all thresholds.
   Partial scores are accumulated group by group, a pair is pruned once its partial score and the
   product of the two remaining norms stay under the anchor's threshold, and the few pairs left are
   finished one by one with the dimensions that the index omits.
3. A task keeps the first ``k`` rows of each window and raises the window's threshold to the
   ``k``-th one's score, so that later blocks are pruned harder.
4. Thresholds start where a bounded sample of rows (``SAMPLE``) suggests that ``OVERSHOOT * k`` rows
   lie above.  Windows that do not fill are searched again with lower thresholds, the third time
   down to ``lower`` itself.  A window that is full, or was searched to its lower end, is exact, so
   the sample decides on time only.

A row's components are ``floor(256 * x)``; scores are integer inner products, exact in doubles below
2 ** 53 and computed in 64-bit integers where norms could exceed that.

Scale: the rows are read once per group of anchor blocks and never shuffled.  Anchors are the stated
set of rows (one in ``ANCHOR_EVERY``); they go out as broadcasts of at most ``GROUP_BYTES`` each, one
after the other, however many there are.  A task returns at most ``k`` rows per window, which a
window function per anchor merges.  A hot label or vector makes no difference: blocks are cut by
number of rows, not by label.

Defined cases: rows with a NULL ``vec_id``, label or vector, or any NULL or non-finite component,
take no part; a vector shorter than another counts as if it ended in zeros, an empty one scores 0;
components beyond ``±2 ** 24`` after the factor enter as that; rows with the anchor's ``vec_id`` are
not its positives; rows that repeat a ``vec_id`` are rows of their own, as anchors too; ties go to
the smaller ``vec_id``; a negative positive-score has an empty window; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

POSITIVES = 5
NEGATIVES = 10
LOWEST, HIGHEST = 30, 90       # percent of the positive's score
ANCHOR_EVERY = 100
SCALE = 256
CLAMP = 1 << 24

BLOCK = 2048
ANCHORS = 512
GROUP = 8                      # dimensions
GROUP_BYTES = 16 << 20
SAMPLE = 2048
OVERSHOOT = 4
WIDER = 8                      # the factor by which a further round looks deeper into the sample
ROUNDS = 3
FEW = 0.02                     # share of live pairs from which they are finished one by one
HELD = 100_000                 # candidates a task holds for a block of anchors before it cuts them down

FAR = 1 << 62


# ---------------------------------------------------------------- rows


def items(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vec) of the rows that take part, with scaled components and moved labels."""
    x = F.col("embedding")
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    scaled = F.transform(x, lambda v: F.greatest(F.least(F.floor(v.cast("double") * SCALE).cast("double"), F.lit(float(CLAMP))),
                                                 F.lit(-float(CLAMP))).cast("int"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return vectors.where(whole & ~F.coalesce(odd, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), scaled.alias("vec"))


BLOCK_SCHEMA = "n int, dim int, ids binary, labels binary, vecs binary"


def matrix(lists: pa.ListArray) -> np.ndarray:
    """Lists of integers as rows of one matrix, padded with zeros."""
    sizes = lists.value_lengths().to_numpy()
    dim = int(sizes.max(initial=0))
    out = np.zeros((len(sizes), dim), np.int32)
    if dim:
        out[np.arange(dim) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def as_list(column) -> pa.ListArray:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def row_blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows packed into blocks of at most ``size``, as they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), size):
                part = batch.slice(k, size)
                vecs = matrix(as_list(part["vec"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(part)], pa.int32()), pa.array([vecs.shape[1]], pa.int32()),
                     pa.array([part["vec_id"].to_numpy().tobytes()]), pa.array([part["label"].to_numpy().tobytes()]),
                     pa.array([vecs.tobytes()])], names=["n", "dim", "ids", "labels", "vecs"])

    return rows.select("vec_id", "label", "vec").mapInArrow(run, BLOCK_SCHEMA)


# ---------------------------------------------------------------- the threshold join of two blocks


def suffix_norms(x: np.ndarray) -> np.ndarray:
    """Norms of each row's dimensions from every group's start on; rounded up."""
    starts = np.arange(0, x.shape[1], GROUP)
    squares = np.add.reduceat(x * x, starts, axis=1) if len(starts) else np.zeros((len(x), 0))
    out = np.zeros((len(x), len(starts) + 1))
    out[:, :-1] = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1])
    return out * (1 + 1e-9)


def threshold_pairs(q: np.ndarray, x: np.ndarray, tau: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all pairs whose inner product reaches the anchor's ``tau``.

    ``q`` and ``x`` hold integers as doubles, ``tau`` integers or minus infinity.
    """
    none = np.zeros(0, np.int64)
    if not len(q) or not len(x):
        return none, none, none
    dim = max(q.shape[1], x.shape[1])
    q, x = (np.pad(m, ((0, 0), (0, dim - m.shape[1]))) if m.shape[1] < dim else m for m in (q, x))
    qn, xn = suffix_norms(q), suffix_norms(x)
    if qn[:, 0].max() * xn[:, 0].max() >= 2.0 ** 52:  # beyond exact doubles
        scores = q.astype(np.int64) @ x.astype(np.int64).T
        a, b = np.nonzero(scores >= np.maximum(tau, -float(FAR)).astype(np.int64)[:, None])
        return a, b, scores[a, b]
    least = tau - 0.5  # scores are integers
    groups = qn.shape[1] - 1
    # the index: a row's groups end where what is left cannot matter to any anchor
    covered = xn * qn.max(0) < least.min()
    depth = np.where(covered.any(1), covered.argmax(1), groups)
    rows = np.argsort(-depth, kind="stable")
    depth = depth[rows]
    if groups or least.min() > 0:
        rows = rows[depth > 0]
    if not len(rows):
        return none, none, none
    depth = depth[:len(rows)]
    anchors = np.arange(len(q))
    part, live = np.zeros((len(q), len(rows))), np.ones((len(q), len(rows)), bool)
    xt = x[rows]
    pairs = None
    for g in range(groups):
        n = int((depth > g).sum())  # the rows in this group's lists stand first
        if not n:
            break
        cut = slice(g * GROUP, (g + 1) * GROUP)
        part[:, :n] += q[anchors, cut] @ xt[:n, cut].T
        live[:, :n] &= part[:, :n] + np.outer(qn[anchors, g + 1], xn[rows[:n], g + 1]) >= least[anchors][:, None]
        if live.mean() < FEW:
            a, b = np.nonzero(live)
            pairs, at = (anchors[a], b, part[a, b]), np.minimum(g + 1, depth)[b]
            break
        some, keep = live.any(1), live.any(0)
        if some.mean() < 0.8 or keep.mean() < 0.8:
            part, live, anchors = part[np.ix_(some, keep)], live[np.ix_(some, keep)], anchors[some]
            rows, depth, xt = rows[keep], depth[keep], xt[keep]
    if pairs is None:
        a, b = np.nonzero(live)
        pairs, at = (anchors[a], b, part[a, b]), depth[b]
    a, b, score = pairs
    # what the lists do not hold, or the loop did not reach, for the pairs left
    for g in range(groups):
        late = np.flatnonzero(at <= g)
        if len(late):
            cut = slice(g * GROUP, (g + 1) * GROUP)
            score[late] += np.einsum("ij,ij->i", q[a[late], cut], xt[b[late], cut])
            rest = score + qn[a, g + 1] * xn[rows[b], g + 1]
            fit = (rest >= least[a]) | (at > g)
            a, b, score, at = a[fit], b[fit], score[fit], at[fit]
    good = score >= least[a]
    return a[good], rows[b[good]], np.rint(score[good]).astype(np.int64)


# ---------------------------------------------------------------- windows


def first_of(window: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of each window's first ``k`` rows, in order."""
    order = np.lexsort((ids, -score, window))
    own = window[order]
    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
    rank = np.arange(len(own)) - np.repeat(starts, np.diff([*starts, len(own)]))
    return order[rank < k]


class Search:
    """A task's search for the first ``k`` rows of the windows of one block of anchors."""

    def __init__(self, row: dict, k: int, same: bool):
        self.k, self.same, self.keys = k, same, np.frombuffer(row["keys"], np.int64)
        n, slots = row["n"], row["slots"]
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.vecs = np.frombuffer(row["vecs"], np.int32).reshape(n, row["dim"]).astype(float)
        self.upper = np.frombuffer(row["upper"], np.int64).reshape(n, slots)
        self.tau = np.frombuffer(row["tau"], np.int64).reshape(n, slots).copy()
        self.slots, self.found, self.held = slots, [], 0

    def add(self, ids: np.ndarray, labels: np.ndarray, vecs: np.ndarray) -> None:
        """Join with a block of rows."""
        if self.same:  # label by label where they are few
            common = np.intersect1d(labels, self.labels)
            parts = ([(np.flatnonzero(self.labels == y), np.flatnonzero(labels == y)) for y in common]
                     if len(common) <= 64 else [(np.arange(len(self.ids)), np.arange(len(ids)))])
        else:
            parts = [(np.arange(len(self.ids)), np.arange(len(ids)))]
        tau = self.tau.min(1).astype(float)
        tau[tau <= -float(FAR)] = -np.inf
        for own, other in parts:
            a, b, score = threshold_pairs(self.vecs[own], vecs[other], tau[own])
            a, b = own[a], other[b]
            fit = (labels[b] == self.labels[a]) == self.same
            fit &= ids[b] != self.ids[a] if self.same else True
            a, b, score = a[fit], b[fit], score[fit]
            for slot in range(self.slots):
                inside = (score <= self.upper[a, slot]) & (score >= self.tau[a, slot])
                self.found.append((a[inside] * self.slots + slot, score[inside], ids[b[inside]]))
                self.held += int(inside.sum())
        if self.held > HELD:
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keep the first rows only; full windows want at least their last one's score."""
        window, score, ids = (np.concatenate(c) for c in zip(*self.found, strict=True)) if self.found else (
            np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        at = first_of(window, score, ids, self.k)
        window, score, ids = window[at], score[at], ids[at]
        full = np.bincount(window, minlength=self.tau.size) == self.k
        last = np.full(self.tau.size, -FAR)
        last[window] = score  # the last written is the lowest
        flat = self.tau.reshape(-1)
        flat[full] = np.maximum(flat[full], last[full])
        self.found, self.held = [(window, score, ids)], 0
        return window, score, ids


SEARCH_SCHEMA = "keys binary, slots int, upper binary, tau binary, " + BLOCK_SCHEMA


def anchor_blocks(windows: DataFrame, size: int) -> DataFrame:
    """Anchors with their windows (key, vec_id, label, vec, upper[], tau[]) packed into blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), size):
                part = batch.slice(k, size)
                vecs = matrix(as_list(part["vec"]))
                slots = max(map(len, part["upper"].to_pylist()), default=0)
                upper, tau = np.full((len(part), slots), -FAR), np.full((len(part), slots), FAR)  # nothing fits
                for i, (u, t) in enumerate(zip(part["upper"].to_pylist(), part["tau"].to_pylist(), strict=True)):
                    upper[i, :len(u)], tau[i, :len(t)] = u, t
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part["key"].to_numpy().tobytes()]), pa.array([slots], pa.int32()),
                     pa.array([upper.tobytes()]), pa.array([tau.tobytes()]),
                     pa.array([len(part)], pa.int32()), pa.array([vecs.shape[1]], pa.int32()),
                     pa.array([part["vec_id"].to_numpy().tobytes()]), pa.array([part["label"].to_numpy().tobytes()]),
                     pa.array([vecs.tobytes()])],
                    names=["keys", "slots", "upper", "tau", "n", "dim", "ids", "labels", "vecs"])

    return windows.select("key", "vec_id", "label", "vec", "upper", "tau").mapInArrow(run, SEARCH_SCHEMA)


def searched(blocks: DataFrame, windows: DataFrame, k: int, same: bool) -> DataFrame:
    """(key, slot, vec_id, score, rank): the first ``k`` rows of each window at or above its ``tau``."""
    queries = materialize(anchor_blocks(windows, ANCHORS).withColumn("block", F.monotonically_increasing_id()), "negatives-queries")
    size = F.octet_length("vecs") + F.octet_length("upper") + F.octet_length("tau") + 3 * F.octet_length("ids")
    order = Window.orderBy("block")  # a row per ANCHORS anchors
    sizes = materialize(queries.select("block", size.alias("bytes")), "negatives-sizes")
    group = F.floor(F.sum("bytes").over(order) / GROUP_BYTES)
    sizes = materialize(sizes.select("block", group.alias("grp")), "negatives-groups")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches: dict[int, Search] = {}
        for batch in batches:
            for i in range(len(batch)):
                block = batch["block"][i].as_py()
                if block not in searches:
                    searches[block] = Search(batch["query"][i].as_py(), k, same)
                row = {c: batch[c][i].as_py() for c in ("n", "dim", "ids", "labels", "vecs")}
                vecs = np.frombuffer(row["vecs"], np.int32).reshape(row["n"], row["dim"]).astype(float)
                searches[block].add(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), vecs)
        for s in searches.values():
            window, score, ids = s.cut()
            yield pa.RecordBatch.from_arrays(
                [pa.array(s.keys[window // s.slots]) if s.slots else pa.array([], pa.int64()),
                 pa.array((window % s.slots if s.slots else window).astype(np.int32)), pa.array(ids), pa.array(score)],
                names=["key", "slot", "vec_id", "score"])

    out = None
    numbers: dict[int, list[int]] = {}
    for r in sizes.collect():  # a number per ANCHORS anchors
        numbers.setdefault(r["grp"], []).append(r["block"])
    for some in numbers.values():
        # at most GROUP_BYTES and one block, by the running sum above
        part = queries.where(F.col("block").isin(some)).select(
            "block", F.struct(*[c for c in queries.columns if c != "block"]).alias("query"))
        rows = blocks.withColumn("block", F.explode(F.lit(some).cast("array<long>")))
        found = rows.join(F.broadcast(part), "block").mapInArrow(run, "key long, slot int, vec_id long, score long")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = blocks.sparkSession.createDataFrame([], "key long, slot int, vec_id long, score long")
    best = Window.partitionBy("key", "slot").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def with_thresholds(windows: DataFrame, sample: dict, total: int, k: int, same: bool, round_no: int) -> DataFrame:
    """``windows`` with ``tau`` for a round: a place in the sample's scores, at last the lower end."""
    deeper = OVERSHOOT * k * WIDER ** round_no
    last = round_no == ROUNDS - 1
    shared = windows.sparkSession.sparkContext.broadcast(sample)  # SAMPLE rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vecs = (shared.value[c] for c in ("ids", "labels", "vecs"))
        depth = max(1, -(-deeper * len(ids) // max(1, total)))
        for batch in batches:
            own = matrix(as_list(batch["vec"])).astype(np.int64)
            taus = []
            for i, (vec_id, label, upper, lower) in enumerate(zip(*(batch[c].to_pylist() for c in ("vec_id", "label", "upper", "lower")),
                                                                  strict=True)):
                m = min(own.shape[1], vecs.shape[1])
                fit = (labels == label) == same
                if same:
                    fit &= ids != vec_id
                scores = np.sort(vecs[fit, :m] @ own[i, :m])[::-1]
                tau = []
                for u, low in zip(upper, lower, strict=True):
                    inside = scores[np.searchsorted(-scores, -u):]
                    tau.append(FAR if u < low else low if last or len(inside) < depth else max(low, int(inside[depth - 1])))
                taus.append(tau)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(taus, pa.list_(pa.int64()))],
                                             names=[*batch.schema.names, "tau"])

    cols = windows.select("key", "vec_id", "label", "vec", "upper", "lower")
    return materialize(cols.mapInArrow(run, cols.withColumn("tau", F.array(F.lit(0).cast("long"))).schema), "negatives-windows")


def filled(blocks: DataFrame, windows: DataFrame, sample: dict, total: int, k: int, same: bool) -> DataFrame:
    """(key, slot, vec_id, score, rank) of each window's first ``k`` rows, or all of them where fewer."""
    out = None
    for round_no in range(ROUNDS):
        wanted = with_thresholds(windows, sample, total, k, same, round_no)
        found = materialize(searched(blocks, wanted, k, same), "negatives-found")
        if round_no == ROUNDS - 1:
            return found if out is None else out.unionByName(found)
        # a window is done when it is full or was searched to its lower end
        ends = wanted.select("key", F.posexplode(F.arrays_zip("tau", "lower", "upper")).alias("slot", "w")).select(
            "key", "slot", "w.*")
        counts = found.groupBy("key", "slot").agg(F.count(F.lit(1)).alias("n"))
        ends = ends.join(counts, ["key", "slot"], "left")
        short = (F.coalesce(F.col("n"), F.lit(0)) < k) & (F.col("tau") > F.col("lower")) & (F.col("lower") <= F.col("upper"))
        ends = materialize(ends.withColumn("short", short), "negatives-ends")
        done = found.join(ends.where(~F.col("short")).select("key", "slot"), ["key", "slot"], "left_semi").select(*found.columns)
        out = done if out is None else out.unionByName(done)
        again = ends.where("short").groupBy("key").agg(F.collect_list("slot").alias("open"))
        if again.isEmpty():
            return out
        windows = windows.join(again, "key").withColumn(
            # places stay: a closed window gets an upper end below its lower one
            "upper", F.transform("upper", lambda u, i: F.when(F.array_contains("open", i), u).otherwise(-FAR))).drop("open")
        windows = materialize(windows, "negatives-open")
    return out


def hard_negatives(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    rows = items(vectors)
    blocks = materialize(row_blocks(rows, BLOCK), "negatives-blocks")
    total = blocks.agg(F.sum("n").alias("n")).first()["n"] or 0
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    dim = max((len(r["vec"]) for r in drawn), default=0)
    sample = {"ids": np.array([r["vec_id"] for r in drawn], np.int64), "labels": np.array([r["label"] for r in drawn], np.int64),
              "vecs": np.array([r["vec"] + [0] * (dim - len(r["vec"])) for r in drawn], np.int64).reshape(len(drawn), dim)}
    anchors = materialize(rows.where(F.col("vec_id") % ANCHOR_EVERY == 0)
                          .withColumn("key", F.monotonically_increasing_id()), "negatives-anchors")
    far = F.lit(FAR).cast("long")
    open_ = anchors.select("*", F.array(far).alias("upper"), F.array(-far).alias("lower"))
    best = materialize(filled(blocks, open_, sample, total, positives, True), "negatives-positives")
    best = best.select("key", F.col("rank").alias("order"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))

    held = best.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("order", "positive_id", "positive_score"))).alias("ps"))
    # the scores n with LOWEST * p <= 100 * n <= HIGHEST * p
    sets = anchors.join(held, "key").select(
        "key", "vec_id", "label", "vec",
        F.transform("ps", lambda p: _floor(HIGHEST * p["positive_score"])).alias("upper"),
        F.transform("ps", lambda p: -_floor(-LOWEST * p["positive_score"])).alias("lower"))
    found = filled(blocks, materialize(sets, "negatives-sets"), sample, total, negatives, False)
    names = anchors.select("key", F.col("vec_id").alias("anchor_id"))
    found = found.select("key", (F.col("slot") + 1).alias("order"), "rank", F.col("vec_id").alias("negative_id"),
                         F.col("score").alias("negative_score"))
    return (found.join(best, ["key", "order"]).join(names, "key")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def _floor(hundredfold: Column) -> Column:
    """The integer part, towards minus infinity, of a hundredth; in whole numbers."""
    return ((hundredfold - F.pmod(hundredfold, F.lit(100))) / 100).cast("long")
