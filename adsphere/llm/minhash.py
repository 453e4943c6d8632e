"""Near-duplicate documents by SetSketch registers (operator 4).

A document's set holds its distinct two-word shingles.  Its sketch has ``BANDS * ROWS``
registers.  For each register every shingle gets an exponential value; the register is the
least of them on an exponential scale, ``floor(1 - log_b(min))`` truncated to 0 … Q + 1.  The
registers of a union are the larger registers, so sketches merge, and the share of equal
registers follows the Jaccard similarity, so bands of registers serve as hash keys.

1. Documents with the same words in the same order form a class, told by a cryptographic
   128-bit hash; its representative is the smallest ``doc_id``.  Only representatives go on, so
   documents with equal sets but other words in order are linked like any pair, on their sets.
2. Representatives that agree in a whole band meet in a bucket.  At similarity 0.8 a pair
   misses all bands with probability 2e-8.
3. Each bucket has a leader (the least by a hash that differs per band, so a group of
   near copies has many leaders); every member is compared with its leader.  The members
   that their leader left out elect a further leader, round by round while a bucket has more
   than ``CROWD`` of them (``ROUNDS`` rounds at most); the rest are compared with each other
   in tiles of ``CROWD``, which return links that join, not pairs.  So in every bucket each
   member is linked by some plausible pair or has none among those left out.
4. A pair is dropped where the sizes alone rule out the similarity, where two 64-bit
   fingerprints (one bit per register) differ too much, or where the joint maximum-likelihood
   estimate from both sketches and sizes lies more than seven standard errors below it.  The
   rest is verified on the full sets of the whole texts.
5. Verified links give components.  Plausible pairs, verified or not, give groups: documents
   that may be similar.  A group that holds several components compares every document
   outside its largest component with all documents of the group, in tiles of ``TILE`` by
   ``TILE`` documents: a task holds the texts of two tiles, counts shared shingles through an
   index, and returns only links that join components.  So no link in a group is lost, a
   group of g near copies costs about g comparisons, and no task or table holds all pairs.

Scale: shuffled are sketches, bucket rows, and the texts of documents in some plausible pair.
Leaders come from partial aggregation and are stored before they are joined, so AQE can split
a hot bucket on both sides of the join.  Pairs meet the fingerprints first and the sketches
only if those leave the pair in.

Defined cases: lower case is ASCII only; a one-word text is a set of one; a text without words
(or NULL) has an empty set, is its own component and is kept; NULL ``doc_id`` rows link with
nothing and are kept; repeated rows share a component; an empty table gives an empty result;
other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import materialize
from .tokens import byte_slices, ragged

PERCENT = 80
ROWS, BANDS = 5, 44
REGISTERS = ROWS * BANDS
BASE, RATE, Q = 1.001, 20.0, (1 << 16) - 2
STANDARD_ERRORS = 7.0
SLICE_BYTES = 512 << 10  # of text hashed at once: a worker holds some 60 bytes per byte of it
LONG_WORD = 64  # bytes, from which a word's hash is cryptographic
TILE = 256
CROWD = 512  # members of a bucket, left out by their leader, that are compared with each other at once
ROUNDS = 12  # of further leaders
BITS = 128  # of a fingerprint: the lowest bit of each of the first registers

# odd multipliers of the hashes: splitmix64 (fixed values)
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit words (splitmix64)."""
    x = x + MIX[0]
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


_SEEDS = mixed(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64))
XOR = (_SEEDS[:REGISTERS] >> np.uint64(32)).astype(np.uint32)
TIMES = (_SEEDS[REGISTERS:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as far as they are needed."""

    base = np.uint64(0x5851F42D4C957F2D)
    inverse = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES * 2)
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, self.base)]))
            self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, self.inverse)]))
        return self.up, self.down


POWERS: list[Powers] = []


def powers() -> Powers:
    """One table of powers per worker."""
    if not POWERS:
        POWERS.append(Powers())
    return POWERS[0]


def shingle_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): text i has the distinct shingle hashes ``hashes[bounds[i]:bounds[i + 1]]``."""
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(lens + 1) - lens - 1
    upper = (raw >= 65) & (raw <= 90)
    low = raw + (upper.astype(np.uint8) << 5)
    space = (low == 32) | ((low >= 9) & (low <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    up, down = powers().upto(len(low) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:len(low)])])
    word = mixed((sums[ends] - sums[starts]) * down[starts])
    for i in np.flatnonzero(ends - starts >= LONG_WORD).tolist():  # sums of powers modulo 2 ** 64 may agree there
        word[i] = int.from_bytes(hashlib.blake2b(low[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    doc = np.searchsorted(begin, starts, side="right") - 1
    count = np.bincount(doc, minlength=len(texts))
    pair = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) > 1 else np.zeros(0, np.int64)
    hashes = mixed(word[pair] * MIX[1] + word[pair + 1]) if len(pair) else np.zeros(0, np.uint64)
    owner = doc[pair] if len(pair) else np.zeros(0, np.int64)
    alone = np.flatnonzero(count == 1)
    if len(alone):  # one word: the whole sequence
        first = np.searchsorted(doc, alone)
        hashes = np.concatenate([hashes, mixed(word[first])])
        owner = np.concatenate([owner, alone])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])


def sliced_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """:func:`shingle_hashes` of many texts, ``SLICE_BYTES`` at a time."""
    parts, lens, held, at = [], [], 0, 0
    for i, t in enumerate([*texts, None]):
        if t is None or (held and held + len(t) > SLICE_BYTES):
            hashes, bounds = shingle_hashes(texts[at:i])
            parts.append(hashes)
            lens.append(np.diff(bounds))
            at, held = i, 0
        held += len(t or b"")
    return np.concatenate(parts), np.concatenate([[0], *[np.cumsum(np.concatenate(lens))]])


def registers(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of registers per set; a row of zeros for an empty set."""
    out = np.zeros((len(bounds) - 1, REGISTERS), np.uint16)
    some = np.flatnonzero(np.diff(bounds))
    if not len(some):
        return out
    h = (hashes >> np.uint64(32)).astype(np.uint32)
    at = bounds[:-1][some]
    buffer = np.empty_like(h)
    least = np.empty((REGISTERS, len(some)), np.uint32)
    for i in range(REGISTERS):
        np.bitwise_xor(h, XOR[i], out=buffer)
        np.multiply(buffer, TIMES[i], out=buffer)
        least[i] = np.minimum.reduceat(buffer, at)
    value = -np.log1p(-(least.T.astype(float) + 0.5) / 2.0 ** 32) / RATE
    out[some] = np.clip(np.floor(1.0 - np.log(value) / np.log(BASE)), 0, Q + 1)
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """A 64-bit key per band (the band's number is part of it)."""
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), (len(regs), BANDS))
    by_band = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    for r in range(ROWS):
        key = mixed(key * MIX[2] + by_band[:, :, r])
    return key.view(np.int64)


def fingerprints(regs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit words per sketch: a mixed bit of each of the first ``BITS`` registers."""
    bits = mixed(regs[:, :BITS].astype(np.uint64)) & np.uint64(1)
    shift = np.arange(64, dtype=np.uint64)
    words = [(bits[:, k:k + 64] << shift).sum(1, dtype=np.uint64).view(np.int64) for k in (0, 64)]
    return words[0], words[1]


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood Jaccard similarity of pairs of sketches with known set sizes."""
    d_more = (a > b).sum(1)
    d_less = (a < b).sum(1)
    d_same = REGISTERS - d_more - d_less
    u = (na / (na + nb))[:, None]
    v = 1 - u
    grid = np.minimum(u / v, v / u) * np.linspace(0, 1, 101)[None, :]

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    more, less = p(u - v * grid), p(v - u * grid)
    tiny = 1e-12
    ll = (d_more[:, None] * np.log(np.maximum(more, tiny)) + d_less[:, None] * np.log(np.maximum(less, tiny))
          + d_same[:, None] * np.log(np.maximum(1 - more - less, tiny)))
    return grid[np.arange(len(grid)), ll.argmax(1)]


def sequence_hash(text: bytes) -> bytes:
    """A cryptographic 128-bit hash of a text's words in order: equal words, equal sets."""
    return hashlib.blake2b(b" ".join(text.lower().split()), digest_size=16).digest()


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n, s1, s2, f1, f2, regs): set size, a 128-bit hash of the words in order, fingerprint, sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in byte_slices(batch["text"], SLICE_BYTES):
                texts = [t.as_buffer().to_pybytes() if t.is_valid else b""
                         for t in batch["text"][a:b].cast(pa.large_binary())]
                hashes, bounds = shingle_hashes(texts)
                n = np.diff(bounds)
                regs = registers(hashes, bounds)
                same = np.frombuffer(b"".join(sequence_hash(t) for t in texts), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][a:b], pa.array(n, pa.int64()),
                     pa.array(same[:, 0]), pa.array(same[:, 1]),
                     *[pa.array(f) for f in fingerprints(regs)],
                     pa.array([r.tobytes() for r in regs], pa.binary())],
                    names=["doc_id", "n", "s1", "s2", "f1", "f2", "regs"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, s1 long, s2 long, f1 long, f2 long, regs binary")


def bucket_rows(nodes: DataFrame) -> DataFrame:
    """(key, node) for every band of every representative."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                regs = np.frombuffer(b"".join(part["regs"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(band_keys(regs).reshape(-1)),
                     pa.array(np.repeat(part["node"].to_numpy(), BANDS))], names=["key", "node"])

    return nodes.select("node", "regs").mapInArrow(run, "key long, node long")


def limits() -> tuple[float, int]:
    """The least estimate, and the most bits two fingerprints differ in, that leave a pair in."""
    j = PERCENT / 100
    least = j - STANDARD_ERRORS * (j * (1 - j) / REGISTERS) ** 0.5
    # equal registers agree in the bit, others by chance: agreement (1 + j) / 2 at similarity j
    agree = (1 + j) / 2
    return least, int(BITS * (1 - agree + STANDARD_ERRORS * (agree * (1 - agree) / BITS) ** 0.5))


def plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes, fingerprints and the likelihood estimate do not rule out."""
    least, differ = limits()

    def side(name: str, *columns: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), *[F.col(c).alias(c + name) for c in columns])

    near = (pairs.join(side("a", "n", "f1", "f2"), "a").join(side("b", "n", "f1", "f2"), "b")
            .where((100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))
                   & (F.bit_count(F.col("f1a").bitwiseXOR(F.col("f1b")))
                      + F.bit_count(F.col("f2a").bitwiseXOR(F.col("f2b"))) <= differ))
            .select("a", "b", "na", "nb"))
    near = materialize(near, "near-fingerprints")
    joined = near.join(side("a", "regs").withColumnRenamed("regsa", "ra"), "a").join(
        side("b", "regs").withColumnRenamed("regsb", "rb"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                ra, rb = (np.frombuffer(b"".join(part[c].to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
                j = estimate(ra, rb, part["na"].to_numpy().astype(float), part["nb"].to_numpy().astype(float))
                yield pa.RecordBatch.from_arrays(
                    [c.filter(pa.array(j >= least)) for c in (part["a"], part["b"])], names=["a", "b"])

    return joined.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long")


def led(rows: DataFrame) -> DataFrame:
    """Bucket rows (key, node) of buckets of several, with the bucket's leader and size."""
    leaders = materialize(
        rows.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "node").alias("h"), "node")).alias("m"),
                                F.count(F.lit(1)).alias("size"))
        .where("size > 1").select("key", F.col("m.node").alias("leader"), "size"), "bucket-leaders")
    return materialize(rows.join(leaders, "key"), "bucket-members")


def leader_pairs(members: DataFrame) -> DataFrame:
    """(key, node, size, a, b) of every member but the leader; (a, b) is its pair with the leader."""
    return (members.where(F.col("node") != F.col("leader"))
            .select("key", "node", "size", F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")))


def left_out(members: DataFrame, likely: DataFrame) -> DataFrame:
    """(key, node): members whose pair with the leader is not plausible, where there are others."""
    return (leader_pairs(members.where("size > 2")).join(likely, ["a", "b"], "left_anti").select("key", "node"))


def near_in_buckets(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by key: which have a near one in their bucket, and pairs of places that join.

    Near is what sizes and fingerprints (and, where there is a column ``regs``, the share of
    equal registers) do not rule out.  Pairs already known to be joined are not compared.
    """
    least, differ = limits()
    key, n, f1, f2 = (rows[c].to_numpy() for c in ("key", "n", "f1", "f2"))
    regs = np.frombuffer(b"".join(rows["regs"]), np.uint16).reshape(-1, REGISTERS) if "regs" in rows else None
    rank = np.arange(len(key)) - np.searchsorted(key, key)
    root, near = np.arange(len(key)), np.zeros(len(key), bool)
    left, right = [], []
    at = np.flatnonzero(rank >= 1)
    k = 1
    while len(at):
        now = at[~(near[at] & near[at - k])] if regs is None else at[root[at] != root[at - k]]
        a, b = n[now], n[now - k]
        now = now[100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)]
        now = now[np.bitwise_count(f1[now] ^ f1[now - k]).astype(int) + np.bitwise_count(f2[now] ^ f2[now - k]) <= differ]
        if regs is not None:
            same = [(regs[c] == regs[c - k]).mean(1) for c in np.array_split(now, len(now) // 4096 + 1)]
            now = now[np.concatenate(same) >= least]
        near[now] = near[now - k] = True
        if regs is not None and len(now):
            for x in now.tolist():
                a, b = x, x - k
                while root[a] != a:
                    a = root[a]
                while root[b] != b:
                    b = root[b]
                if a != b:
                    root[max(a, b)] = min(a, b)
                    left.append(x)
                    right.append(x - k)
            while (root != root[root]).any():
                root = root[root]
        k += 1
        at = at[rank[at] >= k]
    return near, np.array(left, np.int64), np.array(right, np.int64)


def crowd_tiles(rows: DataFrame, nodes: DataFrame, *columns: str) -> DataFrame:
    """(room, key, node, columns): bucket rows, each pair of a bucket's rows in some room.

    A bucket of up to ``CROWD`` rows is one tile, and small buckets share a room; a pair of
    tiles of a large one has its own.
    """
    sizes = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "crowd-sizes")
    tiles = F.ceil(F.col("size") / F.lit(CROWD)).cast("int")
    tile = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    spread = (rows.join(sizes, "key").withColumn("tiles", tiles).withColumn("tile", tile)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))))
    room = (F.when(F.col("tiles") > 1, F.xxhash64("key", F.least("tile", "other"), F.greatest("tile", "other")))
            .otherwise(F.pmod(F.xxhash64("key"), F.lit(4096))))
    return spread.select(room.alias("room"), "key", "node").join(nodes.select("node", *columns), "node")


def crowd_pairs(members: DataFrame, likely: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): plausible pairs among the members that their bucket's leader left out.

    Enough of them to connect what all of them connect, beside the further leaders' own.
    """
    found = likely.limit(0)
    rows = materialize(left_out(members, likely), "left-out")
    for _ in range(ROUNDS):
        if rows.groupBy("key").count().where(F.col("count") > CROWD).isEmpty():
            break
        members = led(rows)
        now = materialize(plausible(leader_pairs(members).select("a", "b").distinct(), nodes).distinct(), "likely-pairs")
        found = found.unionByName(now)
        rows = materialize(left_out(members, now), "left-out")

    def mark(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("key", ignore_index=True)
        return part.loc[near_in_buckets(part)[0], ["key", "node"]]

    def join(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("key", ignore_index=True)
        _, x, y = near_in_buckets(part)
        a, b = part["node"].to_numpy()[x], part["node"].to_numpy()[y]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    # sketches are fetched for those only that have a near one by size and fingerprint
    marked = materialize(crowd_tiles(rows, nodes, "n", "f1", "f2").groupBy("room")
                         .applyInPandas(mark, "key long, node long").distinct(), "crowd-marked")
    pairs = (crowd_tiles(marked, nodes, "n", "f1", "f2", "regs").groupBy("room")
             .applyInPandas(join, "a long, b long"))
    return found.unionByName(pairs)


WORD_BREAK = r"[\x20\x09-\x0D]+"


def shingle_set(text: str) -> frozenset:
    """The set itself, of word tuples, for verification."""
    import re

    ascii_lower = str.maketrans({c: c + 32 for c in range(65, 91)})
    words = [w for w in re.split(WORD_BREAK, text.translate(ascii_lower)) if w]
    if len(words) < 2:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(words[:-1], words[1:], strict=True))


def similar(s: frozenset, t: frozenset) -> bool:
    """Whether two sets meet the similarity."""
    shared = len(s & t)
    return 100 * shared >= PERCENT * (len(s) + len(t) - shared)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets meet the similarity.

    Each text needed is fetched once per pair, the two sides of a pair are brought together
    by the pair's number, and pairs are streamed: a task holds the texts of one pair at a time.
    """
    numbered = materialize(pairs.withColumn("pair", F.monotonically_increasing_id()), "near-pairs")
    sides = (numbered.select("pair", F.col("a").alias("node"), F.lit(0).alias("side"))
             .unionByName(numbered.select("pair", F.col("b").alias("node"), F.lit(1).alias("side"))))
    both = (sides.join(texts, "node").select("pair", "side", "node", "text")
            .repartition("pair").sortWithinPartitions("pair", "side"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, left, done = None, [], False
        for batch in batches:
            found = []
            for pair, side, node, text in zip(*[batch[c].to_pylist() for c in ("pair", "side", "node", "text")],
                                              strict=True):
                if pair != now:
                    now, left, done = pair, [], False
                if side == 0:
                    left.append((node, shingle_set(text)))
                elif not done:
                    own = shingle_set(text)
                    done = any(similar(s, own) for _, s in left)
                    if done:
                        found.append((left[0][0], node))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                              pa.array([f[1] for f in found], pa.int64())], names=["src", "dst"])

    return both.mapInArrow(run, "src long, dst long")


def tile_links(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(src, dst): links between components inside groups, found tile by tile.

    ``members`` has (grp, node, component, stray, size, strays): a group's documents, whether
    each lies outside its largest component, and the group's counts of both.
    """
    wide = F.ceil(F.col("size") / TILE).cast("int")
    high = F.ceil(F.col("strays") / TILE).cast("int")
    place = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    every = members.select("grp", "node", "component", F.lit(1).alias("side"), place(wide).alias("j"),
                           F.explode(F.sequence(F.lit(0), high - 1)).alias("i"), (wide * high).alias("tiles"))
    strays = members.where("stray").select("grp", "node", "component", F.lit(0).alias("side"),
                                           F.explode(F.sequence(F.lit(0), wide - 1)).alias("j"),
                                           place(high).alias("i"), (wide * high).alias("tiles"))
    rows = strays.unionByName(every).join(texts, "node")
    # small groups share a task; a pair of tiles of a large one has its own
    room = F.when(F.col("tiles") > 1, F.xxhash64("grp", "i", "j")).otherwise(F.pmod(F.xxhash64("grp"), F.lit(4096)))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, part in rows.groupby(["grp", "i", "j"], sort=False):
            found += links_between(part[part["side"] == 0], part[part["side"] == 1])
        return pd.DataFrame(found, columns=["src", "dst"], dtype="int64")

    return (rows.select(room.alias("room"), "grp", "i", "j", "side", "node", "component", "text")
            .groupBy("room").applyInPandas(compare, "src long, dst long"))


def links_between(left: pd.DataFrame, right: pd.DataFrame) -> list[tuple[int, int]]:
    """Links from rows of one tile to rows of the other that join components not yet joined."""
    texts = [t.encode() for t in right["text"]]
    hashes, bounds = sliced_hashes(texts)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(texts)), sizes)
    order = np.argsort(hashes, kind="stable")
    hashes, owner = hashes[order], owner[order]
    nodes, labels = right["node"].to_numpy(), right["component"].to_numpy()
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    found = []
    for node, label, text in zip(left["node"].tolist(), left["component"].tolist(), left["text"], strict=True):
        own, _ = shingle_hashes([text.encode()])
        first, last = np.searchsorted(hashes, own), np.searchsorted(hashes, own, side="right")
        shared = np.bincount(owner[ragged(first, last - first)], minlength=len(texts))
        near = np.flatnonzero((100 * shared >= PERCENT * (len(own) + sizes - shared)) & (labels != label))
        for k in near.tolist():
            a, b = find(label), find(int(labels[k]))
            # the hashes say so; the sets themselves decide
            if a != b and similar(shingle_set(text), shingle_set(right["text"].iat[k])):
                parent[max(a, b)] = min(a, b)
                found.append((node, int(nodes[k])))
    return found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; ``doc_id`` names and orders documents."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = materialize(sketches(docs), "sketches")
    linkable = sketched.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    set_key = ["n", "s1", "s2"]
    classes = materialize(linkable.groupBy(*set_key).agg(F.min("doc_id").alias("node")), "set-classes")
    # the sketch of a class is that of its representative (repeated rows have the same one)
    nodes = materialize(linkable.join(classes.withColumnRenamed("node", "doc_id"), [*set_key, "doc_id"])
                        .select(F.col("doc_id").alias("node"), "n", "f1", "f2", "regs").distinct(), "set-nodes")
    texts = docs.select(F.col("doc_id").alias("node"), "text").where(F.col("node").isNotNull())

    members = led(bucket_rows(nodes))
    first = materialize(plausible(leader_pairs(members).select("a", "b").distinct(), nodes).distinct(), "likely-pairs")
    likely = materialize(first.unionByName(crowd_pairs(members, first, nodes)).distinct(), "likely-pairs")
    links = materialize(verified(likely, texts), "near-links")
    labels = connected_components(links).select(F.col("id").alias("node"), "component")

    # groups of documents that may be similar, where the leaders left several components
    groups = connected_components(likely, "a", "b").select(F.col("id").alias("node"), F.col("component").alias("grp"))
    placed = materialize(groups.join(labels, "node", "left").select(
        "grp", "node", F.coalesce("component", "node").alias("component")), "group-members")
    sizes = placed.groupBy("grp", "component").agg(F.count(F.lit(1)).alias("c"))
    split = materialize(
        sizes.groupBy("grp").agg(F.max(F.struct("c", "component")).alias("m"), F.sum("c").alias("size"))
        .where(F.col("m.c") < F.col("size"))
        .select("grp", F.col("m.component").alias("main"), "size", (F.col("size") - F.col("m.c")).alias("strays"))
        .where("size > 2"), "group-splits")  # a group of two was compared already
    apart = placed.join(split, "grp").withColumn("stray", F.col("component") != F.col("main"))
    more = materialize(tile_links(apart, texts), "near-links")
    if not more.isEmpty():
        labels = connected_components(links.unionByName(more)).select(F.col("id").alias("node"), "component")

    of_class = classes.join(labels, "node", "left").select(*set_key, F.coalesce("component", "node").alias("component"))
    of_class = materialize(of_class, "class-components")
    linked = linkable.select("doc_id", *set_key).join(of_class, set_key).select("doc_id", "n", "component")
    alone = sketched.where((F.col("n") == 0) | F.col("doc_id").isNull()).select(
        "doc_id", "n", F.col("doc_id").alias("component"))
    return linked.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component (the first in table order), with its own columns."""
    packed = materialize(docs.select(F.struct(*docs.columns).alias("_doc"),
                                     F.monotonically_increasing_id().alias("row")), "near-docs")
    # the row number stands for the id, so that repeated rows are told apart
    judged = near_duplicates(packed.select(F.col("row").alias("doc_id"), "_doc.text"))
    kept = judged.where("kept").select(F.col("doc_id").alias("row"))
    return packed.join(kept, "row").select("_doc.*")
