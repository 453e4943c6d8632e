"""Near-duplicate embeddings by sorted projection passes (operator 9).

Vectors are compared only within a group: equal, non-NULL labels and equal length.

1. Equal vectors of a group form a class; its representative is the smallest ``vec_id``.
2. In each pass a class gets a key of ``BITS`` random-hyperplane signs, the hyperplanes going
   through the group's mean.  Classes are ordered by group and key (lexicographically in the
   signs) and each is compared with the ``WINDOW`` classes before it.  A larger group takes more
   signs to decide a neighbourhood, and in a dense one (vectors close to their mean) a pair at the
   threshold shares fewer signs: the window grows with the largest group, the passes of each group
   with its own size and its measured density (:func:`window_for`, :func:`passes_for`).
3. Verified pairs of all passes are joined by union-find, first inside each task, then over
   all tasks by connected components.
4. Inside a component every pair is compared, in tiles of ``TILE`` classes, and links are
   counted, not listed.  So a group of near copies wider than a window loses no link; what
   can be missed are links that no pass found between documents of different components:
   a pair found in no pass at all, or the only links between two components found apart.
   Small components share tasks; a large one is spread over as many tasks as it has pairs
   of tiles.

Similarity is the cosine in double precision.

Scale: a pass range-partitions its rows, so a hot label is many partitions; rows at the borders
of partitions meet in groups of at most two windows.  Passes and window are parameters.

Defined cases: a NULL label, a NULL or zero vector, and one with NULL or non-finite components
link with nothing and are kept; NULL ``vec_id`` rows link with nothing and are kept; an empty
table gives an empty result; rows that repeat a ``vec_id`` with its vector are counted as
links of each other; other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import connected_components
from ..session import materialize

COSINE = 0.98
PASSES = 16     # at least, for a group wider than the window
MAX_PASSES = 400
MISSES = 3.5    # the expected finds of a pair at the threshold, so that it is missed with probability exp(-3.5)
BITS = 128      # a multiple of 8
WINDOW = 32     # at least
WINDOW_ROWS = 10_000  # classes of a group from which the window grows
TILE = 512
PARTITION_ROWS = 50_000
SEED = 20240101


def hyperplanes(dim: int, number: int) -> np.ndarray:
    """The normals of pass ``number``: dim × BITS."""
    return np.random.default_rng([SEED, number, dim]).normal(size=(dim, BITS)).astype(np.float32)


def window_for(largest: int) -> int:
    """The window for a largest group of so many classes."""
    return max(WINDOW, math.ceil(WINDOW * (largest / WINDOW_ROWS) ** (1 / 3)))


def passes_for(size: F.Column, window: int, spread: F.Column, cosine: float) -> F.Column:
    """The passes of a group of so many classes, whose mean unit vector has the squared length ``spread``.

    Hyperplanes go through the mean.  Seen from there a pair at the threshold has the cosine
    ``1 - (1 - cosine) / (1 - spread)`` and agrees in a sign with probability ``agree``, two others with one
    half.  So the signs that leave a window of classes are shared with probability
    ``(window / size) ** (log agree / log one half)``, and ``MISSES`` over that many passes find the pair.
    """
    seen = F.greatest(F.lit(0.0), 1 - (1 - cosine) / F.greatest(1 - spread, F.lit(1e-9)))
    agree = 1 - F.acos(seen) / math.pi
    shared = F.pow(F.least(F.lit(1.0), window / size), F.log(agree) / math.log(0.5))
    needed = F.least(F.ceil(MISSES / shared), F.lit(MAX_PASSES))
    return F.when(size <= window + 1, 1).otherwise(F.greatest(F.lit(PASSES), needed)).cast("int")


def vectors(raw: list[bytes], dim: int, width: int) -> np.ndarray:
    """Unit vectors in double precision."""
    x = np.frombuffer(b"".join(raw), f"<f{width}").reshape(-1, dim).astype(float)
    return x / np.sqrt((x * x).sum(1))[:, None]


def may_link() -> F.Column:
    """Whether a row has an id, a label and a finite vector other than zero."""
    x = F.col("embedding")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()
            & ~F.coalesce(odd, F.lit(True)) & F.coalesce(F.exists(x, lambda v: v != 0), F.lit(False)))


def group_means(classes: DataFrame, sizes: DataFrame, window: int, width: int) -> DataFrame:
    """(grp, dim, mean): the mean unit vector of each group that is wider than the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            codes = batch["grp"].dictionary_encode()
            dims, names = batch["dim"].to_numpy(), codes.dictionary.to_pylist()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                raw = batch.take(pa.array(at))["embedding"].flatten().to_numpy(zero_copy_only=False).astype(f"<f{width}")
                x = raw.reshape(-1, dim).astype(float)
                x /= np.sqrt((x * x).sum(1))[:, None]
                own = codes.indices.to_numpy()[at]
                for k in np.unique(own).tolist():
                    key = (names[k], dim)
                    sums[key] = sums.get(key, 0.0) + x[own == k].sum(0)
            if len(sums) > 10_000:
                yield table(sums)
                sums = {}
        yield table(sums)

    def table(sums: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([g for g, _ in sums], pa.string()), pa.array([d for _, d in sums], pa.int32()),
             pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["grp", "dim", "total"])

    wide = sizes.where(F.col("size") > window + 1)
    part = classes.join(wide, ["grp", "dim"]).select("grp", "dim", "embedding").mapInArrow(run, "grp string, dim int, total array<double>")
    total = part.select("grp", "dim", F.posexplode("total").alias("at", "x")).groupBy("grp", "dim", "at").agg(F.sum("x").alias("x"))
    listed = total.groupBy("grp", "dim").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("xs"))
    return listed.join(wide, ["grp", "dim"]).select("grp", "dim", F.transform("xs", lambda p: p["x"] / F.col("size")).alias("mean"))


def keyed(classes: DataFrame) -> DataFrame:
    """(node, grp, dim, vec, keys): vectors as bytes, one key for each of a row's ``passes``, seen from ``mean``."""
    width = 4 if isinstance(classes.schema["embedding"].dataType.elementType, T.FloatType) else 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            dims = batch["dim"].to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                raw = part["embedding"].flatten().to_numpy(zero_copy_only=False).astype(f"<f{width}")
                rows = [r.tobytes() for r in raw.reshape(-1, dim)]
                unit, own = vectors(rows, dim, width), part["passes"].to_numpy()
                unit -= part["mean"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                first = np.concatenate([[0], np.cumsum(own)])
                keys = np.zeros((first[-1], BITS // 8), np.uint8)
                for p in range(own.max()):
                    if (dim, p) not in planes:
                        planes[dim, p] = hyperplanes(dim, p)
                    at = np.flatnonzero(own > p)
                    keys[first[at] + p] = np.packbits(unit[at] @ planes[dim, p] > 0, axis=1)
                flat = pa.Array.from_buffers(pa.binary(BITS // 8), len(keys), [None, pa.py_buffer(keys.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [part["node"], part["grp"], part["dim"], pa.array(rows, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(first, pa.int32()), flat.cast(pa.binary()))],
                    names=["node", "grp", "dim", "vec", "keys"])

    return classes.select("node", "grp", "dim", "embedding", "passes", "mean").mapInArrow(
        run, "node long, grp string, dim int, vec binary, keys array<binary>")


def joined(parent: dict[int, int], a: int, b: int) -> bool:
    """Union of two nodes; whether they were apart."""
    for x in (a, b):
        parent.setdefault(x, x)
    while parent[a] != a:
        parent[a] = a = parent[parent[a]]
    while parent[b] != b:
        parent[b] = b = parent[parent[b]]
    if a == b:
        return False
    parent[max(a, b)] = min(a, b)
    return True


def window_links(group: np.ndarray, nodes: np.ndarray, unit: np.ndarray, window: int, cosine: float,
                 new_from: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places (later, earlier) up to ``window`` apart, in one group, at the cosine or above."""
    left, right = [], []
    for k in range(1, min(window, len(nodes) - 1) + 1):
        at = np.arange(max(k, new_from), len(nodes))
        at = at[group[at] == group[at - k]]
        hit = at[np.einsum("ij,ij->i", unit[at], unit[at - k]) >= cosine]
        left.append(hit)
        right.append(hit - k)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


EDGE = "kind int, a long, b long, part int, grp string, dim int, vec binary, at int"


def pass_links(stored: DataFrame, window: int, cosine: float, width: int, n_keys: int) -> DataFrame:
    """(src, dst): enough verified pairs of all passes to join what they join."""
    rows = stored.select("node", "grp", "dim", "vec", F.posexplode("keys").alias("pass", "key"))
    parts = max(1, -(-n_keys // PARTITION_ROWS))
    ordered = (rows.repartitionByRange(parts, "pass", "grp", "dim", "key", "node")
               .sortWithinPartitions("pass", "grp", "dim", "key", "node"))

    def compare(table: pd.DataFrame, new_from: int, parent: dict) -> list[tuple[int, int]]:
        out = []
        codes = pd.factorize(pd.MultiIndex.from_frame(table[["pass", "grp", "dim"]]))[0]
        for dim in table["dim"].unique().tolist():
            own = np.flatnonzero(table["dim"].to_numpy() == dim)
            unit = vectors([table["vec"].iat[i] for i in own], dim, width)
            nodes = table["node"].to_numpy()[own]
            x, y = window_links(codes[own], nodes, unit, window, cosine, int((own < new_from).sum()))
            for a, b in zip(nodes[x].tolist(), nodes[y].tolist(), strict=True):
                if joined(parent, a, b):
                    out.append((a, b))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        tail, parent, seen = None, {}, 0
        for batch in batches:
            for at in range(0, len(batch), 4096):
                now = batch.iloc[at:at + 4096]
                table = now if tail is None else pd.concat([tail, now], ignore_index=True)
                pairs = compare(table.reset_index(drop=True), 0 if tail is None else len(tail), parent)
                if pairs:
                    yield pd.DataFrame({"kind": 0, "a": [p[0] for p in pairs], "b": [p[1] for p in pairs], "part": part,
                                        "grp": None, "dim": 0, "vec": None, "at": 0})
                if seen < window:  # the rows that the partition before may have to meet
                    yield border(now.iloc[:window - seen], part - 1, window + seen)
                seen += len(now)
                tail = table.iloc[-window:]
        if tail is not None:
            yield border(tail, part, 0)

    def border(rows: pd.DataFrame, part: int, at: int) -> pd.DataFrame:
        return pd.DataFrame({"kind": 1, "a": rows["node"], "b": rows["pass"], "part": part, "grp": rows["grp"],
                             "dim": rows["dim"], "vec": rows["vec"], "at": np.arange(at, at + len(rows))})

    found = materialize(ordered.mapInPandas(run, EDGE), "window-links")

    def across(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at", ignore_index=True).rename(columns={"a": "node", "b": "pass"})
        pairs = compare(rows, 0, {})
        return pd.DataFrame({"src": [p[0] for p in pairs], "dst": [p[1] for p in pairs]}, dtype="int64")

    borders = found.where("kind = 1").groupBy("part").applyInPandas(across, "src long, dst long")
    return found.where("kind = 0").select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(borders)


def link_counts(members: DataFrame, cosine: float, width: int) -> DataFrame:
    """(node, links): vectors linked with a class's vectors, by its component's tiles.

    ``members`` has (component, node, dim, vec, copies).
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    sized = materialize(members.join(materialize(sizes, "component-sizes"), "component"), "component-members")
    tiles = F.ceil(F.col("size") / F.lit(TILE)).cast("int")
    tile = F.pmod(F.xxhash64("node"), tiles).cast("int")
    spread = (sized.withColumn("tiles", tiles).withColumn("tile", tile)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
              .withColumn("i", F.least("tile", "other")).withColumn("j", F.greatest("tile", "other")))
    # small components share a task; a pair of tiles of a large one has its own
    room = F.when(F.col("tiles") > 1, F.xxhash64("component", "i", "j")).otherwise(F.pmod(F.xxhash64("component"), F.lit(4096)))

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        nodes, links = [], []
        for (_, i, j, dim), part in rows.groupby(["component", "i", "j", "dim"], sort=False):
            unit = vectors(part["vec"].tolist(), dim, width)
            own, copies, t = part["node"].to_numpy(), part["copies"].to_numpy(), part["tile"].to_numpy()
            left, right = (np.flatnonzero(t == i), np.flatnonzero(t == j))
            hit = unit[left] @ unit[right].T >= cosine
            if i == j:
                np.fill_diagonal(hit, False)
                nodes.append(own)
                links.append((hit * copies[None, :]).sum(1))
            else:
                nodes += [own[left], own[right]]
                links += [(hit * copies[right][None, :]).sum(1), (hit * copies[left][:, None]).sum(0)]
        return pd.DataFrame({"node": np.concatenate(nodes), "links": np.concatenate(links)})

    return (spread.withColumn("room", room)
            .select("room", "component", "i", "j", "tile", "node", "dim", "vec", "copies")
            .groupBy("room").applyInPandas(count, "node long, links long")
            .groupBy("node").agg(F.sum("links").alias("links")))


def near_duplicate_vectors(rows: DataFrame, cosine: float = COSINE, passes: int | None = None,
                           window: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding, label).

    Without ``passes`` and ``window`` both grow with the groups.
    """
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    width = 4 if isinstance(rows.schema["embedding"].dataType.elementType, T.FloatType) else 8
    good = rows.where(may_link()).select("vec_id", F.col("label").cast("string").alias("grp"),
                                         F.size("embedding").alias("dim"), "embedding")
    exact = ["grp", "dim", "embedding"]
    classes = materialize(good.groupBy(*exact).agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")),
                          "vector-classes")
    sizes = materialize(classes.groupBy("grp", "dim").agg(F.count(F.lit(1)).alias("size")), "vector-groups")
    if window is None:
        window = window_for(sizes.agg(F.max("size")).first()[0] or 0)
    means = materialize(group_means(classes, sizes, window, width), "vector-means")
    mean = F.coalesce("mean", F.array_repeat(F.lit(0.0), F.col("dim")))
    spread = F.aggregate(mean, F.lit(0.0), lambda a, x: a + x * x)
    wanted = F.lit(passes) if passes else passes_for(F.col("size"), window, spread, cosine)
    sizes = materialize(sizes.join(means, ["grp", "dim"], "left").select("grp", "dim", "size", mean.alias("mean"), wanted.alias("passes")),
                        "vector-passes")
    n_keys = sizes.agg(F.sum(F.col("size") * F.col("passes"))).first()[0] or 0
    stored = materialize(keyed(classes.join(sizes, ["grp", "dim"])), "vector-keys")
    links = materialize(pass_links(stored, window, cosine, width, n_keys).distinct(), "vector-links")
    labels = materialize(connected_components(links).select(F.col("id").alias("node"), "component"), "vector-components")
    members = (stored.select("node", "dim", "vec").join(labels, "node")
               .join(classes.select("node", "copies"), "node"))
    counts = link_counts(members, cosine, width)
    judged = materialize(
        classes.join(labels, "node", "left").join(counts, "node", "left")
        .select(*exact, F.coalesce("component", "node").alias("component"),
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vector-judged")
    linked = good.join(judged, exact).select("vec_id", "n_links", F.col("component").alias("component_id"))
    others = rows.where(~may_link()).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("vec_id").alias("component_id"))
    return linked.unionByName(others).select(
        "vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
