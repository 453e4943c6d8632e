"""Best-fit packing with certified bin counts (operator 6).

Documents become runs of token ids (the text's ids, then id 0).  Runs longer than a sequence
are cut into full sequences, the shorter piece first; a full piece is a sequence of its own.
All other pieces are dealt to groups of about ``GROUP_ROWS`` by a hash of their row number
(no key of the data, so no group is hot) and packed best-fit decreasing.

Each group's bin count is held against a lower bound: the largest value that a family of
dual-feasible functions gives for its lengths.  Bins equal to the bound are proven optimal.
Groups with a gap give up the documents of their bins that are not full; these meet in new
groups and are packed again.  A round that saves no bin is discarded and ends the exchange, as does a
total that reaches the bound over all pieces (from at most 2,048 counts of lengths).

Defined cases: a NULL or empty text is a run of one id; NULL ``doc_id`` and repeated rows are
packed each; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tokens import byte_slices, tokenizer_file, vocabulary_path

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 2048
END_ID = 0
GROUP_ROWS = 8192
MAX_ROUNDS = 4

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer_file(path)
        tail = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for a, b in byte_slices(batch["text"]):
                ids, bounds = t.encode(batch["text"][a:b])
                raw, at = memoryview(ids.astype("<u4").tobytes()), bounds.tolist()
                rows: list[tuple] = []
                for doc, i, j in zip(batch["doc_id"][a:b].to_pylist(), at[:-1], at[1:], strict=True):
                    n = j - i + 1
                    first = n if n <= capacity else n % capacity or capacity
                    cuts = [0, *range(first, n + 1, capacity)]
                    for k, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        crc = zlib.crc32(raw[4 * (i + s):4 * min(i + e, j)])
                        rows.append((doc, k, s, e - s, zlib.crc32(tail, crc) if e == n else crc))
                cols = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECE)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, room left in the bin) per item: longest first, each to the fullest bin that takes it.

    Open bins are kept by the room they have left; a bit per room finds the least that fits.
    """
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []
    open_rooms = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = open_rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            k = by_room[room].pop()
            if not by_room[room]:
                open_rooms ^= 1 << room
        else:
            room, k = capacity, len(rooms)
            rooms.append(room)
        bins[i], offsets[i] = k, capacity - room
        room -= n
        rooms[k] = room
        if room:
            if not by_room[room]:
                open_rooms |= 1 << room
            by_room[room].append(k)
    return bins, offsets, np.array(rooms, np.int64)[bins] if len(bins) else bins


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs; ``counts[n]`` pieces have length ``n``.

    The largest of: total length; for k = 1 … 20 the function that rounds (k + 1)·n/capacity
    down to whole k-ths (exact multiples stay); and for each threshold e up to half a bin the
    function that counts lengths over capacity - e as a bin and ignores those under e.
    """
    n = np.arange(len(counts))
    total = int((counts * n).sum())
    best = -(-total // capacity)
    for k in range(1, 21):
        scaled = (k + 1) * n
        whole = scaled % capacity == 0
        value = np.where(whole, scaled * k, scaled // capacity * capacity)  # in 1/(k * capacity) bins; whole ones stay n/capacity
        value = np.where(whole, n * k, value)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    sizes, pieces = np.cumsum(counts * n), np.cumsum(counts)
    for e in range(1, capacity // 2 + 1):
        large = int(pieces[-1] - pieces[capacity - e])
        middle = int(sizes[capacity - e] - sizes[e - 1])
        best = max(best, large + -(-middle // capacity))
    return best


PACKED = "_key long, _gap long, _room long, sequence_id long, offset long"


def _pack_groups(pieces: DataFrame, capacity: int, n_groups: int, seed: int) -> DataFrame:
    """Pack each group; ``_gap`` is the group's bins over its bound, ``_room`` the room left in the bin."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_key", ignore_index=True)  # the same result however the rows arrive
        lengths = rows["length"].to_numpy()
        bins, offsets, room = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        first = np.zeros(int(bins.max()) + 1, np.int64)
        opened = offsets == 0
        first[bins[opened]] = rows["_key"].to_numpy()[opened]  # a bin is named by the row that opened it
        return pd.DataFrame({"_key": rows["_key"], "_gap": len(first) - bound, "_room": room,
                             "sequence_id": first[bins], "offset": offsets,
                             **{c: rows[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")}})

    group = F.pmod(F.xxhash64("_key", F.lit(seed)), F.lit(n_groups))
    return (pieces.select("_key", "doc_id", "piece", "start", "length", "ids_crc32", group.alias("_group"))
            .groupBy("_group").applyInPandas(pack, f"{PACKED}, {PIECE}"))


def _bins(packed: DataFrame) -> int:
    return packed.where(F.col("offset") == 0).count()


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS,
                max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; see the module's text."""
    keyed = materialize(pieces.withColumn("_key", F.monotonically_increasing_id()), "pack-pieces")
    full = keyed.where(F.col("length") == capacity).select(
        "*", F.col("_key").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = keyed.where(F.col("length") < capacity)
    hist = short.groupBy("length").count().collect()  # fewer than ``capacity`` rows
    counts = np.zeros(capacity + 1, np.int64)
    for r in hist:
        counts[r["length"]] = r["count"]
    target = lower_bound(counts, capacity)
    n_groups = max(1, -(-int(counts.sum()) // group_rows))
    packed = materialize(_pack_groups(short, capacity, n_groups, 0), "pack-round")
    total = _bins(packed)
    done: list[DataFrame] = []
    for r in range(1, max_rounds):
        if total <= target:
            break
        # a short piece of every group's certificate: groups without a gap keep their bins
        pool = packed.where((F.col("_gap") > 0) & (F.col("_room") > 0))
        rows, old = pool.agg(F.count(F.lit(1)), F.count_if(F.col("offset") == 0)).first()
        if not rows:
            break
        again = materialize(_pack_groups(pool, capacity, max(1, -(-rows // (group_rows * 2))), r), "pack-round")
        new = _bins(again)
        if new >= old:
            break
        done.append(packed.where((F.col("_gap") <= 0) | (F.col("_room") == 0)))
        total += new - old
        packed = again
    out = packed
    for d in done:
        out = out.unionByName(d)
    cols = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return out.select(cols).unionByName(full.select(cols))


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Every document's pieces, packed."""
    return pack_pieces(cut_documents(docs, path or vocabulary_path(TOKENIZER)))
