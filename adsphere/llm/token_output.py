"""Token ids as binary blocks (operator 7): frequency ranks in byte-aligned variable length.

1. Every text is encoded once and its ids are stored as 16- or 32-bit words.
2. Ids are counted over the whole corpus; the most frequent id gets rank 0 (ties: smaller
   id).  The rank table has one row per vocabulary entry, so it is handed to all tasks.
3. Each document becomes ranks in 1 to 4 bytes, with 2 control bits per rank kept in separate
   control bytes (four ranks each).  Documents are dealt to files by ``doc_id`` range, sorted,
   and written as blocks: one block holds the header, then the control bytes and the data
   bytes of consecutive documents.
4. Reading takes the blocks back from the files: a 256-entry table turns control bytes into
   lengths, running sums into offsets, and the rank table ranks into ids.

A block is a ``binary`` value of a Parquet file, so that every file system Spark writes to can
hold the output.  Block layout (little-endian): magic ``TIDB``, uint32 documents, uint64 ids
before the block; per document int64 doc_id, uint8 doc_id-is-null, uint64 ids, uint64 data
bytes; control bytes of all documents (each document starts on a byte); data bytes.

The ranges come from approximate quantiles of ``doc_id`` alone, as many as the stored ids
need; ids before a range are a running sum over as many rows as there are ranges.

Defined cases: a NULL text is empty and gives the end id alone; NULL ``doc_id`` rows come
first; repeated rows are written each; an empty table gives an empty result; other columns of
the input are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import _delete, scratch_path
from .tokens import byte_slices, ragged, tokenizer_file, vocabulary_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
BLOCK_IDS = 1 << 20   # ids after which a block is closed (a longer document is a block of its own)
FILE_IDS = 8 << 20    # ids per file, about
MAGIC = b"TIDB"
HEAD = struct.Struct("<4sIQ")
DOC = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<u8"), ("data", "<u8")])

#: lengths of the four ranks of a control byte, by control byte
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def block_header(n_docs: int, start: int) -> bytes:
    return HEAD.pack(MAGIC, n_docs, start)


def encode_ids(docs: DataFrame, path: str, end_id: int | None) -> DataFrame:
    """(doc_id, n, ids): each document's ids, with ``end_id`` behind them, as a run of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer_file(path)
        word = np.dtype("<u2" if t.size <= 1 << 16 else "<u4")
        end = np.array([] if end_id is None else [end_id], word).tobytes()
        for batch in batches:
            for a, b in byte_slices(batch["text"]):
                ids, bounds = t.encode(batch["text"][a:b])
                raw, at = memoryview(ids.astype(word).tobytes()), (bounds * word.itemsize).tolist()
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][a:b].cast(pa.int64()),
                     pa.array(np.diff(bounds) + len(end) // word.itemsize, pa.int64()),
                     pa.array([bytes(raw[i:j]) + end for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                     pa.array(np.full(b - a, word.itemsize, np.int32))],
                    names=["doc_id", "n", "ids", "width"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, ids binary, width int")


def _words(batch: pa.RecordBatch) -> np.ndarray:
    """All ids of a batch of stored runs in a row."""
    raw = batch["ids"]
    width = batch["width"][0].as_py()
    buf = np.frombuffer(b"".join(raw.to_pylist()), np.dtype(f"<u{width}"))
    return buf


def id_counts(stored: DataFrame) -> DataFrame:
    """(id, n): how often each id occurs in the stored runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows:
                c = np.bincount(_words(batch))
                if len(c) > len(total):
                    c, total = total, c.astype(np.int64)
                total[:len(c)] += c
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    per_task = stored.select("ids", "width").mapInArrow(run, "id long, n long")
    return per_task.groupBy("id").agg(F.sum("n").alias("n"))


def rank_table(counts: DataFrame) -> np.ndarray:
    """ids by rank; its length is bounded by the vocabulary."""
    rows = counts.toPandas()
    return rows.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(np.uint32)


def pack_ranks(ranks: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(control, control bounds, data, data bounds) of the runs ``ranks[bounds[i]:bounds[i + 1]]``."""
    n = np.diff(bounds)
    codes = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    quads = -(-n // 4)
    cbounds = np.concatenate([[0], np.cumsum(quads)])
    padded = np.zeros(int(cbounds[-1]) * 4, np.uint8)
    padded[ragged(cbounds[:-1] * 4, n)] = codes
    four = padded.reshape(-1, 4)
    control = (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8)
    ends = np.concatenate([[0], np.cumsum(codes.astype(np.int64) + 1)])
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) <= codes[:, None]]
    return control, cbounds, data, ends[bounds]


def unpack_ranks(control: np.ndarray, data: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The ranks of runs of ``n[i]`` ranks each, by table lookup of the control bytes."""
    quads = -(-n // 4)
    lengths = LENGTHS[control].reshape(-1)[ragged((np.cumsum(quads) - quads) * 4, n)].astype(np.int64)
    at = np.cumsum(lengths) - lengths
    out = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(lengths > k)
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _packed(stored: DataFrame, rank_of: np.ndarray, bounds: np.ndarray) -> DataFrame:
    """(file, doc_id, n, control, data) of every stored run; ``file`` by range of ``doc_id``."""
    sc = stored.sparkSession.sparkContext
    ranks, edges = sc.broadcast(rank_of), sc.broadcast(bounds)  # vocabulary entries; number of files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch["n"].to_numpy()
            b = np.concatenate([[0], np.cumsum(n)])
            control, cb, data, db = pack_ranks(ranks.value[_words(batch)], b)
            control, data = memoryview(control.tobytes()), memoryview(data.tobytes())
            ids = batch["doc_id"].fill_null(-(1 << 63)).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.searchsorted(edges.value, ids, side="right").astype(np.int32)), batch["doc_id"], batch["n"],
                 pa.array([bytes(control[i:j]) for i, j in zip(cb[:-1], cb[1:], strict=True)], pa.binary()),
                 pa.array([bytes(data[i:j]) for i, j in zip(db[:-1], db[1:], strict=True)], pa.binary())],
                names=["file", "doc_id", "n", "control", "data"])

    return stored.mapInArrow(run, "file int, doc_id long, n long, control binary, data binary")


def _blocks(packed: DataFrame, before: dict[int, int]) -> DataFrame:
    """(file, block, payload): consecutive documents of one file joined to blocks.

    ``before`` holds, per file, the ids of all files before it: one number per file.
    """
    base = packed.sparkSession.sparkContext.broadcast(before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {"file": None, "block": 0, "start": 0, "held": 0}
        held: list[tuple] = []

        def close() -> pa.RecordBatch:
            docs = np.zeros(len(held), DOC)
            for k, (doc_id, n, _, data) in enumerate(held):
                docs[k] = (doc_id or 0, doc_id is None, n, len(data))
            payload = b"".join([block_header(len(held), state["start"]), docs.tobytes(),
                                *[h[2] for h in held], *[h[3] for h in held]])
            out = pa.RecordBatch.from_arrays(
                [pa.array([state["file"]], pa.int32()), pa.array([state["block"]], pa.int32()),
                 pa.array([payload], pa.binary())], names=["file", "block", "payload"])
            state["start"] += state["held"]
            state["block"] += 1
            state["held"] = 0
            held.clear()
            return out

        for batch in batches:
            for row in zip(*[batch[c].to_pylist() for c in ("file", "doc_id", "n", "control", "data")], strict=True):
                if held and (row[0] != state["file"] or state["held"] + row[2] > BLOCK_IDS):
                    yield close()
                if row[0] != state["file"]:
                    state.update(file=row[0], block=0, start=base.value.get(row[0], 0))
                held.append(row[1:])
                state["held"] += row[2]
        if held:
            yield close()

    return packed.mapInArrow(run, "file int, block int, payload binary")


def write_token_files(docs: DataFrame, path: str, out: str, end_id: int = END_ID) -> None:
    """Encode all documents and write ``out/blocks`` and ``out/ranks``."""
    spark = docs.sparkSession
    kept = scratch_path(spark, f"token-ids-{out.rstrip('/').rsplit('/', 1)[-1]}")
    (encode_ids(docs, path, end_id).write.mode("overwrite").option("compression", "zstd").parquet(kept))
    stored = spark.read.parquet(kept)
    ids_by_rank = rank_table(id_counts(stored))
    spark.createDataFrame([(r, int(i)) for r, i in enumerate(ids_by_rank)], "rank long, id long").coalesce(1) \
        .write.mode("overwrite").parquet(f"{out}/ranks")
    rank_of = np.zeros(int(ids_by_rank.max()) + 1 if len(ids_by_rank) else 1, np.uint32)
    rank_of[ids_by_rank] = np.arange(len(ids_by_rank), dtype=np.uint32)

    total = stored.agg(F.sum("n")).first()[0] or 0
    n_files = max(1, -(-total // FILE_IDS))
    cuts = stored.select("doc_id").approxQuantile(
        "doc_id", [i / n_files for i in range(1, n_files)], 0.2 / n_files) if n_files > 1 else []
    edges = np.unique(np.array(cuts or [], np.float64)).astype(np.int64)
    sums = {r["file"]: r["n"] for r in _file_sums(stored, edges).collect()}  # one row per file
    before, run = {}, 0
    for f in sorted(sums):
        before[f], run = run, run + sums[f]
    packed = (_packed(stored, rank_of, edges).repartitionById(len(edges) + 1, F.col("file"))
              .sortWithinPartitions("file", "doc_id", "n", "control", "data"))
    _blocks(packed, before).write.mode("overwrite").option("compression", "uncompressed").parquet(f"{out}/blocks")
    _delete(spark, kept)


def _file_sums(stored: DataFrame, edges: np.ndarray) -> DataFrame:
    """(file, n): ids per range of ``doc_id``."""
    cut = stored.sparkSession.sparkContext.broadcast(edges)  # one number per file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(cut.value) + 1, np.int64)
        for batch in batches:
            ids = batch["doc_id"].fill_null(-(1 << 63)).to_numpy()
            np.add.at(sums, np.searchsorted(cut.value, ids, side="right"), batch["n"].to_numpy())
        f = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(f, pa.int32()), pa.array(sums[f])], names=["file", "n"])

    return (stored.select("doc_id", "n").mapInArrow(run, "file int, n long")
            .groupBy("file").agg(F.sum("n").alias("n")))


def read_block(payload: bytes, ids_by_rank: np.ndarray):
    """(doc ids or None, first start, ids per document, all ids) of one block."""
    magic, n_docs, start = HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a token block")
    docs = np.frombuffer(payload, DOC, n_docs, HEAD.size)
    n = docs["n"].astype(np.int64)
    at = HEAD.size + docs.nbytes
    n_control = int((-(-n // 4)).sum())
    control = np.frombuffer(payload, np.uint8, n_control, at)
    data = np.frombuffer(payload, np.uint8, int(docs["data"].sum()), at + n_control)
    ids = ids_by_rank[unpack_ranks(control, data, n)].astype("<u4")
    return [None if z else int(d) for d, z in zip(docs["doc_id"], docs["null"], strict=True)], start, n, ids


def read_token_files(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    ranks = spark.read.parquet(f"{out}/ranks").toPandas()  # one row per vocabulary entry
    table = spark.sparkContext.broadcast(ranks.sort_values("rank")["id"].to_numpy(np.uint32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch["payload"]:
                doc_ids, start, n, ids = read_block(payload.as_py(), table.value)
                raw, at = memoryview(ids.tobytes()), np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(at[:-1] + start, pa.int64()), pa.array(n),
                     pa.array([zlib.crc32(raw[4 * i:4 * j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)],
                              pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (spark.read.parquet(f"{out}/blocks").select("payload")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_files_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the token files under the shared folder and report them as read back."""
    import uuid

    spark = docs.sparkSession
    out = scratch_path(spark, f"token-files-{uuid.uuid4().hex}")
    write_token_files(docs, path or vocabulary_path(TOKENIZER), out)
    return read_token_files(spark, out)
