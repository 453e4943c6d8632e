"""The binary IP range file as a Spark data source.

The format, as commonly published for this kind of file (all numbers little-endian):

* header: the offsets of the first and of the last index entry, 4 bytes each;
* index entry, 7 bytes, ascending: the range's first address (4), the offset of its record (3);
* record: the range's last address (4), then two texts, country and area, in GBK, each ended by a
  zero byte.  A text may stand elsewhere: mode byte 2 and a 3-byte offset in its place.  Mode byte 1
  and an offset in the place of both texts say where both stand, where the country may be redirected
  once more.  An area redirected to offset 0 is missing.

Offsets have three bytes, so a file has less than 16 MB: that bound is what lets a reader hold it and
the driver write it.  ``spark.read.format("ip_range_file")`` splits the *index* into partitions and
decodes each one's records in its own task; it opens the path as a file, on a folder that the executors
share.  :func:`read_range_file` takes any path that Spark reads, through ``binaryFile``, and decodes the
same way.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "start_ip long, end_ip long, country string, area string"
MAX_BYTES = 1 << 24
ENTRY, HEADER = 7, 8
ENCODING = "gbk"
BOTH, ONE = 1, 2  # mode bytes
ENTRIES_PER_TASK = 50_000


# ---------------------------------------------------------------- bytes


def _number(data: bytes, at: int, size: int) -> int:
    if at + size > len(data):
        raise ValueError(f"the range file ends before byte {at + size}")
    return int.from_bytes(data[at:at + size], "little")


def _text(data: bytes, at: int) -> tuple[str, int]:
    """A text that stands at ``at``, and where it ends."""
    end = data.find(b"\0", at)
    if end < 0:
        raise ValueError(f"a text at byte {at} of the range file has no end")
    return data[at:end].decode(ENCODING, "replace"), end + 1


def _maybe_elsewhere(data: bytes, at: int) -> tuple[str | None, int]:
    """A text at ``at`` or where a redirection there points to, and where the next field begins."""
    if _number(data, at, 1) not in (BOTH, ONE):
        return _text(data, at)
    target = _number(data, at + 1, 3)
    return (_text(data, target)[0] if target else None), at + 4


def record(data: bytes, at: int) -> tuple[int, str | None, str | None]:
    """(last address, country, area) of the record at ``at``."""
    last, at = _number(data, at, 4), at + 4
    if _number(data, at, 1) == BOTH:
        at = _number(data, at + 1, 3)
    country, at = _maybe_elsewhere(data, at)
    return last, country, _maybe_elsewhere(data, at)[0]


def index_bounds(header: bytes) -> tuple[int, int]:
    """(offset of the first entry, number of entries)."""
    first, last = _number(header, 0, 4), _number(header, 4, 4)
    if last < first or (last - first) % ENTRY:
        raise ValueError("the range file's header does not bound an index")
    return first, (last - first) // ENTRY + 1


def entries(data: bytes, first: int, number: int) -> Iterator[tuple[int, int, str | None, str | None]]:
    """(start_ip, end_ip, country, area) of ``number`` index entries from byte ``first`` on."""
    for at in range(first, first + number * ENTRY, ENTRY):
        last, country, area = record(data, _number(data, at + 4, 3))
        yield _number(data, at, 4), last, country, area


def as_batch(rows: Iterable[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                      names=["start_ip", "end_ip", "country", "area"])


def range_file_bytes(rows: Iterable[tuple[int, int, str | None, str | None]]) -> bytes:
    """A range file of (start_ip, end_ip, country, area); equal texts, and equal pairs, are stored once."""
    body, texts, pairs, index = bytearray(HEADER), {}, {}, []

    def offset(at: int) -> bytes:
        if at >= MAX_BYTES:
            raise ValueError("a range file holds less than 16 MB")
        return at.to_bytes(3, "little")

    def put(text: str | None) -> None:
        if text is None:
            body.extend(bytes([ONE]) + offset(0))
        elif text in texts:
            body.extend(bytes([ONE]) + offset(texts[text]))
        else:
            raw = text.encode(ENCODING)
            if b"\0" in raw or raw[:1] in (bytes([BOTH]), bytes([ONE])):
                raise ValueError("a text of a range file neither holds a zero byte nor begins with a mode byte")
            texts[text] = len(body)
            body.extend(raw + b"\0")

    for start, end, country, area in sorted(rows):
        index.append(start.to_bytes(4, "little") + offset(len(body)))
        body.extend(end.to_bytes(4, "little"))
        if (country, area) in pairs:
            body.extend(bytes([BOTH]) + offset(pairs[country, area]))
        else:
            pairs[country, area] = len(body)
            put(country or "")
            put(area)
    first = len(body)
    if not index:
        raise ValueError("a range file has at least one range")
    out = bytes(body) + b"".join(index)
    if len(out) > MAX_BYTES:
        raise ValueError("a range file holds less than 16 MB")
    head = first.to_bytes(4, "little") + (first + (len(index) - 1) * ENTRY).to_bytes(4, "little")
    return head + out[HEADER:]


# ---------------------------------------------------------------- data source


class IndexSlice(InputPartition):
    def __init__(self, first: int, number: int):
        self.first, self.number = first, number


class RangeFileReader(DataSourceReader):
    def __init__(self, options: dict):
        if "path" not in options:
            raise ValueError("a range file needs a path")
        self.path = options["path"].removeprefix("file://").removeprefix("file:")
        self.per_task = int(options.get("entriesPerPartition", ENTRIES_PER_TASK))

    def partitions(self) -> list[IndexSlice]:
        with open(self.path, "rb") as f:
            first, number = index_bounds(f.read(HEADER))
        return [IndexSlice(first + k * ENTRY, min(self.per_task, number - k)) for k in range(0, number, self.per_task)]

    def read(self, partition: IndexSlice) -> Iterator[pa.RecordBatch]:
        with open(self.path, "rb") as f:
            data = f.read(MAX_BYTES)  # records refer to texts anywhere
        yield as_batch(entries(data, partition.first, partition.number))


class RangeFileSource(DataSource):
    """``spark.read.format("ip_range_file").load(path)``."""

    @classmethod
    def name(cls) -> str:
        return "ip_range_file"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RangeFileReader:
        return RangeFileReader(self.options)


def register_range_file(spark: SparkSession) -> None:
    spark.dataSource.register(RangeFileSource)


def read_range_file(spark: SparkSession, path: str, per_task: int = ENTRIES_PER_TASK) -> DataFrame:
    """The ranges of a file at any path that Spark reads: a row per slice of the index, decoded in its own task."""

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"].to_pylist():
                first, number = index_bounds(content[:HEADER])
                for k in range(0, number, per_task):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([content], pa.binary()), pa.array([first + k * ENTRY], pa.int64()),
                         pa.array([min(per_task, number - k)], pa.int64())], names=["content", "first", "number"])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield as_batch(entries(row["content"], row["first"], row["number"]))

    # less than 16 MB per slice, by the format
    content = spark.read.format("binaryFile").load(path).select("content")
    return (content.mapInArrow(slices, "content binary, first long, number long").repartition("first")
            .mapInArrow(decode, SCHEMA))


def write_range_file(spark: SparkSession, ranges: DataFrame, path: str) -> str:
    """Write (start_ip, end_ip, country, area) as a range file; the format bounds what the driver holds."""
    limit = MAX_BYTES // (ENTRY + 8)  # no range takes less than an entry, an address and a redirection
    rows = [tuple(r) for r in ranges.select("start_ip", "end_ip", "country", "area").limit(limit + 1).collect()]
    if len(rows) > limit:
        raise ValueError("more ranges than a range file holds")
    data = range_file_bytes(rows)
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hpath, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return path


def file_ranges(spark: SparkSession, path: str) -> DataFrame:
    """The ranges of a file as the ODS build takes them: the format has no coordinates."""
    none = F.lit(None).cast("float")
    return read_range_file(spark, path).withColumns({"longitude": none, "latitude": none})
