"""The binary IP range file: bytes, data source, reader, lookup."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adsphere.plans.ods import lookup_ips
from adsphere.sources import range_file as rf
from adsphere.sources.dims import ip_ranges
from conftest import SF001

TEXT = st.text(alphabet=st.sampled_from("省市广东北京ab 1"), max_size=6)


def decode(data):
    return list(rf.entries(data, *rf.index_bounds(data)))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**32 - 1), TEXT, st.none() | TEXT), min_size=1, max_size=30, unique_by=lambda t: t[0]))
def test_bytes_come_back(parts):
    rows = sorted((ip, min(ip + 5, 2**32 - 1), country, area) for ip, country, area in parts)
    assert decode(rf.range_file_bytes(rows)) == rows


def test_every_redirection():
    """A file made by hand: inline texts, country elsewhere, both elsewhere (plainly and once more), area elsewhere or missing."""
    body = bytearray(8)
    text = {}
    for name in ("中国", "联通", "X"):
        text[name] = len(body)
        body += name.encode("gbk") + b"\0"

    def at(n):
        return n.to_bytes(3, "little")
    starts = []
    for rec in ("A省".encode("gbk") + b"\0" + b"area\0",                                # inline
                b"\2" + at(text["中国"]) + b"here\0",                                    # country elsewhere
                b"\2" + at(text["中国"]) + b"\2" + at(text["联通"]),                     # both, each on its own
                b"B\0" + b"\2" + at(0)):                                                 # no area
        starts.append(len(body))
        body += (len(starts) * 100 + 9).to_bytes(4, "little") + rec
    both = (starts[0] + 4, starts[1] + 4)
    for target in both:                                                                  # both at once
        starts.append(len(body))
        body += (len(starts) * 100 + 9).to_bytes(4, "little") + b"\1" + at(target)
    first = len(body)
    for i, s in enumerate(starts):
        body += ((i + 1) * 100).to_bytes(4, "little") + at(s)
    body[:8] = first.to_bytes(4, "little") + (len(body) - 7).to_bytes(4, "little")
    assert decode(bytes(body)) == [
        (100, 109, "A省", "area"), (200, 209, "中国", "here"), (300, 309, "中国", "联通"), (400, 409, "B", None),
        (500, 509, "A省", "area"), (600, 609, "中国", "here")]


def test_broken_files_are_refused():
    good = rf.range_file_bytes([(1, 2, "a", "b"), (5, 6, "a", "c")])
    for bad in (b"", good[:5], good[:4] + (0).to_bytes(4, "little") + good[8:], good[:-1]):
        with pytest.raises(ValueError):
            decode(bad)
    for rows in ([], [(1, 2, "\x01", None)], [(1, 2, "a\0", None)]):
        with pytest.raises(ValueError):
            rf.range_file_bytes(rows)


def test_data_source_and_reader_give_the_same_rows(spark, tmp_path):
    path = str(tmp_path / "ranges.dat")
    want = [tuple(r) for r in ip_ranges(spark, SF001).select("start_ip", "end_ip", "country", "area").collect()]
    rf.write_range_file(spark, ip_ranges(spark, SF001), path)
    rf.register_range_file(spark)
    source = spark.read.format("ip_range_file").option("entriesPerPartition", 7).load(path)
    assert source.rdd.getNumPartitions() == -(-len(want) // 7)
    assert sorted(map(tuple, source.collect())) == sorted(want)
    assert sorted(map(tuple, rf.read_range_file(spark, path, 7).collect())) == sorted(want)


def test_lookup_from_the_file(spark, tmp_path):
    path = rf.write_range_file(spark, ip_ranges(spark, SF001), str(tmp_path / "r.dat"))
    ips = spark.createDataFrame([("16.0.0.0",), ("16.0.4.50",), ("17.0.1.1",), ("9.9.9.9",), ("no",)], "ip string")
    got, want = (lookup_ips(ips, r).drop("longitude", "latitude").orderBy("ip").collect()
                 for r in (rf.file_ranges(spark, path), ip_ranges(spark, SF001)))
    assert got == want
    assert lookup_ips(ips, rf.file_ranges(spark, path)).where(F.col("longitude").isNotNull()).isEmpty()
