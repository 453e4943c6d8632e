"""Operator 12 against a plain tree over lists, and its versions against trees built anew."""

import hashlib
import zlib

import duckdb
import pytest
from adsphere.llm import merkle
from adsphere.llm.oracles import ORACLES
from pyspark.sql import functions as F

from .conftest import SF001, sentence


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, more=0):
    fields = (r.doc_id, r.source, r.lang, None if r.n_chars is None else r.n_chars + more, r.text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(nodes):
    """All levels, and the siblings of each leaf from below, with their side."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h(*low[i:i + 2]) for i in range(0, len(low), 2)])
    ways = []
    for i in range(len(nodes)):
        way = []
        for low in levels[:-1]:
            pair = low[i // 2 * 2:i // 2 * 2 + 2]
            way.append((i % 2, pair[1 - i % 2] if len(pair) == 2 else None))
            i //= 2
        ways.append(way)
    return levels[-1][0], ways


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r.lang, []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees, out = {}, []
    for x in langs:
        held = sorted(by[x], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
        trees[x] = (held, *tree([leaf(r) for r in held]))
    if not langs:
        return []
    root, tops = tree([trees[x][1] for x in langs])
    for x, top in zip(langs, tops, strict=True):
        held, subroot, ways = trees[x]
        for r, way in zip(held, ways, strict=True):
            way = way + top
            bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            node = leaf(r, int(bad))
            for odd, other in way:
                node = h(*((node,) if other is None else (other, node) if odd else (node, other)))
            out.append((r.doc_id, leaf(r), subroot, root, h(*[s for _, s in way if s]), node, node == root))
    return out


def plain(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_manifest_equals_a_plain_tree(spark, edge_docs, monkeypatch, bits):
    monkeypatch.setattr(merkle, "BLOCK_BITS", bits)
    monkeypatch.setattr(merkle.Manifest.__init__, "__defaults__", (bits,))
    more = [(i, sentence(i, 3), "de" if i % 3 else None, "s", i) for i in range(100, 137)]
    docs = edge_docs.unionByName(spark.createDataFrame(more, edge_docs.schema.fieldNames()[:5]), allowMissingColumns=True)
    got = merkle.manifest(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").collect()
    want = expected(rows)
    assert plain(got.collect()) == plain(want)
    assert any(not r[-1] for r in want)


def test_one_document_and_none(spark, no_docs):
    one = spark.createDataFrame([(14, None, None, None, None)], no_docs.schema)
    assert plain(merkle.manifest(one).collect()) == plain(expected(one.collect()))
    assert merkle.manifest(no_docs).collect() == []


def test_versions_copy_only_ancestors(spark, monkeypatch):
    monkeypatch.setattr(merkle.Manifest.__init__, "__defaults__", (2,))
    rows = [(i, f"t{i}", "en" if i % 2 else "fr", "s", 5) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {}
    for r in merkle.versions(docs).collect():
        got.setdefault(r.doc_id, {})[r.height] = r.digest
    assert set(got) == {i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 0}
    for i, nodes in got.items():
        # the tree of the tampered table, built anew, has the version's root
        other = docs.withColumn("n_chars", F.when(F.col("doc_id") == i, 6).otherwise(5).cast("long")).collect()
        assert nodes[max(nodes)] == expected(other)[0][3]
        assert sorted(nodes) == list(range(7))  # a leaf, five ancestors in its language, the root of all


def test_query_equals_its_sql(spark):
    from adsphere.llm.queries import QUERIES
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    got = QUERIES["op12_merkle"](spark, SF001)
    cur = con.execute(ORACLES["op12_merkle"])
    assert [d[0] for d in cur.description] == got.columns
    assert plain(got.collect()) == plain(cur.fetchall())
