"""Operator 11 against brute force: the threshold join, the windows, the rounds."""

import math

import duckdb
import numpy as np
import pytest
from adsphere.llm import hard_negatives as hn
from adsphere.llm.oracles import ORACLES
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from .conftest import SF001

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """The result by its definition, for (vec_id, embedding, label)."""
    held = []
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        held.append((i, [max(-hn.CLAMP, min(hn.CLAMP, math.floor(256 * float(np.float32(x))))) for x in v],
                     (y + 1) % 10 if i % 7 == 0 else y))

    def dot(a, b):
        return sum(x * z for x, z in zip(a, b, strict=False))
    out = []
    for i, v, y in held:
        if i % 100:
            continue
        best = sorted((-dot(v, w), j) for j, w, z in held if z == y and j != i)[:5]
        other = sorted((-dot(v, w), j) for j, w, z in held if z != y)
        for p, j in best:
            window = [(s, k) for s, k in other if 30 * -p <= 100 * -s <= 90 * -p][:10]
            out += [(i, j, r + 1, k, -p, -s) for r, (s, k) in enumerate(window)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(0, 40), st.integers(1, 30), st.integers(1, 60), st.sampled_from([0.0, 0.5, 0.97, None]))
def test_join_finds_exactly_the_pairs_at_the_threshold(seed, dim, m, n, share):
    r = np.random.default_rng(seed)
    q = np.floor(r.normal(size=(m, dim)) * r.choice([3, 200]))
    x = np.floor(r.normal(size=(n, dim)) * r.choice([1, 200], size=(n, 1)))
    x[:n // 3] = q[0]  # ties
    scores = q @ x.T
    tau = np.full(m, -np.inf) if share is None else np.ceil(np.quantile(scores, share, axis=1))
    a, b, s = hn.threshold_pairs(q, x, tau)
    want = {(i, j, int(scores[i, j])) for i in range(m) for j in range(n) if scores[i, j] >= tau[i]}
    assert len(a) == len(want) and set(zip(a.tolist(), b.tolist(), s.tolist(), strict=True)) == want


def test_join_of_numbers_beyond_exact_doubles():
    q = np.full((1, 64), float(hn.CLAMP))
    x = np.array([[hn.CLAMP] * 63 + [hn.CLAMP - 1], [hn.CLAMP] * 64], float)
    exact = 64 * hn.CLAMP ** 2
    a, b, s = hn.threshold_pairs(q, x, np.array([float(exact)]))
    assert s.tolist() == [exact] and b.tolist() == [1]


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=6).astype("float32").tolist(), int(r.integers(0, 4))) for i in range(430)]
    hot = rows[3][1]
    rows += [(1000 + i, hot, 2) for i in range(150)]                      # one vector many times: ties
    rows += [(300, rows[300][1], 1), (300, rows[300][1], 1), (7, hot, 3)]  # repeated ids and rows
    rows += [(1200, None, 1), (1300, [1.0, None, 2.0], 1), (1400, [float("nan")] * 6, 1), (1500, [float("inf")] * 6, 1),
             (None, hot, 1), (1600, hot, None), (1700, [], 2), (1800, [0.5, -0.5], 2), (1900, [0.0] * 6, 0),
             (2000, [3.0e38] * 6, 3), (2100, hot, 77), (2200, hot + [1.0, 2.0], 9)]
    return rows


@pytest.mark.parametrize("block, anchors, sample, overshoot", [(2048, 512, 2048, 4), (37, 3, 40, 1), (64, 2, 1, 4)])
def test_result_equals_brute_force(spark, monkeypatch, vectors, block, anchors, sample, overshoot):
    for name, value in (("BLOCK", block), ("ANCHORS", anchors), ("SAMPLE", sample), ("OVERSHOOT", overshoot)):
        monkeypatch.setattr(hn, name, value)
    if block == 64:
        monkeypatch.setattr(hn, "GROUP_BYTES", 100)  # a broadcast for each block of anchors
    df = spark.createDataFrame(vectors, SCHEMA).repartition(3)
    for c in ("key", "slot", "score", "rank", "block", "n", "tau", "p"):
        df = df.withColumn(c, F.lit("clash"))
    assert got(hn.hard_negatives(df)) == brute(vectors)


def test_no_rows_and_no_anchors(spark):
    assert got(hn.hard_negatives(spark.createDataFrame([], SCHEMA))) == []
    assert got(hn.hard_negatives(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], SCHEMA))) == []
    assert got(hn.hard_negatives(spark.createDataFrame([(100, [1.0], 1), (2, [1.0], 2)], SCHEMA))) == []


def test_query_equals_its_sql(spark):
    from adsphere.llm.queries import QUERIES
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF001}/embeddings.parquet')")
    df = QUERIES["op11_hard_negatives"](spark, SF001)
    cur = con.execute(ORACLES["op11_hard_negatives"])
    assert [d[0] for d in cur.description] == df.columns
    assert got(df) == sorted(cur.fetchall())
