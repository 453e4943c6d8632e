"""Operator 13: features against plain Python, the model against its tables, held-out accuracy."""

import collections
import re

import numpy as np
import pyarrow as pa
from adsphere.llm import quality_model as qm
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from .conftest import SF001, sentence

NAMES = {n: k for k, n in enumerate(qm.FEATURES)}


def plain(text):
    """Some of the features, counted one by one."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return None
    n = len(words)
    lines = [re.findall(r"[^\x20\x09-\x0D]+", x) for x in text.split("\n")]
    lines = [tuple(x) for x in lines if x]
    pairs = list(zip(words, words[1:], strict=False))
    windows = [tuple(words[i:i + 5]) for i in range(n - 4)]
    return {
        "words": np.log1p(n), "word length": sum(map(len, words)) / n, "longest word": np.log1p(max(map(len, words))),
        "characters": np.log1p(len(text)), "symbol": sum(c in "#*$%&|<>" for c in text) / len(text),
        "sentence end": sum(c in ".!?" for c in text) / n, "digit": len(re.findall("[0-9]", text)) / len(text),
        "single-letter words": sum(len(w) == 1 for w in words) / n, "ended words": sum(w[-1] in ".!?" for w in words) / n,
        "words with a symbol": sum(bool(set(w) & set("#*$%&|<>")) for w in words) / n,
        "distinct words": len(set(words)) / n, "top word": collections.Counter(words).most_common(1)[0][1] / n,
        "word after itself": sum(a == b for a, b in pairs) / n,
        "distinct pairs": len(set(pairs)) / len(pairs) if pairs else 1.0,
        "distinct windows": len(set(windows)) / len(windows) if windows else 1.0,
        "lines": np.log1p(len(lines)), "repeated lines": 1 - len(set(lines)) / len(lines),
        "longest line": np.log1p(max(map(len, lines))), "clauses": text.count(",") / n,
    }


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab B.1#é日,\t \n\n")), max_size=60), max_size=6))
def test_features_equal_plain_counts(texts):
    x = qm.batch_features(pa.array(texts, pa.string()))
    assert x.shape == (len(texts), len(qm.FEATURES)) and np.isfinite(x).all()
    for t, row in zip(texts, x, strict=True):
        want = plain(t)
        if want is None:
            assert not row.any()
        else:
            for name, value in want.items():
                assert np.isclose(row[NAMES[name]], value), (name, t)


def test_features_do_not_depend_on_the_batch(monkeypatch):
    texts = [sentence(i, 5 + 40 * i) for i in range(20)] + ["", None, "x" * 50_000]
    together = qm.batch_features(pa.array(texts))
    assert np.allclose(together, np.concatenate([qm.batch_features(pa.array([t], pa.string())) for t in texts]))
    monkeypatch.setattr(qm, "SLICE_BYTES", 100)
    assert np.allclose(together[3:], qm.batch_features(pa.array(texts).slice(3)))


def test_score_is_the_sum_of_table_cells():
    r = np.random.default_rng(3)
    x = r.normal(size=(1500, 4))
    x[:, 3] = r.integers(0, 3, 1500)
    # the third and fourth feature count only together
    odds = 3 * np.sin(2 * x[:, 0]) + 2 * np.where((x[:, 2] > 0) == (x[:, 3] > 1), 1, -1)
    y = (r.random(1500) < 1 / (1 + np.exp(-odds))).astype(int)
    m = qm.fit(x, y)
    assert (2, 3) in m.pairs
    got = m.score(x)
    for i in range(0, 1500, 97):
        total = m.intercept
        for k in range(4):
            total += m.tables[k][sum(c <= x[i, k] for c in m.cuts[k])]
        for (a, b), t in zip(m.pairs, m.pair_tables, strict=True):
            total += t[sum(c <= x[i, a] for c in m.pair_cuts[a]), sum(c <= x[i, b] for c in m.pair_cuts[b])]
        assert np.isclose(got[i], 1 / (1 + np.exp(-total)))
    alone = qm.Model(m.cuts, m.tables, m.pair_cuts, [], [], m.intercept)

    def hits(p):
        return ((p >= 0.5) == y).mean()
    # labels are drawn, so even the true odds miss some
    assert hits(got) > hits(alone.score(x)) + 0.05 and hits(got) > hits(1 / (1 + np.exp(-odds))) - 0.05


def test_frequency_moves_the_intercept():
    x = np.repeat([[0.0], [1.0]], 200, axis=0)
    y = np.tile([0, 1], 200)  # nothing to tell them apart
    assert np.allclose(qm.fit(x, y, 0.9).score(x), 0.9, atol=0.02)


def test_nothing_to_learn(spark, edge_docs):
    assert qm.fit(np.zeros((0, 29)), np.zeros(0, int)).score(np.zeros((2, 29))).tolist() == [0.0, 0.0]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in qm.quality_scores(edge_docs, none).collect()} == {0.0}
    both = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (2, None, 0), (3, 5, 0), (None, 1, 0), (9, 1, 1)], none.schema)
    assert {r.score for r in qm.quality_scores(edge_docs, both).collect()} == {1.0}


def test_edge_documents(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 14)], "doc_id long, quality int, toxic int")
    got = qm.quality_scores(edge_docs, labels)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= qm.PREDICT_AT) for r in rows)
    blank = {r.score for r in rows if r.doc_id in (4, 5, 6)}
    assert len(blank) == 1  # empty, NULL and blank texts score alike
    assert qm.quality_scores(no_docs, labels).collect() == []


def test_held_out_rows_and_labels_do_not_matter(spark, small):
    docs, labels = small("documents"), small("labels")
    plain_scores = {r.doc_id: r.score for r in qm.quality_scores(docs, labels).collect()}
    turned = labels.withColumn("quality", F.when(qm.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    assert {r.doc_id: r.score for r in qm.quality_scores(other, turned).collect()} == plain_scores


def test_held_out_accuracy(spark):
    def read(name):
        return spark.read.parquet(f"{SF001.replace('0.001', '0.1')}/{name}.parquet")
    rows = qm.quality_scores(read("documents"), read("labels")).where("held_out").join(read("labels"), "doc_id").collect()
    good = [r.predicted for r in rows if r.quality == 1]
    bad = [r.predicted for r in rows if r.quality == 0]
    assert sum(good) / len(good) >= 0.98 and sum(bad) / len(bad) <= 0.08
