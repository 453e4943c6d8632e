"""Operators 4 and 9 against brute force, and the pipeline against its stages done plainly."""

import collections
import re

import numpy as np
import pytest
from adsphere.llm import embedding_dedup, minhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from .conftest import SF001, sentence

LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(zip(w, w[1:], strict=False)) if len(w) > 1 else frozenset([tuple(w)] if w else [])


def components(ids, linked):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in ids:
        for j in ids:
            if i < j and linked(i, j):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in ids}


def expected(rows):
    sets = collections.defaultdict(set)
    for r in rows:
        if r.doc_id is not None:
            sets[r.doc_id].add(shingles(r.text))

    def linked(i, j):
        return any(s and t and 100 * len(s & t) >= 80 * len(s | t) for s in sets[i] for t in sets[j])
    return components(sorted(sets), linked)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aB b\t\né")), max_size=14), min_size=1, max_size=6))
def test_hashed_sets_have_the_right_sizes(texts):
    hashes, bounds = minhash.shingle_hashes([t.encode() for t in texts])
    assert np.diff(bounds).tolist() == [len(shingles(t)) for t in texts]
    parts = [set(hashes[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for s, x in zip(texts, parts, strict=True):
        for t, y in zip(texts, parts, strict=True):
            assert len(shingles(s) & shingles(t)) == len(x & y)


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 2**64, 3000, dtype=np.uint64) for _ in range(2))
    common = rng.integers(0, 2**64, 12_000, dtype=np.uint64)
    sets = [np.unique(np.concatenate([a, common])), np.unique(np.concatenate([b, common]))]
    sets.append(np.unique(np.concatenate(sets)))
    regs = minhash.registers(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]))
    assert np.array_equal(np.maximum(regs[0], regs[1]), regs[2])  # the sketch of the union
    n = np.array([float(len(s)) for s in sets])
    j = minhash.estimate(regs[:1], regs[1:2], n[:1], n[1:2])[0]
    assert abs(j - 12 / 18) < 0.12


def near_copies(n=40):
    """A chain of near copies: neighbours are similar, the ends are not."""
    words = sentence(9, 200).split()
    out = []
    for i in range(n):
        words = list(words)
        for k in range(2):
            words[(i * 5 + k * 97) % 200] = f"new{i}x{k}"
        out.append((100 + i, " ".join(words)))
    return out


def test_near_duplicates_match_brute_force(spark, small, edge_docs, no_docs):
    chain = spark.createDataFrame(near_copies(), "doc_id long, text string")
    for docs in (chain, edge_docs, small("documents")):
        source = docs.collect()
        want = expected(source)
        rows = minhash.near_duplicates(docs).collect()
        assert len(rows) == len(source)
        for r in rows:
            assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
            assert r.kept == (r.doc_id is None or r.component_id == r.doc_id)
        assert collections.Counter(r.n_shingles for r in rows) == collections.Counter(len(shingles(r.text)) for r in source)
    assert minhash.near_duplicates(no_docs).count() == 0


def half_similar(n=70):
    """One group around the threshold: some pairs are similar, many are not, most documents may be."""
    rng = np.random.default_rng(11)
    base = sentence(4, 150).split()
    out = []
    for i in range(n):
        words = list(base)
        for k in rng.choice(150, int(rng.integers(2, 16)), replace=False):
            words[k] = f"own{i}x{k}"
        out.append((i, " ".join(words)))
    return out


def test_tiles_find_what_leaders_miss(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 8)
    docs = spark.createDataFrame(half_similar(), "doc_id long, text string")
    want = expected(docs.collect())
    assert 2 < len(set(want.values())) < 70
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()} == want
    # the tiles by themselves, with no link known before
    members = docs.select(F.lit(0).alias("grp"), F.col("doc_id").alias("node"), F.col("doc_id").alias("component"),
                          (F.col("doc_id") > 0).alias("stray"), F.lit(70).alias("size"), F.lit(69).alias("strays"))
    links = minhash.tile_links(members, docs.select(F.col("doc_id").alias("node"), "text")).collect()
    linked = {frozenset((r.src, r.dst)) for r in links}
    assert components(range(70), lambda i, j: frozenset((i, j)) in linked) == want


def embedded_passage(n_long=600, n_words=140, own=60):
    """Two near copies of a passage, beside longer documents that embed it."""
    passage = [f"p{i}" for i in range(n_words)]
    changed = list(passage)
    for k in (20, 60, 100):
        changed[k] = f"other{k}"
    out = [(1, " ".join(passage)), (2, " ".join(changed))]
    return out + [(100 + i, " ".join(passage + [f"d{i}w{k}" for k in range(own)])) for i in range(n_long)]


@pytest.mark.parametrize("crowd", [64, 512])
def test_copies_are_found_beside_longer_documents_that_embed_them(spark, monkeypatch, crowd):
    monkeypatch.setattr(minhash, "CROWD", crowd)
    docs = spark.createDataFrame(embedded_passage(), "doc_id long, text string")
    rows = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert rows.pop(1) == rows.pop(2) == 1
    assert all(i == c for i, c in rows.items())


def test_one_of_each_stays(edge_docs, no_docs):
    kept = minhash.keep_one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = collections.Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and 2 not in ids and ids[7] + ids[8] == 1 and ids[4] == ids[5] == 1 and ids[None] == 2
    assert minhash.keep_one_of_each(no_docs).count() == 0


def made_vectors():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):  # a group of near copies, wider than a window
        base = rng.normal(size=16) if i == 0 else base
        rows.append((i, [float(x) for x in base + rng.normal(size=16) * 0.12], 1))
    rows += [(100 + i, [float(x) for x in rng.normal(size=16)], i % 3) for i in range(50)]
    rows += [(200, rows[60][1], rows[60][2]), (201, rows[60][1], 7), (202, [2 * x for x in rows[60][1]], rows[60][2])]
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [0.0] * 16, 1), (303, [1.0, None] + [0.0] * 14, 1),
             (304, [float("nan")] + [1.0] * 15, 1), (305, [float("inf")] + [1.0] * 15, 1), (306, rows[0][1], None),
             (307, [1.0, 2.0], 1), (308, [1.0, 2.0], 1), (309, [], 1), (None, rows[0][1], 1), (0, rows[0][1], 1)]
    return rows


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors_match_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 16)
    df = spark.createDataFrame(made_vectors(), f"vec_id long, embedding array<{kind}>, label int").withColumn("n_links", F.lit(9))
    source = df.collect()

    def unit(r):
        x = r.embedding
        if r.vec_id is None or r.label is None or not x or any(v is None for v in x):
            return None
        x = np.array(x)
        return x / np.sqrt((x * x).sum()) if np.isfinite(x).all() and x.any() else None
    units = [unit(r) for r in source]

    def linked(i, j):
        return (i != j and units[i] is not None and units[j] is not None and source[i].label == source[j].label
                and len(units[i]) == len(units[j]) and float(units[i] @ units[j]) >= 0.98)
    want = collections.Counter()
    parts = components(range(len(source)), linked)
    least = collections.defaultdict(list)
    for i, p in parts.items():
        least[p].append(source[i].vec_id)
    for i, r in enumerate(source):
        c = None if r.vec_id is None else min(x for x in least[parts[i]] if x is not None)
        want[r.vec_id, sum(linked(i, j) for j in range(len(source))), c] += 1
    for window in (8, 32):
        rows = embedding_dedup.near_duplicate_vectors(df, window=window).collect()
        assert collections.Counter((r.vec_id, r.n_links, r.component_id) for r in rows) == want
        assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in rows)
    assert embedding_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1000, 6000])
def test_isolated_pairs_are_found_in_dense_labels(spark, n):
    """Vectors of cosine 0.9 to each other, some with one partner each; a narrow window stands for more rows."""
    rng = np.random.default_rng(n)

    def unit(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)
    x = unit(np.sqrt(0.9) * unit(rng.normal(size=64)) + np.sqrt(0.1) * unit(rng.normal(size=(n, 64))))
    a, t = x[:200], rng.normal(size=(200, 64))
    t = unit(t - (t * a).sum(1)[:, None] * a)
    x = np.vstack([x, 0.981 * a + np.sqrt(1 - 0.981 ** 2) * t])
    near = np.argwhere(np.triu(x @ x.T >= 0.98, 1))
    assert len(near) >= 200
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")
    part = {r.vec_id: r.component_id for r in embedding_dedup.near_duplicate_vectors(df, window=2).collect()}
    assert np.mean([part[i] == part[j] for i, j in near.tolist()]) >= 0.9


def test_pipeline_matches_its_stages_done_plainly(spark, monkeypatch):
    import corpus_pipeline
    from adsphere.llm import packing, quality_rules, secrets, toxicity

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    scores = {r.doc_id: r.score for r in toxicity.toxicity_report(
        docs, spark.read.parquet(f"{SF001}/labels.parquet")).collect()}
    left = docs.where(~F.col("doc_id").isin([i for i, s in scores.items() if s >= toxicity.REJECT_AT]))
    good = {r.doc_id for r in quality_rules.quality_report(left).collect() if r.kept}
    sets = {i: shingles(rows[i].text) for i in sorted(good)}
    parts = components(sorted(good), lambda i, j: sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]))
    kept = {i for i in good if parts[i] == i}
    clean = {r.doc_id: r.text for r in secrets.redact(docs.where(F.col("doc_id").isin(list(kept)))).collect()}
    final = spark.createDataFrame(list(clean.items()), "doc_id long, text string")
    want = collections.Counter(map(tuple, packing.cut_documents(
        final, packing.vocabulary_path(packing.TOKENIZER)).collect()))

    seen = []
    for name, stage in corpus_pipeline.STAGES:
        monkeypatch.setattr(corpus_pipeline, "STAGES", [
            (n, (lambda s, d, p, f=f: (seen.append(d.columns), f(s, d, p))[1])) for n, f in corpus_pipeline.STAGES])
        break
    got = corpus_pipeline.run(spark, SF001).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert all(c == docs.columns for c in seen) and len(seen) == 5
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "minhash", "secret_scan", "packing"]


def test_pipeline_stages_take_edge_cases(spark, edge_docs, no_docs):
    import corpus_pipeline
    for docs in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF001).columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF001).count() >= docs.count()


def test_words_whose_power_sums_agree_are_told_apart(spark):
    """Thue-Morse words and their complements: polynomial hashes modulo 2 ** 64 cannot tell them apart."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, other), (3, f"x {word} y"), (4, f"x {other} y"), (5, word), (6, word.upper())]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1, 6: 1}


def test_equal_hashes_are_not_taken_for_equal_sets(spark, monkeypatch):
    """Equal sets in another order are linked by their sets, not by a class."""
    assert minhash.sequence_hash(b"A  b\tC") == minhash.sequence_hash(b"a b c") != minhash.sequence_hash(b"a c b")
    a = "p q r s t p q r s t"
    rows = [(1, a), (2, a + " p q"), (3, "p q r s t p q"), (4, "zz " + a)]
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (5, 1), 2: (5, 1), 3: (5, 1), 4: (6, 1)}
