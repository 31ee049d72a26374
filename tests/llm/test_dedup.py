"""MinHash near-duplicates, components and embedding near-duplicates against brute force, and their edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixloom.llm import minhash_dedup as M
from helixloom.llm.components import connected_components
from helixloom.llm.embedding_dedup import near_duplicate_vectors, possible, quantised
from helixloom.llm.shared import SharedTables
from helixloom.llm.words import word_hashes

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    words = (text or "").translate(ASCII).encode().split()
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def roots(n, links):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute(texts, k, num, den):
    sets = [shingles(t, k) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
    return sets, roots(len(texts), links)


def corpus(rng):
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", " \t\n", "one", "One", "one two", "Über über", "a  b\tc", "a b c"]
    for size in (12, 60, 300):
        base = rng.choice(words, size).tolist()
        for _ in range(40):  # copies of rising distance from one text: chains and strays in one bucket
            text = list(base)
            for i in rng.integers(0, size, rng.integers(0, max(2, size // 12))):
                text[i] = str(rng.choice(words))
            texts.append(" ".join(text))
        texts += [" ".join(base), " ".join(base).upper()]
    texts.append(" ".join(rng.choice(words, 30_000)))
    return texts


@pytest.mark.parametrize(("k", "num"), [(3, 85), (5, 80)])
def test_components_match_all_pairs(spark, k, num, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_MEMBERS", 8)  # several tiles per bucket
    texts = corpus(np.random.default_rng(3))
    sets, want = brute(texts, k, num, 100)
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id bigint, text string, rep string, h string")
    got = {r.doc_id: r for r in M.near_duplicates(df, shingle_words=k, num=num, den=100).collect()}
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i].component_id for i in range(len(texts))] == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_repeats_nulls_and_nothing(spark):
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "a b c d")], "doc_id bigint, text string")
    got = sorted(((r.doc_id or 0, r.component_id, r.kept) for r in M.near_duplicates(df).collect()))
    assert got == [(0, None, True), (1, 1, True), (1, 1, True), (2, 1, False)]
    assert M.near_duplicates(df.limit(0)).count() == 0


def test_bands_keep_misses_rare():
    for s in (0.8, 0.85, 0.95):
        assert (1 - s**M.ROWS) ** M.bands_for(s) <= M.MISS


def test_shared_counts():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in (1, 5, 80, 200)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert M.shared_counts(sets, sets, width=7).tolist() == want


def test_star_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 640)] + [(7, 7)]
    want = roots(700, edges)
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), SharedTables(spark, "test")).collect()
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert {r.node: r.component for r in got} == {n: want[n] for n in nodes} and len(got) == len(nodes)


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 48)) * rng.gamma(1, 3, (300, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q = quantised(x)
    for t in (0.3, 0.6, 0.9):
        r, c, sure = possible(q, q, t)
        links = set(zip(*np.nonzero(x @ x.T >= t), strict=True))
        assert set(zip(r[sure], c[sure], strict=True)) <= links <= set(zip(r, c, strict=True))
        assert sure.any() and (t > 0.3 or not sure.all())


def test_vectors_match_all_pairs(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 16))
    rows = [(i, (base[i % 12] + rng.normal(size=16) * rng.choice([0.01, 0.1, 0.2])).astype(np.float32).tolist(), int(i % 3)) for i in range(160)]
    rows += [(200 + i, rows[0][1], 0) for i in range(5)] + [(300, None, 0), (301, [0.0] * 16, 0), (302, [float("nan")] * 16, 0), (303, [None] + [1.0] * 15, 0), (304, rows[0][1], None), (305, [], 0), (306, [1e-30] * 16, 1), (307, [2e-30] * 16, 1), (308, rows[0][1][:8], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    n = len(rows)
    good = [v is not None and label is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v, label in rows]
    unit = [np.float32(v).astype(float) if g else None for (_, v, _), g in zip(rows, good, strict=True)]
    cos = lambda a, b: a @ b / (np.linalg.norm(a) * np.linalg.norm(b))
    links = [(i, j) for i in range(n) for j in range(i) if good[i] and good[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and cos(unit[i], unit[j]) >= 0.98]
    want = roots(n, links)
    degree = np.bincount(np.array(links).ravel(), minlength=n)
    for block in (7, 2048):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(df, block=block).collect()}
        assert got == {rows[i][0]: (degree[i], rows[want[i]][0], want[i] == i) for i in range(n)}


def test_vectors_without_rows(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert near_duplicate_vectors(df).count() == 0
    assert near_duplicate_vectors(df.withColumn("links", F.lit(1))).count() == 0


def test_vectors_with_repeated_ids(spark):
    x, y = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    df = spark.createDataFrame([(1, x, 0), (1, x, 0), (1, y, 0), (2, x, 0), (None, x, 0)], "vec_id bigint, embedding array<double>, label int")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(df).collect())
    assert got == [(0, 0, None, True), (1, 0, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]


def test_word_hashes():
    rng = random.Random(5)
    words = ["a", "b", "A", "ab", "ba", "x" * 8, "x" * 9, "x" * 64, "x" * 65, "X" * 65, "ß", "Ⅳ"]
    words += ["".join(rng.choice("ab") for _ in range(n)) for n in (7, 8, 9, 16, 17, 40, 63, 64, 65, 500) for _ in range(200)]
    # two words that a polynomial hash modulo a power of two can't tell apart (Thue-Morse and its complement)
    morse = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    words += [morse, morse.translate(str.maketrans("ab", "ba"))]
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(x) for x in raw])
    starts = ends - [len(x) for x in raw]
    data = np.frombuffer(b"".join(raw), np.uint8)
    folded = [w.translate(ASCII) for w in words]
    for lower, want in ((True, folded), (False, words)):
        for seed in (0, 2):
            got = word_hashes(data, starts, ends, lower, seed).tolist()
            assert len({(h, w) for h, w in zip(got, want, strict=True)}) == len(set(got)) == len(set(want))
    assert not set(word_hashes(data, starts, ends).tolist()) & set(word_hashes(data, starts, ends, seed=2).tolist())


def test_words_alike_stay_apart(spark):
    morse = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    other = morse.translate(str.maketrans("ab", "ba"))
    df = spark.createDataFrame([(1, f"{morse} one two"), (2, f"{other} one two"), (3, f"{morse.upper()}  ONE two")], "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in M.near_duplicates(df, shingle_words=3, num=85).collect()} == {1: 1, 2: 2, 3: 1}


def test_long_texts_and_tiles_by_shingles(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_SHINGLES", 50_000)
    rng = np.random.default_rng(8)
    texts = []
    for _ in range(3):
        base = [f"w{i}" for i in rng.integers(0, 5000, 20_000)]
        for share in (0.0, 0.005, 0.04, 0.12, 0.12):
            text = list(base)
            for i in np.flatnonzero(rng.random(len(base)) < share):
                text[i] = f"v{rng.integers(0, 5000)}"
            texts.append(" ".join(text))
    sets, want = brute(texts, 5, 80, 100)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in M.near_duplicates(df).collect()}
    assert got == {i: (len(s), w) for i, (s, w) in enumerate(zip(sets, want, strict=True))}
