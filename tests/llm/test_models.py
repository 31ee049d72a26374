"""Language identification and quality: held-out accuracy and edge cases; the pipeline's decisions."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helixloom.llm import language_id, quality_pu, queries, sampling

SF = "/root/testdata/sf0.01"


def test_language_accuracy(spark):
    rows = queries.op3_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("lang is not null").collect()
    held = [r for r in rows if r.held_out]
    assert {r.held_out for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2} == {True}
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97


def test_language_edges(spark):
    net = language_id.train([("the cat is on the mat and that", "en"), ("der hund ist auf der matte und das", "de")] * 20)
    odd = [(1, None), (2, ""), (3, "123 !!"), (4, "the mat and that"), (None, "der hund"), (4, "der hund ist auf der matte " * 5000)]
    df = spark.createDataFrame(odd, "doc_id bigint, text string").withColumn("lang", F.lit("zz")).withColumn("score", F.lit(9))
    got = language_id.predict(df, net).collect()
    assert [r.lang_pred for r in sorted(got, key=lambda r: (r.doc_id or 0, r.score))[1:4]] == ["und"] * 3
    assert all(0 <= r.score <= 1 for r in got) and len(got) == 6
    assert {r.lang_pred for r in language_id.predict(df, None).collect()} == {"und"}
    assert language_id.predict(df.limit(0), net).count() == 0
    assert language_id.train([]) is None and language_id.train([("1", "en")]) is None


def test_tables_equal_the_network():
    net = language_id.ByteConvNet(["a", "b"])
    x = np.random.default_rng(0).integers(0, 256, (5, language_id.WINDOW)).astype(np.uint8)
    best, _ = net._pool(x)
    want = language_id._softmax(np.maximum(np.concatenate(best, 1) + net.bias, 0) @ net.dense + net.out)
    assert np.allclose(net.probabilities(x, net.tables()), want, atol=1e-5)


def test_gradients_of_the_network():
    net = language_id.ByteConvNet(["a", "b", "c"])
    for i, p in enumerate(net._params()):
        p *= 1 if i else 3
    x, y = np.random.default_rng(1).integers(0, 256, (6, language_id.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])
    loss = lambda: -np.log(net.probabilities(x, net.tables())[np.arange(6), y]).mean()
    for p, g in zip(net._params(), net._gradients(x, y, np.ones(6)), strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = p[at], 2e-3
        p[at] = old + step
        up = loss()
        p[at] = old - step
        down = loss()
        p[at] = old
        assert abs((up - down) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 2e-3


def test_quality_accuracy(spark):
    rows = queries.op5_quality_classifier(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    s, y = np.array([r.score for r in held]), np.array([r.quality for r in held])
    auc = (s[y == 1][:, None] > s[y == 0][None, :]).mean()
    assert auc > 0.97 and np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)


def test_quality_edges(spark):
    rng = np.random.default_rng(0)
    good = [" ".join(rng.choice(["house", "tree", "and", "river", "of"], 40)) + "." for _ in range(80)]
    bad = ["!! $$ " * 30 + str(i) for i in range(80)]
    net = quality_pu.train([(t, 1) for t in good[:60]] + [(t, 0) for t in bad[:20]], good + bad)
    df = spark.createDataFrame([(1, None), (2, ""), (3, good[70]), (4, bad[70]), (None, good[71])], "doc_id bigint, text string").withColumn("quality", F.lit(1))
    got = {r.doc_id: r.score for r in quality_pu.predict(df, net).collect()}
    assert got[1] == got[2] and got[3] > 0.7 > got[4] and len(got) == 5
    assert 0.2 < net.prior < 0.8
    assert quality_pu.train([], good) is None and quality_pu.train([("x", 0)], good) is None
    assert {r.score for r in quality_pu.predict(df, None).collect()} == {0.0}
    assert quality_pu.good_quality(df, None).count() == 5 and quality_pu.predict(df.limit(0), net).count() == 0


def test_fits_with_clashing_columns_and_repeats(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    for name in ("picked", "told", "keep", "o", "i", "h", "r", "c0", "b"):
        docs, labels = docs.withColumn(name, F.lit("x")), labels.withColumn(name, F.lit("x"))
    repeats = docs.union(docs.limit(1).crossJoin(spark.range(500)).drop("id"))
    one, two = (language_id.fit(d, F.lit(True)) for d in (docs, repeats))
    assert all(np.array_equal(a, b) for a, b in zip(one._params(), two._params(), strict=True))
    one, two = (quality_pu.fit(d, m, F.lit(True)) for d, m in ((docs, labels), (docs.repartition(5), labels.union(labels))))
    assert all(np.array_equal(a, b) for a, b in zip(one.params(), two.params(), strict=True)) and one.prior == two.prior
    # what describes the corpus covers all rows, repeated ones too
    texts = [r.text for r in docs.collect() if r.text is not None]
    x = quality_pu._matrix(texts)
    mean, scale = quality_pu.corpus_moments(docs.where("text is not null").select("text"))
    assert np.allclose(mean, x.mean(0), atol=1e-4) and np.allclose(scale, x.std(0) + 1e-3, atol=5e-3)
    margins = one.margin(one.ready(x))
    steps = np.quantile(margins, [0.1, 0.5, 0.9])
    counts, n = quality_pu.corpus_above(docs.where("text is not null").select("text"))(one, steps)
    assert n == len(texts) and np.abs(counts - [(margins >= t).sum() for t in steps]).max() <= 1
    assert not np.array_equal(one.mean, quality_pu.fit(repeats, labels, F.lit(True)).mean)
    assert language_id.fit(docs.limit(0), F.lit(True)) is None and quality_pu.fit(docs.limit(0), labels, F.lit(True)) is None
    assert quality_pu.fit(docs, labels.limit(0), F.lit(True)) is None


def test_samples_are_bounded(spark):
    rows = spark.createDataFrame([(i % 50 if i < 400 else 7, f"text {i}") for i in range(1000)] + [(None, "x")], "id bigint, text string")
    got = sampling.sample_rows(rows, "id", F.lit(True), ["text"], 20, 3)
    assert len(got) == 20 == len({i for i, _ in got}) and got == sampling.sample_rows(rows.repartition(5), "id", F.lit(True), ["text"], 20, 3)
    assert sum(len(t) for _, t in sampling.sample_rows(rows, "id", F.lit(True), ["text"], 20, 3, most_chars=60)) <= 60
    assert {i for i, _ in sampling.rows_of(rows, "id", [7, 3, 7, 999], ["text"], F.lit(True))} == {3, 7}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    out, docs = {}, spark.read.parquet(f"{SF}/documents.parquet")
    out["input"] = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "t")
        stage(spark, docs, SF).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_pipeline_filters(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for name in ("quality", "language", "near_dedup", "secrets"):
        assert stages[name].columns == stages["input"].columns
    gone = stages["input"].join(stages["quality"], "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.where("quality = 1").count() <= 1 and gone.where("quality = 0").count() >= 40
    lost = stages["quality"].join(stages["language"], "doc_id", "left_anti")
    assert lost.where("lang is not null").count() <= 2


def test_pipeline_near_duplicates(stages):
    rows = {r.doc_id: r.text for r in stages["language"].collect()}
    ids = sorted(rows)

    def grams(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = [grams(rows[i]) for i in ids]
    where = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    up = list(range(len(ids)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in enumerate(sets):
        near = {}
        for g in s:
            for j in where[g]:
                if j < i:
                    near[j] = near.get(j, 0) + 1
        for j, n in near.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    want = {ids[i] for i in range(len(ids)) if find(i) == i}
    assert {r.doc_id for r in stages["near_dedup"].select("doc_id").collect()} == want


def test_pipeline_packs_everything(stages):
    pieces = stages["packing"]
    assert pieces.select("doc_id").distinct().count() == stages["secrets"].count()
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_stages_with_odd_rows(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    schema = docs.schema
    text = "one plain text of some words that says the same as the other one does " * 3
    odd = [(None, text, None, None, None), (900, text, "en", "s", 1), (900, text, "en", "s", 1), (901, text.upper(), None, "s", 1), (900, "wholly different words stand here, nothing near to them anywhere else in the table", None, None, None)]
    odd += [(902, None, None, None, None), (903, "", "en", None, 0), (903, " \n", None, None, 2), (None, None, None, None, None), (904, "password = abcdefghijklmnop " * 30_000, None, None, None)]
    one = docs.union(spark.createDataFrame(odd, schema))
    for name in ("_row", "r", "picked", "told", "component_id", "kept"):
        one = one.withColumn(name, F.lit("x"))
    count = one.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, one.limit(0), "/root/testdata/sf0.001").count() == 0, name
        out = stage(spark, one, "/root/testdata/sf0.001")
        assert out.columns == one.columns and out.count() <= count, name
        rows = out.where("doc_id is null or doc_id >= 900").collect()
        if name == "language":
            assert not [r for r in rows if not (r.text or "").strip()]
        if name == "near_dedup":
            left = sorted((r.doc_id or 0, (r.text or "")[:9]) for r in rows)
            assert left == sorted([(0, ""), (900, "one plain"), (900, "wholly di"), (902, ""), (903, ""), (903, " \n"), (904, "password ")])
        if name == "secrets":
            assert len(rows) == len(odd) and {r.text for r in rows if r.doc_id == 904} == {"[SECRET] " * 30_000}
            assert [r.n_chars for r in rows if r.doc_id == 904] == [270_000] and sum(r.text is None for r in rows) == 2
    packed = corpus_pipeline.packing(spark, one, "")
    assert packed.groupBy("piece").count().where("piece = 0").first()["count"] == count
    assert corpus_pipeline.packing(spark, one.limit(0), "").count() == 0


def test_run_leaves_only_what_its_result_reads(spark):
    from pathlib import Path

    from helixloom.llm import shared

    sf, before = "/root/testdata/sf0.001", list(shared._live)
    result = corpus_pipeline.run(spark, sf)
    rows = result.count()
    left = [s for s in shared._live if s not in before]
    tables = sorted(p.name for s in left for p in Path(s.root.removeprefix("file://")).iterdir())
    assert len(left) == 2 and tables == ["001-pieces", "004-secrets"] and rows > 0
    with shared.dropped_after():
        stored = shared.SharedTables(spark, "test")
        path = Path(stored.write(spark.range(3).toDF("x"), "x")._shared_path.removeprefix("file://"))
        assert path.exists()
    assert not path.exists() and stored not in shared._live
