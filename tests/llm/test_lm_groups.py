"""Models that stay in their parts: few and large questions, whatever the number of parts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixloom.llm import lm_bloom


@pytest.fixture(scope="module")
def many(spark):
    rng = np.random.default_rng(5)
    return spark.createDataFrame([(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 300) % 20000)) for i in range(200)], "doc_id bigint, text string").repartition(3).cache()


@pytest.mark.parametrize("group_bytes", [1, 60_000, 8 << 20])
def test_groups_of_parts_answer_as_the_broadcast_model(many, monkeypatch, group_bytes):
    monkeypatch.setattr(lm_bloom, "PART_TOKENS", 1000)
    monkeypatch.setattr(lm_bloom, "GROUP_BYTES", group_bytes)
    monkeypatch.setattr(lm_bloom, "ASK_BYTES", 50_000)
    monkeypatch.setattr(lm_bloom, "ANSWER_KEYS", 700)
    held = F.col("doc_id") % 10 == 0
    one, parted = (sorted(map(tuple, lm_bloom.lm_scores(many, held, broadcast_bytes=b).collect())) for b in (1 << 30, 0))
    assert len(one) == 200 and one == parted


def test_questions_do_not_grow_with_the_parts(many, monkeypatch):
    seen = []
    plain = lm_bloom._probes

    def watched(parts, *more):
        seen.append((parts, plain(parts, *more)))
        return seen[-1][1]

    monkeypatch.setattr(lm_bloom, "PART_TOKENS", 500)
    monkeypatch.setattr(lm_bloom, "_probes", watched)
    assert lm_bloom.lm_scores(many, F.col("doc_id") % 10 == 0, broadcast_bytes=0).count() == 200
    (parts, probe), blocks = seen[0], list(lm_bloom._blocks(many.select("text", "doc_id", F.lit(False).alias("held")).toArrow().to_batches()))
    assert parts >= 64
    assert sum(b.num_rows for b in probe(iter(blocks))) == 2 * sum(b.num_rows for b in blocks)


def test_workers_map_the_slices_of_a_model(spark, many, monkeypatch):
    monkeypatch.setattr(lm_bloom, "PART_TOKENS", 1000)
    held = F.col("doc_id") % 10 == 0
    results = []
    for size in (2_000, 32 << 20):
        monkeypatch.setattr(lm_bloom, "SLICE_BYTES", size)
        results.append(sorted(map(tuple, lm_bloom.lm_scores(many, held).collect())))
    assert results[0] == results[1] and len(results[0]) == 200
    keys, counts = np.arange(0, 90_000, 3, dtype=np.uint64), np.arange(30_000, dtype=np.int64)
    part = lm_bloom.Slice(spark, 1, 0, 0, 1, [], keys.tobytes() + counts.tobytes())
    wanted = np.array([0, 1, 3, 89_997, 89_999], np.uint64)
    kind, found = spark.sparkContext.parallelize([0], 1).map(lambda _: (type(part._body()[0]).__name__, part.look()(wanted).tolist())).first()
    assert kind == "mmap" and found == [0, 0, 1, 29_999, 0]
