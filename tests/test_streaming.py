from helixloom.streaming.pair_counts import merge_counts, streaming_pair_support, windowed_counts


def test_stream_equals_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").select("ts", "event_type")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    run = windowed_counts(stream, "ts", ["event_type"]).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    run.awaitTermination()
    want = windowed_counts(events, "ts", ["event_type"])
    got = spark.table("counts")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_pair_support_by_batches(spark):
    rows = [(1, 1, "a", "+"), (1, 2, "b", "-"), (2, 1, "b", "+"), (2, 2, "a", "-"), (3, 1, "a", "+"), (3, 2, "a", "-"), (4, 1, "a", "+"), (4, 2, "c", "+")]
    df = spark.createDataFrame(rows, "frag int, mate int, gene string, strand string")
    first = merge_counts(None, streaming_pair_support(df.where("frag = 1")))
    both = merge_counts(first, streaming_pair_support(df.where("frag > 1")))
    assert [tuple(r) for r in both.collect()] == [("a", "b", 2)]
