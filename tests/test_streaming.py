from panelwright.streaming.refresh import latest_version, refresh, stream_refresh


def test_refresh_versions(spark, tmp_path):
    root = str(tmp_path / "profiles")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    path, n = refresh(spark, root, first, "k")
    assert n == 2 and path.endswith("v=0")
    path, n = refresh(spark, root, spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), "k")
    assert n == 3 and latest_version(spark, root)[0] == 1
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_stream_refresh_micro_batches(spark, tmp_path):
    root, src = str(tmp_path / "table"), str(tmp_path / "incoming")
    refresh(spark, root, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), "k")
    spark.createDataFrame([(2, "new")], "k int, v string").write.parquet(src + "/batch1")
    stream = spark.readStream.schema("k int, v string").parquet(src + "/batch1")
    q = stream_refresh(stream, root, "k", str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    _, path = latest_version(spark, root)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "new")]


def test_materialize_and_drop_scratch(spark):
    from panelwright.session import drop_scratch, materialize

    drop_scratch(spark)
    df = materialize(spark.range(5).toDF("x"), "scratch-test")
    assert df.count() == 5
    assert drop_scratch(spark) == 1
