"""Streaming forms, with files arriving between runs."""

from datetime import datetime, timedelta

from cohortflow.streaming import discovery, restriction

START = datetime(2024, 5, 1)
SCHEMA = "path string, modificationTime timestamp"


def run(stream, out, state):
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
    writer.trigger(availableNow=True).start().awaitTermination()


def test_runs_are_reported_once_over_restarts(spark, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))

    def arrive(*rows):
        spark.createDataFrame(
            [(path, START + timedelta(hours=h)) for path, h in rows], SCHEMA
        ).coalesce(1).write.mode("append").parquet(source)

    def drain():
        files = spark.readStream.schema(SCHEMA).parquet(source)
        arrivals = discovery.arrivals_from_files(files, "/r")
        discovery.report_runs(discovery.runs_once(arrivals), out, state).awaitTermination()
        found = spark.read.parquet(out)
        return sorted((r.folder, r.run_id) for r in found.collect())

    arrive(("/r/Human_1240k/2A/x.bam", 1), ("/r/Human_1240k/2A/y.bam", 2), ("/r/Human_Y/2B/x.stats", 2))
    assert drain() == [("Human_1240k", "2A")]
    arrive(("/r/Human_1240k/2A/z.bam", 3), ("/r/Human_Y/2B/x.bam", 3))
    assert drain() == [("Human_1240k", "2A"), ("Human_Y", "2B")]
    # Old times after new ones, and a run seen long ago.
    arrive(("/r/Human_Y/2D/x.bam", -24 * 30), ("/r/Human_Y/2E/x.bam", 24 * 30))
    assert drain()[-2:] == [("Human_Y", "2D"), ("Human_Y", "2E")]
    arrive(("/r/Human_1240k/2A/late.bam", 24 * 60), ("/r/Human_Y/2D/y.bam", 24 * 60))
    assert len(drain()) == 4
    typed = discovery.with_types(spark.read.parquet(out).filter("run_id < '2C'")).select("analysis_type", "run_id")
    assert {tuple(r) for r in typed.collect()} == {("TF", "2A"), ("TM", "2A"), ("YC", "2B")}


def test_reported_runs_need_no_folder_per_batch(spark, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    rows = [(f"/r/Human_1240k/2{k % 7}/x{k}.bam", START) for k in range(24)]
    for row in rows:
        spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    query = discovery.report_runs(discovery.runs_once(discovery.arrivals_from_files(stream, "/r")), out, state)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == 24
    found = [r.run_id for r in spark.read.parquet(out).collect()]
    assert sorted(found) == [f"2{k}" for k in range(7)]
    # One folder with files, and the log of them, which is merged every ten batches.
    folders = [one.name for one in (tmp_path / "out").iterdir() if one.is_dir()]
    assert folders == ["_spark_metadata"]
    assert [one.name for one in (tmp_path / "out" / "_spark_metadata").iterdir() if one.name.endswith(".compact")]
    assert "rocksdb" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass").lower()
    assert list((tmp_path / "state" / "state").rglob("*.zip")) or list((tmp_path / "state" / "state").rglob("*.changelog"))


def test_restricted_rows_leave_the_stream(spark, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    spark.createDataFrame([("A_ss",), ("A",), ("B",)], "sample string").write.parquet(source)
    sensitive = spark.createDataFrame([("A.1",)], "id string")
    stream = spark.readStream.schema("sample string").parquet(source)
    run(restriction.scrub_stream(stream, sensitive, "sample"), out, state)
    assert [r.sample for r in spark.read.parquet(out).collect()] == ["B"]


def test_marks_count_from_the_next_batch_on(spark, tmp_path):
    source, out, state, marks = (str(tmp_path / name) for name in ("in", "out", "state", "marks"))

    def drain():
        stream = spark.readStream.schema("sample string").parquet(source)
        write = restriction.scrub_batches(lambda: spark.read.parquet(marks), "sample", out)
        writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", state)
        writer.trigger(availableNow=True).start().awaitTermination()
        return sorted(r.sample for r in spark.read.parquet(out).select("sample").collect())

    rows = spark.createDataFrame([("A",), ("B_ss",), ("C",)], "sample string")
    spark.createDataFrame([("A_ss.1",)], "id string").write.parquet(marks)
    rows.write.parquet(source)
    assert drain() == ["B_ss", "C"]
    spark.createDataFrame([("B.1",)], "id string").write.mode("append").parquet(marks)
    rows.write.mode("append").parquet(source)
    assert drain() == ["B_ss", "C", "C"]
