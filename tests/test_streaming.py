from pyspark.sql import functions as F

from ledgerloom.functions import text
from ledgerloom.plans.registry import released, table_name
from ledgerloom.streaming import runs


def land(df, path):
    df.write.mode("append").parquet(path)


def test_each_file_is_loaded_once(spark, fresh):
    root = fresh("stream")
    df = spark.range(10).withColumn("name", F.lit(" Ab "))
    for i in range(3):
        land(df.withColumn("id", F.col("id") + i * 10), f"{root}/in")
        stream = runs.read_file_stream(spark, f"{root}/in", "parquet", df.schema, max_files_per_batch=2)
        runs.run_to_files(stream.withColumn("name", text.strip(F.col("name"))),
                          f"{root}/out", f"{root}/state")
        assert spark.read.parquet(f"{root}/out").count() == (i + 1) * 10
    runs.run_to_files(stream, f"{root}/out", f"{root}/state")
    assert spark.read.parquet(f"{root}/out").count() == 30
    assert spark.read.parquet(f"{root}/out").where("name = 'Ab'").count() == 30


def test_processed_files_move_to_the_archive(spark, fresh):
    root = fresh("archive")
    df = spark.range(5)
    for i in range(3):
        land(df, f"{root}/in")
        stream = runs.read_file_stream(
            spark, f"{root}/in", "parquet", df.schema, "*.parquet", max_files_per_batch=1, archive_dir=f"{root}/done"
        )
        runs.run_to_files(stream, f"{root}/out", f"{root}/state")
    assert spark.read.parquet(f"{root}/out").count() == 15
    archived = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/done")
    left = spark.read.parquet(f"{root}/in")
    assert archived.count() > 0 and archived.count() + left.count() == 15


def test_repeats_are_dropped_within_and_across_runs(spark, fresh):
    for spread in (1, 4):
        root = fresh("dedup")
        hot = spark.sql(
            """SELECT CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS key,
                      timestamp_ntz '2024-01-01' + make_interval(0, 0, 0, 0, 0, id) AS at FROM range(300)"""
        )
        for _ in range(2):
            land(hot.repartition(6), f"{root}/in")
            stream = runs.read_file_stream(spark, f"{root}/in", "parquet", hot.schema)
            runs.run_to_files(runs.deduplicate_stream(stream, ["key"], "at", "3 days", spread), f"{root}/out", f"{root}/state")
        got = spark.read.parquet(f"{root}/out")
        assert got.columns == ["key", "at"]
        assert got.count() == hot.select("key").distinct().count() == got.select("key").distinct().count()


def test_upserts_from_a_stream(spark, fresh):
    root, name = fresh("upsert"), table_name("upsert")
    first = spark.range(20).withColumn("v", F.lit(1))
    second = spark.range(10, 30).withColumn("v", F.lit(2))
    for df in (first, second):
        land(df, f"{root}/in")
        stream = runs.read_file_stream(spark, f"{root}/in", "parquet", first.schema)
        runs.run_upsert(stream, name, ["id"], f"{root}/state", path=f"{root}/table")
    got = released(spark, name)
    assert got.count() == 30 and got.where("v = 1").count() == 10


def test_metrics_of_each_batch(spark, fresh):
    from ledgerloom.operators.quality import RunMetrics

    root, metrics = fresh("metrics"), RunMetrics("run-7", {"job": "test"})
    df = spark.sql("SELECT id, timestamp '2024-01-01' + make_interval(0, 0, 0, 0, id) AS at FROM range(10)")
    for i in range(3):
        land(df.coalesce(1).where(f"id <> {i}"), f"{root}/in")
    stream = runs.read_file_stream(spark, f"{root}/in", "parquet", df.schema, max_files_per_batch=1)
    kept = stream.withWatermark("at", "1 hour").where("id % 2 = 0")
    runs.run_to_files(kept, f"{root}/out", f"{root}/state", metrics=metrics, task="kept")
    rows = [r for r in metrics.frame(spark).collect() if r["records"]]
    assert [r["records"] for r in rows] == [9, 9, 9] and all(r["task"] == "kept" and r["status"] == "succeeded" for r in rows)
    assert sorted(int(r["tags"]["rows_out"]) for r in rows) == [4, 4, 5]
    assert [r["tags"]["batch_id"] for r in rows] == ["0", "1", "2"] and rows[0]["tags"]["job"] == "test"
    assert "watermark" in rows[-1]["tags"] and rows[-1]["tags"]["watermark"].startswith(("2024-01-01T07", "2024-01-01T08"))
    seen = RunMetrics("run-8")
    runs.run_batches(stream, lambda batch, n: batch.write.mode("append").parquet(f"{root}/each"), f"{root}/state2", seen, "each")
    assert sum(r[4] or 0 for r in seen.rows) == 27 == spark.read.parquet(f"{root}/each").count()


def test_metrics_of_batches_before_a_failure(spark, fresh):
    import pytest

    from ledgerloom.operators.quality import RunMetrics

    root, metrics = fresh("failing"), RunMetrics("run-9")
    for i in range(2):
        land(spark.range(5).coalesce(1), f"{root}/in")
    stream = runs.read_file_stream(spark, f"{root}/in", "parquet", "id long", max_files_per_batch=1)

    def second_fails(batch, number):
        if number == 1:
            raise OSError("gone")
        batch.write.format("noop").mode("append").save()

    with pytest.raises(Exception):
        runs.run_batches(stream, second_fails, f"{root}/state", metrics)
    assert [r[4] for r in metrics.rows] == [5]
