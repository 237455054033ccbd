import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerloom.plans.registry import released, table_name
from ledgerloom.sinks import files as sinks, store, tables
from ledgerloom.sources import files, incremental


@pytest.fixture(scope="module")
def sample(spark):
    return spark.sql(
        """SELECT id AS ColA, CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN ' a "q", b ' ELSE '' END AS ColB,
                  timestamp_ntz '2024-01-01 00:00:00.123456' + make_interval(0, 0, 0, 0, id) AS ColC,
                  id / 7 AS ColD
           FROM range(20)"""
    ).repartition(3)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def texts(spark, path):
    return [r.value for r in spark.read.text(path, wholetext=True).collect()]


def test_csv_round_trip(spark, sample, fresh):
    path = fresh() + "/deep/er"
    sinks.write_csv(sample, path, sep="|")
    back = files.read_csv(spark, path, sample.schema, delimiter="|", **sinks.CSV_READ)
    assert same(back, sample)
    assert all(t.startswith("ColA|ColB|ColC|ColD\n") for t in texts(spark, path))


def test_json_lines_keep_nulls(spark, sample, fresh):
    path = fresh()
    sinks.write_json_lines(sample, path)
    lines = [json.loads(line) for t in texts(spark, path) for line in t.splitlines()]
    assert len(lines) == 20 and all(set(line) == {"ColA", "ColB", "ColC", "ColD"} for line in lines)
    assert lines[0]["ColC"][:11] in ("2024-01-01T",)
    assert same(files.read_json_lines(spark, path, sample.schema, **sinks.ISO_TIMES), sample)


def test_json_arrays_are_whole_documents(spark, sample, fresh):
    path = fresh()
    sinks.write_json_arrays(sample.repartition(30), path)
    documents = [json.loads(t) for t in texts(spark, path) if t]
    assert sum(len(d) for d in documents) == 20 and len(documents) > 3
    assert same(files.read_json_documents(spark, path, sample.schema, **sinks.ISO_TIMES), sample)


def test_epoch_dates(spark, sample, fresh):
    path = fresh()
    sinks.write_json_arrays(sample.where("ColA = 0"), path, date_format="epoch")
    assert json.loads(texts(spark, path)[0])[0]["ColC"] == 1704067200123
    sinks.write_json_lines(sample.where("ColA = 0").withColumn("ColC", F.col("ColC").cast("timestamp")), path, "epoch")
    assert json.loads(texts(spark, path)[0])["ColC"] == 1704067200123
    with pytest.raises(ValueError):
        sinks.write_json_lines(sample, path, "unix")


@pytest.mark.parametrize("codec, mark", [("snappy", ".snappy."), ("gzip", ".gz."), (None, ".parquet"), ("zstd", ".zstd.")])
def test_parquet_codecs(spark, sample, fresh, codec, mark):
    path = fresh()
    sinks.write_parquet(sample, path, codec)
    assert all(mark in f for f in spark.read.parquet(path).inputFiles())
    assert same(files.read_staged(spark, path), sample)
    with pytest.raises(ValueError):
        sinks.write_parquet(sample, path, "zip")


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_staging(sample, fresh, kind):
    assert same(sinks.stage(sample, fresh(), kind), sample)


def test_partitions_are_replaced_one_by_one(spark, fresh):
    path = fresh()
    df = spark.sql("SELECT id, id % 3 AS p FROM range(30)")
    sinks.write_partitioned(df, path, ["p"])
    sinks.write_partitioned(df.where("p = 1").withColumn("id", -F.col("id")), path, ["p"])
    got = spark.read.parquet(path)
    assert got.count() == 30 and got.where("id < 0").select("p").distinct().collect() == [(1,)]
    sinks.write_partitioned(df, path, ["p"], mode="append")
    assert spark.read.parquet(path).count() == 60


# --- tables


@pytest.fixture
def loaded(spark, fresh):
    name = table_name("test")
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0)], "id long, name string, v double")
    tables.load_table(df, name, path=fresh("table"))
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows(spark, name):
    return sorted((tuple(r) for r in spark.read.table(name).collect()), key=str)


def test_load_modes(spark, loaded, fresh):
    df = spark.createDataFrame([("c", 3.0, 3)], "name string, v double, id long")
    with pytest.raises(AnalysisException):
        tables.load_table(df, loaded)
    assert tables.load_table(df, loaded, "append") == 1
    assert (3, "c", 3.0) in rows(spark, loaded)
    assert tables.load_table(df.limit(0), loaded, "replace") == 0
    assert len(rows(spark, loaded)) == 4
    assert tables.load_table(df, loaded, "replace", fresh("replaced")) == 1
    assert rows(spark, loaded) == [("c", 3.0, 3)]
    with pytest.raises(ValueError):
        tables.load_table(df, loaded, "merge")
    assert tables.load_table(df.limit(0), table_name("never"), "append") == 0


def test_bounded_files(spark, fresh):
    name = table_name("bounded")
    assert tables.load_table(spark.range(100).coalesce(1), name, path=fresh(), batch_size=30) == 100
    assert len(released(spark, name).inputFiles()) == 4


def test_update(spark, loaded):
    tables.update_where(spark, loaded, {"v": "v * 10", "name": "upper(name)"}, "id >= 2")
    assert rows(spark, loaded) == [(1, "a", 1.0), (2, "B", 20.0), (None, "n", 0.0)]


def test_truncate_analyze(spark, loaded):
    tables.analyze(spark, loaded, ["id"])
    tables.truncate(spark, loaded)
    assert rows(spark, loaded) == []


def test_upsert(spark, loaded):
    changes = spark.createDataFrame(
        [(2, "b2", 5.0), (2, "b1", 4.0), (3, "c", 3.0), (None, "m", 1.0), (None, "m", 1.0)],
        "id long, name string, v double",
    )
    expected = [(1, "a", 1.0), (2, "b2", 5.0), (3, "c", 3.0), (None, "m", 1.0), (None, "m", 1.0), (None, "n", 0.0)]
    tables.upsert_table(spark, loaded, changes, ["id"], ["v"])
    assert rows(spark, loaded) == sorted(expected, key=str)
    tables.upsert_table(spark, loaded, changes.limit(0), ["id"])
    assert len(rows(spark, loaded)) == 6


def test_upsert_past_the_broadcast_bound(spark, monkeypatch):
    from ledgerloom.operators import joins

    monkeypatch.setattr(joins.lookup_join, "__defaults__", ("left", 0))
    target = spark.range(100).withColumn("v", F.lit("old"))
    source = spark.range(50, 150).withColumn("v", F.lit("new"))
    merged = tables.upserted(target, source, ["id"])
    assert merged.count() == 150 and merged.where("v = 'old'").count() == 50


def test_upsert_touches_only_its_partitions(spark, fresh):
    name, path = table_name("parts"), fresh("parts")
    spark.sql("SELECT id, 'old' AS v, id % 4 AS p FROM range(40)").write.partitionBy("p").option("path", path).saveAsTable(name)
    before = {f for f in spark.read.table(name).inputFiles() if "p=1" not in f}
    changes = spark.sql("SELECT id, 'new' AS v, 1L AS p FROM (SELECT explode(array(1, 5, 101)) AS id)")
    tables.upsert_table(spark, name, changes, ["id"], partitions_follow_keys=True)
    spark.catalog.refreshTable(name)
    got = spark.read.table(name)
    assert got.count() == 41 and got.where("v = 'new'").count() == 3 and got.where("p = 1").count() == 11
    assert {f for f in got.inputFiles() if "p=1" not in f} == before
    spark.sql(f"DROP TABLE {name}")


def null_partitions(spark, fresh, groups):
    """A table over two partition columns that hold NULL, and its rows."""
    name, path = table_name("nulls"), fresh("nulls")
    df = spark.range(4 * groups).selectExpr(
        "id", "'old' AS v", "if(id % 4 = 0, NULL, id % 4) AS p", f"if(id % {groups} = 1, NULL, concat('q', id % {groups})) AS q"
    )
    df.write.partitionBy("p", "q").option("path", path).saveAsTable(name)
    return name, df


@pytest.mark.parametrize("groups", [2, 40])
def test_upsert_of_null_partitions(spark, fresh, groups):
    name, df = null_partitions(spark, fresh, groups)
    changes = df.where("p IS NULL OR q IS NULL").withColumn("v", F.lit("new"))
    changes = changes.where("id % 3 = 0").unionByName(spark.sql("SELECT 900L AS id, 'new' AS v, NULL AS p, NULL AS q"))
    tables.upsert_table(spark, name, changes, ["id"], partitions_follow_keys=True)
    want = df.join(changes.select("id"), "id", "left_anti").unionByName(changes)
    assert same(spark.read.table(name).select(*df.columns), want.select(*df.columns))
    tables.drop_table(spark, name)


def test_partition_filter_at_any_size(spark, plan):
    rows = spark.range(3000).selectExpr("id % 1500 AS a", "if(id % 2 = 0, NULL, id) AS b")
    target = spark.range(6000).selectExpr("id", "id % 3000 AS a", "if(id % 2 = 0, NULL, id) AS b")
    found = tables.touched_partitions(target, rows, ["a", "b"])
    assert found.count() == target.join(rows.distinct(), (target.a.eqNullSafe(rows.a)) & (target.b.eqNullSafe(rows.b)), "left_semi").count()
    assert tables.touched_partitions(target, rows.limit(0), ["a"]) is None
    assert "Join" not in plan(found)


def test_update_of_partitions(spark, fresh):
    name, df = null_partitions(spark, fresh, 4)
    before = spark.read.table(name).inputFiles()
    tables.update_where(spark, name, {"v": "'hit'"}, "p IS NULL AND id > 4")
    got = spark.read.table(name)
    assert {r.id for r in got.where("v = 'hit'").collect()} == {8, 12} and got.count() == 16
    assert {f for f in got.inputFiles() if "p=__" not in f} == {f for f in before if "p=__" not in f}
    tables.update_where(spark, name, {"v": "'never'"}, "id > 1000")
    assert spark.read.table(name).where("v = 'never'").isEmpty()
    with pytest.raises(ValueError):
        tables.update_where(spark, name, {"p": "7"}, "true")
    tables.drop_table(spark, name)


def test_truncate_of_partitions(spark, fresh):
    name, df = null_partitions(spark, fresh, 4)
    tables.truncate(spark, name)
    assert spark.read.table(name).isEmpty()
    df.where("id < 3").select("id", "v", "p", "q").write.insertInto(name)
    assert spark.read.table(name).count() == 3
    tables.drop_table(spark, name)


@pytest.mark.parametrize("kind, options", [("orc", {}), ("csv", {"sep": ";", "header": "true"}), ("parquet", {})])
def test_snapshots_stay_in_place_and_format(spark, fresh, kind, options):
    name, path = table_name("kinds"), fresh("kinds")
    spark.range(5).selectExpr("id", "'a;b' AS v").write.format(kind).options(**options).option("path", path).saveAsTable(name)
    for n in range(4):
        tables.update_where(spark, name, {"v": f"'new {n}'"}, f"id >= {n}")
    assert rows(spark, name) == [(0, "new 0"), (1, "new 1"), (2, "new 2"), (3, "new 3"), (4, "new 3")]
    assert all(path in f for f in spark.read.table(name).inputFiles())
    system, place = store._system(spark, path)
    assert len(system.listStatus(place(f"{path}/_snapshots"))) == 2
    assert {f.getPath().getName() for f in system.listStatus(place(path))} - {"_SUCCESS"} == {"_snapshots", "_commits"}
    tables.drop_table(spark, name)
    assert not system.exists(place(path))


def test_tables_outlive_the_scratch_folder(spark, fresh, tmp_path):
    name = table_name("outlives")
    tables.load_table(spark.range(5).withColumn("v", F.lit("old")), name, path=str(tmp_path / "table"))
    tables.update_where(spark, name, {"v": "'new'"}, "id = 1")
    changes = spark.createDataFrame([(2, "up")], "id long, v string")
    tables.upsert_table(spark, name, changes, ["id"])
    assert all(str(tmp_path) in f for f in spark.read.table(name).inputFiles())
    assert rows(spark, name) == [(0, "old"), (1, "new"), (2, "up"), (3, "old"), (4, "old")]
    tables.drop_table(spark, name)


def test_names_with_dots(spark, fresh):
    name = table_name("dots")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "`the.id` long, `a value` string")
    tables.load_table(df, name, path=fresh("dots"))
    tables.upsert_table(spark, name, spark.createDataFrame([(2, "c"), (3, "d")], df.schema), ["the.id"])
    tables.update_where(spark, name, {"a value": "'x'"}, "`the.id` = 1")
    assert rows(spark, name) == [(1, "x"), (2, "c"), (3, "d")]
    tables.drop_table(spark, name)


def test_increments_load_once(spark, fresh):
    name, state, path = table_name("inc"), fresh("state"), fresh("inc")
    df = spark.range(10).withColumnRenamed("id", "n")
    assert tables.load_increment(df.where("n < 4"), name, "n", state, "load", "r1", path) == 4
    assert tables.load_increment(df, name, "n", state, "load", "r2", path) == 6
    assert tables.load_increment(df, name, "n", state, "load", "r3", path) == 0
    assert released(spark, name).count() == 10


@pytest.mark.parametrize("step", ["commit", "publish"])
def test_increment_that_fails_is_repeated(spark, fresh, monkeypatch, step):
    name, state, path = table_name("crash"), fresh("state"), fresh("crash")
    df = spark.range(10).withColumnRenamed("id", "n")
    tables.load_increment(df.where("n < 4"), name, "n", state, "load", "r1", path)

    def fail(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        if step == "commit":
            broken.setattr(incremental.MarkedBatch, "commit", fail)
        else:
            broken.setattr(incremental, "publish_increment", fail)
        with pytest.raises(RuntimeError):
            tables.load_increment(df, name, "n", state, "load", "r2", path)
    spark.catalog.refreshTable(name)
    assert spark.read.table(name).count() == 4
    assert tables.load_increment(df, name, "n", state, "load", "r3", path) == (6 if step == "commit" else 0)
    assert sorted(r.n for r in released(spark, name).collect()) == list(range(10))


def test_marks_hold_in_any_zone(spark, fresh):
    name, state, path = table_name("zones"), fresh("state"), fresh("zones")
    df = spark.createDataFrame([(1, 0), (2, 3600), (3, None)], "id int, s long").select("id", F.timestamp_seconds("s").alias("at"))
    assert tables.load_increment(df.where("id <> 2"), name, "at", state, "load", "r1", path) == 1
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert tables.load_increment(df, name, "at", state, "load", "r2", path) == 1
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert tables.load_increment(df, name, "at", state, "load", "r3", path) == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    nothing = df.where("id = 3")
    assert tables.load_increment(nothing, name, "at", state, "load", "r4", path) == 0
    assert tables.load_increment(df, name, "at", state, "load", "r5", path) == 0
    assert released(spark, name).count() == 2


def test_the_greatest_mark_counts(spark, fresh):
    state = fresh("state")
    for n in (9, 10, 2):
        batch = incremental.MarkedBatch(spark.range(n, n + 1), "id")
        batch.df.collect()
        batch.commit(spark, state, "x", "r")
    assert incremental.read_high_mark(spark, state, "x") == "10"


def test_jdbc_writer_options():
    got = tables.jdbc_writer_options("u", "t", 500, 4, True, "name VARCHAR(64)")
    assert got == {
        "url": "u", "dbtable": "t", "batchsize": "500", "numPartitions": "4", "truncate": "true",
        "createTableColumnTypes": "name VARCHAR(64)",
    }


def test_rows_at_the_mark_that_land_late(spark, fresh):
    name, path, state = table_name("late"), fresh("late"), fresh("late-state")

    def run(number, *ids, keys=None):
        rows = spark.createDataFrame([(i, f"v{i}", 10 + i // 3) for i in ids], "id long, v string, at long")
        return tables.load_increment(rows, name, "at", state, "late", f"run-{number}", path, late_ties=True, tie_keys=keys)

    assert run(0, 0, 1, 3) == 3
    # 4 and 5 lie at the mark, 2 below it; nothing is loaded twice.
    assert run(1, 0, 1, 2, 3, 4) == 1
    assert run(2, 0, 1, 2, 3, 4, 5) == 1
    assert run(3, 0, 1, 2, 3, 4, 5) == 0
    assert run(4, 4, 5, 6) == 1 and run(5, 6, 7, keys=["id"]) >= 1
    got = sorted(r.id for r in spark.read.table(name).collect())
    assert got[:6] == [0, 1, 3, 4, 5, 6] and 7 in got


def test_ties_of_a_run_that_never_stored_its_mark(spark, fresh, monkeypatch):
    from ledgerloom.sources.incremental import MarkedBatch

    name, path, state = table_name("stopped"), fresh("stopped"), fresh("stopped-state")
    rows = spark.range(6).selectExpr("id", "5L AS at")

    def dies(*a, **k):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(MarkedBatch, "commit", dies)
        with pytest.raises(OSError):
            tables.load_increment(rows, name, "at", state, "s", "run-1", path, late_ties=True)
    assert tables.load_increment(rows.where("id < 3"), name, "at", state, "s", "run-2", path, late_ties=True) == 3
    assert tables.load_increment(rows, name, "at", state, "s", "run-3", path, late_ties=True) == 3
    assert spark.read.table(name).count() == 6
