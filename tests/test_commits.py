"""Several writers of one table, writers that die, and batches that come twice."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans.registry import table_name
from ledgerloom.sinks import commits, files_log, store, tables
from ledgerloom.streaming import runs


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id long, v string, p long")


def plain(spark, fresh, n=10):
    name = table_name("plain")
    spark.range(n).selectExpr("id", "'old' AS v", "id % 3 AS p").write.option("path", fresh("plain")).saveAsTable(name)
    return name


def parted(spark, fresh, n=12):
    name = table_name("parted")
    df = spark.range(n).selectExpr("id", "'old' AS v", "id % 3 AS p")
    df.repartition(2).write.partitionBy("p").option("path", fresh("parted")).saveAsTable(name)
    return name


def held(spark, name):
    return sorted(tuple(r) for r in spark.read.table(name).select("id", "v", "p").collect())


def all_at_once(*calls):
    found, errors = [], []

    def run(call):
        try:
            found.append(call())
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=run, args=(call,)) for call in calls]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors, errors
    return found


def test_put_once(spark, fresh):
    path = fresh("once") + "/a/b"
    wins = all_at_once(*[lambda n=n: files_log.put_if_absent(spark, path, f"text {n}") for n in range(8)])
    assert sum(wins) == 1 and files_log.read_text(spark, path).startswith("text ")
    assert files_log.names_in(spark, path.rpartition("/")[0]) == ["b"]


@pytest.mark.parametrize("make", [plain, parted])
def test_writers_at_once_lose_no_row(spark, fresh, make):
    name = make(spark, fresh)
    upserts = [
        lambda k=k: tables.upsert_table(spark, name, rows(spark, (k, f"new {k}", k % 3), (100 + k, "added", k % 3)), ["id"])
        for k in range(4)
    ]
    all_at_once(*upserts, lambda: tables.update_where(spark, name, {"v": "'updated'"}, "id = 5"))
    got = {r[0]: r[1] for r in held(spark, name)}
    assert {k: got[k] for k in range(6)} == {0: "new 0", 1: "new 1", 2: "new 2", 3: "new 3", 4: "old", 5: "updated"}
    assert all(got[100 + k] == "added" for k in range(4))
    tables.drop_table(spark, name)


def test_writers_of_other_partitions_do_not_wait(spark, fresh):
    name = parted(spark, fresh)
    base = store.place_of(spark, name).base
    slow = commits.claim(spark, base, "slow", [json.dumps({"p": "1"}, separators=(",", ":"))])
    tables.upsert_table(spark, name, rows(spark, (0, "new", 0)), ["id"], partitions_follow_keys=True)
    assert (0, "new", 0) in held(spark, name)
    done = []
    waiting = threading.Thread(target=lambda: done.append(tables.upsert_table(spark, name, rows(spark, (1, "new", 1)), ["id"], partitions_follow_keys=True)))
    waiting.start()
    time.sleep(3)
    assert not done
    assert commits.give_up(spark, slow)
    waiting.join()
    assert done == [True] and (1, "new", 1) in held(spark, name)
    tables.drop_table(spark, name)


@pytest.mark.parametrize("make", [plain, parted])
def test_a_commit_that_was_not_applied_is_applied_by_the_next(spark, fresh, make, monkeypatch):
    name = make(spark, fresh)
    step = "_point" if make is plain else "_move_in"
    real = getattr(store, step)

    def dies(*a):
        raise OSError("gone")

    monkeypatch.setattr(store, step, dies)
    with pytest.raises(OSError):
        tables.upsert_table(spark, name, rows(spark, (0, "first", 0), (None, "no key", 0)), ["id"], owner="run", batch=("run", 1))
    monkeypatch.setattr(store, step, real)
    # The batch counts as loaded, and its rows show with the next call, be it the same batch or another.
    assert not tables.upsert_table(spark, name, rows(spark, (0, "first", 0), (None, "no key", 0)), ["id"], owner="run", batch=("run", 1))
    assert tables.upsert_table(spark, name, rows(spark, (1, "second", 1)), ["id"], owner="run", batch=("run", 2))
    got = [tuple(r) for r in spark.read.table(name).select("id", "v", "p").collect()]
    assert (0, "first", 0) in got and (1, "second", 1) in got and got.count((None, "no key", 0)) == 1
    tables.drop_table(spark, name)


def test_a_writer_past_its_lease_is_given_up(spark, fresh):
    name = plain(spark, fresh)
    base = store.place_of(spark, name).base
    dead = commits.claim(spark, base, "dead", None, lease=-1)
    tables.upsert_table(spark, name, rows(spark, (0, "new", 0)), ["id"])
    assert (0, "new", 0) in held(spark, name)
    with pytest.raises(commits.ClaimLost):
        commits.end(spark, dead, "whatever", [], None)
    tables.drop_table(spark, name)


def test_a_snapshot_still_being_written_stays(spark, fresh):
    name = plain(spark, fresh)
    base = store.place_of(spark, name).base
    unknown = f"{base}/{store.SNAPSHOTS}/being-written"
    for k in range(4):
        spark.range(1).write.mode("overwrite").parquet(unknown)
        tables.upsert_table(spark, name, rows(spark, (k, "new", 0)), ["id"])
        assert "being-written" in files_log.names_in(spark, f"{base}/{store.SNAPSHOTS}")
    assert len(files_log.names_in(spark, f"{base}/{store.SNAPSHOTS}")) == 3
    tables.drop_table(spark, name)


def test_keys_may_move_between_partitions(spark, fresh):
    name = parted(spark, fresh, 30)
    before = set(spark.read.table(name).inputFiles())
    changes = rows(spark, (0, "moved", 1), (3, "same", 0), (200, "added", 7), (201, "added", None))
    files = {r[0] for r in store.located(spark.read.table(name)).where("id IN (0, 3)").select(store.FILE).collect()}
    tables.upsert_table(spark, name, changes, ["id"])
    expected = {k: ("old", k % 3) for k in range(30)} | {0: ("moved", 1), 3: ("same", 0), 200: ("added", 7), 201: ("added", None)}
    got = spark.read.table(name).select("id", "v", "p").collect()
    assert {r.id: (r.v, r.p) for r in got} == expected and len(got) == len(expected)
    # Only the files that held one of the keys are gone.
    after = set(spark.read.table(name).inputFiles())
    assert len(before - after) == len(files) < len(before)
    tables.drop_table(spark, name)


def test_a_partition_may_become_empty(spark, fresh):
    name = parted(spark, fresh, 3)
    tables.upsert_table(spark, name, rows(spark, (0, "a", 1), (2, "b", 1)), ["id"])
    assert held(spark, name) == [(0, "a", 1), (1, "old", 1), (2, "b", 1)]
    tables.drop_table(spark, name)


@pytest.mark.parametrize("make", [plain, parted])
def test_a_batch_that_comes_twice(spark, fresh, make):
    name = make(spark, fresh)
    batch = rows(spark, (0, "new", 0), (None, "no key", 1), (None, "no key", 1))
    assert tables.upsert_table(spark, name, batch, ["id"], batch=("stream", 4))
    once = sorted(map(str, spark.read.table(name).collect()))
    for number in (4, 3):
        assert not tables.upsert_table(spark, name, batch, ["id"], batch=("stream", number))
    assert sorted(map(str, spark.read.table(name).collect())) == once
    assert tables.upsert_table(spark, name, batch, ["id"], batch=("other", 0))
    assert spark.read.table(name).where("id IS NULL").count() == 4
    tables.drop_table(spark, name)


def test_streams_store_their_batches(spark, fresh, monkeypatch):
    root, name = fresh("stream"), table_name("stream")
    rows(spark, (1, "a", 0), (None, "no key", 0)).write.parquet(f"{root}/in")
    stream = runs.read_file_stream(spark, f"{root}/in", "parquet", "id long, v string, p long")
    real = tables.upsert_table

    def dies_after(*a, **k):
        real(*a, **k)
        raise OSError("gone")

    monkeypatch.setattr(runs, "upsert_table", dies_after)
    with pytest.raises(Exception):
        runs.run_upsert(stream, name, ["id"], f"{root}/state", path=f"{root}/table")
    monkeypatch.setattr(runs, "upsert_table", real)
    runs.run_upsert(stream, name, ["id"], f"{root}/state", path=f"{root}/table")
    assert spark.read.table(name).count() == 2
    rows(spark, (1, "b", 0), (None, "another", 0)).write.mode("append").parquet(f"{root}/in")
    runs.run_upsert(stream, name, ["id"], f"{root}/state", path=f"{root}/table")
    assert sorted(r.v for r in spark.read.table(name).collect()) == ["another", "b", "no key"]
    tables.drop_table(spark, name)


def test_old_records_go_and_their_batches_stay(spark, fresh, monkeypatch):
    monkeypatch.setattr(commits, "KEPT_RECORDS", 3)
    name = plain(spark, fresh)
    base = store.place_of(spark, name).base
    for number in range(6):
        tables.upsert_table(spark, name, rows(spark, (number, "new", 0)), ["id"], batch=("often", number))
        if number == 0:
            tables.upsert_table(spark, name, rows(spark, (9, "new", 0)), ["id"], batch=("once", 7))
    assert commits.batches(spark, base) == {"often": 5, "once": 7}
    assert len(commits.commits(spark, base)) == 3
    tables.drop_table(spark, name)


def test_sizes_are_renewed_where_a_table_was_analyzed(spark, fresh):
    name = plain(spark, fresh, 10)
    tables.analyze(spark, name)
    tables.upsert_table(spark, name, spark.range(50_000).selectExpr("id", "uuid() AS v", "0L AS p"), ["id"])
    found = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()[0])["statistics"]
    assert found["size_in_bytes"] > 500_000
    tables.drop_table(spark, name)
