import random
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import running
from ledgerloom.plans import jobs
from ledgerloom.plans.registry import released, table_name

ROWS = "a double, b double, c string, d int"


def plain(rows):
    """Mean of a, medians of b and d, mode of c, missing values left out."""
    columns = [[r[i] for r in rows if r[i] is not None and r[i] == r[i]] for i in range(4)]
    counted = Counter(columns[2])
    mode = min(counted, key=lambda v: (-counted[v], v)) if counted else None
    mean = sum(columns[0]) / len(columns[0]) if columns[0] else None
    return {"a": mean, "b": median(columns[1]) if columns[1] else None, "c": mode, "d": median(columns[3]) if columns[3] else None}


def drawn(draw, n):
    hot = draw.choice([0.0, 7.5, float("nan")])
    return [
        (
            draw.choice([None, float("nan"), float(draw.randint(-9, 9))]),
            draw.choice([None, hot, hot, draw.uniform(-5, 5) * 10 ** draw.randint(0, 6)]),
            draw.choice([None, "x", "y", "z", ""]),
            draw.choice([None, draw.randint(-50, 50)]),
        )
        for _ in range(n)
    ]


def test_every_run_sees_all_rows_so_far(spark, fresh, monkeypatch):
    for name, value in {"CELLS": 5, "ROWS_A_CELL": 6, "RUNS_APART": 3, "LAST_VALUES": 8}.items():
        monkeypatch.setattr(running, name, value)
    draw, folder = random.Random(1), fresh("running")
    done, so_far = [], []
    for run, size in enumerate([40, 0, 1, 90, 25, 60, 7]):
        ids = spark.createDataFrame([(d,) for d in done], "run_id string")
        if run % 3 == 1:
            # A run that stopped before its mark: what it kept does not count, under its own id or another.
            lost = spark.createDataFrame(drawn(draw, 30), ROWS)
            running.Running(spark, folder, f"run {run}/{draw.randint(0, 1) * 'x'}", ids).take(lost, ["a"], ["b", "d"], ["c"])
        rows = drawn(draw, size)
        so_far += rows
        got = running.Running(spark, folder, f"run {run}/", ids).take(
            spark.createDataFrame(rows, ROWS), ["a"], ["b", "d"], ["c"]
        )
        assert got == plain(so_far), run
        done.append(f"run {run}/")
    kept = spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/summary")
    live = kept.where(F.col("run").isin(done)).select("run").distinct().count()
    assert live < len(done)
    with pytest.raises(ValueError):
        running.Running(spark, folder, done[-1], spark.createDataFrame([(d,) for d in done], "run_id string"))


def test_columns_without_values_and_empty_tables(spark, fresh):
    folder, nobody = fresh("no-values"), spark.createDataFrame([], "run_id string")
    empty = running.Running(spark, folder, "r", nobody).take(spark.createDataFrame([], ROWS), ["a"], ["b"], ["c"])
    assert empty == {"a": None, "b": None, "c": None}
    done = spark.createDataFrame([("r",)], "run_id string")
    nulls = spark.createDataFrame([(None, float("nan"), None, None)] * 3, ROWS)
    assert running.Running(spark, folder, "s", done).take(nulls, ["a"], ["b"], ["c"]) == empty


def test_runs_need_a_mark(spark, fresh):
    root = fresh("no-mark")
    own = {"use_watermarking": False, "watermark_path": f"{root}/state", "staging_path": f"{root}/s", "running_statistics": True}
    with pytest.raises(ValueError, match="watermark"):
        jobs.run_configured(spark.range(1), {"transformation": {}, "loading": {}, "performance": own}, "r")


def test_increments_of_a_configured_run(spark, fresh, monkeypatch):
    root, name = fresh("running-job"), table_name("running_job")
    config = {
        "transformation": {"cleaning_rules": {"handle_missing_values": {"column_strategies": {"v": "fill_mean", "w": "fill_median"}}}},
        "loading": {"load_method": "append", "target_table": name, "path": f"{root}/table"},
        "performance": {
            "watermark_name": "w", "watermark_column": "at", "watermark_path": f"{root}/state", "staging_path": f"{root}/staged",
            "running_statistics": True,
        },
    }

    def load(run, at, *pairs):
        df = spark.createDataFrame([(v, w, at) for v, w in pairs], "v double, w long, at long")
        return jobs.run_configured(df, config, run)

    load("one", 1, (1.0, 10), (3.0, 20), (None, None))
    with monkeypatch.context() as m:
        m.setattr(jobs, "write_configured", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load("two", 2, (8.0, 90), (None, None))
    load("two", 2, (8.0, 90), (None, None))
    load("three", 3, (None, None))
    got = sorted((r["at"], r["v"], r["w"]) for r in released(spark, name).collect())
    assert got == [(1, 1.0, 10.0), (1, 2.0, 15.0), (1, 3.0, 20.0), (2, 4.0, 20.0), (2, 8.0, 90.0), (3, 4.0, 20.0)]
