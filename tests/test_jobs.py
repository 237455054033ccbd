import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.quality import SchemaViolation
from ledgerloom.plans import jobs
from ledgerloom.plans.registry import released, table_name
from ledgerloom.sinks import tables


@pytest.fixture(scope="module")
def payments(spark):
    rows = [
        ("T1", "2031-11-18", "23:04:59", "A1", "FEE", "7.4", "USD", " ferry ticket ", "boats", "COMPLETED"),
        ("T2", "2031-12-02", "00:10:00", "A2", "GRANT", "1200", "EUR", "moorings", "Harbour", "PENDING"),
        ("T3", "2032-01-30", "12:00:00", "A3", "FEE", "80", "CAD", "rope", " ropes", "FAILED"),
        ("T4", "bad", "10:00:00", "A4", "DEBIT", "x", None, None, None, None),
    ]
    names = (
        "TransactionID TransactionDate TransactionTime AccountNumber TransactionType Amount Currency Description "
        "Category Status"
    ).split()
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def test_processed_records(payments):
    got = {r.TransactionID: r for r in jobs.processed_records(payments).collect()}
    assert got["T1"].TransactionTimestamp == dt.datetime(2031, 11, 18, 23, 4, 59)
    assert got["T2"].NormalizedAmountUSD == pytest.approx(1308.0) and got["T2"].IsInternational
    assert got["T3"].NormalizedAmountUSD == pytest.approx(60.0)
    assert got["T3"].StandardizedCategory == "ROPES" and got["T3"].StandardizedStatus == "FAILED"
    assert got["T4"].OriginalAmount is None and got["T4"].TransactionTimestamp is None


def test_staged_records(payments):
    got = {r.TransactionID: r for r in jobs.staged_records(payments).collect()}
    assert got["T1"].RawTransactionTimestamp == "2031-11-18 23:04:59"
    assert [got[t].PreliminaryValidationStatus for t in ("T1", "T3", "T4")] == [
        "PASSED", "PASSED_WITH_WARNINGS", "PASSED",
    ]


def test_simple_run(spark, payments, fresh):
    root, name = fresh("simple"), table_name("simple")
    source = payments.select(
        F.col("TransactionID"), F.col("TransactionDate").alias("Date"), "Amount", "Status",
        F.lit(None).cast("string").alias("Merchant"), F.lit("x").alias("unused"),
    )
    source.write.option("header", True).csv(f"{root}/in")
    config = {
        "source_data": {"type": "csv", "path": f"{root}/in", "schema": source.schema},
        "staging_area": {"path": f"{root}/staged", "format": "csv"},
        "transformations": {"drop_columns": ["unused"], "rename_map": {"Amount": "amount"}},
        "target_database": {"target_table": name, "path": f"{root}/table"},
    }
    assert jobs.run_simple(spark, config).count() == 4
    got = {r.TransactionID: r for r in released(spark, name).collect()}
    assert got["T1"].Status == "Processed" and got["T2"].Status == "AwaitingSettlement" and got["T3"].Status == "failed"
    assert got["T4"].amount == 0.0 and got["T4"].Merchant == "Unknown" and got["T4"].Date is None
    assert got["T1"].TransactionDayOfWeek == "Tuesday" and got["T1"].TransactionYear == 2031
    empty = f"{root}/empty"
    source.limit(0).write.option("header", True).csv(empty)
    config["source_data"]["path"] = empty
    assert jobs.run_simple(spark, config) is None


def test_class_chain(spark, payments, fresh):
    name = table_name("chain")
    target = [
        {"target_name": "id", "source_column": "TransactionID", "dtype": "str"},
        {"target_name": "usd", "source_column": "NormalizedAmountUSD", "dtype": "float64"},
        {"target_name": "what", "source_column": "Description", "dtype": "str"},
        {"target_name": "notes", "source_column": "LegacyNotes", "dtype": "str"},
    ]
    jobs.run_class_chain(payments, name, target, ["Description"], [({"notes": "'big'"}, "usd > 1000")], fresh())
    got = {r.id: r for r in released(spark, name).collect()}
    assert got["T2"].notes == "big" and got["T1"].notes is None and got["T4"].what == "UNKNOWN"


def test_configured_sources(spark, payments, fresh):
    root = fresh("configured")
    payments.write.option("header", True).option("sep", ";").csv(f"{root}/in")
    extraction = {
        "source_type": "file",
        "file_source": {
            "input_directory": f"{root}/in", "file_pattern": "*.csv", "file_format": "csv",
            "csv_options": {"delimiter": ";", "header": True, "encoding": "utf-8"},
        },
    }
    assert jobs.read_configured(spark, extraction, payments.schema).count() == 4
    name = table_name("source")
    tables.load_table(payments, name, path=f"{root}/table")
    assert jobs.read_configured(spark, {"source_type": "database", "database_source": {"table_name": name}}).count() == 4
    spark.sql(f"DROP TABLE {name}")
    landed = [("transactions", 0, 200, '[{"id": 1}]'), ("transactions", 50, 200, '[{"id": 2}]'), ("x", 0, 200, '[{"id": 3}]')]
    spark.createDataFrame(landed, "endpoint string, page_no long, status int, body string").write.parquet(f"{root}/pages")
    api = {
        "endpoint": "transactions", "landed_directory": f"{root}/pages",
        "pagination": {"type": "offset_limit", "page_size": 50, "max_pages": 0},
    }
    got = jobs.read_configured(spark, {"source_type": "api", "api_source": api}, "id long")
    assert sorted(r.id for r in got.collect()) == [1, 2]
    with pytest.raises(ValueError):
        jobs.read_configured(spark, {"source_type": "queue"})


def test_configured_run_with_files_and_statements(spark, payments, fresh):
    root = fresh("run")
    config = {
        "transformation": {
            "schema_validation": {
                "enabled": True,
                "expected_columns": [
                    {"name": "Amount", "type": "float", "required": True},
                    {"name": "TransactionDate", "type": "datetime", "datetime_format": "%Y-%m-%d", "required": True},
                ],
            },
            "cleaning_rules": {"handle_missing_values": {"default_strategy": "drop_row", "column_strategies": {}}},
        },
        "loading": {
            "load_method": "files", "output_directory": f"{root}/out", "date_column": "TransactionDate",
            "partition_by": ["year", "month", "day"], "post_load_sql": ["SELECT 1"],
        },
        "performance": {
            "watermark_name": "w", "watermark_column": "TransactionID",
            "watermark_path": f"{root}/state", "staging_path": f"{root}/staged",
        },
    }
    assert jobs.run_configured(payments, config, "r1") == 4
    assert jobs.run_configured(payments, config, "r2") == 0
    got = spark.read.parquet(f"{root}/out")
    assert got.count() == 3 and got.where("year = 2031 AND month = 12 AND day = 2").first().TransactionID == "T2"
    config["transformation"]["schema_validation"]["strict"] = True
    config["performance"]["watermark_name"] = "strict"
    with pytest.raises(SchemaViolation):
        jobs.run_configured(payments, config, "r3")
    assert jobs.run_configured(payments.where("TransactionID < 'T4'"), config, "r4") == 3


def test_declared_fill_values_are_paired():
    declared = {"merchant": "fill_constant", "merchant_fill_value": "Unknown", "amount": "drop_row"}
    assert jobs.column_strategies(declared) == {"merchant": ("fill_constant", "Unknown"), "amount": "drop_row"}


PLAIN = "id long, name string, at long"


def file_pipeline(root, loading, watermark=False):
    state = {"watermark_name": "files", "watermark_path": f"{root}/state", "staging_path": f"{root}/staged"}
    return {
        "extraction": {
            "source_type": "file",
            "file_source": {
                "input_directory": f"{root}/in", "processed_directory": f"{root}/done", "file_pattern": "*.csv", "file_format": "csv",
            },
        },
        "transformation": {},
        "loading": loading,
        "performance": state | ({"watermark_column": "at"} if watermark else {"use_watermarking": False}),
    }


def land(spark, root, rows, name):
    """One file of a given name."""
    from ledgerloom.sinks.files_log import system_of

    spark.createDataFrame(rows, PLAIN).coalesce(1).write.option("header", True).csv(f"{root}/aside-{name}")
    system, path = system_of(spark, root)
    (part,) = [s.getPath() for s in system.globStatus(path(f"{root}/aside-{name}/part-*"))]
    system.mkdirs(path(f"{root}/in"))
    assert system.rename(part, path(f"{root}/in/{name}.csv"))


STEPS = [
    (jobs.file_sinks, "stage", "after"),
    (jobs, "write_configured", "before"),
    (jobs, "write_configured", "after"),
    (jobs.store, "publish_increment", "before"),
    (jobs.store, "publish_increment", "after"),
    (jobs.journal, "archive", "before"),
    (jobs.journal.Run, "note", "after"),
]


@pytest.mark.parametrize("method, watermark", [("append", False), ("append", True), ("upsert", False), ("files", False)])
def test_a_run_that_stops_is_taken_up(spark, fresh, monkeypatch, method, watermark):
    """The run stops at each step in turn; what it left is finished once, with the files it had."""
    for where, step, when in STEPS:
        root, name = fresh("resumed"), table_name("resumed")
        loading = {"load_method": method, "target_table": name, "conflict_target_columns": ["id"], "path": f"{root}/table"}
        if method == "files":
            loading = {"load_method": "files", "output_directory": f"{root}/table", "partition_by": ["id"]}
        config = file_pipeline(root, loading, watermark)
        land(spark, root, [(1, "a", 10), (2, "b", 11), (None, "no key", 12)], "one")
        real = getattr(where, step)

        def dies(*a, **k):
            if when == "after":
                real(*a, **k)
            raise OSError("gone")

        with monkeypatch.context() as m:
            m.setattr(where, step, dies)
            try:
                jobs.run_pipeline(spark, config, "run-1", PLAIN)
            except OSError:
                pass
        # Another file lands before the run is repeated.
        land(spark, root, [(3, "c", 20), (None, "no key either", 21)], "two")
        jobs.run_pipeline(spark, config, "run-2", PLAIN)
        got = spark.read.parquet(f"{root}/table") if method == "files" else spark.read.table(name)
        assert sorted(r["name"] for r in got.collect()) == ["a", "b", "c", "no key", "no key either"], (step, when)
        assert jobs.journal.files_in(spark, f"{root}/in") == []
        assert len(jobs.journal.files_in(spark, f"{root}/done")) == 2


def test_equal_names_stay_apart_in_the_archive(spark, fresh):
    root, name = fresh("names"), table_name("names")
    config = file_pipeline(root, {"load_method": "append", "target_table": name, "path": f"{root}/table"}, True)
    land(spark, root, [(1, "a", 10), (4, "unmarked", None)], "day")
    assert jobs.run_pipeline(spark, config, "daily", PLAIN) == 1
    spark.createDataFrame([(2, "b", 20)], PLAIN).coalesce(1).write.option("header", True).csv(f"{root}/aside")
    system, path = jobs.journal.system_of(spark, root)
    (part,) = [s.getPath() for s in system.globStatus(path(f"{root}/aside/part-*"))]
    assert system.rename(part, path(f"{root}/in/day.csv"))
    assert jobs.run_pipeline(spark, config, "daily", PLAIN) == 1
    assert sorted(n.rpartition("/done/")[2] for n, _ in jobs.journal.files_in(spark, f"{root}/done")) == ["000000001-daily/day.csv", "000000002-daily/day.csv"]
    assert [r.name for r in spark.read.parquet(f"{root}/staged/unmarked-000000001-daily").collect()] == ["unmarked"]
    assert spark.read.table(name).count() == 2


def test_rows_of_earlier_runs_are_left_out(spark, fresh, monkeypatch):
    root, name = fresh("seen"), table_name("seen")
    config = {
        "transformation": {},
        "loading": {"load_method": "append", "target_table": name, "path": f"{root}/table"},
        "performance": {
            "watermark_name": "w", "watermark_column": "at", "watermark_path": f"{root}/state", "staging_path": f"{root}/staged",
            "remember_rows": True, "remember_keys": ["id", "name"],
        },
    }

    def rows(at, *pairs):
        return spark.createDataFrame([(i, n, at) for i, n in pairs], PLAIN)

    jobs.run_configured(rows(1, (1, "a"), (None, "b")), config, "r1")
    # A run that remembered its rows and stopped before its mark: they are loaded by the next.
    with monkeypatch.context() as m:
        m.setattr(jobs, "write_configured", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.run_configured(rows(2, (2, "c"), (1, "a")), config, "r2")
    jobs.run_configured(rows(2, (2, "c"), (1, "a")), config, "r3")
    jobs.run_configured(rows(3, (2, "c"), (None, "b"), (1, "other"), (3, None)), config, "r4")
    jobs.run_configured(rows(4, (3, None), (1, "a")), config, "r5")
    got = sorted(str((r.id, r.name)) for r in spark.read.table(name).collect())
    assert got == sorted(map(str, [(1, "a"), (None, "b"), (2, "c"), (1, "other"), (3, None)]))


def test_checked_rows_are_read_once(spark, fresh):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def day(n):
        read.add(1)
        return [None, "2024-01-02", "no date"][n % 3]

    amount = F.when(F.col("id") % 5 == 0, "n/a").when(F.col("id") % 5 == 1, None).otherwise("1.5")
    df = spark.range(0, 300, 1, 3).select("id", amount.alias("amount"), day("id").alias("day"))
    expected = [
        {"name": "amount", "type": "float", "required": True},
        {"name": "day", "type": "datetime", "datetime_format": "%Y-%m-%d", "required": True},
        {"name": "nowhere", "type": "string"},
    ]
    path = fresh()
    good = jobs.set_aside(df, {"schema_validation": {"enabled": True, "expected_columns": expected}}, path)
    assert read.value == 300
    report = {(r.column_name, r.rule): r.violations for r in spark.read.json(f"{path}/report").collect()}
    assert report == {
        ("amount", "present"): 0, ("day", "present"): 0, ("nowhere", "present"): 1,
        ("amount", "required"): 60, ("amount", "type"): 60, ("day", "required"): 100, ("day", "datetime_format"): 100,
    }
    bad = {r.id: r.failed_rules for r in spark.read.parquet(f"{path}/rows").collect()}
    rules = lambda n: ["amount.type"] * (n % 5 == 0) + ["day.datetime_format"] * (n % 3 == 2)
    assert bad == {n: rules(n) for n in range(300) if rules(n)}
    assert sorted(r.id for r in good.collect()) == [n for n in range(300) if not rules(n)] and good.columns == df.columns
    empty = jobs.set_aside(df.where("id < 0"), {"schema_validation": {"enabled": True, "expected_columns": expected[2:]}}, fresh())
    assert empty.count() == 0
