"""Registered queries: sinks, loads, streams, run metrics and whole jobs."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from ledgerloom.functions import business, mapping, parsing, text
from ledgerloom.operators import quality
from ledgerloom.plans import jobs
from ledgerloom.plans.queries_read import EVENTS, ORDERS
from ledgerloom.plans.raw import NUMBER, PRESENT, RAW, STRIP, raw_orders
from ledgerloom.plans.registry import register, released, table, table_name
from ledgerloom.session import fresh_path, written_table
from ledgerloom.sinks import files as file_sinks, journal, store, tables as table_sinks
from ledgerloom.sources import files, incremental
from ledgerloom.streaming import runs

AMOUNT = NUMBER.format("Amount")
SCORE = PRESENT.format("Score")


@register("L1_stage", ORDERS)
def l1(spark, sf):
    return file_sinks.stage(table(spark, sf, "orders"), fresh_path(spark, "l1"), "csv")


@register("L2_csv_sink", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def l2(spark, sf):
    customers = table(spark, sf, "customer")
    path = fresh_path(spark, "l2")
    file_sinks.write_csv(customers, path, sep="|", encoding="ISO-8859-1", header=False)
    return files.read_csv(spark, path, customers.schema, delimiter="|", header=False, encoding="ISO-8859-1")


@register("L3_json_lines", EVENTS)
def l3(spark, sf):
    events = table(spark, sf, "events")
    path = fresh_path(spark, "l3")
    file_sinks.write_json_lines(events, path)
    return files.read_json_lines(spark, path, events.schema, **file_sinks.ISO_TIMES)


@register(
    "L4_json_arrays",
    "SELECT event_id, epoch_us(ts) // 1000 AS ts, event_type, value FROM events",
)
def l4(spark, sf):
    path = fresh_path(spark, "l4")
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    file_sinks.write_json_arrays(events, path, date_format="epoch")
    return files.read_json_documents(spark, path, "event_id long, ts long, event_type string, value double")


@register("L5_parquet_sink", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def l5(spark, sf):
    path = fresh_path(spark, "l5")
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"]
    file_sinks.write_parquet(table(spark, sf, "lineitem").select(*columns), path, compression="gzip")
    return files.read_staged(spark, path)


@register(
    "L6_partitioned_sink",
    """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year,
              CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""",
)
def l6(spark, sf):
    path = fresh_path(spark, "l6")
    stamped = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    file_sinks.write_partitioned(stamped, path, ["year", "month"])
    return files.read_staged(spark, path)


@register("L7_append", ORDERS)
def l7(spark, sf):
    orders = table(spark, sf, "orders")
    name, path = table_name("append"), fresh_path(spark, "l7")
    settled = F.col("o_orderstatus") == "F"
    table_sinks.load_table(orders.where(settled), name, "append", path)
    table_sinks.load_table(orders.where(~settled), name, "append")
    return released(spark, name)


@register("L8_replace", "SELECT o_orderkey, o_totalprice * 2 AS doubled FROM orders")
def l8(spark, sf):
    orders = table(spark, sf, "orders")
    name, path = table_name("replace"), fresh_path(spark, "l8")
    table_sinks.load_table(orders, name, "fail", path)
    doubled = orders.select("o_orderkey", (F.col("o_totalprice") * 2).alias("doubled"))
    table_sinks.load_table(doubled, name, "replace", path)
    return released(spark, name)


@register("L9_fail_if_exists", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def l9(spark, sf):
    from pyspark.errors import AnalysisException

    parts = table(spark, sf, "part")
    name = table_name("fail")
    table_sinks.load_table(parts, name, path=fresh_path(spark, "l9"))
    try:
        table_sinks.load_table(parts, name)
    except AnalysisException:
        return released(spark, name)
    raise AssertionError("the second load should have failed")


@register("L10_empty_load", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def l10(spark, sf):
    customers = table(spark, sf, "customer")
    name, path = table_name("empty"), fresh_path(spark, "l10")
    table_sinks.load_table(customers, name, path=path)
    table_sinks.load_table(customers.where("c_name = 'nobody'"), name, "replace", path)
    return released(spark, name)


@register("L11_batched_load", EVENTS.replace(" FROM", ", TRUE AS in_batches FROM"))
def l11(spark, sf):
    name, events = table_name("batched"), table(spark, sf, "events")
    size = -(-events.count() // 10)
    table_sinks.load_table(events, name, "append", fresh_path(spark, "l11"), batch_size=size)
    loaded = released(spark, name)
    return loaded.withColumn("in_batches", F.lit(len(loaded.inputFiles()) >= 10))


@register(
    "L12_update_where",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_totalprice > 100000 THEN 'X' ELSE o_orderstatus END
              AS o_orderstatus, CASE WHEN o_orderstatus = 'P' AND o_totalprice > 100000 THEN o_totalprice / 2
              ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def l12(spark, sf):
    name = table_name("update")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    table_sinks.load_table(orders, name, path=fresh_path(spark, "l12"))
    table_sinks.update_where(
        spark,
        name,
        {"o_orderstatus": "'X'", "o_totalprice": "o_totalprice / 2"},
        "o_orderstatus = 'P' AND o_totalprice > 100000",
    )
    return released(spark, name)


@register("L13_truncate_and_analyze", ORDERS)
def l13(spark, sf):
    orders = table(spark, sf, "orders")
    name, path = table_name("truncate"), fresh_path(spark, "l13")
    table_sinks.load_table(orders, name, path=path)
    table_sinks.truncate(spark, name)
    table_sinks.load_table(orders, name, "append")
    table_sinks.analyze(spark, name, ["o_orderkey", "o_totalprice"])
    return released(spark, name)


@register(
    "L12_update_partitions",
    """SELECT event_id, CASE WHEN event_type = 'error' AND value > 50 THEN -value ELSE value END AS value, event_type
       FROM events""",
)
def l12_partitions(spark, sf):
    name, path = table_name("update_parts"), fresh_path(spark, "l12-parts")
    events = table(spark, sf, "events").select("event_id", "value", "event_type")
    events.hint("rebalance", "event_type").write.partitionBy("event_type").option("path", path).saveAsTable(name)
    table_sinks.update_where(spark, name, {"value": "-value"}, "event_type = 'error' AND value > 50")
    spark.sql(f"DROP TABLE {name}")
    return files.read_staged(spark, path)


@register(
    "L13_truncate_partitions",
    "SELECT event_id, value, event_type FROM events WHERE event_type <> 'error'",
)
def l13_partitions(spark, sf):
    name, path = table_name("truncate_parts"), fresh_path(spark, "l13-parts")
    events = table(spark, sf, "events").select("event_id", "value", "event_type")
    events.hint("rebalance", "event_type").write.partitionBy("event_type").option("path", path).saveAsTable(name)
    table_sinks.truncate(spark, name)
    events.where("event_type <> 'error'").write.insertInto(name)
    spark.sql(f"DROP TABLE {name}")
    return files.read_staged(spark, path)


NULL_TYPE = "nullif(event_type, 'click')"


@register(
    "L14_upsert_null_partition",
    f"""SELECT event_id, CASE WHEN {NULL_TYPE} IS NULL AND value > 50 THEN value * 2 ELSE value END AS value,
               {NULL_TYPE} AS kind FROM events""",
)
def l14_null_partition(spark, sf):
    name, path = table_name("null_parts"), fresh_path(spark, "l14-null")
    events = table(spark, sf, "events").select("event_id", "value", F.expr(NULL_TYPE).alias("kind"))
    events.hint("rebalance", "kind").write.partitionBy("kind").option("path", path).saveAsTable(name)
    doubled = events.where("kind IS NULL AND value > 50").withColumn("value", F.col("value") * 2)
    table_sinks.upsert_table(spark, name, doubled, ["event_id"], partitions_follow_keys=True)
    spark.sql(f"DROP TABLE {name}")
    return files.read_staged(spark, path)


CHANGED = """
    SELECT o_orderkey + 7 AS o_orderkey, o_custkey, 'N' AS o_orderstatus, o_totalprice + 1 AS o_totalprice,
           o_orderdate, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'
"""


def changed_orders(orders):
    """Changes to some orders and, past the highest key, some new ones."""
    return orders.where("o_orderpriority = '1-URGENT'").withColumns(
        {
            "o_orderkey": F.col("o_orderkey") + 7,
            "o_orderstatus": F.lit("N"),
            "o_totalprice": F.col("o_totalprice") + 1,
        }
    )


UPSERTED = f"""
    SELECT * FROM ({CHANGED}) c
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({CHANGED}) k)
"""


@register("L14_upsert", UPSERTED)
def l14(spark, sf):
    orders = table(spark, sf, "orders")
    name = table_name("upsert")
    table_sinks.load_table(orders, name, path=fresh_path(spark, "l14"))
    changes = changed_orders(orders)
    repeated = changes.withColumn("o_totalprice", F.col("o_totalprice") - 1).unionByName(changes)
    table_sinks.upsert_table(spark, name, repeated, ["o_orderkey"], ["o_totalprice"])
    return released(spark, name)


@register(
    "L14_upsert_partitions",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN value * 2 ELSE value END AS value, event_type FROM events""",
)
def l14_partitions(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value", "event_type")
    name, path = table_name("parts"), fresh_path(spark, "l14-parts")
    events.hint("rebalance", "event_type").write.partitionBy("event_type").option("path", path).saveAsTable(name)
    errors = events.where("event_type = 'error'").withColumn("value", F.col("value") * 2)
    table_sinks.upsert_table(spark, name, errors, ["event_id"], partitions_follow_keys=True)
    spark.sql(f"DROP TABLE {name}")
    return files.read_staged(spark, path)


@register("L14_interleaved_writers", UPSERTED)
def l14_writers(spark, sf):
    """Three writers at once, each with a third of the changes."""
    orders = table(spark, sf, "orders")
    name = table_name("writers")
    table_sinks.load_table(orders, name, path=fresh_path(spark, "l14-writers"))
    parts = [changed_orders(orders).where(F.col("o_orderkey") % 3 == part) for part in range(3)]
    with ThreadPoolExecutor(len(parts)) as pool:
        list(pool.map(lambda part: table_sinks.upsert_table(spark, name, part, ["o_orderkey"]), parts))
    return released(spark, name)


@register(
    "L14_moving_keys",
    """SELECT event_id, value, CASE WHEN event_type = 'error' AND value > 50 THEN 'settled' ELSE event_type END AS event_type
       FROM events""",
)
def l14_moving(spark, sf):
    """Events that change their partition, some to one that was not there."""
    events = table(spark, sf, "events").select("event_id", "value", "event_type")
    name, path = table_name("moving"), fresh_path(spark, "l14-moving")
    events.hint("rebalance", "event_type").write.partitionBy("event_type").option("path", path).saveAsTable(name)
    settled = events.where("event_type = 'error' AND value > 50").withColumn("event_type", F.lit("settled"))
    table_sinks.upsert_table(spark, name, settled, ["event_id"])
    spark.sql(f"DROP TABLE {name}")
    return files.read_staged(spark, path)


@register("L15_load_state", "SELECT event_id, ts, user_id, value FROM events")
def l15(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    name, path, state = table_name("state"), fresh_path(spark, "l15"), fresh_path(spark, "l15-state")
    early = events.where(F.col("ts") <= F.lit("2024-01-09 12:00:00").cast("timestamp_ntz"))
    for run, rows in (("run-1", early), ("run-2", events), ("run-3", events)):
        table_sinks.load_increment(rows, name, "ts", state, "events", run, path)
    return released(spark, name)


@register("L15_repeated_run", "SELECT event_id, ts, user_id, value FROM events")
def l15_repeated(spark, sf):
    """A run that stops after it stored its mark, and the runs that follow it."""
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    name, path, state = table_name("repeated"), fresh_path(spark, "l15-rep"), fresh_path(spark, "l15-rep-state")
    table_sinks.load_increment(events.limit(0), name, "ts", state, "events", "run-0", path)
    batch = incremental.MarkedBatch(events.where(F.col("ts") <= F.lit("2024-01-09 12:00:00").cast("timestamp_ntz")), "ts")
    staged = store.increment_path(path)
    batch.df.write.parquet(staged)
    batch.commit(spark, state, "events", "run-1", staged, path)
    for run in ("run-2", "run-3"):
        table_sinks.load_increment(events, name, "ts", state, "events", run, path)
    return released(spark, name)


@register(
    "R1_incremental_files",
    "SELECT o_orderkey, o_totalprice, upper(o_orderpriority) AS priority FROM orders",
)
def r1(spark, sf):
    orders = table(spark, sf, "orders")
    root = fresh_path(spark, "r1")
    for status in ("F", "O", "P"):
        orders.where(F.col("o_orderstatus") == status).write.mode("append").parquet(f"{root}/landing")
        stream = runs.read_file_stream(spark, f"{root}/landing", "parquet", orders.schema)
        shaped = stream.select(
            "o_orderkey", "o_totalprice", text.to_case(F.col("o_orderpriority"), "upper").alias("priority")
        )
        runs.run_to_files(shaped, f"{root}/loaded", f"{root}/state")
    return files.read_staged(spark, f"{root}/loaded")


@register("R2_stream_dedup", "SELECT event_id, ts, event_type, value FROM events")
def r2(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    root = fresh_path(spark, "r2")
    for copies in (2, 1):
        for _ in range(copies):
            events.write.mode("append").parquet(f"{root}/landing")
        stream = runs.read_file_stream(spark, f"{root}/landing", "parquet", events.schema)
        once = runs.deduplicate_stream(stream, ["event_id"], "ts", "60 days")
        runs.run_to_files(once, f"{root}/loaded", f"{root}/state")
    return files.read_staged(spark, f"{root}/loaded")


@register("R3_stream_upsert", UPSERTED)
def r3(spark, sf):
    orders = table(spark, sf, "orders")
    root, name = fresh_path(spark, "r3"), table_name("stream_upsert")
    for rows in (orders, changed_orders(orders)):
        rows.write.mode("append").parquet(f"{root}/landing")
        stream = runs.read_file_stream(spark, f"{root}/landing", "parquet", orders.schema)
        runs.run_upsert(stream, name, ["o_orderkey"], f"{root}/state", path=f"{root}/table")
    return released(spark, name)


@register(
    "R3_repeated_batch",
    """SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS o_orderkey, o_totalprice, o_orderstatus FROM orders""",
)
def r3_repeated(spark, sf):
    """Batches that come twice, as after a failure, with keys that are null."""
    keyed = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("o_orderkey")
    orders = table(spark, sf, "orders").select(keyed, "o_totalprice", "o_orderstatus")
    root, name = fresh_path(spark, "r3-twice"), table_name("twice")
    for status in ("F", "P", "O"):
        orders.where(F.col("o_orderstatus") == status).write.mode("append").parquet(f"{root}/landing")
        stream = runs.read_file_stream(spark, f"{root}/landing", "parquet", orders.schema)

        def twice(batch, number):
            for _ in range(2):
                table_sinks.upsert_table(batch.sparkSession, name, batch, ["o_orderkey"], path=f"{root}/table", batch=("orders", number))

        runs.run_batches(stream, twice, f"{root}/state")
    spark.catalog.refreshTable(name)
    return released(spark, name)


@register(
    "R4_stream_columns",
    RAW
    + f"""SELECT TransactionID, {AMOUNT} AS Amount, {STRIP.format("Description")} AS Description,
                 CASE trim(Status) WHEN 'COMPLETED' THEN 'Processed' WHEN 'Pending' THEN 'AwaitingSettlement'
                      ELSE 'failed' END AS Status,
                 Currency IS NULL OR Currency <> 'USD' AS IsInternational
          FROM raw""",
)
def r4(spark, sf):
    raw = raw_orders(spark, sf).select("TransactionID", "Amount", "Description", "Status", "Currency")
    root = fresh_path(spark, "r4")
    raw.write.parquet(f"{root}/landing")
    stream = runs.read_file_stream(spark, f"{root}/landing", "parquet", raw.schema)
    shaped = stream.select(
        "TransactionID",
        parsing.to_number(F.col("Amount")).alias("Amount"),
        text.strip(F.col("Description")).alias("Description"),
        mapping.normal_status(F.col("Status")).alias("Status"),
        business.is_international(F.col("Currency")).alias("IsInternational"),
    )
    runs.run_to_files(shaped, f"{root}/loaded", f"{root}/state")
    return files.read_staged(spark, f"{root}/loaded")


@register(
    "Q4_run_metrics",
    """SELECT 'extract' AS task, 'succeeded' AS status, count(*) AS records FROM orders
       UNION ALL SELECT 'transform', 'succeeded', count(*) FROM orders WHERE o_orderstatus <> 'P'""",
)
def q4(spark, sf):
    metrics = quality.RunMetrics("run-1", {"source": "orders"})
    root = fresh_path(spark, "q4")
    with metrics.stage("extract") as stage:
        file_sinks.write_parquet(stage.counted(table(spark, sf, "orders")), f"{root}/staged")
    with metrics.stage("transform") as stage:
        staged = files.read_staged(spark, f"{root}/staged").where("o_orderstatus <> 'P'")
        file_sinks.write_parquet(stage.counted(staged), f"{root}/kept")
    return metrics.frame(spark).select("task", "status", "records")


@register(
    "Q4_stream_metrics",
    """SELECT 'events' AS task, (row_number() OVER (ORDER BY event_type) - 1)::VARCHAR AS batch_id, count(*) AS records,
              count(*) FILTER (WHERE value > 50)::VARCHAR AS rows_out
       FROM events GROUP BY event_type""",
)
def q4_stream(spark, sf):
    """A batch per event type, in runs one after the other: rows read and rows kept."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    root, metrics = fresh_path(spark, "q4-stream"), quality.RunMetrics("run-1")
    kinds = [r["event_type"] for r in events.select("event_type").distinct().orderBy("event_type").collect()]
    for kind in kinds:
        events.where(F.col("event_type") == kind).coalesce(1).write.mode("append").parquet(f"{root}/landing")
        stream = runs.read_file_stream(spark, f"{root}/landing", "parquet", events.schema).where("value > 50")
        runs.run_to_files(stream, f"{root}/kept", f"{root}/state", metrics=metrics, task="events")
    found = metrics.frame(spark).where("records > 0")
    return found.select("task", F.col("tags")["batch_id"].alias("batch_id"), "records", F.col("tags")["rows_out"].alias("rows_out"))


@register(
    "J1_records",
    RAW
    + f"""SELECT TransactionID, Date, coalesce({AMOUNT}, 0.0) AS Amount,
                 Currency, {STRIP.format("Description")} AS Description,
                 {STRIP.format("coalesce(Merchant, 'Unknown')")} AS Merchant,
                 CASE trim(Status) WHEN 'COMPLETED' THEN 'Processed' WHEN 'Pending' THEN 'AwaitingSettlement'
                      ELSE 'failed' END AS Status,
                 CAST(year(Date) AS INTEGER) AS TransactionYear,
                 CAST(month(Date) AS INTEGER) AS TransactionMonth,
                 CAST(day(Date) AS INTEGER) AS TransactionDay,
                 strftime(Date, '%A') AS TransactionDayOfWeek, {STRIP.format("Category")} AS Category
          FROM (SELECT *, TRY_STRPTIME(TransactionDate, '%Y-%m-%d') AS Date FROM raw) t""",
)
def j1(spark, sf):
    # Three ways to write a date; what is none of them stays as it is.
    at, number = F.try_to_timestamp("TransactionDate", F.lit("yyyy-MM-dd")), F.substring("TransactionID", -1, 1)
    styled = F.coalesce(
        F.when(number == "1", F.date_format(at, "dd.MM.yyyy")).when(number == "2", F.date_format(at, "MM/dd/yyyy")),
        F.col("TransactionDate"),
    )
    raw = raw_orders(spark, sf).select(
        "TransactionID",
        styled.alias("Date"),
        "Amount",
        "Currency",
        "Description",
        "Merchant",
        "Status",
        "Category",
        F.col("Tier").alias("leftover"),
    )
    root, name = fresh_path(spark, "j1"), table_name("records")
    file_sinks.write_csv(raw, f"{root}/input", max_rows_per_file=file_sinks.STAGED_CSV_ROWS, sep=";")
    options = {"delimiter": ";", "multi_line": True, **file_sinks.CSV_READ}
    jobs.run_simple(
        spark,
        {
            "source_data": {"type": "csv", "path": f"{root}/input", "schema": raw.schema, "options": options},
            "staging_area": {"path": f"{root}/staged", "format": "csv"},
            "transformations": {"drop_columns": ["leftover", "nowhere"], "date_formats": ["%d.%m.%Y", "%m/%d/%Y"]},
            "target_database": {"target_table": name, "load_method": "replace", "path": f"{root}/table"},
        },
    )
    return released(spark, name)


@register(
    "J2_processed_records",
    RAW
    + f"""SELECT TransactionID,
                 TRY_STRPTIME(TransactionDate || ' ' || TransactionTime, '%Y-%m-%d %H:%M:%S') AS TransactionTimestamp,
                 AccountNumber, TransactionType, {AMOUNT} AS OriginalAmount, Currency AS OriginalCurrency,
                 CASE upper(Currency) WHEN 'EUR' THEN {AMOUNT} * CAST(1.09 AS DOUBLE)
                      WHEN 'CAD' THEN {AMOUNT} * CAST(0.75 AS DOUBLE) ELSE {AMOUNT} END AS NormalizedAmountUSD,
                 Description, upper({STRIP.format("Category")}) AS StandardizedCategory, Status AS StandardizedStatus,
                 coalesce(Currency <> 'USD', TRUE) AS IsInternational
          FROM raw""",
)
def j2(spark, sf):
    return jobs.processed_records(raw_orders(spark, sf))


@register(
    "J2_staged_records",
    RAW
    + """SELECT TransactionID, TransactionDate || ' ' || TransactionTime AS RawTransactionTimestamp, Amount, Currency,
                Category, Status, CASE WHEN Status = 'failed' THEN 'PASSED_WITH_WARNINGS' ELSE 'PASSED' END
                AS PreliminaryValidationStatus
         FROM raw""",
)
def j2_staged(spark, sf):
    columns = ["TransactionID", "TransactionDate", "TransactionTime", "Amount", "Currency", "Category", "Status"]
    return jobs.staged_records(raw_orders(spark, sf).select(*columns))


CHAIN_TARGET = [
    {"target_name": "TxnID", "source_column": "TransactionID", "dtype": "str", "required": True},
    {"target_name": "Timestamp", "source_column": "TransactionTimestamp", "dtype": "datetime64[ns]"},
    {"target_name": "Amount", "source_column": "Amount", "dtype": "float64"},
    {"target_name": "AmountUSD", "source_column": "NormalizedAmountUSD", "dtype": "float64"},
    {"target_name": "Merchant", "source_column": "Merchant", "dtype": "str"},
    {"target_name": "Foreign", "source_column": "IsInternational", "dtype": "bool"},
    {"target_name": "ReviewMark", "source_column": "old_remarks", "dtype": "str"},
]


@register(
    "J3_class_chain",
    RAW
    + f"""SELECT TransactionID AS TxnID,
                 TRY_STRPTIME(TransactionDate || ' ' || TransactionTime, '%Y-%m-%d %H:%M:%S') AS Timestamp,
                 {AMOUNT} AS Amount,
                 CASE upper(Currency) WHEN 'EUR' THEN {AMOUNT} * CAST(1.09 AS DOUBLE)
                      WHEN 'CAD' THEN {AMOUNT} * CAST(0.75 AS DOUBLE) ELSE {AMOUNT} END AS AmountUSD,
                 coalesce(Merchant, 'UNKNOWN') AS Merchant, coalesce(Currency <> 'USD', TRUE) AS Foreign,
                 CASE WHEN {AMOUNT} > 400000 THEN 'review' END AS ReviewMark
          FROM raw""".replace("AS Foreign", 'AS "Foreign"').replace("AS Timestamp", 'AS "Timestamp"'),
)
def j3(spark, sf):
    name = table_name("chain")
    jobs.run_class_chain(
        raw_orders(spark, sf),
        name,
        CHAIN_TARGET,
        ["Merchant", "Description"],
        [({"ReviewMark": "'review'"}, "Amount > 400000")],
        fresh_path(spark, "j3"),
    )
    return released(spark, name)


TRANSFORMATION = {
    "schema_validation": {
        "enabled": True,
        "expected_columns": [
            {"name": "TransactionID", "type": "string", "required": True},
            {"name": "Amount", "type": "float", "required": True},
            {"name": "TransactionDate", "type": "datetime", "datetime_format": "%Y-%m-%d", "required": True},
        ],
    },
    "cleaning_rules": {
        "handle_missing_values": {
            "default_strategy": "drop_row",
            "column_strategies": {"Merchant": "fill_constant", "Merchant_fill_value": "(not named)"},
        },
        "normalize_text_fields": ["Merchant", "Description"],
        "remove_duplicates": True,
    },
    "business_logic": {
        "add_calculated_fields": [
            {"name": "above_limit", "condition_column": "Amount", "condition_threshold": 12500.0}
        ]
    },
}

CONFIGURED = (
    RAW
    + f"""SELECT TransactionID, seq, {AMOUNT} AS Amount, TRY_STRPTIME(TransactionDate, '%Y-%m-%d') AS TransactionDate,
                 lower({STRIP.format("coalesce(Merchant, '(not named)')")}) AS Merchant,
                 lower({STRIP.format("Description")}) AS Description, ({AMOUNT}) > 12500 AS above_limit --more
          FROM (SELECT *, CAST(substr(TransactionID, 4) AS BIGINT) AS seq FROM raw) t
          WHERE ({AMOUNT}) IS NOT NULL AND TRY_STRPTIME(TransactionDate, '%Y-%m-%d') IS NOT NULL"""
)


def landed_records(spark, sf):
    return raw_orders(spark, sf).select(
        "TransactionID",
        F.expr("CAST(substring(TransactionID, 4) AS BIGINT)").alias("seq"),
        "Amount",
        "TransactionDate",
        "Merchant",
        "Description",
    )


def configured(root: str, loading: dict) -> dict:
    return {
        "transformation": TRANSFORMATION,
        "loading": loading,
        "performance": {
            "watermark_name": "records",
            "watermark_column": "seq",
            "watermark_path": f"{root}/state",
            "staging_path": f"{root}/staged",
        },
    }


@register("J4_configured_upsert", CONFIGURED)
def j4(spark, sf):
    # Landed once: three runs read the records, each of them twice.
    records = written_table(landed_records(spark, sf), "landed")
    root, name = fresh_path(spark, "j4"), table_name("configured")
    config = configured(
        root,
        {
            "load_method": "upsert",
            "target_table": name,
            "conflict_target_columns": ["TransactionID"],
            "path": f"{root}/table",
        },
    )
    doubled = records.unionByName(records)
    jobs.run_configured(doubled.where("Description LIKE '%URGENT%'"), config, "run-1")
    jobs.run_configured(doubled, config, "run-2")
    # The strict mark leaves rows below it out, so the rest comes as a load of its own.
    config["performance"]["watermark_name"] = "late records"
    jobs.run_configured(doubled, config, "run-3")
    return released(spark, name)


@register(
    "J4_configured_files",
    CONFIGURED.replace(
        "--more",
        """, CAST(year(TRY_STRPTIME(TransactionDate, '%Y-%m-%d')) AS INTEGER) AS year,
             CAST(month(TRY_STRPTIME(TransactionDate, '%Y-%m-%d')) AS INTEGER) AS month"""
    ),
)
def j4_files(spark, sf):
    records = landed_records(spark, sf)
    root = fresh_path(spark, "j4-files")
    config = configured(
        root,
        {"load_method": "files", "output_directory": f"{root}/out", "date_column": "TransactionDate"},
    )
    middle = records.agg(F.avg("seq")).first()[0]
    jobs.run_configured(records.where(F.col("seq") <= middle), config, "run-1")
    jobs.run_configured(records, config, "run-2")
    return files.read_staged(spark, f"{root}/out")


@register("J4_configured_stream", CONFIGURED)
def j4_stream(spark, sf):
    records = landed_records(spark, sf)
    root, name = fresh_path(spark, "j4-stream"), table_name("configured_stream")
    for _ in range(2):
        records.write.mode("append").parquet(f"{root}/landing")
        stream = runs.read_file_stream(spark, f"{root}/landing", "parquet", records.schema)

        def load(batch, batch_id):
            out = jobs.configured_transform(batch, TRANSFORMATION)
            table_sinks.upsert_table(spark, name, out, ["TransactionID"], path=f"{root}/table")

        runs.run_batches(stream, load, f"{root}/state")
    return released(spark, name)


@register(
    "J4_shipped_config",
    RAW
    + f"""SELECT TransactionID AS transaction_id, {AMOUNT} AS amount, Currency AS currency,
                 TRY_STRPTIME(TransactionDate || ' ' || TransactionTime, '%Y-%m-%d %H:%M:%S') AS transaction_date,
                 AccountNumber AS customer_id, lower({STRIP.format("coalesce(Merchant, '(no name)')")}) AS merchant_name,
                 {AMOUNT} > 12500 AS above_limit
          FROM raw
          WHERE {AMOUNT} IS NOT NULL AND Currency IS NOT NULL
            AND TRY_STRPTIME(TransactionDate || ' ' || TransactionTime, '%Y-%m-%d %H:%M:%S') IS NOT NULL""",
)
def j4_shipped(spark, sf):
    """A nested configuration over files: archive, quarantine, bulk load, in two runs."""
    raw = raw_orders(spark, sf).select(
        F.col("TransactionID").alias("transaction_id"),
        F.col("Amount").alias("amount"),
        F.col("Currency").alias("currency"),
        F.concat("TransactionDate", F.lit(" "), "TransactionTime").alias("transaction_date"),
        F.col("AccountNumber").alias("customer_id"),
        F.col("Merchant").alias("merchant_name"),
    )
    root, name = fresh_path(spark, "j4-shipped"), table_name("shipped")
    text_column = {"type": "string", "required": True}
    config = {
        "pipeline_name": "records",
        "extraction": {
            "source_type": "file",
            "file_source": {
                "enabled": True,
                "input_directory": f"{root}/input",
                "processed_directory": f"{root}/archive",
                "file_pattern": "*.csv",
                "file_format": "csv",
                "csv_options": {"delimiter": "|", "header": True, "encoding": "utf-8", **file_sinks.CSV_READ},
            },
        },
        "transformation": {
            "schema_validation": {
                "enabled": True,
                "expected_columns": [
                    {"name": "transaction_id", **text_column},
                    {"name": "amount", "type": "float", "required": True},
                    {"name": "currency", **text_column},
                    {
                        "name": "transaction_date",
                        "type": "datetime",
                        "datetime_format": "%Y-%m-%d %H:%M:%S",
                        "required": True,
                    },
                    {"name": "customer_id", **text_column},
                    {"name": "merchant_name", "type": "string", "required": False},
                ],
            },
            "cleaning_rules": {
                "handle_missing_values": {
                    "default_strategy": "drop_row",
                    "column_strategies": {"merchant_name": "fill_constant", "merchant_name_fill_value": "(no name)"},
                },
                "normalize_text_fields": ["merchant_name", "description"],
                "remove_duplicates": True,
            },
            "business_logic": {
                "add_calculated_fields": [
                    {"name": "above_limit", "condition_column": "amount", "condition_threshold": 12500.0}
                ]
            },
            "staging_format": "parquet",
            "staging_directory": f"{root}/staging/",
        },
        "loading": {
            "destination_type": "database",
            "database_destination": {
                "enabled": True,
                "schema": "default",
                "target_table": name,
                "load_method": "bulk",
                "batch_size": 10_000,
                "pre_load_sql": None,
                "post_load_sql": [f"ANALYZE TABLE {name} COMPUTE STATISTICS"],
                "path": f"{root}/table",
            },
        },
        "performance": {"use_watermarking": True, "watermark_file_path": f"{root}/mark"},
    }
    halves = (raw.where("substring(transaction_id, -1) < '5'"), raw.where("substring(transaction_id, -1) >= '5'"))
    for run, half in enumerate(halves):
        file_sinks.write_csv(half, f"{root}/input", sep="|", mode="append")
        jobs.run_pipeline(spark, config, f"run-{run}", raw.schema)
    return released(spark, name)


@register(
    "Q2_quarantine",
    RAW
    + f"""SELECT TransactionID, Amount, TransactionDate,
                 ({AMOUNT}) IS NULL AND Amount IS NOT NULL AS bad_amount,
                 TransactionDate IS NOT NULL AND TRY_STRPTIME(TransactionDate, '%Y-%m-%d') IS NULL AS bad_date
          FROM raw WHERE (({AMOUNT}) IS NULL AND Amount IS NOT NULL)
             OR (TransactionDate IS NOT NULL AND TRY_STRPTIME(TransactionDate, '%Y-%m-%d') IS NULL)""",
)
def q2_quarantine(spark, sf):
    """What a configured run sets aside."""
    path = fresh_path(spark, "q2-quarantine")
    records = landed_records(spark, sf)
    kept = jobs.set_aside(records, TRANSFORMATION, path)
    if kept.count() + spark.read.parquet(f"{path}/rows").count() != records.count():
        raise AssertionError("every row is kept or set aside")
    rules = F.col("failed_rules")
    return files.read_staged(spark, f"{path}/rows").select(
        "TransactionID",
        "Amount",
        "TransactionDate",
        F.array_contains(rules, "Amount.type").alias("bad_amount"),
        F.array_contains(rules, "TransactionDate.datetime_format").alias("bad_date"),
    )


@register("J4_resumed_run", ORDERS)
def j4_resumed(spark, sf):
    """Runs over landed files that stopped: one before its load, one between its load and the archive."""
    orders = table(spark, sf, "orders")
    root, name = fresh_path(spark, "j4-resumed"), table_name("resumed")
    config = {
        "pipeline_name": "orders",
        "extraction": {
            "source_type": "file",
            "file_source": {"input_directory": f"{root}/in", "processed_directory": f"{root}/done", "file_format": "parquet"},
        },
        "transformation": {},
        "loading": {"load_method": "append", "target_table": name, "path": f"{root}/table"},
        "performance": {"use_watermarking": False, "watermark_path": f"{root}/state", "staging_path": f"{root}/staged"},
    }
    folder = journal.journal_folder(f"{root}/state", "orders")

    def land(status):
        orders.where(F.col("o_orderstatus") == status).write.mode("append").parquet(f"{root}/in")
        return journal.files_in(spark, f"{root}/in", "*.parquet")

    config["extraction"]["file_source"]["file_pattern"] = "*.parquet"
    journal.begin(spark, folder, "stopped before the load", land("F"))
    land("P")
    jobs.run_pipeline(spark, config, "the next", orders.schema)
    stopped = journal.begin(spark, folder, "stopped before the archive", land("O"))
    jobs.run_configured(jobs.read_configured(spark, config["extraction"], orders.schema, stopped.files), config, stopped.label, stopped)
    for again in ("again", "and again"):
        jobs.run_pipeline(spark, config, again, orders.schema)
    return released(spark, name)


@register("J4_dedup_across_runs", "SELECT event_id, event_type, value FROM events")
def j4_dedup(spark, sf):
    """Increments that bring rows of earlier ones again, under a later mark."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    root, name = fresh_path(spark, "j4-dedup"), table_name("dedup_runs")
    config = {
        "transformation": {"cleaning_rules": {"remove_duplicates": True}},
        "loading": {"load_method": "append", "target_table": name, "path": f"{root}/table"},
        "performance": {
            "watermark_name": "events",
            "watermark_column": "landed",
            "watermark_path": f"{root}/state",
            "staging_path": f"{root}/staged",
            "remember_rows": True,
            "remember_keys": ["event_id", "event_type", "value"],
        },
    }
    parts = ("event_id % 3 = 0", "event_id % 3 <= 1", "true")
    for run, part in enumerate(parts):
        batch = events.where(part).withColumn("landed", F.lit(run))
        jobs.run_configured(batch.unionByName(batch.where("event_id % 2 = 0")), config, f"run-{run}")
    return released(spark, name).drop("landed")


@register(
    "J4_running_statistics",
    """WITH e AS (SELECT event_id, event_id % 4 AS landed, CASE WHEN event_id % 11 <> 0 THEN user_id END AS user_id,
                      CASE WHEN event_id % 7 <> 0 THEN value END AS value, CASE WHEN event_id % 5 <> 0 THEN event_type END AS event_type
               FROM events),
            runs AS (SELECT DISTINCT landed AS run FROM e),
            numbers AS (SELECT run, avg(user_id) AS mean, list_sort(list(value) FILTER (value IS NOT NULL)) AS v
                        FROM runs JOIN e ON landed <= run GROUP BY run),
            kinds AS (SELECT run, event_type AS common, row_number() OVER (PARTITION BY run ORDER BY count(*) DESC, event_type) AS place
                      FROM runs JOIN e ON landed <= run WHERE event_type IS NOT NULL GROUP BY run, event_type)
       SELECT event_id, CAST(landed AS BIGINT) AS landed, coalesce(CAST(user_id AS DOUBLE), mean) AS user_id,
              coalesce(value, (v[(len(v) + 1) // 2] + v[len(v) // 2 + 1]) / 2) AS value, coalesce(event_type, common) AS event_type
       FROM e JOIN numbers ON numbers.run = landed JOIN kinds ON kinds.run = landed AND place = 1""",
)
def j4_running(spark, sf):
    """Increments whose gaps are filled with the statistics of all rows read so far."""
    gaps = {"user_id": 11, "value": 7, "event_type": 5}
    events = table(spark, sf, "events").select(
        "event_id",
        (F.col("event_id") % 4).alias("landed"),
        *[F.when(F.col("event_id") % n != 0, F.col(c)).alias(c) for c, n in gaps.items()],
    )
    root, name = fresh_path(spark, "j4-running"), table_name("running")
    config = {
        "transformation": {
            "cleaning_rules": {
                "handle_missing_values": {
                    "column_strategies": {"user_id": "fill_mean", "value": "fill_median", "event_type": "fill_mode"}
                }
            }
        },
        "loading": {"load_method": "append", "target_table": name, "path": f"{root}/table"},
        "performance": {
            "watermark_name": "events",
            "watermark_column": "landed",
            "watermark_path": f"{root}/state",
            "staging_path": f"{root}/staged",
            "running_statistics": True,
        },
    }
    for run in range(4):
        jobs.run_configured(events.where(F.col("landed") <= run), config, f"run-{run}")
    return released(spark, name)
