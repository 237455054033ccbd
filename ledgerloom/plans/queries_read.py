"""Registered queries: file, table, page and incremental sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.plans.raw import RAW, raw_orders
from ledgerloom.plans.registry import register, released, table, table_name
from ledgerloom.session import fresh_path
from ledgerloom.sinks import files as file_sinks, tables as table_sinks
from ledgerloom.sources import files, incremental, pages, tables
from ledgerloom.streaming import runs

ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"
EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


@register("S1_csv_scan", ORDERS)
def s1(spark, sf):
    orders = table(spark, sf, "orders")
    path = fresh_path(spark, "s1")
    file_sinks.write_csv(orders, path, sep=";")
    return files.read_csv(spark, path, orders.schema, delimiter=";", **file_sinks.CSV_READ)


@register("S1_line_ends", RAW + "SELECT TransactionID, Category, Description, Amount FROM raw")
def s1_line_ends(spark, sf):
    """Values with line ends, quotes and separators, in files of a bounded size."""
    raw = raw_orders(spark, sf).select("TransactionID", "Category", "Description", "Amount")
    path = fresh_path(spark, "s1-lines")
    file_sinks.write_csv(raw, path, max_rows_per_file=file_sinks.STAGED_CSV_ROWS)
    return files.read_csv(spark, path, raw.schema, multi_line=True, **file_sinks.CSV_READ)


@register(
    "S2_csv_malformed",
    """WITH lines AS (
         SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
                o_orderkey % 50 = 0 AS too_long, o_orderkey % 51 = 0 AS bad_type FROM orders)
       SELECT CASE WHEN NOT too_long AND NOT bad_type THEN o_orderkey END AS o_orderkey,
              CASE WHEN NOT too_long AND NOT bad_type THEN o_custkey END AS o_custkey,
              CASE WHEN NOT too_long AND NOT bad_type THEN CAST(price AS DOUBLE) END AS price,
              CASE WHEN too_long OR bad_type THEN
                o_orderkey || ',' || o_custkey || ',' || CASE WHEN bad_type THEN 'abc' ELSE CAST(price AS VARCHAR) END
                || CASE WHEN too_long THEN ',one too many' ELSE '' END END AS raw_text
       FROM lines""",
)
def s2(spark, sf):
    key = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    line = F.concat_ws(
        ",",
        key.cast("string"),
        F.col("o_custkey").cast("string"),
        F.when(key % 51 == 0, "abc").otherwise(price),
        F.when(key % 50 == 0, "one too many"),
    )
    path = fresh_path(spark, "s2")
    table(spark, sf, "orders").select(line.alias("value")).write.text(path)
    split = files.read_csv_split(spark, path, "o_orderkey long, o_custkey long, price double", header=False)
    bad = split.quarantine.select("raw_text")
    return split.good.unionByName(bad, allowMissingColumns=True)


@register("S3_csv_chunks", EVENTS.replace(" FROM", ", TRUE AS in_chunks FROM"))
def s3(spark, sf):
    events = table(spark, sf, "events")
    source, out, state = (fresh_path(spark, n) for n in ("s3-source", "s3-out", "s3-state"))
    file_sinks.write_csv(events.coalesce(1), source, max_rows_per_file=-(-events.count() // 8))
    chunks = runs.read_file_stream(
        spark, source, "csv", events.schema, max_files_per_batch=3, header=True, **file_sinks.CSV_READ
    )
    runs.run_batches(chunks, lambda df, number: df.write.mode("overwrite").parquet(f"{out}/chunk={number}"), state)
    loaded = files.read_staged(spark, out)
    several = loaded.select("chunk").distinct().count() > 1
    return loaded.drop("chunk").withColumn("in_chunks", F.lit(several))


@register("S4_json_documents", EVENTS)
def s4(spark, sf):
    events = table(spark, sf, "events")
    path = fresh_path(spark, "s4")
    file_sinks.write_json_arrays(events, path)
    return files.read_json_documents(spark, path, events.schema, **file_sinks.ISO_TIMES)


PRICED = """
    SELECT CASE WHEN o_orderkey % 20 > 0 THEN o_orderkey END AS o_orderkey,
           CASE WHEN o_orderkey % 20 > 0 THEN o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderkey % 20 > 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS price,
           CASE WHEN o_orderkey % 20 = 0 THEN o_orderkey END AS set_aside
    FROM orders
"""


def priced(spark, sf):
    """Orders with a price, one in twenty of them a price that is no number."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    wrong = F.when(F.col("o_orderkey") % 20 == 0, "on request").otherwise(price)
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", wrong.alias("price"))


def with_set_aside(split: files.SplitScan):
    key = F.get_json_object("raw_text", "$.o_orderkey").cast("long")
    return split.good.unionByName(split.quarantine.select(key.alias("set_aside")), allowMissingColumns=True)


@register("S4_json_quarantine", PRICED)
def s4_quarantine(spark, sf):
    path = fresh_path(spark, "s4-bad")
    file_sinks.write_json_arrays(priced(spark, sf), path)
    return with_set_aside(files.read_json_split(spark, path, "o_orderkey long, o_orderstatus string, price double"))


@register("S15_xml_quarantine", PRICED)
def s15_quarantine(spark, sf):
    path = fresh_path(spark, "s15-bad")
    priced(spark, sf).write.format("xml").options(rowTag="order", rootTag="orders").save(path)
    return with_set_aside(files.read_xml_split(spark, path, "order", "o_orderkey long, o_orderstatus string, price double"))


@register("S5_staged_scan", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def s5(spark, sf):
    path = fresh_path(spark, "s5")
    file_sinks.write_parquet(table(spark, sf, "documents"), path)
    return files.read_staged(spark, path, "parquet")


@register("S6_parquet_scan", "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_size > 10 AND p_brand <> 'Brand#2'")
def s6(spark, sf):
    part = files.read_path(spark, f"{sf}/part.parquet")
    return part.where("p_size > 10 AND p_brand <> 'Brand#2'").select("p_partkey", "p_name", "p_retailprice")


@register("S7_directory_glob", EVENTS)
def s7(spark, sf):
    events = table(spark, sf, "events")
    root = fresh_path(spark, "s7")
    file_sinks.write_csv(events.where("event_id % 2 = 0"), f"{root}/even/days")
    file_sinks.write_csv(events.where("event_id % 2 = 1"), f"{root}/odd")
    file_sinks.write_json_lines(events, f"{root}/other")
    return files.read_directory(spark, root, "csv", "*.csv", events.schema, **file_sinks.CSV_READ)


@register("S8_archived_files", f"SELECT *, 2 AS held FROM ({ORDERS}) t")
def s8(spark, sf):
    """Every row is loaded once, and lies once in the archive or, from the last run, in the source folder."""
    orders = table(spark, sf, "orders")
    root = fresh_path(spark, "s8")
    settled = F.col("o_orderstatus") == "F"
    for drop in (orders.where(settled), orders.where(~settled)):
        drop.write.mode("append").parquet(f"{root}/landing")
        stream = runs.read_file_stream(
            spark, f"{root}/landing", "parquet", orders.schema, "*.parquet", archive_dir=f"{root}/archive"
        )
        runs.run_to_files(stream, f"{root}/loaded", f"{root}/state")
    archived = spark.read.schema(orders.schema).option("recursiveFileLookup", True).parquet(f"{root}/archive")
    left = spark.read.schema(orders.schema).parquet(f"{root}/landing")
    if archived.isEmpty():
        raise AssertionError("nothing was archived")
    held = files.read_staged(spark, f"{root}/loaded").unionByName(archived).unionByName(left)
    return held.groupBy(*orders.columns).agg(F.count(F.lit(1)).cast("int").alias("held"))


@register(
    "S9_sql_query",
    """SELECT c_mktsegment, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total,
              rank() OVER (PARTITION BY c_mktsegment ORDER BY count(*) DESC, o_orderpriority) AS place
       FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE o_totalprice > 1000.0 AND o_orderstatus <> 'P'
       GROUP BY c_mktsegment, o_orderpriority""",
)
def s9(spark, sf):
    return tables.query(
        spark,
        """SELECT c_mktsegment, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total,
                  CAST(rank() OVER (PARTITION BY c_mktsegment ORDER BY count(*) DESC, o_orderpriority) AS BIGINT) AS place
           FROM {orders} JOIN {customer} ON o_custkey = c_custkey
           WHERE o_totalprice > :floor AND o_orderstatus <> :status
           GROUP BY c_mktsegment, o_orderpriority""",
        {"floor": 1000.0, "status": "P"},
        {"orders": table(spark, sf, "orders"), "customer": table(spark, sf, "customer")},
    )


@register("S10_table_scan", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey < 12")
def s10(spark, sf):
    name = table_name("customer")
    table_sinks.load_table(table(spark, sf, "customer"), name, path=fresh_path(spark, "s10"))
    rows = tables.read_table(spark, name).where("c_nationkey < 12").select("c_custkey", "c_name", "c_acctbal")
    spark.sql(f"DROP TABLE {name}")
    return rows


@register(
    "S11_watermark_scan",
    """SELECT event_id, ts, value FROM events
       WHERE ts > (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '2024-01-12 00:00:00')""",
)
def s11(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "value")
    name, state = table_name("seen"), fresh_path(spark, "s11-state")
    earlier = events.where(F.col("ts") <= F.lit("2024-01-12 00:00:00").cast("timestamp_ntz"))
    table_sinks.load_increment(earlier, name, "ts", state, "events", "run-1", fresh_path(spark, "s11"))
    spark.sql(f"DROP TABLE {name}")
    return incremental.since_mark(events, "ts", incremental.read_high_mark(spark, state, "events"))


@register("S11_late_ties", "SELECT event_id, date_trunc('day', ts)::TIMESTAMP AS day, value FROM events")
def s11_ties(spark, sf):
    """Marks of a day: rows of the day at the mark that land later are loaded once."""
    events = table(spark, sf, "events").select("event_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "value")
    name, state, path = table_name("ties"), fresh_path(spark, "s11-ties-state"), fresh_path(spark, "s11-ties")
    early = events.where("day <= timestamp_ntz '2024-01-09 00:00:00'")
    at_mark = F.col("day") == F.lit("2024-01-09 00:00:00").cast("timestamp_ntz")
    batches = (early.where(~at_mark | (F.col("event_id") % 3 == 0)), early.where(~at_mark | (F.col("event_id") % 3 <= 1)), events, events)
    for run, rows in enumerate(batches):
        table_sinks.load_increment(rows, name, "day", state, "events", f"run-{run}", path, late_ties=True)
    return released(spark, name)


@register(
    "S12_lookback_scan",
    "SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-13 00:00:00'",
)
def s12(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    return incremental.look_back(events, "ts", as_of="2024-01-20", days=7)


def event_pages(spark, sf, with_next: bool) -> DataFrame:
    """Events as landed pages: 50 to a page, 20 pages to an endpoint, some pages broken."""
    number = F.floor(F.col("event_id") / 1000)
    page = (F.floor((F.col("event_id") % 1000) / 50) + 1).alias("page_no")
    gathered = (
        table(spark, sf, "events")
        .groupBy(number.alias("e"), page)
        .agg(F.sort_array(F.collect_list(F.struct("event_id", "event_type", "value"))).alias("results"))
    )
    e, p = F.col("e"), F.col("page_no")
    endpoint = F.concat(F.lit("events/"), e.cast("string")).alias("endpoint")
    if with_next:
        following = F.when(~((e % 3 == 0) & (p == 10)), F.concat(F.lit("events?page="), (p + 1).cast("string")))
        body = F.to_json(F.struct("results", following.alias("next")), {"ignoreNullFields": "false"})
        return gathered.select(endpoint, "page_no", F.lit(200).alias("status"), body.alias("body"))
    emptied = (e % 4 == 3) & (p == 8)
    body = F.when(emptied, '{"results": []}').otherwise(F.to_json(F.struct("results")))
    body = F.when((e % 4 == 2) & (p == 12), F.expr("left(to_json(struct(results)), 40)")).otherwise(body)
    status = F.when((e % 4 == 1) & (p == 15), 500).otherwise(200)
    return gathered.select(endpoint, "page_no", status.alias("status"), body.alias("body"))


PAGED = """
    SELECT 'events/' || CAST(event_id // 1000 AS VARCHAR) AS endpoint, (event_id % 1000) // 50 + 1 AS page_no,
           CAST(event_id % 50 AS INTEGER) AS record_no, event_id, event_type, value
    FROM events
"""


@register(
    "S13_numbered_pages",
    f"""SELECT * FROM ({PAGED}) t
        WHERE NOT ((event_id // 1000) % 4 = 1 AND page_no >= 15)
          AND NOT ((event_id // 1000) % 4 = 2 AND page_no >= 12)
          AND NOT ((event_id // 1000) % 4 = 3 AND page_no >= 8)""",
)
def s13(spark, sf):
    record = "event_id long, event_type string, value double"
    return pages.fetch_all(event_pages(spark, sf, False), record, results_key="results")


@register(
    "S13_next_pages",
    f"""SELECT * FROM ({PAGED}) t
        WHERE page_no <= CASE WHEN (event_id // 1000) % 3 = 0 THEN 10 ELSE 16 END""",
)
def s13_next(spark, sf):
    record = "event_id long, event_type string, value double"
    return pages.fetch_all(
        event_pages(spark, sf, True), record, results_key="results", next_page_url_key="next", max_pages=16
    )


@register(
    "S13_retried_pages",
    f"""SELECT * FROM ({PAGED}) t
        WHERE NOT ((event_id // 1000) % 4 = 2 AND page_no >= 12)
          AND NOT ((event_id // 1000) % 4 = 3 AND page_no >= 8)""",
)
def s13_retried(spark, sf):
    """Pages that failed are fetched again; what came last counts."""
    first = event_pages(spark, sf, False).withColumn("attempt", F.lit(1))
    again = event_pages(spark, sf, True).where("CAST(substring_index(endpoint, '/', -1) AS LONG) % 4 = 1")
    stale = again.where("page_no <= 3").withColumns({"attempt": F.lit(0), "body": F.lit('{"results": [{"event_id": -1}]}')})
    landed = first.unionByName(again.where("page_no >= 15").withColumn("attempt", F.lit(2))).unionByName(stale)
    record = "event_id long, event_type string, value double"
    return pages.fetch_all(landed, record, results_key="results")


@register(
    "S13_null_attempts",
    f"""SELECT * FROM ({PAGED}) t
        WHERE NOT ((event_id // 1000) % 4 = 2 AND page_no >= 12)
          AND NOT ((event_id // 1000) % 4 = 3 AND page_no >= 8)""",
)
def s13_null_attempts(spark, sf):
    """First reads bear no attempt; a page that was read again has a number."""
    first = event_pages(spark, sf, False).withColumn("attempt", F.lit(None).cast("int"))
    again = event_pages(spark, sf, True).where("CAST(substring_index(endpoint, '/', -1) AS LONG) % 4 = 1")
    landed = first.unionByName(again.where("page_no >= 15").withColumn("attempt", F.lit(0)))
    return pages.fetch_all(landed, "event_id long, event_type string, value double", results_key="results")


@register(
    "S14_single_record",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
       WHERE event_id % 9 <> 0 AND event_id % 10 <> 0""",
)
def s14(spark, sf):
    key = F.col("event_id")
    landed = table(spark, sf, "events").select(
        "event_id",
        F.when(key % 9 == 0, 404).otherwise(200).alias("status"),
        F.when(key % 10 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props")).alias("body"),
    )
    return pages.single_records(landed, "k long")


@register("S15_xml_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s15(spark, sf):
    customers = table(spark, sf, "customer")
    path = fresh_path(spark, "s15")
    customers.write.format("xml").options(rowTag="customer", rootTag="customers").save(path)
    return files.read_xml(spark, path, "customer", customers.schema)
