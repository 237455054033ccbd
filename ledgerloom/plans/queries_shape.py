"""Registered queries: schema shaping and type conversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import parsing
from ledgerloom.operators import convert, shape
from ledgerloom.plans.raw import NUMBER, RAW, raw_orders
from ledgerloom.plans.registry import register, table

AMOUNT = NUMBER.format("Amount")
STAMP = "TRY_STRPTIME(TransactionDate || ' ' || TransactionTime, '%Y-%m-%d %H:%M:%S')"
ACTIVE = (
    "CASE WHEN lower(trim(IsActive)) IN ('true', '1') THEN TRUE "
    "WHEN lower(trim(IsActive)) IN ('false', '0') THEN FALSE END"
)


@register(
    "P1_select_rename",
    RAW + "SELECT TransactionID AS TxnID, Amount AS RawAmount, Currency AS Ccy FROM raw",
)
def p1(spark, sf):
    names = {"TransactionID": "TxnID", "Amount": "RawAmount", "NoSuchColumn": "Gone", "Currency": "Ccy"}
    return shape.select_and_rename(raw_orders(spark, sf), names)


TARGET = [
    {"target_name": "points_text", "source_column": "Points", "dtype": "str"},
    {"target_name": "open", "source_column": "IsActive", "dtype": "bool"},
    {"target_name": "charged", "source_column": "Amount", "dtype": "float64"},
    {"target_name": "order_ref", "source_column": "TransactionID", "dtype": "str", "required": True},
    {"target_name": "placed", "source_column": "TransactionDate", "dtype": "datetime64[ns]"},
]


@register(
    "P2_conform",
    RAW
    + f"""SELECT CAST(Points AS VARCHAR) AS points_text, {ACTIVE} AS "open", {AMOUNT} AS charged,
                 TransactionID AS order_ref, TRY_STRPTIME(TransactionDate, '%Y-%m-%d') AS placed
          FROM raw""",
)
def p2(spark, sf):
    return shape.conform(raw_orders(spark, sf), TARGET).df


@register(
    "P3_missing_source",
    """SELECT o_orderkey AS ID, CAST(NULL AS DOUBLE) AS MissingValue, CAST(NULL AS VARCHAR) AS Notes,
              CAST(NULL AS TIMESTAMP) AS SeenAt
       FROM orders""",
)
def p3(spark, sf):
    target = [
        {"target_name": "ID", "source_column": "o_orderkey", "dtype": "int64"},
        {"target_name": "MissingValue", "source_column": "nowhere", "dtype": "float64", "required": True},
        {"target_name": "Notes", "source_column": "old_remarks", "dtype": "str"},
        {"target_name": "SeenAt", "source_column": "seen", "dtype": "datetime64[ns]"},
    ]
    return shape.conform(table(spark, sf, "orders"), target).df


@register(
    "P4_schema_check",
    "SELECT c_custkey AS CustomerID, c_name AS Name, c_acctbal AS Balance, 4 AS refused FROM customer",
)
def p4(spark, sf):
    target = [
        {"target_name": "CustomerID", "source_column": "c_custkey", "dtype": "int64"},
        {"target_name": "Name", "source_column": "c_name", "dtype": "str"},
        {"target_name": "Balance", "source_column": "c_acctbal", "dtype": "float64"},
    ]
    shape.check_target_schema(target)
    refused = 0
    for bad in (target[0], ["c_custkey"], [{"target_name": "x", "dtype": "str"}], [{**target[0], "dtype": None}, target[1:]]):
        try:
            shape.check_target_schema(bad)
        except ValueError:
            refused += 1
    return shape.conform(table(spark, sf, "customer"), target).df.withColumn("refused", F.lit(refused))


@register(
    "P5_drop_columns",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders",
)
def p5(spark, sf):
    return shape.drop_columns(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority", "nowhere"])


@register(
    "P6_rename",
    "SELECT p_partkey AS part_id, p_name AS name, p_brand, p_type, p_size, p_retailprice AS price FROM part",
)
def p6(spark, sf):
    names = {"p_partkey": "part_id", "p_name": "name", "p_retailprice": "price", "nowhere": "gone"}
    return shape.rename_columns(table(spark, sf, "part"), names)


@register(
    "P7_clean_names",
    """SELECT c_custkey AS cust_key, c_name AS c_name, c_nationkey AS nation_key, c_acctbal AS acct_bal,
              c_mktsegment AS mktsegment FROM customer""",
)
def p7(spark, sf):
    untidy = table(spark, sf, "customer").toDF(" Cust Key ", "c.Name", "Nation-Key", "Acct  Bal!", "_MktSegment_")
    return shape.clean_column_names(untidy, "snake")


@register(
    "P8_column_order",
    "SELECT l_shipdate AS shipped, l_quantity AS quantity, l_orderkey AS order_id, l_linenumber AS line FROM lineitem",
)
def p8(spark, sf):
    target = [
        {"target_name": "shipped", "source_column": "l_shipdate", "dtype": "timestamp_ntz"},
        {"target_name": "quantity", "source_column": "l_quantity", "dtype": "float64"},
        {"target_name": "order_id", "source_column": "l_orderkey", "dtype": "int64"},
        {"target_name": "line", "source_column": "l_linenumber", "dtype": "int32"},
    ]
    return shape.conform(table(spark, sf, "lineitem"), target).df


@register(
    "T1_convert_types",
    RAW
    + f"""SELECT TransactionID, {AMOUNT} AS Amount, {ACTIVE} AS IsActive, CAST(Points AS VARCHAR) AS Points,
                 CAST(Tier AS BIGINT) AS Tier, TRY_STRPTIME(TransactionDate, '%Y-%m-%d') AS TransactionDate
          FROM raw""",
)
def t1(spark, sf):
    columns = ["TransactionID", "Amount", "IsActive", "Points", "Tier", "TransactionDate"]
    types = {
        "Amount": "float64",
        "IsActive": "bool",
        "Points": "str",
        "Tier": "Int64",
        "TransactionDate": "datetime",
        "nowhere": "int",
    }
    return convert.convert_types(raw_orders(spark, sf).select(*columns), types)


@register(
    "T1_keep_unconverted",
    RAW + "SELECT TransactionID, Amount, CAST(Points AS DOUBLE) AS Points, CAST(Tier AS BIGINT) AS Tier FROM raw",
)
def t1_keep(spark, sf):
    raw = raw_orders(spark, sf).select("TransactionID", "Amount", "Points", "Tier")
    return convert.convert_types(raw, {"Amount": "float64", "Points": "float64", "Tier": "int"}, on_error="keep")


@register(
    "T2_schema_cast",
    """SELECT CAST(l_orderkey AS VARCHAR) AS order_text, CAST(l_quantity AS BIGINT) AS quantity,
              CAST(l_linenumber AS DOUBLE) AS line, strftime(l_shipdate, '%Y-%m-%d') AS ship_day,
              l_linenumber <> 0 AS has_line
       FROM lineitem""",
)
def t2(spark, sf):
    target = [
        {"target_name": "order_text", "source_column": "l_orderkey", "dtype": "str"},
        {"target_name": "quantity", "source_column": "l_quantity", "dtype": "int64"},
        {"target_name": "line", "source_column": "l_linenumber", "dtype": "float64"},
        {"target_name": "ship_day", "source_column": "l_shipdate", "dtype": "date"},
        {"target_name": "has_line", "source_column": "l_linenumber", "dtype": "bool"},
    ]
    out = shape.conform(table(spark, sf, "lineitem"), target).df
    return out.withColumn("ship_day", F.col("ship_day").cast("string"))


@register("T3_boolean_text", RAW + f"SELECT TransactionID, {ACTIVE} AS active FROM raw")
def t3(spark, sf):
    return raw_orders(spark, sf).select("TransactionID", parsing.to_boolean(F.col("IsActive")).alias("active"))


@register("T4_numeric_coerce", RAW + f"SELECT TransactionID, {AMOUNT} AS amount FROM raw")
def t4(spark, sf):
    return raw_orders(spark, sf).select("TransactionID", parsing.to_number(F.col("Amount")).alias("amount"))


@register(
    "T5_parse_datetime",
    """SELECT event_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS seen,
              CASE WHEN event_id % 12 = 0 THEN NULL ELSE date_trunc('day', ts)::TIMESTAMP END AS day
       FROM events""",
)
def t5(spark, sf):
    texts = table(spark, sf, "events").select(
        "event_id",
        F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("seen"),
        F.when(F.col("event_id") % 12 == 0, "soon").otherwise(F.date_format("ts", "d MMM yyyy")).alias("day"),
    )
    parsed = convert.parse_datetime(texts, "seen", "%d/%m/%Y %H:%M:%S", errors="raise")
    return convert.parse_datetime(parsed, "day", "%d %b %Y", errors="coerce")


@register(
    "T5_all_directives",
    """SELECT event_id, date_trunc('minute', ts)::TIMESTAMP AS named, date_trunc('day', ts)::TIMESTAMP AS short,
              date_trunc('second', ts)::TIMESTAMP - INTERVAL 1 HOUR AS zoned, date_trunc('day', ts)::TIMESTAMP - INTERVAL 30 YEAR AS old
       FROM events""",
)
def t5_directives(spark, sf):
    """Weekdays, two-digit years of both centuries, offsets in three forms."""
    ts = F.col("ts")
    offset = F.when(F.col("event_id") % 3 == 0, "+0100").when(F.col("event_id") % 3 == 1, "+01:00").otherwise("Z")
    utc = F.when(F.col("event_id") % 3 == 2, ts - F.expr("INTERVAL 1 HOUR")).otherwise(ts)
    texts = table(spark, sf, "events").select(
        "event_id",
        F.date_format(ts, "EEEE, d MMMM yyyy hh:mm a").alias("named"),
        F.date_format(ts, "EEE dd.MM.yy").alias("short"),
        F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), offset).alias("zoned"),
        F.date_format(ts - F.expr("INTERVAL 30 YEAR"), "d/M/yy").alias("old"),
    )
    formats = {"named": "%A, %d %B %Y %I:%M %p", "short": "%a %d.%m.%y", "zoned": "%Y-%m-%dT%H:%M:%S%z", "old": "%d/%m/%y"}
    for name, pattern in formats.items():
        texts = convert.parse_datetime(texts, name, pattern)
    return texts


@register(
    "T6_inferred_patterns",
    """SELECT l_orderkey, l_linenumber, l_shipdate::TIMESTAMP AS shipped, l_shipdate::TIMESTAMP + INTERVAL 90 MINUTE AS seen,
              CASE WHEN l_linenumber % 7 <> 0 THEN date_trunc('day', l_shipdate)::TIMESTAMP END AS noted
       FROM lineitem""",
)
def t6_inferred(spark, sf):
    """Dates whose pattern nobody declared: day-first, with a time, and with values that are none."""
    at = F.col("l_shipdate")
    texts = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.date_format(at, "dd/MM/yyyy").alias("shipped"),
        F.date_format(at + F.expr("INTERVAL 90 MINUTE"), "yyyy-MM-dd HH:mm:ss").alias("seen"),
        F.when(F.col("l_linenumber") % 7 == 0, "tomorrow").otherwise(F.date_format(at, "MMM d, yyyy")).alias("noted"),
    )
    return convert.parse_inferred(texts, ["shipped", "seen", "noted"])


@register(
    "T6_parse_date",
    RAW + "SELECT TransactionID, TRY_STRPTIME(TransactionDate, '%Y-%m-%d') AS dated FROM raw",
)
def t6(spark, sf):
    return raw_orders(spark, sf).select(
        "TransactionID", parsing.to_timestamp(F.col("TransactionDate")).alias("dated")
    )


@register(
    "T7_transaction_timestamp",
    RAW + f"SELECT TransactionID, TransactionDate, TransactionTime, {STAMP} AS TransactionTimestamp FROM raw",
)
def t7(spark, sf):
    raw = raw_orders(spark, sf).select("TransactionID", "TransactionDate", "TransactionTime")
    return convert.create_timestamp(raw, "TransactionDate", "TransactionTime", datetime_format="%Y-%m-%d %H:%M:%S")
