"""Untidy records derived from ``orders``.

The supplied tables are clean. These records carry, on every order, what the
operators are there to repair: gaps, bad numbers and dates, stray blanks, mixed
case. Which value is untidy follows from the keys, so the check SQL can say it
again in its own words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.plans.registry import table


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")

    def two(c):
        return F.lpad(c.cast("string"), 2, "0")

    def number(c, width):
        return F.lpad(c.cast("string"), width, "0")

    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("TXN"), number(key, 10)).alias("TransactionID"),
        F.when(key % 17 == 0, "no date")
        .when(key % 19 == 0, None)
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("TransactionDate"),
        F.concat_ws(":", two(key % 24), two(key * 7 % 60), two(key * 13 % 60)).alias("TransactionTime"),
        F.concat(F.lit("ACC"), number(cust, 9)).alias("AccountNumber"),
        F.when(cust % 3 == 0, "DEBIT").when(cust % 3 == 1, "CREDIT").otherwise("TRANSFER").alias(
            "TransactionType"
        ),
        F.when(key % 7 == 0, None)
        .when(key % 11 == 0, "n/a")
        .when(key % 13 == 0, F.concat(amount, F.lit("d")))
        .when(key % 23 == 0, F.concat(F.lit(" "), amount, F.lit("\t")))
        .otherwise(amount)
        .alias("Amount"),
        F.when(cust % 5 == 0, "USD")
        .when(cust % 5 == 1, "eur")
        .when(cust % 5 == 2, "CAD")
        .when(cust % 5 == 3, "GBP")
        .alias("Currency"),
        F.concat(F.lit("\t "), F.col("o_orderpriority"), F.lit(" order of "), cust.cast("string"), F.lit("\xa0 "))
        .alias("Description"),
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit("\n")).alias("Category"),
        F.when(F.col("o_orderstatus") == "F", " COMPLETED ")
        .when(F.col("o_orderstatus") == "O", "Pending")
        .otherwise("failed")
        .alias("Status"),
        F.when(cust % 6 == 0, None)
        .when(cust % 6 == 1, "   ")
        .otherwise(F.concat(F.lit(" Merchant "), (cust % 100).cast("string"), F.lit("\t")))
        .alias("Merchant"),
        F.when(key % 8 == 0, "True")
        .when(key % 8 == 1, "FALSE")
        .when(key % 8 == 2, "true")
        .when(key % 8 == 3, "0")
        .when(key % 8 == 4, "1")
        .when(key % 8 == 6, "yes")
        .when(key % 8 == 7, " false ")
        .alias("IsActive"),
        F.when(key % 9 == 0, None)
        .when(key % 10 == 3, float("nan"))
        .otherwise(F.col("o_totalprice"))
        .alias("Score"),
        F.when(key % 6 != 0, cust % 50).alias("Points"),
        F.when(key % 5 != 1, F.substring("o_orderpriority", 1, 1)).alias("Tier"),
    )


# The same records for the check engine, as the head of a statement.
RAW = """
WITH raw AS (
  SELECT 'TXN' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS TransactionID,
         CASE WHEN o_orderkey % 17 = 0 THEN 'no date'
              WHEN o_orderkey % 19 = 0 THEN NULL
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS TransactionDate,
         lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':' ||
         lpad(CAST(o_orderkey * 7 % 60 AS VARCHAR), 2, '0') || ':' ||
         lpad(CAST(o_orderkey * 13 % 60 AS VARCHAR), 2, '0') AS TransactionTime,
         'ACC' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS AccountNumber,
         CASE o_custkey % 3 WHEN 0 THEN 'DEBIT' WHEN 1 THEN 'CREDIT' ELSE 'TRANSFER' END AS TransactionType,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL
              WHEN o_orderkey % 11 = 0 THEN 'n/a'
              WHEN o_orderkey % 13 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || 'd'
              WHEN o_orderkey % 23 = 0
                THEN ' ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || chr(9)
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS Amount,
         CASE o_custkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'eur' WHEN 2 THEN 'CAD' WHEN 3 THEN 'GBP' END AS Currency,
         chr(9) || ' ' || o_orderpriority || ' order of ' || CAST(o_custkey AS VARCHAR) || chr(160) || ' ' AS Description,
         '  ' || o_orderpriority || chr(10) AS Category,
         CASE o_orderstatus WHEN 'F' THEN ' COMPLETED ' WHEN 'O' THEN 'Pending' ELSE 'failed' END AS Status,
         CASE o_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '   '
              ELSE ' Merchant ' || CAST(o_custkey % 100 AS VARCHAR) || chr(9) END AS Merchant,
         CASE o_orderkey % 8 WHEN 0 THEN 'True' WHEN 1 THEN 'FALSE' WHEN 2 THEN 'true' WHEN 3 THEN '0'
              WHEN 4 THEN '1' WHEN 6 THEN 'yes' WHEN 7 THEN ' false ' END AS IsActive,
         CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 10 = 3 THEN CAST('nan' AS DOUBLE)
              ELSE o_totalprice END AS Score,
         CASE WHEN o_orderkey % 6 <> 0 THEN o_custkey % 50 END AS Points,
         CASE WHEN o_orderkey % 5 <> 1 THEN substr(o_orderpriority, 1, 1) END AS Tier
  FROM orders)
"""

# Texts without white space at the ends, numbers out of plain decimal texts.
STRIP = "regexp_replace({0}, '^[\\s\\x{{A0}}]+|[\\s\\x{{A0}}]+$', '', 'g')"
NUMBER = (
    "CASE WHEN regexp_matches(trim({0}, ' ' || chr(9)), "
    "'^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') "
    "THEN TRY_CAST(trim({0}, ' ' || chr(9)) AS DOUBLE) END"
)
PRESENT = "CASE WHEN isnan({0}) THEN NULL ELSE {0} END"
