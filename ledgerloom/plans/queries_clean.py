"""Registered queries: gaps, duplicates, text, mapping, business columns, quality."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.functions import business, mapping, text
from ledgerloom.functions.parsing import to_number, to_timestamp
from ledgerloom.operators import dedup, missing, quality, values
from ledgerloom.plans.jobs import transform_records
from ledgerloom.plans.raw import NUMBER, PRESENT, RAW, STRIP, raw_orders
from ledgerloom.plans.registry import register, table

SCORE = PRESENT.format("Score")
AMOUNT = NUMBER.format("Amount")


@register(
    "M1_drop_rows",
    RAW + "SELECT TransactionID, Score, Points, Tier FROM raw WHERE Score IS NOT NULL AND NOT isnan(Score) AND Points IS NOT NULL",
)
def m1(spark, sf):
    raw = raw_orders(spark, sf).select("TransactionID", "Score", "Points", "Tier")
    return missing.handle_missing(raw, "drop_row", subset_for_drop=["Score", "Points"])


@register("M2_drop_columns", RAW + "SELECT TransactionID, AccountNumber, Tier FROM raw")
def m2(spark, sf):
    raw = raw_orders(spark, sf).select("TransactionID", "AccountNumber", "Score", "Points", "Tier")
    return missing.handle_missing(raw, "drop_column", columns=["TransactionID", "AccountNumber", "Score", "Points"])


@register(
    "M3_fill_constant",
    RAW
    + f"""SELECT TransactionID, coalesce(Merchant, 'UNKNOWN') AS Merchant, coalesce(Tier, 'UNKNOWN') AS Tier,
                 coalesce({SCORE}, -1.0) AS Score
          FROM raw""",
)
def m3(spark, sf):
    raw = raw_orders(spark, sf).select("TransactionID", "Merchant", "Tier", "Score")
    out = missing.handle_missing(raw, "fill", columns=["Merchant", "Tier", "nowhere"], fill_value="UNKNOWN")
    return missing.handle_missing(out, "fill", columns=["Score"], fill_value=-1.0)


@register(
    "M4_fill_mean",
    RAW
    + f"""SELECT TransactionID, round(coalesce({SCORE}, (SELECT avg({SCORE}) FROM raw)), 4) AS Score,
                 round(coalesce(Points, (SELECT avg(Points) FROM raw)), 4) AS Points, Tier
          FROM raw""",
)
def m4(spark, sf):
    raw = raw_orders(spark, sf).select("TransactionID", "Score", "Points", "Tier")
    filled = missing.handle_missing(raw, "mean", columns=["Score", "Points", "Tier"])
    return filled.withColumns({c: F.round(c, 4) for c in ("Score", "Points")})


@register(
    "M5_fill_median",
    RAW
    + f"""SELECT TransactionID, coalesce({SCORE}, (SELECT quantile_cont({SCORE}, 0.5) FROM raw)) AS Score,
                 coalesce(CAST(Points AS DOUBLE), (SELECT quantile_cont(CAST(Points AS DOUBLE), 0.5) FROM raw)) AS Points
          FROM raw""",
)
def m5(spark, sf):
    raw = raw_orders(spark, sf).select("TransactionID", "Score", "Points")
    return missing.handle_missing(raw, "median", columns=["Score", "Points"])


@register(
    "M6_fill_mode",
    RAW
    + f"""SELECT TransactionID,
                 coalesce(Points, (SELECT Points FROM raw WHERE Points IS NOT NULL
                                   GROUP BY Points ORDER BY count(*) DESC, Points LIMIT 1)) AS Points,
                 coalesce(Tier, (SELECT Tier FROM raw WHERE Tier IS NOT NULL
                                 GROUP BY Tier ORDER BY count(*) DESC, Tier LIMIT 1)) AS Tier,
                 coalesce({SCORE}, (SELECT Score FROM raw WHERE {SCORE} IS NOT NULL
                                    GROUP BY Score ORDER BY count(*) DESC, Score LIMIT 1)) AS Score
          FROM raw""",
)
def m6(spark, sf):
    raw = raw_orders(spark, sf).select("TransactionID", "Points", "Tier", "Score")
    return missing.handle_missing(raw, "mode", columns=["Points", "Tier", "Score"])


@register(
    "M7_domain_defaults",
    RAW
    + f"""SELECT TransactionID, {STRIP.format("coalesce(Merchant, 'Unknown')")} AS Merchant,
                 coalesce({AMOUNT}, 0.0) AS Amount
          FROM raw""",
)
def m7(spark, sf):
    return transform_records(raw_orders(spark, sf).select("TransactionID", "Merchant", "Amount"))


@register(
    "M8_column_strategies",
    RAW
    + f"""SELECT TransactionID, coalesce(Merchant, '(not named)') AS Merchant,
                 coalesce({SCORE}, (SELECT quantile_cont({SCORE}, 0.5) FROM raw)) AS Score,
                 round(coalesce(Points, (SELECT avg(Points) FROM raw)), 4) AS Points,
                 coalesce(Tier, (SELECT Tier FROM raw WHERE Tier IS NOT NULL
                                 GROUP BY Tier ORDER BY count(*) DESC, Tier LIMIT 1)) AS Tier,
                 IsActive
          FROM raw WHERE IsActive IS NOT NULL""",
)
def m8(spark, sf):
    raw = raw_orders(spark, sf).select("TransactionID", "Merchant", "Score", "Points", "Tier", "IsActive")
    strategies = {
        "Merchant": ("fill_constant", "(not named)"),
        "Score": "fill_median",
        "Points": "fill_mean",
        "Tier": "fill_mode",
    }
    out = missing.apply_strategies(raw, strategies, "drop_row")
    return out.withColumn("Points", F.round("Points", 4))


WIDE = 80


@register(
    "M8_wide_table",
    "WITH wide AS (SELECT c_custkey, "
    + ", ".join(f"CASE WHEN (c_custkey + {i}) % 7 > 0 THEN c_custkey * {i + 3} % 41 END AS v{i}" for i in range(WIDE))
    + " FROM customer), filled AS (SELECT c_custkey, "
    + ", ".join(
        f"coalesce(v{i}, (SELECT quantile_cont(v{i}, 0.5) FROM wide)) AS v{i}"
        if i % 2
        else f"coalesce(v{i}, (SELECT v{i} FROM wide WHERE v{i} IS NOT NULL GROUP BY v{i} ORDER BY count(*) DESC, v{i} LIMIT 1)) AS v{i}"
        for i in range(WIDE)
    )
    + " FROM wide) SELECT c_custkey, CAST("
    + " + ".join(f"v{i}" for i in range(1, WIDE, 2))
    + " AS DOUBLE) AS medians, CAST("
    + " + ".join(f"v{i}" for i in range(0, WIDE, 2))
    + " AS BIGINT) AS modes FROM filled",
)
def m8_wide(spark, sf):
    """Medians and modes of many columns at once."""
    key = F.col("c_custkey")
    gaps = {f"v{i}": F.when((key + i) % 7 > 0, key * (i + 3) % 41) for i in range(WIDE)}
    # One key becomes 80 values: the few files of the keys are dealt out over all cores first.
    keys = table(spark, sf, "customer").select("c_custkey").repartition(spark.sparkContext.defaultParallelism)
    wide = keys.select("c_custkey", *[c.alias(n) for n, c in gaps.items()])
    out = missing.apply_strategies(wide, {f"v{i}": "fill_median" if i % 2 else "fill_mode" for i in range(WIDE)})
    return out.select(
        "c_custkey",
        F.expr(" + ".join(f"v{i}" for i in range(1, WIDE, 2))).cast("double").alias("medians"),
        F.expr(" + ".join(f"v{i}" for i in range(0, WIDE, 2))).cast("long").alias("modes"),
    )


LINE_COLUMNS = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)
LINE_ORDER = (
    "l_shipdate {0}, l_partkey {0}, l_suppkey {0}, l_quantity {0}, l_extendedprice {0}, l_discount {0}, "
    "l_tax {0}, l_returnflag {0}, l_linestatus {0}"
)


@register(
    "D1_keep_first",
    f"""SELECT {LINE_COLUMNS} FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER.format("ASC")}) AS place
          FROM lineitem) t WHERE place = 1""",
)
def d1(spark, sf):
    lines = table(spark, sf, "lineitem")
    return dedup.drop_duplicates(lines, ["l_orderkey", "l_linenumber"], "first", ["l_shipdate"])


@register(
    "D2_keep_last",
    f"""SELECT {LINE_COLUMNS} FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER.format("DESC")}) AS place
          FROM lineitem) t WHERE place = 1""",
)
def d2(spark, sf):
    lines = table(spark, sf, "lineitem")
    return dedup.drop_duplicates(lines, ["l_orderkey", "l_linenumber"], "last", ["l_shipdate"])


@register(
    "D3_drop_all_repeated",
    f"""SELECT {LINE_COLUMNS} FROM (
          SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) t WHERE n = 1""",
)
def d3(spark, sf):
    return dedup.drop_duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], keep=False)


@register(
    "D4_whole_rows",
    "SELECT DISTINCT l_suppkey, l_quantity, l_discount, l_returnflag, l_linestatus FROM lineitem",
)
def d4(spark, sf):
    columns = ["l_suppkey", "l_quantity", "l_discount", "l_returnflag", "l_linestatus"]
    return dedup.drop_duplicates(table(spark, sf, "lineitem").select(*columns))


@register(
    "X1_strip",
    RAW
    + f"""SELECT TransactionID, {STRIP.format("Description")} AS Description, {STRIP.format("Category")} AS Category,
                 {STRIP.format("Merchant")} AS Merchant FROM raw""",
)
def x1(spark, sf):
    columns = ["Description", "Category", "Merchant"]
    raw = raw_orders(spark, sf).select("TransactionID", *columns)
    return raw.withColumns({c: text.strip(F.col(c)) for c in columns})


@register(
    "X2_case",
    """SELECT doc_id, md5(lower(text)) AS lower_md5, md5(upper(source)) AS upper_md5, text = text AS kept
       FROM documents""",
)
def x2(spark, sf):
    c = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.md5(text.to_case(c, "lower")).alias("lower_md5"),
        F.md5(text.to_case(F.col("source"), "upper")).alias("upper_md5"),
        (text.to_case(c, "shouting") == c).alias("kept"),
    )


CASED = "\\p{Lu}\\p{Ll}\\p{Lt}"


@register(
    "X3_title_case",
    f"""SELECT doc_id, md5(title) AS title_md5, CAST(length(title) AS INTEGER) AS title_chars FROM (
          SELECT doc_id, array_to_string(list_transform(
                   regexp_extract_all(lower(text), '[{CASED}]+|[^{CASED}]+'),
                   lambda run: CASE substr(run, 1, 1) WHEN 'ß' THEN 'Ss' ELSE upper(substr(run, 1, 1)) END
                               || substr(run, 2)), '') AS title
          FROM documents) t""",
)
def x3(spark, sf):
    title = F.col("title")
    return (
        table(spark, sf, "documents")
        .select("doc_id", text.title_case(F.col("text")).alias("title"))
        .select("doc_id", F.md5(title).alias("title_md5"), F.length(title).alias("title_chars"))
    )


@register(
    "X4_remove_characters",
    "SELECT doc_id, md5(translate(text, '.,;:!?()', '')) AS bare_md5 FROM documents",
)
def x4(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(text.remove_characters(F.col("text"), ".,;:!?()")).alias("bare_md5")
    )


@register(
    "X5_clean_text",
    RAW
    + f"""SELECT TransactionID, replace(replace(upper({STRIP.format("Category")}), '-', ''), ' ', '') AS Category,
                 lower({STRIP.format("Merchant")}) AS Merchant, CAST(Points AS VARCHAR) AS Points FROM raw""",
)
def x5(spark, sf):
    raw = raw_orders(spark, sf).select("TransactionID", "Category", "Merchant", "Points")
    out = values.clean_text_column(raw, "Category", to_case="upper", remove_chars="- ")
    out = values.clean_text_column(out, "Merchant", to_case="lower")
    return values.clean_text_column(out, "Points")


@register(
    "X6_strip_all",
    RAW
    + f"""SELECT TransactionID, {STRIP.format("Amount")} AS Amount, {STRIP.format("Description")} AS Description,
                 {STRIP.format("Category")} AS Category, {STRIP.format("Status")} AS Status,
                 {STRIP.format("Merchant")} AS Merchant, {STRIP.format("IsActive")} AS IsActive, Points FROM raw""",
)
def x6(spark, sf):
    columns = ["TransactionID", "Amount", "Description", "Category", "Status", "Merchant", "IsActive", "Points"]
    return values.strip_text_columns(raw_orders(spark, sf).select(*columns))


@register(
    "X7_normalize_fields",
    RAW
    + f"""SELECT TransactionID, lower({STRIP.format("Merchant")}) AS Merchant,
                 lower({STRIP.format("Description")}) AS Description, Category FROM raw""",
)
def x7(spark, sf):
    raw = raw_orders(spark, sf).select("TransactionID", "Merchant", "Description", "Category")
    return values.normalize_text_fields(raw, ["Merchant", "Description", "nowhere"])


@register(
    "X8_contains",
    """SELECT doc_id, contains(lower(text), 'licen') AS licensed, contains(lower(text), 'http') AS linked,
              contains(lower(text), 'é') AS accented FROM documents""",
)
def x8(spark, sf):
    c = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        text.contains_ignoring_case(c, "Licen").alias("licensed"),
        text.contains_ignoring_case(c, "HTTP").alias("linked"),
        text.contains_ignoring_case(c, "É").alias("accented"),
    )


@register(
    "V1_map_keep",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '5-LOW' THEN 'later'
              ELSE o_orderpriority END AS o_orderpriority FROM orders""",
)
def v1(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return values.map_values(orders, "o_orderpriority", {"1-URGENT": "now", "5-LOW": "later", "2-HIGH": None})


@register(
    "V1_map_codes",
    """SELECT c_custkey, CASE c_nationkey WHEN 1 THEN 'one' WHEN 7 THEN 'seven' ELSE CAST(c_nationkey AS VARCHAR) END AS nation,
              CASE c_mktsegment WHEN 'BUILDING' THEN '10' ELSE c_mktsegment END AS segment FROM customer""",
)
def v1_codes(spark, sf):
    """Numbers to text and text to numbers; what stays decides the type too."""
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    unused = {f"none {n}": n for n in range(100)}
    out = values.map_values(customers, "nation", {1: "one", 7: "seven", "7": "never"})
    return values.map_values(out, "segment", {"BUILDING": 10, **unused})


@register(
    "V1_map_by_table",
    """SELECT l_orderkey, l_linenumber, coalesce(p_name, CAST(l_partkey AS VARCHAR)) AS part
       FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 25) p ON l_partkey = p_partkey""",
)
def v1_table(spark, sf):
    names = table(spark, sf, "part").where("p_size <= 25").select(
        F.col("p_partkey").cast("string"), "p_name"
    )
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part")
    )
    return values.map_values(lines, "part", names)


@register(
    "V2_map_default",
    RAW
    + """SELECT TransactionID, CASE Currency WHEN 'USD' THEN 'dollar' WHEN 'eur' THEN 'euro' ELSE 'other' END AS Currency
         FROM raw""",
)
def v2(spark, sf):
    raw = raw_orders(spark, sf).select("TransactionID", "Currency")
    return values.map_values(raw, "Currency", {"USD": "dollar", "eur": "euro"}, default_value="other")


@register(
    "V3_standard_category",
    RAW
    + f"""SELECT TransactionID, upper(CASE {STRIP.format("Category")} WHEN '1-URGENT' THEN 'Urgent goods'
                 WHEN '2-HIGH' THEN 'high' ELSE {STRIP.format("Category")} END) AS Category FROM raw""",
)
def v3(spark, sf):
    raw = raw_orders(spark, sf).select("TransactionID", "Category")
    return values.standardize_categories(raw, "Category", {"1-URGENT": "Urgent goods", "2-HIGH": "high"})


@register(
    "V4_status",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Processed' WHEN 'O' THEN 'AwaitingSettlement'
              ELSE 'failed' END AS status FROM orders""",
)
def v4(spark, sf):
    raw = raw_orders(spark, sf)
    key = F.expr("CAST(substring(TransactionID, 4) AS BIGINT)").alias("o_orderkey")
    return raw.select(key, mapping.normal_status(F.col("Status")).alias("status"))


RULES = {
    "contact": ["@", "phone"],
    "Links": ["http", "www."],
    "legal": ["Copyright", "licen"],
    "never": [],
    "Secrets": ["key", "token"],
}


@register(
    "V5_keyword_tag",
    """SELECT doc_id, CASE WHEN contains(lower(text), 'key') OR contains(lower(text), 'token') THEN 'SECRETS'
              WHEN contains(lower(text), 'copyright') OR contains(lower(text), 'licen') THEN 'LEGAL'
              WHEN contains(lower(text), 'http') OR contains(lower(text), 'www.') THEN 'LINKS'
              WHEN contains(lower(text), '@') OR contains(lower(text), 'phone') THEN 'CONTACT'
              ELSE 'General' END AS tag FROM documents""",
)
def v5(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return values.tag_descriptions(documents, "text", RULES, "tag", "General").select("doc_id", "tag")


@register(
    "V5_many_keywords",
    """SELECT event_id, coalesce((SELECT 'K' || max(w) FROM range(0, 100) r(w)
              WHERE contains(props, '{"k": ' || CAST(w AS VARCHAR) || '}')), 'NONE') AS tag FROM events""",
)
def v5_many(spark, sf):
    rules = {f"k{w}": [f'{{"K": {w}}}'] for w in range(100)}
    events = table(spark, sf, "events").select("event_id", "props")
    return values.tag_descriptions(events, "props", rules, "tag", "NONE").select("event_id", "tag")


RATES = {"EUR": 1.09, "cad": 0.75}


@register(
    "V5_keyword_index",
    """SELECT o_orderkey, CASE WHEN o_custkey >= 10000 THEN 'PLACE' WHEN o_custkey % 2 = 0 THEN 'EVEN' ELSE 'ODD' END AS tag
       FROM orders""",
)
def v5_index(spark, sf):
    """Ten thousand keywords, customer numbers among them; a later rule wins."""
    numbers = [f"<{n:05d}>" for n in range(10_000)]
    rules = {"any": ["Customer"], "odd": numbers[1::2], "even": numbers[0::2], "place": ["<1", "<2", "<3", "<4", "<5", "<6", "<7", "<8", "<9"]}
    said = F.concat(F.lit("An order of CUSTOMER <"), F.lpad(F.col("o_custkey").cast("string"), 5, "0"), F.lit(">, by post"))
    orders = table(spark, sf, "orders").select("o_orderkey", said.alias("said"))
    return values.tag_descriptions(orders, "said", rules, "tag", "NONE").select("o_orderkey", "tag")


@register(
    "B1_normalize_currency",
    RAW
    + f"""SELECT TransactionID, {AMOUNT} AS Amount, Currency,
                 CASE upper(Currency) WHEN 'EUR' THEN {AMOUNT} * CAST(1.09 AS DOUBLE)
                      WHEN 'CAD' THEN {AMOUNT} * CAST(0.75 AS DOUBLE) ELSE {AMOUNT} END AS NormalizedAmountUSD,
                 coalesce(upper(Currency) <> 'USD', TRUE) AS IsInternational,
                 coalesce(upper(Currency) NOT IN ('USD', 'EUR', 'CAD'), TRUE) AS rate_missing
          FROM raw""",
)
def b1(spark, sf):
    raw = raw_orders(spark, sf).select("TransactionID", "Amount", "Currency")
    return values.normalize_currency(
        raw, "Amount", "Currency", exchange_rates=RATES, rate_missing_column="rate_missing"
    )


@register(
    "B1_rates_by_table",
    """WITH rates AS (SELECT upper(n_name) AS code, 1.0 + n_nationkey / 10.0 AS rate FROM nation)
       SELECT c_custkey, c_acctbal AS amount, lower(n_name) AS currency,
              CASE WHEN n_name = 'NATION_3' THEN c_acctbal ELSE c_acctbal * CAST(rate AS DOUBLE) END AS normalized
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN rates ON upper(n_name) = code""",
)
def b1_table(spark, sf):
    nations = table(spark, sf, "nation")
    rates = nations.select(F.upper("n_name"), (1.0 + F.col("n_nationkey") / 10.0))
    accounts = table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    accounts = accounts.select("c_custkey", F.col("c_acctbal").alias("amount"), F.lower("n_name").alias("currency"))
    return values.normalize_currency(
        accounts, "amount", "currency", "nation_3", rates, "normalized", international_column=None
    )


@register(
    "B1_dated_rates",
    """WITH rates AS (
           SELECT upper(o_orderpriority) AS code, date_trunc('day', o_orderdate)::TIMESTAMP AS since,
                  CAST(1 + max(o_orderkey % 1000) / 1000.0 AS DOUBLE) AS rate
           FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderkey % 40 = 0 GROUP BY ALL
       )
       SELECT o_orderkey, o_totalprice AS amount, lower(o_orderpriority) AS currency, o_orderdate::TIMESTAMP AS dated,
              o_totalprice * coalesce(rate, 1) AS normalized, rate IS NULL AND o_orderpriority <> '1-URGENT' AS rate_missing
       FROM orders ASOF LEFT JOIN (SELECT * FROM rates WHERE code <> '1-URGENT') r
            ON upper(o_orderpriority) = code AND o_orderdate >= since""",
)
def b1_dated(spark, sf):
    """Rates that change from day to day; one currency is the target, one has no rate."""
    orders = table(spark, sf, "orders")
    rates = orders.where("o_orderpriority <> '5-LOW' AND o_orderkey % 40 = 0")
    rates = rates.groupBy("o_orderpriority", F.date_trunc("day", "o_orderdate").alias("since"))
    rates = rates.agg((1 + F.max(F.col("o_orderkey") % 1000) / 1000.0).alias("rate"))
    rows = orders.select(
        "o_orderkey", F.col("o_totalprice").alias("amount"), F.lower("o_orderpriority").alias("currency"), F.col("o_orderdate").alias("dated")
    )
    return values.normalize_currency_dated(
        rows, "amount", "currency", "dated", rates, "1-urgent", "normalized", "rate_missing"
    )


@register(
    "V1_map_decimals",
    """SELECT l_orderkey, l_linenumber,
              CASE l_quantity WHEN 7 THEN '12345678901234567890.12' WHEN 8 THEN '0.05'
                   ELSE CAST(l_quantity AS DECIMAL(30, 2))::VARCHAR END AS few,
              CASE WHEN l_quantity <= 45 THEN '987654321098765432' || (10 + CAST(l_quantity AS INTEGER))::VARCHAR || '.25'
                   ELSE CAST(l_quantity AS DECIMAL(30, 2))::VARCHAR END AS many
       FROM lineitem""",
)
def v1_decimals(spark, sf):
    """Decimals of more digits than a double holds, by a short and a long dictionary."""
    amount = F.col("l_quantity").cast("decimal(30,2)")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", amount.alias("few"), amount.alias("many"))
    rows = values.map_values(rows, "few", {7: Decimal("12345678901234567890.12"), 8: Decimal("0.05"), 9.001: Decimal("1.00")})
    long = {n: n + Decimal("98765432109876543210.25") for n in range(-60, 46)}
    return values.map_values(rows, "many", long).withColumns({c: F.col(c).cast("string") for c in ("few", "many")})


@register(
    "B2_international",
    RAW + "SELECT TransactionID, Currency IS NULL OR upper(Currency) <> 'USD' AS foreign_currency FROM raw",
)
def b2(spark, sf):
    return raw_orders(spark, sf).select(
        "TransactionID", business.is_international(F.col("Currency"), "usd").alias("foreign_currency")
    )


@register("B3_high_value", "SELECT o_orderkey, o_totalprice, o_totalprice > 250000 AS is_high_value FROM orders")
def b3(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return values.add_threshold_flags(
        orders, [{"name": "is_high_value", "condition_column": "o_totalprice", "condition_threshold": 250000.0}]
    )


@register(
    "B4_amount_band",
    """SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 50 THEN 'Small'
              WHEN c_acctbal < 200 THEN 'Medium' WHEN c_acctbal < 1000 THEN 'Large' ELSE 'Very Large' END AS band
       FROM customer""",
)
def b4(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", "c_acctbal", business.amount_band(F.col("c_acctbal")).alias("band")
    )


@register(
    "B5_date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS TransactionYear,
              CAST(month(o_orderdate) AS INTEGER) AS TransactionMonth, CAST(day(o_orderdate) AS INTEGER) AS TransactionDay,
              strftime(o_orderdate, '%A') AS TransactionDayOfWeek FROM orders""",
)
def b5(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return values.add_date_parts(orders, "o_orderdate").drop("o_orderdate")


@register(
    "B6_raw_timestamp",
    RAW + "SELECT TransactionID, TransactionDate || ' ' || TransactionTime AS RawTransactionTimestamp FROM raw",
)
def b6(spark, sf):
    return raw_orders(spark, sf).select(
        "TransactionID",
        business.raw_timestamp_text(F.col("TransactionDate"), F.col("TransactionTime")).alias(
            "RawTransactionTimestamp"
        ),
    )


EXPECTED = [
    {"name": "TransactionID", "type": "string", "required": True},
    {"name": "Amount", "type": "float", "required": True},
    {"name": "Currency", "type": "string", "required": True},
    {"name": "TransactionDate", "type": "datetime", "datetime_format": "%Y-%m-%d", "required": True},
    {"name": "Score", "type": "float", "required": False},
    {"name": "customer_id", "type": "string", "required": True},
]


@register(
    "Q1_expected_columns",
    RAW
    + f"""SELECT 'TransactionID' AS column_name, 'present' AS rule, CAST(0 AS BIGINT) AS violations
          UNION ALL SELECT 'Amount', 'present', 0 UNION ALL SELECT 'Currency', 'present', 0
          UNION ALL SELECT 'TransactionDate', 'present', 0 UNION ALL SELECT 'Score', 'present', 0
          UNION ALL SELECT 'customer_id', 'present', 1
          UNION ALL SELECT 'TransactionID', 'required', count(*) FILTER (TransactionID IS NULL) FROM raw
          UNION ALL SELECT 'TransactionID', 'type', 0
          UNION ALL SELECT 'Amount', 'required', count(*) FILTER (Amount IS NULL) FROM raw
          UNION ALL SELECT 'Amount', 'type', count(*) FILTER (Amount IS NOT NULL AND ({AMOUNT}) IS NULL) FROM raw
          UNION ALL SELECT 'Currency', 'required', count(*) FILTER (Currency IS NULL) FROM raw
          UNION ALL SELECT 'Currency', 'type', 0
          UNION ALL SELECT 'TransactionDate', 'required', count(*) FILTER (TransactionDate IS NULL) FROM raw
          UNION ALL SELECT 'TransactionDate', 'datetime_format', count(*) FILTER (TransactionDate = 'no date') FROM raw
          UNION ALL SELECT 'Score', 'type', 0""",
)
def q1(spark, sf):
    return quality.check_expected(raw_orders(spark, sf), EXPECTED)


@register(
    "Q2_row_status",
    RAW
    + f"""SELECT TransactionID,
                 concat_ws(',', CASE WHEN ({AMOUNT}) IS NULL THEN 'bad_amount' END,
                                CASE WHEN Status = 'failed' THEN 'status_failed' END,
                                CASE WHEN Currency IS NULL THEN 'no_currency' END) AS failed_rules,
                 CASE WHEN ({AMOUNT}) IS NULL THEN 'FAILED'
                      WHEN Status = 'failed' OR Currency IS NULL THEN 'PASSED_WITH_WARNINGS'
                      ELSE 'PASSED' END AS PreliminaryValidationStatus,
                 ({AMOUNT}) IS NULL AS set_aside
          FROM raw""",
)
def q2(spark, sf):
    tagged = quality.tag_rows(
        raw_orders(spark, sf),
        warnings={
            "status_failed": F.lower(text.strip(F.col("Status"))) == "failed",
            "no_currency": F.col("Currency").isNull(),
        },
        errors={"bad_amount": to_number(F.col("Amount")).isNull()},
    )
    good, bad = quality.split_quarantine(tagged)
    split = good.withColumn("set_aside", F.lit(False)).unionByName(bad.withColumn("set_aside", F.lit(True)))
    return split.select(
        "TransactionID",
        "set_aside",
        F.concat_ws(",", "failed_rules").alias("failed_rules"),
        "PreliminaryValidationStatus",
    )


@register(
    "Q3_lost_values",
    RAW
    + f"""SELECT 'Amount' AS column_name, count(Amount) AS present, count(Amount) - count({AMOUNT}) AS lost FROM raw
          UNION ALL SELECT 'TransactionDate', count(TransactionDate),
                           count(*) FILTER (TransactionDate = 'no date') FROM raw""",
)
def q3(spark, sf):
    amount, date = F.col("Amount"), F.col("TransactionDate")
    return quality.lost_values(
        raw_orders(spark, sf),
        {"Amount": (amount, to_number(amount)), "TransactionDate": (date, to_timestamp(date))},
    )
