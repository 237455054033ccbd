"""Value mapping, tagging and business columns on whole tables."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ledgerloom.functions import business, mapping as maps, parsing, text
from ledgerloom.functions.columns import column
from ledgerloom.operators.joins import lookup_join
from ledgerloom.session import written_table

logger = logging.getLogger(__name__)


def clean_text_column(
    df: DataFrame,
    column_name: str,
    strip_whitespace: bool = True,
    to_case: str | None = None,
    remove_chars: str | None = None,
) -> DataFrame:
    """Clean one column; other types are turned into text first, absent columns skipped."""
    if column_name not in df.columns:
        logger.warning("column %s not found, not cleaned", column_name)
        return df
    if to_case and to_case not in text.CASES:
        logger.warning("unknown case %r, case left as it is", to_case)
    value = parsing.to_text(column(column_name), df.schema[column_name].dataType)
    return df.withColumn(column_name, text.clean_text(value, strip_whitespace, to_case, remove_chars))


def strip_text_columns(df: DataFrame) -> DataFrame:
    """Strip every text column in one projection."""
    new = {f.name: text.strip(column(f.name)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns(new) if new else df


def normalize_text_fields(df: DataFrame, names: list[str]) -> DataFrame:
    """Strip and lower-case the listed text columns."""
    new = {c: F.lower(text.strip(column(c).cast("string"))) for c in names if c in df.columns}
    return df.withColumns(new) if new else df


def map_values(
    df: DataFrame, column_name: str, mapping: dict | DataFrame, default_value=None
) -> DataFrame:
    """Replace values by dictionary; unmapped ones are kept, or take the default.

    A mapping may also be a frame of two columns, key and value, with unique
    keys. Short dictionaries become a literal map, longer ones a join, to the
    same result: where values and what unmapped rows keep differ in type, the
    column turns to text. Keys of another kind than the column never match.
    """
    if column_name not in df.columns:
        logger.warning("column %s not found, not mapped", column_name)
        return df
    c, kind = column(column_name), df.schema[column_name].dataType
    if isinstance(mapping, dict):
        if len(mapping) <= maps.LITERAL_MAP_LIMIT:
            return df.withColumn(column_name, maps.map_value(c, mapping, default_value, kind))
        entries, target = maps.typed_pairs(mapping, kind, default_value)
        plain = [(float(k) if isinstance(kind, (T.DoubleType, T.FloatType)) else k, v) for k, v in entries]
        schema = T.StructType([T.StructField("__key", kind), T.StructField("__value", target)])
        pairs = df.sparkSession.createDataFrame(plain, schema)
    else:
        pairs = mapping.toDF("__key", "__value").where("__key is not null and __value is not null")
        value = pairs.schema["__value"].dataType
        kept = kind if default_value is None else maps._type_of(default_value)
        target = maps.common_type([kept, value])
        if target != value:
            text_of = parsing.to_text(F.col("__value"), value)
            new = text_of if isinstance(target, T.StringType) else F.col("__value").cast(target)
            pairs = pairs.withColumn("__value", new)
        # Written once: it is counted, measured and joined.
        pairs = written_table(pairs, "mapping")
        if not pairs.groupBy("__key").count().where("count > 1").isEmpty():
            raise ValueError("the mapping holds a key more than once")
    joined = lookup_join(df.withColumn("__key", c.cast(pairs.schema["__key"].dataType)), pairs, ["__key"])
    rest = maps.fallback(c, kind, target, default_value)
    return joined.withColumn(column_name, F.coalesce(F.col("__value"), rest)).select(*[column(n) for n in df.columns])


def standardize_categories(
    df: DataFrame, category_column: str, mapping: dict | None = None, to_case: str | None = "upper"
) -> DataFrame:
    """Strip, map exactly, then set the case of a category column."""
    if category_column not in df.columns:
        logger.error("category column %s not found", category_column)
        return df
    if mapping and len(mapping) > maps.LITERAL_MAP_LIMIT:
        stripped = df.withColumn(category_column, text.strip(column(category_column)))
        out = map_values(stripped, category_column, mapping)
        return out.withColumn(category_column, text.to_case(column(category_column), to_case))
    return df.withColumn(category_column, maps.standard_category(column(category_column), mapping, to_case))


def tag_descriptions(
    df: DataFrame,
    description_column: str,
    category_map: dict[str, list[str]],
    new_column: str = "DerivedCategory",
    default_category: str = "OTHER",
) -> DataFrame:
    """Add the tag of the last keyword rule that matches the description."""
    if description_column not in df.columns:
        logger.error("description column %s not found", description_column)
        return df
    tag = maps.keyword_tag(column(description_column).cast("string"), category_map, default_category)
    return df.withColumn(new_column, tag)


def normalize_currency(
    df: DataFrame,
    amount_column: str,
    currency_column: str,
    target_currency: str = "USD",
    exchange_rates: dict[str, float] | DataFrame | None = None,
    normalized_column: str = "NormalizedAmountUSD",
    international_column: str | None = "IsInternational",
    rate_missing_column: str | None = None,
) -> DataFrame:
    """Amounts in one currency, with an optional flag for foreign ones.

    The amount column itself becomes numeric. Rates come as a dictionary by
    code, or as a frame of code and rate.
    """
    if amount_column not in df.columns or currency_column not in df.columns:
        logger.error("amount or currency column not found: %s, %s", amount_column, currency_column)
        return df
    data_type = df.schema[amount_column].dataType
    amount = parsing.convert(column(amount_column), data_type, T.DoubleType())
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        amount = parsing.null_if_nan(column(amount_column)).cast("double")
    out = df.withColumn(amount_column, amount)
    currency = column(currency_column)
    rate_table = exchange_rates
    if isinstance(rate_table, dict) and len(rate_table) > maps.LITERAL_MAP_LIMIT:
        rates = business.rate_table(rate_table, target_currency)
        rate_table = df.sparkSession.createDataFrame(list(rates.items()), "code string, rate double")
    if isinstance(rate_table, DataFrame):
        target = target_currency.upper()
        rates = rate_table.toDF("code", "rate").select(
            F.upper("code").alias("__code"), F.col("rate").cast("double").alias("__rate")
        ).where(F.col("__code") != target)
        # Written once: it is counted, measured and joined.
        rates = written_table(rates, "rates")
        if not rates.groupBy("__code").count().where("count > 1").limit(1).isEmpty():
            raise ValueError("the rates hold a currency more than once")
        out = lookup_join(out.withColumn("__code", F.upper(currency)), rates, ["__code"])
        value = F.coalesce(column(amount_column) * F.col("__rate"), column(amount_column))
        lacking = F.col("__rate").isNull() & ~F.coalesce(F.upper(currency) == target, F.lit(False))
    else:
        value = business.normal_amount(column(amount_column), currency, rate_table, target_currency)
        lacking = business.rate_missing(currency, rate_table, target_currency)
    new = {normalized_column: value}
    if international_column:
        new[international_column] = business.is_international(currency, target_currency)
    if rate_missing_column:
        new[rate_missing_column] = lacking
    return out.withColumns(new).drop("__code", "__rate")


def normalize_currency_dated(
    df: DataFrame,
    amount_column: str,
    currency_column: str,
    date_column: str,
    rates: DataFrame,
    target_currency: str = "USD",
    normalized_column: str = "NormalizedAmountUSD",
    rate_missing_column: str | None = None,
    bucket: str = "month",
) -> DataFrame:
    """Amounts in one currency by the rate that held on the row's date.

    ``rates`` holds code, first date and rate; the last rate at or before the
    row's date counts. Before a currency's first rate, without a date or with an
    unknown currency the amount is kept, with an optional flag.

    No range is joined: rates are laid out by currency and ``bucket`` (a unit of
    ``date_trunc``), each with its own rates in order and the one carried in, so
    rows look one entry up by an equal key. A currency with a third of all rows
    spreads over its buckets, and if the rates are too many to broadcast the
    adaptive planner may split each of them, as entries are unique. Choose the
    bucket so that it holds some dozens of rates.
    """
    data_type = df.schema[amount_column].dataType
    amount = parsing.null_if_nan(parsing.convert(column(amount_column), data_type, T.DoubleType()))
    target, at = target_currency.upper(), column(date_column).cast("timestamp_ntz")
    known = rates.toDF("code", "at", "rate").select(
        F.upper("code").alias("__code"), F.col("at").cast("timestamp_ntz").alias("at"), F.col("rate").cast("double").alias("rate")
    )
    known = written_table(known.dropna().where(F.col("__code") != target), "dated-rates")
    if not known.groupBy("__code", "at").count().where("count > 1").limit(1).isEmpty():
        raise ValueError("the rates hold a currency and date more than once")
    unit = lambda c: F.date_trunc(bucket, c).cast("timestamp_ntz")
    steps = known.groupBy("__code", unit(F.col("at")).alias("__bucket")).agg(F.sort_array(F.collect_list(F.struct("at", "rate"))).alias("__steps"))
    last = df.agg(F.max(at).alias("last")).first()["last"]
    stride = {"quarter": "3 months"}.get(bucket, f"1 {bucket}")
    first = steps.groupBy("__code").agg(F.min("__bucket").alias("first"), F.max("__bucket").alias("end"))
    until = F.greatest("end", unit(F.lit(last).cast("timestamp_ntz"))) if last is not None else F.col("end")
    spans = first.select("__code", F.explode(F.sequence("first", until, F.expr(f"INTERVAL {stride}"))).alias("__bucket"))
    before = Window.partitionBy("__code").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    entries = spans.join(steps, ["__code", "__bucket"], "left").select(
        "__code", "__bucket", "__steps", F.last(F.try_element_at("__steps", F.lit(-1))["rate"], True).over(before).alias("__carried")
    )
    keyed = df.withColumns({amount_column: amount, "__code": F.upper(column(currency_column)), "__at": at, "__bucket": unit(at)})
    found = lookup_join(keyed, written_table(entries, "rate-entries"), ["__code", "__bucket"])
    here = F.filter("__steps", lambda s: s["at"] <= F.col("__at"))
    rate = F.coalesce(F.try_element_at(here, F.lit(-1))["rate"], F.col("__carried"))
    new = {normalized_column: F.coalesce(column(amount_column) * rate, column(amount_column))}
    if rate_missing_column:
        new[rate_missing_column] = rate.isNull() & ~F.coalesce(F.col("__code") == target, F.lit(False))
    return found.withColumns(new).drop("__code", "__at", "__bucket", "__steps", "__carried")


def add_threshold_flags(df: DataFrame, fields: list[dict]) -> DataFrame:
    """Flags ``{name, condition_column, condition_threshold}``: true above the threshold."""
    new = {
        f["name"]: business.is_high_value(column(f["condition_column"]), f["condition_threshold"])
        for f in fields
        if f["condition_column"] in df.columns
    }
    return df.withColumns(new) if new else df


def add_date_parts(df: DataFrame, date_column: str, prefix: str = "Transaction") -> DataFrame:
    """Add year, month, day and weekday name of a date column."""
    if date_column not in df.columns:
        return df
    return df.withColumns(business.date_parts(column(date_column), prefix))
