"""Whole jobs: read, transform and load as one lazy plan."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerloom.functions import business, mapping, parsing, text
from ledgerloom.functions.columns import column
from ledgerloom.operators import convert, dedup, missing, quality, running, shape, values
from ledgerloom.session import written_table
from ledgerloom.sinks import files as file_sinks, journal, store, tables as table_sinks
from ledgerloom.sources import files, incremental, pages, tables


logger = logging.getLogger(__name__)


def parsed_date(c: Column, date_formats: str | list[str] | None = None) -> Column:
    """A date text by ISO, then by each strftime pattern in turn."""
    found = parsing.to_timestamp(c)
    return F.coalesce(found, parsing.to_timestamp(text.strip(c), date_formats)) if date_formats else found


def transform_records(
    df: DataFrame, drop: list[str] | None = None, date_formats: str | list[str] | None = None
) -> DataFrame:
    """Defaults, types, trimmed text, normal states and date parts for payment records.

    Each step applies only if its column is there. The merchant default is set
    before texts are stripped, so a blank merchant ends up empty. Dates are ISO,
    or of one of ``date_formats``; ``lost_in_transform`` counts those that are neither.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    new = {}
    for name, data_type in types.items():
        c = F.col(name)
        if name == "Merchant":
            c = F.coalesce(c, F.lit("Unknown"))
        if name == "Amount":
            amount = parsing.convert(c, data_type, T.DoubleType())
            new[name] = F.coalesce(parsing.null_if_nan(amount), F.lit(0.0))
        elif name == "Date" and isinstance(data_type, T.StringType):
            new[name] = parsed_date(c, date_formats)
        elif name == "Status" and isinstance(data_type, T.StringType):
            new[name] = mapping.normal_status(c)
        elif isinstance(data_type, T.StringType):
            new[name] = text.strip(c)
    out = df.withColumns(new) if new else df
    if "Date" in types:
        out = values.add_date_parts(out, "Date")
    return shape.drop_columns(out, drop or [])


def lost_in_transform(df: DataFrame, date_formats: str | list[str] | None = None) -> DataFrame:
    """Report of ``column_name, present, lost``: dates and amounts that are there and do not convert."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    found = {}
    if isinstance(kinds.get("Date"), T.StringType):
        found["Date"] = (F.col("Date"), parsed_date(F.col("Date"), date_formats))
    if "Amount" in kinds:
        found["Amount"] = (F.col("Amount"), parsing.convert(F.col("Amount"), kinds["Amount"], T.DoubleType()))
    return quality.lost_values(df, found)


def run_simple(spark: SparkSession, config: dict) -> DataFrame | None:
    """Read, stage, transform, load.

    Config: ``source_data {type, path, options}``, optional ``staging_area {path,
    format}``, ``transformations {drop_columns, rename_map, date_formats}``,
    ``report_path`` for the counts of values that did not convert, and
    ``target_database {target_table, load_method, path}``. ``options`` go to the
    reader: delimiter, encoding, quoting, ``multi_line``. Returns the
    transformed rows, or None if the source holds none.
    """
    source = config["source_data"]
    df = files.read_directory(
        spark,
        source["path"],
        source["type"],
        schema=source.get("schema"),
        recursive=False,
        **source.get("options", {}),
    )
    if df.isEmpty():
        return None
    staging = config.get("staging_area")
    if staging:
        df = file_sinks.stage(df, staging["path"], staging.get("format", "parquet"))
    steps = config.get("transformations", {})
    formats = steps.get("date_formats")
    if config.get("report_path"):
        lost_in_transform(df, formats).write.mode("overwrite").json(config["report_path"])
    out = transform_records(df, steps.get("drop_columns"), formats)
    out = shape.rename_columns(out, steps.get("rename_map", {}))
    target = config.get("target_database")
    if target:
        table_sinks.load_table(
            out, target["target_table"], target.get("load_method", "append"), target.get("path")
        )
    return out


# The rates the sample records imply.
SAMPLE_RATES = {"EUR": 1.09, "CAD": 0.75}


def processed_records(df: DataFrame, exchange_rates: dict[str, float] | None = None) -> DataFrame:
    """Input columns to processed columns in one projection; amounts are not rounded."""
    rates = SAMPLE_RATES if exchange_rates is None else exchange_rates
    amount = parsing.convert(F.col("Amount"), df.schema["Amount"].dataType, T.DoubleType())
    return df.select(
        "TransactionID",
        parsing.combine_timestamp(F.col("TransactionDate"), F.col("TransactionTime")).alias(
            "TransactionTimestamp"
        ),
        "AccountNumber",
        "TransactionType",
        amount.alias("OriginalAmount"),
        F.col("Currency").alias("OriginalCurrency"),
        business.normal_amount(amount, F.col("Currency"), rates).alias("NormalizedAmountUSD"),
        "Description",
        mapping.standard_category(F.col("Category")).alias("StandardizedCategory"),
        F.col("Status").alias("StandardizedStatus"),
        business.is_international(F.col("Currency")).alias("IsInternational"),
    )


def staged_records(df: DataFrame) -> DataFrame:
    """Input columns to staging columns: raw timestamp text and a preliminary status."""
    staged = df.select(
        "TransactionID",
        business.raw_timestamp_text(F.col("TransactionDate"), F.col("TransactionTime")).alias(
            "RawTransactionTimestamp"
        ),
        *[c for c in df.columns if c not in ("TransactionID", "TransactionDate", "TransactionTime")],
    )
    return quality.tag_rows(
        staged, {"status_failed": F.upper(text.strip(F.col("Status"))) == "FAILED"}
    ).drop("failed_rules")


def cleaned_records(
    df: DataFrame,
    target_schema: list[dict],
    fill_columns: list[str],
    fill_value: str = "UNKNOWN",
    exchange_rates: dict[str, float] | None = None,
) -> DataFrame:
    """Fill, convert, stamp, convert currencies and fit to the target schema."""
    out = missing.fill_constant(df, fill_value, fill_columns)
    out = convert.convert_types(out, {"Amount": "float64"})
    out = convert.create_timestamp(out, "TransactionDate", "TransactionTime")
    out = values.normalize_currency(
        out, "Amount", "Currency", exchange_rates=SAMPLE_RATES if exchange_rates is None else exchange_rates
    )
    return shape.conform(out, target_schema).df


def run_class_chain(
    df: DataFrame,
    table: str,
    target_schema: list[dict],
    fill_columns: list[str],
    post_load: list[tuple[dict, str]] | None = None,
    path: str | None = None,
) -> DataFrame:
    """``cleaned_records``, appended to a table, followed by updates ``(assignments, condition)``."""
    spark = df.sparkSession
    table_sinks.load_table(cleaned_records(df, target_schema, fill_columns), table, "append", path)
    for assignments, condition in post_load or []:
        table_sinks.update_where(spark, table, assignments, condition)
    return spark.read.table(table)


def configured_transform(df: DataFrame, transformation: dict, take: Callable | None = None) -> DataFrame:
    """Validation, cleaning rules and calculated fields of a ``transformation`` section.

    ``take`` gives the statistics that gaps are filled with, in place of those of ``df``.
    """
    validation = transformation.get("schema_validation", {})
    expected = validation.get("expected_columns", [])
    if validation.get("enabled") and validation.get("strict"):
        quality.require_expected(df, expected)
    out = df
    if validation.get("enabled"):
        formats = {d["name"]: d.get("datetime_format") for d in expected}
        out = convert.convert_types(
            out, {d["name"]: d["type"] for d in expected if not d.get("datetime_format")}
        )
        for name, pattern in formats.items():
            if pattern and name in out.columns:
                out = convert.parse_datetime(out, name, pattern, "coerce")
    rules = transformation.get("cleaning_rules", {})
    gaps = rules.get("handle_missing_values")
    if gaps:
        out = missing.apply_strategies(
            out, column_strategies(gaps.get("column_strategies", {})), gaps.get("default_strategy"), take
        )
    out = values.normalize_text_fields(out, rules.get("normalize_text_fields", []))
    if rules.get("remove_duplicates"):
        out = dedup.drop_duplicates(out)
    fields = transformation.get("business_logic", {}).get("add_calculated_fields", [])
    return values.add_threshold_flags(out, fields)


def column_strategies(declared: dict) -> dict:
    """Pair each ``fill_constant`` with the value declared under ``<column>_fill_value``."""
    suffix = "_fill_value"
    out = {}
    for name, strategy in declared.items():
        if name.endswith(suffix) and name[: -len(suffix)] in declared:
            continue
        out[name] = (strategy, declared.get(name + suffix)) if strategy == "fill_constant" else strategy
    return out


def read_configured(
    spark: SparkSession,
    extraction: dict,
    schema: T.StructType | str | None = None,
    names: list[str] | None = None,
) -> DataFrame:
    """The source an ``extraction`` section names: files, a table, or landed pages of an endpoint.

    Of a file source ``names`` may give the files to read, rather than all there are.
    A database source with a ``url`` is read over JDBC, one without from the
    catalog. An API source names the folder its pages landed in.
    """
    kind = extraction["source_type"]
    if kind == "file":
        source = extraction["file_source"]
        options = dict(source.get("csv_options", {})) if source["file_format"] == "csv" else {}
        where = names or source["input_directory"]
        return files.read_directory(spark, where, source["file_format"], source.get("file_pattern"), schema, **options)
    if kind == "database":
        source = extraction["database_source"]
        table = ".".join(source[k] for k in ("schema", "table_name") if source.get(k))
        if source.get("url"):
            return tables.read_jdbc(spark, source["url"], table, fetch_size=source.get("fetch_size", 10_000))
        return tables.read_table(spark, table)
    if kind == "api":
        source = extraction["api_source"]
        landed = spark.read.parquet(source["landed_directory"]).where(F.col("endpoint") == source["endpoint"])
        return pages.fetch_configured(landed, schema, source.get("pagination", {}), source.get("results_key"))
    raise ValueError(f"unknown source type {kind!r}")


# How a ``loading`` section may name the plain ways into a table.
APPENDS = ("append", "insert", "bulk")


def destination(loading: dict) -> dict:
    """The destination a ``loading`` section names, its keys in one place.

    The section is either flat, or nests ``database_destination`` and
    ``file_system_destination`` below a ``destination_type``.
    """
    kind = loading.get("destination_type")
    if kind is None:
        return loading
    if kind == "file_system":
        return {**loading.get("file_system_destination", {}), "load_method": "files"}
    if kind != "database":
        raise ValueError(f"unsupported destination type {kind!r}")
    found = dict(loading.get("database_destination", {}))
    if found.get("schema"):
        found["target_table"] = f"{found['schema']}.{found['target_table']}"
    return found


def _partitioned_files(out: DataFrame, loading: dict, path: str, mode: str) -> None:
    partitions = loading.get("partition_by", ["year", "month"])
    dated = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    derived = {c: dated[c](loading["date_column"]) for c in partitions if c in dated and c not in out.columns}
    file_sinks.write_partitioned(
        out.withColumns(derived) if derived else out,
        path,
        partitions,
        loading.get("file_format", "parquet"),
        loading.get("compression", "snappy"),
        mode=mode,
    )


def write_configured(
    out: DataFrame, loading: dict, owner: str | None = None, batch: tuple[str, int] | None = None
) -> tuple[str, str] | None:
    """Load rows as a ``loading`` section says: upsert, files, or a table load method.

    What would be doubled by a repeated run is written to a folder readers pass
    over, and its path is returned with the folder its files belong to;
    ``incremental.finish_pending`` moves them once the run's mark is stored. An
    upsert stores ``batch`` with its rows and leaves one out that it has.
    """
    spark = out.sparkSession
    loading = destination(loading)
    method = loading["load_method"]
    if method == "files":
        target = loading["output_directory"]
        staged = store.increment_path(target)
        _partitioned_files(out, loading, staged, "append")
        return staged, target
    table = loading["target_table"]
    if method == "upsert":
        table_sinks.upsert_table(
            spark,
            table,
            out,
            loading["conflict_target_columns"],
            loading.get("order_by"),
            loading.get("partitions_follow_keys", False),
            loading.get("path"),
            owner,
            batch,
        )
        return None
    if method not in APPENDS:
        table_sinks.load_table(out, table, method, loading.get("path"), batch_size=loading.get("batch_size") or 0)
        return None
    if not spark.catalog.tableExists(table):
        writer = out.limit(0).write.format("parquet")
        (writer.option("path", loading["path"]) if loading.get("path") else writer).saveAsTable(table)
    place = store.place_of(spark, table)
    if place.partitions:
        raise ValueError(f"table {table} is partitioned: load it by upsert")
    staged = store.increment_path(place.location)
    fitted = out.select(*[column(c) for c in spark.read.table(table).columns])
    writer = fitted.write.format(place.provider).options(**place.options)
    writer.option("maxRecordsPerFile", loading.get("batch_size") or 0).save(staged)
    return staged, place.location


@dataclass(frozen=True)
class RunState:
    """Where a configured run keeps its mark, and where it lands what it reads."""

    name: str
    column: str | None
    path: str
    staging: str


def run_state(config: dict) -> RunState:
    """The state a configuration names, in its own keys or those of the nested sections.

    Without ``use_watermarking``, or without a watermark column, runs have no
    mark and load all they read.
    """
    own = config["performance"]
    source = config.get("extraction", {}).get("database_source", {})
    wanted = own.get("use_watermarking", True)
    return RunState(
        own.get("watermark_name") or own.get("watermark_pipeline_name") or config.get("pipeline_name", "pipeline"),
        (own.get("watermark_column") or source.get("watermark_column")) if wanted else None,
        own.get("watermark_path") or own["watermark_file_path"],
        own.get("staging_path") or config["transformation"]["staging_directory"].rstrip("/"),
    )


def set_aside(df: DataFrame, transformation: dict, path: str) -> DataFrame:
    """Check expected columns; rows with values of the wrong type or format go to ``path``.

    The report of all rules goes to ``<path>/report``, the rows and the names of
    the rules they break to ``<path>/rows``. A missing required value is only
    counted: the cleaning rules say what becomes of it. Strict sections raise instead.
    """
    validation = transformation.get("schema_validation", {})
    expected = validation.get("expected_columns", [])
    if not validation.get("enabled") or validation.get("strict") or not expected:
        return df
    wrong = lambda rule: not rule.endswith(".required")
    return quality.write_checked(df, expected, f"{path}/report", f"{path}/rows", wrong)


# Where the statistics of all runs are kept, below the state folder; readers of the state pass over it.
STATISTICS = "_statistics"


def run_configured(df: DataFrame, config: dict, run_id: str, run: journal.Run | None = None) -> int:
    """One configured increment: rows above the stored mark, transformed and loaded.

    The ``performance`` section names the watermark column and the state folder.
    Rows that break the expected types, and rows without a mark, are set aside
    below the staging folder. A run that fails is repeated with the same outcome:
    appended files appear only once its mark is stored, or without a mark once
    the journal of ``run`` says where they are. Where the section says
    ``remember_rows``, a row loaded by an earlier run is left out, told by
    ``remember_keys`` or else by all columns of the transformed row. With
    ``running_statistics`` gaps are filled with the mean, median or mode over the
    rows of all runs so far. Both need a watermark and run ids that differ.
    Returns the rows read.
    """
    spark = df.sparkSession
    state = run_state(config)
    loading = config["loading"]
    runs_on = config["performance"].get("running_statistics")
    if runs_on and state.column is None:
        raise ValueError("running statistics need a watermark: it tells which runs are done")
    if state.column is None:
        landed = file_sinks.stage(df, f"{state.staging}/{run_id}")
        rows, batch = landed.count(), None
    else:
        incremental.finish_pending(spark, state.path, state.name)
        mark = incremental.read_high_mark(spark, state.path, state.name)
        batch = incremental.MarkedBatch(incremental.since_mark(df, state.column, mark), state.column)
        # The batch is written once as read: its mark and its rows then agree, and
        # the statistics of the cleaning rules do not read the source again.
        landed = file_sinks.stage(batch.df, f"{state.staging}/{run_id}")
        rows = batch.rows
        if batch.unmarked or (mark is not None and run is not None):
            unmarked = df.where(column(state.column).isNull())
            unmarked.write.mode("overwrite").parquet(f"{state.staging}/unmarked-{run_id}")
            logger.warning("rows without a value in %s went to %s/unmarked-%s", state.column, state.staging, run_id)
    if not rows:
        return 0
    table_sinks.run_statements(spark, destination(loading).get("pre_load_sql") or [])
    good = set_aside(landed, config["transformation"], f"{state.staging}/quarantine-{run_id}")
    name = f"run {state.name}"
    take = None
    if runs_on:
        done = incremental.done_runs(spark, state.path, state.name)
        take = running.Running(spark, f"{state.path}/{STATISTICS}/{quote(state.name, safe='')}", run_id, done).take
    out = configured_transform(good, config["transformation"], take)
    if batch is not None and config["performance"].get("remember_rows"):
        # Written once: what is loaded is what is remembered.
        keys = config["performance"].get("remember_keys")
        out = written_table(incremental.unseen(out, state.path, state.name, keys), "unseen")
        incremental.note_seen(out, state.path, state.name, run_id, keys)
    moves = write_configured(out, loading, name if run else None, (name, run.number) if run else None)
    if batch is not None:
        batch.commit(spark, state.path, state.name, run_id, *(moves or ()))
        incremental.finish_pending(spark, state.path, state.name)
    elif moves:
        if run:
            run.note("staged", staged=moves[0], target=moves[1])
        store.publish_increment(spark, *moves)
    _after_load(spark, loading, moves)
    return rows


def _after_load(spark: SparkSession, loading: dict, moves: tuple[str, str] | None) -> None:
    table = destination(loading).get("target_table")
    if moves and table:
        spark.catalog.refreshTable(table)
    table_sinks.run_statements(spark, destination(loading).get("post_load_sql") or [])


def run_pipeline(
    spark: SparkSession, config: dict, run_id: str, schema: T.StructType | str | None = None, as_of: str | None = None
) -> int:
    """A whole configuration: extraction, transformation, loading, and the archive of what was read.

    Files of a file source move to its ``processed_directory`` after the load,
    each run's into a folder of its own. What a run reads is noted before it
    loads; a run that stopped, at whatever step, is finished first, with the
    files it had. An API source with ``lookback_days`` and a ``date_column``
    takes the records of these days up to ``as_of``. Returns the rows read.
    """
    extraction = config["extraction"]
    source = extraction.get("file_source", {})
    if extraction["source_type"] == "file" and source.get("processed_directory"):
        state = run_state(config)
        folder = journal.journal_folder(state.path, state.name)
        for stopped in journal.unfinished(spark, folder):
            _run_files(stopped, config, schema)
        found = journal.files_in(spark, source["input_directory"], source.get("file_pattern"))
        return _run_files(journal.begin(spark, folder, run_id, found), config, schema) if found else 0
    df = read_configured(spark, extraction, schema)
    api = extraction.get("api_source", {})
    days = api.get("parameters", {}).get("lookback_days", 0)
    if extraction["source_type"] == "api" and days and api.get("date_column"):
        df = incremental.look_back(df, api["date_column"], as_of or dt.date.today().isoformat(), days)
    return run_configured(df, config, run_id)


def _run_files(run: journal.Run, config: dict, schema: T.StructType | str | None) -> int:
    """Load the files of a journalled run and archive them, from the step it got to."""
    spark, extraction = run.spark, config["extraction"]
    source, rows = extraction["file_source"], 0
    if run.facts("loaded") is None:
        moves = run.facts("staged")
        if moves is None:
            rows = run_configured(read_configured(spark, extraction, schema, run.files), config, run.label, run)
        else:
            store.publish_increment(spark, moves["staged"], moves["target"])
            _after_load(spark, config["loading"], (moves["staged"], moves["target"]))
        run.note("loaded", rows=rows)
    journal.archive(run, source["input_directory"], source["processed_directory"])
    return rows
