"""Catalog tables: load, replace, update, upsert, and JDBC targets."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ledgerloom.functions.columns import column
from ledgerloom.operators.dedup import drop_duplicates
from ledgerloom.operators.joins import lookup_join
from ledgerloom.session import written_table
from ledgerloom.sinks.store import (  # noqa: F401
    discard_increment,
    drop_table,
    files_with,
    increment_path,
    located,
    place_of,
    publish_snapshot,
    refreshed,
    rewrite,
    rewrite_files,
    rows_of,
)
from ledgerloom.sources.incremental import (
    MarkedBatch,
    finish_pending,
    note_ties,
    read_high_mark,
    since_mark,
    since_mark_or_tied,
)

logger = logging.getLogger(__name__)

SAVE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def load_table(
    df: DataFrame,
    table: str,
    if_exists: str = "fail",
    path: str | None = None,
    file_format: str = "parquet",
    batch_size: int = 0,
) -> int:
    """Load rows into a table that may exist: fail, replace it, or append by column name.

    No rows is a success that changes nothing. ``batch_size`` bounds the rows
    per file. Returns the rows loaded, counted while they are written.
    """
    if if_exists not in SAVE_MODES:
        raise ValueError(f"if_exists must be one of {sorted(SAVE_MODES)}")
    # Appending no rows to a table that is there changes nothing anyway.
    harmless = if_exists == "append" and df.sparkSession.catalog.tableExists(table)
    if not harmless and df.isEmpty():
        logger.info("no rows for table %s", table)
        return 0
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode(SAVE_MODES[if_exists]).format(file_format)
    if batch_size:
        writer = writer.option("maxRecordsPerFile", batch_size)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return seen.get["rows"]


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def update_where(
    spark: SparkSession, table: str, assignments: dict[str, Column | str], condition: Column | str
) -> None:
    """``UPDATE table SET .. WHERE ..`` by rewrite: plain tables take no UPDATE.

    Of a partitioned table only the files that hold a matching row are written
    again; its partition columns take no new values. Without a matching row
    nothing is written. Writers at the same time take their turns.
    """
    test = F.expr(condition) if isinstance(condition, str) else condition
    partitions = _partition_columns(spark, table)
    moved = sorted(set(partitions) & set(assignments))
    if moved:
        raise ValueError(f"partition columns take no new values: {', '.join(moved)}")

    def whole(target: DataFrame) -> DataFrame | None:
        return None if target.where(test).isEmpty() else updated(target, assignments, condition)

    def some(target: DataFrame) -> tuple[DataFrame, list[str]] | None:
        files = files_with(located(target).where(test))
        return (updated(rows_of(target, files), assignments, condition).select(*_columns(target)), files) if files else None

    if partitions:
        rewrite_files(spark, table, None, some)
    else:
        rewrite(spark, table, whole)


def _columns(df: DataFrame) -> list[Column]:
    return [column(c) for c in df.columns]


def updated(df: DataFrame, assignments: dict[str, Column | str], condition: Column | str) -> DataFrame:
    """Rows with new values where the condition holds; all right-hand sides see the old values."""
    test = F.expr(condition) if isinstance(condition, str) else condition
    new = {}
    for name, value in assignments.items():
        value = F.expr(value) if isinstance(value, str) else value
        new[name] = F.when(test, value.cast(df.schema[name].dataType)).otherwise(column(name))
    return df.withColumns(new)


def run_statements(spark: SparkSession, statements: list[str]) -> None:
    """Run SQL before or after a load: TRUNCATE TABLE, ANALYZE TABLE, INSERT and the like."""
    for statement in statements:
        spark.sql(statement)


def truncate(spark: SparkSession, table: str) -> None:
    """Empty a table, its partitions among it, also where its files lie outside the catalog's folders."""
    if spark.catalog.getTable(table).tableType != "EXTERNAL":
        run_statements(spark, [f"TRUNCATE TABLE {table}"])
        return
    if not _partition_columns(spark, table):
        publish_snapshot(spark.read.table(table).limit(0), table)
        return
    rewrite_files(spark, table, None, lambda target: (target.limit(0), files_with(located(target))))


def analyze(spark: SparkSession, table: str, columns: list[str] | None = None) -> None:
    """Gather the statistics the planner uses for its join choices."""
    suffix = f" FOR COLUMNS {', '.join(columns)}" if columns else ""
    run_statements(spark, [f"ANALYZE TABLE {table} COMPUTE STATISTICS{suffix}"])


def _any_null(keys: list[str]) -> Column:
    test = F.lit(False)
    for k in keys:
        test = test | column(k).isNull()
    return test


def last_rows(source: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """The last row of each key, and every row with a null key."""
    null_key = _any_null(keys)
    last = drop_duplicates(source.where(~null_key), keys, "last", order_by)
    return last.unionByName(source.where(null_key))


def upserted(
    target: DataFrame, source: DataFrame, keys: list[str], order_by: list[str] | None = None
) -> DataFrame:
    """Target rows whose key the source does not hold, and the last source row of each key.

    The deduplicated source is written once: its true size then decides whether
    its keys are broadcast, which leaves the target unshuffled. A null key never
    matches, as in SQL.
    """
    fresh = written_table(last_rows(source, keys, order_by).select(*_columns(target)), "upsert-source")
    return _merged(target, fresh, keys)


def _merged(target: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key ``fresh`` does not hold, and all its rows."""
    held = _keys_of(fresh, keys)
    return lookup_join(target, held, keys, "left_anti").select(*_columns(target)).unionByName(fresh)


def _keys_of(fresh: DataFrame, keys: list[str]) -> DataFrame:
    return fresh.where(~_any_null(keys)).select(*[column(k) for k in keys])


def upsert_table(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: list[str],
    order_by: list[str] | None = None,
    partitions_follow_keys: bool = False,
    path: str | None = None,
    owner: str | None = None,
    batch: tuple[str, int] | None = None,
) -> bool:
    """Insert new keys and replace known ones. Returns whether the table was written.

    A plain table is rewritten into a new snapshot. Of a partitioned table only
    the files that hold a key of the source are written again. They are found by
    the key columns of the whole table, as a key may have moved to another
    partition; where ``partitions_follow_keys`` says that it never does, only the
    partitions of the source are looked at, and writers of other partitions go on
    at the same time. The source is read once: its last rows are written, and
    everything else is taken from there.

    ``batch`` (name, number) is stored with the rows; a batch stored before is
    not loaded again, whatever its keys. Open claims of the same ``owner``, a run
    that died, are taken over.
    """
    if not spark.catalog.tableExists(table):
        if source.isEmpty():
            return False
        writer = source.limit(0).write.mode("ignore").format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(table)
    fields = spark.read.table(table).schema.fields
    last = last_rows(source, keys, order_by).select(*[column(f.name).cast(f.dataType).alias(f.name) for f in fields])
    fresh = written_table(last, "upsert-source")
    if fresh.isEmpty():
        return False
    partitions = _partition_columns(spark, table)
    if not partitions:
        return rewrite(spark, table, lambda target: _merged(target, fresh, keys), owner, batch)

    def some(target: DataFrame) -> tuple[DataFrame, list[str]]:
        scope = touched_partitions(target, fresh, partitions) if partitions_follow_keys else target
        held = _keys_of(fresh, keys)
        files = files_with(lookup_join(located(scope), held, keys, "left_semi"))
        return _merged(rows_of(target, files), fresh, keys).select(*_columns(target)), files

    claimed = None
    if partitions_follow_keys:
        named = fresh.select(F.to_json(F.struct(*[column(p).cast("string").alias(p) for p in partitions])).alias("p")).distinct()
        claimed = [r["p"] for r in named.collect()]
    return rewrite_files(spark, table, claimed, some, owner, batch)


def touched_partitions(target: DataFrame, rows: DataFrame, partitions: list[str]) -> DataFrame | None:
    """Target rows in the partitions that occur in ``rows``, None if there are no rows.

    The partition values, one row per partition folder, become a filter that
    takes NULL as a value like any other; the scan skips all other folders
    however many there are.
    """
    found = rows.select(*[column(p) for p in partitions]).distinct().collect()
    return target.where(_one_of([tuple(r) for r in found], partitions)) if found else None


def _one_of(values: list[tuple], names: list[str]) -> Column:
    """True for rows whose columns ``names`` hold one of the tuples; NULL equals NULL."""
    first, rest = column(names[0]), names[1:]
    if not rest:
        known = [v for (v,) in values if v is not None]
        tests = [first.isin(known)] if known else []
        if len(known) < len(values):
            tests.append(first.isNull())
        return F.coalesce(_any(tests), F.lit(False))
    groups: dict = {}
    for value in values:
        groups.setdefault(value[0], []).append(value[1:])
    return _any([first.eqNullSafe(F.lit(v)) & _one_of(below, rest) for v, below in groups.items()])


def _any(tests: list[Column]) -> Column:
    """Their disjunction as a balanced tree, so that many of them nest shallowly."""
    while len(tests) > 1:
        tests = [tests[i] | tests[i + 1] if i + 1 < len(tests) else tests[i] for i in range(0, len(tests), 2)]
    return tests[0]


def load_increment(
    df: DataFrame,
    table: str,
    watermark_column: str,
    state_path: str,
    name: str,
    run_id: str,
    path: str | None = None,
    late_ties: bool = False,
    tie_keys: list[str] | None = None,
) -> int:
    """Append the rows above the stored mark and store the new one. Returns the rows loaded.

    A run that fails is simply repeated, whatever step it failed in. The rows go
    to a folder that readers of the table pass over; then the mark, taken from
    these very rows, is stored together with that folder; then its files are
    moved into the table. A run that finds a folder noted but not moved begins
    by moving it. Rows without a mark are left out and logged. With ``late_ties``
    rows equal to the mark that land after it was stored are loaded too, each
    once, told apart by ``tie_keys`` or else by all columns; run ids must differ.
    """
    spark = df.sparkSession
    finish_pending(spark, state_path, name)
    if late_ties:
        new = since_mark_or_tied(df, watermark_column, state_path, name, tie_keys)
    else:
        new = since_mark(df, watermark_column, read_high_mark(spark, state_path, name))
    batch = MarkedBatch(new, watermark_column)
    if not spark.catalog.tableExists(table):
        writer = df.limit(0).write.format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(table)
    place = place_of(spark, table)
    if place.partitions:
        raise ValueError(f"table {table} is partitioned; increments are moved into plain tables only")
    staged = increment_path(place.location)
    target = spark.read.table(table)
    batch.df.select(*_columns(target)).write.format(place.provider).options(**place.options).save(staged)
    if batch.unmarked:
        logger.warning("%s rows without a value in %s were left out", batch.unmarked, watermark_column)
    if not batch.rows:
        discard_increment(spark, staged)
        spark.catalog.refreshTable(table)
        return 0
    if late_ties:
        # Read back from what was written: the source may have grown meanwhile.
        held = spark.read.format(place.provider).options(**place.options).schema(target.schema).load(staged)
        note_ties(held, watermark_column, batch.high_mark, state_path, name, run_id, tie_keys)
    batch.commit(spark, state_path, name, run_id, staged, place.location)
    finish_pending(spark, state_path, name)
    refreshed(spark, table, place.analyzed)
    return batch.rows


def jdbc_writer_options(
    url: str,
    table: str,
    batch_size: int = 1_000,
    num_partitions: int | None = None,
    truncate_on_replace: bool = False,
    column_types: str | None = None,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Writer options: rows per insert batch, parallel connections, column types."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size), **(properties or {})}
    if num_partitions:
        options["numPartitions"] = str(num_partitions)
    if truncate_on_replace:
        options["truncate"] = "true"
    if column_types:
        options["createTableColumnTypes"] = column_types
    return options


def load_jdbc(df: DataFrame, url: str, table: str, if_exists: str = "fail", **options) -> bool:
    """Load rows into a database table in batches. No rows is a success that changes nothing."""
    if if_exists not in SAVE_MODES:
        raise ValueError(f"if_exists must be one of {sorted(SAVE_MODES)}")
    if df.isEmpty():
        return False
    df.write.format("jdbc").mode(SAVE_MODES[if_exists]).options(
        **jdbc_writer_options(url, table, **options)
    ).save()
    return True
