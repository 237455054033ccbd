"""Reading only what is new: stored high marks and look-back windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ledgerloom.functions.columns import column
from ledgerloom.operators.joins import lookup_join
from ledgerloom.session import written_table
from ledgerloom.sinks.store import publish_increment

# ``kind`` is the type of the mark. ``staged`` and ``target`` name files that were
# noted with the mark and are to be moved; a row with ``done`` says they were.
STATE_SCHEMA = (
    "name string, high_mark string, rows long, run_id string, loaded_at timestamp, "
    "kind string, staged string, target string, done boolean"
)


def _state(spark: SparkSession, state_path: str, name: str) -> DataFrame:
    # An empty state folder is laid out on first use.
    spark.createDataFrame([], STATE_SCHEMA).write.mode("ignore").parquet(state_path)
    return spark.read.schema(STATE_SCHEMA).parquet(state_path).where(F.col("name") == name)


def read_high_mark(spark: SparkSession, state_path: str, name: str) -> str | None:
    """Highest mark stored for a load, as text; None before its first run.

    The greatest by its own type counts, whenever it was stored; rows without a
    mark say nothing. Times with a zone carry their offset in the text.
    """
    state = _state(spark, state_path, name).where(F.col("high_mark").isNotNull())
    kinds = [r["kind"] for r in state.select("kind").distinct().collect()]
    if not kinds:
        return None
    if len(kinds) > 1 or kinds[0] is None:
        # Marks of several types, or without one, cannot be compared.
        return state.agg(F.max_by("high_mark", "loaded_at")).first()[0]
    return state.agg(F.max_by("high_mark", F.col("high_mark").cast(kinds[0]))).first()[0]


def done_runs(spark: SparkSession, state_path: str, name: str) -> DataFrame:
    """``run_id`` of the runs of a load that stored their mark."""
    return _state(spark, state_path, name).where(F.col("high_mark").isNotNull()).select("run_id").distinct()


def finish_pending(spark: SparkSession, state_path: str, name: str) -> None:
    """Move the files of runs that stored their mark but did not get further."""
    state = _state(spark, state_path, name).where(F.col("staged").isNotNull())
    open_ = state.groupBy("staged", "target").agg(F.bool_or(F.coalesce("done", F.lit(False))).alias("done")).where("NOT done")
    for row in open_.collect():
        publish_increment(spark, row["staged"], row["target"])
        _append(spark, state_path, [(name, None, None, None, None, row["staged"], row["target"], True)])


def _append(spark: SparkSession, state_path: str, rows: list[tuple]) -> None:
    schema = "name string, high_mark string, rows long, run_id string, kind string, staged string, target string, done boolean"
    stamped = spark.createDataFrame(rows, schema).withColumn("loaded_at", F.current_timestamp())
    stamped.coalesce(1).write.mode("append").parquet(state_path)


def since_mark(df: DataFrame, watermark_column: str, high_mark) -> DataFrame:
    """Rows strictly above the mark; all rows if there is none. The filter reaches the scan."""
    if high_mark is None:
        return df
    kind = df.schema[watermark_column].dataType
    return df.where(column(watermark_column) > F.lit(high_mark).cast(kind))


# Where the rows at a mark are remembered, below the state folder; readers of the state pass over it.
TIES = "_ties"
TIE_SCHEMA = "name string, high_mark string, run_id string, t0 long, t1 long"


def _row_hash(df: DataFrame, keys: list[str] | None) -> dict[str, Column]:
    """Two hashes that tell rows apart by their key columns, or by all."""
    values = [column(k).cast("string") if isinstance(df.schema[k].dataType, T.MapType) else column(k) for k in keys or df.columns]
    return {"t0": F.xxhash64(F.lit(0), *values), "t1": F.xxhash64(F.lit(1), *values)}


def since_mark_or_tied(
    df: DataFrame, watermark_column: str, state_path: str, name: str, keys: list[str] | None = None
) -> DataFrame:
    """Rows above the stored mark, and rows at the mark that no earlier run has loaded.

    Rows that were loaded at the mark are known by hashes of ``keys`` (all
    columns without it), so of rows equal in these one counts. They are looked
    up, however many share the mark; rows above it are not touched by that.
    """
    spark = df.sparkSession
    mark = read_high_mark(spark, state_path, name)
    if mark is None:
        return df
    at = F.lit(mark).cast(df.schema[watermark_column].dataType)
    runs_at = _state(spark, state_path, name).where(F.col("high_mark") == mark).select("run_id").distinct()
    spark.createDataFrame([], TIE_SCHEMA).write.mode("ignore").parquet(f"{state_path}/{TIES}")
    known = spark.read.schema(TIE_SCHEMA).parquet(f"{state_path}/{TIES}").where((F.col("name") == name) & (F.col("high_mark") == mark))
    # A run that noted its rows but never stored its mark does not count.
    known = written_table(known.join(runs_at, "run_id", "left_semi").select("t0", "t1").distinct(), "ties")
    tied = df.where(column(watermark_column) == at).withColumns(_row_hash(df, keys))
    late = lookup_join(tied, known, ["t0", "t1"], "left_anti").select(*[column(c) for c in df.columns])
    return df.where(column(watermark_column) > at).unionByName(late)


def note_ties(
    rows: DataFrame, watermark_column: str, high_mark: str, state_path: str, name: str, run_id: str, keys: list[str] | None = None
) -> None:
    """Remember the rows of a run that lie at its mark. Call it before the mark is stored."""
    at = F.lit(high_mark).cast(rows.schema[watermark_column].dataType)
    hashes = rows.where(column(watermark_column) == at).withColumns(_row_hash(rows, keys)).select("t0", "t1")
    noted = hashes.select(F.lit(name).alias("name"), F.lit(high_mark).alias("high_mark"), F.lit(run_id).alias("run_id"), "t0", "t1")
    noted.write.mode("append").parquet(f"{state_path}/{TIES}")


# Where the rows of all runs are remembered, below the state folder.
SEEN = "_seen"
SEEN_SCHEMA = "name string, run_id string, t0 long, t1 long"


def unseen(df: DataFrame, state_path: str, name: str, keys: list[str] | None = None) -> DataFrame:
    """Rows that no run which stored its mark has loaded, told apart by ``keys`` or all columns.

    Hashes of 128 bits are looked up. While those of the batch can be broadcast,
    the remembered ones that it does not hold leave in the scan, so that neither
    the batch is shuffled nor what was remembered; beyond, both sides are.
    """
    spark = df.sparkSession
    spark.createDataFrame([], SEEN_SCHEMA).write.mode("ignore").parquet(f"{state_path}/{SEEN}")
    known = spark.read.schema(SEEN_SCHEMA).parquet(f"{state_path}/{SEEN}").where(F.col("name") == name)
    done = done_runs(spark, state_path, name)
    hashed = df.withColumns(_row_hash(df, keys))
    own = written_table(hashed.select("t0", "t1").distinct(), "batch-hashes")
    known = lookup_join(known.join(done, "run_id", "left_semi"), own, ["t0", "t1"], "left_semi")
    known = written_table(known.select("t0", "t1").distinct(), "seen")
    return lookup_join(hashed, known, ["t0", "t1"], "left_anti").select(*[column(c) for c in df.columns])


def note_seen(rows: DataFrame, state_path: str, name: str, run_id: str, keys: list[str] | None = None) -> None:
    """Remember the rows of a run. Call it before its mark is stored; without the mark they do not count."""
    hashes = rows.withColumns(_row_hash(rows, keys)).select(F.lit(name).alias("name"), F.lit(run_id).alias("run_id"), "t0", "t1")
    hashes.write.mode("append").parquet(f"{state_path}/{SEEN}")


def look_back(df: DataFrame, column_name: str, as_of, days: int) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``, that day included; 0 days means all rows."""
    if days == 0:
        return df
    start = F.date_sub(F.lit(as_of).cast("date"), days)
    kind = df.schema[column_name].dataType
    return df.where(column(column_name) >= start.cast(kind))


def mark_text(mark: Column, kind: T.DataType) -> Column:
    """A mark as text that means the same in every session."""
    if isinstance(kind, T.TimestampType):
        return F.date_format(mark, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return mark.cast("string")


class MarkedBatch:
    """A batch that notes its own row count and high mark while it is written.

    Rows without a value in the watermark column have no place in the order: they
    are left out, counted as ``unmarked``, and would never be found again by a mark.
    """

    def __init__(self, df: DataFrame, watermark_column: str):
        self._seen, self._unmarked = Observation(), Observation()
        self._kind = df.schema[watermark_column].dataType
        mark = column(watermark_column)
        self.df = (
            df.observe(self._unmarked, F.count(F.when(mark.isNull(), 1)).alias("rows"))
            .where(mark.isNotNull())
            .observe(self._seen, mark_text(F.max(mark), self._kind).alias("high_mark"), F.count(F.lit(1)).alias("rows"))
        )

    @property
    def high_mark(self) -> str | None:
        return self._seen.get["high_mark"]

    @property
    def rows(self) -> int:
        return self._seen.get["rows"]

    @property
    def unmarked(self) -> int:
        return self._unmarked.get["rows"]

    def commit(
        self, spark: SparkSession, state_path: str, name: str, run_id: str, staged: str | None = None, target: str | None = None
    ) -> None:
        """Store the mark. Call it after the write succeeded; an empty batch stores nothing.

        With ``staged`` the files there belong to the mark, and ``finish_pending``
        moves them to ``target``.
        """
        if not self.rows:
            return
        row = (name, self.high_mark, self.rows, run_id, self._kind.simpleString(), staged, target, False)
        _append(spark, state_path, [row])
