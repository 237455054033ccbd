"""File sinks. Each writes a folder of part files and creates missing parents."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.functions.columns import column

CODECS = ("snappy", "gzip", "brotli", "zstd", "lz4", "none")


# Reader options that take back what ``write_csv`` writes. The null value is a
# text no field holds, so that only an unquoted empty field reads as null.
CSV_READ = {
    "escape": '"',
    "nullValue": "\0",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

STAGED_CSV_ROWS = 50_000


def stage(df: DataFrame, path: str, staging_format: str = "parquet") -> DataFrame:
    """Write rows to a staging folder and go on from the written files.

    Staged CSV may hold line ends inside values: its files are read whole, and
    hold ``STAGED_CSV_ROWS`` rows at most.
    """
    from ledgerloom.sources.files import read_staged

    if staging_format == "parquet":
        df.write.mode("overwrite").parquet(path)
        return read_staged(df.sparkSession, path).select(*df.columns)
    if staging_format == "csv":
        write_csv(df, path, max_rows_per_file=STAGED_CSV_ROWS)
        return read_staged(df.sparkSession, path, "csv", schema=df.schema, multi_line=True, **CSV_READ)
    raise ValueError(f"unsupported staging format {staging_format!r}")


def write_csv(
    df: DataFrame,
    path: str,
    header: bool = True,
    sep: str = ",",
    encoding: str = "utf-8",
    mode: str = "overwrite",
    max_rows_per_file: int = 0,
    **options,
) -> None:
    """Delimited text. Times keep their microseconds, quotes are doubled."""
    df.write.mode(mode).options(
        header=header,
        sep=sep,
        encoding=encoding,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        maxRecordsPerFile=max_rows_per_file,
        timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        **options,
    ).csv(path)


# ISO text of times in JSON output.
ISO_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _epoch_times(df: DataFrame) -> DataFrame:
    """Times as milliseconds since 1970, times without a zone taken as UTC."""
    start = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    new = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            new[f.name] = F.unix_millis(column(f.name))
        elif isinstance(f.dataType, T.TimestampNTZType):
            new[f.name] = F.timestamp_diff("MILLISECOND", start, column(f.name))
    return df.withColumns(new) if new else df


def _with_dates(df: DataFrame, date_format: str) -> DataFrame:
    if date_format not in ("iso", "epoch"):
        raise ValueError("date_format must be 'iso' or 'epoch'")
    return _epoch_times(df) if date_format == "epoch" else df


def write_json_lines(df: DataFrame, path: str, date_format: str = "iso", mode: str = "overwrite") -> None:
    """One JSON object per line, absent values written as null."""
    _with_dates(df, date_format).write.mode(mode).options(ignoreNullFields=False, **ISO_TIMES).json(path)


def write_json_arrays(df: DataFrame, path: str, date_format: str = "iso", mode: str = "overwrite") -> None:
    """JSON array documents, one per part file.

    Objects are encoded by Spark; the tasks only add brackets and commas while
    batches stream through, so no task holds its rows at once and none move.
    """
    encoded = _with_dates(df, date_format).select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false", **ISO_TIMES}).alias("value")
    )

    # Defined here so that it travels to the tasks by itself: they need not be
    # able to import this package.
    def array_lines(batches):
        import pyarrow.compute as pc

        started = False
        for batch in batches:
            if not batch.num_rows:
                continue
            lines = pc.binary_join_element_wise(",", batch.column(0), "")
            if not started:
                first = pa.array(["[" + batch.column(0)[0].as_py()], lines.type)
                lines = pa.concat_arrays([first, lines[1:]])
                started = True
            yield pa.RecordBatch.from_arrays([lines], ["value"])
        if started:
            yield pa.RecordBatch.from_arrays([pa.array(["]"], pa.string())], ["value"])

    encoded.mapInArrow(array_lines, "value string").write.mode(mode).option("maxRecordsPerFile", 0).text(path)


def write_parquet(df: DataFrame, path: str, compression: str | None = "snappy", mode: str = "overwrite") -> None:
    """Parquet with a codec. ``brotli`` needs a codec library Spark does not bring along."""
    codec = compression or "none"
    if codec not in CODECS:
        raise ValueError(f"unknown codec {compression!r}")
    df.write.mode(mode).option("compression", codec).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: list[str],
    file_format: str = "parquet",
    compression: str | None = "snappy",
    mode: str = "overwrite",
) -> None:
    """Folders by partition value; ``overwrite`` replaces only the partitions present in ``df``.

    Rows are rebalanced by partition value first, so a partition gets few files,
    while the adaptive planner splits a value that holds very many rows.
    """
    writer = (
        df.hint("rebalance", *[column(p) for p in partition_by])
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
    )
    if file_format == "parquet":
        writer = writer.option("compression", compression or "none")
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(path)
