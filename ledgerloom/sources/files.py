"""File sources. Paths may name files, folders or globs on any file system Spark reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from ledgerloom.functions.columns import column

CORRUPT = "_corrupt_record"
FORMATS = ("csv", "json", "jsonl", "parquet", "orc", "xml")


def _struct(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    delimiter: str = ",",
    header: bool = True,
    encoding: str = "utf-8",
    on_malformed: str = "fail",
    multi_line: bool = False,
    **options,
) -> DataFrame:
    """Delimited text with a header row.

    Declare a schema for anything large: without one, types are inferred by a
    further pass over the files. A header that names other columns than the
    schema, or in another order, fails the job. Malformed rows ``fail`` the job
    or are dropped; ``read_csv_split`` sets them aside instead. ``multi_line``
    takes line ends inside quotes as part of the value; such a file does not
    split, so keep its size to what one task should read.
    """
    modes = {"fail": "FAILFAST", "drop": "DROPMALFORMED", "null": "PERMISSIVE"}
    reader = spark.read.options(
        sep=delimiter, header=header, encoding=encoding, mode=modes[on_malformed], multiLine=multi_line, **options
    )
    if schema is not None and header:
        reader = reader.option("enforceSchema", False)
    reader = reader.schema(_struct(schema)) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


@dataclass(frozen=True)
class SplitScan:
    good: DataFrame
    quarantine: DataFrame


def read_csv_split(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    delimiter: str = ",",
    header: bool = True,
    encoding: str = "utf-8",
    multi_line: bool = False,
    **options,
) -> SplitScan:
    """Well-formed rows with their types, and the raw text of malformed ones.

    A row is malformed if it has too many fields, or a value that does not fit
    its column.
    """
    declared = _struct(schema)
    full = T.StructType([*declared.fields, T.StructField(CORRUPT, T.StringType())])
    rows = (
        spark.read.schema(full)
        .options(sep=delimiter, header=header, encoding=encoding, mode="PERMISSIVE", columnPruning=False)
        .options(multiLine=multi_line, enforceSchema=not header)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .options(**options)
        .csv(path)
    )
    # Spark converts only the columns a query uses, and would let a bad value in
    # any other column pass. This test holds for every row and uses them all, so
    # the split is the same whatever is read from it.
    rows = rows.where(F.xxhash64(*declared.names).bitwiseAND(F.lit(1)) >= 0)
    bad = F.col(CORRUPT).isNotNull()
    source = F.col("_metadata.file_path").alias("source_file")
    return SplitScan(
        rows.where(~bad).drop(CORRUPT),
        rows.where(bad).select(F.col(CORRUPT).alias("raw_text"), source),
    )


NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType, T.BinaryType)


def _split(reader: DataFrameReader, path, schema: T.StructType, options: dict, variants: bool) -> SplitScan:
    """Rows that fit the schema, and the others as text.

    Plain values are read as they stand, as variants or as text, and cast here,
    so that a value that does not fit costs its row and not the document it
    stands in.
    """
    plain = [f for f in schema if not isinstance(f.dataType, NESTED)]
    other = T.VariantType() if variants else T.StringType()
    kept = (*NESTED, T.StringType)
    loose = [f if isinstance(f.dataType, kept) else T.StructField(f.name, other) for f in schema]
    rows = reader.schema(T.StructType([*loose, T.StructField(CORRUPT, T.StringType())])).load(path)
    formats = {T.TimestampType: "timestampFormat", T.TimestampNTZType: "timestampNTZFormat", T.DateType: "dateFormat"}

    def typed(field: T.StructField) -> Column:
        given, kind = column(field.name), field.dataType
        if isinstance(kind, T.StringType):
            return given
        name = kind.simpleString()
        text = F.try_variant_get(given, "$", "string") if variants else given
        value = F.try_variant_get(given, "$", name) if variants else text.try_cast(kind)
        pattern = options.get(formats.get(type(kind)))
        if pattern:
            value = F.coalesce(value, F.try_to_timestamp(text, F.lit(pattern)).cast(kind))
        if isinstance(kind, T.IntegralType):
            value = F.coalesce(value, text.try_cast("decimal(38,6)").try_cast(kind))
        return value

    def given(field: T.StructField) -> Column:
        there = column(field.name).isNotNull()
        typeless = variants and not isinstance(field.dataType, T.StringType)
        return there & ~F.is_variant_null(column(field.name)) if typeless else there

    # Every column is looked at, so the split is the same whatever is read from it.
    looked_at = [typed(f) for f in plain]
    looked_at += [column(f.name) for f in schema if isinstance(f.dataType, (T.StructType, T.ArrayType, T.BinaryType))]
    bad = column(CORRUPT).isNotNull()
    if looked_at:
        bad = bad | (F.xxhash64(*looked_at).bitwiseAND(F.lit(1)) < 0)
    for field in plain:
        bad = bad | (given(field) & typed(field).isNull())
    out = [typed(f).alias(f.name) if f in plain else column(f.name) for f in schema]
    raw = F.coalesce(column(CORRUPT), F.to_json(F.struct(*[column(f.name) for f in loose])))
    return SplitScan(
        rows.where(~bad).select(*out),
        rows.where(bad).select(raw.alias("raw_text"), F.col("_metadata.file_path").alias("source_file")),
    )


def read_json_split(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, lines: bool = False, **options
) -> SplitScan:
    """Objects that fit the schema, and as text those that do not, with documents or ``lines`` that do not parse."""
    reader = spark.read.format("json").options(multiLine=not lines, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    # Variants, as Spark fetches numbers read as text from a document one by one.
    return _split(reader.options(**options), path, _struct(schema), options, True)


def read_json_documents(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """One JSON document per file: an array gives its objects as rows, an object one row.

    Files that hold anything else, or do not parse, give no rows, and neither do
    objects with a value that does not fit: ``read_json_split`` shows them. One
    file is one task's work, so spread large data over many files.
    """
    if schema is not None:
        return read_json_split(spark, path, schema, **options).good
    return spark.read.options(multiLine=True, mode="DROPMALFORMED", **options).json(path)


def read_json_lines(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """One JSON object per line; files split freely. Lines that do not parse or fit are left out, as above."""
    if schema is not None:
        return read_json_split(spark, path, schema, lines=True, **options).good
    return spark.read.options(mode="DROPMALFORMED", **options).json(path)


def read_xml_split(
    spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str, **options
) -> SplitScan:
    """Elements of the given tag that fit the schema, and as text those that do not."""
    reader = spark.read.format("xml").option("rowTag", row_tag).options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    return _split(reader.options(**options), path, _struct(schema), options, False)


def read_xml(
    spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """XML files, one row for each element of the given tag; elements that do not fit are left out, as above."""
    if schema is not None:
        return read_xml_split(spark, path, row_tag, schema, **options).good
    return spark.read.format("xml").option("rowTag", row_tag).options(**options).load(path)


def read_directory(
    spark: SparkSession,
    directory: str | list[str],
    file_format: str,
    pattern: str | None = None,
    schema: T.StructType | str | None = None,
    recursive: bool = True,
    **options,
) -> DataFrame:
    """All files of one format below a folder, or of those listed, whose names match a glob pattern."""
    if file_format not in FORMATS:
        raise ValueError(f"unsupported file format {file_format!r}")
    found = dict(options)
    if pattern:
        found["pathGlobFilter"] = pattern
    if recursive:
        found["recursiveFileLookup"] = True
    if file_format == "csv":
        return read_csv(spark, directory, schema, **found)
    if file_format == "json":
        return read_json_documents(spark, directory, schema, **found)
    if file_format == "jsonl":
        return read_json_lines(spark, directory, schema, **found)
    if file_format == "xml":
        return read_xml(spark, directory, found.pop("row_tag", "row"), schema, **found)
    reader = spark.read.options(**found)
    if schema is not None:
        reader = reader.schema(_struct(schema))
    return reader.format(file_format).load(directory)


def read_path(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Choose the reader by the file extension."""
    extension = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if extension not in FORMATS:
        raise ValueError(f"unsupported file type {extension!r}")
    return read_directory(spark, path, extension, None, schema, recursive=False, **options)


def read_staged(spark: SparkSession, path: str, staging_format: str = "parquet", **options) -> DataFrame:
    """Rows an earlier stage left as Parquet or CSV."""
    if staging_format == "parquet":
        return spark.read.options(**options).parquet(path)
    if staging_format == "csv":
        return read_csv(spark, path, **options)
    raise ValueError(f"unsupported staging format {staging_format!r}")
