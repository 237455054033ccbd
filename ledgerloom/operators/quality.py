"""Checks of whole tables and of single rows, and metrics of runs."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import wraps

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ledgerloom.functions import parsing
from ledgerloom.functions.columns import column

PASSED, WARNED, FAILED = "PASSED", "PASSED_WITH_WARNINGS", "FAILED"


def expected_columns(schema: T.StructType | str) -> list[dict]:
    """Expected columns from a Spark schema or its JSON text; non-nullable fields are required."""
    struct = T.StructType.fromJson(json.loads(schema)) if isinstance(schema, str) else schema
    return [{"name": f.name, "type": f.dataType, "required": not f.nullable} for f in struct.fields]


def column_rules(df: DataFrame, expected: list[dict]) -> tuple[dict[str, Column], dict[str, int]]:
    """Violation tests per ``column.rule``, and the columns the table lacks (1) or has (0)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    tests, absent = {}, {}
    for d in expected:
        name = d["name"]
        absent[f"{name}.present"] = int(name not in types)
        if name not in types:
            continue
        c, target = column(name), parsing.spark_type(d["type"])
        given = parsing.null_if_nan(c, types[name])
        if d.get("required"):
            tests[f"{name}.required"] = given.isNull()
        if isinstance(types[name], T.StringType) and d.get("datetime_format"):
            parsed = parsing.to_timestamp(c, d["datetime_format"])
            tests[f"{name}.datetime_format"] = c.isNotNull() & parsed.isNull()
        else:
            tests[f"{name}.type"] = given.isNotNull() & parsing.convert(c, types[name], target).isNull()
    return tests, absent


REPORT_ENTRIES = "array<struct<column_name:string,rule:string,violations:bigint>>"


def check_expected(df: DataFrame, expected: list[dict]) -> DataFrame:
    """Report of ``column_name, rule, violations``: presence, required values, type, datetime format.

    One aggregate over the table counts every rule; the report stays lazy.
    """
    tests, absent = column_rules(df, expected)
    counted = _counts(tests)
    entries = [_entry(rule, F.lit(n).cast("long")) for rule, n in absent.items()]
    entries += [_entry(rule, F.col(f"c{i}")) for i, rule in enumerate(tests)]
    return df.agg(F.count(F.lit(1)).alias("rows"), *counted).select(
        F.inline(F.array(*entries).cast(REPORT_ENTRIES))
    )


def _counts(tests: dict[str, Column]) -> list[Column]:
    return [F.count_if(test).alias(f"c{i}") for i, test in enumerate(tests.values())]


def write_checked(
    df: DataFrame, expected: list[dict], report_path: str, rows_path: str, failing: Callable[[str], bool]
) -> DataFrame:
    """Write the report of ``check_expected`` and the rows that break a ``failing`` rule; the other rows are returned.

    One scan counts the rules and writes the rows, which carry the names of
    those they break as ``failed_rules``. Each test is worked out once a row.
    """
    tests, absent = column_rules(df, expected)
    held = {rule: f"__c{i}" for i, rule in enumerate(tests)}
    wrong = [rule for rule in tests if failing(rule)]
    if not wrong:
        check_expected(df, expected).write.mode("overwrite").json(report_path)
        df.limit(0).withColumn("failed_rules", F.array().cast("array<string>")).write.mode("overwrite").parquet(rows_path)
        return df
    tested = df.withColumns({held[rule]: test for rule, test in tests.items()})
    seen = Observation()
    tested = tested.observe(seen, *_counts({rule: F.col(name) for rule, name in held.items()}))
    names = F.array_compact(F.array(*[F.when(F.col(held[rule]), F.lit(rule)) for rule in wrong]))
    bad = tested.where(_any_of([F.col(held[rule]) for rule in wrong])).withColumn("failed_rules", names)
    bad.drop(*held.values()).write.mode("overwrite").parquet(rows_path)
    counts = seen.get
    rows = [(*rule.rsplit(".", 1), n) for rule, n in absent.items()]
    rows += [(*rule.rsplit(".", 1), counts[f"c{i}"]) for i, rule in enumerate(tests)]
    report = df.sparkSession.createDataFrame(rows, "column_name string, rule string, violations long")
    report.coalesce(1).write.mode("overwrite").json(report_path)
    return df.where(~_any_of([tests[rule] for rule in wrong]))


def _any_of(tests: list[Column]) -> Column:
    out = F.lit(False)
    for test in tests:
        out = out | test
    return out


def _entry(rule: str, violations: Column) -> Column:
    name, kind = rule.rsplit(".", 1)
    return F.struct(
        F.lit(name).alias("column_name"), F.lit(kind).alias("rule"), violations.alias("violations")
    )


class SchemaViolation(ValueError):
    """Raised when a checked table breaks its expected schema."""


def require_expected(df: DataFrame, expected: list[dict]) -> DataFrame:
    """Return the table, or raise if any rule counts a violation."""
    broken = check_expected(df, expected).where("violations > 0").collect()
    if broken:
        raise SchemaViolation(
            "; ".join(f"{r.column_name} {r.rule}: {r.violations}" for r in broken)
        )
    return df


def tag_rows(
    df: DataFrame,
    warnings: dict[str, Column],
    errors: dict[str, Column] | None = None,
    status_column: str = "PreliminaryValidationStatus",
    failed_column: str = "failed_rules",
) -> DataFrame:
    """Add the names of broken rules and a status. A rule is a test for what is wrong."""
    errors = errors or {}

    def broken(rules):
        named = [F.when(test, F.lit(name)) for name, test in rules.items()]
        return F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")

    tagged = df.withColumns({"__errors": broken(errors), "__warnings": broken(warnings)})
    status = (
        F.when(F.size("__errors") > 0, FAILED).when(F.size("__warnings") > 0, WARNED).otherwise(PASSED)
    )
    return tagged.withColumns(
        {failed_column: F.concat("__errors", "__warnings"), status_column: status}
    ).drop("__errors", "__warnings")


def split_quarantine(
    df: DataFrame, status_column: str = "PreliminaryValidationStatus"
) -> tuple[DataFrame, DataFrame]:
    """Rows to go on with, and failed rows to set aside."""
    failed = column(status_column) == FAILED
    return df.where(~failed), df.where(failed)


def lost_values(df: DataFrame, conversions: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Report of ``column_name, present, lost``: values that were there and became null."""
    counts = []
    for i, (old, new) in enumerate(conversions.values()):
        counts.append(F.count_if(old.isNotNull()).alias(f"p{i}"))
        counts.append(F.count_if(old.isNotNull() & new.isNull()).alias(f"l{i}"))
    entries = [
        F.struct(F.lit(name).alias("column_name"), F.col(f"p{i}").alias("present"), F.col(f"l{i}").alias("lost"))
        for i, name in enumerate(conversions)
    ]
    return df.agg(*counts).select(F.inline(F.array(*entries)))


METRICS_SCHEMA = (
    "run_id string, task string, status string, seconds double, records long, "
    "records_per_second double, tags map<string,string>, error string"
)


@dataclass
class RunMetrics:
    """Timings and row counts of the stages of one run.

    Row counts come from observations, so they cost no job of their own.
    """

    run_id: str
    tags: dict[str, str] = field(default_factory=dict)
    rows: list[tuple] = field(default_factory=list)

    @contextmanager
    def stage(self, task: str, **tags):
        """Time a stage. ``counted(df)`` on the yielded object makes it count the rows of ``df``."""
        stage = _Stage(task)
        start = time.perf_counter()
        try:
            yield stage
        except Exception as error:
            self._add(stage, "failed", time.perf_counter() - start, tags, str(error))
            raise
        self._add(stage, "succeeded", time.perf_counter() - start, tags, None)

    def timed(self, task: str | None = None, records_of=None):
        """Decorator form; ``records_of`` takes the result and returns its row count."""

        def wrap(function):
            @wraps(function)
            def run(*args, **kwargs):
                with self.stage(task or function.__name__) as stage:
                    result = function(*args, **kwargs)
                    if records_of is not None:
                        stage.set_records(records_of(result))
                    return result

            return run

        return wrap

    def _add(self, stage, status, seconds, tags, error):
        records = stage.records if status == "succeeded" else None
        rate = records / seconds if records is not None and seconds > 0 else None
        merged = {k: str(v) for k, v in {**self.tags, **tags}.items()}
        self.rows.append((self.run_id, stage.task, status, seconds, records, rate, merged, error))

    def add_batch(self, task: str, seconds: float, records: int, tags: dict) -> None:
        """Note one batch of a stream that succeeded, with the rows it read."""
        merged = {k: str(v) for k, v in {**self.tags, **tags}.items()}
        rate = records / seconds if seconds > 0 else None
        self.rows.append((self.run_id, task, "succeeded", seconds, records, rate, merged, None))

    def record(self, name: str, value, **tags) -> None:
        """Note one value under a name, as a row without timing."""
        merged = {k: str(v) for k, v in {**self.tags, **tags, "value": value}.items()}
        self.rows.append((self.run_id, name, "metric", None, None, None, merged, None))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, METRICS_SCHEMA)


class _Stage:
    def __init__(self, task: str):
        self.task = task
        self._seen: Observation | None = None
        self._counted: int | None = None

    def counted(self, df: DataFrame) -> DataFrame:
        self._seen = Observation()
        return df.observe(self._seen, F.count(F.lit(1)).alias("records"))

    def set_records(self, records: int) -> None:
        self._counted = records

    @property
    def records(self) -> int | None:
        if self._counted is not None:
            return self._counted
        return self._seen.get["records"] if self._seen is not None else None
