"""Where a table's files are, and publishing files in steps that can be repeated."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.functions.columns import column
from ledgerloom.sinks import commits
from ledgerloom.sinks.files_log import system_of as _system

# Folders whose names start so are passed over by readers.
SNAPSHOTS = "_snapshots"
INCREMENT = "_increment-"
MOVES_AT_ONCE = 16


@dataclass(frozen=True)
class Place:
    """Provider, folder and options of a catalog table."""

    provider: str
    location: str
    partitions: list[str] = field(default_factory=list)
    options: dict[str, str] = field(default_factory=dict)
    analyzed: bool = False

    @property
    def base(self) -> str:
        """The folder the table was made with; its snapshots lie below."""
        return self.location.split(f"/{SNAPSHOTS}/")[0]


def place_of(spark: SparkSession, table: str) -> Place:
    found = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])
    return Place(
        found.get("provider") or "parquet",
        found["location"].rstrip("/"),
        found.get("partition_columns") or [],
        {k: v for k, v in (found.get("storage_properties") or {}).items() if k not in ("path", "serialization.format")},
        "statistics" in found,
    )


def refreshed(spark: SparkSession, table: str, analyzed: bool) -> None:
    """Let the session see a table's new files, and renew its size where the planner goes by one."""
    spark.catalog.refreshTable(table)
    if analyzed:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS NOSCAN")


def publish_snapshot(df: DataFrame, table: str) -> None:
    """Put the rows of ``df`` in place of those of an unpartitioned table, which ``df`` may itself read."""
    rewrite(df.sparkSession, table, lambda target: df)


def rewrite(
    spark: SparkSession,
    table: str,
    build: Callable[[DataFrame], DataFrame | None],
    owner: str | None = None,
    batch: tuple[str, int] | None = None,
) -> bool:
    """Replace the rows of an unpartitioned table by what ``build`` makes of them; with None it stays as it is.

    The rows go to a fresh folder below the table's own, in the table's format;
    the table then points to it in one catalog change, so readers see the old
    rows or the new ones. The rows before stay for readers under way, and go
    with the next snapshot. Writers take their turns, see ``commits``: ``build``
    is called when the writers before are done. A ``batch`` (name, number) that
    was loaded before is not loaded again. Returns whether something was written.
    """
    place = place_of(spark, table)
    if place.partitions:
        raise ValueError(f"table {table} is partitioned; replace its partitions instead")
    apply = lambda commit: _point(spark, table, commit)
    with commits.writing(spark, place.base, owner, None, apply) as held:
        if _loaded(spark, place.base, batch):
            return False
        spark.catalog.refreshTable(table)
        df = build(spark.read.table(table))
        if df is None:
            return False
        name = uuid.uuid4().hex
        df.write.format(place.provider).options(**place.options).save(f"{place.base}/{SNAPSHOTS}/{name}")
        commits.finish(spark, held, name, [], batch, apply)
    return True


def _loaded(spark: SparkSession, base: str, batch: tuple[str, int] | None) -> bool:
    return batch is not None and commits.batches(spark, base).get(batch[0], batch[1] - 1) >= batch[1]


def _point(spark: SparkSession, table: str, commit: commits.Commit) -> None:
    """Let the table point to a committed snapshot."""
    before = place_of(spark, table)
    path = f"{before.base}/{SNAPSHOTS}/{commit.written}"
    if before.location.rpartition("/")[2] == commit.written:
        return
    quoted = path.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{quoted}'")
    refreshed(spark, table, before.analyzed)
    _drop_old(spark, before, commit)


def _drop_old(spark: SparkSession, before: Place, new: commits.Commit) -> None:
    """Remove what is older than the rows before a snapshot.

    Only what the log calls written goes, and what nobody has touched for longer
    than a claim may last: a snapshot that is still being written stays.
    """
    if before.location == before.base:
        return
    system, path = _system(spark, before.base)
    last = before.location.rpartition("/")[2]
    for status in system.listStatus(path(before.base)):
        if not status.getPath().getName().startswith("_"):
            system.delete(status.getPath(), True)
    known = {c.written for c in commits.commits(spark, before.base) if c.number < new.number}
    old = (time.time() - commits.LEASE_SECONDS) * 1000
    for status in system.listStatus(path(f"{before.base}/{SNAPSHOTS}")):
        name = status.getPath().getName()
        if name not in (last, new.written) and (name in known or status.getModificationTime() < old):
            system.delete(status.getPath(), True)


def rewrite_files(
    spark: SparkSession,
    table: str,
    partitions: list[str] | None,
    build: Callable[[DataFrame], tuple[DataFrame, list[str]] | None],
    owner: str | None = None,
    batch: tuple[str, int] | None = None,
) -> bool:
    """Replace some files of a partitioned table; all others stay as they are.

    ``build`` gets the table and gives the rows to write and the files whose
    place they take, as ``_metadata.file_path`` names them. The rows are written
    aside, once; when that is committed the new files move in and the old ones
    go. ``partitions`` are those that may change, for writers of others need not
    wait; None means any. Otherwise as ``rewrite``.
    """
    place = place_of(spark, table)
    apply = lambda commit: _move_in(spark, table, place, commit)
    with commits.writing(spark, place.base, owner, partitions, apply) as held:
        if _loaded(spark, place.base, batch):
            return False
        spark.catalog.refreshTable(table)
        found = build(spark.read.table(table))
        if found is None:
            return False
        df, files = found
        staged = increment_path(place.base)
        spread = df.hint("rebalance", *[column(p) for p in place.partitions])
        spread.write.format(place.provider).options(**place.options).partitionBy(*place.partitions).save(staged)
        removed = [below(spark, unquote(name), place.base) for name in files]
        commits.finish(spark, held, staged.rpartition("/")[2], removed, batch, apply)
    return True


def below(spark: SparkSession, name: str, folder: str) -> str:
    """The part of a file's path below a folder."""
    system, path = _system(spark, folder)
    whole, top = system.makeQualified(path(name)).toString(), system.makeQualified(path(folder)).toString()
    if not whole.startswith(top + "/"):
        raise ValueError(f"{whole} does not lie below {top}")
    return whole[len(top) + 1 :]


# Partitions named in one statement.
PARTITIONS_AT_ONCE = 500


def _move_in(spark: SparkSession, table: str, place: Place, commit: commits.Commit) -> None:
    """Move the files of a commit into their partitions and remove those whose place they take."""
    staged = f"{place.base}/{commit.written}"
    system, path = _system(spark, place.base)
    if system.exists(path(staged)):
        specs = [_spec(folder, place.partitions) for folder in _leaves(system, path(staged), len(place.partitions))]
        for at in range(0, len(specs), PARTITIONS_AT_ONCE):
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(specs[at : at + PARTITIONS_AT_ONCE])}")
        publish_increment(spark, staged, place.base)
    for name in commit.removed:
        system.delete(path(f"{place.base}/{name}"), False)
    refreshed(spark, table, place.analyzed)


def _leaves(system, folder, depth: int) -> list[str]:
    """Partition folders below a folder, each as ``p=v/q=w``."""
    if depth == 0:
        return [""]
    out = []
    for status in system.listStatus(folder):
        name = status.getPath().getName()
        if status.isDirectory() and not name.startswith(("_", ".")):
            out += [f"{name}/{rest}" if rest else name for rest in _leaves(system, status.getPath(), depth - 1)]
    return out


def _spec(folder: str, names: list[str]) -> str:
    values = []
    for name, part in zip(names, folder.split("/")):
        value = unquote(part.partition("=")[2])
        quoted = value.replace("\\", "\\\\").replace("'", "\\'")
        values.append(f"`{name}` = " + ("NULL" if value == "__HIVE_DEFAULT_PARTITION__" else f"'{quoted}'"))
    return f"PARTITION ({', '.join(values)})"


# The column that tells which file of a table a row lies in.
FILE = "__file"


def located(target: DataFrame) -> DataFrame:
    """The rows of a table with the file each lies in."""
    return target.withColumn(FILE, F.col("_metadata.file_path"))


def files_with(rows: DataFrame) -> list[str]:
    """The files that located rows lie in. Their names are as many as the files to be rewritten."""
    return [r[0] for r in rows.select(FILE).distinct().collect()]


def rows_of(target: DataFrame, files: list[str]) -> DataFrame:
    """The rows of some files; the others are not opened."""
    return target.where(F.col("_metadata.file_path").isin(files))


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table together with its files and snapshots, wherever they lie."""
    base = place_of(spark, table).base
    spark.sql(f"DROP TABLE {table}")
    system, path = _system(spark, base)
    system.delete(path(base), True)


def increment_path(target: str) -> str:
    """A fresh folder below ``target`` that readers of ``target`` do not see."""
    return f"{target.rstrip('/')}/{INCREMENT}{uuid.uuid4().hex}"


def discard_increment(spark: SparkSession, staged: str) -> None:
    """Remove a folder whose files will not be published."""
    system, path = _system(spark, staged)
    system.delete(path(staged), True)


def publish_increment(spark: SparkSession, staged: str, target: str) -> None:
    """Move the files written to ``staged`` into ``target``, at the same place below it.

    Files keep their names, which are unique, so the call can be repeated: what
    was moved before is no longer there, and a folder that is gone is done.
    """
    system, path = _system(spark, staged)
    top = path(staged)
    if not system.exists(top):
        return
    prefix = system.makeQualified(top).toString()
    found, names = system.listFiles(top, True), []
    while found.hasNext():
        below = found.next().getPath().toString()[len(prefix) + 1 :]
        if not any(part.startswith(("_", ".")) for part in below.split("/")):
            names.append(below)

    def move(below: str) -> None:
        goal = path(f"{target.rstrip('/')}/{below}")
        system.mkdirs(goal.getParent())
        if not system.rename(path(f"{prefix}/{below}"), goal) and not system.exists(goal):
            raise OSError(f"{prefix}/{below} cannot be moved to {goal}")

    # A move is a call to the file system's own server, so many are under way at a time.
    with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
        list(pool.map(move, names))
    system.delete(top, True)
