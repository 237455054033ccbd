"""Which files each run of a pipeline read, and how far it got.

Below a folder of its own, every run has a number and up to four small files,
each put there once: ``read`` (the files with their sizes, before anything is
loaded), ``staged`` (rows written aside, and where they are to go), ``loaded``,
``archived``. A run that stopped is taken up where it stopped, with the files it
had and no others, before the next one begins. One process at a time runs a
pipeline of a name.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import SparkSession

from ledgerloom.sinks.files_log import names_in, put_if_absent, read_text, system_of

STATES = ("read", "staged", "loaded", "archived")


@dataclass(frozen=True)
class Run:
    """One run and its place in the journal."""

    spark: SparkSession
    folder: str
    number: int
    run_id: str
    files: list[str]

    def note(self, state: str, **facts) -> None:
        """Store that the run got to ``state``; noting it twice is the same as once."""
        put_if_absent(self.spark, f"{self.folder}/{self.number:09d}.{state}", json.dumps(facts))

    def facts(self, state: str) -> dict | None:
        """What was stored with a state, None if the run did not get there."""
        name = f"{self.number:09d}.{state}"
        return json.loads(read_text(self.spark, f"{self.folder}/{name}")) if name in names_in(self.spark, self.folder) else None

    @property
    def label(self) -> str:
        """A folder name no other run has, also where run ids repeat."""
        return f"{self.number:09d}-{quote(self.run_id, safe='')}"


def journal_folder(state_path: str, name: str) -> str:
    return f"{state_path.rstrip('/')}/_journal/{quote(name, safe='')}"


def begin(spark: SparkSession, folder: str, run_id: str, files: list[tuple[str, int]]) -> Run:
    """Store what a run is about to read."""
    while True:
        number = 1 + max((int(n.partition(".")[0]) for n in names_in(spark, folder)), default=0)
        text = json.dumps({"run_id": run_id, "files": files, "at": time.time()})
        if put_if_absent(spark, f"{folder}/{number:09d}.read", text):
            return Run(spark, folder, number, run_id, [name for name, _ in files])


def unfinished(spark: SparkSession, folder: str) -> list[Run]:
    """Runs that read files which are not archived yet, the oldest first."""
    names = set(names_in(spark, folder))
    out = []
    for name in sorted(n for n in names if n.endswith(".read")):
        if name.replace(".read", ".archived") not in names:
            held = json.loads(read_text(spark, f"{folder}/{name}"))
            out.append(Run(spark, folder, int(name.partition(".")[0]), held["run_id"], [f for f, _ in held["files"]]))
    return out


def files_in(spark: SparkSession, directory: str, pattern: str | None = None) -> list[tuple[str, int]]:
    """The files below a folder whose names match, with their sizes; none of them is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    found = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(directory).select("path", "length")
    return sorted((r["path"], r["length"]) for r in found.collect())


def archive(run: Run, source: str, target: str) -> None:
    """Move the files of a run below ``target``, into a folder of the run, so that equal names keep apart.

    Files moved before are passed over, so the call can be repeated.
    """
    system, path = system_of(run.spark, source)
    prefix = system.makeQualified(path(source)).toString().rstrip("/")
    for name in run.files:
        place = system.makeQualified(path(name)).toString()
        below = place[len(prefix) + 1 :] if place.startswith(prefix + "/") else place.rpartition("/")[2]
        goal = path(f"{target.rstrip('/')}/{run.label}/{below}")
        system.mkdirs(goal.getParent())
        if not system.rename(path(name), goal) and not system.exists(goal):
            raise OSError(f"{name} cannot be moved to {goal}")
    run.note("archived")
