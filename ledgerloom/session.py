"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "ledgerloom", **conf) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is missing and the
    session itself is local, as in tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    fresh = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.sparkContext.setCheckpointDir(fresh)
    return fresh


def scratch_dir(spark: SparkSession) -> str:
    """The folder below the shared one that this application's intermediate tables go to."""
    return f"{shared_dir(spark)}/ledgerloom/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote to its scratch folder. Frames that read from there end with it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives executor loss, and gives the planner the true
    size of the result for its later join choices.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
