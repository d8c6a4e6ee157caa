"""Session helpers: a default local session, and the shared folder in which lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, memory: str = "8g", app: str = "textloom") -> SparkSession:
    """A local session with the settings that the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is missing, a temporary folder is made, but only in local
    mode: on a cluster the executors would not see it, so that is an error.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        at = jvm_dir.get() if jvm_dir.isDefined() else None
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="textloom-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def cut(df: DataFrame, name: str = "cut", rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The result no longer depends on the plan that made it, columns can still be
    pruned, and it outlives the loss of any executor. ``rows_per_file`` keeps files
    of very wide rows small (0: no limit).
    """
    spark = df.sparkSession
    path = f"{own_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def own_dir(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_dir(spark)}/textloom/{spark.sparkContext.applicationId}"


def delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def drop(*tables: DataFrame) -> None:
    """Delete tables made by ``cut`` that nothing reads any more."""
    for t in tables:
        delete(t.sparkSession, t.cut_path)


def drop_cuts(spark: SparkSession) -> None:
    """Delete every table that ``cut`` has left in the shared folder for this application; others are not touched."""
    delete(spark, own_dir(spark))
