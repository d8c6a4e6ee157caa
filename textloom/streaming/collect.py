"""Collecting from a folder that grows: Structured Streaming with the accepted keys in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textloom.functions.text import collapse_space, dedup_norm, hash128, reject_reason
from textloom.operators.collect import RECORD_CAP, candidates, sequential
from textloom.operators.dedup import first_of_norm
from textloom.session import cut, drop


def clean_stream(spark: SparkSession, path: str, schema: StructType, glob: str | None = None) -> DataFrame:
    """A stream of (line_id, rec_id, source, line, reason) from parquet files with line_id, source and text."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    x = reader.parquet(path).where("text is not null")
    record = F.col("rec_id") if "rec_id" in schema.names else F.lit(None).cast("bigint")
    x = x.select("line_id", record.alias("rec_id"), "source", collapse_space(F.col("text")).alias("line"))
    return x.withColumn("reason", F.coalesce(reject_reason(F.col("line")), F.lit("ok")))


def exists(spark: SparkSession, at: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def accept_batch(batch: DataFrame, batch_id: int, accepted: str, sources: DataFrame | None = None, total: float = 0.0, record_cap: int = RECORD_CAP) -> None:
    """Adds the lines of a batch that nobody has had. Written by batch number, so a repeated batch replaces itself.

    Of what was accepted before only the 128-bit keys of the forms are read, and the sums of
    the sources. With ``sources`` their priorities, quotas and the cap for a record hold:
    a batch is taken as one pass in order would take it after all batches before.
    """
    spark = batch.sparkSession
    h1, h2 = hash128(dedup_norm(F.col("line")))
    x = batch.where("reason = 'ok'").withColumns({"h1": h1, "h2": h2})
    had: dict[str, int] = {}
    if exists(spark, accepted):
        before = spark.read.parquet(accepted).where(F.col("batch") != batch_id)
        x = x.join(before.select("h1", "h2"), ["h1", "h2"], "left_anti")
        if sources is not None:
            had = {r.source: r.n for r in before.where("source is not null").groupBy("source").agg(F.sum("n").alias("n")).collect()}  # one row a source
    x = cut(x, "batch")
    if sources is None:
        kept = first_of_norm(x.withColumn("norm", F.struct("h1", "h2")), ["line_id"]).drop("norm")
    else:
        taken = sequential(candidates(x.drop("h1", "h2"), sources, total), sources, total, had, record_cap)
        kept = x.join(taken.select("line_id"), "line_id", "left_semi")
    kept.select("line_id", "source", "line", F.length("line").cast("bigint").alias("n"), "h1", "h2").write.mode("overwrite").parquet(f"{accepted}/batch={batch_id}")
    drop(x)


def collect_stream(
    spark: SparkSession, path: str, schema: StructType, accepted: str, checkpoint: str, glob: str | None = None,
    sources: DataFrame | None = None, total: float = 0.0, record_cap: int = RECORD_CAP,
) -> DataFrame:
    """Takes everything there is so far and returns the accepted lines. Called again, it goes on where it stopped."""
    take = lambda b, i: accept_batch(b, i, accepted, sources, total, record_cap)
    query = clean_stream(spark, path, schema, glob).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(accepted).select("line_id", "source", "line")
