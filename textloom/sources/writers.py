"""Writing line files, splits, manifests and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARD_LINES = 500_000


def write_lines(lines: DataFrame, path: str, by: list[str] | None = None, shard_lines: int = SHARD_LINES, mode: str = "overwrite") -> None:
    """Text files of at most ``shard_lines`` lines in a folder for each value of ``by``; stale files go with the overwrite."""
    by = by or ["source"]
    lines.select(*by, F.col("line").alias("value")).write.mode(mode).partitionBy(*by).option("maxRecordsPerFile", shard_lines).text(path)


def write_split(split: DataFrame, path: str, shard_lines: int = SHARD_LINES) -> None:
    """Folders split=.../source=..."""
    write_lines(split, path, ["split", "source"], shard_lines)


def save_manifest(manifest: DataFrame, path: str) -> None:
    """The state of a collection, committed after its lines: one row a source."""
    manifest.write.mode("overwrite").json(path)


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("source string, chars bigint, lines bigint, shard int, configs map<string,bigint>").json(path)


def markdown(df: DataFrame, title: str, most: int = 200) -> str:
    """A small table as Markdown; more rows than ``most`` are an error, not cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|")
    head = [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(head + ["| " + " | ".join(map(cell, r)) + " |" for r in rows]) + "\n"
