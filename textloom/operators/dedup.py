"""Exact duplicates across sources; the source that comes first in the registry keeps the line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import dedup_norm, hash128


def with_priority(lines: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds the registry's priority of the source; sources that aren't in it come last."""
    p = sources.select(F.col("name").alias("source"), "priority")
    return lines.join(F.broadcast(p), "source", "left").withColumn("priority", F.coalesce("priority", F.lit(1_000_000)))  # one row a source


def first_of_norm(lines: DataFrame, order: list[str], norm: str = "norm") -> DataFrame:
    """The first row of every normal form. Pre-aggregated, so a form that fills a large share of all rows does no harm."""
    first = lines.groupBy(norm).agg(F.min(F.struct(*order)).alias("_first"))
    same = [F.col(f"_first.{c}") == F.col(c) for c in order]
    x = lines.join(first, norm)
    for s in same:
        x = x.where(s)
    return x.drop("_first")


def priority_dedup(lines: DataFrame, sources: DataFrame) -> DataFrame:
    """Lines (line_id unique) that are the first with their normal form, in order of priority and id."""
    x = with_priority(lines, sources).withColumn("norm", dedup_norm(F.col("line")))
    return first_of_norm(x, ["priority", "line_id"]).drop("norm")


def exact_dedup(lines: DataFrame) -> DataFrame:
    """The first line of every exact text."""
    return first_of_norm(lines, ["line_id"], "line")


def duplicate_report(lines: DataFrame) -> DataFrame:
    """(source, lines, unique_keys, duplicates) by source, the totals under a null source."""
    h1, h2 = hash128(dedup_norm(F.col("line")))
    x = lines.select(F.coalesce("source", F.lit("?")).alias("source"), h1.alias("h1"), h2.alias("h2"))
    per_key = x.groupBy("source", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    per = per_key.groupBy("source").agg(F.sum("n").alias("lines"), F.count(F.lit(1)).alias("unique_keys"))
    whole = per_key.groupBy("h1", "h2").agg(F.sum("n").alias("n")).agg(F.sum("n").alias("lines"), F.count(F.lit(1)).alias("unique_keys")).select(F.lit(None).cast("string").alias("source"), "lines", "unique_keys")
    return per.unionByName(whole).withColumn("duplicates", F.col("lines") - F.col("unique_keys"))
