"""Samples, mixtures with targets, oversampling, size caps and shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import hash_fraction
from textloom.operators.prefix import exclusive_sum


def in_shard(lines: DataFrame) -> DataFrame:
    """Adds ``before``: how many lines of its shard come before a line."""
    x = lines.where("source is not null and shard is not null").withColumn("one", F.lit(1))
    return exclusive_sum(x, ["source", "shard"], F.floor(F.col("line_no") / 50_000), ["line_no", "line_id"], "one", "before").drop("one")


def head_per_shard(lines: DataFrame, budget: int) -> DataFrame:
    """(line_id, source, shard): of every source ``budget`` lines, as many from the head of each shard."""
    shards = lines.where("source is not null and shard is not null").groupBy("source").agg(F.countDistinct("shard").alias("shards"))
    x = in_shard(lines).join(F.broadcast(shards), "source")
    return x.where(F.col("before") < F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("shards")))).select("line_id", "source", "shard")


def proportional_sample(lines: DataFrame, budget: int) -> DataFrame:
    """(line_id, source, shard): a budget shared by the number of shards, then equally over a source's shards."""
    shards = lines.where("source is not null and shard is not null").groupBy("source").agg(F.countDistinct("shard").alias("shards"))
    total = shards.agg(F.sum("shards").alias("total"))
    plan = shards.crossJoin(F.broadcast(total))  # one row
    plan = plan.withColumn("source_budget", F.greatest(F.lit(1), F.floor(F.lit(budget) * F.col("shards") / F.col("total"))))
    plan = plan.select("source", "source_budget", F.greatest(F.lit(1), F.floor(F.col("source_budget") / F.col("shards"))).alias("per_shard"))
    x = in_shard(lines).join(F.broadcast(plan), "source").where("before < per_shard")
    # A shard is opened only while the source's budget lasts: its lines count in order of shards.
    sizes = x.groupBy("source", "shard").agg(F.count(F.lit(1)).alias("n"))
    opened = exclusive_sum(sizes, ["source"], F.lit(0), ["shard"], "n", "earlier").select("source", "shard", "earlier")
    x = x.join(opened, ["source", "shard"]).where("earlier < source_budget")
    return x.select("line_id", "source", "shard")


def mixture(lines: DataFrame, targets: DataFrame) -> DataFrame:
    """(line_id, source, n): lines in order until a source has reached its target (source, target)."""
    x = lines.where("source is not null").select("line_id", "source", F.length("line").cast("bigint").alias("n"))
    x = exclusive_sum(x.join(F.broadcast(targets), "source"), ["source"], F.floor(F.col("line_id") / 50_000), ["line_id"], "n", "before")
    return x.where("before < target").select("line_id", "source", "n")


def oversample(lines: DataFrame, targets: DataFrame, salt: str = "over|") -> DataFrame:
    """(line_id, source, epoch, n): a source below its target is repeated until it is reached.

    Epoch 0 is the source itself, always whole. Every later epoch has a hashed
    order of its own and ends where the target is reached. A source at or above
    its target, or without any character, isn't repeated.
    """
    x = lines.where("source is not null").select("line_id", "source", F.length("line").cast("bigint").alias("n"))
    have = x.groupBy("source").agg(F.sum("n").alias("have")).join(F.broadcast(targets), "source")
    have = have.withColumn("epochs", F.when((F.col("have") > 0) & (F.col("target") > F.col("have")), F.ceil((F.col("target") - F.col("have")) / F.col("have"))).otherwise(0).cast("int"))
    x = x.join(F.broadcast(have), "source").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs"))))
    x = x.withColumn("h", hash_fraction(F.concat_ws("|", F.col("epoch").cast("string"), F.col("line_id").cast("string")), salt))
    bucket = F.floor(F.col("h") / F.lit(1 << 52))
    x = exclusive_sum(x, ["source", "epoch"], bucket, ["h", "line_id"], "n", "inner")
    needed = F.col("target") - F.col("have") - (F.col("epoch") - 1) * F.col("have")
    return x.where((F.col("epoch") == 0) | (F.col("inner") < needed)).select("line_id", "source", "epoch", "n")


def byte_cap(lines: DataFrame, line_quota: int, most_bytes: int) -> DataFrame:
    """(line_id, source, bytes): at most so many lines a source, and lines while the file is below a size (UTF-8, with line break)."""
    x = lines.where("source is not null").select("line_id", "source", (F.octet_length("line") + 1).cast("bigint").alias("bytes"), F.lit(1).alias("one"), F.lit(0).alias("all"))
    x = exclusive_sum(x, ["source"], F.floor(F.col("line_id") / 50_000), ["line_id"], "one", "before").where(F.col("before") < line_quota)
    x = exclusive_sum(x, ["all"], F.floor(F.col("line_id") / 50_000), ["line_id"], "bytes", "size").where(F.col("size") < most_bytes)
    return x.select("line_id", "source", "bytes")


def shuffled(lines: DataFrame, seed: int = 42) -> DataFrame:
    """Lines in an order by hash, the same for the same seed; a distributed range sort."""
    return lines.withColumn("place", hash_fraction(F.col("line_id").cast("string"), f"{seed}|")).orderBy("place", "line_id")


def config_targets(lines: DataFrame, targets: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(source, config, target): a source's target shared by its configurations, equally or by ``weights`` (1 where not named)."""
    w = F.lit(1.0)
    for config, weight in (weights or {}).items():
        w = F.when(F.col("config") == config, F.lit(float(weight))).otherwise(w)
    of = lines.where("source is not null and config is not null").select("source", "config").distinct().withColumn("w", w)
    every = of.groupBy("source").agg(F.sum("w").alias("all"))
    x = of.join(F.broadcast(every), "source").join(F.broadcast(targets), "source")  # one row a configuration
    return x.select("source", "config", F.floor(F.col("target") * F.col("w") / F.col("all")).cast("bigint").alias("target"))


def config_mixture(lines: DataFrame, targets: DataFrame) -> DataFrame:
    """(line_id, source, config, n): lines in order until a configuration has reached its target (source, config, target)."""
    x = lines.where("source is not null and config is not null").select("line_id", "source", "config", F.length("line").cast("bigint").alias("n"))
    x = exclusive_sum(x.join(F.broadcast(targets), ["source", "config"]), ["source", "config"], F.floor(F.col("line_id") / 50_000), ["line_id"], "n", "before")
    return x.where("before < target").select("line_id", "source", "config", "n")


def shuffled_chunks(lines: DataFrame, chunk: int, seed: int = 42) -> DataFrame:
    """(line_id, chunk, place): lines in an order by hash, in chunks of so many lines that can be written one by one."""
    x = lines.select("line_id", hash_fraction(F.col("line_id").cast("string"), f"{seed}|").alias("place"), F.lit(1).alias("one"), F.lit(0).alias("all"))
    x = exclusive_sum(x, ["all"], F.shiftright("place", 40), ["place", "line_id"], "one", "before")
    return x.select("line_id", F.floor(F.col("before") / chunk).cast("bigint").alias("chunk"), "place")
