"""Train and holdout by a salted hash of the line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import hash_fraction
from textloom.session import cut

HOLDOUT_LINES, MIN_PER_SOURCE = 100_000, 2000
SALT = "holdout|"


def holdout_plan(lines: DataFrame, holdout_lines: int = HOLDOUT_LINES, least: int = MIN_PER_SOURCE) -> DataFrame:
    """(source, lines, want, modulo): one line in ``modulo`` goes to the holdout, at most a tenth of a source."""
    x = lines.where("source is not null").groupBy("source").agg(F.count(F.lit(1)).alias("lines"))
    total = x.agg(F.sum("lines").alias("total"))
    x = x.crossJoin(F.broadcast(total))  # one row
    want = F.greatest(F.lit(least), F.bround(F.col("lines") * F.lit(float(holdout_lines)) / F.col("total")).cast("bigint"))
    x = x.withColumn("want", F.least(want, F.greatest(F.lit(1), F.floor(F.col("lines") / 10))))
    return x.select("source", "lines", "want", F.greatest(F.lit(2), F.bround(F.col("lines") / F.col("want")).cast("bigint")).alias("modulo"))


def holdout_draw(lines: DataFrame, keys: list[str], holdout_lines: int = HOLDOUT_LINES, least: int = MIN_PER_SOURCE) -> DataFrame:
    """(keys..., source, split) with the plan of the lines themselves, which are read once: keys and draws are kept, texts are not."""
    drawn = cut(lines.where("source is not null").select(*keys, "source", hash_fraction(F.col("line"), SALT).alias("draw")), "draws")
    plan = holdout_plan(drawn, holdout_lines, least).select("source", "modulo")
    x = drawn.join(F.broadcast(plan), "source")  # one row a source
    return x.select(*keys, "source", F.when(F.col("draw") % F.col("modulo") == 0, "holdout").otherwise("train").alias("split"))


def holdout_split(lines: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds ``split``. Lines of sources that aren't in the plan are left out; every other line is in exactly one split."""
    x = lines.join(F.broadcast(plan.select("source", "modulo")), "source")  # one row a source
    return x.withColumn("split", F.when(hash_fraction(F.col("line"), SALT) % F.col("modulo") == 0, "holdout").otherwise("train")).drop("modulo")


def unplanned_sources(lines: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, lines) of what the plan doesn't know."""
    return lines.join(F.broadcast(plan.select("source")), "source", "left_anti").groupBy("source").agg(F.count(F.lit(1)).alias("lines"))


def split_report(split: DataFrame) -> DataFrame:
    """(source, split, lines, chars)."""
    return split.groupBy("source", "split").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("line")).cast("bigint").alias("chars"))
