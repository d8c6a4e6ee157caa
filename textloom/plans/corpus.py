"""The pipeline: records to lines, usable lines, no copies, quotas, splits and the report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import collapse_space, once, reject_reason
from textloom.operators import collect, lines, report, split


@dataclass(frozen=True)
class Settings:
    """Sizes of a run; ``total`` is the wanted number of characters."""

    total: float
    record_cap: int = collect.RECORD_CAP
    limit: int = lines.LIMIT
    holdout_lines: int = split.HOLDOUT_LINES
    least_holdout: int = split.MIN_PER_SOURCE


def shard_lines(shards: DataFrame) -> DataFrame:
    """Lines as they were stored, cleaned: line_id, rec_id, source, config, shard, line_no, line."""
    return shards.where("text is not null").select("line_id", "rec_id", "source", "config", "shard", "line_no", once(collapse_space(F.col("text"))).alias("line"))


def usable(clean: DataFrame) -> DataFrame:
    return clean.where(reject_reason(F.col("line")).isNull())


def corpus_report(documents: DataFrame) -> DataFrame:
    """(source, reason, lines, chars): the flagship query, straight from whole documents."""
    return collect.reject_counts(lines.explode_lines(documents, ["doc_id", "source"], limit=None))


def build(clean: DataFrame, sources: DataFrame, settings: Settings) -> DataFrame:
    """(line_id, source, line, split): a corpus collected exactly and split."""
    taken = collect.collect_exact(clean, sources, settings.total, settings.record_cap)
    kept = clean.join(taken.select("line_id"), "line_id", "left_semi")
    plan = split.holdout_plan(kept, settings.holdout_lines, settings.least_holdout)
    return split.holdout_split(kept, plan).select("line_id", "source", "line", "split")


def statistics(clean: DataFrame) -> dict[str, DataFrame]:
    """All reports on lines by name."""
    return {"stats": report.corpus_stats(clean), "lengths": report.length_histogram(clean), "rates": report.suspicious_rates(report.systematic_sample(clean)), "drawn": report.drawn_lines(clean)}
