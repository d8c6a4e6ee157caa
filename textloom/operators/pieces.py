"""Pre-token pieces and their lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The mark that stands for a blank, and the published byte-level split pattern without its white space branches,
# which clean lines never reach.
MARK = "▁"
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
PERCENTILES = [50.0, 90.0, 95.0, 99.0, 99.9, 99.99]
THRESHOLDS = list(range(12, 41, 4))


def metaspace(line: Column) -> Column:
    """Pieces that each begin with the mark; none for an empty line."""
    return F.regexp_extract_all(F.when(F.startswith(line, F.lit(" ")), F.replace(line, F.lit(" "), F.lit(MARK))).when(line != "", F.concat(F.lit(MARK), F.replace(line, F.lit(" "), F.lit(MARK)))).otherwise(F.lit("")), F.lit(f"{MARK}[^{MARK}]*"), F.lit(0))


def byte_level(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(BYTE_LEVEL), F.lit(0))


def piece_counts(lines: DataFrame, kind: str = "metaspace") -> DataFrame:
    """(piece, n): the table that a vocabulary is made from."""
    of = metaspace if kind == "metaspace" else byte_level
    return lines.select(F.explode(of(F.col("line"))).alias("piece")).groupBy("piece").agg(F.count(F.lit(1)).alias("n"))


def length_counts(pieces: DataFrame) -> DataFrame:
    """(measure, length, n) of piece lengths in characters and in UTF-8 bytes."""
    both = F.explode(F.array(F.struct(F.lit("chars").alias("measure"), F.length("piece").alias("length")), F.struct(F.lit("bytes").alias("measure"), F.octet_length("piece").alias("length"))))
    return pieces.select(both.alias("x"), "n").groupBy("x.measure", "x.length").agg(F.sum("n").alias("n"))


def length_percentiles(counts: DataFrame, percentiles: list[float] = PERCENTILES) -> DataFrame:
    """(measure, percentile, length): the least length up to which at least that part of the pieces goes.

    The window runs over the histogram, which has one row a length.
    """
    w = Window.partitionBy("measure")
    x = counts.withColumns({"cum": F.sum("n").over(w.orderBy("length")), "total": F.sum("n").over(w)})
    x = x.withColumn("percentile", F.explode(F.array(*map(F.lit, percentiles)))).where(F.col("cum") >= F.col("total") * F.col("percentile") / 100)
    return x.groupBy("measure", "percentile").agg(F.min("length").alias("length"))


def threshold_coverage(counts: DataFrame, thresholds: list[int] = THRESHOLDS) -> DataFrame:
    """(measure, threshold, covered, percent)."""
    x = counts.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    x = x.groupBy("measure", "threshold").agg(F.sum(F.when(F.col("length") <= F.col("threshold"), F.col("n")).otherwise(0)).alias("covered"), F.sum("n").alias("total"))
    return x.select("measure", "threshold", "covered", F.round(F.col("covered") * 100.0 / F.col("total"), 4).alias("percent"))


def longest_pieces(pieces: DataFrame, k: int = 30) -> DataFrame:
    """The k longest pieces by bytes; ties in order of the piece."""
    return pieces.select("piece", F.octet_length("piece").alias("bytes"), "n").orderBy(F.desc("bytes"), "piece").limit(k)
