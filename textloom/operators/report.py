"""Independent measurements of a corpus of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import ORDINARY, TURKISH_LETTERS, all_caps, count_char, has_replacement, hash_fraction, low_variety
from textloom.operators.prefix import exclusive_sum

# The inclusive length ranges of the histogram.
BUCKETS = [(0, 19), (20, 49), (50, 99), (100, 199), (200, 499), (500, 999), (1000, 1999), (2000, None)]
SAMPLE_EVERY, DRAWN = 50, 5


def corpus_stats(lines: DataFrame) -> DataFrame:
    """(source, lines, chars, shards, bad_lines, mean_chars, share)."""
    n = F.length("line").cast("bigint")
    x = lines.groupBy("source").agg(F.count(F.lit(1)).alias("lines"), F.sum(n).alias("chars"), F.countDistinct("shard").alias("shards"), F.sum(has_replacement(F.col("line")).cast("int")).alias("bad_lines"))
    total = x.agg(F.sum("chars").alias("total"))
    x = x.crossJoin(F.broadcast(total))  # one row
    return x.select("source", "lines", "chars", "shards", "bad_lines", F.round(F.col("chars") / F.col("lines"), 4).alias("mean_chars"), F.round(F.col("chars") * 100.0 / F.col("total"), 4).alias("share"))


def grand_totals(lines: DataFrame) -> DataFrame:
    """(source, lines, chars) with a row of totals, marked by is_total."""
    x = lines.withColumn("n", F.length("line").cast("bigint")).rollup("source").agg(F.count(F.lit(1)).alias("lines"), F.sum("n").alias("chars"), F.grouping("source").alias("is_total"))
    return x.select("source", "lines", "chars", F.col("is_total").cast("int").alias("is_total"))


def bucket_name(length):
    expr = None
    for lo, hi in BUCKETS:
        name = f"{lo}-{hi}" if hi is not None else f"{lo}+"
        cond = length >= lo if hi is None else (length >= lo) & (length <= hi)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr


def length_histogram(lines: DataFrame) -> DataFrame:
    """(source, bucket, lines, percent) of line lengths."""
    x = lines.groupBy("source", bucket_name(F.length("line")).alias("bucket")).agg(F.count(F.lit(1)).alias("lines"))
    total = F.sum("lines").over(Window.partitionBy("source"))  # eight rows a source
    return x.select("source", "bucket", "lines", F.round(F.col("lines") * 100.0 / total, 4).alias("percent"))


def systematic_sample(lines: DataFrame, every: int = SAMPLE_EVERY) -> DataFrame:
    """Every so-manieth line of all, in order of line_id."""
    x = lines.withColumns({"one": F.lit(1), "all": F.lit(0)})
    x = exclusive_sum(x, ["all"], F.floor(F.col("line_id") / 50_000), ["line_id"], "one", "before")
    return x.where((F.col("before") + 1) % every == 0).drop("one", "all", "before")


def suspicious_rates(lines: DataFrame) -> DataFrame:
    """(source, sampled, turkish, all_caps, urls, low_variety) in percent, over all lines given."""
    c = F.col("line")
    pct = lambda cond: F.round(F.sum(cond.cast("int")) * 100.0 / F.count(F.lit(1)), 4)
    turkish = F.round(F.sum(count_char(c, TURKISH_LETTERS)) * 100.0 / F.nullif(F.sum(F.length(c)), F.lit(0)), 4)
    return lines.groupBy("source").agg(F.count(F.lit(1)).alias("sampled"), turkish.alias("turkish"), pct(all_caps(c)).alias("all_caps"), pct(c.contains("http")).alias("urls"), pct(low_variety(c)).alias("low_variety"))


def drawn_lines(lines: DataFrame, n: int = DRAWN, salt: str = "draw|") -> DataFrame:
    """(source, line_id, line): the n lines of every source with the least salted hash.

    The rank limit is pushed below the shuffle, so of a source each task sends n lines only.
    """
    x = lines.where("source is not null").select("source", "line_id", "line", hash_fraction(F.col("line_id").cast("string"), salt).alias("h"))
    rank = F.row_number().over(Window.partitionBy("source").orderBy("h", "line_id"))
    return x.withColumn("k", rank).where(F.col("k") <= n).select("source", "line_id", "line")


def state_compare(lines: DataFrame, state: DataFrame) -> DataFrame:
    """(source, state_lines, lines, state_chars, chars, status): saved counters against what is there."""
    have = lines.groupBy("source").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("line")).cast("bigint").alias("chars"))
    saved = state.select("source", F.col("lines").alias("state_lines"), F.col("chars").alias("state_chars"))
    x = saved.join(have, "source", "full_outer").na.fill(0, ["state_lines", "state_chars", "lines", "chars"])
    same = (F.col("lines") == F.col("state_lines")) & (F.col("chars") == F.col("state_chars"))
    return x.select("source", "state_lines", "lines", "state_chars", "chars", F.when(same, "same").otherwise("differs").alias("status"))


def last_state(state: DataFrame) -> DataFrame:
    """(source, chars, lines): the newest complete save of every source, over all runs."""
    s = state.where("chars is not null and lines is not null and source is not null")
    last = s.groupBy(F.trim(F.lower("source")).alias("source")).agg(F.max(F.struct("saved_at", "run_id", "chars", "lines")).alias("r"))
    return last.select("source", "r.chars", "r.lines")


def word_counts(lines: DataFrame) -> DataFrame:
    return lines.select(F.explode(F.split(F.lower("line"), " ")).alias("word")).where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def top_words(lines: DataFrame, k: int = 20) -> DataFrame:
    """The k most frequent words; ties in order of the word."""
    return word_counts(lines).orderBy(F.desc("n"), "word").limit(k)


def weird_chars(lines: DataFrame, k: int = 15) -> DataFrame:
    """The k most frequent characters that are neither letters, digits, blanks nor ordinary punctuation."""
    odd = F.regexp_replace("line", rf"[\p{{L}}\p{{N}}\s\x1c-\x1f\x85\p{{Z}}{ORDINARY}]+", "")
    x = lines.select(odd.alias("odd")).where("odd <> ''").select(F.explode(F.split("odd", "")).alias("char")).where("char <> ''")
    return x.groupBy("char").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "char").limit(k)


def char_profile(lines: DataFrame) -> DataFrame:
    """(lines, mean_chars, mean_words, turkish_percent) over all lines."""
    c = F.col("line")
    return lines.agg(
        F.count(F.lit(1)).alias("lines"), F.round(F.sum(F.length(c)) / F.count(F.lit(1)), 4).alias("mean_chars"),
        F.round(F.sum(F.size(F.split(c, " "))) / F.count(F.lit(1)), 4).alias("mean_words"),
        F.round(F.sum(count_char(c, TURKISH_LETTERS)) * 100.0 / F.nullif(F.sum(F.length(c)), F.lit(0)), 4).alias("turkish_percent"),
    )


def char_frequency(lines: DataFrame) -> DataFrame:
    """(char, n) of every character."""
    return lines.select(F.explode(F.split("line", "")).alias("char")).where("char <> ''").groupBy("char").agg(F.count(F.lit(1)).alias("n"))
