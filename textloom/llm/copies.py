"""Problem 5: duplicates hidden by formatting differences.

Method: progressive partition refinement. Lines are first grouped by cheap
invariants that no formatting change and no reordering of fields can alter (the
number of letters and digits, and a histogram of some letters). Only lines of
classes with several members get the costlier keys: the hash of their letters
and digits in order, and, for lines made of labelled fields, the hash of their
fields in sorted order. The sizes of the first classes are kept in a table of
bounded size that every task has, so no text is moved to find the classes; where
several classes share a place of it, a line gets its costlier keys for nothing.

Defined results: null, empty and blank texts belong to no class; lines with
fewer than ``min_chars`` letters and digits are left out; repeated rows with one
id count as one line; the smallest id of a class stands for it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import hash128, letters_digits, once, turkish_lower
from textloom.llm.components import components
from textloom.llm.sketch import bits_for, count_table, held_by
from textloom.session import cut

MIN_CHARS = 40
# Frequent Turkish letters whose counts form the histogram.
HISTOGRAM = "aeinrlkd"
# A separator counts only where a label and its colon follow.
SPACE = r"[\s\p{Z}\p{Cf}]"
LABEL = r"\p{L}[\p{L}\p{Z}\p{Cf}\s]{0,24}:"
FIELD_SPLIT = SPACE + r"*[•|/;,·]" + SPACE + "*(?=" + LABEL + ")"
IS_FIELDS = "^" + SPACE + "*" + LABEL + r".*[•|/;,·]" + SPACE + "*" + LABEL


def cheap_key(stripped: Column) -> Column:
    """Hash of what reordering and formatting leave alone: length and letter histogram."""
    counts = [F.length(stripped) - F.length(F.replace(stripped, F.lit(c), F.lit(""))) for c in HISTOGRAM]
    return F.xxhash64(F.length(stripped), *counts)


def field_string(text: Column) -> Column:
    """For lines made of labelled fields their normalised fields, sorted; null for other lines."""
    parts = F.transform(F.split(turkish_lower(text), FIELD_SPLIT), lambda x: F.regexp_replace(x, r"[^\p{L}\p{N}]+", ""))
    return F.when(text.rlike("(?s)" + IS_FIELDS), F.array_join(F.array_sort(F.filter(parts, lambda x: x != "")), "\u001f"))


def keyed_lines(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, k1, k2, f1, f2) of the lines that share their cheap key with another line, and some more."""
    lines = (
        df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
        .where(F.col("id").isNotNull() & (F.length("text") >= min_chars))
        .select("id", "text", once(letters_digits(F.col("text"))).alias("stripped"))
        .where(F.length("stripped") >= min_chars)
        .withColumn("k0", cheap_key(F.col("stripped")))
    )
    # About two places a line, as far as the table may grow.
    sizes = df.sparkSession.sparkContext.broadcast(count_table(lines, "k0", bits_for(8 * df.count())))

    @F.pandas_udf("boolean")
    def several(keys: pd.Series) -> pd.Series:
        return pd.Series(held_by(keys.to_numpy().view(np.uint64), sizes.value) > 1)

    kept = lines.where(several("k0")).withColumn("fields", field_string(F.col("text")))
    k1, k2 = hash128(F.col("stripped"))
    f1, f2 = hash128(F.col("fields"))
    some = F.col("fields").isNotNull()
    return kept.select("id", k1.alias("k1"), k2.alias("k2"), F.when(some, f1).alias("f1"), F.when(some, f2).alias("f2"))


def copy_classes(df: DataFrame, id_col: str = "line_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, first_id) for every member of a class with at least two different ids.

    The classes are pre-aggregated before any row is moved by class, so a class
    that holds a large share of all rows sends one row per task to the
    aggregation; the join back has one row per class on its other side and is
    split by adaptive execution where a class is hot.
    """
    keyed = cut(keyed_lines(df, id_col, text_col, min_chars), "keyed")
    # Lines with the same letters in order form a class; classes that contain lines
    # with the same sorted fields are one class.
    fields = F.when(F.col("f1").isNotNull(), F.struct("f1", "f2"))
    plain = cut(keyed.groupBy("k1", "k2").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.min(fields).alias("f"), F.max(fields).alias("g")), "classes")
    if plain.where("f <> g").limit(1).count():
        # The same letters divided into fields in two ways tie further classes together.
        own = keyed.where("f1 is not null").select("k1", "k2", "f1", "f2").distinct().join(plain.select("k1", "k2", "lo"), ["k1", "k2"])
        ties = own.join(own.groupBy("f1", "f2").agg(F.min("lo").alias("least")), ["f1", "f2"])
        root = components(ties.select(F.col("least").alias("a"), F.col("lo").alias("b")).where("a < b"))
        tied = plain.join(root.withColumnRenamed("id", "lo"), "lo", "left").withColumn("g1", F.coalesce("root", "lo")).withColumn("g2", F.lit(0).cast("bigint"))
    else:
        tied = plain.withColumns({"g1": F.coalesce("f.f1", "k1"), "g2": F.coalesce("f.f2", "k2")})
    tied = tied.select("k1", "k2", "lo", "hi", "g1", "g2")
    whole = tied.groupBy("g1", "g2").agg(F.min("lo").alias("first_id"), F.max("hi").alias("last_id")).where("first_id < last_id")
    of_plain = tied.join(whole, ["g1", "g2"]).select("k1", "k2", "first_id")
    return keyed.join(of_plain, ["k1", "k2"]).select("id", "first_id")


def found(df: DataFrame, id_col: str = "line_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(first_line_id, line_id): one row for each copy, without the first of its class."""
    rows = copy_classes(df, id_col, text_col, min_chars).where("id > first_id").distinct()
    return rows.select(F.col("first_id").alias("first_line_id"), F.col("id").alias("line_id"))


def copy_counts(df: DataFrame, id_col: str = "line_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(line_id, n_copies): the line kept of each class and how many lines the class has."""
    return copy_classes(df, id_col, text_col, min_chars).distinct().groupBy(F.col("first_id").alias("line_id")).agg(F.count(F.lit(1)).alias("n_copies"))
