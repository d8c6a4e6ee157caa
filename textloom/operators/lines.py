"""From records to clean lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import WHITESPACE, collapse_space, once

LIMIT = 2000
# Limits of a usable web record.
MIN_LANGUAGE_SCORE, MAX_CLUSTER = 0.90, 1000
SENTENCE_END = f"(?<=[.!?…]){WHITESPACE}"


def as_list(df: DataFrame, text_col: str) -> Column:
    """A text column as an array, whether it is a string or an array of strings."""
    return F.col(text_col) if dict(df.dtypes)[text_col].startswith("array") else F.array(text_col)


def atoms(text: Column, limit: int) -> Column:
    """(text, fresh, n, bare) of the sentences of a text; one above the limit is a run of fragments, each marked fresh.

    A fragment ends before the last blank within the limit, or at the limit where there is none.
    """
    fragment = rf"(?s)(?:\A|{WHITESPACE[:-1]}*+)(.{{1,{limit}}}\z|.{{1,{limit - 1}}}(?= )|.{{{limit}}})"
    of = lambda sentence: F.transform(
        F.when(F.length(sentence) <= limit, F.array(sentence)).otherwise(F.regexp_extract_all(sentence, F.lit(fragment), F.lit(1))),
        lambda x: F.struct(x.alias("text"), (F.length(sentence) > limit).alias("fresh"), F.length(x).alias("n"), F.length(F.trim(x)).alias("bare")),
    )
    return F.filter(F.flatten(F.transform(F.split(text, SENTENCE_END), of)), lambda x: x.n > 0)


def split_long(text: Column, limit: int = LIMIT) -> Column:
    """The pieces of a text as an array: cut where sentences end, or at blanks where a sentence is too long.

    The places at which pieces start are worked out from the lengths of the atoms
    alone; the pieces are slices between them. A text within the limit stays as it
    is. Everything stays in the JVM.
    """

    def place(state: Column, x: Column) -> Column:
        held = F.when(state.n > 0, state.n + 1 + x.n).otherwise(F.lit(limit + 1))
        joins = ~x.fresh & (held <= limit)
        return F.struct(
            F.when(joins, state.starts).otherwise(F.concat(state.starts, F.array(state.at))).alias("starts"),
            F.when(joins, held).when(x.fresh | (x.n == limit), x.n).otherwise(x.bare).alias("n"), (state.at + 1).alias("at"),
        )

    def pieces(a: Column) -> Column:
        first = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("n"), F.lit(1).alias("at"))
        starts = F.aggregate(a, first, place, lambda s: s.starts)
        return F.transform(starts, lambda lo, k: F.array_join(F.slice(F.transform(a, lambda x: x.text), lo, F.coalesce(F.get(starts, k + 1), F.size(a) + 1) - lo), " "))

    return F.when(F.length(text) <= limit, F.array(text)).otherwise(F.flatten(F.transform(F.array(atoms(text, limit)), pieces)))


def explode_lines(df: DataFrame, keys: list[str], text_col: str = "text", limit: int | None = LIMIT) -> DataFrame:
    """(keys..., part_no, raw_no, chunk_no, line): every line of every record, cleaned.

    Null parts give nothing; an empty part gives one empty line. With ``limit``
    None long lines stay whole.
    """
    x = df.select(*keys, F.posexplode(as_list(df, text_col)).alias("part_no", "part")).where("part is not null")
    x = x.select(*keys, "part_no", F.posexplode(F.split("part", "\n")).alias("raw_no", "raw"))
    if limit is None:
        return x.select(*keys, "part_no", "raw_no", F.lit(0).alias("chunk_no"), once(collapse_space(F.col("raw"))).alias("line"))
    x = x.select(*keys, "part_no", "raw_no", F.posexplode(split_long(F.col("raw"), limit)).alias("chunk_no", "raw"))
    return x.select(*keys, "part_no", "raw_no", "chunk_no", once(collapse_space(F.col("raw"))).alias("line"))


def is_usable() -> Column:
    """A sure language and no mass copies; a missing value passes. Written so that both limits reach the scan."""
    return (F.col("language_score").isNull() | (F.col("language_score") >= MIN_LANGUAGE_SCORE)) & (F.col("minhash_cluster_size").isNull() | (F.col("minhash_cluster_size") <= MAX_CLUSTER))


def usable_records(df: DataFrame) -> DataFrame:
    """Web records that are usable."""
    return df.where(is_usable())


def first_text(*columns: str) -> Column:
    """The first column that isn't null or blank, stripped."""
    return F.coalesce(*(F.nullif(F.trim(F.col(c)), F.lit("")) for c in columns))


def every_text(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Every listed column of a record becomes a line of its own; null and blank ones are left out."""
    x = df.select(*keys, F.posexplode(F.array(*columns)).alias("field_no", "text")).where("text is not null")
    return x.select(*keys, "field_no", once(collapse_space(F.col("text"))).alias("line")).where("line <> ''")


def field_profile(df: DataFrame) -> DataFrame:
    """(field, kind, records, total_chars, mean_chars, is_text): every string column, the one with most text marked."""
    fields = [(c, t) for c, t in df.dtypes if t in ("string", "array<string>")]
    size = [F.length(c) if t == "string" else F.aggregate(F.filter(c, lambda x: x.isNotNull()), F.lit(0), lambda n, x: n + F.length(x)) for c, t in fields]
    one = df.select(*(F.struct(F.sum(s.cast("bigint")).alias("t"), F.count(c).alias("n")).alias(f"f{i}") for i, ((c, _), s) in enumerate(zip(fields, size))))
    rows = F.array(*(F.struct(F.lit(c).alias("field"), F.lit(t).alias("kind"), F.col(f"f{i}.n").alias("records"), F.coalesce(F.col(f"f{i}.t"), F.lit(0)).alias("total_chars")) for i, (c, t) in enumerate(fields)))
    x = one.select(F.array_sort(rows, lambda a, b: F.when(a.total_chars > b.total_chars, -1).when(a.total_chars < b.total_chars, 1).when(a.field < b.field, -1).otherwise(1)).alias("rows"))
    x = x.select(F.posexplode("rows").alias("rank", "r"))
    return x.select("r.field", "r.kind", "r.records", "r.total_chars", F.round(F.col("r.total_chars") / F.when(F.col("r.records") > 0, F.col("r.records")), 6).alias("mean_chars"), (F.col("rank") == 0).alias("is_text"))
