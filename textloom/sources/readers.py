"""Reading labelled sources: record tables, lists of configurations, and folders of line files."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import clip, collapse_space
from textloom.operators.lines import field_profile

#: Parts into which a range of ids is divided when records are counted.
PARTS = 4096
log = logging.getLogger(__name__)


def decoded(value: Column) -> Column:
    """Bytes that aren't UTF-8 become U+FFFD."""
    return F.make_valid_utf8(value)


def read_line_files(spark: SparkSession, path: str) -> DataFrame:
    """(source, shard, line) of text files named ``<source>_<number>.txt``, empty lines left out."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.[^.]*$", 1)
    x = spark.read.text(path).select(decoded(F.col("value")).alias("line"), name.alias("shard"))
    return x.where(F.length("line") > 0).select(F.regexp_replace("shard", "_[^_]*$", "").alias("source"), "shard", "line")


def read_records(spark: SparkSession, path: str, kind: str = "parquet", drop: list[str] | None = None, **options: str) -> DataFrame:
    """A record table (parquet, json, orc, csv); columns in ``drop`` are never read from columnar files."""
    return spark.read.format(kind).options(**options).load(path).drop(*(drop or []))


def read_sources(spark: SparkSession, configs: list[dict]) -> tuple[DataFrame, list[tuple[str, str]]]:
    """All configurations of all sources in order as one table, and those that couldn't be opened.

    A configuration has source, config, path, text (the text column), and maybe kind and already (records to skip, in order of ``order``).
    Columns: priority, config_no, source, config, texts (array). A failure is logged and skipped.
    """
    parts, failed = [], []
    priority = {s: i for i, s in enumerate(dict.fromkeys(c["source"] for c in configs))}
    for no, c in enumerate(configs):
        try:
            x = read_records(spark, c["path"], c.get("kind", "parquet"))
            if c.get("already"):
                x = skip_done(x, c["order"], c["already"])
            text = F.col(c["text"]) if dict(x.dtypes)[c["text"]].startswith("array") else F.array(c["text"])
            parts.append(x.select(F.lit(priority[c["source"]]).alias("priority"), F.lit(no).alias("config_no"), F.lit(c["source"]).alias("source"), F.lit(c.get("config", "default")).alias("config"), text.alias("texts")))
        except Exception as e:  # noqa: BLE001
            log.warning("%s/%s can't be opened: %s", c["source"], c.get("config", "default"), str(e)[:200])
            failed.append((c["source"], c.get("config", "default")))
    empty = spark.createDataFrame([], "priority int, config_no int, source string, config string, texts array<string>")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts, empty), failed


def probe(spark: SparkSession, configs: list[dict], rows: int = 50, previews: int = 2) -> tuple[DataFrame, DataFrame]:
    """(source, config, field, kind, records, total_chars, mean_chars, is_text, previews) over the first rows of every configuration, and (source, config, error) of those that failed.

    A look at what there is before a run: ``rows`` and ``previews`` bound what is read, on purpose.
    """
    parts, failed = [], []
    for c in configs:
        names = (F.lit(c["source"]).alias("source"), F.lit(c.get("config", "default")).alias("config"))
        try:
            x = read_records(spark, c["path"], c.get("kind", "parquet")).limit(rows)
            profile = field_profile(x)
            shown = [f for f, t in x.dtypes if t in ("string", "array<string>")]
            first = x.select(*(clip(collapse_space(F.col(f) if t == "string" else F.array_join(f, " "))).alias(f) for f, t in x.dtypes if f in shown)).limit(previews).collect()
            seen = spark.createDataFrame([(f, [r[f] for r in first if r[f] is not None]) for f in shown], "field string, previews array<string>")
            parts.append(profile.join(seen, "field").select(*names, *profile.columns, "previews"))
        except Exception as e:  # noqa: BLE001
            failed.append((c["source"], c.get("config", "default"), str(e)[:200]))
    empty = spark.createDataFrame([], "source string, config string, field string, kind string, records bigint, total_chars bigint, mean_chars double, is_text boolean, previews array<string>")
    return reduce(lambda a, b: a.unionByName(b), parts, empty), spark.createDataFrame(failed, "source string, config string, error string")


def skip_done(records: DataFrame, order: str, already: int) -> DataFrame:
    """Records after the first ``already`` in order (an integer column without nulls).

    The last record to skip is found by counting in ranges of ids that get narrower:
    some thousand counts come to the driver, whatever ``already`` is, and nothing is sorted.
    """
    if already <= 0:
        return records
    ids = records.select(F.col(order).cast("bigint").alias("i"))
    lo, hi = ids.agg(F.min("i"), F.max("i")).first()
    left = already
    while lo is not None and lo < hi:
        width = -(-(hi - lo + 1) // PARTS)
        counts = ids.where(F.col("i").between(lo, hi)).groupBy(F.expr(f"(i - {lo}) div {width}").alias("part")).count().collect()
        for part, n in sorted((r.part, r["count"]) for r in counts):
            if n >= left:
                lo, hi = lo + part * width, min(hi, lo + (part + 1) * width - 1)
                break
            left -= n
        else:
            return records.limit(0)
    return records.where(F.col(order) > F.lit(lo))


def batches(df: DataFrame, rows: int = 10_000):
    """Rows in lists of at most ``rows``, fetched partition by partition."""
    held = []
    for r in df.toLocalIterator(prefetchPartitions=True):
        held.append(r)
        if len(held) == rows:
            yield held
            held = []
    if held:
        yield held


def schema_table(df: DataFrame) -> DataFrame:
    """(position, field, kind)."""
    return df.sparkSession.createDataFrame([(i, c, t) for i, (c, t) in enumerate(df.dtypes)], "position int, field string, kind string")
