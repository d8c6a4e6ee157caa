"""Running sums that no single task has to make for a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Buckets of one range, as a power of two.
SPAN_BITS = 20


def exclusive_sum(df: DataFrame, keys: list[str], bucket: Column, order: list[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the same keys that come before.

    ``bucket`` must rise with ``order``. Sums by bucket are made first (with partial
    aggregation), running sums over buckets give each bucket its base, and running
    sums over rows stay inside one bucket. Buckets are summed up in the same way in
    ranges of ``SPAN``, so that with sparse order values, where hardly two rows share
    a bucket, no task sees all buckets of a key either. Keys must not be null.
    """
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    x = df.withColumn("_b", bucket)
    sums = x.groupBy(*keys, "_b").agg(F.sum(value).alias("_s")).withColumn("_t", F.shiftright(F.col("_b").cast("bigint"), SPAN_BITS))
    tops = sums.groupBy(*keys, "_t").agg(F.sum("_s").alias("_s"))
    tops = tops.select(*keys, "_t", F.coalesce(F.sum("_s").over(before(*keys).orderBy("_t")), F.lit(0)).alias("_top"))
    base = sums.withColumn("_base", F.coalesce(F.sum("_s").over(before(*keys, "_t").orderBy("_b")), F.lit(0))).join(tops, [*keys, "_t"])
    base = base.select(*keys, "_b", (F.col("_base") + F.col("_top")).alias("_base"))
    x = x.withColumn("_in", F.coalesce(F.sum(value).over(before(*keys, "_b").orderBy(*order)), F.lit(0)))
    return x.join(base, [*keys, "_b"]).withColumn(name, F.col("_base") + F.col("_in")).drop("_b", "_base", "_in")
