"""Problem 4: mixing sources to target weights.

Method: a time-varying curriculum. A schedule gives every source a weight that
may change over the run: pieces (source, t0, w0, t1, w1), linear from w0 at t0 to w1 at t1,
where t runs from 0 to 1. The integral of a source's weight times the size of the
mix is its demand. A source contributes its demand, or, where that is more than
its size times the most repeats, all it may. The documents of a source, repeated
as often as needed, stand one after the other in a fixed random order; the place
where a document begins is looked up in the inverse of the cumulative demand, and
that is its position in training. Range-sorting all documents by position gives
the mix, which follows the weights at every moment.

A plain quota is the schedule with one constant piece. Whether a source falls short
in a run is read from the same inverse: what it may add, its size times the most
repeats, is looked up in its cumulative demand, and the position found is where the
run would use it up; a source that lasts to the end has none.

Defined results: of several saves of a run and source the last with a count
stands, of saves at the same time the largest count; names are compared without
regard to case and surrounding blanks; a source without a save has 0; quotas that
are null or not above 0 take no part; documents with null or empty text have no
position; repeated rows are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import hash_fraction
from textloom.session import cut

PIECES = "source string, t0 double, w0 double, t1 double, w1 double"
#: Rows of a bucket within which running sums are made by one task.
BUCKET_ROWS = 20_000


def name_key(name: Column) -> Column:
    """A source name without letter case (i with and without dot count as one letter, as in Turkish capitals) and surrounding blanks."""
    return F.trim(F.lower(F.translate(name, "İIı", "iii")))


def constant_schedule(sources: DataFrame) -> DataFrame:
    """The schedule of fixed quotas: one piece a source with a quota above 0."""
    q = F.col("quota").cast("double")
    return sources.where(q > 0).groupBy(F.col("name").alias("source")).agg(F.max(q).alias("w0")).select("source", F.lit(0.0).alias("t0"), "w0", F.lit(1.0).alias("t1"), F.col("w0").alias("w1"))


def shifting_schedule(sources: DataFrame, most: float = 0.8, start: float = 0.2, end: float = 0.8) -> DataFrame:
    """The registry's quotas as a curriculum: sources that come first in it fade out, those that come last grow.

    A weight stands still until ``start``, moves evenly until ``end``, and stands still
    again; over the whole run it comes to the quota.
    """
    q = sources.where("quota > 0").groupBy(F.col("name").alias("source")).agg(F.max(F.col("quota").cast("double")).alias("q"), F.min("priority").alias("priority"))
    rank = F.row_number().over(Window.orderBy("priority", "source"))  # a registry is small, given by hand
    n = q.agg(F.count(F.lit(1)).alias("n"))
    q = q.withColumn("k", rank - 1).crossJoin(F.broadcast(n))  # one row
    tilt = F.lit(most) * (2 * F.col("k") / F.greatest(F.col("n") - 1, F.lit(1)) - 1)
    lo, hi = F.col("q") * (1 - tilt), F.col("q") * (1 + tilt)
    parts = [(0.0, lo, start, lo), (start, lo, end, hi), (end, hi, 1.0, hi)]
    return q.select("source", F.inline(F.array(*(F.struct(F.lit(a).alias("t0"), v.alias("w0"), F.lit(b).alias("t1"), w.alias("w1")) for a, v, b, w in parts))))


def piece_areas(schedule: DataFrame) -> DataFrame:
    """Every piece with its area, the area of the source's pieces before it, and that of the next one; null for the last."""
    p = schedule.where("t1 > t0").withColumn("area", (F.col("w0") + F.col("w1")) / 2 * (F.col("t1") - F.col("t0")))
    # A schedule is small: its rows are sources times pieces, given by hand.
    order = Window.partitionBy("source").orderBy("t0")
    p = p.withColumn("before", F.coalesce(F.sum("area").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    return p.withColumn("end", F.lead("before").over(order))


def reached(p: Column, rest: Column) -> Column:
    """The time at which a piece has added the area ``rest``: the inverse of w0 x + (w1 - w0) x^2 / (2 width)."""
    width = p.t1 - p.t0
    slope = (p.w1 - p.w0) / width
    x = F.when(F.abs(slope) < 1e-12, rest / p.w0).otherwise((F.sqrt(F.greatest(p.w0 * p.w0 + 2 * slope * rest, F.lit(0.0))) - p.w0) / slope)
    return p.t0 + F.least(F.greatest(x, F.lit(0.0)), width)


def collected(state: DataFrame) -> DataFrame:
    """(run_id, key, chars): the last count saved of every run and source."""
    s = state.where("chars is not null and run_id is not null and source is not null")
    last = s.groupBy("run_id", name_key(F.col("source")).alias("key")).agg(F.max(F.struct("saved_at", "chars")).alias("last"))
    return last.select("run_id", "key", F.col("last.chars").alias("chars"))


def plan(runs: DataFrame, schedule: DataFrame, state: DataFrame) -> DataFrame:
    """One row for each run and source of the schedule: what is wanted, what there is, what is used."""
    piece = F.struct("t0", "t1", "w0", "w1", "before", "area")
    demand = piece_areas(schedule).groupBy("source").agg(F.sum("area").alias("weight"), F.sort_array(F.collect_list(piece)).alias("pieces"))
    # The registry, a few sources given by hand, goes to every run as one row holding an array.
    registry = demand.agg(F.sort_array(F.collect_list(F.struct("source", "weight", "pieces"))).alias("registry"))
    wanted = runs.select("run_id", "total_chars", "max_repeat").distinct().crossJoin(F.broadcast(registry)).select("run_id", "total_chars", "max_repeat", F.inline("registry"))
    got = collected(state)
    x = wanted.withColumn("key", name_key(F.col("source"))).join(got, ["run_id", "key"], "left").withColumn("chars", F.coalesce("chars", F.lit(0)))
    x = x.withColumn("target", F.col("weight") * F.col("total_chars")).withColumn("most", F.col("chars") * F.col("max_repeat"))
    # The piece in which the cumulative demand passes what there is, in characters as the demand is.
    x = x.withColumn("piece", F.get(F.filter("pieces", lambda p: F.col("most") < (p.before + p.area) * F.col("total_chars")), F.lit(0)))
    x = x.withColumn("dry_at", F.when(F.col("piece").isNotNull(), reached(F.col("piece"), F.col("most") / F.col("total_chars") - F.col("piece.before"))))
    x = x.withColumn("short", F.col("piece").isNotNull()).withColumn("used", F.least(F.col("most").cast("double"), F.col("target")))
    used_all = F.sum("used").over(Window.partitionBy("run_id"))  # as many rows as the registry has sources
    return x.select(
        "run_id", "source", "weight", "target", "chars", "most", "used", "short", "dry_at",
        F.when(F.col("chars") > 0, F.col("used") / F.col("chars")).alias("repeats"),
        F.when(used_all > 0, F.col("used") / used_all).alias("share"),
    )


def found(runs: DataFrame, sources: DataFrame, state: DataFrame) -> DataFrame:
    return plan(runs, constant_schedule(sources), state).where("short").select("run_id", "source")


def report(runs: DataFrame, sources: DataFrame, state: DataFrame) -> DataFrame:
    """(run_id, source, quota, chars, target, used, share, short, dry_at) with shares as they are reached; dry_at is where in the run a source is used up."""
    p = plan(runs, constant_schedule(sources), state)
    return p.select("run_id", "source", F.col("weight").alias("quota"), "chars", F.round("target", 3).alias("target"), F.round("used", 3).alias("used"), F.round("share", 9).alias("share"), "short", F.round("dry_at", 6).alias("dry_at"))


def running_sum(docs: DataFrame, total_rows: int) -> DataFrame:
    """Adds ``start``: the size of all documents of the source before this one, in an order by hash.

    Two levels: sums by bucket of the hash first, then running sums inside buckets of
    about BUCKET_ROWS rows. No task sees a source as a whole.
    """
    buckets = max(1, -(-total_rows // BUCKET_ROWS))
    d = docs.withColumn("h", hash_fraction(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "order|")).withColumn("bucket", F.floor(F.col("h") / F.lit(2.0**60) * buckets).cast("bigint"))
    sums = d.groupBy("key", "bucket").agg(F.sum("size").alias("of"))
    w = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("key", "bucket", F.coalesce(F.sum("of").over(w), F.lit(0)).alias("base"))
    inside = Window.partitionBy("key", "bucket").orderBy("h", "doc_id", "copy").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return d.join(sums, ["key", "bucket"]).withColumn("start", F.col("base") + F.col("inner")).drop("h", "bucket", "base", "inner")


def positions(docs: DataFrame, schedule: DataFrame, total: float, max_repeat: int, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, source, epoch, position), sorted by position: the order in which the mix is read.

    A source that falls short is spread over the whole run instead of ending early.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), name_key(F.col(source_col)).alias("key"), F.length(text_col).cast("bigint").alias("size"), F.monotonically_increasing_id().alias("copy")).where("size > 0 and key is not null")
    d = cut(d, "sizes")
    pieces = cut(piece_areas(schedule).withColumn("key", name_key(F.col("source"))), "pieces")
    demand = pieces.groupBy("key").agg(F.first("source").alias("source"), (F.sum("area") * F.lit(float(total))).alias("demand"))
    have = d.groupBy("key").agg(F.sum("size").alias("have")).join(demand, "key")
    have = have.withColumn("used", F.least("demand", F.col("have") * F.lit(float(max_repeat))))
    placed = running_sum(d, d.count()).join(F.broadcast(have), "key")  # one row a source of the schedule
    last = F.ceil((F.col("used") - F.col("start")) / F.col("have")).cast("int") - 1
    placed = placed.where(F.col("start") < F.col("used")).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.greatest(last, F.lit(0)))))
    # The place in the demand of the whole source, as an area under its weights.
    placed = placed.withColumn("at", (F.col("start") + F.col("epoch") * F.col("have")) / F.col("used") * F.col("demand") / F.lit(float(total)))
    p = F.broadcast(pieces.select("key", F.struct("t0", "t1", "w0", "w1", "before").alias("p"), "before", "end"))
    # A piece ends where the next one begins, so that every place lies in exactly one.
    hit = placed.join(p, "key").where((F.col("at") >= F.col("before")) & (F.col("end").isNull() | (F.col("at") < F.col("end"))))
    out = hit.withColumn("position", reached(F.col("p"), F.col("at") - F.col("before")))
    return out.select("doc_id", "source", "epoch", "position").orderBy("position", "doc_id", "epoch")
