"""Collecting a corpus: duplicates, a cap for each record and a character quota for each source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import dedup_norm, hash128, reject_reason
from textloom.operators.dedup import first_of_norm, with_priority
from textloom.operators.prefix import exclusive_sum
from textloom.session import cut, drop

RECORD_CAP = 20_000
SHARD_LINES = 500_000
SAMPLE_EVERY = 200_000
#: Lines of this many neighbouring ids are summed up by one task.
BUCKET = 50_000
#: Parts into which a range of ids is divided in the search for a stop.
PARTS = 4096
NO_STOP = (1 << 63) - 1


def bucket_of(order: str = "line_id"):
    return F.floor(F.col(order) / BUCKET)


def quotas(sources: DataFrame, total: float) -> DataFrame:
    """(source, quota, is_last): whole characters a source may add; the last source takes what the others leave."""
    q = sources.where("quota > 0").select(F.col("name").alias("source"), "priority", F.floor(F.col("quota") * F.lit(float(total))).cast("bigint").alias("quota"))
    last = q.agg(F.max("priority").alias("last"))
    return q.crossJoin(last).select("source", "quota", (F.col("priority") == F.col("last")).alias("is_last"))  # one row a source


def keyed(lines: DataFrame) -> DataFrame:
    """Usable lines without their text: line_id, rec_id, source, n, hashes of the normal form."""
    h1, h2 = hash128(dedup_norm(F.col("line")))
    x = lines.where(reject_reason(F.col("line")).isNull() & F.col("source").isNotNull())
    return x.select("line_id", "rec_id", "source", F.length("line").cast("bigint").alias("n"), h1.alias("h1"), h2.alias("h2"))


def with_quota(keys: DataFrame, sources: DataFrame, total: float) -> DataFrame:
    """Keyed lines of sources with a quota, with priority, quota and is_last; lines without a record share record -1."""
    x = with_priority(keys, sources).join(F.broadcast(quotas(sources, total)), "source")  # one row a source
    return x.select("line_id", F.coalesce("rec_id", F.lit(-1)).alias("rec_id"), "source", "priority", "n", "h1", "h2", "quota", "is_last")


def candidates(lines: DataFrame, sources: DataFrame, total: float) -> DataFrame:
    """Usable lines of sources with a quota, without their text: line_id, rec_id, source, priority, n, hashes of the normal form, quota."""
    return with_quota(keyed(lines), sources, total)


def settle_last(x: DataFrame, total: float, taken: str) -> DataFrame:
    """Replaces the quota of the last source by what the others, as far as ``taken``, leave of the total."""
    others = x.where(f"{taken} and not is_last").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("others"))
    left = F.greatest(F.floor(F.lit(float(total))).cast("bigint") - F.col("others"), F.lit(0))
    return x.crossJoin(F.broadcast(others)).withColumn("limit", F.when(F.col("is_last"), left).otherwise(F.col("quota"))).drop("others")  # one row


def collect_staged(lines: DataFrame, sources: DataFrame, total: float, record_cap: int = RECORD_CAP) -> DataFrame:
    """(line_id, source, n): first duplicates go, then records are capped, then sources stop at their quota.

    One pass; it differs from ``collect_exact`` where a line that a cap or quota
    turned away has a later copy. A line counts while the sum before it is below the limit.
    """
    kept = cut(candidates(lines, sources, total), "candidates")  # running sums read their input several times
    x = first_of_norm(kept.withColumn("norm", F.struct("h1", "h2")), ["priority", "line_id"]).drop("norm")
    x = cut(exclusive_sum(x, ["source", "rec_id"], bucket_of(), ["line_id"], "n", "in_record").where(F.col("in_record") < record_cap), "within-records")
    drop(kept)
    x = exclusive_sum(x, ["source"], bucket_of(), ["line_id"], "n", "in_source")
    x = x.withColumn("within", F.col("in_source") < F.col("quota"))
    return settle_last(x, total, "within").where("in_source < limit").select("line_id", "source", "n")


class Stops:
    """Where each source stops: its lines with an id below ``at`` are taken, and have ``taken`` characters.

    ``limits`` are the characters that a source (by priority) may still add, ``had``
    what it has already; the last source takes what the others leave of ``total``.
    """

    def __init__(self, limits: dict[int, int], had: dict[int, int], last: int | None, total: int) -> None:
        self.limits, self.had, self.last, self.total = limits, had, last, total
        self.at: dict[int, int] = dict.fromkeys(limits, NO_STOP)

    def accepted(self, of: Column) -> Column:
        """Of the first lines of a normal form in each source, in order of priority, the one that is taken; null for none."""
        stop = F.create_map(*(F.lit(v) for kv in sorted(self.at.items()) for v in kv))
        return F.get(F.filter(of, lambda x: x.line_id < stop[x.priority]), F.lit(0))

    def search(self, offered: DataFrame, ranges: dict[int, tuple[int, int]]) -> dict[int, int]:
        """The stop of every source, given all lines (priority, line_id, n) that no earlier source takes.

        A sum by ``PARTS`` equal parts of a source's ids tells in which part the limit is
        reached; that part is divided again until it is one line. Only the sums come
        to the driver, and there is no order or spread of ids that would make them more.
        """
        low, width, base, open_ = {}, {}, dict.fromkeys(self.limits, 0), set(self.limits)
        for p, (lo, hi) in ranges.items():
            low[p], width[p] = lo, max(1, -(-(hi - lo + 1) // PARTS))
        stop, taken = dict.fromkeys(self.limits, NO_STOP), {}
        waiting = None
        while open_:
            asked = {p: (low[p], width[p]) for p in open_ if p in ranges}
            sums = self.sums(offered, asked) if asked else {}
            if waiting is not None:
                sums[self.last] = waiting
            for p in sorted(open_, key=lambda p: p == self.last):
                limit = self.limits[p]
                if p == self.last:
                    others = [q for q in self.limits if q != p]
                    if any(q in open_ for q in others):
                        waiting = sums.get(p, [])  # its limit isn't known yet
                        continue
                    waiting = None
                    limit = self.total - sum(self.had.get(q, 0) + taken[q] for q in others) - self.had.get(p, 0)
                if limit <= 0:
                    stop[p], taken[p] = -NO_STOP, 0
                    open_.discard(p)
                    continue
                total = base[p]
                for part, n in sums.get(p, []):
                    if total + n >= limit:
                        at = low[p] + part * width[p]
                        if width[p] == 1:
                            stop[p], taken[p] = at + 1, total + n
                            open_.discard(p)
                        else:
                            base[p], low[p], width[p] = total, at, -(-width[p] // PARTS)
                        break
                    total += n
                else:
                    taken[p] = total
                    open_.discard(p)
        return stop

    @staticmethod
    def sums(offered: DataFrame, asked: dict[int, tuple[int, int]]) -> dict[int, list[tuple[int, int]]]:
        table = F.create_map(*(x for p, (lo, w) in sorted(asked.items()) for x in (F.lit(p), F.struct(F.lit(lo).cast("bigint").alias("lo"), F.lit(w).cast("bigint").alias("w")))))
        x = offered.withColumn("of", table[F.col("priority")]).where("of is not null")
        x = x.withColumn("part", F.expr("(line_id - of.lo) div of.w")).where((F.col("line_id") >= F.col("of.lo")) & (F.col("part") < PARTS))
        out: dict[int, list[tuple[int, int]]] = {}
        for r in x.groupBy("priority", "part").agg(F.sum("n").alias("n")).collect():
            out.setdefault(r.priority, []).append((r.part, r.n))
        return {p: sorted(v) for p, v in out.items()}


def classes(x: DataFrame) -> DataFrame:
    """(of): for every normal form the first line of each source that has it, in order of priority: as many entries as sources at most."""
    first = x.groupBy("h1", "h2", "priority").agg(F.min(F.struct("line_id", "n", "rec_id")).alias("f"))
    return first.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("priority", "f.line_id", "f.n", "f.rec_id"))).alias("of"))


def settle(forms: DataFrame, stops: Stops) -> None:
    """Sets the stops to those of one sequential pass.

    What a source takes depends on the stops of earlier sources only, so the k-th
    round settles the k-th source; the rounds end when no stop changes.
    """
    ranges = {r.priority: (r.lo, r.hi) for r in forms.select(F.explode("of").alias("x")).groupBy("x.priority").agg(F.min("x.line_id").alias("lo"), F.max("x.line_id").alias("hi")).collect()}
    while True:
        taken = stops.accepted(F.col("of"))
        offered = forms.withColumn("p", taken.priority).select(F.explode(F.filter("of", lambda x: F.col("p").isNull() | (x.priority <= F.col("p")))).alias("x")).select("x.*")
        new = stops.search(offered, ranges)
        if new == stops.at:
            return
        stops.at = new


def capped(x: DataFrame, taken: DataFrame, record_cap: int) -> DataFrame:
    """The lines of ``x`` before which their record already has ``record_cap`` characters among the lines taken."""
    y = x.join(taken.select("line_id", F.lit(True).alias("in")), "line_id", "left").withColumn("kept", F.when(F.col("in"), F.col("n")).otherwise(F.lit(0)))
    y = exclusive_sum(y, ["priority", "rec_id"], bucket_of(), ["line_id"], "kept", "in_record")
    return y.where(F.col("in_record") >= record_cap).select("line_id")


def sequential(x: DataFrame, sources: DataFrame, total: float, had: dict[str, int], record_cap: int) -> DataFrame:
    """(line_id, source, n): what one pass over the candidates in order takes, when sources already ``had`` some characters."""
    registry = quotas(sources, total).join(sources.select(F.col("name").alias("source"), "priority"), "source").collect()  # one row a source
    limits = {r.priority: r.quota - had.get(r.source, 0) for r in registry}
    last = next((r.priority for r in registry if r.is_last), None)
    names = {r.priority: r.source for r in registry}
    if not limits:
        return x.sparkSession.createDataFrame([], "line_id bigint, source string, n bigint")
    kept = cut(x.select("line_id", "rec_id", "priority", "n", "h1", "h2"), "candidates")
    # Only in records that have more than the cap in all can a line be turned away by it.
    large = cut(kept.groupBy("priority", "rec_id").agg(F.sum("n").alias("all")).where(F.col("all") >= record_cap).select("priority", "rec_id"), "large")
    within = cut(kept.join(large, ["priority", "rec_id"], "left_semi"), "within") if large.limit(1).count() else None
    away = None
    while True:
        forms = cut(classes(kept if away is None else kept.join(away, "line_id", "left_anti")), "forms")
        stops = Stops(limits, {r.priority: had.get(r.source, 0) for r in registry}, last, int(total))
        settle(forms, stops)
        taken = forms.select(stops.accepted(F.col("of")).alias("x")).where("x is not null").select("x.*")
        if within is None:
            break
        # The cap's own fixpoint: whether it turns a line away depends on earlier lines only.
        now = cut(capped(within, taken, record_cap), "capped")
        same = away is not None and now.count() == away.count() == now.join(away, "line_id").count()
        if same:
            drop(now)
            break
        if away is not None:
            drop(away)
        drop(forms)
        away = now
    drop(kept, large)
    name = F.create_map(*(F.lit(v) for kv in names.items() for v in kv))
    return taken.select("line_id", name[F.col("priority")].alias("source"), "n")


def collect_exact(lines: DataFrame, sources: DataFrame, total: float, record_cap: int = RECORD_CAP) -> DataFrame:
    """(line_id, source, n) exactly as one pass over the lines in order would choose them.

    A line is taken if no earlier line with its normal form was, and if what was
    taken before it in its record and its source is below the limits. Lines are
    first brought to one row for each normal form; a quota cuts a source off at one
    line, so the state of the search is one number a source, not a mark on every line.
    """
    return sequential(candidates(lines, sources, total), sources, total, {}, record_cap)


def collect_resume(lines: DataFrame, sources: DataFrame, total: float, already: DataFrame, record_cap: int = RECORD_CAP) -> DataFrame:
    """Goes on after ``already`` (line_id, source, n): what a restarted run adds.

    Records up to the last one taken of a source are skipped (of lines without a
    record those up to the last line taken); copies of what was taken stay out,
    and quotas go on from there. The last source takes what the others, in both
    runs together, leave of the total. Together with an interrupted run's lines
    this is what the run would have taken.
    """
    already = cut(already, "already")
    keys = cut(keyed(lines), "keyed")  # lines are cleaned and hashed once
    seen = keys.join(already.select("line_id"), "line_id", "left_semi")
    done = seen.groupBy("source").agg(F.max("rec_id").alias("done"), F.max("line_id").alias("last_line"))
    had = {r.source: r.had for r in already.groupBy("source").agg(F.sum("n").alias("had")).collect()}  # one row a source
    rest = keys.join(F.broadcast(done), "source", "left")
    rest = rest.where(F.col("last_line").isNull() | F.coalesce(F.col("rec_id") > F.col("done"), F.col("line_id") > F.col("last_line"))).drop("done", "last_line")
    x = with_quota(rest.join(seen.select("h1", "h2"), ["h1", "h2"], "left_anti"), sources, total)
    out = sequential(x, sources, total, had, record_cap)
    drop(already, keys)
    return out


def shard_assignment(lines: DataFrame, shard_lines: int = SHARD_LINES) -> DataFrame:
    """(line_id, source, shard): numbered files of at most ``shard_lines`` lines a source, in order."""
    x = lines.where("source is not null").select("line_id", "source", F.lit(1).alias("one"))
    x = exclusive_sum(x, ["source"], bucket_of(), ["line_id"], "one", "before")
    return x.select("line_id", "source", F.format_string("%s_%04d", "source", F.floor(F.col("before") / shard_lines) + 1).alias("shard"))


def periodic_samples(lines: DataFrame, every: int = SAMPLE_EVERY) -> DataFrame:
    """(line_id, source): every so-manieth line of a source."""
    x = exclusive_sum(lines.where("source is not null").select("line_id", "source", F.lit(1).alias("one")), ["source"], bucket_of(), ["line_id"], "one", "before")
    return x.where((F.col("before") + 1) % every == 0).select("line_id", "source")


def reject_counts(lines: DataFrame) -> DataFrame:
    """(source, reason, lines, chars), usable lines under 'ok'."""
    reason = F.coalesce(reject_reason(F.col("line")), F.lit("ok"))
    return lines.groupBy("source", reason.alias("reason")).agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("line")).cast("bigint").alias("chars"))


def outcome_counts(lines: DataFrame, sources: DataFrame, total: float, taken: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """(source, outcome, lines): what became of every line read of a source with a quota.

    read counts all; a rejected line counts under its reason, a taken one under
    accepted, one whose form was taken before it under dup, and one that a record's
    cap or the source's quota turned away under limit. ``records`` (source, kept)
    adds how many records were left out before (record_filtered).
    """
    h1, h2 = hash128(dedup_norm(F.col("line")))
    x = with_priority(lines.where("source is not null"), sources).join(F.broadcast(quotas(sources, total).select("source")), "source")  # one row a source
    x = x.select("line_id", "source", "priority", reject_reason(F.col("line")).alias("reason"), h1.alias("h1"), h2.alias("h2"))
    x = x.join(taken.select("line_id", F.lit(True).alias("in")), "line_id", "left")
    # One line of a form is taken at most, so the other side has one row a form.
    held = x.where("in").select("h1", "h2", F.struct("priority", "line_id").alias("by"))
    x = x.join(held, ["h1", "h2"], "left")
    outcome = F.coalesce("reason", F.when(F.col("in"), "accepted").when(F.col("by") < F.struct("priority", "line_id"), "dup").otherwise("limit"))
    counts = x.groupBy("source", outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("lines"))
    out = counts.unionByName(counts.groupBy("source").agg(F.sum("lines").alias("lines")).withColumn("outcome", F.lit("read")))
    if records is not None:
        out = out.unionByName(records.where("not kept").groupBy("source").agg(F.count(F.lit(1)).alias("lines")).withColumn("outcome", F.lit("record_filtered")))
    return out


def source_summary(taken: DataFrame, sources: DataFrame, total: float) -> DataFrame:
    """(source, target, lines, chars, share): what every registered source gave of its target."""
    got = taken.groupBy("source").agg(F.count(F.lit(1)).alias("lines"), F.sum("n").alias("chars"))
    x = quotas(sources, total).join(got, "source", "left").select("source", F.col("quota").alias("target"), F.coalesce("lines", F.lit(0)).alias("lines"), F.coalesce("chars", F.lit(0)).alias("chars"))
    return x.withColumn("share", F.round(F.col("chars") / F.when(F.col("target") > 0, F.col("target")), 6))
