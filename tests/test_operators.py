import random
import re

import pytest
from pyspark.sql import functions as F

from textloom.functions.text import collapse_space
from textloom.operators import collect, dedup, lines, pieces, prefix, report, sampling, split
from textloom.plans import corpus
from textloom.sources import readers

LINE = "line_id bigint, rec_id bigint, source string, config string, shard string, line_no int, line string, extra int"


def make(spark, rows):
    """rows: (line_id, rec_id, source, line)"""
    return spark.createDataFrame([(i, r, s, "c", f"{s}_0001", i % 1000, t, 1) for i, r, s, t in rows], LINE)


def pieces_of(spark, texts, limit):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.p for r in df.select("i", lines.split_long(F.col("t"), limit).alias("p")).orderBy("i").collect()]


def test_pieces_of_long_texts(spark):
    r = random.Random(1)
    texts = ["".join(r.choice(["a", "bb", " ", ". ", "! ", "  ", "ccccc", "…\t"]) for _ in range(r.randint(0, 160))) for _ in range(300)]
    texts = [t.strip() for t in texts]
    for text, got in zip(texts, pieces_of(spark, texts, 40)):
        if len(text) <= 40:
            assert got == [text]
            continue
        assert all(0 < len(x) <= 40 for x in got)
        assert "".join("".join(got).split()) == "".join(text.split())
        sentences = re.split(r"(?<=[.!?…])\s+", text)
        if max(map(len, sentences)) <= 40:
            # Cuts are at ends of sentences only, and the sentence after a cut would not have fitted.
            assert " ".join(got) == " ".join(sentences)
            assert all(len(a) + 1 + len(re.split(r"(?<=[.!?…])\s+", b)[0]) > 40 for a, b in zip(got, got[1:]))


@pytest.mark.parametrize("text, want", [
    ("x" * 100, ["x" * 40, "x" * 40, "x" * 20]), ("x" * 40, ["x" * 40]), ("x" * 41, ["x" * 40, "x"]), ("", [""]), (None, None),
    (". ".join(["y" * 38] * 3), ["y" * 38 + ".", "y" * 38 + ".", "y" * 38]),
    ("a" * 30 + " " + "b" * 9 + " " + "c" * 5, ["a" * 30, "b" * 9 + " " + "c" * 5]),
    ("k. " + "d" * 45 + ". e.", ["k.", "d" * 40, "d" * 5 + ". e."]),
    ("bir iki. üç dört! beş altı yedi sekiz? dokuz", ["bir iki. üç dört! beş altı yedi sekiz?", "dokuz"]),
    ("f" * 39 + ". g." + " " * 5, ["f" * 39 + ".", "g."]),
])
def test_pieces_by_hand(spark, text, want):
    assert pieces_of(spark, [text], 40) == [want]


def test_explode_lines(spark):
    df = spark.createDataFrame([(1, "a\n b  c \n"), (2, None), (3, "")], "k int, text string").withColumn("line", F.lit("clash"))
    got = {(r.k, r.raw_no, r.line) for r in lines.explode_lines(df, ["k"]).collect()}
    assert got == {(1, 0, "a"), (1, 1, "b c"), (1, 2, ""), (3, 0, "")}
    df = spark.createDataFrame([(1, ["x\ny", None, "z" * 2100])], "k int, texts array<string>")
    got = sorted((r.part_no, r.raw_no, r.chunk_no, len(r.line)) for r in lines.explode_lines(df, ["k"], "texts").collect())
    assert got == [(0, 0, 0, 1), (0, 1, 0, 1), (2, 0, 0, 2000), (2, 0, 1, 100)]


def test_usable_records_pushes_both_limits(spark, small):
    plan = lines.usable_records(spark.read.parquet(f"{small}/fineweb2.parquet"))._jdf.queryExecution().toString()
    assert "language_score" in plan.split("PushedFilters")[1] and "Or(IsNull(minhash_cluster_siz" in plan.split("PushedFilters")[1]


def test_exclusive_sum(spark):
    rows = [(i, i % 3, (i * 7) % 11) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, k int, v int")
    got = {r.i: r.before for r in prefix.exclusive_sum(df, ["k"], F.floor(F.col("i") / 16), ["i"], "v", "before").collect()}
    assert got == {i: sum(v for j, kk, v in rows if kk == k and j < i) for i, k, _ in rows}


SOURCES = [(1, "az", 0.2), (2, "orta", 0.3), (3, "son", 0.4), (4, "yok", 0.0), (5, "bos", None)]


def sources(spark):
    return spark.createDataFrame(SOURCES, "priority int, name string, quota double")


def random_lines(seed, n=260):
    r = random.Random(seed)
    words = ["elma", "armut", "kiraz", "ayva", "incir", "üzüm"]
    return [(i, i // 7, r.choice(["az", "orta", "son", "başka"]), " ".join(r.choice(words) for _ in range(r.randint(3, 9))) + r.choice(["", ".", "!"])) for i in range(n)]


def fold(rows, total, cap):
    """The sequential way: one pass in order of source priority and id."""
    from math import floor

    prio = {n: p for p, n, q in SOURCES if q}
    share = {n: q for p, n, q in SOURCES if q}
    seen, out, chars = set(), [], {}
    norm = lambda s: " ".join("".join(c if c.isalnum() else " " for c in s.lower()).split())
    for s in sorted(prio, key=prio.get):
        quota = floor(share[s] * total) if s != "son" else max(int(total) - sum(chars.values()), 0)
        got, rec = 0, {}
        for i, k, src, line in sorted(x for x in rows if x[2] == s):
            usable = 20 <= len(line) <= 2000 and line.count(" ") >= 2
            if not usable or got >= quota or rec.get(k, 0) >= cap or norm(line) in seen:
                continue
            seen.add(norm(line))
            got += len(line)
            rec[k] = rec.get(k, 0) + len(line)
            out.append(i)
        chars[s] = got
    return sorted(out)


@pytest.mark.parametrize("seed, total, cap", [(1, 3000, 60), (2, 1500, 20_000), (3, 100_000, 40)])
def test_collect_exact_is_the_sequential_fold(spark, seed, total, cap):
    rows = random_lines(seed)
    got = collect.collect_exact(make(spark, rows), sources(spark), total, cap)
    assert sorted(r.line_id for r in got.collect()) == fold(rows, total, cap)


def test_collect_empty(spark):
    assert collect.collect_exact(make(spark, []), sources(spark), 1000).count() == 0
    assert collect.collect_staged(make(spark, []), sources(spark), 1000).count() == 0


def test_resume_adds_no_copy(spark):
    rows = random_lines(5)
    df, src = make(spark, rows), sources(spark)
    first = collect.collect_staged(df, src, 1500)
    more = collect.collect_resume(df, src, 6000, first)
    norm = lambda s: " ".join("".join(c if c.isalnum() else " " for c in s.lower()).split())
    text = {i: t for i, _, _, t in rows}
    a, b = [r.line_id for r in first.collect()], [r.line_id for r in more.collect()]
    assert b and not set(a) & set(b)
    assert len({norm(text[i]) for i in a + b}) == len(a + b)


def test_resume_passes_the_shortfall_to_the_last_source(spark):
    rows = [(i, i, "az" if i < 3 else "orta" if i < 6 else "son", f"satır numarası {i} burada uzun uzun durur") for i in range(200)]
    df, src = make(spark, rows), sources(spark)
    total = 3000
    first = collect.collect_staged(df, src, 200)
    taken = {r.line_id: r.n for x in (first, collect.collect_resume(df, src, total, first)) for r in x.collect()}
    # The others run dry at six lines together; the last source stops at the first line that reaches the total.
    assert sum(taken.values()) - taken[max(taken)] < total <= sum(taken.values())
    assert sorted(taken) == fold(rows, total, collect.RECORD_CAP)


@pytest.mark.parametrize("stop", [20, 90, 150])
def test_resume_is_the_rest_of_the_run(spark, stop):
    rows = random_lines(6)
    order = sorted(rows, key=lambda x: ({n: p for p, n, q in SOURCES if q}.get(x[2], 9), x[0]))
    whole = fold(rows, 5000, 20_000)
    # The run was interrupted between two records.
    done = [x for x in order if x[0] in whole][:stop]
    done = [x for x in done if (x[2], x[1]) != (done[-1][2], done[-1][1])]
    already = spark.createDataFrame([(x[0], x[2], len(x[3])) for x in done], "line_id bigint, source string, n bigint")
    more = collect.collect_resume(make(spark, rows), sources(spark), 5000, already)
    assert sorted([x[0] for x in done] + [r.line_id for r in more.collect()]) == whole


@pytest.mark.parametrize("ids", [lambda i: i * 7919 % 1_000_003 - 500_000, lambda i: i << 44, lambda i: 5 + i])
def test_stops_and_skips_with_any_ids(spark, ids):
    rows = sorted((ids(i), i, s, t) for i, _, s, t in random_lines(8, 120))
    got = collect.collect_exact(make(spark, rows).drop("line_no").withColumn("line_no", F.lit(1)), sources(spark), 2500)
    assert sorted(r.line_id for r in got.collect()) == fold(rows, 2500, 20_000)
    df = make(spark, rows)
    for k in (0, 1, 57, 120, 500):
        assert sorted(r.line_id for r in readers.skip_done(df, "line_id", k).collect()) == [r[0] for r in rows][k:]
    sums = prefix.exclusive_sum(df.withColumn("k", F.lit(0)), ["k"], collect.bucket_of(), ["line_id"], "extra", "before")
    assert [r.before for r in sums.orderBy("line_id").collect()] == list(range(120))


def test_priority_dedup_prefers_the_rare_source(spark):
    df = make(spark, [(1, 1, "son", "Aynı satır burada durur."), (2, 2, "az", "aynı satır BURADA durur"), (3, 3, "orta", "başka bir satır")])
    assert sorted(r.line_id for r in dedup.priority_dedup(df, sources(spark)).collect()) == [2, 3]


def test_sharding_and_samples(spark):
    df = make(spark, [(i, i, "az" if i % 2 else "orta", "x") for i in range(20)])
    assert {r.shard for r in collect.shard_assignment(df, 4).collect()} == {f"{s}_{k:04d}" for s in ("az", "orta") for k in (1, 2, 3)}
    assert sorted(r.line_id for r in collect.periodic_samples(df, 5).collect()) == [8, 9, 18, 19]


def test_holdout_plan_floor_and_ceiling(spark):
    df = make(spark, [(i, i, "az", "x") for i in range(50)] + [(100 + i, i, "orta", "x") for i in range(400)] + [(900, 1, "tek", "x")])
    plan = {r.source: (r.want, r.modulo) for r in split.holdout_plan(df, 45, 10).collect()}
    assert plan == {"az": (5, 10), "orta": (40, 10), "tek": (1, 2)}


def test_split_is_a_partition(spark):
    df = make(spark, [(i, i, "az", f"satır {i}") for i in range(300)] + [(999, 1, "bilinmeyen", "x")])
    plan = split.holdout_plan(df.where("source = 'az'"), 45, 10)
    x = split.holdout_split(df, plan)
    assert x.count() == 300 and x.where("split = 'holdout'").count() > 0
    assert split.unplanned_sources(df, plan).first().lines == 1


def test_percentiles(spark):
    df = spark.createDataFrame([("a" * k, n) for k, n in [(1, 50), (2, 40), (5, 9), (9, 1)]], "piece string, n bigint")
    got = {(r.measure, r.percentile): r.length for r in pieces.length_percentiles(pieces.length_counts(df), [50.0, 90.0, 99.0, 99.99]).collect()}
    assert got["chars", 50.0] == 1 and got["chars", 90.0] == 2 and got["chars", 99.0] == 5 and got["chars", 99.99] == 9
    assert pieces.length_percentiles(pieces.length_counts(df.where("n < 0"))).count() == 0


@pytest.mark.parametrize("text, want", [("", []), ("a", ["▁a"]), ("a b", ["▁a", "▁b"]), (" a", ["▁a"]), ("a  b", ["▁a", "▁", "▁b"])])
def test_metaspace(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(pieces.metaspace(F.col("t"))).first()[0] == want


def test_oversample(spark):
    df = make(spark, [(i, i, "az", "x" * 10) for i in range(5)] + [(100, 1, "orta", "y" * 50)])
    targets = spark.createDataFrame([("az", 125), ("orta", 20)], "source string, target bigint")
    got = sampling.oversample(df, targets).collect()
    assert sum(r.n for r in got if r.source == "az") == 130 and max(r.epoch for r in got) == 2
    assert [r.epoch for r in got if r.source == "orta"] == [0]


def test_byte_cap(spark):
    df = make(spark, [(i, i, "az", "ç" * 4) for i in range(10)])
    assert [r.bytes for r in sampling.byte_cap(df, 5, 20).collect()] == [9, 9, 9]


def test_reports(spark):
    df = make(spark, [(i, i, "az", "bir iki") for i in range(9)])
    assert sorted(r.line_id for r in report.systematic_sample(df, 3).collect()) == [2, 5, 8]
    assert report.drawn_lines(df, 4).count() == 4
    state = spark.createDataFrame([("az", 63, 9), ("orta", 1, 1)], "source string, chars bigint, lines bigint")
    assert {r.source: r.status for r in report.state_compare(df, state).collect()} == {"az": "same", "orta": "differs"}


def test_build(spark):
    rows = random_lines(9)
    got = corpus.build(make(spark, rows), sources(spark), corpus.Settings(total=4000, least_holdout=3, holdout_lines=10))
    assert sorted(r.line_id for r in got.collect()) == fold(rows, 4000, 20_000)


def test_cleaned_line_is_not_pushed_through(spark):
    df = spark.createDataFrame([("a  b",)], "text string")
    x = df.select(F.explode(F.array(collapse_space(F.col("text")))).alias("line")).where("line = 'a b'")
    assert x.count() == 1
