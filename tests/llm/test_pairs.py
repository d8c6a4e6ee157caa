import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import components, copies, neardup, overlap, sketch

TR = str.maketrans({"İ": "i", "I": "ı"})
SCHEMA = "line_id bigint, text string, id int, stripped string, n int, unit string, key string, feats string"


def words(t):
    return re.findall(r"[^\W_]+", t.translate(TR).lower())


def make(spark, rows):
    """Columns whose names clash with those used inside."""
    return spark.createDataFrame([(i, t, 7, "x", 1, "u", "k", "f") for i, t in rows], SCHEMA)


def share_enough(a, b, least, share=0.75):
    a, b = words(a), words(b)
    return min(len(a), len(b)) >= least and sum((Counter(a) & Counter(b)).values()) >= share * max(len(a), len(b))


def edited(r, base, vocabulary):
    w = base.split()
    for _ in range(r.randint(0, len(w) // 3)):
        k = r.randrange(len(w))
        what = r.random()
        if what < 0.4:
            w[k] = r.choice(vocabulary)
        elif what < 0.6:
            w.insert(k, r.choice(vocabulary))
        elif what < 0.8 and len(w) > 2:
            w.pop(k)
        else:
            j = r.randrange(len(w))
            w[k], w[j] = w[j], w[k]
    return " ".join(x.upper() if r.random() < 0.05 else x for x in w)


def corpus(seed, n=160, vocabulary_size=60):
    r = random.Random(seed)
    vocabulary = [f"söz{k}" for k in range(vocabulary_size)]
    bases = [" ".join(r.choice(vocabulary) for _ in range(r.randint(6, 16))) for _ in range(n // 8)]
    rows = [(i, edited(r, r.choice(bases), vocabulary)) for i in range(n)]
    return [*rows, (n, None), (n + 1, ""), (n + 2, "  "), (n + 3, "kısa"), rows[0], (n + 4, "aynı " * 12), (n + 5, "aynı " * 12)]


@pytest.mark.parametrize("seed, size, rare, hot, local", [(1, 60, 8, 1000, 250), (2, 12, 2, 1000, 250), (3, 400, 8, 1000, 250), (4, 12, 0, 1000, 9), (5, 60, 2, 3, 250), (6, 12, 0, 2, 2), (7, 60, 0, 1, 1), (8, 60, 32, 1000, 3)])
def test_unit_pairs_lose_nothing(spark, seed, size, rare, hot, local):
    rows = corpus(seed, vocabulary_size=size)
    _, units = neardup.make_units(make(spark, rows), "line_id", "text", 8)
    units_rows = {r.unit for r in units.select("unit").collect()}
    got = {(r.a, r.b) for r in neardup.unit_pairs(units, 0.75, rare, hot, local).collect()}
    text = dict(rows)
    want = {(a, b) for a in units_rows for b in units_rows if a < b and share_enough(text[a], text[b], 8)}
    assert got == want and want


@pytest.mark.parametrize("seed", [1, 2])
def test_near_pairs(spark, seed):
    rows = corpus(seed)
    got = {tuple(r) for r in neardup.found(make(spark, rows), min_words=8, min_chars=40).collect()}
    text, want = dict(rows), set()
    key = {i: "".join(words(t or "")) for i, t in rows}
    for a in text:
        for b in text:
            if a < b and text[a] and text[b] and share_enough(text[a], text[b], 8) and not (key[a] == key[b] and len(key[a]) >= 40):
                want.add((a, b))
    assert got == want


def test_near_groups(spark):
    rows = corpus(3)
    got = {r.line_id: (r.group_id, r.n_links) for r in neardup.groups(make(spark, rows), min_words=8).collect()}
    text = {i: t for i, t in dict(rows).items() if t}
    near = {i: {j for j in text if j != i and share_enough(text[i], text[j], 8)} for i in text}
    seen, root = set(), {}
    for i in sorted(text):
        if i not in seen and near[i]:
            todo = [i]
            while todo:
                k = todo.pop()
                if k not in seen:
                    seen.add(k)
                    root[k] = i
                    todo += near[k]
    assert {i: g for i, (g, _) in got.items()} == root


def test_a_third_of_all_lines_are_copies(spark):
    rows = [(i, "bir iki üç dört beş altı yedi sekiz dokuz on onbir oniki") for i in range(400)] + [(1000, "bir iki üç dört beş altı yedi sekiz dokuz on onbir değişik")]
    got = neardup.found(make(spark, rows), min_words=8).collect()
    assert len(got) == 400 and {r.line_id_b for r in got} == {1000}
    assert neardup.groups(make(spark, rows), min_words=8).groupBy("group_id").count().first()["count"] == 401
    assert copies.found(make(spark, rows)).count() == 399


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "tek bir satır var burada " * 5)], [(None, "kimliksiz satır burada duruyor " * 4)] * 3])
def test_nothing_to_find(spark, rows):
    df = make(spark, rows)
    assert neardup.found(df).count() == 0 and copies.found(df).count() == 0 and copies.copy_counts(df).count() == 0
    assert neardup.groups(df).count() == 0 and overlap.overlaps(df, df.withColumn("line_id", F.col("line_id") + 10)).count() == len([1 for i, t in rows if i and t])


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (20, 30), (30, 20), (5, 5)]
    got = {r.id: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7, 20: 20, 30: 20}
    path = spark.range(200).selectExpr("id as a", "id + 1 as b")
    assert components.components(path).where("root = 0").count() == 201
    assert components.components(path.where("a < 0")).count() == 0


def test_copies_by_form_and_field_order(spark):
    base = "Ürün: Kavık şurup 250 • Marka: Iğdır • Puan: 4 • Yorum: ben bunu çok beğendim, işte"
    rows = [
        (5, base), (3, base.replace("i", "İ").upper()), (9, "Puan : 4 / Yorum: ben bunu çok beğendim, işte / Ürün:Kavık şurup 250 / Marka:Iğdır"), (4, base.replace(" • ", " ").replace(":", "")),
        (7, "puan: 4; yorum: ben bunu çok beğendim, işte; marka: ığdır; ürün: kavık şurup 250"), (8, base.replace("250", "251")), (1, "kısa: a; kısa: b"), (2, "kısa: b; kısa: a"),
        (11, None), (12, ""), (5, base),
    ]
    got = {tuple(r) for r in copies.found(make(spark, rows)).collect()}
    assert got == {(3, x) for x in (4, 5, 7, 9)}
    assert {tuple(r) for r in copies.copy_counts(make(spark, rows)).collect()} == {(3, 5)}


def test_the_same_letters_divided_in_two_ways(spark):
    """Line 2 has the letters of 1 in other fields; 3 has the fields of 1 in another order, 4 those of 2."""
    head, tail = "Satıcı adı: Konak pazar yeri bir iki üç", "Yorum: güzel ve hızlı geldi"
    one, two = f"{head} • Not: iyi • {tail}", f"{head} Not: iyi • {tail}"
    rows = [(5, one), (2, two), (9, f"{tail} • {head} • Not: iyi"), (4, f"{tail} • {head} Not: iyi"), (7, "Başka: bir satır burada duruyor • Yorum: hiç ilgisi yok işte")]
    assert {tuple(r) for r in copies.found(make(spark, rows)).collect()} == {(2, x) for x in (4, 5, 9)}


@pytest.mark.parametrize("seed", range(3))
def test_copies_against_brute_force(spark, seed):
    r = random.Random(seed)
    bases = ["".join(r.choice("abcçdeıi ") for _ in range(60)) for _ in range(12)]
    form = lambda t: "".join(c.upper() if c not in "iı" and r.random() < 0.3 else c + r.choice(["", "", " ", ".", " "]) for c in t)
    rows = [(i, form(r.choice(bases))) for i in range(120)]
    first, want = {}, set()
    for i, t in rows:
        k = "".join(words(t))
        if len(k) >= 40:
            if k in first:
                want.add((first[k], i))
            else:
                first[k] = i
    assert {tuple(x) for x in copies.found(make(spark, rows)).collect()} == want


def test_overlap_across_splits(spark):
    base = [f"kelime{k}" for k in range(24)]
    other = [f"başka{k}" for k in range(24)]
    changed = [w if k % 5 else "x" + w for k, w in enumerate(base)]
    halves = base[12:] + base[:12]
    train = [(100, " ".join(base)), (101, " ".join(changed)), (102, ", ".join(halves).replace("k", "K")), (103, " ".join(other)), (104, " ".join(base[:12] + other[:12])), (105, None), (106, ""), (100, " ".join(base))]
    held = [(1, " ".join(base)), (2, " ".join(base) + "!"), (3, None), (4, "çok kısa")]
    got = {(r.holdout_id, r.train_id): (r.shared, r.coverage) for r in overlap.overlaps(make(spark, held), make(spark, train)).collect()}
    text = dict(train)
    want = {(i, j) for i, t in held if t for j in text if text[j] and share_enough(t, text[j], 20)}
    assert set(got) == want and got[1, 100] == (24, 1.0)
    assert 0.75 <= got[1, 101][1] <= 0.85


def test_overlap_of_lines_edited_at_different_places(spark):
    """No three common words stand in a row, and what stands beside two is in no other line."""

    def edited(own, after, front):
        out = [f"{own}ön"] if front else []
        for k in range(15):
            out += [f"kelime{k}", *([f"{own}{k}"] if k in after else [])]
        return " ".join(out)

    held, train = [(1, edited("bir", (0, 2, 6, 10, 14), False))], [(100, edited("iki", (0, 4, 8, 12), True))]
    got = [(r.holdout_id, r.train_id, r.shared) for r in overlap.overlaps(make(spark, held), make(spark, train)).collect()]
    assert got == [(1, 100, 15)]


def test_overlap_report(spark):
    text = " ".join(f"kelime{k}" for k in range(24))
    held = spark.createDataFrame([(1, "dev", None, text), (2, "dev", "web", text), (3, "holdout", "web", "başka")], "line_id bigint, split string, source string, text string")
    got = {(r.split, r.source): (r.lines, r.leaked) for r in overlap.report(held, make(spark, [(100, text)])).collect()}
    assert got == {("dev", None): (1, 1), ("dev", "web"): (1, 1), ("holdout", "web"): (1, 0)}


@pytest.mark.parametrize("seed, size, crowded, rare, hot", [(0, 300, 100, 32, 1000), (1, 300, 0, 8, 1000), (2, 40, 3, 2, 3), (3, 40, 0, 0, 1)])
def test_overlap_loses_nothing(spark, seed, size, crowded, rare, hot):
    """Words changed in place, moved, shuffled one by one, taken out here and put in there; with and without seeds."""
    r = random.Random(seed)
    vocabulary = [f"söz{k}" for k in range(size)]
    held = [(i, [r.choice(vocabulary) for _ in range(r.randint(20, 40))]) for i in range(40)]
    train = []
    for i, base in held:
        for kind in range(3):
            w = list(base)
            k = len(w) // 4
            if kind == 0:
                for j in r.sample(range(len(w)), k):
                    w[j] = r.choice(vocabulary)
            elif kind == 1:
                r.shuffle(w)
                w = w[k:] + [r.choice(vocabulary) for _ in range(k)]
            else:
                for j in sorted(r.sample(range(len(w)), k), reverse=True):
                    w.pop(j)
                for _ in range(k):
                    w.insert(r.randrange(len(w)), r.choice(vocabulary))
            train.append((1000 + 3 * i + kind, w))
    rows = lambda x: [(i, " ".join(w)) for i, w in x]
    got = {(x.holdout_id, x.train_id) for x in overlap.overlaps(make(spark, rows(held)), make(spark, rows(train)), crowded=crowded, rare=rare, hot=hot).collect()}
    want = {(i, j) for i, a in held for j, b in train if share_enough(" ".join(a), " ".join(b), 20)}
    assert got == want and len(want) > 60


def test_count_codes_rise():
    n = np.arange(0, 3_000_000)
    codes = sketch.count_code(n).astype(int)
    assert (np.diff(codes) >= 0).all() and (codes[:128] == n[:128]).all() and sketch.count_code(np.array([2**40])) == 255


@pytest.mark.parametrize("bits", [10, 18])
def test_count_table(spark, bits):
    r = random.Random(bits)
    rows = [[r.randrange(-(2**31), 2**31) if r.random() < 0.5 else r.randrange(40) for _ in range(r.randint(0, 30))] for _ in range(300)]
    table = sketch.count_table(spark.createDataFrame([(x,) for x in rows], "feats array<int>"), "feats", bits)
    want = Counter(v % (1 << bits) for x in rows for v in x)
    assert len(table) == 1 << bits and all(table[p] == sketch.count_code(np.array([n]))[0] for p, n in want.items()) and (table > 0).sum() == len(want)


def test_a_key_that_a_third_of_the_lines_have(spark):
    """It is marked where it is made and doesn't pass through the shuffle."""
    base = [f"kelime{k}" for k in range(16)]
    rows = [(i, " ".join([*base, *(f"kendi{i}x{k}" for k in range(4))])) for i in range(2000)] + [(5000 + i, " ".join(f"başka{i % 700}x{k}" for k in range(11))) for i in range(1400)]
    _, units = neardup.make_units(make(spark, rows), "line_id", "text", 8)
    counts = sketch.count_table(units, "feats", 20)
    masks = neardup.mask_table(units, counts, rare=4).toPandas()
    cold = masks[masks.n > 0]
    assert masks[masks.n == 0].key.nunique() == 3 and not set(masks[masks.n == 0].key) & set(cold.key)
    assert len(cold) == 0 or cold.groupby("key").size().max() < 10
    assert set(-masks[masks.n < 0].n) == {20} and len(masks[masks.n < 0]) == 2000
