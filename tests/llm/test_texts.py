import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import layout, leak, mixing, mojibake, packing, quality, subjects

PROSE = [
    "Öğleden sonra yağmur yağınca çocuklar eve döndü; akşama doğru güneş açtı.",
    "Şehrin ışıkları geceleyin ağır ağır söndü, kimse bunun nedenini sormadı.",
    "İki gün önce Iğdır'da küçük bir şirket yeni ürününü tanıttı ve çok ilgi gördü.",
    "Bahçedeki ağaçların gölgesinde oturup uzun uzun konuştuk, güldük, düşündük.",
]


# ---- encodings ----


def garble(text, steps):
    for read, written in reversed(steps):
        if read == "lower":
            text = text.lower()
            continue
        raw = text.encode("utf-8") if written == "utf-8" else bytes(mojibake.reverse_table(written)[c] for c in text)
        text = "".join(mojibake.forward_table(read)[b] for b in raw)
    return text


@pytest.fixture(scope="module")
def describer():
    return mojibake.Describer(" ".join(PROSE).encode())


@pytest.mark.parametrize("name, steps", [(n, s) for n, s, _ in mojibake.CHAINS if "lower" not in n])
@pytest.mark.parametrize("text", PROSE)
def test_garbled_text_comes_back(describer, name, steps, text):
    try:
        bad = garble(text, steps)
    except KeyError:
        pytest.skip("the encoding lacks a character")
    if bad == text:
        return
    assert mojibake.restore(bad, describer)[0] == text


@pytest.mark.parametrize("text", [
    *PROSE, "Müzede Łódź treni de vardı", "Ærø adası ve smørrebrød tabağı", "Привет yazısı asıldı", "¿Qué tal? kartpostalı geldi", "bunu Ý harfi ile yazdı", "naïve yaklaşım, déjà vu hissi",
    "20 °C sıcaklık, ½ su bardağı, § 14", "┌─ çizim ─┐ notu", "░▒▓░▒▓░▒▓ neden ░▒▓", "kârlı piyasa • yeni → eski", "agac ve cicek dusundu", "Größe etiketi São Tomé kıyısında",
])
def test_right_text_stays(describer, text):
    assert mojibake.restore(text, describer)[0] == text and not mojibake.restore(text, describer)[2]


@pytest.mark.parametrize("text", ["Schöne Grüße aus der Bücherei, wir wünschen Ihnen einen schönen Tag.", "L'élève était très étonné, où avait-il déjà vu cette forêt ?", "Мы хотели бы поговорить о хорошей погоде.", "Žluťoučký kůň úpěl ďábelské ódy."])
@pytest.mark.parametrize("name", ["utf-8 as cp1252", "utf-8 as latin-1", "utf-8 as latin-1, then as cp1252", "utf-8 as cp1252, then as cp1254"])
def test_other_languages_come_back(describer, name, text):
    steps = next(s for n, s, _ in mojibake.CHAINS if n == name)
    try:
        bad = garble(text, steps)
    except KeyError:
        pytest.skip("the encoding lacks a character")
    assert mojibake.restore(bad, describer)[0] == text


def test_garbled_in_places(describer):
    bad = PROSE[0].replace("çocuklar", garble("çocuklar", [("cp1252", "utf-8")]))
    fixed, chains, n, lost = mojibake.restore(bad, describer)
    assert fixed == PROSE[0] and n == 1 and len(chains) == 1 and lost == 0


def test_found_lines(spark):
    rows = [(i, p) for i, p in enumerate(PROSE)] + [(10, garble(PROSE[1], [("cp1252", "utf-8")])), (11, "bozuk s�z"), (12, None), (13, ""), (14, "  "), (15, "Łódź"), (10, garble(PROSE[1], [("cp1252", "utf-8")]))]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "line_id bigint, text string, restored string")
    assert sorted(r.line_id for r in mojibake.found(df).collect()) == [10, 11]
    assert mojibake.repair(df).where("id = 10").first().restored == PROSE[1]
    assert mojibake.found(df.where("line_id < 0")).count() == 0


# ---- prose or not ----

NOT_PROSE = {
    1: ["• Tiyatrolar", "• Sahneler", "• perdeler Konak"], 2: ["Ankara\t12.5\t7\t88", "Bursa\t3.1\t9\t14", "İzmir\t4\t4\t2"], 3: ["Anasayfa > Künye > İletişim > Yardım > Sepetim"],
    4: ["tarif yemek limon tarif kek kremalar tarif sofra limon kek tarif mutfak"], 5: ["def topla(a, b):", "    c = [a[i] for i in range(9)]", "    return c"],
    6: ["2015-08-21 02:45:38,622 WARN isci-44: id=9a8fdacb0648940a"] * 3, 7: ["https://ornek.example/a/b-1", "https://ornek.example/c"], 8: ["zsvcgpjtqswfjqqhlshxzkrmhpf zksncwjjj"],
    11: ["idhdgkjajf şgkssikgdi fgad shşhhfjf isjhafkij jişfdşl jsh"], 12: ["Tekolalı insan 1251,99 TL", "Erganedik neden 2394,22 TL"], 9: ["Saatler", "Konak 07:01 19:03 13:05", "Bornova 09:22 16:26 07:02"], 10: ["Enzim: 61.4", "Dalga: Göl", "Uydu: -"],
}
IS_PROSE = {
    21: PROSE, 22: ["beğenmedim"], 25: ["Ürün: Kavık şurup 250 • Marka: Iğdır • Puan: 4 • Yorum: ben bunu çok beğendim, kullanıyorum"],
    27: [PROSE[0], "• Tiyatrolar", PROSE[1]], 28: [p.upper() for p in PROSE[:2]], 29: [garble(PROSE[0], [("cp1252", "utf-8")])], 30: [None, PROSE[2], ""],
}


def lines_of(spark, records, start=1):
    rows = [(r, start + k, t, 5) for r, lines in records.items() for k, t in enumerate(lines)]
    return spark.createDataFrame(rows, "rec_id bigint, line_no int, text string, words int")


def beside_a_corpus(spark, records, start=1):
    """The records among those of a table, from which the language and the score are learned."""
    corpus = spark.read.parquet("/root/testdata/sf0.01/shards.parquet").select((F.col("rec_id") + 1_000_000).alias("rec_id"), "line_no", "text", F.lit(5).alias("words"))
    return lines_of(spark, records, start).unionByName(corpus)


@pytest.mark.parametrize("start", [1, 62])
def test_records(spark, start):
    df = beside_a_corpus(spark, NOT_PROSE | IS_PROSE | {40: [None, ""], 41: []}, start)
    got = {r.rec_id for r in quality.found(df).where("rec_id < 1000").collect()}
    assert got == set(NOT_PROSE)


def test_too_little_to_learn_from(spark):
    df = lines_of(spark, {1: PROSE, 2: [None, ""], 3: ["•"]})
    assert quality.found(df).count() == 0 and quality.found(df.where("rec_id < 0")).count() == 0
    rows = {r.rec_id: r for r in quality.statistics(df).collect()}
    assert (rows[2].lines, rows[2].words, rows[2].closed_ratio, rows[2].prose) == (2, 0, None, None) and rows[1].closed_ratio == 1.0


def test_without_the_layout_nothing_is_named(spark, monkeypatch):
    """Alignment, indentation and regular lengths are what the score is learned from, and they also decide in it."""
    df = beside_a_corpus(spark, {1: ["Bölümler ve konu", "    Giriş", "    Yöntem", "    Sonuç"], 2: ["Enzim kodu: Göl", "Dalga boyu: Kar", "Uydu yeri: Van"]})
    rows = quality.cut(quality.features(quality.ratios(quality.record_sums(quality.line_statistics(*(lambda x: (x, quality.learn(x)))(quality.lines_of(df, "rec_id", "line_no", "text")))))))
    named = lambda r, s: {x.rec for x in r.where((F.col("text") > 0) & (s.column(F.col("x")) > 0)).collect()}
    score = quality.fit(rows)
    whole = named(rows, score)
    assert {1, 2} <= whole and len(whole) > 90
    where = [quality.FEATURES.index(c) for c in quality.LAYOUT]
    assert all(score.weights[k] > 0 for k in where)
    # The same records with their layout gone from the features, and from the examples.
    flat = rows.withColumn("x", F.transform("x", lambda v, k: F.when(k.isin(where), 0.0).otherwise(v)))
    assert len(whole - named(flat, score)) >= 1
    blind = quality.cut(flat.withColumn("example", F.when(F.col("example") == 0, 0.0)))
    assert quality.fit(blind) is None


def test_pairs_across_block_borders(spark):
    r = random.Random(4)
    texts = ["a" * r.randint(1, 30) + r.choice(["", ";b", ";b;c"]) for _ in range(300)]
    got = quality.record_statistics(lines_of(spark, {1: texts}, 30)).first()
    n = [len(t) for t in texts]
    signature = ["".join(c for c in t if c == ";") for t in texts]
    assert got.pairs1 == 299 and got.pairs2 == 298 and got.lines == 300
    assert got.x1 == sum(a * b for a, b in zip(n, n[1:])) and got.x2 == sum(a * b for a, b in zip(n, n[2:]))
    assert got.aligned == sum(a == b != "" for a, b in zip(signature, signature[1:]))


def test_lines_as_bytes():
    """Counts by numpy over bytes against regular expressions on each line."""
    import re

    import pyarrow as pa

    r = random.Random(3)
    texts = ["".join(r.choice(["a", "bc", "gel", "di", " ", "  ", "7", "42", ".", "!", " :)", "|", " - ", "-", "\t", ",", "é", " • ", "x=y"]) for _ in range(r.randint(0, 30))) for _ in range(400)]
    x = layout.Lines.of(pa.array([t + "\n" for t in texts]))
    m = x.measure(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(729))
    of_row = lambda at: np.bincount(x.word_row[at], minlength=len(texts))
    which, _, unknown = x.endings()
    closes = of_row(which[x.closes(which)])
    for k, t in enumerate(texts):
        tokens = [re.sub(r"[^\x00-\x7f]", "é", w) if re.search("[a-z0-9]", w) else re.sub(r"[^\x00-\x7f]", "•", w) for w in t.split()]
        words = [x for w in t.split() if re.search("[a-z0-9]", w) for x in re.findall("[a-z0-9é•]+", w)]
        assert m["words"][k] == len(words) and m["repeated"][k] == len(words) - len(set(words))
        assert m["chars"][k] == len("".join(t.split())) and m["digits"][k] == len(re.findall("[0-9]", t)) and m["letters"][k] == sum(len(re.findall("[a-zé]", w)) for w in tokens)
        assert m["mixed"][k] == sum(bool(re.search("[a-z]", w) and re.search("[0-9]", w) or re.search("[a-z0-9]", w) and re.search(r"[_=/\\{}\[\]<>:@#](?=\S)", w)) for w in tokens)
        assert m["indent"][k] == (len(t) - len(t.lstrip()) if t.strip() else 0)
        last = re.search(r"[^a-zé0-9\s]+$", " ".join(tokens))
        assert m["closed"][k] == bool(last and re.search(r"[.!?)]", last.group()))
        same = re.sub(r"\S+", lambda w: re.sub(r"[^\x00-\x7f]", "é" if re.search("[a-z0-9]", w.group()) else "•", w.group()), t)
        runs = [re.match(r"[ \t]?([^a-zé0-9\s]+)(?=\s|$)", same[w.end() :]) for w in re.finditer(r"(?<![a-zé0-9])[a-zé]+(?![a-zé0-9])", same) if len(w.group().encode()) >= 3]
        assert closes[k] == sum(bool(x and re.search(r"[.!?)]", x.group(1))) for x in runs)
        cells = [c for c in re.split(r"[^a-zé0-9\s.,!?'\"()-]|(?:(?<=\s)|^)-(?=\s|$)", same) if re.search("[a-zé0-9]", c)]
        assert m["cells"][k] == len(cells)


# ---- mixing ----


def test_mix_cases(spark):
    runs = spark.createDataFrame([(1, 1000, 2), (2, 1000, 1), (1, 1000, 2)], "run_id bigint, total_chars bigint, max_repeat int")
    sources = spark.createDataFrame([("az", 0.2), ("WİKİ", 0.5), ("sıfır", 0.0), ("boş", None)], "name string, quota double")
    state = spark.createDataFrame([(1, " AZ ", 99, 1), (1, "az", 100, 2), (1, "az", None, 3), (1, "wiki", 10, 5), (1, "wiki", 400, 5), (2, "az", 200, 1), (3, "az", 1, 1), (1, None, 5, 9)], "run_id bigint, source string, chars bigint, saved_at int").withColumn("target", F.lit(1))
    got = sorted(tuple(r) for r in mixing.found(runs, sources, state).collect())
    assert got == [(2, "WİKİ")]
    shares = {(r.run_id, r.source): r.share for r in mixing.report(runs, sources, state).collect()}
    assert shares[2, "az"] == 1.0 and shares[2, "WİKİ"] == 0.0 and abs(sum(v for (run, _), v in shares.items() if run == 1) - 1) < 1e-6
    assert mixing.found(runs.where("run_id < 0"), sources, state).count() == 0


def test_positions_follow_the_weights(spark):
    docs = spark.createDataFrame([(i, "artan" if i % 2 else "azalan", "x" * (5 + i % 7)) for i in range(4000)] + [(9999, None, "x"), (9998, "artan", None), (9997, "artan", "")], "doc_id bigint, source string, text string").withColumn("position", F.lit(3))
    schedule = spark.createDataFrame([("artan", 0.0, 0.0, 1.0, 1.0), ("azalan", 0.0, 1.0, 0.5, 0.5), ("azalan", 0.5, 0.5, 1.0, 0.0)], mixing.PIECES)
    total = 16_000
    got = mixing.positions(docs, schedule, total, 3).collect()
    at = [r.position for r in got]
    assert at == sorted(at) and 0 <= at[0] and at[-1] < 1
    size = {r.doc_id: len(r.text) for r in docs.where("text is not null").collect()}
    for lo in np.arange(0, 1, 0.25):
        part = [r for r in got if lo <= r.position < lo + 0.25]
        up = sum(size[r.doc_id] for r in part if r.source == "artan")
        assert abs(up - total * (lo * 0.25 + 0.25**2 / 2)) < 60


def test_a_source_is_used_up_where_its_demand_passes_it(spark):
    """A weight that rises from 0 to 2: of 1,000 characters half are wanted in the first 0.707 of the run."""
    runs = spark.createDataFrame([(1, 1000, 1)], "run_id bigint, total_chars bigint, max_repeat int")
    schedule = spark.createDataFrame([("artan", 0.0, 0.0, 1.0, 2.0), ("sabit", 0.0, 0.3, 1.0, 0.3)], mixing.PIECES)
    state = spark.createDataFrame([(1, "ARTAN", 500, 1), (1, "sabit", 300, 1)], "run_id bigint, source string, chars bigint, saved_at int")
    got = {r.source: r.dry_at for r in mixing.plan(runs, schedule, state).collect()}
    assert abs(got["artan"] - 0.5**0.5) < 1e-9 and got["sabit"] is None


def test_names_differ_by_their_marks(spark):
    df = spark.createDataFrame([(" WİKİ ",), ("wıkı",), ("ş",), ("s",)], "n string")
    assert [r.k for r in df.select(mixing.name_key(F.col("n")).alias("k")).collect()] == ["wiki", "wiki", "ş", "s"]


def test_shares_of_every_tenth_follow_the_weights(spark):
    sources = spark.createDataFrame([(1, "bir", 0.5), (2, "iki", 0.3), (3, "üç", 0.2), (4, "yok", 0.0)], "priority int, name string, quota double")
    docs = spark.createDataFrame([(i, ("bir", "iki", "üç")[i % 3], "x" * (5 + i % 5)) for i in range(6000)], "doc_id bigint, source string, text string")
    total = 20_000
    schedule = mixing.shifting_schedule(sources)
    got = mixing.positions(docs, schedule, total, 9).collect()
    weight = {}
    for r in schedule.collect():
        for k in range(1000):
            t = (k + 0.5) / 1000
            if r.t0 <= t < r.t1:
                weight[r.source, k // 100] = weight.get((r.source, k // 100), 0) + (r.w0 + (r.w1 - r.w0) * (t - r.t0) / (r.t1 - r.t0)) / 1000
    size = {r.doc_id: len(r.text) for r in docs.collect()}
    for tenth in range(10):
        for s in ("bir", "iki", "üç"):
            chars = sum(size[r.doc_id] for r in got if r.source == s and tenth / 10 <= r.position < (tenth + 1) / 10)
            assert abs(chars - weight[s, tenth] * total) <= 20


def test_repeats_are_capped(spark):
    docs = spark.createDataFrame([(i, "az", "x" * 10) for i in range(10)] + [(0, "az", "x" * 10)], "doc_id bigint, source string, text string")
    schedule = spark.createDataFrame([("az", 0.0, 1.0, 1.0, 1.0)], mixing.PIECES)
    got = mixing.positions(docs, schedule, 10_000, 3).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in got} == {0: 6} | dict.fromkeys(range(1, 10), 3)
    assert mixing.positions(docs, schedule, 25, 3).count() == 3
    assert mixing.positions(docs.where("doc_id < 0"), schedule, 25, 3).count() == 0


def test_running_sum_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    docs = spark.createDataFrame([(i, "k" if i % 3 else "m", i % 5 + 1, i) for i in range(120)], "doc_id bigint, key string, size bigint, copy bigint")
    for key in "km":
        rows = sorted((r.start, r.size) for r in mixing.running_sum(docs, 120).where(F.col("key") == key).collect())
        assert [s for s, _ in rows] == [sum(n for _, n in rows[:i]) for i in range(len(rows))]


# ---- packing ----


def naive(items, capacity, conflicts):
    """Best fit by looking at every container."""
    bins, out = [], [0] * len(items)
    for i in sorted(range(len(items)), key=lambda i: (-items[i][0], items[i][2] is None, items[i][2] or 0, items[i][3])):
        n, s, c, _ = items[i]
        fit = [(b[0], k) for k, b in enumerate(bins) if b[0] >= n and (c is None or c not in b[2]) and not any(conflicts.get(s, 0) >> x & 1 for x in b[1])]
        if fit:
            k = min(fit)[1]
        else:
            bins.append([capacity, set(), set()])
            k = len(bins) - 1
        bins[k][0] -= n
        bins[k][1].add(s)
        bins[k][2].add(c)
        out[i] = k
    return sorted(b[0] for b in bins), out


@pytest.mark.parametrize("seed", range(12))
def test_pack_is_best_fit(seed):
    r = random.Random(seed)
    capacity = 50
    size_of = {c: r.randint(1, 50) for c in range(12)}
    items = []
    for k in range(150):
        c = r.choice([None, *range(12)]) if seed % 3 else r.choice([None, 0])
        items.append((size_of[c] if c is not None else r.randint(1, 50), r.randrange(3), c, k))
    conflicts = {0: 0b100, 2: 0b001} if seed % 2 else {}
    got = packing.pack(items, capacity, conflicts)
    room, clusters, kinds = {}, {}, {}
    for (n, s, c, _), b in zip(items, got):
        room[b] = room.get(b, capacity) - n
        assert room[b] >= 0 and (c is None or c not in clusters.setdefault(b, set()))
        if c is not None:
            clusters[b].add(c)
        kinds.setdefault(b, set()).add(s)
    assert not conflicts or all(not {0, 2} <= k for k in kinds.values())
    if not conflicts:
        assert sorted(room.values()) == naive(items, capacity, conflicts)[0]


def test_token_counts_are_the_tokenizers():
    c = packing.Counter(packing.TOKENIZER)
    r = random.Random(1)
    texts = ["".join(r.choice(["a", "ş", " ", "  ", "\n", "\n\n", "\t", "1", "'s", "...", "　", "kelime", "\xa0"]) for _ in range(r.randint(0, 30))) for _ in range(2000)]
    assert all(c.count(t) == (c.whole(t) if t else 0) for t in [*texts, None, "", "bir iki\nüç", " "])


def test_every_row_once(spark):
    rows = [(i, "kelime " * (i % 40 + 1), "web") for i in range(300)] + [(1000, "uzun metin " * 900, "web"), (1001, None, None), (1002, "", "web"), (5, "kelime " * 6, "web"), (None, "kimliksiz", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("tokens", F.lit(1))
    got = packing.containers(docs, capacity=100, group_rows=150).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == sorted((i is not None, i or 0) for i, _, _ in rows)
    used = {}
    for r in got:
        used[r.container] = used.get(r.container, 0) + r.tokens % 100
        assert (r.own_containers > 0) == (r.tokens >= 100) == (r.first_own is not None)
    assert max(used.values()) <= 100
    own = [r.first_own + k for r in got for k in range(r.own_containers)]
    assert len(own) == len(set(own)) and not set(own) & {b for b, n in used.items() if n}
    assert packing.fill(packing.containers(docs, capacity=100), 100).first().documents == len(rows)
    assert packing.containers(docs.where("doc_id < -1")).count() == 0


def test_sources_apart_and_copies(spark):
    """Sources and copies turn containers away; every check of the result is 0, and without ``apart`` it isn't."""
    r = random.Random(2)
    texts = [" ".join(r.choice(["kelime", "söz", "metin", "uzun"]) for _ in range(r.randint(1, 60))) for _ in range(60)]
    docs = spark.createDataFrame([(i, r.choice(texts), r.choice(["web", "forum", "wiki", None])) for i in range(400)], "doc_id bigint, text string, source string")
    apart = (("web", "wiki"), ("forum", "wiki"))
    both = {name: packing.checks(packing.containers(docs, capacity=120, apart=a), docs, 120, apart).first().asDict() for name, a in (("kept", apart), ("free", ()))}
    assert both["kept"] == {"documents": 400} | dict.fromkeys(("missing", "twice", "overfull", "own_shared", "copies_together", "apart_together"), 0)
    assert both["free"]["apart_together"] > 0 and both["free"]["copies_together"] == 0


# ---- leaks ----


def spread(r, n, at):
    return [f"{at}{r.randrange(4000)}" for _ in range(n)]


def test_leaked_passages(spark):
    r = random.Random(7)
    item = spread(r, 40, "soru")
    noise = lambda n: spread(r, n, "metin")
    changed = list(item)
    for k in (5, 12, 20):
        changed[k] = "değişik"
    added = item[:6] + ["fazla"] + item[6:14] + ["daha"] + item[14:20]
    docs = {
        1: noise(50) + item[3:18] + noise(30), 2: noise(500) + changed[:25] + noise(9), 3: noise(5) + added + noise(5), 4: noise(20) + item[:8] + noise(20), 5: noise(100), 6: noise(3) + item[:9] + noise(12) + item[9:20] + noise(3),
        7: [w.upper() for w in item[10:30]], 8: item[20:40] + item[0:11], 9: noise(20) + item[:6] + noise(200) + item[30:36],
    }
    text = {k: ", ".join(v) if k % 2 else " \n".join(v) for k, v in docs.items()} | {10: None, 11: "", 12: "   "}
    df = spark.createDataFrame([(k, t, 1) for k, t in text.items()] + [(1, text[1], 1)], "doc_id bigint, text string, item_id int")
    items = spark.createDataFrame([(70, " ".join(item), "a"), (71, None, "a"), (72, "çok kısa", "a"), (73, " ".join(noise(30)), "b")], "item_id bigint, text string, words string")
    got = {(x.item_id, x.doc_id): (x.words, x.kind) for x in leak.matches(items, df).collect()}
    assert {d for i, d in got} == {1, 2, 3, 6, 7, 8} and {i for i, d in got} == {70}
    assert got[70, 1] == (15, "exact") and got[70, 3][1] == "proximity" and got[70, 2][0] >= 24
    again = {(x.item_id, x.doc_id): (x.words, x.kind) for x in leak.matches(items, df, block=1).collect()}
    assert again == got
    assert leak.matches(items.where("item_id < 0"), df).count() == 0 and leak.matches(items, df.where("doc_id < 0")).count() == 0


def found_in(spark, items, docs, **kw):
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} bigint, text string")
    return sorted(tuple(r) for r in leak.matches(frame(items, "item_id"), frame(docs, "doc_id"), **kw).collect())


def test_half_with_few_anchors(spark):
    """Words 3 and 4 serve the windows of the first half, what else stands there is everywhere."""
    item = [f"kelime{k}x" for k in range(12)]
    often = {k: 9 for k in range(12)} | {3: 0, 6: 1, 9: 1}
    filler = " ".join(f"{item[k]} ara ara ara ara ara" for k, n in often.items() for _ in range(n))
    leaked = " ".join(["ön", *item[:6], *["yabancı"] * 10, *item[6:], "son"])
    apart = " ".join([*item[:6], *["yabancı"] * 99, filler])
    assert found_in(spark, [(1, " ".join(item))], [(5, leaked), (6, filler), (7, apart)]) == [(1, 5, 12, "proximity")]


@pytest.mark.parametrize("length, shift", [(12, 1), (16, 1), (16, 3), (24, 0), (24, 2)])
def test_every_fourth_word_changed(spark, length, shift):
    """The words that were changed stand elsewhere in the corpus, more seldom than all others; the segments don't matter."""
    r = random.Random(length + shift)
    items, docs, rare = [], [], []
    for i in range(25):
        item = spread(r, length, f"soru{i}k")
        changed = ["değişik" + str(r.randrange(50)) if k % 4 == shift else w for k, w in enumerate(item)]
        items.append((i, " ".join(item)))
        docs.append((i, " ".join(spread(r, 30, "metin") + changed + spread(r, 30, "metin"))))
        rare.append(" ".join(w for k, w in enumerate(item) if k % 4 == shift))
        docs += [(1000 + 10 * i + k, " ".join(r.sample(changed, len(changed)))) for k in range(3)]
    docs.append((9000, " ara ara ara ara ara ara ara ".join(rare)))
    got = found_in(spark, items, docs)
    first = [k for k in range(length) if k % 4 != shift]
    if first[-1] - first[0] + 1 >= leak.MIN_WORDS:
        assert {(i, i) for i in range(25)} <= {x[:2] for x in got}
    assert found_in(spark, items, docs, block=4) == got


def test_segments_do_not_matter(spark, monkeypatch):
    r = random.Random(11)
    items = [(i, " ".join(spread(r, 30, "ortak"))) for i in range(12)]
    docs = [(i, " ".join(spread(r, r.randint(0, 90), "ortak") + (items[i % 12][1].split()[3 : 3 + i % 25]) + spread(r, 20, "ortak"))) for i in range(120)]
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} bigint, text string")
    whole = found_in(spark, items, docs)
    assert len(whole) > 40
    index = leak.build_index(frame(docs, "doc_id"))
    assert index.selectExpr("sum(size(steps))").first()[0] == sum(len(t.split()) for _, t in docs)
    build = leak.segment_row
    rows = [build(np.array([i]), np.array([w], np.int32).reshape(-1), np.array([len(w)])) for i, w in ((d, [r.w for r in frame([(d, t)], "doc_id").select(leak.term_numbers(leak.plain_words(F.col("text"))).alias("w")).collect()][0]) for d, t in docs[:30])]
    single = spark.createDataFrame([tuple([int(v) for v in c] for c in row) for row in rows], leak.INDEX)
    got = sorted(tuple(x) for x in leak.matches(frame(items, "item_id"), frame(docs, "doc_id"), index=single).collect())
    assert got == [x for x in whole if x[1] < 30]


def test_diacritics_and_case_are_ignored(spark):
    df = spark.createDataFrame([("ÇAĞRI Işık İğne naïve Crème!",), ("",), (None,), (" .. ",)], "t string")
    assert [r.w for r in df.select(leak.plain_words(F.col("t")).alias("w")).collect()] == ["cagri isik igne naive creme".split(), [], None, []]


# ---- subjects ----


def subject_corpus(seed, n=300):
    r = random.Random(seed)
    terms = {s: [f"{s}{'abcdefghijklmnop'[k]}ler" for k in range(12)] for s in ("spor", "hukuk", "yemek")}
    plain = [f"gunluk{c}" for c in "abcdefgh"]
    docs, truth = [], {}
    for i in range(n):
        subjects_of = r.choice([("spor",), ("hukuk",), ("yemek",), ("spor", "yemek"), ()])
        total = r.randint(6, 20)
        sentences = []
        for k in range(total):
            s = subjects_of[k % len(subjects_of)] if subjects_of else None
            w = [r.choice(plain) for _ in range(4)] + ([r.choice(terms[s]) for _ in range(2)] if s else [])
            r.shuffle(w)
            sentences.append(" ".join(w) + ".")
        docs.append((i, " ".join(sentences), r.choice(["web", "forum", None])))
        truth[i] = set(subjects_of)
    return docs, truth


def test_subjects(spark):
    docs, truth = subject_corpus(1)
    extra = [(900, None, "web"), (901, "", None), (902, "The weather is fine today. Nobody knows why.", "web"), (3, docs[3][1], docs[3][2])]
    df = spark.createDataFrame(docs + extra, "doc_id bigint, text string, source string").withColumn("subject", F.lit("x"))
    labels = [(i, s) for i in range(150) for s in truth[i]] + [(7, "spor"), (7, "spor"), (None, "spor"), (5, None), (99999, "hukuk")]
    labels = spark.createDataFrame(labels, "doc_id bigint, subject string")
    names = spark.createDataFrame([("spor",), ("hukuk",), ("yemek",), (None,)], "subject string")
    got = {}
    for r in subjects.found(df, labels, names).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    held = [i for i in truth if i >= 150]
    assert sum(got.get(i, set()) == truth[i] for i in held) >= 0.95 * len(held)
    assert not {900, 901, 902} & set(got)
    assert subjects.found(df, labels.where("doc_id < 0"), names).count() == 0
    assert subjects.found(df.where("doc_id < 0"), labels, names).count() == 0
    total = subjects.composition(df, labels, names).agg(F.sum("documents")).first()[0]
    assert total >= df.select("doc_id").distinct().count()


def test_terms_are_counted_on_all_documents(spark):
    docs, truth = subject_corpus(3, 200)
    docs += [(10_000 + k, text, source) for k, (_, text, source) in enumerate(docs * 30)]
    rare = [(99_000 + k, "sporaler sporbler. sporcler spordler. sporeler sporfler nadirce.", "web") for k in range(3)]
    df = spark.createDataFrame(docs + rare, "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, s) for i in truth for s in truth[i]], "doc_id bigint, subject string")
    model = subjects.fit(subjects.stem_table(df), labels, ["hukuk", "spor", "yemek"])
    rare = spark.range(1).select(F.hash(F.lit("nadir"))).first()[0]
    assert [model.subjects[j] for j in model.speaks_for[model.terms == rare]] == ["spor"]


def test_another_language_is_not_drawn_in(spark):
    """A chance term of a subject stands in every sentence of texts that share nothing else with the labelled ones."""
    docs, truth = subject_corpus(4, 200)
    r = random.Random(1)
    english = [(50_000 + i, " ".join(f"sporaler the {r.choice('abcdefgh')}{r.choice(['harbour', 'lantern', 'kettle', 'orchard'])} was{i % 7} moved again." for _ in range(6)), "web") for i in range(150)]
    plain = [(60_000 + i, t.replace("sporaler", ""), s) for i, t, s in english]
    df = spark.createDataFrame(docs + english + plain, "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, s) for i in truth for s in truth[i]], "doc_id bigint, subject string")
    names = spark.createDataFrame([("hukuk",), ("spor",), ("yemek",)], "subject string")
    got = {x.doc_id for x in subjects.found(df, labels, names).collect()}
    assert not {i for i in got if i >= 60_000} and {i for i in truth if truth[i]} <= got


def test_every_link_is_calibrated_with_few_labels(spark):
    docs, truth = subject_corpus(2, 250)
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, s) for i in truth for s in truth[i]], "doc_id bigint, subject string")
    model = subjects.fit(subjects.stem_table(df), labels, ["hukuk", "spor", "yemek"])
    assert len(model.calibration) == 3 and (1.0, 0.0) not in model.calibration


def test_calibration_undoes_an_overconfident_score():
    r = np.random.default_rng(5)
    z = r.normal(size=600) * 4
    y = (r.random(600) < 1 / (1 + np.exp(-z / 2))).astype(float)
    step = subjects.logistic(np.stack([z, np.ones(600)], 1), y, np.full(2, subjects.SHRINK), offset=z)
    assert abs(1 + step[0] - 0.5) < 0.12 and abs(step[1]) < 0.3


def random_model(seed, k=4):
    r = np.random.default_rng(seed)
    m = subjects.Model([f"s{j}" for j in range(k)], [], [2, 0, 3, 1])
    x = np.hstack([r.random((20, 2 * k + 3)), np.ones((20, 1))])
    width = m.inputs(x, 0).shape[1]
    m.links = [r.normal(size=width + j) * 2 for j in range(k)]
    m.calibration = [(0.8, 0.1)] * k
    return m, x


def test_beam_search_finds_the_best_answers():
    m, x = random_model(3)
    got, odds = m.decode(x)
    for row in range(20):
        every = []
        for code in range(16):
            path = [float(code >> k & 1) for k in range(4)]
            score = 0.0
            for k in range(4):
                z = 0.8 * float(np.concatenate([m.inputs(x[[row]], m.order[k])[0], path[:k]]) @ m.links[k]) + 0.1
                score -= np.log1p(np.exp(-z if path[k] else z))
            every.append((score, path))
        best = max(every)[1]
        assert [bool(got[row, m.order[k]]) for k in range(4)] == [bool(v) for v in best]
        # Over the beam the log odds are those of the most probable combinations.
        top = sorted(every, reverse=True)[: subjects.BEAM]
        for k in range(4):
            yes = sum(np.exp(v) for v, path in top if path[k])
            no = sum(np.exp(v) for v, path in top if not path[k])
            if yes and no and abs(np.log(yes / no)) < 1.5:
                assert abs(np.log(yes / no) - odds[row, m.order[k]]) < 0.7


def test_the_chain_decides(spark):
    """Words of law and economy are shared; which of them a document is about can be told by its source, not by its terms.

    Without the chain (its log odds zero, all subjects allowed) the same evidence gives other rows.
    """
    r = random.Random(5)
    shared, own = [f"ortak{c}x" for c in "abcdefghij"], {"hukuk": ["yasax", "davax"], "ekonomi": ["parax", "borcx"]}
    docs, truth = [], {}
    for i in range(400):
        s = r.choice(["hukuk", "ekonomi", None])
        text = []
        for _ in range(12):
            w = [f"gunluk{c}" for c in r.sample("abcdef", 3)]
            if s and r.random() < 0.75:
                # Mostly shared words; now and then one of the other subject.
                w += r.sample(shared, 2) + ([r.choice(own[s if r.random() < 0.6 else {"hukuk": "ekonomi", "ekonomi": "hukuk"}[s]])] if r.random() < 0.7 else [])
            r.shuffle(w)
            text.append(" ".join(w) + ".")
        docs.append((i, " ".join(text), {"hukuk": "mahkeme", "ekonomi": "borsa", None: "web"}[s]))
        truth[i] = {s} - {None}
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, s) for i in range(200) for s in truth[i]], "doc_id bigint, subject string")
    names = ["ekonomi", "hukuk"]
    table = subjects.stem_table(df)
    model = subjects.fit(table, labels, names)
    rows = table.orderBy("doc_id").toArrow()
    t, source = subjects.Texts.of(rows.column("stems")), rows.column("source").to_pylist()
    right = lambda yes: sum({n for n, v in zip(names, yes[i]) if v} == truth[i] for i in range(200, 400))
    with_chain, _ = model.classify(t, source)
    without = model.shares(t, model.evidence(t)) >= subjects.FULL - 1e-9
    assert right(with_chain) >= 190 and right(without) <= 150
