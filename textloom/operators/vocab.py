"""Public subword vocabularies as tables, encoding and decoding, and what is measured with them.

Vocabularies are read, never trained. Their folder is a parameter.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import TURKISH_LETTERS

FOLDER = "/opt/tokenizers"
NAMES = ("byte_bpe_50k", "word_bpe_49k", "piece_bpe_32k")
# Parts of tokens that come from web addresses.
URL_PARTS = ["http", ".com", ".aspx", "?", "="]
# Memory of the two standard machines in MB, the safety factor and the deviation that calls for a warning in percent.
STANDARD_MB, LARGE_MB, SAFETY, DEVIATION = 12_700, 51_000, 1.3, 15.0


class Vocabulary:
    """Encoding and decoding with one public vocabulary, loaded once a worker."""

    def __init__(self, path: str) -> None:
        self.pieces = path.endswith(".model")
        if self.pieces:
            import sentencepiece

            self.tool = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer

            self.tool = Tokenizer.from_file(path)
            self.tool.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.pieces:
            return self.tool.encode(texts, num_threads=1)
        return [e.ids for e in self.tool.encode_batch(texts, add_special_tokens=False)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        if self.pieces:
            return [self.tool.decode(x) for x in ids]
        return self.tool.decode_batch(ids, skip_special_tokens=False)

    def tokens(self) -> list[tuple[int, str]]:
        if self.pieces:
            return [(i, self.tool.id_to_piece(i)) for i in range(self.tool.get_piece_size())]
        return sorted((i, t) for t, i in self.tool.get_vocab(with_added_tokens=True).items())


def vocabulary_path(name: str, folder: str = FOLDER) -> str:
    return f"{folder}/{name}.model" if name.startswith("piece") else f"{folder}/{name}.json"


@lru_cache(maxsize=8)
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(text: Column, path: str) -> Column:
    """The token ids of a text; null for null."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        some = texts[texts.notna()]
        out = pd.Series([None] * len(texts), index=texts.index, dtype=object)
        out.loc[some.index] = pd.Series(load(path).encode(some.tolist()), index=some.index, dtype=object) if len(some) else None
        return out

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """The text of token ids; null for null."""

    @F.pandas_udf("string")
    def texts(rows: pd.Series) -> pd.Series:
        some = rows[rows.notna()]
        out = pd.Series([None] * len(rows), index=rows.index, dtype=object)
        if len(some):
            out.loc[some.index] = load(path).decode([[int(i) for i in r] for r in some])
        return out

    return texts(ids)


def nfkc(text: Column) -> Column:
    """Compatibility normal form; plain ASCII never goes to Python."""

    @F.pandas_udf("string")
    def normal(texts: pd.Series) -> pd.Series:
        return texts.str.normalize("NFKC")

    plain = text.rlike(r"^[\x00-\x7F]*$")
    return F.when(plain, text).otherwise(normal(F.when(~plain, text)))


def vocab_table(spark: SparkSession, path: str) -> DataFrame:
    """(id, token); tens of thousands of rows at most."""
    return spark.createDataFrame(pd.DataFrame(load(path).tokens(), columns=["id", "token"]), "id int, token string")


def vocab_profile(vocab: DataFrame) -> DataFrame:
    """(tokens, url_like, url_percent, turkish, turkish_percent, longest)."""
    url = F.lit(False)
    for p in URL_PARTS:
        url = url | F.contains("token", F.lit(p))
    turkish = F.col("token").rlike(f"[{TURKISH_LETTERS}]")
    x = vocab.agg(F.count(F.lit(1)).alias("tokens"), F.sum(url.cast("int")).alias("url_like"), F.sum(turkish.cast("int")).alias("turkish"), F.max(F.length("token")).alias("longest"))
    pct = lambda c: F.round(F.col(c) * 100.0 / F.col("tokens"), 4)
    return x.select("tokens", "url_like", pct("url_like").alias("url_percent"), "turkish", pct("turkish").alias("turkish_percent"), "longest")


def long_words(vocab: DataFrame, k: int = 20) -> DataFrame:
    """The k longest tokens that are words of letters only, without their mark for a blank."""
    x = vocab.withColumn("word", F.regexp_replace("token", "^[Ġ▁]|</w>$", "")).where(F.col("word").rlike(r"^\p{L}{6,}$"))
    return x.select("id", "word", F.length("word").alias("length")).orderBy(F.desc("length"), "word", "id").limit(k)


def vocab_mapping(old: DataFrame, new: DataFrame) -> DataFrame:
    """(old_id, new_id, token) of tokens that both vocabularies have."""
    return old.select(F.col("id").alias("old_id"), "token").join(new.select(F.col("id").alias("new_id"), "token"), "token").select("old_id", "new_id", "token")


def token_frequency(pieces: DataFrame, path: str) -> DataFrame:
    """(token_id, n) over a corpus, each distinct piece (piece, n) encoded once."""
    text = F.regexp_replace("piece", "^▁", " ")
    return pieces.select(F.explode(encode(text, path)).alias("token_id"), "n").groupBy("token_id").agg(F.sum("n").alias("n"))


def fertility(lines: DataFrame, path: str) -> DataFrame:
    """(source, lines, words, tokens, fertility, chars_per_token, whole_word_percent)."""
    x = lines.where("source is not null and line <> ''").withColumn("k", F.size(encode(F.col("line"), path)))
    x = x.groupBy("source").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.size(F.split("line", " "))).alias("words"), F.sum("k").alias("tokens"), F.sum(F.length("line")).alias("chars"))
    return x.select("source", "lines", "words", "tokens", F.round(F.col("tokens") / F.col("words"), 4).alias("fertility"), F.round(F.col("chars") / F.col("tokens"), 4).alias("chars_per_token"))


def continued_words(words: DataFrame, path: str) -> DataFrame:
    """(words, continued, percent): running words (word, n) that take more than one token, each distinct word encoded once."""
    x = words.withColumn("k", F.size(encode(F.concat(F.lit(" "), F.col("word")), path)))
    x = x.agg(F.sum("n").alias("words"), F.sum(F.when(F.col("k") > 1, F.col("n")).otherwise(0)).alias("continued"))
    return x.withColumn("percent", F.round(F.col("continued") * 100.0 / F.col("words"), 4))


def register_eval(lines: DataFrame, ours: str, others: list[str]) -> DataFrame:
    """(source, ours, best_other, gain): tokens a source takes, and the gain over the best other vocabulary in percent."""
    cols = {f"t{i}": F.size(encode(F.col("line"), p)) for i, p in enumerate([ours, *others])}
    x = lines.where("source is not null and line <> ''").withColumns(cols).groupBy("source").agg(*(F.sum(c).alias(c) for c in cols))
    rest = [F.col(c) for c in list(cols)[1:]]
    best = F.least(*rest) if len(rest) > 1 else rest[0]
    return x.select("source", F.col("t0").alias("ours"), best.alias("best_other"), F.round((best - F.col("t0")) * 100.0 / best, 4).alias("gain"))


def learned_words(words: DataFrame, path: str, most: int = 3) -> DataFrame:
    """(word, tokens, learned): a word in few tokens counts as learned."""
    x = words.withColumn("tokens", F.size(encode(F.concat(F.lit(" "), F.col("word")), path)))
    return x.select("word", "tokens", (F.col("tokens") <= most).alias("learned"))


# Scripts, signs and joined characters that a vocabulary should survive, for information.
EXOTIC = ["日本語のテキスト", "مرحبا بالعالم", "Γειά σου Κόσμε", "👩‍👩‍👧‍👦 🇹🇷", "∑∫√≠≤", "e\u0301 a\u0308", "\u200bsıfır\u200b", "½ ¼ № ™"]


def unknown_id(path: str) -> int | None:
    """The id that stands for what a vocabulary can't write; null for none."""
    v = load(path)
    if v.pieces:
        return v.tool.unk_id()
    token = getattr(v.tool.model, "unk_token", None)
    return v.tool.token_to_id(token) if token else None


def validation(texts: DataFrame, vocab: DataFrame, path: str, special: dict[str, int], longest: int | None = None) -> DataFrame:
    """(check, passed, failed, blocking) of a vocabulary over texts (text) and its table.

    Round trip, letter case kept, exotic texts (for information), and (blocking) no
    unknown token, something for every text, special ids in their places, ids
    without gaps, and token length.
    """
    spark, unknown = vocab.sparkSession, unknown_id(path)
    trips = lambda df: df.withColumn("ids", encode(F.col("text"), path)).withColumn("back", F.trim(decode(F.col("ids"), path)))
    x = trips(texts.where("text is not null and text <> ''"))
    whole = F.trim("text")
    x = x.select((F.col("back") == whole).alias("same"), (F.lower("back") == F.lower(whole)).alias("fold"), (F.size("ids") > 0).alias("some"), (~F.array_contains("ids", unknown if unknown is not None else -1)).alias("known"))
    x = x.withColumn("kept", F.col("same") | ~F.col("fold"))
    names = {"same": ("round trip", False), "kept": ("letter case", False), "known": ("no unknown token", True), "some": ("load", True)}
    one = x.agg(*(F.struct(F.count(F.when(F.col(c), 1)).alias("passed"), F.count(F.when(~F.col(c), 1)).alias("failed")).alias(c) for c in names))
    out = one.select(F.inline(F.array(*(F.struct(F.lit(n).alias("check"), F.col(f"{c}.passed").alias("passed"), F.col(f"{c}.failed").alias("failed"), F.lit(b).alias("blocking")) for c, (n, b) in names.items()))))
    count = lambda df, name, blocking: df.agg(F.count(F.when(F.col("ok"), 1)).alias("passed"), F.count(F.when(~F.col("ok"), 1)).alias("failed")).select(F.lit(name).alias("check"), "passed", "failed", F.lit(blocking).alias("blocking"))
    exotic = trips(spark.createDataFrame([(t,) for t in EXOTIC], "text string"))
    out = out.unionByName(count(exotic.select((F.col("back") == whole).alias("ok")), "exotic texts", False))
    spots = spark.createDataFrame([(t, i) for t, i in special.items()], "token string, want int").join(vocab, "token", "left").select(F.coalesce(F.col("id") == F.col("want"), F.lit(False)).alias("ok"))
    out = out.unionByName(count(spots, "special ids", True))
    out = out.unionByName(count(vocab.agg((F.max("id") + 1 == F.countDistinct("id")).alias("ok")), "ids without gaps", True))
    if longest is not None:
        out = out.unionByName(count(vocab.select((F.length("token") <= longest).alias("ok")), "token length", True))
    return out


def id_samples(vocab: DataFrame, starts: list[int], each: int = 20) -> DataFrame:
    """(id, token) of ``each`` ids from every start on: what early, middle and late merges look like."""
    inside = F.lit(False)
    for a in starts:
        inside = inside | F.col("id").between(a, a + each - 1)
    return vocab.where(inside).select("id", "token")


def capacity_plan(points: DataFrame, target: int) -> DataFrame:
    """(target, ram_mb, seconds, needed_mb, deviation, warn, verdict) from measured points (vocab, ram_mb, seconds).

    A line through the smallest and the largest point; the middle one tests it.
    """
    p = points.agg(F.min_by(F.struct("vocab", "ram_mb", "seconds"), "vocab").alias("a"), F.max_by(F.struct("vocab", "ram_mb", "seconds"), "vocab").alias("b"), F.sort_array(F.collect_list(F.struct("vocab", "ram_mb"))).alias("all"), F.count(F.lit(1)).alias("k"))
    at = lambda f, v: F.col(f"a.{f}") + F.coalesce((F.col(f"b.{f}") - F.col(f"a.{f}")) / F.nullif(F.col("b.vocab") - F.col("a.vocab"), F.lit(0)), F.lit(0.0)) * (v - F.col("a.vocab"))
    p = p.withColumn("mid", F.when(F.col("k") >= 3, F.element_at("all", 2)))
    expected = at("ram_mb", F.col("mid.vocab"))
    p = p.withColumns({"ram": at("ram_mb", F.lit(target)), "sec": at("seconds", F.lit(target)), "dev": F.abs(F.col("mid.ram_mb") - expected) / F.greatest(expected, F.lit(1.0)) * 100})
    need = F.col("ram") * SAFETY
    verdict = F.when(need < STANDARD_MB, "standard").when(need < LARGE_MB, "large").otherwise("too large")
    return p.select(F.lit(target).alias("target"), F.round("ram", 3).alias("ram_mb"), F.round("sec", 3).alias("seconds"), F.round(need, 3).alias("needed_mb"), F.round("dev", 3).alias("deviation"), F.coalesce(F.col("dev") > DEVIATION, F.lit(False)).alias("warn"), verdict.alias("verdict"))


def show(text: str, path: str, width: int = 80) -> str:
    """Tokens of a text for people: a leading blank as _, bytes that make no character by themselves grouped, lines wrapped."""
    v = load(path)
    out, held = [], []
    for i in v.encode([text])[0]:
        held.append(i)
        piece = v.decode([held])[0]
        if "�" not in piece:
            out.append("_" + piece[1:] if piece.startswith(" ") else piece)
            held = []
    if held:
        out.append(v.decode([held])[0])
    lines, line = [], ""
    for t in out:
        if line and len(line) + 3 + len(t) > width:
            lines.append(line)
            line = ""
        line = f"{line} | {t}" if line else t
    return "\n".join([*lines, line])


def save_table(vocab: DataFrame, path: str, trial: bool = False) -> None:
    """Writes a vocabulary table once; an existing one is never replaced. A trial goes beside it."""
    vocab.coalesce(1).write.mode("errorifexists").parquet(path + ("-trial" if trial else ""))


