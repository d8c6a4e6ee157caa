import hashlib

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as T


def one(spark, value, *cols):
    return tuple(spark.createDataFrame([(value,)], "t string").select(*(c(F.col("t")) for c in cols)).first())


@pytest.mark.parametrize("value, want", [
    ("a" * 9 + " b " + "c" * 7, "length"), ("a" * 9 + " b " + "c" * 8, None), ("ab " * 666 + "ab", None), ("ab " * 666 + "abc", "length"),
    ("kelime " + "b" * 20, "few_words"), ("kelime bir " + "b" * 20, None), ("abcde abcd a 1234567890", "low_letters"), ("abcdefgh ab 12345678 ", "low_letters"), ("abcdefgh abc 1234567 89", "low_letters"), ("abcdefghi abc 1234567 1", None),
])
def test_reject_reason_limits(spark, value, want):
    assert one(spark, value, T.reject_reason) == (want,)


def test_letters_exactly_half_are_enough(spark):
    line = "abcdefghijk 12345678 9"
    assert len(line) == 22 and sum(c.isalpha() for c in line) == 11
    assert one(spark, line, T.reject_reason) == (None,)


def test_collapse_space_is_pythons_split(spark):
    for value in ["a\x1c b\x85c d　e\xa0f", "", "  ", "\t x \n"]:
        assert one(spark, value, T.collapse_space) == (" ".join(value.split()),)


def test_dedup_norm(spark):
    got = one(spark, "Ali, VELİ-ve  49!", T.dedup_norm)[0]
    assert got == " ".join("".join(c if c.isalnum() else " " for c in "Ali, VELİ-ve  49!".lower()).split())


def test_turkish_lower_and_words(spark):
    assert one(spark, "ISPARTA İzmir IĞDIR", T.turkish_lower, T.word_string, T.letters_digits) == ("ısparta izmir ığdır", "ısparta izmir ığdır", "ıspartaizmirığdır")


def preview(s, width=600):
    if len(s) <= width:
        return s
    ends = [i for i, c in enumerate(s[width : width + 200]) if c in ".!?"]
    if ends:
        return s[: width + ends[0] + 1]
    blank = s[:width].rfind(" ")
    return s[: blank if blank > 0 else width] + " ..."


@pytest.mark.parametrize("value", ["kısa", "a" * 700, "söz " * 200, "söz " * 160 + "son. " + "x " * 100, "b" * 599 + " c" * 50, " " + "d" * 650])
def test_clip(spark, value):
    assert one(spark, value, T.clip) == (preview(value),)


def test_flags(spark):
    assert one(spark, "BU SATIR BÜYÜK HARFLERLE YAZILDI VE UZUNDUR EPEY", T.all_caps) == (True,)
    assert one(spark, "a a a a a a a a", T.low_variety) == (True,)
    assert one(spark, "a b c d e f g h", T.low_variety) == (False,)
    assert one(spark, "bozuk �", T.has_replacement) == (True,)


def test_hash_fraction_is_sha256(spark):
    assert one(spark, "satır", lambda c: T.hash_fraction(c, "holdout|")) == (int(hashlib.sha256("holdout|satır".encode()).hexdigest()[:15], 16),)


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert tuple(df.select(T.collapse_space(F.col("t")), T.dedup_norm(F.col("t")), T.clip(F.col("t"))).first()) == (None, None, None)
