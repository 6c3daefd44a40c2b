"""Tokenizer families on FIXTURES A5: they differ only on empties."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import columns as C
from quarry.functions import tokenize as T

LINES = [" a  b ", "", "a\tb", "the cow jumped over the moon", "foo\\ bar foo"]


def _apply(spark, fn):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(LINES)], "i int, s string")
    return {r["i"]: list(r["w"]) for r in df.select("i", fn(F.col("s")).alias("w")).collect()}


def test_collapse(spark):
    out = _apply(spark, T.split_collapse)
    assert out[0] == ["a", "b"]
    assert out[1] == []
    assert out[2] == ["a\tb"]


def test_java_split(spark):
    out = _apply(spark, T.java_split)
    assert out[0] == ["", "a", "", "b"]
    assert out[1] == [""]
    assert out[3] == ["the", "cow", "jumped", "over", "the", "moon"]


def test_java_split_all_separators(spark):
    df = spark.createDataFrame([("   ",), ("a b  ",)], "s string")
    got = [list(r[0]) for r in df.select(T.java_split(F.col("s"))).collect()]
    assert got == [[], ["a", "b"]]


def test_keep_all(spark):
    out = _apply(spark, T.split_keep_all)
    assert out[0] == ["", "a", "", "b", ""]


def test_tokenizer_and_whitespace(spark):
    for fn in (T.split_tokenizer, T.split_whitespace):
        out = _apply(spark, fn)
        assert out[0] == ["a", "b"]
        assert out[2] == ["a", "b"]
        assert out[1] == []


def test_escaped_split(spark):
    out = _apply(spark, T.split_escaped)
    assert out[0] == ["", "a", "", "b"]      # trailing empty dropped
    assert out[1] == []
    assert out[4] == ["foo\\ bar", "foo"]    # escaped separator kept, escape kept


def test_escaped_split_double_escape(spark):
    df = spark.createDataFrame([("a\\\\ b",)], "s string")
    assert list(df.select(T.split_escaped(F.col("s"))).first()[0]) == ["a\\\\", "b"]


def test_regex_words(spark):
    df = spark.createDataFrame([("Cat cat dog the",), ("dog 9x a_b Bird",)], "s string")
    got = [list(r[0]) for r in df.select(T.regex_words(F.col("s"))).collect()]
    assert got == [["cat", "cat", "dog", "the"], ["dog", "9x", "a_b", "bird"]]


def test_head_and_rest(spark):
    df = spark.createDataFrame([("u1,a,b",), ("u2",)], "s string")
    head, rest = T.head_and_rest(F.col("s"))
    got = [(r[0], list(r[1])) for r in df.select(head, rest).collect()]
    assert got == [("u1", ["a", "b"]), ("u2", [])]


def test_unknown_tokenizer():
    with pytest.raises(ValueError):
        T.get_tokenizer("nope")


def test_java_trim_and_format(spark):
    df = spark.createDataFrame([("\t CA \n", 0.5, 1.123456789, 0.0)], "s string, a double, b double, c double")
    r = df.select(C.java_trim("s"), C.format_decimals("a"), C.format_decimals("b"),
                  C.format_decimals("c"), C.fixed_width(F.lit("x"), F.lit(3), 5)).first()
    assert r[0] == "CA"
    assert (r[1], r[2], r[3]) == ("0.5", "1.12345679", "0")
    assert r[4] == "x    3"


def test_reformat_date_and_coerce(spark):
    df = spark.createDataFrame([("2009-01-02", None), ("bad", "1.5")], "d string, v string")
    got = df.select(C.reformat_date("d"), C.coerce_double("v")).collect()
    assert [tuple(r) for r in got] == [("2009", 0.0), ("Invalid Date", 1.5)]


def test_first_char_partition_non_negative(spark):
    df = spark.createDataFrame([("apple",), ("0zero",), ("Zed",)], "k string")
    got = [r[0] for r in df.select(C.first_char_partition("k", 3, base="A")).collect()]
    assert all(0 <= g < 3 for g in got)


def test_split_escaped_takes_control_characters_as_text(spark):
    texts = ["a\\ b x\u0001y \u0002z", "\u0001\u0004 \\ \u0001\u0005", "\\\u0001 \u0003\\\\ q\u0001", "\u0001\u0003 \\x"]
    want = [["a\\ b", "x\u0001y", "\u0002z"], ["\u0001\u0004", "\\ \u0001\u0005"], ["\\\u0001", "\u0003\\\\", "q\u0001"],
            ["\u0001\u0003", "\\x"]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["w"] for r in df.select("i", T.split_escaped("t").alias("w")).orderBy("i").collect()]
    assert got == want
