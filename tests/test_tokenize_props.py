"""Tokenizers against plain-Python statements of their rules, on many random
strings at once (one Spark job per tokenizer)."""

import random
import re

from pyspark.sql import functions as F

from quarry.functions import tokenize as T

ALPHABET = [" ", " ", "a", "b", "\t", "\\", "\n", "x"]


def _strings(n=300, seed=11):
    rnd = random.Random(seed)
    out = ["", " ", "  ", "\\", "\\ ", "a\\\\ b"]
    for _ in range(n):
        out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 12))))
    return out


def _java_split(s, sep=" "):
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def _escaped_split(s, sep=" ", esc="\\"):
    out, cur, odd = [], [], False
    for ch in s:
        if not odd and ch == sep:
            out.append("".join(cur))
            cur = []
            continue
        cur.append(ch)
        odd = (not odd) if ch == esc else False
    out.append("".join(cur))
    while out and out[-1] == "":
        out.pop()
    return out


RULES = {
    "collapse": lambda s: [w for w in s.split(" ") if w],
    "java": _java_split,
    "keep_all": lambda s: s.split(" "),
    "tokenizer": lambda s: [w for w in re.split("[ \t\n\r\f]+", s) if w],
    "escaped": _escaped_split,
    "whitespace": lambda s: [w for w in re.split("[ \t\n\r\f\v\x1c-\x1f]+", s) if w],
}


def test_tokenizers_follow_their_rules(spark):
    data = _strings()
    df = spark.createDataFrame([(i, s) for i, s in enumerate(data)], "i int, s string")
    cols = [T.get_tokenizer(name)(F.col("s")).alias(name) for name in RULES]
    for r in df.select("i", *cols).collect():
        s = data[r["i"]]
        for name, rule in RULES.items():
            assert list(r[name]) == rule(s), (name, repr(s))


def test_java_trim_rule(spark):
    from quarry.functions.columns import java_trim

    data = _strings(seed=5) + ["\x01 a \x1f", "\x00"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(data)], "i int, s string")
    control = "".join(chr(c) for c in range(33))
    for r in df.select("i", java_trim("s").alias("t")).collect():
        assert r["t"] == data[r["i"]].strip(control)
