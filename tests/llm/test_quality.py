"""Quality ledger: measurements, bits, policies and ablations against a plain-Python version."""

import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import quality
from quarry.llm.quality import POLICIES, RULES, Policy, mask

TEXTS = [None, "", "   \n\t", "one two", "a b c d e f g h " * 4, "the quick brown fox " * 30, "same line here\nsame line here\nother\n\nsame line here",
         "# $ % & | < > * word", "東京 は 大きい 街 です", "x" * 1500 + " tail", "- a\n* b\n• c", "open...\nmore… \nend.", "a\x1cb\x85c d e",
         " ".join(f"w{i}" for i in range(40)), " ".join(f"w{i}" for i in range(30_000))]


def expected(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if runs[tuple(words[i:i + 8])] > 1 for j in range(8)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_letter_words": sum(bool(re.search("[A-Za-z\x80-\U0010FFFF]", w)) for w in words), "n_distinct_words": len(set(words)),
        "n_digits": len(re.findall("[0-9]", text)), "max_word_chars": max(map(len, words), default=0),
        "n_bullet_lines": sum(bool(re.match("[ \t]*[-*•]", x)) for x in lines),
        "n_open_lines": sum(x.rstrip(" \t\n\x0b\x0c\r").endswith(("...", "…")) for x in lines)}


def failed(m):
    return [i for i, (_, fails) in enumerate(RULES) if eval(fails, dict(m))]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é東\n\t #.-\x1c", max_size=60)), max_size=6))
def test_measures(texts):
    got = quality.measure(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert {k: int(v[i]) for k, v in got.items()} == expected(t)


def test_ledger_with_edge_cases(spark):
    rows = [(i, t, 5, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", 5, "x"), (3, "one two", 5, "x"), (3, "one two", 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bits int, kept string")
    got = quality.decisions(quality.ledger(docs)).collect()
    want = []
    for doc_id, text, *_ in rows:
        m = expected(text)
        bits = sum(1 << i for i in failed(m))
        want.append((doc_id, *(m[k] for k in quality.MEASURES), bits, ",".join(RULES[i][0] for i in failed(m))))
    key = lambda r: (r[0] is None, r)
    assert sorted(((r.doc_id, *(r[k] for k in quality.MEASURES), r.bits, r.failed_rules) for r in got), key=key) == sorted(want, key=key)
    first = POLICIES[0]
    for r in got:
        assert r.kept == (not r.bits & first.hard and (r.bits & first.soft).bit_count() <= first.allowed)
        assert r.kept_1_strict == (r.bits == 0)
    assert quality.ledger(docs.limit(0)).count() == 0


@pytest.mark.parametrize("policy", [Policy("a", 3, 0b11100, 1), Policy("b", 0b100), Policy("c", 0, 0b1111, 2)])
def test_ablation(spark, policy):
    bits = [0, 1, 2, 3, 4, 0b1100, 0b11100, 0b1111, 1, 4, 4]
    rejects = lambda b: bool(b & policy.hard) or bool(policy.soft) and (b & policy.soft).bit_count() > policy.allowed
    got = quality.ablation(spark.createDataFrame([(b,) for b in bits], "bits long"), [policy]).collect()
    assert len(got) == len(RULES)
    for r in got:
        own = 1 << r.bit
        assert r.n_failed == sum(bool(b & own) for b in bits) and r.n_rejected == sum(map(rejects, bits))
        assert r.n_kept_without == sum(rejects(b) and not rejects(b & ~own) for b in bits)
        assert r.n_rejected_alone == sum(rejects(b & own) for b in bits)
    none = quality.ablation(spark.createDataFrame([], "bits long"), [policy]).collect()
    assert len(none) == len(RULES) and all(r.n_failed == r.n_rejected == 0 for r in none)


def test_bits_keep_their_meaning():
    assert [r[0] for r in RULES[:13]] == ["few_words", "repeated_windows", "symbols", "few_letters", "short_words", "long_words", "repeated_lines",
                                          "digits", "bullets", "open_lines", "endless_word", "few_distinct_words", "many_words"]
    assert mask("few_words", "symbols", "symbols") == 5
