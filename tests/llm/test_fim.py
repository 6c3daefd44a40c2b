"""Fill-in-the-middle: every byte of every text against a plain-Python version."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import fim

TEXTS = [None, "", "a", "one two three", "x<P>y", "<S", "S><M", "naïve café 東京 🙂 end", "\n\t  \r\n", "abc" * 50, "a<S>b <P", "é",
         "under_score-d 12ab34", "word " * 30_000]


def expected(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output, text) of one document."""
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def run(ids, texts):
    parts = [(t or "").encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    data = np.frombuffer(b"".join(parts), np.uint8)
    r = fim.transform(data, bounds, np.array([fim.draws(i) for i in ids], np.int64).reshape(-1, 4))
    back, at = fim.restore(r["data"], r["bounds"], r["plain"], r["spm"])
    got = []
    for k in range(len(ids)):
        plain = r["plain"][k]
        got.append((r["n"][k], "plain" if plain else "spm" if r["spm"][k] else "psm", None if plain else r["prefix_chars"][k],
                    None if plain else r["middle_chars"][k], r["data"][r["bounds"][k]:r["bounds"][k + 1]].tobytes().decode(),
                    back[at[k]:at[k + 1]].tobytes().decode()))
    return got


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab<PSM>é東🙂 \n", max_size=12)), max_size=6), st.integers(0, 10_000),
       st.sampled_from([1, 3, 7, 1 << 20]))
def test_scatter_and_gather(texts, first, block):
    whole, fim.BLOCK = fim.BLOCK, block
    try:
        ids = list(range(first, first + len(texts)))
        assert run(ids, texts) == [expected(i, t) for i, t in zip(ids, texts, strict=True)]
    finally:
        fim.BLOCK = whole


@pytest.mark.parametrize("records", [1, 10_000])
def test_table_with_edge_cases(spark, records):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS * 3)] + [(None, "no id", "x", 1), (3, "one two three", "x", 1), (3, "one two three", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string, n int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    try:
        got = fim.restored(fim.fill_in_middle(docs)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, bytes(r.output).decode(), bytes(r.restored).decode())
                   for r in got), key=key) == sorted(((r[0], *expected(r[0], r[1])) for r in rows), key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.restored(fim.fill_in_middle(docs.limit(0))).count() == 0


def test_a_damaged_output_is_refused():
    text = np.frombuffer(b"<P>a<S>b<M>c", np.uint8)
    yes, no = np.array([True]), np.array([False])
    assert fim.restore(text, np.array([0, 12]), no, no)[0].tobytes() == b"acb"
    for wrong in (b"<P>a<M>b<S>c", b"a<P><S>b<M>c", b"<P>a<S>bc..."):
        with pytest.raises(ValueError):
            fim.restore(np.frombuffer(wrong, np.uint8), np.array([0, 12]), no, no)
    assert fim.restore(text, np.array([0, 12]), yes, no)[0].tobytes() == text.tobytes()


def test_query_covers_its_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {d.doc_id: (*(e := expected(d.doc_id, d.text))[:4], sha(e[4]), sha(e[5])) for d in docs}
    assert {r[0]: tuple(r[1:]) for r in fim.op12_fim(spark, "/root/testdata/sf0.001").collect()} == want
