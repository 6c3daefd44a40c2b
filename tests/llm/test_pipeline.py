"""Every pipeline stage on a small table against plain versions, and the whole run."""

import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from quarry.llm import minhash, mixing, packing, toxicity
from quarry.llm.common import remainder, table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, rid string, score string, id string"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def _rows():
    rng = np.random.default_rng(8)
    out = []
    for i in range(60):
        words = [f"w{x}" for x in rng.integers(0, 4000, 50)]
        for k in range(1 + i % 3):  # up to two copies, one word changed in the last
            copy = list(words)
            if k == 2:
                copy[25] = f"other{i}"
            out.append((10 * i + k, " ".join(copy), "en", "abc"[i % 3], 300, "x", "y", "z", "i"))
    out += [(1000 + i, f"those people are idiotic scum number{i} of {' '.join(f'v{x}' for x in rng.integers(0, 4000, 8))}",
             "en", "a", 9, None, None, None, None) for i in range(40)]
    out += [(2001, None, None, None, None, None, None, None, None), (2002, "", "en", "b", 0, None, None, None, None),
            (None, "write to und.34@mail7.example.com or 4952 9359 0025 3052", None, "b", 9, None, None, None, None),
            (2003, "long word " * 30_000, "en", "c", 9, None, None, None, None), (0, out[0][1], "en", "a", 300, "x", "y", "z", "i")]
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("docs"))
    rows = _rows()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{out}/documents.parquet")
    labels = [(r[0], 1, int("scum" in (r[1] or ""))) for r in rows if r[0] is not None]
    spark.createDataFrame([*labels, (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return out


def _all(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


def _stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "pii", "mixing", "packing"]


def test_toxicity_stage(spark, folder):
    docs = table(spark, folder, "documents")
    got = _all(_stage("toxicity")(spark, docs, folder))
    model = toxicity.toxicity(spark, folder, docs)
    want = Counter()
    for row in _rows():
        want[row] += bool(model.scores(pd.Series([row[1]]))[0] < toxicity.THRESHOLD)
    assert got == +want
    held = {r[0] for r in docs.select("doc_id").where(remainder(docs["doc_id"], 4) == 2).collect()}
    assert held and not any("scum" in (r[1] or "") for r in got) and sum(got.values()) == len(_rows()) - 40


def test_near_dedup_stage(spark, folder):
    docs = table(spark, folder, "documents")
    before = set(os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:")))
    got = _all(_stage("near_dedup")(spark, docs, folder))
    rows = sorted(_rows(), key=lambda r: (r[0] is None, r[0]))
    left = []
    for row in rows:  # groups here are stars: the first of each is like all its others
        if not any(minhash.similarity(row[1], x[1]) >= 0.8 for x in left):
            left.append(row)
    assert got == Counter(left)
    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    new = [d for d in set(os.listdir(root)) - before if d.startswith("llm-minhash-")]
    assert [sorted(os.listdir(f"{root}/{d}")) for d in new] == [["kept"]]  # nothing else stays in the shared folder


def test_pii_stage(spark, folder):
    got = _all(_stage("pii")(spark, table(spark, folder, "documents"), folder))
    same = {r for r in got if r[0] is not None}
    assert Counter({r: got[r] for r in same}) == Counter(r for r in _rows() if r[0] is not None)
    (text,) = [r[1] for r in got if r[0] is None]
    assert "4952 9359" not in text and re.fullmatch(r"write to [a-z]{3}\.[0-9]{2}@mail7\.example\.com or( [0-9]{4}){4}", text)


def test_mixing_stage(spark, folder):
    got = _stage("mixing")(spark, table(spark, folder, "documents"), folder)
    assert got.columns == COLUMNS
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = db.execute(f"SELECT doc_id, source FROM ({mixing.OP7_SQL})").fetchall()
    assert Counter((r["doc_id"], r["source"]) for r in got.collect()) == Counter(want)


def _pieces(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    ids = [np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], dtype="<u4") for x in texts]
    return Counter((i, zlib.crc32(x[at:at + 4096].tobytes())) for x in ids for i, at in enumerate(range(0, len(x), 4096)))


def test_packing_stage(spark, folder):
    got = _stage("packing")(spark, table(spark, folder, "documents"), folder).collect()
    assert Counter((r["piece"], r["ids_crc32"]) for r in got) == _pieces(r[1] for r in _rows())


def test_run_is_the_stages_one_after_another(spark, folder):
    docs = table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    want = _pieces(r["text"] for r in docs.collect())
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r["piece"], r["ids_crc32"]) for r in got) == want and len(got) > 60


def test_run_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
