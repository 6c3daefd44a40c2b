"""Toxicity by a counterfactual-regularised classifier.

A logistic model over the presence of words and word beginnings.  While it is fitted, every labelled sentence that
names a group of people is written again with each other group of its kind, and the squared difference of the two
scores is penalised, so a neutral mention of a group carries no weight of its own.

Stages: (1) a bounded sample of the labelled rows (``max_rows``, by a hash of the id) is joined with its texts;
(2) Spark counts, for every feature, the toxic and the clean rows that hold it; a likelihood-ratio test keeps those
that tell the labels apart; (3) the rows and the counterfactual pairs, as lists of kept features, are fitted with
numpy; (4) every whole text of the table is scored inside Spark tasks with the fitted weights.

Defined cases: a null text scores as an empty one; a null id is not held out and never a training row; repeated
labels of an id count once (the largest); without any toxic label every score is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, remainder, table

#: Words that name groups of people, by kind; a word is swapped only for others of its kind.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "hispanic", "arab"),
    ("mexican", "chinese", "indian", "african", "american", "european"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("disabled", "blind", "deaf"),
    ("old", "young"),
)
PREFIXES = (4, 5, 6)
HELD_FEATURES = 200_000  # counts a task holds before it hands them on
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def features(text: str) -> set[str]:
    """Words (``=word``) and beginnings of longer words (``word-``) of a text, each once."""
    words = set(_WORD.findall(text.lower()))
    out = {f"={w}" for w in words}
    for k in PREFIXES:
        out.update(f"{w[:k]}-" for w in words if len(w) > k)
    return out


def swapped(sentence: str, terms=IDENTITY_TERMS) -> list[tuple[str, str]]:
    """``(sentence, counterfactual)`` for every identity term that occurs and every other term of its kind."""
    low, out = sentence.lower(), []
    words = set(_WORD.findall(low))
    for kind in terms:
        for term in words.intersection(kind):
            out += [(low, re.sub(rf"\b{re.escape(term)}\b", other, low)) for other in kind if other != term]
    return out


@dataclass
class Model:
    bias: float = -50.0
    weights: dict[str, float] = field(default_factory=dict)

    def scores(self, texts: pd.Series) -> pd.Series:
        by_word = {k[1:]: v for k, v in self.weights.items() if k[0] == "="}
        heads = {k: {w[:-1]: v for w, v in self.weights.items() if w[0] != "=" and len(w) == k + 1} for k in PREFIXES}
        out = np.full(len(texts), self.bias)
        for i, text in enumerate(texts):
            if not text:
                continue
            words = set(_WORD.findall(text.lower()))
            z = sum(by_word[w] for w in sorted(w for w in words if w in by_word))
            for k, own in heads.items():
                z += sum(own[h] for h in sorted({w[:k] for w in words if len(w) > k and w[:k] in own}))
            out[i] += z
        return pd.Series(1 / (1 + np.exp(-np.clip(out, -50, 50))) * (out > -49))


def fit_weights(rows, labels, pairs, n_features: int, l2: float, counterfactual: float, steps: int = 600):
    """Bias and weights that minimise log loss + ``l2``/2 |w|^2 + ``counterfactual`` * sum n (w . difference)^2.

    ``rows`` are lists of feature numbers; ``pairs`` are (features of the sentence, features of its
    counterfactual, how often).  Plain Adam steps on the whole (convex) objective."""
    where = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    which = np.array([f for r in rows for f in r], dtype=np.int64)
    y = np.asarray(labels, dtype=float)
    p_where = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b, _ in pairs])
    p_which = np.array([f for a, b, _ in pairs for f in (*a, *b)], dtype=np.int64)
    p_sign = np.array([s for a, b, _ in pairs for s in [1.0] * len(a) + [-1.0] * len(b)])
    p_n = np.array([n for *_, n in pairs], dtype=float)
    w = np.zeros(n_features + 1)
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = np.bincount(where, w[which], len(rows)) + w[-1]
        r = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - y
        g = np.append(np.bincount(which, r[where], n_features) + l2 * w[:-1], r.sum())
        if len(pairs):
            d = 2 * counterfactual * p_n * np.bincount(p_where, p_sign * w[p_which], len(pairs))
            g[:-1] += np.bincount(p_which, p_sign * d[p_where], n_features)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 / (1 + t / 100) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w[-1], w[:-1]


def fit(train: DataFrame, scratch: Scratch, text: str = "text", label: str = "toxic", counterfactual: float = 5.0,
        l2: float = 0.5, min_g2: float = 25.0, max_features: int = 20_000, terms=IDENTITY_TERMS) -> Model:
    """Fit on ``train`` (a text and a 0/1 label a row).  ``min_g2`` is the likelihood-ratio statistic that a feature
    must reach; ``max_features`` bounds the model (the strongest stay)."""
    train = train.select(F.coalesce(F.col(text), F.lit("")).alias("text"), (F.col(label) > 0).cast("int").alias("y"))
    train = scratch.put(train.where("y is not null"), "train")
    n, n_toxic = train.select(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not n_toxic:
        return Model()
    if n_toxic == n:
        return Model(bias=6.0)

    def count(batches):
        clean, toxic = Counter(), Counter()

        def emitted():
            names = sorted(clean.keys() | toxic.keys())
            for i in range(0, len(names), 50_000):
                part = names[i:i + 50_000]
                yield pd.DataFrame({"feature": part, "a": [toxic[f] for f in part], "b": [clean[f] for f in part]})
            clean.clear()
            toxic.clear()

        for pdf in batches:
            for x, y in zip(pdf["text"], pdf["y"], strict=True):
                (toxic if y else clean).update(features(x))
                if len(clean) + len(toxic) >= HELD_FEATURES:
                    yield from emitted()
        yield from emitted()

    counts = (train.mapInPandas(count, "feature string, a long, b long")
              .groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    a, b, big_a, big_b = F.col("a"), F.col("b"), F.lit(float(n_toxic)), F.lit(float(n - n_toxic))

    def term(seen, total, share):  # seen * ln(seen / expected), 0 where nothing was seen
        return F.when(seen > 0, seen * F.ln(seen / (total * share))).otherwise(0.0)

    share = (a + b) / F.lit(float(n))
    g2 = 2 * (term(a, big_a, share) + term(b, big_b, share) + term(big_a - a, big_a, 1 - share)
              + term(big_b - b, big_b, 1 - share))
    kept = sorted(r["feature"] for r in counts.withColumn("g2", g2).where(F.col("g2") >= min_g2)
                  .orderBy(F.desc("g2"), "feature").limit(max_features).select("feature").collect())
    number = {f: i for i, f in enumerate(kept)}

    def encode(batches):
        for pdf in batches:
            pairs = Counter()
            rows = [sorted(number[f] for f in features(x) if f in number) for x in pdf["text"]]
            for x in pdf["text"]:
                for s in _SENTENCE.split(x):
                    for old, new in swapped(s, terms):
                        old_f, new_f = features(old), features(new)
                        key = tuple(tuple(sorted(number[f] for f in one - other if f in number))
                                    for one, other in ((old_f, new_f), (new_f, old_f)))
                        if key[0] or key[1]:
                            pairs[key] += 1
            yield pd.DataFrame({"y": [*pdf["y"].astype(int), *[-1] * len(pairs)],
                                "f": [*rows, *(list(k[0]) for k in pairs)],
                                "g": [*([] for _ in rows), *(list(k[1]) for k in pairs)],
                                "n": [*[1] * len(rows), *pairs.values()]})

    # equal rows are summed before they are fitted: at most max_rows of them
    got = (train.mapInPandas(encode, "y int, f array<int>, g array<int>, n long")
           .groupBy("y", "f", "g").agg(F.sum("n").alias("n")).orderBy("y", "f", "g").toPandas())
    seen, pairs = got[got["y"] >= 0], got[got["y"] < 0]
    rows = [list(f) for f, k in zip(seen["f"], seen["n"], strict=True) for _ in range(k)]
    y = np.repeat(seen["y"].to_numpy(), seen["n"].to_numpy())
    bias, w = fit_weights(rows, y, [(list(f), list(g), k) for f, g, k in zip(pairs["f"], pairs["g"], pairs["n"],
                                                                           strict=True)],
                          len(kept), l2, counterfactual)
    return Model(float(bias), {f: float(x) for f, x in zip(kept, w, strict=True)})


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> DataFrame:
    """Labelled rows that may be learnt from (crc32 remainder not 2): about ``max_rows`` of them at most, picked by a
    hash of the id, with their whole texts."""
    known = (labels.select("doc_id", "toxic").where("doc_id is not null and toxic is not null")
             .where(remainder(F.col("doc_id"), 4) != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    share = max_rows / max(1, known.count())
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    return docs.select("doc_id", "text").join(known, "doc_id").select("text", "toxic")


def score(text: Column, model: Model) -> Column:
    """Column of scores; the weights travel with the task."""
    return F.pandas_udf(lambda s: model.scores(s), "double")(text)


def toxicity(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> Model:
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    with Scratch(spark, "toxicity") as scratch:
        return fit(training_rows(docs, table(spark, sf_dir, "labels")), scratch)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``: doc_id, held_out, score, predicted (1 from a score of 0.3)."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity(spark, sf_dir, docs)
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return (docs.select("doc_id", held.alias("held_out"), score(F.col("text"), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: documents with a score of 0.3 or more go."""
    model = toxicity(spark, sf_dir, docs)
    return docs.where(score(docs["text"], model) < THRESHOLD)
