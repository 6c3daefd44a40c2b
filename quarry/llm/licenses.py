"""License scan by ordered signature rules, in DataFrame functions only.

A text becomes its words (A-Z lower-cased) between single spaces.  Rules are regular expressions over them, built from
a list of license families, their versions and a list of leads ("licensed under the", "spdx license identifier", ...),
each with the keyword that must occur before it is tried and a priority.  A detection is an interval of words; it is
suppressed if it lies inside one of equal or higher priority (equal intervals: the first label stays).

Defined cases: null and empty texts have no words and no labels; repeated rows are answered alike; other columns are
not looked at; an empty table stays empty.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import table

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: label, keyword, name, versions; {v} in the name stands for the version's pattern; every match holds the keyword
FAMILIES = [
    ("apache", "apache", "apache(?: software)?(?: foundation)?(?: license)?{v}", ("1 0", "1 1", "2 0")),
    ("gpl", "general public license", "(?:gnu )?general public license{v}", ("1 0", "2 0", "3 0")),
    ("lgpl", "lesser general public license", "(?:gnu )?lesser general public license{v}", ("2 1", "3 0")),
    ("agpl", "affero general public license", "(?:gnu )?affero general public license{v}", ("1 0", "3 0")),
    ("gpl", "gpl", "(?:gnu )?gpl{v}", ("1 0", "2 0", "3 0")),
    ("lgpl", "lgpl", "(?:gnu )?lgpl{v}", ("2 0", "2 1", "3 0")),
    ("agpl", "agpl", "(?:gnu )?agpl{v}", ("1 0", "3 0")),
    ("fdl", "gfdl", "(?:gnu )?gfdl{v}", ("1 1", "1 2", "1 3")),
    ("cddl", "cddl", "cddl{v}", ("1 0", "1 1")),
    ("eupl", "eupl", "eupl{v}", ("1 1", "1 2")),
    ("fdl", "free documentation license", "(?:gnu )?free documentation license{v}", ("1 1", "1 2", "1 3")),
    ("mpl", "mozilla public license", "mozilla public license{v}", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse public license", "eclipse public license{v}", ("1 0", "2 0")),
    ("cddl", "common development and distribution license", "common development and distribution license{v}", ("1 0", "1 1")),
    ("eupl", "european union public", "european union public licen[cs]e{v}", ("1 1", "1 2")),
    ("osl", "open software license", "open software license{v}", ("1 0", "2 0", "3 0")),
    ("artistic", "artistic license", "artistic license{v}", ("1 0", "2 0")),
    ("cc-by", "cc by", "cc by{v}", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "cc by", "cc by sa{v}", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "cc by", "cc by nc{v}", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "cc by", "cc by nd{v}", ("2 0", "3 0", "4 0")),
    ("cc-by-nc-sa", "cc by", "cc by nc sa{v}", ("2 0", "3 0", "4 0")),
    ("cc-by-nc-nd", "cc by", "cc by nc nd{v}", ("2 0", "3 0", "4 0")),
    ("cc-by", "creative commons attribution", "creative commons attribution(?: license)?{v}", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "creative commons attribution", "creative commons attribution share ?alike(?: license)?{v}", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "creative commons attribution", "creative commons attribution non ?commercial(?: license)?{v}", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "creative commons attribution", "creative commons attribution no ?deriv(?:ative)?s?(?: license)?{v}", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", "creative commons attribution", "creative commons attribution non ?commercial share ?alike(?: license)?{v}", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", "creative commons attribution", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: license)?{v}", ("2 0", "2 5", "3 0", "4 0")),
    ("cc0", "cc0", "cc0{v}", ("1 0",)),
    ("cc0", "creative commons zero", "creative commons zero{v}", ("1 0",)),
    ("bsd-2-clause", "bsd", "(?:simplified|2 clause) bsd(?: license)?", ()),
    ("bsd-3-clause", "bsd", "(?:new|modified|3 clause) bsd(?: license)?", ()),
    ("bsd-2-clause", "bsd 2 clause", "bsd 2 clause", ()),
    ("bsd-3-clause", "bsd 3 clause", "bsd 3 clause", ()),
    ("bsd", "bsd", "bsd(?: style)? license", ()),
    ("mit", "mit", "mit license", ()),
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", ()),
    ("isc", "isc", "isc license", ()),
    ("zlib", "zlib", "zlib(?: libpng)? license", ()),
    ("boost", "boost software license", "boost software license{v}", ("1 0",)),
    ("unlicense", "unlicense", "(?:the )?unlicense", ()),
    ("wtfpl", "wtfpl", "wtfpl", ()),
    ("odbl", "open database license", "open database license{v}", ("1 0",)),
    ("odbl", "odbl", "odbl{v}", ("1 0",)),
    ("ofl", "ofl", "(?:sil )?ofl{v}", ("1 0", "1 1")),
    ("ofl", "open font license", "(?:sil )?open font license{v}", ("1 0", "1 1")),
    ("postgresql", "postgresql", "postgresql license", ()),
    ("python", "python software foundation", "python software foundation license{v}", ("2 0",)),
    ("public-domain", "the public domain", "(?:in|into|to) the public domain", ()),
    ("reserved", "all rights reserved", "all rights reserved", ()),
    ("proprietary", "proprietary and confidential", "proprietary and confidential", ()),
]
#: short and SPDX names that also mean something else: they count behind a lead of priority 3 or more, or with a version
SHORT = [
    ("mpl", "mpl", "mpl{v}", ("1 0", "1 1", "2 0")),
    ("epl", "epl", "epl{v}", ("1 0", "2 0")),
    ("osl", "osl", "osl{v}", ("1 0", "2 0", "3 0")),
    ("artistic", "artistic", "artistic{v}", ("1 0", "2 0")),
    ("boost", "bsl", "bsl{v}", ("1 0",)),
    ("boost", "boost", "boost{v}", ("1 0",)),
    ("python", "psf", "psf{v}", ("2 0",)),
]
#: those that count behind such a lead only
LED = [
    ("bsd", "bsd", "bsd", ()),
    ("mit", "mit", "mit", ()),
    ("mit", "expat", "expat", ()),
    ("isc", "isc", "isc", ()),
    ("zlib", "zlib", "zlib", ()),
    ("postgresql", "postgresql", "postgresql", ()),
    ("python", "python", "python{v}", ("2 0",)),
]
#: lead, priority; a name alone comes last
LEADS = [
    ("spdx license identifier ", 4),
    ("(?:dual |multi )?licen[cs]ed under(?: the)?(?: terms of)?(?: the)? ", 3),
    ("licen[cs]ed with(?: the)? ", 3),
    ("(?:released|distributed|published|available|provided|covered) under(?: the)?(?: terms of)?(?: the)? ", 3),
    ("(?:governed by|subject to)(?: the)?(?: terms of)?(?: the)? ", 2),
    ("under the terms of(?: the)? ", 2),
    ("see(?: the)? ", 2),
    ("", 1),
]
CONFIDENCE = {4: 1.0, 3: 0.9, 2: 0.75, 1: 0.5}


def rules() -> list[tuple[str, str, str, int]]:
    """(label, keyword, pattern, priority); patterns take the space before their first word, not the one after."""
    out = []
    for label, keyword, name, versions in [*FAMILIES, *SHORT, *LED]:
        family = (label, keyword, name, versions)
        # a version may stand at the keyword without a space: gplv3
        key = f" {keyword}" if versions else f" {keyword} "
        for lead, priority in LEADS:
            if family in LED and priority < 3:
                continue
            for v in versions:
                major, minor = v.split(" ")
                number = f"{major}(?: {minor})?" if minor == "0" else f"{major} {minor}"
                out.append((f"{label}-{major}.{minor}", key,
                            f" {lead}{name.replace('{v}', f'(?: license)?(?: version| ?v)? ?{number}')}(?= )", priority))
            if family not in SHORT or priority >= 3:
                out.append((label, key, f" {lead}{name.replace('{v}', '')}(?= )", priority))
    return out


#: the keywords of all rules: a text without any of them matches none
GATES = tuple(sorted({keyword for _, keyword, _, _ in rules()}))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _detections(words: Column, rule: Column) -> Column:
    """Word intervals [start, end) of a rule's matches."""
    between = F.split(words, rule["pattern"], -1)
    hits = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int,priority:int,label:string>>").alias("out"))

    def step(a: Column, i: Column) -> Column:
        begin = a["at"] + _spaces(F.get(between, i))
        stop = begin + _spaces(F.get(hits, i))
        one = F.struct(begin.alias("start"), stop.alias("stop"), rule["priority"].alias("priority"), rule["label"].alias("label"))
        return F.struct(stop.alias("at"), F.concat(a["out"], F.array(one)).alias("out"))

    return F.when(F.size(hits) == 0, start["out"]).otherwise(
        F.aggregate(F.sequence(F.lit(0), F.size(hits) - 1), start, step)["out"])


def _survivors(found: Column) -> Column:
    """Labels and the highest priority that are left after containment suppression: one sweep over the intervals by
    start, longest first; ``m`` holds the furthest end so far of each priority and those above."""
    ranked = F.array_sort(F.transform(found, lambda d: F.struct(
        d["start"].alias("start"), (-d["stop"]).alias("back"), (-d["priority"]).alias("rank"), d["label"].alias("label"))))
    start = F.struct(*[F.lit(-1).alias(f"m{p}") for p in CONFIDENCE], F.lit(0).alias("top"),
                     F.array().cast("array<string>").alias("labels"))

    def step(a: Column, d: Column) -> Column:
        stop, priority = -d["back"], -d["rank"]
        furthest = F.lit(None).cast("int")
        for p in CONFIDENCE:
            furthest = F.when(priority == p, a[f"m{p}"]).otherwise(furthest)
        stays = furthest < stop
        return F.struct(*[F.when(stays & (priority >= p), F.greatest(a[f"m{p}"], stop)).otherwise(a[f"m{p}"]).alias(f"m{p}")
                          for p in CONFIDENCE],
                        F.when(stays, F.greatest(a["top"], priority)).otherwise(a["top"]).alias("top"),
                        F.when(stays, F.array_union(a["labels"], F.array(d["label"]))).otherwise(a["labels"]).alias("labels"))

    return F.aggregate(ranked, start, step)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(row, n_words, n_base, first_word, last_word, base_labels, labels, score)``."""
    only = F.trim(F.regexp_replace(F.coalesce(docs[text], F.lit("")), SEPARATORS, " "))
    hold = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), only.alias("only"))
    hold = hold.select("row", F.when(F.col("only") == "", 0).otherwise(_spaces(F.col("only")) + 1).cast("long").alias("n_words"),
                       F.concat(F.lit(" "), F.col("only"), F.lit(" ")).alias("mixed"))
    gate = F.lit(False)
    for word in GATES:
        gate = gate | F.col("lowered").contains(word)
    hold = hold.withColumn("lowered", F.translate("mixed", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    hold = hold.select("row", "n_words", F.when(gate, F.col("lowered")).alias("w"))

    pieces = {p: F.split("w", f" {p}(?= )", -1) for p in BASE}
    hold = hold.select("row", "n_words", "w", *[F.struct(
        (F.size(x) - 1).alias("n"), _spaces(x[0]).alias("first"),
        (F.col("n_words") - (_spaces(F.element_at(x, -1)) - 1) - len(p.split(" "))).alias("last")).alias(f"b{i}")
        for i, (p, x) in enumerate(pieces.items())])
    b = [F.when(F.col("w").isNotNull() & (F.col(f"b{i}.n") > 0), F.col(f"b{i}")) for i in range(len(BASE))]
    # one literal instead of some thousand: the plan stays small; rules by keyword, which is looked for once
    groups = [{"keyword": k, "rules": [dict(zip(("label", "pattern", "priority"), (r[0], r[2], r[3]), strict=True))
                                       for r in rules() if r[1] == k]} for k in GATES]
    known = F.from_json(F.lit(json.dumps(groups)), "array<struct<keyword:string,rules:array<struct<pattern:string,priority:int,label:string>>>>")
    near = F.flatten(F.transform(F.filter(known, lambda g: F.contains(F.col("w"), g["keyword"])), lambda g: g["rules"]))
    found = F.flatten(F.transform(near, lambda r: _detections(F.col("w"), r)))
    hold = hold.select(
        "row", "n_words", sum((F.coalesce(x["n"], F.lit(0)) for x in b), F.lit(0)).cast("long").alias("n_base"),
        F.least(*[x["first"] for x in b]).cast("long").alias("first_word"),
        F.greatest(*[x["last"] for x in b]).cast("long").alias("last_word"),
        F.filter(F.array(*[F.when(x.isNotNull(), F.lit(name)) for x, name in zip(b, BASE.values(), strict=True)]),
                 lambda x: x.isNotNull()).alias("base"),
        F.when(F.col("w").isNotNull(), found).alias("found"))
    hold = hold.withColumn("left", F.when(F.size("found") > 0, _survivors(F.col("found"))))
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    score = F.lit(0.0)
    for p, c in CONFIDENCE.items():
        score = F.when(F.col("left.top") == p, c).otherwise(score)
    return hold.select("row", "n_words", "n_base", "first_word", "last_word", joined(F.col("base")).alias("base_labels"),
                       joined(F.array_union("base", F.coalesce(F.col("left.labels"), F.array().cast("array<string>"))))
                       .alias("labels"), score.alias("score"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``: word count, base phrases, labels after suppression, score."""
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
