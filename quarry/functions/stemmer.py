"""Porter (1980) suffix stripping as SQL expressions, one column in, one out.

Every step is an expression over a small struct: the word ``w``, its pattern ``p`` (a 1 for each vowel, a 0 for each
consonant) and whether step 1b cut something (``x``).  Whether a letter is a vowel depends on the letters before it only,
so the pattern of a stem is the beginning of the word's, and the measure of a stem is the number of times ``10`` stands in
it.  Follows the published algorithm (steps 1a-5b, with the "bli"->"ble" and "logi"->"log" refinements of its author).

``stemmed`` adds the stem to a DataFrame, step by step; ``function_sql`` declares the same steps as one SQL function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Suffix rules of the published algorithm, by step.
STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
         ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
         ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
         ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
         ("logi", "log")]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
         ("ness", "")]
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
         "ism", "ate", "iti", "ous", "ive", "ize"]


def _cut(c: str, k: int) -> str:
    return f"left(s.{c}, length(s.{c}) - {k})"


def _measure(p: str) -> str:
    return f"((length({p}) - length(replace({p}, '10', ''))) DIV 2)"


def _state(w: str, p: str, x: str = "false") -> str:
    return f"named_struct('w', {w}, 'p', {p}, 'x', {x})"


def _shorter(k: int, x: str = "false") -> str:
    return _state(_cut("w", k), _cut("p", k), x)


def _pattern(letters: str) -> str:
    """Of a replacement (none holds a y)."""
    return "".join("1" if c in "aeiou" else "0" for c in letters)


def _longer(k: int, letters: str) -> str:
    return _state(f"concat({_cut('w', k)}, '{letters}')", f"concat({_cut('p', k)}, '{_pattern(letters)}')")


def _ends(*suffixes: str) -> str:
    return "(" + " OR ".join(f"endswith(s.w, '{x}')" for x in suffixes) + ")"


def _has_vowel(p: str) -> str:
    return f"contains({p}, '1')"


def _cvc(w: str, p: str) -> str:
    return f"(endswith({p}, '010') AND right({w}, 1) NOT IN ('w', 'x', 'y'))"


_DOUBLE = "(length(s.w) >= 2 AND right(s.w, 1) = substring(s.w, -2, 1) AND endswith(s.p, '0'))"


def _replaced(rules, least: int) -> str:
    """The first suffix that stands there is replaced if the measure before it is above ``least``."""
    cases = [f"WHEN {_ends(a)} THEN CASE WHEN {_measure(_cut('p', len(a)))} > {least} THEN {_longer(len(a), b)} ELSE s END" for a, b in rules]
    return "CASE " + " ".join(cases) + " ELSE s END"


def _step4() -> str:
    cases = []
    for a in STEP4:
        more = f" AND right({_cut('w', 3)}, 1) IN ('s', 't')" if a == "ion" else ""
        cases.append(f"WHEN {_ends(a)} THEN CASE WHEN {_measure(_cut('p', len(a)))} > 1{more} THEN {_shorter(len(a))} ELSE s END")
    return "CASE " + " ".join(cases) + " ELSE s END"


# A y is a vowel after a consonant; the rounds below settle a run of up to four of them, longer runs go letter by letter.
_SEEN = "translate(regexp_replace(w, '[^aeiouy]', '0'), 'aeiou', '11111')"
_AFTER_0, _AFTER_1 = ("(?<=0)y", "1"), ("(?<=^|1)y", "0")


def _rounds() -> str:
    out = _SEEN
    for pattern, digit in (_AFTER_0, _AFTER_1) * 3:
        out = f"regexp_replace({out}, '{pattern}', '{digit}')"
    return out


_LETTERS = ("aggregate(split(w, ''), '', (a, c) -> concat(a, CASE WHEN c IN ('a', 'e', 'i', 'o', 'u') THEN '1' "
            "WHEN c = 'y' AND endswith(a, '0') THEN '1' ELSE '0' END))")

#: The steps in order, by name.
STEPS = {
    "1a": f"CASE WHEN {_ends('sses', 'ies')} THEN {_shorter(2)} WHEN {_ends('ss')} THEN s WHEN {_ends('s')} THEN {_shorter(1)} ELSE s END",
    "1b": f"CASE WHEN {_ends('eed')} THEN CASE WHEN {_measure(_cut('p', 3))} > 0 THEN {_shorter(1)} ELSE s END "
          f"WHEN {_ends('ed')} AND {_has_vowel(_cut('p', 2))} THEN {_shorter(2, 'true')} "
          f"WHEN {_ends('ing')} AND {_has_vowel(_cut('p', 3))} THEN {_shorter(3, 'true')} ELSE s END",
    "1b_mended": f"CASE WHEN NOT s.x THEN s WHEN {_ends('at', 'bl', 'iz')} THEN {_longer(0, 'e')} "
                 f"WHEN {_DOUBLE} AND right(s.w, 1) NOT IN ('l', 's', 'z') THEN {_shorter(1)} "
                 f"WHEN {_measure('s.p')} = 1 AND {_cvc('s.w', 's.p')} THEN {_longer(0, 'e')} ELSE s END",
    "1c": f"CASE WHEN {_ends('y')} AND {_has_vowel(_cut('p', 1))} THEN {_longer(1, 'i')} ELSE s END",
    "2": _replaced(STEP2, 0),
    "3": _replaced(STEP3, 0),
    "4": _step4(),
    "5a": f"CASE WHEN {_ends('e')} AND ({_measure(_cut('p', 1))} > 1 OR {_measure(_cut('p', 1))} = 1 AND NOT {_cvc(_cut('w', 1), _cut('p', 1))}) "
          f"THEN {_shorter(1)} ELSE s END",
    "5b": f"CASE WHEN {_measure('s.p')} > 1 AND {_DOUBLE} AND {_ends('l')} THEN {_shorter(1)} ELSE s END",
}
_FIRST = _state("w", "CASE WHEN contains(p, 'y') THEN " + _LETTERS + " ELSE p END")


def stemmed(df: DataFrame, word: str, out: str) -> DataFrame:
    """``df`` with the stem of a lower-case word (null stays null; words of one or two letters are their own).

    The steps are columns of their own, so a step's result is computed once however often the next one names it."""
    at = df.select(F.struct(*[c for c in df.columns if c != out], F.lit(0).alias("_")).alias("row"), F.col(word).alias("w"))
    at = at.withColumn("p", F.expr(_rounds())).withColumn("s", F.expr(_FIRST))
    for step in STEPS.values():
        at = at.withColumn("s", F.expr(step))
    return at.select("row.*", F.when(F.length("w") <= 2, F.col("w")).otherwise(F.col("s.w")).alias(out)).drop("_")


def function_sql(name: str = "quarry_stem") -> str:
    """The statement that declares ``name(word)`` as a temporary SQL function of a session.

    Steps are bound as lambda variables: a step that names the word many times then holds one copy of the steps before it,
    for a literal word, too."""
    steps = f"transform(array({_rounds()}), p -> {_FIRST})"
    for body in STEPS.values():
        steps = f"transform({steps}, s -> {body})"
    return (f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(w STRING) RETURNS STRING "
            f"RETURN CASE WHEN length(w) <= 2 THEN w ELSE element_at({steps}, 1).w END")
