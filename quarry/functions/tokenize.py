"""Tokenizers as Column expressions (JVM-side, code-generated).

The reference splits text in several incompatible ways; each family is one
function here, returning ``ARRAY<STRING>``.  They differ only in how empty
pieces are treated:

=========================  ======================================================
``split_collapse``   (F1)  split on one char, runs collapsed, no empty pieces
``split_escaped``    (F2)  split on one char unless escaped; escapes kept;
                           inner empties kept, trailing empties dropped
``java_split``       (F3)  split on a regex; inner/leading empties kept,
                           trailing dropped; ``''`` gives ``['']``
``split_tokenizer``  (F4)  split on space, tab, newline, CR, FF; no empties
``split_whitespace`` (F5)  split on any whitespace; no empties
``split_keep_all``   (F6)  split on one char; every empty kept
``head_and_rest``    (F7)  comma split, first item apart from the rest
``regex_words``      (F9)  ASCII ``\\w+`` runs, lower-cased after matching
=========================  ======================================================
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.columns import as_col

# Character classes used by the reference's tokenizers.
TOKENIZER_DELIMS = "[ \\t\\n\\r\\f]+"  # java.util.StringTokenizer default delimiters
WHITESPACE = ("[\\s\\x1c-\\x1f\\u1680\\u2000-\\u2006\\u2008-\\u200a"
              "\\u2028\\u2029\\u205f\\u3000]+")  # Character.isWhitespace
LINE_BREAK = "\\r\\n|\\n|\\r"

# marks of the escaped split; a U+0001 of the text itself is written as _OWN first, so no text can hold a mark
_LEAD = "\u0001"
_OWN = _LEAD + "\u0003"        # a U+0001 of the text
_ESC_MARK = _LEAD + "\u0004"   # stands for the escape char of an escaped pair
_SEP_MARK = _LEAD + "\u0005"   # stands for an escaped separator with its escape char


def _non_empty(arr: Column) -> Column:
    # array_remove is code-generated; a lambda filter would not be
    return F.array_remove(arr, "")


def split_lines(text) -> Column:
    """Split a document into lines the way a line reader does (\\n, \\r\\n, \\r)."""
    return F.split(as_col(text), LINE_BREAK, -1)


def split_collapse(text, sep: str = " ") -> Column:
    """split on ``sep``; runs of separators collapse; no empty words."""
    return _non_empty(F.split(as_col(text), re.escape(sep), -1))


def java_split(text, pattern: str = " ") -> Column:
    """``String.split(regex)`` with limit 0.

    Inner and leading empty strings are kept, trailing ones are removed; an
    input that is all separators gives ``[]``, while ``''`` gives ``['']``.
    """
    c = as_col(text)
    # trailing empties come from trailing separators: strip them first
    # (\z, not $: $ would also match before a final line break)
    stripped = F.regexp_replace(c, f"(?:{pattern})+\\z", "")
    return (F.when(c == F.lit(""), F.array(F.lit("")))
            .when(stripped == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, pattern, -1)))


def split_escaped(text, sep: str = " ", escape: str = "\\") -> Column:
    """split on ``sep`` unless preceded by an odd number of ``escape``.

    Escape characters stay in the words; trailing empty words are dropped and
    an empty input gives ``[]``.
    """
    c = as_col(text)
    esc_re = re.escape(escape)
    sep_re = re.escape(sep)
    # mark every (escape, char) pair left to right, then protect escaped seps
    marked = F.replace(c, F.lit(_LEAD), F.lit(_OWN))
    marked = F.regexp_replace(marked, f"{esc_re}([\\s\\S])", _ESC_MARK + "$1")
    marked = F.replace(marked, F.lit(_ESC_MARK + sep), F.lit(_SEP_MARK))

    def plain(w: Column) -> Column:
        for mark, text_of in ((_SEP_MARK, escape + sep), (_ESC_MARK, escape), (_OWN, _LEAD)):
            w = F.replace(w, F.lit(mark), F.lit(text_of))
        return w

    escaped = F.transform(java_split(marked, sep_re), plain)
    # without an escape char the marking is a no-op: plain split
    return (F.when(c == F.lit(""), F.array().cast("array<string>"))
            .when(c.contains(F.lit(escape)), escaped)
            .otherwise(java_split(c, sep_re)))


def split_tokenizer(text) -> Column:
    """``StringTokenizer`` defaults: space, tab, newline, CR, FF; no empties."""
    return _non_empty(F.split(as_col(text), TOKENIZER_DELIMS, -1))


def split_whitespace(text) -> Column:
    """split on any whitespace character; no empties."""
    return _non_empty(F.split(as_col(text), WHITESPACE, -1))


def split_keep_all(text, sep: str = " ") -> Column:
    """Python ``str.split(sep)``: every empty piece kept."""
    return F.split(as_col(text), re.escape(sep), -1)


def head_and_rest(text, sep: str = ","):
    """``(first item, remaining items)`` of a comma split."""
    parts = F.split(as_col(text), re.escape(sep), -1)
    return F.element_at(parts, 1), F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def regex_words(text) -> Column:
    """ASCII ``\\w+`` runs, each lower-cased after matching.

    Matches are ASCII, so lower-casing them equals mapping only ``A-Z`` to
    ``a-z`` in the text before matching (a char map, no per-word lambda);
    other characters are left as they are, so the runs found are the same."""
    return F.regexp_extract_all(F.translate(as_col(text), _UPPER, _UPPER.lower()), F.lit("\\w+"), 0)


TOKENIZERS = {
    "collapse": split_collapse,
    "escaped": split_escaped,
    "java": java_split,
    "tokenizer": split_tokenizer,
    "whitespace": split_whitespace,
    "keep_all": split_keep_all,
    "regex_words": regex_words,
}


def get_tokenizer(name_or_fn):
    """Resolve a tokenizer name (see ``TOKENIZERS``) or pass a callable through."""
    if callable(name_or_fn):
        return name_or_fn
    try:
        return TOKENIZERS[name_or_fn]
    except KeyError:
        raise ValueError(f"unknown tokenizer {name_or_fn!r}; one of {sorted(TOKENIZERS)}") from None
