"""Fill-in-the-middle by displacement scatter.

Every text is cut at two of its tokens into prefix, middle and suffix and written out with marks between them, suffix
before the middle.  A whole Arrow batch is one buffer of bytes: the cuts are found by a scan over it, a difference array
holds the change of the output shift at the start of every part, its cumulative sum is the shift of every byte, and one
numpy scatter puts all bytes in place.  ``restore`` finds the marks in the outputs alone and gathers the bytes back.

Tokens are runs of ASCII letters and single other characters.  The cuts, whether a text stays plain, and the order come
from a hash of the id, so a rerun gives the same rows.

Defined cases: a null text counts as empty and stays plain; a null id hashes as no digits; a text that holds a mark
stays plain; repeated rows are rows of their own; other columns are ignored; an empty table gives no rows; a text of
any length is one row, held whole by its task and worked on in blocks of ``BLOCK`` bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import table

#: Bytes of the batch that are worked on at once.
BLOCK = 1 << 20
#: Marks: three bytes, ``<``, a letter of these, ``>``.
PREFIX, SUFFIX, MIDDLE = b"PSM"
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100
OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
RESTORED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary, restored binary"

_BYTES = np.arange(256)
_LETTER = ((_BYTES | 32) >= ord("a")) & ((_BYTES | 32) <= ord("z"))
_LEAD = (_BYTES & 0xC0) != 0x80  # not inside a character


def _blocks(n: int):
    for lo in range(0, n, BLOCK):
        yield lo, min(lo + BLOCK, n)


def count_before(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many are set before each of the ascending places ``at``."""
    out, seen = np.zeros(len(at), np.int64), 0
    for lo, hi in _blocks(len(mask)):
        running = np.cumsum(mask[lo:hi])
        i, j = np.searchsorted(at, [lo, hi], side="right")
        out[i:j] = seen + running[at[i:j] - lo - 1]
        seen += int(running[-1])
    return out


def place_of(mask: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The places of the set entries with these ascending ranks (from 0); the end for a rank beyond the last."""
    out, seen = np.full(len(ranks), len(mask), np.int64), 0
    for lo, hi in _blocks(len(mask)):
        places = np.flatnonzero(mask[lo:hi])
        i, j = np.searchsorted(ranks, [seen, seen + len(places)])
        out[i:j] = lo + places[ranks[i:j] - seen]
        seen += len(places)
    return out


def displaced(n: int, begins: np.ndarray, shifts: np.ndarray):
    """(lo, hi, target of each place in lo..hi-1): from ``begins[k]`` on places move by ``shifts[k]``.  Parts are in
    ascending order and may be empty."""
    steps, shift = np.diff(shifts, prepend=0), 0
    for lo, hi in _blocks(n):
        i, j = np.searchsorted(begins, [lo, hi])
        difference = np.zeros(hi - lo, np.int64)
        np.add.at(difference, begins[i:j] - lo, steps[i:j])
        difference[0] += shift
        moved = np.cumsum(difference)
        shift = moved[-1]
        moved += np.arange(lo, hi)
        yield lo, hi, moved


def marks_in(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the marks that lie within one text, and the number of that text."""
    if len(data) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    letter = data[1:-1]
    at = np.flatnonzero((data[:-2] == ord("<")) & (data[2:] == ord(">"))
                        & ((letter == PREFIX) | (letter == SUFFIX) | (letter == MIDDLE)))
    text = np.searchsorted(bounds, at, side="right") - 1
    inside = at + 3 <= bounds[text + 1]
    return at[inside], text[inside]


def draws(doc_id: int | None) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))


def transform(data: np.ndarray, bounds: np.ndarray, drawn: np.ndarray) -> dict[str, np.ndarray]:
    """Texts ``data[bounds[i]:bounds[i + 1]]`` with the four draws of each, as outputs and what they are made of."""
    begin, end = bounds[:-1], bounds[1:]
    lead = _LEAD[data]
    lead[begin[begin < end]] = True
    starts = lead.copy()
    letter = _LETTER[data]
    starts[1:] &= ~(letter[1:] & letter[:-1])
    starts[begin[begin < end]] = True
    tokens = count_before(starts, bounds)
    n = np.diff(tokens)
    cuts = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
    at = place_of(starts, (tokens[:-1, None] + cuts).ravel()).reshape(-1, 2)
    at = np.where(cuts < n[:, None], at, end[:, None])
    a, b = at[:, 0], at[:, 1]

    plain = (begin == end) | (drawn[:, 2] % 100 >= PLAIN_FROM)
    plain[marks_in(data, bounds)[1]] = True
    spm = ~plain & (drawn[:, 3] % 100 < SPM_BELOW)
    prefix, middle, suffix = a - begin, b - a, end - b
    size = end - begin + np.where(plain, 0, 9)
    out_bounds = np.concatenate([[0], np.cumsum(size)])
    o = out_bounds[:-1]
    # where the three parts begin in the output; a mark stands before each of them
    p_at = np.where(plain, o, np.where(spm, o + 6 + suffix, o + 3))
    s_at = np.where(plain, o + prefix + middle, np.where(spm, o + 3, o + 6 + prefix))
    m_at = np.where(plain, o + prefix, o + 9 + prefix + suffix)

    out = np.empty(int(out_bounds[-1]), np.uint8)
    parts = np.stack([begin, a, b], 1).ravel()
    shifts = np.stack([p_at - begin, m_at - a, s_at - b], 1).ravel()
    for lo, hi, target in displaced(len(data), parts, shifts):
        out[target] = data[lo:hi]
    for name, place in ((PREFIX, p_at), (SUFFIX, s_at), (MIDDLE, m_at)):
        place = place[~plain]
        out[place - 3], out[place - 2], out[place - 1] = ord("<"), name, ord(">")
    chars = count_before(lead, np.stack([begin, a, b], 1).ravel()).reshape(-1, 3)
    return {"data": out, "bounds": out_bounds, "n": n, "plain": plain, "spm": spm,
            "prefix_chars": chars[:, 1] - chars[:, 0], "middle_chars": chars[:, 2] - chars[:, 1]}


def restore(data: np.ndarray, bounds: np.ndarray, plain: np.ndarray, spm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts again, from outputs and forms only."""
    begin, end = bounds[:-1], bounds[1:]
    at, text = marks_in(data, bounds)
    at = at[~plain[text]].reshape(-1, 3)
    cut = ~plain
    one = begin[cut]
    order = np.where(spm[cut], int.from_bytes(b"SPM"), int.from_bytes(b"PSM"))
    if len(at) != len(one) or (at[:, 0] != one).any() or ((data[at + 1] * np.array([1 << 16, 1 << 8, 1])).sum(1) != order).any():
        raise ValueError("an output does not hold the three marks of its form")
    first, second, last = at[:, 1] - at[:, 0] - 3, at[:, 2] - at[:, 1] - 3, end[cut] - at[:, 2] - 3
    flip = spm[cut]
    p_from, p_size = np.where(flip, at[:, 1], at[:, 0]) + 3, np.where(flip, second, first)
    s_from = np.where(flip, at[:, 0], at[:, 1]) + 3
    out_bounds = np.concatenate([[0], np.cumsum(end - begin - np.where(plain, 0, 9))])
    o = out_bounds[:-1]
    parts, shifts = np.stack([o, o, o], 1), np.repeat((begin - o)[:, None], 3, 1)
    parts[cut, 1], parts[cut, 2] = o[cut] + p_size, o[cut] + p_size + last
    shifts[cut] = np.stack([p_from, at[:, 2] + 3, s_from], 1) - parts[cut]
    out = np.empty(int(out_bounds[-1]), np.uint8)
    for lo, hi, source in displaced(len(out), parts.ravel(), shifts.ravel()):
        out[lo:hi] = data[source]
    return out, out_bounds


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The buffer of a string or binary column and the bounds of its values; null as empty."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    column = column.fill_null(b"" if "binary" in str(column.type) else "")
    bounds = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds.astype(np.int64) - bounds[0]


def _column(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1,
                                            [None, pa.py_buffer(bounds), pa.py_buffer(data)]).cast(pa.binary())


def slices(batches, column: str):
    """Arrow batches cut at ``BLOCK`` bytes of a column; a longer value is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bounds = _bytes_of(batch.column(column))[1]
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + BLOCK, side="right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars and the output text (as UTF-8) of every document."""

    def run(batches):
        for batch in slices(batches, "text"):
            ids = batch.column("doc_id")
            drawn = np.array([draws(x) for x in ids.to_pylist()], np.int64)
            r = transform(*_bytes_of(batch.column("text")), drawn)
            form = np.where(r["plain"], "plain", np.where(r["spm"], "spm", "psm"))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(r["n"]), pa.array(form.tolist(), pa.string()),
                 pa.array(r["prefix_chars"], mask=r["plain"]), pa.array(r["middle_chars"], mask=r["plain"]),
                 _column(r["data"], r["bounds"])], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, OUTPUT)


def restored(outputs: DataFrame) -> DataFrame:
    """Rows of ``fill_in_middle`` with the text that output and form give back."""

    def run(batches):
        for batch in slices(batches, "output"):
            form = np.array(batch.column("form").to_pylist(), dtype=object)
            data, bounds = restore(*_bytes_of(batch.column("output")), form == "plain", form == "spm")
            yield pa.RecordBatch.from_arrays([*batch.columns, _column(data, bounds)], [*batch.schema.names, "restored"])

    return outputs.mapInArrow(run, RESTORED)


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document transformed and restored, as digests."""
    rows = restored(fill_in_middle(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


OP12_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS w, ('0x' || h[1:8])::BIGINT AS h1,
         ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
c AS (
  SELECT doc_id, text, w, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a,
         greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
         CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM w),
p AS (
  SELECT doc_id, text, n, form, array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m,
         array_to_string(w[b + 1:], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
