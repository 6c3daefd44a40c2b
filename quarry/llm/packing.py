"""Best-fit packing of tokenised documents, certified by dual-feasible lower bounds.

Documents are cut into pieces of at most ``capacity`` tokens.  Full pieces are sequences of their own.  The others are
dealt at random over partitions of a bounded number of pieces, and each partition is packed by best-fit
decreasing.  Dual-feasible functions of the piece lengths bound the number of sequences from below, for each partition
and (from the table of lengths, one row for each possible length) for all together.  While the whole count is above
its bound, partitions give up the sequences that are not full, theirs are exchanged - dealt into fewer
partitions - and packed again; a round that does not help ends it.

Defined cases: null text as empty (one end token); repeated rows and ids are documents of their own; extra columns
are ignored; an empty table packs into nothing.
"""

from __future__ import annotations

import os
import struct
import unicodedata
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, table

CAPACITY = 4096
END = 1
PARTITION_PIECES = 10_000
REMEMBERED = 400_000      # words whose ids a worker keeps; a quarter as many parts of words
MARKS = ".,;:!?#$%&*"     # a run of these after a word's letters is split off by the tokenizer
ROWS_TOKENS = 250_000     # tokens of the rows that a worker hands over at once
BATCH_ROWS = 500          # documents that a worker takes out of an Arrow batch at once
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class TextEncoder:
    """Token ids (as little-endian unsigned 32-bit bytes) of whole texts, remembering those of single words.

    The tokenizer drops white space and splits at it before anything else, so a text's ids are its words' ids one
    after another.  Plain words go to the tokenizer's model directly; all others through the tokenizer itself."""

    def __init__(self, path: str, remember: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        rest = [b for b in range(256) if b not in kept]
        self.shown = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.remember = remember
        self.words = _Remembered(self.encode_word)
        self.parts = _Remembered(self._plain)  # lower-cased letters, and runs of the marks that may end a word

    def _bytes(self, ids) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, text: str) -> bytes:
        shown = text if text.isascii() else text.encode().decode("latin-1").translate(self.shown)
        return self._bytes([t.id for t in self.model.tokenize(shown)])

    def encode_word(self, word: str) -> bytes:
        core = word.rstrip(MARKS)
        tail = word[len(core):]
        low = core.lower()
        if core.isalpha() and (core.isascii() or (low.isalpha() and len(low) == len(core) and "Σ" not in core
                                                  and unicodedata.is_normalized("NFC", word))):
            if 8 * len(self.parts) > self.remember:
                self.parts.age()
            return self.parts[low] + self.parts[tail] if tail else self.parts[low]
        return self._bytes(self.whole.encode(word, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        if not text.isprintable() and any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space to Python only
            return self._bytes(self.whole.encode(text, add_special_tokens=False).ids)
        if 2 * len(self.words) > self.remember:
            self.words.age()
        return b"".join(map(self.words.__getitem__, text.split()))


class _Remembered(dict):
    """Ids of strings met since the last ``age``; those met between the last two are taken over when they come again."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode
        self.before: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        self[text] = ids = self.before.get(text) or self.encode(text)
        return ids

    def age(self) -> None:
        self.before = dict(self)
        self.clear()


_ENCODERS: dict[tuple[str, int], TextEncoder] = {}  # one for each worker process, file and size


def encoder_of(path: str, remember: int = REMEMBERED) -> TextEncoder:
    if (path, remember) not in _ENCODERS:
        _ENCODERS[path, remember] = TextEncoder(path, remember)
    return _ENCODERS[path, remember]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces_of(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32 (and the ids, if asked for)."""

    def run(batches):
        from quarry.llm.packing import encoder_of  # the worker's own module: what it remembers outlives the task

        # beside the ids of its rows (and, in the pipeline, what other stages hold) a worker keeps fewer words
        encoder = encoder_of(path or tokenizer_path(), REMEMBERED // 8 if with_ids else REMEMBERED)

        def rows(out, parts):
            doc_id, piece, start, length, crc = zip(*out, strict=True)
            columns = {"doc_id": pa.array(doc_id, pa.int64()), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                       "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
            if with_ids:
                ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), "<u4").view("<i4")))
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            out, parts, held = [], [], 0
            for at in range(0, batch.num_rows, BATCH_ROWS):
                some = batch.slice(at, BATCH_ROWS)
                for doc_id, text in zip(some["doc_id"].to_pylist(), some["text"].to_pylist(), strict=True):
                    ids = encoder.encode(text or "") + END.to_bytes(4, "little")
                    for i, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start:start + 4 * capacity]
                        out.append((doc_id, i, start // 4, len(part) // 4, zlib.crc32(part)))
                        if with_ids:
                            parts.append(part)
                    held += len(ids) // 4
                    if held >= ROWS_TOKENS:
                        yield rows(out, parts)
                        out, parts, held = [], [], 0
            if out:
                yield rows(out, parts)

    return (docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
            .mapInArrow(run, PIECES + (", ids array<int>" if with_ids else "")))


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """Sequences needed at least, by three families of dual-feasible functions over a table of lengths."""
    if not len(lengths):
        return 0
    best = -(-int((lengths * counts).sum()) // capacity)
    for k in np.unique(np.concatenate([lengths[lengths * 2 <= capacity], [0]])):  # lengths over capacity - k count
        f = np.where(lengths > capacity - k, capacity, np.where(lengths >= k, lengths, 0))  # whole, those under k
        best = max(best, -(-int((f * counts).sum()) // capacity))  # not at all
    for k in range(1, 101):  # rounding to k-ths
        x = lengths * (k + 1)
        f = np.where(x % capacity == 0, lengths * k, x // capacity * capacity)
        best = max(best, -(-int((f * counts).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Bin number of each piece: longest first, each into the fullest bin that still has room."""
    bins = np.empty(len(lengths), np.int64)
    by_room: dict[int, list[int]] = {}
    rooms = n = 0  # bit r: some bin has r left
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b, n = capacity, n, n + 1
        bins[i] = b
        left = room - size
        if left:
            own = by_room.setdefault(left, [])
            if not own:
                rooms |= 1 << left
            own.append(b)
    return bins


def _packed(pool: DataFrame, parts: int, round_: int, capacity: int) -> DataFrame:
    """Best-fit decreasing in each of ``parts`` random partitions, with the partition's own bound."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pid", ignore_index=True)
        lengths = pdf["length"].to_numpy()
        bins = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, lengths).astype(np.int64)
        values, counts = np.unique(lengths, return_counts=True)
        gap = len(fill) - lower_bound(values, counts, capacity)
        part = int(pdf["part"].iloc[0])
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(lengths[order])
        heads = np.concatenate([[0], np.cumsum(fill)[:-1]])
        offset = np.empty(len(pdf), np.int64)
        offset[order] = ends - lengths[order] - heads[bins[order]]
        return pd.DataFrame({"pid": pdf["pid"], "length": lengths, "sequence_id": (round_ << 56) + (part << 28) + bins,
                             "offset": offset, "room": capacity - fill[bins], "gap": gap})

    part = F.pmod(F.xxhash64("pid", F.lit(round_)), F.lit(parts)).cast("int")
    return (pool.select("pid", "length", part.alias("part")).groupBy("part")
            .applyInPandas(run, "pid long, length long, sequence_id long, offset long, room long, gap long"))


def pack(pieces: DataFrame, scratch: Scratch, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES,
         rounds: int = 8) -> DataFrame:
    """``(pid, sequence_id, offset)`` for rows of (pid, length); pid is unique, 1 <= length <= capacity."""
    table_ = pieces.groupBy("length").agg(F.count("*").alias("n")).orderBy("length").toPandas()  # <= capacity rows
    bound = lower_bound(table_["length"].to_numpy(), table_["n"].to_numpy(), capacity)
    full = pieces.where(F.col("length") == capacity)
    done = [full.select("pid", F.col("pid").bitwiseOR(F.lit(1 << 62)).alias("sequence_id"),
                        F.lit(0).cast("long").alias("offset"))]
    settled = int(table_.loc[table_["length"] == capacity, "n"].sum())
    pool, before, last = pieces.where(F.col("length") < capacity), None, None
    for i in range(1, rounds + 1):
        n = pool.count()
        if not n:
            break
        now = scratch.put(_packed(pool, -(-n // partition_pieces), i, capacity), f"packed-{i}", keep=True)
        bins, open_ = now.where(F.col("offset") == 0).agg(
            F.count("*"), F.coalesce(F.sum((F.col("room") > 0).cast("long")), F.lit(0))).first()
        if before is not None and bins >= before:  # the exchange won nothing: its sequences stay as they were
            done.append(last)
            break
        # partitions without a gap of their own still exchange while the whole is above its bound
        certified = settled + bins <= bound
        if certified or i == rounds or n <= partition_pieces:
            done.append(now.select("pid", "sequence_id", "offset"))
            break
        done.append(now.where("room = 0").select("pid", "sequence_id", "offset"))
        settled += bins - open_
        last = now.where("room > 0").select("pid", "sequence_id", "offset")
        pool, before = now.where("room > 0").select("pid", "length"), open_
    out = done[0]
    for x in done[1:]:
        out = out.union(x)
    return out


def packed_documents(docs: DataFrame, scratch: Scratch, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents with their token ids (if wanted, else their CRC alone), sequence and place."""
    pieces = scratch.put(pieces_of(docs, path, with_ids=with_ids).withColumn("pid", F.monotonically_increasing_id()), "pieces", keep=True)
    return pieces.join(pack(pieces.select("pid", "length"), scratch), "pid").drop("pid")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.  The ids themselves are in what
    ``packed_documents`` and the pipeline's stage return."""
    with Scratch(spark, "packing") as scratch:
        return packed_documents(table(spark, sf_dir, "documents"), scratch, with_ids=False)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline (last stage): the packed pieces of all documents, token ids included."""
    with Scratch(spark, "packing") as scratch:
        return packed_documents(docs, scratch)
