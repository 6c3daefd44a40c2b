"""Skew-safe ordered scan: per-key sequential work without one task per key.

``Window.partitionBy(key)`` sends every row of a key to one task; when one key holds a third of all rows that task
holds a third of the data.  The scan here instead

1. range-partitions on ``(keys..., order...)`` (cut points are sampled on the whole composite key, so a hot key is cut
   into many contiguous slices), sorts within each slice and writes the slices once with ``checkpoint()`` to the shared
   folder: both passes below read the same slices, whatever columns they use;
2. summarises every slice.  A slice that ends with a key that began in it knows that key's state.  A slice that lies
   within one key does not know the state it starts from, so it is summarised as a *function* of that state;
3. composes those functions along the slices (one small row each) into the state each slice starts from;
4. runs the final pass, starting the first key of every slice from its state (a table of at most one row a slice,
   broadcast).

A *recipe* says what is computed along each key.  Its function must stay small: row numbers and running sums are an
addition, a rolling mean the last ``width - 1`` rows, the value-change fold a list of breakpoints.  A slice whose
function has too many breakpoints is read again once the state it starts from is known.

Rows must be totally ordered by ``order`` within a key (add a unique column as the last order column).  Null keys are one
key, as in GROUP BY.  The checkpoint files go when the DataFrame is no longer referenced
(``spark.cleaner.referenceTracking.cleanCheckpoints``).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import checkpoint_root, core_count, split_count

_PID = "_pid"

# Upper bound on scan slices by default: the carry table has at most one row
# per slice (a key and a small state), so it stays a few MB; at 100 TB this
# still gives slices of about 1 GB.
MAX_SCAN_PARTITIONS = 100_000

# A rolling mean looks at so many (row, window place) cells at once.
WINDOW_CELLS = 1 << 20

# Breakpoints of a value-change summary; a slice with more is read again.
MAX_PIECES = 512


# --------------------------------------------------------------------------- recipes


class Recipe:
    """One kind of per-key sequential computation, vectorised over a batch.

    A *state* (JSON) is what is known after some rows of a key; ``start()`` is that before its first row.
    ``run(cols, n, starts, state)`` processes ``n`` rows sorted by key, ``starts`` being the offsets where a key begins
    (``starts[0] == 0``) and ``state`` that of the first key.  It returns the output columns, a mask of the rows to keep
    (or None) and the state after the last row.

    A *summary* (JSON) describes rows of one key whose first state is unknown: ``blank()`` of no rows, ``extend`` adds
    rows, ``close(summary, state)`` is the state after them, or None if only the rows themselves can tell."""

    out_fields: list[T.StructField] = []
    needs: list[str] = []

    def start(self):
        raise NotImplementedError

    def run(self, cols: dict, n: int, starts: np.ndarray, state):
        raise NotImplementedError

    def blank(self):
        raise NotImplementedError

    def extend(self, summary, cols: dict, n: int):
        raise NotImplementedError

    def close(self, summary, state):
        raise NotImplementedError


def _layout(n: int, starts: np.ndarray):
    """Run id and run start offset of every row."""
    lengths = np.diff(np.append(starts, n))
    run_id = np.repeat(np.arange(len(starts)), lengths)
    return run_id, starts[run_id]


class RowIndex(Recipe):
    """1-based row number within the key."""

    def __init__(self, out_col: str = "rn"):
        self.out_col = out_col
        self.out_fields = [T.StructField(out_col, T.LongType(), False)]

    def start(self):
        return 0

    blank = start

    def run(self, cols, n, starts, state):
        run_id, run_start = _layout(n, starts)
        rn = np.arange(n, dtype=np.int64) - run_start + 1
        rn[run_id == 0] += state
        return {self.out_col: rn}, None, int(rn[-1])

    def extend(self, summary, cols, n):
        return summary + n

    def close(self, summary, state):
        return state + summary


class RunningSums(Recipe):
    """Running totals of long columns within the key (64-bit, wrapping around)."""

    def __init__(self, totals: dict[str, str], before: dict[str, str] | None = None):
        """``totals``: output column by summed column; ``before``: the same for the total of the rows before."""
        self.totals, self.before = totals, before or {}
        self.needs = list(totals)
        self.out_fields = [T.StructField(c, T.LongType(), False) for c in [*totals.values(), *self.before.values()]]

    def start(self):
        return [0] * len(self.needs)

    blank = start

    @staticmethod
    def _plus(a: int, b: int) -> int:
        return (a + b + (1 << 63)) % (1 << 64) - (1 << 63)

    def run(self, cols, n, starts, state):
        run_id, run_start = _layout(n, starts)
        out, after = {}, []
        for c, before in zip(self.needs, state, strict=True):
            v = cols[c].astype(np.int64)
            total = np.cumsum(v)
            total -= (total - v)[run_start]
            total[run_id == 0] += np.int64(before)
            out[self.totals[c]] = total
            if c in self.before:
                out[self.before[c]] = total - v
            after.append(int(total[-1]))
        return out, None, after

    def extend(self, summary, cols, n):
        return [self._plus(s, int(cols[c].astype(np.int64).sum())) for c, s in zip(self.needs, summary, strict=True)]

    def close(self, summary, state):
        return [self._plus(a, b) for a, b in zip(summary, state, strict=True)]


class Rolling(Recipe):
    """Trailing mean over the last ``width`` rows of ``value`` (fewer at the
    start of a key), with the row number and the number of rows averaged.
    Each window is summed afresh (no running add/subtract drift)."""

    def __init__(self, value: str, width: int, mean_col: str = "moving_avg", rn_col: str = "rn",
                 n_col: str = "n_in_window"):
        if width < 1:
            raise ValueError("width must be >= 1")
        self.value, self.width = value, width
        self.mean_col, self.rn_col, self.n_col = mean_col, rn_col, n_col
        self.needs = [value]
        self.out_fields = [T.StructField(mean_col, T.DoubleType(), True),
                           T.StructField(rn_col, T.LongType(), False),
                           T.StructField(n_col, T.LongType(), False)]

    def start(self):
        return {"cnt": 0, "tail": []}

    blank = start

    def _last(self, values: list) -> list:
        return values[-(self.width - 1):] if self.width > 1 else []

    def run(self, cols, n, starts, state):
        v = cols[self.value].astype("float64")
        w = self.width
        run_id, run_start = _layout(n, starts)
        tail = np.asarray(state["tail"], dtype="float64")
        off = len(tail)
        ext = np.concatenate([tail, v])
        # lowest usable position (in ``ext``) of each row's window
        lower = off + run_start
        lower[run_id == 0] = 0
        pos = off + np.arange(n)
        # each window summed afresh, whatever its width, so nothing of another key or an older row is left in it; a block of
        # rows at a time bounds the memory; nulls are skipped as in SQL's avg
        sums, seen = np.empty(n), np.empty(n)
        step = max(1, WINDOW_CELLS // w)
        for a in range(0, n, step):
            idx = pos[a:a + step, None] - (w - 1) + np.arange(w)[None, :]
            x = np.where(idx >= lower[a:a + step, None], ext[np.clip(idx, 0, None)], np.nan)
            good = ~np.isnan(x)
            sums[a:a + step] = np.where(good, x, 0.0).sum(axis=1)
            seen[a:a + step] = good.sum(axis=1)
        cnt = pos + 1 - np.maximum(lower, pos - (w - 1))
        mean = np.divide(sums, seen, out=np.full(n, np.nan), where=seen > 0)
        rn = np.arange(n, dtype=np.int64) - run_start + 1
        rn[run_id == 0] += state["cnt"]
        out = {self.mean_col: mean, self.rn_col: rn, self.n_col: cnt.astype(np.int64)}
        return out, None, {"cnt": int(rn[-1]), "tail": self._last(ext[int(lower[-1]):].tolist())}

    def extend(self, summary, cols, n):
        new = self._last(cols[self.value].astype("float64").tolist())
        return {"cnt": summary["cnt"] + n, "tail": self._last(summary["tail"] + new)}

    def close(self, summary, state):
        return {"cnt": state["cnt"] + summary["cnt"], "tail": self._last(state["tail"] + summary["tail"])}


class ValueChange(Recipe):
    """W1 fold: walk the key in order with ``last = 0.0``; a row whose value
    differs from ``last`` by more than ``eps`` is emitted with
    ``change = value - last`` and becomes the new ``last``.  Other rows are
    dropped and leave ``last`` unchanged.  Values are neither null nor NaN
    (such rows take no part: drop them first).

    Vectorised: ``last`` is always within ``eps`` of the previous row's value,
    so a step above ``2*eps`` from the previous value is always emitted and a
    zero step never is; only steps in ``(0, 2*eps]`` are decided one by one.

    Summary, the transfer function from the ``last`` before some rows to the ``last`` after them.  Whatever ``last`` was,
    the first row further than ``eps`` from it becomes the new ``last``, and that row can only be one that is larger or
    smaller than all before it.  ``pieces`` lists those rows in order, each with the ``last`` that follows from it; a
    ``last`` that none of them moves stays as it is.  Pieces in a row that lead to the same ``last`` are collapsed into the
    largest and the smallest of them, so a constant run is one piece, and after a step above ``3*eps`` every ``last`` has moved and
    leads to the same one (``fixed``)."""

    def __init__(self, value: str, eps: float = 1e-6, change_col: str = "change", max_pieces: int = MAX_PIECES):
        self.value, self.eps, self.change_col, self.max_pieces = value, eps, change_col, max_pieces
        self.needs = [value]
        self.out_fields = [T.StructField(change_col, T.DoubleType(), False)]

    def start(self):
        return {"last": 0.0, "prev": 0.0}

    def run(self, cols, n, starts, state):
        v, eps = cols[self.value].astype("float64"), self.eps
        run_id, run_start = _layout(n, starts)
        last0 = np.zeros(len(starts))
        last0[0] = state["last"]
        prevs = np.empty(n)
        prevs[1:] = v[:-1]
        prevs[starts] = 0.0
        prevs[0] = state["prev"]
        step = np.abs(v - prevs)
        big = step > 2 * eps
        small = (step > 0) & ~big
        emit = big.copy()
        if small.any():
            last_big = np.maximum.accumulate(np.where(big, np.arange(n), -1))
            last_small, last_small_run = -1, -1
            for i in np.flatnonzero(small):
                r = run_id[i]
                j = last_big[i - 1] if i > 0 else -1
                if last_small_run == r:
                    j = max(j, last_small)
                known = v[j] if j >= run_start[i] else last0[r]
                if abs(v[i] - known) > eps:
                    emit[i] = True
                    last_small, last_small_run = i, r
        change = np.zeros(n)
        e_idx = np.flatnonzero(emit)
        if len(e_idx):
            before = last0[run_id[e_idx]]
            same = np.zeros(len(e_idx), dtype=bool)
            same[1:] = run_id[e_idx[1:]] == run_id[e_idx[:-1]]
            before[1:][same[1:]] = v[e_idx[:-1]][same[1:]]
            change[e_idx] = v[e_idx] - before
        in_last = e_idx[run_id[e_idx] == len(starts) - 1]
        last = v[in_last[-1]] if len(in_last) else last0[-1]
        return {self.change_col: change}, emit, {"last": float(last), "prev": float(v[-1])}

    def blank(self):
        return {"pieces": [], "high": None, "low": None, "fixed": None, "too_many": False, "prev": None}

    def _next_event(self, s, v, i):
        """The first row from ``i`` on that changes the function."""
        if s["high"] is None:
            return i
        states = [x for _, x in s["pieces"]]
        top, bottom = max(states), min(states)
        width = 64
        while i < len(v):
            x = v[i:i + width]
            # differences as in ``_add``: a bound ``bottom + eps`` may round onto ``x`` itself
            hit = (top - x > self.eps) | (x - bottom > self.eps) | (x > s["high"]) | (x < s["low"])
            if hit.any():
                return i + int(hit.argmax())
            i, width = i + width, width * 4
        return len(v)

    def _add(self, s, x):
        """One row: it moves every ``last`` further than ``eps`` from it."""
        pieces = [(at, x if abs(x - to) > self.eps else to) for at, to in s["pieces"]]
        if s["high"] is None or x > s["high"] or x < s["low"]:
            pieces.append((x, x))
            s["high"] = x if s["high"] is None else max(x, s["high"])
            s["low"] = x if s["low"] is None else min(x, s["low"])
        out: list[tuple[float, float]] = []
        for at, to in pieces:
            group = []
            while out and out[-1][1] == to:
                group.append(out.pop()[0])
            group.append(at)
            out += [(y, to) for y in sorted({min(group), max(group)})]
        s["pieces"] = out
        if s["high"] - s["low"] > 3 * self.eps and len({to for _, to in out}) == 1:
            s["fixed"], s["pieces"] = out[0][1], []
        s["too_many"] = len(out) > self.max_pieces

    def extend(self, summary, cols, n):
        v, s = cols[self.value].astype("float64"), summary
        i = 0
        while i < n and s["fixed"] is None and not s["too_many"]:
            i = self._next_event(s, v, i)
            if i < n:
                self._add(s, float(v[i]))
                s["prev"] = float(v[i])
                i += 1
        if s["too_many"]:
            s["pieces"] = []
        elif s["fixed"] is not None and i < n:
            state = {"last": s["fixed"], "prev": s["prev"]}
            s["fixed"] = self.run({self.value: v[i:]}, n - i, np.array([0]), state)[2]["last"]
        s["prev"] = float(v[-1])
        return s

    def close(self, summary, state):
        s = summary
        if s["too_many"]:
            return None
        if s["prev"] is None:
            return state
        if s["fixed"] is not None:
            return {"last": s["fixed"], "prev": s["prev"]}
        last = next((to for at, to in s["pieces"] if abs(at - state["last"]) > self.eps), state["last"])
        return {"last": last, "prev": s["prev"]}


# --------------------------------------------------------------------------- engine


def _key_json(batch: pa.RecordBatch, keys: list[str], i: int) -> str:
    return json.dumps([batch.column(k)[i].as_py() for k in keys], default=repr)


def _run_starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Offsets where a new key begins; compared in Arrow, so 64-bit keys stay exact beside null keys."""
    n = batch.num_rows
    change = np.zeros(n, dtype=bool)
    change[0] = True
    for k in keys:
        a = batch.column(k)
        x, y = a.slice(1), a.slice(0, n - 1)
        differs = pc.fill_null(pc.not_equal(x, y), False)
        if pa.types.is_floating(a.type):  # NaN keys are one key, too
            differs = pc.and_(differs, pc.fill_null(pc.invert(pc.and_(pc.is_nan(x), pc.is_nan(y))), True))
        differs = pc.or_(differs, pc.xor(pc.is_null(x), pc.is_null(y)))
        change[1:] |= differs.to_numpy(zero_copy_only=False)
    return np.flatnonzero(change)


def _columns(batch: pa.RecordBatch, names: list[str]) -> dict:
    out = {}
    for c in names:
        a = batch.column(c)
        out[c] = (a.cast(pa.float64()) if pa.types.is_decimal(a.type) else a).to_numpy(zero_copy_only=False)
    return out


def _summary(batches, keys: list[str], recipe: Recipe) -> dict | None:
    """First and last key of a slice, whether it is one key throughout, and the summary (one key) or the state of
    its last key."""
    first = last = None
    single, known = True, recipe.blank()
    for batch in batches:
        n = batch.num_rows
        starts = _run_starts(batch, keys)
        head = _key_json(batch, keys, 0)
        first = head if first is None else first
        if single and head == first and len(starts) == 1:
            known = recipe.extend(known, _columns(batch, recipe.needs), n)
        else:
            # of a batch that ends with a key other than the first only that last key matters
            went_on = len(starts) == 1 and not single and head == last
            at = int(starts[-1])
            known = recipe.run(_columns(batch.slice(at), recipe.needs), n - at, np.array([0]),
                               known if went_on else recipe.start())[2]
            single = False
        last = _key_json(batch, keys, n - 1)
    return None if first is None else {"first_key": first, "last_key": last, "single": single, "known": json.dumps(known)}


def _walk(batches, keys: list[str], recipe: Recipe, state, key: str | None):
    """Final pass over one slice whose first key, if it is ``key``, goes on from ``state``: for every batch the output
    columns, the mask and the state after it."""
    for batch in batches:
        starts = _run_starts(batch, keys)
        went_on = key is not None and _key_json(batch, keys, 0) == key
        out, mask, state = recipe.run(_columns(batch, recipe.needs), batch.num_rows, starts, state if went_on else recipe.start())
        key = _key_json(batch, keys, batch.num_rows - 1)
        yield batch, out, mask, state


def _full(batches):
    return (b for b in batches if b.num_rows)


_SUMMARY = f"{_PID} int, first_key string, last_key string, single boolean, known string"
#: ``again``: the slice has too many breakpoints and the state before it is known now.
_CARRY = f"{_PID} int, _carry_key string, _carry string, again boolean"


@dataclass
class OrderedScan:
    keys: list[str]
    order: list[str]
    recipe: Recipe
    num_partitions: int | None = None
    pass_cols: list[str] = field(default_factory=list)
    materialize: bool = False

    def _sorted(self, df: DataFrame) -> DataFrame:
        cols = list(dict.fromkeys(self.pass_cols + self.keys + self.order + self.recipe.needs))
        narrow = df.select(*cols)
        if self.materialize:
            # the range partitioner samples its input in a separate job; an
            # expensive input (e.g. tokenised text) is written once to the
            # shared checkpoint folder instead of being computed twice
            checkpoint_root(df.sparkSession)
            narrow = narrow.checkpoint(eager=True)
        # sized by the data: as many slices as the input has splits
        # (spark.sql.files.maxPartitionBytes each), unless given; a
        # checkpointed (expensive) input gets at least one slice per core;
        # capped so the broadcast carry table stays bounded (one row per slice)
        floor = core_count(df.sparkSession) if self.materialize else 1
        n = self.num_partitions or min(MAX_SCAN_PARTITIONS, max(floor, split_count(narrow)))
        return (narrow
                .repartitionByRange(n, *self.keys, *self.order)
                .sortWithinPartitions(*self.keys, *self.order)
                .withColumn(_PID, F.spark_partition_id()))

    def summaries(self, slices: DataFrame) -> DataFrame:
        """One row a slice: what is known of it without the slices before it."""
        keys, recipe = self.keys, self.recipe

        def summarize(it):
            pid = None

            def batches():
                nonlocal pid
                for b in _full(it):
                    pid = b.column(_PID)[0].as_py()
                    yield b

            row = _summary(batches(), keys, recipe)
            if row is not None:
                yield pa.RecordBatch.from_pylist([{_PID: pid, **row}], pa.schema(
                    [(_PID, pa.int32()), ("first_key", pa.string()), ("last_key", pa.string()), ("single", pa.bool_()),
                     ("known", pa.string())]))

        narrow = slices.select(_PID, *keys, *[c for c in recipe.needs if c not in keys])
        return narrow.mapInArrow(summarize, _SUMMARY)

    def carries(self, summaries: DataFrame) -> DataFrame:
        """The state every slice starts from that continues a key, by composing the summaries in slice order (one small
        task; its input is one row a slice).  A slice behind one that has to be read again has none yet."""
        recipe = self.recipe

        def resolve(it):
            key = state = None  # state None: not known yet
            for batch in it:
                out = []
                for r in batch.to_pylist():
                    went_on = r["first_key"] == key
                    before = state if went_on else recipe.start()
                    known = json.loads(r["known"])
                    if r["single"]:
                        closed = recipe.close(known, before) if before is not None else None
                    else:
                        closed = known
                    if went_on and before is not None or r["single"] and closed is None and before is not None:
                        out.append({_PID: r[_PID], "_carry_key": r["first_key"], "_carry": json.dumps(before),
                                    "again": r["single"] and closed is None})
                    key, state = r["last_key"], closed
                yield pa.RecordBatch.from_pylist(out, pa.schema(
                    [(_PID, pa.int32()), ("_carry_key", pa.string()), ("_carry", pa.string()), ("again", pa.bool_())]))

        # repartition (a shuffle), not coalesce: coalesce(1) is narrow and
        # would pull the summary pass itself into one task; here the summary
        # runs per slice and only its one-row-per-slice output moves
        return summaries.repartition(1).sortWithinPartitions(_PID).mapInArrow(resolve, _CARRY)

    def _with_carry(self, slices: DataFrame, carry: DataFrame) -> DataFrame:
        # the carry is attached to the first row of its slice only (row ids
        # are ``slice << 33`` + position), not repeated on every row
        first_row = F.monotonically_increasing_id() == F.shiftleft(F.col(_PID).cast("long"), 33)
        carry = carry.select(_PID, "_carry_key", "_carry").withColumn("_first", F.lit(True))
        return slices.withColumn("_first", first_row).join(F.broadcast(carry), [_PID, "_first"], "left")

    def _read_again(self, slices: DataFrame, summaries: DataFrame, carry: DataFrame) -> DataFrame:
        """Summaries in which the slices marked ``again`` have become the state they end with."""
        keys, recipe = self.keys, self.recipe

        def fold(it):
            state = pid = None
            batches = _full(it)
            first = next(batches, None)
            if first is None or not first.column("_carry")[0].is_valid:
                return
            pid = first.column(_PID)[0].as_py()

            def chain():
                yield first
                yield from batches

            for *_, state in _walk(chain(), keys, recipe, json.loads(first.column("_carry")[0].as_py()),
                                   first.column("_carry_key")[0].as_py()):
                pass
            yield pa.RecordBatch.from_pylist([{_PID: pid, "ended": json.dumps(state)}],
                                             pa.schema([(_PID, pa.int32()), ("ended", pa.string())]))

        again = carry.where("again")
        narrow = slices.select(_PID, *keys, *[c for c in recipe.needs if c not in keys])
        ended = self._with_carry(narrow, again).mapInArrow(fold, f"{_PID} int, ended string")
        return summaries.join(ended, _PID, "left").select(
            _PID, "first_key", "last_key", (F.col("single") & F.col("ended").isNull()).alias("single"),
            F.coalesce("ended", "known").alias("known"))

    def _resolved(self, slices: DataFrame) -> DataFrame:
        summaries = self.summaries(slices)
        if not isinstance(self.recipe, ValueChange):
            return self.carries(summaries)
        summaries = summaries.checkpoint(eager=True)
        while True:
            carry = self.carries(summaries)
            if not carry.where("again").head(1):
                return carry
            summaries = self._read_again(slices, summaries, carry).checkpoint(eager=True)

    def apply(self, df: DataFrame) -> DataFrame:
        checkpoint_root(df.sparkSession)
        slices = self._sorted(df).checkpoint(eager=True)
        joined = self._with_carry(slices, self._resolved(slices))
        keys, recipe = self.keys, self.recipe
        pass_cols = list(dict.fromkeys(self.pass_cols + self.keys + self.order + self.recipe.needs))
        out_schema = T.StructType([slices.schema[c] for c in pass_cols] + recipe.out_fields)

        def final(it):
            batches = _full(it)
            first = next(batches, None)
            if first is None:
                return
            state, key = None, None
            if first.column("_carry")[0].is_valid:
                state, key = json.loads(first.column("_carry")[0].as_py()), first.column("_carry_key")[0].as_py()

            def chain():
                yield first
                yield from batches

            for batch, out, mask, _ in _walk(chain(), keys, recipe, state, key):
                made = [pa.array(out[f.name], from_pandas=True) for f in recipe.out_fields]
                rows = pa.RecordBatch.from_arrays([*(batch.column(c) for c in pass_cols), *made],
                                                  [*pass_cols, *(f.name for f in recipe.out_fields)])
                yield rows if mask is None else rows.filter(pa.array(mask))

        return joined.mapInArrow(final, out_schema)


# --------------------------------------------------------------------------- public helpers


def row_index(df: DataFrame, keys: list[str], order: list[str], out_col: str = "rn",
              num_partitions: int | None = None, materialize: bool = False) -> DataFrame:
    """Row number (1-based) within ``keys`` in ``order``, skew-safe.
    ``materialize`` checkpoints an expensive input before it is sampled."""
    return OrderedScan(keys, order, RowIndex(out_col), num_partitions,
                       pass_cols=[c for c in df.columns], materialize=materialize).apply(df)


def running_sums(df: DataFrame, keys: list[str], order: list[str], totals: dict[str, str],
                 num_partitions: int | None = None, before: dict[str, str] | None = None) -> DataFrame:
    """Running totals within ``keys`` in ``order``: ``totals`` names the output column of each long column, ``before``
    that of the total without the row itself."""
    return OrderedScan(keys, order, RunningSums(totals, before), num_partitions, pass_cols=list(df.columns)).apply(df)


def rolling_mean(df: DataFrame, keys: list[str], order: list[str], value: str, width: int,
                 mean_col: str = "moving_avg", num_partitions: int | None = None,
                 pass_cols: list[str] | None = None) -> DataFrame:
    """Trailing ``width``-row mean of ``value`` within ``keys``, plus ``rn``
    and ``n_in_window``."""
    return OrderedScan(keys, order, Rolling(value, width, mean_col), num_partitions,
                       pass_cols=pass_cols if pass_cols is not None else list(df.columns)).apply(df)


def value_changes(df: DataFrame, keys: list[str], order: list[str], value: str, eps: float = 1e-6,
                  change_col: str = "change", num_partitions: int | None = None,
                  pass_cols: list[str] | None = None, max_pieces: int = MAX_PIECES) -> DataFrame:
    """Rows where ``value`` moved by more than ``eps`` from the last emitted
    value of the key (starting at 0.0), with that ``change``.  Rows without a
    value (null, NaN) neither move it nor come out."""
    real = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return OrderedScan(keys, order, ValueChange(value, eps, change_col, max_pieces), num_partitions,
                       pass_cols=pass_cols if pass_cols is not None else list(df.columns)).apply(real)
