"""Runs of words that repeat with a period, by recompression.

The words of many texts, as numbers, are one sequence with a mark of its own after each text.
It is compressed in turn by blocks (equal neighbours become one symbol) and by pairs (symbols are
dealt into two classes, and a neighbouring pair of a left and a right one becomes one symbol)
until one symbol is left. The levels are a run-length grammar of the sequence. Equal stretches are
cut alike on every level but for their ends, so the longest common extension of two places is
found by going up while the symbols agree, and down again from where they do not.

A run with period q that is at least e periods long holds a point of every grid of step
(e - 1) * q; only there the extensions of the places x and x + q are asked for, exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from goldweave.llm.chunks import slices
from goldweave.llm.tables import id_type, schema, texts

SLICE_BYTES = 4 << 20
# Candidates extended at once.
BLOCK = 1 << 20

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Grammar:
    """The levels of a sequence of numbers, and common extensions of its places."""

    def __init__(self, symbols: np.ndarray):
        self.symbols = [symbols.astype(np.int64)]
        self.parents: list[np.ndarray] = []
        # First and last child of each symbol, from the second level on.
        self.firsts: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.lasts: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.free = int(symbols.max()) + 1 if len(symbols) else 0
        turn = 0
        while len(self.symbols[-1]) > 1:
            self._blocks()
            if len(self.symbols[-1]) > 1:
                self._pairs(turn)
            turn += 1

    def _named(self, keys: np.ndarray) -> np.ndarray:
        """New symbols, equal for equal keys."""
        codes, known = pd.factorize(keys)
        codes = codes + self.free
        self.free += len(known)
        return codes

    def _add(self, starts: np.ndarray, symbols: np.ndarray) -> None:
        """One more level, given the places of the level below at which its symbols start."""
        size = len(self.symbols[-1])
        edge = np.zeros(size, np.int64)
        edge[starts] = 1
        self.parents.append(np.cumsum(edge) - 1)
        self.firsts.append(starts)
        self.lasts.append(np.append(starts[1:], size) - 1)
        self.symbols.append(symbols)

    def _blocks(self) -> None:
        below = self.symbols[-1]
        starts = np.flatnonzero(np.concatenate([[True], below[1:] != below[:-1]]))
        lengths = np.diff(np.append(starts, len(below)))
        symbols = below[starts]
        many = np.flatnonzero(lengths > 1)
        # A length is below 2**31, and so is every symbol.
        symbols[many] = self._named((symbols[many] << 31) | lengths[many])
        self._add(starts, symbols)

    def _pairs(self, turn: int) -> None:
        below = self.symbols[-1]
        mixed = (below + 1) * (2 * turn + 0x5851F42D) % 0x7FFFFFFF
        side = (mixed * 0x2545F491 >> 17) & 1
        down = (side[:-1] == 1) & (side[1:] == 0)
        up = (side[:-1] == 0) & (side[1:] == 1)
        joined = down if down.sum() >= up.sum() else up
        heads = np.flatnonzero(joined)
        edge = np.ones(len(below), bool)
        edge[heads + 1] = False
        starts = np.flatnonzero(edge)
        symbols = below[starts]
        symbols[np.searchsorted(starts, heads)] = self._named((below[heads] << 31) | below[heads + 1])
        self._add(starts, symbols)

    def extend(self, x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
        """How many symbols agree from places ``x`` and ``y`` on, to the right (1) or left (-1).

        ``x`` and ``y`` differ, and a symbol that occurs once lies on the way from each.
        """
        end, _ = self._mismatch(0, x, y, step)
        return (end - x) * step

    def _advance(self, level: int, p: np.ndarray, q: np.ndarray, step: int):
        """Past equal symbols: the whole common part of two blocks, or one symbol of a pair."""
        if level % 2:
            return p + step, q + step
        edges = self.lasts[level + 1] if step > 0 else self.firsts[level + 1]
        parents = self.parents[level]
        by = np.minimum((edges[parents[p]] - p) * step, (edges[parents[q]] - q) * step) + 1
        return p + step * by, q + step * by

    def _mismatch(self, level: int, p: np.ndarray, q: np.ndarray, step: int):
        """The first places at which the symbols of a level differ, from ``p`` and ``q`` on."""
        symbols = self.symbols[level]
        p, q = p.copy(), q.copy()
        equal = np.flatnonzero(symbols[p] == symbols[q])
        if not len(equal):
            return p, q
        parents = self.parents[level]
        edges = self.firsts[level + 1] if step > 0 else self.lasts[level + 1]
        a, b = p[equal], q[equal]
        inside = np.flatnonzero((edges[parents[a]] != a) | (edges[parents[b]] != b))
        a[inside], b[inside] = self._advance(level, a[inside], b[inside], step)
        p[equal], q[equal] = a, b
        # Equal symbols after equal symbols are cut alike: both places are edges now.
        on = equal[symbols[a] == symbols[b]]
        if len(on):
            a, b = self._mismatch(level + 1, parents[p[on]], parents[q[on]], step)
            a, b = edges[a], edges[b]
            same = np.flatnonzero(symbols[a] == symbols[b])
            a[same], b[same] = self._advance(level, a[same], b[same], step)
            p[on], q[on] = a, b
        return p, q


def _candidates(offsets: np.ndarray, sizes: np.ndarray, least: int, periods: int):
    """Blocks of (place, period): every grid of every period of every text."""
    held = np.flatnonzero(sizes >= max(least, periods))
    tops = sizes[held] // periods
    ends = np.cumsum(tops)
    total = int(ends[-1]) if len(ends) else 0
    for low in range(0, total, BLOCK):
        # Texts and periods of a part of all (text, period), then their grids, again in parts.
        index = np.arange(low, min(low + BLOCK, total))
        row = np.searchsorted(ends, index, side="right")
        q = index - (ends[row] - tops[row]) + 1
        text = held[row]
        grid = np.maximum((periods - 1) * q, least - q)
        points = (sizes[text] - q + grid - 1) // grid
        stops = np.cumsum(points)
        for first in range(0, int(stops[-1]), BLOCK):
            which = np.arange(first, min(first + BLOCK, int(stops[-1])))
            at = np.searchsorted(stops, which, side="right")
            nth = which - (stops[at] - points[at])
            yield offsets[text[at]] + nth * grid[at], q[at]


def runs_of(words: list[np.ndarray], least: int = 24, periods: int = 3) -> np.ndarray:
    """Rows ``(text, start, length, period)`` of all runs, by text, start and period.

    ``words`` are the words of each text as numbers from 0. A run is at least ``least`` words and
    ``periods`` (2 or more) of its smallest period long, and cannot be extended with that period.
    """
    if periods < 2:
        raise ValueError("a run holds at least two periods")
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    if not (sizes >= max(least, periods)).any():
        return np.zeros((0, 4), np.int64)
    flat = np.concatenate(words).astype(np.int64)
    free = int(flat.max()) + 1
    # A mark that occurs once before the first text and after each.
    offsets = np.cumsum(sizes + 1) - sizes
    sequence = np.empty(len(flat) + len(sizes) + 1, np.int64)
    marks = np.append(0, offsets + sizes)
    sequence[marks] = free + np.arange(len(marks))
    inner = np.ones(len(sequence), bool)
    inner[marks] = False
    sequence[inner] = flat
    grammar = Grammar(sequence)
    found = []
    for x, q in _candidates(offsets, sizes, least, periods):
        hit = np.flatnonzero(sequence[x] == sequence[x + q])
        x, q = x[hit], q[hit]
        right = grammar.extend(x, x + q, 1)
        left = grammar.extend(x - 1, x - 1 + q, -1)
        length = left + right + q
        long = np.flatnonzero((length >= least) & (length >= periods * q))
        if len(long):
            rows = np.stack([x[long] - left[long], length[long], q[long]], axis=1)
            found.append(np.unique(rows, axis=0))
    if not found:
        return np.zeros((0, 4), np.int64)
    rows = np.unique(np.concatenate(found), axis=0)
    # A stretch found with a multiple of its period is kept with the least one.
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[new]
    text = np.searchsorted(offsets, rows[:, 0], side="right") - 1
    start = rows[:, 0] - offsets[text]
    order = np.lexsort((rows[:, 2], start, text))
    return np.stack([text, start, rows[:, 1], rows[:, 2]], axis=1)[order]


def find_runs(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24,
              periods: int = 3) -> DataFrame:
    """One row per input row: the id, ``n_words``, ``runs`` and ``collapsed``.

    Words are what stands between ASCII white space, numbered from 0. ``runs`` holds start, length
    and period of each run, by start, then period. ``collapsed`` holds the words, joined by one
    space, but those that some run contains after its first period.

    A null text counts as empty and has no words, no runs and an empty ``collapsed``. Null ids,
    equal ids and repeated rows are handled like any other row; an empty table gives an empty one;
    other columns are left out. Memory goes with a slice of 4 MB of texts, or one longer text.
    """
    out = schema(id_type(rows, id_col), f"n_words long, runs {RUNS}, collapsed string", id_col)

    def run(batches):
        for batch in batches:
            for start, column in slices(batch.column(1).cast(pa.binary()), SLICE_BYTES):
                ids = batch.column(0).slice(start, len(column))
                yield _slice(ids, [t.split() for t in column.to_pylist()], least, periods, out)

    return texts(rows, id_col, text_col).mapInArrow(run, out)


def _slice(ids: pa.Array, words: list[list[bytes]], least: int, periods: int, out) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    flat = pa.array([w for ws in words for w in ws], pa.binary())
    codes = flat.dictionary_encode().indices.to_numpy()
    runs = runs_of(np.split(codes, ends[:-1]) if len(words) else [], least, periods)
    # +1 where a run's first period ends and -1 behind the run: words under a positive sum go.
    change = np.zeros(len(codes) + 1, np.int64)
    base = (ends - sizes)[runs[:, 0]] + runs[:, 1]
    np.add.at(change, base + runs[:, 3], 1)
    np.add.at(change, base + runs[:, 2], -1)
    kept = np.cumsum(change[:-1]) == 0
    collapsed = []
    for k, ws in enumerate(words):
        mine = kept[ends[k] - sizes[k]:ends[k]]
        if not mine.all():
            ws = [ws[i] for i in np.flatnonzero(mine)]
        collapsed.append(b" ".join(ws))
    per_text = np.searchsorted(runs[:, 0], np.arange(len(words) + 1))
    kinds = to_arrow_schema(out)
    struct = kinds.field("runs").type.value_type
    values = pa.StructArray.from_arrays(
        [pa.array(runs[:, c], pa.int64()) for c in (1, 2, 3)], fields=list(struct))
    listed = pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), values)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(sizes, pa.int64()), listed.cast(kinds.field("runs").type),
         pa.array(collapsed, pa.binary()).cast(pa.string())], names=out.names)
