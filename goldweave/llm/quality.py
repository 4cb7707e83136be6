"""Quality rules on repetition: characters inside repeated n-grams and lines."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from goldweave.llm.tables import id_type, schema, texts

# Highest share of a text's word characters inside n-grams that occur twice, by n.
NGRAM_SHARES = {5: 0.30, 7: 0.28, 10: 0.25}
# Highest share inside lines equal to an earlier line, and of symbols among characters.
LINE_SHARE = 0.30
SYMBOL_SHARE = 0.20
MIN_WORDS = 10
BASE_WINDOW = 5
BASE_PERCENT = 20

_SYMBOLS = frozenset(b"#*$%&|<>")
_BLANK = bytes([0x20, *range(0x09, 0x0E)])
_IS_SYMBOL = np.array([b in _SYMBOLS for b in range(256)])
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread word numbers over 64 bits."""
    x = (x + np.uint64(1)) * _MULTIPLIER
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def covered(codes: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in an n-word window that occurs twice or more."""
    count = len(codes) - n + 1
    hit = np.zeros(len(codes), bool)
    if count < 2:
        return hit
    with np.errstate(over="ignore"):
        rolling = np.zeros(count, np.uint64)
        for k in range(n):  # the polynomial of each window, one power at a time
            rolling = rolling * _MULTIPLIER + codes[k:k + count]
    _, inverse, times = np.unique(rolling, return_inverse=True, return_counts=True)
    edges = np.zeros(len(codes) + 1, np.int64)
    twice = np.flatnonzero(times[inverse] > 1)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + n, -1)
    return np.cumsum(edges[:-1]) > 0


def _characters(word: bytes) -> int:
    return len(word) if word.isascii() else len(word.decode())


def measure(text: str, lengths: tuple[int, ...]) -> tuple:
    """Word count, characters in words, symbols, repeated lines and words, and the shares."""
    raw = text.encode()
    words = raw.split()  # bytes split at ASCII white space only
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    size = np.fromiter(map(_characters, numbers), np.int64, len(numbers))[codes]
    chars = int(size.sum())
    symbols = int(_IS_SYMBOL[np.frombuffer(raw, np.uint8)].sum())
    seen: set[bytes] = set()
    n_lines = line_chars = 0
    if b"\n" in raw:
        for line in raw.split(b"\n"):
            if line.strip(_BLANK):
                if line in seen:
                    n_lines += 1
                    line_chars += _characters(b"".join(line.split()))
                seen.add(line)
    with np.errstate(over="ignore"):
        mixed = _mixed(codes.astype(np.uint64))
    repeated = covered(mixed, BASE_WINDOW)
    whole = max(chars, 1)
    shares = [float(size[repeated if n == BASE_WINDOW else covered(mixed, n)].sum() / whole)
              for n in lengths]
    return (len(words), chars, symbols, n_lines, int(repeated.sum()), shares, line_chars / whole,
            symbols / max(len(text), 1))


def quality(rows: DataFrame, ngram_shares: Mapping[int, float] = NGRAM_SHARES,
            line_share: float = LINE_SHARE, symbol_share: float = SYMBOL_SHARE,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with its counts, shares and verdict.

    Words are numbered in order of appearance, so equal numbers are equal words; windows of
    several lengths are compared by rolling hashes of the spread numbers. ``base_failed``: too
    few words, or too many words in repeated five-word windows. ``kept`` further needs every
    share (word characters in repeated windows by length, in repeated lines, symbols among all
    characters) to be at most its limit.

    A null or empty text has no words and fails. Null ids, equal ids and repeated rows are
    judged like any other row; an empty table gives an empty one; other columns are left out.
    """
    lengths = tuple(sorted(ngram_shares))
    limits = [ngram_shares[n] for n in lengths]
    out = schema(id_type(rows, id_col), "n_words long, word_chars long, n_symbols long, "
                 "n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
                 "ngram_shares array<double>, line_share double, symbol_share double", id_col)
    types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.list_(pa.float64()), pa.float64(), pa.float64()]

    def run(batches):
        for batch in batches:
            columns: list[list] = [[] for _ in types]
            for value in batch.column(1):
                n, chars, symbols, n_lines, repeats, shares, in_lines, share = measure(
                    value.as_py(), lengths)
                failed = n < MIN_WORDS or 100 * repeats > BASE_PERCENT * n
                kept = (not failed and in_lines <= line_share and share <= symbol_share
                        and all(s <= m for s, m in zip(shares, limits, strict=True)))
                for c, v in zip(columns, (n, chars, symbols, n_lines, repeats, failed, kept,
                                          shares, in_lines, share), strict=True):
                    c.append(v)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=out.names)

    return texts(rows, id_col, text_col).mapInArrow(run, out)
