"""Byte-level BPE by a rank file: encoding, and decoding back to bytes."""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from goldweave.llm.chunks import APART, ChunkEncoder, slices
from goldweave.llm.tables import id_type, schema, texts

_NONE = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the leftmost pair of lowest rank is merged until none is left.

    A segment tree over byte positions holds, for the part that starts at a position, the rank
    of the pair it forms with the next live part; its root is the leftmost minimum. A merge
    changes the leaves of the part itself, the part it swallows and the part before.
    """
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    after = list(range(1, n + 1))
    before = list(range(-1, n))
    # Rank and position in one number: the minimum is the lowest rank, then the leftmost.
    tree = [_NONE] * (2 * size)
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i:i + 2])
        if rank is not None:
            tree[size + i] = rank * size + i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b

    def put(i: int, value: int) -> None:
        k = size + i
        tree[k] = value
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
            k >>= 1

    def pair(i: int) -> int:
        middle = after[i]
        if middle >= n:
            return _NONE
        rank = get(piece[i:after[middle]])
        return _NONE if rank is None else rank * size + i

    while tree[1] != _NONE:
        i = tree[1] % size
        gone = after[i]
        after[i] = after[gone]
        before[after[gone]] = i
        put(gone, _NONE)
        put(i, pair(i))
        if before[i] >= 0:
            put(before[i], pair(before[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class ByteBpe:
    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        self.pattern = regex.compile(pattern)
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.encoder = ChunkEncoder(self.encode_all, "kept", apart=pattern == APART)

    def encode_all(self, group: list[str]) -> list[list[int]]:
        known: dict[str, list[int]] = {}
        out = []
        for text in group:
            ids: list[int] = []
            for match in self.pattern.finditer(text):
                piece = match.group()
                if piece not in known:
                    known[piece] = merge_bytes(piece.encode(), self.ranks)
                ids += known[piece]
            out.append(ids)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode_documents(rows: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The id and ``ids`` (little-endian unsigned 32-bit integers in one binary value).

    ``pattern`` must leave a space to the word after it and hold no other white space inside
    words, as the patterns of byte-level vocabularies do. A null or empty text has no ids.
    Null ids, equal ids and repeated rows are encoded like any other row; an empty table gives
    an empty one; other columns are left out.
    """
    out = schema(id_type(rows, id_col), "ids binary", id_col)

    def run(batches):
        encoder = byte_bpe(ranks, pattern).encoder
        for batch in batches:
            for start, column in slices(batch.column(1)):
                ids, counts = encoder.ids(column)
                flat = ids.astype("<u4")
                ends = np.cumsum(counts)
                values = [flat[e - n:e].tobytes() for e, n in zip(ends, counts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(column)), pa.array(values, pa.binary())],
                    names=out.names)

    return texts(rows, id_col, text_col).mapInArrow(run, out)


def decode_documents(encoded: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id",
                     digest: bool = False) -> DataFrame:
    """The id and ``decoded`` (bytes), or with ``digest`` the digests of ids and bytes."""
    rest = ("n_tokens long, ids_sha256 string, decoded_sha256 string" if digest
            else "decoded binary")
    out = schema(id_type(encoded, id_col), rest, id_col)

    def run(batches):
        model = byte_bpe(ranks, pattern)
        for batch in batches:
            columns: list[list] = [[] for _ in out.names[1:]]
            for value in batch.column(1):
                raw = value.as_py()
                ids = np.frombuffer(raw, "<u4")
                text = model.decode(ids)
                row = ((len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text).hexdigest())
                       if digest else (text,))
                for c, v in zip(columns, row, strict=True):
                    c.append(v)
            arrays = [pa.array(c, t) for c, t in zip(
                columns, [pa.int64(), pa.string(), pa.string()] if digest else [pa.binary()],
                strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=out.names)

    return encoded.select(id_col, "ids").mapInArrow(run, out)


def round_trip(rows: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode and decode in one worker: the id, ``n_tokens`` and the digests of ids and bytes.

    As :func:`encode_documents` and :func:`decode_documents` one after the other, with one copy of
    the vocabulary and of the pieces known, and with ids of a slice of texts at a time.
    """
    out = schema(id_type(rows, id_col), "n_tokens long, ids_sha256 string, decoded_sha256 string", id_col)

    def run(batches):
        model = byte_bpe(ranks, pattern)
        for batch in batches:
            for start, column in slices(batch.column(1)):
                ids, counts = model.encoder.ids(column)
                parts = np.split(ids.astype("<u4"), np.cumsum(counts)[:-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(column)), pa.array(counts, pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in parts], pa.string()),
                     pa.array([hashlib.sha256(model.decode(x)).hexdigest() for x in parts], pa.string())],
                    names=out.names)

    return texts(rows, id_col, text_col).mapInArrow(run, out)
