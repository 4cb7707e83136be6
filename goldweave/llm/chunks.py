"""Encoding many texts with every distinct chunk encoded once per worker.

A text is cut at spaces where no token can cross, each distinct chunk is encoded by the
tokenizer itself, and the ids of a text are gathered from those of its chunks.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# White space of Unicode, as the libraries have it: not the separators that Python counts as such.
_SPACES = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f" ?[^{_SPACES}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+")
# Two of them in a row.
_ODD = r"[\pZ\s\x0b\x85][\pZ\s\x0b\x85]"
# The pattern of byte-level vocabularies: its matches are white space, letters, digits or other marks.
APART = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Bytes by kind: letters of ASCII, its digits and marks, and first bytes of U+00C0 to U+023F,
# which are letters but for two.
_LETTER, _MARK, _LATIN = (np.array([test(b) for b in range(256)]) for test in (
    lambda b: b < 128 and chr(b).isalpha(),
    lambda b: b < 128 and not chr(b).isalpha() and chr(b) not in "\t\n\x0b\x0c\r ",
    lambda b: 0xC3 <= b <= 0xC8))
_NO_LETTERS = [tuple(c.encode()) for c in "×÷"]
_ENDED = re.compile("(?s:.*)[A-Za-z][.,;:!?]").fullmatch

SLICE_BYTES = 4 << 20
ENCODE_BYTES = 64 << 10
# What is kept in a worker, about: an entry costs ENTRY_BYTES besides its text and ids. A chunk
# longer than LONG is encoded, but not kept. When full, the more used half stays.
CACHE_BYTES = 128 << 20
ENTRY_BYTES = 190
LONG = 256


def by_bytes(items: list[str], limit: int) -> Iterator[list[str]]:
    """Consecutive groups of about ``limit`` characters; a long item is one group."""
    ends = np.cumsum(np.fromiter(map(len, items), np.int64, len(items)))
    start = 0
    while start < len(items):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield items[start:stop]
        start = stop


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive parts of a string column of at most ``limit`` bytes, or one row."""
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(column):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, column.slice(start, stop - start)
        start = stop


class Joined:
    """Encodes many chunks as one text, which takes half the time, and cuts the ids again.

    Chunks that fit are such that the text would be cut between them anyhow, and that their ids
    spell them byte by byte; so the sizes of the ids' bytes tell where each chunk ends. If they
    do not meet every end there is no result, and the chunks are encoded one by one. Where spaces
    are kept, chunks without one are set apart by line feeds, whose ids are dropped.
    """

    def __init__(self, encode: Callable[[str], Sequence[int]], sizes: np.ndarray, spaces: str):
        self.text_ids, self.sizes, self.glue = encode, sizes, "" if spaces == "kept" else " "
        plain = f" ?[^{_SPACES}<]+" if spaces == "kept" else f"[^{_SPACES}<]+"
        self.plain, self.kept = re.compile(plain).fullmatch, spaces == "kept"

    def fits(self, word: str) -> bool:
        """Others than ASCII may be rewritten; then only if that seems to keep their length."""
        if not self.plain(word):
            return False
        return self.kept or word.isascii() or \
            len(unicodedata.normalize("NFC", word).lower().encode()) == len(word.encode())

    def fitting(self, words: list[str]) -> list[str]:
        return list(filter(self.plain if self.kept else self.fits, words))

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of all words in order, and the number of each.

        If spaces are kept, all words begin with one or none does.
        """
        if self.kept and words and words[0][0] != " ":
            found = self._spelled([f"\n{w}" for w in words])
            if found is None:
                return None
            ids, lengths = found
            feeds = np.cumsum(lengths) - lengths
            if (self.sizes[ids[feeds]] != 1).any():
                return None
            return np.delete(ids, feeds), lengths - 1
        return self._spelled(words)

    def _spelled(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        text = self.glue.join(words)
        ids = np.array(self.text_ids(text), np.uint32)
        sizes = map(len, words) if text.isascii() else (len(w.encode()) for w in words)
        ends = np.cumsum(np.fromiter(sizes, np.int64, len(words)))
        reached = np.cumsum(self.sizes[ids])
        stops = np.searchsorted(reached, ends)
        if len(ids) == 0 or reached[-1] != ends[-1] or (reached[stops] != ends).any():
            return None
        return ids, np.diff(stops + 1, prepend=0)


class ChunkEncoder:
    """Ids of texts.

    ``encode`` maps a list of strings to a list of id sequences. ``spaces`` says what the
    tokenizer does with white space: ``"kept"`` (a space belongs to the word after it, runs
    of white space leave their last space to that word), ``"dropped"``, or ``"whole"`` for a
    tokenizer whose texts cannot be cut. Texts with one of
    ``special`` in them are encoded whole, since such strings cut a text on their own.
    ``apart`` says that spaces are kept and texts are matched by ``APART``: then they are cut at
    line feeds as well, and where letters end before a digit or a mark.
    """

    def __init__(self, encode: Callable[[list[str]], Sequence[Sequence[int]]], spaces: str,
                 special: Sequence[str] = (), max_bytes: int = CACHE_BYTES,
                 joined: "Joined | None" = None, apart: bool = False):
        if spaces not in ("kept", "dropped", "whole"):
            raise ValueError(f"spaces must be kept, dropped or whole, not {spaces!r}")
        self.encode, self.spaces, self.special, self.max_bytes = encode, spaces, special, max_bytes
        self.joined, self.apart = joined, apart
        self._clear()

    def _clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.uses = np.zeros(1024, np.int32)
        self.pool, self.used = np.zeros(4096, np.uint32), 0
        self.characters = 0
        # Entries, ids and characters to go back to: long chunks come after them.
        self.kept = 0, 0, 0

    def _put(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Keep the ids of new words, given one after another."""
        k, n = len(self.slot), len(words)
        if k + n > len(self.starts):
            self.starts = np.resize(self.starts, 2 * (k + n))
            self.lengths = np.resize(self.lengths, 2 * (k + n))
            self.uses = np.resize(self.uses, 2 * (k + n))
        if self.used + len(ids) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * (self.used + len(ids)))
        self.slot.update(zip(words, range(k, k + n), strict=True))
        self.lengths[k:k + n] = lengths
        self.uses[k:k + n] = 0
        self.starts[k:k + n] = self.used + np.cumsum(lengths) - lengths
        self.pool[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.characters += sum(map(len, words))

    def _learn(self, words: list[str]) -> None:
        """Encode what is missing, given once each; a word and the mark that ends it are encoded apart.

        Only after a letter of ASCII: others may be rewritten to end in what joins the mark.
        """
        ended: list[str] = []
        plain = words
        if self.spaces != "whole" and not self.apart:
            plain = []
            for w in words:
                (ended if _ENDED(w) else plain).append(w)
        heads, marks = [w[:-1] for w in ended], [w[-1] for w in ended]
        new = [w for w in dict.fromkeys([*plain, *heads, *marks]) if w not in self.slot] if ended else words
        if self.joined is not None:
            fit = self.joined.fitting(new)
            # Apart from ASCII, as a word that is rewritten to another length spoils its group.
            basic, other = [w for w in fit if w.isascii()], [w for w in fit if not w.isascii()]
            groups = [[w for w in g if (w[0] == " ") == space] for g in (basic, other) for space in (True, False)]
            for group in itertools.chain.from_iterable(by_bytes(g, ENCODE_BYTES) for g in groups):
                found = self.joined.encode(group)
                if found is not None:
                    self._put(group, *found)
            new = [w for w in new if w not in self.slot]
        for group in by_bytes(new, ENCODE_BYTES):
            found = self.encode(group)
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(lengths.sum()))
            self._put(group, ids, lengths)
        if ended:
            parts = np.empty(2 * len(ended), np.int64)
            parts[0::2] = np.fromiter(map(self.slot.__getitem__, heads), np.int64, len(heads))
            parts[1::2] = np.fromiter(map(self.slot.__getitem__, marks), np.int64, len(marks))
            lengths = self.lengths[parts]
            self._put(ended, self._gather(parts), lengths[0::2] + lengths[1::2])

    def _gather(self, slots: np.ndarray) -> np.ndarray:
        """The ids of the slots, one after another."""
        lengths = self.lengths[slots]
        ends = np.cumsum(lengths)
        place = np.arange(ends[-1] if len(ends) else 0)
        return self.pool[place + np.repeat(self.starts[slots] - ends + lengths, lengths)]

    def _chunks(self, column: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All chunks in order, and the number of chunks of each text."""
        if self.spaces == "whole":
            return column, np.ones(len(column), np.int64)
        whole = np.zeros(len(column), bool)
        for mark in self.special:
            whole |= pc.match_substring(column, mark).to_numpy(zero_copy_only=False)
        if self.spaces == "kept":
            return self._cut(column, whole)
        plain = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        if not whole.any():
            return plain.flatten(), np.diff(plain.offsets.to_numpy())
        parts = [column.slice(i, 1) if whole[i] else plain[i].values for i in range(len(column))]
        return pa.concat_arrays(parts), np.array(list(map(len, parts)))

    def _cut(self, column: pa.Array, whole: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Chunks as places in the bytes of the column, for spaces that are kept."""
        column = column.cast(pa.string())
        _, offsets, buffer = column.buffers()
        ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1] \
            if len(column) else np.zeros(1, np.int32)
        data = np.frombuffer(buffer or b"", np.uint8)[ends[0]:ends[-1]]
        ends = (ends - ends[0]).astype(np.int64)
        cut = data == 32
        if self.apart:
            feed = data == 10
            cut |= feed
            cut[1:] |= feed[:-1]
        odd = pc.match_substring_regex(column, _ODD).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(odd & ~whole).tolist():
            found = _CHUNK.findall(column[i].as_py())
            sizes = np.fromiter((len(c.encode()) for c in found), np.int64, len(found))
            cut[ends[i]:ends[i + 1]] = False
            cut[ends[i] + np.cumsum(sizes) - sizes] = True
        if self.apart:
            letter = _LETTER[data]
            high = _LATIN[data[:-1]]
            for first, second in _NO_LETTERS:
                high &= (data[:-1] != first) | (data[1:] != second)
            letter[1:] |= high
            cut[1:] |= letter[:-1] & _MARK[data[1:]]
        for i in np.flatnonzero(whole).tolist():
            cut[ends[i]:ends[i + 1]] = False
        cut[ends[:-1][ends[:-1] < ends[1:]]] = True
        starts = np.flatnonzero(cut)
        places = np.append(starts, len(data)).astype(np.int32)
        chunks = pa.StringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(data))
        return chunks, np.diff(np.searchsorted(starts, ends))

    def _slots(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each chunk, and the number of chunks of each text."""
        chunks, counts = self._chunks(column)
        coded = chunks.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._trim()
        slots = np.fromiter(map(self.slot.get, words, itertools.repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(slots < 0)
        if len(unknown):
            missing = [words[i] for i in unknown.tolist()]
            self._learn([w for w in missing if len(w) <= LONG])
            self.kept = len(self.slot), self.used, self.characters
            self._learn([w for w in missing if len(w) > LONG])
            slots[unknown] = np.fromiter(map(self.slot.__getitem__, missing), np.int64, len(missing))
        self.uses[slots] += 1
        return slots[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.int64), counts

    def _trim(self) -> None:
        """Forget long chunks of the last texts, and the less used half if there is too much."""
        size, self.used, self.characters = self.kept
        while len(self.slot) > size:
            self.slot.popitem()
        if ENTRY_BYTES * size + self.characters + 4 * self.used <= self.max_bytes:
            return
        words, uses = list(self.slot), self.uses[:size]
        # In the order of slots; of equally used ones the later come first.
        stay = np.sort(np.lexsort((-np.arange(size), -uses))[:size // 2])
        words = [words[i] for i in stay.tolist()]
        ids, lengths = self._gather(stay), self.lengths[stay]
        self._clear()
        if ENTRY_BYTES * len(words) + sum(map(len, words)) + 4 * len(ids) <= self.max_bytes:
            self._put(words, ids, lengths)
            self.kept = len(self.slot), self.used, self.characters

    def counts(self, column: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        slots, counts = self._slots(column)
        total = np.concatenate([[0], np.cumsum(self.lengths[slots])])
        ends = np.cumsum(counts)
        return total[ends] - total[ends - counts]

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text."""
        slots, counts = self._slots(column)
        total = np.concatenate([[0], np.cumsum(self.lengths[slots])])
        ends = np.cumsum(counts)
        return self._gather(slots), total[ends] - total[ends - counts]


def white_space(tokenizer: dict) -> str:
    """How a tokenizers file treats white space, or ``"whole"`` if that cannot be told.

    ``"kept"``: words by the byte-level pattern, on the text as it is. ``"dropped"``: parts by
    a pattern whose matches hold no space, on a text that was rewritten character by character,
    by composition or by folding white space, none of which reaches over a space.
    """
    normalizer, splitter = tokenizer.get("normalizer"), tokenizer.get("pre_tokenizer") or {}
    if splitter.get("type") == "ByteLevel" and splitter["use_regex"] and not splitter["add_prefix_space"] \
            and not normalizer:
        return "kept"
    steps = [normalizer] if normalizer else []
    if normalizer and normalizer["type"] == "Sequence":
        steps = normalizer["normalizers"]
    parts = splitter.get("pretokenizers", [])
    plain = all(
        step["type"] in ("NFC", "Lowercase")
        or step["type"] == "Replace" and step["pattern"] == {"Regex": r"\s+"} and step["content"] == " "
        for step in steps)
    if not plain or not parts or parts[0]["type"] != "Split":
        return "whole"
    rule = parts[0]
    rest = all(p["type"] == "ByteLevel" and not p["use_regex"] and not p["add_prefix_space"] for p in parts[1:])
    if not rest or rule["behavior"] != "Removed" or not rule["invert"] or "Regex" not in rule["pattern"]:
        return "whole"
    found = regex.findall(rule["pattern"]["Regex"], " a b  1 2 . , \n ' s é 你 ")
    return "whole" if any(m.isspace() or len(m.split()) > 1 or m != m.strip() for m in found) else "dropped"


@lru_cache(maxsize=2)
def library_encoder(path: str, spaces: str | None = None) -> ChunkEncoder:
    """The encoder of a tokenizers or sentencepiece file, one per worker.

    How texts may be cut is read from the file; ``spaces`` may ask for ``"whole"`` instead, and
    is refused if it says what the file does not.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return ChunkEncoder(lambda group: model.encode(group, num_threads=1), "whole")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    known = white_space(json.loads(tokenizer.to_str()))
    if spaces not in (None, known, "whole"):
        raise ValueError(f"white space is {known} by {path}, not {spaces}")
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def encode(group: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(group, add_special_tokens=False)]

    # Spaces are kept only by byte-level pre-tokenizers, whose pattern is the one of APART.
    return ChunkEncoder(encode, spaces or known, special, joined=_joined(tokenizer, spaces or known),
                        apart=(spaces or known) == "kept")


def _joined(tokenizer, spaces: str) -> Joined | None:
    """For byte-level vocabularies, whose tokens have a character for each byte."""
    model = json.loads(tokenizer.to_str())["model"]
    if spaces == "whole" or model["type"] != "BPE" or model["unk_token"] or model["byte_fallback"]:
        return None
    end = model["end_of_word_suffix"] or ""
    sizes = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
    for token, number in tokenizer.get_vocab(with_added_tokens=True).items():
        sizes[number] = len(token) - (len(end) if end and token.endswith(end) else 0)
    return Joined(
        lambda text: tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, sizes, spaces)
