"""Token ids of the tokenizers library, each distinct run of letters, digits or marks encoded once per task.

The tokenizer of ``word_bpe_49k.json`` drops white space and encodes every pre-token on its own, so a text may be cut
wherever two pre-tokens are sure to part: at ASCII white space, and between letters, digits and other ASCII marks.
Characters outside ASCII and the Latin-1 letters are never cut from their neighbours, nor is an apostrophe from the
letters after it; the library itself cuts such runs. A text with ``<|`` may hold a special token and goes through the
library whole.

Runs are found and hashed by numpy over slices of texts. A task keeps the ids of runs it has met in a hash table of
arrays; two different runs have the same hash and length with a probability of about 1 in 10**19 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers

from basketry.llm.common import flat_bytes, run_hashes, text_slices

TOKENIZER = "word_bpe_49k.json"
# A task forgets its runs beyond so many runs or ids.
RUNS, IDS = 600_000, 8_000_000

_SPACE, _LETTER, _DIGIT, _MARK, _OTHER = range(5)
_KIND = np.full(256, _MARK, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[range(0x30, 0x3A)] = _DIGIT
_KIND[0x80:] = _OTHER


def _kinds(data: np.ndarray) -> np.ndarray:
    kinds = _KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)  # U+00C0 to U+00FF: letters but for the two signs
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kinds[lead] = _LETTER
    kinds[lead + 1] = _LETTER
    return kinds


def runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, kind) of every run of bytes that may be encoded on its own, and the bytes in lower case.

    A run of several kinds, or with characters outside ASCII and the Latin-1 letters, has the kind ``_OTHER`` and keeps its case.
    """
    kinds = _kinds(data)
    before, after = kinds[:-1], kinds[1:]
    cut = (before != after) & (((before != _OTHER) & (after != _OTHER)) | (before == _SPACE) | (after == _SPACE))
    cut &= ~((data[:-1] == 0x27) & (after == _LETTER))
    edges = np.concatenate(([0], np.flatnonzero(cut) + 1, [len(data)]))
    found = kinds[edges[:-1]]
    changes = np.concatenate(([0], np.cumsum(before != after)))
    found[changes[edges[1:] - 1] > changes[edges[:-1]]] = _OTHER
    upper = (data >= 0x41) & (data <= 0x5A)
    upper[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    upper &= np.repeat(found == _LETTER, np.diff(edges))
    real = found != _SPACE
    return edges[:-1][real], edges[1:][real], found[real], np.where(upper, data | 0x20, data)


class Table:
    """Open addressing in arrays: 64-bit keys to numbers."""

    def __init__(self, bits: int = 16):
        self.mask = np.uint64((1 << bits) - 1)
        self.keys, self.numbers, self.used = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32), 0

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Distinct keys that are not in the table yet."""
        if 2 * (self.used + len(keys)) > len(self.keys):
            held = self.numbers >= 0
            old, olds = self.keys[held], self.numbers[held]
            need = 4 * (self.used + len(keys))
            self.__init__(int(need - 1).bit_length())
            self.add(old, olds)
        self.used += len(keys)
        slots = keys & self.mask
        while len(keys):
            free = self.numbers[slots] < 0
            at = slots[free]
            self.keys[at], self.numbers[at] = keys[free], numbers[free]
            left = self.numbers[slots] != numbers  # another key stands there
            keys, numbers, slots = keys[left], numbers[left], (slots[left] + np.uint64(1)) & self.mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the keys, -1 where the table hasn't one."""
        slots = keys & self.mask
        found = self.numbers[slots]
        rows = np.flatnonzero((found >= 0) & (self.keys[slots] != keys))
        while len(rows):
            slots[rows] = (slots[rows] + np.uint64(1)) & self.mask
            found[rows] = self.numbers[slots[rows]]
            rows = rows[(found[rows] >= 0) & (self.keys[slots[rows]] != keys[rows])]
        return found


def _byte_letters() -> np.ndarray:
    """The letters that byte-level vocabularies write bytes as: printable ones as themselves, the rest from U+0100 on."""
    plain = np.zeros(256, bool)
    plain[[*range(33, 127), *range(161, 173), *range(174, 256)]] = True
    return np.where(plain, np.arange(256), 255 + np.cumsum(~plain)).astype("<u4")


class Encoder:
    """One task's tokenizer. ``path`` is a file that every executor can read."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model, self.letters = self.library.model, _byte_letters()
        self._forget()

    def _forget(self) -> None:
        self.table, self.n = Table(), 0
        self.pool, self.starts, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int32)

    def _learn(self, low: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, kinds: np.ndarray) -> None:
        """Encode runs that no earlier slice had. Letters or marks alone are one pre-token, every digit is one."""
        raw, tokenize = low.tobytes(), self.model.tokenize
        letters = self.letters[low].tobytes().decode("utf-32-le")
        ids: list[int] = []
        sizes = np.empty(len(keys), np.int32)
        for i, (a, b, kind) in enumerate(zip(starts.tolist(), ends.tolist(), kinds.tolist())):
            before = len(ids)
            if kind == _OTHER:
                ids += self.library.encode(raw[a:b].decode(), add_special_tokens=False).ids
            elif kind == _DIGIT:
                ids += [t.id for d in letters[a:b] for t in tokenize(d)]
            else:
                ids += [t.id for t in tokenize(letters[a:b])]
            sizes[i] = len(ids) - before
        self.table.add(keys, np.arange(self.n, self.n + len(keys), dtype=np.int32))
        self.n += len(keys)
        self.starts = np.concatenate((self.starts, len(self.pool) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.pool = np.concatenate((self.pool, np.array(ids, np.uint32)))

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.n > RUNS or len(self.pool) > IDS:
            self._forget()
        data, offsets = flat_bytes(texts)
        starts, ends, kinds, low = runs(data)
        keys = run_hashes(low, starts, ends)
        numbers = self.table.find(keys)
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            fresh, first = np.unique(keys[missing], return_index=True)
            rows = missing[first]
            self._learn(low, fresh, starts[rows], ends[rows], kinds[rows])
            numbers[missing] = self.table.find(keys[missing])
        sizes = self.sizes[numbers]
        stops = np.cumsum(sizes, dtype=np.int64)
        flat = self.pool[np.arange(stops[-1] if len(stops) else 0) + np.repeat(self.starts[numbers] - (stops - sizes), sizes)]
        bounds = np.concatenate(([0], stops))[np.searchsorted(starts, offsets)]
        return flat, np.diff(bounds)

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Row ranges of the texts with all their ids (uint32) one after the other and how many each row has."""
        for start, stop in text_slices(texts, 1 << 20):
            part = texts.slice(start, stop - start)
            special = [i for i, t in enumerate(part.to_pylist()) if t and "<|" in t]
            if not special:
                yield start, stop, *self._slice(part)
                continue
            at = 0
            for i in [*special, stop - start]:
                if i > at:
                    yield start + at, start + i, *self._slice(part.slice(at, i - at))
                if i < stop - start:
                    ids = np.array(self.library.encode(part[i].as_py(), add_special_tokens=False).ids, np.uint32)
                    yield start + i, start + i + 1, ids, np.array([len(ids)])
                at = i + 1


def default_path() -> str:
    return public_tokenizers.path(TOKENIZER)
