"""Exact token ids at the speed of a table: each distinct chunk of text goes to the library once.

A text is cut only where the tokenizer itself always cuts: before an ASCII white-space character
that follows a character other than white space, after a line end between such a character and an
ASCII letter, and before ASCII punctuation (but the apostrophe, and what added tokens contain) that
follows a letter of ASCII or Latin-1. No piece of the two supported pre-tokenizers (byte-level BPE with its usual pattern,
and the word-end BPE that drops white space) reaches over such a place, and their normalizers do
not either, so the ids of the chunks laid end to end are the ids of the text. ``tests/llm``
compares them with whole-text encoding, on real and on random texts.

Chunks repeat far more than texts do. Their ids are kept by 64-bit hash in a table of bounded
size (sorted arrays); when it is full, the half that was used least is dropped. Misses are encoded by the
tokenizers library: a chunk that is one run of Latin letters goes straight to its model, all
others (and so every special token) through its whole pipeline.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterable

import numpy as np

from cabflow.llm import kernels as k

#: Chunks of which the ids are remembered; bounds a worker's memory (about 50 bytes each).
TABLE_ENTRIES = 1 << 20
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(f" ?[{LATIN}]+")
CUT = np.zeros(256, bool)
CUT[[0x20, 0x09, 0x0A, 0x0D]] = True
STOPS = frozenset("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LETTER = np.zeros(256, bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = True


def _after_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place is white space (Unicode, in UTF-8)."""
    a = data[at - 1]
    b = data[np.maximum(at - 2, 0)]
    c = data[np.maximum(at - 3, 0)]
    return (
        SPACE[a]
        | ((b == 0xC2) & ((a == 0x85) | (a == 0xA0)))
        | ((c == 0xE1) & (b == 0x9A) & (a == 0x80))
        | ((c == 0xE2) & (b == 0x80) & ((a <= 0x8A) | (a == 0xA8) | (a == 0xA9) | (a == 0xAF)))
        | ((c == 0xE2) & (b == 0x81) & (a == 0x9F))
        | ((c == 0xE3) & (b == 0x80) & (a == 0x80))
    )


def stops(added: Iterable[str]) -> np.ndarray:
    """Bytes of punctuation before which a text may be cut: those of no added token."""
    table = np.zeros(256, bool)
    table[[ord(c) for c in STOPS.difference(*added)]] = True
    return table


def _after_letter(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place is a letter of ASCII or Latin-1 (in UTF-8)."""
    a, b = data[at - 1], data[np.maximum(at - 2, 0)]
    return LETTER[a] | ((b == 0xC3) & (a >= 0x80) & (a <= 0xBF) & (a != 0x97) & (a != 0xB7))


def cuts(data: np.ndarray, bounds: np.ndarray, stop_bytes: np.ndarray) -> np.ndarray:
    """Byte offsets at which the chunks of all documents begin."""
    if not len(data):
        return np.zeros(0, np.int64)
    space = np.flatnonzero(CUT[data])
    space = space[space > 0]
    space = space[~_after_space(data, space)]
    stop = np.flatnonzero(stop_bytes[data])
    stop = stop[stop > 0]
    stop = stop[_after_letter(data, stop)]
    line = space[(data[space] == 0x0A) & (space + 1 < len(data))] + 1
    line = line[LETTER[data[line]]]
    mark = np.zeros(len(data), bool)
    mark[space] = mark[stop] = mark[line] = True
    first = bounds[:-1]
    mark[first[first < len(data)]] = True
    return np.flatnonzero(mark)


class Encoder:
    """Ids of texts by one tokenizer file; one per Python worker."""

    _open: dict[str, "Encoder"] = {}

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tk = Tokenizer.from_file(path)
        self.tk.no_truncation()
        self.tk.no_padding()
        self.stops = stops(t.content for t in self.tk.get_added_tokens_decoder().values())
        self.names = np.zeros(0, np.uint64)  # hashes of the chunks kept, sorted
        self.slots = np.zeros(0, np.int32)  # of each of them: its place in the arrays below
        self.flat = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1 << 14, np.int64)  # of each slot: where its ids begin in flat
        self.size = np.zeros(1 << 14, np.int32)
        self.used = np.zeros(1 << 14, np.int32)
        self.end = 0
        self.letters = self._letters()

    def _through_library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tk.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, s: str) -> str:
        s = self.tk.normalizer.normalize_str(s) if self.tk.normalizer else s
        return "".join(p for p, _ in self.tk.pre_tokenizer.pre_tokenize_str(s))

    def _letters(self) -> dict[int, str] | None:
        """What the pipeline makes of each Latin letter before it reaches the model (as a
        translation table), or None where that is not a letter-by-letter matter."""
        every = [chr(c) for c in range(0x41, 0x100) if re.fullmatch(f"[{LATIN}]", chr(c))]
        table = {ord(c): self._pieces(c) for c in every}
        table[0x20] = self._pieces(" a").removesuffix(self._pieces("a"))
        self.letters = table
        probe = [" " + "".join(every), "".join(every[::-1]), " Straße", "naïve", " The"]
        return table if [self._model(x) for x in probe] == self._through_library(probe) else None

    def _model(self, plain: str) -> list[int]:
        return [t.id for t in self.tk.model.tokenize(plain.translate(self.letters))]

    def _ids(self, chunks: list[str]) -> list[list[int]]:
        out: list = [None] * len(chunks)
        rest = []
        for i, c in enumerate(chunks):
            if self.letters is not None and PLAIN.fullmatch(c):
                out[i] = self._model(c)
            else:
                rest.append(i)
        for at in range(0, len(rest), 2000):
            part = rest[at : at + 2000]
            for i, ids in zip(part, self._through_library([chunks[i] for i in part]), strict=True):
                out[i] = ids
        return out

    def _add(self, names: np.ndarray, where: np.ndarray, chunks: list[str]) -> np.ndarray:
        """The slots of new chunks; ``where``: the places of their ``names`` among those kept."""
        ids = self._ids(chunks)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        new = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(sizes.sum()))
        n, m = len(self.names), len(self.names) + len(ids)
        while m > len(self.at):
            self.at, self.size, self.used = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.size, self.used))
        while self.end + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.end : self.end + len(new)] = new
        self.at[n:m] = self.end + np.cumsum(sizes) - sizes
        self.size[n:m] = sizes
        self.used[n:m] = 0
        self.end += len(new)
        slots = np.arange(n, m, dtype=np.int32)
        self.names, self.slots = np.insert(self.names, where, names), np.insert(self.slots, where, slots)
        return slots

    def _shrink(self) -> None:
        """Keep the half of the table that was used most."""
        n = len(self.names)
        keep = np.zeros(n, bool)
        keep[np.argpartition(-self.used[:n], n // 2)[: n // 2]] = True
        size = self.size[:n][keep].astype(np.int64)
        take = np.repeat(self.at[:n][keep] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        self.flat, self.end = self.flat[take], len(take)
        self.at, self.size, self.used = np.cumsum(size) - size, self.size[:n][keep], self.used[:n][keep] // 2
        moved = (np.cumsum(keep) - 1).astype(np.int32)
        kept = keep[self.slots]
        self.names, self.slots = self.names[kept], moved[self.slots[kept]]

    def _slots(self, names: np.ndarray, first: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The slot of each of the sorted ``names``; chunk ``first`` bears it."""
        where = np.searchsorted(self.names, names)
        slot = np.full(len(names), -1, np.int32)
        inside = np.flatnonzero(where < len(self.names))
        inside = inside[self.names[where[inside]] == names[inside]]
        slot[inside] = self.slots[where[inside]]
        missing = np.flatnonzero(slot < 0)
        if len(missing):
            raw = data.tobytes()
            spans = zip(start[first[missing]].tolist(), end[first[missing]].tolist(), strict=True)
            slot[missing] = self._add(names[missing], where[missing], [raw[x:y].decode("utf-8", "replace") for x, y in spans])
        return slot

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(uint32 ids of all documents of a chunk, where those of each document begin), as
        ``Tokenizer.encode(text, add_special_tokens=False)`` gives them."""
        start = cuts(data, bounds, self.stops)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        end = np.append(start[1:], len(data))
        every = k.run_hash(data, start, end)
        order = np.argsort(every)
        ordered = every[order]
        new = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        times = np.diff(np.append(new, len(every)))
        if len(self.names) + len(new) > TABLE_ENTRIES and len(self.names) > TABLE_ENTRIES // 2:
            self._shrink()
        each = self._slots(ordered[new], order[new], data, start, end)
        self.used[each] += times.astype(np.int32)
        slot = np.empty(len(every), np.int32)
        slot[order] = np.repeat(each, times)
        size = self.size[slot]
        to = np.cumsum(size, dtype=np.int64)
        ids = self.flat[np.repeat(self.at[slot] - (to - size), size) + np.arange(to[-1])]
        of = np.searchsorted(start, bounds)
        return ids, np.append(0, to)[of]
