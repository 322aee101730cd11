"""Encoding many texts with a public tokenizer, a vocabulary file of the tokenizers library.

A text is cut at places where no pre-token can cross, whatever stands around them: before a single space, and before and
after a single newline, between characters that are surely no white space, and between an ASCII letter and a comma or full
stop that ends such a unit. Encoding the units and joining their ids gives the ids of the whole text (tests hold the two
against each other). The same units come again and again, so each task encodes a distinct unit once and gathers the ids
of all occurrences with numpy. The cache is bounded; units too long for it are encoded as they come.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from .common import data, offsets, ranges

END = 1
MOST_CACHED, LONGEST_CACHED, JOINED, MANY = 600_000, 48, 64, 16384

_SAFE2 = np.zeros(256, bool)  # lead bytes of two-byte characters that are no white space
_SAFE2[0xC3:0xE0] = True
_SAFE3 = np.zeros(256, bool)  # lead bytes of longer such characters
_SAFE3[0xE0] = True
_SAFE3[0xE4:0xF0] = True
_SAFE4 = np.zeros(256, bool)
_SAFE4[0xF0:] = True
_ASCII = np.zeros(256, bool)
_ASCII[0x21:0x7F] = True
_STARTS = _ASCII | _SAFE2 | _SAFE3 | _SAFE4
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True

#: ASCII and Latin-1 letters in UTF-8: a unit of a space and these is one word.
_PLAIN = _LETTER.copy()
_PLAIN[0x80:0xC0] = _PLAIN[0xC3] = True


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def unit_starts(b: np.ndarray, o: np.ndarray) -> np.ndarray:
    """Where units begin in the bytes ``b`` of texts that begin at ``o[:-1]`` and end at ``o[-1]``; sorted."""
    n = len(b)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        ends = _ASCII[b].copy()  # byte i is the last of a character that is surely no white space
        ends[1:] |= _SAFE2[b[:-1]]
        ends[2:] |= _SAFE3[b[:-2]]
        ends[3:] |= _SAFE4[b[:-3]]
        inner = np.zeros(n, bool)  # a lone space or newline within a text, with solid neighbours
        inner[1:-1] = ((b[1:-1] == 32) | (b[1:-1] == 10)) & ends[:-2] & _STARTS[b[2:]]
        begin, end = o[:-1][np.diff(o) > 0], o[1:][np.diff(o) > 0]
        inner[begin] = inner[end - 1] = False
        cut[:n] = inner
        cut[1:] |= inner & (b == 10)
        stop = np.zeros(n, bool)
        stop[1:-1] = ((b[1:-1] == 44) | (b[1:-1] == 46)) & _LETTER[b[:-2]] & inner[2:]
        stop[begin] = False
        cut[:n] |= stop
    cut[o[:-1][np.diff(o) > 0]] = True
    return np.flatnonzero(cut[:n])


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        special = sorted((i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and t.content.startswith("<|") and not t.lstrip and not t.rstrip and not t.single_word and not t.normalized)
        self.mark_id, self.mark = special[-1] if special else (None, None)
        # of a byte-level vocabulary without a normalizer the bytes of each token; of one with word ends which tokens end a word
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        tokens = sorted((i, t) for t, i in self.tokenizer.get_vocab().items())
        self.length = self.ends = None
        if suffix:
            self.ends = np.zeros(tokens[-1][0] + 1, np.int64)
            self.ends[[i for i, t in tokens if t.endswith(suffix)]] = 1
        elif self.tokenizer.normalizer is None:
            self.length = np.zeros(tokens[-1][0] + 1, np.int64)
            self.length[[i for i, _ in tokens]] = [len(t) for _, t in tokens]
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 20, np.uint32), 0
        self.at = np.zeros(1 << 16, np.int64)
        self.length_of = np.zeros(1 << 16, np.int64)

    def _call(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, encoded each for itself, and how many each has."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(got), np.uint32), np.fromiter(map(len, got), np.int64, len(got))

    def _ids(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the units, and how many each has. The library gets JOINED units as one text, so that not each of them
        costs a call and an object: plain words that begin with a space just as they come, which are cut again where their
        bytes or their ends of words are full, others with the special token between, at which the library cuts first."""
        size = np.fromiter(map(len, units), np.int64, len(units))
        at = np.concatenate([[0], np.cumsum(size)])
        raw = np.frombuffer(b"".join(units), np.uint8)
        plain = (raw[at[:-1]] == 32) & (size > 1) & np.logical_and.reduceat(np.r_[True, _PLAIN[raw[1:]]] | (np.arange(len(raw)) == np.repeat(at[:-1], size)), at[:-1]) & _PLAIN[raw[at[1:] - 1]]
        if self.length is None and self.ends is None:
            plain[:] = False
        count = np.zeros(len(units), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []  # units, and their ids in this order
        words = np.flatnonzero(plain)
        for i in range(0, len(words), MANY):
            some = words[i : i + MANY]
            texts = [b"".join([units[j] for j in some[k : k + JOINED].tolist()]).decode() for k in range(0, len(some), JOINED)]
            ids, _ = self._call(texts)
            if self.length is not None:  # a token that ends where a unit does
                done, goal = np.cumsum(self.length[ids]), np.cumsum(size[some])
            else:
                done, goal = np.cumsum(self.ends[ids]), np.arange(1, len(some) + 1)
            last = np.searchsorted(done, goal)
            if not len(done) or done[-1] != goal[-1] or (done[last] != goal).any():
                plain[some] = False  # no such vocabulary: one by one
                continue
            count[some] = np.diff(last, prepend=-1)
            parts.append((some, ids))
        rest = np.flatnonzero(~plain)
        safe = [j for j in rest.tolist() if self.mark is not None and b"<|" not in units[j]]
        for i in range(0, len(safe), JOINED):
            some = safe[i : i + JOINED]
            ids, _ = self._call([self.mark.join([units[j].decode() for j in some])])
            cut = np.flatnonzero(ids == self.mark_id)
            count[some] = np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1
            parts.append((np.array(some), np.delete(ids, cut)))
        alone = sorted(set(rest.tolist()) - set(safe))
        if alone:
            ids, n = self._call([units[j].decode() for j in alone])
            count[alone] = n
            parts.append((np.array(alone), ids))
        to = np.cumsum(count) - count
        flat = np.zeros(int(count.sum()), np.uint32)
        for some, ids in parts:
            flat[ranges(to[some], count[some])] = ids
        return flat, count

    def _remember(self, units: list[bytes], flat: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(flat)] = flat
        n = len(self.known)
        while n + len(units) > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
            self.length_of = np.concatenate([self.length_of, np.zeros_like(self.length_of)])
        self.at[n : n + len(units)] = self.used + np.cumsum(sizes) - sizes
        self.length_of[n : n + len(units)] = sizes
        self.known.update(zip(units, range(n, n + len(units)), strict=True))
        self.used += len(flat)

    def units(self, b: np.ndarray, o: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the texts in ``b``: where units begin, how many ids each has, and all ids."""
        start = unit_starts(b, o)
        if not len(start):
            return start, np.zeros(0, np.int64), np.zeros(0, np.uint32)
        bounds = np.append(start, len(b)).astype(np.int64)
        arr = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(b))])
        coded = arr.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > MOST_CACHED:
            self.clear()
        found = list(map(self.known.get, distinct))
        fresh = [u for u, i in zip(distinct, found, strict=True) if i is None]
        if fresh:
            self._remember(fresh, *self._ids(fresh))
            found = list(map(self.known.__getitem__, distinct))
        index = np.array(found, np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
        count = self.length_of[index]
        ids = self.flat[ranges(self.at[index], count)]
        if self.used > 8 * MOST_CACHED or any(len(u) > LONGEST_CACHED * 1000 for u in fresh):
            self.clear()  # texts without spaces
        return start, count, ids

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's begin (n + 1 places)."""
        o = offsets(column)
        b = data(column)[int(o[0]) : int(o[-1])]
        o = o - o[0]
        start, count, ids = self.units(b, o)
        total = np.concatenate([[0], np.cumsum(count)])
        return ids, total[np.searchsorted(start, o)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each vocabulary and worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def with_end(ids: np.ndarray, at: np.ndarray, end: int = END) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end`` after each text."""
    n = len(at) - 1
    out = np.full(len(ids) + n, end, np.uint32)
    keep = np.ones(len(out), bool)
    keep[at[1:] + np.arange(n)] = False
    out[keep] = ids
    return out, at + np.arange(n + 1)
