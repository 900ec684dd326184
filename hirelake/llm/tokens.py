"""Whole texts to token ids, with a tokenizer file of the ``tokenizers`` library.

For the lower-casing word BPE with word ends, ids depend only on the unit a
byte stands in, where units end at white space and between letters and the
marks ``. , ; : ! ?``.  Units are hashed in numpy, looked up in a direct-mapped
cache of fixed size, and only those not in it go through the library.  Texts
with characters on which Python and the library may differ about white space
are given to the library whole.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from hirelake.llm import common as C

SLOTS = 1 << 20          # units the cache can hold
POOL = 6_000_000         # ids the cache can hold; it starts anew when full
MARKS = b".,;:!?"
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -​    　﻿]|<\\|")

_MARK = np.zeros(256, bool)
_MARK[list(MARKS)] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def _units(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row): words, cut between letters or digits and marks."""
    starts, ends, row = C.word_spans(buf, off)
    if not len(starts):
        return starts, ends, row
    mark, letter = _MARK[buf], _ALNUM[buf]
    # the two-byte letters after 0xC3, without the signs for times and divided by
    tail = (buf[1:] >= 0x80) & (buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
    before, after = letter.copy(), letter.copy()
    before[1:] |= tail        # the letter's last byte
    after[:-1] |= tail        # the letter's first byte
    cut = np.flatnonzero((before[:-1] & mark[1:]) | (mark[:-1] & after[1:])) + 1
    word = np.searchsorted(starts, cut, "right") - 1
    ok = (word >= 0) & (cut > starts[word]) & (cut < ends[word])
    cut, word = cut[ok], word[ok]
    s = np.sort(np.concatenate([starts, cut]))
    e = np.sort(np.concatenate([ends, cut]))
    return s, e, np.searchsorted(off, s, "right") - 1


class Encoder:
    """Ids of many texts; one per Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self._clear()

    def _clear(self) -> None:
        self.key = np.zeros(SLOTS, C.U)
        self.at = np.zeros(SLOTS, np.int32)
        self.long = np.zeros(SLOTS, np.int32)
        self.pool = np.zeros(POOL, np.uint32)
        self.used = 0

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, units: list[bytes]) -> list[list[int]]:
        out: list[list[int] | None] = [None] * len(units)
        rest = []
        for i, u in enumerate(units):
            if u.isalpha():  # ASCII letters only: one word of the model
                out[i] = [t.id for t in self.model.tokenize(u.decode())]
            else:
                rest.append(i)
        got = self.tokenizer.encode_batch_fast([units[i].decode() for i in rest], add_special_tokens=False)
        for i, e in zip(rest, got):
            out[i] = e.ids
        return out

    def block(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, offsets of the rows' ids)."""
        starts, ends, row = _units(buf, off)
        h = C.word_hashes(buf, starts, ends) | C.U(1)
        slot = (h >> C.U(20)).astype(np.int64) & (SLOTS - 1)
        at, long = self.at[slot].astype(np.int64), self.long[slot].astype(np.int64)
        miss = np.flatnonzero(self.key[slot] != h)
        if len(miss):
            new, first, back = np.unique(h[miss], return_index=True, return_inverse=True)
            raw = C.LOWER[buf].tobytes()
            a, b = starts[miss[first]], ends[miss[first]]
            ids = self._learn([raw[x:y] for x, y in zip(a.tolist(), b.tolist())])
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(size.sum()))
            if self.used + len(flat) > POOL:
                if len(miss) < len(h):  # begin anew, with all of this block
                    self._clear()
                    return self.block(buf, off)
                self.pool = np.zeros(max(POOL, len(flat)), np.uint32)
                self.key[:], self.used = 0, 0
            place = self.used + np.concatenate([[0], np.cumsum(size)[:-1]])
            self.pool[self.used: self.used + len(flat)] = flat
            self.used += len(flat)
            s = (new >> C.U(20)).astype(np.int64) & (SLOTS - 1)
            self.key[s], self.at[s], self.long[s] = new, place, size
            at[miss], long[miss] = place[back], size[back]
        total = np.concatenate([[0], np.cumsum(long)])
        ids = self.pool[np.repeat(at - total[:-1], long) + np.arange(total[-1])]
        cut = total[np.searchsorted(row, np.arange(len(off)))]
        return ids, cut

    def texts(self, col: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text of an Arrow string column, in order."""
        for lo, hi, buf, off in C.text_blocks(col):
            ids, cut = self.block(buf, off)
            odd = {}
            plain = len(buf) == 0 or not ((buf < 0x20) | (buf == 0xC2) | (buf == 0xE1) | (buf == 0xE2) | (buf == 0xE3)
                                          | (buf == 0xEF) | (buf == 0x7C)).any()
            if not plain:
                raw = buf.tobytes()
                rows = [i for i in range(hi - lo) if ODD_SPACE.search(raw[off[i]: off[i + 1]].decode())]
                odd = dict(zip(rows, self.whole([raw[off[i]: off[i + 1]].decode() for i in rows])))
            for i in range(hi - lo):
                yield odd[i] if i in odd else ids[cut[i]: cut[i + 1]]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)
