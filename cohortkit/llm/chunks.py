"""Cutting a text at single spaces, line ends and stops without changing its byte-level BPE tokens.

The pre-tokenizer of the byte-level vocabularies attaches one space to the front of the word that follows it, and
of a run of white space it leaves the last character to what follows. So no piece crosses the front of a space that
has a non-space character behind it. A line end with no white space on either side is a piece of its own, and a piece
of letters ends before a full stop or comma. The chunks between those places can be encoded apart and kept in a table.
A space before other white space joins with it, and a special token is matched before the text is cut; texts with
either are encoded whole.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from cohortkit.llm.common import Piece

SPECIAL = b"<|endoftext|>"
#: White space of one byte, and the first, second and third bytes of the rest (0: any second or third byte).
_SPACE = np.zeros(256, bool)
_SPACE[[*range(9, 14), *range(28, 33)]] = True
_WIDE = [(0xC2, [0x85, 0xA0], None), (0xE1, [0x9A], [0x80]), (0xE2, [0x80], [*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF]),
         (0xE2, [0x81], [0x9F]), (0xE3, [0x80], [0x80])]


def spaces_before_spaces(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For the places of spaces: does white space follow?"""
    one, two, three = (data[np.minimum(at + k, len(data) - 1)] for k in (1, 2, 3))
    out = _SPACE[one]
    for first, seconds, thirds in _WIDE:
        out |= (one == first) & np.isin(two, seconds) & (True if thirds is None else np.isin(three, thirds))
    return out


_LETTER, _STOP = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP[[44, 46]] = True


def white_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For places behind the first: may white space end there? Some other characters of several bytes count too."""
    one, two = data[at - 1], data[np.maximum(at - 2, 0)]
    return _SPACE[one] | ((one >= 0x80) & (one <= 0xAF) & np.isin(two, [0xC2, 0x80, 0x81, 0x9A]))


def inner_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places inside the texts that are fronts of lone line ends, or between an ASCII letter and a full stop or comma."""
    lines = np.flatnonzero(data == 10)
    text = np.searchsorted(offsets, lines, side="right") - 1
    lines = lines[(lines > offsets[text]) & (lines + 1 < offsets[text + 1])]
    if len(lines):
        lines = lines[~white_before(data, lines) & ~spaces_before_spaces(data, lines)]
    stops = np.flatnonzero(_LETTER[data[:-1]] & _STOP[data[1:]]) + 1
    return np.concatenate([lines, stops])


class ChunkTable:
    """Token ids of the chunks seen so far on this worker, by the chunks' hashes in a sorted array; bounded.

    ``encode`` takes a list of strings and returns all their ids, one after the other, and the number of each.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = 600_000):
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        self.hash, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.begin, self.count = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a buffer, one after the other; number of each)."""
        data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
        if len(self.hash) > self.most or len(self.ids) > 8 * self.most:
            self.clear()
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        raw = data.tobytes()
        whole = np.zeros(len(offsets) - 1, bool)
        at = np.flatnonzero(data == 32)
        text = np.searchsorted(offsets, at, side="right") - 1
        inner = at + 1 < offsets[text + 1]
        whole[text[inner & spaces_before_spaces(data, at)]] = True
        found = raw.find(SPECIAL)
        while found >= 0:
            whole[np.searchsorted(offsets, found, side="right") - 1] = True
            found = raw.find(SPECIAL, found + 1)
        filled = np.flatnonzero(np.diff(offsets))
        inner = inner_cuts(data, offsets)
        inner = inner[~whole[np.searchsorted(offsets, inner, side="right") - 1]]
        starts = np.sort(np.concatenate([offsets[filled], at[~whole[text]], inner]))
        starts = starts[np.append(True, starts[1:] != starts[:-1])]
        ends = np.append(starts[1:], len(data))
        owner = np.searchsorted(offsets, starts, side="right") - 1
        owner = np.minimum(owner, len(whole) - 1)
        alone = whole[owner]

        every = Piece(data, 0)(starts, ends)
        order = np.argsort(every)
        fresh = np.append(True, every[order[1:]] != every[order[:-1]])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(fresh) - 1
        first = order[fresh]  # one place of each chunk
        hashes = every[first]
        near = np.searchsorted(self.hash, hashes)
        known = self.hash[np.minimum(near, len(self.hash) - 1)] == hashes if len(self.hash) else np.zeros(len(hashes), bool)
        new = np.flatnonzero(~known)
        slot = np.empty(len(hashes), np.int64)
        slot[known] = self.slot[near[known]]
        if len(new):
            ids, count = self.encode([raw[a:b].decode() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
            slot[new] = len(self.count) + np.arange(len(new))
            self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
            keep = new[~alone[first[new]]]  # whole texts are not worth keeping
            self.hash = np.insert(self.hash, near[keep], hashes[keep])
            self.slot = np.insert(self.slot, near[keep], slot[keep])
        used = slot[number]
        n = self.count[used]
        stop = np.cumsum(n)
        flat = self.ids[np.arange(int(stop[-1])) + np.repeat(self.begin[used] - (stop - n), n)]
        return flat, np.bincount(owner, n, len(whole)).astype(np.int64)
