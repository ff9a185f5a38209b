"""Merging of many short byte strings at once by the ranks of a merge vocabulary.

Strings of about one length are rows of a matrix of ids. A step merges in every row the
leftmost pair of the lowest rank, which is what merging one string after another does;
rows without a pair to merge are done. Only the two pairs beside a merge are looked up
anew, so a step costs a few vectorised operations whatever the number of strings.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa

from intentloom.llm.tokens import byte_characters

NO_RANK = (1 << 31) - 1
#: Places of the table that says where a pair may stand among the merges, as a power of 2.
SLOT_BITS = 20
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Widths of the matrices; the last is the longest string that is taken.
WIDTHS = (2, 4, 6, 8, 10, 12, 16, 24, 32, 64)
LONGEST = WIDTHS[-1]


class Merger:
    """Ids of byte strings; `ending` marks the last byte of each, if the vocabulary does."""

    def __init__(self, vocabulary: dict[str, int], merges: Sequence, ending: str = ""):
        of_byte = {b: c for c, b in byte_characters().items()}
        self.inner = np.array([vocabulary[of_byte[b]] for b in range(256)], dtype=np.int32)
        self.last = np.array([vocabulary[of_byte[b] + ending] for b in range(256)], dtype=np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], dtype=np.int64)
        self.keys, self.ranks = np.unique(keys, return_index=True)  # a pair's first rank holds
        self.ranks = self.ranks.astype(np.int32)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int32)
        slots = self._slots(self.keys)
        self.at = np.full(1 << SLOT_BITS, -1, dtype=np.int32)
        self.at[slots] = np.arange(len(slots))
        #: keys, sorted, whose slot another one has
        self.displaced = np.flatnonzero(self.at[slots] != np.arange(len(slots)))

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * MIX >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; the id -1, after a string's end, is in none."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        at = self.at[self._slots(keys)]
        found = np.where(self.keys[at] == keys, self.ranks[at], NO_RANK)
        if len(self.displaced):
            unsure = np.nonzero((found == NO_RANK) & (at >= 0))
            wanted, there = keys[unsure], self.keys[self.displaced]
            place = self.displaced[np.minimum(np.searchsorted(there, wanted), len(there) - 1)]
            found[unsure] = np.where(self.keys[place] == wanted, self.ranks[place], NO_RANK)
        return found

    def encode(self, strings: Sequence[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each string; all have 1 to LONGEST bytes."""
        return self.encode_array(pa.array(strings, pa.binary())).to_pylist()

    def encode_array(self, strings: pa.BinaryArray) -> pa.LargeBinaryArray:
        """The same for an Arrow array without nulls, whose bytes need no copies of their own."""
        _, limits, data = strings.buffers()
        limits = np.frombuffer(limits or b"", np.int32)[strings.offset :][: len(strings) + 1]
        starts, sizes = limits[:-1], np.diff(limits)
        padding = np.zeros(LONGEST, dtype=np.uint8)
        data = np.concatenate([np.frombuffer(data or b"", np.uint8), padding])
        counts = np.zeros(len(strings), dtype=np.int64)
        found, low = [], 0
        for width in WIDTHS:
            places = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            if not len(places):
                continue
            size, columns = sizes[places], np.arange(width, dtype=np.int32)
            own = data[starts[places][:, None] + columns]
            ids = self.inner[own]
            rows = np.arange(len(places))
            ids[rows, size - 1] = self.last[own[rows, size - 1]]
            ids[columns >= size[:, None]] = -1
            ids, counts[places] = self._merge(ids)
            found.append((places, ids[ids >= 0]))
        ends = np.cumsum(counts)
        flat = np.empty(counts.sum(), dtype="<u4")
        for places, ids in found:
            own = counts[places]
            shift = ends[places] - np.cumsum(own)
            flat[np.repeat(shift, own) + np.arange(len(ids))] = ids
        limits = pa.py_buffer(4 * np.concatenate([[0], ends]))
        return pa.Array.from_buffers(pa.large_binary(), len(strings), [None, limits, pa.py_buffer(flat)])

    def _merge(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The merged rows and their numbers of ids; ids fill a row from its start."""
        done = ids.copy()
        left = np.arange(len(ids))
        ranks = self._rank(ids[:, :-1], ids[:, 1:])
        while len(left):
            at = ranks.argmin(axis=1)
            rows = np.arange(len(left))
            best = ranks[rows, at]
            going = best < NO_RANK
            if not going.all():
                done[left[~going]] = -1
                done[left[~going], : ids.shape[1]] = ids[~going]
                left, ids, ranks, at, best = (x[going] for x in (left, ids, ranks, at, best))
                rows = np.arange(len(left))
                if not len(left):
                    break
            # everything behind the pair moves up by one
            columns = np.arange(ids.shape[1] - 1)
            moved = columns >= at[:, None]
            ids = np.where(moved, ids[:, 1:], ids[:, :-1])
            ids[rows, at] = self.merged[best]
            if ids.shape[1] == 1:  # pairs that are one id now
                done[left] = -1
                done[left, 0] = ids[:, 0]
                break
            ranks = np.where(moved[:, :-1], ranks[:, 1:], ranks[:, :-1])
            before = np.maximum(at - 1, 0)
            has_before = np.flatnonzero(at > 0)
            ranks[has_before, before[has_before]] = self._rank(
                ids[has_before, before[has_before]], ids[has_before, at[has_before]]
            )
            has_after = np.flatnonzero(at < ids.shape[1] - 1)
            ranks[has_after, at[has_after]] = self._rank(
                ids[has_after, at[has_after]], ids[has_after, at[has_after] + 1]
            )
        return done, (done >= 0).sum(axis=1)
