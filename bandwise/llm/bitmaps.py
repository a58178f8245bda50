"""Inverted lists as compressed bitmaps of the documents of one block.

A list is a set of places (0 to 65535) with multiplicities. Its first plane holds the places;
plane j > 0 those whose multiplicity less one has binary digit j - 1. A plane is stored as
16-bit places, or as a bitset where that is shorter. Bitsets have an odd number of
bytes, so the length tells which it is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PLACE_BITS = 16


class PairLists:
    """Lists by key: rows (key, place, times), sorted by key, then place, each pair once. A row is held as one number
    of 64 bits, and its multiplicity in as few bytes as the largest needs."""

    def __init__(self, code: np.ndarray, times: np.ndarray):
        self.code = code
        self.times = times.astype(np.min_scalar_type(int(times.max(initial=0))), copy=False)

    @property
    def keys(self) -> np.ndarray:
        return (self.code >> np.uint64(PLACE_BITS)).astype(np.int64)

    @property
    def places(self) -> np.ndarray:
        return (self.code & np.uint64(0xFFFF)).astype(np.int64)

    @classmethod
    def counted(cls, keys: np.ndarray, places: np.ndarray, times: np.ndarray | None = None) -> PairLists:
        """Lists of links, in any order and repeated; keys below 2^48."""
        return cls._summed((keys.astype(np.uint64) << np.uint64(PLACE_BITS)) | places.astype(np.uint64), times)

    @classmethod
    def _summed(cls, code: np.ndarray, times: np.ndarray | None) -> PairLists:
        """Rows in order, the multiplicities of equal ones added up. ``code`` may be sorted in place."""
        if times is None:
            code.sort()
        else:
            order = np.argsort(code, kind="stable")
            code, times = code[order], times[order]
        new = np.concatenate(([True], code[1:] != code[:-1])) if len(code) else np.zeros(0, bool)
        if times is not None and new.all():
            return cls(code, times)
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(code))) if times is None else np.add.reduceat(times, first, dtype=np.int64)
        return cls(code[first], n)

    @classmethod
    def merged(cls, parts: list[PairLists]) -> PairLists:
        """The union (OR) of lists; multiplicities of one place add up. ``parts`` is emptied, so that
        no row is held twice for long."""
        if not parts:
            return cls(np.zeros(0, np.uint64), np.zeros(0, np.uint8))
        code, times = np.concatenate([p.code for p in parts]), np.concatenate([p.times for p in parts])
        parts.clear()
        return cls._summed(code, times)

    def slices(self, rows: int):
        """The lists in stretches of about ``rows`` rows; a key's list is never cut."""
        at = 0
        while at < len(self):
            end = min(at + rows, len(self))
            if end < len(self):
                end = int(np.searchsorted(self.code, self.code[end - 1] | np.uint64(0xFFFF), "right"))
            yield PairLists(self.code[at:end], self.times[at:end])
            at = end

    def __len__(self) -> int:
        return len(self.code)

    def planes(self, n_places: int) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
        """Distinct keys, numbers of places (the popcount of the first plane) and stored planes of each."""
        keys = self.keys
        new = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, bool)
        first, rows = np.flatnonzero(new), np.cumsum(new) - 1
        places, times = self.places, self.times.astype(np.int64)
        row, plane, place = [rows], [np.zeros(len(rows), np.int64)], [places]
        more, j = times - 1, 1
        while (more > 0).any():
            has = (more & 1).astype(bool)
            row.append(rows[has])
            plane.append(np.full(int(has.sum()), j))
            place.append(places[has])
            more, j = more >> 1, j + 1
        row, plane, place = (np.concatenate(x) for x in (row, plane, place))
        # highest plane of each list, so that empty planes below it are stored as empty
        top = np.zeros(len(first), np.int64)
        np.maximum.at(top, row, plane)
        base = np.concatenate(([0], np.cumsum(top + 1)))
        slot = base[row] + plane
        order = np.argsort(slot, kind="stable")  # places stay in order within a plane
        return (keys[first], np.diff(np.append(first, len(self))),
                pa.ListArray.from_arrays(pa.array(base, pa.int32()),
                                         stored(slot[order], place[order], int(base[-1]), n_places)))


def stored(slots: np.ndarray, places: np.ndarray, n_slots: int, n_places: int) -> pa.BinaryArray:
    """One binary value per slot from (slot, place) rows in order."""
    width = -(-n_places // 8)
    width += 1 - width % 2  # odd
    n = np.bincount(slots, minlength=n_slots)
    dense = 2 * n > width
    size = np.where(dense, width, 2 * n)
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if n_slots else 0, np.uint8)
    listed = ~dense[slots]
    within = np.arange(len(slots)) - np.repeat(np.cumsum(n) - n, n)
    at = (ends - size)[slots[listed]] + 2 * within[listed]
    out[at], out[at + 1] = places[listed] & 0xFF, places[listed] >> 8
    slot, place = slots[~listed], places[~listed]
    np.bitwise_or.at(out, (ends - size)[slot] + (place >> 3), (1 << (place & 7)).astype(np.uint8))
    if n_slots and ends[-1] >= 1 << 31:
        raise ValueError("a block's lists must stay below 2 GB")
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), n_slots, [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def opened(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, weight) of stored lists: a multiplicity is the sum of its rows' weights."""
    flat = lists.flatten()
    sizes = np.asarray(pa.compute.list_value_length(lists), np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    plane = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    weight = np.where(plane == 0, 1, np.left_shift(1, np.maximum(plane - 1, 0)))
    length = np.asarray(pa.compute.binary_length(flat), np.int64)
    dense = length % 2 == 1
    short = flat.filter(pa.array(~dense))
    n = length[~dense] // 2
    offset = np.frombuffer(short.buffers()[1], np.int32)[short.offset:short.offset + len(short) + 1] if len(short) else [0, 0]
    data = np.frombuffer(short.buffers()[2], np.uint8)[offset[0]:offset[-1]] if n.sum() else np.zeros(0, np.uint8)
    rows, places, weights = [np.repeat(row[~dense], n)], [data.view("<u2").astype(np.int64)], [np.repeat(weight[~dense], n)]
    for i in np.flatnonzero(dense):
        set_ = np.flatnonzero(np.unpackbits(np.frombuffer(flat[int(i)].as_py(), np.uint8), bitorder="little"))
        rows.append(np.full(len(set_), row[i]))
        places.append(set_)
        weights.append(np.full(len(set_), weight[i]))
    return np.concatenate(rows), np.concatenate(places), np.concatenate(weights)
