"""Keys found in the texts of an Arrow batch by hashes of windows of bytes, all texts of a slice at once.

The hash of any window follows from sums over the bytes before it (a polynomial modulo 2**64). A
window is looked at if its first bytes begin a key, for longer keys twice as many bytes each time;
what has a key's hash is then compared with the key byte by byte, so hits are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: Bytes of texts or keys that are hashed at once; a longer text is alone.
BYTES = 1 << 19


@dataclass(frozen=True)
class Table:
    """Keys in the order of their bytes, one after another, their hashes in order with the key of each, where hashes of some first bits begin, and a filter of their hashes and of those of their first bytes."""

    hashes: np.ndarray
    places: np.ndarray
    starts: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    sizes: list[int]
    stages: list[int]
    filter: np.ndarray

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Which hashes may be among those of the filter, whose places are their first bits."""
        return self.filter[_place(hashes, self.filter)]

    def first_not_below(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the first hashes of the table that are not less; a search from where their first bits begin."""
        low = self.starts[_place(hashes, self.starts)].astype(np.int64)
        left = np.arange(len(low))
        while len(left):
            left = left[low[left] < len(self.hashes)]
            left = left[self.hashes[low[left]] < hashes[left]]
            low[left] += 1
        return low

    def names(self, keys: np.ndarray) -> pa.Array:
        """The keys at some places, as strings."""
        return pa.StringArray.from_buffers(len(self.offsets) - 1, pa.py_buffer(self.offsets), pa.py_buffer(self.data)).take(pa.array(keys))


def _place(hashes: np.ndarray, among: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(65 - len(among).bit_length())


class _Sums:
    """Sums from which the hashes of all windows of some bytes follow."""

    _powers = _inverses = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(_Sums._powers) <= n:
            _Sums._powers, _Sums._inverses = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)])) for x in (_BASE, _INVERSE))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _Sums._powers[:n], out=self.sums[1:])

    def hashes(self, at: np.ndarray, size: int | np.ndarray, salt: int = 0) -> np.ndarray:
        h = (self.sums[at + size] - self.sums[at]) * _Sums._inverses[at]
        h += np.asarray(size).astype(np.uint64) * np.uint64(2) + np.uint64(salt)
        h ^= h >> np.uint64(32)
        h *= _MIX
        return h ^ (h >> np.uint64(29))


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts that are not null, one after another, and where each begins."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(texts: pa.Array, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` bytes, `BYTES` if it is not given."""
    return _ranges(_bytes(texts)[1], most or BYTES)


def _ranges(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    start = 0
    while start < len(offsets) - 1:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        yield start, stop
        start = stop


def _stages(least: int, most: int) -> list[int]:
    """How many first bytes are looked at: those of the shortest key, then twice as many each time."""
    out = [least]
    while out[-1] * 2 <= most:
        out.append(out[-1] * 2)
    return out


def table(keys: pa.Array | pa.ChunkedArray) -> Table:
    """Of distinct keys of less than 2 GB, none of them empty or null. The filter has 8 to 16 places a key, 2**27 at most."""
    keys = (keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys).cast(pa.large_string())
    data, offsets = _bytes(keys.take(pc.array_sort_indices(keys)))
    lengths = np.diff(offsets)
    sizes = np.unique(lengths)
    stages = _stages(int(sizes[0]), int(sizes[-1])) if len(keys) else []
    known = np.zeros(1 << min(27, max(16, (8 * len(keys)).bit_length())), bool)
    hashes = np.empty(len(keys), np.uint64)
    for start, stop in _ranges(offsets, BYTES):
        sums = _Sums(data[offsets[start] : offsets[stop]])
        at = offsets[start:stop] - offsets[start]
        hashes[start:stop] = sums.hashes(at, lengths[start:stop])
        known[_place(hashes[start:stop], known)] = True
        for stage in stages:
            known[_place(sums.hashes(at[lengths[start:stop] >= stage], stage, 1), known)] = True
    order = np.argsort(hashes)
    hashes = hashes[order]
    starts = np.arange(1 << max(1, len(keys).bit_length()))
    starts = np.searchsorted(_place(hashes, starts).astype(np.int64), starts).astype(np.int32)
    return Table(hashes, order.astype(np.int32), starts, np.ascontiguousarray(data), offsets.astype(np.int32), sizes.tolist(), stages, known)


def hits(texts: pa.Array, t: Table) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(row, key, n, first) of each text, by its row, and key of it: how often it occurs and where first, in characters from 0."""
    rows, keys, times, firsts = merged(*met(texts, t))
    return rows, t.names(keys), times, firsts


def met(texts: pa.Array, t: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, place of the key, 1, where in characters) of each time that a key occurs, in no order."""
    data, offsets = _bytes(texts)
    sums = _Sums(data)
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    end = offsets[1:][row] if len(data) else np.zeros(0, np.int64)
    at, stages, found = np.arange(len(data)), list(t.stages), []
    for size in t.sizes:
        while stages and stages[0] <= size:
            at = at[at + stages[0] <= end[at]]
            at = at[t.known(sums.hashes(at, stages.pop(0), 1))]
        near = at[at + size <= end[at]]
        h = sums.hashes(near, size)
        maybe = t.known(h)
        near, h = near[maybe], h[maybe]
        low = t.first_not_below(h)
        while len(low):  # keys of one hash stand side by side
            same = low < len(t.hashes)
            same[same] = t.hashes[low[same]] == h[same]
            near, h, low = near[same], h[same], low[same]
            key = t.places[low]
            fits = t.offsets[key + 1] - t.offsets[key] == size
            fits[fits] = _equal(data, near[fits], t.data, t.offsets[key[fits]], size)
            found.append((near[fits], key[fits]))
            near, h, low = near[~fits], h[~fits], low[~fits] + 1
    near, key = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters
    rows = row[near]
    return rows, key.astype(np.int64), np.ones(len(near), np.int64), before[near] - before[offsets[:-1][rows]]


def merged(rows: np.ndarray, keys: np.ndarray, times: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A row for each row and key, in their order: times are added, of firsts the least is taken."""
    if not len(rows):
        return rows, keys, times, firsts
    code = rows * (int(keys.max()) + 1) + keys
    order = np.argsort(code)
    code = code[order]
    starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    one = order[starts]
    return rows[one], keys[one], np.add.reduceat(times[order], starts), np.minimum.reduceat(firsts[order], starts)


def in_pieces(texts: pa.Array, least: int, search: Callable[[pa.Array], tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What `search` meets in texts that are not null, for keys of at least that many bytes that have no space: it is given each distinct piece between spaces once.

    Like `met` its rows are those of the texts, and a row and key may come several times.
    """
    lists = pc.split_pattern(texts, " ")
    pieces, bounds = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    rows = np.repeat(np.arange(len(texts)), np.diff(bounds))
    starts = np.concatenate([[0], np.cumsum(pc.utf8_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64) + 1)])[:-1]
    starts -= starts[bounds[:-1]][rows]
    long = pc.binary_length(pieces).to_numpy(zero_copy_only=False) >= least
    coded = pieces.filter(pa.array(long)).dictionary_encode()
    found = [search(coded.dictionary.slice(start, stop - start)) + (start,) for start, stop in slices(coded.dictionary)]
    own, keys, times, firsts = (np.concatenate([f[k] + f[4] * (k == 0) for f in found]) if found else np.zeros(0, np.int64) for k in range(4))
    order = np.argsort(own)
    n = np.bincount(own, minlength=len(coded.dictionary))
    at, rows, starts = coded.indices.to_numpy(zero_copy_only=False), rows[long], starts[long]
    some = n[at] > 0 if len(at) else np.zeros(0, bool)
    at, rows, starts = at[some], rows[some], starts[some]
    often = n[at]
    begins = np.cumsum(n) - n
    where = order[np.repeat(begins[at] - (np.cumsum(often) - often), often) + np.arange(often.sum())]
    return np.repeat(rows, often), keys[where], times[where], firsts[where] + np.repeat(starts, often)


def _equal(a: np.ndarray, at: np.ndarray, b: np.ndarray, to: np.ndarray, size: int) -> np.ndarray:
    """Whether size bytes of a at some places are those of b at others, byte by byte."""
    out = np.ones(len(at), bool)
    for k in range(size):
        if not out.all():
            left = np.flatnonzero(out)
            out[left] = a[at[left] + k] == b[to[left] + k]
        else:
            out = a[at + k] == b[to + k]
    return out
