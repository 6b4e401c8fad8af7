"""Runs of windows that share an anchor, with hashes by doubling; all places depend on content alone."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SEGMENT = 1 << 19
#: Bytes or words hashed at a time: arrays of so many numbers stay in the processor's cache and are not mapped anew.
GROUP = 1 << 16
BLOCK = 16
_PLACE = np.uint64((1 << 22) - 1)
_BYTES = np.random.Generator(np.random.PCG64(5)).integers(0, 1 << 64, 256, dtype=np.uint64)
_FACTOR = np.random.Generator(np.random.PCG64(6)).integers(0, 1 << 63, 40, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Ranks:
    """Hashes of the strings of growing length that start at each place, by doubling.

    The hash of ``2 n`` bytes comes from the pair of hashes of ``n`` bytes at a place and
    ``n`` behind it, as ranks do in prefix doubling; a length between is put together from
    its powers of two. Entries whose string leaves the data mean nothing.
    """

    def __init__(self, data: np.ndarray):
        """``data``: bytes, or 64-bit hashes that stand for words."""
        self.levels = [data if data.dtype == np.uint64 else _BYTES[data]]

    @staticmethod
    def _paired(x: np.ndarray, y: np.ndarray, bit: int, behind: int) -> np.ndarray:
        out = x * _FACTOR[bit]
        if behind < len(out):
            z = y[behind:]
            out[:-behind] += z ^ (z >> np.uint64(31))
        return out

    def of(self, length: int) -> np.ndarray:
        while len(self.levels) < length.bit_length():
            top = self.levels[-1]
            self.levels.append(self._paired(top, top, len(self.levels), 1 << (len(self.levels) - 1)))
        out, at = None, 0
        for bit in range(length.bit_length() - 1, -1, -1):
            if length >> bit & 1:
                out = self.levels[bit] if out is None else self._paired(out, self.levels[bit], 20 + bit, at)
                at += 1 << bit
        return out


def spread(x: np.ndarray) -> np.ndarray:
    """Scrambled hashes, so that their order has nothing to do with the text's."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of ``x[i:i + width]`` for each i, by doubling; the last entries cover what there is."""
    n = 1
    while n < width:
        step = min(n, width - n)
        if step < len(x):
            x = np.concatenate((np.minimum(x[:-step], x[step:]), x[-step:]))
        n += step
    return x


def _pieces(bodies: list, length: int) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Slabs of ``(row, first window, windows, bytes or hashes)``; a long text is cut so that each window is in one piece."""
    held, size = [], 0
    for row, body in enumerate(bodies):
        windows = len(body) - length + 1
        for a in range(0, max(windows, 0), SEGMENT):
            b = min(windows, a + SEGMENT)
            held.append((row, a, b - a, body[a:b + length - 1]))
            size += len(held[-1][3])
            if size >= GROUP:
                yield held
                held, size = [], 0
    if held:
        yield held


def runs(bodies: list, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``(row, start, n, back, fp, whole)`` arrays of the runs of windows in the texts, given as bytes or as arrays of word hashes.

    A window's anchor is its string of half the length whose hash is least, the first
    of equals; a run is the ``n`` windows from ``start`` on that share one, ``back`` bytes
    before it. ``fp`` is the anchor's hash, and ``whole`` that of all bytes of the run
    and of its place at the anchor. Every window is in exactly one run.
    """
    half = length // 2
    for held in _pieces(bodies, length):
        words = isinstance(held[0][3], np.ndarray)
        data = np.concatenate([p[3] for p in held]) if words else np.frombuffer(b"".join(p[3] for p in held), np.uint8)
        begin = np.cumsum([0] + [len(p[3]) for p in held])[:-1]
        count = np.array([p[2] for p in held])
        ranks = Ranks(data)
        short, full = spread(ranks.of(half)), ranks.of(length)
        place = np.arange(len(data), dtype=np.uint64)
        least = _sliding_least((short & ~_PLACE) | place, length - half + 1)
        at = np.repeat(begin - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        anchor = (least[at] & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        n = np.diff(np.append(first, len(at)))
        start, anchor = at[first], anchor[first]
        back = anchor - start
        whole = spread(spread(full[start]) * np.uint64(3) + spread(full[start + n - 1]) + (back * 1024 + n).astype(np.uint64))
        piece = np.searchsorted(begin, start, "right") - 1
        rows, offset = np.array([p[0] for p in held]), np.array([p[1] for p in held])
        yield rows[piece], start - begin[piece] + offset[piece], n, back, short[anchor].view(np.int64), whole.view(np.int64)


def blocks(body: bytes, wanted: list[tuple[int, int, int]], length: int) -> Iterator[tuple]:
    """Blocks of the windows of stated runs ``(start, n, back)``: ``(run, block, high, start, n, core, whole, hashes)``.

    Blocks are counted from the anchor: the windows that start from ``16 b`` to ``16 b + 15`` bytes
    before it, ``high`` the most that occurs. ``core`` is the hash of what all windows of the full block share.
    """
    held: list[tuple[int, int, int, int]] = []
    data, size = [], 0
    for i, (start, n, back) in enumerate(wanted):
        held.append((i, start, n, back))
        data.append(body[start:start + n - 1 + length])
        size += len(data[-1])
        if size >= GROUP or i + 1 == len(wanted):
            ranks = Ranks(np.frombuffer(b"".join(data), np.uint8))
            full, core = ranks.of(length), spread(ranks.of(length - BLOCK + 1))
            ends = spread(full)
            base = 0
            for (run, first, count, far), part in zip(held, data):
                for b in range(far // BLOCK, (far - count + 1) // BLOCK - 1, -1):
                    high, low = min(far, BLOCK * b + BLOCK - 1), max(far - count + 1, BLOCK * b)
                    at = base + far - high
                    last = base + far - low
                    whole = (int(ends[at]) * 3 + int(ends[last]) + high * 1024 + low) & (1 << 63) - 1
                    yield (run, b, high, first + far - high, high - low + 1, int(core[base + far - BLOCK * b].view(np.int64)),
                           whole, full[at:last + 1].view(np.int64))
                base += len(part)
            held, data, size = [], [], 0
