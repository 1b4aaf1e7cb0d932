"""Canonical length-limited Huffman codes in numpy: package-merge, packing of many rows at once, lockstep decoding."""

from __future__ import annotations

import numpy as np

#: Longest code in bits; codes for up to 2**LIMIT symbols exist.
LIMIT = 16


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits (package-merge); 0 for symbols that do not occur."""
    used = np.nonzero(counts)[0]
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols don't fit into {limit} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    used = used[np.argsort(counts[used], kind="stable")]
    weights, packages, leaves = counts[used].astype(np.int64), np.zeros(0, np.int64), []
    for _ in range(limit):
        both = np.concatenate([weights, packages])
        order = np.argsort(both, kind="stable")
        leaves.append(order < len(weights))
        both = both[order]
        packages = both[:len(both) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * len(used) - 2
    for is_leaf in reversed(leaves):
        n = int(is_leaf[:take].sum())
        lengths[used[:n]] += 1
        take = 2 * (take - n)
    return lengths


class Code:
    """The canonical code of given lengths: codes by symbol, and tables from `limit` bits to symbol and length."""

    def __init__(self, lengths: np.ndarray, limit: int = LIMIT):
        self.lengths, self.limit = lengths.astype(np.int64), limit
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        span = np.left_shift(1, limit - self.lengths[order])  # table entries of each symbol
        first = np.cumsum(span) - span
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[order] = first >> (limit - self.lengths[order])
        self.symbol = np.zeros(1 << limit, np.uint32)
        self.step = np.ones(1 << limit, np.int64)
        filled = int(span.sum())
        self.symbol[:filled], self.step[:filled] = np.repeat(order, span), np.repeat(self.lengths[order], span)

    def pack(self, ids: np.ndarray, sizes: np.ndarray, every: int) -> tuple[list[bytes], list[np.ndarray]]:
        """Rows of `sizes` symbols, lying in `ids` one after the other: each one's bytes, and the bit offset of each `every`-th symbol."""
        lens = self.lengths[ids]
        if len(ids) and lens.min() == 0:
            raise ValueError("an id without a code")
        first = np.cumsum(sizes) - sizes
        ends = np.concatenate([[0], np.cumsum(lens)])
        begin = ends[first]
        size = (ends[first + sizes] - begin + 7) // 8
        place = np.cumsum(size) - size  # rows begin at whole bytes
        at = ends[:-1] + np.repeat(8 * place - begin, sizes)
        word = at >> 5
        value = self.codes[ids] << (64 - (at & 31) - lens).view(np.uint64)
        out = np.zeros(int(size.sum()) // 4 + 3, np.uint64)
        if len(ids):
            starts = np.nonzero(np.diff(word, prepend=-1))[0]
            own = word[starts]
            out[own] += np.add.reduceat(value >> np.uint64(32), starts)
            out[own + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), starts)
        packed = out.astype(">u4").tobytes()
        rows = zip(first.tolist(), sizes.tolist(), place.tolist(), size.tolist(), strict=True)
        both = [(packed[p:p + z], at[a:a + n:every] - 8 * p) for a, n, p, z in rows]
        return [b for b, _ in both], [m for _, m in both]

    def unpack(self, packed: bytes, marks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The symbols of the segments that begin at the bit offsets `marks` and have `sizes` symbols, all decoded in step."""
        raw = np.frombuffer(packed + bytes(4), np.uint8).astype(np.uint32)
        window = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
        mask, short = (1 << self.limit) - 1, 24 - self.limit
        order = np.argsort(-sizes, kind="stable")
        at, to = marks[order].astype(np.int64), (np.cumsum(sizes) - sizes)[order]
        out = np.zeros(int(sizes.sum()), np.uint32)
        live = np.searchsorted(-sizes[order], -np.arange(int(sizes.max(initial=0))), side="left")
        for k, n in enumerate(live.tolist()):  # the segments with more than k symbols come first
            p = at[:n]
            bits = (window[p >> 3] >> (short - (p & 7))) & mask
            out[to[:n] + k] = self.symbol[bits]
            at[:n] = p + self.step[bits]
        return out
