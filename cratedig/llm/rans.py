"""Range asymmetric numeral system over static frequencies, many interleaved states at a time.

A block of BLOCK symbols has LANES states of 64 bits; symbol i belongs to lane
i % LANES. States give and take words of 32 bits of one stream in the order of
their lanes, so that blocks need nothing of each other and numpy steps through
all lanes of all blocks at once.
"""

from __future__ import annotations

import numpy as np

BLOCK, LANES = 1 << 16, 64
#: Bits of the frequencies' sum.
BITS = 20
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


def quantised(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Frequencies that sum to 2**bits, in proportion to the counts and at least 1 where a count is not 0."""
    counts = np.asarray(counts, np.int64)
    some = np.flatnonzero(counts)
    total = 1 << bits
    if len(some) > total:
        raise ValueError("more symbols than frequencies")
    out = np.zeros(len(counts), np.int64)
    if not len(some):
        return out
    share = counts[some].astype(np.float64) * (total - len(some)) / float(counts[some].sum())
    out[some] = 1 + np.floor(share).astype(np.int64)
    # what rounding left goes to the largest remainders
    order = np.argsort(-(share - np.floor(share)), kind="stable")
    rest = total - int(out.sum())
    out[some[order[np.arange(rest) % len(order)]]] += 1
    return out


class Coder:
    """Encodes and decodes symbols of a frequency table."""

    def __init__(self, frequencies: np.ndarray, bits: int = BITS):
        self.bits, self.frequency = bits, np.asarray(frequencies, np.uint64)
        self.start = np.cumsum(self.frequency, dtype=np.uint64) - self.frequency
        self.symbol = np.repeat(np.arange(len(frequencies), dtype=np.uint32), np.asarray(frequencies, np.int64))

    def encode(self, symbols: np.ndarray) -> list[bytes]:
        """One byte string for each BLOCK symbols, the last for what is left."""
        n = len(symbols)
        blocks, steps, bits = -(-n // BLOCK), min(BLOCK, n + LANES - 1) // LANES, np.uint64(self.bits)
        if not n:
            return []
        # behind the last symbol stand ones of frequency 1, which leave a state as it is
        f = np.full(blocks * steps * LANES, 1 << self.bits, np.uint64)
        c = np.zeros(len(f), np.uint64)
        f[:n], c[:n] = self.frequency[symbols], self.start[symbols]
        if not f[:n].all():
            raise ValueError("a symbol has no frequency")
        f, c = f.reshape(blocks, steps, LANES), c.reshape(blocks, steps, LANES)
        x, width = np.full((blocks, LANES), _LOW), steps * LANES
        words, at = np.empty(blocks * width, np.uint32), width * np.arange(1, blocks + 1)
        count, shift = np.arange(blocks * LANES), np.uint64(63 - self.bits)
        for t in range(steps - 1, -1, -1):
            ft = f[:, t]
            full = x >= ft << shift
            flat, out = x.reshape(-1), np.flatnonzero(full)
            if len(out):
                many = np.count_nonzero(full, axis=1)
                at -= many
                given = flat[out]
                words[(at - np.cumsum(many) + many)[out // LANES] + count[: len(out)]] = given.astype(np.uint32)
                flat[out] = given >> _WORD
            whole = x // ft
            x = (whole << bits) + (x - whole * ft) + c[:, t]
        return [x[b].astype("<u8").tobytes() + words[at[b] : width * (b + 1)].astype("<u4").tobytes() for b in range(blocks)]

    def decode(self, blocks: list[bytes], sizes: list[int]) -> np.ndarray:
        """The symbols of blocks of the given sizes, end to end; an error if the states don't end as they began."""
        if not blocks:
            return np.zeros(0, np.uint32)
        head, sizes, bits = 8 * LANES, np.asarray(sizes), np.uint64(self.bits)
        steps, mask = int(sizes.max() + LANES - 1) // LANES, np.uint64((1 << self.bits) - 1)
        x = np.stack([np.frombuffer(b, "<u8", LANES) for b in blocks]).astype(np.uint64)
        words = np.zeros((len(blocks), max(len(b) - head for b in blocks) // 4 + LANES), np.uint64)
        for i, b in enumerate(blocks):
            words[i, : (len(b) - head) // 4] = np.frombuffer(b, "<u4", offset=head)
        width = words.shape[1]
        words, at, out = words.reshape(-1), width * np.arange(len(blocks)), np.empty((len(blocks), steps, LANES), np.uint32)
        lanes, least, count = np.arange(LANES), int(sizes.min()) // LANES, np.arange(x.size)
        for t in range(steps):
            slot = x & mask
            symbol = self.symbol[slot]
            out[:, t] = symbol
            y = self.frequency[symbol] * (x >> bits) + slot - self.start[symbol]
            if t >= least:
                y = np.where(t * LANES + lanes < sizes[:, None], y, x)
            low = y < _LOW
            flat, take = y.reshape(-1), np.flatnonzero(low)
            if len(take):
                many = np.count_nonzero(low, axis=1)
                # a damaged block can ask for more words than there are
                place = np.minimum((at - np.cumsum(many) + many)[take // LANES] + count[: len(take)], words.size - 1)
                flat[take] = flat[take] << _WORD | words[place]
                at += many
            x = y
        if (x != _LOW).any():
            raise ValueError("a block is damaged")
        out = out.reshape(len(blocks), -1)
        return np.concatenate([out[i, :n] for i, n in enumerate(sizes)])
