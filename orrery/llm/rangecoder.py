"""Adaptive context-mixing range coder for blocks of ids.

A block starts with its own alphabet and a fresh model. Every id is coded against the mixture of three
predictions: order 0 (adaptive counts of the block), order 1 and order 2 (the id that last followed the previous
one, or two). How much an order-1 or order-2 prediction weighs is learned in the block from how often
predictions of the same standing (fresh, right before, wrong before) came true. The mixture's interval drives a
48-bit range coder with carry.

Blocks know nothing of each other, so a step codes one id of every block of a group at once, as numpy rows.
"""

from __future__ import annotations

import zlib

import numpy as np

ORDER0, TOTAL, WORD = 14, 22, 16  # bits of the order-0 scale, of the mixture's scale, of an output word
LOW, FULL = 1 << 32, 1 << 48  # the range stays between these
CELLS = 10  # bits of the decoder's table into the order-0 scale
CONTEXTS = 12  # bits of an order-2 context
BLOCK = 4096  # ids
ROOM = 128  # words kept free ahead of every block
STANDING = np.array([1, 1, 3, 2, 3, 2, 3, 2], np.int32)  # by standing and hit: 0 none, 1 fresh, 2 right, 3 wrong before
FIRST, EVERY = (16, 32, 64, 128), 256  # steps after which order-0 intervals are renewed


class Model:
    """State of all blocks of a group; row = block. ``sizes``: alphabet size of each."""

    def __init__(self, sizes: np.ndarray):
        n, a = len(sizes), int(sizes.max())
        self.sizes, self.width = sizes.astype(np.int64), a + 1
        self.row = np.arange(n) * self.width
        self.row1, self.row2 = np.arange(n) * a, np.arange(n) << CONTEXTS
        self.counts = (np.arange(a) < sizes[:, None]).astype(np.int32)
        self.count = self.counts.reshape(-1)
        # what last followed a context, times 4, plus the standing of that prediction; -1 and 0 where nothing did
        self.slot1, self.slot2 = np.full(n * a, -4, np.int32), np.full(n << CONTEXTS, -4, np.int32)
        self.trust1, self.trust2 = (np.tile(np.array([0, 24, 64, 8], np.int32), n) for _ in range(2))
        self.cell_row, self.trust_row = np.arange(n) << CELLS, np.arange(n) * 4
        self.before, self.last = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.step = 0
        self.renew()

    def renew(self) -> None:
        room = (1 << ORDER0) - self.sizes
        total = self.counts.sum(axis=1)
        freq = self.counts * room[:, None] // total[:, None] + (self.counts > 0)
        cum = np.zeros((len(self.sizes), self.width), np.int32)
        np.cumsum(freq, axis=1, out=cum[:, 1:])
        cum[np.arange(self.width) >= self.sizes[:, None]] = 1 << ORDER0  # the last symbol takes the remainder
        self.cum = cum.ravel()
        self.cells = None

    def table(self) -> np.ndarray:
        """For each cell of the order-0 scale: the last symbol that starts at or before the cell's start."""
        if self.cells is None:
            n, shift = len(self.sizes), ORDER0 - CELLS
            cell = (self.cum.reshape(n, -1)[:, 1:] + (1 << shift) - 1) >> shift
            at = (np.arange(n)[:, None] * ((1 << CELLS) + 1) + cell).ravel()
            marks = np.bincount(at, minlength=n * ((1 << CELLS) + 1)).reshape(n, -1)[:, : 1 << CELLS]
            self.cells = np.minimum(np.cumsum(marks, axis=1), self.sizes[:, None] - 1).astype(np.int32).ravel()
        return self.cells

    def predict(self, k: int) -> tuple:
        """Predictions of the first k blocks and what they weigh, of 256 in all."""
        last = self.last[:k]
        self.at1 = self.row1[:k] + last
        self.at2 = self.row2[:k] + ((self.before[:k] * 2654435 + last * 40503) >> 3 & ((1 << CONTEXTS) - 1))
        self.e1, self.e2 = self.slot1.take(self.at1), self.slot2.take(self.at2)
        self.t1, self.t2 = self.trust_row[:k] + (self.e1 & 3), self.trust_row[:k] + (self.e2 & 3)
        self.o1, self.o2 = self.trust1.take(self.t1), self.trust2.take(self.t2)
        q2 = self.o2 >> 4
        q1 = (self.o1 >> 4) * (256 - q2) >> 8
        return self.e1 >> 2, self.e2 >> 2, q1.astype(np.int64), q2.astype(np.int64)

    def update(self, k: int, symbol: np.ndarray, hit1: np.ndarray, hit2: np.ndarray) -> None:
        four = (symbol << 2).astype(np.int32)
        for trust, t, old, slot, at, e, hit in ((self.trust1, self.t1, self.o1, self.slot1, self.at1, self.e1, hit1), (self.trust2, self.t2, self.o2, self.slot2, self.at2, self.e2, hit2)):
            trust[t] = old + ((hit * np.int32(3840) - old) >> 5)
            slot[at] = four | STANDING.take((e & 3) * 2 + hit)
        self.count[self.row1[:k] + symbol] += 24
        self.before[:k] = self.last[:k]
        self.last[:k] = symbol
        self.step += 1
        if self.step in FIRST or self.step % EVERY == 0:
            self.renew()


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block of ids as self-contained bytes. Lengths fall by one at most, the longer ones first."""
    longest, alphabets = len(blocks[0]), []
    grid = np.zeros((longest, len(blocks)), np.int32)
    for i, b in enumerate(blocks):
        alphabet, grid[: len(b), i] = np.unique(b, return_inverse=True)
        alphabets.append(alphabet)
    sizes = np.array([len(a) for a in alphabets])
    short = sum(len(b) == longest for b in blocks)
    m = Model(sizes)
    low, span = np.zeros(len(blocks), np.int64), np.full(len(blocks), FULL, np.int64)
    words = np.empty((len(blocks), longest // 2 + 2 * ROOM), np.uint32)
    used = np.zeros(len(blocks), np.int64)
    for step in range(longest):
        k = short if step == longest - 1 else len(blocks)
        if step % (ROOM // 2) == 0 and used.max() + 2 * ROOM > words.shape[1]:  # an id takes two words at most
            words = np.pad(words, ((0, 0), (0, longest // 4 + 2 * ROOM)))
        s = grid[step, :k].astype(np.int64)
        p1, p2, q1, q2 = m.predict(k)
        at = m.row[:k] + s
        c, e = m.cum.take(at), m.cum.take(at + 1)
        q0 = 256 - q1 - q2
        hit1, hit2 = p1 == s, p2 == s
        start = q0 * c + ((q1 * (p1 < s) + q2 * (p2 < s)) << ORDER0)
        width = q0 * (e - c) + ((q1 * hit1 + q2 * hit2) << ORDER0)
        r = span[:k] >> TOTAL
        low[:k] += r * start
        span[:k] = r * width
        i = np.flatnonzero(span < LOW)
        while len(i):
            words[i, used[i]] = low[i] >> 32
            used[i] += 1
            low[i] = (low[i] & (LOW - 1)) << WORD
            span[i] <<= WORD
            i = i[span[i] < LOW]
        m.update(k, s, hit1, hit2)
    every = np.arange(len(blocks))
    for _ in range(3):
        words[every, used] = low >> 32
        used += 1
        low = (low & (LOW - 1)) << WORD
    carry = np.zeros(len(blocks), np.uint32)
    for j in range(int(used.max()) - 1, -1, -1):  # a word may hold a carry into the one before
        live = j < used
        w = np.where(live, words[:, j] + carry, 0)
        words[:, j] = w & 0xFFFF
        carry = w >> 16
    out = []
    for b, a, w, n in zip(blocks, alphabets, words, used, strict=True):
        gaps = np.diff(a.astype(np.int64), prepend=0).astype("<u4").tobytes()
        gaps = zlib.compress(gaps, 1)
        body = w[:n].astype("<u2").tobytes()
        head = np.array([len(b), len(a), len(gaps), len(body), zlib.crc32(b.astype("<u4").tobytes()), zlib.crc32(gaps + body)], "<u4").tobytes()
        out.append(head + gaps + body)
    return out


HEAD = 24


def decode(coded: list[bytes]) -> list[np.ndarray]:
    """The blocks of a group, in the order and with the lengths that ``encode`` got; raises where a checksum fails."""
    alphabets, bodies, heads = [], [], []
    for c in coded:
        n, _, g, w, crc, own = np.frombuffer(c[:HEAD], "<u4").tolist()
        if zlib.crc32(c[HEAD : HEAD + g + w]) != own:
            raise ValueError("a block is damaged")
        alphabets.append(np.cumsum(np.frombuffer(zlib.decompress(c[HEAD : HEAD + g]), "<u4").astype(np.int64)))
        bodies.append(np.frombuffer(c[HEAD + g : HEAD + g + w], "<u2"))
        heads.append((n, crc))
    longest = heads[0][0]
    short = sum(n == longest for n, _ in heads)
    words = np.zeros((len(coded), max(map(len, bodies)) + 2), np.uint16)
    for i, b in enumerate(bodies):
        words[i, : len(b)] = b
    m = Model(np.array([len(a) for a in alphabets]))
    head = words[:, :3].astype(np.int64)
    diff = (head[:, 0] << 32) | (head[:, 1] << 16) | head[:, 2]
    span = np.full(len(coded), FULL, np.int64)
    used = np.full(len(coded), 3)
    grid = np.zeros((longest, len(coded)), np.int32)
    shift = ORDER0 - CELLS
    for step in range(longest):
        k = short if step == longest - 1 else len(coded)
        p1, p2, q1, q2 = m.predict(k)
        q0 = 256 - q1 - q2
        r = span[:k] >> TOTAL
        v = np.minimum(diff[:k] // r, (1 << TOTAL) - 1)
        first = p1 <= p2
        lo, hi = np.where(first, p1, p2), np.where(first, p2, p1)
        ql, qh = np.where(first, q1, q2) << ORDER0, np.where(first, q2, q1) << ORDER0
        row = m.row[:k]
        at_lo, at_hi = row + lo, row + hi
        # the extra weight of the two predictions that lies before v
        past_lo = v >= q0 * m.cum.take(at_lo + 1) + ql + qh * (lo == hi)
        past_hi = v >= q0 * m.cum.take(at_hi + 1) + ql + qh
        in_lo = ~past_lo & (v >= q0 * m.cum.take(at_lo))
        in_hi = ~past_hi & (v >= q0 * m.cum.take(at_hi) + ql) & ~in_lo & past_lo
        u = (v - ql * past_lo - qh * past_hi) // q0
        u = np.clip(u, 0, (1 << ORDER0) - 1)
        s = m.table().take(m.cell_row[:k] + (u >> shift))
        for jump in (8, 4, 2, 1, 1):
            t = np.minimum(s + jump, m.sizes[:k] - 1)
            s = np.where(m.cum.take(row + t) <= u, t, s)
        s = np.where(in_lo, lo, np.where(in_hi, hi, s))
        grid[step, :k] = s
        at = row + s
        c, e = m.cum.take(at), m.cum.take(at + 1)
        hit1, hit2 = p1 == s, p2 == s
        diff[:k] -= r * (q0 * c + ((q1 * (p1 < s) + q2 * (p2 < s)) << ORDER0))
        span[:k] = r * (q0 * (e - c) + ((q1 * hit1 + q2 * hit2) << ORDER0))
        i = np.flatnonzero(span < LOW)
        while len(i):
            diff[i] = (diff[i] << WORD) | words[i, used[i]].astype(np.int64)
            used[i] += 1
            span[i] <<= WORD
            i = i[span[i] < LOW]
        m.update(k, s, hit1, hit2)
    out = []
    for i, (n, crc) in enumerate(heads):
        ids = alphabets[i][grid[:n, i]].astype("<u4")
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError("a block's ids fail their checksum")
        out.append(ids)
    return out


def split(ids: np.ndarray, block: int = BLOCK) -> list[np.ndarray]:
    """Blocks of about ``block`` ids (fewer, down to 1024, where that leaves under 64 of them) whose lengths differ
    by one at most, the longer ones first."""
    block = min(block, max(1024, len(ids) // 64))
    return np.array_split(ids, max(1, -(-len(ids) // block))) if len(ids) else []
