"""A context-mixing range coder for token ids, in numpy.

A block of ids is dealt to lanes, each a run of consecutive ids with a range
coder of its own. All lanes of a block take one step at a time and share one
adaptive model, so a step is a handful of array operations; decoding repeats
the same steps. The model starts anew with each block.

The model predicts an id by three orders: the id last seen after the two ids
before (order 2, hashed), the id last seen after the id before (order 1), each
with a confidence that grows with hits, and the frequencies of ids (order 0).
They are mixed by weights for each pair of confidences, learned from which
order was right there. An id is coded as the order that gives it, and, if that
is order 0, the id by its frequency; both drive the arithmetic coder.

A block: ids (u32), lanes (u32), crc32 of the rest (u32), words of each lane
(u32 each), then the lanes' 32-bit words. All integers are little-endian.
"""

from __future__ import annotations

import zlib

import numpy as np

#: Ids of a lane, lanes of a block, at most.
STEPS, LANES = 512, 4096
BLOCK = STEPS * LANES

_MIX_BITS, _FREQUENCY_BITS = 12, 18
_MIX, _TOTAL = 1 << _MIX_BITS, 1 << _FREQUENCY_BITS
_HASH_BITS = 18
_U = np.uint64
_LOW32 = _U(0xFFFFFFFF)


class _Model:
    """The state that coder and decoder keep alike.

    What a context predicts is held as id * 16 + confidence. A hit raises the
    confidence, a miss lowers it, and a miss without confidence takes the new id.
    A state is a pair of confidences and whether both orders predict the same
    id; its outcomes are 0 (order 0 gave the id), 1 (order 1), 2 and 3 (order 2,
    without and with order 1).
    """

    _MOVE = np.array([0] + [-1] * 15 + [1] * 15 + [0], np.int32)  # by hit * 16 + confidence

    def __init__(self, symbols: int):
        if symbols > _TOTAL // 2:
            raise ValueError(f"ids must be below {_TOTAL // 2}")
        self.symbols = symbols
        self.after_one = np.zeros(symbols, np.int32)
        self.after_two = np.zeros(1 << _HASH_BITS, np.int32)
        self.outcomes = np.tile(np.array([1.0, 0.2, 0.1, 0.1]), (512, 1))
        self.seen = np.zeros(symbols, np.int64)
        self.new: list[np.ndarray] = []
        self.step, self.next = 0, 1
        self._frequencies()
        self._weights()

    def _frequencies(self) -> None:
        """Begin and size of each id in the frequency interval; one more entry
        is the whole interval, for what order 1 or 2 gives."""
        total = int(self.seen.sum())
        spare = _TOTAL - self.symbols
        f = self.seen * spare // total + 1 if total else np.full(self.symbols, _TOTAL // self.symbols)
        f[int(f.argmax())] += _TOTAL - int(f.sum())
        self.frequency = np.append(f, _TOTAL).astype(np.uint64)
        self.start = np.append(np.cumsum(f) - f, 0).astype(np.uint64)
        self.symbol_at = np.repeat(np.arange(self.symbols, dtype=np.int32), f)

    def _weights(self) -> None:
        """The orders' places in the mixing interval: order 2, order 1, order 0."""
        right = self.outcomes / self.outcomes.sum(axis=1, keepdims=True)
        two = np.clip(((right[:, 2] + right[:, 3]) * _MIX).astype(np.int64), 1, _MIX - 2)
        one = np.clip(two + (right[:, 1] * _MIX).astype(np.int64), two + 1, _MIX - 1)
        zero = np.zeros_like(two)
        # By state * 4 + outcome.
        self.begin = np.stack([one, two, zero, zero], axis=1).ravel().astype(np.uint64)
        self.size = np.stack([_MIX - one, one - two, two, two], axis=1).ravel().astype(np.uint64)
        self.two, self.one = two.astype(np.uint64), one.astype(np.uint64)

    def predict(self, last: np.ndarray, before: np.ndarray) -> None:
        self.last = last
        self.slot = (((before * 0x9E3779B1 + last * 0x85EBCA77) >> 7) & ((1 << _HASH_BITS) - 1))
        self.by_two = self.after_two.take(self.slot, mode="clip")
        self.by_one = self.after_one.take(last, mode="clip")
        self.sure_two, self.sure_one = self.by_two & 15, self.by_one & 15
        self.state = self.sure_two * 32 + self.sure_one * 2 + ((self.by_two ^ self.by_one) < 16)

    def _learn(self, held: np.ndarray, sure: np.ndarray, hit: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        case = hit * np.int32(16) + sure
        new = held + self._MOVE.take(case, mode="clip")
        np.copyto(new, fresh, where=case == 0)
        return new

    def hits(self, ids: np.ndarray) -> np.ndarray:
        """Compares the ids with the predictions; state * 4 + outcome."""
        self.fresh = ids << 4
        self.hit_two, self.hit_one = (self.by_two ^ self.fresh) < 16, (self.by_one ^ self.fresh) < 16
        return self.state * 4 + self.hit_two * np.int32(2) + self.hit_one

    def update(self, ids: np.ndarray, outcome: np.ndarray) -> None:
        self.after_two[self.slot] = self._learn(self.by_two, self.sure_two, self.hit_two, self.fresh)
        self.after_one[self.last] = self._learn(self.by_one, self.sure_one, self.hit_one, self.fresh)
        self.outcomes += np.bincount(outcome, minlength=2048).reshape(512, 4)
        self.new.append(ids)
        self.step += 1
        if self.step == self.next:
            self.seen += np.bincount(np.concatenate(self.new), minlength=self.symbols)
            self.new = []
            self._frequencies()
            self._weights()
            self.next += min(self.step, 64)


def _shape(n: int) -> tuple[int, int]:
    lanes = max(1, -(-n // STEPS))
    return lanes, -(-n // lanes)


def _shift_out(low: np.ndarray, width: np.ndarray, small: np.ndarray) -> np.ndarray:
    """Drops the top 32 bits of the lanes ``small``; returns these bits. Where
    an interval crosses a border of them, the part beyond is given up."""
    a, w = low[small], width[small]
    across = np.flatnonzero((a ^ (a + w)) > _LOW32)
    if len(across):
        w[across] = (~a[across] + _U(1)) & _LOW32
    low[small], width[small] = a << _U(32), w << _U(32)
    return a >> _U(32)


def encode(ids: np.ndarray, symbols: int) -> bytes:
    """One block; at most BLOCK ids, each below ``symbols``."""
    ids = np.asarray(ids, np.int32)
    n = len(ids)
    if n > BLOCK or n and (int(ids.min()) < 0 or int(ids.max()) >= symbols):
        raise ValueError("too many ids, or an id out of range")
    lanes, steps = _shape(n)
    grid = np.zeros(lanes * steps, np.int32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model = _Model(symbols)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    out, used = np.zeros((lanes, 2 * steps + 4), np.uint32), np.zeros(lanes, np.int64)
    last, before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    for t in range(steps if n else 0):
        live = -(-(n - t) // steps)  # the first lanes still have ids
        x, a, w = grid[t, :live], low[:live], width[:live]
        model.predict(last[:live], before[:live])
        outcome = model.hits(x)
        given = x.copy()
        np.copyto(given, np.int32(symbols), where=model.hit_two | model.hit_one)
        part = w >> _U(_MIX_BITS)
        a += part * model.begin.take(outcome, mode="clip")
        part = (part * model.size.take(outcome, mode="clip")) >> _U(_FREQUENCY_BITS)
        a += part * model.start.take(given, mode="clip")
        np.multiply(part, model.frequency.take(given, mode="clip"), out=w)
        small = np.flatnonzero(w <= _LOW32)
        while len(small):
            out[small, used[small]] = _shift_out(a, w, small)
            used[small] += 1
            small = small[w[small] <= _LOW32]
        model.update(x, outcome)
        before[:live] = last[:live]
        last[:live] = x
    for shift in (32, 0) if n else ():
        out[np.arange(lanes), used] = (low >> _U(shift) & _LOW32).astype(np.uint32)
        used += 1
    words = out[np.arange(out.shape[1]) < used[:, None]]
    rest = used.astype("<u4").tobytes() + words.astype("<u4").tobytes()
    return np.array([n, lanes, zlib.crc32(rest)], "<u4").tobytes() + rest


def size_of(head: bytes) -> tuple[int, int]:
    """Ids and lanes of a block, from its first 12 bytes."""
    n, lanes, _ = np.frombuffer(head, "<u4", 3).tolist()
    return n, lanes


def decode(block: bytes, symbols: int) -> np.ndarray:
    """The ids of a block; raises if it is damaged."""
    n, lanes, check = np.frombuffer(block, "<u4", 3).tolist()
    if zlib.crc32(block[12:]) != check or lanes != _shape(n)[0]:
        raise ValueError("damaged block")
    steps = _shape(n)[1]
    if not n:
        return np.zeros(0, np.int32)
    used = np.frombuffer(block, "<u4", lanes, 12).astype(np.int64)
    words = np.frombuffer(block, "<u4", -1, 12 + 4 * lanes).astype(np.uint64)
    words = np.append(words, _U(0))
    at = np.cumsum(used) - used
    code = words[at] << _U(32) | words[at + 1]
    at += 2
    model = _Model(symbols)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    grid = np.zeros((steps, lanes), np.int32)
    last, before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    for t in range(steps):
        live = -(-(n - t) // steps)
        model.predict(last[:live], before[:live])
        a, w, c = low[:live], width[:live], code[:live]
        part = w >> _U(_MIX_BITS)
        ahead = c - a
        v = ahead // part
        two, one = v < model.two.take(model.state, mode="clip"), v < model.one.take(model.state, mode="clip")
        outcome = model.state * 4 + two * np.int32(2) + one
        skip = part * model.begin.take(outcome, mode="clip")
        part = (part * model.size.take(outcome, mode="clip")) >> _U(_FREQUENCY_BITS)
        x = model.symbol_at.take(((ahead - skip) // part).view(np.int64), mode="clip")
        given = x.copy()
        np.copyto(given, np.int32(symbols), where=one)  # order 2 or 1
        np.copyto(x, model.by_one >> 4, where=one)
        np.copyto(x, model.by_two >> 4, where=two)
        a += skip
        a += part * model.start.take(given, mode="clip")
        np.multiply(part, model.frequency.take(given, mode="clip"), out=w)
        small = np.flatnonzero(w <= _LOW32)
        while len(small):
            _shift_out(a, w, small)
            c[small] = c[small] << _U(32) | words.take(at[small], mode="clip")
            at[small] += 1
            small = small[w[small] <= _LOW32]
        grid[t, :live] = x
        model.update(x, model.hits(x))
        before[:live] = last[:live]
        last[:live] = x
    return np.ascontiguousarray(grid.T).ravel()[:n]
