"""Adaptive context-mixing range coder for token ids.

Ids are cut into blocks of ``BLOCK``; each block starts from fresh models and
carries a CRC-32 of its ids. Per id three predictions are mixed into one
interval of the code range:

* order 2: the id that last followed the two ids before (hashed context),
* order 1: the id that last followed the id before (hashed context),
* order 0: ``GAIN`` x earlier occurrences in the block, brought up to date at
  the places in ``EPOCHS``, and 1 for every id of the alphabet, which those
  without an earlier occurrence use.

Orders 2 and 1 get a share of the range by how often each has been right
lately; the rest is order 0. Blocks do not depend on each other, so all blocks
of a group advance together, one array operation per step for all of them.
The encoder has the ids, so it finds all predictions beforehand, block by
block; the decoder keeps the tables that give it the same ones step by step.

The range stays between 2**32 and 2**48 and the code is put out 16 bits at a
time, so all numbers are whole and below 2**53: doubles hold them, and the floor
of their quotients, exactly, and divide many times faster than 64-bit integers.
"""

from __future__ import annotations

import zlib

import numpy as np

PLACE_BITS = 12
BLOCK = 1 << PLACE_BITS
EPOCHS = (64, 256, 1024)
GAIN = 64
AHEAD = 64  # steps whose intervals the encoder finds at once; divides BLOCK and EPOCHS
SLOT_BITS = 11
SLOTS = 1 << SLOT_BITS  # of each context table
SHARE = 1024  # parts of the range that the three orders divide
_TOP, _LEAST, _WORD = 2.0**48, 2.0**32, 2.0**16
_PLACES = np.arange(BLOCK, dtype=np.uint32)
_FIELD = 20  # bits of an order-0 start and width in a decoder's table


def _contexts(x1: np.ndarray, x2: np.ndarray) -> np.ndarray:
    """Places of the order-1 and order-2 contexts in their tables."""
    out = np.empty((2, *x1.shape), np.uint32)
    np.multiply(x1, np.uint32(0x9E3779B1), out=out[0])
    np.multiply(x2, np.uint32(0x85EBCA6B), out=out[1])
    out[1] += out[0]
    out >>= np.uint32(32 - SLOT_BITS)
    return out


def _shares(hit1: np.ndarray, hit2: np.ndarray):
    """Range shares of order 1 and 2 by their hit rates."""
    a2 = hit2 * np.int32(960)
    a2 >>= 16
    a2 += 1
    a1 = np.int32(960) - a2
    a1 *= hit1
    a1 >>= 16
    a1 += 1
    return a1, a2


def _learn(hit: np.ndarray, right: np.ndarray) -> None:
    step = right.astype(np.int32)
    step *= 65535
    step -= hit
    step >>= 5
    hit += step


def _right(slots: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Where each context's table slot foretells the id of a block: it says the
    id at the last earlier place with this slot, 0 for none."""
    key = slots << np.uint32(PLACE_BITS)
    key |= _PLACES[:len(ids)]
    key.sort()
    place = (key & np.uint32(BLOCK - 1)).astype(np.int64)
    key >>= np.uint32(PLACE_BITS)
    by = ids.take(place)
    right = by == 0
    again = key[1:] == key[:-1]
    right[1:] &= ~again
    right[1:] |= again & (by[1:] == by[:-1])
    out = np.empty(len(ids), bool)
    out[place] = right
    return out


def _foresee(ids: np.ndarray, known: np.ndarray):
    """Of a block: where order 1 and order 2 are right, and the order-0 start
    and width of every id. ``known``: a zero for each id of the alphabet."""
    x1 = np.zeros(len(ids), np.uint32)
    x1[1:] = ids[:-1]
    x2 = np.zeros(len(ids), np.uint32)
    x2[1:] = x1[:-1]
    s1, s2 = _contexts(x1, x2)
    start, width = ids.copy(), np.ones_like(ids)
    for m, end in zip(EPOCHS, (*EPOCHS[1:], BLOCK), strict=True):
        now = ids[m:end]
        if not len(now):
            break
        seen = np.sort(ids[:m])
        first = np.zeros(m, bool)
        first[0] = True
        np.not_equal(seen[1:], seen[:-1], out=first[1:])
        first = np.flatnonzero(first).astype(np.int32)
        seen = seen.take(first)
        times = np.empty_like(first)
        np.subtract(first[1:], first[:-1], out=times[:-1])
        times[-1] = m - first[-1]
        first <<= PLACE_BITS + 1
        first += times
        known[seen] = first
        one = known.take(now)
        known[seen] = 0
        new = one == 0  # after all those seen
        start[m:end] = (one >> PLACE_BITS + 1) * GAIN + new * (now + GAIN * m)
        one &= 2 * BLOCK - 1
        one *= GAIN
        one += new
        width[m:end] = one
    return _right(s1, ids), _right(s2, ids), start, width


class Tables:
    """What the decoder of ``lanes`` blocks keeps."""

    def __init__(self, lanes: int, alphabet: int):
        self.alphabet = alphabet
        self.base = np.arange(2 * lanes, dtype=np.int64).reshape(2, lanes) * SLOTS
        self.last = np.zeros(2 * lanes * SLOTS, np.uint16 if alphabet <= 1 << 16 else np.uint32)
        self.hit = np.full((2, lanes), 4096, np.int32)
        self.x1 = self.x2 = np.zeros(lanes, np.uint32)
        self.m, self.total0 = 0, alphabet

    def keep(self, n: int) -> None:
        """Only the first ``n`` lanes go on."""
        self.base, self.hit = self.base[:, :n].copy(), self.hit[:, :n].copy()
        self.x1, self.x2 = self.x1[:n], self.x2[:n]
        if self.m:
            self.row = self.row[:n]

    def epoch(self, history: np.ndarray) -> None:
        """Order 0 from the ids seen so far, ``history[lane, t]``: per lane and
        place in its sorted ids the id, its start and its width."""
        lanes, m = history.shape
        self.m = m
        self.total0 = self.alphabet + GAIN * m
        seen = np.sort(history.astype(np.int32), axis=1)
        new = np.ones((lanes, m + 1), bool)
        np.not_equal(seen[:, 1:], seen[:, :-1], out=new[:, 1:m])
        at = np.flatnonzero(new[:, :m])
        times = np.diff(at, append=lanes * m)
        one = (seen.ravel()[at].astype(np.int64) << 2 * _FIELD) + (GAIN * (at % m) << _FIELD) + GAIN * times
        self.known = np.repeat(one, times)
        self.row = np.arange(lanes, dtype=np.int64) * m

    def predict(self):
        """Predicted ids (order 1, order 2) and range shares."""
        self.at = _contexts(self.x1, self.x2) + self.base
        return self.last.take(self.at), *_shares(*self.hit)

    def update(self, x: np.ndarray, told: np.ndarray) -> None:
        one = x.astype(self.last.dtype)
        self.last[self.at.ravel()] = np.concatenate([one, one])
        _learn(self.hit, told == x)
        self.x2, self.x1 = self.x1, x

    def of_value(self, u: np.ndarray):
        """Id, order-0 start and width at values ``u``."""
        if not self.m:
            return u, u, 1
        k = u // GAIN
        k += self.row
        one = self.known.take(k, mode="clip")  # another lane's where it is not used
        new = u >= GAIN * self.m
        x = one >> 2 * _FIELD
        np.copyto(x, u - GAIN * self.m, where=new)
        width = one & ((1 << _FIELD) - 1)
        np.copyto(width, 1, where=new)
        one >>= _FIELD
        one &= (1 << _FIELD) - 1
        np.copyto(one, u, where=new)
        return x, one, width


def _blocks(n: int) -> np.ndarray:
    """Lengths of the blocks of ``n`` ids."""
    full, rest = divmod(n, BLOCK)
    return np.array([BLOCK] * full + [rest] * (rest > 0), np.int64)


def encode(ids: np.ndarray, alphabet: int) -> tuple[np.ndarray, np.ndarray, bytes]:
    """32-bit words and CRC-32 of each block, and the blocks' code."""
    sizes = _blocks(len(ids))
    lanes = len(sizes)
    if not lanes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), b""
    right1, right2 = np.zeros((lanes, BLOCK), bool), np.zeros((lanes, BLOCK), bool)
    start0, width0 = np.zeros((lanes, BLOCK), np.int32), np.ones((lanes, BLOCK), np.int32)
    known, at = np.zeros(alphabet, np.int32), 0
    for k, size in enumerate(sizes.tolist()):
        one = _foresee(ids[at:at + size].astype(np.int32), known)
        right1[k, :size], right2[k, :size], start0[k, :size], width0[k, :size] = one
        at += size
    hit, low, rng = np.full((2, lanes), 4096, np.int32), np.zeros(lanes), np.full(lanes, _TOP)
    row = 2 * BLOCK + 8  # 16-bit words, an even number; a step puts out two at most
    out, pos = np.zeros(lanes * row, np.int32), np.arange(lanes) * row
    total0, done = alphabet, []
    for begin in range(0, int(sizes[0]), AHEAD):  # intervals of some steps at once
        if begin in EPOCHS:
            total0 = alphabet + GAIN * begin
        steps = slice(begin, min(begin + AHEAD, int(sizes[0])))
        n = len(low)
        right = np.stack([right1[:n, steps].T, right2[:n, steps].T], axis=1)
        hits = np.empty(right.shape, np.int32)
        for t, good in enumerate(right):
            hits[t] = hit
            _learn(hit, good)
        a1, a2 = _shares(hits[:, 0], hits[:, 1])
        a0, two = (SHARE - a1 - a2).astype(float), a2 * float(total0)
        one, is1, is2 = a1 * float(total0), right[:, 0], right[:, 1]
        starts, widths = a0 * start0[:n, steps].T, a0 * width0[:n, steps].T
        starts += two
        starts += one
        np.copyto(starts, two, where=is1)
        np.copyto(widths, one, where=is1)
        np.copyto(starts, 0, where=is2)
        np.copyto(widths, two, where=is2)
        whole = float(total0 * SHARE)
        for t, (start, width) in enumerate(zip(starts, widths, strict=True), begin):
            if t == sizes[-1] and len(low) == lanes:  # the last block is over
                done = [(low[-1:], pos[-1:])]
                low, rng, pos, hit = low[:-1], rng[:-1], pos[:-1], hit[:, :-1].copy()
            n = len(low)
            part = rng / whole
            np.floor(part, out=part)
            low = low + start[:n] * part
            rng = width[:n] * part
            over = np.flatnonzero(low >= _TOP)
            out[pos[over] - 1] += 1  # carries are settled at the end
            low[over] -= _TOP
            go = rng < _LEAST
            word = np.floor(low * (1 / _LEAST))
            out[pos] = word.astype(np.int32)  # written again where the word is not complete
            word *= _LEAST
            word *= go
            low -= word
            times = go * (_WORD - 1) + 1
            low *= times
            rng *= times
            pos = pos + go
            more = np.flatnonzero(rng < _LEAST)
            if len(more):
                word = np.floor(low[more] * (1 / _LEAST))
                out[pos[more]] = word
                low[more] = (low[more] - word * _LEAST) * _WORD
                rng[more] *= _WORD
                pos[more] += 1
    done.insert(0, (low, pos))
    low, pos = (np.concatenate(x) for x in zip(*done, strict=True))
    for unit in (_LEAST, _WORD, 1.0):
        word = np.floor(low / unit)
        out[pos] = word
        low -= word * unit
        pos += 1
    used = pos - np.arange(lanes) * row
    out[pos[used % 2 > 0]] = 0
    used += used % 2
    rows = out.reshape(lanes, row)[:, :int(used.max())].copy()
    while len(over := np.flatnonzero(rows > 0xFFFF)):
        rows.ravel()[over] &= 0xFFFF
        rows.ravel()[over - 1] += 1
    cuts = np.cumsum(sizes)[:-1]
    crcs = np.array([zlib.crc32(b.astype("<u4").tobytes()) for b in np.split(np.asarray(ids), cuts)], np.int64)
    return used // 2, crcs, b"".join(r[:k].astype("<u2").tobytes() for r, k in zip(rows, used.tolist(), strict=True))


def decode(n: int, alphabet: int, words: np.ndarray, crcs: np.ndarray, code: bytes) -> np.ndarray:
    """The ``n`` ids; raises where a block's checksum does not fit."""
    sizes = _blocks(n)
    lanes = len(sizes)
    if not lanes:
        return np.zeros(0, np.int64)
    raw = np.frombuffer(code, "<u2")
    model, rng, pos = Tables(lanes, alphabet), np.full(lanes, _TOP), 2 * (np.cumsum(words) - words)
    value = np.zeros(lanes)  # of the code above the interval's low end
    for unit in (_LEAST, _WORD, 1.0):
        value += raw[pos] * unit
        pos += 1
    x = np.zeros((BLOCK, lanes), np.uint32)
    with np.errstate(all="ignore"):  # damaged code may lead anywhere, until its checksum is seen
        for t in range(int(sizes[0])):
            if t == sizes[-1]:
                model.keep(lanes - 1)
                rng, value, pos = rng[:lanes - 1], value[:lanes - 1], pos[:lanes - 1]
            m = len(rng)
            if t in EPOCHS:
                model.epoch(np.ascontiguousarray(x[:t, :m].T))
            told, a1, a2 = model.predict()
            total0 = model.total0
            part = rng / float(total0 * SHARE)
            np.floor(part, out=part)
            v = value / part
            np.floor(v, out=v)
            two = a2 * float(total0)
            a1 += a2
            both = a1 * float(total0)
            is2, is1 = v < two, v < both  # is1: order 2 among them
            a0 = SHARE - a1.astype(float)
            v -= both
            v /= a0
            np.minimum(v, total0 - 1, out=v)
            x0, start0, width0 = model.of_value(v.astype(np.int64))
            now = x[t, :m]
            now[:] = x0
            start, width = a0 * start0, a0 * width0
            start += both
            np.copyto(now, told[0], where=is1)
            np.copyto(start, two, where=is1)
            both -= two
            np.copyto(width, both, where=is1)
            np.copyto(now, told[1], where=is2)
            np.copyto(start, 0, where=is2)
            np.copyto(width, two, where=is2)
            start *= part
            value = value - start
            rng = width * part
            go = rng < _LEAST
            times = go * (_WORD - 1) + 1
            rng *= times
            value *= times
            value += raw.take(pos, mode="clip") * go
            pos = pos + go
            more = np.flatnonzero(rng < _LEAST)
            if len(more):
                rng[more] *= _WORD
                value[more] = value[more] * _WORD + raw.take(pos[more], mode="clip")
                pos[more] += 1
            model.update(now, told)
    ids = np.empty((lanes, BLOCK), np.uint32)
    for t in range(0, BLOCK, AHEAD):
        ids[:, t:t + AHEAD] = x[t:t + AHEAD].T
    ids = ids.ravel()[:n]
    for k, block in enumerate(np.split(ids, np.cumsum(sizes)[:-1])):
        if zlib.crc32(block.astype("<u4").tobytes()) != crcs[k]:
            raise ValueError(f"block {k}: checksum does not fit")
    return ids
