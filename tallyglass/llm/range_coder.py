"""Adaptive range coding of token ids in independent, checksummed blocks.

A block's ids are dealt to lanes of ``STEPS`` consecutive ids each. All lanes
take a step together, each with its own coder, and share one model that starts
empty in every block and learns from a step before the next one:

* order 2 and order 1: the id that last followed the two ids, or the one id,
  before this place, each with a confidence from 0 to 7;
* mixing: how often either prediction held at such a pair of confidences gives
  the probabilities of "order 2 is right", "order 1 is right" and "neither";
* order 0: how often each id occurred, for the ids that neither predicted; ids
  that have not occurred yet share one interval and are coded evenly after it.

Both tables of counts are turned into coding intervals after steps 1, 2, 4, and so
on, and then every ``REBUILD`` steps, in encoder and decoder alike. The coder is the
carry-less one with 64-bit state and 16-bit output. Arithmetic is on whole lanes
in numpy, so it is the same everywhere.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TGT2"
STEPS = 256
REBUILD = 32
PAIR_SLOTS = 1 << 17
MIX_BITS = 15
LEAST_COUNT_BITS = 18
TOP = np.uint64(1 << 48)
BOTTOM = np.uint64(1 << 32)
LOW_MASK = np.uint64((1 << 32) - 1)
WORD = np.uint64(16)
WORD_BELOW_TOP = np.uint64(48)
HEADER = struct.Struct("<4sIIII")  # magic, ids, size of the vocabulary, lanes, crc32 of the ids


class _Model:
    """What encoder and decoder know before a step."""

    def __init__(self, lanes: int, vocabulary: int):
        # Predicted id and its confidence in one number.
        self.after_pair = np.zeros(PAIR_SLOTS, dtype=np.uint32)
        self.after_one = np.zeros(vocabulary + 1, dtype=np.uint32)
        self.before_last = np.full(lanes, vocabulary, dtype=np.uint32)
        self.last = np.full(lanes, vocabulary, dtype=np.uint32)
        self.mix = np.tile(np.array([1.0, 1.0, 2.0]), (128, 1))
        # The last place counts ids that occurred for the first time.
        self.counts = np.zeros(vocabulary + 1, dtype=np.int64)
        self.counts[-1] = 1
        self.count_bits = np.uint64(max(LEAST_COUNT_BITS, vocabulary.bit_length() + 2))
        self._ids: list[np.ndarray] = []
        self._outcomes: list[np.ndarray] = []
        self._rebuild()

    def _rebuild(self) -> None:
        if self._ids:
            n = len(self.counts)
            occurred = np.bincount(np.concatenate(self._ids), minlength=n)
            occurred[-1] = np.count_nonzero((self.counts == 0) & (occurred > 0))
            self.counts += occurred
            seen = np.bincount(np.concatenate(self._outcomes), minlength=self.mix.size)
            self.mix += seen.reshape(self.mix.shape)
            self._ids, self._outcomes = [], []
        known = np.nonzero(self.counts)[0]
        total, counted = 1 << int(self.count_bits), self.counts[known]
        shares = 1 + counted * (total - len(known)) // counted.sum()
        shares[-1] += total - shares.sum()
        self.id_sizes = np.zeros(len(self.counts), dtype=np.uint64)
        self.id_starts = np.zeros(len(self.counts), dtype=np.uint64)
        self.id_sizes[known], self.id_starts[known] = shares, np.cumsum(shares) - shares
        self.known, self.shares, self._id_at = known, shares, None
        whole = (1 << MIX_BITS) - 3
        sizes = 1 + np.floor(self.mix / self.mix.sum(axis=1, keepdims=True) * whole).astype(np.int64)
        sizes[:, 2] += (1 << MIX_BITS) - sizes.sum(axis=1)
        self.mix_sizes = sizes.astype(np.uint64).ravel()
        self.mix_starts = (np.cumsum(sizes, axis=1) - sizes).astype(np.uint64).ravel()

    def id_at(self) -> np.ndarray:
        """The id, or the mark of a new one, at every place of the interval."""
        if self._id_at is None:
            self._id_at = np.repeat(self.known, self.shares)
        return self._id_at

    def predict(self, lanes: int) -> None:
        """Look both predictions up for the first ``lanes`` lanes."""
        last = self.last[:lanes]
        mixed = self.before_last[:lanes] * np.uint32(0x9E3779B1) ^ last * np.uint32(0x85EBCA6B)
        self.slot = ((mixed >> np.uint32(15)) & np.uint32(PAIR_SLOTS - 1)).astype(np.int64)
        self.pair, self.one = self.after_pair[self.slot], self.after_one[last]
        self.by_pair, self.by_one = self.pair >> 3, self.one >> 3
        situation = ((self.pair & 7) << 3 | (self.one & 7)) << 1 | (self.by_pair == self.by_one)
        self.row = situation.astype(np.int64) * 3

    def learn(self, ids: np.ndarray, outcome: np.ndarray, step: int) -> None:
        lanes = len(ids)
        last = self.last[:lanes].astype(np.int64)
        self.after_pair[self.slot] = _revised(self.pair, self.by_pair, ids)
        self.after_one[last] = _revised(self.one, self.by_one, ids)
        self.before_last[:lanes] = last
        self.last[:lanes] = ids
        self._ids.append(ids)
        self._outcomes.append(self.row + outcome)
        done = step + 1
        if done % REBUILD == 0 or done < REBUILD and done & (done - 1) == 0:
            self._rebuild()


def _revised(entry: np.ndarray, predicted: np.ndarray, ids: np.ndarray) -> np.ndarray:
    confidence = entry & 7
    held = entry + (confidence < 7)
    missed = np.where(confidence > 0, entry - 1, ids << 3 | 1)
    return np.where(predicted == ids, held, missed).astype(np.uint32)


def _settle(low: np.ndarray, width: np.ndarray, emit) -> None:
    """Move out every word that is decided; ``emit`` gets lanes and words."""
    ready = np.nonzero(((low ^ (low + width)) < TOP) | (width < BOTTOM))[0]
    while len(ready):
        a, w = low[ready], width[ready]
        cut = (a ^ (a + w)) >= TOP  # narrow but astride a boundary: give up what lies beyond it
        w = np.where(cut, (~a + np.uint64(1)) & LOW_MASK, w)
        emit(ready, a >> WORD_BELOW_TOP)
        a, w = a << WORD, w << WORD
        low[ready], width[ready] = a, w
        ready = ready[((a ^ (a + w)) < TOP) | (w < BOTTOM)]


def encode_ids(ids: np.ndarray, vocabulary: int) -> bytes:
    """One block. ``vocabulary`` is above every id."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    n = len(ids)
    lanes = -(-n // STEPS)
    head = HEADER.pack(MAGIC, n, vocabulary, lanes, zlib.crc32(ids.tobytes()))
    model = _Model(lanes, vocabulary)
    table = np.zeros(lanes * STEPS, dtype=np.uint32)
    table[:n] = ids
    table = np.ascontiguousarray(table.reshape(lanes, STEPS).T)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
    lane_kind = np.uint16 if lanes <= 1 << 16 else np.uint32
    out_lanes: list[np.ndarray] = []
    out_words: list[np.ndarray] = []

    def emit(which: np.ndarray, words: np.ndarray) -> None:
        out_lanes.append(which.astype(lane_kind))
        out_words.append(words.astype(np.uint16))

    for step in range(min(STEPS, n)):
        active = lanes if (lanes - 1) * STEPS + step < n else lanes - 1
        now = table[step, :active]
        a, w = low[:active], width[:active]
        model.predict(active)
        outcome = np.where(model.by_pair == now, 0, np.where(model.by_one == now, 1, 2))
        interval = model.row + outcome
        unit = w >> np.uint64(MIX_BITS)
        a += unit * model.mix_starts[interval]
        w[:] = unit * model.mix_sizes[interval]
        _settle(a, w, emit)
        rest = np.nonzero(outcome == 2)[0]
        if len(rest):
            values = now[rest].astype(np.int64)
            new = np.nonzero(model.id_sizes[values] == 0)[0]
            marked = values.copy()
            marked[new] = vocabulary
            b, v = a[rest], w[rest] >> model.count_bits
            b += v * model.id_starts[marked]
            v *= model.id_sizes[marked]
            _settle(b, v, lambda which, words: emit(rest[which], words))
            if len(new):
                c, u = b[new], v[new] // np.uint64(vocabulary)
                c += u * values[new].astype(np.uint64)
                _settle(c, u, lambda which, words: emit(rest[new[which]], words))
                b[new], v[new] = c, u
            a[rest], w[rest] = b, v
        model.learn(now, outcome, step)
    for shift in (48, 32, 16, 0):
        emit(np.arange(lanes), low >> np.uint64(shift))
    if not n:
        return head + struct.pack("<I", zlib.crc32(head))
    order = np.argsort(np.concatenate(out_lanes), kind="stable")
    sizes = np.bincount(np.concatenate(out_lanes), minlength=lanes).astype("<u2")
    body = head + sizes.tobytes() + np.concatenate(out_words)[order].astype("<u2").tobytes()
    return body + struct.pack("<I", zlib.crc32(body))


def decode_ids(block: bytes) -> np.ndarray:
    """The ids of one block; fails if the block was damaged."""
    body, (check,) = block[:-4], struct.unpack("<I", block[-4:])
    magic, n, vocabulary, lanes, id_check = HEADER.unpack_from(body)
    if magic != MAGIC or zlib.crc32(body) != check:
        raise ValueError("damaged block")
    if not n:
        return np.zeros(0, "<u4")
    sizes = np.frombuffer(body, "<u2", lanes, HEADER.size).astype(np.int64)
    words = np.frombuffer(body, "<u2", -1, HEADER.size + 2 * lanes).astype(np.uint64)
    words = np.concatenate([words, np.zeros(1, np.uint64)])
    at = np.cumsum(sizes) - sizes
    model = _Model(lanes, vocabulary)
    table = np.zeros((STEPS, lanes), dtype=np.uint32)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
    code = np.zeros(lanes, np.uint64)

    def take(which: np.ndarray, _words: np.ndarray) -> None:
        code[which] = code[which] << WORD | words[at[which]]
        at[which] += 1

    for _ in range(4):
        take(np.arange(lanes), None)
    for step in range(min(STEPS, n)):
        active = lanes if (lanes - 1) * STEPS + step < n else lanes - 1
        a, w = low[:active], width[:active]
        model.predict(active)
        unit = w >> np.uint64(MIX_BITS)
        inside = code[:active] - a
        first = inside >= unit * model.mix_starts[model.row + 1]
        second = inside >= unit * model.mix_starts[model.row + 2]
        outcome = first.astype(np.int64) + second
        interval = model.row + outcome
        a += unit * model.mix_starts[interval]
        w[:] = unit * model.mix_sizes[interval]
        _settle(a, w, take)
        now = np.where(outcome == 0, model.by_pair, model.by_one).astype(np.uint32)
        rest = np.nonzero(outcome == 2)[0]
        if len(rest):
            b, v = a[rest], w[rest] >> model.count_bits
            values = model.id_at()[((code[rest] - b) // v).astype(np.int64)]
            b += v * model.id_starts[values]
            v *= model.id_sizes[values]
            _settle(b, v, lambda which, words_: take(rest[which], words_))
            new = np.nonzero(values == vocabulary)[0]
            if len(new):
                c, u = b[new], v[new] // np.uint64(vocabulary)
                values[new] = (code[rest[new]] - c) // u
                c += u * values[new].astype(np.uint64)
                _settle(c, u, lambda which, words_: take(rest[new[which]], words_))
                b[new], v[new] = c, u
            a[rest], w[rest] = b, v
            now[rest] = values
        table[step, :active] = now
        model.learn(now, outcome, step)
    ids = np.ascontiguousarray(table.T).ravel()[:n].astype("<u4")
    if zlib.crc32(ids.tobytes()) != id_check:
        raise ValueError("block does not give back its ids")
    return ids
