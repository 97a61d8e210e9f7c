"""Adaptive context-mixing range coder for token ids, in independent blocks.

A block lists the ids that occur in it; their places in the list are what is coded.
They are split into lanes, contiguous runs that are coded side by side
(array operations over all lanes, one id of each lane per step). All lanes share
one model, which starts afresh in every block:

- order 2: a table hashed by the last two ids predicts the next one;
- order 1: a table by the last id predicts the next one;
- order 0: adaptive counts of all ids.

The confidences of the two predictions and whether they agree select adaptive
counts of (order 2 right, order 1 right, neither); these mix the three orders:
a right prediction is coded by its flag alone, any other id by the flag and then,
within the flag's range, by the order-0 counts. Both go through a carry-less range
coder with 64-bit registers and 32-bit output words.

The two predictions are updated after every step. The counts are turned into
shares of a fixed whole after every step at first, later whenever they have grown
by a quarter to a half (or after STALE_STEPS steps), so that one table of shares,
and for reading one table from shares to ids, serves several steps.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"CMX2"
HEAD, PART = "<4sIII", "<IIII"
LANES, STEPS = 4096, 256     # long enough for the higher orders to learn from the block
BLOCK_IDS = LANES * STEPS
U = np.uint64
BOT, LOW32, SHIFT = U(1 << 32), U((1 << 32) - 1), U(32)
SLOTS = 1 << 18
FLAG_BITS, ID_BITS = 12, 20  # shares are 2^-32 at least, as a range is 2^32 at least
MOST_IDS = 1 << ID_BITS - 1  # blocks of more different ids are coded as the ids' high and low halves
STALE_STEPS = 64             # most steps with the same shares


class _Model:
    """Counts and predictions shared by a block's lanes. An entry of the tables of
    predictions is 4 * id + confidence; -4 predicts nothing."""

    def __init__(self, vocab: int, lanes: int, reads: bool):
        self.reads, self.whole = reads, 1 << min(ID_BITS, vocab.bit_length() + 6)
        self.counts = np.zeros(vocab, dtype=np.int64)
        self.first, self.second = np.full(vocab, -4, dtype=np.int32), np.full(SLOTS, -4, dtype=np.int32)
        self.flags = np.ones((32, 4), dtype=np.int64)  # the fourth column is not used
        self.last, self.before = np.zeros(lanes, dtype=np.int64), np.zeros(lanes, dtype=np.int64)
        self.steps = self.next = 0
        self._shares()

    def _shares(self) -> None:
        """Sizes and starts of ids and flags in proportion to their counts so far."""
        size = 1 + self.counts * (self.whole - len(self.counts)) // max(int(self.counts.sum()), 1)
        below = np.cumsum(size)
        self.total = U(below[-1])
        self.id_start, self.id_size = (below - size).astype(U), size.astype(U)
        if self.reads:
            self.id_at = np.repeat(np.arange(len(size), dtype=np.uint16 if len(size) <= 1 << 16 else np.uint32), size)
        flags = self.flags[:, :3]
        size = 1 + flags * ((1 << FLAG_BITS) - 3) // flags.sum(axis=1, keepdims=True)
        size[:, 2] = (1 << FLAG_BITS) - size[:, 0] - size[:, 1]
        self.flag_start, self.flag_size = np.zeros((2, 32, 4), dtype=U)
        self.flag_size[:, :3] = size
        self.flag_start[:, 1:] = np.cumsum(size, axis=1)
        self.flag_start, self.flag_size = self.flag_start.ravel(), self.flag_size.ravel()

    def look(self, n: int) -> None:
        """Predictions for the next id of the first ``n`` lanes."""
        last = self.last[:n]
        self.slot = (self.before[:n] * 48271 + last) & (SLOTS - 1)
        self.e2, self.e1 = self.second[self.slot], self.first[last]
        self.p2, self.p1, self.c2, self.c1 = self.e2 >> 2, self.e1 >> 2, self.e2 & 3, self.e1 & 3
        agree = (self.p1 == self.p2).astype(np.int32)
        self.ctx = ((((self.c2 << 2) + self.c1 << 1) + agree) << 2).astype(np.int64)

    def update(self, ids: np.ndarray, codes: np.ndarray, flag_at: np.ndarray) -> None:
        """``codes``: the ids as 32-bit numbers."""
        n = len(ids)
        self.flags += np.bincount(flag_at, minlength=self.flags.size).reshape(self.flags.shape)
        entry = (codes << 2) + np.int32(1)
        for table, at, e, seen, c in ((self.second, self.slot, self.e2, self.p2, self.c2),
                                      (self.first, self.last[:n], self.e1, self.p1, self.c1)):
            table[at] = np.where(seen == codes, e + (c < 3).astype(np.int32), np.where(c > 1, e - np.int32(1), entry))
        self.before[:n] = self.last[:n]
        self.last[:n] = ids
        self.steps += 1

    def learn(self, rows: np.ndarray) -> bool:
        """Take in the ids of the rows since it last did (0 for lanes that have ended),
        if it is time."""
        if self.steps < self.next:
            return False
        self.next = self.steps + min(max(1, (1 << self.steps.bit_length()) >> 2), STALE_STEPS)
        self.counts += np.bincount(rows.reshape(-1), minlength=len(self.counts))
        self._shares()
        return True


def _shape(n: int) -> tuple[int, int, np.ndarray]:
    """(lanes, steps, active lanes at each step); lane j holds ids j*steps and on."""
    lanes = min(LANES, -(-n // STEPS)) or 1
    steps = -(-n // lanes)
    sizes = np.clip(n - np.arange(lanes) * steps, 0, steps)
    active = np.count_nonzero(sizes[None, :] > np.arange(steps)[:, None], axis=1) if lanes * steps < 1 << 22 else \
        np.array([np.count_nonzero(sizes > t) for t in range(steps)], dtype=np.int64)
    return lanes, steps, active


def _shifted(low: np.ndarray, rng: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Registers of ranges below 2^32 without their top word; a range within which
    that word changes is cut short."""
    loose = (low ^ (low + rng)) >= BOT
    if loose.any():
        rng = np.where(loose, (U(0) - low) & LOW32, rng)
    return low << SHIFT, rng << SHIFT


class _Encoder:
    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, dtype=U), np.full(lanes, (1 << 64) - 1, dtype=U)
        self.lanes: list[np.ndarray] = []
        self.words: list[np.ndarray] = []

    def _out(self, lanes: np.ndarray, words: np.ndarray) -> None:
        self.lanes.append(lanes.astype(np.uint16))
        self.words.append(words.astype(np.uint32))

    def put(self, model: _Model, ids: np.ndarray, flag_at: np.ndarray, rest: np.ndarray) -> None:
        """``rest``: the lanes that neither prediction fits."""
        n = len(ids)
        unit = self.range[:n] >> U(FLAG_BITS)
        low, rng = self.low[:n] + model.flag_start[flag_at] * unit, model.flag_size[flag_at] * unit
        if len(rest):
            unit, x = rng[rest] // model.total, ids[rest]
            low[rest] += model.id_start[x] * unit
            rng[rest] = model.id_size[x] * unit
        who = (rng < BOT).nonzero()[0]
        if len(who):
            top = low[who]
            self._out(who, top >> SHIFT)
            low[who], rng[who] = _shifted(top, rng[who])
        self.low[:n], self.range[:n] = low, rng

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        # a word and zeros name a value within [low, low + range), as range is 2^32 at least
        lanes = np.arange(len(self.low))
        self._out(lanes, (self.low + LOW32) >> SHIFT)
        who = np.concatenate(self.lanes)
        return np.bincount(who, minlength=len(lanes)), np.concatenate(self.words)[np.argsort(who, kind="stable")]


class _Decoder:
    """``off`` is the value read so far, less ``low``."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        lanes = len(sizes)
        self.low, self.range = np.zeros(lanes, dtype=U), np.full(lanes, (1 << 64) - 1, dtype=U)
        ends = np.cumsum(sizes)
        self.words = np.insert(words.astype(U), ends, U(0))  # a zero after each lane
        self.at = ends - sizes + np.arange(lanes)
        self.off = (self.words[self.at] << SHIFT) | self.words[self.at + 1]
        self.at += 2

    def take(self, model: _Model, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, places of their flags) of the next step's first ``n`` lanes."""
        off, unit = self.off[:n], self.range[:n] >> U(FLAG_BITS)
        past0 = off >= model.flag_start[model.ctx + 1] * unit
        past1 = off >= model.flag_start[model.ctx + 2] * unit
        flag_at = model.ctx + (past0.view(np.int8) + past1.view(np.int8))
        begin = model.flag_start[flag_at] * unit
        low, rng, off = self.low[:n] + begin, model.flag_size[flag_at] * unit, off - begin
        ids, rest = np.where(past0, model.p1, model.p2).astype(np.int64), past1.nonzero()[0]
        if len(rest):
            unit, there = rng[rest] // model.total, off[rest]
            x = model.id_at[there // unit].astype(np.int64)
            begin = model.id_start[x] * unit
            ids[rest] = x
            low[rest] += begin
            off[rest] = there - begin
            rng[rest] = model.id_size[x] * unit
        who = (rng < BOT).nonzero()[0]
        if len(who):
            low[who], rng[who] = _shifted(low[who], rng[who])
            at = self.at[who]
            off[who] = (off[who] << SHIFT) | self.words[at]
            self.at[who] = at + 1
        self.low[:n], self.range[:n], self.off[:n] = low, rng, off
        return ids, flag_at


def encode_ids(ids: np.ndarray, vocab: int) -> tuple[np.ndarray, np.ndarray]:
    """(words per lane, words) of one block's ids, which are below ``vocab``."""
    n = len(ids)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint32)
    lanes, steps, active = _shape(n)
    grid = np.zeros(lanes * steps, dtype=np.int32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model, coder, known = _Model(vocab, lanes, reads=False), _Encoder(lanes), 0
    for t in range(steps):
        codes = grid[t, :active[t]]
        x = codes.astype(np.int64)
        model.look(len(x))
        by2 = codes == model.p2
        known_id = by2 | (codes == model.p1)
        flag_at = model.ctx + (np.int8(2) - known_id.view(np.int8) - by2.view(np.int8))
        coder.put(model, x, flag_at, (~known_id).nonzero()[0])
        model.update(x, codes, flag_at)
        if model.learn(grid[known:t + 1]):
            known = t + 1
    return coder.finish()


def decode_ids(n: int, vocab: int, sizes: np.ndarray, words: np.ndarray) -> np.ndarray:
    if not n:
        return np.zeros(0, dtype=np.int32)
    lanes, steps, active = _shape(n)
    grid = np.zeros((steps, lanes), dtype=np.int32)
    model, coder, known = _Model(vocab, lanes, reads=True), _Decoder(sizes, words), 0
    for t in range(steps):
        a = active[t]
        model.look(a)
        x, flag_at = coder.take(model, a)
        grid[t, :a] = x
        model.update(x, grid[t, :a], flag_at)
        if model.learn(grid[known:t + 1]):
            known = t + 1
    return np.ascontiguousarray(grid.T).reshape(-1)[:n]


def _listed(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the different ids, rising, the place in them of each id)."""
    if not len(ids) or int(ids.max()) >= 1 << 24:
        return np.unique(ids, return_inverse=True)
    seen = np.flatnonzero(np.bincount(ids))
    place = np.zeros(int(ids.max()) + 1, dtype=np.int32)
    place[seen] = np.arange(len(seen))
    return seen, place[ids]


def pack_block(doc_ids: list, sizes: list[int], ids: np.ndarray) -> bytes:
    """One block: header, document table, listed ids, lane table and words, crc32 of it all."""
    n = len(ids)
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    table = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    listed = [_listed(ids)]
    if len(listed[0][0]) > MOST_IDS:
        listed = [_listed(ids >> 16), _listed(ids & 0xFFFF)]
    body = [struct.pack(HEAD, MAGIC, n, len(doc_ids), len(listed)),
            known.tobytes(), table.tobytes(), np.array(sizes, dtype="<u4").tobytes()]
    for seen, places in listed:
        lane_sizes, words = encode_ids(places, len(seen))
        steps = zlib.compress(np.diff(seen, prepend=0).astype("<u4").tobytes(), 1)
        body += [struct.pack(PART, len(seen), len(steps), len(lane_sizes), len(words)), steps,
                 lane_sizes.astype("<u4" if n > BLOCK_IDS else "<u2").tobytes(), words.astype("<u4").tobytes()]
    packed = b"".join(body)
    return packed + struct.pack("<I", zlib.crc32(packed))


def unpack_block(block: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(document ids, ids per document, ids); raises on any damage."""
    body, (crc,) = block[:-4], struct.unpack("<I", block[-4:])
    if len(block) < struct.calcsize(HEAD) + 4 or zlib.crc32(body) != crc:
        raise ValueError("damaged block: checksum differs")
    magic, n, docs, parts = struct.unpack_from(HEAD, body)
    if magic != MAGIC:
        raise ValueError("not a block of this format")
    at = struct.calcsize(HEAD)

    def part(kind: str, count: int) -> np.ndarray:
        nonlocal at
        got = np.frombuffer(body, dtype=kind, count=count, offset=at)
        at += got.nbytes
        return got

    known, table, sizes = part("u1", docs), part("<i8", docs), part("<u4", docs)
    ids = np.zeros(n, dtype="<u4")
    for _ in range(parts):
        vocab, listed, lanes, n_words = struct.unpack_from(PART, body, at)
        at += struct.calcsize(PART)
        seen = np.cumsum(np.frombuffer(zlib.decompress(part("u1", listed)), dtype="<u4"), dtype=np.int64).astype("<u4")
        lane_sizes = part("<u4" if n > BLOCK_IDS else "<u2", lanes).astype(np.int64)
        places = decode_ids(n, vocab, lane_sizes, part("<u4", n_words))
        ids = ids << 16 | seen[places]
    return [int(d) if k else None for d, k in zip(table, known)], sizes, ids
