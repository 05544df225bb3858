"""Token ids in files: a range coder driven by adaptive predictions of the next id.

Ids are coded in blocks that are reset and checksummed on their own, so any block can
be read, checked or lost without the others. Within a block an order-2, an order-1
and an order-0 context each predict the next id. How often such predictions held, one
row of counts per order and per trust in it, is mixed into the probabilities of "the
order-2 prediction", "the order-1 prediction", "the order-0 prediction" and "another
id"; another id follows as its number of bits, under adaptive order-0 probabilities. A
range coder turns these choices into bytes; the bits of an id below its highest, which
are taken as equally likely, stand behind them as they are.

What was learned comes into use after each stretch of :data:`STRETCH` ids, so contexts,
mixtures and updates are made for whole stretches; the blocks of a segment are coded
side by side, and only the step of the range coder is taken id by id.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import content_id, in_slices, stage

MAGIC = b"STID3\n"
#: Ids of a block, of a stretch, and of a segment; a document is never split between
#: segments.
BLOCK, STRETCH = 2048, 64
SEGMENT = 2048 * BLOCK

#: The range stays between 2**32 and 2**56; what is settled leaves in words of 24 bits.
_WORD, _LEAST = np.uint64(24), np.uint64(1 << 32)
_LOWER = _LEAST - np.uint64(1)

_SLOTS2, _SLOTS1 = 1 << 10, 1 << 9
_TRUST = 4  # levels of trust in a prediction
#: Sums of the probabilities of the kinds and of the numbers of bits, as powers of two.
_KIND_BITS, _SIZE_BITS = 12, 10
_BITS, _SCALE = np.uint64(_KIND_BITS + _SIZE_BITS), np.uint64(1 << _SIZE_BITS)
_SIZES = 16
#: Counts are halved beyond this, so that late ids weigh more.
_MOST = 1 << 10
#: Blocks whose bits are packed at a time.
_PACKED = 64


def _scaled(counts: np.ndarray, bits: int) -> np.ndarray:
    """Where each symbol starts among 2**bits, by the counts, each at least one wide."""
    symbols = counts.shape[-1]
    starts = np.zeros(counts.shape, np.int32)
    # Column by column, as a row is short. The quotients are exact in doubles: what is
    # divided stays below 2**30, so no rounding reaches the next integer.
    total = _total(counts).astype(float)
    upto = np.zeros(total.shape)
    for k in range(1, symbols):
        upto += counts[..., k - 1]
        starts[..., k] = upto * ((1 << bits) - symbols) / total
        starts[..., k] += k
    return starts


def _with_end(starts: np.ndarray, bits: int) -> np.ndarray:
    """Starts and, behind the last, the end of it."""
    out = np.full((len(starts), starts.shape[1] + 1), 1 << bits, np.uint64)
    out[:, :-1] = starts
    return out


def _total(counts: np.ndarray) -> np.ndarray:
    """Sums over the last axis, a short one."""
    total = counts[..., 0].copy()
    for k in range(1, counts.shape[-1]):
        total += counts[..., k]
    return total


def _widths(starts: np.ndarray, place: np.ndarray, symbol: np.ndarray, symbols: int, bits: int):
    """Start and width of a symbol in rows of starts, ``place`` being where it stands."""
    flat = starts.reshape(-1)
    start = flat.take(place)
    after = flat.take(place + 1, mode="clip")
    return start, np.where(symbol == symbols - 1, np.int32(1 << bits), after) - start


class _Encoder:
    """Range coder of several independent streams; carries are settled at the end."""

    def __init__(self, streams: int, steps: int) -> None:
        self.room = steps + 3
        self.base = np.arange(streams) * self.room
        self.low = np.zeros(streams, np.uint64)
        self.range = np.full(streams, 1 << 56, np.uint64)
        self.out = np.zeros(streams * self.room, np.uint32)
        self.at = self.base.copy()

    def put(self, start: np.ndarray, width: np.ndarray) -> None:
        """Code what lies from ``start``, ``width`` wide, of 2**_BITS for each stream."""
        share = self.range >> _BITS
        low = share * start
        low += self.low
        share *= width
        full = share < _LEAST
        self.out[self.at] = low >> np.uint64(32)
        self.at += full
        shift = full * _WORD
        # Without a word that leaves, nothing above the lower bits must be lost.
        low &= np.where(full, _LOWER, ~np.uint64(0))
        self.low = low << shift
        self.range = share << shift

    def finish(self) -> list[bytes]:
        for k in range(3):
            self.out[self.at + k] = self.low >> np.uint64(32)
            self.low = (self.low & _LOWER) << _WORD
        used = self.at - self.base
        words = self.out.reshape(-1, self.room)[:, : int(used.max()) + 3].copy()
        while True:
            carry = words >> np.uint32(24)
            if not carry.any():
                break
            words &= np.uint32(0xFFFFFF)
            words[:, :-1] += carry[:, 1:]
        as_bytes = words.astype(">u4").view(np.uint8).reshape(*words.shape, 4)[:, :, 1:]
        # The last two bytes are zeros.
        ends = 3 * used + 7
        return [row.reshape(-1)[:end].tobytes() for row, end in zip(as_bytes, ends.tolist())]


class _Decoder:
    def __init__(self, streams: list[bytes]) -> None:
        room = max(7, *map(len, streams))
        room += -(room - 7) % 3 + 3
        data = np.zeros((len(streams), room), np.uint8)
        for k, s in enumerate(streams):
            data[k, : len(s)] = np.frombuffer(s, np.uint8)
        self.code = np.zeros(len(streams), np.uint64)
        for k in range(7):
            self.code = (self.code << np.uint64(8)) | data[:, k]
        words = data[:, 7:].reshape(len(streams), -1, 3).astype(np.uint32)
        words = (words[:, :, 0] << np.uint32(16)) | (words[:, :, 1] << np.uint32(8)) | words[:, :, 2]
        self.words = words.ravel()
        self.range = np.full(len(streams), 1 << 56, np.uint64)
        # A broken stream may ask for more words than there are.
        self.last = np.arange(1, len(streams) + 1) * words.shape[1] - 1
        self.at = self.last - words.shape[1] + 1

    def take(self, code: np.ndarray, share: np.ndarray) -> None:
        """Go on within a part of the range: where the code stands in it, and its width."""
        full = share < _LEAST
        shift = full * _WORD
        code <<= shift
        code |= self.words.take(self.at) * full
        self.code, self.range = code, share << shift
        self.at += full
        np.minimum(self.at, self.last, out=self.at)


def _pack(values: np.ndarray, bits: np.ndarray, owner: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of so many bits as 32-bit words, each owner's from a word of its own; and
    where each owner starts. ``owner`` ascends."""
    per = np.bincount(owner, bits, owners).astype(np.int64)
    starts = np.cumsum(np.append(0, (per + 31) // 32))
    ends = np.cumsum(bits)
    first = np.searchsorted(owner, np.arange(owners))
    before = np.append(ends, ends[-1:] if len(ends) else 0)
    ahead = np.where(first > 0, before[np.maximum(first - 1, 0)], 0) if len(ends) else np.zeros(owners, np.int64)
    place = ends - bits - ahead[owner] + 32 * starts[owner]
    shifted = values.astype(np.uint64) << (place & 31).astype(np.uint64)
    word = place >> 5
    size = int(starts[-1]) + 1
    # No two values share a bit, so sums are exact.
    words = np.bincount(word, (shifted & np.uint64(0xFFFFFFFF)).astype(float), size)
    words += np.bincount(word + 1, (shifted >> np.uint64(32)).astype(float), size + 1)[:size]
    return words.astype(np.uint64).astype("<u4"), starts


class _Model:
    """The adaptive state of each block of a segment, as it stands in a stretch."""

    def __init__(self, blocks: int) -> None:
        # Places are 64-bit, as numpy would turn others into that for each use.
        self.blocks, every = blocks, np.arange(blocks)
        self.base2, self.base1 = every * _SLOTS2, every * _SLOTS1
        # A prediction and its trust: 4 * id + trust.
        self.table2 = np.full(blocks * _SLOTS2, -4, np.int32)
        self.table1 = np.full(blocks * _SLOTS1, -4, np.int32)
        self.zero = np.full(blocks, -4, np.int32)
        # What came of predictions, by order and trust; at first, none is believed.
        self.kinds = np.tile(np.array([1, 1, 1, 5], np.int32), (blocks, 3, _TRUST, 1))
        for order in range(3):
            self.kinds[:, order, 1:, order] += 4
        self.sizes = np.ones((blocks, _SIZES), np.int32)
        self.row_base, self.kind_base = every * (_TRUST * _TRUST), every * (3 * _TRUST * 4)
        self.size_base = every * _SIZES
        self._mix()

    def _mix(self) -> None:
        """Starts of the kinds for each trust in the order-2 and the order-1 prediction,
        and of the numbers of bits. Counts add up, so surer orders weigh more."""
        own = self.kinds[np.arange(self.blocks), 2, self.zero & 3]
        mixed = self.kinds[:, 0, :, None] + (self.kinds[:, 1] + own[:, None])[:, None]
        self.kind_starts = _scaled(mixed.reshape(-1, 4), _KIND_BITS)
        self.size_starts = _scaled(self.sizes, _SIZE_BITS)

    def look(self, p1: np.ndarray, p2: np.ndarray) -> tuple[np.ndarray, ...]:
        """Slots and predictions of orders 2 and 1, and the row of kinds, after the ids
        ``p1`` and, before it, ``p2`` (unsigned 32-bit, as products wrap)."""
        near = p1 * np.uint32(40503)
        far = near + p2 * np.uint32(2654435)
        at2 = (far >> np.uint32(5) & np.uint32(_SLOTS2 - 1)).view(np.int32) + self.base2
        at1 = (near >> np.uint32(4) & np.uint32(_SLOTS1 - 1)).view(np.int32) + self.base1
        held2, held1 = self.table2.take(at2), self.table1.take(at1)
        row = self.row_base + ((held2 & 3) << 2 | held1 & 3)
        return at2, at1, held2, held1, row

    def learn(self, ids, kind, at2, at1, held2, held1) -> None:
        """Take in a stretch: arrays of steps by blocks."""
        held = (held2, held1, self.zero)
        own = self.kind_base + kind
        counts = np.zeros(self.kinds.size, np.int64)
        for order in range(3):
            where = own + ((held[order] & 3) << 2 | order << 4)
            counts += np.bincount(where.ravel(), minlength=self.kinds.size)
        self.kinds += 4 * counts.reshape(self.kinds.shape).astype(np.int32)
        self.kinds >>= (_total(self.kinds) > _MOST).astype(np.int32)[..., None]
        np.maximum(self.kinds, 1, out=self.kinds)
        where = (self.size_base + _size_of(ids))[kind == 3]
        counts = np.bincount(where, minlength=self.sizes.size).astype(np.int32)
        self.sizes += 2 * counts.reshape(self.sizes.shape)
        self.sizes >>= (_total(self.sizes) > _MOST).astype(np.int32)[..., None]
        np.maximum(self.sizes, 1, out=self.sizes)
        # Of several ids after one context the last stays.
        for table, at, before in ((self.table2, at2, held2), (self.table1, at1, held1)):
            table[at.ravel()] = _next(before, ids).ravel()
        for now in ids[:: STRETCH // 4]:
            self.zero = _next(self.zero, now)
        self._mix()


def _next(held: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Predictions and trust after an id was met."""
    trust = held & 3
    missed = np.where(trust > 1, held - 2, ids << 2)
    return np.where(held >> 2 == ids, held + (trust < _TRUST - 1), missed)


#: The place of the highest bit of each id; 0 for the ids 0 and 1.
_SIZE_OF = np.repeat(np.arange(16, dtype=np.int32), [2, *(1 << k for k in range(1, 16))])

#: What an id of so many bits has beside its plain bits, and what keeps those.
_HIGH_OF = np.array([0, *(1 << k for k in range(1, 16))], np.uint64)
_REST_OF = np.array([1, *((1 << k) - 1 for k in range(1, 16))], np.uint64)


def _size_of(ids: np.ndarray) -> np.ndarray:
    return _SIZE_OF.take(ids)


def encode(ids: np.ndarray) -> bytes:
    """A segment: blocks of :data:`BLOCK` ids below 65536, each with count, sizes of its
    two parts and CRC-32.

    The last block is filled up with zeros, which cost next to nothing.
    """
    if len(ids) and (ids.min() < 0 or ids.max() >= 1 << 16):
        raise ValueError("ids must be below 65536")
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return MAGIC + struct.pack("<I", 0)
    steps = min(n, BLOCK)
    counts = np.full(blocks, steps)
    counts[-1] = n - steps * (blocks - 1)
    padded = np.zeros(blocks * steps, np.int32)
    padded[:n] = ids
    by_block = padded.reshape(blocks, steps)
    # Two zeros before the first id, as its context.
    in_steps = np.zeros((steps + 2, blocks), np.int32)
    in_steps[2:] = by_block.T
    before = in_steps.view(np.uint32)
    coder, model = _Encoder(blocks, steps), _Model(blocks)
    missed = np.zeros((steps, blocks), bool)
    for begin in range(0, steps, STRETCH):
        now = in_steps[begin + 2 : begin + 2 + STRETCH]
        end = begin + len(now)
        at2, at1, held2, held1, row = model.look(before[begin + 1 : end + 1], before[begin:end])
        kind = np.full(now.shape, 3, np.int32)
        kind[model.zero >> 2 == now] = 2
        kind[held1 >> 2 == now] = 1
        kind[held2 >> 2 == now] = 0
        start, width = _widths(model.kind_starts, row * 4 + kind, kind, 4, _KIND_BITS)
        start, width = start << _SIZE_BITS, width.astype(np.int64)
        other = np.equal(kind, 3, out=missed[begin:end])
        size = _size_of(now)
        low, wide = _widths(model.size_starts, model.size_base + size, size, _SIZES, _SIZE_BITS)
        start = (start + np.where(other, width * low, 0)).astype(np.uint64)
        width = (width * np.where(other, wide, 1 << _SIZE_BITS)).astype(np.uint64)
        for k in range(len(now)):
            coder.put(start[k], width[k])
        model.learn(now, kind, at2, at1, held2, held1)
    streams = coder.finish()
    plain, sizes = [], []
    # Some blocks at a time, so that what is made of them stays in the caches.
    for begin in range(0, blocks, _PACKED):
        some = np.ascontiguousarray(missed[:, begin : begin + _PACKED].T)
        owner = np.repeat(np.arange(len(some)), some.sum(1))
        value = by_block[begin : begin + _PACKED][some]
        high = _size_of(value)
        rest = np.where(value > 1, value - (1 << high), value)
        words, at = _pack(rest, np.maximum(high, 1), owner, len(some))
        plain.append(words[:-1].tobytes())
        sizes += (4 * np.diff(at)).tolist()
    heads = b"".join(
        struct.pack("<IIII", int(count), len(s), size, zlib.crc32(row[:count].astype("<u4").tobytes()))
        for count, s, row, size in zip(counts, streams, by_block, sizes)
    )
    return b"".join([MAGIC, struct.pack("<I", blocks), heads, *streams, *plain])


def decode(data: bytes) -> np.ndarray:
    """Ids of a segment. Raises ``ValueError`` if a block does not match its checksum."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a segment of token ids")
    at = len(MAGIC)
    (blocks,) = struct.unpack_from("<I", data, at)
    if not blocks:
        return np.zeros(0, np.int32)
    heads = np.frombuffer(data, "<u4", 4 * blocks, at + 4).reshape(blocks, 4).astype(np.int64)
    starts = np.cumsum([at + 4 + 16 * blocks, *heads[:, 1]]).tolist()
    coder = _Decoder([data[a:b] for a, b in zip(starts, starts[1:])])
    plain = np.frombuffer(data[starts[-1] :].ljust(4 * int(heads[:, 2].sum() // 4) + 8, b"\0")[: 4 * int(heads[:, 2].sum() // 4) + 8], "<u4")
    # Every pair of neighbouring words, so that any value is in one of them.
    pairs = plain[:-1].astype(np.uint64) | plain[1:].astype(np.uint64) << np.uint64(32)
    bit = 32 * np.cumsum(np.append(0, heads[:-1, 2] // 4))
    last = 32 * len(pairs) - 1
    model, steps = _Model(blocks), int(heads[0, 0])
    ids = np.zeros((steps + 2, blocks), np.int32)
    before = ids.view(np.uint32)
    five, ends = np.arange(0, 5 * blocks, 5), np.arange(0, (_SIZES + 1) * blocks, _SIZES + 1)
    for begin in range(0, steps, STRETCH):
        length = min(STRETCH, steps - begin)
        seen = [np.empty((length, blocks), kind) for kind in (np.int32, np.int64, np.int64, np.int32, np.int32)]
        guess0 = model.zero >> 2
        kinds = _with_end(model.kind_starts, _KIND_BITS)
        sizes, levels = _with_end(model.size_starts, _SIZE_BITS).ravel(), model.size_starts.astype(np.uint16)
        for k in range(length):
            t = begin + k + 2
            at2, at1, held2, held1, row = model.look(before[t - 1], before[t - 2])
            # Where each kind starts and the last one ends, in the scale of the code.
            bounds = kinds.take(row, axis=0)
            bounds *= (coder.range >> _BITS << np.uint64(_SIZE_BITS))[:, None]
            below = (bounds[:, 1:4] <= coder.code[:, None]).view(np.int8)
            kind = below[:, 0] + below[:, 1]
            kind += below[:, 2]
            place = five + kind
            bounds = bounds.reshape(-1)
            start = bounds.take(place)
            place += 1
            width = bounds.take(place) - start
            rest = coder.code - start
            unit = width >> np.uint64(_SIZE_BITS)
            where = np.minimum(rest // unit, _SCALE - np.uint64(1)).astype(np.uint16)
            # The number of bits, as if each id were another one than predicted.
            fits = np.bitwise_count((levels <= where[:, None]).view(np.uint64))
            size = (fits[:, 0] + fits[:, 1]).astype(np.int64)
            size -= 1
            place = ends + size
            low = sizes.take(place)
            place += 1
            high = sizes.take(place)
            other = kind == 3
            coder.take(rest - unit * (low * other), np.where(other, unit * (high - low), width))
            value = pairs.take(bit >> 5) >> (bit & 31).view(np.uint64)
            value &= _REST_OF.take(size)
            value += _HIGH_OF.take(size)
            now = np.where(kind == 1, held1 >> 2, guess0)
            now = np.where(kind == 0, held2 >> 2, now)
            now = np.where(other, value.astype(np.int32), now)
            bit += np.maximum(size, 1) * other
            np.minimum(bit, last, out=bit)
            ids[t] = now
            for kept, made in zip(seen, (kind, at2, at1, held2, held1)):
                kept[k] = made
        model.learn(ids[begin + 2 : begin + 2 + length], *seen)
    by_block = np.ascontiguousarray(ids[2:].T)
    counts, sums = heads[:, 0].tolist(), heads[:, 3].tolist()
    for count, crc, row in zip(counts, sums, by_block):
        if zlib.crc32(row[:count].astype("<u4").tobytes()) != crc:
            raise ValueError("a block of token ids does not match its checksum")
    return np.concatenate([row[:count] for row, count in zip(by_block, counts)])


#: Characters that Python takes for white space and the tokenizers library does not.
_SEPARATOR, _SPACED = re.compile("[\x1c-\x1f]"), re.compile("(?:\\S|[\x1c-\x1f])+")


#: Texts of these characters only are cut into pieces without the library: their lower
#: case and normal form are plain, and the library's pattern is known to cut them so.
_PLAIN = re.compile("[ -&(-~\t\n\rÀ-ÖØ-öø-ÿ]*")  # no apostrophe, which the pattern treats apart
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: 0: white space, 1: letter, 2: digit, 3: another mark, of the characters below 256.
_KIND_OF = np.array(
    [0 if chr(k) in " \t\n\r" else 2 if 48 <= k < 58 else 1 if chr(k).isalpha() else 3 for k in range(256)],
    np.uint8,
)


#: What keeps the first so many bytes of a little-endian word.
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class _PieceTable:
    """Ids of pieces by 64-bit keys of theirs, in slots that are found by a part of the key.

    A piece of up to eight bytes, none of them zero, is its own key. The key of a longer
    one adds up random numbers, one per character and place, so that two given pieces
    share one with chance 2**-64 whatever they are.
    """

    LONGEST = 64
    _SPREAD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self) -> None:
        draw = np.random.Generator(np.random.PCG64(20))
        self.numbers = draw.integers(0, 1 << 64, (256, self.LONGEST), np.uint64).ravel()
        self.clear()

    def clear(self) -> None:
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.sizes, self.count = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32), 0
        self._slots(14)

    def _slots(self, bits: int) -> None:
        self.bits, self.keys = bits, np.zeros(1 << bits, np.uint64)
        self.entry = np.zeros(1 << bits, np.int32)

    def __len__(self) -> int:
        return self.count

    def hashes(self, text: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Keys of pieces of ``text``, of the first LONGEST bytes of each."""
        words = np.ndarray((len(text),), "<u8", text + bytes(8), strides=(1,))
        keys = words[starts] & _FIRST_BYTES.take(sizes, mode="clip")
        long = np.flatnonzero(sizes > 8)
        if len(long):
            size = np.minimum(sizes[long], self.LONGEST)
            first = np.cumsum(size) - size
            place = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
            held = np.frombuffer(text, np.uint8).take(np.repeat(starts[long], size) + place)
            place += held.astype(np.int64) * self.LONGEST
            keys[long] = np.maximum(np.add.reduceat(self.numbers.take(place), first), np.uint64(1))
        return keys

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys * self._SPREAD >> np.uint64(64 - self.bits)).view(np.int64)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The entry of each key; -1 where it is new."""
        at = self._home(wanted)
        held = self.keys.take(at)
        found = np.where(held == wanted, self.entry.take(at), np.int32(-1))
        left = np.flatnonzero((held != wanted) & (held != 0))
        at = at[left]
        while len(left):
            at = at + 1 & len(self.keys) - 1
            held = self.keys.take(at)
            hit = held == wanted[left]
            found[left[hit]] = self.entry[at[hit]]
            on = ~hit & (held != 0)
            left, at = left[on], at[on]
        return found

    def _insert(self, keys: np.ndarray, entries: np.ndarray) -> None:
        at = self._home(keys)
        while len(keys):
            free = self.keys.take(at) == 0
            self.keys[at[free]] = keys[free]
            # Of several that meet in a free slot, one has it now.
            won = free & (self.keys.take(at) == keys)
            self.entry[at[won]] = entries[won]
            keys, entries, at = keys[~won], entries[~won], at[~won] + 1 & len(self.keys) - 1

    def add_ids(self, ids: np.ndarray) -> int:
        """Where the ids stand that are stored now."""
        end = self.used + len(ids)
        while end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : end] = ids
        begin, self.used = self.used, end
        return begin

    def add(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """New keys, each once, with their ids, one after the other."""
        begin, end = self.add_ids(ids), self.count + len(keys)
        while end > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        self.starts[self.count : end] = begin + np.cumsum(sizes) - sizes
        self.sizes[self.count : end] = sizes
        entries = np.arange(self.count, end, dtype=np.int32)
        self.count = end
        if 2 * end > len(self.keys):
            taken = np.flatnonzero(self.keys)
            keys = np.concatenate([self.keys[taken], keys])
            entries = np.concatenate([self.entry[taken], entries])
            self._slots((2 * end).bit_length() + 1)
        self._insert(keys, entries)


class WordEncoder:
    """A tokenizer of the ``tokenizers`` library that drops white space, and the ids
    of the words it has met. Words are encoded apart, which gives the ids of the whole
    text, because no token goes across white space."""

    MAX_KNOWN, MAX_PIECES = 300_000, 2_000_000
    #: New words that are encoded as one text.
    TOGETHER = 200
    CUT = "\x1c"

    def __init__(self, path: str) -> None:
        # Spark runs the tasks side by side; further threads only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.pieces = _PieceTable()
        # The same model, for pieces that are in lower case and cut already.
        self.of_pieces, self.closes = Tokenizer(self.tokenizer.model), None
        self.of_pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        if self._cuts_as_known():
            suffix, words = self.tokenizer.model.end_of_word_suffix, self.tokenizer.get_vocab()
            self.closes = np.zeros(max(words.values(), default=0) + 1, bool)
            self.closes[[i for word, i in words.items() if word.endswith(suffix)]] = True
        # Between new words stands a character that no other one shares its id with.
        ids = self.tokenizer.encode(self.CUT, add_special_tokens=False).ids
        self.cut_id = ids[0] if len(ids) == 1 else None
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        self.marks = re.compile("|".join(map(re.escape, [self.CUT, *self.special])))

    def _cuts_as_known(self) -> bool:
        """Whether the tokenizer lower-cases and cuts texts as :meth:`_plain` does."""
        stated = json.loads(self.tokenizer.to_str())
        steps = (stated["normalizer"] or {}).get("normalizers", [])
        cuts = (stated["pre_tokenizer"] or {}).get("pretokenizers", [])
        first = cuts[0] if cuts else {}
        return (
            [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
            and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
            and first["pattern"] == {"Regex": _PATTERN} and first["behavior"] == "Removed" and first["invert"]
            and not cuts[1]["use_regex"] and not cuts[1]["add_prefix_space"]
            and stated["model"]["type"] == "BPE" and bool(stated["model"]["end_of_word_suffix"])
            and stated["post_processor"] is None
        )

    def _learn(self, new: list[str]) -> None:
        """The ids of words that have not been met."""
        alone = new if self.cut_id is None else list(filter(self.marks.search, new))
        joined = list(set(new).difference(alone)) if alone else new
        for word in alone:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            self.known[word] = np.array(ids, "<u4").tobytes()
        parts = [joined[k : k + self.TOGETHER] for k in range(0, len(joined), self.TOGETHER)]
        for start in range(0, len(parts), 100):
            some = parts[start : start + 100]
            lines = [f" {self.CUT} ".join(part) for part in some]
            found = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
            for part, encoded in zip(some, found):
                ids = np.array(encoded.ids, "<u4")
                cuts = np.flatnonzero(ids == self.cut_id)
                if len(cuts) != len(part) - 1:
                    raise ValueError("the tokenizer does not keep words apart")
                packed = ids.tobytes()
                starts = [0, *(4 * cuts + 4).tolist()]
                ends = [*(4 * cuts).tolist(), len(packed)]
                self.known.update((w, packed[s:e]) for w, s, e in zip(part, starts, ends))

    def _ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after the other, and how many each has. Many are encoded in
        one text: the last token of a piece tells that it ends there."""
        lines = [" ".join(pieces[k : k + self.TOGETHER]) for k in range(0, len(pieces), self.TOGETHER)]
        made = []
        for begin in range(0, len(lines), 100):
            found = self.of_pieces.encode_batch_fast(lines[begin : begin + 100], add_special_tokens=False)
            made += [np.array(encoded.ids, np.uint32) for encoded in found]
        ids = np.concatenate(made) if made else np.zeros(0, np.uint32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(pieces):
            raise ValueError("the tokenizer does not keep pieces apart")
        return ids, np.diff(ends, prepend=0)

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Ids of plain texts without apostrophes, whose pieces are runs of letters or of
        marks and single digits."""
        # A line end belongs to no piece, so it keeps the texts apart.
        low = "\n".join(texts).lower()
        packed = low.encode("latin-1")
        kinds = _KIND_OF.take(np.frombuffer(packed, np.uint8))
        edge = np.empty(len(kinds), bool)
        edge[0] = True
        np.not_equal(kinds[1:], kinds[:-1], out=edge[1:])
        edge |= kinds == 2  # every digit is a piece
        cuts = np.append(np.flatnonzero(edge), len(kinds))
        piece = np.flatnonzero(kinds.take(cuts[:-1]))
        starts = cuts.take(piece)
        lengths = cuts.take(piece + 1) - starts
        table = self.pieces
        if len(table) > self.MAX_PIECES:
            table.clear()
        keys = table.hashes(packed, starts, lengths)
        entry = table.find(keys)
        new = np.flatnonzero(entry < 0)
        if len(new):
            keys_new, first = np.unique(keys[new], return_index=True)
            some = new[first]
            names = [low[s : s + n] for s, n in zip(starts[some].tolist(), lengths[some].tolist())]
            table.add(keys_new, *self._ids_of(names))
            entry[new] = table.find(keys[new])
        sizes, at = table.sizes.take(entry), table.starts.take(entry)
        # What is longer than the hash sees is encoded alone.
        for k in np.flatnonzero(lengths > table.LONGEST).tolist():
            ids, _ = self._ids_of([low[starts[k] : starts[k] + lengths[k]]])
            at[k], sizes[k] = table.add_ids(ids), len(ids)
        upto = np.cumsum(sizes)
        flat = table.ids.take(np.arange(upto[-1] if len(upto) else 0) + np.repeat(at - upto + sizes, sizes))
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        bounds = np.append(0, upto)[np.searchsorted(starts, begins)]
        packed = flat.astype("<u4").tobytes()
        return [packed[4 * a : 4 * b] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        A plain text is cut into pieces here and each new piece is encoded by the
        library; of other texts each new word is, with all that the library does to it.
        """
        if len(self.known) > self.MAX_KNOWN:
            self.known.clear()
        out: list[bytes] = [b""] * len(texts)
        plain, other = [], []
        for k, text in enumerate(texts):
            if text:
                fast = self.closes is not None and _PLAIN.fullmatch(text) and not any(m in text for m in self.special)
                (plain if fast else other).append(k)
        if plain:
            for k, packed in zip(plain, self._plain([texts[k] for k in plain])):
                out[k] = packed
        split = [_SPACED.findall(t) if _SEPARATOR.search(t) else t.split() for t in map(texts.__getitem__, other)]
        known = self.known
        # Not a difference with the keys, which would go through all of them.
        self._learn([w for w in set().union(*split) if w not in known])
        get = known.__getitem__
        for k, words in zip(other, split):
            out[k] = b"".join(map(get, words))
        return out


@lru_cache(maxsize=1)
def _word_encoder(path: str) -> WordEncoder:
    """The encoder of this worker: the tasks that it runs share the words met so far."""
    return WordEncoder(path)


def write_ids(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, text: str = "text", doc_id: str = "doc_id"
) -> None:
    """Write the ids of all texts, each followed by ``end_id``, in order of ``doc_id``.

    The texts are dealt out by ranges of ids (rows of one id by their content, null
    ids first), so each file holds a stretch of the order and file ``shard`` follows
    ``shard - 1``. A row of a file is a segment: ``shard``, ``segment``, ``doc_ids``,
    ``counts`` (ids of each document with its end id), ``ids`` (see :func:`encode`).
    Null and empty texts are a lone end id; ids of 65536 and more raise ``ValueError``.
    A lost task is run again and writes the
    same rows; Spark commits the files of each task once.
    """
    ordered = (
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(text).alias("text"),
            content_id(F.col(doc_id), F.col(text)).alias("row"),
        )
        .repartitionByRange("doc_id", "row")
        .sortWithinPartitions("doc_id", "row")
        .select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    )
    names = ["shard", "segment", "doc_ids", "counts", "ids"]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _word_encoder(tokenizer)
        ids: list[bytes] = []
        owners: list[pa.Array] = []
        counts: list[int] = []
        shard, segment, waiting = 0, 0, 0

        def cut() -> int:
            """How many documents come to a segment."""
            return int(np.searchsorted(np.cumsum(counts), SEGMENT)) + 1

        def finish(size: int) -> pa.RecordBatch:
            numbers = np.frombuffer(b"".join(ids[:size]), "<u4").astype(np.int64)
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([segment], pa.int32()),
                    pa.ListArray.from_arrays([0, size], pa.concat_arrays(owners[:size])),
                    pa.array([counts[:size]], pa.list_(pa.int64())),
                    pa.array([encode(numbers)], pa.binary()),
                ],
                names,
            )
            return row

        for batch in (part for whole in batches for part in in_slices(whole, 2)):
            shard = batch.column(0)[0].as_py()
            made = encoder.encode(batch.column(2).to_pylist())
            for k, packed in enumerate(made):
                ids.append(packed + end)
                owners.append(batch.column(1).slice(k, 1))
                counts.append(len(packed) // 4 + 1)
                waiting += counts[-1]
                # A rest of a quarter joins the segment before it: coding few blocks side
                # by side takes as many steps as coding many.
                while waiting >= SEGMENT + SEGMENT // 4:
                    size = cut()
                    yield finish(size)
                    segment, waiting = segment + 1, waiting - sum(counts[:size])
                    del ids[:size], owners[:size], counts[:size]
        if counts:
            yield finish(len(counts))

    kind = docs.schema[doc_id].dataType.simpleString()
    written = ordered.mapInArrow(
        run, f"shard int, segment int, doc_ids array<{kind}>, counts array<bigint>, ids binary"
    )
    # The ids are compressed already.
    written.write.mode("overwrite").option("compression", "uncompressed").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start`` (ids before it), ``n_tokens``
    and ``ids`` (little-endian unsigned 32-bit integers, with the end id). Every block
    is checked."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                first, owners, counts, data = (batch.column(c)[row] for c in range(4))
                numbers = decode(data.as_py()).astype("<u4")
                ends = np.cumsum(counts.values.to_numpy())
                starts = np.append(0, ends[:-1])
                if len(numbers) != ends[-1]:
                    raise ValueError("a segment does not have as many ids as its documents")
                packed = numbers.tobytes()
                for a in range(0, len(ends), 2000):
                    part = slice(a, min(a + 2000, len(ends)))
                    made = [packed[4 * s : 4 * e] for s, e in zip(starts[part].tolist(), ends[part].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            owners.values[part], pa.array(starts[part] + first.as_py()),
                            pa.array(ends[part] - starts[part]), pa.array(made, pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    # Where each segment starts: sums within a shard, and over one row per shard. The
    # segments meet their starts before they are decoded; the table of starts has a size
    # that Spark knows, so a small one is broadcast and nothing is shuffled.
    sizes = stage(
        files.select(
            "shard", "segment", F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, c: s + c).alias("size")
        ),
        "segment_sizes",
    )
    before = lambda w: F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = sizes.groupBy("shard").agg(F.sum("size").alias("size"))
    shards = shards.select("shard", before(Window.orderBy("shard")).alias("shard_start"))
    segments = sizes.select(
        "shard", "segment", before(Window.partitionBy("shard").orderBy("segment")).alias("segment_start")
    )
    starts = stage(
        segments.join(shards, "shard").select(
            "shard", "segment", (F.col("shard_start") + F.col("segment_start")).alias("first")
        ),
        "segment_starts",
    )
    placed = files.join(starts, ["shard", "segment"]).select("first", "doc_ids", "counts", "ids")
    return placed.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary")
