"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The pairs that can merge wait in one bucket per merge rank; a bucket holds positions
of a linked list. Two levels of bitmaps tell which buckets have entries, so finding
the lowest rank is two find-first-set steps whatever the length of the text. Entries
whose pair has changed since are skipped when they come up.

All distinct pre-tokens of a batch share one list and one queue: no pair crosses from
one into the next, and the lowest rank of all is the lowest of each that has it. So a
bucket is merged with a few numpy calls for all its positions at once, and a very
long pre-token costs no more per byte than many short ones.
"""

from __future__ import annotations

import base64
import functools
import itertools
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, functions as F
from pyspark.sql.types import BinaryType

from .common import in_slices

#: Ranks per bitmap of the lower level.
_SPAN = 256
#: A worker forgets its pre-tokens after a batch in which it came to hold so many, or so
#: many characters of those longer than :data:`CACHE_CHARS`.
CACHE_ENTRIES = 400_000
CACHE_CHARS, CACHE_LONG_CHARS = 64, 2_000_000
#: Pre-tokens are merged together up to about so many bytes.
MERGE_BYTES = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and a rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x.strip())}


class _Numbers(dict):
    """Pre-tokens numbered as they are first met."""

    def __missing__(self, name: str) -> int:
        number = self[name] = len(self)
        return number


class RankQueue:
    """Arrays of positions in a bucket per rank; the lowest rank comes out first."""

    def __init__(self) -> None:
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.low: dict[int, int] = {}
        self.high = 0

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Add positions; those with a negative rank wait for nothing."""
        some = ranks >= 0
        ranks, positions = ranks[some], positions[some]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist()]
        ends = [*starts[1:], len(ranks)]
        for rank, start, end in zip(ranks[starts].tolist(), starts, ends):
            bucket = self.buckets.get(rank)
            if bucket is not None:
                bucket.append(positions[start:end])
                continue
            self.buckets[rank] = [positions[start:end]]
            group = rank // _SPAN
            self.low[group] = self.low.get(group, 0) | 1 << rank % _SPAN
            self.high |= 1 << group

    def pop(self) -> tuple[int, np.ndarray]:
        """The lowest rank and its positions in ascending order."""
        group = (self.high & -self.high).bit_length() - 1
        bits = self.low[group]
        rank = group * _SPAN + (bits & -bits).bit_length() - 1
        bits &= bits - 1
        self.low[group] = bits
        if not bits:
            self.high &= self.high - 1
        found = self.buckets.pop(rank)
        return rank, found[0] if len(found) == 1 else np.unique(np.concatenate(found))


class BytePairCodec:
    """Encode and decode with one table of ranks; a token's id is its rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.size = max(ranks.values(), default=-1) + 1
        self.tokens: list[bytes | None] = [None] * self.size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        pairs = [
            (left * self.size + right, rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if (left := ranks.get(token[:k])) is not None
            and (right := ranks.get(token[k:])) is not None
        ]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.pair_keys = np.append(table[:, 0], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(table[:, 1], -1).astype(np.int32)
        # Tokens that can at once be part of a pair of lower rank than their own.
        left, right = np.divmod(table[:, 0], self.size or 1)
        self.risky = {*left[table[:, 1] < left].tolist(), *right[table[:, 1] < right].tolist()}
        self.numbers, self.packed, self.long_chars = _Numbers(), [], 0

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two ids make together, -1 for none."""
        keys = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.pair_keys, keys)
        found = np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)
        return np.where((left >= 0) & (right >= 0), found, -1)

    def merge(self, pieces: Sequence[bytes]) -> list[bytes]:
        """Packed ids of each pre-token. Raises ``KeyError`` on a byte without a token."""
        if not pieces:
            return []
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(lengths)
        n = int(ends[-1])
        ids = np.full(n + 1, -1, np.int32)
        ids[:n] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        if (ids[:n] < 0).any():
            raise KeyError("the ranks have no token for some byte")
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
        # Position n stands for "none" on both sides.
        after = np.arange(1, n + 2, dtype=np.int32)
        after[ends[lengths > 0] - 1] = n
        before = np.arange(-1, n, dtype=np.int32)
        before[(ends - lengths)[lengths > 0]] = n
        waiting = np.full(n + 1, -1, np.int32)  # rank of the pair that starts here
        waiting[:n] = self._rank(ids[:n], ids[after[:n]])
        queue = RankQueue()
        queue.push(waiting[:n], np.arange(n, dtype=np.int32))
        while queue.high:
            rank, at = queue.pop()
            at = at[waiting[at] == rank]  # the others are stale
            if rank in self.risky and len(at) > 1:
                # A merge that makes a pair of lower rank lets it go before the merges
                # that follow in its pre-token; those go back.
                same = np.full(len(at), rank, np.int32)
                # -1 % size is the highest rank, so it is never lower.
                lower = self._rank(same, ids[after[after[at]]]) % self.size < rank
                lower |= self._rank(ids[before[at]], same) % self.size < rank
                if lower.any():
                    first = np.append(True, piece[at[1:]] != piece[at[:-1]])
                    so_far = np.cumsum(lower) - lower
                    start = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
                    later = so_far > so_far[start]
                    queue.push(same[later], at[later])
                    at = at[~later]
            if not len(at):
                continue
            over = after[at]
            linked = over[:-1] == at[1:]
            if linked.any():  # of pairs that overlap in a row, every other one merges
                index = np.arange(len(at))
                start = np.maximum.accumulate(np.where(np.append(True, ~linked), index, 0))
                at = at[(index - start) % 2 == 0]
                over = after[at]
            then = after[over]
            ids[at], ids[over], waiting[over] = rank, -1, -1
            after[at] = then
            before[then] = at
            new = self._rank(ids[at], ids[then])
            waiting[at] = new
            queue.push(new, at)
            ahead = before[at]
            new = self._rank(ids[ahead], ids[at])
            changed = (ahead < n) & (new != waiting[ahead])
            ahead, new = ahead[changed], new[changed]
            waiting[ahead] = new
            queue.push(new, ahead)
        left = ids[:n] >= 0
        data = ids[:n][left].astype("<u4").tobytes()
        counts = np.append(0, np.cumsum(left))[np.append(0, ends)] * 4
        cuts = counts.tolist()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def _learn(self, names: Sequence[str]) -> list[bytes]:
        """Packed ids of pre-tokens."""
        made = [b""] * len(names)
        places, block, size = [], [], 0

        def finish() -> None:
            for place, ids in zip(places, self.merge(block)):
                made[place] = ids
            places.clear()
            block.clear()

        for place, name in enumerate(names):
            data = name.encode("utf-8")
            whole = self.ranks.get(data)
            if whole is not None:
                made[place] = whole.to_bytes(4, "little")
                continue
            places.append(place)
            block.append(data)
            size += len(data)
            if size >= MERGE_BYTES:
                finish()
                size = 0
        finish()
        return made

    def encode_batch(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text, packed as little-endian unsigned 32-bit integers.

        The texts are taken one at a time and kept as numbers of their pre-tokens; new
        pre-tokens of all of them are encoded together.
        """
        numbers, packed = self.numbers, self.packed
        number = numbers.__getitem__
        held = [np.fromiter(map(number, self.split(t)), np.int32) if t else None for t in texts]
        if len(numbers) > len(packed):
            new = list(itertools.islice(numbers, len(packed), None))
            packed.extend(self._learn(new))
            self.long_chars += sum(len(name) for name in new if len(name) > CACHE_CHARS)
        pick = packed.__getitem__
        out = [b"".join(map(pick, own.tolist())) if own is not None else b"" for own in held]
        if len(packed) > CACHE_ENTRIES or self.long_chars > CACHE_LONG_CHARS:
            self.numbers, self.packed, self.long_chars = _Numbers(), [], 0
        return out

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@functools.lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> BytePairCodec:
    """The codec of a rank file, made once per Python worker."""
    return BytePairCodec(read_ranks(path), pattern)


def _strings(texts: pa.Array) -> Iterator[str | None]:
    """The texts of an array, of which a bounded stretch is held as Python strings."""
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    for part in in_slices(batch, 0):
        yield from part.column(0).to_pylist()


def _decoded(packed: Iterable[bytes | None], own: BytePairCodec) -> pa.Array:
    return pa.array((own.decode(p) if p else b"" for p in packed), pa.binary())


def encode(text: Column, path: str, pattern: str) -> Column:
    """Ids of ``text`` as little-endian unsigned 32-bit integers in one binary.

    Each match of ``pattern`` is encoded apart, without special tokens. A null text
    counts as empty and gives an empty binary. ``path`` is read on the workers.
    """

    @F.arrow_udf(BinaryType())
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(codec(path, pattern).encode_batch(_strings(texts)), pa.binary())

    return run(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """Bytes of packed ids; empty for null. They need not be valid UTF-8."""

    @F.arrow_udf(BinaryType())
    def run(packed: pa.Array) -> pa.Array:
        return _decoded((p.as_py() for p in packed), codec(path, pattern))

    return run(ids)


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """Struct of ``ids`` (see :func:`encode`) and ``decoded``, the bytes that
    :func:`decode` gives for them, by one pass through one worker."""

    @F.arrow_udf("struct<ids: binary, decoded: binary>")
    def run(texts: pa.Array) -> pa.Array:
        own = codec(path, pattern)
        ids = own.encode_batch(_strings(texts))
        return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), _decoded(ids, own)], ["ids", "decoded"])

    return run(text)


def to_array(ids: Column) -> Column:
    """Packed ids as ``array<bigint>``."""
    digits = F.hex(ids)
    places = F.sequence(F.lit(0), (F.length(ids) / 4).cast("int") - 1)
    return F.when(F.length(ids) > 0, F.transform(places, lambda i: F.conv(
        F.concat(*[F.substring(digits, i * 8 + k, F.lit(2)) for k in (7, 5, 3, 1)]), 16, 10
    ).cast("long"))).otherwise(F.array().cast("array<bigint>"))
