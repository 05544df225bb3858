"""Token counts that follow edits: segment trees over the pre-tokens of a document.

Pre-tokens are gathered in leaves; trees over the leaves hold sums of characters and
of tokens. An edit finds its leaves by descending the characters, re-encodes from a
few pre-tokens before it to where the old pre-tokens fit again, and updates the sums
on the way to the root. All other pre-tokens are never looked at again.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import in_slices

#: Pre-tokens of a leaf when it is made, and of one of a stored tree, where an edit
#: encodes whole leaves.
LEAF, STORED_LEAF = 64, 16
#: Pre-tokens before an edit that are encoded again: the one it touches, and one more
#: whose end depends on the character after it.
BEFORE = 2

#: (start, end, replacement) in code points of the text before any edit.
Edit = tuple[int, int, str]

EDITS = "array<struct<start:int,end:int,replacement:string>>"


class Counter:
    """Tokens of pre-tokens under one table of ranks."""

    MAX_KNOWN = 400_000

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x.strip())}
        self.encoding = tiktoken.Encoding(
            "counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def count(self, pieces: Iterable[str]) -> list[int]:
        pieces = list(pieces)
        known = self.known
        new = [p for p in set(pieces) if p not in known]
        if len(known) + len(new) > self.MAX_KNOWN:
            known.clear()
            new = list(set(pieces))
        encode = self.encoding.encode_ordinary
        known.update((p, len(encode(p))) for p in new)
        found = list(map(known.__getitem__, pieces))
        if len(known) > self.MAX_KNOWN:
            known.clear()
        return found


@functools.lru_cache(maxsize=4)
def counter(path: str, pattern: str) -> Counter:
    """The counter of a rank file, made once per Python worker."""
    return Counter(path, pattern)


class TokenTree:
    """The pre-tokens of one text, with sums of their characters and tokens."""

    def __init__(self, text: str, counter: Counter) -> None:
        self.counter = counter
        self.text = text
        pieces = counter.split(text)
        chars, tokens = list(map(len, pieces)), counter.count(pieces)
        self.leaves = [
            (chars[i : i + LEAF], tokens[i : i + LEAF]) for i in range(0, len(pieces), LEAF)
        ] or [([], [])]
        self.encoded = len(pieces)
        self._build()

    def _build(self) -> None:
        self.width = 1 << max(len(self.leaves) - 1, 0).bit_length()
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        for k, (chars, tokens) in enumerate(self.leaves):
            self.sums[self.width + k] = sum(chars), sum(tokens)
        low = self.width
        while low > 1:
            self.sums[low // 2 : low] = self.sums[low : 2 * low].reshape(-1, 2, 2).sum(1)
            low //= 2

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def _update(self, leaf: int) -> None:
        chars, tokens = self.leaves[leaf]
        node = self.width + leaf
        self.sums[node] = sum(chars), sum(tokens)
        while node > 1:
            node //= 2
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def _leaf(self, position: int) -> tuple[int, int]:
        """The leaf that holds a character, and where the leaf starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if position >= start + self.sums[node, 0] and self.sums[node + 1, 0] > 0:
                start += int(self.sums[node, 0])
                node += 1
        return node - self.width, start

    def edit(self, start: int, end: int, replacement: str) -> int:
        """Replace characters ``start`` to ``end`` (exclusive); returns the number of
        pre-tokens that were encoded for it."""
        size = len(self.text)
        start, end = min(max(start, 0), size), min(max(end, start, 0), size)
        text = self.text[:start] + replacement + self.text[end:]
        moved = len(replacement) - (end - start)
        # Where to start: BEFORE whole pre-tokens ahead of the one that is touched.
        leaf, at = self._leaf(max(start - 1, 0))
        first, k = leaf, 0
        position = at
        chars = self.leaves[leaf][0]
        while k < len(chars) and position + chars[k] < start:
            position += chars[k]
            k += 1
        for _ in range(BEFORE):
            while k == 0 and first > 0:
                first -= 1
                k = len(self.leaves[first][0])
            if k == 0:
                break
            k -= 1
            position -= self.leaves[first][0][k]
        # Where old pre-tokens start after the edit, in the new text.
        old = self._boundaries(first, k, position)
        new: list[str] = []
        reach = position
        last, j, boundary = next(old)
        for match in self.counter.pattern.finditer(text, position):
            new.append(match[0])
            reach = match.end()
            while boundary is not None and (boundary < end or boundary + moved < reach):
                last, j, boundary = next(old)
            if boundary is not None and boundary + moved == reach:
                break
        else:
            while boundary is not None:
                last, j, boundary = next(old)
        counts = self.counter.count(new)
        head_chars, head_tokens = (x[:k] for x in self.leaves[first])
        tail_chars, tail_tokens = (x[j:] for x in self.leaves[last])
        for between in range(first + 1, last + 1):
            self.leaves[between] = ([], [])
        self.leaves[first] = (
            head_chars + list(map(len, new)) + tail_chars,
            head_tokens + counts + tail_tokens,
        )
        self.text = text
        if len(self.leaves[first][0]) > 8 * LEAF:
            self._split(first)
        else:
            for leaf in range(first, last + 1):
                self._update(leaf)
        self.encoded += len(new)
        return len(new)

    def _boundaries(self, leaf: int, k: int, position: int):
        """(leaf, index, start) of each pre-token from one on; start is None at the end."""
        while leaf < len(self.leaves):
            chars = self.leaves[leaf][0]
            while k < len(chars):
                yield leaf, k, position
                position += chars[k]
                k += 1
            leaf, k = leaf + 1, 0
        end = len(self.leaves) - 1
        while True:
            yield end, len(self.leaves[end][0]), None

    def _split(self, leaf: int) -> None:
        """Make leaves of normal size of one that has grown, and the sums anew."""
        chars, tokens = self.leaves[leaf]
        cut = [(chars[i : i + LEAF], tokens[i : i + LEAF]) for i in range(0, len(chars), LEAF)]
        self.leaves[leaf : leaf + 1] = cut
        self._build()


def apply_edits(text: str, edits: Sequence[Edit], counter: Counter) -> tuple[int, int, int, int]:
    """Tokens before and after the edits, pre-tokens of the text, and those encoded
    for the edits. Edits are positions in the given text and are applied from the last
    to the first; of two that overlap, the part that a later one has replaced stays."""
    tree = TokenTree(text, counter)
    before, pieces = tree.tokens, tree.encoded
    again = apply(tree, edits)
    return before, tree.tokens, pieces, again


class LeafTree:
    """A document with its tree: per leaf the characters, tokens and pre-tokens, and sums
    of characters and tokens over the leaves. Unlike a :class:`TokenTree` it does not
    know the pre-tokens, so it is small enough to be stored with every document; an edit
    encodes again the leaves it touches and the one before them.
    """

    def __init__(self, text: str, chars, tokens, pieces, counter: Counter) -> None:
        self.text, self.counter, self.encoded = text, counter, 0
        self.leaves = np.array([chars, tokens, pieces], np.int64).reshape(3, -1)
        self._sum()

    @classmethod
    def of(cls, text: str, counter: Counter) -> LeafTree:
        """The tree of a text that has none yet."""
        return cls(text, *_leaves(counter.split(text), counter), counter)

    def _sum(self) -> None:
        """Subtree sums, the root's at 1."""
        n = self.leaves.shape[1]
        self.width = 1 << max(n - 1, 0).bit_length()
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        self.sums[self.width : self.width + n] = self.leaves[:2].T
        low = self.width
        while low > 1:
            self.sums[low // 2 : low] = self.sums[low : 2 * low].reshape(-1, 2, 2).sum(1)
            low //= 2

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    @property
    def pieces(self) -> int:
        return int(self.leaves[2].sum())

    def _leaf(self, position: int) -> tuple[int, int]:
        """The leaf that holds a character, and where the leaf starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if position >= start + self.sums[node, 0] and self.sums[node + 1, 0] > 0:
                start += int(self.sums[node, 0])
                node += 1
        return node - self.width, start

    def edit(self, start: int, end: int, replacement: str) -> int:
        """Replace characters ``start`` to ``end`` (exclusive); returns the number of
        pre-tokens that were encoded for it."""
        size = len(self.text)
        start, end = min(max(start, 0), size), min(max(end, start, 0), size)
        if start == end and not replacement:
            return 0
        text = self.text[:start] + replacement + self.text[end:]
        moved = len(replacement) - (end - start)
        first, at = self._leaf(max(start - 1, 0))
        if first > 0:  # its pre-tokens are the context of what is touched
            first -= 1
            at -= int(self.leaves[0, first])
        count = self.leaves.shape[1]
        # Old pre-tokens fit again where a leaf starts behind the edit.
        last, boundary = first, at
        new: list[str] = []
        for match in self.counter.pattern.finditer(text, at):
            new.append(match[0])
            while last < count and (boundary < end or boundary + moved < match.end()):
                boundary += int(self.leaves[0, last])
                last += 1
            if boundary >= end and boundary + moved == match.end():
                break
        else:
            last = count
        made = np.array(_leaves(new, self.counter), np.int64).reshape(3, -1)
        self.text = text
        same = last - first == made.shape[1]
        if same and made.shape[1]:
            self.leaves[:, first:last] = made
            nodes = np.arange(self.width + first, self.width + last)
            self.sums[nodes] = made[:2].T
            while nodes[0] > 1:  # only the sums on the way to the root
                nodes = np.unique(nodes // 2)
                self.sums[nodes] = self.sums[2 * nodes] + self.sums[2 * nodes + 1]
        else:
            self.leaves = np.concatenate([self.leaves[:, :first], made, self.leaves[:, last:]], axis=1)
            self._sum()
        self.encoded += len(new)
        return len(new)


def _leaves(pieces: list[str], counter: Counter) -> tuple[list[int], list[int], list[int]]:
    """Characters, tokens and pre-tokens of leaves of so many pre-tokens."""
    chars = np.fromiter(map(len, pieces), np.int64, len(pieces))
    tokens = np.array(counter.count(pieces), np.int64)
    starts = np.arange(0, len(pieces), STORED_LEAF)
    if not len(starts):
        return [], [], []
    sizes = np.diff(np.append(starts, len(pieces)))
    return np.add.reduceat(chars, starts).tolist(), np.add.reduceat(tokens, starts).tolist(), sizes.tolist()


#: A stored tree: characters, tokens and pre-tokens of each leaf.
TREE = "struct<chars: array<int>, tokens: array<int>, pieces: array<int>>"


def tree(text: Column, path: str, pattern: str) -> Column:
    """The tree of a text, to be stored with it: of type :data:`TREE`. A null text has
    the tree of an empty one, which has no leaves."""

    @F.arrow_udf(TREE)
    def run(texts: pa.Array) -> pa.Array:
        own, made = counter(path, pattern), []
        for part in in_slices(pa.RecordBatch.from_arrays([texts], ["text"]), 0):
            made += [_leaves(own.split(t), own) if t else ([], [], []) for t in part.column(0).to_pylist()]
        return _trees(made)

    return run(text)


def _trees(made: list) -> pa.Array:
    columns = [pa.array([m[k] for m in made], pa.list_(pa.int32())) for k in range(3)]
    return pa.StructArray.from_arrays(columns, ["chars", "tokens", "pieces"])


def edit_stored(text: Column, stored: Column, edits: Column, path: str, pattern: str) -> Column:
    """A text and its stored tree after edits: struct of ``text``, ``tree`` (both to be
    stored again), ``n_tokens`` before and ``n_tokens_edited`` after, ``n_pretokens`` and
    ``n_reencoded``, the pre-tokens that were encoded for the edits.

    Nothing of the text is encoded but what the edits touch, and the leaves around it.
    ``edits`` is of type :data:`EDITS`, as for :func:`count_edited`.
    """

    @F.arrow_udf(
        f"struct<text: string, tree: {TREE}, n_tokens: bigint, n_tokens_edited: bigint,"
        " n_pretokens: bigint, n_reencoded: bigint>"
    )
    def run(texts: pa.Array, trees: pa.Array, changes: pa.Array) -> pa.Array:
        own = counter(path, pattern)
        out, made, numbers = [], [], []
        for part in in_slices(pa.RecordBatch.from_arrays([texts, trees, changes], ["t", "s", "e"]), 0):
            for t, known, es in zip(*(part.column(k).to_pylist() for k in range(3))):
                held = LeafTree(t or "", known["chars"], known["tokens"], known["pieces"], own)
                row = [held.tokens, 0, held.pieces, 0]
                apply(held, [_edit(e) for e in es or [] if e])
                row[1], row[3] = held.tokens, held.encoded
                out.append(held.text), made.append(held.leaves.tolist()), numbers.append(row)
        table = np.array(numbers, np.int64).reshape(-1, 4)
        return pa.StructArray.from_arrays(
            [pa.array(out, pa.string()), _trees(made), *[pa.array(table[:, k]) for k in range(4)]],
            ["text", "tree", "n_tokens", "n_tokens_edited", "n_pretokens", "n_reencoded"],
        )

    return run(text, stored, edits)


def apply(held: TokenTree | LeafTree, edits: Sequence[Edit]) -> int:
    """Apply edits, whose positions are those of the text before any, from the last to
    the first; of two that overlap, the part that a later one has replaced stays.
    Returns the pre-tokens that were encoded."""
    again, limit = 0, len(held.text)
    for start, end, replacement in sorted(edits, key=lambda e: (e[0], e[1], e[2]), reverse=True):
        start = min(max(start, 0), limit)
        end = min(max(end, start), limit)
        again += held.edit(start, end, replacement)
        limit = start
    return again


_COUNTS = StructType(
    [StructField(n, LongType()) for n in ("n_tokens", "n_tokens_edited", "n_pretokens", "n_reencoded")]
)


def count_edited(text: Column, edits: Column, path: str, pattern: str) -> Column:
    """Struct of ``n_tokens``, ``n_tokens_edited``, ``n_pretokens``, ``n_reencoded``.

    ``edits`` is of type :data:`EDITS`; null edits, and null fields of one, count as
    none, 0 and empty. A null text counts as empty. Positions beyond the text are
    moved to its end.
    """

    @F.pandas_udf(_COUNTS)
    def run(texts: pd.Series, changes: pd.Series) -> pd.DataFrame:
        own = counter(path, pattern)
        rows = [
            apply_edits(t or "", [_edit(e) for e in es if e] if es is not None else [], own)
            for t, es in zip(texts, changes)
        ]
        return pd.DataFrame(np.array(rows, np.int64).reshape(-1, 4), columns=_COUNTS.names)

    return run(text, edits)


def _edit(e) -> Edit:
    """An edit from a dict or a row."""
    start, end, new = (e["start"], e["end"], e["replacement"])
    start = 0 if start is None else int(start)
    return start, start if end is None else int(end), new or ""
