"""A fixed piece vocabulary, and one dynamic program over the trie of many words.

Words are sorted, so that the words below a trie node are neighbours; the trie is then built one
byte depth at a time, and each node is one element of a numpy array. What a program computes for a
prefix is computed once, however many words share it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np

#: Longer words take the plain program, one byte after the other.
TRIE_BYTES = 48
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 22


class Pieces:
    """Looks up byte strings; piece numbers are the ranks of the file."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.number = ranks
        self.size = max(ranks.values()) + 1
        self.longest = max(map(len, ranks))
        self._of_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._seen = np.zeros(1 << _FILTER_BITS, bool)
        for length in sorted({len(p) for p in ranks if len(p) <= TRIE_BYTES}):
            pieces = [p for p in ranks if len(p) == length]
            keys = _keys(np.array([list(p) for p in pieces], np.uint8))
            order = np.argsort(keys)
            self._of_length[length] = keys[order], np.array([ranks[p] for p in pieces])[order]
            self._seen[_slot(keys)] = True
        self.lengths = tuple(self._of_length)

    def find(self, length: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of keys that are pieces of this length, and the pieces' numbers."""
        if length not in self._of_length:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known, numbers = self._of_length[length]
        maybe = np.flatnonzero(self._seen[_slot(keys)])
        at = np.minimum(np.searchsorted(known, keys[maybe]), len(known) - 1)
        hit = known[at] == keys[maybe]
        return maybe[hit], numbers[at[hit]]

    def ending_at(self, word: bytes, end: int) -> Iterator[tuple[int, int]]:
        """Start and number of every piece that ends there."""
        for start in range(max(0, end - self.longest), end):
            number = self.number.get(word[start:end])
            if number is not None:
                yield start, number


def _keys(rows: np.ndarray) -> np.ndarray:
    """A 64-bit key of each row of bytes."""
    keys = np.zeros(len(rows), np.uint64)
    power = np.uint64(1)
    with np.errstate(over="ignore"):
        for column in range(rows.shape[1] - 1, -1, -1):
            keys += (rows[:, column].astype(np.uint64) + np.uint64(1)) * power
            power *= _BASE
    return keys


def _slot(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


@dataclass
class Trace:
    """The nodes of a run over the trie, for a way back: all lists are by depth.

    `order` sorts the words; `node_of` has the node of each sorted word, `heads` the first word of each
    node, `ends` the words that end there, `values` the nodes' values.
    """

    order: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    node_of: list[np.ndarray] = field(default_factory=list)
    heads: list[np.ndarray] = field(default_factory=list)
    ends: list[np.ndarray] = field(default_factory=list)
    values: list[np.ndarray] = field(default_factory=list)


def over_trie(words: list[bytes], pieces: Pieces, start: np.ndarray, step: Callable, fresh: Callable, trace: Trace | None = None) -> np.ndarray:
    """The program's value at the end of every word (none longer than TRIE_BYTES, none with a NUL).

    `start` is the value of the empty prefix; `fresh(n)` makes the values of n nodes that no piece
    has reached; `step(values, at, before, numbers)` lets pieces lead from values `before` to the
    nodes `at`. A `trace` is filled with the nodes.
    """
    count = len(words)
    result = fresh(count)
    if not count:
        return result
    text = np.array(words, dtype=f"S{TRIE_BYTES}")
    order = np.argsort(text, kind="stable")
    text = text[order]
    lengths = np.array([len(w) for w in words])[order]
    rows = np.arange(count)  # words that reach this depth
    new = np.zeros(count, bool)
    new[0] = True
    letters = text.view(np.uint8).reshape(count, TRIE_BYTES)
    node_of: list[np.ndarray] = [np.zeros(count, np.int32)]  # by depth: node of each word
    values: list[np.ndarray] = [start]
    result[order[lengths == 0]] = start[0]
    if trace is not None:
        trace.order, trace.node_of, trace.values = order, node_of, values
        trace.heads, trace.ends = [np.zeros(1, np.int64)], [np.flatnonzero(lengths == 0)]
    for depth in range(1, int(lengths.max()) + 1):
        rows = rows[lengths[rows] >= depth]
        here = letters[rows, depth - 1]
        first = np.ones(len(rows), bool)
        first[1:] = (here[1:] != here[:-1]) | (node_of[depth - 1][rows[1:]] != node_of[depth - 1][rows[:-1]])
        nodes = np.zeros(count, np.int32)
        nodes[rows] = np.cumsum(first) - 1
        node_of.append(nodes)
        heads = rows[first]
        value = fresh(len(heads))
        keys = np.zeros(len(heads), np.uint64)
        power = np.uint64(1)
        with np.errstate(over="ignore"):
            for length in range(1, min(depth, pieces.lengths[-1]) + 1):
                keys += (letters[heads, depth - length].astype(np.uint64) + np.uint64(1)) * power
                power *= _BASE
                at, numbers = pieces.find(length, keys)
                if len(at):
                    step(value, at, values[depth - length][node_of[depth - length][heads[at]]], numbers)
        values.append(value)
        ends = rows[lengths[rows] == depth]
        result[order[ends]] = value[nodes[ends]]
        if trace is not None:
            trace.heads.append(heads)
            trace.ends.append(ends)
    return result


def matches(words: list[bytes], pieces: Pieces, start: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All pieces that end after `start` and up to `stop` bytes of the words: (end, word, length, number), by end and word."""
    reach, width = pieces.lengths[-1], stop - start
    letters = np.zeros((len(words), reach + width), np.uint64)
    for row, word in zip(letters, words, strict=True):
        own = word[max(0, start - reach) : stop]
        at = max(0, reach - start)
        row[at : at + len(own)] = np.frombuffer(own, np.uint8)
    lengths = np.array([len(word) for word in words])
    keys = np.zeros((len(words), width), np.uint64)
    power = np.uint64(1)
    found = []
    with np.errstate(over="ignore"):
        for length in range(1, reach + 1):
            keys += (letters[:, reach - length + 1 : reach - length + 1 + width] + np.uint64(1)) * power
            power *= _BASE
            at, numbers = pieces.find(length, keys.ravel())
            owner, end = at // width, at % width + start + 1
            inside = (end <= lengths[owner]) & (end >= length)
            found.append((end[inside], owner[inside], np.full(int(inside.sum()), length), numbers[inside]))
    ends, owners, sizes, numbers = (np.concatenate(column) for column in zip(*found, strict=True))
    order = np.lexsort((owners, ends))
    return ends[order], owners[order], sizes[order], numbers[order]
