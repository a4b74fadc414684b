"""A burstable hash trie over word numbers, for counting word sequences of up to four words.

The first word of a sequence is an arc of the trie, the rest a key in the hash container below it; what
has one word only is counted at the arc itself. A container that grows too large bursts into one container per second word. When the trie holds too many
entries, whole subtrees leave it, largest first: they are packed into sorted tables of 24 bytes an entry, where
what comes again is added up, or handed on as runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Word numbers are 1, 2, ... below this; three of them make a 63-bit key, 0 stands for no word.
MAX_WORDS = 1 << 21
_BITS = 21
_SECOND = 2 * _BITS
_REST = (1 << _SECOND) - 1
_LAST = (1 << _BITS) - 1


class Subtree:
    """All sequences with one first word: a hash container, or one per second word after a burst."""

    __slots__ = ("children", "container", "size")

    def __init__(self) -> None:
        self.container: dict[int, int] | None = {}
        self.children: dict[int, dict[int, int]] = {}
        self.size = 0

    def add(self, keys: list[int], counts: list[int], burst: int) -> None:
        container = self.container
        if container is not None:
            for key, n in zip(keys, counts):
                container[key] = container.get(key, 0) + n
            self.size = len(container)
            if self.size > burst:
                self.container = None
                for key, n in container.items():
                    self.children.setdefault(key >> _SECOND, {})[key & _REST] = n
            return
        for key, n in zip(keys, counts):
            child = self.children.setdefault(key >> _SECOND, {})
            rest = key & _REST
            if rest in child:
                child[rest] += n
            else:
                child[rest] = n
                self.size += 1

    def items(self) -> Iterator[tuple[int, int]]:
        if self.container is not None:
            yield from self.container.items()
        for second, child in self.children.items():
            for rest, n in child.items():
                yield second << _SECOND | rest, n

    def packed(self, word: int) -> np.ndarray:
        """Three rows: the first word, the keys and their counts."""
        table = np.fromiter((x for item in self.items() for x in item), np.int64, 2 * self.size).reshape(-1, 2)
        return np.stack((np.full(self.size, word), table[:, 0], table[:, 1]))


def _added_up(tables: list[np.ndarray]) -> np.ndarray:
    """Packed tables as one, sorted by first word and key, with one entry for each sequence."""
    first, keys, counts = np.concatenate(tables, axis=1)
    order = np.lexsort((keys, first))
    first, keys, counts = first[order], keys[order], counts[order]
    new = np.flatnonzero(np.concatenate(([True], (first[1:] != first[:-1]) | (keys[1:] != keys[:-1]))))
    return np.stack((first[new], keys[new], np.add.reduceat(counts, new)))


class HatTrie:
    """Counts of sequences, apart for every group (a language, say)."""

    def __init__(self, burst: int = 4096):
        self.burst = burst
        self.subtrees: dict[tuple[str, int], Subtree] = {}
        self.arcs: dict[str, np.ndarray] = {}
        self.size = 0
        self.tables: dict[str, np.ndarray] = {}

    @property
    def packed_size(self) -> int:
        return sum(table.shape[1] for table in self.tables.values())

    def add(self, group: str, sequences: np.ndarray) -> None:
        """Count the rows of a table of word numbers, filled up with zeros to four columns."""
        if not len(sequences):
            return
        first = sequences[:, 0]
        if not sequences[:, 1].any():
            self._add_words(group, first)
            return
        keys = sequences[:, 1] << _SECOND | sequences[:, 2] << _BITS | sequences[:, 3]
        order = np.lexsort((keys, first))
        first, keys = first[order], keys[order]
        new = np.flatnonzero(np.concatenate(([True], (first[1:] != first[:-1]) | (keys[1:] != keys[:-1]))))
        counts = np.diff(np.append(new, len(first)))
        first, keys = first[new], keys[new]
        begins = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
        keys, counts = keys.tolist(), counts.tolist()
        for word, start, stop in zip(first[begins].tolist(), begins.tolist(), [*begins[1:].tolist(), len(keys)]):
            subtree = self.subtrees.get((group, word))
            if subtree is None:
                subtree = self.subtrees[group, word] = Subtree()
            before = subtree.size
            subtree.add(keys[start:stop], counts[start:stop], self.burst)
            self.size += subtree.size - before

    def _add_words(self, group: str, words: np.ndarray) -> None:
        counts = np.bincount(words)
        held = self.arcs.get(group, np.zeros(0, np.int64))
        if len(held) < len(counts):
            held, counts = counts, held
        held[: len(counts)] += counts
        self.arcs[group] = held

    def spill(self, keep: int) -> Iterator[tuple[str, list[tuple[tuple[int, ...], int]]]]:
        """Take out what is packed and the largest subtrees until at most ``keep`` entries are left; single words
        at the end."""
        if not keep:
            for group, counts in self.arcs.items():
                yield group, [((word,), int(counts[word])) for word in np.flatnonzero(counts).tolist()]
            self.arcs = {}
        self.pack(keep)
        while self.tables:
            group, table = self.tables.popitem()
            ends = np.flatnonzero(np.diff(table[0])) + 1
            for start, stop in zip([0, *ends.tolist()], [*ends.tolist(), table.shape[1]]):
                word = int(table[0, start])
                keys, counts = table[1:, start:stop].tolist()
                yield group, [((word, *_words(key)), n) for key, n in zip(keys, counts)]

    def pack(self, keep: int) -> None:
        """Move the largest subtrees into the packed tables until at most ``keep`` entries are left."""
        leaving: dict[str, list[np.ndarray]] = {}
        for place in sorted(self.subtrees, key=lambda p: -self.subtrees[p].size):
            if self.size <= keep:
                break
            subtree = self.subtrees.pop(place)
            self.size -= subtree.size
            group, word = place
            leaving.setdefault(group, []).append(subtree.packed(word))
        for group, tables in leaving.items():
            held = [self.tables.pop(group)] if group in self.tables else []
            self.tables[group] = _added_up(held + tables)


def _words(key: int) -> Iterator[int]:
    for shift in (_SECOND, _BITS, 0):
        if word := key >> shift & _LAST:
            yield word
