"""Windows of words over whole batches of texts at once, on the bytes of an Arrow array.

Words are runs without ASCII white space, which never part a UTF-8 character. Their hashes come from
prefix sums of the bytes, so no word becomes a Python object.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tracewright.llm.shingles import mixed

#: Bytes of texts that are looked at together; arrays of numbers take some 40 times as much for a while.
PART_BYTES = 1 << 18

_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWERED = np.frombuffer(bytes(range(256)).lower(), np.uint8)


@dataclass(frozen=True)
class Words:
    """Words of some texts: their bytes' places, the text of each, and where each text's words begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    first_of_text: np.ndarray

    def joined(self, first: int, last: int) -> bytes:
        """Words ``first`` to ``last`` (exclusive) with one blank between."""
        return b" ".join(self.data[self.starts[first] : self.ends[last - 1]].tobytes().split())


def parts(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of about :data:`PART_BYTES` each; a longer text is a part by itself."""
    lengths = np.asarray(pc.binary_length(texts).fill_null(0))
    before = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(before, before[row] + PART_BYTES, side="right")) - 1)
        yield row, texts.slice(row, stop - row)
        row = stop


def words(texts: pa.Array, *, lower: bool = False) -> Words:
    """The words of a part, A-Z lower-cased on demand; a null text has none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    # Taken together, the buffers start at the part's first byte.
    texts = pa.concat_arrays([texts])
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data_buffer or b"", np.uint8)[offsets[0] : offsets[-1]]
    return _split(_LOWERED[data] if lower else data, offsets - offsets[0])


def words_of(data: bytes) -> Words:
    """The words of one text, given as UTF-8."""
    return _split(np.frombuffer(data, np.uint8), np.array([0, len(data)]))


def _split(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of texts that end where the next begins."""
    inside = ~_IS_SPACE[data]
    filled = offsets[1:] > offsets[:-1]
    opens = np.concatenate(([False], inside[:-1]))[: len(data)]
    opens[offsets[:-1][filled]] = False
    closes = np.concatenate((inside[1:], [False]))[: len(data)]
    closes[offsets[1:][filled] - 1] = False
    starts = np.flatnonzero(inside & ~opens)
    ends = np.flatnonzero(inside & ~closes) + 1
    text = np.searchsorted(offsets, starts, side="right") - 1
    return Words(data, starts, ends, text, np.searchsorted(text, np.arange(len(offsets) - 1)))


class _Powers:
    """Powers of the factor and of its inverse, modulo 2**64."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            def raised(x: int) -> np.ndarray:
                return np.cumprod(np.append(np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)), dtype=np.uint64)

            if n > 4 * PART_BYTES:
                return raised(_FACTOR), raised(_INVERSE)
            self.up, self.down = raised(_FACTOR), raised(_INVERSE)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def word_hashes(found: Words) -> np.ndarray:
    """64-bit hash of every word, the same wherever it stands."""
    hashes = np.zeros(len(found.starts), np.uint64)
    k = 0
    while k < len(hashes):
        base = found.starts[k]
        stop = max(k + 1, int(np.searchsorted(found.ends, base + PART_BYTES, side="right")))
        starts, ends = found.starts[k:stop] - base, found.ends[k:stop] - base
        block = found.data[base : base + ends[-1]].astype(np.uint64)
        up, down = _POWERS.of(len(block) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((block + np.uint64(1)) * up[:-1], dtype=np.uint64)))
        hashes[k:stop] = mixed((sums[ends] - sums[starts]) * down[starts])
        k = stop
    return hashes


def group_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` words in a row, across the ends of texts as well."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    n = len(hashes) - size + 1
    combined = np.zeros(n, np.uint64)
    for k in range(size):
        combined = combined * np.uint64(_FACTOR) + hashes[k : k + n]
    return mixed(combined)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size < width:
        step = min(size, width - size)
        values = np.minimum(values[:-step], values[step:]) if len(values) > step else values[:0]
        size += step
    return values


def anchored_runs(
    found: Words, hashes: np.ndarray, window: int, anchor_words: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor) of every run of windows of one text with one anchor.

    A window is named by its first word; its anchor is the lowest hash of ``anchor_words`` words inside.
    """
    lowest = sliding_min(group_hashes(hashes, anchor_words), window - anchor_words + 1)
    n = len(lowest)
    places = np.flatnonzero(found.text[:n] == found.text[window - 1 : window - 1 + n])
    anchors = lowest[places]
    new = np.flatnonzero(
        np.concatenate(([True], (anchors[1:] != anchors[:-1]) | (places[1:] != places[:-1] + 1)))[: len(places)]
    )
    return places[new], np.diff(np.append(new, len(places))), anchors[new].view(np.int64)
