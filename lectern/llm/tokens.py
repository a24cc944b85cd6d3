"""Vectorised word hashing over Arrow string columns.

A word is a maximal run of bytes that are not ASCII white space.  Words never become Python strings here: one pass of
modular prefix sums over the UTF-8 bytes gives each word a 64-bit hash, so the cost is a few nanoseconds a byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 12, 13, 32]] = True  # what \s matches in RE2
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_POW: dict[str, np.ndarray] = {}
CHUNK_BYTES = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POW.get("up")
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INV)):
            out = np.ones(1, np.uint64)
            step = base
            while len(out) < size:
                out = np.concatenate([out, out * np.uint64(step)])
                step = step * step % (1 << 64)
            _POW[name] = out
    return _POW["up"], _POW["down"]


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; a null counts as an empty text."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def document_chunks(offsets: np.ndarray, most: int = CHUNK_BYTES):
    """Runs (first, last) of documents of about `most` bytes together; a longer text is a run of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def fold_case(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the capitals of the Latin-1 block in lower case."""
    out = _FOLD[data]
    lead = np.flatnonzero(data[:-1] == 0xC3) + 1 if len(data) > 1 else np.zeros(0, np.int64)
    capital = lead[(data[lead] >= 0x80) & (data[lead] <= 0x9E) & (data[lead] != 0x97)]
    out[capital] += 0x20
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in `data`, and for each document the index of its first word (one more at the end)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~space[data]
    before = np.empty(len(inside), bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(len(inside), bool)
    after[-1], after[:-1] = False, inside[1:]
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    before[cut] = False
    after[cut - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_of(word: str) -> int:
    """The hash that hashed_words gives a word (or a folded word)."""
    total = 0
    for i, b in enumerate(word.encode()):
        total += (b + 1) * pow(_BASE, i, 1 << 64)
    return int(mix64(np.array([total % (1 << 64)], np.uint64))[0])


def hashed_words(column: pa.Array, fold: bool = False, space: np.ndarray = _SPACE):
    """Yield (first row, hashes, bounds, starts, ends, text bytes, offsets) for runs of rows.

    `bounds[i]:bounds[i + 1]` are the words of the i-th row of the run; starts and ends are byte places in the run.
    With `fold`, words are hashed in lower case; `space` tells for each byte whether it parts words.
    """
    offsets, data = buffers(column)
    for i, j in document_chunks(offsets):
        own = offsets[i : j + 1] - offsets[i]
        text = data[offsets[i] : offsets[j]]
        starts, ends, bounds = word_spans(text, own, space)
        up, down = _powers(len(text) + 1)
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((fold_case(text) if fold else text).astype(np.uint64) * up[: len(text)] + up[: len(text)], out=sums[1:])
        yield i, mix64((sums[ends] - sums[starts]) * down[starts]), bounds, starts, ends, text, own


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of `width` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix64((sums[width:] - sums[:-width]) * down[:n])
