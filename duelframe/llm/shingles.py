"""Words and word n-grams of a batch of texts as 64-bit hashes, in numpy.

A word is a maximal run of bytes of one class (PLAIN: other than space and
\\x09-\\x0D), with A-Z lower-cased.  Its hash is a polynomial over a random byte table, taken from
prefix sums, so a batch costs a few array passes and no Python per word.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 20                       # bytes hashed at once
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_table() -> np.ndarray:
    t = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))
    t[65:91] = t[97:123]
    return t


_TABLE = _byte_table()
#: byte classes: 0 separates, and words are runs of one class
PLAIN = np.ones(256, dtype=np.uint8)
PLAIN[[0x20, *range(0x09, 0x0E)]] = 0
#: letters, digits and all non-ASCII are one class, punctuation another
SPLIT = PLAIN.copy()
SPLIT[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = 2
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, _U(_BASE)), np.full(size, _U(pow(_BASE, -1, 1 << 64)))
        up[0] = down[0] = 1
        _POWERS["up"], _POWERS["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS["up"], _POWERS["down"]


def _words_of_block(buf: np.ndarray, starts_of_docs: np.ndarray, classes: np.ndarray):
    """(start, hash) of the words of one block; words end at document starts too."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    kind = classes[buf]
    inside = kind > 0
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = kind[1:] != kind[:-1]
    first[starts_of_docs[starts_of_docs < n]] = True
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = first[1:]
    begin, end = np.flatnonzero(inside & first), np.flatnonzero(inside & last)
    up, down = _powers(n)
    sums = np.cumsum(_TABLE[buf] * up[:n], dtype=np.uint64)
    low = np.where(begin > 0, sums[begin - 1], _U(0))
    h = (sums[end] - low) * down[begin]
    return begin, mix(h + (end - begin + 1).astype(np.uint64) * _U(0xA24BAED4963EE407))


def words(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray = PLAIN):
    """Word hashes of all documents in order, and the number of words of each.

    ``data`` holds the texts' bytes one after the other, ``offsets`` their
    bounds.  Blocks of BLOCK bytes are cut at separators, so a very long
    text needs no more memory than its hashes; one word beyond BLOCK bytes
    makes its block that long.
    """
    hashes, docs = [], []
    n, at = len(data), 0
    while at < n:
        to = min(n, at + BLOCK)
        if to < n:
            seps = np.flatnonzero(classes[data[at:to]] == 0)
            bounds = offsets[(offsets > at) & (offsets <= to)]
            best = max(at + int(seps[-1]) + 1 if len(seps) else at, int(bounds[-1]) if len(bounds) else at)
            if best == at:                        # one word fills the block: go to its end
                later = np.flatnonzero(classes[data[to:]] == 0)
                nxt = offsets[offsets > to]
                best = min(to + int(later[0]) + 1 if len(later) else n, int(nxt[0]) if len(nxt) else n)
            to = best
        inner = offsets[(offsets >= at) & (offsets < to)] - at
        begin, h = _words_of_block(data[at:to], inner, classes)
        hashes.append(h)
        docs.append(np.searchsorted(offsets, begin + at, side="right") - 1)
        at = to
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    doc = np.concatenate(docs)
    return np.concatenate(hashes), np.bincount(doc, minlength=len(offsets) - 1)


def arrow_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column without null values."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, off, data = column.buffers()
    if off is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int):
    """(hash, document) of every window of ``width`` words; fewer words: the whole sequence."""
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    windows = np.maximum(counts - width + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(counts)), windows)
    start = np.repeat(first - np.concatenate([[0], np.cumsum(windows)[:-1]]), windows) + np.arange(len(doc))
    size = np.minimum(counts, width)[doc]
    h = size.astype(np.uint64) * _U(0x8CB92BA72F3D8DD7)
    for j in range(width):
        there = j < size
        w = hashes[np.minimum(start + j, max(len(hashes) - 1, 0))] if len(hashes) else h
        h = np.where(there, mix(h * _U(0xD6E8FEB86659FD93) + w), h)
    return h, doc


def distinct(h: np.ndarray, doc: np.ndarray, n_docs: int):
    """Sorted distinct hashes of each document, one document after the other, and their bounds."""
    bounds = np.searchsorted(doc, np.arange(n_docs + 1))
    parts, sizes = [], np.zeros(n_docs, np.int64)
    for i in range(n_docs):
        s = np.sort(h[bounds[i]:bounds[i + 1]])
        if len(s) > 1:
            s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        parts.append(s)
        sizes[i] = len(s)
    return (np.concatenate(parts) if parts else h[:0]), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
