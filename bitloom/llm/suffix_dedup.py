"""Removal of byte strings that an earlier document holds, by two-stage suffix sorting.

Every string of ``width`` bytes belongs to the segment around its minimizer, the smallest hashed ``KMER``
bytes inside it, so equal strings meet in the same part wherever they come from. At first a segment sends
only short hashes of its contexts left and right of the minimizer: segments that share a string of
``width`` bytes share one of them, so a segment both of whose contexts are single needs no sorting. Then
a block of documents sends the text of each distinct segment that is left, with its smallest document. A
part sorts their suffixes: those smaller than their successor are sorted directly, all others are induced
by scanning the buckets of first bytes in order. Neighbours with a common prefix of ``width`` bytes form
a group, and every member whose document is not the group's smallest is removed. Segments of one
minimizer are sorted together; those of a very common one band by band, by the windows' distance from it.

Null text counts as empty. A null id comes after all others. Documents with equal ids never remove each
other; an id with several texts keeps its rows apart. Only the input decides, not what is left. Parts
follow the bytes of the texts; a text of any length is cut into slices. Repeated rows lose the same bytes.
An empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bitloom.llm.bpe import ragged
from bitloom.llm.common import salts, whole_text

WIDTH = 50
KMER = 6
BLOCK = 2 << 20
STEP = 1 << 18
SORTED = 1 << 19
_LAST = (1 << 63) - 1
PART_BYTES = 8 << 20  # of text per part
TASKS = 20_000  # parts beyond that are dealt to so many tasks, each of which takes one after another
_TAG = 31  # bits below the tag that keeps texts of one id apart: places in a text
_BASE = np.uint64(0xD1342543DE82EF95)
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 257, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_COLUMNS = ("done", "docs", "at", "size", "anchor", "segment", "text")


@lru_cache(maxsize=2)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        out = []
        for base in (_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64))):
            powers = np.full(length, base)
            powers[0] = 1
            out.append(np.cumprod(powers, dtype=np.uint64))
        return tuple(out)


class Hashes:
    """Hashes of any stretch of a byte array from sums of powers, modulo 2 ** 64."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _powers(1 << max(20, len(data).bit_length()))
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum(_BYTES[data] * powers[:len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._mixed(self.sums[end] - self.sums[start], self.inverse[start], (end - start).astype(np.uint64))

    def all(self, width: int) -> np.ndarray:
        """Of every stretch of one width."""
        n = len(self.sums) - width
        return self._mixed(self.sums[width:] - self.sums[:n], self.inverse[:n], np.uint64(width))

    @staticmethod
    def _mixed(sums: np.ndarray, inverse: np.ndarray, size) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = sums * inverse
            x += size
            x ^= x >> np.uint64(32)
            x *= np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
            return x


def window_low(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of each window, by doubling."""
    low, span = values, 1
    while span * 2 <= width:
        low, span = np.minimum(low[:-span], low[span:]), span * 2
    return np.minimum(low[:len(values) - width + 1], low[width - span:])


def segments(data: np.ndarray, edges: np.ndarray, width: int, kmer: int):
    """(source, start, end, anchor) of the segments of texts lying one after another between the edges."""
    hashes = Hashes(data)
    if len(data) < width:
        return hashes, *[np.zeros(0, dtype=np.int64)] * 4
    mixed = hashes.all(kmer)
    mixed &= ~np.uint64((1 << 24) - 1)
    mixed |= np.arange(len(mixed), dtype=np.uint64)
    low = window_low(mixed, width - kmer + 1)
    opens = np.concatenate([[True], low[1:] != low[:-1]])
    sizes = np.diff(edges)
    opens[edges[:-1][sizes >= width]] = True  # a text's first window
    for back in range(1, width):  # windows that reach into the next text
        cut = edges[1:] - back
        opens[cut[(cut >= 0) & (cut < len(opens))]] = False
    start = np.flatnonzero(opens)
    source = np.repeat(np.arange(len(sizes)), sizes)[start]
    anchor = (low[start] & np.uint64((1 << 24) - 1)).astype(np.int64)
    last = np.append(start[1:], len(data)) - 1
    # a segment ends before the next one or with its text
    return hashes, source, start, np.minimum(last, edges[source + 1] - width) + width, anchor


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 3)


def _open(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), dtype=kind)


def _slices(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, int, bytes, np.ndarray | None]]:
    """(key, first byte, bytes, marks): texts in slices of bounded size; every window lies in exactly one.

    The marks are starts of segments, counted from the slice's first byte, or None for all.
    """
    keys, tags, texts = (batch.column(i).to_pylist() for i in range(3))
    marks = batch.column(3) if batch.num_columns > 3 else [None] * len(keys)
    for key, tag, text, marked in zip(keys, tags, texts, marks):
        raw = text.encode()
        starts = None if marked is None else np.sort(marked.values.to_numpy().astype(np.int64))
        for first in range(0, max(1, len(raw) - width + 1), STEP):
            own = None if starts is None else starts[slice(*np.searchsorted(starts, [first, first + STEP]))] - first
            yield key, (tag << _TAG) + first, raw[first:first + STEP + width - 1], own


def _gathered(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[tuple]]:
    """Slices in blocks of about ``BLOCK`` bytes."""
    held, size = [], 0
    for batch in batches:
        for piece in _slices(batch, width):
            if held and size + len(piece[2]) > BLOCK:
                yield held
                held, size = [], 0
            held.append(piece)
            size += len(piece[2])
    if held:
        yield held


def _steps(slices: list[tuple], width: int, kmer: int):
    """A few slices at a time, as the hashes of every place take many times the text's memory: hashes, first
    byte, and source, start, end and anchor of their segments, counted from that byte."""
    data = np.frombuffer(b"".join(s[2] for s in slices), dtype=np.uint8)
    edges = np.concatenate([[0], np.cumsum([len(s[2]) for s in slices])])
    ends = np.unique(np.append(np.searchsorted(edges, np.arange(0, len(data), STEP)), len(slices)))
    for i, j in zip(ends[:-1], ends[1:]):
        hashes, source, *rest = segments(data[edges[i]:edges[j]], edges[i:j + 1] - edges[i], width, kmer)
        yield hashes, edges[i], source + i, *rest


def _part_of(hashes: Hashes, anchor: np.ndarray, parts: int, kmer: int) -> np.ndarray:
    return ((hashes.of(anchor, anchor + kmer) >> np.uint64(20)) % np.uint64(parts)).astype(np.int32)


def _short(hashes: np.ndarray) -> np.ndarray:
    """Of 31 bits, 0 for none. Unequal contexts with equal hashes cost work, not correctness."""
    return np.where(hashes == 0, 0, (hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)).astype(np.uint32)


def _binary_batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * (len(names) + 1)
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                                      names=["part", *names])


_CONTEXTS = ("docs", "at", "left", "right")


def _context_rows(parts: int, width: int, kmer: int):
    """Of each block a row per part: document, place, left and right context of its segments."""
    half = (width - kmer) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _gathered(batches, width):
            keys, firsts = np.array([s[0] for s in held]), np.array([s[1] for s in held])
            edges = np.concatenate([[0], np.cumsum([len(s[2]) for s in held])])
            found = []
            for hashes, base, source, start, end, anchor in _steps(held, width, kmer):
                left, right = _contexts(hashes, start, end, anchor, kmer, half)
                found.append((_part_of(hashes, anchor, parts, kmer), keys[source],
                              firsts[source] + base + start - edges[source], _short(left), _short(right)))
            part, *columns = map(np.concatenate, zip(*found))
            order = np.argsort(part, kind="stable")
            rows = []
            for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else []:
                doc, at, left, right = (c[own] for c in columns)
                rows.append((int(part[own[0]]), _packed(np.diff(doc, prepend=0)), _packed(np.diff(at, prepend=0)),
                             left.tobytes(), right.tobytes()))
            yield _binary_batch(rows, _CONTEXTS)
    return run


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of one part after the other."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[0][0] != row[0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, tag, start) of the segments with a context that another segment has too."""
    for rows in _by_part(batches):
        left, right = (np.concatenate([np.frombuffer(r[i], np.uint32) for r in rows]) for i in (3, 4))
        some = _repeated(left) | _repeated(right)
        doc, at = (np.concatenate([np.cumsum(_open(r[i], np.int64)) for r in rows])[some] for i in (1, 2))
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(at >> _TAG), pa.array((at & ((1 << _TAG) - 1)).astype(np.int32))],
            names=["key", "tag", "start"])


def _block(slices: list[tuple], parts: int, width: int, kmer: int, passing: int) -> list[tuple]:
    """Rows (part, done, columns …): a row per part with the distinct marked segments, and one with the
    stretches that a smaller document of the block removes."""
    slices = sorted(slices, key=lambda s: s[0])
    data = np.frombuffer(b"".join(s[2] for s in slices), dtype=np.uint8)
    edges = np.concatenate([[0], np.cumsum([len(s[2]) for s in slices])])
    keys, firsts = np.array([s[0] for s in slices]), np.array([s[1] for s in slices])
    marked = np.zeros(len(data) + 1, dtype=bool)
    for edge, own in zip(edges, (s[3] for s in slices)):
        marked[edge + own] = True
    found = []
    for hashes, base, source, start, end, anchor in _steps(slices, width, kmer):
        own = marked[base + start]
        source, start, end, anchor = source[own], start[own], end[own], anchor[own]
        found.append((source, base + start, base + end, base + anchor, hashes.of(start, end),
                      _part_of(hashes, anchor, parts, kmer)))
    source, start, end, anchor, whole, part = map(np.concatenate, zip(*found))
    if not len(start):
        return []
    doc, at = keys[source], firsts[source] + start - edges[source]
    # the texts are in the order of their ids, so the first place of a segment is in its smallest document
    _, first, segment = np.unique(whole, return_index=True, return_inverse=True)
    own = doc == doc[first[segment]]
    rows = []
    gone = np.flatnonzero(~own)
    if len(gone):
        opens = np.concatenate([[True], (np.diff(gone) > 1) | (source[gone[1:]] != source[gone[:-1]])
                                | (start[gone[1:]] > end[gone[:-1]])])
        closes = np.concatenate([opens[1:], [True]])
        head, tail = gone[opens], gone[closes]
        rows.append((passing, b"1", *map(_packed, (doc[head], at[head], at[tail] + end[tail] - start[tail] - at[head])), b"", b"", b""))
    held = np.flatnonzero(own)
    held = held[np.argsort(part[held], kind="stable")]
    number = np.zeros(len(first), dtype=np.int32)
    for own in np.split(held, np.flatnonzero(np.diff(part[held])) + 1):
        one = own[first[segment[own]] == own]
        number[segment[one]] = np.arange(len(one))
        text = data[ragged(start[one], end[one] - start[one])]
        # in the order of places, so that differences are small
        rows.append((int(part[own[0]]), b"", *map(_packed, (
            np.diff(doc[own], prepend=0), np.diff(at[own], prepend=0), (end[one] - start[one]).astype(np.uint8),
            (anchor[one] - start[one]).astype(np.uint8), np.diff(number[segment[own]], prepend=0).astype(np.int32), text))))
    return rows


def _block_rows(parts: int, width: int, kmer: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _gathered(batches, width):
            yield _binary_batch(_block(held, parts, width, kmer, hash(held[0][:2]) % parts), _COLUMNS)
    return run


def two_stage_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in order of their first 50 or more symbols. ``text`` holds bytes + 1, and 0 after each piece."""
    n = len(text)
    after = np.concatenate([text[1:], [0]])
    steps = np.where(after == text, n, np.arange(n))
    turn = np.minimum.accumulate(steps[::-1])[::-1]  # the place where a run of equal symbols ends
    turn = np.minimum(turn, n - 1)
    larger = (text[turn] > after[turn]) & (text > 0)  # than its successor: induced
    small = np.flatnonzero(~larger)
    words = _words(text)
    direct = small[np.lexsort([words[np.minimum(small + 7 * k, n)] for k in range(7, -1, -1)])]
    sorted_of = np.split(direct, np.cumsum(np.bincount(text[direct], minlength=257))[:-1])
    induced: list[list[np.ndarray]] = [[] for _ in range(257)]
    order = []

    def induce(scan: np.ndarray, symbol: int) -> np.ndarray:
        """Deals the predecessors to their buckets; those of the same bucket are scanned next."""
        before = scan[scan > 0] - 1
        before = before[larger[before]]
        first = text[before]
        same = before[first == symbol]
        before, first = before[first > symbol], first[first > symbol]
        if len(before):
            by = np.argsort(first, kind="stable")
            before, first = before[by], first[by]
            cuts = np.flatnonzero(np.diff(first)) + 1
            for bucket, found in zip(first[np.concatenate([[0], cuts])].tolist(), np.split(before, cuts)):
                induced[bucket].append(found)
        return same

    for symbol in range(257):
        scan = np.concatenate(induced[symbol]) if induced[symbol] else np.zeros(0, dtype=np.int64)
        while len(scan):
            order.append(scan)
            scan = induce(scan, symbol)
        if len(sorted_of[symbol]):
            order.append(sorted_of[symbol])
            induce(sorted_of[symbol], symbol)
    return np.concatenate(order)


def _words(text: np.ndarray) -> np.ndarray:
    """Seven symbols of nine bits from each place on, one more 0 at the end."""
    wide = np.concatenate([text, np.zeros(8, dtype=text.dtype)]).astype(np.int64)
    n = len(text) + 1
    out = np.zeros(n, dtype=np.int64)
    for k in range(7):
        out = (out << 9) | wide[k:k + n]
    return out


def same_prefix(text: np.ndarray, order: np.ndarray, width: int) -> np.ndarray:
    """Whether each suffix shares ``width`` symbols with the one before in the order."""
    words = _words(text)
    a, b = order[:-1], order[1:]
    equal = np.ones(len(a), dtype=bool)
    for k in [*range(0, width - 6, 7), width - 7]:
        equal &= words[a + k] == words[b + k]
    return np.concatenate([[False], equal])


def _contexts(hashes: Hashes, start, end, anchor, kmer: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the minimizer with ``half`` bytes on its left, and on its right; 0 where the segment ends before."""
    low, high = anchor - half, anchor + kmer + half
    return (np.where(low >= start, hashes.of(np.maximum(low, start), anchor + kmer), 0),
            np.where(high <= end, hashes.of(anchor, np.minimum(high, end)), 0))


def _hashed(text: np.ndarray, size: np.ndarray, anchor: np.ndarray, kmer: int, half: int):
    """Hashes of each segment, its contexts and its minimizer; the segments lie one after another."""
    hashes = Hashes(text)
    end = np.cumsum(size)
    start = end - size
    anchor = start + anchor
    return hashes.of(start, end), *_contexts(hashes, start, end, anchor, kmer, half), hashes.of(anchor, anchor + kmer)


def _repeated(values: np.ndarray) -> np.ndarray:
    order = np.argsort(values)
    equal = np.diff(values[order]) == 0
    out = np.zeros(len(values), dtype=bool)
    out[order[1:]] = equal
    out[order[:-1]] |= equal
    return out & (values != 0)


def removed_windows(texts: np.ndarray, start: np.ndarray, size: np.ndarray, doc: np.ndarray, width: int):
    """(piece, offset) of the windows of distinct pieces that a piece of a smaller document holds too."""
    gaps = size + 1
    text = np.zeros(gaps.sum(), dtype=np.uint16)
    at = np.cumsum(gaps) - gaps
    text[ragged(at, size)] = texts[ragged(start, size)].astype(np.uint16) + 1
    piece, offset = np.repeat(np.arange(len(size)), gaps), np.arange(len(text)) - np.repeat(at, gaps)
    order = two_stage_order(text)
    order = order[offset[order] + width <= size[piece[order]]]
    if not len(order):
        return order, order
    heads = np.flatnonzero(~same_prefix(text, order, width))
    group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
    least = np.minimum.reduceat(doc[piece[order]], heads)
    gone = np.sort(order[doc[piece[order]] > least[group]])
    return piece[gone], offset[gone]


def _part(rows: list[tuple], width: int, kmer: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(doc, start, end) of the stretches to remove."""
    for row in rows:
        if row[1]:
            at = _open(row[3], np.int64)
            yield _open(row[2], np.int64), at, at + _open(row[4], np.int64)
    rows = [r for r in rows if not r[1]]
    if not rows:
        return
    doc, at = (np.concatenate([np.cumsum(_open(r[i], np.int64)) for r in rows]) for i in (2, 3))
    sizes = [_open(r[4], np.uint8).astype(np.int64) for r in rows]
    anchors = [_open(r[5], np.uint8).astype(np.int64) for r in rows]
    texts = [_open(r[7], np.uint8) for r in rows]
    before = np.cumsum([0] + [len(s) for s in sizes])
    segment = np.concatenate([np.cumsum(_open(r[6], np.int32)) + b for r, b in zip(rows, before)])
    # the minimizer with half of a window's other bytes on its left, and on its right
    half = (width - kmer) // 2
    whole, left, right, mini = map(np.concatenate, zip(*(_hashed(*x, kmer, half) for x in zip(texts, sizes, anchors))))
    # equal segments of several blocks are one
    _, first, same = np.unique(whole, return_index=True, return_inverse=True)
    size = np.concatenate(sizes)
    start, size, segment = (np.cumsum(size) - size)[first], size[first], same[segment]
    before = np.concatenate(anchors)[first]
    least = np.full(len(first), _LAST)
    np.minimum.at(least, segment, doc)
    later = doc > least[segment]
    yield doc[later], at[later], at[later] + size[segment[later]]
    # two segments that share a window share the left or the right context
    pick = np.flatnonzero(_repeated(left[first]) | _repeated(right[first]))
    found = _removed(np.concatenate(texts), start[pick], (start + size)[pick], (start + before)[pick], least[pick],
                     mini[first][pick], 0, width - kmer, width)
    # at every place of their segments in the smallest document
    for spot, low, high in _dealt(((pick[piece], low, high) for piece, low, high in found), segment, ~later):
        anchor = at[spot] + before[segment[spot]]
        yield doc[spot], anchor + low, anchor + high


def _removed(data, start, end, anchor, least, group, near: int, far: int, width: int) -> Iterator[tuple]:
    """(piece, from, to), counted from the minimizer: the stretches of distinct pieces that a piece of the same
    group and a smaller document holds too. All windows begin ``near`` to ``far`` bytes before the minimizer.

    Groups are sorted together, about SORTED symbols at a time. The windows of a larger group are dealt to two
    bands by their distance from the minimizer: equal windows have the same, and share the more bytes around
    it, the narrower the band.
    """
    size = end - start
    _, group = np.unique(group, return_inverse=True)
    symbols = np.bincount(group, weights=size)
    some, large = np.bincount(group) > 1, symbols > SORTED
    turn = (np.cumsum(np.where(some & ~large, symbols, 0)) // SORTED)[group]
    own = np.flatnonzero((some & ~large)[group])
    own = own[np.argsort(turn[own], kind="stable")]
    for own in np.split(own, np.flatnonzero(np.diff(turn[own])) + 1) if len(own) else []:
        piece, offset = removed_windows(data, start[own], size[own], least[own], width)
        if len(piece):
            opens = np.concatenate([[True], (np.diff(piece) > 0) | (np.diff(offset) > 1)])
            closes = np.concatenate([opens[1:], [True]])
            piece = own[piece[opens]]
            first = start[piece] - anchor[piece]
            yield piece, first + offset[opens], first + offset[closes] + width
    own = np.flatnonzero((some & large)[group])
    if len(own):
        middle = (near + far) // 2
        for band in ((near, middle), (middle + 1, far)):
            for piece, low, high in _banded(data, start[own], end[own], anchor[own], least[own], *band, width):
                yield own[piece], low, high


def _banded(data, start, end, anchor, least, near: int, far: int, width: int) -> Iterator[tuple]:
    """(piece, from, to) as above, of the windows that begin ``near`` to ``far`` bytes before the minimizer."""
    start, end = np.maximum(start, anchor - far), np.minimum(end, anchor - near + width)
    own = np.flatnonzero(end - start >= width)
    if not len(own):
        return
    start, end, anchor, least = start[own], end[own], anchor[own], least[own]
    # the bytes that all windows of the band hold tell the groups apart; those of one distance are such a group
    whole, shared = _piece_hashes(data, start, end, anchor - near, anchor - far + width)
    _, first, same = np.unique(whole, return_index=True, return_inverse=True)
    low = np.full(len(first), _LAST)
    np.minimum.at(low, same, least)
    later = least > low[same]
    yield own[later], (start - anchor)[later], (end - anchor)[later]
    found = _removed(data, start[first], end[first], anchor[first], low, shared[first], near, far, width)
    for piece, *stretch in _dealt(found, same, ~later):
        yield own[piece], *stretch


def _piece_hashes(data, start, end, low, high) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of pieces and of a stretch inside each, a few pieces at a time."""
    turn = np.cumsum(end - start) // STEP
    out = []
    for own in np.split(np.arange(len(start)), np.flatnonzero(np.diff(turn)) + 1):
        size = (end - start)[own]
        hashes, close = Hashes(data[ragged(start[own], size)]), np.cumsum(size)
        shift = close - size - start[own]
        out.append((hashes.of(close - size, close), hashes.of(low[own] + shift, high[own] + shift)))
    return tuple(map(np.concatenate, zip(*out)))


def _dealt(found: Iterator[tuple], same: np.ndarray, kept: np.ndarray) -> Iterator[tuple]:
    """Stretches of distinct pieces, at each kept member that is the same piece."""
    members = np.flatnonzero(kept)
    members = members[np.argsort(same[members], kind="stable")]
    of = same[members]
    for piece, low, high in found:
        first = np.searchsorted(of, piece)
        n = np.searchsorted(of, piece, side="right") - first
        yield members[ragged(first, n)], np.repeat(low, n), np.repeat(high, n)


def _part_rows(width: int, kmer: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_part(batches):
            for doc, start, end in _part(rows, width, kmer):
                if len(doc):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc), pa.array(start >> _TAG), pa.array(start & ((1 << _TAG) - 1)), pa.array(end & ((1 << _TAG) - 1))],
                        names=["key", "tag", "start", "end"])
    return run


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, starts, ends in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            raw = text.encode()
            left, at, removed, spans, reach = [], 0, 0, 0, -1
            for start, end in sorted(zip(starts or (), ends or ())):
                spans += start > reach
                if end > at:
                    left.append(raw[at:max(at, start)])
                    removed += end - max(at, start)
                    at = end
                reach = max(reach, end)
            left.append(raw[at:])
            rows.append((len(raw), removed, spans, b"".join(left)))
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def tagged(rows: DataFrame) -> DataFrame:
    """Rows (key, text, …) with ``tag``: 0, but for ids with several texts the number of the text among
    all such ones, from 1. Numbers are counted per range of the texts' hashes, so no task sees all."""
    several = (rows.groupBy("key").agg((F.min(F.xxhash64("text")) != F.max(F.xxhash64("text"))).alias("several"))
               .where("several"))
    if several.isEmpty():
        return rows.withColumn("tag", F.lit(0).cast("long"))
    digests = rows.join(several, "key", "left").withColumn("digest", F.when(F.col("several"), F.md5(F.col("text").cast("binary"))))
    named = (digests.where("several").select("key", "digest").distinct()
             .withColumn("range", F.conv(F.substring("digest", 1, 3), 16, 10).cast("int")))
    # at most 4096 ranges
    before = Window.partitionBy(F.lit(1)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    first = named.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("range").orderBy("digest", "key"))
    numbers = (named.withColumn("place", place).join(F.broadcast(first), "range")
               .select("key", "digest", (F.col("first") + F.col("place")).alias("tag")))
    return digests.join(numbers, ["key", "digest"], "left").select(
        *rows.columns, F.coalesce("tag", F.lit(0).cast("long")).alias("tag"))


def deduplicated(docs: DataFrame, width: int = WIDTH, kmer: int = KMER) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): the bytes of each text that are left."""
    rows = tagged(docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("key"),
                              whole_text().alias("text"))).select("key", "tag", "text", "doc_id")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(2 * salts(docs), -(-size // PART_BYTES))
    tasks = min(parts, TASKS)
    contexts = rows.select("key", "tag", "text").mapInArrow(_context_rows(parts, width, kmer), "part int, " + ", ".join(f"{c} binary" for c in _CONTEXTS))
    shared = (contexts.repartition(tasks, "part").sortWithinPartitions("part")
              .mapInArrow(_shared_rows, "key long, tag long, start int"))
    # dealt by document before the lists are built: a list of one start takes several times its room
    marks = shared.repartition("key").groupBy("key", "tag").agg(F.collect_list("start").alias("marks"))
    # all columns go along, so that this exchange of the texts serves the last join too
    sent = (rows.join(marks, ["key", "tag"]).select("key", "tag", "text", "marks", "doc_id")
            .mapInArrow(_block_rows(parts, width, kmer), "part int, " + ", ".join(f"{c} binary" for c in _COLUMNS)))
    found = (sent.repartition(tasks, "part").sortWithinPartitions("part")
             .mapInArrow(_part_rows(width, kmer), "key long, tag long, start long, end long"))
    spans = found.repartition("key").groupBy("key", "tag").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (rows.join(spans, ["key", "tag"], "left").select("doc_id", "text", "starts", "ends")
            .mapInArrow(_kept_rows, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"))


def report(docs: DataFrame) -> DataFrame:
    return deduplicated(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
