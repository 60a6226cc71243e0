"""Arrow kernels for the two per-row computations Spark has no expression for.

Both are row-local, so they need no shuffle: n-gram multiset intersection, counted over the rows of an
Arrow batch at once, and shift-aware edit distance.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bitloom.functions import text as tx
from bitloom.schemas import SHIFT_EDITS


_CHUNK = 1 << 18  # items counted at once, so that sorts stay in the cache


def _window(items: np.ndarray, left: np.ndarray, k: int) -> np.ndarray:
    """The item k places on, 0 behind the end of the text."""
    ahead = np.zeros_like(items)
    if k < len(items):
        ahead[:len(items) - k] = items[k:]
    ahead[left <= k] = 0
    return ahead


def _packed(items: np.ndarray, left: np.ndarray, bits: int, order: int) -> np.ndarray:
    """The ``order`` items from each place on, ``bits`` bits each, the first one highest."""
    gram = items
    for k in range(1, order):
        gram = (gram << bits) | _window(items, left, k)
    return gram


def _beginnings(distinct: np.ndarray, bits: int, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1..order, per packed gram (sorted, entry 0: nothing) the number of its first n items and
    whether it has as many."""
    out = []
    for n in range(1, order + 1):
        head = np.concatenate([[0], distinct >> (bits * (order - n))])
        out.append((np.cumsum(np.diff(head, prepend=0) != 0), (head & ((1 << bits) - 1)) != 0))
    return out


def clipped_matches(ids: list[np.ndarray], sizes: list[np.ndarray], order: int) -> np.ndarray:
    """Per row and order 1..n: sum over grams of min(count in hypothesis, count in reference).

    ``ids`` holds the items of all hypotheses one after another and those of all references; ``sizes``
    the items per row. The longest grams of both sides are sorted once; that order is also the order of
    their beginnings, so runs of one (row, beginning) are the counts of the shorter grams.
    """
    rows, cut = len(sizes[0]), len(ids[0])
    out = np.zeros((rows, order), np.int64)
    if not cut or not len(ids[1]):
        return out
    items, size = np.concatenate(ids).astype(np.int64) + 1, np.concatenate(sizes)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(items))
    row = np.repeat(np.tile(np.arange(rows, dtype=np.int64), 2), size)
    bits, room = int(items.max()).bit_length(), 62 - rows.bit_length()
    split = order if order * bits <= room else (order + 1) // 2
    if split * bits > 62:
        raise ValueError(f"{order} items of {bits} bits do not fit")
    if split == order:
        code_bits, code = order * bits, _packed(items, left, bits, order)
    else:  # halves are numbered in their order; the number keeps it
        distinct, half = np.unique(_packed(items, left, bits, split), return_inverse=True)
        half += 1
        half_bits = len(distinct).bit_length()
        code_bits, code = 2 * half_bits, (half << half_bits) | _window(half, left, split)
        heads = _beginnings(distinct, bits, split)
    key = (((row << code_bits) | code) << 1)
    key[cut:] |= 1
    key.sort()
    of_ref = np.concatenate([[0], np.cumsum(key & 1)])
    code = key >> 1
    if split < order:
        mask = (1 << half_bits) - 1
        first, second = (code >> half_bits) & mask, code & mask
        new_row = np.diff(code >> code_bits) != 0
        new_first = new_row | (np.diff(first) != 0)
    else:
        change = code[1:] ^ code[:-1]
    for n in range(1, order + 1):
        if split == order:
            shift = bits * (order - n)
            new = change >= (1 << shift)
        elif n <= split:
            new = new_row | (np.diff(heads[n - 1][0][first]) != 0)
        else:
            new = new_first | (np.diff(heads[n - split - 1][0][second]) != 0)
        start = np.concatenate([[0], np.flatnonzero(new) + 1])
        end = np.append(start[1:], len(key))
        ref = of_ref[end] - of_ref[start]
        both = np.minimum(ref, end - start - ref)
        if split == order:
            whole = ((code[start] >> shift) & ((1 << bits) - 1)) != 0
        elif n <= split:
            whole = heads[n - 1][1][first[start]]
        else:
            whole = heads[n - split - 1][1][second[start]]
        both[~whole] = 0
        hit = both > 0
        out[:, n - 1] = np.bincount(code[start[hit]] >> code_bits, weights=both[hit], minlength=rows)
    return out


def _chunks(sizes: np.ndarray) -> Iterator[slice]:
    """Slices of rows of about _CHUNK items; a longer row is alone."""
    chunk = np.cumsum(sizes) // _CHUNK
    cuts = np.flatnonzero(np.diff(chunk)) + 1
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)]):
        if high > low:
            yield slice(low, high)


def _matches(ids: list[np.ndarray], sizes: list[np.ndarray], order: int) -> np.ndarray:
    ends = [np.concatenate([[0], np.cumsum(s)]) for s in sizes]
    out = [np.zeros((0, order), np.int64)]
    for part in _chunks(sizes[0] + sizes[1]):
        some = [i[e[part.start]:e[part.stop]] for i, e in zip(ids, ends)]
        seen = np.zeros(max((int(i.max()) for i in some if len(i)), default=0) + 1, bool)
        for side in some:
            seen[side] = True
        number = np.cumsum(seen) - 1  # few numbers, so that many fit in a long
        out.append(clipped_matches([number[i] for i in some], [s[part] for s in sizes], order))
    return np.concatenate(out)


def _numbered(words: pa.Array, first: int) -> list[np.ndarray]:
    """Numbers of equal words, those of the first ``first`` words and those of the others."""
    number = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.split(number, [first])


def word_ngram_matches(order: int):
    """UDF over two strings of tokens: the matches of order 1..n, then the tokens of both; the words of a
    batch are numbered at once."""
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def udf(hyp: pd.Series, ref: pd.Series) -> pd.Series:
        cut = [[t.split() for t in side] for side in (hyp, ref)]
        sizes = [np.array([len(w) for w in side], np.int64) for side in cut]
        ids = _numbered(pa.array(list(chain.from_iterable(chain(*cut))), pa.string()), int(sizes[0].sum()))
        return pd.Series(list(np.column_stack([_matches(ids, sizes, order), *sizes])))
    return udf


def _among(chars: str) -> np.ndarray:
    table = np.zeros(max(map(ord, chars)) + 2, bool)  # the last entry stands for all behind
    table[[ord(c) for c in chars]] = True
    return table


_SPACE, _MARK = _among(tx.SPACE_CHARS), _among(string.punctuation)


def _is(table: np.ndarray, points: np.ndarray) -> np.ndarray:
    return table[np.minimum(points, len(table) - 1)]


def _per_row(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[np.concatenate([[0], ends])])


def _chars_and_words(texts: pd.Series) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Code points without white space, their number per row, words and their number per row. One
    punctuation mark at a word's end, else at its start, is a word of its own."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) for t in texts])
    kept = ~_is(_SPACE, points)
    starts = kept.copy()
    starts[1:] &= ~kept[:-1]
    starts[ends[:-1][ends[:-1] < len(points)]] = True
    starts &= kept
    chars, n_chars = points[kept], _per_row(kept, ends)
    word = np.flatnonzero(starts[kept])
    last = np.append(word[1:], len(chars))[:len(word)] - 1
    tail = (last > word) & _is(_MARK, chars[last])
    head = (last > word) & ~tail & _is(_MARK, chars[word])
    starts = np.zeros(len(chars), bool)
    starts[word] = starts[last[tail]] = starts[word[head] + 1] = True
    width = 1 + (chars >= 0x80).astype(np.int64) + (chars >= 0x800) + (chars >= 0x10000)
    offsets = np.concatenate([[0], np.cumsum(width)])[np.append(np.flatnonzero(starts), len(chars))]
    data = chars.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
    return chars.astype(np.int64), n_chars, words, _per_row(starts, np.cumsum(n_chars))


def chrf_matches(char_order: int, word_order: int):
    """UDF over two texts: matches of the character orders, then of the word orders, then the characters
    and words of hypothesis and reference."""
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def udf(hyp: pd.Series, ref: pd.Series) -> pd.Series:
        (hc, n_hc, hw, n_hw), (rc, n_rc, rw, n_rw) = _chars_and_words(hyp), _chars_and_words(ref)
        chars = _matches([hc, rc], [n_hc, n_rc], char_order)
        words = _matches(_numbered(pa.concat_arrays([hw, rw]), len(hw)), [n_hw, n_rw], word_order)
        return pd.Series(list(np.column_stack([chars, words, n_hc, n_rc, n_hw, n_rw])))
    return udf


# --- shift-aware edit distance -------------------------------------------------------------------
# Fixed values of the published search.
MAX_SHIFT_LENGTH, MAX_SHIFT_DISTANCE, MAX_CANDIDATES, BEAM = 10, 50, 1000, 25
_FAR = 1 << 28


def _band(n_hyp: int, n_ref: int) -> int:
    """Half the width of the band around the diagonal."""
    slope = n_ref / n_hyp
    return math.ceil(slope / 2 + BEAM) if BEAM < slope / 2 else BEAM


class _Beams:
    """Levenshtein rows of several hypotheses, each against its reference, kept to a band of one width
    around its diagonal and filled together. Longer hypotheses come first.

    Row ``i`` of a pair covers reference positions ``base[i] + k``. ``front[i]`` is the cost to reach a
    cell minus its position, ``back[i]`` the cost from the cell to the end plus its position: skipping a
    reference word is then free of arithmetic and a running minimum. An edited hypothesis that differs
    from the current one only in words ``lo..hi`` needs only those rows of ``front`` recomputed.
    """

    def __init__(self, hyps: list[np.ndarray], refs: list[np.ndarray], half: int):
        self.n, self.m = (np.array([len(w) for w in side], np.int64) for side in (hyps, refs))
        self.pairs, self.rows = len(hyps), int(self.n[0])
        at = np.minimum(np.arange(self.rows + 1)[:, None], self.n)
        self.base = np.floor(at * (self.m / self.n)).astype(np.int64) - half
        self.step = np.diff(self.base, axis=0, prepend=self.base[:1])
        self.width, self.pad = 2 * half, int(self.step.max()) + 1
        self.span = self.width + self.pad + 1
        self.k = np.arange(self.width)
        # the reference word behind position j is at ref[start + j]; out-of-range positions hold -1
        length = 2 * (half + self.pad + 2) + int(self.m[0] if self.pairs == 1 else self.m.max())
        self.ref = np.full((self.pairs, length), -1, np.int32)
        self.hyp = np.full((self.rows, self.pairs), -2, np.int32)
        self.start = np.arange(self.pairs) * length + half + 2
        for pair, (hyp, ref) in enumerate(zip(hyps, refs)):
            self.ref[pair, half + 2:half + 2 + len(ref)] = ref
            self.hyp[:len(hyp), pair] = hyp
        self.ref = self.ref.reshape(-1)

    def _next(self, previous, base, step, start, word):
        """Band cells of the next row of some pairs from the padded rows before them."""
        at = np.arange(len(previous)) * self.span + step
        window = previous.reshape(-1).take(at[:, None] + np.arange(self.width + 1))
        same = self.ref.take((start + base - 1)[:, None] + self.k) == word[:, None]
        cost = window[:, :-1] - same
        np.minimum(cost, window[:, 1:] + 1, out=cost)
        return np.minimum.accumulate(cost, axis=1)

    def forward(self, keep: bool) -> np.ndarray:
        """Distance of every pair; fills ``front`` on request."""
        front = np.full((self.rows + 1 if keep else 2, self.pairs, self.span), _FAR, np.int32)
        place = self.base[0][:, None] - 1 + np.arange(self.span)
        now = np.where((place >= 0) & (place <= self.m[:, None]), 0, _FAR).astype(np.int32)
        front[0] = now
        distance, active = np.empty(self.pairs, np.int64), self.pairs
        for i in range(1, self.rows + 1):
            previous = now if i == 1 else front[(i - 1) if keep else (i - 1) % 2]
            if i == 2 and not keep:
                front[0] = _FAR
            band = self._next(previous[:active], self.base[i, :active], self.step[i, :active],
                              self.start[:active], self.hyp[i - 1, :active])
            front[i if keep else i % 2, :active, 1:self.width + 1] = band
            while active and self.n[active - 1] == i:
                active -= 1
                distance[active] = band[active, self.m[active] - self.base[i, active]] + self.m[active]
        self.front = front
        return distance

    def backward(self) -> None:
        tail = self.pad + 1
        span = self.width + 2 * tail
        self.back = np.full((self.rows + 1, self.pairs, span), _FAR, np.int32)
        active = 0
        for i in range(self.rows, -1, -1):
            if active:
                at = np.arange(active) * span + tail - self.step[i + 1, :active]
                window = self.back[i + 1, :active].reshape(-1).take(at[:, None] + np.arange(self.width + 1))
                same = (self.ref.take((self.start[:active] + self.base[i, :active])[:, None] + self.k)
                        == self.hyp[i, :active, None])
                cost = window[:, 1:] - same
                np.minimum(cost, window[:, :-1] + 1, out=cost)
                self.back[i, :active, tail:tail + self.width] = np.minimum.accumulate(cost[:, ::-1], axis=1)[:, ::-1]
            while active < self.pairs and self.n[active] == i:
                j = self.base[i, active] + self.k
                self.back[i, active, tail:tail + self.width] = np.where(
                    (j >= 0) & (j <= self.m[active]), self.m[active], _FAR)
                active += 1
        self.back = self.back[:, :, tail:tail + self.width]

    def alignment(self, pair: int, hyp: np.ndarray, ref: np.ndarray):
        """Aligned hypothesis position per reference word and error flags of both sides."""
        i, j = len(hyp), len(ref)
        align, hyp_err, ref_err = [-1] * j, [False] * i, [False] * j
        cells, line, first = memoryview(self.front.reshape(-1)), self.pairs * self.span, pair * self.span
        base, hyp, ref = self.base[:, pair].tolist(), hyp.tolist(), ref.tolist()
        here = cells[i * line + first + j - base[i] + 1]
        while i or j:
            if i:
                k = j - base[i - 1] + 1
                at = (i - 1) * line + first + k
                if j and 1 <= k <= self.span:
                    miss = hyp[i - 1] != ref[j - 1]
                    if cells[at - 1] + miss - 1 == here:
                        i, j, here = i - 1, j - 1, cells[at - 1]
                        align[j], hyp_err[i], ref_err[j] = i, miss, miss
                        continue
                if k < self.span and cells[at] + 1 == here:
                    i, here = i - 1, cells[at]
                    hyp_err[i] = True
                    continue
            j -= 1
            here = cells[i * line + first + j - base[i] + 1]
            align[j], ref_err[j] = i - 1, True
        return np.array(align, np.int64), np.array(hyp_err, bool), np.array(ref_err, bool)

    def distances(self, changed: list[tuple[int, int, np.ndarray]]) -> np.ndarray:
        """Distance of every hypothesis given by (pair, first changed word, new words from there)."""
        result = np.empty(len(changed), np.int64)
        for low in range(0, len(changed), 2048):
            result[low:low + 2048] = self._some_distances(changed[low:low + 2048])
        return result

    def _some_distances(self, changed) -> np.ndarray:
        pair, at = (np.array([c[x] for c in changed]) for x in (0, 1))
        length = np.array([len(w) for _, _, w in changed])
        new = np.full((int(length.max()), len(changed)), -2, np.int32)
        for c, (_, _, w) in enumerate(changed):
            new[:len(w), c] = w
        rows = self.front[at, pair]
        result = np.empty(len(changed), np.int64)
        alive = np.arange(len(changed))
        for t in range(len(new)):
            p, i = pair[alive], at[alive] + t + 1
            band = self._next(rows, self.base[i, p], self.step[i, p], self.start[p], new[t, alive])
            done = length[alive] == t + 1
            if done.any():
                result[alive[done]] = (band[done] + self.back[i[done], p[done]]).min(-1)
                alive, band = alive[~done], band[~done]
                if not len(alive):
                    break
            rows = np.full((len(alive), self.span), _FAR, np.int32)
            rows[:, 1:self.width + 1] = band
        return result


def _shift_candidates(hyp, ref, align, hyp_err, ref_err, budget: int):
    """(run start, length, target) of the shifts to try; None once ``budget`` is used up.

    ``equal[h, d]`` tells whether hypothesis word h is reference word h + d - MAX_SHIFT_DISTANCE;
    equal runs are diagonals, so longer runs follow from shorter ones.
    """
    r = np.arange(len(hyp))[:, None] + np.arange(-MAX_SHIFT_DISTANCE, MAX_SHIFT_DISTANCE + 1)
    inside = (r >= 0) & (r < len(ref))
    equal = inside & (ref[np.clip(r, 0, len(ref) - 1)] == hyp[:, None])
    bad_h, bad_r = np.append(0, hyp_err.cumsum()), np.append(0, ref_err.cumsum())
    equal, runs = equal.reshape(-1), []
    run, wide = np.flatnonzero(equal), 2 * MAX_SHIFT_DISTANCE + 1
    for length in range(1, min(MAX_SHIFT_LENGTH, len(hyp)) + 1):
        if length > 1:
            run = run[:np.searchsorted(run, len(equal) - (length - 1) * wide)]
            run = run[equal[run + (length - 1) * wide]]
        h, d = run // wide, run % wide
        at = h + d - MAX_SHIFT_DISTANCE
        wrong = (bad_h[h + length] > bad_h[h]) & (bad_r[at + length] > bad_r[at])
        useful = wrong & ~((h <= align[at]) & (align[at] < h + length))
        runs += zip(h[useful].tolist(), at[useful].tolist(), [length] * int(useful.sum()))
        if len(runs) >= budget:
            return None
    found = []
    for h, at, length in runs:
        before = -1
        for place in range(at - 1, at + length):
            target = 0 if place < 0 else int(align[place]) + 1
            if target != before:
                found.append((h, length, target))
            before = target
    return found if len(found) < budget else None


def _moved(hyp, start, length, target):
    """(first changed word, the words from there to the last changed word) of one shift."""
    run = hyp[start:start + length]
    if target < start:
        return target, np.concatenate([run, hyp[target:start]])
    end = target if target > start + length else min(length + target, len(hyp))
    return start, np.concatenate([hyp[start + length:end], run])


def _search(hyps: list[np.ndarray], refs: list[np.ndarray], half: int) -> list[tuple[int, int]]:
    """Shifts and remaining edits of pairs with one band width, longer hypotheses first."""
    out, shifts, tried = [(0, 0)] * len(hyps), [0] * len(hyps), [0] * len(hyps)
    hyps, alive = list(hyps), list(range(len(hyps)))
    while alive:
        beams = _Beams([hyps[p] for p in alive], [refs[p] for p in alive], half)
        distance, changed, found = beams.forward(keep=True), [], {}
        for b, p in enumerate(alive):
            out[p] = (shifts[p], int(distance[b]))
            if distance[b] == abs(len(hyps[p]) - len(refs[p])):
                continue  # shifts keep the length, so none can gain
            some = _shift_candidates(hyps[p], refs[p], *beams.alignment(b, hyps[p], refs[p]),
                                     MAX_CANDIDATES - tried[p])
            if some:
                tried[p] += len(some)
                found[p] = (b, some, len(changed))
                changed += [(b, *_moved(hyps[p], *shift)) for shift in some]
        if not changed:
            break
        beams.backward()
        after, alive = beams.distances(changed), []
        for p, (b, some, first) in found.items():
            gains = (distance[b] - after[first:first + len(some)]).tolist()
            best = max(range(len(some)), key=lambda c: (gains[c], some[c][1], -some[c][0], -some[c][2]))
            if gains[best] > 0:
                _, start, new = changed[first + best]
                hyps[p] = np.concatenate([hyps[p][:start], new, hyps[p][start + len(new):]])
                shifts[p] += 1
                alive.append(p)
    return out


_CELLS = 1 << 22  # cells of a table held at once; a longer pair is alone


def _blocks(pairs: list[int], n: list[int], cells: int) -> Iterator[list[int]]:
    """Pairs, longer ones first, in blocks whose longest times their number stays below ``cells``."""
    block: list[int] = []
    for p in pairs:
        if block and n[block[0]] * (len(block) + 1) > cells:
            yield block
            block = []
        block.append(p)
    if block:
        yield block


def shift_edits_of(hyps: list[np.ndarray], refs: list[np.ndarray]) -> list[tuple[int, int]]:
    """Shifts and remaining edits that turn every hypothesis into its reference."""
    out = [(0, max(len(h), len(r))) for h, r in zip(hyps, refs)]
    n, bands = [len(h) for h in hyps], {}
    for p in sorted((p for p in range(len(hyps)) if len(hyps[p]) and len(refs[p])), key=lambda p: -n[p]):
        bands.setdefault(_band(len(hyps[p]), len(refs[p])), []).append(p)
    for half, pairs in bands.items():
        most = max(len(refs[p]) / n[p] for p in pairs)
        cells = int(_CELLS / (2 * half + 2 * most + 4))
        open_pairs = []
        for block in _blocks(pairs, n, 4 * cells):
            plain = _Beams([hyps[p] for p in block], [refs[p] for p in block], half).forward(keep=False)
            for p, distance in zip(block, plain.tolist()):
                out[p] = (0, distance)
                if distance != abs(n[p] - len(refs[p])):
                    open_pairs.append(p)
        for block in _blocks(open_pairs, n, cells):
            for p, found in zip(block, _search([hyps[p] for p in block], [refs[p] for p in block], half)):
                out[p] = found
    return out


def shift_edits(hyp: np.ndarray, ref: np.ndarray) -> tuple[int, int]:
    """Shifts and remaining edits that turn the hypothesis into the reference."""
    return shift_edits_of([hyp], [ref])[0]


@F.pandas_udf(SHIFT_EDITS)
def ter_edits(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Shift-aware edits per row over two lower-cased texts, and the words of the second."""
    for hyp, ref in batches:
        cut = [[t.split() for t in side] for side in (hyp, ref)]
        sizes = [[len(w) for w in side] for side in cut]
        ids = _numbered(pa.array(list(chain.from_iterable(chain(*cut))), pa.string()), sum(sizes[0]))
        found = shift_edits_of(*[np.split(i, np.cumsum(n)[:-1]) if n else [] for i, n in zip(ids, sizes)])
        yield pd.DataFrame([(edits + shifts, shifts, n) for (shifts, edits), n in zip(found, sizes[1])],
                           columns=SHIFT_EDITS.names, dtype="int64")
