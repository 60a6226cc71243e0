"""Byte-level BPE by merge replay over the words of a block of documents.

The pattern cuts each text into words. The distinct words of a block form one array of byte tokens; an
inverted index maps the rank of each adjacent pair to the positions that hold it. Ranks are taken from
the smallest up: all positions of a rank merge at once, and only the pairs with the touched neighbours
are looked up and indexed again. Merges never cross a word, so blocks are independent and no text moves
between tasks; a block is bounded in characters, and one longer text is a block of its own.

Null text counts as empty and has no ids. Extra columns are ignored; repeated rows are encoded alike.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from bitloom.llm.common import whole_text

BLOCK_CHARS = 16 << 20
_NONE = np.iinfo(np.int32).max


class Ranks:
    """A rank table with every way to split a token into two tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.size = len(self.bytes)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int32)
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.flat = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the pair, _NONE where it is no token."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], _NONE)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.flat[ragged(self.starts[ids], self.lengths[ids])].tobytes()


@lru_cache(maxsize=4)
def load(path: str) -> Ranks:
    with open(path, "rb") as lines:
        return Ranks({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, … of each run, one after another."""
    if not len(lengths):
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)


def replay(words: list[bytes], table: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after another, and the number of ids of each."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    token = table.single[np.frombuffer(b"".join(words), dtype=np.uint8)]
    n = len(token)
    if not n:
        return token, sizes
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    ends = np.cumsum(sizes)
    after[ends[sizes > 0] - 1] = n  # n: no neighbour
    before[(ends - sizes)[sizes > 0]] = n
    alive = np.ones(n, dtype=bool)
    rank = np.full(n + 1, _NONE, dtype=np.int32)  # of the pair that starts at each position
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    marked = np.zeros(n + 1, dtype=bool)
    stamp = np.zeros(n, dtype=np.int64)

    def enter(at: np.ndarray) -> None:
        """Looks up the pairs at these positions and adds the new ones to the index."""
        at = at[after[at] < n]
        found = table.of(token[at], token[after[at]])
        fresh = (found != rank[at]) & (found < _NONE)
        rank[at] = found
        at, found = at[fresh], found[fresh]
        order = np.argsort(found, kind="stable")
        at, found = at[order], found[order]
        cuts = np.flatnonzero(np.diff(found)) + 1
        for value, part in zip(found[np.concatenate([[0], cuts])].tolist() if len(found) else [], np.split(at, cuts)):
            if value not in index:
                index[value] = []
                heapq.heappush(heap, value)
            index[value].append(part)

    enter(np.arange(n))
    while heap:
        value = heapq.heappop(heap)
        parts = index.pop(value)
        at = np.concatenate(parts) if len(parts) > 1 else parts[0]
        at = at[rank[at] == value]
        if len(parts) > 1:  # a pair that went and came back is listed twice
            stamp[at] = np.arange(len(at))
            at = at[stamp[at] == np.arange(len(at))]
        if not len(at):
            continue
        follows = after[at]
        marked[at] = True
        overlap = marked[follows].any()
        marked[at] = False
        if overlap:  # a run of overlapping pairs: left to right
            at = np.sort(at)
            follows = after[at]
            taken, keep = set(), []
            for p, q in zip(at.tolist(), follows.tolist()):
                if p not in taken:
                    keep.append(p)
                    taken.add(q)
            at = np.array(keep)
            follows = after[at]
        beyond = after[follows]
        token[at] = value
        rank[at] = _NONE
        alive[follows] = False
        rank[follows] = _NONE
        after[at] = beyond
        has = beyond < n
        before[beyond[has]] = at[has]
        left = before[at]
        marked[at] = True
        left = left[(left < n) & ~marked[left]]
        marked[at] = False
        enter(np.concatenate([at, left]))
    total = np.concatenate([[0], np.cumsum(alive)])
    return token[alive], total[ends] - total[ends - sizes]


@lru_cache(maxsize=4)
def plain_pattern(pattern: str) -> re.Pattern | None:
    """The pattern for the standard library, which is faster; it has no \\p classes. Equal on ordinary text."""
    plain = (pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)")
             .replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d"))
    return None if r"\p" in plain else re.compile(plain)


def ordinary(texts: list[str]) -> bool:
    """No character that the two libraries class differently: numbers that are no digits, separators."""
    odd = {c for c in set().union(*texts) if "\x1c" <= c <= "\x1f" or c.isnumeric() and not (c.isalpha() or c.isdecimal())}
    return not odd


def encode_block(texts: list[str], table: Ranks, pattern: regex.Pattern) -> list[np.ndarray]:
    """Ids of each text. A word that is itself a token is that token."""
    find = (plain_pattern(pattern.pattern) if ordinary(texts) else None) or pattern
    cut = [find.findall(t) for t in texts]
    place: dict[str, int] = defaultdict(count().__next__)
    used = np.fromiter(map(place.__getitem__, chain.from_iterable(cut)), dtype=np.int64)
    raw = [w.encode() for w in place]
    whole = np.array([table.ranks.get(w, -1) for w in raw], dtype=np.int64)
    ids, sizes = replay([w for w, known in zip(raw, whole.tolist()) if known < 0], table)
    parts = np.ones(len(raw), dtype=np.int64)
    parts[whole < 0] = sizes
    flat = np.empty(parts.sum(), dtype=np.int64)
    start = np.cumsum(parts) - parts
    flat[start[whole >= 0]] = whole[whole >= 0]
    flat[ragged(start[whole < 0], sizes)] = ids
    out = flat[ragged(start[used], parts[used])]
    bounds = np.concatenate([[0], np.cumsum(parts[used])])
    words = np.concatenate([[0], np.cumsum([len(c) for c in cut])])
    edges = bounds[words]
    return [out[a:b] for a, b in zip(edges[:-1], edges[1:])]


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_CHARS) -> Iterator[tuple[pa.Array, list[str]]]:
    """Keys and texts, over the batches' ends, in blocks that close once they reach ``limit`` characters."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1).to_pylist()):
            keys.append(key)
            texts.append(text)
            size += len(text)
            if size >= limit:
                yield pa.array(keys, batch.schema.types[0]), texts
                keys, texts, size = [], [], 0
        kind = batch.schema.types[0]
    if keys:
        yield pa.array(keys, kind), texts


def encoded(docs: DataFrame, path: str, pattern: str, each=None, schema: str = "ids array<int>") -> DataFrame:
    """(doc_id, ids) of every document; ``each(ids, table)`` may return other columns instead."""
    row = each or (lambda ids, table: (ids.tolist(),))
    out = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {schema}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load(path)
        cut = regex.compile(pattern)
        for keys, texts in blocks(batches):
            rows = [row(x, table) for x in encode_block(texts, table, cut)]
            yield pa.RecordBatch.from_arrays(
                [keys, *[pa.array(list(c), t) for c, t in zip(zip(*rows), types)]], names=["doc_id", *names])

    fields = docs.sparkSession.createDataFrame([], schema).schema.fields
    names, types = [f.name for f in fields], [to_arrow_type(f.dataType) for f in fields]
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, out)


def _report_row(ids: np.ndarray, table: Ranks) -> tuple:
    return (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
            hashlib.sha256(table.decode(ids)).hexdigest())


def report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Number of ids, digest of the ids, digest of the bytes they decode to."""
    return encoded(docs, path, pattern, _report_row, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def decoded(ids: DataFrame, path: str) -> DataFrame:
    """(doc_id, bytes) of (doc_id, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load(path)
        for batch in batches:
            texts = [table.decode(np.array(x or [], dtype=np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["doc_id", "bytes"])

    kind = ids.schema["doc_id"].dataType.simpleString()
    return ids.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, bytes binary")
