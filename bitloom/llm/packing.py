"""Packing token sequences: shortest pack first over the histogram of lengths.

Every document's ids (and an end id) are cut into pieces of at most ``size``. Only the histogram of
piece lengths, at most ``size`` numbers, reaches the driver. There, lengths are placed from the longest
down into the shortest pack with room, as counts of packing patterns. Each pattern slot then covers a
range of ranks of one length, and the pieces find their slot by their rank among equal lengths.

Null text counts as empty and has the end id only. Rows that repeat an id are packed each for
themselves.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bitloom.llm.bpe import blocks, ordinary, plain_pattern, ragged
from bitloom.llm.common import salts, stored, whole_text

SIZE = 2048
END_ID = 1
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")  # split() cuts there, the tokenizer does not
_BATCH = 200
_KNOWN = 200_000  # strings kept per worker, about 30 MB
BLOCK_CHARS = 2 << 20
_CASES = re.compile("[\u0130\u03a3]")  # lower-cased by context in Python


class Known:
    """Ids of the strings seen so far by a worker; forgotten beyond ``limit`` strings."""

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = defaultdict(count().__next__)
        self.ids = np.zeros(0, dtype=np.uint32)
        self.sizes = np.zeros(0, dtype=np.int64)

    def look_up(self, strings: Iterator[str], new) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all strings one after another and the number of each; ``new`` encodes unseen ones."""
        if len(self.place) > self.limit:
            self.clear()
        before = len(self.sizes)
        used = np.fromiter(map(self.place.__getitem__, strings), dtype=np.int64)
        if len(self.place) > before:
            ids, sizes = new(list(islice(self.place, before, None)))
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        starts = np.cumsum(self.sizes) - self.sizes
        return self.ids[ragged(starts[used], self.sizes[used])], self.sizes[used]


class Words:
    """A tokenizer that drops white space, so that a text's ids are those of its words one after another.

    Where the tokenizer file cuts words by a pattern and its vocabulary marks word ends, the new parts of
    all words are encoded in batches and told apart by these marks; any other word is encoded alone.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        with open(path) as lines:
            steps = json.load(lines)["pre_tokenizer"].get("pretokenizers", [])
        cut = next((s["pattern"]["Regex"] for s in steps if s["type"] == "Split"), None)
        self.cut = cut and plain_pattern(cut.replace(r"[\p{L}]", r"\p{L}").replace(r"[\p{N}]", r"\p{N}"))
        self.words, self.parts = Known(_KNOWN), Known(_KNOWN)

    def alone(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _simple(self, text: str) -> bool:
        """Python lower-cases, normalises and cuts this text as the tokenizer does."""
        return bool(self.cut) and "<|" not in text and (text.isascii() or (
            unicodedata.is_normalized("NFC", text) and not _CASES.search(text))) and ordinary([text])

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and the number of ids of each."""
        if len(words) > 1 and not self._simple("\n".join(words)):
            simple = [self._simple(w) for w in words]
            rest = {i: self.alone(w) for i, (w, s) in enumerate(zip(words, simple)) if not s}
            ids, sizes = self._encode([w for w, s in zip(words, simple) if s])
            out = iter(np.split(ids, np.cumsum(sizes)[:-1]) if len(sizes) else [])
            all_ = [rest[i] if i in rest else next(out) for i in range(len(words))]
            return np.concatenate(all_), np.array([len(x) for x in all_], dtype=np.int64)
        if len(words) == 1 and not self._simple(words[0]):
            ids = self.alone(words[0])
            return ids, np.array([len(ids)])
        return self._encode(words)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = [(w,) if w.isalpha() else self.cut.findall(w) for w in map(str.lower, words)]
        ids, sizes = self.parts.look_up(chain.from_iterable(cut), self._encode_parts)
        groups = np.array(list(map(len, cut)), dtype=np.int64)
        total = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum(groups)
        return ids, total[ends] - total[ends - groups]

    def _encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out, counts = [], []
        for k in range(0, len(parts), _BATCH):
            some = parts[k:k + _BATCH]
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(some)], add_special_tokens=False)[0].ids,
                           dtype=np.uint32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some):
                out.append(ids)
                counts.append(np.diff(ends, prepend=0))
            else:
                single = [self.alone(p) for p in some]
                out += single
                counts.append(np.array([len(x) for x in single]))
        return np.concatenate(out), np.concatenate(counts)


@lru_cache(maxsize=2)
def load(path: str) -> Words:
    return Words(path)


def encode(texts: list[str], path: str) -> list[np.ndarray]:
    """Ids of each text; every distinct word is encoded once."""
    words = load(path)
    whole = {i for i, t in enumerate(texts) if any(c in t for c in _SEPARATORS)}
    cut = [[] if i in whole else t.split() for i, t in enumerate(texts)]
    out, sizes = words.words.look_up(chain.from_iterable(cut), words.encode)
    edges = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(list(map(len, cut)))])]
    parts = [out[a:b] for a, b in zip(edges[:-1], edges[1:])]
    for i in whole:
        parts[i] = words.alone(texts[i])
    return parts


def pieces(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): every document cut into full pieces and a rest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in blocks(batches, BLOCK_CHARS):
            rows = []
            for i, found in enumerate(encode(texts, path)):
                ids = np.append(found, np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), size):
                    part = ids[start:start + size]
                    rows.append((i, start, len(part), zlib.crc32(part.tobytes()), len(ids),
                                 part.astype(np.int32) if with_ids else None))
            at, *columns, raw = map(list, zip(*rows))
            out = [keys.take(pa.array(at)), *[pa.array(c, pa.int64()) for c in columns]]
            yield pa.RecordBatch.from_arrays(out + ([pa.array(raw, pa.list_(pa.int32()))] if with_ids else []), names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, schema + ", ids array<int>" * with_ids)


def shortest_pack_first(histogram: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths in order) and how often each is used."""
    rooms: dict[int, list[tuple[int, tuple]]] = defaultdict(list)  # room left -> (count, pattern)
    open_rooms: list[int] = []  # ascending
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while open_rooms and not rooms[open_rooms[-1]]:
                open_rooms.pop()
            room = open_rooms[-1] if open_rooms and open_rooms[-1] >= length else size
            if room == size:
                used, pattern = left, ()
            else:
                n, pattern = rooms[room].pop()
                used = min(n, left)
                if n > used:
                    rooms[room].append((n - used, pattern))
            left -= used
            rooms[room - length].append((used, (*pattern, length)))
            if room - length not in open_rooms:
                open_rooms.append(room - length)
                open_rooms.sort()
    return [(pattern, n) for room in sorted(rooms) for n, pattern in rooms[room]]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys (length, first rank), with the first sequence and the offset of the ranks from there on."""
    next_rank: dict[int, int] = defaultdict(int)
    rows, base = [], 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            rows.append((_slot_key(length, next_rank[length]), base, offset))
            next_rank[length] += n
            offset += length
        base += n
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def _slot_key(length, rank):
    return length * (1 << 44) + rank


def ranked(found: DataFrame) -> DataFrame:
    """The pieces with ``rank`` among equal lengths, from 0. A frequent length is dealt to salts, each of
    which starts where the one before ends."""
    n = salts(found)
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(n)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
              .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    place = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32"))
    return (salted.withColumn("rank", place - 1).join(starts, ["length", "salt"])
            .withColumn("rank", F.col("rank") + F.col("first")).drop("salt", "first"))


def packed(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """The pieces with their ``sequence_id`` and ``offset`` in it."""
    found = stored(pieces(docs, path, size, end_id, with_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    keys, first, offsets = slots(shortest_pack_first(histogram, size))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            key = _slot_key(frame["length"].to_numpy(), frame["rank"].to_numpy())
            at = np.searchsorted(keys, key, side="right") - 1
            frame["sequence_id"] = first[at] + (key - keys[at])
            frame["offset"] = offsets[at]
            yield frame.drop(columns="rank")

    rows = ranked(found)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "rank")
    return rows.mapInPandas(place, schema + ", sequence_id long, offset long")
