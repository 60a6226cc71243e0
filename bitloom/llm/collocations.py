"""Phrases whose words occur together: Rabin-Karp fingerprints, level by level.

A block of texts is one array of bytes. Prefix sums of a polynomial over the bytes give every word's
hash, prefix sums of a polynomial over these give the fingerprint of every n-gram, both modulo 2^64 and
without a loop. A block sends (fingerprint, count) of its distinct n-grams, the shuffle adds them up.
Level n counts only n-grams whose two parts of n - 1 words may be frequent: the frequent fingerprints of
the level before are a bit table of a fixed size (``FILTER_BITS``). A full table lets more n-grams
through and changes no result.

A last scan keeps per block a pointer to the first place of every fingerprint that may be frequent and
compares the bytes of all other places with the bytes there; what differs is a phrase of its own. Only
these phrases become text, combined per task, with their counts and the place (id, number of the word in
the text) of the first; grouping by the text gives exact counts, so colliding fingerprints cost work and
never a result. Single words are counted by their text at once.

Null text counts as empty, a null language as ``und``. Texts are cut at marks into pieces before they
are blocked, so a text is as long as it likes; one piece is held by a task. Repeated rows count as often
as they occur. Phrases of equal score are ordered by count, then by bytes. An empty table gives an empty
table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from bitloom.llm.bpe import ragged
from bitloom.llm.common import salts, stored, whole_text

LONGEST, LEAST, TOP, COVERED = 5, 100, 2000, 100
SCALE = 1000
UNKNOWN = "und"
FILTER_BITS = 1 << 25  # 4 MB; more bits let fewer n-grams through where millions are frequent
BLOCK_BYTES = 2 << 20
HELD = 100_000  # phrases that a task combines before it sends them on
_CHUNK = 32768  # bits of one bitmap of bitmap_construct_agg
_BYTE_BASE, _WORD_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

_WORD, _SPACE, _CUT = 0, 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = _SPACE
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _CUT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


class Powers:
    """Powers of a base and of its inverse, as many as asked for so far."""

    def __init__(self, base: np.uint64):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (np.concatenate([[np.uint64(1)], np.full(size - 1, b)]).cumprod(dtype=np.uint64)
                                  for b in (self.base, _inverse(self.base)))
        return self.up[:n], self.down[:n]


_BYTE_POWERS, _WORD_POWERS = Powers(_BYTE_BASE), Powers(_WORD_BASE)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Block:
    """Words of a block: their bytes (one space after each), hashes, pieces and languages."""

    def __init__(self, texts: list[bytes], salts: np.ndarray):
        """``salts``: one number per text, by its language, that goes into its fingerprints."""
        raw = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
        kind = _KIND[raw]
        edge = np.flatnonzero(np.diff((kind == _WORD).view(np.int8), prepend=0, append=0))
        starts, ends = edge[0::2], edge[1::2]
        self.n = len(starts)
        sizes = ends - starts
        self.text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
        cuts = np.cumsum(kind == _CUT, dtype=np.int32)
        self.piece = cuts[starts] if self.n else np.zeros(0, np.int32)
        self.ends = np.cumsum(sizes + 1)
        self.starts = self.ends - sizes - 1
        self.bytes = raw[ragged(starts, sizes + 1)]
        self.ends -= 1
        self.bytes[self.ends] = 0x20
        self.raw = self.bytes.tobytes()
        up, down = _BYTE_POWERS.of(len(raw) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], dtype=np.uint64)])
        word = mixed((total[ends] - total[starts]) * down[starts] + sizes.astype(np.uint64))
        self.up, self.down = _WORD_POWERS.of(self.n + 1)
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word * self.up[:self.n], dtype=np.uint64)])
        self.salt = salts[self.text]

    def fingerprints(self, n: int) -> np.ndarray:
        """Of the n words from each word on, wherever the block has n more."""
        last = max(self.n - n + 1, 0)
        value = (self.total[n:n + last] - self.total[:last]) * self.down[:last]
        return mixed(value + mixed(self.salt[:last] * np.uint64(31) + np.uint64(n)))

    def inside(self, n: int) -> np.ndarray:
        """Whether these n words lie in one piece."""
        last = max(self.n - n + 1, 0)
        return self.piece[:last] == self.piece[n - 1:n - 1 + last]

    def possible(self, n: int, frequent: np.ndarray | None) -> np.ndarray:
        """Places of n-grams whose parts of n - 1 words have their bits set."""
        here = self.inside(n)
        if frequent is not None and len(here):
            part = is_set(frequent, self.fingerprints(n - 1))
            here &= part[:len(here)] & part[1:1 + len(here)]
        return np.flatnonzero(here)

    def same(self, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
        """Whether the n words from a on and from b on have equal bytes."""
        size = self.ends[a + n - 1] - self.starts[a]
        equal = size == self.ends[b + n - 1] - self.starts[b]
        at = np.flatnonzero(equal)
        if len(at):
            differ = self.bytes[ragged(self.starts[a[at]], size[at])] != self.bytes[ragged(self.starts[b[at]], size[at])]
            equal[at] = np.add.reduceat(differ, np.cumsum(size[at]) - size[at], dtype=np.int64) == 0
        return equal

    def phrase(self, at: int, n: int) -> bytes:
        return self.raw[self.starts[at]:self.ends[at + n - 1]]


def is_set(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    bit = prints & np.uint64(len(bits) * 8 - 1)
    return (bits[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def in_pieces(text: bytes, limit: int = BLOCK_BYTES) -> Iterator[bytes]:
    """The text in parts of about ``limit`` bytes, cut at marks only."""
    start = 0
    while len(text) - start > limit:
        kinds = _KIND[np.frombuffer(text, np.uint8, limit, start)]
        cuts = np.flatnonzero(kinds == _CUT)
        if len(cuts):
            end = start + int(cuts[-1]) + 1
        else:
            end = len(text)
            for at in range(start + limit, len(text), limit):
                later = np.flatnonzero(_KIND[np.frombuffer(text, np.uint8, min(limit, len(text) - at), at)] == _CUT)
                if len(later):
                    end = at + int(later[0]) + 1
                    break
        yield text[start:end]
        start = end
    yield text[start:]


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[tuple[list, list[str], list[bytes], list[int]]]:
    """Ids, languages, parts of texts and how many words of its text stand before each part."""
    ids, tongues, texts, before, size = [], [], [], [], 0
    for batch in batches:
        for i, tongue, text in zip(*[c.to_pylist() for c in batch.columns]):
            words = 0
            for part in in_pieces(text, limit):
                ids.append(i)
                tongues.append(tongue)
                texts.append(part)
                before.append(words)
                size += len(part)
                if len(text) > limit:
                    words += int((np.diff((_KIND[np.frombuffer(part, np.uint8)] == _WORD).view(np.int8), prepend=0) == 1).sum())
                if size >= limit:
                    yield ids, tongues, texts, before
                    ids, tongues, texts, before, size = [], [], [], [], 0
    if texts:
        yield ids, tongues, texts, before


def _block(tongues: list[str], texts: list[bytes]) -> Block:
    salt = {name: int.from_bytes(blake2b(name.encode(), digest_size=8).digest()) for name in set(tongues)}
    return Block(texts, np.array([salt[t] for t in tongues], np.uint64))


def _inputs(docs: DataFrame, lang: str) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"),
                       whole_text().cast("binary").alias("text"))


def counted(docs: DataFrame, n: int, frequent=None, least: int = LEAST, lang: str = "lang") -> DataFrame:
    """(print, n): fingerprints of n words that occur ``least`` times or more; collisions count together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if frequent is None else np.frombuffer(frequent.value, np.uint8)
        for _, tongues, texts, _ in blocks(batches):
            block = _block(tongues, texts)
            found, times = np.unique(block.fingerprints(n)[block.possible(n, bits)], return_counts=True)
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times, pa.int64())], names=["print", "n"])

    return (_inputs(docs, lang).mapInArrow(run, "print long, n long").groupBy("print")
            .agg(F.sum("n").alias("n")).where(F.col("n") >= least))


def bit_table(prints: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """One bit per fingerprint in a table of fixed size, built by Spark in chunks of 4 KB."""
    bit = F.col("print").bitwiseAND(F.lit(bits - 1)) + 1
    chunks = (prints.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("chunk"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect())
    table = np.zeros(bits // 8, dtype=np.uint8)
    for row in chunks:  # at most bits / _CHUNK rows
        at = (row["chunk"] - 1) * _CHUNK // 8
        table[at:at + _CHUNK // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return table


def repeated(block: Block, at: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of the phrases of n words at these places, the first place of each and how often it occurs, in
    one turn unless fingerprints collide.

    Places of one fingerprint are compared with the bytes at the first; those that differ go on as
    phrases of their own.
    """
    prints = block.fingerprints(n)
    while len(at):
        _, pointer, group = np.unique(prints[at], return_index=True, return_inverse=True)
        same = block.same(at, at[pointer][group], n)
        yield at[pointer], np.bincount(group[same], minlength=len(pointer))
        at = at[~same]


def _scan(docs: DataFrame, lang: str, sizes: list[int], tables: list) -> DataFrame:
    """(lang, words, phrase, n, place) of all phrases of these sizes, combined per task; tables[n] is the
    bit table of n words. With words of one alone, words 0 counts all words of the language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def rows() -> pa.RecordBatch:
            keys = list(zip(*held)) or [(), (), ()]
            values = list(zip(*held.values())) or [(), (), ()]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys[0], pa.string()), pa.array(keys[1], pa.int32()),
                 pa.array(keys[2], pa.binary()).cast(pa.string()), pa.array(values[0], pa.int64()),
                 pa.array(values[1], id_type), pa.array(values[2], pa.int64())],
                names=["lang", "words", "phrase", "n", "doc_id", "word"])

        for ids, tongues, texts, before in blocks(batches):
            block = _block(tongues, texts)
            first_word = np.searchsorted(block.text, np.arange(len(texts)))
            for n in sizes:
                at = block.possible(n, _bits(tables, n - 1))
                if n < len(tables):
                    at = at[is_set(_bits(tables, n), block.fingerprints(n)[at])]
                for first, times in repeated(block, at, n):
                    if n == 1:  # most words of a block are no other block's: sent on as arrays
                        yield words_of(block, tongues, first, times)
                        continue
                    for p, k in zip(first.tolist(), times.tolist()):
                        t = int(block.text[p])
                        key = (tongues[t], n, block.phrase(p, n))
                        if key in held:
                            held[key][0] += k
                        else:
                            held[key] = [k, ids[t], before[t] + p - int(first_word[t])]
            if 1 in sizes:
                for tongue, size in zip(tongues, np.bincount(block.text, minlength=len(texts)).tolist()):
                    held.setdefault((tongue, 0, b""), [0, None, None])[0] += size
            if len(held) >= HELD:
                yield rows()
        yield rows()

    def words_of(block: Block, tongues: list[str], at: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
        sizes = block.ends[at] - block.starts[at]
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        raw = block.bytes[ragged(block.starts[at], sizes)]
        texts = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array(tongues, pa.string()).take(pa.array(block.text[at])), pa.array(np.ones(len(at), np.int32)), texts,
             pa.array(times.astype(np.int64)), pa.nulls(len(at), id_type), pa.nulls(len(at), pa.int64())],
            names=["lang", "words", "phrase", "n", "doc_id", "word"])

    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (_inputs(docs, lang).mapInArrow(run, f"lang string, words int, phrase string, n long, doc_id {kind}, word long"))


def _bits(tables: list, n: int) -> np.ndarray | None:
    return np.frombuffer(tables[n].value, np.uint8) if 0 < n < len(tables) else None


def _prints_of_words(words: DataFrame) -> DataFrame:
    """(print) of single words (lang, phrase)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tongues, texts = (c.to_pylist() for c in batch.columns)
            block = _block(tongues, [t.encode() for t in texts])
            yield pa.RecordBatch.from_arrays([pa.array(block.fingerprints(1).view(np.int64))], names=["print"])

    return words.select("lang", "phrase").mapInArrow(run, "print long")


def phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, lang: str = "lang",
            filter_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, words, phrase, n, doc_id, word): exact counts of all phrases of 1 to ``longest`` words that
    occur ``least`` times or more in a language, with a place where each of two words or more occurs;
    words 0: the language's number of words."""
    spark = docs.sparkSession
    counts = [F.sum("n").alias("n"), F.min(F.struct("doc_id", "word")).alias("place")]
    words = stored(_scan(docs, lang, [1], []).groupBy("lang", "words", "phrase").agg(counts[0])
                   .where((F.col("n") >= least) | (F.col("words") == 0)), "words")
    tables: list = [None]
    prints = _prints_of_words(words.where("words = 1"))
    for n in range(1, longest + 1):
        table = bit_table(prints, filter_bits)
        if not table.any():
            break
        tables.append(spark.sparkContext.broadcast(table.tobytes()))
        prints = counted(docs, n + 1, tables[n], least, lang)
    longer = (_scan(docs, lang, list(range(2, len(tables))), tables).groupBy("lang", "words", "phrase").agg(*counts)
              .where(F.col("n") >= least))
    return longer.select("lang", "words", "phrase", "n", "place.doc_id", "place.word").unionByName(
        words, allowMissingColumns=True)


def _joined(words, first, last) -> F.Column:
    return F.array_join(F.slice(words, first, last), " ")


def collocations(found: DataFrame, covered: int = COVERED) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score, doc_id, word) of the phrases of two words and more.

    Every cut into two parts has the score floor(1000 a n / (l r)), exact in 38 digits; the lowest one
    counts, and the shortest first part among equals. A phrase inside a longer one that has at least
    ``covered`` percent of its count is dropped; looking one word further suffices, because counts never
    grow with length.
    """
    dealt = salts(found)  # few languages: their rows are dealt to parts
    totals = found.where("words = 0").select("lang", F.col("n").alias("total"),
                                             F.explode(F.expr(f"sequence(0, {dealt - 1})")).alias("salt"))
    parts = found.where("words > 0").select("lang", "phrase", "n")
    longer = found.where("words > 1").withColumn("w", F.split("phrase", " "))
    cuts = (longer.select("lang", "phrase", "words", "w", F.col("n").alias("a"), "doc_id", "word",
                          F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
            .withColumn("left", _joined(F.col("w"), F.lit(1), F.col("k")))
            .withColumn("right", _joined(F.col("w"), F.col("k") + 1, F.col("words") - F.col("k"))))
    scored = (cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
              .join(parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
              .withColumn("salt", F.pmod(F.hash("phrase"), F.lit(dealt))).join(totals, ["lang", "salt"])
              .withColumn("score", F.expr(f"cast({SCALE} * a as decimal(19, 0)) * cast(total as decimal(19, 0))"
                                          " div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")))
    lowest = scored.groupBy("lang", "phrase").agg(
        F.first("words").alias("words"), F.first("a").alias("a"), F.first("total").alias("n"),
        F.first("doc_id").alias("doc_id"), F.first("word").alias("word"),
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = (longer.where("words > 2").select("lang", "n", F.explode(F.array(
        _joined(F.col("w"), F.lit(1), F.col("words") - 1), _joined(F.col("w"), F.lit(2), F.col("words") - 1)))
        .alias("phrase")).groupBy("lang", "phrase").agg(F.max("n").alias("longer")))
    return (lowest.join(inner, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
            .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score", "doc_id", "word"))


def report(docs: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of every language."""
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (collocations(stored(phrases(docs), "phrases")).withColumn("rank", F.row_number().over(order).cast("long"))
            .where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
