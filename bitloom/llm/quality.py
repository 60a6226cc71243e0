"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. Expectation-maximisation over
the counts of all vote patterns (at most 3 ** labellers, counted over the whole corpus) estimates how
often each labeller is right, which gives each pattern a posterior. The posteriors of a bounded sample
(``TRAINING_ROWS`` rows with the smallest hash) train a linear scorer over the hashed words and word
pairs of the whole text and the steps of the labellers' measures, and the scorer judges every document.

Null text counts as empty. A text without words is rejected: all labellers vote against it. Rows with
the same text get the same score, whatever their ids; ties in the sample's hash are equal rows. A very
long text is measured whole. An empty table gives an empty table. Extra columns are ignored, whatever
their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain, count
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom.llm.common import stored, whole_text
from bitloom.operators.ranks import value_of_rank
from bitloom.llm.spotsigs import ANCHORS

TRAINING_ROWS = 8_000
BLOCK_ROWS = 256
WORD_DIMENSIONS = 1 << 14
STEP_DIMENSIONS = 1 << 12
DIMENSIONS = WORD_DIMENSIONS + STEP_DIMENSIONS
THRESHOLD = 0.5
_SYMBOLS = "*#$%&|<>{}[]^~=+\\@_"
_MARKS = re.compile(r"[^\w\s]+")
_COMMON = frozenset(ANCHORS)

GOOD, BAD, NONE = 1, -1, 0


def measures(text: str) -> dict[str, float]:
    """Shares the labellers and the features look at."""
    words = text.split()
    n = len(words)
    if not n:
        return {"words": 0}
    lower = list(map(str.lower, words))
    return {
        "words": n,
        "symbols": sum(map(text.count, _SYMBOLS)) / len(text),
        "repeats": sum(map(eq, lower, lower[1:])) / n,
        "distinct": len(set(lower)) / n,
        "common": sum(map(_COMMON.__contains__, lower)) / n,
        "capitals": sum(map(str.isupper, words)) / n,
        "shouts": text.count("!") / n,
        "bars": text.count("|") / n,
        "stops": text.count(".") / n,
        "mean_length": (len(text) - n + 1) / n,
    }


def _vote(value: float, good, bad) -> int:
    return GOOD if good(value) else BAD if bad(value) else NONE


def votes(m: dict[str, float]) -> list[int]:
    """One vote per labeller. Ratios over a few words say little, so short texts get fewer votes."""
    if not m["words"]:
        return [BAD] * len(LABELLERS)
    some = m["words"] >= 20
    return [
        _vote(m["symbols"], lambda x: x < 0.01, lambda x: x > 0.03),
        _vote(m["repeats"], lambda x: x < 0.03, lambda x: x > 0.15),
        _vote(m["distinct"], lambda x: some and x > 0.35, lambda x: some and x < 0.2),
        _vote(m["common"], lambda x: x > 0.1, lambda x: some and x < 0.03),
        _vote(m["capitals"], lambda x: some and x < 0.1, lambda x: some and x > 0.4),
        _vote(m["shouts"], lambda x: x < 0.1, lambda x: x > 0.3),
        _vote(m["bars"], lambda x: x < 0.05, lambda x: x > 0.2),
        _vote(m["stops"], lambda x: 0.01 < x < 0.5, lambda x: some and x < 0.004),
    ]


LABELLERS = ("symbols", "repeats", "distinct", "common", "capitals", "shouts", "bars", "stops")


def step_features(text: str, m: dict[str, float]) -> dict[int, float]:
    """Hashed features of the form: runs of marks by frequency, every measure by its step on a log scale."""
    out: dict[int, float] = {}

    def add(token: str, value: float) -> None:
        at = WORD_DIMENSIONS + zlib.crc32(token.encode()) % STEP_DIMENSIONS
        out[at] = out.get(at, 0.0) + value

    add("bias", 1.0)
    if m["words"]:
        for mark, n in Counter(_MARKS.findall(text)).items():
            add(f"mark {mark}", min(1.0, 10 * n / m["words"]))
        for name, value in m.items():
            add(f"{name} {round(2 * np.log2(value + 2 ** -10))}", 1.0)
    return out


def word_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, at, value) of the lower-cased words and pairs of neighbours, in the order of rows.

    A value is log(1 + occurrences); the values of a row have length one.
    """
    cut = [t.lower().split() for t in texts]
    place: dict[str, int] = defaultdict(count().__next__)
    used = np.fromiter(map(place.__getitem__, chain.from_iterable(cut)), dtype=np.int64)
    word = np.fromiter(map(xxhash.xxh64_intdigest, place), dtype=np.uint64, count=len(place))[used]
    row = np.repeat(np.arange(len(cut)), [len(words) for words in cut])
    pair = (word[:-1] * np.uint64(3) + word[1:])[row[:-1] == row[1:]]
    pair ^= pair >> np.uint64(32)
    hashes = np.concatenate([word, pair])
    rows = np.concatenate([row, row[:-1][row[:-1] == row[1:]]])
    key, n = np.unique(rows * WORD_DIMENSIONS + (hashes % np.uint64(WORD_DIMENSIONS)).astype(np.int64), return_counts=True)
    row, value = key // WORD_DIMENSIONS, np.log1p(n)
    length = np.sqrt(np.bincount(row, value ** 2, len(texts)))
    return row, key % WORD_DIMENSIONS, value / length[row]


def features(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The vote pattern of each text and (row, at, value) of all features."""
    found = [measures(t) for t in texts]
    steps = [step_features(t, m) for t, m in zip(texts, found)]
    row, at, value = word_features(texts)
    patterns = ["".join("-0+"[v + 1] for v in votes(m)) for m in found]
    return (patterns, np.concatenate([row, np.repeat(np.arange(len(texts)), [len(s) for s in steps])]),
            np.concatenate([at, np.fromiter(chain.from_iterable(steps), dtype=np.int64)]),
            np.concatenate([value, np.fromiter(chain.from_iterable(s.values() for s in steps), dtype=float)]))


def _voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        patterns = ["".join("-0+"[v + 1] for v in votes(measures(t))) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(patterns, pa.string()), batch.column(1)], names=["votes", "v"])


def _packed_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        patterns, row, at, value = features(batch.column(0).to_pylist())
        order = np.argsort(row, kind="stable")
        cuts = np.searchsorted(row[order], np.arange(1, batch.num_rows))
        ats = np.split(at[order].astype(np.uint16), cuts)
        values = np.split(value[order].astype(np.float32), cuts)
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array(patterns, pa.string()), pa.array([a.tobytes() for a in ats], pa.binary()),
             pa.array([x.tobytes() for x in values], pa.binary())], names=["v", "votes", "at", "value"])


def fit_labellers(patterns: dict[str, int], rounds: int = 100) -> tuple[dict[str, float], np.ndarray]:
    """Posterior of every vote pattern, and each labeller's rates of (bad, good) by class.

    Starts from the majority vote; the rates are smoothed by one vote each. A labeller that votes nothing
    says nothing about the class, so short texts are not held to be bad for their few votes.
    """
    names = list(patterns)
    if not names:
        return {}, np.full((2, len(LABELLERS), 2), 0.5)
    n = np.array([patterns[p] for p in names], dtype=float)
    vote = np.array([["-0+".index(c) for c in p] for p in names], dtype=int).reshape(len(names), -1)
    posterior = np.clip((vote - 1).sum(axis=1) / max(1, vote.shape[1]) / 2 + 0.5, 0.05, 0.95)
    seen = np.eye(3)[vote][:, :, [0, 2]]  # pattern, labeller, (bad, good)
    rates = np.full((2, vote.shape[1], 2), 1 / 2)
    for _ in range(rounds):
        weight = np.stack([n * (1 - posterior), n * posterior])
        prior = (weight.sum(axis=1) + 1) / (n.sum() + 2)
        rates = np.einsum("cp,plv->clv", weight, seen) + 1
        rates /= rates.sum(axis=2, keepdims=True)
        log = np.log(prior)[:, None] + np.einsum("plv,clv->cp", seen, np.log(rates))
        fresh = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        done = np.abs(fresh - posterior).max(initial=0) < 1e-9
        posterior = fresh
        if done:
            break
    return dict(zip(names, posterior.tolist())), rates


def train(rows: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = 100, rate: float = 1.0,
          decay: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels by full gradient steps with per-weight step sizes.

    The rows are gone through in blocks, so working arrays are small beside the features.
    """
    weights = np.zeros(DIMENSIONS)
    if not rows:
        return weights
    blocks = []
    for k in range(0, len(rows), BLOCK_ROWS):
        part = rows[k:k + BLOCK_ROWS]
        blocks.append((np.concatenate([a for a, _, _ in part]), np.concatenate([v for _, v, _ in part]),
                       [len(a) for a, _, _ in part], np.array([t for _, _, t in part])))
    total = len(rows)
    del rows
    squares = np.full(DIMENSIONS, 1e-8)
    for _ in range(rounds):
        slope = decay * weights
        for at, value, sizes, target in blocks:
            row = np.repeat(np.arange(len(sizes)), sizes)
            guess = 1 / (1 + np.exp(-np.bincount(row, weights[at] * value, len(sizes))))
            slope += np.bincount(at, (guess - target)[row] * value, DIMENSIONS) / total
        squares += slope ** 2
        weights -= rate * slope / np.sqrt(squares)
    return weights


def sampled(rows: DataFrame, values: DataFrame, n: int, size: int) -> DataFrame:
    """``size`` of n rows, those of smallest ``v``, a hash of the row; ``values`` holds all rows' v.

    The hash of rank ``size`` is found by counting. Rows of equal hash are equal.
    """
    if n <= size:
        return rows
    bound = value_of_rank(values.select("v"), size - 1)
    below = values.where(F.col("v") < bound).count()
    return rows.where(F.col("v") < bound).unionByName(rows.where(F.col("v") == bound).limit(size - below))


def scored(docs: DataFrame, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, votes, posterior, score) of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", whole_text().alias("text"))
    hashed = texts.select("text", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2).alias("v"))
    voted = stored(hashed.mapInArrow(_voted, "votes string, v long"), "votes")
    patterns = {r["votes"]: r["n"] for r in voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    posterior, _ = fit_labellers(patterns)
    sample = (sampled(hashed, voted, sum(patterns.values()), training_rows)
              .mapInArrow(_packed_features, "v long, votes string, at binary, value binary").collect())
    weights = train([(np.frombuffer(r["at"], np.uint16), np.frombuffer(r["value"], np.float32), posterior[r["votes"]])
                     for r in sorted(sample, key=lambda r: (r["v"], r["votes"]))])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, row, at, value = features(batch.column(1).to_pylist())
            sums = np.bincount(row, weights[at] * value, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.string()), pa.array([posterior[p] for p in found], pa.float64()),
                 pa.array(1 / (1 + np.exp(-sums)))], names=["doc_id", "votes", "posterior", "score"])

    return texts.mapInArrow(judge, f"doc_id {kind}, votes string, posterior double, score double")


def report(docs: DataFrame, threshold: float = THRESHOLD, training_rows: int = TRAINING_ROWS) -> DataFrame:
    return scored(docs, training_rows).withColumn("kept", F.col("score") >= threshold)


def accepted(docs: DataFrame, threshold: float = THRESHOLD, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """The documents that are not rejected, all columns as given. Ids are matched null-safely; of rows
    that share an id, all stay if one is accepted."""
    out = (report(docs, threshold, training_rows).groupBy(F.col("doc_id").alias("__id"))
           .agg(F.max("kept").alias("__kept")).where(~F.col("__kept")).select("__id"))
    return docs.join(out, docs["doc_id"].eqNullSafe(out["__id"]), "left_anti")
