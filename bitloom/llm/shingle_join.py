"""Join on the Jaccard coefficient of word shingles through a MinHash LSH forest.

A set of shingles (``SHINGLE`` words each, white-space separated, lower case) has one label per tree: a
sequence of min-hashes, which is a path in that tree's trie. Two sets are candidates where their paths
share a prefix. The prefix is shortened from ``MAX_DEPTH`` until a pair right at the threshold meets in
some tree with the target recall. Candidates form coarse clusters, and inside a cluster every pair is
compared exactly, in blocks of two chunks of ``CHUNK`` sets; a block returns counts and a spanning
forest, never its pairs.

Equal sets are one class from the start and counted, not compared. Texts shorter than a shingle are one
shingle; texts without words are alike. Null text counts as empty. Documents that share an id are one
document if their texts are equal, else each keeps its own class; ``near_deduplicated`` then keeps both
if one stays. Rows without an id are told apart by their texts; a class of such rows only has a null
class id. Sets, shingles and texts are told apart by 64-bit hashes. A text is held whole, however long.
Repeated rows are linked like copies. An empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom.llm.common import join_dealt, stored, whole_text
from bitloom.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
TREES = 40
MAX_DEPTH = 16
RECALL = 0.999
CHUNK = 256
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SEED = 20


def prefix_depth(threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL, depth: int = MAX_DEPTH) -> int:
    """The longest prefix that still finds a pair at the threshold with the target recall."""
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_sets(texts: list[str], width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    cut = [t.lower().split() for t in texts]
    place: dict[str, int] = defaultdict(count().__next__)
    used = np.fromiter(map(place.__getitem__, chain.from_iterable(cut)), dtype=np.int64)
    word = np.fromiter(map(xxhash.xxh64_intdigest, place), dtype=np.uint64, count=len(place))[used]
    out, at = [], 0
    with np.errstate(over="ignore"):
        for words in cut:
            own = word[at:at + len(words)]
            at += len(words)
            n = min(width, len(own))
            mixed = np.zeros(max(0, len(own) - n + 1) if n else 0, dtype=np.uint64)
            for k in range(n):
                mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + own[k:k + len(mixed)]
            out.append(np.unique(mixed ^ (mixed >> np.uint64(32))))
    return out


def _functions(number: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(_SEED)
    return (random.integers(0, 1 << 32, number, dtype=np.uint32),
            random.integers(0, 1 << 31, number, dtype=np.uint32) * np.uint32(2) + np.uint32(1))


def labels(sets: list[np.ndarray], trees: int, depth: int) -> np.ndarray:
    """(sets, trees): the hashed prefix of each tree's path."""
    flip, factor = _functions(trees * depth)
    low = np.full((len(sets), trees * depth), np.iinfo(np.uint32).max, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for i, found in enumerate(sets):
            short = (found >> np.uint64(16)).astype(np.uint32)
            for k in range(0, len(short), 4096):
                part = (short[k:k + 4096, None] ^ flip) * factor
                np.minimum(low[i], part.min(axis=0), out=low[i])
        paths = low.reshape(len(sets), trees, depth).astype(np.uint64)
        mixed = np.broadcast_to(np.arange(1, trees + 1, dtype=np.uint64), (len(sets), trees)).copy()
        for k in range(depth):
            mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX + paths[:, :, k]
        return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def _set_id(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes()) - (1 << 63)


def _forest_rows(trees: int, depth: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), width)
            paths = pa.ListArray.from_arrays(
                pa.array(np.arange(0, (len(sets) + 1) * trees, trees), pa.int32()), pa.array(labels(sets, trees, depth).ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([_set_id(s) for s in sets], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()), paths], names=["doc_id", "text_key", "node", "size", "paths"])
    return run


def linked(sets: list[np.ndarray], threshold: float, split: int | None = None) -> np.ndarray:
    """Boolean matrix of the pairs at or above the threshold, without the diagonal.

    With ``split``, only pairs of one set before and one set from that place on.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    shared = seen[column] > 1
    columns, column = np.unique(column[shared], return_inverse=True)
    row = row[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((n, n), dtype=np.float32)
    step = max(256, (1 << 22) // max(1, n))
    for low in range(0, len(columns), step):
        a, b = np.searchsorted(column, [low, low + step])
        part = np.zeros((n, min(step, len(columns) - low)), dtype=np.float32)
        part[row[a:b], column[a:b] - low] = 1
        both += part @ part.T
    out = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-6
    np.fill_diagonal(out, False)
    if split is not None:
        out[:split, :split] = False
        out[split:, split:] = False
    return out


def _roots(pairs: np.ndarray) -> list[int]:
    """Smallest reachable place of each row of a symmetric matrix."""
    root = [-1] * len(pairs)
    for i in range(len(pairs)):
        if root[i] < 0:
            root[i], todo = i, [i]
            while todo:
                for j in np.flatnonzero(pairs[todo.pop()]).tolist():
                    if root[j] < 0:
                        root[j] = i
                        todo.append(j)
    return root


def _block_rows(threshold: float, width: int):
    """Compares the rows of one block after the other; the rows of a block follow each other."""
    def compared(rows: list[tuple]) -> list[tuple[int, int, int]]:
        left, right = rows[0][1], rows[0][2]
        found = dict(zip((r[3] for r in rows), rows))  # repeated rows count once
        rows = sorted(found.values(), key=lambda r: (r[4] != left, r[3]))
        sets = shingle_sets([r[6] for r in rows], width)
        if len(rows) < 2:
            return []
        pairs = linked(sets, threshold, None if left == right else sum(r[4] == left for r in rows))
        copies = np.array([r[5] for r in rows], dtype=np.int64)
        links = pairs @ copies
        return [(r[3], int(n), rows[root][3]) for r, n, root in zip(rows, links, _roots(pairs)) if n]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[tuple] = []
        done: list[tuple[int, int, int]] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if open_ and open_[0][:3] != row[:3]:
                    done += compared(open_)
                    open_ = []
                open_.append(row)
            if done:
                yield _triples(done)
                done = []
        if open_:
            yield _triples(compared(open_))
    return run


def _triples(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "links", "near"])


def coarse_clusters(reps: DataFrame) -> DataFrame:
    """(node, cluster) of the sets that share a prefix with another one, directly or through others."""
    paths = reps.select("node", F.explode("paths").alias("path"))
    meet = paths.groupBy("path").agg(F.min("node").alias("b"), F.max("node").alias("top")).where("b < top").select("path", "b")
    roots = components(paths.join(meet, "path").select(F.col("node").alias("a"), "b"))
    return roots.select("node", F.col("root").alias("cluster")).unionByName(
        roots.select(F.col("root").alias("node"), F.col("root").alias("cluster")).distinct())


def classes(docs: DataFrame, threshold: float = THRESHOLD, width: int = SHINGLE, trees: int = TREES,
            recall: float = RECALL, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, class_id, n_links, n_shingles, kept): the class is named by its smallest doc_id, which stays.

    ``n_links`` counts the other documents at or above the threshold, equal ones included.
    """
    depth = prefix_depth(threshold, trees, recall)
    kind = docs.schema["doc_id"].dataType.simpleString()
    # the text's hash tells rows of one id, or without one, apart
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn("text_key", F.xxhash64("text"))
    rows = stored(texts.mapInArrow(_forest_rows(trees, depth, width),
                                   f"doc_id {kind}, text_key long, node long, size long, paths array<long>"), "forest")
    chosen = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("text_key").alias("key")))
    groups = rows.groupBy("node").agg(F.min("doc_id").alias("first_id"), chosen.alias("chosen"), F.count(F.lit(1)).alias("copies"))
    clusters = coarse_clusters(rows.where("size > 0").dropDuplicates(["node"]).select("node", "paths"))
    # chunks by hash: about `chunk` sets each, whatever the cluster's size
    parts = clusters.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("parts"))
    members = (join_dealt(clusters, parts, "cluster", "node").join(groups, "node")
               .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    blocks = (members.withColumn("other", F.explode(every))
              .select("cluster", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                      "node", "part", "copies", "chosen"))
    held = texts.dropDuplicates(["doc_id", "text_key"])
    with_text = (blocks.join(held, held["doc_id"].eqNullSafe(blocks["chosen.id"])
                             & (held["text_key"] == blocks["chosen.key"]))
                 .select("cluster", "i", "j", "node", "part", "copies", "text"))
    found = stored(
        with_text.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
        .mapInArrow(_block_rows(threshold, width), "node long, links long, near long"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    near = components(found.select(F.col("node").alias("a"), F.col("near").alias("b")))
    named = groups.join(near, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = named.groupBy("root").agg(F.min("first_id").alias("class_id"))
    sets = (join_dealt(named, ids, "root", "node").join(links, "node", "left")
            .select("node", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    return join_dealt(rows.select("doc_id", "node", "size"), sets, "node", "doc_id").select(
        "doc_id", "class_id", "n_links", F.col("size").alias("n_shingles"),
        F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def near_deduplicated(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The document with the smallest id of each class, all columns as given."""
    report = classes(docs, threshold)
    out = (report.groupBy(F.col("doc_id").alias("__id")).agg(F.max("kept").alias("kept"))
           .where("not kept").select("__id"))
    return docs.join(out, docs["doc_id"].eqNullSafe(out["__id"]), "left_anti")
