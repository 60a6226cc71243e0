"""Spelling variants of a vocabulary: finite-state composition with a one-edit transducer.

Two words one edit apart agree in their first half or in their last half (halves of the shorter one).
Every word goes to the groups of its halves, once as the shorter and once as the longer word. In a group
the agreed half is a path that all its words share; the state behind it is the initial state of the
group. There, an acceptor of the shorter words' remainders is composed with the transducer of one
replacement or one insertion and with the acceptor of all remainders; both acceptors are minimised, and
each accepted pair of paths is a pair of near words. An inserted letter never precedes an equal one of
the shorter word, so no pair has two paths; a pair that agrees in both halves counts in the first only.

A group is as large as the alphabet allows for the other half, whatever the number of words. Groups are
dealt to tasks by their hash and read one after another; a group of one word ends at once.

Null and empty texts have no words; a null id counts as an empty one. Words of equal count tie by code
point. Repeated rows count as often as they occur. An empty table gives an empty table; extra columns
are ignored. The words of one text, however long, are one array of one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom.llm.common import salts, stored, whole_text

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[a-zÀ-ÿ]+"  # behind lower-casing of A-Z
MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
DELETED_OF = 97
_BATCH = 20_000

Node = dict  # letter -> next node; a key "" marks an accepting node


def acceptor(words: list[str]) -> Node:
    """Minimised acceptor of distinct sorted words: equal remainders share their node."""
    root: Node = {}
    known: dict[tuple, Node] = {}
    path = [root]  # nodes along the last word
    last = ""

    def settle(depth: int) -> None:
        while len(path) > depth + 1:
            node = path.pop()
            key = tuple((letter, id(after)) for letter, after in node.items())
            path[-1][last[len(path) - 1]] = known.setdefault(key, node)

    for word in words:
        agree = next((i for i, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))
        settle(agree)
        for letter in word[agree:]:
            node: Node = {}
            path[-1][letter] = node
            path.append(node)
        path[-1][""] = None
        last = word
    settle(0)
    return root


def one_edit(left: Node, right: Node) -> Iterator[tuple[str, str]]:
    """Accepted pairs of the composition left ∘ one replacement or insertion ∘ right.

    States are (left node, right node, letter inserted just before, edits so far); paths are linked lists,
    so long words cost their length once.
    """
    stack = [(left, right, "", False, None)]
    while stack:
        a, b, inserted, edited, path = stack.pop()
        if edited:
            if "" in a and "" in b:
                yield _spelled(path)
            for letter, after in a.items():
                if letter and letter != inserted and letter in b:
                    stack.append((after, b[letter], "", True, (path, letter, letter)))
            continue
        for other, behind in b.items():
            if not other:
                continue
            stack.append((a, behind, other, True, (path, "", other)))
            for letter, after in a.items():
                if letter == other:
                    stack.append((after, behind, "", False, (path, letter, letter)))
                elif letter:
                    stack.append((after, behind, "", True, (path, letter, other)))


def _spelled(path) -> tuple[str, str]:
    one, other = [], []
    while path:
        path, a, b = path
        one.append(a)
        other.append(b)
    return "".join(reversed(one)), "".join(reversed(other))


def near_in_group(first_half: bool, shorter: int, half: str, rests: list[str], counts: list[int]) -> Iterator[tuple]:
    """(word, near, n of near) of one group, rests sorted; both orders of each pair.

    Rests of a last half are spelled backwards, so both kinds of groups read away from the agreed half.
    """
    n = dict(zip(rests, counts))
    short = shorter - len(half)
    left = [r for r in rests if len(r) == short]
    if not left or len(rests) < 2:
        return
    word = (lambda rest: half + rest) if first_half else (lambda rest: rest[::-1] + half)
    for a, b in one_edit(acceptor(left), acceptor(rests)):
        if not first_half and len(b) > len(a) and b[1:] == a:
            continue  # agrees in the first half too
        yield word(a), word(b), n[b]
        if len(b) > len(a):  # replacements are met in both orders
            yield word(b), word(a), n[a]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["word", "near", "near_n"]
    key, rests, counts, found = None, [], [], []

    def grouped():
        nonlocal key, rests, counts
        for batch in batches:
            for *here, rest, n in zip(*[c.to_pylist() for c in batch.columns]):
                if here != key:
                    if len(rests) > 1:
                        yield from near_in_group(*key, rests, counts)
                    key, rests, counts = here, [], []
                rests.append(rest)
                counts.append(n)
        if len(rests) > 1:
            yield from near_in_group(*key, rests, counts)

    for row in grouped():
        found.append(row)
        if len(found) >= _BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=names)
            found = []
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=names)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, near, near_n): both orders of all pairs of words (word, n) that are one edit apart."""
    length = F.length("word")
    groups = (vocabulary.where(length > 0).select("word", F.col("n").cast("long").alias("n"), F.explode(F.array(
        *[F.struct(F.lit(first).alias("first"), (length - less).alias("shorter"))
          for first in (True, False) for less in (0, 1)])).alias("g"))
        .select("word", "n", "g.*").where("shorter > 0")
        .withColumn("h", F.when(F.col("first"), F.expr("shorter div 2")).otherwise(F.expr("shorter - shorter div 2"))))
    cut = groups.select(
        "first", F.col("shorter").cast("int").alias("shorter"),
        F.expr("if(first, left(word, int(h)), right(word, int(h)))").alias("half"),
        F.expr("if(first, substring(word, int(h) + 1), reverse(left(word, int(length(word) - h))))").alias("rest"), "n")
    return (cut.repartition(salts(vocabulary), "first", "shorter", "half")
            .sortWithinPartitions("first", "shorter", "half", "rest")
            .mapInArrow(_near, "word string, near string, near_n long"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of enough code points and occurrences."""
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the end of the chain word, form, form's form, …

    Each round doubles the steps taken, and counts at least double per step, so rounds are few.
    """
    jump = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = jump.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jump = stored(jump.select("word", "root").join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not jump.where("moved").limit(1).count():
            return jump.select("word", "root")


def variants(words: DataFrame, ratio: float = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word (word, n).

    The form is the near word of largest count, smallest in code points among equals, where that count is
    at least ``ratio`` times the word's.
    """
    words = stored(words.select("word", "n"), "vocabulary")
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near"))).alias("best"))
    strong = -F.col("best.minus_n") >= ratio * F.col("n")
    formed = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"),
        F.when(strong, -F.col("best.minus_n")).alias("form_n")), "forms")
    return (formed.join(roots(formed.where("form IS NOT NULL")), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, word): every maximal run of letters of the whole texts, A-Z lower-cased."""
    lowered = F.translate(whole_text(), UPPER, LOWER)
    return docs.select("doc_id", F.explode(F.regexp_extract_all(lowered, F.lit(f"({RUN})"), F.lit(1))).alias("word"))


def misspelled(words: DataFrame, one_of: int = DELETED_OF) -> DataFrame:
    """One of so many runs, chosen by the checksum of id and run, loses the code point that it names."""
    mark = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "word")
    with_mark = words.withColumn("mark", F.crc32(mark.cast("binary")))
    at = "int(mark % length(word))"
    return with_mark.select(F.when(F.col("mark") % one_of == 0, F.expr(
        f"concat(left(word, {at}), substring(word, {at} + 2))")).otherwise(F.col("word")).alias("word"))


def report(docs: DataFrame) -> DataFrame:
    return variants(vocabulary(misspelled(runs(docs))))
