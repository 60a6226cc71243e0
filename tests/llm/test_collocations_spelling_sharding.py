"""Phrases, spelling variants and shards against brute force: nulls, empty and long texts, ties, repeated
rows, empty tables, extra columns with clashing names."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from bitloom.llm import collocations, sharding, spelling
from bitloom.session import prepare_session

SCHEMA = ("doc_id long, text string, lang string, source string, phrase string, n long, word string, form string, "
          "shard long, slot string, place string, row string, n_chars long")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "p", 7, "w", "f", 99, "slot", "here", "row", None) for i, t, lang, s in rows],
                                 SCHEMA)


@pytest.fixture(scope="module")
def given():
    rng = random.Random(3)
    words = ["New", "york", "the", "Of", "tée", "colour", "color", "colours", "Äpfel", "apfel", "x" * 40]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ", "]) for _ in range(n))
    rows = [(i, text(rng.randrange(1, 60)), rng.choice(["en", "de", None]), rng.choice(["a", "b", "b", None])) for i in range(60)]
    rows += [(60, None, "en", "a"), (61, "", None, None), (62, "  .. \t", "de", "a"), (None, "new york of the colour", "en", "b"),
             (None, None, None, None), (63, "new york. " * 3000, "en", "b"), (64, "of" * 20000, "en", "c"),
             (64, "of" * 20000, "en", "c"), (5, text(9), "en", "a"), (65, "a×b \U0001f600colourİ", "en", "b")]
    return rows + rows[:7]


@pytest.fixture(scope="module")
def docs(spark, given):
    prepare_session(spark)
    return frame(spark, given)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def expected_phrases(rows, least, longest):
    f, total = Counter(), Counter()
    for _, text, lang, _ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            f.update((lang or "und", " ".join(w[i:i + n])) for n in range(1, longest + 1) for i in range(len(w) - n + 1))
    return {k: v for k, v in f.items() if v >= least}, total


def test_phrases(docs, given):
    f, total = expected_phrases(given, 4, 5)
    rows = collocations.phrases(docs, least=4, filter_bits=1 << 18).collect()
    assert {(r["lang"], r["phrase"]): r["n"] for r in rows if r["words"]} == f
    assert len([r for r in rows if r["words"]]) == len(f)
    assert {r["lang"]: r["n"] for r in rows if not r["words"]} == dict(total)
    texts = defaultdict(list)
    for i, t, lang, _ in given:
        texts[i, lang or "und"].append(re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", lower(t)))
    for r in rows:
        if r["words"] > 1:
            assert any(" ".join(w[r["word"]:r["word"] + r["words"]]) == r["phrase"] for w in texts[r["doc_id"], r["lang"]])


def test_a_full_bit_table_changes_nothing(docs, given):
    f, _ = expected_phrases(given, 4, 5)
    rows = collocations.phrases(docs, least=4, filter_bits=1 << 15)  # smallest chunk
    assert {(r["lang"], r["phrase"]): r["n"] for r in rows.collect() if r["words"]} == f


def test_colliding_fingerprints_keep_their_texts(docs, given, monkeypatch):
    """Blocks whose fingerprints agree for all words of one length."""
    monkeypatch.setattr(collocations.Block, "fingerprints", lambda self, n: (
        self.ends[n - 1:] - self.starts[:max(self.n - n + 1, 0)]).astype(np.uint64) if self.n >= n else np.zeros(0, np.uint64))
    block = collocations._block(["en", "de"], [b"ab cd ab xy", b"cd cd ef"])
    prints = block.fingerprints(1)
    at = np.arange(block.n)
    _, pointer, group = np.unique(prints, return_index=True, return_inverse=True)
    assert block.same(at, at[pointer][group], 1).tolist() == [True, False, True, False, False, False, False]


def test_collocations(docs, given):
    least = 6
    f, total = expected_phrases(given, least, 5)
    expected = {}
    for (lang, phrase), a in f.items():
        w = phrase.split(" ")
        if len(w) < 2:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        inside = any(g >= a for (other, longer), g in f.items() if other == lang and longer != phrase
                     and f" {phrase} " in f" {longer} ")
        if not inside:
            expected[lang, phrase] = (a, left, right, total[lang], score)
    found = collocations.phrases(docs, least=least, filter_bits=1 << 18)
    rows = collocations.collocations(found).collect()
    assert {(r["lang"], r["phrase"]): (r["a"], r["l"], r["r"], r["n"], r["score"]) for r in rows} == expected
    assert len(rows) == len(expected) > 20


def test_score_passes_64_bits(spark):
    big = 3_000_000_000_000
    rows = [("en", 0, "", 10 ** 15, 1, 0), ("en", 1, "a", big, 1, 0), ("en", 1, "b", big + 1, 1, 0), ("en", 2, "a b", big - 7, 1, 0)]
    found = spark.createDataFrame(rows, "lang string, words int, phrase string, n long, doc_id long, word long")
    [row] = collocations.collocations(found).collect()
    assert row["score"] == 1000 * (big - 7) * 10 ** 15 // (big * (big + 1))


def test_texts_are_cut_at_marks_only():
    text = b"one two. three four, " * 50 + b"x" * 500 + b" y z" * 200 + b". end"
    parts = list(collocations.in_pieces(text, 64))
    assert b"".join(parts) == text and len(parts) > 10
    cut = lambda b: [p.split() for p in re.split(rb"[.,]", b) if p.split()]
    assert [w for p in parts for w in cut(p)] == cut(text)


def test_no_documents(spark):
    empty = frame(spark, [])
    assert collocations.report(empty).collect() == []
    assert spelling.report(empty).collect() == []
    assert sharding.report(empty).collect() == []


def expected_words(rows):
    n = Counter()
    for i, text, _, _ in rows:
        for run in re.findall("[a-zÀ-ÿ]+", lower(text)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected_variants(n):
    best, count = {}, Counter()
    for w in n:
        around = [v for v in n if near(w, v)]
        count[w] = len(around)
        top = min(around, key=lambda v: (-n[v], v), default=None)
        best[w] = top if top and n[top] >= 2 * n[w] else None

    def root(w):
        while best[w]:
            w = best[w]
        return w
    return {(w, best[w], root(w), n[w], count[w], n.get(best[w])) for w in n}


def test_spelling_report(docs, given):
    rows = spelling.report(docs).collect()
    assert {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in rows} == expected_variants(
        expected_words(given))
    assert len(rows) >= 5


def test_variants_of_many_words(spark):
    rng = random.Random(11)
    n = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 8))): 0 for _ in range(1500)}
    n |= {"z" * 400: 0, "z" * 401: 0, "z" * 200 + "y" + "z" * 199: 0}
    n = {w: rng.choice([1, 2, 4, 8, 16, 33, 70]) for w in n}
    words = spark.createDataFrame([(w, k, "x") for w, k in n.items()], "word string, n long, near string")
    rows = spelling.variants(words).collect()
    assert {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in rows} == expected_variants(n)
    assert len(rows) == len(n)


def test_acceptor_is_minimal():
    words = sorted(a + b for a in ("x", "yy", "zzz") for b in ("ing", "ings", "ed"))
    nodes, stack = {}, [spelling.acceptor(words)]
    while stack:
        node = stack.pop()
        if id(node) not in nodes:
            nodes[id(node)] = node
            stack += [after for letter, after in node.items() if letter]

    def language(node):
        return frozenset({""} if "" in node else set()) | frozenset(
            letter + rest for letter, after in node.items() if letter for rest in language(after))
    assert language(spelling.acceptor(words)) == set(words)
    assert len({language(node) for node in nodes.values()}) == len(nodes)


def test_shards(docs, given):
    rows = sharding.report(docs).collect()
    key = lambda i, t: (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(key(i, t) for i, t, _, _ in given)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1


def test_every_shard_has_the_mixture(spark):
    rows = [(i, f"text {i}", "en", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(2100)]
    placed = sharding.interleaved(frame(spark, rows), shards=7, by="source").collect()
    total = Counter(s for _, _, _, s in rows)
    found = Counter((r["source"], r["shard"]) for r in placed)
    assert all(abs(found[s, k] - n / 7) <= 2 for s, n in total.items() for k in range(7))
    first = [r["doc_id"] for r in sorted(placed, key=lambda r: (r["shard"], r["slot"]))][:300]
    assert sum(a < b for a, b in zip(first, first[1:])) < 250  # shuffled
    again = sharding.interleaved(frame(spark, rows).repartition(13), shards=7).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in again} == {(r["doc_id"], r["shard"], r["slot"]) for r in placed}
    other = sharding.interleaved(frame(spark, rows), shards=7, seed=2).collect()
    assert {(r["doc_id"], r["shard"]) for r in other} != {(r["doc_id"], r["shard"]) for r in placed}
    assert placed[0]["place"] == "here" and placed[0]["row"] == "row"


def test_rows_of_one_key_are_all_placed(spark):
    rows = [(None, "same", None, "a")] * 50 + [(1, None, "en", None)] * 30
    placed = sharding.interleaved(frame(spark, rows), shards=3).collect()
    assert sorted(Counter(r["shard"] for r in placed).values()) == [26, 27, 27]


def test_no_python_in_the_plan(spark, docs):
    plan = sharding.report(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_written_shards(spark, docs, given, tmp_path):
    sharding.write_shards(docs.drop("shard"), str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(given) and {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}
