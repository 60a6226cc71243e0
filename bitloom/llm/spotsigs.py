"""Spot signatures with DataFrame functions only.

Every common word (anchor) of a text gives a signature: the anchor and the ``CHAIN`` content words that
follow it, hashed. The set of signatures is the fingerprint, its likeness the Jaccard coefficient.
A text without anchors uses every word as one; a text without words is its own signature; the empty
text has none, and two empty sets are alike.

Null text counts as empty. Rows with a null id come first in the order of ids; rows that repeat an id
are ordered by their text, so each still has one next row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitloom.llm.common import salts, whole_text

CHAIN = 3
# The most common words of English, French, German and Spanish.
ANCHORS = (
    "the of and to in is that for on with as was are be by this at from or an it have has not "
    "le la les de des du un une et en que qui dans pour sur est pas au avec ce il "
    "der die das den dem und zu von mit sich auf für ist im nicht ein eine als auch des "
    "el los las una y a con para por es del se al como su lo más"
).split()


def _is_anchor(word: Column) -> Column:
    return word.isin(*sorted(set(ANCHORS)))


def with_signatures(df: DataFrame, text: str, out: str, chain: int = CHAIN) -> DataFrame:
    """Adds ``out``: the sorted distinct signatures of the text column as 32-bit hashes."""
    w, a, c = "__words", "__anchors", "__content"
    df = df.withColumn(w, F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda x: x != ""))
    # an anchor at word i, the j-th of its kind, has i - j content words before it
    df = df.withColumns({
        a: F.filter(F.transform(w, lambda x, i: F.struct(x.alias("word"), i.alias("at"))), lambda s: _is_anchor(s["word"])),
        c: F.filter(w, lambda x: ~_is_anchor(x))})
    follow = lambda words, at: [F.get(F.col(words), at + k) for k in range(chain)]
    spots = F.transform(a, lambda s, j: F.when(
        F.get(F.col(c), s["at"] - j).isNotNull(), F.hash(s["word"], *follow(c, s["at"] - j))))
    runs = F.transform(w, lambda x, i: F.hash(x, *follow(w, i + 1)))
    some = F.when(F.size(a) > 0, F.array_compact(spots)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(out, some)
    rest = F.when(F.size(w) > 0, runs).when(F.col(text) != "", F.array(F.hash(text))).otherwise(F.col(out))
    return df.withColumn(out, F.array_sort(F.array_distinct(F.when(F.size(out) > 0, F.col(out)).otherwise(rest)))).drop(w, a, c)


def fingerprint(signatures: str) -> Column:
    """The set as text: its members, comma-joined."""
    return F.array_join(F.col(signatures).cast("array<string>"), ",")


def likeness(a: str, b: str) -> Column:
    """Jaccard coefficient of two signature sets; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def length_part(size: Column, threshold: float) -> Column:
    """Number of the length partition: sets at or above the threshold lie in equal or adjacent ones."""
    return F.floor(F.log(F.greatest(size, F.lit(1))) / math.log(1 / threshold) + 1e-9).cast("int")


def _bucket(bounds: list, key: str) -> Column:
    """How many bounds are at or below the key, found in two steps of about a square root each."""
    step = max(1, math.isqrt(len(bounds)))
    chunks = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    if not chunks:
        return F.lit(0)
    number = lambda xs: F.array(*[F.lit(x) for x in xs])
    below = lambda xs: F.size(F.filter(xs, lambda b: b <= F.col(key)))
    chunk = F.greatest(below(number([c[0] for c in chunks])) - 1, F.lit(0))
    return F.when(F.col(key).isNull(), F.lit(0)).otherwise(
        chunk * step + below(F.get(F.array(*[number(c) for c in chunks]), chunk)))


def with_next(df: DataFrame, key: str, columns: list[str], tie: Column) -> DataFrame:
    """Adds next_<column>: the value in the row that follows by key, the first row's after the last.

    Rows are dealt to buckets of neighbouring keys by sampled bounds; each bucket also gets the first row
    of the one after it, so no task orders all rows. At most one number per bucket reaches the driver.
    """
    parts = 2 * salts(df)
    shares = [i / parts for i in range(1, parts)]
    bounds = df.agg(F.percentile_approx(key, shares, max(10_000, 8 * parts)).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    dealt = df.withColumns({"__bucket": _bucket(bounds, key), "__extra": F.lit(False), "__tie": tie})
    firsts = [(r["__bucket"], r["first"][0]) for r in sorted(
        dealt.groupBy("__bucket").agg(F.min(F.struct(key)).alias("first")).collect(), key=lambda r: r["__bucket"])]
    if not firsts:
        return dealt.withColumns({f"next_{c}": F.col(c) for c in columns}).drop("__bucket", "__extra", "__tie")
    leads = [(firsts[(i + 1) % len(firsts)][1], bucket) for i, (bucket, _) in enumerate(firsts)]
    kind = df.schema[key].dataType.simpleString()
    # one row per bucket
    heads = F.broadcast(df.sparkSession.createDataFrame(leads, f"__first {kind}, __to int"))
    extra = (dealt.join(heads, dealt[key].eqNullSafe(heads["__first"]))
             .withColumns({"__bucket": F.col("__to"), "__extra": F.lit(True)}).drop("__first", "__to"))
    order = Window.partitionBy("__bucket").orderBy("__extra", F.col(key).asc_nulls_first(), "__tie")
    rows = dealt.unionByName(extra)
    return (rows.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
            .where(~F.col("__extra")).drop("__bucket", "__extra", "__tie"))


def report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and the next document's."""
    base = with_signatures(docs.select("doc_id", whole_text().alias("text")), "text", "signatures")
    pairs = with_next(base, "doc_id", ["text", "signatures"], F.xxhash64("text"))
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    pairs = pairs.withColumn("edited", F.concat(F.left("text", n - quarter), F.left("next_text", quarter)))
    pairs = pairs.select("doc_id", n.cast("long").alias("n_chars"), "signatures", "next_signatures", "edited")
    both = with_signatures(pairs, "edited", "edited_signatures")
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("signatures").alias("fingerprint"), fingerprint("edited_signatures").alias("edited_fingerprint"),
        likeness("signatures", "edited_signatures").alias("near_edited"),
        likeness("signatures", "next_signatures").alias("near_next"),
        length_part(F.size("signatures"), 0.8).alias("length_part"))


def near_pairs(df: DataFrame, key: str, signatures: str, threshold: float = 0.8) -> DataFrame:
    """Pairs (a, b, likeness) of distinct sets at or above the threshold; a is the smaller key of its set.

    Equal sets are one class first. A set is indexed, in its length partition, under its rarest members:
    two sets above the threshold share one of the first ``n - ceil(t n) + 1``. Only equal and adjacent
    partitions meet, and pairs whose sizes rule the threshold out are pruned before the sets are compared.
    """
    sets = (df.where(F.size(signatures) > 0).groupBy(F.col(signatures).alias("set")).agg(F.min(key).alias("id")))
    members = sets.select("id", F.explode("set").alias("s"))
    counted = members.join(members.groupBy("s").agg(F.count(F.lit(1)).alias("n")), "s")
    ordered = counted.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "s"))).alias("by"))
    size = F.size("by")
    heads = ordered.select(
        "id", size.alias("size"), length_part(size, threshold).alias("part"), F.col("by.s").alias("set"),
        F.explode(F.slice("by", F.lit(1), size - F.ceil(size * threshold - 1e-9).cast("int") + 1)).alias("head"))
    heads = heads.select("id", "size", "part", F.col("head.s").alias("s"))
    left = heads.select(F.col("id").alias("a"), F.col("size").alias("size_a"), "s",
                        F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    right = heads.select(F.col("id").alias("b"), F.col("size").alias("size_b"), "s", "part")
    small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    found = (left.join(right, ["s", "part"]).where((F.col("a") != F.col("b")) & (small >= large * threshold - 1e-9))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    named = lambda k: sets.select(F.col("id").alias(k), F.col("set").alias(f"set_{k}"))
    return (found.join(named("a"), "a").join(named("b"), "b")
            .withColumn("likeness", likeness("set_a", "set_b"))
            .where(F.col("likeness") >= threshold - 1e-12).select("a", "b", "likeness"))
