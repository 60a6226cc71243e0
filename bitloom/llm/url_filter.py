"""URL filters: a Bloom filter cascade over listed hosts, and prefix rules over host and path.

Level 0 encodes the listed keys; each further level encodes the keys of the other kind that the level
before lets through, over the complete set of keys in the corpus. A key's answer is the parity of the
first level that does not hold it, which is exact for every key of that set; no page is joined. A list
whose filters would pass ``MAX_BYTES`` is not broadcast: its hosts are joined with the pages instead, with
the same verdicts.

A null url, or one without ``://``, has an empty host and path. Repeated pages are judged alike, and a
page's other columns are ignored. An empty table or list gives an empty table or no listed host. The
longest fitting rule wins; two of one length cannot fit one page unless they are the same. A url is read
whole, however long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BYTES = 64 << 20  # of all levels together; hosts of a longer list are joined
MAX_LEVELS = 64
_HASHES = 3
_BITS_PER_KEY = 6


def host(url: str = "url") -> Column:
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: str = "url") -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


@dataclass(frozen=True)
class PathRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    PathRule("allow", "org", "/"), PathRule("block", "example.org", "/es/"),
    PathRule("block", "example.org", "/en/1"), PathRule("allow", "com", "/fr/"), PathRule("block", "com", "/de/"),
)

# Labels of hosts that are listed; a host is listed when one of its labels starts with one of these.
LISTED_LABELS = ("adult-", "ads-", "casino-", "cheap-pills", "free-bets", "spam-")


def listed_hosts(hosts: DataFrame, labels: tuple[str, ...] = LISTED_LABELS) -> DataFrame:
    """The listed keys among the hosts: a host list as a provider would deliver it."""
    starts = "|".join(s.replace("-", r"\-") for s in labels)
    return hosts.where(F.col("host").rlike(rf"(^|\.)({starts})"))


def _positions(hashed: np.ndarray, level: int, bits: int) -> np.ndarray:
    """(keys, hashes) bit positions by double hashing of one 64-bit value."""
    with np.errstate(over="ignore"):
        x = hashed.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        step = (x >> np.uint64(32)) | np.uint64(1)
        return (x[:, None] + step[:, None] * np.arange(_HASHES, dtype=np.uint64)) % np.uint64(bits)


def _holds(filter_: np.ndarray, hashed: np.ndarray, level: int) -> np.ndarray:
    at = _positions(hashed, level, len(filter_) * 8)
    return ((filter_[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _member(levels: list[np.ndarray], hashed: np.ndarray) -> np.ndarray:
    """Parity of the first level that rejects: even levels hold listed keys."""
    answer = np.full(len(hashed), len(levels) % 2 == 1)
    open_ = np.ones(len(hashed), dtype=bool)
    for level, filter_ in enumerate(levels):
        left = np.flatnonzero(open_)
        out = left[~_holds(filter_, hashed[left], level)]
        answer[out] = level % 2 == 1
        open_[out] = False
    return answer


def _key(key: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(key), F.lit("")))


def _level(keys: DataFrame, level: int, n: int) -> np.ndarray:
    """A filter over the keys' hashes: bytes are set in the tasks and combined by a bitwise or."""
    size = max(8, -(-n * _BITS_PER_KEY // 8))

    def bits(frames):
        for frame in frames:
            at = np.unique(_positions(frame["hash"].to_numpy(), level, size * 8))
            byte, bit = (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7)).astype(np.int64))
            yield pd.DataFrame({"byte": byte, "bit": bit})

    parts = keys.mapInPandas(bits, "byte long, bit long").groupBy("byte").agg(F.bit_or("bit").alias("bit"))
    out = np.zeros(size, dtype=np.uint8)
    for row in parts.toLocalIterator():  # at most `size` rows, checked against MAX_BYTES
        out[row["byte"]] = row["bit"]
    return out


def build(listed: DataFrame, universe: DataFrame, key: str, max_bytes: int = MAX_BYTES) -> list[np.ndarray] | None:
    """The cascade of the listed keys over the universe, both frames of distinct keys.

    Every level halves at least what is left, so the sizes sum up to a small multiple of the list's.
    None if the filters would exceed ``max_bytes``, or if a listed key and another one have one hash.
    """
    inside = listed.select(_key(key).alias("hash")).distinct()
    n = inside.count()
    if n * _BITS_PER_KEY > 8 * max_bytes:
        return None
    outside = universe.join(listed.select(key), key, "left_anti").select(_key(key).alias("hash")).distinct()
    if n and not outside.join(inside, "hash", "left_semi").isEmpty():
        return None
    levels: list[np.ndarray] = []
    used = 0
    while n:
        used += max(8, -(-n * _BITS_PER_KEY // 8))
        if used > max_bytes or len(levels) == MAX_LEVELS:
            return None
        level = len(levels)
        levels.append(_level(inside, level, n))
        held = F.pandas_udf(_tester(levels[level], level), "boolean")
        inside, outside = outside.where(held("hash")), inside
        n = inside.count()
    return levels


def _tester(filter_: np.ndarray, level: int):
    def held(hashed: pd.Series) -> pd.Series:
        return pd.Series(_holds(filter_, hashed.to_numpy(), level))
    return held


def member(levels: list[np.ndarray], key: str) -> Column:
    """Whether a key of the universe is listed."""
    def test(hashed: pd.Series) -> pd.Series:
        return pd.Series(_member(levels, hashed.to_numpy()))
    return F.pandas_udf(test, "boolean")(_key(key))


def fitting_rule(rules: tuple[PathRule, ...] = RULES) -> Column:
    """The longest rule that fits ``host`` and ``path``, as a struct, else null."""
    out = None
    for rule in sorted(rules, key=lambda r: -len(r.name)):
        fits = (((F.col("host") == rule.host) | F.endswith(F.col("host"), F.lit("." + rule.host)))
                & F.startswith(F.col("path"), F.lit(rule.path)))
        value = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def with_listed(pages: DataFrame, listed: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Adds ``listed``: whether the page's ``host`` is one of the frame's, by the cascade where it fits."""
    universe = pages.select("host").distinct()
    listed = listed.select(F.col("host")).distinct().join(universe, "host", "left_semi")
    levels = build(listed, universe, "host", max_bytes)
    if levels is not None:
        return pages.withColumn("listed", member(levels, "host"))
    return (pages.join(listed.withColumn("listed", F.lit(True)), "host", "left")
            .withColumn("listed", F.coalesce("listed", F.lit(False))))


def judge(pages: DataFrame, labels: tuple[str, ...] = LISTED_LABELS, rules: tuple[PathRule, ...] = RULES,
          listed: DataFrame | None = None, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Every page's host, path, rule and verdict: the rule's, else block for listed hosts.

    ``listed`` is a table with a column ``host`` (lower case; nulls, repeats and hosts of no page do no
    harm); without it the corpus's hosts with one of the ``labels`` are listed.
    """
    parsed = pages.select("page_id", host().alias("host"), path().alias("path"))
    if listed is None:
        listed = listed_hosts(parsed.select("host").distinct(), labels)
    return (with_listed(parsed, listed, max_bytes).withColumn("fit", fitting_rule(rules))
            .select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce("fit.verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict")))
