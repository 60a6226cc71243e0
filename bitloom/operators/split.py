"""Reproducible splits keyed by a hash of the sample id.

The key is ``md5(seed:sample_id)``. Threshold splits are one filter. Exact-size splits find the keys
of all wanted ranks by counting keys per hexadecimal prefix, so no row is moved or sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitloom.operators.ranks import value_of_rank

_STEP = 4  # hexadecimal digits counted per job


def split_key(seed: int = 42, id_col: str = "sample_id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col)).cast("binary"))


def split_fraction(seed: int = 42, id_col: str = "sample_id") -> Column:
    """Number in [0, 1) from the first 52 bits of the key."""
    bits = F.conv(F.substring(split_key(seed, id_col), 1, 13), 16, 10).cast("long")
    return bits.cast("double") / float(2 ** 52)


def _check(ratios: list[float]) -> None:
    if abs(sum(ratios) - 1.0) >= 1e-6:
        raise ValueError(f"split ratios must sum to 1, got {ratios}")


def _assign(value: Column, bounds: list, names: list[str]) -> Column:
    part = F.lit(names[-1])
    for bound, name in reversed(list(zip(bounds, names))):
        part = F.when(value < bound, name).otherwise(part)
    return part


def split_by_hash(df: DataFrame, ratios: dict[str, float], seed: int = 42) -> DataFrame:
    """Adds ``split``; sizes are approximate and stay stable while the table grows."""
    names, shares = list(ratios), list(ratios.values())
    _check(shares)
    bounds, total = [], 0.0
    for share in shares[:-1]:
        total += share
        bounds.append(F.lit(total))
    return df.withColumn("split", _assign(split_fraction(seed), bounds, names))


def _boundaries(keys: DataFrame, ranks) -> tuple[int, list]:
    """Number of rows and, for every wanted rank, the key with so many smaller ones (None: the end).

    ``ranks`` maps the number of rows to the wanted ranks. Three jobs serve all of them: counts of the
    first 16 bits of the keys, of the next 16 where a rank lies, and the few keys that are left there.
    A rank that lies inside of equal keys has no exact boundary: the ids repeat, which raises.
    """
    bits = F.conv(F.substring("key", 1, 2 * _STEP), 16, 10).cast("long")
    first = F.shiftright(bits, 4 * _STEP)
    counts = {r["b"]: r["count"] for r in keys.groupBy(first.alias("b")).count().collect()}  # at most 16**4
    total = sum(counts.values())
    wanted = [r for r in ranks(total) if r < total]
    narrowed = _holding(counts, wanted)
    # at most 16**4 counts per rank
    near = keys.where(first.isin([b for b, _ in narrowed])) if narrowed else keys.limit(0)
    found: dict[int, dict[int, int]] = {}
    for r in near.groupBy(first.alias("b"), bits.alias("c")).count().collect():
        found.setdefault(r["b"], {})[r["c"]] = r["count"]
    second = [_holding(found[b], [left])[0] for b, left in narrowed]
    # keys equal in 32 bits: n / 2**32 by chance; an id that repeats is one row here
    last = keys.where(bits.isin([c for c, _ in second])) if second else keys.limit(0)
    same: dict[int, list] = {}
    for r in sorted(last.groupBy(bits.alias("c"), "key").count().collect(), key=lambda r: r["key"]):
        same.setdefault(r["c"], []).append((r["key"], r["count"]))
    bounds = []
    for c, left in second:
        for key, n in same[c]:
            if left <= 0:
                break
            left -= n
        else:
            key = format(c + 1, f"0{2 * _STEP}x")  # behind all keys that begin so
        if left < 0:
            raise ValueError("the table cannot be split exactly: sample ids repeat at a boundary")
        bounds.append(key)
    return total, bounds + [None] * (len(ranks(total)) - len(wanted))


def _holding(counts: dict[int, int], ranks: list[int]) -> list[tuple[int, int]]:
    """For ascending ranks, the bucket that holds each and the rank inside of it."""
    out, before = [], 0
    order = iter(sorted(counts))
    bucket = next(order, None)
    for rank in ranks:
        while before + counts[bucket] <= rank:
            before += counts[bucket]
            bucket = next(order)
        out.append((bucket, rank - before))
    return out


def split_exact(df: DataFrame, ratios: dict[str, float], seed: int = 42) -> DataFrame:
    """Adds ``split`` with sizes floor(n·share) per part and the rest in the last one.

    Needs unique ``sample_id`` values: sizes are exact, or repeated ids at a boundary raise an error. An
    empty table gives an empty table.
    """
    names, shares = list(ratios), list(ratios.values())
    _check(shares)

    def ranks(n: int) -> list[int]:
        out, total = [], 0
        for share in shares[:-1]:
            total += int(n * share)
            out.append(total)
        return out

    _, bounds = _boundaries(df.select(split_key(seed).alias("key")), ranks)
    # a key above every hexadecimal key where the part reaches the end
    return df.withColumn("split", _assign(split_key(seed), [F.lit(b or "g") for b in bounds], names))


def split_head_tail(df: DataFrame, head_ratio: float = 0.9, order: str = "row_idx", repeat_small: int = 0) -> DataFrame:
    """Ordered split: the first floor(n·ratio) rows train, the rest val.

    Rows of equal order, and those without one (the last), are ordered by their split key, so sizes are
    exact however many tie; repeated ids at the boundary raise an error. ``repeat_small``: tables of at
    most so many rows train on everything and repeat the first max(1, n//5) rows as val.
    """
    at = F.col(order).cast("long")
    n, present = df.agg(F.count(F.lit(1)), F.count(at)).first()
    if n <= repeat_small:
        head = df.orderBy(order).limit(max(1, n // 5))
        return df.withColumn("split", F.lit("train")).unionByName(head.withColumn("split", F.lit("val")))
    head = int(n * head_ratio)
    if head < present:
        bound = value_of_rank(df.select(at.alias("v")).where("v IS NOT NULL"), head)
        below, ties = F.coalesce(at < bound, F.lit(False)), at == bound
    else:
        below, ties = at.isNotNull(), at.isNull()
    left = head - df.where(below).count()
    train = below
    if left:
        _, [key] = _boundaries(df.where(ties).select(split_key().alias("key")), lambda _: [left])
        train = below | F.coalesce(ties & (split_key() < F.lit(key or "g")), F.lit(False))
    return df.withColumn("split", F.when(train, "train").otherwise("val"))
