"""Secret scans over a trigram inverted index, with DataFrame functions only.

Each rule's regular expression gives a Boolean trigram query: a list of clauses (OR), each a set of
trigrams (AND). Postings of these trigrams are intersected by document, the documents that satisfy a
rule's query are verified with the expression itself, and a rule without mandatory trigrams scans every
document.

Null text counts as empty. Documents with equal ids share their postings, which only adds candidates;
null ids are matched null-safely. Repeated rows are scanned each. Offsets count code points. Spans of one
start are in the order of the rules. The work grows with a text's length and, up to a logarithm, with its
matches, so very long texts are whole. An empty table gives an empty table; columns of any other name are
kept as they are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from re import _constants as sre
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitloom.functions import text as tx
from bitloom.llm.common import whole_text


@dataclass(frozen=True)
class Rule:
    """A pattern; matches are dropped unless ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    any_case: bool = False

    @property
    def java(self) -> str:
        return ("(?i)" if self.any_case else "") + self.pattern


BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         12, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    # a run of 16 or more is what `[0-9a-f]+` leaves after the length test
    Rule("hex", r"[0-9a-f]{16,}", 16),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opusr]_[A-Za-z0-9]{36,}"),
)

_BRANCHES = 64  # alternatives followed per pattern; beyond it a part counts as unknown, which only widens


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Clauses of lower-case trigrams, one of which every match contains in full; [] if there is none.

    An alternative is a tuple of known fragments; the last one is still growing.
    """
    def follow(nodes, alts):
        for op, arg in nodes:
            alts = step(op, arg, alts)
        return alts

    def cut(alts):
        return list({(*a, "") for a in alts})

    def grow(alts, letters):
        if len(alts) * len(letters) > _BRANCHES:
            return cut(alts)
        return [(*a[:-1], a[-1] + c) for a in alts for c in letters]

    def step(op, arg, alts):
        if op is sre.LITERAL:
            return grow(alts, [chr(arg)])
        if op is sre.IN and all(o is sre.LITERAL for o, _ in arg):
            return grow(alts, [chr(c) for _, c in arg])
        if op is sre.SUBPATTERN:
            return follow(arg[3], alts)
        if op is sre.BRANCH:
            parts = [follow(b, alts) for b in arg[1]]
            return sum(parts, []) if sum(map(len, parts)) <= _BRANCHES else cut(alts)
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = arg
            if (low, high) == (0, 1):
                both = alts + follow(body, alts)
                return both if len(both) <= _BRANCHES else cut(alts)
            if low and low == high and low <= 8:
                return reduce(lambda a, _: follow(body, a), range(low), alts)
            return cut(follow(body, alts)) if low else cut(alts)
        return cut(alts)

    clauses = {frozenset(f.lower()[i:i + 3] for f in alt for i in range(len(f) - 2))
               for alt in follow(parser.parse(pattern), [("",)])}
    if frozenset() in clauses:
        return []
    return sorted((c for c in clauses if not any(d < c for d in clauses)), key=sorted)


_RARE = "zqxjkvbpgyfmwculdrhsnioate"  # letters of Western texts, rare ones first


def _lead(clause: frozenset[str]) -> str:
    """The trigram of a clause that few texts hold, by its letters."""
    place = lambda c: _RARE.find(c) if c in _RARE else -1
    return min(clause, key=lambda t: (sum(map(place, t)), t))


def postings(docs: DataFrame, clauses: list[frozenset[str]]) -> DataFrame:
    """(trigram, doc_id): the index restricted to the clauses, case folded. A clause's rarest trigram is
    looked for in every text, its others only where that one occurs."""
    folded = F.lower(whole_text())
    held = lambda t: F.when(F.contains(folded, F.lit(t)), F.lit(t))
    none = F.array().cast("array<string>")
    by_clause = [F.when(F.contains(folded, F.lit(_lead(c))), F.array(*map(held, sorted(c)))).otherwise(none) for c in clauses]
    found = F.array_distinct(F.array_compact(F.concat(*by_clause)))
    return docs.select("doc_id", F.explode(found).alias("trigram")).select("trigram", "doc_id")


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, kinds): the indexed rules whose trigram query each document satisfies."""
    needs = [(r.kind, k, t, 1 << i, (1 << len(clause)) - 1)
             for r in rules for k, clause in enumerate(trigram_query(r.pattern)) for i, t in enumerate(sorted(clause))]
    # one row per trigram of the rules: fixed by the rules, not by the data
    query = F.broadcast(docs.sparkSession.createDataFrame(
        needs, "kind string, clause int, trigram string, bit long, full long"))
    clauses = sorted({c for r in rules for c in trigram_query(r.pattern)}, key=sorted)
    held = postings(docs, clauses).join(query, "trigram")
    met = held.groupBy("doc_id", "kind", "clause", "full").agg(F.bit_or("bit").alias("bits"))
    return met.where("bits = full").groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


_FAN = 8


def running(values: Column, op) -> Column:
    """Running sums (or maxima) of an array of integers. Each step combines values ``_FAN`` times as far
    apart, as long as the array is that long, so the work is the length times its logarithm."""
    def step(distance: int):
        def combine(a: Column) -> Column:
            def wider(x: Column, i: Column) -> Column:
                for k in range(1, _FAN):
                    earlier = F.get(a, i - F.lit(distance * k))
                    x = op(x, F.coalesce(earlier, F.lit(0)))
                return x
            return F.when(F.size(a) > distance, F.transform(a, wider)).otherwise(a)
        return combine

    distance = 1
    while distance < 1 << 31:  # arrays are no longer
        values = tx.let(values, step(distance))
        distance *= _FAN
    return values


_STEP = "array<struct<rank:int,gap:bigint,size:bigint,value:int>>"


def matches(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's matches in order: characters between the one before and it, its own, those of its group."""
    pattern = F.lit(rule.java)

    def measured(whole: Column) -> Column:
        gaps = F.split(text, rule.java, -1)
        value = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
        zipped = F.arrays_zip(whole.alias("whole"), value.alias("value"),
                              F.slice(gaps, F.lit(1), F.size(whole)).alias("gap"))
        return F.transform(zipped, lambda m: F.struct(
            F.lit(rank).alias("rank"), F.char_length(m["gap"]).cast("long").alias("gap"),
            F.char_length(m["whole"]).cast("long").alias("size"), F.char_length(m["value"]).alias("value")))

    return tx.let(F.regexp_extract_all(text, pattern, F.lit(0)),
                  lambda whole: F.when(F.size(whole) > 0, measured(whole)).otherwise(F.array().cast(_STEP)))


def spans(by_rule: list[Column], rules: tuple[Rule, ...]) -> Column:
    """(start, rank, end, kind) of the matches of all rules that are long enough, sorted by start, then
    rule; code points. One running sum serves all rules: each begins at the sum of those before."""
    least = F.array(*[F.lit(r.least) for r in rules])
    kind = F.array(*[F.lit(r.kind) for r in rules])
    width = lambda m: m["gap"] + m["size"]
    zero = F.lit(0).cast("long")
    totals = lambda parts: F.transform(parts, lambda p: F.aggregate(p, zero, lambda acc, m: acc + width(m)))

    def placed(flat: Column, sums: Column) -> Column:
        def span(m: Column, end: Column) -> Column:
            before = F.aggregate(F.slice(sums, F.lit(1), m["rank"]), zero, lambda acc, x: acc + x)
            return F.struct((end - before - m["size"]).cast("int").alias("start"), m["rank"].alias("rank"),
                            (end - before).cast("int").alias("end"), F.get(kind, m["rank"]).alias("kind"),
                            (m["value"] >= F.get(least, m["rank"])).alias("long"))
        ends = running(F.transform(flat, width), lambda x, y: x + y)
        kept = F.filter(F.zip_with(flat, ends, span), lambda s: s["long"])
        return F.sort_array(F.transform(kept, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"])))

    return tx.let(F.array(*by_rule), lambda parts: tx.let(
        totals(parts), lambda sums: tx.let(F.flatten(parts), lambda flat: placed(flat, sums))))


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that the table lacks."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> tuple[DataFrame, str]:
    """The documents with an array of (start, rank, end, kind), sorted by start, then rule; and the name
    of that column, which no given column has."""
    id_, kinds, found = (_unused(docs, n) for n in ("id_of_candidate", "kinds_of_candidate", "spans_found"))
    indexed = tuple(r for r in rules if trigram_query(r.pattern))
    likely = candidates(docs.select("doc_id", "text"), indexed).withColumnsRenamed({"doc_id": id_, "kinds": kinds})
    joined = docs.join(likely, docs["doc_id"].eqNullSafe(likely[id_]), "left")
    none = F.array().cast(_STEP)
    steps = []
    for rank, rule in enumerate(rules):
        got = matches(whole_text(), rule, rank)
        steps.append(F.when(F.array_contains(kinds, rule.kind), got).otherwise(none) if rule in indexed else got)
    return joined.withColumn(found, spans(steps, rules)).drop(id_, kinds), found


def joined_spans(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


_CHUNK = 1000


def _without(text: Column, found: Column, mark: str) -> Column:
    """The text with every span (sorted by start) replaced; spans that overlap become one mark.

    The text is held in chunks, so cutting a piece out costs its length and a chunk, wherever it lies.
    """
    def cut(chunks: Column) -> Column:
        def piece(low: Column, high: Column) -> Column:
            first, last = F.floor(low / _CHUNK).cast("int"), F.floor(high / _CHUNK).cast("int")
            return F.substring(F.array_join(F.slice(chunks, first + 1, last - first + 1), ""),
                               (low % _CHUNK + 1).cast("int"), (high - low).cast("int"))

        def joined(to: Column) -> Column:
            gaps = F.transform(found, lambda s, i: F.struct(
                F.coalesce(F.get(to, i - 1), F.lit(0)).alias("low"), s["start"].alias("high")))
            kept = F.transform(F.filter(gaps, lambda g: g["high"] >= g["low"]), lambda g: piece(g["low"], g["high"]))
            return F.array_join(F.concat(kept, F.array(piece(F.element_at(to, -1), F.char_length(text)))), mark)

        return tx.let(running(F.transform(found, lambda s: s["end"]), F.greatest), joined)

    return tx.let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0)), cut)


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, mark: str = "<secret>") -> DataFrame:
    """The documents with every found span replaced by ``mark``; overlapping spans become one mark.

    ``n_chars`` follows the text where the column is present; null text stays null.
    """
    text = F.col("text")
    found, name = scan(docs, rules)
    out = found.withColumn("text", F.when(F.size(name) > 0, _without(text, F.col(name), mark)).otherwise(text))
    if "n_chars" in docs.columns:
        changed = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(changed))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """Counts and spans of every document; the digest covers the base rules."""
    base = [r.kind for r in BASE_RULES]
    found, name = scan(docs.select("doc_id", "text"), rules)
    count = lambda kind: F.size(F.filter(name, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(joined_spans(F.filter(name, lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined_spans(F.col(name)).alias("spans"))
