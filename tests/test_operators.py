import hashlib
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from bitloom import config, session
from bitloom.operators import augment, features, filters, glossary, quantiles, ranks, split, stats, store, translate
from bitloom.plans import text_queries

PAIRS = "sample_id string, row_idx long, source string, target string"


def pairs(spark, *rows):
    return spark.createDataFrame([(f"s{i}", i, s, t) for i, (s, t) in enumerate(rows)], PAIRS)


def test_reject_reasons_in_order(spark):
    w = lambda n: " ".join(["w"] * n)
    df = pairs(spark, ("", w(9)), (w(4), w(300)), (w(201), w(9)), (w(10), w(31)), (w(10), w(30)), (w(5), w(5)))
    got = [r["reject_reason"] for r in filters.with_reject_reason(df).orderBy("row_idx").collect()]
    assert got == ["empty", "too_short", "too_long", "mismatch", None, None]
    counts = {r["reject_reason"]: r["n"] for r in filters.reject_counts(filters.with_reject_reason(df.limit(0))).collect()}
    assert counts == dict.fromkeys(config.REJECT_REASONS, 0)


def test_clean_and_identical(spark):
    df = pairs(spark, (" a ", "b"), (None, "b"), ("\t", "b"), ("same", "same "))
    cleaned = filters.clean_pairs(df)
    assert [r["source"] for r in cleaned.orderBy("row_idx").collect()] == ["a", "same"]
    assert filters.drop_identical(cleaned).count() == 1


def test_stats_on_empty_and_small(spark):
    empty = stats.dataset_stats(pairs(spark, ("a", "b")).limit(0)).first()
    assert empty["num_samples"] == 0 and empty["avg_source_length"] == 0 and empty["domain_terms"] == []
    row = stats.dataset_stats(pairs(spark, ("My USB app {1} %s {1}", "x"), ("a A", "y z"))).first()
    assert row["vocab_size_source"] == 6 and row["unique_patterns"] == 2 and row["domain_terms"] == ["app", "usb"]


def test_features_defaults(spark):
    row = features.extract_features(pairs(spark, ("", None))).first()
    assert row["length_ratio"] == 1.0 and row["source_avg_word_length"] == 0 and row["lexical_diversity_source"] == 0
    row = features.extract_features(pairs(spark, ("Ready For USB-C {1} {1} #", "ja ja nee"))).first()
    assert row["num_placeholders"] == 2 and row["placeholder_types"] == ["{1}"] and row["has_special_punctuation"]
    assert row["technical_terms"] == ["ready for", "usb", "usb-c"] and row["has_brand_names"]
    assert row["target_unique_words"] == 2 and len(row) == 22
    counter = translate.token_counter(lambda t: t.split())
    assert features.extract_features(pairs(spark, ("a b", "c")), counter).first()["source_length_tokens"] == 2


def test_exact_quantiles_match_linear_interpolation(spark):
    rng = random.Random(3)
    values = [rng.choice([0.0, 1.5, rng.random() * 100]) for _ in range(501)] + [7.0] * 400
    df = spark.createDataFrame([(v, float(i % 3)) for i, v in enumerate(values)], "a double, b double")
    got = {(r["metric"], r["prob"]): r["quantile"] for r in
           quantiles.exact_quantiles(df, ["a", "b"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    import numpy as np
    for p in (0.0, 0.25, 0.5, 0.9, 1.0):
        assert got["a", p] == pytest.approx(np.quantile(values, p))
        assert got["b", p] == pytest.approx(np.quantile([float(i % 3) for i in range(len(values))], p))
    assert statistics.median(values) == pytest.approx(got["a", 0.5])


@pytest.mark.parametrize("n", [0, 1, 5, 11, 100])
def test_exact_split_sizes(spark, n):
    df = spark.range(n).select(F.concat(F.lit("id"), "id").alias("sample_id"))
    out = split.split_exact(df, {"train": 0.8, "val": 0.1, "test": 0.1})
    got = {r["sample_id"]: r["split"] for r in out.collect()}
    order = sorted(got, key=lambda s: hashlib.md5(f"42:{s}".encode()).hexdigest())
    cut, cut2 = int(n * 0.8), int(n * 0.8) + int(n * 0.1)
    assert [got[s] for s in order] == ["train"] * cut + ["val"] * (cut2 - cut) + ["test"] * (n - cut2)


def test_quantiles_beside_an_outlier(spark):
    """One far value among many: no range of values is one task."""
    import numpy as np
    df = spark.range(200_000).selectExpr("double(id % 100003) AS a").unionByName(
        spark.createDataFrame([(1e15,)], "a double"))
    values = [float(i % 100003) for i in range(200_000)] + [1e15]
    counts = quantiles.value_counts(df, ["a"])
    got = {r["prob"]: r["quantile"] for r in quantiles.quantiles_of_counts(counts, [0.1, 0.5, 0.999, 1.0]).collect()}
    assert got == {p: pytest.approx(np.quantile(values, p)) for p in (0.1, 0.5, 0.999, 1.0)}
    parts = counts.repartitionByRange(8, "metric", "value").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < 0.3 * counts.count()


def test_ranks_inside_equal_and_missing_values(spark):
    df = spark.createDataFrame([("m", 1.0, 3), ("m", 2.0, 1), ("k", 5.0, 1)], "metric string, value double, n long")
    ranks_of = F.array(*[F.struct(F.lit(r).cast("long").alias("rank")) for r in range(5)])
    got = sorted((r["metric"], r["target"]["rank"], r["value"]) for r in quantiles.ranked_values(df, ranks_of).collect())
    assert got == [("k", 0, 5.0), ("m", 0, 1.0), ("m", 1, 1.0), ("m", 2, 1.0), ("m", 3, 2.0)]
    assert quantiles.ranked_values(df.limit(0), ranks_of).collect() == []


def test_repeated_ids_split_exactly_or_raise(spark):
    ten = spark.range(100).select((F.col("id") % 10).cast("string").alias("sample_id"))
    with pytest.raises(ValueError, match="repeat"):
        split.split_exact(ten, {"train": 0.85, "val": 0.15})
    sizes = {r["split"]: r["count"] for r in split.split_exact(ten, {"train": 0.8, "val": 0.2}).groupBy("split").count().collect()}
    assert sizes == {"train": 80, "val": 20}


def test_exact_split_takes_three_jobs(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("sample_id"))
    parts = {f"p{i}": 1 / 20 for i in range(20)}
    tracker, group = spark.sparkContext.statusTracker(), "split-jobs"
    spark.sparkContext.setJobGroup(group, "boundaries")
    try:
        out = split.split_exact(df, parts)
        jobs = len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert jobs <= 6  # three actions, each with a job for its exchange at most
    assert {r["count"] for r in out.groupBy("split").count().collect()} == {150}


def test_head_tail_split_with_ties(spark):
    for rows in ([(5, str(i)) for i in range(100)], [(None if i % 3 else i // 20, str(i)) for i in range(100)]):
        df = spark.createDataFrame(rows, "row_idx long, sample_id string")
        got = split.split_head_tail(df, 0.85).collect()
        assert sum(r["split"] == "train" for r in got) == 85
        worst = max((r["row_idx"] for r in got if r["split"] == "train" and r["row_idx"] is not None), default=0)
        assert all(r["row_idx"] is None or r["row_idx"] >= worst for r in got if r["split"] == "val")
    assert split.split_head_tail(df.limit(0)).count() == 0


def test_hash_split(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("sample_id"))
    sizes = {r["split"]: r["count"] for r in split.split_by_hash(df, {"a": 0.5, "b": 0.5}).groupBy("split").count().collect()}
    assert 900 < sizes["a"] < 1100
    with pytest.raises(ValueError):
        split.split_by_hash(df, {"a": 0.5, "b": 0.4})


@pytest.mark.parametrize("n", [1, 5, 10, 11, 100])
def test_head_tail_split(spark, n):
    df = spark.range(n).select((F.col("id") * 7 + 3).alias("row_idx"))
    sizes = {r["split"]: r["count"] for r in split.split_head_tail(df, repeat_small=10).groupBy("split").count().collect()}
    assert sizes == ({"train": n, "val": max(1, n // 5)} if n <= 10 else {"train": int(n * 0.9), "val": n - int(n * 0.9)})


def test_first_rows_by_rank(spark):
    df = spark.range(500).select((F.col("id") % 250).alias("row_idx"), F.col("id").cast("string").alias("sample_id"))
    rows = sorted(r["row_idx"] for r in ranks.first_rows(df, 101, tie="sample_id").collect())
    assert rows == sorted(i % 250 for i in range(500))[:101]
    gap = df.unionByName(spark.createDataFrame([(None, "x")], "row_idx long, sample_id string"))
    for n in (1, 10, 500, 501, 600):
        got = [r["row_idx"] for r in ranks.first_rows(gap, n).collect()]
        assert len(got) == min(n, 501) and (None in got) == (n > 500)


def test_glossary(spark):
    terms = glossary.glossary_frame(spark)
    words = spark.createDataFrame([(i, w) for i, w in enumerate(["Settings", "boom", "APP"])], "doc_id int, word string")
    got = {r["word"]: r["translation"] for r in glossary.lookup(words, terms).collect()}
    assert got == {"Settings": "instellingen", "boom": None, "APP": "app"}
    assert glossary.known_words(words, terms).count() == 2
    assert [r["word"] for r in glossary.unknown_words(words, terms).collect()] == ["boom"]
    new = spark.createDataFrame([("App", "programma", 1), ("app", "toepassing", 2), ("Boom", "tree", 1)], "term string, translation string, o int")
    merged = {r["term"]: r["translation"] for r in glossary.upsert(terms, new, "o").collect()}
    assert merged["app"] == "toepassing" and merged["boom"] == "tree" and len(merged) == 41


def test_glossary_lookup_never_sorts_by_word(spark, tmp_path, capsys):
    rows = [(i % 40 if i % 7 else None, None if i == 5 else "The " * 30 + f"Word{i % 5} only{i}") for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = text_queries.glossary_lookup(spark, str(tmp_path))
    got = {r["doc_id"]: tuple(r)[1:] for r in found.collect()}
    want = {}
    for i, text in rows:
        for word in (text or "").lower().split():
            want.setdefault(i, []).append(word)
    known = {i: [w for w in words if not w.startswith("only")] for i, words in want.items()}
    assert got == {i: (len(words), len(known[i]), f"<{min(known[i])}>") for i, words in want.items()}
    found.explain()
    plan = capsys.readouterr().out
    # a frequent word's occurrences are dealt to several partitions and stream past the terms
    assert "ShuffledHashJoin" in plan and "Sort [term" not in plan
    assert re.search(r"Exchange hashpartitioning\(term#\d+, term_deal#\d+", plan)


def test_fallback_words(column):
    assert column(glossary.fallback_translation, "My Phone  SETTINGS", "PC", "") == ["my telefoon instellingen", "pc", ""]


def plain_variations(source, target, n):
    import re
    out, marks = [(source, target)], re.findall(r"\{(\d+)\}", source)
    for a, b in zip(marks, marks[1:]):
        a, b = "{%s}" % a, "{%s}" % b
        swap = lambda t: t.replace(a, "__TEMP__").replace(b, a).replace("__TEMP__", b)  # noqa: E731,B023
        if (swap(source), swap(target)) not in out:
            out.append((swap(source), swap(target)))
    return out[:n + 1]


def test_augmentation(spark):
    rows = [("{1} a {2}", "{2} b {1}"), ("x", "y"), ("{1}", "z"), ("{1}{1}", "q"), ("{1}{2}{3}{4}{5}", "{5}{4}{3}{2}{1}")]
    for n in (1, 3):
        out = augment.augment_pairs(pairs(spark, *rows), n).orderBy("row_idx", "variation").collect()
        got = [[(r["source"], r["target"]) for r in out if r["row_idx"] == i] for i in range(len(rows))]
        assert got == [plain_variations(s, t, n) for s, t in rows]


def test_feature_store(spark, tmp_path):
    base = store.FeatureStore(spark, str(tmp_path))
    df = features.extract_features(pairs(spark, ("a", "b"), ("c", "d")))
    assert base.load("none") is None
    base.store("one", df)
    base.store("two", df.repartition(3))
    rows = base.manifest().collect()
    assert {r["name"] for r in rows} == {"one", "two"} and len({r["content_hash"] for r in rows}) == 1
    assert base.load("one").count() == 2
    with pytest.raises(ValueError):
        base.store("../x", df)


def test_guarded_translation(spark):
    def model(text):
        if "fail" in text:
            raise RuntimeError("down")
        return "" if text == "void" else text.replace("go", "ga")

    df = pairs(spark, ("", ""), ("  ", ""), ("go {1} USB", ""), ("fail the app settings {1}", ""), ("void", ""), ("!!! ?", ""))
    out = translate.translate_column(df, model, pause=0.0).orderBy("row_idx").collect()
    assert [r["output"] for r in out] == ["", "", "ga {1} USB", "fail the app instellingen {1}", config.FALLBACK_TEXT, "!!! ?"]
    assert [r["fallback_used"] for r in out] == [False, False, False, True, False, False]
    assert out[0]["warnings"] == ["Empty input"] and out[3]["warnings"] == ["Translation failed: down"]
    assert out[2]["processed_input"] == "go __PLACEHOLDER_NUM_0__ __TERM_0__" and out[5]["warnings"] == [config.WARN_SPECIAL]
    assert out[1]["original_input"] == "  "
    batch = translate.translate_column(df, lambda ts: [t.upper() for t in ts], mode="batch").orderBy("row_idx").collect()
    assert batch[2]["output"] == "GO {1} USB" and not batch[2]["fallback_used"]

    def broken(texts):
        raise RuntimeError("no")
    failed = translate.translate_column(df, broken, mode="batch").collect()
    assert {r["output"] for r in failed} == {config.FALLBACK_TEXT} and all(r["fallback_used"] for r in failed)
    assert translate.guarded(model, pause=0.0)(df).count() == 6


def test_scorer(spark):
    out = translate.add_scores(pairs(spark, ("abc", "a")), lambda rows: [len(s) - len(t) for s, t in rows], ["source", "target"], "x")
    assert out.first()["x"] == 2.0


def test_a_bad_text_of_a_batch_is_found(spark):
    calls = []

    def fn(texts):
        calls.append(len(texts))
        if "bad" in texts:
            raise ValueError("bad text")
        return [t.upper() for t in texts]
    texts = [f"t{i}" for i in range(999)]
    texts.insert(500, "bad")
    rows = translate.bisected(fn, texts)
    assert [r for r in rows if r[1]] == [(None, "bad text")] and rows[0] == ("T0", None) and len(calls) <= 21
    assert translate.bisected(fn, []) == []
    assert [e is None for _, e in translate.bisected(lambda t: t[:1], ["a", "b"])] == [True, True]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, source string")
    out = translate.translate_column(df, lambda t: fn(t), mode="batch").where("fallback_used").collect()
    assert [r["source"] for r in out] == ["bad"]


def test_feature_store_versions(spark, tmp_path):
    from bitloom.operators.store import FeatureStore
    base = FeatureStore(spark, str(tmp_path / "store"))
    assert base.load("x") is None and not base.verify("x")
    rows = spark.createDataFrame([(1, 0.5, ["a"], None), (2, 0.25, [], "z")], "i int, v double, l array<string>, s string")
    base.store("x", rows)
    first = base.manifest().first()
    old = base.load("x")
    base.store("x", rows.where("i = 1"))
    assert base.load("x").count() == 1 and base.verify("x") and base.history().count() == 2
    assert old.count() == 2 and base.manifest().count() == 1
    base.store("x", rows.repartition(3).orderBy(F.desc("i")))
    assert base.manifest().first()["content_hash"] == first["content_hash"] and base.load("x").count() == 2


def test_dataset_stats_reads_once(spark):
    df = pairs(spark, ("Open the USB app {1}", "de app"), ("open", None), (None, "x y z"))
    row = stats.dataset_stats(df).first()
    assert (row["num_samples"], row["max_source_length"], row["max_target_length"]) == (3, 5, 3)
    assert row["avg_source_length"] == 3.0 and row["vocab_size_source"] == 5 and row["domain_terms"] == ["app", "usb"]
    empty = stats.dataset_stats(df.limit(0)).first()
    assert (empty["num_samples"], empty["avg_source_length"], empty["domain_terms"]) == (0, 0.0, [])
