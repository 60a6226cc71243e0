import os

import pytest
from pyspark.sql import functions as F

from bitloom.plans import prepare
from bitloom.sources import cascade, lines, po, sinks, tables

PO = '''msgid ""
msgstr ""
"Content-Type: text/plain; charset=UTF-8\\n"

#: a.c:1
msgid "Open \\"file\\""
msgstr "Bestand \\"openen\\""

msgid "Long "
"line\\n"
msgstr "Lange "
"regel\\n"

msgid "%d file"
msgid_plural "%d files"
msgstr[0] "%d bestand"
msgstr[1] "%d bestanden"

msgid "Same"
msgstr "Same"
msgctxt "menu"
msgid "Untranslated"
msgstr ""

#~ msgid "Old"
#~ msgstr "Oud"
'''


def write(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(text)
    return str(path)


def test_po(spark, tmp_path):
    write(f"{tmp_path}/x/app.nl.po", PO)
    write(f"{tmp_path}/x/other.de.po", 'msgid "A"\nmsgstr "B"\n')
    got = po.parse_catalogues(spark, str(tmp_path), lang="nl").orderBy("row_idx", "sample_id").collect()
    assert [(r["source"], r["target"]) for r in got] == [
        ('Open "file"', 'Bestand "openen"'), ("Long line", "Lange regel"), ("%d file", "%d bestand"),
        ("%d files", "%d bestanden"), ("Old", "Oud")]
    assert got[0]["sample_id"] == "po_x_app.nl_1" and po.parse_catalogues(spark, str(tmp_path)).count() == 6


def test_aligned_lines_over_many_splits(spark, tmp_path):
    n = 4000
    a = write(f"{tmp_path}/a.txt", "".join(f"line {i} é\n" for i in range(n)))
    b = write(f"{tmp_path}/b.txt", "".join(f"regel {i}\n" if i % 10 else " \n" for i in range(n - 7)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = lines.read_aligned(spark, a, b).collect()
        assert lines.read_splits(spark, a).select("block").distinct().count() > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == sum(1 for i in range(n - 7) if i % 10)
    assert all(r["source"] == f"line {r['row_idx']} é" and r["target"] == f"regel {r['row_idx']}" for r in got)


def test_bad_bytes_and_stripped_files(spark, tmp_path):
    write(f"{tmp_path}/en.txt", b"\n\none\xff\ntwo\n\n", "wb")
    write(f"{tmp_path}/nl.txt", "een\n\ndrie\n")
    got = lines.read_aligned_folder(spark, str(tmp_path)).orderBy("row_idx").collect()
    assert [(r["source"], r["target"]) for r in got] == [("one", "een"), ("two", "")]
    assert lines.read_aligned_folder(spark, f"{tmp_path}/none") is None


def test_stem_folder(spark, tmp_path):
    for stem in ("q1", "q2"):
        write(f"{tmp_path}/{stem}_en.txt", f"{stem} a\n\n{stem} c\n")
        write(f"{tmp_path}/{stem}_nl.txt", f"{stem} x\n{stem} y\n{stem} z\n")
    got = {r["sample_id"]: (r["source"], r["target"]) for r in lines.read_stem_folder(spark, str(tmp_path)).collect()}
    assert got == {f"wmt16_batch_{s}_{i}": (f"{s} {a}", f"{s} {b}") for s in ("q1", "q2") for i, a, b in ((0, "a", "x"), (2, "c", "z"))}


def test_cascade(spark, tmp_path):
    base = str(tmp_path)
    assert cascade.load_training(spark, f"{base}/none").count() == len(cascade.SEED_PAIRS)
    write(f"{base}/raw/app.po", 'msgid "A"\nmsgstr "B"\n\nmsgid "C"\nmsgstr "D"\n')
    write(f"{base}/raw/en.txt", "e\nf\n")
    write(f"{base}/raw/nl.txt", "g\nh\n")
    assert cascade.load_training(spark, f"{base}/raw").count() == 4
    assert {r["source"] for r in cascade.load_training(spark, f"{base}/raw", max_samples=3).collect()} == {"A", "C", "e"}
    done = write(f"{base}/train.json", '[{"source":"s","target":"t"},{"source":"u","target":"v","metadata":{"k":"1"}}]')
    rows = cascade.load_training(spark, f"{base}/raw", processed=done).collect()
    assert len(rows) == 2 and {len(r["metadata"]) for r in rows} == {0, 1}
    few = cascade.load_training(spark, f"{base}/raw")
    assert cascade.add_seeds_if_few(few, cascade.seed_pairs(spark), minimum=100).count() == 4 + len(cascade.SEED_PAIRS)
    assert cascade.add_seeds_if_few(few, cascade.seed_pairs(spark), minimum=4).count() == 4


def test_tables(spark):
    df = spark.createDataFrame([(0, " a ", "b"), (1, None, "c")], "row_idx int, `English Source` string, `Reference Translation` string")
    got = tables.pairs_from_columns(df).collect()
    assert [(r["sample_id"], r["source"]) for r in got] == [("challenge_0", "a")]
    with pytest.raises(ValueError):
        tables.pairs_from_columns(df, source_col="missing")
    assert tables.resolve_columns(["x", "Source 1", "English", "Dutch"]) == ("English", "Dutch")
    assert tables.resolve_columns(["one", "two"]) == ("one", "two")
    bench = tables.pivoted_benchmark(spark.createDataFrame([(3, "a", "b")], "id int, en string, nl string"), "en", "nl")
    assert bench.first()["sample_id"] == "flores_3"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", 'q "x"\tt', "l1\nl2", "software")], "sample_id string, source string, target string, domain string")
    sinks.save_samples(df, f"{tmp_path}/t", "tsv")
    assert sinks.read_tsv(spark, f"{tmp_path}/t").first().asDict() == {"source": 'q "x"\tt', "target": "l1\nl2"}
    sinks.save_samples(df, f"{tmp_path}/j")
    assert tables.read_jsonl(spark, f"{tmp_path}/j").first()["target"] == "l1\nl2"
    with pytest.raises(ValueError):
        sinks.save_samples(df, f"{tmp_path}/x", "xml")
    sinks.write_csv_report(df.withColumn("l", F.array(F.lit("a"), F.lit("b"))), f"{tmp_path}/c")
    assert spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{tmp_path}/c").first()["l"] == "a,b"


def test_preparation_jobs(spark, tmp_path):
    a = write(f"{tmp_path}/a.en", "".join(f"one two three {i}\n" for i in range(60)))
    b = write(f"{tmp_path}/a.nl", "".join(f"een twee drie {i}\n" if i % 6 else "kort\n" for i in range(60)))
    job = prepare.CorpusJob(a, b, f"{tmp_path}/out", max_train_samples=40, val_ratio=0.1)
    counts = {r["reject_reason"]: r["n"] for r in prepare.prepare_corpus(spark, job).collect()}
    assert counts == {"empty": 0, "too_short": 10, "too_long": 0, "mismatch": 0}
    sizes = [tables.read_jsonl(spark, f"{tmp_path}/out/{n}.jsonl").count() for n in ("train", "val")]
    assert sizes == [36, 4]
    pairs = lines.read_aligned(spark, a, b).withColumn("target", F.concat("target", F.lit(" {1}")))
    row = prepare.prepare_dataset(spark, pairs, pairs, f"{tmp_path}/set").first()
    assert (row["total_samples"], row["val_samples"], row["test_samples"]) == (54, 6, 60)
    stored = sinks.load_processed(spark, f"{tmp_path}/set", "train").first()
    assert stored["target"].endswith("__PLACEHOLDER_NUM_0__") and stored["metadata"]["original_target"].endswith("{1}")


def test_aligned_folders(spark, tmp_path):
    for side in "ab":
        for file in "12":
            path = tmp_path / side / f"{file}.txt"
            path.parent.mkdir(exist_ok=True)
            path.write_text(f"{side}{file} one\n{side}{file} two\n")
    pairs = lines.read_aligned(spark, str(tmp_path / "a"), str(tmp_path / "b")).collect()
    assert len({r["sample_id"] for r in pairs}) == len({r["row_idx"] for r in pairs}) == 4
    assert all(r["source"][1:] == r["target"][1:] for r in pairs)
    (tmp_path / "b" / "3.txt").write_text("x\n")
    try:
        lines.read_aligned(spark, str(tmp_path / "a"), str(tmp_path / "b"))
        raise AssertionError("unequal sides must fail")
    except ValueError:
        pass


def small_splits(spark, size):
    from contextlib import contextmanager

    @contextmanager
    def held():
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.minPartitionNum", "64")
        try:
            yield
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.minPartitionNum")
    return held()


AWKWARD = ['plain', '', 'a "quoted" word', 'brace } and { in text', '[list], ]', 'line\nbreak', 'tab\t, comma', 'back\\slash \\"',
           '\\', 'é \U0001f600 ü', 'x' * 300, '"', '}"{', "end\\", ' lead']


@pytest.mark.parametrize("layout", ["one line", "pretty", "object per line"])
@pytest.mark.parametrize("size", ["1500", "10000000"])
def test_json_arrays_over_many_splits(spark, tmp_path, layout, size):
    import json
    import random
    rng = random.Random(4)
    objects = [{"source": rng.choice(AWKWARD), "target": rng.choice(AWKWARD), "sample_id": str(i),
                **({"metadata": {"k": rng.choice(AWKWARD)}} if i % 3 == 0 else {})} for i in range(200)]
    for name, part in (("a", objects[:120]), ("b", objects[120:]), ("none", [])):
        text = {"one line": json.dumps(part), "pretty": json.dumps(part, indent=2, ensure_ascii=False),
                "object per line": "[" + ",\n".join(map(json.dumps, part)) + "]\n"}[layout]
        write(f"{tmp_path}/{name}.json", text)
    with small_splits(spark, size):
        got = tables.read_json_array(spark, str(tmp_path)).collect()
        if size == "1500":
            assert records_splits(spark, f"{tmp_path}/a.json") > 5
    assert sorted((int(r["sample_id"]), r["source"], r["target"], tuple(r["metadata"].items())) for r in got) == sorted(
        (int(o["sample_id"]), o["source"], o["target"], tuple(o.get("metadata", {}).items())) for o in objects)


def records_splits(spark, path):
    return lines.read_splits(spark, path, lineSep="}").select("block").distinct().count()


@pytest.mark.parametrize("sep,size", [(",", "900"), ("\t", "2500"), (",", "10000000")])
def test_quoted_tables_over_many_splits(spark, tmp_path, sep, size):
    import csv
    import random
    rng = random.Random(6)
    rows = [tuple(rng.choice(AWKWARD) for _ in range(2)) + (f"h{i}",) for i in range(300)]
    for name, part in (("a", rows[:200]), ("b", rows[200:])):
        with open(f"{tmp_path}/{name}.csv", "w", newline="") as f:
            out = csv.writer(f, delimiter=sep, lineterminator="\r\n" if name == "b" else "\n", quoting=csv.QUOTE_ALL)
            out.writerow(["source", "reference", "hypothesis"])
            out.writerows(part)
    with small_splits(spark, size):
        df = tables.read_translations(spark, str(tmp_path), sep).na.fill("")
        got = [tuple(r) for r in df.collect()]
    assert sorted(got) == sorted(rows)


def test_wrong_header_and_open_quote(spark, tmp_path):
    write(f"{tmp_path}/x.csv", "source,hypothesis,reference\na,b,c\n")
    with pytest.raises(ValueError, match="header"):
        tables.read_translations(spark, f"{tmp_path}/x.csv")
    write(f"{tmp_path}/y.csv", 'source,reference,hypothesis\na,b,c\nd,"e\nf,g,h\n')
    assert tables.read_translations(spark, f"{tmp_path}/y.csv").where("source = 'a'").count() == 1
    write(f"{tmp_path}/z.csv", "source,reference,hypothesis\n")
    assert tables.read_translations(spark, f"{tmp_path}/z.csv").count() == 0


def test_header_check_cuts_no_records(spark, tmp_path):
    from bitloom.sources import records

    for name, head in (("a", "﻿x,y\r\n"), ("b", "x,y\n")):
        (tmp_path / f"{name}.csv").write_text(head + '1,"p\nq"\n2,r\r\n', newline="")
    first = records._first_lines(spark, str(tmp_path))
    assert "MapInArrow" not in first._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["record"] for r in first.collect()) == ["x,y\n", "x,y\r\n"]
    got = records.read_quoted_table(spark, str(tmp_path), spark.range(0).selectExpr("1 x", "'' y").schema, header=True)
    assert sorted(map(tuple, got.collect())) == [(1, "p\nq")] * 2 + [(2, "r")] * 2
    (tmp_path / "c.csv").write_text('"x\n",y\n1,2\n')
    with pytest.raises(ValueError):
        records.read_quoted_table(spark, str(tmp_path), got.schema, header=True)


def test_benchmark_alignment_joins_documents_and_pages(spark, tmp_path):
    from bitloom.plans import pair_queries

    spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(2, "<p>"), (3, "<q>")], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    rows = pair_queries.benchmark_alignment(spark, str(tmp_path)).select("sample_id", "source", "target").collect()
    assert sorted(map(tuple, rows)) == [("flores_1", "a", "nl: a"), ("flores_2", "b", "nl: b"), ("page_2", "b", "<p>")]
