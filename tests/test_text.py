import re
import unicodedata

from pyspark.sql import functions as F

from bitloom.functions import prompts
from bitloom.functions import text as tx

SAMPLES = ["", "   ", "a b", " a b\tc ", "x\x1cy z　", "één  twee\n\n\ndrie", "tab\tstays", " q "]


def test_words_and_strip_follow_python(column):
    assert column(tx.words, *SAMPLES) == [s.split() for s in SAMPLES]
    assert column(tx.strip, *SAMPLES) == [s.strip() for s in SAMPLES]
    spaces = [chr(c) for c in range(0x10000) if chr(c).isspace()]
    assert sorted(tx.SPACE_CHARS) == sorted(spaces)


def test_nfkc_matches_unicodedata_on_every_character(column):
    chars = [chr(c) for c in range(0x20, 0x3000) if unicodedata.category(chr(c)) != "Cn"]
    text = ["".join(chars[i:i + 50]) for i in range(0, len(chars), 50)]
    assert column(tx.nfkc, *text) == [unicodedata.normalize("NFKC", t) for t in text]
    singles = [c for c in chars if ord(c) < 0x300 or 0x2000 <= ord(c) < 0x2100]
    assert column(tx.nfkc, *singles) == [unicodedata.normalize("NFKC", c) for c in singles]


def test_normalisers(column):
    ws = lambda s: re.sub(r"\n+", "\n", re.sub(r" +", " ", s)).strip()
    assert column(tx.normalize_whitespace, *SAMPLES) == [ws(s) for s in SAMPLES]
    assert column(tx.normalize_punctuation, "a–b—c....d..e “q”") == ["a-b-c...d..e “q”"]
    assert column(lambda c: tx.normalize_punctuation(c, True), "“q” ‘r’") == ["\"q\" 'r'"]
    assert column(lambda c: tx.truncate_words(c, 2), "a  b", "a b c", "") == ["a  b", "a b", ""]
    assert column(tx.preview, "x" * 100) == ["x" * 80]


def test_validate_input(column):
    got = column(lambda c: tx.validate_input(c, 10), "", " \t", "fine", "x" * 11, "a\x00b", "!!!a")
    assert [(r["is_valid"], len(r["warnings"])) for r in got] == [
        (False, 1), (False, 1), (True, 0), (False, 1), (True, 1), (True, 1)]
    assert got[3]["warnings"] == ["Input exceeds max length (11 > 10)"]


def test_sanitize_input(column):
    def expected(text, limit=10):
        text = " ".join(unicodedata.normalize("NFKC", text.replace("\x00", "")).split())
        if len(text) > limit:
            text = text[:limit]
            cut = text.rfind(" ")
            if cut > limit * 0.8:
                text = text[:cut]
        return text.strip()

    rows = ["", "a\x00b", "™ x", "abcdefghi jkl", "abcdefgh ijkl", "abcd efghijkl", "abcdefghijkl", "  a   b  "]
    assert column(lambda c: tx.sanitize_input(c, 10), *rows) == [expected(r) for r in rows]


def test_terms_and_features(column):
    got = column(lambda c: tx.contained_terms(c, ["ai", "usb", "usb-c"], lower=True), "maintain", "USB-C", "none")
    assert got == [["ai"], ["usb", "usb-c"], []]
    whole = column(lambda c: tx.contained_terms(c, ["ai", "usb"], lower=True, word_boundary=True), "maintain AI")
    assert whole == [["ai"]]
    row = column(tx.language_features, "Tap {x} on https://a.b 5 %s ©")[0]
    assert all(row[f] for f in ("has_placeholders", "has_percent_vars", "has_numbers", "has_urls", "has_special_chars"))
    assert not row["has_brand_names"] and row["length_words"] == 7


def test_unescape_po(column):
    assert column(tx.unescape_po, r' say \"hi\"\nnow ') == ['say "hi" now']
    assert column(lambda c: tx.unescape_po(c, "\n"), r"a\nb") == ["a\nb"]


def test_prompts(column):
    pair = lambda s, t: prompts.render_prompt(s, t, "gpt2")
    assert column(pair, ("50% {target}", "x")) == ["Translate English to Dutch:\nEnglish: 50% {target}\nDutch: x"]
    assert column(lambda s: prompts.render_prompt(s, template="unknown"), "hi")[0].endswith("### Response: ")
    outputs = ["### Response: Hallo ", "[INST] q [/INST] Dag</s> rest", "Instruct: a\nOutput: b", "x\nlast line", "Dutch: z"]
    assert column(prompts.extract_response, *outputs) == ["Hallo", "Dag", "b", "last line", "z"]


def test_language_columns_need_no_python(spark):
    df = spark.createDataFrame([("a",)], "t string").select(
        tx.language_features(F.col("t")).alias("f"), tx.validate_input(F.col("t")).alias("v"))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan
