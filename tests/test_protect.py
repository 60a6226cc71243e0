import re

from hypothesis import given, settings
from hypothesis import strategies as st

from bitloom import config
from bitloom.functions import protect


def sequential(text, patterns):
    """Plain reading of the rule: pattern after pattern, first occurrence of each new placeholder."""
    tokens = {}
    for pattern, template in patterns:
        for found in [m.group(0) for m in re.finditer(pattern, text)]:
            if found not in tokens.values():
                token = template.replace("#", str(len(tokens)))
                tokens[token] = found
                text = text.replace(found, token, 1)
    return text, list(tokens.items())


ROWS = ["", "plain", "{1} {1} {2}", "${a} {a.b} ${a.b}", "%s %% %d %s", r"line\nbreak\ttab\n", "{1}{2}{name}", "{a\nb}", "{}", "$x {1}%s"]


def test_protect_rows(column):
    for patterns in (config.PIPELINE_PATTERNS, config.GUARD_PATTERNS):
        got = column(lambda c: protect.protect_placeholders(c, patterns), *ROWS)
        assert [(r["text"], [tuple(t) for t in r["tokens"]]) for r in got] == [sequential(r, patterns) for r in ROWS]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet="{}%sd$ab1\\nt ", max_size=25), min_size=40, max_size=60))
def test_restore_undoes_protect(column, texts):
    both = column(lambda c: protect.restore(protect.protect_placeholders(c)["text"],
                                            protect.protect_placeholders(c)["tokens"]), *texts)
    assert both == texts
    got = column(protect.protect_placeholders, *texts)
    assert [r["text"] for r in got] == [sequential(t, config.PIPELINE_PATTERNS)[0] for t in texts]


def test_terms(column):
    got = column(protect.protect_terms, "USB-C and USB via Wi-Fi", "none")
    assert got[0]["text"] == "__TERM_0__ and __TERM_2__ via __TERM_1__"
    assert [t["original"] for t in got[0]["tokens"]] == ["USB-C", "Wi-Fi", "USB"] and got[1]["tokens"] == []
    back = column(lambda c: protect.restore(protect.protect_terms(c)["text"], protect.protect_terms(c)["tokens"]), "USB-C USB USB")
    assert back == ["USB-C USB USB"]


def test_preprocess_and_postprocess(column):
    assert column(lambda c: protect.preprocess(c)["text"], "", "a  –  ready for {1}....") == [
        "", "a - __READY_FOR__ __PLACEHOLDER_NUM_0__..."]
    cfg = config.PreprocessConfig(False, False, False, False, False, False, 2)
    assert column(lambda c: protect.preprocess(c, cfg)["text"], "a – {1} b") == ["a –"]

    def cycle(c):
        state = protect.preprocess(c)
        return protect.postprocess(state["text"], state["tokens"])
    assert column(cycle, "Ready For {1} and %s") == ["Ready For {1} and %s"]
