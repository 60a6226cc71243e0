"""Instruction prompts and extraction of the answer from generated text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bitloom import config
from bitloom.functions.text import strip


def _fill(template: str, **values: Column) -> Column:
    """Concatenate the literal pieces of a template with the given columns."""
    pieces = [template]
    for name in values:
        pieces = [part for piece in pieces for part in _cut(piece, "{" + name + "}")]
    filled = [values[p[1:-1]] if p[1:-1] in values and p[0] == "{" else F.lit(p) for p in pieces if p]
    return F.concat(*filled)


def _cut(piece: str, mark: str) -> list[str]:
    before, found, after = piece.partition(mark)
    return [before, found, after] if found else [piece]


def render_prompt(source: Column, target: Column | None = None, template: str = "generic") -> Column:
    """Filled template; without a target the text before the target slot. Unknown names: generic."""
    text = config.PROMPT_TEMPLATES.get(template, config.PROMPT_TEMPLATES["generic"])
    if target is None:
        return _fill(text.split("{target}")[0], source=source)
    return _fill(text, source=source, target=target)


def extract_response(output: Column) -> Column:
    """Text after the first marker that occurs (in list order), else the last line."""
    result = strip(F.element_at(F.split(strip(output), "\n"), -1))
    for start, end in reversed(config.RESPONSE_MARKERS):
        answer = F.substring(output, F.instr(output, start) + len(start), F.char_length(output))
        if end:
            cut = F.substring(answer, F.lit(1), F.instr(answer, end) - 1)
            answer = F.when(F.contains(answer, F.lit(end)), cut).otherwise(answer)
        result = F.when(F.contains(output, F.lit(start)), strip(answer)).otherwise(result)
    return result
