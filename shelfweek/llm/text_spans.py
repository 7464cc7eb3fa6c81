"""Places of pattern matches in a text, from built-in functions only.

``split`` gives what lies between the matches and ``regexp_extract_all`` the matches
themselves; lengths added up give their places. Patterns here use possessive repetition,
which runs as a loop, so a very long match does not exhaust the stack.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 512
_MARK = "\x01"


def _long(value) -> Column:
    return F.lit(value).cast("long")


def _running(values: Column) -> Column:
    """[0, v1, v1 + v2, ...]; copying grows with the array's length."""
    return F.aggregate(
        values,
        F.array(_long(0)),
        lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)),
    )


def running_sums(values: Column) -> Column:
    """[v1, v1 + v2, ...] of an array of longs, in blocks, so that the work stays in
    proportion to the array's length up to some hundred thousand entries."""
    firsts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(_BLOCK))
    blocks = F.transform(firsts, lambda k: _running(F.slice(values, k, _BLOCK)))
    bases = F.slice(
        _running(F.transform(blocks, lambda b: F.element_at(b, -1))), F.lit(1), F.size(blocks)
    )
    return F.flatten(
        F.zip_with(
            blocks,
            bases,
            lambda block, base: F.transform(
                F.slice(block, F.lit(2), F.size(block) - 1), lambda v: v + base
            ),
        )
    )


def matches(text: Column, pattern: str, only_if: Column | None = None) -> tuple[Column, Column]:
    """(between, found): the n + 1 stretches between n matches, and the matches. Texts for
    which ``only_if`` does not hold are taken to have none, without a search."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern)
    if only_if is not None:
        found = F.when(only_if, found).otherwise(F.array().cast("array<string>"))
        between = F.when(only_if, between).otherwise(F.array(text))
    return between, found


def cut_up(text: Column, pattern: str) -> Column:
    """The text cut before and after every match, from one search: matches are set off by a
    character that the text does not hold. Null for a text that holds it."""
    marked = F.regexp_replace(text, F.lit(pattern), F.lit(f"{_MARK}$0{_MARK}"))
    return F.when(~F.contains(text, F.lit(_MARK)), F.split(marked, _MARK))


def matches_of(parts: Column, text: Column, pattern: str) -> tuple[Column, Column]:
    """``matches`` from a column of ``cut_up`` parts; texts without parts are searched."""
    between, found = matches(text, pattern)
    return (
        F.when(parts.isNull(), between).otherwise(F.filter(parts, lambda _, i: i % 2 == 0)),
        F.when(parts.isNull(), found).otherwise(F.filter(parts, lambda _, i: i % 2 == 1)),
    )


def steps(between: Column, found: Column) -> Column:
    """How far each match ends behind the one before it, in code points. ``running_sums`` of
    this, taken from a column of its own, are the matches' ends."""
    return F.zip_with(
        F.slice(between, F.lit(1), F.size(found)),
        found,
        lambda b, m: (F.length(b) + F.length(m)).cast("long"),
    )
