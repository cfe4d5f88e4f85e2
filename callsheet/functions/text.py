"""Text predicates and small string helpers (Column in, Column out)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from callsheet.functions.regex import SPACE, TRIM, any_of


def strip(c: Column) -> Column:
    """Trim Unicode white space on both ends."""
    return F.regexp_replace(c, TRIM, "")


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def blank_row(*cols: Column) -> Column:
    """True when every cell is NULL or white space only."""
    cells = F.array(*[c.cast("string") for c in cols])
    return F.forall(cells, is_blank)


def contains_any(c: Column, words) -> Column:
    return c.rlike(any_of(words)) if words else F.lit(False)


def one_line(c: Column) -> Column:
    """Newlines become spaces, carriage returns vanish."""
    return F.translate(F.regexp_replace(c, "\n", " "), "\r", "")


def json_block(c: Column) -> Column:
    """JSON object or array inside free text, fenced or bare: from the first opening
    brace or bracket to the last one that closes its kind; NULL when there is none."""
    brace, bracket = F.instr(c, "{"), F.instr(c, "[")
    is_object = (brace > 0) & ((bracket == 0) | (brace < bracket))
    start = F.when(is_object, brace).otherwise(bracket)
    from_end = F.instr(F.reverse(c), "}"), F.instr(F.reverse(c), "]")
    tail = F.when(is_object, from_end[0]).otherwise(from_end[1])
    size = F.length(c) - tail - start + F.lit(2)
    return F.when((start > 0) & (tail > 0) & (size > 1), F.substring(c, start, size))


def country_list(c: Column) -> Column:
    """Array from a list literal such as ``['DE','AT']``; empty when not a list."""
    is_list = c.rlike(r"(?s)^\[.*\]$")
    parsed = F.from_json(F.translate(c, "'", '"'), "array<string>")
    return F.coalesce(F.when(is_list, parsed), F.array().cast("array<string>"))


def blocks(text: Column, size: int = 1024) -> Column:
    """The text in pieces of ``size`` characters, an index for ``cut``."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def cut(pieces: Column, start: Column, end: Column, size: int = 1024) -> Column:
    """Characters [start, end) of the text behind ``blocks``; costs what it returns, not the
    text's length."""
    first = F.floor(start / size).cast("int")
    some = F.array_join(F.slice(pieces, first + 1, F.floor((end - 1) / size).cast("int") - first + 1), "")
    return F.when(end > start, F.substring(some, (start - first * size + 1).cast("int"), (end - start).cast("int"))).otherwise("")
