"""Phone candidates of page texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from callsheet import dims
from callsheet.functions import phones
from callsheet.functions.stages import let
from callsheet.functions.text import blocks, cut, strip
from callsheet.operators.paging import positions


def scan_region(codes) -> "F.Column":
    """First target country when it is a two-letter code, else the scan default."""
    first = F.try_element_at(codes, F.lit(1))
    return F.when(F.length(first) == 2, F.upper(first)).otherwise(F.lit(dims.SCAN_REGION))


def _matches(text: Column, region) -> Column:
    """Dialable runs of a text that read as valid numbers, with their place among all runs. A
    run that is no number itself may hold two or more, which share its place."""
    def match(i: Column, raw: Column, start: Column, number: Column) -> Column:
        return F.struct(i.alias("match_ord"), raw.alias("raw"), start.alias("match_start"),
                        (start + F.length(raw)).alias("match_end"), number.alias("number"))

    def tested(r: Column, i: Column) -> Column:
        whole = lambda number: F.when(number.isNotNull(), F.array(match(i, r["raw"], r["start"], number))).otherwise(F.transform(
            let(phones.numbers_in_run(r["raw"], region), lambda all_: F.filter(all_, lambda n: F.size(all_) > 1)),
            lambda n: match(i, n["raw"], r["start"] + n["offset"], n["number"])))
        return F.when(phones.is_dialable_run(r["raw"], r["before"], r["after"]), let(phones.e164_or_null(r["raw"], region), whole))

    return F.flatten(F.filter(F.transform(phones.digit_runs(text), tested), lambda m: m.isNotNull()))


def _inlined(texts: DataFrame, found: Column) -> DataFrame:
    return texts.filter(F.col("text").rlike(phones.WHOLE_RUN)).select(*[c for c in texts.columns if c != "text"], F.inline(found))


def _with_snippets(texts: DataFrame, matches: Column, half: int, some: int = 256) -> DataFrame:
    """``matches`` of each text with their snippets, ``some`` matches at a time. A snippet may be as long as its
    text (numbers inside one long word), so a text's spans are found in its row, but what leaves it is the
    stretch that ``some`` of them share; they are cut from that in a row of their own."""
    text, names = F.col("text"), ("match_ord", "raw", "match_start", "match_end", "number")
    index = F.struct(blocks(text).alias("_pieces"), F.length(text).alias("_length"), F.struct(
        (F.instr(text, " ") - 1).alias("first"), (F.length(text) - F.length(F.substring_index(text, " ", -1)) - 1).alias("last")).alias("_blanks"))

    def stretch(t: Column, m: Column) -> Column:
        spans = F.transform(m, lambda x: F.struct(x.alias("m"), phones.snippet_span(
            t["_pieces"], t["_length"], x["match_start"], x["match_end"], half, blanks=t["_blanks"]).alias("s")))
        return let(spans, lambda s: let(F.struct(F.array_min(s["s"]["a"]).alias("a"), F.array_max(s["s"]["z"]).alias("z")), lambda w: F.struct(
            cut(t["_pieces"], w["a"], w["z"]).alias("_stretch"), w["a"].alias("_from"), s.alias("_spans"))))

    def stretches(m: Column) -> Column:
        parts = F.sequence(F.lit(0), F.floor((F.size(m) - 1) / some).cast("int"))
        return F.when(F.size(m) > 0, let(index, lambda t: F.transform(parts, lambda i: stretch(t, F.slice(m, i * some + 1, F.lit(some))))))

    kept = [c for c in texts.columns if c != "text"]
    one = lambda p: F.transform("_spans", lambda x: F.struct(*[x["m"][c].alias(c) for c in names], strip(
        cut(p, x["s"]["a"] - F.col("_from"), x["s"]["z"] - F.col("_from"))).alias("snippet")))
    return _inlined(texts, let(matches, stretches)).select(*kept, F.inline(let(blocks(F.col("_stretch")), one)))


def phone_matches(texts: DataFrame, region=dims.SCAN_REGION, window: int | None = None) -> DataFrame:
    """Digit runs of column ``text`` that read as valid numbers, with offsets and, given a
    ``window``, the text around them. All tests run inside the text's row, so what leaves
    it are matches only; the text itself goes no further."""
    found = _matches(F.col("text"), region)
    return _inlined(texts, found) if window is None else _with_snippets(texts, found, window // 2)


def phone_candidates(texts: DataFrame, region=dims.SCAN_REGION, window: int = 300) -> DataFrame:
    """Plausible numbers with their context snippet; drops ``text``."""
    kept = [c for c in texts.columns if c != "text"]
    good = F.filter(_matches(F.col("text"), region), lambda m: let(phones.national_number(m["number"]), lambda nsn: phones.plausible(m["raw"], nsn)))
    return _with_snippets(texts, good, window // 2).select(*kept, "match_ord", "raw", "number", "snippet")


def beyond_cap(cands: DataFrame, limit: int, page: str = "page_url") -> DataFrame:
    """What ``cap_identical`` leaves out, with the place among the number's occurrences."""
    return positions(cands, [page, "number"], ["match_ord"], "place").filter(F.col("place") >= limit)


def cap_identical(cands: DataFrame, limit: int, page: str = "page_url") -> DataFrame:
    """First ``limit`` occurrences of a number per page. The rank filter sits right
    on the window, so each map task passes on at most ``limit`` rows per group."""
    w = Window.partitionBy(page, "number").orderBy("match_ord")
    return cands.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= limit).drop("_n")
