"""Page text and anchors from stored HTML, with regular expressions only."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, functions as F

from callsheet.functions.regex import LONG_SPACE
from callsheet.functions.text import strip

# Scripts come before tags: they may hold text that looks like markup.
HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
TAG = r"(?is)<[!?/a-z][^>]*>"
MARKUP = HIDDEN + "|" + TAG.removeprefix("(?is)")
# An anchor ends at its end tag, at the next anchor or with the page.
ANCHOR = r"(?is)<a\b[^>]*>.*?(?:</a\s*>|(?=<a\b)|\z)"
HREF = r"""(?is)^<a\b[^>]*?\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
REFERENCE = r"(?s)^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);(.*)$"
# All named references of the public HTML standard; the most frequent first, as a map is searched from its start.
FREQUENT = ["amp", "nbsp", "lt", "gt", "quot", "auml", "ouml", "uuml", "szlig"]
NAMES = {n[:-1]: c for n, c in html5.items() if n.endswith(";")}
NAMES = json.dumps({n: NAMES[n] for n in FREQUENT} | NAMES)


def _code_point(n: Column) -> Column:
    """Character of a code point (``chr`` only knows the first 256)."""
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def decode_entities(c: Column) -> Column:
    """Replace numeric and named character references, in one pass."""
    names = F.from_json(F.lit(NAMES), "map<string,string>")

    def one(piece: Column) -> Column:
        name = F.regexp_extract(piece, REFERENCE, 1)
        rest = F.regexp_extract(piece, REFERENCE, 2)
        decimal = F.substring(name, 2, 7).try_cast("bigint")
        hexa = F.conv(F.substring(name, 3, 6), 16, 10).try_cast("bigint")
        number = F.when(name.rlike("^#[0-9]"), decimal).when(name.rlike("^#[xX]"), hexa)
        char = F.coalesce(
            F.try_element_at(names, name),
            F.when(number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF), _code_point(number)))
        return F.when((name != "") & char.isNotNull(), F.concat(char, rest)).otherwise(
            F.concat(F.lit("&"), piece))

    pieces = F.split(c, "&")
    decoded = F.concat(
        F.element_at(pieces, 1),
        F.array_join(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), one), ""))
    return F.when(c.contains("&"), decoded).otherwise(c)


def without_hidden(c: Column) -> Column:
    """Page source without scripts, styles and comments, in one pass."""
    return F.regexp_replace(c, HIDDEN, " ")


def html_text(c: Column) -> Column:
    """Visible text: tags become blanks, references are decoded, blanks collapse."""
    bare = F.regexp_replace(c, MARKUP, " ")
    return F.coalesce(F.trim(F.regexp_replace(decode_entities(bare), LONG_SPACE, " ")), F.lit(""))


def anchors(c: Column) -> Column:
    """Array of all ``<a>`` elements of a page."""
    return F.regexp_extract_all(without_hidden(c), F.lit(ANCHOR), 0)


def anchor_href(tag: Column) -> Column:
    raw = F.concat(*[F.regexp_extract(tag, HREF, i) for i in (1, 2, 3)])
    return strip(decode_entities(raw))


def anchor_text(tag: Column) -> Column:
    return F.lower(strip(decode_entities(F.regexp_replace(tag, TAG, ""))))
