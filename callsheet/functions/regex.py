"""Helpers that turn literal word lists into regular expressions. All patterns
avoid look-around and back references so that they run on any RE2 engine too."""

from __future__ import annotations

import re

# Unicode white space, as one character class body.
SPACE = r"\s\x0B\x1C-\x1F\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
# A run of white space that is not already one plain blank.
OTHER_SPACE = SPACE.replace(r"\s", r"\t\n\f\r")
LONG_SPACE = f" [{SPACE}]+|[{OTHER_SPACE}][{SPACE}]*"
TRIM = f"^[{SPACE}]+|[{SPACE}]+$"


def quote(word: str) -> str:
    """Escape every character that is special in Java and RE2 syntax."""
    return re.sub(r"([\\.^$|?*+()\[\]{}-])", r"\\\1", word)


def any_of(words) -> str:
    return "(?:" + "|".join(quote(w) for w in words) + ")"
