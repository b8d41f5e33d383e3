"""Regular expressions that mean the same in Python, Java and RE2 engines."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = "[0-9A-Za-z_]"
#: ASCII word boundary; Java's own is Unicode-aware.
BOUNDARY = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
#: White space as RE2 sees it.
SPACE = r"[\t\n\f\r ]"


def whole_word(word: str) -> str:
    return rf"(?iu){BOUNDARY}{re.escape(word)}{BOUNDARY}"


def any_whole_word(words: list[str]) -> str:
    return rf"(?iu){BOUNDARY}(?:{'|'.join(re.escape(w) for w in words)}){BOUNDARY}"


def holds(cond: Column) -> Column:
    """Null as false."""
    return F.coalesce(cond, F.lit(False))


def keyword(term: str, partial: bool = False, case: bool = False, joiner: str = r"\s+") -> str:
    """A phrase whose words may stand apart by any white space; whole words unless ``partial``. Unicode-aware."""
    body = joiner.join(re.escape(w) for w in term.split())
    flags = "(?U)" if case else "(?iU)"
    return f"{flags}{body}" if partial else rf"{flags}(?<!\w){body}(?!\w)"
