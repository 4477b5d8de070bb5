"""Text cleaning: categories, code maps, keyword classes, titles."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that start a new word in a title, besides
# white space.
TITLE_BREAKS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"


def tidy(col: Column) -> Column:
    """Upper case without leading and trailing spaces."""
    return F.upper(F.trim(col))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def has_text(col: Column) -> Column:
    """True where something other than spaces is present; NULL stays NULL."""
    return F.trim(col) != ""


def category(col: Column, default: str = "UNKNOWN") -> Column:
    """Upper-case category; blank and NULL become ``default``."""
    return F.coalesce(blank_to_null(tidy(col)), F.lit(default))


def title_case(col: Column) -> Column:
    """Capitalise each word, where punctuation separates words too."""
    breaks = "".join("\\" + c for c in TITLE_BREAKS)
    words = F.split(F.lower(col), f"(?<=[\\s{breaks}])")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), ""
    )


def map_codes(col: Column, codes: Mapping[str, Iterable[str]], default: Column | str = "UNKNOWN") -> Column:
    """Replace any alias of a code by the code itself; anything else by ``default``."""
    key = tidy(col)
    fallback = default if isinstance(default, Column) else F.lit(default)
    return first_match([(key.isin(*aliases), code) for code, aliases in codes.items()], fallback)


def contains_any(cols: Iterable[tuple[Column, Iterable[str]]]) -> Column:
    tests = [col.contains(word) for col, words in cols for word in words]
    return reduce(lambda a, b: a | b, tests)


def first_match(rules: Iterable[tuple[Column, str]], default: Column | str) -> Column:
    """Label of the first rule that holds, in the given order."""
    chain = None
    for test, label in rules:
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise(default)
