"""Column functions for tokens, query strings and file names.

All of them are built-in expressions, so they stay in the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token alphabet, the supported suffixes and the white space
# of the C locale. The class is ASCII in Spark's regular expressions, and it is
# matched much faster than the three ranges it stands for.
TOKEN_PATTERN = r"\p{Alnum}+"
SUPPORTED_PATTERN = r"(?is)[^/][.](txt|md|log|csv)\z"
SUFFIX_PATTERN = r"(?s)[^/]([.][^./]*)\z"
SPACE_CHARACTERS = " \t\n\u000b\f\r"


def raw_tokens(text: Column | str) -> Column:
    """Maximal ASCII alphanumeric runs, in order, with their case kept.

    Folding comes after matching: folding the text first would turn characters
    such as U+212A (Kelvin sign) into ASCII letters and so change the tokens.
    """
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def fold(word: Column | str) -> Column:
    """Lower-case a raw token, which is ASCII by construction."""
    return F.lower(word)


def tokenize(text: Column | str) -> Column:
    """Folded tokens of a text as an array, in order, duplicates kept."""
    return F.transform(raw_tokens(text), fold)


def count_tokens(text: Column | str) -> Column:
    """Number of tokens. Folding does not change it, so it is left out."""
    return F.coalesce(F.size(raw_tokens(text)).cast("bigint"), F.lit(0).cast("bigint"))


def count_tokens_by_line(text: Column | str) -> Column:
    """The same number, counted line by line and added up inside the row."""
    return F.aggregate(
        F.split(text, "\n"),
        F.lit(0).cast("bigint"),
        lambda total, line: total + count_tokens(line),
    )


def distinct_terms(text: Column | str) -> Column:
    """Each token of a query once, as an array."""
    return F.array_distinct(tokenize(text))


def trim_space(value: Column | str) -> Column:
    """Strip space, tab, newline, vertical tab, form feed and return."""
    return F.trim(value, F.lit(SPACE_CHARACTERS))


def unquote(value: Column | str) -> Column:
    """Trim, then take off one pair of equal quotes. The inside stays as it is."""
    trimmed = trim_space(value)
    first = F.substring(trimmed, 1, 1)
    quoted = (
        (F.length(trimmed) >= 2)
        & first.isin('"', "'")
        & (first == F.substring(trimmed, -1, 1))
    )
    inside = F.substring(trimmed, F.lit(2), F.length(trimmed) - 2)
    return F.when(quoted, inside).otherwise(trimmed)


def file_extension(path: Column | str) -> Column:
    """Last suffix of the file name, folded; empty for names like ``.txt``."""
    return F.lower(F.regexp_extract(path, SUFFIX_PATTERN, 1))


def is_supported(path: Column | str) -> Column:
    """True when the file name ends in one of the indexed suffixes."""
    return F.regexp_like(path, F.lit(SUPPORTED_PATTERN))


def path_components(path: Column | str) -> Column:
    """The path as an array, whose order is the order of a directory scan."""
    return F.split(path, "/")


def query_words(query: str) -> list[str]:
    """Distinct folded tokens of one query string held by the driver."""
    return list(dict.fromkeys(word.lower() for word in re.findall("[0-9A-Za-z]+", query)))


def query_argument(query: str) -> str:
    """``unquote`` for one query string held by the driver."""
    trimmed = query.strip(SPACE_CHARACTERS)
    if len(trimmed) >= 2 and trimmed[0] == trimmed[-1] and trimmed[0] in "\"'":
        return trimmed[1:-1]
    return trimmed
