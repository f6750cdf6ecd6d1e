"""Name splitting: first and last whitespace-separated token."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# White space as str.split() sees it; the same text works in Java's and RE2's patterns.
SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"


def _trimmed(name: Column) -> Column:
    return F.regexp_replace(name, f"^{SPACE}+|{SPACE}+$", "")


def _tokens(name: Column, mode: str) -> Column:
    if mode == "whitespace":
        # any run of white space, outer white space ignored
        return F.split(_trimmed(name), f"{SPACE}+")
    if mode == "space":
        # single-space split without trimming; outer blanks give '' tokens
        return F.split(name, " ")
    raise ValueError(f"unknown split mode {mode!r}")


def _has_token(name: Column, mode: str) -> Column:
    return _trimmed(name) != "" if mode == "whitespace" else name.isNotNull()


def first_token(name: Column | str, mode: str = "whitespace") -> Column:
    """Token 0; NULL for a NULL or blank name."""
    name = F.col(name) if isinstance(name, str) else name
    return F.when(_has_token(name, mode), _tokens(name, mode).getItem(0))


def last_token(name: Column | str, mode: str = "whitespace") -> Column:
    """Last token; a one-token name gives that token; middle tokens are dropped."""
    name = F.col(name) if isinstance(name, str) else name
    return F.when(_has_token(name, mode), F.element_at(_tokens(name, mode), -1))
