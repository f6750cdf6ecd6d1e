"""Quality rules, line first [native].

Each line is judged by itself: stray punctuation, navigation and boilerplate
make it fail. Failing lines are removed, and a document that loses too many of
its words with them is rejected. Base measures of the whole text (length,
repetition) reject a document too.

One scan and no shuffle: everything about a document is computed inside its
row with DataFrame functions, in time n log n of its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, n_words

SYMBOLS = "#*$%&|<>"

# Fixed phrases of boilerplate and navigation, matched in lower-cased lines.
BOILERPLATE = ("all rights reserved", "privacy policy", "terms of use", "terms of service",
               "cookie policy", "we use cookies", "accept cookies", "enable javascript",
               "javascript is disabled", "subscribe to our newsletter", "lorem ipsum")
NAVIGATION = ("home", "menu", "login", "log in", "sign in", "sign up", "register", "search",
              "next", "previous", "back to top", "read more", "click here", "share this",
              "skip to content", "contact us", "about us")

#: A line fails at these shares of its words (the bounds are inclusive).
SYMBOL_SHARE = 30      # percent: runs of SYMBOLS
SHOUTED_SHARE = 50     # percent: runs of "!" or "?" of two or more
SEPARATED_SHARE = 25   # percent: lone "/", "-" or ">" between blanks
SHORT_LINE = 80        # boilerplate phrases only fail lines of so many characters or fewer
LOST_SHARE = 50        # a document that loses more than this percent of its words is rejected


def step(value: Column, f) -> Column:
    """``f`` of a value that is made once: a one-element transform binds it.
    (Projections one after the other would be merged, and the value made again
    wherever it is used.)"""
    return F.get(F.transform(F.array(value), f), 0)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def line_fails(line: Column) -> Column:
    """Whether a line breaks a rule. Blank lines don't. The cheap test of each
    rule stands first, so that most lines need no word count."""
    n = _count(line, WORD)

    def share(first: Column, pattern: str, percent: int) -> Column:
        return first & (100 * _count(line, pattern) >= percent * n)

    def any_of(*parts: str, text: Column = line) -> Column:
        found = text.contains(parts[0])
        for part in parts[1:]:
            found = found | text.contains(part)
        return found

    def short(low: Column) -> Column:
        bare = F.regexp_replace(low, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
        return any_of(*BOILERPLATE, text=low) | ((F.length(low) < 40) & bare.isin(*NAVIGATION))

    return (share(line.rlike(r"[#*$%&|<>]"), r"[#*$%&|<>]+", SYMBOL_SHARE)
            | share(any_of("!!", "!?", "?!", "??"), r"[!?]{2,}", SHOUTED_SHARE)
            | share(any_of(" / ", " - ", " > "), r" [/>-] ", SEPARATED_SHARE)
            | ((F.length(line) <= SHORT_LINE) & step(F.lower(line), short)))


def repeated_words(found: Column, window: int = 3) -> Column:
    """Words inside windows of ``window`` words that occur twice or more in
    the list ``found``. Each window's hash and place are packed into one
    number; sorted, windows of equal hash are neighbours. Only those are then
    compared as words, and the union of the spans of the equal ones counted."""
    def gram(x: Column, i: Column, w: Column) -> list[Column]:
        return [x, *[F.get(w, i + k) for k in range(1, window)]]

    low = (1 << 31) - 1  # the place, which is less than 2**31, fills the low bits

    def packed(x: Column, i: Column) -> Column:
        return F.xxhash64(*gram(x, i, found)).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))

    def alike(v: Column) -> Column:  # places of windows whose hash a neighbour shares
        head = lambda x: F.shiftright(x, 31)
        return F.transform(F.filter(v, lambda x, i: F.coalesce(
            head(x) == head(F.get(v, i + 1)), F.lit(False)) | F.coalesce(
            head(x) == head(F.get(v, i - 1)), F.lit(False))), lambda x: x.bitwiseAND(F.lit(low)))

    def grams(at: Column) -> Column:
        return F.sort_array(F.transform(at, lambda p: F.struct(
            F.concat_ws(" ", *[F.get(found, p.cast("int") + k) for k in range(window)]).alias("g"),
            p.alias("at"))))

    def equal(s: Column) -> Column:
        marked = F.transform(s, lambda x, i: F.when(
            (F.get(s, i - 1)["g"] == x["g"]) | (F.get(s, i + 1)["g"] == x["g"]), x["at"]))
        return F.sort_array(F.filter(marked, lambda x: x.isNotNull()))

    def covered(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, i: F.least(
                F.lit(window), F.coalesce(F.get(p, i + 1) - x, F.lit(window)))),
            F.lit(0).cast("long"), lambda a, x: a + x)

    whole = F.slice(F.transform(found, packed), 1, F.size(found) - (window - 1))
    return F.when(F.size(found) <= window, F.lit(0).cast("long")).otherwise(
        step(step(F.sort_array(whole), alike), lambda at: F.when(
            F.size(at) == 0, F.lit(0).cast("long")).otherwise(
                step(step(grams(at), equal), covered))))


def clean_lines(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with one struct column more, ``quality``: n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, n_lost (words of failing lines),
    base_failed, kept, clean_text (the text without its failing lines).

    A NULL text counts as empty, fails the base rule and stays NULL. Equal
    rows get equal results. An empty table gives an empty one. Other columns stay
    as they are, but one that is named ``quality`` itself, which is called
    ``quality_in`` (and so on with further ``_in``, where that is taken too)."""
    body = F.coalesce(F.col(text), F.lit(""))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("repeat"))

    def of_lines(lines: Column) -> Column:
        full = F.filter(lines, lambda x: x.rlike(WORD))
        return step(F.struct(F.filter(lines, lambda x: ~line_fails(x)).alias("good"),
                             full.alias("full")), lambda x: F.struct(
            x["good"].alias("good"),
            (F.size(x["full"]) - F.size(F.array_distinct(x["full"]))).cast("long").alias("dup"),
            (F.size(x["good"]) == F.size(lines)).alias("all_good")))

    def result(m: Column) -> Column:
        n, repeat = m["words"]["n"], m["words"]["repeat"]
        clean = F.array_join(m["lines"]["good"], "\n")
        lost = F.when(m["lines"]["all_good"], F.lit(0).cast("long")).otherwise(n - n_words(clean))
        return step(F.struct(
            n.alias("n_words"),
            F.length(F.translate(body, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
            (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            m["lines"]["dup"].alias("n_dup_lines"), repeat.alias("n_repeat_words"),
            lost.alias("n_lost"), ((n < 50) | (100 * repeat > 50 * n)).alias("base_failed"),
            F.when(F.col(text).isNotNull(), clean).alias("clean_text")), lambda r: F.struct(
                *[r[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                          "n_repeat_words", "n_lost", "base_failed")],
                (~r["base_failed"] & (100 * r["n_lost"] <= LOST_SHARE * r["n_words"])).alias("kept"),
                r["clean_text"].alias("clean_text")))

    measured = F.struct(
        step(F.regexp_extract_all(body, F.lit(WORD), F.lit(0)), of_words).alias("words"),
        step(F.split(body, "\n", -1), of_lines).alias("lines"))
    taken, moved = {c.lower() for c in docs.columns}, "quality"
    while moved in taken:
        moved += "_in"
    names = [moved if c.lower() == "quality" else c for c in docs.columns]
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)],
                       step(measured, result).alias("quality"))
