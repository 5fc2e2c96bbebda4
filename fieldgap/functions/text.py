"""Text normalisation and surrogate keys (F-1, F-2, F-4..F-7, F-11..F-15, F-24, F-26..F-31)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every Unicode space separator. Trimming removes these but keeps tabs.
SPACES = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u202f\u205f\u3000"
)
# Java's \s also matches the vertical tab, so the whitespace class is spelled out.
WHITESPACE_RUN = r"[\t\n\f\r ]+"


def trim_spaces(c: Column) -> Column:
    """Trim Unicode space separators on both ends."""
    return F.trim(c, F.lit(SPACES))


def trim_ends(c: Column) -> Column:
    """`trim_spaces` for columns that seldom have any.

    Trimming compares sign by sign with the list of spaces; text that begins and ends with a visible
    ASCII sign has nothing to trim and stays as it is. The two tests make more code than the trim alone.
    """
    bare = F.substring(c, 1, 1).between("!", "~") & F.substring(c, -1, 1).between("!", "~")
    return F.when(bare, c).otherwise(trim_spaces(c))


def blank_to_null(c: Column) -> Column:
    """Landing rule for raw cells: trim, then treat the empty string as missing."""
    return F.nullif(trim_spaces(c), F.lit(""))


def model_name_key(c: Column) -> Column:
    """Upper-case words separated by single spaces; missing names become ''.

    Non-ASCII letters separate words, so they are replaced before upper-casing ('ß' would
    otherwise turn into 'SS'). Alnum is ASCII only, and one test per sign: the three ranges spelled out
    are a chain of tests that the JVM does not inline, ten times as slow.
    """
    words = F.regexp_replace(F.coalesce(c, F.lit("")), r"\P{Alnum}+", " ")
    return F.trim(F.upper(words))


def make_name_key(c: Column) -> Column:
    """Upper-case name with whitespace runs collapsed; missing names become ''.

    Only names with a run or with another sign than the space need the regular expression.
    """
    upper = F.upper(F.coalesce(c, F.lit("")))
    to_collapse = F.contains(upper, F.lit("  "))
    for sign in "\t\n\f\r":
        to_collapse = to_collapse | F.contains(upper, F.lit(sign))
    return trim_spaces(F.when(to_collapse, F.regexp_replace(upper, WHITESPACE_RUN, " ")).otherwise(upper))


def collapse_spaces(c: Column) -> Column:
    """Strip all surrounding whitespace and collapse inner runs, keeping the letter case."""
    stripped = F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    return F.regexp_replace(stripped, r"[\s\p{Z}]+", " ")


def yes_flag(c: Column) -> Column:
    """Y / YES in any case is true, everything else including missing is false."""
    return F.upper(F.coalesce(c, F.lit("N"))).isin("Y", "YES")


def unfused(c: Column) -> Column:
    """The same value by way of a lambda, which keeps its projection out of the method around it.

    Spark makes one method of all that it fuses, and the JVM does not compile methods above 8000 bytes, so
    that a wide projection right after the one that reads its cells runs interpreted, some three times as
    long. A projection with a lambda is not fused, and its columns become methods of their own, whatever
    limits the session sets. One such column is enough.
    """
    return F.get(F.transform(F.array(c), lambda same: same), F.lit(0))


def path_level(c: Column, level: int, sep: str = ":") -> Column:
    """The n-th level of a separated path; '' when the path is shorter."""
    if level == 1:
        return F.substring_index(c, sep, 1)
    return F.split_part(c, F.lit(sep), F.lit(level))


def joined_key(*cols: Column) -> Column:
    """md5 surrogate key over the non-null parts joined with '|'."""
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))


def path_key(c: Column) -> Column:
    """md5 surrogate key of a trimmed, upper-cased path; missing stays missing."""
    return F.md5(F.upper(trim_spaces(c)))


def fully_matches(c: Column, pattern: str) -> Column:
    r"""Whole-string regular-expression test. Java's `$` accepts a trailing newline, `\z` does not."""
    return c.rlike(rf"\A(?:{pattern})\z")


def java_replacement(c: Column) -> Column:
    r"""Turn a `\1`-style replacement into Java's `$1` form, escaping literal dollars."""
    escaped = F.regexp_replace(c, r"\$", r"\\\$")
    return F.regexp_replace(escaped, r"\\([0-9])", r"\$$1")


# Signs that stand between packed texts and for a missing one.
BETWEEN, MISSING = "\u0001", "\u0002"


def packed_texts(names: Sequence[str]) -> list[Column]:
    """`_texts`, the named columns as one text, and `_apart`, an array of them where they hold the signs of packing.

    A row with one text is smaller in a shuffle than a row with many: every text of a row has a word of
    place and length, which differs from row to row.
    """
    together = F.concat_ws("", *names)
    apart = F.contains(together, F.lit(BETWEEN)) | F.contains(together, F.lit(MISSING))
    joined = F.concat_ws(BETWEEN, *[F.coalesce(F.col(n), F.lit(MISSING)) for n in names])
    return [F.when(~apart, joined).alias("_texts"), F.when(apart, F.array(*names)).alias("_apart")]


def unpacked_texts(names: Sequence[str]) -> list[Column]:
    """The columns of `packed_texts` from `_cells`, its text split at BETWEEN, and `_apart`."""
    return [
        F.when(F.col("_apart").isNotNull(), F.get("_apart", F.lit(i)))
        .otherwise(F.nullif(F.get("_cells", F.lit(i)), F.lit(MISSING)))
        .alias(n)
        for i, n in enumerate(names)
    ]


def reason_text(reasons: Column) -> Column:
    """Comma-joined sorted reason names."""
    return F.array_join(F.array_sort(reasons), ",")


def left_text(c: Column, n: int) -> Column:
    """The first n characters."""
    return F.substring(c, 1, n)


def hash_fraction(c: Column) -> Column:
    """Deterministic value in [0, 1] from the first 32 bits of the md5 digest."""
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("bigint") / F.lit(
        4294967295.0
    )


def word_prefixes(c: Column) -> Column:
    """All proper prefixes that end right before a space, shortest first.

    `sequence(1, 0)` counts down, so single words are guarded explicitly.
    """
    words = F.split(c, " ")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(words) - 1),
        lambda n: F.array_join(F.slice(words, F.lit(1), n), " "),
    )
    return F.when(F.size(words) > 1, prefixes).otherwise(F.array().cast("array<string>"))
